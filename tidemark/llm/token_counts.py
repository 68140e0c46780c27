"""Token counts by a two-tier lookup: a broadcast table of frequent segments, and worker caches.

No segment is shuffled: a task counts its own segments and passes on a bounded
sketch of the most frequent ones.  The table decides only how fast a text is
counted, never the count.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.pieces import Tier, segments

#: Texts are looked up in groups of about so many characters, so long texts need no more memory.
_GROUP_CHARS = 2_000_000


def _processor(model_path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model_path)


def segment_lengths(processor, wanted: list[str]) -> list[int]:
    """Tokens of each segment with the space before it.

    The library puts a space before every text but the empty one; an empty
    segment stands for one space and is the library's token for it.
    """
    return [len(ids) if s else 1 for s, ids in zip(wanted, processor.encode(wanted, num_threads=1))]


def frequent_segments(
    docs: DataFrame, text_column: str = "text", size: int = 50_000, per_task: int = 20_000, width: int = 200_000
) -> list[str]:
    """At most ``size`` of the most frequent segments of all texts.

    A task counts every segment; when its counter holds over ``width`` of them
    it keeps the larger half and passes on at most ``per_task`` in the end.
    The driver gets ``size`` strings at most, and a segment longer than 64
    characters is never among them.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    seen.update(segments(text))
                if len(seen) > width:
                    seen = Counter(dict(seen.most_common(width // 2)))
        kept = [(s, n) for s, n in seen.most_common(per_task) if n > 1 and len(s) <= 64]
        yield pa.RecordBatch.from_arrays(
            [pa.array([s for s, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())],
            names=["segment", "n"],
        )

    counted = docs.select(F.col(text_column)).mapInArrow(count, "segment string, n long")
    total = counted.groupBy("segment").agg(F.sum("n").alias("n"))
    return [r.segment for r in total.orderBy(F.desc("n"), "segment").limit(size).collect()]


def token_count(text: Column | str, model_path: str, frequent: list[str]) -> Column:
    """Tokens of a text column as the piece library gives them; null and empty texts have none."""
    lengths = dict(zip(frequent, segment_lengths(_processor(model_path), frequent)))
    table = SparkSession.active().sparkContext.broadcast(lengths)

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        processor = _processor(model_path)
        tier = Tier(lambda wanted: segment_lengths(processor, wanted), table.value)
        for texts in batches:
            out, cut, chars = [], [], 0

            def flush() -> None:
                tier.learn(set().union(*cut))
                out.extend(sum(map(tier.__getitem__, parts)) for parts in cut)
                cut.clear()

            for text in texts:
                cut.append(segments(text) if text else [])
                chars += len(text or "")
                if chars > _GROUP_CHARS:
                    flush()
                    chars = 0
            flush()
            yield pd.Series(out, dtype="int64")

    return count(text)


def token_counts(
    docs: DataFrame, model_path: str, *, id_column: str = "doc_id", text_column: str = "text",
    limit: int = 4096, frequent: int = 50_000,
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row.

    Null and empty texts have no bytes and no tokens.  Rows are counted one by
    one, so repeated rows and null ids come out as they went in.
    """
    counted = docs.select(
        F.col(id_column).alias("doc_id"),
        F.coalesce(F.octet_length(text_column), F.lit(0)).cast("long").alias("n_bytes"),
        token_count(F.col(text_column), model_path, frequent_segments(docs, text_column, frequent)).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
