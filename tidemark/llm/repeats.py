"""Substring dedup: documents factored against an index of reference blocks of all documents.

A document is cut at words its own content selects (the smallest hash of
every ``window`` words), so equal passages are cut alike wherever they lie.
Its blocks are looked up in the index of all documents' blocks; runs of known
blocks are the long factors of a greedy parse, and need no further look.  At a
factor's boundary, where a block is unknown but a window's own seed is known elsewhere,
single windows are looked up in the same way.  Words are hashed to two independent
lanes of 64 bits; blocks are decided by 128 bits and windows by 96, which among the
10^13 windows of 100 TB meet by chance less than once in 1,000 runs.  Seeds only choose
what is looked up: 48 bits of them do, as a seed taken for another costs a look only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh3_128_digest

from tidemark.llm.text import Rolling, mixed, sliding, word_digests, words_of

_SEED = 8
#: High bits of a gram's hash that stand for it as a seed.
_SEED_SHIFT = np.uint64(64 - 48)
#: One of so many seeds starts a block, so a block holds about 60 words besides its window.
_BLOCK_EVERY = 4


class Parse:
    """Seeds and blocks of one text's word digests (two lanes)."""

    def __init__(self, digests: tuple[np.ndarray, np.ndarray], window: int):
        h, n = digests[0], len(digests[0])
        self.words = np.stack(digests, axis=1)
        self.window, self.n_windows = window, n - window + 1
        size = min(_SEED, window)
        self.lanes = (Rolling(h), Rolling(digests[1], 1))
        grams = self.lanes[0].windows(size)
        # A gram is a seed if it is the smallest of some window that lies in the text.
        span = window - size + 1
        least = self.least = sliding(grams, span, np.minimum)
        pad = np.zeros(span - 1, dtype=np.uint64)
        reach = sliding(np.concatenate([pad, least, pad]), span, np.maximum)
        self.seeds = np.flatnonzero(reach == grams)
        self.seed_hash = grams[self.seeds]
        cuts = self.seeds[mixed(self.seed_hash) % np.uint64(_BLOCK_EVERY) == 0]
        cuts = cuts[(cuts > 0) & (cuts < self.n_windows)]
        self.starts = np.concatenate([[0], cuts]).astype(np.int64)
        self.ends = np.concatenate([cuts, [self.n_windows]]).astype(np.int64)

    def window_keys(self, at: np.ndarray) -> list[np.ndarray]:
        """96 bits for the words of single windows: one lane and half of the other."""
        first, second = (lane.runs(at, at + self.window).view(np.int64) for lane in self.lanes)
        return [first, (second >> 32).astype(np.int32)]

    def block_keys(self) -> list[np.ndarray]:
        """128 bits for the words under each block's windows.

        A block may be long, and sums of powers of a radix modulo 2^64 are equal for some long
        regular texts; the digests of its words are hashed as bytes instead.
        """
        view = memoryview(np.ascontiguousarray(self.words)).cast("B")
        lasts = self.ends + (self.window - 1)
        found = b"".join(xxh3_128_digest(view[16 * a : 16 * b]) for a, b in zip(self.starts.tolist(), lasts.tolist()))
        both = np.frombuffer(found, dtype=np.int64).reshape(-1, 2)
        return [both[:, 0], both[:, 1]]


def _groups(batch: pa.RecordBatch, chars: int = 4_000_000):
    """Row ranges of a batch with about so many characters each."""
    texts, at = batch.column("text"), 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and size < chars:
            size += len(texts[to].as_py() or "")
            to += 1
        yield batch.slice(at, to - at)
        at = to


def _index_rows(window: int):
    """Rows (key1, key2, row, start, n): a seed has n = 0, a block the number of its windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _groups(batch):
                columns = [[], [], [], [], []]
                for row, text in zip(part.column("row").to_pylist(), part.column("text").to_pylist()):
                    digests = word_digests(text)
                    if len(digests[0]) < window:
                        continue
                    parse = Parse(digests, window)
                    # The same seed twice in a text is one row that says so.
                    seeds, times = np.unique(parse.seed_hash >> _SEED_SHIFT, return_counts=True)
                    k1, k2 = parse.block_keys()
                    size, many = len(seeds), len(parse.starts)
                    columns[0] += [seeds.view(np.int64), k1]
                    columns[1] += [np.zeros(size, np.int64), k2]
                    columns[2].append(np.full(size + many, row))
                    columns[3] += [np.zeros(size, np.int64), parse.starts]  # a seed's place is never asked for
                    columns[4] += [np.where(times > 1, -1, 0), parse.ends - parse.starts]
                if columns[2]:
                    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(c), k) for c, k in zip(columns, kinds)],
                        names=["key1", "key2", "row", "start", "n"],
                    )

    return run, "key1 long, key2 long, row long, start int, n int"


def _window_rows(window: int):
    """Windows at factor boundaries, and those of one copy of each known block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _groups(batch):
                columns = [[], [], [], []]
                rows = (part.column(c).to_pylist() for c in ("row", "text"))
                hits = zip(part.column("seed_keys"), part.column("blocks"), part.column("references"))
                for row, text, (known_seeds, blocks, references) in zip(*rows, hits):
                    parse = Parse(word_digests(text), window)
                    # Equal windows have the same smallest gram, and it is a seed of either text.
                    runs = np.flatnonzero(np.concatenate([[True], parse.least[1:] != parse.least[:-1]]))
                    known = np.isin(parse.least[runs] >> _SEED_SHIFT, known_seeds.values.to_numpy().view(np.uint64))
                    open_ = np.repeat(known, np.diff(np.append(runs, parse.n_windows)))
                    decided = np.isin(parse.starts, blocks.values.to_numpy())
                    reference = np.isin(parse.starts, references.values.to_numpy())
                    block_of = np.repeat(np.arange(len(parse.starts)), parse.ends - parse.starts)
                    chosen = np.where(decided[block_of], reference[block_of], open_)
                    at = np.flatnonzero(chosen)
                    if len(at):
                        k1, k2 = parse.window_keys(at)
                        for column, values in zip(columns, (k1, k2, np.full(len(at), row), at)):
                            column.append(values)
                if columns[0]:
                    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(c), k) for c, k in zip(columns, kinds)],
                        names=["key1", "key2", "row", "start"],
                    )

    return run, "key1 long, key2 int, row long, start int"


def repeated_spans(docs: DataFrame, window: int = 35) -> DataFrame:
    """(row, spans) of ``docs(row, text, ...)`` with any window of words that also starts elsewhere.

    A span (start, n) says that the windows at words start .. start + n - 1 are
    repeated.  Texts shorter than a window have none.
    """
    run, schema = _index_rows(window)
    index = docs.select("row", "text").mapInArrow(run, schema)
    counts = index.groupBy("key1", "key2").agg(
        F.count("*").alias("n_all"), F.min(F.when(F.col("n") > 0, F.col("row"))).alias("first_row"), F.min("n").alias("least")
    )
    shared = counts.where("n_all > 1 or least < 0").select("key1", "key2", "first_row")
    hits = index.join(shared, ["key1", "key2"])
    block = F.col("n") > 0
    per_row = hits.groupBy("row").agg(
        F.collect_list(F.when(~block, F.col("key1"))).alias("seed_keys"),
        F.collect_list(F.when(block, F.col("start"))).alias("blocks"),
        F.collect_list(F.when(block & (F.col("row") == F.col("first_row")), F.col("start"))).alias("references"),
        F.collect_list(F.when(block, F.struct("start", "n"))).alias("block_spans"),
    ).checkpoint()
    run, schema = _window_rows(window)
    windows = docs.join(per_row.drop("block_spans"), "row").mapInArrow(run, schema)
    again = windows.groupBy("key1", "key2").agg(F.count("*").alias("n_all")).where("n_all > 1")
    single = windows.join(again.drop("n_all"), ["key1", "key2"]).groupBy("row").agg(
        F.collect_list(F.struct("start", F.lit(1).alias("n"))).alias("window_spans")
    )
    blocks = per_row.where(F.size("block_spans") > 0).select("row", "block_spans")
    spans = F.concat(F.coalesce("block_spans", F.array()), F.coalesce("window_spans", F.array()))
    return blocks.join(single, "row", "full").select("row", spans.alias("spans"))


def _kept(text: str | None, spans, window: int) -> tuple[int, int, bytes, list[tuple[int, int]]]:
    words = words_of(text)
    if not spans:
        return len(words), 0, b" ".join(words), []
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    for s in spans:
        edge[s["start"]] += 1
        edge[s["start"] + s["n"] - 1 + window] -= 1
    gone = np.cumsum(edge[:-1]) > 0
    change = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
    kept = [w for w, g in zip(words, gone) if not g]
    return len(words), len(words) - len(kept), b" ".join(kept), list(zip(change[::2].tolist(), change[1::2].tolist()))


def remove_repeats(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", window: int = 35) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text, removed) of every row of a table scan.

    A word goes if a window of ``window`` consecutive words that covers it has the
    same words as a window that starts anywhere else, in the same text too;
    ``removed`` lists the ranges of words [start, end).  Windows are judged on the
    texts as they came.  Null and empty texts have no words; repeated rows are
    texts of their own and so repeat each other; null ids are kept.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_column).alias("doc_id"),
        F.col(text_column).alias("text"),
    )
    # Both joins of the texts take the same columns, so Spark shuffles the texts once.
    spans = repeated_spans(rows, window)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _groups(batch):
                out = [_kept(t, s, window) for t, s in zip(*(part.column(c).to_pylist() for c in ("text", "spans")))]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([x[0] for x in out], pa.int64()),
                        pa.array([x[1] for x in out], pa.int64()),
                        pa.array([x[2].decode() for x in out], pa.string()),
                        pa.array(
                            [[{"start": a, "end": b} for a, b in x[3]] for x in out],
                            pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])),
                        ),
                    ],
                    names=["doc_id", "n_words", "n_removed", "kept_text", "removed"],
                )

    id_type = docs.schema[id_column].dataType.simpleString()
    return rows.join(spans, "row", "left").mapInArrow(
        keep,
        f"doc_id {id_type}, n_words long, n_removed long, kept_text string, removed array<struct<start:int,end:int>>",
    )
