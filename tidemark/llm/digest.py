"""Document fingerprints: digests of improbable byte windows in chained Bloom filters.

Every window of 64 bytes has the entropy of its byte counts.  How rare an
entropy is among all windows of the corpus ranks the window; a window that is
the rarest of enough runs of 64 neighbours is a feature.  Features go five bits
each into a chain of small Bloom filters, and two chains are compared by the
bits their filters share beyond what chance would give.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.text import sliding

WINDOW = 64
#: Runs of so many neighbouring windows elect their rarest one.
_RUN = 64
#: Runs a window must win.
_POPULAR = 16
_LEVELS = 512
_BITS, _FEATURES, _HASHES = 2048, 160, 5
#: The 11 bits of a feature's hash that each of its places takes.
_PLACES = np.arange(0, 11 * _HASHES, 11, dtype=np.uint64)
#: Texts with fewer bytes have too few windows to elect from: all their short windows are features.
_SHORT, _SHORT_WINDOW = 4 * WINDOW, 8
#: c * log2(c) in fixed point, so sums of any order are equal.
_TERM = np.array([0] + [round(c * np.log2(c) * (1 << 20)) for c in range(1, WINDOW + 1)], dtype=np.int64)


def entropy_levels(data: np.ndarray) -> np.ndarray:
    """Entropy of the byte counts of every window, in ``_LEVELS`` steps from 0 (one byte) up."""
    n = len(data)
    if n < WINDOW:
        return np.zeros(0, dtype=np.int16)
    # Positions of equal bytes side by side; two runs in order are merged to see how many lie in reach.
    kind = np.int32 if n < 1 << 22 else np.int64
    order = np.argsort(data, kind="stable")
    keys = data[order].astype(kind) * kind(n + WINDOW) + order.astype(kind)
    merged = np.argsort(np.concatenate([keys - kind(WINDOW - 1), keys]), kind="stable")
    at = np.arange(n)
    low = np.flatnonzero(merged < n) - at
    high = np.cumsum(np.bincount(low, minlength=n)) - 1
    came, left = np.empty(n, dtype=np.uint8), np.empty(n, dtype=np.uint8)
    came[order], left[order] = at - low, high - at
    gain = _TERM[1:] - _TERM[:-1]
    # A byte that comes in finds ``came`` equals among the 63 before it; one that goes leaves ``left``.
    total = np.cumsum(gain[came])
    total[WINDOW:] -= np.cumsum(gain[left[: n - WINDOW]])
    sums = total[WINDOW - 1 :]
    return (_LEVELS - 1 - sums * (_LEVELS - 1) // _TERM[WINDOW]).astype(np.int16)


def level_counts(docs: DataFrame, text_column: str = "text") -> np.ndarray:
    """Windows of each entropy level: all windows of all texts.

    One row of counts per task reaches the shuffle.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_LEVELS, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0):
                raw = (text.as_py() or "").encode()
                total += np.bincount(entropy_levels(np.frombuffer(raw, dtype=np.uint8)), minlength=_LEVELS)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen])], names=["level", "n"])

    rows = docs.select(F.col(text_column)).mapInArrow(count, "level int, n long").groupBy("level").agg(F.sum("n").alias("n"))
    counts = np.zeros(_LEVELS, dtype=np.int64)
    for row in rows.collect():  # at most one row per level
        counts[row.level] = row.n
    return counts


def level_ranks(counts: np.ndarray) -> np.ndarray:
    """Rank of each entropy level: the rarer its windows, the lower; ties by the level."""
    ranks = np.empty(len(counts), dtype=np.int64)
    ranks[np.lexsort((np.arange(len(counts)), counts))] = np.arange(len(counts))
    return ranks


def _winners(ranks: np.ndarray) -> np.ndarray:
    """Windows elected often enough in one text; the most elected if none is."""
    n = len(ranks)
    kind, shift = (np.int32, 22) if n < 1 << 22 else (np.int64, 40)
    keys = (ranks.astype(kind) << shift) | np.arange(n, dtype=kind)
    best = sliding(keys, min(_RUN, n), np.minimum) & kind((1 << shift) - 1)
    edges = np.flatnonzero(np.concatenate([[True], best[1:] != best[:-1]]))
    votes = np.diff(np.append(edges, len(best)))
    chosen = best[edges[votes >= _POPULAR]]
    return chosen if len(chosen) else best[edges[[np.argmax(votes)]]]


class Text:
    """A text's bytes and the levels of its windows."""

    def __init__(self, text: str, like: Text | None = None, same_chars: int = 0):
        """``like`` is a text that starts with the same ``same_chars`` code points."""
        self.text, self.raw = text, text.encode()
        data = np.frombuffer(self.raw, dtype=np.uint8)
        known = len(text[:same_chars].encode()) - WINDOW + 1 if like else 0
        if known > 0:
            self.levels = np.concatenate([like.levels[:known], entropy_levels(data[known:])])
        else:
            self.levels = entropy_levels(data)


def digest(text: Text, ranks: np.ndarray) -> np.ndarray:
    """Chained Bloom filters of a text, one row of bits each; the empty text has none."""
    raw = text.raw
    if not raw:
        return np.zeros((0, _BITS // 8), dtype=np.uint8)
    if len(raw) < _SHORT:
        features = dict.fromkeys(raw[i : i + _SHORT_WINDOW] for i in range(max(1, len(raw) - _SHORT_WINDOW + 1)))
    else:
        features = dict.fromkeys(raw[i : i + WINDOW] for i in _winners(ranks[text.levels]).tolist())
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, features), dtype=np.uint64, count=len(features))
    bits = np.zeros((-(-len(hashes) // _FEATURES), _BITS), dtype=np.uint8)
    places = ((hashes[:, None] >> _PLACES) & np.uint64(_BITS - 1)).astype(np.int64)
    bits.ravel()[places + (np.arange(len(hashes)) // _FEATURES * _BITS)[:, None]] = 1
    return np.packbits(bits, axis=1)


def _ones(filters: np.ndarray) -> np.ndarray:
    return np.bitwise_count(filters).sum(axis=1, dtype=np.int64)


def _likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Best match in the other chain of the shorter one's filters, weighed by their set bits, 0 to 1.

    Shared bits count from what two filters of as many set bits may share by chance, two
    deviations above its mean (0), to all bits of the emptier one (1).  Two empty digests are alike.
    """
    if not len(a) or not len(b):
        return 1.0 if len(a) == len(b) else 0.0
    if a.shape == b.shape and (a == b).all():
        return 1.0
    set_a, set_b = _ones(a), _ones(b)
    if (len(a), set_a.sum(), a.tobytes()) > (len(b), set_b.sum(), b.tobytes()):
        a, b, set_a, set_b = b, a, set_b, set_a
    best = []
    for filter_, ones in zip(a, set_a):
        shared = _ones(filter_ & b)
        chance = ones * set_b / _BITS
        most = np.minimum(ones, set_b)
        chance = chance + 2 * np.sqrt(chance)
        best.append(np.where(most > chance, (shared - chance) / np.maximum(most - chance, 1e-9), 0.0).max())
    return min(1.0, max(0.0, float((set_a * np.array(best)).sum() / set_a.sum())))


def spelled(filters: np.ndarray) -> str:
    """A digest as text: the number of filters and their bits in base 64."""
    return f"{len(filters)}:{base64.b64encode(filters.tobytes()).decode()}"


def read_digest(text: str) -> np.ndarray:
    n, bits = text.split(":")
    return np.frombuffer(base64.b64decode(bits), dtype=np.uint8).reshape(int(n), _BITS // 8)


def compare_digests(a: str, b: str) -> float:
    """Likeness of two spelled digests, 0 to 1; the order of the two doesn't matter."""
    return _likeness(read_digest(a), read_digest(b))


def fingerprints(docs: DataFrame, *, text_column: str = "text", out: str = "fingerprint", ranks: np.ndarray | None = None) -> DataFrame:
    """``docs`` with the digest of every text; null and empty texts have the digest of nothing."""
    ranks = level_ranks(level_counts(docs, text_column)) if ranks is None else ranks

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([spelled(digest(Text(t or ""), ranks)) for t in texts], dtype=object)

    return docs.withColumn(out, run(F.col(text_column)))


def in_turn(docs: DataFrame, id_column: str, per_bucket: int) -> DataFrame:
    """``docs`` in buckets of consecutive ids, each followed by the first row of the next one.

    Adds ``_bucket``, ``_row`` (its order among equal ids) and ``_tail``.  The
    driver holds one key per bucket.
    """
    keys = docs.select(F.col(id_column).alias("id"), F.col("_row"))
    n = keys.count()
    buckets = max(1, -(-n // per_bucket))
    heads = (
        keys.repartitionByRange(buckets, F.col("id").asc_nulls_last(), "_row")
        .groupBy(F.spark_partition_id().alias("part"))
        .agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "_row")).alias("head"))
        .collect()
    )
    starts = sorted((h["head"]["last"], h["head"]["id"] or 0, h["head"]["_row"]) for h in heads)
    edges = docs.sparkSession.sparkContext.broadcast(starts)

    @F.pandas_udf("array<int>")
    def place(id_: pd.Series, row: pd.Series) -> pd.Series:
        known, out = edges.value, []
        for i, r in zip(id_, row):
            key = (True, 0, r) if pd.isna(i) else (False, int(i), r)
            at = bisect_right(known, key) - 1
            out.append([at, (at - 1) % len(known)] if known[at] == key else [at])
        return pd.Series(out)

    return docs.select("*", F.posexplode(place(F.col(id_column), F.col("_row"))).alias("_tail", "_bucket"))


def edited_likeness(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", ranks: np.ndarray | None = None,
    rows_per_bucket: int = 4000,
) -> DataFrame:
    """Digests of every text and of its edited text, and their likeness.

    The edited text has its last quarter of code points replaced by as many of
    the next text's first; the next text is that of the next larger id, and the
    first one after the last.  Equal ids follow each other in table order, null
    ids come last; a null text is empty; a table of one row is followed by itself.
    ``docs`` is a table scan with a long id.
    """
    ranks = level_ranks(level_counts(docs, text_column)) if ranks is None else ranks
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("_row"),
    )
    placed = in_turn(rows, "doc_id", rows_per_bucket)
    last = F.col("doc_id").isNull()
    ordered = placed.repartition("_bucket").sortWithinPartitions("_bucket", "_tail", last, "doc_id", "_row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bucket = None, None  # the row whose next one is awaited
        out: list[tuple] = []

        def finish(row: tuple[int, Text, np.ndarray], following: Text, next_print: np.ndarray) -> None:
            id_, text, own = row
            n = len(text.text)
            kept = n - n // 4
            edited = Text(text.text[:kept] + following.text[: n - kept], text, kept)
            changed = digest(edited, ranks)
            out.append((
                id_, n, hashlib.sha256(edited.raw).hexdigest(), spelled(own), spelled(changed),
                _likeness(own, changed), _likeness(own, next_print),
            ))

        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

        def emitted() -> pa.RecordBatch:
            columns = [pa.array(list(c), k) for c, k in zip(zip(*out), kinds)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            columns = (batch.column(c) for c in ("doc_id", "text", "_tail", "_bucket"))
            for id_, text, tail, at in zip(*columns):
                text, at = Text(text.as_py()), at.as_py()
                own = digest(text, ranks)
                if held is not None and bucket == at:
                    finish(held, text, own)
                held = None if tail.as_py() else (id_.as_py(), text, own)
                bucket = at
                if len(out) >= 500:
                    yield emitted()
        if out:
            yield emitted()

    return ordered.mapInArrow(
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
