"""Benchmark decontamination: SimHash of item-sized windows, searched by multi-index Hamming blocks.

A window with as many words as an item is a leak of it if their fingerprints
lie within the radius and their weighted five-word shingles are at least 0.8
alike; of an item longer than the text, the whole text is the window.  Fingerprints within ``RADIUS`` bits of 64 differ in at most
``RADIUS // BLOCKS`` bits in one of ``BLOCKS`` blocks, so a lookup of each block among the
items' blocks and all their neighbours misses none.  Only windows with
enough shingles of the benchmark to reach the similarity at all are
fingerprinted; that drops no leak.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.text import Rolling, mixed, word_hashes

RADIUS, BLOCKS = 20, 8
_BLOCK_BITS = 64 // BLOCKS
#: Windows are fingerprinted in groups of so many, whatever the text's length.
_GROUP = 512
HIT = "array<struct<item_id:bigint,start:int,n_words:int,similarity:double>>"


def _lower(text: str | None) -> str | None:
    return text.lower() if text else text


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; of all words if there are fewer."""
    size = min(size, len(hashes))
    return mixed(Rolling(hashes).windows(size)) if size else np.zeros(0, dtype=np.uint64)


def _fingerprints(rows: np.ndarray) -> np.ndarray:
    """SimHash of each row of shingle hashes, repeats counted."""
    n, m = rows.shape
    bits = np.unpackbits(rows.astype(">u8").view(np.uint8).reshape(n, m, 8), axis=2).reshape(n, m, 64)
    return np.packbits(bits.sum(axis=1, dtype=np.int32) * 2 > m, axis=1).view(">u8").ravel().astype(np.uint64)


def weighted_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Shared shingles over all shingles, each as often as it occurs."""
    va, ca = np.unique(a, return_counts=True)
    vb, cb = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(va, vb, assume_unique=True, return_indices=True)
    shared = int(np.minimum(ca[i], cb[j]).sum())
    return shared / max(1, len(a) + len(b) - shared)


def _neighbours(value: int) -> list[int]:
    """All values of a block within its share of the radius."""
    out = [value]
    for k in range(1, RADIUS // BLOCKS + 1):
        out += [value ^ sum(1 << b for b in flip) for flip in combinations(range(_BLOCK_BITS), k)]
    return out


@dataclass
class _Size:
    """Items of one number of words."""

    n_words: int
    n_shingles: int
    need: int
    ids: list[int]
    shingles: list[np.ndarray]
    prints: np.ndarray
    #: By block and value: which items to look at.
    blocks: np.ndarray


class ItemIndex:
    """The items of one block of the benchmark."""

    def __init__(self, items: list[tuple[int, str]], shingle_words: int = 5, similarity: float = 0.8):
        self.shingle_words, self.similarity = shingle_words, similarity
        by_size: dict[int, list[tuple[int, np.ndarray]]] = {}
        for id_, text in items:
            hashes = word_hashes(_lower(text))
            if len(hashes):
                by_size.setdefault(len(hashes), []).append((id_, shingles(hashes, shingle_words)))
        self.sizes = [self._size(n, of) for n, of in sorted(by_size.items())]
        known: dict[int, list[np.ndarray]] = {}
        for size in self.sizes:
            known.setdefault(min(shingle_words, size.n_words), []).extend(size.shingles)
        #: By shingle length: the benchmark's shingles, and a table that rules most others out at once.
        self.known = {}
        for length, parts in known.items():
            values = np.unique(np.concatenate(parts))
            table = np.zeros(1 << 20, dtype=bool)
            table[values >> np.uint64(44)] = True
            self.known[length] = values, table

    def _size(self, n_words: int, items: list[tuple[int, np.ndarray]]) -> _Size:
        rows = np.stack([s for _, s in items])
        prints, m = _fingerprints(rows), rows.shape[1]
        # Of two rows of m shingles, so many are shared at least at the similarity.
        need = max(1, ceil(2 * m * self.similarity / (1 + self.similarity) - 1e-9))
        blocks = np.zeros((BLOCKS, 1 << _BLOCK_BITS, len(items)), dtype=bool)
        for i, p in enumerate(prints.tolist()):
            for b in range(BLOCKS):
                blocks[b, _neighbours(p >> (b * _BLOCK_BITS) & ((1 << _BLOCK_BITS) - 1)), i] = True
        return _Size(n_words, m, need, [i for i, _ in items], [s for _, s in items], prints, blocks)

    def hits(self, text: str | None) -> list[dict]:
        """The most similar window of every item that leaks into a text; the first of equal ones."""
        hashes = word_hashes(_lower(text))
        best: dict[int, tuple[float, int, int]] = {}
        seen: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in self.sizes:
            length = min(self.shingle_words, size.n_words)
            # Of a longer item's window, the whole text, so many shingles are missing at least.
            whole = len(hashes) < size.n_words
            n_shingles = len(hashes) - length + 1 if whole else size.n_shingles
            if n_shingles < max(1, self.similarity * size.n_shingles - 1e-9):
                break
            if length not in seen:
                own = shingles(hashes, length)
                values, table = self.known[length]
                maybe = np.flatnonzero(table[own >> np.uint64(44)])
                found = values[np.minimum(np.searchsorted(values, own[maybe]), len(values) - 1)] == own[maybe]
                seen[length] = own, maybe[found]
            own, known = seen[length]
            if whole:
                need = self.similarity * (n_shingles + size.n_shingles) / (1 + self.similarity)
                if len(known) >= need - 1e-9:
                    self._search(size, own[None], np.zeros(1, dtype=np.int64), len(hashes), best)
                continue
            if len(known) < size.need:
                continue
            # A window with enough known shingles starts at or before the first of ``need`` consecutive ones.
            first, last = known[: len(known) - size.need + 1], known[size.need - 1 :]
            near = first[last - first < size.n_shingles], last[last - first < size.n_shingles]
            if not len(near[0]):
                continue
            low = np.maximum(near[1] - size.n_shingles + 1, 0)
            high = np.minimum(near[0], len(hashes) - size.n_words)
            edge = np.zeros(len(hashes) + 2, dtype=np.int32)
            np.add.at(edge, low, 1)
            np.add.at(edge, np.maximum(high + 1, low), -1)
            starts = np.flatnonzero(np.cumsum(edge) > 0)
            for at in range(0, len(starts), _GROUP):
                group = starts[at : at + _GROUP]
                self._search(size, own[group[:, None] + np.arange(size.n_shingles)], group, size.n_words, best)
        return [
            {"item_id": i, "start": s, "n_words": n, "similarity": like} for i, (like, s, n) in sorted(best.items())
        ]

    def _search(self, size: _Size, rows: np.ndarray, starts: np.ndarray, n_words: int, best: dict) -> None:
        prints = _fingerprints(rows)
        candidates = np.zeros((len(starts), len(size.ids)), dtype=bool)
        for b in range(BLOCKS):
            values = (prints >> np.uint64(b * _BLOCK_BITS)) & np.uint64((1 << _BLOCK_BITS) - 1)
            candidates |= size.blocks[b, values.astype(np.int64)]
        for w, i in zip(*np.nonzero(candidates)):
            if int(prints[w] ^ size.prints[i]).bit_count() > RADIUS:
                continue
            like, id_, start = weighted_jaccard(rows[w], size.shingles[i]), size.ids[i], int(starts[w])
            if like >= self.similarity and (id_ not in best or (like, -start) > (best[id_][0], -best[id_][1])):
                best[id_] = like, start, n_words


def item_blocks(
    benchmark: DataFrame, *, id_column: str = "item_id", text_column: str = "text",
    items_per_block: int = 20_000, bytes_per_block: int = 16 << 20, **options,
) -> Iterator[ItemIndex]:
    """Indexes of bounded size that cover the benchmark, one after the other.

    The benchmark is the query set: its size decides the number of blocks, not what one holds.
    """
    total = benchmark.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length(text_column)), F.lit(0)).alias("b")).first()
    n = max(1, -(-total.n // items_per_block), -(-total.b // bytes_per_block))
    block = F.pmod(F.xxhash64(F.col(id_column), F.col(text_column)), F.lit(n))
    for k in range(n):
        rows = benchmark.where(block == k).select(F.col(id_column).cast("long").alias("i"), F.col(text_column).alias("t"))
        yield ItemIndex([(-1 if r.i is None else r.i, r.t) for r in rows.collect()], **options)


def leaks(text: Column | str, index: ItemIndex) -> Column:
    """Leaks of a block's items in a text column; null and empty texts have none."""
    shared = SparkSession.active().sparkContext.broadcast(index)

    @F.pandas_udf(HIT)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([shared.value.hits(t) for t in texts])

    return run(text)


def find_leaks(docs: DataFrame, benchmark: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """(doc_id, item_id, start, n_words, similarity): an item's most similar window in a text, for every leak.

    Words are compared in lower case.  A text with fewer words than an item is compared with it as a whole.  Items without words leak nowhere; repeated
    documents and items are judged each for itself; a null item id counts as -1.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    found = None
    for index in item_blocks(benchmark, **options):
        part = rows.select("doc_id", leaks(F.col("text"), index).alias("hits")).select("doc_id", F.inline("hits"))
        found = part if found is None else found.unionByName(part)
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame, *, text_column: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` in which no item leaks."""
    for index in item_blocks(benchmark, **options):
        docs = docs.where(F.size(leaks(F.col(text_column), index)) == 0)
    return docs
