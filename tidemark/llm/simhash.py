"""SimHash near-duplicates: fingerprints, and their links by BK-trees over shards.

Two fingerprints within ``radius`` differ in at most ``radius`` of ``radius + 2``
blocks, so they agree on two blocks at least.  Every distinct fingerprint goes
to one shard per pair of blocks, and each shard is searched by a BK-tree.  A
shard with more than ``shard_limit`` fingerprints is dealt anew by two blocks of
its free bits, which loses no link and bounds a shard by the bits left free.
Trees stay where their shard is: their number grows with the corpus, so they
are not broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.graph import components
from tidemark.session import ensure_checkpoint_dir

_BITS = 64
_ALL = (1 << _BITS) - 1
#: Set bits of a byte, most significant first, as rows of a table.
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of 64-bit hashes; none gives zero."""
    n = len(hashes)
    if not n:
        return 0
    by_byte = hashes.astype(">u8").view(np.uint8).reshape(n, 8)
    if n < 256:
        counts = np.unpackbits(by_byte, axis=1).sum(axis=0, dtype=np.int64)
    else:
        counts = np.concatenate([np.bincount(by_byte[:, i], minlength=256) @ _BYTE_BITS for i in range(8)])
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def shingle_hashes(text: str | None, size: int, seed: int) -> np.ndarray:
    """XXH64 of every run of ``size`` words, repeats included; of all words if fewer."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    runs = zip(*(words[i:] for i in range(size))) if len(words) >= size else [words]
    n = max(1, len(words) - size + 1)
    return np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, runs), repeat(seed)), np.uint64, n)


def simhash64(text: Column | str, shingle_words: int = 3, seed: int = 42) -> Column:
    """Fingerprint of a text column as a long (its 64 bits); null and empty texts give zero."""

    @F.pandas_udf("long")
    def fingerprint(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([_signed(majority(shingle_hashes(t, shingle_words, seed))) for t in texts], dtype="int64")

    return fingerprint(text)


class BKTree:
    """Children of a node are keyed by their Hamming distance to it."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> int:
        """Insert a value unless it is there; its node's number."""
        if self.values:
            at = 0
            while d := (self.values[at] ^ value).bit_count():
                below = self.children[at].get(d)
                if below is None:
                    self.children[at][d] = len(self.values)
                    break
                at = below
            else:
                return at
        self.values.append(value)
        self.children.append({})
        return len(self.values) - 1

    def within(self, value: int, radius: int) -> list[int]:
        """Nodes at most ``radius`` away; only edges within the radius of the parent's distance are followed."""
        found, stack = [], [0] if self.values else []
        while stack:
            at = stack.pop()
            d = (self.values[at] ^ value).bit_count()
            if d <= radius:
                found.append(at)
            for edge, below in self.children[at].items():
                if d - radius <= edge <= d + radius:
                    stack.append(below)
        return found


def shard_links(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that connect a shard's values exactly as all pairs within the radius would.

    A value is searched in the tree of those before it and joined to each
    component it meets, so there are fewer links than values.
    """
    tree, parent, links = BKTree(), [], []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for value in values:
        near = tree.within(value, radius)
        node = tree.add(value)
        if node < len(parent):
            continue
        parent.append(node)
        for other in near:
            a, b = root(other), root(node)
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((tree.values[other], value))
    return links


def _block_masks(bits: list[int], radius: int) -> list[int]:
    """Masks of every two of ``radius + 2`` blocks of the given bit positions."""
    blocks = [sum(1 << int(b) for b in part) for part in np.array_split(bits, radius + 2)]
    return [a | b for a, b in combinations(blocks, 2)]


def fingerprint_links(prints: DataFrame, radius: int = 2, shard_limit: int = 4096) -> DataFrame:
    """Links (u, v) among the distinct values of ``prints(fingerprint)``.

    Their components are those of all pairs within ``radius``; not all pairs are listed.
    """
    masks = _block_masks(list(range(_BITS)), radius)
    finer = [_block_masks([b for b in range(_BITS) if not m >> b & 1], radius) for m in masks]
    value = F.col("fingerprint")
    shards = (
        prints.select("fingerprint")
        .distinct()
        .select(
            value,
            F.posexplode(F.array(*[value.bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("shard", "bits"),
        )
    )
    sizes = shards.groupBy("shard", "bits").agg(F.count("*").alias("n")).where("n > 1")
    shards = shards.join(sizes, ["shard", "bits"])
    table = F.array(*[F.array(*[F.lit(_signed(m | s)) for s in sub]) for m, sub in zip(masks, finer)])
    dealt_anew = (
        shards.where(F.col("n") > shard_limit)
        .select(value, "shard", F.posexplode(table[F.col("shard")]).alias("sub", "mask"))
        .select(
            value,
            (F.lit(len(masks)) + F.col("shard") * len(masks) + F.col("sub")).alias("shard"),
            value.bitwiseAND(F.col("mask")).alias("bits"),
        )
    )
    shards = shards.where(F.col("n") <= shard_limit).select(value, "shard", "bits").unionByName(dealt_anew)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members = None, []

        def links() -> pa.RecordBatch:
            found = shard_links([m & _ALL for m in members], radius) if len(members) > 1 else []
            u, v = ([_signed(x[i]) for x in found] for i in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

        out = []
        for batch in batches:
            for shard, bits, print_ in zip(*(batch.column(c).to_pylist() for c in ("shard", "bits", "fingerprint"))):
                if (shard, bits) != key:
                    if members:
                        out.append(links())
                    key, members = (shard, bits), []
                members.append(print_)
            if out:
                yield from pa.Table.from_batches(out).combine_chunks().to_batches()
                out = []
        if members:
            yield links()

    dealt = shards.repartition("shard", "bits").sortWithinPartitions("shard", "bits", "fingerprint")
    return dealt.mapInArrow(search, "u long, v long")


def near_duplicates(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", shingle_words: int = 3,
    seed: int = 42, radius: int = 2, shard_limit: int = 4096,
) -> DataFrame:
    """(id, fingerprint, component_id) of every row; component_id is the smallest id linked with it.

    Fingerprints within ``radius`` bits are linked.  Null and empty texts have
    fingerprint zero, linked like any other; repeated rows link; a null id is
    kept and never is the smallest, unless all ids of its group are null.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    prints = docs.select(
        F.col(id_column).alias("doc_id"), simhash64(F.col(text_column), shingle_words, seed).alias("fingerprint")
    ).checkpoint()
    roots = components(fingerprint_links(prints, radius, shard_limit))
    first = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"))
    rooted = first.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn(
        "root", F.coalesce("root", "fingerprint")
    )
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_print = rooted.select("fingerprint", "root").join(smallest, "root").select("fingerprint", "component_id")
    return prints.join(by_print, "fingerprint").select("doc_id", "fingerprint", "component_id")
