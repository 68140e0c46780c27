"""Near copies by SimHash and BK-trees, where similarity and not the fingerprint decides.

Texts whose word shingles are 0.8 alike differ in up to about 20 of 64
fingerprint bits, too many for shards of equal blocks.  Here a text's shards are
bands of shingle minima, which texts that alike share almost surely (a pair at 0.8 has no
band in common once in 30,000); a shard's tree finds the fingerprints within the
radius, and each link is verified on the shingles of both texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh3_128_digest

from tidemark.llm.decontamination import shingles
from tidemark.llm.graph import components
from tidemark.llm.simhash import BKTree, _signed, majority
from tidemark.llm.text import fresh_name, mixed, word_hashes, words_of
from tidemark.session import ensure_checkpoint_dir

BANDS, ROWS = 20, 4
_ALL = (1 << 64) - 1
_MULTIPLY = np.array([mixed(np.array([i + 1], dtype=np.uint64))[0] | np.uint64(1) for i in range(BANDS * ROWS)])


def _lower(text: str | None) -> str | None:
    return text.lower() if text else None


def _lowered(text: str | None) -> np.ndarray:
    return word_hashes(_lower(text))


def _described(size: int):
    """(row, content, fingerprint, bands) of texts; content is a hash of all words in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            content, prints, bands = [], [], []
            for text in batch.column("text"):
                words = _lowered(text.as_py())
                content.append(np.frombuffer(xxh3_128_digest(b" ".join(words_of(_lower(text.as_py())))), dtype=np.int64).tolist())
                # A repeated line counts once, as it does in the similarity and the bands.
                own = np.unique(shingles(words, size))
                prints.append(_signed(majority(own)))
                if not len(own):
                    bands.append([])
                    continue
                # High bits of a product are its even ones.
                least = np.array([(own * m).min() for m in _MULTIPLY])
                folded = mixed(least.reshape(BANDS, ROWS) * _MULTIPLY[:ROWS]).sum(axis=1, dtype=np.uint64)
                bands.append(folded.view(np.int64).tolist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array([c[0] for c in content], pa.int64()),
                    pa.array([c[1] for c in content], pa.int64()),
                    pa.array(prints, pa.int64()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                names=["row", "content1", "content2", "fingerprint", "bands"],
            )

    return run, "row long, content1 long, content2 long, fingerprint long, bands array<long>"


def _alike(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether two sets of shingles, sorted, are so alike."""
    if min(len(a), len(b)) < similarity * max(len(a), len(b)):
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared >= similarity * (len(a) + len(b) - shared)


def _tree_links(
    rows: list[tuple[int, int, int, int]], radius: int, alike: Callable[[int, int], bool]
) -> list[tuple[int, int]]:
    """Links that connect the (row, fingerprint, root, side) of a block as all pairs within the radius that are ``alike``.

    Rows of one root are connected already.  Sides 1 and 2 are compared with each other,
    side 0 with itself.  A row meets every row before it, until a link that holds joins their groups.
    """
    parent = {r[2]: r[2] for r in rows}

    def root(i: int) -> int:
        at = rows[i][2]
        while parent[at] != at:
            parent[at] = parent[parent[at]]
            at = parent[at]
        return at

    # The text most others were made from is met first: it joins them by one check each.
    middle = majority(np.array([r[1] & _ALL for r in rows], dtype=np.uint64))
    order = sorted(range(len(rows)), key=lambda i: (rows[i][3], ((rows[i][1] & _ALL) ^ middle).bit_count(), rows[i][0]))
    tree, members, links = BKTree(), [], []
    for rank, i in enumerate(order):
        row, print_, _, side = rows[i]
        if side != 1:
            for j in sorted(j for at in tree.within(print_ & _ALL, radius) for j in members[at]):
                a, b = root(order[j]), root(i)
                if a != b and alike(order[j], i):
                    parent[max(a, b)] = min(a, b)
                    links.append((rows[order[j]][0], row))
        if side != 2:
            at = tree.add(print_ & _ALL)
            if at == len(members):
                members.append([])
            members[at].append(rank)
    return links


_BLOCK = ("band", "bits", "kind", "i", "j")


def _search(radius: int, size: int, similarity: float):
    """Links (u, v) in the rows of one block after another; without texts, all pairs within the radius are alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, texts = None, [], []

        def result() -> pa.RecordBatch:
            sets: dict[int, np.ndarray] = {}

            def own(i: int) -> np.ndarray:
                if i not in sets:
                    sets[i] = np.unique(shingles(_lowered(texts[i]), size))
                return sets[i]

            found = _tree_links(held, radius, lambda i, j: texts[i] is None or _alike(own(i), own(j), similarity))
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["u", "v"])

        out = []
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in (*_BLOCK, "row", "fingerprint", "root", "side", "text"))
            for *block, row, print_, root, side, text in zip(*columns):
                if block != key:
                    if held:
                        out.append(result())
                    key, held, texts = block, [], []
                held.append((row, print_, root, side))
                texts.append(text)
            if out:
                yield from pa.Table.from_batches(out).combine_chunks().to_batches()
                out = []
        if held:
            yield result()

    return run, "u long, v long"


def _open_blocks(hot: DataFrame, links: DataFrame, chunk_rows: int) -> DataFrame:
    """Blocks of hot shards that together hold every pair not connected by ``links`` yet.

    A shard's rows outside its largest group are open: their chunks meet each other and
    the chunks of that group, whose own rows need not meet again.
    """
    rooted = (
        hot.join(components(links).withColumnRenamed("node", "row"), "row", "left")
        .withColumn("root", F.coalesce("root", "row"))
        .checkpoint()
    )
    sizes = (
        rooted.groupBy("band", "bits", "root").agg(F.count("*").alias("n"))
        .groupBy("band", "bits").agg(F.max(F.struct("n", "root")).alias("main"), F.sum("n").alias("n"))
        .where(F.col("n") > F.col("main.n"))
        .select(
            "band", "bits", F.col("main.root").alias("main"),
            F.ceil((F.col("n") - F.col("main.n")) / chunk_rows).cast("int").alias("n_open"),
            F.ceil(F.col("main.n") / chunk_rows).cast("int").alias("n_main"),
        )
    )
    own = F.col("own")

    def block(kind: int, i, j, side):
        return F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), side.alias("side"))

    def among(k):
        side = F.when(k == own, 0).when(own < k, 1).otherwise(2)
        return block(0, F.least(own, k), F.greatest(own, k), side)

    blocks_open = F.concat(
        F.transform(F.sequence(F.lit(0), F.col("n_open") - 1), among),
        F.transform(F.sequence(F.lit(0), F.col("n_main") - 1), lambda k: block(1, own, k, F.lit(1))),
    )
    blocks_main = F.transform(F.sequence(F.lit(0), F.col("n_open") - 1), lambda k: block(1, k, own, F.lit(2)))
    is_main = F.col("root") == F.col("main")
    chunks = F.when(is_main, F.col("n_main")).otherwise(F.col("n_open"))
    return (
        rooted.join(sizes, ["band", "bits"])
        .withColumn("own", F.pmod(F.xxhash64("row"), chunks.cast("long")).cast("int"))
        .select("band", "bits", "row", "fingerprint", "root", F.explode(F.when(is_main, blocks_main).otherwise(blocks_open)).alias("b"))
        .select("band", "bits", "row", "fingerprint", "root", "b.*")
    )


def candidate_links(
    prints: DataFrame, radius: int, chunk_rows: int = 1000, *, texts: DataFrame | None = None,
    shingle_words: int = 5, similarity: float = 0.8,
) -> DataFrame:
    """Links (u, v) that connect ``prints(row, fingerprint, bands)`` as all pairs within the radius in some shard.

    With ``texts(row, text)`` only pairs count whose sets of shingles are ``similarity`` alike or more.
    A shard of over ``chunk_rows`` rows is searched in chunks first; then all its pairs which the
    links found do not connect are, in blocks of two chunks.
    """
    rows = prints.select("row", "fingerprint", F.posexplode("bands").alias("band", "bits"))
    # Bands with the same rows are one shard.
    same = (F.count("*").alias("n"), F.bit_xor(F.xxhash64("row")).alias("x"), F.bit_xor(F.xxhash64("row", F.lit(1))).alias("y"))
    shards = (
        rows.groupBy("band", "bits").agg(*same).where("n > 1").groupBy("n", "x", "y")
        .agg(F.min(F.struct("band", "bits")).alias("shard")).select("shard.band", "shard.bits", "n")
    )
    placed = rows.join(shards, ["band", "bits"]).checkpoint()
    run, schema = _search(radius, shingle_words, similarity)

    def searched(blocks: DataFrame) -> DataFrame:
        blocks = blocks.withColumn("text", F.lit(None).cast("string")) if texts is None else blocks.join(texts, "row")
        dealt = blocks.select(*_BLOCK, "row", "fingerprint", "root", "side", "text").repartition(*_BLOCK)
        return dealt.sortWithinPartitions(*_BLOCK, "row").mapInArrow(run, schema).distinct().checkpoint()

    chunk = F.pmod(F.xxhash64("row", "band"), F.ceil(F.col("n") / chunk_rows)).cast("int")
    none = F.lit(0)
    found = searched(
        placed.select("band", "bits", "row", "fingerprint", F.col("row").alias("root"),
                      none.alias("kind"), chunk.alias("i"), none.alias("j"), none.alias("side"))
    )
    hot = placed.where(F.col("n") > chunk_rows).select("band", "bits", "row", "fingerprint")
    if hot.isEmpty():
        return found
    return found.union(searched(_open_blocks(hot, found, chunk_rows)))


def without_near_copies(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", shingle_words: int = 5,
    similarity: float = 0.8, radius: int = 20,
) -> DataFrame:
    """The rows of a table scan without near copies: of every group the row with the smallest id stays.

    Texts are linked if the sets of their lower-case word shingles are ``similarity`` alike or more;
    groups are what links connect.  Texts of the same words are copies whatever
    their length; null and empty ones are copies of each other.  Of equal ids the first row in the
    table stays, null ids stay last.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    key = fresh_name(docs, "_row")
    keyed = docs.select("*", F.monotonically_increasing_id().alias(key))
    texts = keyed.select(F.col(key).alias("row"), F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    run, schema = _described(shingle_words)
    described = texts.select("row", "text").mapInArrow(run, schema).checkpoint()
    ids = texts.select("row", F.struct(F.col("id").isNull().alias("last"), "id", "row").alias("place"))
    copies = (
        described.select("row", "content1", "content2")
        .join(ids, "row")
        .groupBy("content1", "content2")
        .agg(F.min("place").alias("place"))
        .select(F.col("place.row").alias("row"))
        .checkpoint()
    )
    firsts = described.join(copies, "row", "left_semi")
    links = candidate_links(
        firsts.select("row", "fingerprint", "bands"), radius, texts=texts.select("row", "text"),
        shingle_words=shingle_words, similarity=similarity,
    )
    groups = components(links)
    placed = groups.withColumnRenamed("node", "row").join(ids, "row")
    stays = placed.groupBy("root").agg(F.min("place").alias("place")).select(F.col("place.row").alias("row"))
    gone = groups.select(F.col("node").alias("row")).join(stays, "row", "left_anti")
    kept = copies.join(gone, "row", "left_anti")
    return keyed.join(kept.withColumnRenamed("row", key), key, "left_semi").drop(key)
