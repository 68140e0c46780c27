"""Merkle manifest of a dataset: one tree per source, one tree over the sources' roots.

A node's hash is the sha256 of its children's hex digests, one after the other.  Every
aligned block of 256 nodes of a source keeps its level as one string of 64-digit
substrings: the parents are hashes of fixed-width substrings of it, the siblings of a
node are the substrings on both sides of its own inside its run of 16.  The blocks'
roots are the nodes of the next blocks, until each source has one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.ranks import ranked, stored

FAN = 16
BLOCK = FAN * FAN
_HEX = 64
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_STEPS = "array<struct<left:string,right:string>>"


def _field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    return F.sha2(F.concat(*map(_field, values)), 256)


def tampered_text(identifier: Column, text: Column) -> tuple[Column, Column]:
    """(whether a row is tampered with, its text then): every fifth row by crc32 of its id has its A-Z lower-cased."""
    hit = F.crc32(identifier.cast("string").cast("binary")) % 5 == 0
    return F.coalesce(hit, F.lit(False)), F.translate(text, _UPPER, _LOWER)


def _pieces(level: Column, size: int) -> Column:
    """A level cut into its nodes or runs; an empty one has none."""
    n = F.ceil(F.length(level) / size).cast("int")
    whole = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(level, i * size + 1, F.lit(size)))
    return F.when(n > 0, whole).otherwise(F.array().cast("array<string>"))


def _parents(level: Column) -> Column:
    """The level above: each run of 16 digests is hashed."""
    return F.array_join(F.transform(_pieces(level, FAN * _HEX), lambda run: F.sha2(run, 256)), "")


def _step(runs: Column, place: Column) -> Column:
    """Siblings of one node inside its run: the substrings on both sides of its own."""
    run = F.get(runs, F.floor(place / FAN).cast("int"))
    at = (place % FAN).cast("int") * _HEX
    return F.struct(
        F.substring(run, F.lit(1), at).alias("left"),
        F.substring(run, at + _HEX + 1, F.lit(FAN * _HEX)).alias("right"),
    )


def _blocks(nodes: DataFrame) -> DataFrame:
    """One row per aligned block of ``nodes(group, rank, group_rows, hash, ...)``.

    ``level0`` and ``level1`` are the block's levels as strings, ``height`` tells how many
    of them its group still has to climb, ``root`` is the block's node in the next round.
    A block has 256 nodes at most, whatever the size of its group.
    """
    member = F.struct("rank", *[c for c in nodes.columns if c not in ("group", "rank", "group_rows")])
    blocks = nodes.groupBy("group", F.floor(F.col("rank") / BLOCK).alias("block")).agg(
        F.max("group_rows").alias("group_rows"), F.sort_array(F.collect_list(member)).alias("members")
    )
    joined = blocks.withColumn("level0", F.array_join(F.transform("members", lambda m: m["hash"]), ""))
    height = F.when(F.col("group_rows") <= 1, 0).when(F.col("group_rows") <= FAN, 1).otherwise(2)
    climbed = joined.withColumns({"height": height, "level1": _parents(F.col("level0"))})
    root = F.when(F.col("height") == 0, F.col("level0")).when(F.col("height") == 1, F.col("level1"))
    return climbed.withColumn("root", root.otherwise(F.sha2("level1", 256)))


def _members(blocks: DataFrame, *kept: str) -> DataFrame:
    """One row per member: ``kept`` columns, the member as ``m``, its ``steps`` inside the block."""
    cut = {f"runs{k}": _pieces(F.col(f"level{k}"), FAN * _HEX) for k in (0, 1)}
    each = blocks.withColumns(cut).select(*kept, "height", *cut, F.posexplode("members").alias("place", "m"))
    place = F.col("place")
    first, second = _step(F.col("runs0"), place), _step(F.col("runs1"), F.floor(place / FAN))
    steps = F.when(F.col("height") == 0, F.array().cast(_STEPS)).when(F.col("height") == 1, F.array(first))
    return each.select(*kept, "m", steps.otherwise(F.array(first, second)).cast(_STEPS).alias("steps"))


def climb(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Trees over ``nodes(group, rank, group_rows, hash, ...)``.

    Returns the lowest blocks, each with ``above`` (steps from its root to its group's) and
    ``top`` (that root), and one row (group, top) per group.  Every round has a 256th of the
    rows of the last; only the size of the largest group reaches the driver.
    """
    rounds = [stored(_blocks(nodes), "merkle-blocks")]
    largest = rounds[0].agg(F.max("group_rows")).first()[0] or 0
    while largest > BLOCK:
        last = rounds[-1].select(
            "group", F.col("block").alias("rank"), F.ceil(F.col("group_rows") / BLOCK).alias("group_rows"),
            F.col("root").alias("hash"),
        )
        rounds.append(stored(_blocks(last), "merkle-blocks"))
        largest = -(-largest // BLOCK)
    top = rounds[-1].select("group", F.col("root").alias("top"))
    above = rounds[-1].select("group", "block", F.array().cast(_STEPS).alias("above"), F.col("root").alias("top"))
    for upper in reversed(rounds[1:]):
        below = _members(_with_above(upper, above), "group", "top", "above")
        above = below.select("group", F.col("m.rank").alias("block"), F.concat("steps", "above").alias("above"), "top")
    return _with_above(rounds[0], above), top


def _with_above(blocks: DataFrame, above: DataFrame) -> DataFrame:
    paths = above.select(F.col("group").alias("_group"), F.col("block").alias("_block"), "above", "top")
    same = F.col("group").eqNullSafe(F.col("_group")) & (F.col("block") == F.col("_block"))
    return blocks.drop("root").join(paths, same).drop("_group", "_block")


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(steps, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def manifest(
    docs: DataFrame, *, id_column: str = "doc_id", group_column: str = "source",
    value_columns: tuple[str, ...] = ("source", "lang", "n_chars", "text"), text_column: str = "text",
) -> DataFrame:
    """(doc_id, source, leaf, tampered_leaf, rank, steps, subroot, root) of every row.

    ``steps`` are the siblings (left, right) of each level from the leaf to the root;
    ``tampered_leaf`` is null where the row is not tampered with.  Nulls in any column are
    part of the leaf (``-``); a null source is a source of its own, the first; null ids come
    first, and their rows are never tampered with.  Rows with one id ascend by leaf, so
    repeated rows are leaves of their own in an order that changes nothing.  Empty and very
    long texts are hashed whole where they are read; no text is shuffled.  An empty table
    gives no rows.  Other columns of ``docs``, whatever their names, have no part.
    """
    text = F.col(text_column)
    hit, changed = tampered_text(F.col(id_column), text)
    values = [F.col(c) for c in value_columns]
    altered = [changed if c == text_column else F.col(c) for c in value_columns]
    leaves = docs.select(
        F.col(group_column).cast("string").alias("group"),
        F.col(id_column).alias("doc_id"),
        leaf_hash(F.col(id_column), *values).alias("hash"),
        F.when(hit, leaf_hash(F.col(id_column), *altered)).alias("tampered"),
    )
    nodes = ranked(stored(leaves, "merkle-leaves"), "group", ["doc_id", "hash"])
    blocks, tops = climb(nodes)
    subroots = tops.select(F.lit(0).alias("group"), F.col("group").alias("source"), F.col("top").alias("hash"))
    ordered = ranked(stored(subroots, "merkle-subroots"), "group", [F.col("source").asc_nulls_first()])
    upper, _ = climb(ordered)
    sources = _members(upper, "top", "above").select(
        F.col("m.source").alias("_source"), F.concat("steps", "above").alias("to_root"), F.col("top").alias("root")
    )
    paths = blocks.join(sources, F.col("group").eqNullSafe(F.col("_source"))).withColumn("above", F.concat("above", "to_root"))
    return _members(paths, "group", "top", "root", "above").select(
        F.col("m.doc_id").alias("doc_id"),
        F.col("group").alias("source"),
        F.col("m.hash").alias("leaf"),
        F.col("m.tampered").alias("tampered_leaf"),
        F.col("m.rank").alias("rank"),
        F.concat("steps", "above").alias("steps"),
        F.col("top").alias("subroot"),
        "root",
    )


def verified(rows: DataFrame) -> DataFrame:
    """The manifest's rows with ``proof_sha256``, ``folded_root`` and ``verified``: a row is folded anew to the root
    from its tampered leaf, or its own, and its stored siblings."""
    siblings = F.array_join(F.transform("steps", lambda s: F.concat(s["left"], s["right"])), "")
    fold = folded(F.coalesce("tampered_leaf", "leaf"), F.col("steps"))
    return rows.withColumns({"proof_sha256": F.sha2(siblings, 256), "folded_root": fold}).withColumn(
        "verified", F.col("folded_root") == F.col("root")
    )
