"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source has the same expected number of copies.  Fractional
parts are paired: words are moved at random from one document to the other
until one of the two takes a whole number of copies, which keeps the source's
total and each document's expectation.  A task works off the documents of its
node and keeps one open document per source; a reduction tree pairs those.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.text import fresh_name
from tidemark.session import ensure_checkpoint_dir

_WORD = r"[^\x20\x09-\x0D]+"
_OPEN = "row long, content long, doc_id long, source string, size long, source_size long, target double, base long, p double, open boolean, node long"


def word_count(text: str):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(_WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, source_size, target) of every source of ``sized(source, size)``.

    Sources in code point order, null last, take ``weights`` in turn and share
    ``share`` of all words; what is above ``cap`` times a source's words is shared
    anew by weight among the others, until none is above.  The driver sees three
    numbers per round.
    """
    ensure_checkpoint_dir(sized.sparkSession)
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source, not per document, meets in this window.
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    sources = totals.select(
        "source",
        "source_size",
        F.array(*[F.lit(float(w)) for w in weights])[(place - 1) % len(weights)].alias("weight"),
        (F.col("source_size") * F.lit(float(cap))).alias("most"),
    ).checkpoint()
    level, known = 0.0, -1
    while True:
        full = F.col("most") < F.lit(level) * F.col("weight")
        row = sources.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)).alias("all"),
            F.count_if(full).alias("full"),
            F.coalesce(F.sum(F.when(full, F.col("most"))), F.lit(0.0)).alias("taken"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("weight"),
        ).first()
        if row.full == known or not row.weight:
            break
        known, level = row.full, (share * row["all"] - row.taken) / row.weight
    target = F.least(F.col("most"), F.lit(level) * F.col("weight"))
    if not row.weight:
        target = F.col("most")
    return sources.select("source", "source_size", target.alias("target"))


def _unit(seed: int, doc_id, size: int, level: int) -> float:
    import xxhash

    return (xxhash.xxh64_intdigest(f"{doc_id}/{size}/{level}".encode(), seed) >> 11) / (1 << 53)


def _pair(a: float, p: float, b: float, q: float, u: float) -> tuple[float, float]:
    """Move words between documents of ``a`` and ``b`` words until one of the shares is 0 or 1."""
    up, down = min((1 - p) * a, q * b), min(p * a, (1 - q) * b)
    if u * (up + down) < down:
        return (1.0, q - up / b) if (1 - p) * a <= q * b else (p + up / a, 0.0)
    return (0.0, q + down / b) if p * a <= (1 - q) * b else (p - down / a, 1.0)


def _settle(rows: DataFrame, seed: int, level: int) -> DataFrame:
    """Pair the open rows of each (node, source); all but one at most are settled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, None
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if (r["node"], r["source"]) != key:
                    if held:
                        out.append(held)
                    key, held = (r["node"], r["source"]), None
                if not r["size"] or not 0 < r["p"] < 1:
                    out.append(r | {"p": round(r["p"]), "open": False})
                elif held is None:
                    held = r
                else:
                    u = _unit(seed, r["doc_id"], r["size"], level)
                    held["p"], r["p"] = _pair(held["size"], held["p"], r["size"], r["p"], u)
                    still = [x for x in (held, r) if 1e-9 < x["p"] < 1 - 1e-9]
                    out += [x | {"p": round(x["p"]), "open": False} for x in (held, r) if x not in still]
                    held = still[0] if still else None
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=batch.schema)
        if held:
            yield pa.RecordBatch.from_pylist([held], schema=batch.schema)

    order = F.xxhash64(F.col("doc_id"), F.lit(seed + level))
    placed = rows.repartition("node", "source").sortWithinPartitions("node", "source", order, "doc_id", "size", "content", "row")
    return placed.mapInArrow(run, _OPEN)


def mix(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
    weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, seed: int = 7,
    node_rows: int = 20_000, fan_in: int = 16,
) -> DataFrame:
    """(row, doc_id, size, source, source_size, target, copies) of every row of a table scan.

    ``copies`` is a whole number for all documents but one per source at most;
    that one keeps a fraction, so a source's words meet its target.  Null and
    empty texts have no words and are no source's weight; null sources are one
    source, the last; repeated rows are rounded one by one; an empty table gives
    no rows.  Nodes, order and draws follow from ids and texts alone, so reruns
    agree however the table is split into tasks; a hot source is spread over all
    nodes.  A node's rows pass one by one, whatever their number.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    sized = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.xxhash64(text_column).alias("content"),
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(source_column).cast("string").alias("source"),
        word_count(text_column).alias("size"),
    ).checkpoint()
    targets = source_targets(sized, weights, share, cap)
    nodes = max(1, -(-sized.count() // node_rows))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = sized.join(targets, sized.source.eqNullSafe(targets.source)).select(
        "row", "content", "doc_id", sized.source, "size", "source_size", "target",
        F.floor(ratio).alias("base"),
        (ratio - F.floor(ratio)).alias("p"),
        F.lit(True).alias("open"),
        F.pmod(F.xxhash64("doc_id", "content"), F.lit(nodes)).alias("node"),
    )
    done, level = None, 0
    while True:
        settled = _settle(rows, seed, level).checkpoint()
        closed = settled.where("not open")
        done = closed if done is None else done.unionByName(closed)
        rows = settled.where("open").withColumn("node", F.floor(F.col("node") / fan_in))
        if nodes <= 1:
            break
        nodes, level = -(-nodes // fan_in), level + 1
    every = done.unionByName(settled.where("open"))
    return every.select(
        "row", "doc_id", "size", "source", "source_size", "target", (F.col("base") + F.col("p")).alias("copies")
    )


def words_taken(mixed: DataFrame) -> DataFrame:
    """Words each row gives to the mix: whole copies, and of a source's open document a part of one."""
    return mixed.withColumn("taken", F.round(F.col("copies") * F.col("size")).cast("long"))


def mixed_documents(docs: DataFrame, seed: int = 7, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; all texts stay whole.

    A source's one open document is taken once more or not, at random by its fraction.
    """
    mixed = mix(docs, seed=seed, **options)
    part = F.col("copies") - F.floor("copies")
    unit = F.pmod(F.xxhash64("doc_id", "size", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    times = (F.floor("copies") + (unit < part).cast("long")).cast("int")
    key, count = fresh_name(docs, "_row"), fresh_name(docs, "_times")
    taken = mixed.select(F.col("row").alias(key), times.alias(count)).where(F.col(count) > 0)
    keyed = docs.select("*", F.monotonically_increasing_id().alias(key))
    joined = keyed.join(taken, key)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return joined.select(*columns, F.explode(F.sequence(F.lit(1), count)).alias(count)).drop(count)
