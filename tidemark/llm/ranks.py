"""Gapless ranks inside groups of any size, without a window over rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import scratch_path

#: ``monotonically_increasing_id`` keeps the partition above these bits and the row's place below.
_ROW_BITS = 33


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: its lineage ends there."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ranked(df: DataFrame, group: str, order: Sequence[str | Column], rows_per_part: int = 200_000) -> DataFrame:
    """``df`` with ``rank`` (from 0, by ``order`` inside ``group``) and ``group_rows``.

    Rows are range-partitioned by group and order, so a hot group is spread over many
    tasks and only one row per group and task meets in a window.  ``df`` should be small
    rows of a written table: it is read for its count, the ranges and the sort.  Groups may
    be null; null orders first.  Rows that agree in all of ``order`` are ranked in any order.
    """
    parts = max(1, -(-df.count() // rows_per_part))
    salted = df.withColumn("_tie", F.monotonically_increasing_id())
    keys = [F.col(group).asc_nulls_first(), *order, F.col("_tie")]
    placed = stored(
        salted.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("_tie")
        .withColumn("_at", F.monotonically_increasing_id()),
        "ranks",
    ).withColumn("_part", F.shiftright("_at", _ROW_BITS))
    counts = placed.groupBy(F.col(group).alias("_group"), F.col("_part").alias("_run")).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    runs = Window.partitionBy("_group")
    before = runs.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        "_group", "_run", "_first",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"),
        F.sum("_n").over(runs).alias("group_rows"),
    )
    joined = placed.join(bases, placed[group].eqNullSafe(bases["_group"]) & (F.col("_part") == F.col("_run")))
    return joined.select(
        *[F.col(c) for c in df.columns], (F.col("_base") + F.col("_at") - F.col("_first")).alias("rank"), "group_rows"
    )
