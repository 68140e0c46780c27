"""Counts, maxima and unions over several tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


METRICS_SCHEMA = "table_name string, symbol string, row_count bigint"


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def key_union(frames: Sequence[DataFrame], key: str = "symbol") -> DataFrame:
    """Distinct non-null keys of several tables.

    Each table is made distinct on the map side of one shared aggregation, so
    no task sees more than one row per key and input task.
    """
    return union_all([f.select(key).where(F.col(key).isNotNull()) for f in frames]).distinct()


def latest_activity(frames: Sequence[DataFrame], key: str = "symbol", cursor: str = "ingested_at") -> DataFrame:
    """H2, E5: newest cursor per key over the union of several tables."""
    stacked = union_all([f.select(key, cursor) for f in frames])
    return stacked.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(cursor).alias(f"latest_{cursor}"))


def newest_overall(frames: Sequence[DataFrame], cursor: str = "ingested_at") -> DataFrame:
    """Maximum of the per-table maxima; parquet statistics can answer each."""
    maxima = union_all([f.agg(F.max(cursor).alias(cursor)) for f in frames])
    return maxima.agg(F.max(cursor).alias(f"max_{cursor}"))


def table_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row ``(table_name, row_count)`` per table."""
    return union_all(
        [
            frame.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
            for name, frame in frames.items()
        ]
    )


def total_rows(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Sum of the row counts."""
    return table_counts(frames).agg(F.sum("row_count").cast("bigint").alias("total_rows"))


def load_metrics(frames: Mapping[str, DataFrame], key: str = "symbol") -> DataFrame:
    """Rows to be written per table and symbol, in-batch duplicates included."""
    return union_all(
        [
            frame.groupBy(key).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), key, "row_count")
            for name, frame in frames.items()
        ]
    )


def duplicate_grain(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)
