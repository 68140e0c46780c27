"""Latest version per key, newest value, physical against logical counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_RANK = "_version_rank"


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """one row per key, the first in ``order`` (names mean newest first).

    Spark keeps only the best row per key of each input task before it
    shuffles, so a key that holds a large part of the rows sends one row per
    task, not all of its versions.
    """
    ordering = [F.col(o).desc_nulls_last() if isinstance(o, str) else o for o in order]
    window = Window.partitionBy(*keys).orderBy(*ordering)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def newest_value(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """Newest non-null ``value`` per key; null when the key has none.

    Rows with a value come first, so the best row of each input task and key is all that is shuffled.
    """
    rows = df.select(*keys, value, *[c for c in order if c not in (*keys, value)])
    return latest_by_key(rows, keys, [F.col(value).isNotNull().desc(), *order]).select(*keys, value)


def version_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows against distinct keys.

    Keys are grouped first (with partial counts on the map side), then summed.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("physical_rows"),
        F.count(F.lit(1)).alias("logical_rows"),
    )
