"""Joins against reference keys.

Every right side is reduced to one row per key before it is joined, and no
side is broadcast by hint: the planner broadcasts it when its size, measured
at run time, is below the configured threshold, and shuffles otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def attach(left: DataFrame, right_unique: DataFrame, key: str) -> DataFrame:
    """Left join to a side with one row per key; the row count stays."""
    return left.join(right_unique, key, "left")


def missing_keys(expected: DataFrame, present: DataFrame, key: str, alias: str) -> DataFrame:
    """Keys of ``expected`` that ``present`` lacks."""
    wanted = expected.select(F.col(key).alias(alias)).where(F.col(alias).isNotNull()).distinct()
    have = present.select(F.col(key).alias(alias)).distinct()
    return wanted.join(have, alias, "left_anti")


def orphan_counts(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without a parent and their row counts; null keys pass.

    Child rows are counted per key before the join, so a hot key is one row.
    """
    referenced = (
        child.where(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("orphan_key"))
        .agg(F.count(F.lit(1)).alias("child_rows"))
    )
    parents = parent.select(F.col(parent_key).alias("orphan_key")).distinct()
    return referenced.join(parents, "orphan_key", "left_anti")
