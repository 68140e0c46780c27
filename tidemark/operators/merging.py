"""Keyed upsert, replace and insert-if-absent on tables without MERGE.

The batch is reduced to one row per key first.  The target side is then only
anti-joined on its key: a target is unique per key, so no key is hot, and the
planner broadcasts the batch keys when they are small enough at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.versioning import latest_by_key


def replace_by_key(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete the batch's keys from the target, then add the batch.

    The result has the batch's columns (A12): columns only the batch has are
    null on old rows, columns it no longer has are dropped.
    """
    kept = target.join(batch.select(*keys), list(keys), "left_anti")
    return sync_columns(kept, batch).unionByName(batch)


def sync_columns(old: DataFrame, new: DataFrame) -> DataFrame:
    """Give ``old`` exactly the columns of ``new``."""
    present = set(old.columns)
    return old.select(
        *[
            F.col(f.name) if f.name in present else F.lit(None).cast(f.dataType).alias(f.name)
            for f in new.schema.fields
        ]
    )


def last_write_per_key(batch: DataFrame, keys: Sequence[str], arrival: Sequence[str]) -> DataFrame:
    """The row of each key that arrived last; earlier ones are overwritten in the batch."""
    return latest_by_key(batch, keys, arrival)


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], arrival: Sequence[str]) -> DataFrame:
    """Insert new keys and overwrite every non-key column of existing ones.

    Within the batch the last arrival wins; the arrival columns are not stored
    unless the target has them.
    """
    incoming = last_write_per_key(batch, keys, arrival).select(*target.columns)
    return replace_by_key(target, incoming, keys)


def insert_if_absent(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], arrival: Sequence[str | Column]
) -> DataFrame:
    """The rows of ``batch`` to append: first arrival per key, keys not yet
    in the target.  Nulls in a key compare equal."""
    first = latest_by_key(batch, keys, [F.col(a).asc() if isinstance(a, str) else a for a in arrival])
    known = target.select(*[F.col(k).alias(f"_known_{k}") for k in keys]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in keys]
    condition = same[0]
    for part in same[1:]:
        condition = condition & part
    return first.join(known, condition, "left_anti")
