"""Slowly changing history of a keyed table (J6): timestamp strategy, hard deletes closed."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.functions.scalars import version_key
from tidemark.sources.lake import parse_instant

VALID_FROM, VALID_TO, VERSION_ID, UPDATED_AT = "valid_from", "valid_to", "scd_id", "updated_at"
HISTORY_COLUMNS = (VERSION_ID, UPDATED_AT, VALID_FROM, VALID_TO)


def history_schema(source: T.StructType) -> T.StructType:
    return T.StructType(
        [T.StructField(f.name, f.dataType, True) for f in source.fields]
        + [
            T.StructField(VERSION_ID, T.StringType()),
            T.StructField(UPDATED_AT, T.TimestampType()),
            T.StructField(VALID_FROM, T.TimestampType()),
            T.StructField(VALID_TO, T.TimestampType()),
        ]
    )


def snapshot_changes(
    open_rows: DataFrame, source: DataFrame, key: str, updated_at: str, run_at: datetime | str
) -> DataFrame:
    """The successors of the open rows: still-open, newly closed and newly
    opened versions, in one pass.

    Both sides are unique per key, so the full outer join has no hot key.  A
    strictly newer source row closes the open version and opens another; a key
    gone from the source is closed at ``run_at``; a key without an open
    version, also one that comes back, opens one.
    """
    business = [c for c in source.columns]
    now = F.lit(parse_instant(run_at))
    old = open_rows.select(F.col(key).alias("_key"), F.struct(*open_rows.columns).alias("old"))
    fresh = source.select(
        F.col(key).alias("_key"),
        F.struct(
            *business,
            version_key(key, updated_at).alias(VERSION_ID),
            F.col(updated_at).alias(UPDATED_AT),
            F.col(updated_at).alias(VALID_FROM),
            F.lit(None).cast("timestamp").alias(VALID_TO),
        ).alias("fresh"),
    )
    both = old.join(fresh, "_key", "full_outer")

    def closed_at(instant):
        kept = [F.col(f"old.{c}").alias(c) for c in open_rows.columns if c != VALID_TO]
        return F.struct(*kept, instant.cast("timestamp").alias(VALID_TO))

    gone = F.col("fresh").isNull()
    is_new = F.col("old").isNull()
    changed = F.col(f"fresh.{UPDATED_AT}") > F.col(f"old.{UPDATED_AT}")
    versions = (
        F.when(gone, F.array(closed_at(now)))
        .when(is_new, F.array("fresh"))
        .when(changed, F.array(closed_at(F.col(f"fresh.{UPDATED_AT}")), F.col("fresh")))
        .otherwise(F.array("old"))
    )
    return both.select(F.inline(versions))


def snapshot(history: DataFrame, source: DataFrame, key: str, updated_at: str, run_at: datetime | str) -> DataFrame:
    """The whole history after one snapshot run."""
    columns = [*source.columns, *HISTORY_COLUMNS]
    open_rows = history.where(F.col(VALID_TO).isNull()).select(*columns)
    closed = history.where(F.col(VALID_TO).isNotNull()).select(*columns)
    return closed.unionByName(snapshot_changes(open_rows, source, key, updated_at, run_at))
