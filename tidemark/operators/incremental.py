"""What is new, what to reload, what is stale."""

from __future__ import annotations

import logging
from collections.abc import Callable, Collection, Mapping
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from enum import Enum

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.registry import EPOCH_WATERMARK
from tidemark.sources.lake import parse_instant

EARLIEST_FACT = "1900-01-01"
_LOG = logging.getLogger(__name__)


class Decision(Enum):
    EMPTY = "EMPTY"  # landing holds nothing yet
    NEW = "NEW"  # rows after the watermark
    RESYNC = "RESYNC"  # watermark is current but some months below landing are not: reload those
    SKIP = "SKIP"  # nothing to do


@dataclass(frozen=True)
class Plan:
    decision: Decision
    latest: datetime | None
    start_after: datetime
    #: RESYNC: the months of each table to load again.
    drifted: Mapping[str, Collection[int]] = field(default_factory=dict)


def decide(latest: datetime | None, watermark: datetime, drift: Callable[[], Mapping[str, Collection[int]]]) -> Plan:
    """Compare the newest landing cursor with the stored watermark.

    ``drift`` is asked only when nothing is new: the months of each table that the layers
    below landing do not hold as landing does.  If that cannot be read they are taken to hold it.
    """
    if latest is None:
        return Plan(Decision.EMPTY, None, watermark)
    if latest > watermark:
        return Plan(Decision.NEW, latest, watermark)
    try:
        drifted = {name: months for name, months in drift().items() if months}
    except Exception:  # noqa: BLE001 - any failure to read means: do not reload
        _LOG.warning("the layers below landing could not be compared; nothing is reloaded", exc_info=True)
        drifted = {}
    if drifted:
        return Plan(Decision.RESYNC, latest, parse_instant(EPOCH_WATERMARK), drifted)
    return Plan(Decision.SKIP, latest, watermark)


def own_maximum(target: DataFrame, cursor: str = "ingested_at") -> Column:
    """Newest cursor of the target as a literal, so that ``>=`` on it is
    pushed into the scan of the source."""
    value = target.agg(F.max(cursor).cast("string")).first()[0]
    return F.lit(value or EARLIEST_FACT).cast(target.schema[cursor].dataType)


def since_own_maximum(source: DataFrame, target: DataFrame, cursor: str = "ingested_at") -> DataFrame:
    """Source rows not older than the newest target row, that row included."""
    return source.where(F.col(cursor) >= own_maximum(target, cursor))


def freshness(
    df: DataFrame,
    as_of: datetime | str,
    cursor: str = "ingested_at",
    warn_after: timedelta = timedelta(hours=36),
    error_after: timedelta = timedelta(hours=72),
) -> DataFrame:
    """Newest load and its state at ``as_of``; an empty table is an error."""
    now = parse_instant(as_of)
    newest = df.agg(F.max(cursor).cast("timestamp").alias("max_loaded_at"))
    state = (
        F.when(F.col("max_loaded_at").isNull(), "error")
        .when(F.col("max_loaded_at") < F.lit(now - error_after), "error")
        .when(F.col("max_loaded_at") < F.lit(now - warn_after), "warn")
        .otherwise("pass")
    )
    return newest.withColumn("state", state)


def stale(df: DataFrame, as_of: datetime | str, cursor: str = "ingested_at", days: int = 3) -> DataFrame:
    """K8: the newest load when it is older than ``days`` or missing, else no row."""
    limit = parse_instant(as_of) - timedelta(days=days)
    newest = df.agg(F.max(cursor).cast("timestamp").alias("max_loaded_at"))
    return newest.where((F.col("max_loaded_at") < F.lit(limit)) | F.col("max_loaded_at").isNull())
