"""Stored high-watermark per named job (J4): one state per job, the newest wins."""

from __future__ import annotations

from datetime import datetime, timezone
from urllib.parse import quote

from pyspark.sql import SparkSession

from tidemark.registry import EPOCH_WATERMARK
from tidemark.sources.lake import parse_instant
from tidemark.sources.states import StateFolder


class WatermarkStore:
    """ISO instants per job.  A job that never committed stands at the epoch."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path

    def _states(self, job: str) -> StateFolder:
        return StateFolder(self.spark, f"{self.path}/job-{quote(job, safe='')}")

    def read(self, job: str) -> datetime:
        return parse_instant(self._states(job).latest()[1].get("watermark", EPOCH_WATERMARK))

    def commit(self, job: str, watermark: datetime) -> None:
        states = self._states(job)
        state = {"watermark": parse_instant(watermark).isoformat(), "written_at": datetime.now(timezone.utc).isoformat()}
        states.commit(states.latest()[0] + 1, state)
