"""Trial queries: the operators on the test tables, each with the SQL it must equal.

The test tables are general order and event data.  :mod:`tidemark.trials.standins`
derives market-shaped tables from whole test tables with Spark; the trial
modules run the library on them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import apply_settings
from tidemark.trials.compare import comparable

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def trial(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can express it, the SQL to compare with."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(build(apply_settings(spark), sf_dir))

        run.__name__ = name
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return build

    return register


def load_all() -> None:
    from tidemark.trials import changes, layers, mappings, models, quality, reloads, rules  # noqa: F401
