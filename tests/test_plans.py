"""Physical plans: what is pruned, pushed down and combined before a shuffle, and results under skew."""

from __future__ import annotations

import re
from datetime import datetime, timezone

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import tidemark.trials as trials
from tidemark.operators.fallback import merge_sources
from tidemark.operators.merging import upsert
from tidemark.operators.versioning import latest_by_key
from tidemark.plans import models
from tidemark.registry import DAILY_PRICE
from tidemark.session import apply_settings
from tidemark.sources.lake import newer_than, with_month

SF_DIR = "/root/testdata/sf0.001"
trials.load_all()


def plan_of(df) -> str:
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


def hot_prices(spark, rows=30_000):
    """A third of all rows belong to one symbol and one month."""
    n = F.col("id")
    hot = n % 3 == 0
    symbol = F.when(hot, F.lit("HOT")).otherwise(F.concat(F.lit("S"), (n % 997).cast("string")))
    price = (n % 100 + 1).cast("decimal(18,6)")
    return spark.range(rows).select(
        symbol.alias("symbol"),
        F.when(hot, F.date_add(F.lit("2024-03-01").cast("date"), (n % 28).cast("int")))
        .otherwise(F.date_add(F.lit("2024-01-01").cast("date"), (n % 700).cast("int")))
        .alias("price_date"),
        *[price.alias(c) for c in ("open_price", "high_price", "low_price", "close_price")],
        F.lit(None).cast("decimal(18,6)").alias("adjusted_close"),
        n.alias("volume"),
        F.timestamp_seconds(n).alias("ingested_at"),
        F.lit("s").alias("source_system"),
        F.concat(F.lit("b"), n.cast("string")).alias("batch_id"),
    )


def test_mart_aggregates_before_its_only_row_shuffle(spark):
    names = spark.createDataFrame([], "symbol string, company_name string, ingested_at timestamp, snapshot_date date")
    plan = plan_of(models.monthly_mart(hot_prices(spark), names, "2024-01-01T00:00:00Z"))
    assert "partial_sum" in plan and "partial_bit_or" in plan and "count(distinct" not in plan
    below = plan[plan.index("partial_sum") :]
    assert "Exchange" not in below.split("Window")[0].split("BroadcastExchange")[0]


def test_mart_over_a_hot_symbol(spark):
    names = spark.createDataFrame([], "symbol string, company_name string, ingested_at timestamp, snapshot_date date")
    mart = models.monthly_mart(hot_prices(spark), names, "2024-01-01T00:00:00Z")
    row = mart.where("symbol = 'HOT'").collect()
    assert [(r["source_row_count"], r["trading_days_count"]) for r in row] == [(10_000, 28)]


def test_latest_version_limits_before_the_shuffle(spark):
    latest = latest_by_key(hot_prices(spark), ["symbol"], ["ingested_at"])
    plan = plan_of(latest)
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert latest.where("symbol = 'HOT'").select("volume").first()[0] == 29_997


def test_upsert_and_merge_over_a_hot_key(spark):
    rows = hot_prices(spark).select("symbol", "volume")
    empty = rows.limit(0)
    assert upsert(empty, rows, ["symbol"], ["volume"]).where("symbol = 'HOT'").collect() == [("HOT", 29_997)]
    flagged = rows.select("symbol", F.col("volume").alias("arrival"), F.lit(False).alias("hollow"))
    merged = merge_sources(flagged, flagged, ["symbol"], F.col("hollow"), "arrival")
    assert merged.count() == 30_000


def test_hot_month_is_stored_whole(spark, lake):
    apply_settings(spark)
    lake.append_staging(DAILY_PRICE, hot_prices(spark))
    stored = lake.staging(DAILY_PRICE)
    assert stored.count() == 30_000
    assert stored.where("yyyymm = 202403").count() == hot_prices(spark).where("price_date BETWEEN '2024-03-01' AND '2024-03-31'").count()


def test_hot_month_is_split_over_tasks(spark, lake):
    """A month far above the advised task size is written by several tasks."""
    apply_settings(spark)
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "65536")
    try:
        lake.append_staging(DAILY_PRICE, hot_prices(spark, 120_000))
    finally:
        spark.conf.set(size, before)
    files = lake.staging(DAILY_PRICE).select("yyyymm", F.input_file_name().alias("file")).distinct()
    per_month = {r["yyyymm"]: r["count"] for r in files.groupBy("yyyymm").count().collect()}
    assert per_month[202403] > 2, per_month
    assert lake.staging(DAILY_PRICE).count() == 120_000


def test_watermark_scan_uses_statistics(spark, lake):
    apply_settings(spark)
    lake.overwrite_months("landing", DAILY_PRICE.name, hot_prices(spark), "price_date", ("symbol",))
    newer = newer_than(lake.landing(DAILY_PRICE), datetime(1970, 1, 1, 8, tzinfo=timezone.utc))
    assert "GreaterThan(ingested_at" in plan_of(newer)
    file = newer.select(F.input_file_name()).first()[0].removeprefix("file://")
    column = pq.ParquetFile(file).metadata.row_group(0)
    stats = {column.column(i).path_in_schema: column.column(i).statistics for i in range(column.num_columns)}
    assert stats["ingested_at"] is not None and stats["ingested_at"].has_min_max


def test_months_are_partitions(spark):
    assert with_month(hot_prices(spark), "price_date").select("yyyymm").distinct().count() == 23


_JOINING = [n for n in trials.QUERIES if n.startswith(("a7", "a8", "a9", "b10_f", "d", "e1", "g3", "j5", "j6", "k15"))]


@pytest.mark.parametrize("name", _JOINING)
def test_no_cartesian_product(spark, name):
    plan = plan_of(trials.QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
