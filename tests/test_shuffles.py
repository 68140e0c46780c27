"""What the steps of a refresh shuffle, and that rows laid out by month are the same rows."""

from __future__ import annotations

import re
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import functions as F

from tests.test_plans import hot_prices, plan_of
from tidemark.functions.scalars import strip_text
from tidemark.operators import quality
from tidemark.operators.versioning import latest_by_key
from tidemark.plans import jobs
from tidemark.registry import DAILY_PRICE, VERSION_ORDER
from tidemark.sources.envelopes import read_envelopes, write_envelopes
from tidemark.sources.lake import Lake
from tidemark.trials import standins

_START = datetime(1970, 1, 1, tzinfo=timezone.utc)


def exchanges(df) -> int:
    return len(re.findall(r"\bExchange\b", plan_of(df)))


def record_writes(monkeypatch) -> list[int]:
    """Exchanges in the plan of each monthly write."""
    seen, write = [], Lake._month_writer

    def counted(self, df, sort_columns, *rest):
        laid = df if rest and rest[0] else df.hint("rebalance", "yyyymm")
        seen.append(exchanges(laid))
        return write(self, df, sort_columns, *rest)

    monkeypatch.setattr(Lake, "_month_writer", counted)
    return seen


def test_sync_shuffles_an_increment_once(spark, tmp_path, monkeypatch):
    """Landed rows lie by month, so staging takes them as they are; curated needs one shuffle for keys and months."""
    lake = Lake(spark, str(tmp_path))
    rows = hot_prices(spark, 6_000)
    lake.overwrite_months("landing", DAILY_PRICE.name, latest_by_key(rows, DAILY_PRICE.key, VERSION_ORDER), "price_date", DAILY_PRICE.sort_columns)
    seen = record_writes(monkeypatch)
    jobs.sync_increment(lake, _START)
    assert seen == [0, 1]
    expected = latest_by_key(rows, DAILY_PRICE.key, VERSION_ORDER).select(*DAILY_PRICE.columns)
    stored = lake.curated(DAILY_PRICE).select(*DAILY_PRICE.columns)
    assert stored.exceptAll(expected).count() == 0 and expected.exceptAll(stored).count() == 0


def test_newest_over_many_buckets(spark, tmp_path, monkeypatch):
    """A month over many buckets keeps one row per key, the newest."""
    monkeypatch.setattr(jobs, "_BUCKET_ROWS", 50)
    lake = Lake(spark, str(tmp_path))
    rows = hot_prices(spark, 3_000)
    parts = [*jobs.stage_increment(lake, DAILY_PRICE, rows), *jobs.stage_increment(lake, DAILY_PRICE, rows)]
    jobs.refresh_curated(lake, DAILY_PRICE, {p.month for p in parts})
    expected = latest_by_key(rows, DAILY_PRICE.key, VERSION_ORDER).select(*DAILY_PRICE.columns)
    stored = lake.curated(DAILY_PRICE).select(*DAILY_PRICE.columns)
    assert stored.exceptAll(expected).count() == 0 and expected.exceptAll(stored).count() == 0


def test_first_fact_rows_are_not_shuffled(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path))
    rows = latest_by_key(hot_prices(spark, 3_000), DAILY_PRICE.key, VERSION_ORDER)
    lake.overwrite_months("landing", DAILY_PRICE.name, rows, "price_date", DAILY_PRICE.sort_columns)
    seen = record_writes(monkeypatch)
    jobs.refresh_fact(lake, "fct_stock_daily")
    assert seen == [0]
    assert lake.row_count("facts", "fct_stock_daily") == lake.row_count("landing", DAILY_PRICE.name)


def test_landing_derives_incoming_rows_once(spark, tmp_path, monkeypatch):
    """Rows put into a filled table are derived once: months, keys and rows come from their stored copy."""
    lake = Lake(spark, str(tmp_path))
    rows = latest_by_key(hot_prices(spark, 3_000), DAILY_PRICE.key, VERSION_ORDER).select(*DAILY_PRICE.columns)
    jobs.replace_landed(lake, DAILY_PRICE, rows)
    raised = rows.where(F.col("symbol") == "HOT").withColumn("volume", F.col("volume") + 1)
    seen, write = [], Lake._month_writer
    monkeypatch.setattr(Lake, "_month_writer", lambda self, df, *rest: (seen.append(plan_of(df)), write(self, df, *rest))[1])
    jobs.replace_landed(lake, DAILY_PRICE, raised)
    assert len(seen) == 1 and "Window" not in seen[0]
    expected = rows.where(F.col("symbol") != "HOT").unionByName(raised)
    stored = lake.landing(DAILY_PRICE).select(*DAILY_PRICE.columns)
    assert stored.exceptAll(expected).count() == 0 and expected.exceptAll(stored).count() == 0


def test_splits_fit_a_task(spark):
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "16m"


def test_trimming_without_patterns(spark):
    """Every white space of Unicode, at the ends only; no pattern runs over the text."""
    white = [c for c in map(chr, range(1, 0x10000)) if not 0xD800 <= ord(c) < 0xE000]
    rows = spark.createDataFrame([(c, f"{c}{c}a{c}b{c}") for c in white], "c string, text string")
    trimmed = rows.select("c", "text", strip_text("text").alias("now"), F.regexp_replace("text", r"(?U)^\s+|\s+$", "").alias("pattern"))
    assert trimmed.where("now <> pattern").count() == 0
    assert "regexp_replace" not in plan_of(rows.select(strip_text("text")))


def test_months_with_one_version_are_copied(spark, tmp_path, monkeypatch):
    """Curated takes what landing holds once per key without a shuffle; a month that has rows already is compared."""
    lake = Lake(spark, str(tmp_path))
    rows = latest_by_key(hot_prices(spark, 3_000), DAILY_PRICE.key, VERSION_ORDER).select(*DAILY_PRICE.columns)
    jobs.replace_landed(lake, DAILY_PRICE, rows)
    seen = record_writes(monkeypatch)
    jobs.sync_increment(lake, _START)
    assert seen == [0, 0]
    raised = rows.withColumns({"volume": F.col("volume") + 1, "ingested_at": F.col("ingested_at") + F.expr("INTERVAL 1 DAY")})
    jobs.replace_landed(lake, DAILY_PRICE, raised)
    seen.clear()
    jobs.sync_increment(lake, _START)
    assert seen == [0, 1]
    stored = lake.curated(DAILY_PRICE).select(*DAILY_PRICE.columns)
    assert stored.exceptAll(raised).count() == 0 and raised.exceptAll(stored).count() == 0


def test_unkeyed_landing_is_compared(spark, tmp_path):
    """Landing rows that nobody made one per key are not copied: curated has the newest of each key."""
    lake = Lake(spark, str(tmp_path))
    rows = latest_by_key(hot_prices(spark, 600), DAILY_PRICE.key, VERSION_ORDER).select(*DAILY_PRICE.columns)
    newer = rows.withColumn("ingested_at", F.col("ingested_at") + F.expr("INTERVAL 1 DAY"))
    lake.overwrite_months("landing", DAILY_PRICE.name, rows.unionByName(newer), "price_date", DAILY_PRICE.sort_columns)
    jobs.sync_increment(lake, _START)
    stored = lake.curated(DAILY_PRICE).select(*DAILY_PRICE.columns)
    assert stored.exceptAll(newer).count() == 0 and newer.exceptAll(stored).count() == 0


def test_facts_shuffle_only_filled_months(spark, tmp_path):
    """Months that the fact lacks are written as they are read, beside those whose keys are replaced."""
    lake = Lake(spark, str(tmp_path))
    rows = latest_by_key(hot_prices(spark, 3_000), DAILY_PRICE.key, VERSION_ORDER).select(*DAILY_PRICE.columns)
    later = rows.withColumns({"price_date": F.add_months("price_date", 60), "ingested_at": F.col("ingested_at") + F.expr("INTERVAL 1 DAY")})
    raised = rows.where(F.col("symbol") == "HOT").withColumns(
        {"volume": F.col("volume") + 1, "ingested_at": F.col("ingested_at") + F.expr("INTERVAL 1 DAY")}
    )
    jobs.replace_landed(lake, DAILY_PRICE, rows)
    jobs.refresh_fact(lake, "fct_stock_daily")
    jobs.replace_landed(lake, DAILY_PRICE, latest_by_key(later.unionByName(raised), DAILY_PRICE.key, VERSION_ORDER))
    jobs.refresh_fact(lake, "fct_stock_daily")
    landed, stored = lake.landing(DAILY_PRICE).select(*DAILY_PRICE.columns), jobs.read_fact(lake, "fct_stock_daily").select(*DAILY_PRICE.columns)
    assert stored.exceptAll(landed).count() == 0 and landed.exceptAll(stored).count() == 0


def test_repeated_keys_by_their_hashes(spark):
    keys = [("a" * 32,), ("b" * 32,), ("a" * 32,), (None,), (None,)]
    df = spark.createDataFrame(keys, "sk string")
    assert [tuple(r) for r in quality.repeated(df, "sk").collect()] == [("a" * 32, 2)]
    assert quality.repeated(df.distinct(), "sk").collect() == []


def test_envelope_files_are_compressed(spark, tmp_path):
    blank = "CAST(NULL AS STRING) AS source, CAST(NULL AS TIMESTAMP) AS load_timestamp, id AS seq"
    rows = spark.range(50).selectExpr("'ratings' AS dataset", "concat('S', id) AS symbol", "DATE '2024-01-01' AS record_date", "parse_json('{}') AS payload", *blank.split(", "))
    path = write_envelopes(rows, str(tmp_path), "one")
    names = [p.name for p in Path(path).glob("part-*")]
    assert names and all(n.endswith(".json.gz") for n in names)
    assert read_envelopes(spark, path).select("symbol").distinct().count() == 50


def test_stand_ins_dealt_by_month_are_the_same_rows(spark):
    folder = "/root/testdata/sf0.001"
    plain, dealt = standins.market(spark, folder), standins.market(spark, folder, dealt=True)
    for name, rows in plain.items():
        other = dealt[name].drop(*standins.PLACE)
        assert other.exceptAll(rows).count() == 0 and rows.exceptAll(other).count() == 0, name
