"""Trials of second loads: incremental models, drift, changed columns, the contract, the screen.

Prices and profiles share their symbols here, and all rows come in two loads: the second brings
new days, new prices for some days of the first, and newer profiles with other names.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.incremental import Decision
from tidemark.operators.merging import replace_by_key
from tidemark.operators.universe import industry_match, ranked_universe, screen
from tidemark.operators.versioning import latest_by_key
from tidemark.plans import jobs, models
from tidemark.registry import (
    BASIC_INFO,
    DAILY_PRICE,
    DIMENSION_NAME,
    DIMENSION_SCHEMA,
    HOLDERS,
    MONTHLY_MART_NAME,
    MONTHLY_MART_SCHEMA,
    MONTHLY_SUMMARY_NAME,
    MONTHLY_SUMMARY_SCHEMA,
    TABLES,
    VERSION_ORDER,
)
from tidemark.sources.contracts import contract_report
from tidemark.sources.lake import Lake
from tidemark.sources.watermark import WatermarkStore
from tidemark.trials import standins as st, trial
from tidemark.trials.compare import rendered
from tidemark.trials.layers import WINDOW, new_lake
from tidemark.trials.models import MART_COLUMNS, MART_SQL

_CUT = "1997-03-01"
_FIRST, _SECOND = datetime(2024, 1, 31, 12, tzinfo=timezone.utc), datetime(2024, 2, 1, 12, tzinfo=timezone.utc)
#: Days of the first load whose prices the second load raises.
_RAISED = "volume > 30 AND price_date BETWEEN DATE '1996-11-01' AND DATE '1997-01-31'"
_DAILY2_SQL = f"""daily2 AS (
  SELECT * REPLACE (CASE WHEN {_RAISED} THEN CAST(close_price + 1 AS DECIMAL(18,6)) ELSE close_price END AS close_price,
                    CASE WHEN {_RAISED} THEN CAST(high_price + 1 AS DECIMAL(18,6)) ELSE high_price END AS high_price)
  FROM daily)"""
_MART2_SQL = MART_SQL.format(source="daily2")
_WITHOUT_LOAD = " ".join(c for c in MART_COLUMNS.split() if not c.startswith("loaded_at"))


def _profiles(spark, sf_dir, version: int, at: datetime) -> DataFrame:
    own = {"symbol", "snapshot_date", "company_name"}
    named = st.supplier_profiles(spark, sf_dir).where(F.month("snapshot_date") == version)
    values = {
        "ingested_at": F.lit(at),
        "source_system": F.lit("suppliers"),
        "batch_id": F.lit(f"load-{version}"),
        "country": F.lit("HOME") if version == 2 else F.lit(None),
    }
    return named.select(
        *[(F.col(f.name) if f.name in own else values.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name) for f in BASIC_INFO.schema.fields]
    )


def land(lake: Lake, spec, rows: DataFrame) -> None:
    """Upsert typed rows into landing, as an ingest of them would leave it."""
    place = [c for c in st.PLACE if c in rows.columns]
    newest = latest_by_key(rows, [*place, *spec.key], VERSION_ORDER).select(*spec.columns)
    jobs.replace_landed(lake, spec, newest, by_month=bool(place))


_LAKES: dict[tuple[str, str], Lake] = {}


def two_loads(spark, sf_dir) -> Lake:
    """A lake refreshed after each of two loads; the third poll must skip.  Made once per session and data."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LAKES:
        _LAKES[key] = _refreshed_twice(spark, sf_dir)
    return _LAKES[key]


def _refreshed_twice(spark, sf_dir) -> Lake:
    lake = new_lake(spark, "two-loads")
    state = WatermarkStore(spark, f"{lake.root}/state")
    daily = st.daily_prices(spark, sf_dir, dealt=True)
    early = F.col("price_date") < F.lit(_CUT).cast("date")
    raised = F.expr(_RAISED)
    changed = daily.where(raised).withColumns(
        {c: (F.col(c) + 1).cast("decimal(18,6)") for c in ("close_price", "high_price")}
    )
    loads = (
        (_FIRST, daily.where(early), st.line_holders(spark, sf_dir, dealt=True)),
        (_SECOND, daily.where(~early).unionByName(changed), None),
    )
    for number, (at, prices, holders) in enumerate(loads, start=1):
        land(lake, BASIC_INFO, _profiles(spark, sf_dir, number, at))
        land(lake, DAILY_PRICE, prices.withColumn("ingested_at", F.lit(at)))
        if holders is not None:
            land(lake, HOLDERS, holders.withColumn("ingested_at", F.lit(at)))
        decision = jobs.refresh_from_landing(lake, state, "main", at, WINDOW)
        assert decision is Decision.NEW, decision
    assert jobs.detect_new(lake, state, "main").decision is Decision.SKIP
    return lake


@trial(
    "p6_second_load",
    rendered(
        _WITHOUT_LOAD,
        "SELECT * FROM mart",
        f"{st.DAILY_SQL}, {_DAILY2_SQL}, {st.SUPPLIER_PROFILES_SQL}, {_MART2_SQL}",
    ),
)
def p6_second_load(spark, sf_dir):
    """The mart after two loads, each refreshed by its touched months and new names, equals one built of all rows."""
    lake = two_loads(spark, sf_dir)
    return lake.monthly(MONTHLY_MART_NAME, MONTHLY_MART_SCHEMA).drop("loaded_at")


@trial(
    "p3_second_load",
    rendered(
        "symbol:s month_date:d avg_open_price:n avg_close_price:n avg_volume:n company_name:s country:s batch_id:s",
        """SELECT m.*, coalesce(p.company_name, 'UNKNOWN') AS company_name, 'HOME' AS country, 'load-2' AS batch_id FROM (
             SELECT symbol, date_trunc('month', price_date) AS month_date,
               CAST(sum(open_price) AS DOUBLE) / count(open_price) AS avg_open_price,
               CAST(sum(close_price) AS DOUBLE) / count(close_price) AS avg_close_price,
               CAST(sum(volume) AS DOUBLE) / count(volume) AS avg_volume
             FROM daily2 WHERE open_price >= 0 AND close_price >= 0 AND volume >= 0 GROUP BY ALL) AS m
           JOIN (SELECT * FROM supplier_profiles WHERE month(snapshot_date) = 2) AS p USING (symbol)""",
        f"{st.DAILY_SQL}, {_DAILY2_SQL}, {st.SUPPLIER_PROFILES_SQL}",
    ),
)
def p3_second_load(spark, sf_dir):
    """The summary of touched months beside the dimension merged from its state (D1, D2, E2, E5, J5, P3); prices meet profiles."""
    lake = two_loads(spark, sf_dir)
    summary = lake.monthly(MONTHLY_SUMMARY_NAME, MONTHLY_SUMMARY_SCHEMA)
    dimension = lake.published(DIMENSION_NAME, DIMENSION_SCHEMA)
    return summary.join(dimension.select("symbol", "company_name", "country", "batch_id"), "symbol")


@trial(
    "j2_drift",
    """SELECT 'RESYNC' AS decision, CAST(year(d) * 100 + month(d) AS BIGINT) AS month,
         CAST(count(*) AS BIGINT) AS curated_rows
       FROM (SELECT symbol, price_date AS d FROM (SELECT DISTINCT 'S' || CAST(l_suppkey AS VARCHAR) AS symbol,
               CAST(l_shipdate AS DATE) AS price_date FROM lineitem)) AS days
       WHERE year(d) * 100 + month(d) IN (199505, 199602) GROUP BY ALL""",
)
def j2_drift(spark, sf_dir):
    """A staged month is deleted and a month's last day arrives late under an old instant: those two months are reloaded, no others."""
    lake = new_lake(spark, "drift")
    state = WatermarkStore(spark, f"{lake.root}/state")
    daily = st.daily_prices(spark, sf_dir).withColumn("ingested_at", F.lit(_SECOND))
    late = (F.date_trunc("month", "price_date") == F.lit("1996-02-01").cast("timestamp")) & (F.day("price_date") > 20)
    land(lake, DAILY_PRICE, daily.where(~late))
    plan = jobs.detect_new(lake, state, "main")
    jobs.sync_increment(lake, plan.start_after)
    state.commit("main", plan.latest)
    land(lake, DAILY_PRICE, daily.where(late).withColumn("ingested_at", F.lit(_FIRST)))
    for part in lake.parts("staging", DAILY_PRICE.staging_name):
        if part.month == 199505:
            lake.delete_part("staging", DAILY_PRICE.staging_name, part)
    plan = jobs.detect_new(lake, state, "main")
    before = lake.versions("curated", DAILY_PRICE.curated_name)
    jobs.resync_months(lake, plan.drifted)
    after = lake.versions("curated", DAILY_PRICE.curated_name)
    rewritten = sorted(int(m) for m in after if after[m] != before.get(m))
    assert jobs.detect_new(lake, state, "main").decision is Decision.SKIP
    stored = lake.curated(DAILY_PRICE, lambda part: part.month in rewritten)
    return stored.groupBy(F.lit(plan.decision.value).alias("decision"), F.col("yyyymm").alias("month")).agg(
        F.count(F.lit(1)).alias("curated_rows")
    )


@trial(
    "a12_changed_columns",
    f"""WITH {st.DAILY_SQL} SELECT symbol, CAST(price_date AS VARCHAR) AS price_date, CAST(close_price AS DOUBLE) AS close_price,
        CASE WHEN price_date >= DATE '{_CUT}' THEN CAST(high_price - low_price AS DOUBLE) END AS spread FROM daily""",
)
def a12_changed_columns(spark, sf_dir):
    """A fact that drops a column and gets another between two loads; months of both schemas are read together."""
    lake = new_lake(spark, "columns")
    daily = st.daily_prices(spark, sf_dir)
    early = F.col("price_date") < F.lit(_CUT).cast("date")
    kept = ("symbol", "price_date", "close_price")
    old = daily.select(*kept, F.col("volume").alias("dropped"))
    new = daily.select(*kept, (F.col("high_price") - F.col("low_price")).cast("decimal(18,6)").alias("spread"))
    lake.overwrite_months("facts", "changing", old, "price_date", ("symbol",))
    months = set(jobs.months_of(new.where(~early), "price_date"))
    schema = lake.stored(new.schema)
    current = lake.fact("changing", schema, lambda part: part.month in months).drop("yyyymm")
    merged = replace_by_key(current, new.where(~early), ["symbol", "price_date"])
    lake.overwrite_months("facts", "changing", merged, "price_date", ("symbol",))
    return lake.fact("changing", schema).drop("yyyymm")


@trial(
    "a13_contract",
    """SELECT * FROM (VALUES ('bank_basic_info', '', 'table is missing'), ('holders', 'shares', 'is double, not decimal(22,2)'),
         ('stock_daily_price', 'volume', 'column is missing')) AS r(table_name, column_name, problem)
       WHERE EXISTS (SELECT 1 FROM lineitem)""",
)
def a13_contract(spark, sf_dir):
    """The contract of stored landing tables: a missing table, a missing column and another type are reported."""
    lake = new_lake(spark, "contract")
    market = {name: rows for name, rows in st.market(spark, sf_dir).items() if name != BASIC_INFO.name}
    for name, rows in market.items():
        land(lake, TABLES[name], rows)
    found: dict[str, DataFrame | None] = {name: lake.landing(TABLES[name]) for name in market}
    found[HOLDERS.name] = found[HOLDERS.name].withColumn("shares", F.col("shares").cast("double"))
    found[DAILY_PRICE.name] = found[DAILY_PRICE.name].drop("volume")
    found[BASIC_INFO.name] = None
    return contract_report(spark, found, {name: spec.schema for name, spec in TABLES.items()})


@trial(
    "c7_screened_universe",
    """WITH quotes AS (
         SELECT 'C' || CAST(c_custkey AS VARCHAR) AS symbol, CASE WHEN n_nationkey = 24 THEN 'us' ELSE lower(n_name) END AS region,
           CASE WHEN c_mktsegment = 'BUILDING' THEN 'Industrials' ELSE 'Financial Services' END AS sector,
           CASE c_nationkey % 4 WHEN 0 THEN 'NMS' WHEN 1 THEN 'ASE' WHEN 2 THEN 'PNK' ELSE 'NYQ' END AS exchange,
           CASE WHEN c_mktsegment IN ('MACHINERY', 'FURNITURE') THEN c_mktsegment ELSE c_mktsegment || ' banks' END AS industry,
           c_acctbal AS market_cap
         FROM customer JOIN nation ON c_nationkey = n_nationkey)
       SELECT symbol, industry, exchange, CAST(market_cap AS DOUBLE) AS market_cap FROM quotes
       WHERE region = 'us' AND sector = 'Financial Services' AND (exchange BETWEEN 'NMS' AND 'NYQ' OR exchange = 'ASE')
         AND contains(upper(industry), 'BANK') ORDER BY market_cap DESC, symbol LIMIT 25""",
)
def c7_screened_universe(spark, sf_dir):
    """The literal screen (region, sector, exchange range, industry word) over customers as quotes, then the 25 largest."""
    customer, nation = st.table(spark, sf_dir, "customer"), st.table(spark, sf_dir, "nation")
    segment, place = F.col("c_mktsegment"), F.col("c_nationkey") % 4
    quotes = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        st.tagged("C", "c_custkey").alias("symbol"),
        F.when(F.col("n_nationkey") == 24, "us").otherwise(F.lower("n_name")).alias("region"),
        F.when(segment == "BUILDING", "Industrials").otherwise("Financial Services").alias("sector"),
        F.when(place == 0, "NMS").when(place == 1, "ASE").when(place == 2, "PNK").otherwise("NYQ").alias("exchange"),
        F.when(segment.isin("MACHINERY", "FURNITURE"), segment).otherwise(F.concat(segment, F.lit(" banks"))).alias("industry"),
        F.col("c_acctbal").alias("market_cap"),
    )
    chosen = ranked_universe(quotes, screen(), industry_match(), "market_cap", "symbol")
    return chosen.select("symbol", "industry", "exchange", "market_cap")
