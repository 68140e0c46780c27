"""Trials of stored layers and whole jobs.

Each one writes its tables below a fresh folder of the shared directory and
returns what a reader finds there.
"""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.incremental import Decision
from tidemark.operators.versioning import latest_by_key, version_counts
from tidemark.plans import jobs
from tidemark.plans.landing import Batch
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
    RATINGS,
    TABLES,
    VERSION_ORDER,
)
from tidemark.session import scratch_path
from tidemark.sources.envelopes import read_envelopes, write_envelopes
from tidemark.sources.lake import Lake
from tidemark.sources.watermark import WatermarkStore
from tidemark.streaming.ingest import curate_stream, ingest_stream
from tidemark.trials import documents as docs, standins as st, trial
from tidemark.trials.compare import rendered
from tidemark.trials.mappings import BATCH
from tidemark.trials.models import MART_COLUMNS, MART_SQL, NEWEST, daily_mart, latest_sql

_RATING_COLUMNS = (
    "symbol:s rating_date:d firm_name:s to_grade:s from_grade:s rating_action:s recommendation_score:n "
    "ingested_at:t source_system:s batch_id:s"
)
_CUT = "2024-01-25"
_NEWEST_RATINGS = latest_sql("event_ratings", "symbol, rating_date, firm_name", NEWEST)
WINDOW = jobs.Window(*st.WINDOW, years=(1996, 1997))
RUN_AT = datetime(2024, 2, 1, tzinfo=timezone.utc)


def new_lake(spark, label: str) -> Lake:
    return Lake(spark, scratch_path(spark, label))


def split_ratings(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Versions before and from a day; keys of the later part get new versions too."""
    ratings = st.event_ratings(spark, sf_dir)
    cut = F.lit(_CUT).cast("date")
    return ratings.where(F.col("rating_date") < cut), ratings.where(F.col("rating_date") >= cut)


def fill_landing(lake: Lake, tables: dict[str, DataFrame]) -> None:
    """Store landing tables: one row per key, as landing holds them."""
    for name, rows in tables.items():
        spec = TABLES[name]
        place = [c for c in st.PLACE if c in rows.columns]
        current = latest_by_key(rows, [*place, *spec.key], VERSION_ORDER).drop(*place)
        lake.overwrite_months(
            "landing", name, current, spec.date_column, spec.sort_columns, by_month=bool(place), keyed=True
        )


@trial(
    "a5_staging_append",
    rendered(_RATING_COLUMNS + " yyyymm:i", "SELECT *, year(rating_date) * 100 + month(rating_date) AS yyyymm FROM event_ratings", st.EVENT_RATINGS_SQL),
)
def a5_staging_append(spark, sf_dir):
    """All versions appended in two loads to the month-partitioned staging table."""
    lake = new_lake(spark, "append")
    for part in split_ratings(spark, sf_dir):
        jobs.stage_increment(lake, RATINGS, part)
    return lake.staging(RATINGS)


@trial("a6_curated_months", rendered(_RATING_COLUMNS, _NEWEST_RATINGS, st.EVENT_RATINGS_SQL))
def a6_curated_months(spark, sf_dir):
    """Curated rebuilt only for the months of each load."""
    lake = new_lake(spark, "curated")
    for part in split_ratings(spark, sf_dir):
        jobs.refresh_curated(lake, RATINGS, {p.month for p in jobs.stage_increment(lake, RATINGS, part)})
    return lake.curated(RATINGS).select(*RATINGS.columns)


@trial(
    "a6_curated_holders",
    rendered(
        "symbol:s holder_type:s holder_name:s holdings_date:d shares:n market_value:n batch_id:s",
        "SELECT * FROM line_holders",
        st.LINE_HOLDERS_SQL,
    ),
)
def a6_curated_holders(spark, sf_dir):
    """Seven years of months, staged twice; the second copy changes nothing."""
    lake = new_lake(spark, "holders")
    fill_landing(lake, {HOLDERS.name: st.line_holders(spark, sf_dir, dealt=True)})
    for _ in range(2):
        staged = jobs.stage_increment(lake, HOLDERS, lake.landing(HOLDERS), by_month=True)
    jobs.refresh_curated(lake, HOLDERS, {p.month for p in staged})
    kept = ("symbol", "holder_type", "holder_name", "holdings_date", "shares", "market_value", "batch_id")
    return lake.curated(HOLDERS).select(*kept)


@trial(
    "a10_published_mart",
    rendered(
        MART_COLUMNS,
        "SELECT * FROM mart",
        f"{st.DAILY_SQL}, {st.SUPPLIER_PROFILES_SQL}, {MART_SQL.format(source='daily')}",
    ),
)
def a10_published_mart(spark, sf_dir):
    """Two full rebuilds; readers find the second generation."""
    lake = new_lake(spark, "mart")
    lake.publish(MONTHLY_MART_NAME, daily_mart(spark, sf_dir).withColumn("avg_volume", F.lit(0.0)))
    lake.publish(MONTHLY_MART_NAME, daily_mart(spark, sf_dir), ("symbol", "year", "month"))
    return lake.published(MONTHLY_MART_NAME, MONTHLY_MART_SCHEMA)


@trial(
    "a11_staging_view",
    rendered(
        "holder_type:s positions:i shares:n",
        """SELECT CASE lower(holder_type) WHEN 'fund' THEN 'mutual_fund' ELSE lower(holder_type) END AS holder_type,
             count(*) AS positions, sum(shares) AS shares FROM line_holders GROUP BY 1""",
        st.LINE_HOLDERS_SQL,
    ),
)
def a11_staging_view(spark, sf_dir):
    """A staging model as a named view, queried in SQL."""
    from tidemark.plans.models import staging_view

    Lake.create_view(staging_view(st.line_holders(spark, sf_dir), HOLDERS), HOLDERS.staging_name)
    return spark.sql(
        "SELECT holder_type, count(*) AS positions, sum(shares) AS shares FROM stg_holders GROUP BY holder_type"
    )


_KEYS = "count(DISTINCT (user_id, event_type, CAST(ts AS DATE)))"


@trial(
    "a16_compaction",
    f"""SELECT 'before' AS state, CAST(2 * count(*) AS BIGINT) AS physical_rows, CAST({_KEYS} AS BIGINT) AS logical_rows FROM events
        UNION ALL SELECT 'after', CAST({_KEYS} AS BIGINT), CAST({_KEYS} AS BIGINT) FROM events""",
)
def a16_compaction(spark, sf_dir):
    """Staging loaded twice, counted, compacted and counted again."""
    lake = new_lake(spark, "compaction")
    ratings = st.event_ratings(spark, sf_dir)
    months = {p.month for _ in range(2) for p in jobs.stage_increment(lake, RATINGS, ratings)}
    before = version_counts(lake.staging(RATINGS), RATINGS.key).withColumn("state", F.lit("before"))
    counted = lake.spark.createDataFrame(before.collect(), before.schema)  # one row
    jobs.compact_staging(lake, RATINGS, months)
    after = version_counts(lake.staging(RATINGS), RATINGS.key).withColumn("state", F.lit("after"))
    return counted.unionByName(after)


# Ingest and sync --------------------------------------------------------------

_LANDED_SQL = """SELECT 'U' || CAST(user_id AS VARCHAR) AS symbol, CAST(ts AS DATE) AS rating_date, event_type AS firm_name,
    'G' || regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS to_grade, event_type AS rating_action,
    CAST(CAST(value AS DECIMAL(8,4)) AS DOUBLE) AS recommendation_score
  FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY event_id DESC) = 1"""
_LANDED_COLUMNS = ("symbol", "rating_date", "firm_name", "to_grade", "rating_action", "recommendation_score")
_LANDED = f"SELECT * REPLACE (CAST(rating_date AS VARCHAR) AS rating_date) FROM ({_LANDED_SQL}) AS l"


@trial("p1_ingest_ratings", _LANDED)
def p1_ingest_ratings(spark, sf_dir):
    """A file batch into landing; of a repeated key the last record wins."""
    lake = new_lake(spark, "ingest")
    path = write_envelopes(docs.rating_envelopes(spark, sf_dir), scratch_path(spark, "batch"), BATCH.batch_id)
    jobs.ingest_batch(lake, read_envelopes(spark, path), BATCH)
    return lake.landing(RATINGS).select(*_LANDED_COLUMNS)


@trial(
    "p1_ingest_reports",
    """SELECT 'rows' AS report, 'stock_daily_price' AS name, CAST(count(*) AS BIGINT) AS n FROM lineitem
         WHERE l_orderkey % 9 <> 0 AND l_orderkey % 7 <> 0 AND l_orderkey % 5 <> 0 AND l_orderkey % 3 <> 0
       UNION ALL
       SELECT 'skipped', reason, CAST(count(*) AS BIGINT) FROM (
         SELECT CASE WHEN l_orderkey % 9 = 0 THEN 'unknown_dataset' WHEN l_orderkey % 7 = 0 THEN 'missing_symbol'
                     WHEN l_orderkey % 5 = 0 THEN 'missing_date' WHEN l_orderkey % 3 = 0 THEN 'missing_ohlcv' END AS reason
         FROM lineitem) AS l WHERE reason IS NOT NULL GROUP BY reason
       UNION ALL
       SELECT 'datasets', CASE WHEN l_orderkey % 9 = 0 THEN 'NONE' ELSE 'daily_prices' END, CAST(count(*) AS BIGINT)
       FROM lineitem GROUP BY 2""",
)
def p1_ingest_reports(spark, sf_dir):
    """What a batch reports: rows per table, skips per reason, records per dataset."""
    lake = new_lake(spark, "reports")
    path = write_envelopes(docs.price_envelopes(spark, sf_dir), scratch_path(spark, "batch"), "prices")
    reports = jobs.ingest_batch(lake, read_envelopes(spark, path), BATCH)
    rows = reports["rows"].groupBy(F.col("table_name").alias("name")).agg(F.sum("row_count").alias("n"))
    skipped = reports["skipped"].select(F.col("skip_reason").alias("name"), F.col("skipped").alias("n"))
    datasets = reports["datasets"].select(F.col("dataset").alias("name"), F.col("record_count").alias("n"))
    parts = [("rows", rows), ("skipped", skipped), ("datasets", datasets)]
    labelled = [df.select(F.lit(label).alias("report"), "name", "n") for label, df in parts]
    return labelled[0].unionByName(labelled[1]).unionByName(labelled[2])


@trial("p1_ingest_stream", _LANDED)
def p1_ingest_stream(spark, sf_dir):
    """The same records as a stream of files, one micro-batch per load."""
    lake = new_lake(spark, "ingest-stream")
    source = scratch_path(spark, "arriving")
    envelopes = docs.rating_envelopes(spark, sf_dir)
    halves = (F.col("record_date") < F.lit(_CUT).cast("date"), F.col("record_date") >= F.lit(_CUT).cast("date"))
    checkpoint = scratch_path(spark, "stream-state")
    for number, half in enumerate(halves):
        write_envelopes(envelopes.where(half), source, f"load-{number}")
        ingest_stream(
            lake,
            f"{source}/*",
            checkpoint,
            source_system="stream",
            snapshot_date=date(2024, 2, 1),
            ingested_at=lambda n: datetime(2024, 2, 1, 7, n, tzinfo=timezone.utc),
        ).awaitTermination()
    return lake.landing(RATINGS).select(*_LANDED_COLUMNS)


_TWO_LOADS = _LANDED.replace("ORDER BY event_id DESC", "ORDER BY event_id % 2 DESC, event_id DESC")


def _two_loads(spark, sf_dir) -> str:
    """Even events as an older load, odd ones as a newer one; both are numbered from 1 and share keys."""
    root = scratch_path(spark, "two-loads")
    event = F.col("seq")
    for number in range(2):
        load = docs.rating_envelopes(spark, sf_dir).where(event % 2 == number)
        at = F.lit(datetime(2024, 2, 1, number + 1, tzinfo=timezone.utc))
        write_envelopes(
            load.withColumn("load_timestamp", at).withColumn("seq", F.floor(event / 2) + 1), root, f"load-{number}"
        )
    return f"{root}/*"


@trial("p1_ingest_two_loads", _TWO_LOADS)
def p1_ingest_two_loads(spark, sf_dir):
    """Two loads in one batch: the newer load's record of a key wins, whatever its number."""
    lake = new_lake(spark, "two-loads")
    jobs.ingest_batch(lake, read_envelopes(spark, _two_loads(spark, sf_dir)), BATCH)
    return lake.landing(RATINGS).select(*_LANDED_COLUMNS)


@trial("p1_ingest_two_loads_stream", _TWO_LOADS)
def p1_ingest_two_loads_stream(spark, sf_dir):
    """The same loads in one micro-batch."""
    lake = new_lake(spark, "two-loads-stream")
    ingest_stream(
        lake,
        _two_loads(spark, sf_dir),
        scratch_path(spark, "stream-state"),
        source_system="stream",
        snapshot_date=date(2024, 2, 1),
        ingested_at=lambda n: datetime(2024, 2, 1, 7, n, tzinfo=timezone.utc),
    ).awaitTermination()
    return lake.landing(RATINGS).select(*_LANDED_COLUMNS)


@trial("j3_incremental_sync", rendered(_RATING_COLUMNS, _NEWEST_RATINGS, st.EVENT_RATINGS_SQL))
def j3_incremental_sync(spark, sf_dir):
    """Landing filled and synced twice; the second pull starts after the first's newest row."""
    lake = new_lake(spark, "sync")
    state = WatermarkStore(spark, f"{lake.root}/state")
    filled = []
    for part in split_ratings(spark, sf_dir):
        filled.append(part)
        everything = filled[0] if len(filled) == 1 else filled[0].unionByName(filled[1])
        fill_landing(lake, {RATINGS.name: everything})
        plan = jobs.detect_new(lake, state, "sync")
        jobs.sync_increment(lake, plan.start_after)
        state.commit("sync", plan.latest)
    return lake.curated(RATINGS).select(*RATINGS.columns)


@trial("j3_curate_stream", rendered(_RATING_COLUMNS, _NEWEST_RATINGS, st.EVENT_RATINGS_SQL))
def j3_curate_stream(spark, sf_dir):
    """Landed rows as a file stream into staging and curated, in several micro-batches."""
    lake = new_lake(spark, "curate-stream")
    feed = scratch_path(spark, "feed")
    for part in split_ratings(spark, sf_dir):
        part.write.mode("append").parquet(feed)
    curate_stream(lake, RATINGS, feed, scratch_path(spark, "stream-state"), files_per_trigger=4).awaitTermination()
    return lake.curated(RATINGS).select(*RATINGS.columns)


_LATEST_SQL = (
    "(SELECT max(m) FROM ("
    + " UNION ALL ".join(f"SELECT max(ingested_at) AS m FROM {n}" for n in st.MARKET_NAMES.values())
    + ") AS maxima)"
)


@trial(
    "j1_decisions",
    f"""WITH {st.MARKET_SQL} SELECT step, decision, strftime({_LATEST_SQL}, '%Y-%m-%d %H:%M:%S.%f') AS latest
        FROM (VALUES (1, 'NEW'), (2, 'RESYNC'), (3, 'SKIP'), (4, 'NEW')) AS d(step, decision)
        UNION ALL SELECT 0, 'EMPTY', NULL""",
)
def j1_decisions(spark, sf_dir):
    """Empty landing, new rows, staging lost, nothing new, watermark behind."""
    lake = new_lake(spark, "decisions")
    state = WatermarkStore(spark, f"{lake.root}/state")
    plans = [jobs.detect_new(lake, state, "main")]
    fill_landing(lake, st.market(spark, sf_dir, dealt=True))
    plans.append(jobs.detect_new(lake, state, "main"))
    state.commit("main", plans[-1].latest)
    plans.append(jobs.detect_new(lake, state, "main"))
    jobs.sync_increment(lake, plans[-1].start_after)
    plans.append(jobs.detect_new(lake, state, "main"))
    plans.append(jobs.detect_new(lake, state, "another job"))
    rows = [(step, p.decision.value, p.latest) for step, p in enumerate(plans)]
    return spark.createDataFrame(rows, "step bigint, decision string, latest timestamp")


# Whole refreshes --------------------------------------------------------------

_CURATED_PROFILES = latest_sql("order_profiles", "symbol, snapshot_date", NEWEST)
_FULL_MART_SQL = MART_SQL.format(source="daily").replace(
    "FROM supplier_profiles GROUP BY symbol", f"FROM ({_CURATED_PROFILES}) AS p GROUP BY symbol"
)


def refreshed(spark, sf_dir, label: str, runs: int = 1):
    """A lake after P6 on the market tables; repeat runs must skip."""
    lake = new_lake(spark, label)
    state = WatermarkStore(spark, f"{lake.root}/state")
    fill_landing(lake, clean_market(spark, sf_dir))
    decisions = [jobs.refresh_from_landing(lake, state, "main", RUN_AT, WINDOW) for _ in range(runs)]
    assert decisions[0] is Decision.NEW and all(d is Decision.SKIP for d in decisions[1:]), decisions
    return lake


def clean_market(spark, sf_dir) -> dict[str, DataFrame]:
    """The market tables with loads of the last day, so that the freshness check passes."""
    loaded = F.lit("2024-01-31T12:00:00Z").cast("timestamp")
    return {name: df.withColumn("ingested_at", loaded) for name, df in st.market(spark, sf_dir, dealt=True).items()}


@trial(
    "p6_refresh_mart",
    rendered(
        MART_COLUMNS,
        "SELECT * FROM mart",
        f"{st.DAILY_SQL}, {st.ORDER_PROFILES_SQL}, {_FULL_MART_SQL}",
    ),
)
def p6_refresh_mart(spark, sf_dir):
    """Landing to staging, curated, models, checks, mart and gates; the second run skips."""
    lake = refreshed(spark, sf_dir, "refresh", runs=2)
    return lake.monthly(MONTHLY_MART_NAME, MONTHLY_MART_SCHEMA)


@trial(
    "p3_models",
    rendered(
        "symbol:s month_date:d avg_open_price:n avg_close_price:n avg_volume:n country:s",
        """SELECT m.*, 'UNKNOWN' AS country FROM (
             SELECT symbol, date_trunc('month', price_date) AS month_date,
               CAST(sum(open_price) AS DOUBLE) / count(open_price) AS avg_open_price,
               CAST(sum(close_price) AS DOUBLE) / count(close_price) AS avg_close_price,
               CAST(sum(volume) AS DOUBLE) / count(volume) AS avg_volume
             FROM daily WHERE open_price >= 0 AND close_price >= 0 AND volume >= 0 GROUP BY ALL) AS m""",
        st.DAILY_SQL,
    ),
)
def p3_models(spark, sf_dir):
    """Views, dimension, facts and monthly summary with all their checks (P3); the summary beside its dimension row."""
    lake = new_lake(spark, "models")
    fill_landing(lake, clean_market(spark, sf_dir))
    jobs.build_models(lake, RUN_AT)
    summary = lake.monthly(MONTHLY_SUMMARY_NAME, MONTHLY_SUMMARY_SCHEMA)
    dimension = lake.published(DIMENSION_NAME, DIMENSION_SCHEMA)
    return summary.join(dimension.select("symbol", "country"), "symbol")


@trial(
    "p5_full_refresh",
    rendered(
        "symbol:s year:i month:i trading_days_count:i source_row_count:i avg_open_price:n avg_volume:n company_name:s",
        """SELECT symbol, year(price_date) AS year, month(price_date) AS month, count(*) AS trading_days_count,
             count(*) AS source_row_count, CAST(sum(close_price) AS DOUBLE) / count(*) AS avg_open_price,
             CAST(sum(volume) AS DOUBLE) / count(*) AS avg_volume, 'Supplier ' || symbol AS company_name
           FROM daily WHERE price_date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31' GROUP BY ALL""",
        st.DAILY_SQL,
    ),
)
def p5_full_refresh(spark, sf_dir):
    """Files of profile and price records through every layer to the mart (P5)."""
    daily = st.daily_prices(spark, sf_dir)
    close = F.col("close_price")
    blank = F.lit(None).cast("date")
    prices = daily.select(
        F.lit("daily_prices").alias("dataset"),
        F.lower("symbol").alias("symbol"),
        F.col("price_date").alias("record_date"),
        docs.document(
            F.struct(
                close.alias("open"), docs.raw(close).alias("high"), close.cast("string").alias("low"), close.alias("close"), "volume"
            )
        ).alias("payload"),
    )
    profiles = daily.select("symbol").distinct().select(
        F.lit("basics").alias("dataset"),
        "symbol",
        blank.alias("record_date"),
        docs.document(F.struct(F.concat(F.lit(" Supplier "), "symbol").alias("company_name"))).alias("payload"),
    )
    envelopes = prices.unionByName(profiles).select(
        "*",
        F.lit(None).cast("string").alias("source"),
        F.lit(RUN_AT).alias("load_timestamp"),
        F.lit(None).cast("bigint").alias("seq"),
    )
    path = write_envelopes(envelopes, scratch_path(spark, "batch"), "full")
    lake = new_lake(spark, "full")
    state = WatermarkStore(spark, f"{lake.root}/state")
    batch = Batch("full", date(2024, 2, 1), RUN_AT, "files")
    decision = jobs.full_refresh(lake, state, "main", path, batch, WINDOW)
    assert decision is Decision.NEW
    mart = lake.monthly(MONTHLY_MART_NAME, MONTHLY_MART_SCHEMA)
    kept = ("symbol", "year", "month", "trading_days_count", "source_row_count", "avg_open_price", "avg_volume", "company_name")
    return mart.select(*kept)


@trial(
    "p7_dimension_history",
    f"""WITH {st.ORDER_PROFILES_SQL},
        cuts AS (SELECT *, 1 AS run FROM order_profiles WHERE snapshot_date <= DATE '1998-06-30'
                 UNION ALL SELECT *, 2 AS run FROM order_profiles WHERE country <> 'ASIA'),
        newest AS ({latest_sql("cuts", "symbol, run", "snapshot_date DESC, ingested_at DESC")}),
        pairs AS (SELECT coalesce(a.symbol, b.symbol) AS symbol, a.batch_id AS b1, a.ingested_at AS i1,
                    b.batch_id AS b2, b.ingested_at AS i2
                  FROM (SELECT * FROM newest WHERE run = 1) AS a
                  FULL JOIN (SELECT * FROM newest WHERE run = 2) AS b ON a.symbol = b.symbol)
        SELECT symbol, b1 AS batch_id, strftime(i1, '%Y-%m-%d %H:%M:%S.%f') AS valid_from,
          strftime(CASE WHEN i2 IS NULL THEN TIMESTAMP '2002-01-02 00:00:00' WHEN i2 > i1 THEN i2 END,
                   '%Y-%m-%d %H:%M:%S.%f') AS valid_to FROM pairs WHERE i1 IS NOT NULL
        UNION ALL SELECT symbol, b2, strftime(i2, '%Y-%m-%d %H:%M:%S.%f'), NULL FROM pairs
        WHERE i2 IS NOT NULL AND (i1 IS NULL OR i2 > i1)""",
)
def p7_dimension_history(spark, sf_dir):
    """Two snapshots of a published dimension, the second without one region's customers.

    A third run without changes adds nothing.
    """
    lake = new_lake(spark, "history")
    profiles = st.order_profiles(spark, sf_dir)
    cut = F.col("snapshot_date") <= F.lit("1998-06-30").cast("date")
    states = (profiles.where(cut), profiles.where(F.col("country") != "ASIA"))
    for day, rows in enumerate(states, start=1):
        newest = latest_by_key(rows, ["symbol"], ["snapshot_date", "ingested_at"])
        lake.publish(DIMENSION_NAME, newest.select(*DIMENSION_SCHEMA.fieldNames()))
        jobs.snapshot_dimension(lake, datetime(2002, 1, day, tzinfo=timezone.utc))
    jobs.snapshot_dimension(lake, datetime(2002, 1, 3, tzinfo=timezone.utc))
    return jobs.read_history(lake).select("symbol", "batch_id", "valid_from", "valid_to")


@trial(
    "j8_replay",
    rendered(
        "symbol:s snapshot_date:d company_name:s market_cap:n",
        _CURATED_PROFILES,
        st.ORDER_PROFILES_SQL,
    ),
)
def j8_replay(spark, sf_dir):
    """A load repeated from the start leaves curated as it was."""
    lake = new_lake(spark, "replay")
    fill_landing(lake, {BASIC_INFO.name: st.order_profiles(spark, sf_dir, dealt=True)})
    for _ in range(2):
        jobs.sync_increment(lake, datetime(1970, 1, 1, tzinfo=timezone.utc))
    return lake.curated(BASIC_INFO).select("symbol", "snapshot_date", "company_name", "market_cap")


