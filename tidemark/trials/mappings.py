"""Trials of envelopes, mappers, scalar functions and the second source (A1, A2, B, P8)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tidemark.functions import scalars, variants
from tidemark.operators.fallback import merge_sources
from tidemark.operators.filters import accepted, skip_counts, tag_skips, unknown_dataset
from tidemark.operators.universe import batch_numbers
from tidemark.plans import jobs, landing, models, payloads, second_source
from tidemark.registry import RATINGS
from tidemark.session import scratch_path
from tidemark.sources.envelopes import read_envelopes, safe_batch_name_column, with_arrival, write_envelopes
from tidemark.trials import documents as docs, standins as st, trial
from tidemark.trials.compare import rendered

BATCH = landing.Batch("run/2024-02-01", date(2024, 2, 1), "2024-02-01T07:30:00Z", "trial")
_AUDIT = "TIMESTAMP '2024-02-01 07:30:00' AS ingested_at, 'trial' AS source_system, 'run/2024-02-01' AS batch_id"
_AUDIT_COLUMNS = "ingested_at:t source_system:s batch_id:s"


def _loaded(rows):
    return accepted(rows).drop(landing.ARRIVAL, landing.ELEMENT)


@trial(
    "a1_envelope_round_trip",
    rendered(
        "dataset:s symbol:s record_date:d firm:s score:n source:s load_timestamp:t seq:i",
        """SELECT 'ratings' AS dataset, 'u' || CAST(user_id AS VARCHAR) AS symbol, CAST(ts AS DATE) AS record_date,
             event_type AS firm, CAST(value AS DECIMAL(18,6)) AS score,
             CASE WHEN event_id % 2 = 0 THEN 'feed' ELSE 'yahoo_finance' END AS source, ts AS load_timestamp, event_id AS seq
           FROM events""",
    ),
)
def a1_envelope_round_trip(spark, sf_dir):
    """Records written as JSON lines and read back; the source is filled (A1, A2)."""
    path = write_envelopes(docs.rating_envelopes(spark, sf_dir), scratch_path(spark, "envelopes"), "run/2024:02")
    return read_envelopes(spark, path).select(
        "dataset",
        "symbol",
        "record_date",
        variants.path_text("payload", "$.firm").alias("firm"),
        variants.unwrap_decimal("payload", "$.recommendation_score", 18, 6).alias("score"),
        "source",
        "load_timestamp",
        "seq",
    )


@trial(
    "a2_safe_batch_names",
    "SELECT c_custkey, regexp_replace(c_name || ' ' || c_mktsegment, '[^A-Za-z0-9_.-]', '_', 'g') AS batch_name FROM customer",
)
def a2_safe_batch_names(spark, sf_dir):
    name = F.concat_ws(" ", "c_name", "c_mktsegment")
    return st.table(spark, sf_dir, "customer").select("c_custkey", safe_batch_name_column(name).alias("batch_name"))


@trial(
    "b1_first_result",
    "SELECT c_custkey, c_custkey % 5 <> 4 AS has_result, CASE WHEN c_custkey % 5 <> 4 THEN n_name END AS city "
    "FROM customer JOIN nation ON c_nationkey = n_nationkey",
)
def b1_first_result(spark, sf_dir):
    found = docs.profile_documents(spark, sf_dir).withColumn("r", variants.first_result("payload", "quoteSummary"))
    return found.select(
        F.col("seq").alias("c_custkey"),
        F.col("r").isNotNull().alias("has_result"),
        variants.path_text("r", "$.assetProfile.city").alias("city"),
    )


@trial(
    "b2_unwrapped_numbers",
    """SELECT event_id, CASE WHEN event_id % 4 < 2 THEN CAST(k AS DOUBLE) WHEN event_id % 4 = 2 THEN k + 0.5 END AS amount,
         CASE WHEN event_id % 4 < 2 THEN CAST(k AS DOUBLE) END AS whole,
         CASE WHEN event_id % 4 < 2 THEN CAST(DATE '1970-01-01' + CAST(k AS INTEGER) AS VARCHAR) END AS day
       FROM (SELECT event_id, CAST(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS INTEGER) AS k FROM events) AS e""",
)
def b2_unwrapped_numbers(spark, sf_dir):
    """A number bare, wrapped, as text with a fraction, or unreadable."""
    kind = F.col("event_id") % 4
    k = F.get_json_object("props", "$.k")
    text = (
        F.when(kind == 0, F.col("props"))
        .when(kind == 1, F.concat(F.lit('{"k": {"raw": '), k, F.lit("}}")))
        .when(kind == 2, F.concat(F.lit('{"k": "'), k, F.lit('.5"}')))
        .otherwise(F.concat(F.lit('{"k": "'), k, F.lit(',000"}')))
    )
    v = st.table(spark, sf_dir, "events").select("event_id", F.parse_json(text).alias("v"))
    seconds = variants.unwrap_long("v", "$.k") * 86400
    return v.select(
        "event_id",
        variants.unwrap_decimal("v", "$.k", 18, 6).alias("amount"),
        variants.unwrap_long("v", "$.k").cast("double").alias("whole"),
        variants.epoch_date(seconds).alias("day"),
    )


@trial(
    "b3_profiles",
    rendered(
        "symbol:s snapshot_date:d company_name:s industry:s sector:s employee_count:i city:s phone:s country:s "
        f"address:s market_cap:n currency:s exchange:s {_AUDIT_COLUMNS}",
        f"SELECT *, DATE '2024-02-01' AS snapshot_date, CAST(NULL AS VARCHAR) AS phone, {_AUDIT} FROM profile_rows",
        f"{docs.CUSTOMERS_SQL}, {docs.PROFILE_ROWS_SQL}",
    ),
)
def b3_profiles(spark, sf_dir):
    """Documents to profile rows, hollow ones dropped."""
    records = payloads.profile_records(docs.profile_documents(spark, sf_dir))
    return _loaded(landing.profile_rows(with_arrival(records), BATCH)).drop("state", "website")


@trial(
    "b4_statements",
    rendered(
        "symbol:s statement_date:d period_type:s total_assets:n total_debt:n invested_capital:n shares_issued:n "
        f"currency:s {_AUDIT_COLUMNS}",
        f"SELECT *, CAST(NULL AS VARCHAR) AS currency, {_AUDIT} FROM statement_rows",
        f"{st.ORDER_FUNDAMENTALS_SQL}, {docs.STATEMENT_ROWS_SQL}",
    ),
)
def b4_statements(spark, sf_dir):
    """Statements, headline fill for zeros, and the trailing row."""
    records = payloads.statement_records(docs.statement_documents(spark, sf_dir))
    return _loaded(landing.fundamental_rows(with_arrival(records), BATCH))


@trial(
    "b5_ownership",
    rendered(
        f"symbol:s holder_type:s holder_name:s holdings_date:d shares:n market_value:n pct_outstanding:n {_AUDIT_COLUMNS}",
        f"SELECT *, CAST(NULL AS DOUBLE) AS pct_outstanding, {_AUDIT} FROM ownership_rows",
        docs.OWNERSHIP_ROWS_SQL,
    ),
)
def b5_ownership(spark, sf_dir):
    records = payloads.ownership_records(docs.ownership_documents(spark, sf_dir))
    return _loaded(landing.holder_rows(with_arrival(records), BATCH))


@trial(
    "b6_grades",
    rendered(
        f"symbol:s rating_date:d firm_name:s to_grade:s from_grade:s rating_action:s recommendation_score:n {_AUDIT_COLUMNS}",
        f"""SELECT symbol, rating_date, firm_name, to_grade, CAST(NULL AS VARCHAR) AS from_grade, rating_action,
              CAST(NULL AS DOUBLE) AS recommendation_score, {_AUDIT} FROM grade_rows""",
        docs.GRADE_ROWS_SQL,
    ),
)
def b6_grades(spark, sf_dir):
    records = payloads.grade_records(docs.grade_documents(spark, sf_dir))
    return _loaded(landing.rating_rows(with_arrival(records), BATCH))


@trial(
    "b7_charts",
    rendered(
        "symbol:s price_date:d open_price:n high_price:n low_price:n close_price:n adjusted_close:n volume:i "
        + _AUDIT_COLUMNS,
        f"SELECT *, CAST(NULL AS DOUBLE) AS adjusted_close, {_AUDIT} FROM chart_rows",
        f"{st.DAILY_SQL}, {docs.CHART_ROWS_SQL}",
    ),
)
def b7_charts(spark, sf_dir):
    """Parallel arrays to daily rows inside the window; a short array gives null and a skip."""
    records = payloads.price_records(docs.chart_documents(spark, sf_dir), *st.WINDOW)
    return _loaded(landing.price_rows(with_arrival(records), BATCH))


_YEARS = [f"{y}-12-31" for y in range(1995, 2002)]
_WIDE_SQL = """yearly AS (
  SELECT 'C' || CAST(o_custkey AS VARCHAR) AS symbol, make_date(year(o_orderdate), 12, 31) AS period_end,
    sum(CAST(o_totalprice AS DECIMAL(18,2))) AS assets,
    sum(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS debt
  FROM orders GROUP BY ALL)"""


def _wide_statement(spark, sf_dir):
    """One row per customer and metric, one column per year end."""
    amount = F.col("o_totalprice").cast("decimal(18,2)")
    yearly = (
        st.table(spark, sf_dir, "orders")
        .groupBy(st.tagged("C", "o_custkey").alias("symbol"), F.year("o_orderdate").alias("year"))
        .agg(
            F.sum(amount).cast("double").alias("Total Assets"),
            F.sum(F.when(F.col("o_orderstatus") == "F", amount)).cast("double").alias("Total Debt"),
            F.count(F.lit(1)).cast("double").alias("Order Count"),
        )
    )
    long = yearly.unpivot(["symbol", "year"], ["Total Assets", "Total Debt", "Order Count"], "metric", "amount")
    year_end = F.concat(F.col("year").cast("string"), F.lit("-12-31"))
    return long.withColumn("period", year_end).groupBy("symbol", "metric").pivot("period", _YEARS).agg(F.max("amount"))


@trial(
    "b8_statement_periods",
    rendered("symbol:s period_end:d totalAssets:n totalDebt:n", "SELECT symbol, period_end, assets AS totalAssets, debt AS totalDebt FROM yearly", _WIDE_SQL),
)
def b8_statement_periods(spark, sf_dir):
    """A wide statement turned into one row per period."""
    return second_source.statement_periods(_wide_statement(spark, sf_dir), "metric", _YEARS)


@trial(
    "b9_resolved_columns",
    rendered(
        "symbol:s holder_type:s holder_name:s holdings_date:d shares:n market_value:n",
        """SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS symbol, 'mutual_fund' AS holder_type,
             'H' || CAST(l_partkey AS VARCHAR) AS holder_name, CAST(l_shipdate AS DATE) AS holdings_date,
             CAST(l_quantity AS DECIMAL(22,2)) AS shares, CAST(l_extendedprice AS DECIMAL(22,2)) AS market_value
           FROM lineitem WHERE l_returnflag <> 'N'""",
    ),
)
def b9_resolved_columns(spark, sf_dir):
    """Positions under other column names; those without a holder are dropped."""
    positions = st.table(spark, sf_dir, "lineitem").select(
        st.tagged("s", "l_suppkey").alias("symbol"),
        F.when(F.col("l_returnflag") != "N", st.tagged(" H", "l_partkey")).alias("HOLDER"),
        F.col("l_quantity").alias("shares"),
        F.col("l_shipdate").alias("DATE REPORTED"),
        F.col("l_extendedprice").alias("VALUE"),
        F.col("l_orderkey").alias("seq"),
    )
    rows = landing.holder_rows(with_arrival(second_source.holders_fallback(positions, "mutual_fund")), BATCH)
    return accepted(rows).select("symbol", "holder_type", "holder_name", "holdings_date", "shares", "market_value")


@trial(
    "b10_ratings_fallback",
    rendered(
        "symbol:s rating_date:d firm_name:s to_grade:s recommendation_score:n",
        """SELECT 'U' || CAST(user_id AS VARCHAR) AS symbol, CAST(ts AS DATE) AS rating_date,
             CASE WHEN event_id % 3 = 0 THEN 'UNKNOWN_FIRM' ELSE event_type END AS firm_name,
             event_type AS to_grade, CASE WHEN event_id % 2 = 0 THEN CAST(value AS DECIMAL(8,4)) END AS recommendation_score
           FROM events""",
    ),
)
def b10_ratings_fallback(spark, sf_dir):
    grades = st.table(spark, sf_dir, "events").select(
        st.tagged("u", "user_id").alias("symbol"),
        F.col("ts").alias("Grade Date"),
        F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("FIRM"),
        F.col("event_type").alias("tograde"),
        F.when(F.col("event_id") % 2 == 0, F.col("value")).otherwise(F.lit(float("nan"))).alias("Score"),
        F.col("event_id").alias("seq"),
    )
    rows = landing.rating_rows(with_arrival(second_source.ratings_fallback(grades)), BATCH)
    return accepted(rows).select("symbol", "rating_date", "firm_name", "to_grade", "recommendation_score")


@trial(
    "b10_profile_fallback",
    rendered(
        "symbol:s company_name:s industry:s employee_count:i market_cap:n",
        """SELECT 'C' || CAST(c_custkey AS VARCHAR) AS symbol, c_name AS company_name, c_mktsegment AS industry,
             c_custkey AS employee_count, CAST(abs(c_acctbal) AS DECIMAL(20,2)) AS market_cap
           FROM customer WHERE c_custkey % 3 <> 0""",
    ),
)
def b10_profile_fallback(spark, sf_dir):
    """Profiles under the second source's names; every third one is empty and dropped."""
    key = F.col("c_custkey")
    some = key % 3 != 0
    info = st.table(spark, sf_dir, "customer").select(
        st.tagged(" c", "c_custkey").alias("symbol"),
        F.lit("").alias("longName"),
        F.when(key % 3 == 1, F.col("c_name")).alias("shortName"),
        F.when(key % 3 == 2, F.col("c_name")).alias("displayName"),
        F.when(some, F.col("c_mktsegment")).alias("Industry"),
        F.when(some, key).otherwise(F.lit(0)).alias("fullTimeEmployees"),
        F.when(some, F.abs("c_acctbal")).alias("marketCap"),
        key.alias("seq"),
    )
    rows = landing.profile_rows(with_arrival(second_source.profile_fallback(info)), BATCH)
    return accepted(rows).select("symbol", "company_name", "industry", "employee_count", "market_cap")


@trial(
    "b10_fundamentals_fallback",
    rendered(
        "symbol:s statement_date:d period_type:s total_assets:n total_debt:n shares_issued:n",
        """SELECT 'C' || CAST(c_custkey AS VARCHAR) AS symbol, coalesce(period_end, DATE '2024-02-01') AS statement_date,
             CASE WHEN period_end IS NULL THEN 'ttm' ELSE 'quarterly' END AS period_type,
             assets AS total_assets, debt AS total_debt, c_custkey + 1 AS shares_issued
           FROM customer LEFT JOIN yearly ON symbol = 'C' || CAST(c_custkey AS VARCHAR)""",
        _WIDE_SQL,
    ),
)
def b10_fundamentals_fallback(spark, sf_dir):
    """Periods listed per symbol, headline from the info table, and a trailing row without periods."""
    info = st.table(spark, sf_dir, "customer").select(
        st.tagged("C", "c_custkey").alias("symbol"),
        F.lit(0.0).alias("sharesOutstanding"),
        (F.col("c_custkey") + 1).alias("impliedSharesOutstanding"),
        F.col("c_custkey").alias("seq"),
    )
    periods = second_source.statement_periods(_wide_statement(spark, sf_dir), "metric", _YEARS)
    records = second_source.fundamentals_fallback(info, periods)
    rows = landing.fundamental_rows(with_arrival(records), BATCH)
    return accepted(rows).select(
        "symbol", "statement_date", "period_type", "total_assets", "total_debt", "shares_issued"
    )


@trial(
    "b11_normalised_symbols",
    "SELECT p_partkey, upper(p_name || ' ' || p_brand || ' ' || p_type) AS symbol FROM part",
)
def b11_normalised_symbols(spark, sf_dir):
    padded = F.concat(F.lit("\t  "), F.concat_ws(" ", "p_name", "p_brand", "p_type"), F.lit(" \n"))
    return st.table(spark, sf_dir, "part").select("p_partkey", scalars.normalise_symbol(padded).alias("symbol"))


@trial(
    "b13_content_hash",
    """SELECT c_custkey, sha256('{"c_mktsegment":"' || c_mktsegment || '","c_name":"' || c_name || '","c_nationkey":'
         || CAST(c_nationkey AS VARCHAR) || ',"note":null}') AS version_hash FROM customer""",
)
def b13_content_hash(spark, sf_dir):
    """The hash does not depend on the order of members."""
    payload = docs.document(F.struct("c_nationkey", F.lit(None).cast("string").alias("note"), "c_name", "c_mktsegment"))
    return st.table(spark, sf_dir, "customer").select("c_custkey", scalars.content_hash(payload).alias("version_hash"))


@trial(
    "b17_typed_rows",
    rendered(
        "symbol:s rating_date:d firm_name:s to_grade:s from_grade:s rating_action:s recommendation_score:n " + _AUDIT_COLUMNS,
        "SELECT * FROM event_ratings",
        st.EVENT_RATINGS_SQL,
    ),
)
def b17_typed_rows(spark, sf_dir):
    """Instants of microseconds become milliseconds on the way to staging."""
    return models.staging_rows(st.event_ratings(spark, sf_dir, in_millis=False), RATINGS)


@trial(
    "b18_window_bounds",
    f"""SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date FROM orders
        WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '{st.WINDOW[0]}' AND DATE '{st.WINDOW[1]}'""",
)
def b18_window_bounds(spark, sf_dir):
    """Epoch bounds of a date window: start included, the day after the end excluded."""
    first, beyond = scalars.window_epoch_bounds(*st.WINDOW)
    at = docs.epoch("o_orderdate")
    orders = st.table(spark, sf_dir, "orders").where((at >= first) & (at < beyond))
    return orders.select("o_orderkey", F.to_date("o_orderdate").alias("order_date"))


@trial(
    "b19_batch_numbers",
    """SELECT c_name, CAST(floor((row_number() OVER (ORDER BY c_name) - 1) / 25) + 1 AS BIGINT) AS batch_number FROM customer""",
)
def b19_batch_numbers(spark, sf_dir):
    """All customers in batches of 25 by name, without a global window."""
    return batch_numbers(st.table(spark, sf_dir, "customer").select("c_name"), "c_name", 25)


@trial(
    "b20_symbol_lists",
    """SELECT doc_id, CAST(len(symbols) AS BIGINT) AS n, md5(array_to_string(symbols, '|')) AS joined FROM (
         SELECT doc_id, list_sort(list_distinct(list_filter(list_transform(string_split(text, ','),
           lambda x: upper(regexp_replace(replace(x, 'ß', 'SS'), '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g'))), lambda x: x <> ''))) AS symbols
         FROM documents) AS d""",
)
def b20_symbol_lists(spark, sf_dir):
    """Whole texts split at commas into sorted distinct symbols.

    Upper case of the sharp s is SS, as in Unicode's full mapping; the SQL
    engine alone would give a capital sharp s."""
    symbols = scalars.symbols_from_text("text")
    return st.table(spark, sf_dir, "documents").select(
        "doc_id", F.size(symbols).alias("n"), F.md5(F.array_join(symbols, "|")).alias("joined")
    )


_SKIPS_SQL = """SELECT skip_reason, CAST(count(*) AS BIGINT) AS skipped FROM (
    SELECT CASE WHEN l_orderkey % 9 = 0 THEN 'unknown_dataset' WHEN l_orderkey % 7 = 0 THEN 'missing_symbol'
                WHEN l_orderkey % 5 = 0 THEN 'missing_date' WHEN l_orderkey % 3 = 0 THEN 'missing_ohlcv' END AS skip_reason
    FROM lineitem) AS l WHERE skip_reason IS NOT NULL GROUP BY skip_reason"""


@trial("c1_skip_counts", _SKIPS_SQL)
def c1_skip_counts(spark, sf_dir):
    """Records skipped per rule, unknown datasets included."""
    envelopes = with_arrival(docs.price_envelopes(spark, sf_dir))
    candidates = {"stock_daily_price": landing.price_rows(envelopes, BATCH)}
    return landing.skipped_rows(envelopes, candidates).select("skip_reason", "skipped")


@trial(
    "c3_accepted_prices",
    rendered(
        "symbol:s price_date:d open_price:n high_price:n low_price:n close_price:n volume:i",
        """SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS symbol, l_shipdate AS price_date, l_extendedprice AS open_price,
             l_extendedprice AS high_price, l_extendedprice AS low_price, l_extendedprice AS close_price, l_quantity AS volume
           FROM lineitem WHERE l_orderkey % 9 <> 0 AND l_orderkey % 7 <> 0 AND l_orderkey % 5 <> 0 AND l_orderkey % 3 <> 0""",
    ),
)
def c3_accepted_prices(spark, sf_dir):
    rows = landing.price_rows(with_arrival(docs.price_envelopes(spark, sf_dir)), BATCH)
    return accepted(rows).select("symbol", "price_date", "open_price", "high_price", "low_price", "close_price", "volume")


@trial(
    "c11_unknown_events",
    """SELECT event_type AS skip_reason, CAST(count(*) AS BIGINT) AS skipped FROM events
       WHERE event_type NOT IN ('ratings', 'holders') GROUP BY event_type""",
)
def c11_unknown_events(spark, sf_dir):
    """Every event type that is no dataset, counted by itself."""
    events = st.table(spark, sf_dir, "events")
    tagged = tag_skips(events, {"unknown": unknown_dataset("event_type")})
    return skip_counts(tagged, "event_type").select(F.col("event_type").alias("skip_reason"), "skipped")


_SOURCES_SQL = """primary_rows AS (
    SELECT 'basics' AS dataset, c_custkey, 'C' || CAST(c_custkey AS VARCHAR) AS symbol, c_custkey % 3 = 0 AS hollow,
      'first' AS origin FROM customer WHERE c_custkey % 7 <> 0),
  fallback_rows AS (
    SELECT 'basics' AS dataset, 'C' || CAST(c_custkey AS VARCHAR) AS symbol, 'second' AS origin
    FROM customer WHERE c_custkey % 2 = 0)"""


@trial(
    "d7_source_fallback",
    f"""WITH {_SOURCES_SQL}
        SELECT dataset, symbol, origin FROM primary_rows WHERE NOT hollow
        UNION ALL SELECT dataset, symbol, origin FROM fallback_rows
        WHERE symbol NOT IN (SELECT symbol FROM primary_rows WHERE NOT hollow)""",
)
def d7_source_fallback(spark, sf_dir):
    """The first source where it answered, else the second, else nothing."""
    key = F.col("c_custkey")
    customer = st.table(spark, sf_dir, "customer")

    def envelope(df, origin, name):
        return with_arrival(
            df.select(
                F.lit("basics").alias("dataset"),
                st.tagged("C", "c_custkey").alias("symbol"),
                docs.document(F.struct(name.alias("company_name"), F.lit(0).alias("fullTimeEmployees"))).alias("payload"),
                F.lit(origin).alias("origin"),
                key.alias("seq"),
            )
        )

    first = envelope(customer.where(key % 7 != 0), "first", F.when(key % 3 != 0, F.col("c_name")).otherwise(F.lit("")))
    second = envelope(customer.where(key % 2 == 0), "second", F.col("c_name"))
    return jobs.merge_batches(first, second).select("dataset", "symbol", "origin")


@trial(
    "d7_label_fallback",
    """SELECT doc_id, CAST(quality AS BIGINT) AS quality, 'labels' AS origin FROM labels WHERE toxic = 0
       UNION ALL SELECT doc_id, CAST(0 AS BIGINT), 'documents' FROM documents
       WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 0)""",
)
def d7_label_fallback(spark, sf_dir):
    """The same merge on labels, with a default per document where none counts."""
    labels = st.table(spark, sf_dir, "labels").withColumn("arrival", F.lit(0))
    first = labels.select("doc_id", "quality", "toxic", F.lit("labels").alias("origin"), "arrival")
    second = st.table(spark, sf_dir, "documents").select(
        "doc_id", F.lit(0).alias("quality"), F.lit(0).alias("toxic"), F.lit("documents").alias("origin"), F.lit(0).alias("arrival")
    )
    merged = merge_sources(first, second, ["doc_id"], F.col("toxic") != 0, "arrival")
    return merged.select("doc_id", "quality", "origin")
