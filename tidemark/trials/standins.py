"""Market-shaped tables derived from the test tables, in Spark and as SQL CTEs.

Each function scans whole test tables and returns rows in a landing schema;
the constant beside it is the same derivation for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.scalars import truncate_to_millis, year_month
from tidemark.functions.variants import path_text
from tidemark.registry import BASIC_INFO, DAILY_PRICE, FUNDAMENTALS, HOLDERS, RATINGS
from tidemark.plans.jobs import dealt_by_month, largest_month
from tidemark.session import scratch_path

WINDOW = ("1996-01-01", "1997-12-31")
LOADED_AT = "2024-02-01T00:00:00Z"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tagged(prefix: str, key: str) -> Column:
    return F.concat(F.lit(prefix), F.col(key).cast("string"))


#: Columns of rows that are dealt by month: rows of one key and place are in one task.
PLACE = ("_month", "_bucket")


def _typed(df: DataFrame, spec) -> DataFrame:
    places = [c for c in PLACE if c in df.columns]
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.schema.fields], *places)


def _dealt(rows: DataFrame, spec, dealt: bool) -> tuple[DataFrame, tuple[str, ...]]:
    """With ``dealt``, rows of a month in a few tasks; a table of months is then written from the same tasks."""
    if not dealt:
        return rows, ()
    return dealt_by_month(rows, spec.date_column, spec.key, largest_month(rows, spec.date_column))


def daily_prices(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """One row per supplier and ship date: first, highest, lowest and last price."""
    order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    lines, place = _dealt(
        table(spark, sf_dir, "lineitem").select(
            tagged("S", "l_suppkey").alias("symbol"), F.to_date("l_shipdate").alias("price_date"),
            "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity",
        ),
        DAILY_PRICE,
        dealt,
    )
    daily = (
        lines.groupBy(*place, "symbol", "price_date")
        .agg(
            F.min_by("l_extendedprice", order).alias("open_price"),
            F.max("l_extendedprice").alias("high_price"),
            F.min("l_extendedprice").alias("low_price"),
            F.max_by("l_extendedprice", order).alias("close_price"),
            F.sum("l_quantity").alias("volume"),
        )
    )
    return _typed(
        daily.withColumns(
            {
                "adjusted_close": F.lit(None),
                "ingested_at": F.date_add("price_date", 1).cast("timestamp"),
                "source_system": F.lit("lineitem"),
                "batch_id": F.concat(F.lit("b"), year_month("price_date").cast("string")),
            }
        ),
        DAILY_PRICE,
    )


DAILY_SQL = """daily AS (
  SELECT symbol, price_date,
    CAST(arg_min(l_extendedprice, o) AS DECIMAL(18,6)) AS open_price,
    CAST(max(l_extendedprice) AS DECIMAL(18,6)) AS high_price,
    CAST(min(l_extendedprice) AS DECIMAL(18,6)) AS low_price,
    CAST(arg_max(l_extendedprice, o) AS DECIMAL(18,6)) AS close_price,
    CAST(NULL AS DECIMAL(18,6)) AS adjusted_close,
    CAST(sum(l_quantity) AS BIGINT) AS volume,
    CAST(price_date + INTERVAL 1 DAY AS TIMESTAMP) AS ingested_at,
    'lineitem' AS source_system,
    'b' || CAST(year(price_date) * 100 + month(price_date) AS VARCHAR) AS batch_id
  FROM (SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS price_date,
               l_extendedprice, l_quantity,
               ROW(l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS o
        FROM lineitem) AS l
  GROUP BY symbol, price_date)"""


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One price row per line item, some with impossible prices or volume."""
    price = F.col("l_extendedprice")
    rows = table(spark, sf_dir, "lineitem").select(
        tagged("S", "l_suppkey").alias("symbol"),
        F.to_date("l_shipdate").alias("price_date"),
        price.cast("decimal(18,6)").alias("open_price"),
        (price * (1 + F.col("l_tax"))).cast("decimal(18,6)").alias("high_price"),
        (price * (1 - F.col("l_discount"))).cast("decimal(18,6)").alias("low_price"),
        (price * (1.05 - F.col("l_discount"))).cast("decimal(18,6)").alias("close_price"),
        (F.col("l_quantity").cast("bigint") - 5).alias("volume"),
        "l_orderkey",
        "l_linenumber",
        "l_returnflag",
    )
    return rows


QUOTES_SQL = """quotes AS (
  SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS price_date,
    CAST(l_extendedprice AS DECIMAL(18,6)) AS open_price,
    CAST(l_extendedprice * (1 + l_tax) AS DECIMAL(18,6)) AS high_price,
    CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,6)) AS low_price,
    CAST(l_extendedprice * (CAST(1.05 AS DOUBLE) - l_discount) AS DECIMAL(18,6)) AS close_price,
    CAST(l_quantity AS BIGINT) - 5 AS volume, l_orderkey, l_linenumber, l_returnflag
  FROM lineitem)"""


def supplier_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two profile versions per supplier; the newer one lacks a name for every third."""
    base = table(spark, sf_dir, "supplier").withColumn("version", F.explode(F.array(F.lit(1), F.lit(2))))
    rows = base.select(
        tagged("S", "s_suppkey").alias("symbol"),
        F.make_date(F.lit(2024), F.col("version"), F.lit(1)).alias("snapshot_date"),
        F.when((F.col("version") == 1) | (F.col("s_suppkey") % 3 != 0), F.concat("s_name", F.lit(" v"), F.col("version").cast("string"))).alias("company_name"),
        F.make_timestamp(F.lit(2024), F.col("version"), F.lit(2), F.lit(0), F.lit(0), F.lit(0)).alias("ingested_at"),
    )
    return rows


SUPPLIER_PROFILES_SQL = """supplier_profiles AS (
  SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS symbol, make_date(2024, version, 1) AS snapshot_date,
    CASE WHEN version = 1 OR s_suppkey % 3 <> 0 THEN s_name || ' v' || CAST(version AS VARCHAR) END AS company_name,
    CAST(make_date(2024, version, 2) AS TIMESTAMP) AS ingested_at
  FROM supplier, (SELECT unnest([1, 2]) AS version) AS versions)"""


def order_profiles(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """One profile version per order: the customer as it was on that day."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    places = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "n_name", "r_name")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        places, F.col("c_nationkey") == F.col("n_nationkey")
    )
    day = F.col("o_orderdate").cast("timestamp")
    profiles = _typed(
        joined.select(
            tagged("C", "o_custkey").alias("symbol"),
            F.to_date("o_orderdate").alias("snapshot_date"),
            F.when(F.col("o_orderpriority") != "5-LOW", F.concat("c_name", F.lit(" "), "o_orderstatus")).alias("company_name"),
            F.col("c_mktsegment").alias("industry"),
            F.when(F.col("o_orderstatus") != "P", F.col("r_name")).alias("sector"),
            (F.col("o_orderkey") % 1000).alias("employee_count"),
            F.col("n_name").alias("city"),
            F.lit(None).alias("phone"),
            F.lit(None).alias("state"),
            F.col("r_name").alias("country"),
            F.concat(F.lit("c"), F.col("o_custkey").cast("string"), F.lit(".example.com")).alias("website"),
            F.lit(None).alias("address"),
            F.col("o_totalprice").alias("market_cap"),
            F.lit("USD").alias("currency"),
            F.col("o_orderpriority").alias("exchange"),
            F.timestamp_seconds(F.unix_timestamp(day) + F.col("o_orderkey") % 86400).alias("ingested_at"),
            F.col("o_orderstatus").alias("source_system"),
            F.concat(F.lit("b"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("batch_id"),
        ),
        BASIC_INFO,
    )
    if not dealt:
        return profiles
    # A month has no more profiles than orders.
    return dealt_by_month(profiles, "snapshot_date", BASIC_INFO.key, largest_month(orders, "o_orderdate"))[0]


ORDER_PROFILES_SQL = """order_profiles AS (
  SELECT 'C' || CAST(o_custkey AS VARCHAR) AS symbol, CAST(o_orderdate AS DATE) AS snapshot_date,
    CASE WHEN o_orderpriority <> '5-LOW' THEN c_name || ' ' || o_orderstatus END AS company_name,
    c_mktsegment AS industry, CASE WHEN o_orderstatus <> 'P' THEN r_name END AS sector,
    o_orderkey % 1000 AS employee_count, n_name AS city, CAST(NULL AS VARCHAR) AS phone,
    CAST(NULL AS VARCHAR) AS state, r_name AS country,
    'c' || CAST(o_custkey AS VARCHAR) || '.example.com' AS website, CAST(NULL AS VARCHAR) AS address,
    CAST(o_totalprice AS DECIMAL(20,2)) AS market_cap, 'USD' AS currency, o_orderpriority AS exchange,
    o_orderdate + to_seconds(o_orderkey % 86400) AS ingested_at, o_orderstatus AS source_system,
    'b' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS batch_id
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""


def event_ratings(spark: SparkSession, sf_dir: str, in_millis: bool = True, dealt: bool = False) -> DataFrame:
    """One rating version per event."""
    at = F.col("ts").cast("timestamp")
    k = path_text(F.try_parse_json("props"), "$.k").cast("int")
    ratings = _typed(
        table(spark, sf_dir, "events").select(
            tagged("U", "user_id").alias("symbol"),
            F.to_date("ts").alias("rating_date"),
            F.col("event_type").alias("firm_name"),
            F.concat(F.lit("G"), (k % 5).cast("string")).alias("to_grade"),
            F.lit(None).alias("from_grade"),
            F.col("event_type").alias("rating_action"),
            F.col("value").alias("recommendation_score"),
            (truncate_to_millis(at) if in_millis else at).alias("ingested_at"),
            F.lit("events").alias("source_system"),
            F.concat(F.lit("b"), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("batch_id"),
        ),
        RATINGS,
    )
    return _dealt(ratings, RATINGS, dealt)[0]


EVENT_RATINGS_SQL = """event_ratings AS (
  SELECT 'U' || CAST(user_id AS VARCHAR) AS symbol, CAST(ts AS DATE) AS rating_date, event_type AS firm_name,
    'G' || CAST(CAST(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS INTEGER) % 5 AS VARCHAR) AS to_grade,
    CAST(NULL AS VARCHAR) AS from_grade, event_type AS rating_action,
    CAST(value AS DECIMAL(8,4)) AS recommendation_score,
    date_trunc('millisecond', ts) AS ingested_at, 'events' AS source_system,
    'b' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS batch_id
  FROM events)"""


def order_fundamentals(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """Quarterly totals per customer."""
    amount = F.col("o_totalprice").cast("decimal(18,2)")
    quarter_end = F.last_day(F.add_months(F.trunc("o_orderdate", "quarter"), 2))
    orders = table(spark, sf_dir, "orders").select(
        tagged("C", "o_custkey").alias("symbol"), quarter_end.alias("statement_date"), "o_totalprice", "o_orderstatus", "o_orderdate"
    )
    period = F.when(F.month("statement_date") == 12, "annual").otherwise("quarterly")
    orders, place = _dealt(orders.withColumn("period_type", period), FUNDAMENTALS, dealt)
    rows = (
        orders.groupBy(*place, "symbol", "statement_date", "period_type")
        .agg(
            F.sum(amount).alias("total_assets"),
            F.sum(F.when(F.col("o_orderstatus") == "F", amount)).alias("total_debt"),
            F.max(amount).alias("invested_capital"),
            (F.count(F.lit(1)) * 1000).alias("shares_issued"),
            F.max("o_orderdate").cast("timestamp").alias("ingested_at"),
        )
        .withColumns(
            {
                "currency": F.lit(None),
                "source_system": F.lit("orders"),
                "batch_id": F.concat(F.lit("b"), F.year("statement_date").cast("string")),
            }
        )
    )
    return _typed(rows, FUNDAMENTALS)


ORDER_FUNDAMENTALS_SQL = """order_fundamentals AS (
  SELECT symbol, statement_date,
    CASE WHEN month(statement_date) = 12 THEN 'annual' ELSE 'quarterly' END AS period_type,
    CAST(sum(amount) AS DECIMAL(22,2)) AS total_assets,
    CAST(sum(CASE WHEN o_orderstatus = 'F' THEN amount END) AS DECIMAL(22,2)) AS total_debt,
    CAST(max(amount) AS DECIMAL(22,2)) AS invested_capital,
    CAST(count(*) * 1000 AS DECIMAL(22,2)) AS shares_issued, CAST(NULL AS VARCHAR) AS currency,
    max(o_orderdate) AS ingested_at, 'orders' AS source_system,
    'b' || CAST(year(statement_date) AS VARCHAR) AS batch_id
  FROM (SELECT 'C' || CAST(o_custkey AS VARCHAR) AS symbol,
               last_day(CAST(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH AS DATE)) AS statement_date,
               CAST(o_totalprice AS DECIMAL(18,2)) AS amount, o_orderstatus, o_orderdate
        FROM orders) AS o
  GROUP BY symbol, statement_date)"""


def line_holders(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """Quarterly positions of part groups in suppliers."""
    kind = (
        F.when(F.col("l_returnflag") == "A", "institution")
        .when(F.col("l_returnflag") == "R", "FUND")
        .otherwise("insider")
    )
    quarter_end = F.last_day(F.add_months(F.trunc("l_shipdate", "quarter"), 2))
    lines, place = _dealt(
        table(spark, sf_dir, "lineitem").select(
            tagged("S", "l_suppkey").alias("symbol"),
            kind.alias("holder_type"),
            F.concat(F.lit("H"), (F.col("l_partkey") % 50).cast("string")).alias("holder_name"),
            quarter_end.alias("holdings_date"),
            "l_quantity",
            "l_extendedprice",
            "l_shipdate",
        ),
        HOLDERS,
        dealt,
    )
    rows = (
        lines.groupBy(*place, "symbol", "holder_type", "holder_name", "holdings_date")
        .agg(
            F.sum("l_quantity").alias("shares"),
            F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("market_value"),
            F.max("l_shipdate").cast("timestamp").alias("ingested_at"),
        )
        .withColumns(
            {
                "pct_outstanding": F.lit(None),
                "source_system": F.lit("lineitem"),
                "batch_id": F.concat(F.lit("b"), F.year("holdings_date").cast("string")),
            }
        )
    )
    return _typed(rows, HOLDERS)


LINE_HOLDERS_SQL = """line_holders AS (
  SELECT symbol, holder_type, holder_name, holdings_date, CAST(sum(l_quantity) AS DECIMAL(22,2)) AS shares,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(22,2)) AS market_value,
    CAST(NULL AS DECIMAL(9,6)) AS pct_outstanding, max(l_shipdate) AS ingested_at,
    'lineitem' AS source_system, 'b' || CAST(year(holdings_date) AS VARCHAR) AS batch_id
  FROM (SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS symbol,
          CASE l_returnflag WHEN 'A' THEN 'institution' WHEN 'R' THEN 'FUND' ELSE 'insider' END AS holder_type,
          'H' || CAST(l_partkey % 50 AS VARCHAR) AS holder_name,
          last_day(CAST(date_trunc('quarter', l_shipdate) + INTERVAL 2 MONTH AS DATE)) AS holdings_date,
          l_quantity, l_extendedprice, l_shipdate
        FROM lineitem) AS l
  GROUP BY symbol, holder_type, holder_name, holdings_date)"""


def market(spark: SparkSession, sf_dir: str, dealt: bool = False) -> dict[str, DataFrame]:
    """All five tables; profiles and ratings hold several versions per key."""
    return {
        BASIC_INFO.name: order_profiles(spark, sf_dir, dealt=dealt),
        DAILY_PRICE.name: daily_prices(spark, sf_dir, dealt),
        FUNDAMENTALS.name: order_fundamentals(spark, sf_dir, dealt),
        HOLDERS.name: line_holders(spark, sf_dir, dealt),
        RATINGS.name: event_ratings(spark, sf_dir, dealt=dealt),
    }


def stored_market(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five tables, each derived and written once: for what reads them many times."""
    stored = {}
    for name, rows in market(spark, sf_dir).items():
        path = scratch_path(spark, f"market-{name}")
        rows.write.parquet(path)
        stored[name] = spark.read.schema(rows.schema).parquet(path)
    return stored


MARKET_SQL = ",\n".join(
    (ORDER_PROFILES_SQL, DAILY_SQL, ORDER_FUNDAMENTALS_SQL, LINE_HOLDERS_SQL, EVENT_RATINGS_SQL)
)
MARKET_NAMES = {
    BASIC_INFO.name: "order_profiles",
    DAILY_PRICE.name: "daily",
    FUNDAMENTALS.name: "order_fundamentals",
    HOLDERS.name: "line_holders",
    RATINGS.name: "event_ratings",
}
