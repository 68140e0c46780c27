"""Trials of the models and aggregations (B12, B14, B15, D1-D3, E1-E12, F, G, H)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.scalars import distinct_days_in_month, month_end, month_start
from tidemark.operators import metrics
from tidemark.operators.lookups import attach
from tidemark.operators.universe import ranked_universe
from tidemark.operators.versioning import latest_by_key, newest_value, version_counts
from tidemark.plans import models
from tidemark.registry import BASIC_INFO, FACTS, HOLDERS, RATINGS, TABLES, VERSION_ORDER
from tidemark.sources.lake import in_window
from tidemark.trials import standins as st, trial
from tidemark.trials.compare import rendered

_START, _END = st.WINDOW

MART_SQL = f"""mart AS (
  SELECT d.symbol, n.company_name, CAST(year(month_start_date) AS INTEGER) AS year,
    CAST(month(month_start_date) AS INTEGER) AS month, month_start_date, last_day(month_start_date) AS month_end_date,
    avg_open_price, avg_close_price, avg_volume, min_open_price, max_close_price, trading_days_count,
    min_price_date, max_price_date, source_row_count, TIMESTAMP '2024-02-01 00:00:00' AS loaded_at
  FROM (SELECT symbol, CAST(date_trunc('month', price_date) AS DATE) AS month_start_date,
          CAST(sum(open_price) AS DOUBLE) / count(open_price) AS avg_open_price,
          CAST(sum(close_price) AS DOUBLE) / count(close_price) AS avg_close_price,
          CAST(sum(volume) AS DOUBLE) / count(volume) AS avg_volume,
          min(open_price) AS min_open_price, max(close_price) AS max_close_price,
          count(DISTINCT price_date) AS trading_days_count,
          min(price_date) AS min_price_date, max(price_date) AS max_price_date, count(*) AS source_row_count
        FROM {{source}}
        WHERE price_date BETWEEN DATE '{_START}' AND DATE '{_END}'
          AND open_price >= 0 AND close_price >= 0 AND volume >= 0 AND high_price >= low_price
          AND high_price >= open_price AND high_price >= close_price
          AND low_price <= open_price AND low_price <= close_price
        GROUP BY ALL) AS d
  LEFT JOIN (SELECT symbol, arg_max(company_name, ROW(ingested_at, snapshot_date))
                              FILTER (WHERE company_name IS NOT NULL) AS company_name
             FROM supplier_profiles GROUP BY symbol) AS n ON n.symbol = d.symbol)"""

MART_COLUMNS = (
    "symbol:s company_name:s year:i month:i month_start_date:d month_end_date:d avg_open_price:n "
    "avg_close_price:n avg_volume:n min_open_price:n max_close_price:n trading_days_count:i "
    "min_price_date:d max_price_date:d source_row_count:i loaded_at:t"
)


def daily_mart(spark, sf_dir):
    return models.monthly_mart(
        st.daily_prices(spark, sf_dir), st.supplier_profiles(spark, sf_dir), st.LOADED_AT, *st.WINDOW
    )


@trial(
    "e1_monthly_mart",
    rendered(MART_COLUMNS, "SELECT * FROM mart", f"{st.DAILY_SQL}, {st.SUPPLIER_PROFILES_SQL}, {MART_SQL.format(source='daily')}"),
)
def e1_monthly_mart(spark, sf_dir):
    """Flagship: supplier days to the monthly mart with the newest known name."""
    return daily_mart(spark, sf_dir)


@trial(
    "e1_monthly_mart_of_quotes",
    rendered(MART_COLUMNS, "SELECT * FROM mart", f"{st.QUOTES_SQL}, {st.SUPPLIER_PROFILES_SQL}, {MART_SQL.format(source='quotes')}"),
)
def e1_monthly_mart_of_quotes(spark, sf_dir):
    """The mart over rows of which many fail the quality predicate and days repeat."""
    return models.monthly_mart(
        st.quotes(spark, sf_dir), st.supplier_profiles(spark, sf_dir), st.LOADED_AT, *st.WINDOW
    )


@trial(
    "g4_browse_mart",
    rendered(
        MART_COLUMNS,
        "SELECT * FROM mart ORDER BY symbol, year, month LIMIT 20",
        f"{st.DAILY_SQL}, {st.SUPPLIER_PROFILES_SQL}, {MART_SQL.format(source='daily')}",
    ),
)
def g4_browse_mart(spark, sf_dir):
    """First 20 mart rows in symbol, year, month order."""
    return daily_mart(spark, sf_dir).orderBy("symbol", "year", "month").limit(20)


@trial(
    "e2_monthly_summary",
    rendered(
        "symbol:s month_date:d avg_open_price:n avg_close_price:n avg_volume:n",
        """SELECT symbol, date_trunc('month', price_date) AS month_date,
             coalesce(CAST(sum(open_price) AS DOUBLE) / count(open_price), 0) AS avg_open_price,
             coalesce(CAST(sum(close_price) AS DOUBLE) / count(close_price), 0) AS avg_close_price,
             coalesce(CAST(sum(volume) AS DOUBLE) / count(volume), 0) AS avg_volume
           FROM quotes WHERE symbol IS NOT NULL AND price_date IS NOT NULL AND open_price >= 0
             AND close_price >= 0 AND volume >= 0 GROUP BY ALL""",
        st.QUOTES_SQL,
    ),
)
def e2_monthly_summary(spark, sf_dir):
    return models.monthly_summary(st.quotes(spark, sf_dir))


@trial(
    "e3_newest_name",
    rendered(
        "symbol:s company_name:s",
        """SELECT symbol, arg_max(company_name, ROW(ingested_at, snapshot_date, batch_id))
             FILTER (WHERE company_name IS NOT NULL) AS company_name FROM order_profiles GROUP BY symbol""",
        st.ORDER_PROFILES_SQL,
    ),
)
def e3_newest_name(spark, sf_dir):
    """Newest non-null name per customer over all profile versions."""
    profiles = st.order_profiles(spark, sf_dir)
    return newest_value(profiles, ["symbol"], "company_name", ["ingested_at", "snapshot_date", "batch_id"])


@trial(
    "e4_distinct_days",
    """SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS symbol,
         CAST(CAST(date_trunc('month', l_shipdate) AS DATE) AS VARCHAR) AS month_start_date,
         CAST(CAST(max(last_day(CAST(l_shipdate AS DATE))) AS DATE) AS VARCHAR) AS month_end_date,
         CAST(count(DISTINCT CAST(l_shipdate AS DATE)) AS BIGINT) AS days
       FROM lineitem GROUP BY l_suppkey, date_trunc('month', l_shipdate)""",
)
def e4_distinct_days(spark, sf_dir):
    """Exact distinct ship days per supplier and month, over all line items."""
    lines = st.table(spark, sf_dir, "lineitem").select(
        st.tagged("S", "l_suppkey").alias("symbol"), F.to_date("l_shipdate").alias("day")
    )
    return lines.groupBy("symbol", month_start("day").alias("month_start_date")).agg(
        F.max(month_end("day")).alias("month_end_date"), distinct_days_in_month("day").alias("days")
    )


_SYMBOL_STREAMS = " UNION ALL ".join(
    f"SELECT symbol, ingested_at FROM {name}" for name in st.MARKET_NAMES.values()
)
_ACTIVITY = f"SELECT symbol, max(ingested_at) AS latest_ingested_at FROM ({_SYMBOL_STREAMS}) AS s GROUP BY symbol"


@trial("e5_latest_activity", rendered("symbol:s latest_ingested_at:t", _ACTIVITY, st.MARKET_SQL))
def e5_latest_activity(spark, sf_dir):
    """Newest load per symbol over the union of five tables (E5, H2)."""
    return metrics.latest_activity(list(st.market(spark, sf_dir).values()))


@trial(
    "e6_newest_overall",
    rendered(
        "max_ingested_at:t",
        "SELECT max(m) AS max_ingested_at FROM ("
        + " UNION ALL ".join(f"SELECT max(ingested_at) AS m FROM {n}" for n in st.MARKET_NAMES.values())
        + ") AS maxima",
        st.MARKET_SQL,
    ),
)
def e6_newest_overall(spark, sf_dir):
    return metrics.newest_overall(list(st.market(spark, sf_dir).values()))


_COUNTED = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
_COUNTS = " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in _COUNTED)


def _counted(spark, sf_dir):
    return {name: st.table(spark, sf_dir, name) for name in _COUNTED}


@trial("e7_total_rows", f"SELECT CAST(sum(row_count) AS BIGINT) AS total_rows FROM ({_COUNTS}) AS c")
def e7_total_rows(spark, sf_dir):
    return metrics.total_rows(_counted(spark, sf_dir))


@trial("e12_table_counts", rendered("table_name:s row_count:i", _COUNTS))
def e12_table_counts(spark, sf_dir):
    """Row counts by union; the scans read no columns."""
    return metrics.table_counts(_counted(spark, sf_dir))


@trial(
    "e8_rows_in_years",
    """SELECT CAST(count(*) FILTER (WHERE year(l_shipdate) = 1996) AS BIGINT) AS rows_1996,
         CAST(count(*) FILTER (WHERE year(l_shipdate) = 1997) AS BIGINT) AS rows_1997,
         CAST(count(*) FILTER (WHERE year(l_shipdate) = 2024) AS BIGINT) AS rows_2024 FROM lineitem""",
)
def e8_rows_in_years(spark, sf_dir):
    year = F.year("l_shipdate")
    return st.table(spark, sf_dir, "lineitem").agg(
        *[F.count_if(year == y).alias(f"rows_{y}") for y in (1996, 1997, 2024)]
    )


@trial(
    "e9_duplicate_grain",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(count(*) AS BIGINT) AS row_count
       FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def e9_duplicate_grain(spark, sf_dir):
    return metrics.duplicate_grain(st.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@trial(
    "e11_load_metrics",
    rendered(
        "table_name:s symbol:s row_count:i",
        " UNION ALL ".join(
            f"SELECT '{table}' AS table_name, symbol, count(*) AS row_count FROM {name} GROUP BY symbol"
            for table, name in st.MARKET_NAMES.items()
        ),
        st.MARKET_SQL,
    ),
)
def e11_load_metrics(spark, sf_dir):
    """Rows per table and symbol, repeated keys counted each time."""
    return metrics.load_metrics(st.market(spark, sf_dir))


_RATING_COLUMNS = (
    "symbol:s rating_date:d firm_name:s to_grade:s from_grade:s rating_action:s recommendation_score:n "
    "ingested_at:t source_system:s batch_id:s"
)


def latest_sql(source: str, keys: str, order: str) -> str:
    return f"""SELECT * FROM {source}
      QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {order}) = 1"""


NEWEST = "ingested_at DESC, batch_id DESC, source_system DESC"


@trial(
    "f1_latest_rating_version",
    rendered(_RATING_COLUMNS, latest_sql("event_ratings", "symbol, rating_date, firm_name", NEWEST), st.EVENT_RATINGS_SQL),
)
def f1_latest_rating_version(spark, sf_dir):
    """Newest version per natural key, many versions per key."""
    return latest_by_key(st.event_ratings(spark, sf_dir), RATINGS.key, VERSION_ORDER)


_PROFILE_COLUMNS = (
    "symbol:s snapshot_date:d company_name:s industry:s sector:s employee_count:n city:s phone:s state:s country:s "
    "website:s address:s market_cap:n currency:s exchange:s ingested_at:t source_system:s batch_id:s"
)


@trial(
    "f1_latest_profile_version",
    rendered(_PROFILE_COLUMNS, latest_sql("order_profiles", "symbol, snapshot_date", NEWEST), st.ORDER_PROFILES_SQL),
)
def f1_latest_profile_version(spark, sf_dir):
    newest = latest_by_key(st.order_profiles(spark, sf_dir), BASIC_INFO.key, VERSION_ORDER)
    return newest.withColumn("employee_count", F.col("employee_count").cast("double"))


@trial(
    "f2_latest_profile",
    rendered(
        "symbol:s snapshot_date:d company_name:s market_cap:n ingested_at:t batch_id:s",
        latest_sql("order_profiles", "symbol", "snapshot_date DESC, ingested_at DESC, batch_id DESC"),
        st.ORDER_PROFILES_SQL,
    ),
)
def f2_latest_profile(spark, sf_dir):
    newest = latest_by_key(st.order_profiles(spark, sf_dir), ["symbol"], ["snapshot_date", "ingested_at", "batch_id"])
    return newest.select("symbol", "snapshot_date", "company_name", "market_cap", "ingested_at", "batch_id")


@trial(
    "a16_version_counts",
    """SELECT CAST(count(*) AS BIGINT) AS physical_rows,
         CAST(count(DISTINCT (user_id, event_type, CAST(ts AS DATE))) AS BIGINT) AS logical_rows FROM events""",
)
def a16_version_counts(spark, sf_dir):
    """Stored versions against distinct keys."""
    return version_counts(st.event_ratings(spark, sf_dir), RATINGS.key)


_UNION_SYMBOLS = " UNION ".join(f"SELECT symbol FROM {n} WHERE symbol IS NOT NULL" for n in st.MARKET_NAMES.values())


@trial("h1_symbol_universe", rendered("symbol:s", _UNION_SYMBOLS, st.MARKET_SQL))
def h1_symbol_universe(spark, sf_dir):
    """Distinct symbols of five tables."""
    return models.symbol_universe(st.market(spark, sf_dir))


_DIMENSION_SQL = f"""SELECT u.symbol,
    coalesce(b.snapshot_date, CAST(a.latest_ingested_at AS DATE), DATE '1900-01-01') AS snapshot_date,
    coalesce(b.company_name, 'UNKNOWN') AS company_name, coalesce(b.industry, 'UNKNOWN') AS industry,
    coalesce(b.sector, 'UNKNOWN') AS sector, b.employee_count, coalesce(b.city, 'UNKNOWN') AS city, b.phone, b.state,
    coalesce(b.country, 'UNKNOWN') AS country, b.website, b.address, b.market_cap, b.currency, b.exchange,
    coalesce(b.ingested_at, a.latest_ingested_at, TIMESTAMP '2024-02-01 00:00:00') AS ingested_at,
    coalesce(b.source_system, 'UNKNOWN') AS source_system, coalesce(b.batch_id, 'UNKNOWN') AS batch_id
  FROM ({_UNION_SYMBOLS}) AS u
  LEFT JOIN ({latest_sql('order_profiles', 'symbol', 'snapshot_date DESC, ingested_at DESC')}) AS b ON b.symbol = u.symbol
  LEFT JOIN ({_ACTIVITY}) AS a ON a.symbol = u.symbol"""


@trial("d1_profile_dimension", rendered(_PROFILE_COLUMNS, _DIMENSION_SQL, st.MARKET_SQL))
def d1_profile_dimension(spark, sf_dir):
    """The dimension over five tables."""
    built = models.dimension(st.market(spark, sf_dir), st.LOADED_AT)
    return built.withColumn("employee_count", F.col("employee_count").cast("double"))


@trial(
    "d2_customer_activity",
    """SELECT c_custkey, c_name, CAST(CAST(last_order AS DATE) AS VARCHAR) AS last_order_date
       FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS last_order FROM orders GROUP BY o_custkey) AS o
         ON o_custkey = c_custkey""",
)
def d2_customer_activity(spark, sf_dir):
    """Left join to one row per key; customers without orders stay."""
    last = (
        st.table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.to_date(F.max("o_orderdate")).alias("last_order_date"))
    )
    return attach(st.table(spark, sf_dir, "customer").select("c_custkey", "c_name"), last, "c_custkey")


@trial(
    "d3_daily_names",
    rendered(
        "symbol:s price_date:d close_price:n company_name:s",
        """SELECT d.symbol, price_date, close_price, company_name FROM daily AS d
           LEFT JOIN (SELECT symbol, arg_max(company_name, ROW(ingested_at, snapshot_date))
                        FILTER (WHERE company_name IS NOT NULL) AS company_name
                      FROM supplier_profiles GROUP BY symbol) AS n ON n.symbol = d.symbol""",
        f"{st.DAILY_SQL}, {st.SUPPLIER_PROFILES_SQL}",
    ),
)
def d3_daily_names(spark, sf_dir):
    """Daily rows with the newest known name of their symbol."""
    names = newest_value(
        st.supplier_profiles(spark, sf_dir), ["symbol"], "company_name", ["ingested_at", "snapshot_date"]
    )
    prices = st.daily_prices(spark, sf_dir).select("symbol", "price_date", "close_price")
    return attach(prices, names, "symbol")


def _fact_sql(name: str) -> str:
    fact = FACTS[name]
    parts = [
        f"coalesce({c}, '')" if c in fact.empty_for_null else f"CAST({c} AS VARCHAR)" for c in fact.key_parts
    ]
    joined = " || '|' || ".join(parts)
    return f"SELECT md5({joined}) AS {fact.surrogate}, * FROM {st.MARKET_NAMES[fact.source.name]}"


def _fact_trial(name: str, columns: str) -> None:
    fact = FACTS[name]

    @trial(f"b12_{name}", rendered(f"{fact.surrogate}:s {columns}", _fact_sql(name), st.MARKET_SQL))
    def build(spark, sf_dir):
        return models.fact_rows(st.market(spark, sf_dir)[fact.source.name], fact)


_fact_trial(
    "fct_stock_daily",
    "symbol:s price_date:d open_price:n high_price:n low_price:n close_price:n adjusted_close:n volume:i "
    "ingested_at:t source_system:s batch_id:s",
)
_fact_trial(
    "fct_bank_fundamentals",
    "symbol:s statement_date:d period_type:s total_assets:n total_debt:n invested_capital:n shares_issued:n "
    "currency:s ingested_at:t source_system:s batch_id:s",
)
_HOLDER_COLUMNS = (
    "symbol:s holder_type:s holder_name:s holdings_date:d shares:n market_value:n pct_outstanding:n "
    "ingested_at:t source_system:s batch_id:s"
)
_fact_trial("fct_holders", _HOLDER_COLUMNS)
_fact_trial("fct_ratings", _RATING_COLUMNS)


@trial(
    "b14_staging_view",
    rendered(
        _HOLDER_COLUMNS,
        """SELECT symbol, CASE WHEN lower(holder_type) = 'fund' THEN 'mutual_fund' ELSE lower(holder_type) END AS holder_type,
             holder_name, holdings_date, shares, market_value, pct_outstanding, ingested_at, source_system, batch_id
           FROM line_holders""",
        st.LINE_HOLDERS_SQL,
    ),
)
def b14_staging_view(spark, sf_dir):
    return models.staging_view(st.line_holders(spark, sf_dir), HOLDERS)


@trial(
    "c4_date_window",
    rendered(
        "symbol:s price_date:d close_price:n",
        f"SELECT * FROM daily WHERE price_date BETWEEN DATE '{_START}' AND DATE '{_END}'",
        st.DAILY_SQL,
    ),
)
def c4_date_window(spark, sf_dir):
    """Both ends of the window are kept."""
    return in_window(st.daily_prices(spark, sf_dir), "price_date", *st.WINDOW).select("symbol", "price_date", "close_price")


_UNIVERSE_SQL = """WITH quotes AS (
    SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS symbol, s_suppkey, s_acctbal, n_name AS industry, r_name AS region
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
  largest AS (SELECT * FROM quotes WHERE region BETWEEN 'AMERICA' AND 'EUROPE' OR region = 'AFRICA'
              )
  SELECT symbol, s_acctbal AS market_cap, industry FROM largest WHERE contains(upper(industry), 'NATION_1')
  ORDER BY s_acctbal DESC, s_suppkey LIMIT 25"""


@trial("g3_ranked_universe", _UNIVERSE_SQL)
def g3_ranked_universe(spark, sf_dir):
    """Both filters over all quotes, then the first 25."""
    supplier, nation, region = (st.table(spark, sf_dir, n) for n in ("supplier", "nation", "region"))
    quotes = (
        supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            st.tagged("S", "s_suppkey").alias("symbol"),
            "s_suppkey",
            F.col("s_acctbal").alias("market_cap"),
            F.col("n_name").alias("industry"),
            F.col("r_name").alias("region"),
        )
    )
    coarse = F.col("region").between("AMERICA", "EUROPE") | (F.col("region") == "AFRICA")
    fine = F.contains(F.upper("industry"), F.lit("NATION_1"))
    return ranked_universe(quotes, coarse, fine, "market_cap", "s_suppkey").select("symbol", "market_cap", "industry")


assert set(TABLES) == set(st.MARKET_NAMES)
