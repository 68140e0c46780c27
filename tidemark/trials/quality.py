"""Trials of checks, suites and gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import quality as q
from tidemark.plans import checks, models
from tidemark.registry import BASIC_INFO, DAILY_PRICE, FACTS, FUNDAMENTALS, HOLDERS, RATINGS
from tidemark.trials import standins as st, trial
from tidemark.trials.compare import rendered
from tidemark.trials.models import MART_SQL

_START, _END = st.WINDOW


def _report(*rows: tuple[str, str, str]) -> str:
    """SQL of a report from (table, check, scalar SQL) triples."""
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS check_name, CAST(({sql}) AS BIGINT) AS violations" for t, c, sql in rows
    )


def _where(table: str, condition: str) -> str:
    return f"SELECT count(*) FROM {table} WHERE {condition}"


def _repeated(table: str, keys: str) -> str:
    return f"SELECT count(*) FROM (SELECT 1 FROM {table} GROUP BY {keys} HAVING count(*) > 1) AS g"


def _nulls(table: str, source: str, *columns: str):
    return [(table, f"{c}_not_null", _where(source, f"{c} IS NULL")) for c in columns]


_HOLDER_BAD = "holder_type NOT IN ('institution', 'insider', 'mutual_fund', 'major')"
_PERIOD_BAD = "period_type NOT IN ('annual', 'quarterly', 'ttm')"


@trial(
    "k1_source_checks",
    f"WITH {st.MARKET_SQL} "
    + _report(
        *_nulls("bank_basic_info", "order_profiles", "symbol", "snapshot_date"),
        *_nulls("stock_daily_price", "daily", "symbol", "price_date", "volume"),
        *_nulls("bank_fundamentals", "order_fundamentals", "symbol"),
        ("bank_fundamentals", "period_type_accepted", _where("order_fundamentals", _PERIOD_BAD)),
        *_nulls("holders", "line_holders", "symbol"),
        ("holders", "holder_type_accepted", _where("line_holders", _HOLDER_BAD)),
        *_nulls("ratings", "event_ratings", "symbol"),
    ),
)
def k1_source_checks(spark, sf_dir):
    """The declared checks of the five landing tables; raw holder types fail (K1, K3)."""
    return q.run_suite(checks.source_checks(st.market(spark, sf_dir)))


@trial(
    "k3_staging_checks",
    f"WITH {st.MARKET_SQL} "
    + _report(
        *_nulls("stg_bank_basic_info", "order_profiles", "symbol", "snapshot_date"),
        *_nulls("stg_stock_daily_price", "daily", "symbol", "price_date", "volume"),
        *_nulls("stg_bank_fundamentals", "order_fundamentals", "symbol", "period_type"),
        ("stg_bank_fundamentals", "period_type_accepted", _where("order_fundamentals", _PERIOD_BAD)),
        (
            "stg_holders",
            "holder_type_accepted",
            _where("line_holders", _HOLDER_BAD.replace("holder_type", "replace(lower(holder_type), 'fund', 'mutual_fund')")),
        ),
        *_nulls("stg_ratings", "event_ratings", "symbol"),
    ),
)
def k3_staging_checks(spark, sf_dir):
    """The declared checks of the staging views; holder types are canonical there."""
    market = st.market(spark, sf_dir)
    specs = (BASIC_INFO, DAILY_PRICE, FUNDAMENTALS, HOLDERS, RATINGS)
    views = {spec.name: models.staging_view(market[spec.name], spec) for spec in specs}
    return q.run_suite(checks.staging_checks(views))


_SK = {
    "fct_stock_daily": ("stock_daily_sk", "daily", "symbol, price_date"),
    "fct_bank_fundamentals": ("fundamentals_sk", "order_fundamentals", "symbol, statement_date, period_type"),
    "fct_holders": ("holders_sk", "line_holders", "symbol, holder_type, holder_name, holdings_date"),
    "fct_ratings": ("ratings_sk", "event_ratings", "symbol, rating_date, firm_name"),
}
_IN_DIMENSION = "symbol NOT IN (SELECT symbol FROM order_profiles UNION SELECT symbol FROM event_ratings)"


def _unknown_symbols(table: str) -> str:
    return f"SELECT count(DISTINCT symbol) FROM {table} WHERE {_IN_DIMENSION}"


@trial(
    "k2_model_checks",
    f"WITH {st.MARKET_SQL}, summary AS (SELECT DISTINCT symbol, date_trunc('month', price_date) AS month_date FROM daily) "
    + _report(
        ("dim_bank_profile", "symbol_not_null", "SELECT 0"),
        ("dim_bank_profile", "snapshot_date_not_null", "SELECT 0"),
        ("dim_bank_profile", "symbol_unique", "SELECT 0"),
        *[(n, f"{sk}_unique", _repeated(source, keys)) for n, (sk, source, keys) in _SK.items()],
        *[(n, f"{sk}_not_null", "SELECT 0") for n, (sk, _, _) in _SK.items()],
        *[(n, "symbol_in_dimension", _unknown_symbols(source)) for n, (_, source, _) in _SK.items()],
        *_nulls("fct_stock_daily", "daily", "symbol", "price_date"),
        (
            "fct_stock_daily",
            "ohlc_in_range",
            _where("daily", "high_price < low_price OR high_price < greatest(open_price, close_price) OR low_price > "
                   "least(open_price, close_price) OR open_price < 0 OR high_price < 0 OR low_price < 0 OR close_price < 0"),
        ),
        ("fct_stock_daily", "volume_non_negative", _where("daily", "volume < 0")),
        (
            "fct_stock_daily",
            "loaded_recently",
            "SELECT CASE WHEN max(ingested_at) < TIMESTAMP '2024-01-29 00:00:00' THEN 1 ELSE 0 END FROM daily",
        ),
        ("fct_bank_fundamentals", "period_type_accepted", _where("order_fundamentals", _PERIOD_BAD)),
        ("fct_holders", "holder_type_accepted", _where("line_holders", _HOLDER_BAD)),
        *[
            ("monthly_bank_stock_summary", f"{c}_not_null", "SELECT 0")
            for c in ("symbol", "month_date", "avg_open_price", "avg_close_price", "avg_volume")
        ],
        ("monthly_bank_stock_summary", "symbol_in_dimension", _unknown_symbols("summary")),
        ("monthly_bank_stock_summary", "one_row_per_symbol_month", _repeated("summary", "symbol, month_date")),
    ),
)
def k2_model_checks(spark, sf_dir):
    """All checks of dimension, facts and summary, over a dimension that lacks
    the suppliers and over facts with repeated keys (K1-K8, D5, E9)."""
    market = st.stored_market(spark, sf_dir)
    known = dict(market)
    known.update({n: market[n].where(F.lit(False)) for n in (DAILY_PRICE.name, HOLDERS.name)})
    dimension = models.dimension(known, st.LOADED_AT)
    facts = {n: models.fact_rows(market[f.source.name], f) for n, f in FACTS.items()}
    summary = models.monthly_summary(market[DAILY_PRICE.name])
    return q.run_suite(checks.model_checks(dimension, facts, summary, st.LOADED_AT))


_IN_WINDOW = f"price_date BETWEEN DATE '{_START}' AND DATE '{_END}'"
_DISORDERED = "high_price < greatest(low_price, open_price, close_price) OR low_price > least(open_price, close_price)"
_MART_REQUIRED = (
    "symbol year month month_start_date month_end_date avg_open_price avg_close_price avg_volume "
    "trading_days_count min_price_date max_price_date source_row_count loaded_at"
).split()


@trial(
    "k9_mart_checks",
    f"WITH {st.QUOTES_SQL}, {st.SUPPLIER_PROFILES_SQL}, {MART_SQL.format(source='quotes')} "
    + _report(
        ("cur_stock_daily_price", "ohlc_ordered_in_window", _where("quotes", f"{_IN_WINDOW} AND ({_DISORDERED})")),
        ("cur_stock_daily_price", "every_year_present", "SELECT 1"),
        *_nulls("mart_monthly_stock_summary", "mart", *_MART_REQUIRED),
        ("mart_monthly_stock_summary", "year_accepted", _where("mart", "year NOT IN (1996, 2024)")),
        ("mart_monthly_stock_summary", "years_in_scope", _where("mart", "year NOT IN (1996, 2024)")),
        (
            "mart_monthly_stock_summary",
            "dates_ordered",
            _where("mart", "min_price_date > max_price_date OR month_start_date > month_end_date"),
        ),
        ("mart_monthly_stock_summary", "month_in_range", _where("mart", "month < 1 OR month > 12")),
        (
            "mart_monthly_stock_summary",
            "metrics_non_negative",
            _where("mart", "avg_open_price < 0 OR avg_close_price < 0 OR avg_volume < 0"),
        ),
        ("mart_monthly_stock_summary", "rows_cover_days", _where("mart", "source_row_count < trading_days_count")),
        ("mart_monthly_stock_summary", "trading_days_positive", _where("mart", "trading_days_count <= 0")),
        ("mart_monthly_stock_summary", "one_row_per_symbol_month", _repeated("mart", "symbol, year, month")),
        (
            "mart_monthly_stock_summary",
            "every_symbol_present",
            f"SELECT count(DISTINCT symbol) FROM quotes WHERE {_IN_WINDOW} AND symbol NOT IN (SELECT symbol FROM mart)",
        ),
        ("mart_monthly_stock_summary", "filled_when_curated_is", "SELECT 0"),
    ),
)
def k9_mart_checks(spark, sf_dir):
    """All 25 checks of the monthly mart over rows that break some of them.

    The expected years include one without data and leave one out.
    """
    prices = st.quotes(spark, sf_dir)
    mart = models.monthly_mart(prices, st.supplier_profiles(spark, sf_dir), st.LOADED_AT, *st.WINDOW)
    return q.run_suite(checks.mart_checks(prices, mart, *st.WINDOW, years=(1996, 2024)))


@trial(
    "k5_ohlc_violations",
    rendered(
        "symbol:s price_date:d open_price:n high_price:n low_price:n close_price:n",
        f"SELECT * FROM quotes WHERE {_DISORDERED} OR open_price < 0 OR high_price < 0 OR low_price < 0 OR close_price < 0",
        st.QUOTES_SQL,
    ),
)
def k5_ohlc_violations(spark, sf_dir):
    """Violating rows themselves, with the columns a reader needs."""
    bad = st.quotes(spark, sf_dir).where(q.ohlc_out_of_range())
    return bad.select("symbol", "price_date", "open_price", "high_price", "low_price", "close_price")


@trial("k6_negative_balances", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0")
def k6_negative_balances(spark, sf_dir):
    return st.table(spark, sf_dir, "customer").where(q.negative("c_acctbal")).select("c_custkey", "c_acctbal")


@trial(
    "g2_violation_sample",
    rendered(
        "symbol:s price_date:d l_orderkey:i l_linenumber:i close_price:n",
        f"""SELECT * FROM quotes WHERE {_IN_WINDOW} AND ({_DISORDERED})
            ORDER BY symbol, price_date, l_orderkey, l_linenumber, close_price LIMIT 50""",
        st.QUOTES_SQL,
    ),
)
def g2_violation_sample(spark, sf_dir):
    """The first 50 violations in key order."""
    bad = q.in_window(st.quotes(spark, sf_dir), "price_date", *st.WINDOW).where(q.ohlc_disordered())
    order = ("symbol", "price_date", "l_orderkey", "l_linenumber", "close_price")
    return q.sample(bad.select(*order), order, 50)


@trial(
    "k10_missing_years",
    """SELECT CAST(y AS BIGINT) AS missing_year FROM (VALUES (1994), (1996), (1997), (2000), (2024)) AS v(y)
       WHERE y NOT IN (SELECT year(o_orderdate) FROM orders WHERE o_orderdate >= TIMESTAMP '1990-01-01' AND o_orderdate < TIMESTAMP '2025-01-01')""",
)
def k10_missing_years(spark, sf_dir):
    orders = st.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day"))
    return q.missing_years(orders, "day", "1990-01-01", "2024-12-31", (1994, 1996, 1997, 2000, 2024))


@trial(
    "k15_uncovered_symbols",
    f"""WITH {st.DAILY_SQL} SELECT DISTINCT symbol AS symbol_missing_from_mart FROM daily WHERE {_IN_WINDOW}
        AND symbol NOT IN (SELECT 'S' || CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_acctbal > 0)""",
)
def k15_uncovered_symbols(spark, sf_dir):
    """Traded suppliers that a table of solvent ones lacks."""
    solvent = st.table(spark, sf_dir, "supplier").where("s_acctbal > 0").select(st.tagged("S", "s_suppkey").alias("symbol"))
    return q.uncovered_symbols(st.daily_prices(spark, sf_dir), solvent, "price_date", *st.WINDOW)


@trial(
    "k18_empty_target",
    """SELECT CAST(count(*) AS BIGINT) AS source_rows, CAST(0 AS BIGINT) AS target_rows FROM orders
       WHERE (SELECT count(*) FROM lineitem WHERE l_quantity < 0) = 0 HAVING count(*) > 0""",
)
def k18_empty_target(spark, sf_dir):
    """A target without rows while its source has some."""
    nothing = st.table(spark, sf_dir, "lineitem").where("l_quantity < 0")
    return q.empty_while_source_has_rows(st.table(spark, sf_dir, "orders"), nothing)


@trial(
    "k19_gates",
    f"""WITH {st.DAILY_SQL} SELECT 'landing_to_curated' AS gate, 'pass' AS outcome, CAST((SELECT count(*) FROM lineitem) AS BIGINT) AS upstream_rows,
          CAST((SELECT count(*) FROM daily) AS BIGINT) AS downstream_rows
        UNION ALL SELECT 'landing_to_curated_empty', 'fail', NULL, NULL
        UNION ALL SELECT 'curated_to_mart', 'pass', (SELECT count(*) FROM daily WHERE {_IN_WINDOW}),
          (SELECT count(*) FROM (SELECT DISTINCT symbol, date_trunc('month', price_date) FROM daily WHERE {_IN_WINDOW}) AS m)
        UNION ALL SELECT 'curated_to_mart_empty', 'fail', NULL, NULL""",
)
def k19_gates(spark, sf_dir):
    """Both gates with a filled and with an emptied downstream table."""
    lines, daily = st.table(spark, sf_dir, "lineitem"), st.daily_prices(spark, sf_dir)
    mart = models.monthly_mart(daily, st.supplier_profiles(spark, sf_dir), st.LOADED_AT, *st.WINDOW)
    nothing = F.lit(False)
    gates = {
        "landing_to_curated": lambda: q.gate_landing_to_curated(lines, daily),
        "landing_to_curated_empty": lambda: q.gate_landing_to_curated(lines, daily.where(nothing)),
        "curated_to_mart": lambda: q.gate_curated_to_mart(daily, mart, "price_date", *st.WINDOW),
        "curated_to_mart_empty": lambda: q.gate_curated_to_mart(daily, mart.where(nothing), "price_date", *st.WINDOW),
    }
    rows = []
    for gate, run in gates.items():
        try:
            counts = list(run().values())
            rows.append((gate, "pass", counts[0], counts[1]))
        except q.QualityFailure:
            rows.append((gate, "fail", None, None))
    return spark.createDataFrame(rows, "gate string, outcome string, upstream_rows bigint, downstream_rows bigint")


