"""Raw API documents built from the test tables: the input shapes of the mappers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.registry import DEFAULT_SOURCE
from tidemark.trials import standins as st

_KEEP_NULLS = {"ignoreNullFields": "false"}
LOAD_TIMESTAMP = "2024-02-01T06:00:00Z"


def document(body: Column) -> Column:
    """A struct as a VARIANT document, nulls kept."""
    return F.parse_json(F.to_json(body, _KEEP_NULLS))


def raw(c: Column) -> Column:
    return F.struct(c.alias("raw"))


def epoch(c: str | Column) -> Column:
    return F.unix_timestamp((F.col(c) if isinstance(c, str) else c).cast("timestamp"))


def summary(present: Column, **modules: Column) -> Column:
    """``quoteSummary`` with one result, or with an empty list."""
    result = F.struct(*[c.alias(n) for n, c in modules.items()])
    listed = F.when(present, F.array(result)).otherwise(F.filter(F.array(result), lambda _: F.lit(False)))
    return document(F.struct(F.struct(listed.alias("result"), F.lit(None).cast("string").alias("error")).alias("quoteSummary")))


def customers(spark, sf_dir) -> DataFrame:
    customer, nation, region = (st.table(spark, sf_dir, n) for n in ("customer", "nation", "region"))
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey
    )


CUSTOMERS_SQL = """customers AS (
  SELECT c_custkey, c_name, c_acctbal, c_mktsegment, n_name, r_name
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def profile_documents(spark, sf_dir) -> DataFrame:
    """One document per customer; the name sits in a different place for each fifth,
    and every fifth document has no result."""
    kind, key = F.col("c_custkey") % 5, F.col("c_custkey")
    name = F.col("c_name")
    size = F.abs("c_acctbal").cast("decimal(18,2)")
    return customers(spark, sf_dir).select(
        F.concat(F.lit("\t c"), key.cast("string"), F.lit(" \n")).alias("symbol"),
        key.alias("seq"),
        summary(
            kind != 4,
            assetProfile=F.struct(
                F.when(kind == 0, name).otherwise(F.lit("")).alias("longName"),
                F.when(kind == 3, name).alias("name"),
                F.col("c_mktsegment").alias("industry"),
                F.col("r_name").alias("sector"),
                key.alias("fullTimeEmployees"),
                F.col("n_name").alias("city"),
                F.col("r_name").alias("country"),
                F.concat(F.lit("Street "), key.cast("string")).alias("address1"),
            ),
            price=F.struct(
                F.when(kind == 1, name).alias("longName"),
                F.when(kind == 2, F.concat(F.lit("  "), name, F.lit(" "))).alias("shortName"),
                F.concat(F.lit("EXCHANGE OF THE "), F.col("n_name")).alias("exchangeName"),
                F.when(key % 2 == 0, raw(size)).alias("marketCap"),
            ),
            summaryDetail=F.struct(F.lit("US DOLLARS").alias("currency"), size.alias("marketCap")),
        ).alias("payload"),
    )


PROFILE_ROWS_SQL = """profile_rows AS (
  SELECT 'C' || CAST(c_custkey AS VARCHAR) AS symbol, c_name AS company_name, c_mktsegment AS industry,
    r_name AS sector, c_custkey AS employee_count, n_name AS city, r_name AS country,
    'Street ' || CAST(c_custkey AS VARCHAR) AS address, CAST(abs(c_acctbal) AS DECIMAL(18,2)) AS market_cap,
    'US DOLLARS' AS currency, 'EXCHANGE OF THE ' || n_name AS exchange
  FROM customers WHERE c_custkey % 5 <> 4)"""


def statement_documents(spark, sf_dir) -> DataFrame:
    """One document per customer with its quarters; by customer number: both
    statements and headline, headline only, nothing, statements only (those of
    March without an end date).  A quarter's list is bounded by the calendar."""
    quarters = st.order_fundamentals(spark, sf_dir)
    kind = F.first("kind")
    per_customer = (
        quarters.withColumn("kind", F.substring("symbol", 2, 20).cast("bigint") % 4)
        .groupBy("symbol")
        .agg(
            kind.alias("kind"),
            F.max("total_assets").alias("assets"),
            F.sum("total_assets").cast("decimal(22,2)").alias("debt"),
            F.max("invested_capital").alias("capital"),
            F.count(F.lit(1)).alias("quarters"),
            F.collect_list(F.struct("statement_date", "total_assets", "total_debt")).alias("statements"),
        )
    )
    kind = F.col("kind")
    headline = kind.isin(0, 1)

    def statement(s: Column) -> Column:
        undated = (kind == 3) & (F.month(s["statement_date"]) == 3)
        seconds = F.unix_date(s["statement_date"]).cast("bigint") * 86400
        return F.struct(
            F.when(~undated, raw(seconds)).alias("endDate"),
            raw(s["total_assets"]).alias("totalAssets"),
            raw(F.coalesce(s["total_debt"], F.lit(0))).alias("totalDebt"),
        )

    return per_customer.select(
        "symbol",
        F.substring("symbol", 2, 20).cast("bigint").alias("seq"),
        summary(
            F.lit(True),
            financialData=F.when(
                headline,
                F.struct(
                    raw(F.col("assets")).alias("totalAssets"),
                    F.col("debt").alias("totalDebt"),
                    F.col("capital").cast("string").alias("investedCapital"),
                ),
            ),
            defaultKeyStatistics=F.when(headline, F.struct(raw(F.col("quarters")).alias("sharesOutstanding"))),
            balanceSheetHistoryQuarterly=F.when(
                kind.isin(0, 3), F.struct(F.transform("statements", statement).alias("balanceSheetStatements"))
            ),
        ).alias("payload"),
    )


STATEMENT_ROWS_SQL = """statement_rows AS (
  SELECT symbol, statement_date, 'quarterly' AS period_type,
    coalesce(nullif(total_assets, 0), CASE WHEN kind = 0 THEN assets END) AS total_assets,
    coalesce(nullif(total_debt, 0), CASE WHEN kind = 0 THEN debt END) AS total_debt,
    CASE WHEN kind = 0 THEN capital END AS invested_capital, CASE WHEN kind = 0 THEN quarters END AS shares_issued
  FROM (SELECT *, max(total_assets) OVER w AS assets, CAST(sum(total_assets) OVER w AS DECIMAL(22,2)) AS debt,
          max(invested_capital) OVER w AS capital, count(*) OVER w AS quarters,
          CAST(substring(symbol, 2) AS BIGINT) % 4 AS kind
        FROM order_fundamentals WINDOW w AS (PARTITION BY symbol)) AS q
  WHERE kind = 0 OR (kind = 3 AND month(statement_date) <> 3)
  UNION ALL
  SELECT symbol, DATE '2024-02-01', 'ttm', max(total_assets), CAST(sum(total_assets) AS DECIMAL(22,2)),
    max(invested_capital), count(*)
  FROM order_fundamentals WHERE CAST(substring(symbol, 2) AS BIGINT) % 4 = 1 GROUP BY symbol)"""


def ownership_documents(spark, sf_dir) -> DataFrame:
    """One document per line item: an institution, an institution and a fund, or only a breakdown."""
    line = st.table(spark, sf_dir, "lineitem")
    flag = F.col("l_returnflag")
    holder = F.struct(
        F.concat(F.lit(" H"), F.col("l_partkey").cast("string")).alias("organization"),
        raw(epoch("l_shipdate")).alias("reportDate"),
        raw(F.col("l_quantity")).alias("position"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("value"),
    )
    fund = F.struct(
        F.lit("").alias("organization"),
        epoch("l_shipdate").alias("reportDate"),
        F.col("l_quantity").cast("string").alias("position"),
        raw(F.lit(None).cast("bigint")).alias("value"),
    )
    return line.select(
        st.tagged("s", "l_suppkey").alias("symbol"),
        F.col("l_orderkey").alias("seq"),
        summary(
            F.lit(True),
            institutionOwnership=F.when(flag != "N", F.struct(F.array(holder).alias("ownershipList"))),
            fundOwnership=F.when(flag == "R", F.struct(F.array(fund).alias("ownershipList"))),
            majorHoldersBreakdown=F.struct(F.lit(0.5).alias("insidersPercentHeld")),
        ).alias("payload"),
    )


OWNERSHIP_ROWS_SQL = """ownership_rows AS (
  SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS symbol, 'institution' AS holder_type,
    'H' || CAST(l_partkey AS VARCHAR) AS holder_name, CAST(l_shipdate AS DATE) AS holdings_date,
    CAST(l_quantity AS DECIMAL(22,2)) AS shares, CAST(l_extendedprice AS DECIMAL(18,2)) AS market_value
  FROM lineitem WHERE l_returnflag <> 'N'
  UNION ALL
  SELECT 'S' || CAST(l_suppkey AS VARCHAR), 'mutual_fund', 'UNKNOWN_HOLDER', CAST(l_shipdate AS DATE),
    CAST(l_quantity AS DECIMAL(22,2)), NULL FROM lineitem WHERE l_returnflag = 'R'
  UNION ALL
  SELECT 'S' || CAST(l_suppkey AS VARCHAR), 'major', '_major_holders_breakdown', DATE '2024-02-01', NULL, NULL
  FROM lineitem WHERE l_returnflag = 'N')"""


def grade_documents(spark, sf_dir) -> DataFrame:
    """One document per event: a dated grade and, for every second event, an undated one."""
    kind = F.col("event_id") % 2
    at = epoch("ts")

    def grade(firm: Column, bare: Column, wrapped: Column) -> Column:
        return F.struct(
            F.struct(wrapped.alias("raw"), F.lit("text").alias("fmt")).alias("epochGradeDate"),
            bare.alias("plain"),
            firm.alias("firm"),
            F.concat(F.lit("G"), F.get_json_object("props", "$.k")).alias("toGrade"),
            F.lit(None).cast("string").alias("fromGrade"),
            F.col("event_type").alias("action"),
        )

    nothing = F.lit(None).cast("bigint")
    dated = grade(F.when(kind == 0, F.concat(F.lit(" "), "event_type")).otherwise(F.lit("  ")), at, at)
    undated = grade(F.col("event_type"), nothing, nothing)
    history = F.when(kind == 0, F.array(dated, undated)).otherwise(F.array(dated))
    return st.table(spark, sf_dir, "events").select(
        st.tagged("u", "user_id").alias("symbol"),
        F.col("event_id").alias("seq"),
        summary(F.lit(True), upgradeDowngradeHistory=F.struct(history.alias("history"))).alias("payload"),
    )


GRADE_ROWS_SQL = """grade_rows AS (
  SELECT 'U' || CAST(user_id AS VARCHAR) AS symbol, CAST(ts AS DATE) AS rating_date,
    CASE WHEN event_id % 2 = 0 THEN event_type ELSE 'UNKNOWN_FIRM' END AS firm_name,
    'G' || regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS to_grade, event_type AS rating_action, event_id
  FROM events)"""


def chart_documents(spark, sf_dir) -> DataFrame:
    """One chart per supplier and month: at most 31 timestamps and value arrays.
    For every third supplier the volumes stop one day early."""
    daily = st.daily_prices(spark, sf_dir)
    charts = daily.groupBy("symbol", F.trunc("price_date", "MM").alias("month")).agg(
        F.sort_array(
            F.collect_list(F.struct("price_date", "open_price", "high_price", "low_price", "close_price", "volume"))
        ).alias("days")
    )

    def values(name: str) -> Column:
        return F.transform("days", lambda d: d[name])

    short = F.substring("symbol", 2, 20).cast("bigint") % 3 == 0
    volumes = values("volume")
    quote = F.struct(
        *[values(f"{n}_price").alias(n) for n in ("open", "high", "low", "close")],
        F.when(short, F.slice(volumes, F.lit(1), F.size("days") - 1)).otherwise(volumes).alias("volume"),
    )
    chart = F.struct(
        F.transform("days", lambda d: F.unix_date(d["price_date"]).cast("bigint") * 86400 + 52200).alias("timestamp"),
        F.struct(F.array(quote).alias("quote")).alias("indicators"),
    )
    return charts.select(
        F.lower("symbol").alias("symbol"),
        F.unix_date("month").cast("bigint").alias("seq"),
        document(F.struct(F.struct(F.array(chart).alias("result")).alias("chart"))).alias("payload"),
    )


CHART_ROWS_SQL = f"""chart_rows AS (
  SELECT symbol, price_date, open_price, high_price, low_price, close_price, volume
  FROM (SELECT *, max(price_date) OVER (PARTITION BY symbol, date_trunc('month', price_date)) AS last_day FROM daily) AS d
  WHERE price_date BETWEEN DATE '{st.WINDOW[0]}' AND DATE '{st.WINDOW[1]}'
    AND NOT (price_date = last_day AND CAST(substring(symbol, 2) AS BIGINT) % 3 = 0))"""


def price_envelopes(spark, sf_dir) -> DataFrame:
    """Daily price records per line item, some with a blank symbol, no date or a missing price."""
    key = F.col("l_orderkey")
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return st.table(spark, sf_dir, "lineitem").select(
        F.when(key % 9 == 0, F.lit("NONE")).otherwise(F.lit("daily_prices")).alias("dataset"),
        F.when(key % 7 == 0, F.lit(" \t")).otherwise(st.tagged("s", "l_suppkey")).alias("symbol"),
        F.when(key % 5 != 0, F.to_date("l_shipdate")).alias("record_date"),
        document(
            F.struct(
                price.alias("open"),
                raw(price).alias("high"),
                price.cast("string").alias("low"),
                F.when(key % 3 != 0, price).alias("close"),
                F.col("l_quantity").alias("volume"),
            )
        ).alias("payload"),
        F.lit(DEFAULT_SOURCE).alias("source"),
        F.lit(LOAD_TIMESTAMP).cast("timestamp").alias("load_timestamp"),
        key.alias("seq"),
    )


def rating_envelopes(spark, sf_dir) -> DataFrame:
    """One rating record per event, numbered by the event."""
    return st.table(spark, sf_dir, "events").select(
        F.lit("ratings").alias("dataset"),
        st.tagged("u", "user_id").alias("symbol"),
        F.to_date("ts").alias("record_date"),
        document(
            F.struct(
                F.col("event_type").alias("firm"),
                F.concat(F.lit("G"), F.get_json_object("props", "$.k")).alias("to_grade"),
                F.col("event_type").alias("action"),
                F.col("value").alias("recommendation_score"),
            )
        ).alias("payload"),
        F.when(F.col("event_id") % 2 == 0, F.lit("feed")).alias("source"),
        F.col("ts").cast("timestamp").alias("load_timestamp"),
        F.col("event_id").alias("seq"),
    )
