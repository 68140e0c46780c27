"""Trials of row rules and anti-joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import fallback, filters
from tidemark.operators.lookups import missing_keys, orphan_counts
from tidemark.plans import payloads
from tidemark.registry import DAILY_PRICE, RATINGS
from tidemark.trials import documents as docs, standins as st, trial
from tidemark.trials.compare import rendered

_QUOTE_COLUMNS = "symbol:s price_date:d open_price:n high_price:n low_price:n close_price:n volume:i"
_QUOTE_NAMES = [c.split(":")[0] for c in _QUOTE_COLUMNS.split()]


@trial(
    "c2_hollow_profiles",
    "SELECT c_custkey, c_custkey % 5 = 4 AS hollow FROM customer JOIN nation ON c_nationkey = n_nationkey",
)
def c2_hollow_profiles(spark, sf_dir):
    """Profile records without any of the six presence fields."""
    records = payloads.profile_records(docs.profile_documents(spark, sf_dir))
    return records.select(F.col("seq").alias("c_custkey"), filters.hollow_profile("payload").alias("hollow"))


@trial(
    "c5_mart_quality",
    rendered(
        _QUOTE_COLUMNS,
        """SELECT * FROM quotes WHERE open_price >= 0 AND close_price >= 0 AND volume >= 0 AND high_price >= low_price
             AND high_price >= open_price AND high_price >= close_price AND low_price <= open_price AND low_price <= close_price""",
        st.QUOTES_SQL,
    ),
)
def c5_mart_quality(spark, sf_dir):
    return st.quotes(spark, sf_dir).where(filters.mart_quality()).select(*_QUOTE_NAMES)


@trial(
    "c6_summary_quality",
    rendered(
        _QUOTE_COLUMNS,
        """SELECT * REPLACE (CASE WHEN volume <> 7 THEN volume END AS volume) FROM quotes
           WHERE open_price >= 0 AND close_price >= 0 AND volume >= 0 AND volume <> 7""",
        st.QUOTES_SQL,
    ),
)
def c6_summary_quality(spark, sf_dir):
    """Null volumes are dropped with the negative ones."""
    quotes = st.quotes(spark, sf_dir).withColumn("volume", F.when(F.col("volume") != 7, F.col("volume")))
    return quotes.where(filters.summary_quality()).select(*_QUOTE_NAMES)


@trial(
    "c9_hollow_primary",
    """SELECT dataset, c_custkey % 4 AS kind, CAST(count(*) FILTER (WHERE hollow) AS BIGINT) AS hollow_records,
         CAST(count(*) AS BIGINT) AS records
       FROM (SELECT c_custkey, 'basics' AS dataset, c_custkey % 4 <> 1 AS hollow FROM customer
             UNION ALL SELECT c_custkey, 'fundamentals', c_custkey % 4 NOT IN (1, 2) FROM customer
             UNION ALL SELECT c_custkey, 'holders', false FROM customer) AS r
       GROUP BY dataset, c_custkey % 4""",
)
def c9_hollow_primary(spark, sf_dir):
    """Hollow records per dataset: falsy members, empty statement lists, zero headlines that count."""
    key = F.col("c_custkey")
    kind = key % 4
    customer = st.table(spark, sf_dir, "customer").select("c_custkey")
    profile = docs.document(
        F.struct(
            F.when(kind == 1, F.lit("BANK")).otherwise(F.lit("")).alias("industry"),
            F.when(kind == 2, F.lit(0)).alias("fullTimeEmployees"),
            F.lit("www").alias("website"),
        )
    )
    figures = docs.document(
        F.struct(
            F.when(kind == 1, F.lit(0)).alias("totalDebt"),
            F.when(kind == 2, F.array(F.struct(F.lit(1).alias("endDate"))))
            .when(kind == 3, F.filter(F.array(F.struct(F.lit(1).alias("endDate"))), lambda _: F.lit(False)))
            .alias("balanceSheetStatements"),
        )
    )
    position = docs.document(F.struct(F.lit(None).cast("string").alias("holder")))
    parts = {"basics": profile, "fundamentals": figures, "holders": position}
    records = None
    for dataset, payload in parts.items():
        part = customer.select("c_custkey", F.lit(dataset).alias("dataset"), payload.alias("payload"))
        records = part if records is None else records.unionByName(part)
    flagged = records.withColumn("hollow", fallback.hollow_primary())
    return flagged.groupBy("dataset", kind.alias("kind")).agg(
        F.count_if("hollow").alias("hollow_records"), F.count(F.lit(1)).alias("records")
    )


@trial(
    "c12_constraint_counts",
    """SELECT CAST(count(*) FILTER (WHERE l_orderkey IS NULL) AS BIGINT) AS key_not_null,
         CAST(count(*) FILTER (WHERE open_price < 0 OR high_price < 0 OR low_price < 0 OR close_price < 0) AS BIGINT) AS prices_non_negative,
         CAST(count(*) FILTER (WHERE high_price < low_price OR high_price < greatest(open_price, close_price)
                                  OR low_price > least(open_price, close_price)) AS BIGINT) AS ohlc_consistent,
         CAST(count(*) FILTER (WHERE volume < 0) AS BIGINT) AS volume_non_negative
       FROM quotes""".replace("SELECT CAST", f"WITH {st.QUOTES_SQL} SELECT CAST", 1),
)
def c12_constraint_counts(spark, sf_dir):
    """All price constraints counted in one pass."""
    quotes = st.quotes(spark, sf_dir).withColumn("adjusted_close", F.lit(None).cast("decimal(18,6)"))
    counts = filters.constraint_counts(quotes, DAILY_PRICE.checks, ["l_orderkey"])
    return counts.withColumnRenamed("l_orderkey_not_null", "key_not_null")


@trial(
    "c12_quarantine",
    f"""WITH {st.QUOTES_SQL} SELECT skip_reason, CAST(count(*) AS BIGINT) AS n FROM (
          SELECT CASE WHEN open_price < 0 OR high_price < 0 OR low_price < 0 OR close_price < 0 THEN 'prices_non_negative'
            WHEN high_price < greatest(low_price, open_price, close_price) OR low_price > least(open_price, close_price)
              THEN 'ohlc_consistent'
            WHEN volume < 0 THEN 'volume_non_negative' ELSE 'accepted' END AS skip_reason FROM quotes) AS q
        GROUP BY skip_reason""",
)
def c12_quarantine(spark, sf_dir):
    """Rows set aside by the first constraint they break, and the rest."""
    quotes = st.quotes(spark, sf_dir).withColumn("adjusted_close", F.lit(None).cast("decimal(18,6)"))
    good, bad = filters.quarantine(quotes, DAILY_PRICE.checks)
    kept = good.agg(F.count(F.lit(1)).alias("n")).select(F.lit("accepted").alias("skip_reason"), "n")
    return bad.groupBy("skip_reason").agg(F.count(F.lit(1)).alias("n")).unionByName(kept)


@trial(
    "c12_rating_scores",
    f"""WITH {st.EVENT_RATINGS_SQL} SELECT CAST(count(*) FILTER (WHERE recommendation_score < 0) AS BIGINT) AS score_non_negative
        FROM event_ratings""",
)
def c12_rating_scores(spark, sf_dir):
    return filters.constraint_counts(st.event_ratings(spark, sf_dir), RATINGS.checks)


@trial(
    "d4_orders_without_lines",
    "SELECT o_orderkey AS missing FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
)
def d4_orders_without_lines(spark, sf_dir):
    """Keys of one table that another lacks."""
    orders = st.table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "key")
    lines = st.table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "key")
    return missing_keys(orders, lines, "key", "missing")


@trial(
    "d5_unlabelled_documents",
    """SELECT doc_id AS orphan_key, CAST(1 AS BIGINT) AS child_rows FROM documents
       WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def d5_unlabelled_documents(spark, sf_dir):
    documents, labels = st.table(spark, sf_dir, "documents"), st.table(spark, sf_dir, "labels")
    return orphan_counts(documents, "doc_id", labels, "doc_id")


@trial(
    "d5_lines_of_cheap_parts",
    """SELECT l_partkey AS orphan_key, CAST(count(*) AS BIGINT) AS child_rows FROM lineitem
       WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5) GROUP BY l_partkey""",
)
def d5_lines_of_cheap_parts(spark, sf_dir):
    """Referencing rows are counted per key before the anti-join; null keys pass."""
    lines = st.table(spark, sf_dir, "lineitem")
    parts = st.table(spark, sf_dir, "part").where("p_size > 5")
    return orphan_counts(lines, "l_partkey", parts, "p_partkey")
