"""Trials of upsert, replace, insert-if-absent, history and incremental facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import incremental
from tidemark.operators.history import snapshot, history_schema
from tidemark.operators.merging import insert_if_absent, replace_by_key, upsert
from tidemark.plans import models
from tidemark.registry import FACTS
from tidemark.sources.lake import newer_than
from tidemark.trials import standins as st, trial
from tidemark.trials.compare import rendered

_CUT = "2024-01-25"
_CUSTOMER_CUT = "1998-06-30"


@trial(
    "a4_newer_than_watermark",
    rendered(
        "symbol:s rating_date:d firm_name:s ingested_at:t batch_id:s",
        "SELECT * FROM event_ratings WHERE ingested_at > TIMESTAMP '2024-01-20 12:00:00'",
        st.EVENT_RATINGS_SQL,
    ),
)
def a4_newer_than_watermark(spark, sf_dir):
    """Strictly after the watermark."""
    ratings = newer_than(st.event_ratings(spark, sf_dir), "2024-01-20T12:00:00Z")
    return ratings.select("symbol", "rating_date", "firm_name", "ingested_at", "batch_id")


_EVENT_KEY = ("user_id", "event_type")


@trial(
    "a7_keyed_upsert",
    f"""SELECT user_id, event_type, event_id, value FROM (
          SELECT *, ts >= TIMESTAMP '{_CUT} 00:00:00' AS in_batch FROM events) AS e
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY in_batch DESC,
          CASE WHEN in_batch THEN event_id END DESC NULLS LAST, ts DESC, event_id DESC) = 1""",
)
def a7_keyed_upsert(spark, sf_dir):
    """Events of the last week upserted into the newest older event per user and type.

    Inside the batch the last arrival (the highest number) wins.
    """
    events = st.table(spark, sf_dir, "events").select(*_EVENT_KEY, "event_id", "value", "ts")
    cut = F.lit(f"{_CUT} 00:00:00").cast("timestamp_ntz")
    older = events.where(F.col("ts") < cut)
    target = upsert(older.where(F.lit(False)).select(*_EVENT_KEY, "event_id", "value"), older, _EVENT_KEY, ["ts", "event_id"])
    return upsert(target, events.where(F.col("ts") >= cut), _EVENT_KEY, ["event_id"])


_HASHED = "SELECT doc_id, sha256(text) AS content, lang, source FROM documents"


@trial(
    "a8_insert_if_absent",
    f"""SELECT doc_id, content, lang FROM ({_HASHED}) AS d
        WHERE NOT EXISTS (SELECT 1 FROM ({_HASHED}) AS known WHERE known.lang = 'en' AND known.content = d.content
                          AND CASE WHEN known.doc_id % 2 = 0 THEN known.source END
                              IS NOT DISTINCT FROM CASE WHEN d.doc_id % 2 = 0 THEN d.source END)
        QUALIFY row_number() OVER (PARTITION BY content, CASE WHEN doc_id % 2 = 0 THEN source END ORDER BY doc_id) = 1""",
)
def a8_insert_if_absent(spark, sf_dir):
    """Whole documents by content hash and a nullable source; first arrival kept, known ones left out."""
    docs = st.table(spark, sf_dir, "documents").select(
        "doc_id",
        F.sha2("text", 256).alias("content"),
        "lang",
        F.when(F.col("doc_id") % 2 == 0, F.col("source")).alias("origin"),
    )
    known = docs.where(F.col("lang") == "en")
    return insert_if_absent(known, docs, ["content", "origin"], ["doc_id"]).select("doc_id", "content", "lang")


@trial(
    "a9_replace_by_key",
    """WITH batch AS (SELECT o_custkey AS custkey, count(*) AS orders, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS amount
                      FROM orders GROUP BY o_custkey HAVING count(*) > 9)
       SELECT custkey, CAST(NULL AS DOUBLE) AS orders, CAST(c_acctbal AS DOUBLE) AS amount
       FROM (SELECT c_custkey AS custkey, c_acctbal FROM customer) AS c
       WHERE custkey NOT IN (SELECT custkey FROM batch)
       UNION ALL SELECT custkey, CAST(orders AS DOUBLE), CAST(amount AS DOUBLE) FROM batch""",
)
def a9_replace_by_key(spark, sf_dir):
    """Matching keys are deleted and the batch added; the batch brings one
    column and drops another (A12, D6)."""
    target = st.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("custkey"), F.col("c_acctbal").cast("decimal(28,2)").alias("amount"), "c_mktsegment"
    )
    batch = (
        st.table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("custkey"))
        .agg(
            F.count(F.lit(1)).cast("double").alias("orders"),
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("amount"),
        )
        .where("orders > 9")
    )
    return replace_by_key(target, batch, ["custkey"])


@trial(
    "c8_since_own_maximum",
    rendered(
        "symbol:s rating_date:d ingested_at:t batch_id:s",
        """SELECT * FROM event_ratings WHERE ingested_at >= (
             SELECT coalesce(max(ingested_at), TIMESTAMP '1900-01-01') FROM event_ratings
             WHERE rating_date < DATE '2024-01-25')""",
        st.EVENT_RATINGS_SQL,
    ),
)
def c8_since_own_maximum(spark, sf_dir):
    """Not older than the newest target row; that row is read again."""
    ratings = st.event_ratings(spark, sf_dir)
    target = ratings.where(F.col("rating_date") < F.lit(_CUT).cast("date"))
    return incremental.since_own_maximum(ratings, target).select("symbol", "rating_date", "ingested_at", "batch_id")


@trial(
    "j5_refreshed_fact",
    rendered(
        "stock_daily_sk:s symbol:s price_date:d close_price:n volume:i",
        """SELECT md5(symbol || '|' || CAST(price_date AS VARCHAR)) AS stock_daily_sk, symbol, price_date, close_price,
             CASE WHEN ingested_at >= (SELECT max(ingested_at) FROM daily WHERE price_date < DATE '1999-06-15')
                  THEN volume ELSE volume + 1 END AS volume
           FROM daily WHERE price_date < DATE '1999-06-15'
             OR ingested_at >= (SELECT max(ingested_at) FROM daily WHERE price_date < DATE '1999-06-15')""",
        st.DAILY_SQL,
    ),
)
def j5_refreshed_fact(spark, sf_dir):
    """A fact filled up to a day is refreshed: its last day is replaced, later days are added.

    Stored volumes are one too high, which shows the rows that were replaced.
    """
    fact = FACTS["fct_stock_daily"]
    view = st.daily_prices(spark, sf_dir)
    stored = models.fact_rows(view.where(F.col("price_date") < F.lit("1999-06-15").cast("date")), fact)
    refreshed = models.refreshed_fact(stored.withColumn("volume", F.col("volume") + 1), view, fact)
    return refreshed.select("stock_daily_sk", "symbol", "price_date", "close_price", "volume")


_HISTORY_SQL = f"""WITH cuts AS (
    SELECT o_custkey, o_orderstatus, o_orderdate, o_orderkey, '{_CUSTOMER_CUT}' AS cut FROM orders
    WHERE o_orderdate <= TIMESTAMP '{_CUSTOMER_CUT} 00:00:00' AND o_custkey % 10 <> 1
    UNION ALL
    SELECT o_custkey, o_orderstatus, o_orderdate, o_orderkey, 'end' AS cut FROM orders WHERE o_custkey % 10 <> 2),
  newest AS (
    SELECT * FROM cuts
    QUALIFY row_number() OVER (PARTITION BY o_custkey, cut ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
  pairs AS (
    SELECT coalesce(a.o_custkey, b.o_custkey) AS k, a.o_orderstatus AS s1, a.o_orderdate AS d1,
      b.o_orderstatus AS s2, b.o_orderdate AS d2
    FROM (SELECT * FROM newest WHERE cut <> 'end') AS a
    FULL JOIN (SELECT * FROM newest WHERE cut = 'end') AS b ON a.o_custkey = b.o_custkey),
  versions AS (
    SELECT k, s1 AS status, d1 AS valid_from,
      CASE WHEN d2 IS NULL THEN TIMESTAMP '2002-01-01 00:00:00' WHEN d2 > d1 THEN d2 END AS valid_to
    FROM pairs WHERE d1 IS NOT NULL
    UNION ALL
    SELECT k, s2, d2, NULL FROM pairs WHERE d2 IS NOT NULL AND (d1 IS NULL OR d2 > d1))
  SELECT k AS custkey, status, md5(CAST(k AS VARCHAR) || '|' || strftime(valid_from, '%Y-%m-%d %H:%M:%S')) AS scd_id,
    strftime(valid_from, '%Y-%m-%d %H:%M:%S.%f') AS valid_from, strftime(valid_to, '%Y-%m-%d %H:%M:%S.%f') AS valid_to,
    strftime(valid_from, '%Y-%m-%d %H:%M:%S.%f') AS updated_at
  FROM versions"""


@trial("j6_history", _HISTORY_SQL)
def j6_history(spark, sf_dir):
    """Order status per customer in two snapshot runs: unchanged, changed, new and gone keys."""
    orders = st.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("custkey"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").cast("timestamp").alias("changed_at"),
        "o_orderkey",
    )

    def state(rows):
        newest = F.max(F.struct("changed_at", "o_orderkey", "status")).alias("n")
        return rows.groupBy("custkey").agg(newest).select("custkey", "n.status", "n.changed_at")

    early = state(orders.where((F.col("changed_at") <= F.lit(f"{_CUSTOMER_CUT} 00:00:00").cast("timestamp")) & (F.col("custkey") % 10 != 1)))
    late = state(orders.where(F.col("custkey") % 10 != 2))
    empty = spark.createDataFrame([], history_schema(early.schema))
    first = snapshot(empty, early, "custkey", "changed_at", "2000-01-01T00:00:00Z")
    second = snapshot(first, late, "custkey", "changed_at", "2002-01-01T00:00:00Z")
    return second.drop("changed_at")


@trial(
    "j7_freshness",
    """SELECT event_type, strftime(newest, '%Y-%m-%d %H:%M:%S.%f') AS max_loaded_at, CASE
         WHEN newest < TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 72 HOUR THEN 'error'
         WHEN newest < TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 36 HOUR THEN 'warn' ELSE 'pass' END AS state
       FROM (SELECT 'all' AS event_type, max(ts) AS newest FROM events
             UNION ALL SELECT 'early', max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-10 00:00:00'
             UNION ALL SELECT 'recent', max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-30 00:00:00') AS e""",
)
def j7_freshness(spark, sf_dir):
    """Newest event against a fixed instant: fresh, late and stale."""
    events = st.table(spark, sf_dir, "events")

    def state(name, rows):
        return incremental.freshness(rows, st.LOADED_AT, "ts").select(F.lit(name).alias("event_type"), "max_loaded_at", "state")

    def before(day):
        return events.where(F.col("ts") < F.lit(f"{day} 00:00:00").cast("timestamp_ntz"))

    return (
        state("all", events)
        .unionByName(state("early", before("2024-01-10")))
        .unionByName(state("recent", before("2024-01-30")))
    )


@trial(
    "k8_stale_load",
    """SELECT strftime(newest, '%Y-%m-%d %H:%M:%S.%f') AS max_loaded_at
       FROM (SELECT max(o_orderdate) AS newest FROM orders) AS o
       WHERE newest < TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 3 DAY OR newest IS NULL""",
)
def k8_stale_load(spark, sf_dir):
    return incremental.stale(st.table(spark, sf_dir, "orders"), st.LOADED_AT, "o_orderdate")
