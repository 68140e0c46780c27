"""Mappers on hand-made records: skips, defaults and precedence."""

from __future__ import annotations

import json
from datetime import date, datetime, timezone
from decimal import Decimal
from functools import reduce

import pytest
from pyspark.sql import functions as F

from tidemark.operators.filters import REASON, accepted
from tidemark.plans import jobs, landing, payloads, second_source
from tidemark.registry import BASIC_INFO, DAILY_PRICE, FUNDAMENTALS, HOLDERS, RATINGS
from tidemark.sources.envelopes import read_envelopes, with_arrival, write_envelopes

AT = datetime(2024, 2, 1, 7, tzinfo=timezone.utc)
BATCH = landing.Batch("b1", date(2024, 2, 1), AT, "test")


def envelopes(spark, *records):
    """(dataset, symbol, record_date, payload) tuples, numbered in order."""
    rows = [(d, s, r, json.dumps(p), n) for n, (d, s, r, p) in enumerate(records)]
    df = spark.createDataFrame(rows, "dataset string, symbol string, record_date date, text string, seq bigint")
    return with_arrival(df.withColumn("payload", F.parse_json("text")).drop("text"))


def rows(df):
    return [r.asDict() for r in accepted(df).orderBy(landing.ARRIVAL, landing.ELEMENT).collect()]


def reasons(df):
    return [r[0] for r in df.orderBy(landing.ARRIVAL, landing.ELEMENT).select(REASON).collect()]


def test_profiles(spark):
    df = landing.profile_rows(
        envelopes(
            spark,
            ("basics", " jpm ", None, {"company_name": " JP ", "market_cap": {"raw": 5}, "currency": "", "exchange": "N" * 30}),
            ("basics", "", None, {"company_name": "x"}),
            ("basics", None, None, {"company_name": "x"}),
            ("basics", "a", None, {"city": "only a city", "fullTimeEmployees": 0}),
            ("basics", "b", None, {"website": "w", "fullTimeEmployees": {"raw": 7}}),
        ),
        BATCH,
    )
    assert reasons(df) == [None, "missing_symbol", "missing_symbol", "hollow_profile", None]
    first, second = rows(df)
    assert (first["symbol"], first["company_name"], first["market_cap"]) == ("JPM", "JP", Decimal("5.00"))
    assert (first["currency"], first["exchange"]) == (None, "N" * 30)
    assert (second["employee_count"], second["snapshot_date"], second["ingested_at"]) == (7, date(2024, 2, 1), AT.replace(tzinfo=None))


def test_prices(spark):
    good = {"open": 1, "high": {"raw": 2}, "low": "1", "close": 1.5, "volume": 10.9}
    day = date(2024, 1, 2)
    df = landing.price_rows(
        envelopes(
            spark,
            ("daily_prices", "A", day, good),
            ("daily_prices", "A", None, good),
            ("daily_prices", "A", day, {**good, "volume": None}),
            ("daily_prices", "A", day, {**good, "low": "n/a"}),
        ),
        BATCH,
    )
    assert reasons(df) == [None, "missing_date", "missing_ohlcv", "missing_ohlcv"]
    assert rows(df)[0]["volume"] == 10


def test_fundamentals(spark):
    end = {"raw": 1703980800}  # 2023-12-31
    df = landing.fundamental_rows(
        envelopes(
            spark,
            ("fundamentals", "A", None, {"totalAssets": 9, "balanceSheetStatements": [{"endDate": end, "totalAssets": {"raw": 0}, "totalDebt": 3}]}),
            ("fundamentals", "B", None, {"totalDebt": {"raw": 4}, "balanceSheetStatements": [{"totalAssets": 1}, 5]}),
            ("fundamentals", "C", None, {"balanceSheetStatements": []}),
            ("fundamentals", " ", None, {"totalDebt": 1, "balanceSheetStatements": [{"endDate": end}, {"endDate": end}]}),
            ("fundamentals", "D", None, {"balanceSheetStatements": [{"endDate": end, "totalAssets": 0}]}),
        ),
        BATCH,
    )
    assert reasons(df) == [None, None, "missing_symbol", None]
    a, b, d = rows(df)
    assert (a["period_type"], a["statement_date"], a["total_assets"], a["total_debt"]) == ("quarterly", date(2023, 12, 31), 9, 3)
    assert (b["period_type"], b["statement_date"], b["total_debt"], b["total_assets"]) == ("ttm", date(2024, 2, 1), 4, None)
    assert d["total_assets"] is None


def test_holders(spark):
    day = date(2024, 1, 2)
    df = landing.holder_rows(
        envelopes(
            spark,
            ("holders", "a", day, {"holder": " ", "holder_type": " Fund ", "shares": {"raw": 2}}),
            ("holders", "a", None, {"holder": "x"}),
            ("holders", "a", None, {"majorHoldersBreakdown": {}}),
            ("holders", "a", day, {"holder": "y" * 3000, "majorHoldersBreakdown": {}}),
        ),
        BATCH,
    )
    assert reasons(df) == [None, "missing_date", None, None]
    fund, major, named = rows(df)
    assert (fund["holder_type"], fund["holder_name"], fund["shares"]) == ("mutual_fund", "UNKNOWN_HOLDER", 2)
    assert (major["holder_type"], major["holder_name"], major["holdings_date"]) == ("major", "_major_holders_breakdown", date(2024, 2, 1))
    assert (named["holder_type"], len(named["holder_name"])) == ("unknown", 3000)


def test_ratings(spark):
    df = landing.rating_rows(
        envelopes(
            spark,
            ("ratings", "a", None, {"firm": " ", "epochGradeDate": {"raw": 1704067200}, "to_grade": "g" * 60, "action": "u" * 40}),
            ("ratings", "a", None, {"firm": "x"}),
            ("ratings", "a", date(2024, 1, 5), {"firm": "f" * 600, "epochGradeDate": 1, "recommendation_score": 2.34567}),
        ),
        BATCH,
    )
    assert reasons(df) == [None, "missing_date", None]
    first, second = rows(df)
    assert (first["firm_name"], first["rating_date"], len(first["to_grade"]), len(first["rating_action"])) == ("UNKNOWN_FIRM", date(2024, 1, 1), 60, 40)
    assert (len(second["firm_name"]), second["rating_date"], second["recommendation_score"]) == (600, date(2024, 1, 5), Decimal("2.3457"))


def documents(spark, *docs):
    df = spark.createDataFrame([(s, json.dumps(d), n) for n, (s, d) in enumerate(docs)], "symbol string, text string, seq bigint")
    return df.withColumn("payload", F.parse_json("text")).drop("text")


def test_chart_window_and_short_arrays(spark):
    day = 86400
    start = 1704067200  # 2024-01-01
    quote = {"open": [1, 2, 3, 4], "high": [1, 2, 3, 4], "low": [1, 2, 3, 4], "close": [1, 2, 3, 4], "volume": [5, 6]}
    chart = {"chart": {"result": [{"timestamp": [start - day, start, start + day, start + 2 * day], "indicators": {"quote": [quote]}}]}}
    records = payloads.price_records(documents(spark, ("a", chart), ("b", {"chart": {"result": []}}), ("c", {})), "2024-01-01", "2024-01-02")
    df = landing.price_rows(with_arrival(records), BATCH)
    assert reasons(df) == [None, "missing_ohlcv"]
    assert (rows(df)[0]["price_date"], rows(df)[0]["volume"]) == (date(2024, 1, 1), 6)


def test_name_precedence(spark):
    def doc(profile, price):
        return {"quoteSummary": {"result": [{"assetProfile": profile, "price": price}]}}

    docs = documents(
        spark,
        ("a", doc({"longName": "1", "name": "4"}, {"longName": "2"})),
        ("b", doc({"longName": "", "name": "4"}, {"longName": "2", "shortName": "3"})),
        ("c", doc({"name": "4"}, {"shortName": "3"})),
        ("d", doc({"name": "4", "industry": "Banks"}, {})),
        ("e", {"quoteSummary": {"result": None}}),
    )
    df = landing.profile_rows(with_arrival(payloads.profile_records(docs)), BATCH)
    assert [r["company_name"] for r in rows(df)] == ["1", "2", "3", "4"]
    assert reasons(df)[-1] == "hollow_profile"


def test_column_resolution(spark):
    df = spark.createDataFrame([("a", 1, "x")], "symbol string, `SHARES` int, `Other` string")
    assert second_source.resolve(df, ("shares",)) == "SHARES"
    assert second_source.resolve(df, ("missing", "other")) == "Other"
    assert second_source.resolve(df, ("missing",)) is None
    assert second_source.holders_fallback(df, "institution").count() == 0


def test_unreadable_lines_fail(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"dataset": "basics", "symbol": "A", "payload": {}}\nnot json\n')
    with pytest.raises(Exception, match="unreadable envelope"):
        read_envelopes(spark, str(tmp_path)).select("dataset").collect()


def test_array_file_and_default_source(spark, tmp_path):
    records = [
        {"dataset": "basics", "symbol": "A", "record_date": None, "payload": {"a": 1}, "load_timestamp": "2024-01-01T05:00:00"},
        {"dataset": "basics", "symbol": "B", "record_date": "2024-01-02", "payload": {}, "source": "s", "load_timestamp": "2024-01-01T05:00:00+02:00"},
    ]
    (tmp_path / "batch.json").write_text(json.dumps(records))
    got = read_envelopes(spark, str(tmp_path), array_files=True).orderBy("symbol").collect()
    assert [(r["symbol"], r["source"], r["record_date"]) for r in got] == [("A", "yahoo_finance", None), ("B", "s", date(2024, 1, 2))]
    assert [r["load_timestamp"].hour for r in got] == [5, 3]


def test_keys_alike_at_their_start_stay_apart(spark):
    """Two symbols and two holders that differ only after the old column widths."""
    day = date(2024, 1, 2)
    quote = {"open": 1, "high": 1, "low": 1, "close": 1, "volume": 1}
    prices = landing.price_rows(
        envelopes(spark, ("daily_prices", "x" * 20 + "1", day, quote), ("daily_prices", "x" * 20 + "2", day, quote)), BATCH
    )
    assert len({r["symbol"] for r in rows(prices)}) == 2
    holders = landing.holder_rows(
        envelopes(
            spark,
            ("holders", "a", day, {"holder": "y" * 2000 + "1", "holder_type": "k" * 30 + "1"}),
            ("holders", "a", day, {"holder": "y" * 2000 + "2", "holder_type": "k" * 30 + "2"}),
        ),
        BATCH,
    )
    assert len({r["holder_name"] for r in rows(holders)}) == len({r["holder_type"] for r in rows(holders)}) == 2


def test_second_source_tolerates_its_data(spark):
    """Bad text is null, two spellings of a day are one period, an unnamed date column is found."""
    wide = spark.createDataFrame(
        [("a", "Total Assets", "5", "7"), ("a", "Total Debt", "n/a", None)], "symbol string, metric string, `2024-03-31` string, `2024-3-31` string"
    )
    periods = second_source.statement_periods(wide, "metric", ["2024-03-31", "2024-3-31"])
    assert [tuple(r) for r in periods.collect()] == [("a", date(2024, 3, 31), Decimal(7), None)]
    info = spark.createDataFrame([("a", "n/a", 9007199254740993)], "symbol string, totalDebt string, sharesOutstanding bigint")
    record = second_source.fundamentals_fallback(info, periods).select("payload").first()["payload"].toPython()
    assert record["sharesOutstanding"] == {"raw": 9007199254740993} and record["totalDebt"] is None
    assert [s["totalAssets"] for s in record["balanceSheetStatements"]] == [{"raw": 7}]
    profile = spark.createDataFrame([("a", "n/a", "Bank")], "symbol string, fullTimeEmployees string, longName string")
    assert second_source.profile_fallback(profile).count() == 1
    grades = spark.createDataFrame([("a", date(2024, 1, 5), "F")], "symbol string, unnamed date, Firm string")
    assert second_source.ratings_fallback(grades).first()["record_date"] == date(2024, 1, 5)


def test_later_load_wins_over_a_higher_number(spark, tmp_path):
    """Numbers count inside a load: the newer load's record wins though its number is smaller."""
    for name, hour, seq in (("load-0", 1, 80), ("load-1", 2, 20)):
        part = envelopes(spark, ("ratings", "a", date(2024, 1, 2), {"firm": name})).drop("arrival", "seq").withColumn("source", F.lit("t"))
        part = part.withColumn("seq", F.lit(seq).cast("bigint")).withColumn("load_timestamp", F.lit(datetime(2024, 1, 1, hour)))
        write_envelopes(part, str(tmp_path), name)
    read = read_envelopes(spark, f"{tmp_path}/*")
    assert read.orderBy(F.desc("arrival")).first()["payload"].toPython() == {"firm": "load-1"}


def test_two_sources_make_one_batch(spark, tmp_path, lake):
    """P8 over all datasets with the library's own records on both sides: merge, write, read, ingest."""
    day, at = date(2024, 1, 2), datetime(2024, 1, 1, 5)
    summary = {
        "quoteSummary": {"result": [{
            "assetProfile": {"longName": "Bank A", "industry": "Banks", "sector": "F"},
            "financialData": {"totalAssets": {"raw": 9}},
            "institutionOwnership": {"ownershipList": [{"organization": "O1", "position": {"raw": 3}, "reportDate": {"raw": 1704067200}}, {"organization": "O2", "position": {"raw": 4}, "reportDate": {"raw": 1704067200}}]},
            "upgradeDowngradeHistory": {"history": [{"firm": "F1", "toGrade": "Buy", "epochGradeDate": 1704067200}]},
        }]}
    }
    chart = {"chart": {"result": [{"timestamp": [1704153600], "indicators": {"quote": [{"open": [1], "high": [2], "low": [1], "close": [2], "volume": [7]}]}}]}}
    empty = {"quoteSummary": {"result": [{}]}}

    def documents(*rows):
        df = spark.createDataFrame([(s, json.dumps(d), n) for n, (s, d) in enumerate(rows)], "symbol string, text string, seq bigint")
        return df.withColumn("payload", F.parse_json("text")).drop("text")

    answers, charts = documents((" a ", summary), ("B", empty)), documents(("A", chart))
    primary = [
        payloads.profile_records(answers), payloads.statement_records(answers), payloads.ownership_records(answers),
        payloads.grade_records(answers), payloads.price_records(charts, day, day),
    ]
    info = spark.createDataFrame([("a", "Other", 5, 1), ("b", "Bank B", 6, 2)], "symbol string, longName string, totalAssets bigint, seq bigint")
    wide = spark.createDataFrame([("b", "Total Assets", 8.0)], "symbol string, metric string, `2023-12-31` double")
    held = spark.createDataFrame([("b", "H", 5, day, 1), ("A", "X", 5, day, 2)], "symbol string, Holder string, Shares bigint, Date date, seq bigint")
    graded = spark.createDataFrame([("c", "G", day, 1), ("a", "G", day, 2)], "symbol string, Firm string, Date date, seq bigint")
    fallback = [
        second_source.profile_fallback(info),
        second_source.fundamentals_fallback(info, second_source.statement_periods(wide, "metric", ["2023-12-31"])),
        second_source.holders_fallback(held, "institution"), second_source.ratings_fallback(graded),
    ]
    union = lambda parts: reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
    merged = jobs.merge_batches(union(primary), union(fallback), loaded_at=at)
    path = write_envelopes(merged, str(tmp_path), "both")
    jobs.ingest_batch(lake, read_envelopes(spark, path), BATCH)
    tables = {name: {(r.symbol, *extra(r)) for r in lake.landing(spec).collect()} for name, (spec, extra) in {
        "basics": (BASIC_INFO, lambda r: (r.company_name,)), "fundamentals": (FUNDAMENTALS, lambda r: (r.total_assets,)),
        "holders": (HOLDERS, lambda r: (r.holder_name,)), "ratings": (RATINGS, lambda r: (r.firm_name,)),
        "prices": (DAILY_PRICE, lambda r: (r.volume,)),
    }.items()}
    assert tables["basics"] == {("A", "Bank A"), ("B", "Bank B")}
    assert tables["fundamentals"] == {("A", 9), ("B", 8)}
    assert ("A", "O1") in tables["holders"] and ("A", "O2") in tables["holders"] and ("A", "X") not in tables["holders"]
    assert tables["ratings"] == {("A", "F1"), ("C", "G")}
    assert tables["prices"] == {("A", 7)}
