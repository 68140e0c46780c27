"""Every row check has a passing and a failing case."""

from __future__ import annotations

from datetime import date

import pytest

from tidemark.operators import quality as q
from tidemark.plans.checks import mart_checks, model_checks, source_checks, staging_checks
from tidemark.registry import MONTHLY_MART_SCHEMA, MONTHLY_SUMMARY_SCHEMA, DIMENSION_SCHEMA, FACTS, TABLES
from tidemark.plans import models

D = date


@pytest.mark.parametrize(
    "check, schema, good, bad",
    [
        (lambda: q.is_null("a"), "a int", (1,), (None,)),
        (lambda: q.not_accepted("a", ("x",)), "a string", ("x",), ("y",)),
        (lambda: q.ohlc_out_of_range(), "open_price int, high_price int, low_price int, close_price int", (2, 3, 1, 2), (2, 3, 3, 2)),
        (lambda: q.ohlc_out_of_range(), "open_price int, high_price int, low_price int, close_price int", (0, 0, 0, 0), (-1, 0, -1, 0)),
        (lambda: q.ohlc_disordered(), "open_price int, high_price int, low_price int, close_price int", (-1, -1, -1, -1), (1, 0, 1, 1)),
        (lambda: q.negative("a"), "a int", (0,), (-1,)),
        (lambda: q.negative("a", "b"), "a int, b int", (0, 1), (1, -1)),
        (
            lambda: q.dates_disordered(),
            "min_price_date date, max_price_date date, month_start_date date, month_end_date date",
            (D(2024, 1, 1), D(2024, 1, 1), D(2024, 1, 1), D(2024, 1, 31)),
            (D(2024, 1, 2), D(2024, 1, 1), D(2024, 1, 1), D(2024, 1, 31)),
        ),
        (lambda: q.month_out_of_range(), "month int", (12,), (13,)),
        (lambda: q.fewer_rows_than_days(), "source_row_count int, trading_days_count int", (2, 2), (1, 2)),
        (lambda: q.no_trading_days(), "trading_days_count int", (1,), (0,)),
    ],
)
def test_row_checks(spark, check, schema, good, bad):
    df = spark.createDataFrame([good, bad], schema)
    check = check()
    assert [tuple(r) for r in df.where(check).collect()] == [bad]
    report = q.run_suite([q.TableChecks("t", df, {"c": check})])
    assert [tuple(r) for r in report.collect()] == [("t", "c", 1)]


def test_null_passes_accepted_values(spark):
    assert spark.createDataFrame([(None,)], "a string").where(q.not_accepted("a", ("x",))).count() == 0


def test_set_checks(spark):
    df = spark.createDataFrame([(1, 5), (1, 6), (None, 7), (None, 8), (2, 9)], "k int, v int")
    assert [tuple(r) for r in q.duplicates(df, ["k"]).collect()] == [(1, 2)]
    parents = spark.createDataFrame([(2,)], "p int")
    assert [tuple(r) for r in q.orphans(df, "k", parents, "p").collect()] == [(1, 2)]
    assert q.empty_while_source_has_rows(df, df).count() == 0
    assert q.empty_while_source_has_rows(df.limit(0), df.limit(0)).count() == 0
    assert q.empty_while_source_has_rows(df, df.limit(0)).count() == 1


def test_all_checks_report_before_failing(spark):
    df = spark.createDataFrame([(None, -1)], "a int, b int")
    report = q.run_suite([q.TableChecks("t", df, {"a_not_null": q.is_null("a"), "b_ok": q.negative("b")})])
    with pytest.raises(q.QualityFailure, match="2 of 2 checks failed: t.a_not_null=1, t.b_ok=1"):
        q.require_clean(report)


def test_number_of_declared_checks(spark):
    tables = {n: spark.createDataFrame([], s.schema) for n, s in TABLES.items()}

    def size(checks):
        return sum(len(c.rows) + len(c.sets) for c in checks)

    assert size(source_checks(tables)) == 10
    assert size(staging_checks(tables)) == 10
    dimension = spark.createDataFrame([], DIMENSION_SCHEMA)
    facts = {n: spark.createDataFrame([], models.fact_schema(f)) for n, f in FACTS.items()}
    summary = spark.createDataFrame([], MONTHLY_SUMMARY_SCHEMA)
    assert size(model_checks(dimension, facts, summary, "2024-01-01T00:00:00Z")) == 25 + 4
    mart = spark.createDataFrame([], MONTHLY_MART_SCHEMA)
    assert size(mart_checks(tables["stock_daily_price"], mart)) == 14 + 11
