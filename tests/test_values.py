"""Scalar and payload functions on edge values."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from hypothesis import given, settings, strategies as some
from pyspark.sql import functions as F

from tidemark.functions import scalars, variants


def one(spark, column, **values):
    """Value of a column expression over one row of string columns."""
    schema = ", ".join(f"{k} string" for k in values) or "_x string"
    row = tuple(values.values()) or (None,)
    return spark.createDataFrame([row], schema).select(column.alias("r")).first()[0]


@pytest.mark.parametrize(
    "text, decimal, whole",
    [
        ('{"raw": 5}', "5", 5),
        ("5", "5", 5),
        ('"7.1"', "7.1", None),
        ('"1,000"', None, None),
        ("null", None, None),
        ("{}", None, None),
        ('{"raw": null}', None, None),
        ("1.9", "1.9", 1),
        ('"1.5"', "1.5", None),
        ("true", None, 1),
        ('"NaN"', None, None),
        ('{"raw": {"a": 1}}', None, None),
        ("123.4567895", "123.456790", 123),
        ("-0.0000005", "-0.000001", 0),
        ("[]", None, None),
        ('""', None, None),
    ],
)
def test_unwrapped_numbers(spark, text, decimal, whole):
    v = F.parse_json("t")
    wanted = None if decimal is None else Decimal(decimal).quantize(Decimal("0.000001"))
    assert one(spark, variants.unwrap_decimal(v, "$", 18, 6), t=text) == wanted
    assert one(spark, variants.unwrap_long(v, "$"), t=text) == whole


@pytest.mark.parametrize("text", ["1e13", '{"raw": 1000000000000}', '"1e25"'])
def test_number_too_large_fails(spark, text):
    with pytest.raises(Exception, match="does not fit"):
        one(spark, variants.unwrap_decimal(F.parse_json("t"), "$", 18, 6), t=text)


@pytest.mark.parametrize(
    "text, day",
    [
        ('{"raw": 1704067200}', date(2024, 1, 1)),
        ("1704153599", date(2024, 1, 1)),
        ("-1", date(1969, 12, 31)),
        ('"1704067200"', date(2024, 1, 1)),
        ('"soon"', None),
        ("999999999999999", None),
        ("null", None),
    ],
)
def test_epoch_dates(spark, text, day):
    assert one(spark, variants.unwrap_date(F.parse_json("t"), "$"), t=text) == day


@pytest.mark.parametrize(
    "member, blank, falsy",
    [
        ("null", True, True),
        ('""', True, True),
        ("0", True, True),
        ("0.0", True, True),
        ("false", True, True),
        ("{}", False, True),
        ("[]", False, True),
        ('"0"', False, False),
        ("0.5", False, False),
        ('{"raw": 0}', False, False),
        ('"x"', False, False),
    ],
)
def test_blank_and_falsy(spark, member, blank, falsy):
    v = F.parse_json("t")
    assert one(spark, variants.is_blank_json(v, "$.a"), t=f'{{"a": {member}}}') is blank
    assert one(spark, variants.is_falsy_json(v, "$.a"), t=f'{{"a": {member}}}') is falsy
    assert one(spark, variants.is_blank_json(v, "$.missing"), t=f'{{"a": {member}}}') is True


def test_symbol_normalisation(spark):
    assert one(spark, scalars.normalise_symbol("t"), t=" jpm \t\n") == "JPM"
    assert one(spark, scalars.normalise_symbol("t"), t="x" * 25) == "X" * 25
    assert one(spark, scalars.normalise_symbol("t"), t=None) is None
    assert one(spark, scalars.symbols_from_text("t"), t=" b, a,,A ,b") == ["A", "B"]


def test_surrogate_key_nulls(spark):
    assert one(spark, scalars.surrogate_key("a", "b"), a="x", b=None) is None
    filled = scalars.surrogate_key("a", "b", empty_for_null=("b",))
    assert one(spark, filled, a="x", b=None) == one(spark, scalars.surrogate_key("a", "b"), a="x", b="")


def test_content_hash_ignores_member_order(spark):
    h = scalars.content_hash(F.parse_json("t"))
    assert one(spark, h, t='{"b": 1, "a": null}') == one(spark, h, t='{"a":null,"b":1}')
    assert one(spark, h, t='{"a": null}') != one(spark, h, t="{}")


def test_window_bounds():
    with pytest.raises(ValueError):
        scalars.window_epoch_bounds("2024-01-02", "2024-01-01")


@settings(max_examples=10, deadline=None)
@given(days=some.lists(some.integers(1, 31), min_size=1, max_size=60))
def test_distinct_days_equal_a_set(spark, days):
    df = spark.createDataFrame([(date(2024, 1, d),) for d in days], "d date")
    assert df.agg(scalars.distinct_days_in_month("d")).first()[0] == len(set(days))
