"""Upsert, replace, insert-if-absent, history and source merge against plain Python."""

from __future__ import annotations

from datetime import datetime, timezone

import pytest
from hypothesis import given, settings, strategies as some
from pyspark.sql import functions as F

from tidemark.operators.fallback import merge_sources
from tidemark.operators.history import history_schema, snapshot
from tidemark.operators.merging import insert_if_absent, replace_by_key, upsert
from tidemark.operators.universe import batch_numbers, industry_match, ranked_universe, screen
from tidemark.operators.versioning import latest_by_key, newest_value


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@settings(max_examples=8, deadline=None)
@given(
    old=some.dictionaries(some.integers(0, 5), some.integers(0, 9), max_size=5),
    new=some.lists(some.tuples(some.integers(0, 5), some.integers(0, 9)), max_size=8),
    shuffle=some.randoms(),
)
def test_upsert_is_last_write_wins_in_any_row_order(spark, old, new, shuffle):
    target = frame(spark, list(old.items()), "k int, v int")
    numbered = [(k, v, n) for n, (k, v) in enumerate(new)]
    shuffle.shuffle(numbered)
    batch = frame(spark, numbered, "k int, v int, seq int")
    got = {r["k"]: r["v"] for r in upsert(target, batch, ["k"], ["seq"]).collect()}
    assert got == {**old, **dict(new)}


def test_replace_follows_the_batch_schema(spark):
    target = frame(spark, [(1, "a", "x"), (2, "b", "y")], "k int, gone string, v string")
    batch = frame(spark, [(2, "z", 7), (3, "w", 8)], "k int, v string, added int")
    got = replace_by_key(target, batch, ["k"])
    assert got.columns == ["k", "v", "added"]
    assert sorted(tuple(r) for r in got.collect()) == [(1, "x", None), (2, "z", 7), (3, "w", 8)] or sorted(
        (tuple(r) for r in got.collect()), key=lambda r: r[0]
    ) == [(1, "x", None), (2, "z", 7), (3, "w", 8)]


def test_insert_if_absent_compares_nulls(spark):
    target = frame(spark, [("a", None)], "k string, day string")
    batch = frame(spark, [("a", None, 1), ("b", None, 2), ("b", None, 3), ("a", "d", 4)], "k string, day string, seq int")
    got = insert_if_absent(target, batch, ["k", "day"], ["seq"])
    assert sorted((r["k"], r["day"] or "", r["seq"]) for r in got.collect()) == [("a", "d", 4), ("b", "", 2)]


def test_latest_breaks_ties_in_order(spark):
    df = frame(spark, [("a", 1, "x"), ("a", 2, "w"), ("a", 2, "y"), ("b", 0, "z")], "k string, at int, batch string")
    assert sorted(tuple(r) for r in latest_by_key(df, ["k"], ["at", "batch"]).collect()) == [("a", 2, "y"), ("b", 0, "z")]


def test_newest_value_skips_nulls(spark):
    df = frame(spark, [("a", 1, "old"), ("a", 2, None), ("b", 1, None)], "k string, at int, name string")
    assert {r["k"]: r["name"] for r in newest_value(df, ["k"], "name", ["at"]).collect()} == {"a": "old", "b": None}


def instant(day):
    return datetime(2024, 1, day, tzinfo=timezone.utc)


def test_history_life_of_a_key(spark):
    schema = "k string, v int, at timestamp"

    def state(*rows):
        return frame(spark, [(k, v, instant(d)) for k, v, d in rows], schema)

    history = spark.createDataFrame([], history_schema(state(("x", 1, 1)).schema))
    runs = [
        (state(("a", 1, 1), ("b", 1, 1)), 10),
        (state(("a", 2, 2), ("b", 9, 1)), 11),  # a changed; b changed without a newer instant
        (state(("b", 9, 1)), 12),  # a is gone
        (state(("a", 2, 2), ("b", 9, 1)), 13),  # a is back
    ]
    for source, day in runs:
        history = frame(spark, [tuple(r) for r in snapshot(history, source, "k", "at", instant(day)).collect()], history.schema)
    days = {
        (r["k"], r["v"], r["valid_from"].day, r["valid_to"].day if r["valid_to"] else None) for r in history.collect()
    }
    assert days == {("a", 1, 1, 2), ("a", 2, 2, 12), ("a", 2, 2, None), ("b", 1, 1, None)}


@pytest.mark.parametrize("enabled", [True, False])
def test_source_merge(spark, enabled):
    first = frame(spark, [("good", 1, False), ("good", 2, True), ("hollow", 1, True)], "k string, arrival int, hollow boolean")
    second = frame(spark, [("good", 9, False), ("hollow", 9, False), ("only", 9, False)], first.schema)
    got = merge_sources(first, second, ["k"], F.col("hollow"), "arrival", enabled)
    keys = sorted((r["k"], r["arrival"]) for r in got.collect())
    if enabled:
        assert keys == [("good", 1), ("good", 2), ("hollow", 9), ("only", 9)]
    else:
        assert keys == [("good", 1), ("good", 2), ("hollow", 1)]


def test_batch_numbers(spark):
    df = frame(spark, [(f"s{i:03}",) for i in range(101)], "symbol string").repartition(7)
    got = {r["symbol"]: r["batch_number"] for r in batch_numbers(df, "symbol", 25).collect()}
    assert got == {f"s{i:03}": i // 25 + 1 for i in range(101)}
    with pytest.raises(ValueError):
        batch_numbers(df, "symbol", 0)


def test_universe_cuts_before_the_industry_filter_only_if_asked(spark):
    quotes = [
        ("A", "us", "Financial Services", "NMS", "Banks - Regional", 5),
        ("B", "us", "Financial Services", "NYQ", "Insurance", 9),
        ("C", "us", "Financial Services", "ASE", "banks", 8),
        ("D", "us", "Financial Services", "PNK", "Banks", 99),
        ("E", "ca", "Financial Services", "NMS", "Banks", 99),
        (None, "us", "Financial Services", "NMS", "Banks", 10),
        ("F", "us", "Financial Services", "NMS", None, 7),
    ]
    df = frame(spark, quotes, "symbol string, region string, sector string, exchange string, industry string, cap int")
    got = ranked_universe(df, screen(), industry_match(), "cap", "symbol", limit=5, screen_size=4)
    assert [r["symbol"] for r in got.collect()] == ["C"]
    assert [r["symbol"] for r in ranked_universe(df, screen(), industry_match(), "cap", "symbol", 2).collect()] == ["C", "A"]
