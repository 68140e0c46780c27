"""Warehouse models: staging views, dimension, facts, monthly tables."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.scalars import (
    distinct_days_in_month,
    mean_as_double,
    month_end,
    month_start,
    surrogate_key,
    truncate_to_millis,
)
from tidemark.operators.filters import mart_quality, summary_quality
from tidemark.operators.incremental import since_own_maximum
from tidemark.operators.lookups import attach
from tidemark.operators.merging import replace_by_key
from tidemark.operators.metrics import key_union, latest_activity
from tidemark.operators.versioning import latest_by_key, newest_value
from tidemark.registry import (
    BASIC_INFO,
    DEFAULT_WINDOW,
    DIMENSION_SCHEMA,
    FactSpec,
    HOLDERS,
    MONTHLY_MART_SCHEMA,
    MONTHLY_SUMMARY_SCHEMA,
    PARTITION_COLUMN,
    TABLES,
    TableSpec,
    UNKNOWN,
)
from tidemark.sources.lake import in_window, parse_instant

# Columns of the dimension that are filled when no profile is known.
_FILLED = ("company_name", "industry", "sector", "city", "country", "source_system", "batch_id")
_NO_DATE = "1900-01-01"


#: Newest activity of a symbol, and its newest profile where it has one.
PROFILE_STATE_SCHEMA = T.StructType(
    [
        T.StructField("latest_ingested_at", T.TimestampType()),
        *[T.StructField(f.name, f.dataType) for f in BASIC_INFO.schema.fields],
    ]
)


def canonical_holder_type(c: Column | str) -> Column:
    kind = F.lower(c)
    return F.when(kind == "fund", F.lit("mutual_fund")).otherwise(kind)


def staging_view(landing: DataFrame, spec: TableSpec) -> DataFrame:
    """Explicit columns; holder types in their canonical spelling."""
    columns = [
        canonical_holder_type(name).alias(name) if spec is HOLDERS and name == "holder_type" else F.col(name)
        for name in spec.columns
    ]
    return landing.select(*columns)


def staging_rows(landing: DataFrame, spec: TableSpec) -> DataFrame:
    """Strict types, instants in milliseconds, required columns present.

    A null in a required column stops the load.
    """
    missing = [F.when(F.col(c).isNull(), F.lit(c)) for c in spec.required]
    guard = F.when(
        F.coalesce(*missing).isNotNull(),
        F.raise_error(F.concat(F.lit(f"{spec.name}: required column is null: "), F.coalesce(*missing))).cast("string"),
    ).otherwise(F.col(spec.key[0]))
    columns = []
    for f in spec.schema.fields:
        if f.name == spec.key[0]:
            columns.append(guard.cast(f.dataType).alias(f.name))
        elif isinstance(f.dataType, T.TimestampType):
            columns.append(truncate_to_millis(f.name).alias(f.name))
        else:
            columns.append(F.col(f.name).cast(f.dataType).alias(f.name))
    return landing.select(*columns)


def profile_state(views: Mapping[str, DataFrame]) -> DataFrame:
    """Newest activity and newest profile of each symbol seen in any table.

    ``views`` maps the five table names to their staging views, whole or an increment of them.
    """
    frames = [views[name] for name in TABLES]
    universe_with_activity = latest_activity(frames)  # has exactly the non-null symbols of H1
    latest = latest_by_key(
        views[BASIC_INFO.name].where(F.col("symbol").isNotNull()),
        ["symbol"],
        ["snapshot_date", "ingested_at"],
    )
    return attach(universe_with_activity, latest, "symbol").select(*PROFILE_STATE_SCHEMA.fieldNames())


def merged_profile_state(old: DataFrame, new: DataFrame) -> DataFrame:
    """The state of all rows from the state of the older ones and that of an increment.

    Both sides have one row per symbol.  Rows only ever become newer, so the newest activity
    and the newest profile are among the two.
    """
    both = old.alias("old").join(new.alias("new"), F.col("old.symbol") == F.col("new.symbol"), "full_outer")
    rank = lambda side: F.struct(F.col(f"{side}.snapshot_date"), F.col(f"{side}.ingested_at"))
    newer = F.col("new.snapshot_date").isNotNull() & (
        F.col("old.snapshot_date").isNull() | (rank("new") >= rank("old"))
    )
    merged = {
        "symbol": F.coalesce("new.symbol", "old.symbol"),
        "latest_ingested_at": F.greatest("new.latest_ingested_at", "old.latest_ingested_at"),
    }
    pick = lambda c: F.when(newer, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}"))
    return both.select(*[merged.get(c, pick(c)).alias(c) for c in PROFILE_STATE_SCHEMA.fieldNames()])


def dimension_of(state: DataFrame, built_at: datetime | str | None = None) -> DataFrame:
    """One row per symbol; text without a profile is ``UNKNOWN``."""
    now = F.lit(parse_instant(built_at)) if built_at else F.current_timestamp()
    filled = {name: F.coalesce(name, F.lit(UNKNOWN)) for name in _FILLED}
    filled["snapshot_date"] = F.coalesce(
        "snapshot_date", F.col("latest_ingested_at").cast("date"), F.lit(_NO_DATE).cast("date")
    )
    filled["ingested_at"] = F.coalesce("ingested_at", "latest_ingested_at", now)
    return state.select(*[filled.get(c, F.col(c)).alias(c) for c in DIMENSION_SCHEMA.fieldNames()])


def dimension(views: Mapping[str, DataFrame], built_at: datetime | str | None = None) -> DataFrame:
    """One row per symbol seen in any table."""
    return dimension_of(profile_state(views), built_at)


def symbol_universe(views: Mapping[str, DataFrame]) -> DataFrame:
    """H1 on its own."""
    return key_union([views[name] for name in TABLES])


def fact_rows(view: DataFrame, fact: FactSpec) -> DataFrame:
    """The staging columns behind their surrogate key."""
    sk = surrogate_key(*fact.key_parts, empty_for_null=fact.empty_for_null).alias(fact.surrogate)
    return view.select(sk, *fact.source.columns)


def fact_schema(fact: FactSpec) -> T.StructType:
    return T.StructType([T.StructField(fact.surrogate, T.StringType()), *fact.source.schema.fields])


def fact_stored_schema(fact: FactSpec) -> T.StructType:
    return T.StructType([*fact_schema(fact).fields, T.StructField(PARTITION_COLUMN, T.IntegerType())])


def refreshed_fact(current: DataFrame, view: DataFrame, fact: FactSpec) -> DataFrame:
    """Rows since the fact's own newest cursor replace their keys."""
    fresh = fact_rows(since_own_maximum(view, current), fact)
    return replace_by_key(current.select(*fresh.columns), fresh, [fact.surrogate])


def newest_names(profiles: DataFrame) -> DataFrame:
    """The newest known company name per symbol."""
    return newest_value(profiles, ["symbol"], "company_name", ["ingested_at", "snapshot_date"])


def monthly_mart(
    prices: DataFrame,
    profiles: DataFrame,
    loaded_at: datetime | str,
    start: date | str = DEFAULT_WINDOW[0],
    end: date | str = DEFAULT_WINDOW[1],
) -> DataFrame:
    """Monthly figures per symbol from accepted days of the window."""
    return named_months(prices, newest_names(profiles), loaded_at, start, end)


def named_months(
    prices: DataFrame,
    names: DataFrame,
    loaded_at: datetime | str,
    start: date | str = DEFAULT_WINDOW[0],
    end: date | str = DEFAULT_WINDOW[1],
) -> DataFrame:
    """E1 with given names, one row per symbol.

    Names depend only on the symbol, so they are attached after the months are
    aggregated: the join sees one row per symbol and month instead of one per
    day, and the single shuffle of the daily rows carries partial aggregates.
    """
    accepted = in_window(prices, "price_date", start, end).where(mart_quality())
    monthly = accepted.groupBy("symbol", month_start("price_date").alias("month_start_date")).agg(
        mean_as_double("open_price").alias("avg_open_price"),
        mean_as_double("close_price").alias("avg_close_price"),
        mean_as_double("volume").alias("avg_volume"),
        F.min("open_price").alias("min_open_price"),
        F.max("close_price").alias("max_close_price"),
        distinct_days_in_month("price_date").alias("trading_days_count"),
        F.min("price_date").alias("min_price_date"),
        F.max("price_date").alias("max_price_date"),
        F.count(F.lit(1)).alias("source_row_count"),
    )
    dated = attach(monthly, names, "symbol").select(
        "*",
        F.year("month_start_date").alias("year"),
        F.month("month_start_date").alias("month"),
        month_end("month_start_date").alias("month_end_date"),
        loaded_instant(loaded_at).alias("loaded_at"),
    )
    return dated.select(*MONTHLY_MART_SCHEMA.fieldNames())


def loaded_instant(loaded_at: datetime | str) -> Column:
    return truncate_to_millis(F.lit(parse_instant(loaded_at)))


def renamed_months(mart: DataFrame, changed: DataFrame, loaded_at: datetime | str) -> DataFrame:
    """Mart rows with the names of ``changed(symbol, company_name)``; its symbols' rows count as loaded now."""
    new = changed.select("symbol", F.col("company_name").alias("_name"), F.lit(True).alias("_renamed"))
    values = {
        "company_name": F.when(F.col("_renamed"), F.col("_name")).otherwise(F.col("company_name")),
        "loaded_at": F.when(F.col("_renamed"), loaded_instant(loaded_at)).otherwise(F.col("loaded_at")),
    }
    return mart.join(new, "symbol", "left").select(*[values.get(c, F.col(c)).alias(c) for c in MONTHLY_MART_SCHEMA.fieldNames()])


def monthly_summary(prices: DataFrame) -> DataFrame:
    """Three monthly averages per symbol, no window."""
    averages = {
        f"avg_{name}": F.coalesce(mean_as_double(name), F.lit(0.0)).alias(f"avg_{name}")
        for name in ("open_price", "close_price", "volume")
    }
    return (
        prices.where(summary_quality())
        .groupBy("symbol", month_start("price_date").alias("month_date"))
        .agg(*averages.values())
        .select(*MONTHLY_SUMMARY_SCHEMA.fieldNames())
    )
