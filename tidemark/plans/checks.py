"""The check suites of each layer."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import DataFrame

from tidemark.operators import quality as q
from tidemark.operators.incremental import stale
from tidemark.registry import (
    BASIC_INFO,
    DAILY_PRICE,
    DEFAULT_WINDOW,
    DIMENSION_NAME,
    FACTS,
    FUNDAMENTALS,
    HOLDER_TYPES,
    HOLDERS,
    MONTHLY_MART_NAME,
    MONTHLY_MART_SCHEMA,
    MONTHLY_SUMMARY_NAME,
    MONTHLY_SUMMARY_SCHEMA,
    PERIOD_TYPES,
    RATINGS,
)


def _not_null(*columns: str):
    return {f"{c}_not_null": q.is_null(c) for c in columns}


_PERIOD = {"period_type_accepted": ("period_type", PERIOD_TYPES)}
_HOLDER = {"holder_type_accepted": ("holder_type", HOLDER_TYPES)}


def _accepted(rules):
    return {name: q.not_accepted(column, values) for name, (column, values) in rules.items()}


def source_checks(landing: Mapping[str, DataFrame]) -> list[q.TableChecks]:
    """8 not-null and 2 accepted-value checks on landing."""
    return [
        q.TableChecks(BASIC_INFO.name, landing[BASIC_INFO.name], _not_null("symbol", "snapshot_date")),
        q.TableChecks(DAILY_PRICE.name, landing[DAILY_PRICE.name], _not_null("symbol", "price_date", "volume")),
        q.TableChecks(FUNDAMENTALS.name, landing[FUNDAMENTALS.name], _not_null("symbol") | _accepted(_PERIOD)),
        q.TableChecks(HOLDERS.name, landing[HOLDERS.name], _not_null("symbol") | _accepted(_HOLDER)),
        q.TableChecks(RATINGS.name, landing[RATINGS.name], _not_null("symbol")),
    ]


def staging_checks(views: Mapping[str, DataFrame]) -> list[q.TableChecks]:
    """8 not-null and 2 accepted-value checks on the staging views."""

    def named(spec):
        return spec.staging_name, views[spec.name]

    return [
        q.TableChecks(*named(BASIC_INFO), _not_null("symbol", "snapshot_date")),
        q.TableChecks(*named(DAILY_PRICE), _not_null("symbol", "price_date", "volume")),
        q.TableChecks(*named(FUNDAMENTALS), _not_null("symbol", "period_type") | _accepted(_PERIOD)),
        q.TableChecks(*named(HOLDERS), _accepted(_HOLDER)),
        q.TableChecks(*named(RATINGS), _not_null("symbol")),
    ]


def model_checks(
    dimension: DataFrame,
    facts: Mapping[str, DataFrame],
    summary: DataFrame,
    as_of: datetime | str,
    newest_load: datetime | None = None,
) -> list[q.TableChecks]:
    """Checks of the dimension, the facts and the monthly summary, the four
    special tests included.  Facts and summary may be the months to check;
    ``newest_load`` then tells the newest load of all months."""
    required = {
        "fct_stock_daily": ("stock_daily_sk", "symbol", "price_date"),
        "fct_bank_fundamentals": ("fundamentals_sk",),
        "fct_holders": ("holders_sk",),
        "fct_ratings": ("ratings_sk",),
    }
    special_rows = {
        "fct_stock_daily": {"ohlc_in_range": q.ohlc_out_of_range(), "volume_non_negative": q.negative("volume")},
        "fct_bank_fundamentals": _accepted(_PERIOD),
        "fct_holders": _accepted(_HOLDER),
        "fct_ratings": {},
    }
    checks = [
        q.TableChecks(
            DIMENSION_NAME,
            dimension,
            _not_null("symbol", "snapshot_date"),
            {"symbol_unique": q.duplicates(dimension, ["symbol"])},
        )
    ]
    for name, fact in FACTS.items():
        df = facts[name]
        sets = {
            f"{fact.surrogate}_unique": q.repeated(df, fact.surrogate),
            "symbol_in_dimension": q.orphans(df, "symbol", dimension, "symbol"),
        }
        if name == "fct_stock_daily":
            loads = df if newest_load is None else df.sparkSession.createDataFrame([(newest_load,)], "ingested_at timestamp")
            sets["loaded_recently"] = stale(loads, as_of)
        checks.append(q.TableChecks(name, df, _not_null(*required[name]) | special_rows[name], sets))
    checks.append(
        q.TableChecks(
            MONTHLY_SUMMARY_NAME,
            summary,
            _not_null(*MONTHLY_SUMMARY_SCHEMA.fieldNames()),
            {
                "symbol_in_dimension": q.orphans(summary, "symbol", dimension, "symbol"),
                "one_row_per_symbol_month": q.duplicates(summary, ["symbol", "month_date"]),
            },
        )
    )
    return checks


def mart_checks(
    curated_prices: DataFrame,
    mart: DataFrame,
    start: date | str = DEFAULT_WINDOW[0],
    end: date | str = DEFAULT_WINDOW[1],
    years: tuple[int, ...] = (2024, 2025),
    whole_mart: DataFrame | None = None,
    all_prices: DataFrame | None = None,
) -> list[q.TableChecks]:
    """14 declared and 11 special checks of the monthly mart.

    ``curated_prices`` and ``mart`` may be the months to check; symbols are then looked for in
    ``whole_mart``, years in ``all_prices``.
    """
    whole_mart = mart if whole_mart is None else whole_mart
    all_prices = curated_prices if all_prices is None else all_prices
    in_scope = q.in_window(curated_prices, "price_date", start, end)
    required = [f.name for f in MONTHLY_MART_SCHEMA.fields if not f.nullable]
    mart_rows = _not_null(*required) | {
        "year_accepted": q.not_accepted("year", years),
        "years_in_scope": q.not_accepted("year", years),
        "dates_ordered": q.dates_disordered(),
        "month_in_range": q.month_out_of_range(),
        "metrics_non_negative": q.negative("avg_open_price", "avg_close_price", "avg_volume"),
        "rows_cover_days": q.fewer_rows_than_days(),
        "trading_days_positive": q.no_trading_days(),
    }
    return [
        q.TableChecks(
            DAILY_PRICE.curated_name,
            in_scope,
            {"ohlc_ordered_in_window": q.ohlc_disordered()},
            {"every_year_present": q.missing_years(all_prices, "price_date", start, end, years)},
        ),
        q.TableChecks(
            MONTHLY_MART_NAME,
            mart,
            mart_rows,
            {
                "one_row_per_symbol_month": q.duplicates(mart, ["symbol", "year", "month"]),
                "every_symbol_present": q.uncovered_symbols(curated_prices, whole_mart, "price_date", start, end),
                "filled_when_curated_is": q.empty_while_source_has_rows(in_scope, whole_mart),
            },
        ),
    ]
