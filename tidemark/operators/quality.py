"""Data-quality checks and gates.

Row checks of one table are counted together in a single pass.  Checks that
need groups or another table run on pre-aggregated keys.  A suite reports
``(table_name, check_name, violations)`` for every check and only then fails.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.lookups import missing_keys, orphan_counts
from tidemark.operators.metrics import duplicate_grain, union_all
from tidemark.sources.lake import in_window


class QualityFailure(RuntimeError):
    """Some checks found violating rows."""


# Row predicates: true for a violating row -------------------------------------


def is_null(column: str) -> Column:
    """K1."""
    return F.col(column).isNull()


def not_accepted(column: str, values: Sequence) -> Column:
    """K3: a value outside the list; null passes."""
    return ~F.col(column).isin(*values)


def ohlc_out_of_range() -> Column:
    """K5: impossible ordering of the four prices, or a negative one."""
    return ohlc_disordered() | (F.least("open_price", "high_price", "low_price", "close_price") < 0)


def ohlc_disordered() -> Column:
    """K9 (ordering part): high below, or low above, another price."""
    return (F.col("high_price") < F.greatest("low_price", "open_price", "close_price")) | (
        F.col("low_price") > F.least("open_price", "close_price")
    )


def negative(*columns: str) -> Column:
    """Some column is below zero."""
    return F.least(*[F.col(c) for c in columns]) < 0 if len(columns) > 1 else F.col(columns[0]) < 0


def dates_disordered() -> Column:
    """K11."""
    return (F.col("min_price_date") > F.col("max_price_date")) | (
        F.col("month_start_date") > F.col("month_end_date")
    )


def month_out_of_range() -> Column:
    """K12."""
    return ~F.col("month").between(1, 12)


def fewer_rows_than_days() -> Column:
    """K14."""
    return F.col("source_row_count") < F.col("trading_days_count")


def no_trading_days() -> Column:
    """K16."""
    return F.col("trading_days_count") <= 0


# Checks over sets of rows: a DataFrame of violations --------------------------


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """K2, K7: repeated keys; null keys are ignored."""
    present = df
    for key in keys:
        present = present.where(F.col(key).isNotNull())
    return duplicate_grain(present, keys)


def repeated(df: DataFrame, key: str) -> DataFrame:
    """K2 of a long key: its 64-bit hashes go through the shuffle, and keys themselves only where a hash repeats."""
    present = df.where(F.col(key).isNotNull())
    if duplicate_grain(present.select(F.xxhash64(key).alias("place")), ["place"]).isEmpty():
        return df.sparkSession.createDataFrame([], f"{key} string, row_count bigint")
    return duplicates(df, [key])


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """K4."""
    return orphan_counts(child, child_key, parent, parent_key)


def uncovered_symbols(curated: DataFrame, mart: DataFrame, date_column: str, start: date | str, end: date | str) -> DataFrame:
    """Symbols with prices in the window but no mart row."""
    return missing_keys(in_window(curated, date_column, start, end), mart, "symbol", "symbol_missing_from_mart")


def missing_years(curated: DataFrame, date_column: str, start: date | str, end: date | str, years: Sequence[int]) -> DataFrame:
    """Expected years without any row in the window."""
    in_scope = in_window(curated, date_column, start, end)
    seen = in_scope.agg(*[F.count_if(F.year(date_column) == y).alias(str(y)) for y in years])
    listed = F.array(*[F.when(F.col(f"`{y}`") == 0, F.lit(y)) for y in years])
    return seen.select(F.explode(F.array_compact(listed)).alias("missing_year"))


def empty_while_source_has_rows(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row when the source has rows and the target none."""
    counts = union_all(
        [
            source.agg(F.count(F.lit(1)).alias("source_rows"), F.lit(0).cast("bigint").alias("target_rows")),
            target.agg(F.lit(0).cast("bigint").alias("source_rows"), F.count(F.lit(1)).alias("target_rows")),
        ]
    ).agg(F.sum("source_rows").alias("source_rows"), F.sum("target_rows").alias("target_rows"))
    return counts.where((F.col("source_rows") > 0) & (F.col("target_rows") == 0))


def sample(violations: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` violations in key order, for a report."""
    return violations.orderBy(*order).limit(n)


# Suites -----------------------------------------------------------------------


@dataclass
class TableChecks:
    """Checks of one table: row predicates, and named violation sets."""

    table: str
    df: DataFrame
    rows: Mapping[str, Column] = field(default_factory=dict)
    sets: Mapping[str, DataFrame] = field(default_factory=dict)

    def report(self) -> DataFrame:
        parts = []
        if self.rows:
            # One aggregation for all row checks, then one output row per check.
            counted = self.df.agg(*[F.count_if(p).alias(f"c{i}") for i, p in enumerate(self.rows.values())])
            entries = [
                F.struct(F.lit(name).alias("check_name"), F.col(f"c{i}").alias("violations"))
                for i, name in enumerate(self.rows)
            ]
            parts.append(counted.select(F.inline(F.array(*entries))))
        for name, violations in self.sets.items():
            parts.append(
                violations.agg(F.count(F.lit(1)).alias("violations")).select(
                    F.lit(name).alias("check_name"), "violations"
                )
            )
        return union_all(parts).select(F.lit(self.table).alias("table_name"), "check_name", "violations")


def run_suite(checks: Sequence[TableChecks]) -> DataFrame:
    """Every check with its number of violations."""
    return union_all([c.report() for c in checks])


def require_clean(report: DataFrame) -> list[dict]:
    """Fail after all checks have run.  The report has one row per check."""
    rows = [row.asDict() for row in report.collect()]
    failed = [r for r in rows if r["violations"]]
    if failed:
        listing = ", ".join(f"{r['table_name']}.{r['check_name']}={r['violations']}" for r in failed)
        raise QualityFailure(f"{len(failed)} of {len(rows)} checks failed: {listing}")
    return rows


# Gates ------------------------------------------------------------------------


def gate_rows(payload: dict[str, int], source: str, target: str, problem: str) -> dict[str, int]:
    """Rows in the source without any in the target stop the flow; the counts go with the failure."""
    if payload[source] > 0 and payload[target] == 0:
        raise QualityFailure(f"{problem}: {payload}")
    return payload


def gate_landing_to_curated(landing: DataFrame, curated: DataFrame) -> dict[str, int]:
    """Landing rows without any curated row stop the flow."""
    payload = {"landing_rows": landing.count(), "curated_rows": curated.count()}
    return gate_rows(payload, "landing_rows", "curated_rows", "landing has rows but curated is empty")


def gate_curated_to_mart(
    curated: DataFrame, mart: DataFrame, date_column: str, start: date | str, end: date | str
) -> dict[str, int]:
    """Curated rows in the window without any mart row stop the flow."""
    in_scope = in_window(curated, date_column, start, end).count()
    counted = mart.agg(F.count(F.lit(1)), F.count_distinct("symbol")).first()
    payload = {
        "curated_rows_in_window": in_scope,
        "mart_rows": counted[0],
        "mart_distinct_symbols": counted[1],
    }
    return gate_rows(payload, "curated_rows_in_window", "mart_rows", "curated has rows in the window but the mart is empty")
