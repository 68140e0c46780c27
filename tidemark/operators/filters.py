"""Row rules: skip with a reason, quality predicates, constraints."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.scalars import strip_text
from tidemark.functions.variants import is_blank_json
from tidemark.registry import DATASETS

REASON = "skip_reason"

# Members of a profile payload, one of which must hold a value.
PROFILE_PRESENCE_FIELDS = ("company_name", "industry", "sector", "country", "website", "fullTimeEmployees")


class ConstraintViolation(ValueError):
    """A batch holds rows that break a table constraint; nothing was written."""


def evaluate_once(df: DataFrame) -> DataFrame:
    """Keep a later filter from being computed below this point.

    Spark moves a filter under the projection that computes its columns and
    repeats their expressions there, once per use.  For parsed payloads that
    multiplies the parsing.  A filter on generated columns stays above the
    generator, so every expression runs once per row.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))


def tag_skips(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add the name of the first rule a row meets, null for accepted rows."""
    reason = F.coalesce(*[F.when(condition, F.lit(name)) for name, condition in rules.items()])
    return df.withColumn(REASON, reason)


def accepted(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(REASON).isNull()).drop(REASON)


def rejected(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(REASON).isNotNull())


def skip_counts(tagged: DataFrame, *by: str) -> DataFrame:
    return rejected(tagged).groupBy(*by, REASON).agg(F.count(F.lit(1)).alias("skipped"))


def blank_text(c: Column | str) -> Column:
    """Null or only whitespace."""
    return F.coalesce(strip_text(c) == "", F.lit(True))


def missing_symbol(c: str = "symbol") -> Column:
    return blank_text(c)


def hollow_profile(payload: Column | str) -> Column:
    """None of the presence fields holds a value."""
    blanks = [is_blank_json(payload, f"$.{name}") for name in PROFILE_PRESENCE_FIELDS]
    every = blanks[0]
    for blank in blanks[1:]:
        every = every & blank
    return every


def any_null(*columns: str) -> Column:
    """Some column is null."""
    condition = F.col(columns[0]).isNull()
    for column in columns[1:]:
        condition = condition | F.col(column).isNull()
    return condition


def unknown_dataset(c: str = "dataset") -> Column:
    """C11: a dataset no mapper exists for."""
    return ~F.coalesce(F.col(c).isin(*DATASETS), F.lit(False))


def mart_quality() -> Column:
    """Non-negative open, close and volume, and consistent price ordering."""
    return (
        (F.col("open_price") >= 0)
        & (F.col("close_price") >= 0)
        & (F.col("volume") >= 0)
        & (F.col("high_price") >= F.greatest("low_price", "open_price", "close_price"))
        & (F.col("low_price") <= F.least("open_price", "close_price"))
    )


def summary_quality() -> Column:
    """Key, date, open, close and volume present, the numbers non-negative.

    A comparison with null is never true, so ``>= 0`` also asks for a value.
    """
    return (
        F.col("symbol").isNotNull()
        & F.col("price_date").isNotNull()
        & (F.col("open_price") >= 0)
        & (F.col("close_price") >= 0)
        & (F.col("volume") >= 0)
    )


def _breaks(check: str) -> Column:
    """True where a check is false; null passes."""
    return ~F.coalesce(F.expr(check), F.lit(True))


def constraint_counts(df: DataFrame, checks: Mapping[str, str], required: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """One row with the number of violations per constraint, in one pass."""
    counts = [F.count_if(F.col(c).isNull()).alias(f"{c}_not_null") for c in required]
    counts += [F.count_if(_breaks(check)).alias(name) for name, check in checks.items()]
    return df.agg(*counts)


def require_constraints(df: DataFrame, checks: Mapping[str, str], required: tuple[str, ...] | list[str] = ()) -> None:
    """Refuse the whole batch when any row breaks a constraint."""
    if not checks and not required:
        return
    broken = {k: n for k, n in constraint_counts(df, checks, required).first().asDict().items() if n}
    if broken:
        raise ConstraintViolation(f"rows break constraints: {broken}")


def quarantine(df: DataFrame, checks: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Split instead of refusing: rows that pass, and rows with the first broken constraint."""
    tagged = tag_skips(df, {name: _breaks(check) for name, check in checks.items()})
    return accepted(tagged), rejected(tagged)
