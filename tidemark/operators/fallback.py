"""Two sources for one set of keys: hollow-record tests and the merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.variants import is_blank_json, is_falsy_json

# Payload members the tests look at.
PROFILE_CORE_FIELDS = ("industry", "sector", "company_name", "country", "fullTimeEmployees")
PROFILE_FIELDS = (
    "company_name",
    "industry",
    "sector",
    "fullTimeEmployees",
    "city",
    "phone",
    "state",
    "country",
    "website",
    "address1",
    "exchange",
    "currency",
    "market_cap",
)
HEADLINE_FIELDS = ("totalAssets", "totalDebt", "investedCapital", "sharesOutstanding")
STATEMENTS_FIELD = "balanceSheetStatements"


def _all(conditions: Sequence[Column]) -> Column:
    result = conditions[0]
    for condition in conditions[1:]:
        result = result & condition
    return result


def _null_json(payload: Column | str, path: str) -> Column:
    column = F.col(payload) if isinstance(payload, str) else payload
    value = F.try_variant_get(column, path, "variant")
    return value.isNull() | F.is_variant_null(value)


def hollow_primary(dataset: Column | str = "dataset", payload: Column | str = "payload") -> Column:
    """A record that does not count as an answer of the first source."""
    dataset = F.col(dataset) if isinstance(dataset, str) else dataset
    no_profile = _all([is_falsy_json(payload, f"$.{name}") for name in PROFILE_CORE_FIELDS])
    no_figures = is_falsy_json(payload, f"$.{STATEMENTS_FIELD}") & _all(
        [_null_json(payload, f"$.{name}") for name in HEADLINE_FIELDS]
    )
    return F.when(dataset == "basics", no_profile).when(dataset == "fundamentals", no_figures).otherwise(F.lit(False))


def usable_fallback(dataset: Column | str = "dataset", payload: Column | str = "payload") -> Column:
    """A record of the second source that carries anything."""
    dataset = F.col(dataset) if isinstance(dataset, str) else dataset
    no_profile = _all([is_blank_json(payload, f"$.{name}") for name in PROFILE_FIELDS])
    no_figures = is_falsy_json(payload, f"$.{STATEMENTS_FIELD}") & _all(
        [_null_json(payload, f"$.{name}") for name in HEADLINE_FIELDS]
    )
    return F.when(dataset == "basics", ~no_profile).when(dataset == "fundamentals", ~no_figures).otherwise(F.lit(True))


def answered_keys(primary: DataFrame, keys: Sequence[str], hollow: Column, arrival: str) -> DataFrame:
    """Keys whose first primary record is not hollow.

    Only a flag per key is aggregated, before the shuffle, so a key with very
    many records costs no more than any other.
    """
    flagged = primary.select(*keys, F.struct(F.col(arrival), hollow.alias("_hollow")).alias("_first"))
    first = flagged.groupBy(*keys).agg(F.min("_first").alias("_first"))
    return first.where(~F.col("_first._hollow")).select(*keys)


def merge_sources(
    primary: DataFrame,
    fallback: DataFrame,
    keys: Sequence[str],
    hollow: Column,
    arrival: str,
    enabled: bool = True,
) -> DataFrame:
    """The primary's rows for keys it answered, else the fallback's rows.

    Switched off, the primary is passed through, hollow records included.
    Both joins are against one row per key; a hot key on the record side is
    split by adaptive execution when the keys are too many to broadcast.
    """
    if not enabled:
        return primary
    good = answered_keys(primary, keys, hollow, arrival)
    return primary.join(good, list(keys), "left_semi").unionByName(fallback.join(good, list(keys), "left_anti"))
