"""Raw API documents to record envelopes (upper half of B3-B7).

Input is one row per answered request: ``symbol`` and the document as VARIANT
in ``payload``.  Further columns, such as ``seq``, are carried along.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.scalars import check_window
from tidemark.functions.variants import epoch_date, first_result, is_falsy_json, unwrap_date, unwrap_long, variant_items
from tidemark.registry import DEFAULT_SOURCE

SUMMARY_ROOT = "quoteSummary"
CHART_ROOT = "chart"

# Where each profile member is found in a document, best source first.
PROFILE_PATHS = {
    "company_name": ("$.assetProfile.longName", "$.price.longName", "$.price.shortName", "$.assetProfile.name"),
    "industry": ("$.assetProfile.industry",),
    "sector": ("$.assetProfile.sector",),
    "fullTimeEmployees": ("$.assetProfile.fullTimeEmployees",),
    "city": ("$.assetProfile.city",),
    "phone": ("$.assetProfile.phone",),
    "state": ("$.assetProfile.state",),
    "country": ("$.assetProfile.country",),
    "website": ("$.assetProfile.website",),
    "address1": ("$.assetProfile.address1",),
    "exchange": ("$.price.exchangeName", "$.summaryDetail.exchange"),
    "currency": ("$.price.currency", "$.summaryDetail.currency"),
    "market_cap": ("$.price.marketCap", "$.summaryDetail.marketCap"),
}
HEADLINE_PATHS = {
    "totalAssets": "$.financialData.totalAssets",
    "totalDebt": "$.financialData.totalDebt",
    "investedCapital": "$.financialData.investedCapital",
    "sharesOutstanding": "$.defaultKeyStatistics.sharesOutstanding",
}
STATEMENTS_PATH = "$.balanceSheetHistoryQuarterly.balanceSheetStatements"
OWNERSHIP_PATHS = {
    "institution": "$.institutionOwnership.ownershipList",
    "mutual_fund": "$.fundOwnership.ownershipList",
}
GRADES_PATH = "$.upgradeDowngradeHistory.history"

_RESULT = "_result"


def _variant(path: str, source: str = _RESULT) -> Column:
    return F.try_variant_get(F.col(source), path, "variant")


def _best(paths: tuple[str, ...]) -> Column:
    """First member that is not falsy; the last one as it is."""
    *preferred, last = paths
    return F.coalesce(*[F.when(~is_falsy_json(_RESULT, p), _variant(p)) for p in preferred], _variant(last))


def _raw(path: str, source: str = _RESULT) -> Column:
    """Unwrapped value; an object with a null ``raw`` is null."""
    wrapped = F.try_variant_get(F.col(source), f"{path}.raw", "variant")
    return F.coalesce(wrapped, _variant(path, source))


def _payload(**members: Column) -> Column:
    return F.to_variant_object(F.struct(*[column.alias(name) for name, column in members.items()]))


def _envelopes(df: DataFrame, dataset: str, record_date: Column, payload: Column, carry: list[str]) -> DataFrame:
    return df.select(
        F.lit(dataset).alias("dataset"),
        "symbol",
        record_date.alias("record_date"),
        payload.alias("payload"),
        F.lit(DEFAULT_SOURCE).alias("source"),
        *carry,
    )


def _carried(documents: DataFrame) -> list[str]:
    return [c for c in documents.columns if c not in ("symbol", "payload", "dataset", "record_date", "source")]


def _with_result(documents: DataFrame, root: str) -> DataFrame:
    empty = F.parse_json(F.lit("{}"))
    return documents.withColumn(_RESULT, F.coalesce(first_result("payload", root), empty))


def profile_records(documents: DataFrame) -> DataFrame:
    """One ``basics`` record per document."""
    members = {name: _best(paths) for name, paths in PROFILE_PATHS.items()}
    df = _with_result(documents, SUMMARY_ROOT)
    return _envelopes(df, "basics", F.lit(None).cast("date"), _payload(**members), _carried(documents))


def statement_records(documents: DataFrame) -> DataFrame:
    """One ``fundamentals`` record per document, statements kept as a list."""
    members = {name: _raw(path) for name, path in HEADLINE_PATHS.items()}
    members["balanceSheetStatements"] = F.coalesce(_variant(STATEMENTS_PATH), F.parse_json(F.lit("[]")))
    df = _with_result(documents, SUMMARY_ROOT)
    return _envelopes(df, "fundamentals", F.lit(None).cast("date"), _payload(**members), _carried(documents))


def ownership_records(documents: DataFrame) -> DataFrame:
    """One ``holders`` record per list entry, or one placeholder per document.

    The two lists are joined and exploded once; the position of an entry tells
    which list it came from, and a document without entries keeps one row.
    """
    carry = _carried(documents)
    none = F.array().cast("array<variant>")
    lists = {kind: F.coalesce(variant_items(_RESULT, path), none) for kind, path in OWNERSHIP_PATHS.items()}
    df = (
        _with_result(documents, SUMMARY_ROOT)
        .select("symbol", *carry, _RESULT, *[c.alias(f"_{kind}") for kind, c in lists.items()])
        .select(
            "symbol",
            *carry,
            _RESULT,
            F.size("_institution").alias("_institutions"),
            F.posexplode_outer(F.concat(*[F.col(f"_{kind}") for kind in lists])).alias("_position", "_item"),
        )
    )
    first_list, second_list = OWNERSHIP_PATHS
    position = _payload(
        holder=_variant("$.organization", "_item"),
        shares=_raw("$.position", "_item"),
        value=_raw("$.value", "_item"),
        holder_type=F.when(F.col("_position") < F.col("_institutions"), first_list).otherwise(second_list),
    )
    breakdown = F.coalesce(_variant("$.majorHoldersBreakdown"), F.parse_json(F.lit("{}")))
    payload = F.when(F.col("_position").isNull(), _payload(majorHoldersBreakdown=breakdown)).otherwise(position)
    return _envelopes(df, "holders", unwrap_date("_item", "$.reportDate"), payload, _with_position(carry))


def grade_records(documents: DataFrame) -> DataFrame:
    """One ``ratings`` record per history entry."""
    carry = _carried(documents)
    df = _with_result(documents, SUMMARY_ROOT).select(
        "symbol", *carry, F.posexplode(variant_items(_RESULT, GRADES_PATH)).alias("_position", "_item")
    )
    payload = _payload(
        to_grade=_variant("$.toGrade", "_item"),
        from_grade=_variant("$.fromGrade", "_item"),
        action=_variant("$.action", "_item"),
        firm=_variant("$.firm", "_item"),
        epochGradeDate=_variant("$.epochGradeDate", "_item"),
    )
    return _envelopes(df, "ratings", unwrap_date("_item", "$.epochGradeDate"), payload, _with_position(carry))


def price_records(documents: DataFrame, start: date | str, end: date | str) -> DataFrame:
    """One ``daily_prices`` record per timestamp inside the window.

    Value arrays shorter than the timestamps give null.  Arrays are zipped before
    they are exploded, so a row carries its own values and no array.
    """
    first, last = check_window(start, end)
    carry = _carried(documents)
    quote = "$.indicators.quote[0]"
    names = ("open", "high", "low", "close", "volume")
    lists = _with_result(documents, CHART_ROOT).select(
        "symbol",
        *carry,
        variant_items(_RESULT, "$.timestamp").alias("_ts"),
        *[variant_items(_RESULT, f"{quote}.{n}").alias(f"_{n}") for n in names],
    )
    none = F.array().cast("array<variant>")
    zipped = F.arrays_zip("_ts", *[F.coalesce(f"_{n}", none).alias(f"_{n}") for n in names])
    df = lists.select("symbol", *carry, F.posexplode(zipped).alias("_position", "_quote")).select(
        "symbol", *carry, "_position", "_quote.*"
    )
    df = df.withColumn("_day", epoch_date(unwrap_long("_ts", "$"))).where(F.col("_day").between(F.lit(first), F.lit(last)))
    payload = _payload(**{n: F.col(f"_{n}") for n in names})
    return _envelopes(df, "daily_prices", F.col("_day"), payload, _with_position(carry))


def _with_position(carry: list[str]) -> list[str]:
    return [*carry, "_position"]
