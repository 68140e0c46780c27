"""Record envelopes to typed landing rows (lower half of B3-B7, B11, B16, C1-C3).

Each mapper returns candidate rows with a ``skip_reason`` (null when the row
is to be loaded), so that accepted and skipped rows come from one plan.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.scalars import normalise_symbol, nullif, strip_text
from tidemark.functions.variants import path_text, read_decimal, to_decimal, unwrap_date, unwrap_long, unwrapped, variant_items
from tidemark.operators.filters import (
    REASON,
    accepted,
    any_null,
    evaluate_once,
    hollow_profile,
    missing_symbol,
    rejected,
    tag_skips,
    unknown_dataset,
)
from tidemark.operators.metrics import load_metrics, union_all
from tidemark.registry import (
    BASIC_INFO,
    BY_DATASET,
    DAILY_PRICE,
    FUNDAMENTALS,
    HOLDERS,
    MAJOR_HOLDER_NAME,
    RATINGS,
    TABLES,
    UNKNOWN_FIRM,
    UNKNOWN_HOLDER,
    TableSpec,
)
from tidemark.sources.lake import parse_instant

ARRIVAL = "arrival"
ELEMENT = "element"  # position inside an exploded payload, 0 for whole records


@dataclass(frozen=True)
class Batch:
    """Values stamped on every row of one ingest run."""

    batch_id: str
    snapshot_date: date
    ingested_at: datetime
    source_system: str

    def audit(self) -> list[Column]:
        return [
            F.lit(parse_instant(self.ingested_at)).alias("ingested_at"),
            F.lit(self.source_system).alias("source_system"),
            F.lit(self.batch_id).alias("batch_id"),
        ]


def _of(envelopes: DataFrame, spec: TableSpec) -> DataFrame:
    return envelopes.where(F.col("dataset") == spec.dataset).withColumn("symbol", normalise_symbol("symbol"))


def _finish(tagged: DataFrame, spec: TableSpec, batch: Batch) -> DataFrame:
    business = [f.name for f in spec.fields]
    mapped = evaluate_once(tagged.select(*business, ARRIVAL, ELEMENT, REASON))
    return mapped.select(*business, *batch.audit(), ARRIVAL, ELEMENT, REASON)


def _text(path: str) -> Column:
    """Text of a payload member, whole: keys and values have no width."""
    return path_text("payload", path)


def _numbers(df: DataFrame, spec: TableSpec, paths: dict[str, str], payload: Column | str = "payload") -> DataFrame:
    """Add decimals read from payload members, in steps: the member is taken out
    once and read as a decimal once, as the conversion asks for both several times."""
    members = {f"_{column}": unwrapped(payload, path) for column, path in paths.items()}
    types = {column: spec.schema[column].dataType for column in paths}
    read = {f"_read_{c}": read_decimal(f"_{c}", t.precision, t.scale) for c, t in types.items()}
    converted = {c: to_decimal(f"_{c}", t.precision, t.scale, f"_read_{c}") for c, t in types.items()}
    return df.withColumns(members).withColumns(read).withColumns(converted)


def profile_rows(envelopes: DataFrame, batch: Batch) -> DataFrame:
    """B3, C2."""
    tagged = tag_skips(
        _of(envelopes, BASIC_INFO),
        {"missing_symbol": missing_symbol(), "hollow_profile": hollow_profile("payload")},
    )
    df = _numbers(tagged, BASIC_INFO, {"market_cap": "$.market_cap"}).select(
        "*",
        F.lit(batch.snapshot_date).alias("snapshot_date"),
        strip_text(nullif(_text("$.company_name"), "")).alias("company_name"),
        unwrap_long("payload", "$.fullTimeEmployees").alias("employee_count"),
        *[_text(f"$.{n}").alias(n) for n in ("industry", "sector", "city", "phone", "state", "country", "website")],
        _text("$.address1").alias("address"),
        nullif(_text("$.currency"), "").alias("currency"),
        nullif(_text("$.exchange"), "").alias("exchange"),
        F.lit(0).alias(ELEMENT),
    )
    return _finish(df, BASIC_INFO, batch)


def price_rows(envelopes: DataFrame, batch: Batch) -> DataFrame:
    """B7, C1, C3."""
    paths = {f"{n}_price": f"$.{n}" for n in ("open", "high", "low", "close")}
    df = _numbers(_of(envelopes, DAILY_PRICE), DAILY_PRICE, paths).select(
        "symbol",
        ARRIVAL,
        F.col("record_date").alias("price_date"),
        *paths,
        F.lit(None).cast(DAILY_PRICE.schema["adjusted_close"].dataType).alias("adjusted_close"),
        unwrap_long("payload", "$.volume").alias("volume"),
        F.lit(0).alias(ELEMENT),
    )
    rules = {
        "missing_symbol": missing_symbol(),
        "missing_date": F.col("price_date").isNull(),
        "missing_ohlcv": any_null("open_price", "high_price", "low_price", "close_price", "volume"),
    }
    return _finish(tag_skips(df, rules), DAILY_PRICE, batch)


def fundamental_rows(envelopes: DataFrame, batch: Batch) -> DataFrame:
    """A row per dated statement, else one ``ttm`` row when a headline exists.

    Statement figures of zero count as absent.  A record that yields no row is
    neither loaded nor counted as skipped.
    """
    headline = {
        "total_assets": "$.totalAssets",
        "total_debt": "$.totalDebt",
        "invested_capital": "$.investedCapital",
        "shares_issued": "$.sharesOutstanding",
    }
    undated = F.array().cast("array<variant>")
    records = _numbers(_of(envelopes, FUNDAMENTALS), FUNDAMENTALS, headline).select(
        "symbol",
        ARRIVAL,
        *headline,
        F.filter(
            F.coalesce(variant_items("payload", "$.balanceSheetStatements"), undated),
            lambda s: unwrap_date(s, "$.endDate").isNotNull(),
        ).alias("_statements"),
    )
    records = evaluate_once(records)
    any_headline = F.coalesce(*headline).isNotNull()
    # A missing symbol is one skipped record, whatever it holds.
    wanted = (F.size("_statements") > 0) | any_headline | missing_symbol()
    exploded = records.where(wanted).select(
        "*",
        F.posexplode_outer(F.when(~missing_symbol(), F.col("_statements"))).alias("_position", "_item"),
    )
    dated = F.col("_item").isNotNull()
    own = {"total_assets": "$.totalAssets", "total_debt": "$.totalDebt"}
    headlined = exploded.withColumns({f"_head_{c}": F.col(c) for c in own})
    df = _numbers(headlined, FUNDAMENTALS, own, "_item").select(
        "symbol",
        ARRIVAL,
        F.when(dated, unwrap_date("_item", "$.endDate")).otherwise(F.lit(batch.snapshot_date)).alias("statement_date"),
        F.when(dated, F.lit("quarterly")).otherwise(F.lit("ttm")).alias("period_type"),
        *[F.coalesce(nullif(c, 0), F.col(f"_head_{c}")).alias(c) for c in own],
        "invested_capital",
        "shares_issued",
        F.lit(None).cast("string").alias("currency"),
        F.coalesce("_position", F.lit(0)).alias(ELEMENT),
    )
    rules = {
        "missing_symbol": missing_symbol(),
        "missing_date": F.col("statement_date").isNull(),
        "missing_period": strip_text("period_type") == "",
    }
    return _finish(tag_skips(df, rules), FUNDAMENTALS, batch)


def holder_rows(envelopes: DataFrame, batch: Batch) -> DataFrame:
    """A position, or the placeholder of a breakdown-only record."""
    has_breakdown = path_text("payload", "$.majorHoldersBreakdown").isNotNull() & path_text(
        "payload", "$.holder"
    ).isNull()
    kind = F.lower(strip_text(F.coalesce(nullif(_text("$.holder_type"), ""), F.lit("unknown"))))
    name = F.coalesce(nullif(strip_text(_text("$.holder")), ""), F.lit(UNKNOWN_HOLDER))

    measures = {"shares": "$.shares", "market_value": "$.value"}
    df = _numbers(_of(envelopes, HOLDERS), HOLDERS, measures).select(
        "symbol",
        ARRIVAL,
        F.when(has_breakdown, F.lit("major"))
        .when(kind == "fund", F.lit("mutual_fund"))
        .otherwise(kind)
        .alias("holder_type"),
        F.when(has_breakdown, F.lit(MAJOR_HOLDER_NAME)).otherwise(name).alias("holder_name"),
        F.when(has_breakdown, F.lit(batch.snapshot_date)).otherwise(F.col("record_date")).alias("holdings_date"),
        *[F.when(~has_breakdown, F.col(c)).alias(c) for c in measures],
        F.lit(None).cast(HOLDERS.schema["pct_outstanding"].dataType).alias("pct_outstanding"),
        F.lit(0).alias(ELEMENT),
    )
    rules = {"missing_symbol": missing_symbol(), "missing_date": F.col("holdings_date").isNull()}
    return _finish(tag_skips(df, rules), HOLDERS, batch)


def rating_rows(envelopes: DataFrame, batch: Batch) -> DataFrame:
    """B6."""
    firm = F.coalesce(nullif(strip_text(_text("$.firm")), ""), F.lit(UNKNOWN_FIRM))
    df = _numbers(_of(envelopes, RATINGS), RATINGS, {"recommendation_score": "$.recommendation_score"}).select(
        "symbol",
        ARRIVAL,
        F.coalesce("record_date", unwrap_date("payload", "$.epochGradeDate")).alias("rating_date"),
        firm.alias("firm_name"),
        _text("$.to_grade").alias("to_grade"),
        _text("$.from_grade").alias("from_grade"),
        _text("$.action").alias("rating_action"),
        "recommendation_score",
        F.lit(0).alias(ELEMENT),
    )
    rules = {"missing_symbol": missing_symbol(), "missing_date": F.col("rating_date").isNull()}
    return _finish(tag_skips(df, rules), RATINGS, batch)


MAPPERS = {
    "basics": profile_rows,
    "daily_prices": price_rows,
    "fundamentals": fundamental_rows,
    "holders": holder_rows,
    "ratings": rating_rows,
}


def map_batch(envelopes: DataFrame, batch: Batch) -> dict[str, DataFrame]:
    """Candidate rows per landing table, skip reasons included."""
    return {BY_DATASET[dataset].name: mapper(envelopes, batch) for dataset, mapper in MAPPERS.items()}


def skipped_rows(envelopes: DataFrame, candidates: dict[str, DataFrame]) -> DataFrame:
    """Skipped rows per table and reason, unknown datasets included."""
    parts = [
        rejected(df).select(F.lit(name).alias("table_name"), F.col(REASON)) for name, df in candidates.items()
    ]
    strays = envelopes.where(unknown_dataset()).select(
        F.lit(None).cast("string").alias("table_name"), F.lit("unknown_dataset").alias(REASON)
    )
    return union_all([*parts, strays]).groupBy("table_name", REASON).agg(F.count(F.lit(1)).alias("skipped"))


def batch_metrics(candidates: dict[str, DataFrame]) -> DataFrame:
    """Rows per table and symbol that the batch writes."""
    return load_metrics({name: accepted(df) for name, df in candidates.items()})


def arrival_order(spec: TableSpec) -> list[str]:
    """Order in which rows of one key overwrite each other."""
    assert spec.name in TABLES
    return [ARRIVAL, ELEMENT]
