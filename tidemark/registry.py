"""Typed table registry: schema, natural key, date column, sort order and
row constraints for every table the library reads or writes (A14, A15).

One :class:`TableSpec` describes a table family in all three layers.  Landing
holds one current row per natural key, staging (``stg_``) appends versions, and
curated (``cur_``) holds the newest version per key.  Staging and curated keep
``ingested_at`` in milliseconds; the schemas are otherwise the same.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

PARTITION_COLUMN = "yyyymm"

# The text the data model uses for sources and placeholders.
DEFAULT_SOURCE = "yahoo_finance"
UNKNOWN = "UNKNOWN"
UNKNOWN_FIRM = "UNKNOWN_FIRM"
UNKNOWN_HOLDER = "UNKNOWN_HOLDER"
MAJOR_HOLDER_NAME = "_major_holders_breakdown"
PERIOD_TYPES = ("annual", "quarterly", "ttm")
HOLDER_TYPES = ("institution", "insider", "mutual_fund", "major")
DEFAULT_WINDOW = ("2024-01-01", "2025-12-31")
EPOCH_WATERMARK = "1970-01-01T00:00:00+00:00"
DATASETS = ("basics", "daily_prices", "fundamentals", "holders", "ratings")


def _field(name: str, dtype: T.DataType, comment: str, nullable: bool = True) -> T.StructField:
    return T.StructField(name, dtype, nullable, {"comment": comment})


def _text(name: str, comment: str, nullable: bool = True) -> T.StructField:
    return _field(name, T.StringType(), comment, nullable)


def _dec(name: str, precision: int, scale: int, comment: str, nullable: bool = True) -> T.StructField:
    return _field(name, T.DecimalType(precision, scale), comment, nullable)


_AUDIT = (
    _field("ingested_at", T.TimestampType(), "UTC instant of the load, one per batch", False),
    _text("source_system", "System the row was read from", False),
    _text("batch_id", "Identifier of the ingest run", False),
)
AUDIT_COLUMNS = tuple(f.name for f in _AUDIT)

# Newest version first; the later columns only break ties.
VERSION_ORDER = ("ingested_at", "batch_id", "source_system")


@dataclass(frozen=True)
class TableSpec:
    """One table family.  ``checks`` are SQL predicates; NULL passes a check."""

    name: str
    dataset: str
    description: str
    key: tuple[str, ...]
    date_column: str
    fields: tuple[T.StructField, ...]
    checks: dict[str, str] = field(default_factory=dict)
    clustering: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType(list(self.fields) + list(_AUDIT))

    @property
    def stored_schema(self) -> T.StructType:
        """Schema as written: the columns plus the month partition."""
        return T.StructType(list(self.schema.fields) + [T.StructField(PARTITION_COLUMN, T.IntegerType())])

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]

    @property
    def sort_columns(self) -> tuple[str, ...]:
        return self.clustering or self.key

    @property
    def staging_name(self) -> str:
        return f"stg_{self.name}"

    @property
    def curated_name(self) -> str:
        return f"cur_{self.name}"


BASIC_INFO = TableSpec(
    name="bank_basic_info",
    dataset="basics",
    description="Company profile per symbol and snapshot date",
    key=("symbol", "snapshot_date"),
    date_column="snapshot_date",
    fields=(
        _text("symbol", "Ticker, trimmed and upper case", False),
        _field("snapshot_date", T.DateType(), "UTC business date of the run", False),
        _text("company_name", "Long company name"),
        _text("industry", "Industry label"),
        _text("sector", "Sector label"),
        _field("employee_count", T.LongType(), "Full-time employees"),
        _text("city", "City of the head office"),
        _text("phone", "Phone number"),
        _text("state", "State or province"),
        _text("country", "Country"),
        _text("website", "Web address"),
        _text("address", "First address line"),
        _dec("market_cap", 20, 2, "Market capitalisation"),
        _text("currency", "Quote currency"),
        _text("exchange", "Exchange code"),
    ),
    checks={
        "employee_count_non_negative": "employee_count >= 0",
        "market_cap_non_negative": "market_cap >= 0",
    },
)

DAILY_PRICE = TableSpec(
    name="stock_daily_price",
    dataset="daily_prices",
    description="Daily open, high, low, close and volume per symbol",
    key=("symbol", "price_date"),
    date_column="price_date",
    fields=(
        _text("symbol", "Ticker, trimmed and upper case", False),
        _field("price_date", T.DateType(), "UTC trading date", False),
        _dec("open_price", 18, 6, "Opening price", False),
        _dec("high_price", 18, 6, "Highest price", False),
        _dec("low_price", 18, 6, "Lowest price", False),
        _dec("close_price", 18, 6, "Closing price", False),
        _dec("adjusted_close", 18, 6, "Adjusted close; not delivered by the live source"),
        _field("volume", T.LongType(), "Traded volume", False),
    ),
    checks={
        "prices_non_negative": "least(open_price, high_price, low_price, close_price) >= 0"
        " AND coalesce(adjusted_close, 0) >= 0",
        "ohlc_consistent": "high_price >= greatest(low_price, open_price, close_price)"
        " AND low_price <= least(open_price, close_price)",
        "volume_non_negative": "volume >= 0",
    },
)

FUNDAMENTALS = TableSpec(
    name="bank_fundamentals",
    dataset="fundamentals",
    description="Balance-sheet figures per symbol, statement date and period type",
    key=("symbol", "statement_date", "period_type"),
    date_column="statement_date",
    fields=(
        _text("symbol", "Ticker, trimmed and upper case", False),
        _field("statement_date", T.DateType(), "Last day of the reported period", False),
        _text("period_type", "annual, quarterly or ttm", False),
        _dec("total_assets", 22, 2, "Total assets"),
        _dec("total_debt", 22, 2, "Total debt"),
        _dec("invested_capital", 22, 2, "Invested capital"),
        _dec("shares_issued", 22, 2, "Shares issued"),
        _text("currency", "Reporting currency"),
    ),
    checks={
        "amounts_non_negative": "least(total_assets, total_debt, invested_capital, shares_issued) >= 0",
    },
)

HOLDERS = TableSpec(
    name="holders",
    dataset="holders",
    description="Positions of institutions, insiders and funds",
    key=("symbol", "holder_type", "holder_name", "holdings_date"),
    date_column="holdings_date",
    clustering=("symbol", "holdings_date", "holder_type", "holder_name"),
    fields=(
        _text("symbol", "Ticker, trimmed and upper case", False),
        _text("holder_type", "institution, insider, mutual_fund or major", False),
        _text("holder_name", "Name of the holder", False),
        _field("holdings_date", T.DateType(), "Date the position was reported for", False),
        _dec("shares", 22, 2, "Shares held"),
        _dec("market_value", 22, 2, "Value of the position"),
        _dec("pct_outstanding", 9, 6, "Share of the outstanding stock, 0 to 1"),
    ),
    checks={
        "holdings_in_range": "coalesce(shares, 0) >= 0 AND coalesce(market_value, 0) >= 0"
        " AND coalesce(pct_outstanding, 0) BETWEEN 0 AND 1",
    },
)

RATINGS = TableSpec(
    name="ratings",
    dataset="ratings",
    description="Analyst rating actions per symbol, date and firm",
    key=("symbol", "rating_date", "firm_name"),
    date_column="rating_date",
    fields=(
        _text("symbol", "Ticker, trimmed and upper case", False),
        _field("rating_date", T.DateType(), "Date of the rating action", False),
        _text("firm_name", "Name of the firm", False),
        _text("to_grade", "Grade after the action"),
        _text("from_grade", "Grade before the action"),
        _text("rating_action", "Kind of action"),
        _dec("recommendation_score", 8, 4, "Numeric recommendation"),
    ),
    checks={"score_non_negative": "recommendation_score >= 0"},
)

TABLES: dict[str, TableSpec] = {
    spec.name: spec for spec in (BASIC_INFO, DAILY_PRICE, FUNDAMENTALS, HOLDERS, RATINGS)
}
BY_DATASET: dict[str, TableSpec] = {spec.dataset: spec for spec in TABLES.values()}


@dataclass(frozen=True)
class FactSpec:
    """A fact table: the staging columns behind a hashed surrogate key."""

    name: str
    source: TableSpec
    surrogate: str
    key_parts: tuple[str, ...]
    empty_for_null: tuple[str, ...] = ()


# Order of the hashed columns is part of the key and differs from the natural key for some tables.
FACTS: dict[str, FactSpec] = {
    fact.name: fact
    for fact in (
        FactSpec("fct_stock_daily", DAILY_PRICE, "stock_daily_sk", ("symbol", "price_date")),
        FactSpec("fct_bank_fundamentals", FUNDAMENTALS, "fundamentals_sk", ("symbol", "statement_date", "period_type")),
        FactSpec(
            "fct_holders",
            HOLDERS,
            "holders_sk",
            ("symbol", "holder_type", "holder_name", "holdings_date"),
            empty_for_null=("holder_type",),
        ),
        FactSpec("fct_ratings", RATINGS, "ratings_sk", ("symbol", "rating_date", "firm_name")),
    )
}

DIMENSION_NAME = "dim_bank_profile"
MONTHLY_MART_NAME = "mart_monthly_stock_summary"
MONTHLY_SUMMARY_NAME = "monthly_bank_stock_summary"
HISTORY_NAME = "snap_dim_bank_profile"

DIMENSION_SCHEMA = T.StructType(
    [
        T.StructField(f.name, f.dataType, f.name not in ("symbol", "snapshot_date"), f.metadata)
        for f in BASIC_INFO.schema.fields
    ]
)

MONTHLY_MART_SCHEMA = T.StructType(
    [
        _text("symbol", "Ticker", False),
        _text("company_name", "Newest known company name; may be null"),
        _field("year", T.IntegerType(), "Calendar year", False),
        _field("month", T.IntegerType(), "Calendar month, 1 to 12", False),
        _field("month_start_date", T.DateType(), "First day of the month", False),
        _field("month_end_date", T.DateType(), "Last day of the month", False),
        _field("avg_open_price", T.DoubleType(), "Mean opening price of accepted days", False),
        _field("avg_close_price", T.DoubleType(), "Mean closing price of accepted days", False),
        _field("avg_volume", T.DoubleType(), "Mean daily volume", False),
        _dec("min_open_price", 18, 6, "Lowest opening price"),
        _dec("max_close_price", 18, 6, "Highest closing price"),
        _field("trading_days_count", T.LongType(), "Exact number of distinct trading days", False),
        _field("min_price_date", T.DateType(), "First accepted day", False),
        _field("max_price_date", T.DateType(), "Last accepted day", False),
        _field("source_row_count", T.LongType(), "Accepted daily rows", False),
        _field("loaded_at", T.TimestampType(), "UTC instant the row was built", False),
    ]
)

MONTHLY_SUMMARY_SCHEMA = T.StructType(
    [
        _text("symbol", "Ticker", False),
        _field("month_date", T.DateType(), "First day of the month", False),
        _field("avg_open_price", T.DoubleType(), "Mean opening price", False),
        _field("avg_close_price", T.DoubleType(), "Mean closing price", False),
        _field("avg_volume", T.DoubleType(), "Mean volume", False),
    ]
)
