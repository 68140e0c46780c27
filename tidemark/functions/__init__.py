"""Column functions: pure expressions, evaluated inside the JVM."""

from tidemark.functions.scalars import (
    content_hash,
    distinct_days_in_month,
    first_truthy,
    mean_as_double,
    month_end,
    month_start,
    normalise_symbol,
    nullif,
    strip_text,
    surrogate_key,
    symbols_from_text,
    truncate_to_millis,
    version_key,
    window_epoch_bounds,
    year_month,
)
from tidemark.functions.variants import (
    first_result,
    is_blank_json,
    is_falsy_json,
    path_text,
    to_decimal,
    unwrap_date,
    unwrap_decimal,
    unwrap_long,
    unwrapped,
    variant_items,
)

__all__ = [
    "content_hash",
    "distinct_days_in_month",
    "first_result",
    "first_truthy",
    "is_blank_json",
    "is_falsy_json",
    "mean_as_double",
    "month_end",
    "month_start",
    "normalise_symbol",
    "nullif",
    "path_text",
    "strip_text",
    "surrogate_key",
    "symbols_from_text",
    "to_decimal",
    "truncate_to_millis",
    "unwrap_date",
    "unwrap_decimal",
    "unwrap_long",
    "unwrapped",
    "variant_items",
    "version_key",
    "window_epoch_bounds",
    "year_month",
]
