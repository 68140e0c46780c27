"""Reading semi-structured payloads held as VARIANT.

A number may arrive bare (``5``) or wrapped (``{"raw": 5}``).  Text that is no
number, and wrapped nulls, become null.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_FIRST_EPOCH_SECOND = -62135596800  # 0001-01-01
_LAST_EPOCH_SECOND = 253402300799  # 9999-12-31
_SECONDS_PER_DAY = 86_400


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unwrapped(payload: Column | str, path: str) -> Column:
    """Value at ``path``, taken out of its ``raw`` wrapper if it has one."""
    v = _col(payload)
    return F.coalesce(F.try_variant_get(v, f"{path}.raw", "variant"), F.try_variant_get(v, path, "variant"))


def path_text(payload: Column | str, path: str) -> Column:
    """Value at ``path`` as text; JSON null and missing are null."""
    return F.try_variant_get(_col(payload), path, "string")


def read_decimal(value: Column | str, precision: int, scale: int) -> Column:
    """An unwrapped value as a decimal where it has room, booleans as 0 and 1: see :func:`to_decimal`."""
    return F.try_variant_get(_col(value), "$", f"decimal({precision},{scale})")


def to_decimal(value: Column | str, precision: int, scale: int, read: Column | str | None = None) -> Column:
    """An unwrapped number as a decimal, rounded half up.

    A finite number the target has no room for raises, as a database column
    would; text that is no number, booleans, NaN and infinities are null.
    ``value`` and ``read``, its :func:`read_decimal`, are read more than once, so give them as
    columns of their own.  Only a 0 or 1 can be a boolean, so no other number is asked for its type.
    """
    v = _col(value)
    target = f"decimal({precision},{scale})"
    number = read_decimal(v, precision, scale) if read is None else _col(read)
    no_boolean = F.schema_of_variant(v) != "BOOLEAN"
    finite = F.abs(F.try_variant_get(v, "$", "double")) < float("inf")
    overflow = F.when(no_boolean & finite, F.raise_error(F.lit(f"number does not fit {target}")).cast(target))
    return (
        F.when(number.isNull(), overflow)
        .when((number == 0) | (number == 1), F.when(no_boolean, number))
        .otherwise(number)
    )


def unwrap_decimal(payload: Column | str, path: str, precision: int, scale: int) -> Column:
    """B2: number at ``path`` as a decimal."""
    return to_decimal(unwrapped(payload, path), precision, scale)


def unwrap_long(payload: Column | str, path: str) -> Column:
    """B2: number at ``path`` as a long.  ``1.9`` gives 1, the text ``"1.5"`` gives null."""
    return F.try_variant_get(unwrapped(payload, path), "$", "bigint")


def epoch_date(seconds: Column | str) -> Column:
    """UTC date of epoch seconds; null outside the years 1 to 9999."""
    s = _col(seconds)
    in_calendar = F.when(s.between(_FIRST_EPOCH_SECOND, _LAST_EPOCH_SECOND), s)
    return F.date_from_unix_date(F.floor(in_calendar / _SECONDS_PER_DAY).cast("int"))


def unwrap_date(payload: Column | str, path: str) -> Column:
    """B2: epoch seconds at ``path`` as a UTC date."""
    return epoch_date(unwrap_long(payload, path))


def first_result(payload: Column | str, root: str) -> Column:
    """B1: first element of ``root.result``; null when there is none."""
    return F.try_variant_get(_col(payload), f"$.{root}.result[0]", "variant")


def variant_items(payload: Column | str, path: str) -> Column:
    """Array at ``path`` as ``array<variant>``; anything else is null."""
    return F.try_variant_get(_col(payload), path, "array<variant>")


def _printed(payload: Column | str, path: str) -> Column:
    return F.to_json(F.try_variant_get(_col(payload), path, "variant"))


def is_blank_json(payload: Column | str, path: str) -> Column:
    """Missing, null, empty text, zero or false.  An object or list is a value."""
    return F.coalesce(_printed(payload, path).rlike(r'^(null|""|false|-?0(\.0*)?(E.*)?)$'), F.lit(True))


def is_falsy_json(payload: Column | str, path: str) -> Column:
    """Blank, or an empty object or list."""
    return F.coalesce(_printed(payload, path).rlike(r'^(null|""|false|\{\}|\[\]|-?0(\.0*)?(E.*)?)$'), F.lit(True))
