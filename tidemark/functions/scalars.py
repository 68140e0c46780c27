"""Text, date, key and numeric helpers over ordinary columns."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

#: White_Space of Unicode: what a Unicode-aware pattern takes for white space.
_WHITESPACE = "\t\n\x0b\f\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_text(c: Column | str) -> Column:
    """Trim every kind of whitespace; ``trim`` alone removes only spaces.

    A list of letters is looked up at both ends only; a pattern is tried at every letter.
    """
    return F.btrim(_col(c), F.lit(_WHITESPACE))


def nullif(c: Column | str, value) -> Column:
    return F.nullif(_col(c), F.lit(value))


def first_truthy(*columns: Column | str) -> Column:
    """First text that is neither null nor empty."""
    return F.coalesce(*[nullif(c, "") for c in columns])


def normalise_symbol(c: Column | str) -> Column:
    """Trim and upper-case a ticker, whatever its length.  Null stays null."""
    return F.upper(strip_text(c))


def symbols_from_text(c: Column | str, separator: str = ",") -> Column:
    """A separated list as a sorted array of distinct, clean symbols."""
    parts = F.transform(F.split(_col(c), separator), lambda part: F.upper(strip_text(part)))
    return F.array_sort(F.array_distinct(F.filter(parts, lambda part: part != "")))


def surrogate_key(*columns: Column | str, empty_for_null: tuple[str, ...] = ()) -> Column:
    """md5 over ``|``-joined columns.  A null part makes the key null
    unless its name is listed in ``empty_for_null``."""
    pieces: list[Column] = []
    for position, column in enumerate(columns):
        text = _col(column).cast("string")
        if isinstance(column, str) and column in empty_for_null:
            text = F.coalesce(text, F.lit(""))
        if position:
            pieces.append(F.lit("|"))
        pieces.append(text)
    return F.md5(F.concat(*pieces))


def content_hash(payload: Column | str) -> Column:
    """sha256 over the payload printed as JSON with sorted keys."""
    return F.sha2(F.to_json(_col(payload)), 256)


def version_key(key: Column | str, updated_at: Column | str) -> Column:
    """Row identity inside a history table."""
    return F.md5(
        F.concat(
            F.coalesce(_col(key).cast("string"), F.lit("")),
            F.lit("|"),
            F.coalesce(_col(updated_at).cast("string"), F.lit("")),
        )
    )


def month_start(c: Column | str) -> Column:
    return F.trunc(_col(c), "MM")


def month_end(c: Column | str) -> Column:
    return F.last_day(_col(c))


def year_month(c: Column | str) -> Column:
    """Partition value ``yyyymm`` of a date."""
    return (F.year(_col(c)) * 100 + F.month(_col(c))).cast("int")


def truncate_to_millis(c: Column | str) -> Column:
    return F.date_trunc("MILLISECOND", _col(c))


def mean_as_double(c: Column | str) -> Column:
    """Mean of an exact type as double: exact sum first, one division last.

    The result does not depend on the order of rows, which a running double
    mean would.
    """
    return F.sum(_col(c)).cast("double") / F.count(_col(c))


def distinct_days_in_month(c: Column | str) -> Column:
    """Exact number of distinct dates when all rows share one calendar month.

    Each day sets one bit, so the state is a single long that merges before
    the shuffle.  A general ``count_distinct`` would shuffle every date.
    """
    day_bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.dayofmonth(_col(c)))
    return F.bit_count(F.bit_or(day_bit)).cast("bigint")


def window_epoch_bounds(start: date | str, end: date | str) -> tuple[Column, Column]:
    """UTC epoch seconds of an inclusive date window, end made exclusive."""
    first, last = check_window(start, end)
    day = 86_400
    origin = date(1970, 1, 1)
    return F.lit((first - origin).days * day), F.lit(((last - origin).days + 1) * day)


def check_window(start: date | str, end: date | str) -> tuple[date, date]:
    first = date.fromisoformat(start) if isinstance(start, str) else start
    last = date.fromisoformat(end) if isinstance(end, str) else end
    if first > last:
        raise ValueError(f"window start {first} is after its end {last}")
    return first, last
