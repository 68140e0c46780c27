"""One spelling of values on both engines: dates and instants as text, decimals as double."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

_INSTANT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def comparable(df: DataFrame) -> DataFrame:
    columns = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, _INSTANT)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        columns.append(c.alias(f.name))
    return df.select(*columns)


_RENDER = {
    "s": "{c}",
    "d": "CAST(CAST({c} AS DATE) AS VARCHAR)",
    "t": "strftime({c}, '%Y-%m-%d %H:%M:%S.%f')",
    "n": "CAST({c} AS DOUBLE)",
    "i": "CAST({c} AS BIGINT)",
    "b": "CAST({c} AS BOOLEAN)",
}


def rendered(columns: str, body: str, ctes: str = "") -> str:
    """SQL that prints ``body`` in the common spelling.

    ``columns`` lists ``name:kind`` pairs: s text, d date, t instant, n
    number, i integer, b boolean.
    """
    pairs = [part.split(":") for part in columns.split()]
    shown = ", ".join(f"{_RENDER[kind].format(c=name)} AS {name}" for name, kind in pairs)
    prefix = f"WITH {ctes} " if ctes else ""
    return f"{prefix}SELECT {shown} FROM ({body}) AS result"
