"""Tables of a second data source to record envelopes.

The second source answers with data frames whose column names vary in case
and wording.  Columns are resolved by name against a list of alternatives and
the rows are projected to the same envelopes the first source yields.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.scalars import first_truthy, normalise_symbol, nullif, strip_text
from tidemark.operators.fallback import PROFILE_FIELDS, usable_fallback
from tidemark.registry import DEFAULT_SOURCE, UNKNOWN_FIRM

# Wording of the second source, in order of preference.
COMPANY_NAMES = ("longName", "shortName", "displayName")
SHARES_NAMES = ("sharesOutstanding", "impliedSharesOutstanding")
STATEMENT_METRICS = {"Total Assets": "totalAssets", "Total Debt": "totalDebt"}
HOLDER_NAMES = ("Holder",)
HOLDER_SHARES = ("Shares",)
HOLDER_DATES = ("Date Reported", "Date")
HOLDER_VALUES = ("Value",)
GRADE_DATES = ("Date", "Grade Date", "Index")
GRADE_FIRMS = ("Firm", "To Firm")
TO_GRADES = ("ToGrade", "To Grade", "to_grade")
FROM_GRADES = ("FromGrade", "From Grade", "from_grade")
GRADE_ACTIONS = ("Action",)
GRADE_SCORES = ("recommendation", "rating", "score")

def resolve(df: DataFrame, names: Sequence[str]) -> str | None:
    """The column whose name equals one of ``names`` in any case."""
    by_lower = {c.lower(): c for c in df.columns}
    return next((by_lower[n.lower()] for n in names if n.lower() in by_lower), None)


def resolved(df: DataFrame, names: Sequence[str], dtype: str) -> Column:
    """The resolved column, or null of the wanted type; a value that isn't of the type is null too."""
    found = resolve(df, names)
    return F.lit(None).cast(dtype) if found is None else F.col(f"`{found}`").try_cast(dtype)


_EXACT = "decimal(38,6)"


def exact_number(df: DataFrame, names: Sequence[str]) -> Column:
    """The resolved column as a decimal, so that no digit of a whole number is lost.

    What no decimal holds (text that is no number, NaN, infinities, numbers of
    over 32 digits) is null.
    """
    found = resolve(df, names)
    return F.lit(None).cast(_EXACT) if found is None else F.col(f"`{found}`").try_cast(_EXACT)


def wrapped_number(number: Column) -> Column:
    """``{"raw": n}`` with whole numbers as integers, in the type's own digits; null gives null."""
    integer = number.cast("decimal(38,0)")
    return F.when(number % 1 == 0, F.to_variant_object(F.struct(integer.alias("raw")))).when(
        number.isNotNull(), F.to_variant_object(F.struct(number.alias("raw")))
    )


def _midnight(day: Column) -> Column:
    return F.unix_date(day).cast("bigint") * 86_400


def _payload(**members: Column) -> Column:
    return F.to_variant_object(F.struct(*[c.alias(n) for n, c in members.items()]))


def _envelope(df: DataFrame, dataset: str, record_date: Column, payload: Column) -> DataFrame:
    carry = ["seq"] if "seq" in df.columns else []
    return df.select(
        F.lit(dataset).alias("dataset"),
        normalise_symbol("symbol").alias("symbol"),
        record_date.alias("record_date"),
        payload.alias("payload"),
        F.lit(DEFAULT_SOURCE).alias("source"),
        *carry,
    ).where(F.col("symbol") != "")


def statement_periods(wide: DataFrame, metric: str, periods: Sequence[str], by: Sequence[str] = ("symbol",)) -> DataFrame:
    """One column per period and one row per metric, turned into one row
    per period with a column per metric.

    Only the metrics of interest are kept before the rows are regrouped, so a
    period has at most that many rows.
    """
    amounts = [F.col(f"`{p}`").try_cast(_EXACT).alias(p) for p in periods]
    long = wide.where(F.col(metric).isin(*STATEMENT_METRICS)).select(*by, metric, *amounts).unpivot(
        [*by, metric], list(periods), "period_end", "amount"
    )
    # Two spellings of a day are one period.
    dated = long.withColumn("period_end", F.col("period_end").try_cast("date")).where("period_end IS NOT NULL")
    per_period = dated.groupBy(*by, "period_end").agg(
        *[
            F.max(F.when(F.col(metric) == label, F.col("amount"))).alias(name)
            for label, name in STATEMENT_METRICS.items()
        ]
    )
    return per_period.where(F.coalesce(*STATEMENT_METRICS.values()).isNotNull())


def profile_fallback(info: DataFrame) -> DataFrame:
    """Profile records; those without any usable member are dropped."""
    members = {name: resolved(info, (name,), "string") for name in PROFILE_FIELDS if name not in ("company_name", "market_cap")}
    members["fullTimeEmployees"] = resolved(info, ("fullTimeEmployees",), "bigint")
    members["company_name"] = first_truthy(*[resolved(info, (n,), "string") for n in COMPANY_NAMES])
    members["market_cap"] = resolved(info, ("marketCap",), "decimal(38,2)")
    records = _envelope(info, "basics", F.lit(None).cast("date"), _payload(**members))
    return records.where(usable_fallback())


def fundamentals_fallback(info: DataFrame, periods: DataFrame) -> DataFrame:
    """One record per symbol, its statements as a list.

    ``periods`` is the result of :func:`statement_periods`; a list holds one
    entry per reporting period of the symbol.
    """
    figures = list(STATEMENT_METRICS.values())
    listed = periods.groupBy("symbol").agg(F.collect_list(F.struct("period_end", *figures)).alias("_periods"))

    def statement(period: Column) -> Column:
        return _payload(
            endDate=F.to_variant_object(F.struct(_midnight(period["period_end"]).alias("raw"))),
            **{name: wrapped_number(period[name]) for name in figures},
        )

    ordered = listed.select("symbol", F.transform(F.sort_array("_periods", asc=False), statement).alias("_statements"))
    joined = info.join(ordered, "symbol", "left")
    *preferred, last = [exact_number(info, (n,)) for n in SHARES_NAMES]
    shares = F.coalesce(*[nullif(c, 0) for c in preferred], last)
    members = {name: wrapped_number(exact_number(info, (name,))) for name in ("totalAssets", "totalDebt", "investedCapital")}
    members["sharesOutstanding"] = wrapped_number(shares)
    members["balanceSheetStatements"] = F.coalesce(
        F.to_variant_object(F.col("_statements")), F.parse_json(F.lit("[]"))
    )
    records = _envelope(joined, "fundamentals", F.lit(None).cast("date"), _payload(**members))
    return records.where(usable_fallback())


def holders_fallback(positions: DataFrame, holder_type: str) -> DataFrame:
    """Positions with a holder and a date; without such columns, none."""
    if resolve(positions, HOLDER_NAMES) is None or resolve(positions, HOLDER_DATES) is None:
        return _envelope(positions, "holders", F.lit(None).cast("date"), F.parse_json(F.lit("{}"))).where(F.lit(False))
    holder = resolved(positions, HOLDER_NAMES, "string")
    reported = resolved(positions, HOLDER_DATES, "date")
    payload = _payload(
        holder=strip_text(holder),
        shares=wrapped_number(exact_number(positions, HOLDER_SHARES)),
        value=wrapped_number(exact_number(positions, HOLDER_VALUES)),
        holder_type=F.lit(holder_type),
    )
    kept = positions.where(holder.isNotNull() & reported.isNotNull())
    return _envelope(kept, "holders", reported, payload)


def ratings_fallback(grades: DataFrame) -> DataFrame:
    """Dated grades with the firm filled and an optional score.

    Without a column of a known name, the first one of dates or instants is the
    date; without that either there are no grades.
    """
    instants = (T.DateType, T.TimestampType, T.TimestampNTZType)
    others = [f.name for f in grades.schema.fields if isinstance(f.dataType, instants)]
    known = resolve(grades, GRADE_DATES) or next(iter(others), None)
    if known is None:
        return _envelope(grades, "ratings", F.lit(None).cast("date"), F.parse_json(F.lit("{}"))).where(F.lit(False))
    day = resolved(grades, (known,), "date")
    firm = nullif(strip_text(resolved(grades, GRADE_FIRMS, "string")), "")
    payload = _payload(
        firm=F.coalesce(firm, F.lit(UNKNOWN_FIRM)),
        to_grade=resolved(grades, TO_GRADES, "string"),
        from_grade=resolved(grades, FROM_GRADES, "string"),
        action=resolved(grades, GRADE_ACTIONS, "string"),
        epochGradeDate=F.to_variant_object(F.struct(_midnight(day).alias("raw"))),
        recommendation_score=F.nanvl(resolved(grades, GRADE_SCORES, "double"), F.lit(None).cast("double")),
    )
    return _envelope(grades.where(day.isNotNull()), "ratings", day, payload)
