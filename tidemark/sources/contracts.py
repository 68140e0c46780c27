"""Schema contract (A13): a relation must have the columns and types of its registry entry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

_REPORT = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("problem", T.StringType()),
    ]
)


class ContractViolation(ValueError):
    """A table is missing or does not have its declared columns."""


def schema_mismatches(name: str, actual: T.StructType | None, expected: T.StructType) -> list[tuple[str, str, str]]:
    if actual is None:
        return [(name, "", "table is missing")]
    found = {f.name: f.dataType for f in actual.fields}
    problems = []
    for wanted in expected.fields:
        if wanted.name not in found:
            problems.append((name, wanted.name, "column is missing"))
        elif found[wanted.name] != wanted.dataType:
            problems.append(
                (name, wanted.name, f"is {found[wanted.name].simpleString()}, not {wanted.dataType.simpleString()}")
            )
    return problems


def contract_report(
    spark: SparkSession, relations: dict[str, DataFrame | None], expected: dict[str, T.StructType]
) -> DataFrame:
    """One row per mismatch; only schemas are looked at, no data is read."""
    rows = []
    for name, schema in expected.items():
        relation = relations.get(name)
        rows.extend(schema_mismatches(name, None if relation is None else relation.schema, schema))
    return spark.createDataFrame(rows, _REPORT)


def require_contract(relations: dict[str, DataFrame | None], expected: dict[str, T.StructType]) -> None:
    problems = []
    for name, schema in expected.items():
        relation = relations.get(name)
        problems.extend(schema_mismatches(name, None if relation is None else relation.schema, schema))
    if problems:
        raise ContractViolation("; ".join(f"{t}.{c}: {p}" for t, c, p in problems))
