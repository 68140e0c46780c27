"""Record envelopes: reading and writing batches of semi-structured records (A1, A2).

An envelope is ``(dataset, symbol, record_date, payload, source,
load_timestamp, seq)``.  ``seq`` is the arrival number inside a batch; where a
producer gives none, file and position in the file stand in for it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.registry import DEFAULT_SOURCE

ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("dataset", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("record_date", T.DateType()),
        T.StructField("payload", T.VariantType()),
        T.StructField("source", T.StringType()),
        T.StructField("load_timestamp", T.TimestampType()),
        T.StructField("seq", T.LongType()),
    ]
)
ENVELOPE_COLUMNS = ENVELOPE_SCHEMA.fieldNames()
_CORRUPT = "_unreadable"
_READ_SCHEMA = T.StructType(ENVELOPE_SCHEMA.fields + [T.StructField(_CORRUPT, T.StringType())])


def safe_batch_name(batch_id: str) -> str:
    """Batch id as a path segment: everything but letters, digits, ``_ . -`` becomes ``_``."""
    return re.sub(r"[^A-Za-z0-9_.-]", "_", batch_id)


def safe_batch_name_column(batch_id: Column | str) -> Column:
    return F.regexp_replace(batch_id, "[^A-Za-z0-9_.-]", "_")


def batch_path(root: str, batch_id: str) -> str:
    return f"{root.rstrip('/')}/{safe_batch_name(batch_id)}"


_POSITION = ("_written", "_file", "_block")


def _with_file_position(raw: DataFrame) -> DataFrame:
    return raw.select(
        "*",
        F.col("_metadata.file_modification_time").alias("_written"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    )


def finish_envelopes(raw: DataFrame) -> DataFrame:
    """Refuse unreadable lines, fill the source and number the rows.

    Numbers count inside a load, so arrival order is the load first: its instant (of
    the file, where a record has none) and its folder.  Then come the record's
    number, file, block and row.
    """
    unreadable = F.raise_error(F.concat(F.lit("unreadable envelope: "), F.left(F.col(_CORRUPT), F.lit(200))))
    return raw.select(
        F.when(F.col(_CORRUPT).isNotNull(), unreadable.cast("string")).otherwise(F.col("dataset")).alias("dataset"),
        "symbol",
        "record_date",
        "payload",
        F.coalesce("source", F.lit(DEFAULT_SOURCE)).alias("source"),
        "load_timestamp",
        "seq",
        F.struct(
            F.coalesce("load_timestamp", "_written").alias("load"),
            F.expr("left(_file, length(_file) - length(substring_index(_file, '/', -1)))").alias("folder"),
            "seq",
            *_POSITION,
            F.monotonically_increasing_id().alias("_row"),
        ).alias("arrival"),
    )


def _json_options(reader, array_files: bool):
    return (
        reader.schema(_READ_SCHEMA)
        .option("columnNameOfCorruptRecord", _CORRUPT)
        .option("mode", "PERMISSIVE")
        .option("timeZone", "UTC")
        .option("multiLine", str(array_files).lower())
    )


def read_envelopes(spark: SparkSession, path: str, array_files: bool = False) -> DataFrame:
    """A1: read a batch.  ``array_files`` reads one JSON array per file, which
    Spark cannot split; JSON lines are the format for large batches."""
    return finish_envelopes(_with_file_position(_json_options(spark.read, array_files).json(path)))


def stream_envelopes(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """A1 as a stream over a directory of JSON-lines files.

    Rows can only be numbered inside a micro-batch: pass each one through
    :func:`finish_envelopes`.
    """
    reader = _json_options(spark.readStream, False)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return _with_file_position(reader.json(path))


def write_envelopes(envelopes: DataFrame, root: str, batch_id: str) -> str:
    """A2: write a batch as JSON lines and return its path.

    Nulls are written out so that a null and a missing payload member stay
    distinct; instants are written in UTC.  Files are compressed.
    """
    path = batch_path(root, batch_id)
    (
        envelopes.select(*ENVELOPE_COLUMNS)
        .write.mode("overwrite")
        .option("ignoreNullFields", "false")
        .option("timeZone", "UTC")
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        # A compressed file is read by one task, so none gets too large.
        .option("compression", "gzip")
        .option("maxRecordsPerFile", 500_000)
        .json(path)
    )
    return path


def with_arrival(envelopes: DataFrame) -> DataFrame:
    """Arrival order of envelopes that were not read from files: their load,
    their number, then their position inside the document they came from."""

    def given(name: str, kind: str) -> Column:
        return F.col(name).cast(kind) if name in envelopes.columns else F.lit(None).cast(kind)

    arrival = F.struct(
        given("load_timestamp", "timestamp").alias("load"),
        given("seq", "bigint").alias("seq"),
        F.coalesce(given("_position", "int"), F.lit(0)).alias("row"),
    )
    return envelopes.withColumn("arrival", arrival)
