"""Choosing symbols: screening, ranking, batching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import ensure_checkpoint_dir

DEFAULT_LIMIT = 25

# The screen for listed companies of the sector.
SCREEN_REGION = "us"
SCREEN_SECTOR = "Financial Services"
EXCHANGE_RANGE = ("NMS", "NYQ")
EXTRA_EXCHANGE = "ASE"
INDUSTRY_WORD = "BANK"


def screen(region: str = SCREEN_REGION, sector: str = SCREEN_SECTOR) -> Column:
    """C7, first stage: region, sector and exchange."""
    return (
        (F.col("region") == region)
        & (F.col("sector") == sector)
        & (F.col("exchange").between(*EXCHANGE_RANGE) | (F.col("exchange") == EXTRA_EXCHANGE))
    )


def industry_match(word: str = INDUSTRY_WORD) -> Column:
    """C7, second stage: a symbol is present and its industry contains the word."""
    return (F.coalesce(F.col("symbol"), F.lit("")) != "") & F.contains(
        F.upper(F.coalesce(F.col("industry"), F.lit(""))), F.lit(word)
    )


def ranked_universe(
    quotes: DataFrame,
    coarse: Column,
    fine: Column,
    rank_by: str,
    tie_break: str,
    limit: int = DEFAULT_LIMIT,
    screen_size: int | None = None,
) -> DataFrame:
    """All quotes that pass both filters, largest first, up to ``limit``.

    ``screen_size`` keeps only so many of the coarse filter before the fine one,
    as a paged source would; without it no eligible symbol is lost.  Each cut
    runs as a top-k per task and a merge of at most k rows per task.
    """
    order = [F.col(rank_by).desc_nulls_last(), F.col(tie_break).asc()]
    largest = quotes.where(coarse)
    if screen_size is not None:
        largest = largest.orderBy(*order).limit(screen_size)
    return largest.where(fine).orderBy(*order).limit(limit)


def batch_numbers(df: DataFrame, key: str, size: int) -> DataFrame:
    """Number rows by ``key`` order in batches of ``size``, from 1.

    A global row number over one window would pull every row into one task.
    Rows are range-partitioned and sorted instead; the row number inside a
    partition comes with the partition, and only one count per partition is
    summed up.  The sorted rows are checkpointed because both uses must see
    the same partition bounds.
    """
    if size < 1:
        raise ValueError("batch size must be at least 1")
    ensure_checkpoint_dir(df.sparkSession)
    row_bits = 33  # monotonically_increasing_id keeps the row of a partition in its low 33 bits
    ranged = (
        df.repartitionByRange(F.col(key))
        .sortWithinPartitions(key)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_id", row_bits))
        .withColumn("_row", F.col("_id").bitwiseAND((1 << row_bits) - 1))
        .checkpoint()
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    position = F.col("_row") + F.col("_offset")
    return (
        ranged.join(offsets, "_part")
        .withColumn("batch_number", (F.floor(position / size) + 1).cast("bigint"))
        .drop("_id", "_part", "_row", "_offset")
    )
