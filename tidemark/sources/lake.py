"""Tables on shared storage.

Large tables are parquet folders by write and month of the key date, so an update rewrites only
the months it touches.  Rows are written once, into the folder of their write; a state file then
makes all its months current at once, and holds for each of them its rows, its newest cursor and
a digest, so that a poll needs no data file.  Readers open the folders that the state names:
they see a month before or after a write, never without its rows.  Small derived tables
(dimension, marts, history) are numbered generations, each made current by a state file too.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence
from dataclasses import dataclass, replace
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.scalars import check_window, truncate_to_millis, year_month
from tidemark.registry import PARTITION_COLUMN, TableSpec
from tidemark.sources.states import StateFolder

GENERATION = "generation"
_WRITE = "write"
_CURSOR = "ingested_at"
#: Of all stored tables and scratch copies: keys and digests in text take half the bytes that the default leaves.
COMPRESSION = "zstd"


@dataclass(frozen=True)
class Part:
    """The rows that one write gave one month."""

    month: int
    write: int
    rows: int
    newest: datetime | None = None
    #: Of keys and cursors, whatever their order; parts of a month are combined with ``^``.
    digest: int = 0
    #: Whether the rows were one per key when they were written.
    keyed: bool = False

    def newer_than(self, instant: datetime) -> bool:
        return self.newest is not None and self.newest > instant

    def to_state(self) -> list:
        entry = [self.month, self.write, self.rows, self.newest and self.newest.isoformat(), self.digest]
        return [*entry, True] if self.keyed else entry

    @staticmethod
    def of_state(entry: list) -> Part:
        month, write, rows, newest, digest, *keyed = entry
        return Part(month, write, rows, newest and parse_instant(newest), digest, bool(keyed))


def with_month(df: DataFrame, date_column: str) -> DataFrame:
    return df.withColumn(PARTITION_COLUMN, year_month(date_column))


def in_window(df: DataFrame, date_column: str, start: date | str, end: date | str) -> DataFrame:
    """C4: inclusive date window.  Where the table carries its month partition
    the window is also put on it, so that whole months are never listed or read."""
    first, last = check_window(start, end)
    windowed = df.where(F.col(date_column).between(F.lit(first), F.lit(last)))
    if PARTITION_COLUMN in df.columns:
        windowed = windowed.where(
            F.col(PARTITION_COLUMN).between(first.year * 100 + first.month, last.year * 100 + last.month)
        )
    return windowed


def newer_than(df: DataFrame, watermark: datetime | str, cursor: str = "ingested_at") -> DataFrame:
    """A4: rows whose cursor is strictly after the watermark."""
    return df.where(F.col(cursor) > F.lit(parse_instant(watermark)))


def parse_instant(value: datetime | str) -> datetime:
    """ISO text, ``Z`` allowed, or a datetime; a naive value is UTC."""
    instant = datetime.fromisoformat(value.strip().replace("Z", "+00:00")) if isinstance(value, str) else value
    return instant.replace(tzinfo=timezone.utc) if instant.tzinfo is None else instant.astimezone(timezone.utc)


def jdbc_scan(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    partition_column: str,
    bounds: tuple[str, str],
    partitions: int,
    **options: str,
) -> DataFrame:
    """A3 against a relational landing database.  Filters and columns are
    pushed to the database; the partition column and its bounds let many tasks
    read, as one task could not read a large table."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    return (
        reader.option("partitionColumn", partition_column)
        .option("lowerBound", bounds[0])
        .option("upperBound", bounds[1])
        .option("numPartitions", partitions)
        .load()
    )


@dataclass
class Lake:
    """Tables below one root directory."""

    spark: SparkSession
    root: str

    def path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    # Month-partitioned tables -------------------------------------------------

    def _states(self, layer: str, name: str) -> StateFolder:
        return StateFolder(self.spark, f"{self.path(layer, name)}/_states")

    def parts(self, layer: str, name: str) -> list[Part]:
        """What the table holds now, from its state: no data file is read."""
        return [Part.of_state(entry) for entry in self._states(layer, name).latest()[1].get("parts", [])]

    def newest(self, layer: str, name: str) -> datetime | None:
        """The newest cursor of a table, from its state."""
        return max((p.newest for p in self.parts(layer, name) if p.newest), default=None)

    def row_count(self, layer: str, name: str) -> int:
        """Stored rows of a table, from its state."""
        return sum(p.rows for p in self.parts(layer, name))

    def months(self, layer: str, name: str) -> dict[int, tuple[int, int, datetime | None]]:
        """Rows, digest and newest cursor per month, from the table's state."""
        found: dict[int, tuple[int, int, datetime | None]] = {}
        for p in self.parts(layer, name):
            rows, digest, newest = found.get(p.month, (0, 0, None))
            found[p.month] = (rows + p.rows, digest ^ p.digest, max(filter(None, (newest, p.newest)), default=None))
        return found

    def _open(self, layer: str, name: str, schema: T.StructType, keep: Callable[[Part], bool] | None) -> DataFrame:
        return self.read_parts(layer, name, schema, [p for p in self.parts(layer, name) if keep is None or keep(p)])

    def read_parts(self, layer: str, name: str, schema: T.StructType, parts: Sequence[Part]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], schema)
        root = self.path(layer, name)
        reader = self.spark.read.schema(schema).option("basePath", root)
        folders = [self._folder(layer, name, p) for p in parts]
        return reader.parquet(*folders).select(*schema.fieldNames())

    def _folder(self, layer: str, name: str, part: Part) -> str:
        return f"{self.path(layer, name)}/{_WRITE}={part.write}/{PARTITION_COLUMN}={part.month}"

    def landing(self, spec: TableSpec, keep: Callable[[Part], bool] | None = None) -> DataFrame:
        """``keep`` picks the parts to open by their state, before any file is listed."""
        return self._open("landing", spec.name, spec.stored_schema, keep)

    def staging(self, spec: TableSpec, keep: Callable[[Part], bool] | None = None) -> DataFrame:
        return self._open("staging", spec.staging_name, spec.stored_schema, keep)

    def curated(self, spec: TableSpec, keep: Callable[[Part], bool] | None = None) -> DataFrame:
        return self._open("curated", spec.curated_name, spec.stored_schema, keep)

    def fact(self, name: str, schema: T.StructType, keep: Callable[[Part], bool] | None = None) -> DataFrame:
        """Parts written under other columns read as the schema says: absent ones null, dropped ones gone."""
        return self._open("facts", name, schema, keep)

    def monthly(self, name: str, schema: T.StructType, keep: Callable[[Part], bool] | None = None) -> DataFrame:
        """A monthly table: its rows without the partition column."""
        return self._open("marts", name, self.stored(schema), keep).drop(PARTITION_COLUMN)

    @staticmethod
    def stored(schema: T.StructType) -> T.StructType:
        """A schema with the month partition behind it."""
        return T.StructType([*schema.fields, T.StructField(PARTITION_COLUMN, T.IntegerType())])

    def _month_writer(self, df: DataFrame, sort_columns: tuple[str, ...], by_month: bool):
        """Rebalanced and clustered rows, one set of files per month.

        ``rebalance`` groups rows by month and lets adaptive execution split a
        month that is larger than a task should take, so a hot month is never
        one file and a small one never many.  Rows that lie by month, as those
        read from a table of months do, are written by the tasks that hold them.
        """
        return (
            (df if by_month else df.hint("rebalance", PARTITION_COLUMN))
            .sortWithinPartitions(PARTITION_COLUMN, *sort_columns)
            .write.option("compression", COMPRESSION)
            .partitionBy(PARTITION_COLUMN)
        )

    def append_staging(self, spec: TableSpec, rows: DataFrame, by_month: bool = False, keyed: bool = False) -> list[Part]:
        """A5: append versions to the month-partitioned staging table; ``keyed`` says they are one per key."""
        return self._write(
            "staging", spec.staging_name, rows.select(*spec.columns), spec.date_column, spec.sort_columns, False,
            by_month=by_month, keyed=keyed,
        )

    def overwrite_months(
        self, layer: str, name: str, rows: DataFrame, date_column: str, sort_columns: tuple[str, ...],
        months: Collection[int] = (), by_month: bool = False, keyed: bool = False,
    ) -> list[Part]:
        """Replace exactly the months present in ``rows``, and ``months`` even where no row is left; others stay.

        ``by_month`` says that tasks hold rows of few months each, which then aren't shuffled;
        ``keyed``, that the rows are one per key.

        ``rows`` may be derived from the same table: the folders it reads stay until two
        writes later.
        """
        columns = [c for c in rows.columns if c != PARTITION_COLUMN]
        return self._write(layer, name, rows.select(*columns), date_column, sort_columns, True, months, by_month, keyed)

    def _write(
        self, layer: str, name: str, rows: DataFrame, date_column: str, sort_columns: tuple[str, ...], replacing: bool,
        emptied: Collection[int] = (), by_month: bool = False, keyed: bool = False,
    ) -> list[Part]:
        """Write the rows under a number of their own, then commit: a write that breaks has changed nothing.

        Its folder is written over by the next write, which has the same number.
        """
        states = self._states(layer, name)
        last, state = states.latest()
        number, parts = last + 1, [Part.of_state(entry) for entry in state.get("parts", [])]
        folder = f"{self.path(layer, name)}/{_WRITE}={number}"
        monthly = with_month(rows, date_column)
        writer = self._month_writer(monthly, sort_columns, by_month).mode("overwrite")
        writer.option("partitionOverwriteMode", "static").parquet(folder)
        written = [replace(p, keyed=keyed) for p in self._described(folder, number, monthly.schema, sort_columns)]
        touched = {p.month for p in written} | set(emptied) if replacing else set()
        if not written and not any(p.month in touched for p in parts):
            return []
        after = [p for p in parts if p.month not in touched] + written
        older = [Part.of_state(entry) for entry in state.get("before", [])]
        states.commit(
            number, {"parts": [p.to_state() for p in after], "before": [p.to_state() for p in parts if p not in after]}
        )
        # Replaced a write ago: readers have moved on to the state of this write or the last.
        for part in older:
            self.delete_part(layer, name, part)
        return written

    def _described(self, folder: str, number: int, schema: T.StructType, sort_columns: tuple[str, ...]) -> list[Part]:
        """Count what was stored: keys and cursor only are read back, one row per month comes out."""
        stored = self.spark.read.schema(schema).parquet(folder)
        cursor = F.col(_CURSOR) if _CURSOR in schema.fieldNames() else F.lit(None).cast("timestamp")
        counted = stored.groupBy(PARTITION_COLUMN).agg(
            F.count(F.lit(1)).alias("rows"),
            F.unix_micros(F.max(cursor)).alias("newest"),
            F.bit_xor(F.xxhash64(*sort_columns, truncate_to_millis(cursor))).alias("digest"),
        )
        epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)
        return [
            Part(r[PARTITION_COLUMN], number, r["rows"], r["newest"] and epoch + timedelta(microseconds=r["newest"]), r["digest"])
            for r in sorted(counted.collect())
        ]

    def stored_bytes(self, layer: str) -> int:
        """Bytes below a layer's folder, as the file system counts them."""
        files, place = self._files(f"{self.root.rstrip('/')}/{layer}")
        return files.getContentSummary(place).getLength() if files.exists(place) else 0

    def missing_parts(self, layer: str, name: str) -> list[Part]:
        """Parts of the state whose folder is gone."""
        gone = []
        for part in self.parts(layer, name):
            files, place = self._files(self._folder(layer, name, part))
            if not files.exists(place):
                gone.append(part)
        return gone

    def forget(self, layer: str, name: str, parts: Collection[Part]) -> None:
        """Take parts out of a table's state; their rows are to be written anew."""
        states = self._states(layer, name)
        last, state = states.latest()
        gone = {(p.month, p.write) for p in parts}
        kept = [entry for entry in state.get("parts", []) if (entry[0], entry[1]) not in gone]
        if gone:
            states.commit(last + 1, {"parts": kept, "before": []})

    def delete_part(self, layer: str, name: str, part: Part) -> None:
        """Remove a part's files; the state still names it."""
        files, place = self._files(self._folder(layer, name, part))
        files.delete(place, True)

    def versions(self, layer: str, name: str) -> dict[str, list[int]]:
        """Numbers of the writes that made each month; they differ after any write to it."""
        found: dict[str, list[int]] = {}
        for part in self.parts(layer, name):
            found.setdefault(str(part.month), []).append(part.write)
        return {month: sorted(writes) for month, writes in found.items()}

    def built(self, layer: str, name: str) -> StateFolder:
        """What a derived table was last built or checked from."""
        return StateFolder(self.spark, f"{self.path(layer, name)}/_built")

    def _files(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    # Published generations ----------------------------------------------------

    def _generations(self, name: str) -> StateFolder:
        return StateFolder(self.spark, f"{self.path('published', name)}/_states")

    def current_generation(self, name: str) -> int | None:
        return self._generations(name).latest()[0] or None

    def generation_path(self, name: str, generation: int, part: str = "rows") -> str:
        return f"{self.path('published', name)}/{part}/{GENERATION}={generation}"

    def commit_generation(
        self, name: str, generation: int, committed_at: datetime | None = None, note: dict | None = None
    ) -> None:
        at = parse_instant(committed_at or datetime.now(timezone.utc))
        self._generations(name).commit(generation, {"committed_at": at.isoformat(), "note": note or {}})

    def note(self, name: str) -> dict:
        """What was said when the current generation was published."""
        return self._generations(name).latest()[1].get("note", {})

    def publish(self, name: str, rows: DataFrame, sort_columns: tuple[str, ...] = (), note: dict | None = None) -> int:
        """A10: write a full new generation and make it current; the one before the last is deleted."""
        generation = (self.current_generation(name) or 0) + 1
        # Many small tasks would leave many small files; AQE sizes them from the data.
        sized = rows.hint("rebalance")
        if sort_columns:
            sized = sized.sortWithinPartitions(*sort_columns)
        sized.write.mode("overwrite").option("compression", COMPRESSION).parquet(self.generation_path(name, generation))
        self.commit_generation(name, generation, note=note)
        files, place = self._files(self.generation_path(name, generation - 2))
        files.delete(place, True)
        return generation

    def published(self, name: str, schema: T.StructType) -> DataFrame:
        generation = self.current_generation(name)
        if generation is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.generation_path(name, generation))

    # Views --------------------------------------------------------------------

    @staticmethod
    def create_view(df: DataFrame, name: str) -> None:
        """A view is the plan under a name; nothing is stored."""
        df.createOrReplaceTempView(name)


def months_of(df: DataFrame, date_column: str) -> list[int]:
    """Months present in a batch.  Their number is bounded by the calendar."""
    month = F.col(PARTITION_COLUMN) if PARTITION_COLUMN in df.columns else year_month(date_column)
    return sorted(row[0] for row in df.select(month.alias("m")).distinct().collect() if row[0] is not None)


def laid_by_month(df: DataFrame, date_column: str) -> DataFrame:
    """Rows of a month in few tasks, a month too large for one task in several."""
    return with_month(df, date_column).hint("rebalance", PARTITION_COLUMN)


def only_months(df: DataFrame, months: list[int]) -> DataFrame:
    """Partition predicate for a list of months."""
    predicate: Column = F.col(PARTITION_COLUMN).isin(months) if months else F.lit(False)
    return df.where(predicate)
