"""Composed jobs.

Every job is restartable: each write replaces or appends in a way that a
repeat run makes harmless, and the watermark is committed last.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.scalars import normalise_symbol, year_month
from tidemark.operators import quality as q
from tidemark.operators.fallback import hollow_primary, merge_sources
from tidemark.operators.filters import accepted, require_constraints
from tidemark.operators.history import HISTORY_COLUMNS, VALID_TO, history_schema, snapshot_changes
from tidemark.operators.incremental import Decision, Plan, decide
from tidemark.operators.merging import last_write_per_key, replace_by_key
from tidemark.operators.metrics import METRICS_SCHEMA, union_all
from tidemark.operators.versioning import latest_by_key
from tidemark.plans import models
from tidemark.plans.checks import mart_checks, model_checks, staging_checks
from tidemark.plans.landing import Batch, arrival_order, batch_metrics, map_batch, skipped_rows
from tidemark.registry import (
    BASIC_INFO,
    DAILY_PRICE,
    DATASETS,
    DEFAULT_WINDOW,
    DIMENSION_NAME,
    DIMENSION_SCHEMA,
    FACTS,
    HISTORY_NAME,
    MONTHLY_MART_NAME,
    MONTHLY_MART_SCHEMA,
    MONTHLY_SUMMARY_NAME,
    MONTHLY_SUMMARY_SCHEMA,
    PARTITION_COLUMN,
    TABLES,
    VERSION_ORDER,
    TableSpec,
)
from tidemark.session import delete_scratch, scratch_path, size_shuffles
from tidemark.sources.contracts import require_contract
from tidemark.sources.envelopes import ENVELOPE_SCHEMA, read_envelopes, with_arrival
from tidemark.sources.lake import COMPRESSION, GENERATION, Lake, Part, laid_by_month, months_of, newer_than, parse_instant
from tidemark.sources.states import StateFolder
from tidemark.sources.watermark import WatermarkStore

_OTHER = "other"
#: Rows of a month that one task is dealt when versions are compared.
_BUCKET_ROWS = 500_000
_PRICE_FACT = next(name for name, fact in FACTS.items() if fact.source is DAILY_PRICE)
_PROFILE_STATE = f"{DIMENSION_NAME}_state"
_MART_NAMES = f"{MONTHLY_MART_NAME}_names"
_NAMES_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("symbol", "company_name")])


@dataclass(frozen=True)
class Window:
    start: str = DEFAULT_WINDOW[0]
    end: str = DEFAULT_WINDOW[1]
    years: tuple[int, ...] = (2024, 2025)


# Envelopes to landing -----------------------------------------------------


def split_by_dataset(spark: SparkSession, envelopes: DataFrame) -> tuple[DataFrame, str]:
    """Parse a batch once and store it by dataset, so that each mapper reads
    only its own part and a lost executor never re-reads the text files.  The
    folder of the copy is the caller's to delete."""
    path = scratch_path(spark, "batch")
    part = F.when(F.col("dataset").isin(*DATASETS), F.col("dataset")).otherwise(F.lit(_OTHER))
    tagged = envelopes.withColumn("part", part).withColumnRenamed("dataset", "raw_dataset")
    tagged.write.option("compression", COMPRESSION).partitionBy("part").parquet(path)
    stored = spark.read.schema(tagged.schema).parquet(path)
    return stored.withColumn("dataset", F.when(F.col("part") != _OTHER, F.col("part")).otherwise(F.col("raw_dataset"))), path


def stored_rows(rows: DataFrame, path: str) -> DataFrame:
    """A scratch copy of rows that are read more than once: unlike a cache it takes no executor's memory."""
    rows.write.option("compression", COMPRESSION).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def upsert_landing(lake: Lake, spec: TableSpec, rows: DataFrame) -> None:
    """A7 on stored landing: only the months the batch touches are read and rewritten."""
    largest = largest_month(rows, spec.date_column)
    dealt, place = dealt_by_month(rows, spec.date_column, spec.key, largest)
    replace_landed(lake, spec, last_write_per_key(dealt, [*place, *spec.key], arrival_order(spec)).select(*spec.columns), True)


def replace_landed(lake: Lake, spec: TableSpec, incoming: DataFrame, by_month: bool = False) -> None:
    """Put rows, one per key, into the landing months they touch.

    Incoming rows are stored before they are compared with what is there, as their months, their
    keys and they themselves are asked for; into an empty table they are written directly, and
    without a shuffle where they lie ``by_month``.
    """
    there = lake.parts("landing", spec.name)
    if not there:
        lake.overwrite_months("landing", spec.name, incoming, spec.date_column, spec.sort_columns, by_month=by_month, keyed=True)
        return
    # Null keys never meet, so only keys that staging refuses as null stay one per key.
    keyed = all(p.keyed for p in there) and set(spec.key) <= set(spec.required)
    scratch = scratch_path(lake.spark, "incoming")
    try:
        stored = stored_rows(incoming, scratch)
        months = set(months_of(stored, spec.date_column))
        if not months:
            return
        current = lake.landing(spec, lambda part: part.month in months).select(*spec.columns)
        merged = replace_by_key(current, stored, spec.key)
        lake.overwrite_months("landing", spec.name, merged, spec.date_column, spec.sort_columns, keyed=keyed)
    finally:
        delete_scratch(lake.spark, scratch)


def ingest_batch(lake: Lake, envelopes: DataFrame, batch: Batch) -> dict[str, DataFrame]:
    """Map, check everything, then write.  Returns metrics and skip counts.

    A constraint violation in any table refuses the whole batch before the
    first write.
    """
    spark = lake.spark
    stored, scratch = split_by_dataset(spark, envelopes)
    folders = [scratch]
    try:
        present = {row[0] for row in stored.select("part").distinct().collect()}  # at most one per dataset, plus one
        candidates = {}
        for name, rows in map_batch(stored, batch).items():
            if TABLES[name].dataset in present:
                folders.append(scratch_path(spark, f"candidates-{name}"))
                candidates[name] = stored_rows(rows, folders[-1])
        for name, rows in candidates.items():
            spec = TABLES[name]
            require_constraints(accepted(rows), spec.checks, spec.required)
        for name, rows in candidates.items():
            upsert_landing(lake, TABLES[name], accepted(rows))
        reports = {
            "rows": batch_metrics(candidates) if candidates else spark.createDataFrame([], METRICS_SCHEMA),
            "skipped": skipped_rows(stored, candidates),
            "datasets": stored.groupBy("dataset").agg(F.count(F.lit(1)).alias("record_count")),
        }
        # Small results, one row per table, symbol or reason; made now because the inputs are deleted below.
        written = {}
        for name, report in reports.items():
            path = scratch_path(spark, f"report-{name}")
            report.write.parquet(path)
            written[name] = spark.read.schema(report.schema).parquet(path)
        return written
    finally:
        for folder in folders:
            delete_scratch(spark, folder)


# Landing to staging to curated --------------------------------------------


def detect_new(lake: Lake, state: WatermarkStore, job: str) -> Plan:
    """J1, J2 from the tables' states alone: no data file is opened and no Spark job runs."""
    newest = [lake.newest("landing", name) for name in TABLES]
    return decide(max(filter(None, newest), default=None), state.read(job), lambda: drift(lake))


def _synced(lake: Lake, spec: TableSpec) -> StateFolder:
    """Landing months (rows, digest) as they were when the layers below last held them whole."""
    return StateFolder(lake.spark, f"{lake.path('staging', spec.staging_name)}/_synced")


def drift(lake: Lake) -> dict[str, set[int]]:
    """Months that landing changed without a newer cursor (late rows), or whose staged or
    curated rows are gone, found by comparing digests and folders."""
    found = {}
    for name, spec in TABLES.items():
        landed = {m: [rows, digest] for m, (rows, digest, _) in lake.months("landing", name).items()}
        synced = _synced(lake, spec).latest()[1]
        months = {m for m, seen in landed.items() if synced.get(str(m)) != seen}
        for layer, stored in (("staging", spec.staging_name), ("curated", spec.curated_name)):
            months |= {p.month for p in lake.missing_parts(layer, stored)}
            months |= set(landed) - set(lake.months(layer, stored))
        found[name] = months
    return found


def _record_synced(lake: Lake, spec: TableSpec, landed: Mapping[int, tuple], months: Collection[int]) -> None:
    states = _synced(lake, spec)
    number, known = states.latest()
    fresh = {str(m): list(landed[m][:2]) for m in months if m in landed}
    if fresh:
        states.commit(number + 1, known | fresh)


def largest_month(rows: DataFrame, date_column: str) -> int:
    """Rows of the month that has most."""
    counted = rows.groupBy(year_month(date_column).alias("month")).agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(F.max("n")).first()[0] or 0


def dealt_by_month(rows: DataFrame, date_column: str, key: Sequence[str], largest: int) -> tuple[DataFrame, tuple[str, ...]]:
    """Rows of one key in one task and those of a month in a few, and the columns that tell the places.

    Grouped by these columns and the key, rows are not shuffled again, and can be written by month.
    """
    buckets = max(1, -(-largest // _BUCKET_ROWS))
    place = {"_month": year_month(date_column), "_bucket": F.pmod(F.xxhash64(*key), F.lit(buckets))}
    return rows.withColumns(place).repartition(*place), tuple(place)


def newest_by_month(versions: DataFrame, spec: TableSpec, parts: Sequence[Part]) -> DataFrame:
    """F1 for the months of some parts: the newest version per key, each month in a few tasks.

    A key never leaves its month, so the shuffle that brings versions together can bring months
    together too: a month is dealt over buckets of its keys, as many as the largest month's rows call for.
    """
    rows: Counter[int] = Counter()
    for part in parts:
        rows[part.month] += part.rows
    dealt, place = dealt_by_month(versions, spec.date_column, spec.key, max(rows.values(), default=1))
    return latest_by_key(dealt, [*place, *spec.key], VERSION_ORDER).drop(*place)


def refresh_curated(lake: Lake, spec: TableSpec, months: Collection[int], increment: Sequence[Part] | None = None) -> None:
    """Newest version per key, for the months that changed.

    The key contains the date, so a key never leaves its month and untouched
    months are already right.  The order of versions is total, so with the parts
    just staged as ``increment`` the newest of curated and increment is the newest
    of all versions, and the cost doesn't grow with the versions staged before.  Months that curated
    lacks and one keyed part brings are copied: no key has two versions there.
    """
    if not months:
        return
    here, alone = set(months), []
    if increment is None:
        parts = lake.parts("staging", spec.staging_name)
        versions = lake.staging(spec, lambda part: part.month in here).select(*spec.columns)
    else:
        parts = [*increment, *lake.parts("curated", spec.curated_name)]
        folders = Counter(part.month for part in parts)
        alone = [part for part in increment if part.keyed and folders[part.month] == 1 and part.month in here]
        single = {part.month for part in alone}
        parts = [part for part in parts if part.month not in single]
        staged = lake.read_parts("staging", spec.staging_name, spec.stored_schema, [p for p in increment if p.month not in single])
        current = lake.curated(spec, lambda part: part.month in here)
        versions = current.select(*spec.columns).unionByName(staged.select(*spec.columns))
    rows = []
    if alone:
        rows.append(lake.read_parts("staging", spec.staging_name, spec.stored_schema, alone).select(*spec.columns))
    if here - {part.month for part in alone}:
        rows.append(newest_by_month(versions, spec, [part for part in parts if part.month in here]))
    newest = union_all(rows)
    lake.overwrite_months("curated", spec.curated_name, newest, spec.date_column, spec.sort_columns, by_month=True)


def stage_increment(
    lake: Lake, spec: TableSpec, increment: DataFrame, by_month: bool = False, keyed: bool = False
) -> list[Part]:
    """Append typed rows; returns what was stored.  The increment is read once.

    Rows read from a table of months lie ``by_month`` and are not shuffled; ``keyed`` ones are one per key.
    """
    return lake.append_staging(spec, models.staging_rows(increment, spec), by_month, keyed)


def sync_increment(lake: Lake, start_after: datetime) -> dict[str, list[int]]:
    """Pull rows after the watermark, append them, rebuild what they touch.

    Landing months without a newer cursor are not opened.
    """
    touched = {}
    for name, spec in TABLES.items():
        touched[name] = []
        landed = lake.months("landing", name)
        newer = lake.landing(spec, lambda part: part.newer_than(start_after))
        parts = [p for p in lake.parts("landing", name) if p.newer_than(start_after)]
        if not parts:
            continue
        keyed = all(p.keyed for p in parts) and len({p.month for p in parts}) == len(parts)
        staged = stage_increment(lake, spec, newer_than(newer, start_after), by_month=True, keyed=keyed)
        touched[name] = sorted({p.month for p in staged})
        refresh_curated(lake, spec, touched[name], staged)
        # A month whose landing holds rows that were not pulled stays unrecorded, and is found by the next poll.
        curated = lake.months("curated", spec.curated_name)
        whole = [m for m in touched[name] if curated.get(m, ())[:2] == landed[m][:2]]
        _record_synced(lake, spec, landed, whole)
    return touched


def resync_months(lake: Lake, drifted: Mapping[str, Collection[int]]) -> dict[str, list[int]]:
    """Stage the landed rows that some months lack, then rebuild those months from staging."""
    for name, months in drifted.items():
        spec, here = TABLES[name], set(months)
        landed = lake.months("landing", name)
        for layer, stored in (("staging", spec.staging_name), ("curated", spec.curated_name)):
            lake.forget(layer, stored, lake.missing_parts(layer, stored))
        in_months = lambda part: part.month in here  # noqa: B023, E731
        rows = models.staging_rows(lake.landing(spec, in_months), spec)
        known = lake.staging(spec, in_months).select(*spec.key, *VERSION_ORDER)
        lake.append_staging(spec, rows.join(known, [*spec.key, *VERSION_ORDER], "left_anti"))
        refresh_curated(lake, spec, here)
        _record_synced(lake, spec, landed, here)
    return {name: sorted(drifted.get(name, ())) for name in TABLES}


def compact_staging(lake: Lake, spec: TableSpec, months: Collection[int]) -> None:
    """Keep only the newest version of each staged key in some months."""
    if not months:
        return
    here = set(months)
    parts = [part for part in lake.parts("staging", spec.staging_name) if part.month in here]
    versions = lake.staging(spec, lambda part: part.month in here).select(*spec.columns)
    newest = newest_by_month(versions, spec, parts)
    lake.overwrite_months("staging", spec.staging_name, newest, spec.date_column, spec.sort_columns, by_month=True)


def crowded_months(lake: Lake, spec: TableSpec, versions_per_key: float = 4, parts: int = 32) -> list[int]:
    """Months whose staged rows are over so many times their keys, or lie in over so many parts; from states."""
    keys = {m: rows for m, (rows, *_) in lake.months("curated", spec.curated_name).items()}
    folders = Counter(p.month for p in lake.parts("staging", spec.staging_name))
    stored = lake.months("staging", spec.staging_name)
    return sorted(
        m for m, (rows, *_) in stored.items() if rows > versions_per_key * keys.get(m, rows) or folders[m] > parts
    )


def landing_to_curated(lake: Lake, plan: Plan) -> dict[str, int]:
    """P2 with its gate (K19), then compaction of the months that need it."""
    if plan.drifted:
        resync_months(lake, plan.drifted)
    else:
        sync_increment(lake, plan.start_after)
    counts = {
        "landing_rows": lake.row_count("landing", DAILY_PRICE.name),
        "curated_rows": lake.row_count("curated", DAILY_PRICE.curated_name),
    }
    q.gate_rows(counts, "landing_rows", "curated_rows", "landing has rows but curated is empty")
    for spec in TABLES.values():
        compact_staging(lake, spec, crowded_months(lake, spec))
    return counts


# Relational models --------------------------------------------------------


def staging_views(lake: Lake, keep: Callable[[Part], bool] | None = None) -> dict[str, DataFrame]:
    """B14 on stored landing, whole or the parts that ``keep`` picks."""
    return {name: models.staging_view(lake.landing(spec, keep), spec) for name, spec in TABLES.items()}


def register_views(lake: Lake) -> dict[str, DataFrame]:
    """The five staging views under their names."""
    views = staging_views(lake)
    for name, view in views.items():
        Lake.create_view(view, TABLES[name].staging_name)
    return views


def refresh_dimension(
    lake: Lake, views: Mapping[str, DataFrame], built_at: datetime, note: dict | None = None, merge: bool = False
) -> DataFrame:
    """The dimension from its state; keys gone from the sources stay.

    With ``merge``, ``views`` hold only rows since the state's newest cursor, which are merged
    with the stored state; else they are all rows, and the state is made anew (the repair path).
    """
    state = models.profile_state(views)
    if merge:
        state = models.merged_profile_state(lake.published(_PROFILE_STATE, models.PROFILE_STATE_SCHEMA), state)
    lake.publish(_PROFILE_STATE, state, ("symbol",), note)
    fresh = models.dimension_of(lake.published(_PROFILE_STATE, models.PROFILE_STATE_SCHEMA), built_at)
    current = lake.published(DIMENSION_NAME, DIMENSION_SCHEMA)
    lake.publish(DIMENSION_NAME, replace_by_key(current, fresh, ["symbol"]), ("symbol",))
    return lake.published(DIMENSION_NAME, DIMENSION_SCHEMA)


def dimension_increment(lake: Lake, built_at: datetime, again: bool = False) -> DataFrame:
    """Refresh the dimension from the landing parts that are not older than its state and were written since."""
    newest = max(filter(None, (lake.newest("landing", name) for name in TABLES)), default=None)
    note = {"newest": newest and newest.isoformat(), "landing": {name: lake.versions("landing", name) for name in TABLES}}
    known = lake.note(_PROFILE_STATE)
    if again or not known.get("newest"):
        return refresh_dimension(lake, staging_views(lake), built_at, note)
    since, views = parse_instant(known["newest"]), {}
    for name, spec in TABLES.items():
        written = _changed(lake, "landing", name, known["landing"].get(name, {}))
        rows = lake.landing(spec, lambda p, months=written: p.month in months and p.newest is not None and p.newest >= since)
        views[name] = models.staging_view(rows.where(F.col("ingested_at") >= F.lit(since)), spec)
    return refresh_dimension(lake, views, built_at, note, merge=True)


def refresh_fact(lake: Lake, name: str, again: Collection[int] = ()) -> set[int]:
    """J5, C8 on stored facts: rows not older than the fact's own newest cursor, which its state holds, replace
    their keys; months in ``again`` are taken whole.  Only those months of landing and fact are opened, and
    of them only what was written since the fact last took it."""
    fact = FACTS[name]
    spec, since, built = fact.source, lake.newest("facts", name), lake.built("facts", name)
    number, taken = built.latest()
    versions = lake.versions("landing", spec.name)
    written = _changed(lake, "landing", spec.name, taken)
    parts = [
        p for p in lake.parts("landing", spec.name)
        if since is None or p.month in again or (p.month in written and p.newest is not None and p.newest >= since)
    ]
    months = {p.month for p in parts}
    if not months:
        return months
    rows = lake.read_parts("landing", spec.name, spec.stored_schema, parts)
    if since is not None:
        rows = rows.where((F.col("ingested_at") >= F.lit(since)) | F.col(PARTITION_COLUMN).isin(list(again)))
    fresh = models.fact_rows(models.staging_view(rows, spec), fact)
    filled = {p.month for p in lake.parts("facts", name)} & months
    if filled:
        fresh_in = lambda known: models.fact_rows(
            models.staging_view(rows.where(F.col(PARTITION_COLUMN).isin(list(known))), spec), fact
        )
        current = lake.fact(name, models.fact_stored_schema(fact), lambda part: part.month in filled)
        merged = replace_by_key(current.drop(PARTITION_COLUMN), fresh_in(filled), [fact.surrogate])
        laid = laid_by_month(merged, spec.date_column).drop(PARTITION_COLUMN)
        fresh = laid.unionByName(fresh_in(months - filled)) if months - filled else laid
    # Where nothing is replaced the rows stay in the months they are read from.
    lake.overwrite_months("facts", name, fresh, spec.date_column, spec.sort_columns, by_month=True)
    built.commit(number + 1, versions)
    return months


def read_fact(lake: Lake, name: str, months: Collection[int] | None = None) -> DataFrame:
    keep = None if months is None else lambda part: part.month in months
    return lake.fact(name, models.fact_stored_schema(FACTS[name]), keep).drop(PARTITION_COLUMN)


def _changed(lake: Lake, layer: str, source: str, built: Mapping[str, list[int]]) -> set[int]:
    """Months of a table that were written since ``built`` was recorded, months gone included."""
    now = lake.versions(layer, source)
    return {int(m) for m in now.keys() | built.keys() if now.get(m) != built.get(m)}


def refresh_summary(lake: Lake) -> DataFrame:
    """E2 for the months whose prices were written since the last run; the others stay."""
    built = lake.built("marts", MONTHLY_SUMMARY_NAME)
    number, of = built.latest()
    versions = lake.versions("facts", _PRICE_FACT)
    months = _changed(lake, "facts", _PRICE_FACT, of)
    if months:
        rows = models.monthly_summary(read_fact(lake, _PRICE_FACT, months))
        lake.overwrite_months("marts", MONTHLY_SUMMARY_NAME, rows, "month_date", ("symbol", "month_date"), months)
        built.commit(number + 1, versions)
    return lake.monthly(MONTHLY_SUMMARY_NAME, MONTHLY_SUMMARY_SCHEMA)


def check_models(lake: Lake, as_of: datetime) -> list[dict]:
    """All checks of dimension, facts and summary over the months written since they last passed.

    A month that passed and was not written since has no violations still: keys hold the date,
    so none repeats in another month, and symbols never leave the dimension.
    """
    tables = [("facts", name) for name in FACTS] + [("marts", MONTHLY_SUMMARY_NAME)]
    passed = {name: lake.built("checks", name) for _, name in tables}
    now = {name: lake.versions(layer, name) for layer, name in tables}
    months = {name: _changed(lake, layer, name, passed[name].latest()[1]) for layer, name in tables}
    dimension = lake.published(DIMENSION_NAME, DIMENSION_SCHEMA)
    facts = {name: read_fact(lake, name, months[name]) for name in FACTS}
    checked = months[MONTHLY_SUMMARY_NAME]
    summary = lake.monthly(MONTHLY_SUMMARY_NAME, MONTHLY_SUMMARY_SCHEMA, lambda part: part.month in checked)
    suite = model_checks(dimension, facts, summary, as_of, lake.newest("facts", _PRICE_FACT))
    results = q.require_clean(q.run_suite(suite))
    for name, states in passed.items():
        if months[name]:
            states.commit(states.latest()[0] + 1, now[name])
    return results


def check_staging(lake: Lake) -> list[dict]:
    """A13, K1, K3 before the models: the contract of landing, then the staging checks of the months written since they passed."""
    require_contract({name: lake.landing(spec) for name, spec in TABLES.items()}, {n: s.schema for n, s in TABLES.items()})
    passed = {name: lake.built("checks", spec.staging_name) for name, spec in TABLES.items()}
    now = {name: lake.versions("landing", name) for name in TABLES}
    months = {name: _changed(lake, "landing", name, passed[name].latest()[1]) for name in TABLES}
    views = {
        name: models.staging_view(lake.landing(spec, lambda part, name=name: part.month in months[name]), spec)
        for name, spec in TABLES.items()
    }
    results = q.require_clean(q.run_suite(staging_checks(views)))
    for name, states in passed.items():
        if months[name]:
            states.commit(states.latest()[0] + 1, now[name])
    return results


def build_models(
    lake: Lake, built_at: datetime, as_of: datetime | None = None, again: Mapping[str, Collection[int]] | None = None
) -> list[dict]:
    """Views, staging checks, dimension, facts, monthly summary, then all their checks.

    ``again`` names landing months whose rows may be older than what the models hold.
    """
    again = again or {}
    register_views(lake)
    results = check_staging(lake)
    dimension_increment(lake, built_at, bool(again))
    for name, fact in FACTS.items():
        refresh_fact(lake, name, again.get(fact.source.name, ()))
    refresh_summary(lake)
    return results + check_models(lake, as_of or built_at)


# Monthly mart -------------------------------------------------------------


def refresh_mart(lake: Lake, loaded_at: datetime, window: Window = Window()) -> set[int]:
    """E1, E3 for the months of the window whose prices were written since the last run, and new
    names in the other months of symbols whose name changed; returns those months.

    Another window than the last run's builds all months.
    """
    built = lake.built("marts", MONTHLY_MART_NAME)
    number, last = built.latest()
    bounds = [window.start, window.end]
    first, end = (int(b[:4]) * 100 + int(b[5:7]) for b in bounds)
    price, profile = DAILY_PRICE.curated_name, BASIC_INFO.curated_name
    versions = {m: w for m, w in lake.versions("curated", price).items() if first <= int(m) <= end}
    known = last.get("prices", {}) if last.get("window") == bounds else {}
    months = {int(m) for m in versions.keys() | known.keys() if versions.get(m) != known.get(m)}
    if last.get("window") != bounds:
        months |= {p.month for p in lake.parts("marts", MONTHLY_MART_NAME)}
    profiles = lake.versions("curated", profile)
    renamed, names = set(), lake.published(_MART_NAMES, _NAMES_SCHEMA)
    if profiles != last.get("profiles"):
        lake.publish(_MART_NAMES, models.newest_names(lake.curated(BASIC_INFO)), ("symbol",))
        before, names = names, lake.published(_MART_NAMES, _NAMES_SCHEMA)
        same = F.col("new.symbol").eqNullSafe(F.col("old.symbol")) & F.col("new.company_name").eqNullSafe(F.col("old.company_name"))
        changed = names.alias("new").join(before.alias("old"), same, "left_anti")
        other = lake.monthly(MONTHLY_MART_NAME, MONTHLY_MART_SCHEMA, lambda part: part.month not in months)
        renamed = set(months_of(other.join(changed, "symbol", "left_semi"), "month_start_date"))
    rows = []
    if months:
        prices = lake.curated(DAILY_PRICE, lambda part: part.month in months)
        rows.append(models.named_months(prices, names, loaded_at, *bounds))
    if renamed:
        mart = lake.monthly(MONTHLY_MART_NAME, MONTHLY_MART_SCHEMA, lambda part: part.month in renamed)
        rows.append(models.renamed_months(mart, changed, loaded_at))
    if rows:
        whole = union_all(rows)
        lake.overwrite_months(
            "marts", MONTHLY_MART_NAME, whole, "month_start_date", ("symbol", "year", "month"), months | renamed
        )
    built.commit(number + 1, {"window": bounds, "prices": versions, "profiles": profiles})
    return months | renamed


def build_mart(lake: Lake, loaded_at: datetime, window: Window = Window()) -> list[dict]:
    """Mart, its checks and its gate.

    Checks run over the months that changed since they last passed, against the whole mart where
    they look for symbols; years are looked for in all months.
    """
    passed = lake.built("checks", MONTHLY_MART_NAME)
    refresh_mart(lake, loaded_at, window)
    number, last = passed.latest()
    bounds = [window.start, window.end]
    known = last.get("mart", {}) if last.get("window") == bounds else {}
    versions = lake.versions("marts", MONTHLY_MART_NAME)
    months = _changed(lake, "marts", MONTHLY_MART_NAME, known) | _changed(
        lake, "curated", DAILY_PRICE.curated_name, last.get("prices", {}) if last.get("window") == bounds else {}
    )
    here = lambda part: part.month in months
    prices = lake.curated(DAILY_PRICE, here)
    mart, whole = (lake.monthly(MONTHLY_MART_NAME, MONTHLY_MART_SCHEMA, keep) for keep in (here, None))
    results = q.require_clean(
        q.run_suite(mart_checks(prices, mart, *bounds, window.years, whole, lake.curated(DAILY_PRICE)))
    )
    q.gate_curated_to_mart(lake.curated(DAILY_PRICE), whole, "price_date", *bounds)
    if months:
        passed.commit(number + 1, {"window": bounds, "mart": versions, "prices": lake.versions("curated", DAILY_PRICE.curated_name)})
    return results


# Whole refreshes ------------------------------------------------------


def refresh_from_landing(
    lake: Lake, state: WatermarkStore, job: str, run_at: datetime, window: Window = Window()
) -> Decision:
    """Everything below landing; the watermark moves only when all passed."""
    plan = detect_new(lake, state, job)
    if plan.decision in (Decision.EMPTY, Decision.SKIP):
        return plan.decision
    size_shuffles(lake.spark, lake.stored_bytes("landing"))
    build_models(lake, run_at, again=plan.drifted)
    landing_to_curated(lake, plan)
    build_mart(lake, run_at, window)
    state.commit(job, plan.latest)
    return plan.decision


def full_refresh(
    lake: Lake, state: WatermarkStore, job: str, envelope_path: str, batch: Batch, window: Window = Window()
) -> Decision:
    """P5: ingest a batch of files, then P6."""
    ingest_batch(lake, read_envelopes(lake.spark, envelope_path), batch)
    return refresh_from_landing(lake, state, job, batch.ingested_at, window)


# Dimension history --------------------------------------------------------


def read_history(lake: Lake) -> DataFrame:
    """Open rows of the current generation and all closed rows up to it."""
    schema = history_schema(DIMENSION_SCHEMA)
    generation = lake.current_generation(HISTORY_NAME)
    if generation is None:
        return lake.spark.createDataFrame([], schema)
    return _open_versions(lake, generation).unionByName(_closed_versions(lake, generation))


def _open_versions(lake: Lake, generation: int) -> DataFrame:
    return lake.spark.read.schema(history_schema(DIMENSION_SCHEMA)).parquet(
        lake.generation_path(HISTORY_NAME, generation, "open")
    )


def _closed_versions(lake: Lake, generation: int) -> DataFrame:
    """Closed rows of all committed runs; a run that failed half-way is ahead of
    the current generation and is overwritten by the next one."""
    schema = T.StructType([*history_schema(DIMENSION_SCHEMA).fields, T.StructField(GENERATION, T.LongType())])
    every = lake.spark.read.schema(schema).parquet(f"{lake.path('published', HISTORY_NAME)}/closed")
    return every.where(F.col(GENERATION) <= generation).drop(GENERATION)


def snapshot_dimension(lake: Lake, run_at: datetime) -> int:
    """One snapshot run.

    Closed versions never change, so each run writes only the versions it
    closed plus the open ones, and old closed files are left alone.
    """
    schema = history_schema(DIMENSION_SCHEMA)
    last = lake.current_generation(HISTORY_NAME)
    if last is None:
        open_rows = lake.spark.createDataFrame([], schema)
    else:
        open_rows = _open_versions(lake, last)
    source = lake.published(DIMENSION_NAME, DIMENSION_SCHEMA)
    changes = snapshot_changes(open_rows, source, "symbol", "ingested_at", run_at)
    changes = changes.select(*DIMENSION_SCHEMA.fieldNames(), *HISTORY_COLUMNS).persist(StorageLevel.MEMORY_AND_DISK)
    generation = (last or 0) + 1
    for part, rows in (("closed", changes.where(F.col(VALID_TO).isNotNull())), ("open", changes.where(F.col(VALID_TO).isNull()))):
        rows.hint("rebalance").write.mode("overwrite").parquet(lake.generation_path(HISTORY_NAME, generation, part))
    lake.commit_generation(HISTORY_NAME, generation, run_at)
    changes.unpersist()
    return generation


# Two sources into one batch -----------------------------------------------


def as_envelopes(records: DataFrame, loaded_at: datetime | None = None) -> DataFrame:
    """Records of any source as whole envelopes: normalised symbols, every
    envelope column, arrival.  ``loaded_at`` fills a missing load instant; the
    position inside a document stays in the arrival order."""
    types = {f.name: f.dataType for f in ENVELOPE_SCHEMA}
    absent = {n: F.lit(None).cast(t) for n, t in types.items() if n not in records.columns}
    whole = records.withColumns({**absent, "symbol": normalise_symbol("symbol")})
    if loaded_at is not None:
        whole = whole.withColumn("load_timestamp", F.coalesce("load_timestamp", F.lit(loaded_at)))
    return (whole if "arrival" in whole.columns else with_arrival(whole)).drop("_position")


def merge_batches(
    primary: DataFrame, fallback: DataFrame, enabled: bool = True, loaded_at: datetime | None = None
) -> DataFrame:
    """Per dataset and symbol the first source, or the second where the
    first has no answer.  Prices come from the first source only.

    Both sides may be records of this library's mappers; the result can be written
    and ingested.  Symbols are normalised before they are compared.
    """
    primary, fallback = as_envelopes(primary, loaded_at), as_envelopes(fallback, loaded_at)
    prices = F.col("dataset") == "daily_prices"
    merged = merge_sources(
        primary.where(~prices),
        fallback.where(~prices),
        ["dataset", "symbol"],
        hollow_primary(),
        "arrival",
        enabled,
    )
    return merged.unionByName(primary.where(prices))
