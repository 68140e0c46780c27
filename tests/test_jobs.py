"""Jobs on small lakes: refusal, replay, resync, pruning, history, contracts."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone
from decimal import Decimal
from pathlib import Path
from uuid import uuid4

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F, types as T
from pyspark.sql.readwriter import DataFrameWriter

from tidemark.operators import quality as q
from tidemark.operators.filters import ConstraintViolation
from tidemark.operators.incremental import Decision
from tidemark.operators.merging import replace_by_key
from tidemark.plans import jobs, models
from tidemark.plans.landing import Batch
from tidemark.registry import BASIC_INFO, DAILY_PRICE, FACTS, MONTHLY_MART_NAME, MONTHLY_MART_SCHEMA, TABLES
from tidemark.session import shared_directory
from tidemark.sources.contracts import ContractViolation, contract_report, require_contract
from tidemark.sources.lake import Lake, in_window
from tidemark.sources.states import StateFolder
from tidemark.sources.watermark import WatermarkStore
from tests.test_mapping import envelopes

AT = datetime(2024, 3, 1, tzinfo=timezone.utc)
WINDOW = jobs.Window(years=(2024, 2025))


def price(value, **changes):
    return {"open": value, "high": value, "low": value, "close": value, "volume": 10, **changes}


def batch(number, at=AT):
    return Batch(f"b{number}", at.date(), at, "test")


def days():
    return [("daily_prices", "A", date(y, m, 15), price(m)) for y in (2024, 2025) for m in (1, 2)]


def profile(name="Bank A"):
    return ("basics", "a", None, {"company_name": name})


def state_of(lake):
    return WatermarkStore(lake.spark, f"{lake.root}/state")


def content(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def test_violation_refuses_the_whole_batch(spark, lake):
    bad = envelopes(spark, *days(), ("daily_prices", "A", date(2024, 3, 1), price(5, high=4)), profile())
    with pytest.raises(ConstraintViolation, match="ohlc_consistent"):
        jobs.ingest_batch(lake, bad, batch(1))
    assert all(lake.landing(spec).count() == 0 for spec in TABLES.values())


def scratch_folders(spark):
    return {p.name for p in Path(shared_directory(spark).removeprefix("file:"), "tidemark").glob("*") if p.name.startswith(("batch-", "candidates-"))}


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ingest_reads_mapped_rows_from_a_stored_copy(spark, lake, monkeypatch):
    """No executor's heap holds the rows of a batch, however large; the copies are deleted, after a refusal too."""
    before, plans = scratch_folders(spark), []
    for name, rows_at in (("require_constraints", 0), ("upsert_landing", 2)):
        step = getattr(jobs, name)
        monkeypatch.setattr(jobs, name, lambda *args, step=step, at=rows_at: (plans.append(plan_text(args[at])), step(*args)))
    jobs.ingest_batch(lake, envelopes(spark, *days(), profile()), batch(1))
    assert len(plans) == 4 and all("FileScan parquet" in p and "InMemoryTableScan" not in p for p in plans)
    assert lake.landing(DAILY_PRICE).count() == 4
    with pytest.raises(ConstraintViolation):
        jobs.ingest_batch(lake, envelopes(spark, ("daily_prices", "A", date(2024, 3, 1), price(5, high=4))), batch(2))
    with pytest.raises(Exception, match="does not fit"):
        jobs.ingest_batch(lake, envelopes(spark, ("daily_prices", "A", date(2024, 3, 1), price(10**15))), batch(3))
    assert scratch_folders(spark) == before and lake.landing(DAILY_PRICE).count() == 4


def test_reports_read_stored_rows(spark, lake, monkeypatch):
    """Rows per table, skips and datasets of a batch are counted on its stored copies, not on a cache of it."""
    plans, metrics, skipped = [], jobs.batch_metrics, jobs.skipped_rows
    watch = lambda candidates: plans.extend(map(plan_text, candidates.values()))
    monkeypatch.setattr(jobs, "batch_metrics", lambda candidates: (watch(candidates), metrics(candidates))[1])
    monkeypatch.setattr(jobs, "skipped_rows", lambda stored, candidates: (watch(candidates), skipped(stored, candidates))[1])
    odd = [("daily_prices", " ", date(2024, 1, 1), price(1)), ("daily_prices", "B", None, price(1)), ("NONE", "B", None, {})]
    reports = jobs.ingest_batch(lake, envelopes(spark, *days(), *odd, profile()), batch(1))
    assert len(plans) == 4 and all("FileScan parquet" in p and "InMemoryTableScan" not in p for p in plans)
    assert {(r["table_name"], r["symbol"], r["row_count"]) for r in reports["rows"].collect()} == {
        (DAILY_PRICE.name, "A", 4),
        (BASIC_INFO.name, "A", 1),
    }
    assert {(r["table_name"], r["skip_reason"], r["skipped"]) for r in reports["skipped"].collect()} == {
        (DAILY_PRICE.name, "missing_symbol", 1),
        (DAILY_PRICE.name, "missing_date", 1),
        (None, "unknown_dataset", 1),
    }
    assert {tuple(r) for r in reports["datasets"].collect()} == {("daily_prices", 6), ("basics", 1), ("NONE", 1)}


def test_refresh_replay_and_resync(spark, lake):
    state = state_of(lake)
    assert jobs.refresh_from_landing(lake, state, "main", AT, WINDOW) is Decision.EMPTY
    jobs.ingest_batch(lake, envelopes(spark, *days(), profile()), batch(1))
    assert jobs.refresh_from_landing(lake, state, "main", AT, WINDOW) is Decision.NEW
    assert state.read("main") == AT
    mart = lake.monthly(MONTHLY_MART_NAME, MONTHLY_MART_SCHEMA).drop("loaded_at")
    before, curated = content(mart), content(lake.curated(DAILY_PRICE).drop("ingested_at", "batch_id"))
    assert len(before) == 4 and before[0][1] == "Bank A"
    assert jobs.refresh_from_landing(lake, state, "main", AT, WINDOW) is Decision.SKIP

    # The same records in a later batch: staging grows, curated and mart keep their content.
    later = AT + timedelta(hours=1)
    jobs.ingest_batch(lake, envelopes(spark, *days(), profile()), batch(2, later))
    assert lake.landing(DAILY_PRICE).count() == 4
    assert jobs.refresh_from_landing(lake, state, "main", later, WINDOW) is Decision.NEW
    assert lake.staging(DAILY_PRICE).count() == 8
    assert content(lake.curated(DAILY_PRICE).drop("ingested_at", "batch_id")) == curated
    assert content(lake.monthly(MONTHLY_MART_NAME, MONTHLY_MART_SCHEMA).drop("loaded_at")) == before
    assert {r["batch_id"] for r in lake.curated(DAILY_PRICE).collect()} == {"b2"}

    # Staging lost while the watermark is current: everything is loaded again.
    lost = Lake(spark, f"{lake.root}-lost")
    jobs.ingest_batch(lost, envelopes(spark, *days(), profile()), batch(2, later))
    assert jobs.refresh_from_landing(lost, state, "main", later, WINDOW) is Decision.RESYNC
    assert content(lost.curated(DAILY_PRICE).drop("ingested_at", "batch_id")) == curated


def test_failed_check_keeps_the_watermark(spark, lake):
    state = state_of(lake)
    jobs.ingest_batch(lake, envelopes(spark, *days(), profile(), ("holders", "A", date(2024, 1, 1), {"holder": "h"})), batch(1))
    with pytest.raises(q.QualityFailure, match="holder_type_accepted"):
        jobs.refresh_from_landing(lake, state, "main", AT, WINDOW)
    assert state.read("main").year == 1970


def test_upsert_rewrites_only_touched_months(spark, lake):
    jobs.ingest_batch(lake, envelopes(spark, *days()), batch(1))
    files = {r[0] for r in lake.landing(DAILY_PRICE).select(F.input_file_name()).distinct().collect()}
    jobs.ingest_batch(lake, envelopes(spark, ("daily_prices", "A", date(2024, 2, 15), price(99))), batch(2))
    after = {r[0] for r in lake.landing(DAILY_PRICE).select(F.input_file_name()).distinct().collect()}
    assert len(files & after) == 3
    stored = {r["price_date"]: r["close_price"] for r in lake.landing(DAILY_PRICE).collect()}
    assert stored[date(2024, 2, 15)] == Decimal(99) and len(stored) == 4


def test_window_prunes_months(spark, lake):
    jobs.ingest_batch(lake, envelopes(spark, *days()), batch(1))
    plan = in_window(lake.landing(DAILY_PRICE), "price_date", "2025-01-01", "2025-01-31")
    text = plan._jdf.queryExecution().executedPlan().toString()
    partition_filters = text.split("PartitionFilters: [")[1].split("]")[0]
    assert "yyyymm" in partition_filters and "202501" in partition_filters
    assert plan.count() == 1


def test_dimension_keeps_keys_gone_from_the_sources(spark, lake):
    jobs.ingest_batch(lake, envelopes(spark, profile(), *days()), batch(1))
    views = jobs.staging_views(lake)
    jobs.refresh_dimension(lake, views, AT)
    gone = {n: v.where(F.col("symbol") != "A") for n, v in views.items()}
    assert [r["symbol"] for r in jobs.refresh_dimension(lake, gone, AT).collect()] == ["A"]


def test_null_in_a_required_column_stops_staging(spark):
    row = ("A", date(2024, 1, 1), None, AT, "s", "b")
    df = spark.createDataFrame([row], "symbol string, price_date date, volume long, ingested_at timestamp, source_system string, batch_id string")
    for name in ("open_price", "high_price", "low_price", "close_price", "adjusted_close"):
        df = df.withColumn(name, F.lit(1))
    with pytest.raises(Exception, match="required column is null: volume"):
        models.staging_rows(df, DAILY_PRICE).collect()


def test_interrupted_publish_leaves_the_old_generation(spark, lake):
    lake.publish("t", spark.createDataFrame([(1,)], "a int"))
    half_written = lake.generation_path("t", 2)
    spark.createDataFrame([(2,)], "a int").write.parquet(half_written)
    schema = spark.createDataFrame([], "a int").schema
    assert [r[0] for r in lake.published("t", schema).collect()] == [1]
    assert lake.publish("t", spark.createDataFrame([(3,)], "a int")) == 2
    assert [r[0] for r in lake.published("t", schema).collect()] == [3]


def test_contracts(spark, lake):
    spec = DAILY_PRICE
    good = spark.createDataFrame([], spec.schema)
    expected = {spec.name: spec.schema}
    require_contract({spec.name: good}, expected)
    with pytest.raises(ContractViolation, match="table is missing"):
        require_contract({}, expected)
    changed = good.drop("volume").withColumn("open_price", F.col("open_price").cast("double"))
    problems = {(r["column_name"], r["problem"].split(",")[0]) for r in contract_report(spark, {spec.name: changed}, expected).collect()}
    assert problems == {("volume", "column is missing"), ("open_price", "is double")}


def test_registry_descriptions():
    assert len(TABLES) == 5
    for spec in TABLES.values():
        assert all(f.metadata.get("comment") for f in spec.schema.fields)
        assert set(spec.key) | {spec.date_column} <= set(spec.required)


_PRICE_FACT = next(n for n, f in FACTS.items() if f.source is DAILY_PRICE)
_STORED = {"curated": DAILY_PRICE.curated_name, "facts": _PRICE_FACT, "landing": DAILY_PRICE.name, "staging": DAILY_PRICE.staging_name}
_MONTHS = [(date(y, m, 15), m) for y in (2024, 2025) for m in (1, 2)]


def land(lake, rows, at=AT, name="b1"):
    """Prices of one symbol straight into landing, as an ingest of them would leave it."""
    values = [("A", d, *[Decimal(v)] * 4, None, 10, at, "test", name) for d, v in rows]
    fresh = lake.spark.createDataFrame(values, DAILY_PRICE.schema)
    months = {d.year * 100 + d.month for d, _ in rows}
    current = lake.landing(DAILY_PRICE, lambda part: part.month in months).select(*DAILY_PRICE.columns)
    merged = replace_by_key(current, fresh, DAILY_PRICE.key)
    lake.overwrite_months("landing", DAILY_PRICE.name, merged, "price_date", DAILY_PRICE.sort_columns)


def sync(lake, state):
    """The part of a refresh that moves prices: fact, staging and curated, then the watermark."""
    plan = jobs.detect_new(lake, state, "main")
    if plan.decision in (Decision.NEW, Decision.RESYNC):
        jobs.refresh_fact(lake, _PRICE_FACT, plan.drifted.get(DAILY_PRICE.name, ()))
        jobs.landing_to_curated(lake, plan)
        state.commit("main", plan.latest)
    return plan.decision


def days_of(df):
    return sorted(r["price_date"] for r in df.collect())


@pytest.mark.parametrize(
    "layer, lost",
    [
        ("landing", "while writing"), ("landing", "after the commit"), ("curated", "before the commit"),
        ("curated", "while writing"), ("facts", "after the commit"), ("facts", "before the commit"),
        ("staging", "before the commit"), ("staging", "after the commit"),
    ],
)
def test_driver_lost_in_a_write_loses_no_rows(spark, lake, monkeypatch, layer, lost):
    """Readers find the old months until the commit; the next run has all keys, old and new."""
    state = state_of(lake)
    land(lake, _MONTHS)
    sync(lake, state)
    later = AT + timedelta(hours=1)
    added = [(date(2024, 2, 16), 7)]
    root = lake.path(layer, _STORED[layer])
    write, commit = DataFrameWriter.parquet, StateFolder.commit

    def broken_write(self, to, *args, **options):
        write(self, to, *args, **options)
        if to.startswith(f"{root}/write="):
            files, place = lake._files(f"{to}/yyyymm=202402")
            assert files.delete(place, True)
            raise ConnectionError("driver lost")

    def broken_commit(self, number, content):
        if self.path == f"{root}/_states":
            if lost == "after the commit":
                commit(self, number, content)
            raise ConnectionError("driver lost")
        commit(self, number, content)

    with monkeypatch.context() as patch:
        if lost == "while writing":
            patch.setattr(DataFrameWriter, "parquet", broken_write)
        else:
            patch.setattr(StateFolder, "commit", broken_commit)
        with pytest.raises(ConnectionError):
            land(lake, added, later, "b2")
            sync(lake, state)
    lake = Lake(spark, lake.root)
    old = [d for d, _ in _MONTHS]
    assert set(old) <= set(days_of(lake.curated(DAILY_PRICE))) and set(old) <= set(days_of(lake.landing(DAILY_PRICE)))
    land(lake, added, later, "b2")
    assert sync(lake, state) is Decision.NEW
    want = sorted([*old, date(2024, 2, 16)])
    assert days_of(lake.landing(DAILY_PRICE)) == days_of(lake.curated(DAILY_PRICE)) == want
    assert days_of(jobs.read_fact(lake, _PRICE_FACT)) == want and state.read("main") == later


def test_a_reader_keeps_its_months_through_a_write(spark, lake):
    land(lake, _MONTHS)
    before = lake.landing(DAILY_PRICE)
    land(lake, [(date(2024, 2, 15), 99)], name="b2")
    assert {r["close_price"] for r in before.collect()} == {1, 2} and before.count() == 4
    land(lake, [(date(2024, 2, 15), 98)], name="b3")
    assert lake.landing(DAILY_PRICE).count() == 4
    assert {p.month for p in lake.parts("landing", DAILY_PRICE.name) if p.write == 1} == {202401, 202501, 202502}
    files, place = lake._files(f"{lake.path('landing', DAILY_PRICE.name)}/write=1/yyyymm=202402")
    assert not files.exists(place)


def test_months_are_written_once(spark, lake, monkeypatch):
    """The window's shuffle by key and one by month: no copy is written first."""
    plans, writer = [], Lake._month_writer
    monkeypatch.setattr(Lake, "_month_writer", lambda self, df, columns: plans.append(df) or writer(self, df, columns))
    land(lake, _MONTHS)
    jobs.sync_increment(lake, datetime(1970, 1, 1, tzinfo=timezone.utc))
    assert len(plans) == 3  # landing, staging, curated
    text = plans[-1].hint("rebalance", "yyyymm")._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 2 and "InMemoryTableScan" not in text


def jobs_run(spark, action):
    """Number of Spark jobs that ``action`` starts, and its result."""
    group = f"count-{uuid4().hex}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        result = action()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)), result


def test_a_poll_without_news_reads_no_data_file(spark, lake):
    state = state_of(lake)
    land(lake, _MONTHS)
    sync(lake, state)
    assert jobs_run(spark, lambda: jobs.detect_new(lake, state, "main").decision) == (0, Decision.SKIP)
    assert jobs_run(spark, lambda: lake.newest("facts", _PRICE_FACT)) == (0, AT)
    assert jobs_run(spark, lambda: lake.row_count("staging", DAILY_PRICE.staging_name)) == (0, 4)
    assert jobs_run(spark, lambda: lake.landing(DAILY_PRICE).count())[0] > 0


def test_only_months_with_news_are_opened(spark, lake, monkeypatch):
    state = state_of(lake)
    land(lake, _MONTHS)
    sync(lake, state)
    jobs.dimension_increment(lake, AT)
    jobs.refresh_summary(lake)
    jobs.refresh_mart(lake, AT, WINDOW)
    later = AT + timedelta(hours=1)
    land(lake, [(date(2025, 2, 15), 9)], later, "b2")
    opened, read = [], Lake.read_parts

    def watched(self, layer, name, schema, parts):
        opened.extend((layer, name, p.month) for p in parts)
        return read(self, layer, name, schema, parts)

    monkeypatch.setattr(Lake, "read_parts", watched)
    jobs.detect_new(lake, state, "main")
    assert opened == []
    jobs.dimension_increment(lake, later)
    sync(lake, state)
    jobs.refresh_summary(lake)
    jobs.refresh_mart(lake, later, WINDOW)
    inputs = [o for o in opened if o[0] != "marts"]  # the refreshed summary is handed back whole, not read
    assert {layer for layer, *_ in inputs} == {"landing", "staging", "curated", "facts"}
    assert {month for *_, month in inputs} == {202502}
    closing = {r["month"]: r["avg_close_price"] for r in lake.monthly(MONTHLY_MART_NAME, MONTHLY_MART_SCHEMA).where("year = 2025").collect()}
    assert closing == {1: 1.0, 2: 9.0}


def test_drift_reloads_only_the_months_that_differ(spark, lake):
    """A staged month is deleted and a row arrives with an old instant: both are found by digest and folder, and mended."""
    state = state_of(lake)
    land(lake, _MONTHS)
    sync(lake, state)
    land(lake, [(date(2024, 1, 20), 3)], AT - timedelta(hours=5), "late")
    (part,) = [p for p in lake.parts("staging", DAILY_PRICE.staging_name) if p.month == 202502]
    files, place = lake._files(lake._folder("staging", DAILY_PRICE.staging_name, part))
    assert files.delete(place, True)
    plan = jobs.detect_new(lake, state, "main")
    assert plan.decision is Decision.RESYNC and plan.drifted == {DAILY_PRICE.name: {202401, 202502}}
    before = {p.month: p.write for p in lake.parts("curated", DAILY_PRICE.curated_name)}
    assert sync(lake, state) is Decision.RESYNC
    after = {p.month: p.write for p in lake.parts("curated", DAILY_PRICE.curated_name)}
    assert {m for m in after if after[m] != before.get(m)} == {202401, 202502}
    want = sorted([d for d, _ in _MONTHS] + [date(2024, 1, 20)])
    assert days_of(lake.staging(DAILY_PRICE)) == days_of(lake.curated(DAILY_PRICE)) == want
    assert days_of(jobs.read_fact(lake, _PRICE_FACT)) == want
    assert sync(lake, state) is Decision.SKIP


def test_a_late_overwrite_settles(spark, lake):
    """An old instant over a known key: staging gets the version, curated keeps the newest, the next poll is quiet."""
    state = state_of(lake)
    land(lake, _MONTHS)
    sync(lake, state)
    land(lake, [(date(2024, 1, 15), 50)], AT - timedelta(days=1), "late")
    assert sync(lake, state) is Decision.RESYNC
    assert lake.staging(DAILY_PRICE).count() == 5 and lake.curated(DAILY_PRICE).where("close_price = 50").count() == 0
    assert sync(lake, state) is Decision.SKIP


def test_a_late_row_beside_new_ones_is_found_by_the_next_poll(spark, lake):
    state = state_of(lake)
    land(lake, _MONTHS)
    sync(lake, state)
    land(lake, [(date(2024, 1, 20), 3)], AT - timedelta(hours=5), "late")
    land(lake, [(date(2024, 1, 21), 4)], AT + timedelta(hours=1), "b2")
    assert sync(lake, state) is Decision.NEW
    assert date(2024, 1, 20) not in days_of(lake.curated(DAILY_PRICE))
    assert sync(lake, state) is Decision.RESYNC and date(2024, 1, 20) in days_of(lake.curated(DAILY_PRICE))
    assert sync(lake, state) is Decision.SKIP


def test_crowded_months_are_compacted(spark, lake):
    state = state_of(lake)
    for n in range(5):
        land(lake, _MONTHS[: 4 if n == 0 else 1], AT + timedelta(hours=n), f"b{n}")
        sync(lake, state)
    counts = {m: rows for m, (rows, *_) in lake.months("staging", DAILY_PRICE.staging_name).items()}
    assert counts == {202401: 1, 202402: 1, 202501: 1, 202502: 1}
    assert {r["batch_id"] for r in lake.curated(DAILY_PRICE).where("yyyymm = 202401").collect()} == {"b4"}


def test_a_failed_check_is_run_again_and_a_passed_month_is_not(spark, lake, monkeypatch):
    land(lake, _MONTHS)
    for _ in range(2):
        with pytest.raises(q.QualityFailure, match="symbol_in_dimension"):
            jobs.refresh_fact(lake, _PRICE_FACT)
            jobs.check_models(lake, AT)
    jobs.dimension_increment(lake, AT)
    jobs.check_models(lake, AT)
    months, read = [], jobs.read_fact
    monkeypatch.setattr(jobs, "read_fact", lambda lake, name, m=None: months.append(m) or read(lake, name, m))
    jobs.check_models(lake, AT)
    assert months == [set()] * len(FACTS)
    land(lake, [(date(2025, 2, 15), 9)], AT, "b2")
    jobs.refresh_fact(lake, _PRICE_FACT)
    jobs.check_models(lake, AT)
    assert {202502} <= months[len(FACTS)]


def test_a_contract_breach_stops_the_models(spark, lake, monkeypatch):
    land(lake, _MONTHS)
    assert jobs.check_staging(lake)
    monkeypatch.setattr(Lake, "landing", lambda self, spec, keep=None: self.spark.createDataFrame([], "symbol string"))
    with pytest.raises(ContractViolation, match="volume: column is missing"):
        jobs.check_staging(lake)


def test_files_of_a_month_are_sorted(spark, lake):
    """Rows of a file ascend by the table's clustering."""
    rows = [("daily_prices", s, date(2024, 1, d), price(1)) for s in ("C", "A", "B") for d in (9, 3, 20)]
    values = [(s, d, *[Decimal(1)] * 4, None, 10, AT, "test", "b1") for _, s, d, _ in rows]
    made = spark.createDataFrame(values, DAILY_PRICE.schema).repartition(4)
    lake.overwrite_months("landing", DAILY_PRICE.name, made, "price_date", DAILY_PRICE.sort_columns)
    files = [r[0] for r in lake.landing(DAILY_PRICE).select(F.input_file_name()).distinct().collect()]
    for file in files:
        table = pq.read_table(file.removeprefix("file://"))
        keys = list(zip(*(table.column(c).to_pylist() for c in DAILY_PRICE.sort_columns)))
        assert keys == sorted(keys) and len(keys) > 1


def test_facts_of_several_schemas(spark, lake):
    """Months written under other columns read as the schema says, and are rewritten when touched."""
    old = T.StructType([T.StructField("sk", T.StringType()), T.StructField("d", T.DateType()), T.StructField("dropped", T.LongType())])
    new = T.StructType([*old.fields[:2], T.StructField("added", T.StringType()), T.StructField("yyyymm", T.IntegerType())])
    first = spark.createDataFrame([("a", date(2024, 1, 1), 1), ("b", date(2024, 2, 1), 2)], old)
    lake.overwrite_months("facts", "t", first, "d", ("sk",))
    fresh = spark.createDataFrame([("c", date(2024, 2, 2), "x")], T.StructType(new.fields[:3]))
    kept = lake.fact("t", new, lambda part: part.month == 202402).drop("yyyymm")
    lake.overwrite_months("facts", "t", replace_by_key(kept, fresh, ["sk"]), "d", ("sk",))
    rows = sorted(tuple(r)[:3] for r in lake.fact("t", new).collect())
    assert rows == [("a", date(2024, 1, 1), None), ("b", date(2024, 2, 1), None), ("c", date(2024, 2, 2), "x")]


def test_states_are_few_and_whole(spark, tmp_path):
    states = StateFolder(spark, str(tmp_path / "s"))
    assert states.latest() == (0, {})
    for n in range(1, 6):
        states.commit(n, {"n": n})
    assert states.numbers() == [4, 5] and states.latest() == (5, {"n": 5})
    with pytest.raises(FileExistsError):
        states.commit(5, {"n": 0})
    assert states.latest() == (5, {"n": 5})
