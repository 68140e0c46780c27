"""Every query runs on the small tables, and those with SQL equal it; the pipeline's stages in turn."""

from __future__ import annotations

import pytest

import corpus_pipeline
from tests.oracle import _rows, connect
from tidemark.llm import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_equals_sql(spark, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    cursor = connect(SF_DIR).execute(queries.ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(names, cursor.fetchall())


def test_a_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_stages(spark, tmp_path):
    docs = queries.table(spark, SF_DIR, "documents")
    columns, before = docs.columns, {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        ids = {r.doc_id for r in docs.collect()}
        assert ids <= before
        if name in ("toxicity", "near_copies", "decontamination"):
            assert docs.columns == columns and len(ids) > 0.8 * len(before)
        before = ids
    rows = sorted(docs.collect(), key=lambda r: r.start)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:]))
    empty = queries.table(spark, SF_DIR, "documents").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).collect() == []
