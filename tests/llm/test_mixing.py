from __future__ import annotations

from collections import defaultdict

import pytest

from tests.llm.data import awkward, frame
from tidemark.llm import mixing


def targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    free, rest, out = set(order), share * sum(sizes.values()), {}
    while free:
        level = rest / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > cap * sizes[s]]
        if not over:
            return out | {s: level * weight[s] for s in free}
        for s in over:
            out[s] = cap * sizes[s]
            rest -= out[s]
            free.discard(s)
    return out


@pytest.mark.parametrize("nodes", [3, 20_000])
def test_words_meet_targets(spark, tmp_path, nodes):
    docs = frame(spark, None, tmp_path)
    rows = mixing.words_taken(mixing.mix(docs, node_rows=nodes, fan_in=2)).collect()
    assert len(rows) == len(awkward())
    sizes, taken, target, parts = defaultdict(int), defaultdict(int), {}, defaultdict(int)
    for r in awkward():
        sizes[r[3]] += len((r[1] or "").encode().split())
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size and r.source_size == sizes[r.source]
        taken[r.source] += r.taken
        target[r.source] = r.target
        parts[r.source] += r.copies != round(r.copies)
    want = targets(dict(sizes))
    for s in sizes:
        assert abs(target[s] - want[s]) < 1e-6 and abs(taken[s] - want[s]) <= 1 and parts[s] <= 1
    again = mixing.words_taken(mixing.mix(docs, node_rows=nodes, fan_in=2)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_documents_come_as_often_as_taken(spark, tmp_path):
    docs = frame(spark, None, tmp_path)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    whole = {r.row: r.copies for r in mixing.mix(docs).collect()}
    assert sum(int(c) for c in whole.values()) <= out.count() <= sum(-(-c // 1) for c in whole.values())
    assert {r.text for r in out.collect()} <= {r[1] for r in awkward()}
    empty = frame(spark, [], tmp_path / "none")
    assert mixing.mix(empty).collect() == [] and mixing.mixed_documents(empty).collect() == []


def test_expectation_is_kept():
    up = sum(mixing._pair(30, 0.4, 10, 0.7, (i + 0.5) / 1000)[1] for i in range(1000)) / 1000
    assert abs(up - 0.7) < 2e-3
    for u in (0.0, 0.5, 0.999):
        p, q = mixing._pair(30, 0.4, 10, 0.7, u)
        assert abs(30 * p + 10 * q - 19) < 1e-9 and (p in (0, 1) or q in (0, 1))


def test_reruns_agree_on_any_split(spark, tmp_path):
    docs = frame(spark, None, tmp_path)
    docs.repartition(7).write.parquet(f"{tmp_path}/other")
    other = spark.read.parquet(f"{tmp_path}/other")
    drop = lambda df: sorted(str(tuple(r)) for r in df.drop("row").collect())
    options = {"node_rows": 5, "fan_in": 2}
    assert drop(mixing.mix(docs, **options)) == drop(mixing.mix(other, **options))
