from __future__ import annotations

import hashlib
import zlib

import pytest

from tests.llm.data import SCHEMA, awkward, frame
from tidemark.llm import merkle, ranks


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def spelled(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root and, for each leaf, its siblings (left, right) level by level."""
    places, steps = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for leaf, i in enumerate(places):
            run = i // 16 * 16
            steps[leaf].append(("".join(nodes[run:i]), "".join(nodes[i + 1 : run + 16])))
        places = [i // 16 for i in places]
        nodes = [sha("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
    return nodes[0], steps


def expected(rows: list[tuple]) -> list[tuple]:
    """doc_id, leaf, subroot, root, proof, folded root, verified of rows (doc_id, text, lang, source, n_chars, ...)."""
    sources: dict = {}
    for doc_id, text, lang, source, n_chars, *_ in rows:
        leaf = lambda t: sha("".join(map(spelled, (doc_id, source, lang, n_chars, t))))  # noqa: B023, E731
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        lower = text if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        own = leaf(text)
        entry = (-1 if doc_id is None else doc_id, own, doc_id, leaf(lower) if hit else own)
        sources.setdefault(source, []).append(entry)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([e[1] for e in sorted(sources[s])]) for s in order}
    root, to_root = tree([trees[s][0] for s in order])
    out = []
    for at, s in enumerate(order):
        subroot, steps = trees[s]
        for (_, own, doc_id, bad), path in zip(sorted(sources[s]), steps):
            path = path + to_root[at]
            node = bad
            for left, right in path:
                node = sha(left + node + right)
            proof = sha("".join(left + right for left, right in path))
            out.append((doc_id, own, subroot, root, proof, node, node == root))
    return sorted(map(str, out))


def found(docs) -> list[str]:
    rows = merkle.verified(merkle.manifest(docs))
    columns = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted(str(tuple(r)) for r in rows.select(*columns).collect())


def test_awkward_rows(spark, tmp_path):
    rows = awkward() + [(6, "UPPER", "EN", "S0", 4, 1, "s", "f", 2, 3), (31, "Mixed Ä", None, "", 7, 1, "s", "f", 2, 3)]
    got = found(frame(spark, rows, tmp_path))
    assert got == expected(rows)
    assert any("False" in r for r in got) and any("True" in r for r in got)
    assert found(frame(spark, [], tmp_path / "none")) == []


@pytest.mark.parametrize("sizes", [(1,), (16, 17, 1), (256, 257, 300, 2, 4097)])
def test_trees_of_every_height(spark, tmp_path, sizes, monkeypatch):
    monkeypatch.setattr(merkle, "ranked", lambda *a: ranks.ranked(*a, rows_per_part=500))
    rows = [(i, f"T{i % 7}", "en", f"s{g}", i, 1, "s", "f", 2, 3) for g, n in enumerate(sizes) for i in range(n)]
    assert found(frame(spark, rows, tmp_path)) == expected(rows)


def test_many_sources_and_a_very_long_text(spark, tmp_path):
    rows = [(i, "x", "en", f"host-{i}", i, 1, "s", "f", 2, 3) for i in range(600)]
    rows.append((6, "Long " * 4_000_000, "en", "host-1", 1, 1, "s", "f", 2, 3))
    assert found(frame(spark, rows, tmp_path)) == expected(rows)


def test_ranks_are_gapless(spark, tmp_path):
    df = spark.createDataFrame([(i % 3 or None, i // 2, i) for i in range(1000)], "g int, a int, b int")
    df.write.parquet(f"{tmp_path}/t")
    rows = ranks.ranked(spark.read.parquet(f"{tmp_path}/t"), "g", ["a"], rows_per_part=90).collect()
    for g in (None, 1, 2):
        own = sorted((r["rank"], r.a, r.group_rows) for r in rows if r.g == g)
        assert [r[0] for r in own] == list(range(len(own))) and {r[2] for r in own} == {len(own)}
        assert [r[1] for r in own] == sorted(r[1] for r in own)
    assert SCHEMA and len(rows) == 1000
