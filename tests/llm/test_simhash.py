from __future__ import annotations

import random

import xxhash
from hypothesis import given, settings, strategies as st

from tests.llm.data import awkward, frame
from tidemark.llm import near_copies, simhash


def fingerprint(text):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [b" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values, linked):
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if linked(values[i], values[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(values))]


def test_awkward_rows(spark, tmp_path):
    rows = awkward()
    found = simhash.near_duplicates(frame(spark, None, tmp_path)).collect()
    prints = [fingerprint(r[1]) for r in rows]
    of = groups(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for r, g in zip(rows, of):
        if r[0] is not None:
            least[g] = min(least.get(g, r[0]), r[0])
    want = sorted(str((r[0], p, least.get(g))) for r, p, g in zip(rows, prints, of))
    assert sorted(str((r.doc_id, r.fingerprint % 2**64, r.component_id)) for r in found) == want
    assert simhash.near_duplicates(frame(spark, [], tmp_path / "none")).collect() == []


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(0, 2**12 - 1), max_size=60), st.integers(0, 4))
def test_tree_links_connect_as_all_pairs(values, radius):
    values = list(dict.fromkeys(values))
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for v in values:
        assert sorted(tree.values[i] for i in tree.within(v, radius)) == sorted(x for x in values if (x ^ v).bit_count() <= radius)
    links = set(simhash.shard_links(values, radius))
    of = groups(values, lambda a, b: (a ^ b).bit_count() <= radius)
    assert groups(values, lambda a, b: (a, b) in links or (b, a) in links) == of


def test_crowded_shards_lose_no_link(spark):
    """All values in a few shards, dealt anew at a tiny limit: the components are those of all pairs."""
    rng = random.Random(5)
    values = list({rng.getrandbits(10) << 20 | rng.getrandbits(3) for _ in range(300)})
    prints = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    links = {tuple(r) for r in simhash.fingerprint_links(prints, 2, shard_limit=8).collect()}
    of = groups(values, lambda a, b: (a ^ b).bit_count() <= 2)
    assert groups(values, lambda a, b: (a, b) in links or (b, a) in links) == of


def test_near_copies_leave_one(spark, tmp_path):
    kept = near_copies.without_near_copies(frame(spark, None, tmp_path))
    assert kept.columns == frame(spark).columns
    ids = [r.doc_id for r in kept.collect()]
    assert 0 in ids and not {1, 2, 16} & set(ids)  # copy, near copy, copy with a word more
    assert 3 in ids and not {4, 5} & set(ids)  # texts without words
    assert 6 in ids and 14 not in ids and 7 in ids
    assert ids.count(17) == 1 and {20 + i for i in range(30)} - set(ids) <= {20 + i for i in range(30)}
    assert near_copies.without_near_copies(frame(spark, [], tmp_path / "none")).collect() == []


def test_hot_shards_are_searched_in_chunks(spark, tmp_path):
    """More near copies than a chunk holds: one stays."""
    rng = random.Random(1)
    base = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    rows = []
    for i in range(150):
        w = list(base)
        w[rng.randrange(400)] = f"n{i}"
        rows.append((i, " ".join(w), None, None, 0, 0, "", "", 0, 0))
    docs = frame(spark, rows, tmp_path)
    assert [r.doc_id for r in near_copies.without_near_copies(docs).collect()] == [0]
    run, schema = near_copies._described(5)
    prints = docs.selectExpr("doc_id AS row", "text").mapInArrow(run, schema)
    links = near_copies.candidate_links(prints.select("row", "fingerprint", "bands"), 20, chunk_rows=20)
    pairs = {tuple(r) for r in links.collect()}
    assert len(set(groups(list(range(150)), lambda a, b: (a, b) in pairs or (b, a) in pairs))) == 1


def documents(texts):
    return [(i, t, None, None, 0, 0, "", "", 0, 0) for i, t in enumerate(texts)]


def test_repeated_lines_do_not_hide_near_copies(spark, tmp_path):
    rng = random.Random(8)
    body = [f"w{rng.randrange(10**6)}" for _ in range(200)]
    lines = [" ".join(f"l{rng.randrange(10**6)}" for _ in range(10)) for _ in range(2)]
    texts = [" ".join([*body, *[mark] * 50]) for mark in "-*"]
    docs = frame(spark, documents(texts), tmp_path / "marks")
    assert [r.doc_id for r in near_copies.without_near_copies(docs).collect()] == [0]
    texts = [" ".join([*body, *[line] * 20]) for line in lines]
    docs = frame(spark, documents(texts), tmp_path / "lines")
    assert [r.doc_id for r in near_copies.without_near_copies(docs).collect()] == [0]


def sets_alike(a, b):
    """Five-word shingles 0.8 alike, by brute force."""
    a, b = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a.split(), b.split()))
    return len(a & b) >= 0.8 * len(a | b)


def star(rng, copies, words=300, edits=5):
    """An original in the middle of copies that are like it but not like each other."""
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    texts = []
    for i in range(copies):
        w = list(base)
        # Edits that share no shingle.
        for k in range(edits):
            w[5 + words // edits * k + rng.randrange(words // edits - 10)] = f"n{i}-{k}"
        texts.append(" ".join(w))
    return [*texts[: copies // 2], " ".join(base), *texts[copies // 2 :]]


def test_star_group_leaves_one(spark, tmp_path):
    rng = random.Random(11)
    texts = star(rng, 60) + star(rng, 20) + [" ".join(f"u{rng.randrange(10**6)}" for _ in range(100)) for _ in range(5)]
    rng.shuffle(texts)
    of = groups(texts, sets_alike)
    assert len(set(of)) == 7
    assert len(set(groups(texts, lambda a, b: sets_alike(a, b) and "-" in a and "-" in b))) > 7  # only the originals join them
    kept = near_copies.without_near_copies(frame(spark, documents(texts), tmp_path))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(of))


def test_hot_shards_lose_no_verified_link(spark):
    """Rows of several chunks, few of them connected: the components are those of all pairs in a shard."""
    rng = random.Random(12)
    texts = star(rng, 40) + star(rng, 10)
    rng.shuffle(texts)
    rows = spark.createDataFrame(list(enumerate(texts)), "row long, text string")
    run, schema = near_copies._described(5)
    # One shard holds all: what its chunks do not meet is met nowhere else.
    prints = rows.mapInArrow(run, schema).selectExpr("row", "fingerprint", "array(1L) AS bands")
    links = near_copies.candidate_links(prints, 64, chunk_rows=8, texts=rows)
    pairs = {(texts[u], texts[v]) for u, v in links.collect()}
    assert all(sets_alike(u, v) for u, v in pairs)
    of = groups(texts, sets_alike)
    assert len(set(of)) == 2
    assert groups(texts, lambda a, b: (a, b) in pairs or (b, a) in pairs) == of
