from __future__ import annotations

import random

import pytest

from tests.llm.data import SCHEMA, awkward, frame
from tidemark.llm import repeats


def brute(texts, window):
    split = [(t or "").encode().split() for t in texts]
    seen = {}
    for w in split:
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            seen[key] = seen.get(key, 0) + 1
    out = []
    for w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return sorted(out)


def got(df):
    return sorted((r.n_words, r.n_removed, r.kept_text) for r in df.collect())


@pytest.mark.parametrize("window", [35, 12])
def test_awkward_rows(spark, tmp_path, window):
    docs = frame(spark, None, tmp_path)
    assert got(repeats.remove_repeats(docs, window=window)) == brute([r[1] for r in awkward()], window)


def test_empty_table(spark, tmp_path):
    assert repeats.remove_repeats(frame(spark, [], tmp_path)).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_boundaries(spark, tmp_path, seed):
    """Passages of all lengths near the window, cut from each other at every offset."""
    rng = random.Random(seed)
    pool = [f"w{rng.randrange(500)}" for _ in range(400)]
    rows = []
    for i in range(60):
        text = []
        for _ in range(rng.randrange(1, 5)):
            a = rng.randrange(350)
            text += pool[a : a + rng.randrange(20, 60)] + [f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(0, 40))]
        rows.append((i, " ".join(text), None, None, 0, 0, "", "", 0, 0))
    assert SCHEMA and got(repeats.remove_repeats(frame(spark, rows, tmp_path))) == brute([r[1] for r in rows], 35)


def thue_morse(n: int, flip: bool = False) -> str:
    return "".join("ab"[bin(i).count("1") % 2 ^ flip] for i in range(n))


def test_regular_words_and_texts_do_not_collide(spark, tmp_path):
    """Sums of powers modulo 2^64 are equal for these words, and for texts of such words."""
    common = [f"w{i}" for i in range(34)]
    rows = [common + [thue_morse(1024, flip)] for flip in (False, True)]
    rows += [list(thue_morse(4096, flip)) for flip in (False, True)]
    texts = [(i, " ".join(w), "en", "s", 1, 1, "s", "f", 2, 3) for i, w in enumerate(rows)]
    found = {r.doc_id: r.n_removed for r in repeats.remove_repeats(frame(spark, texts[:2], tmp_path)).collect()}
    assert found == {0: 0, 1: 0}
    seen: dict = {}
    for d, w in enumerate(rows):
        for i in range(len(w) - 34):
            seen.setdefault(tuple(w[i : i + 35]), []).append((d, i))
    gone: list[set] = [set() for _ in rows]
    for places in seen.values():
        for d, i in places if len(places) > 1 else ():
            gone[d].update(range(i, i + 35))
    found = {r.doc_id: r.n_removed for r in repeats.remove_repeats(frame(spark, texts, tmp_path / "all")).collect()}
    assert found == {d: len(g) for d, g in enumerate(gone)}
