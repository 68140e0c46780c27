from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st

from tests.llm.data import awkward, frame, words
from tidemark.llm import packing

BPE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BPE)


def padding(fills: list[int], length: int) -> int:
    return sum(0 if n & (n - 1) == 0 else length - n for n in fills)


def check_plan(histogram: dict[int, int], length: int, grain: int) -> tuple[packing.Plan, list[int]]:
    """Every rest lies whole in gapless sequences of at most ``length``; returns the fills."""
    plan = packing.make_plan(histogram, length, grain)
    rests = np.array([r for r, n in histogram.items() for _ in range(n)], dtype=np.int64)
    ranks = np.array([i for _, n in histogram.items() for i in range(n)], dtype=np.int64)
    pieces, covered = defaultdict(list), defaultdict(list)
    for docs, start, size, sequence, offset in plan.locate(rests, ranks):
        for d, a, n, s, o in zip(*(x.tolist() for x in (docs, start, size, sequence, offset))):
            assert n > 0
            pieces[s].append((o, n))
            covered[d].append((a, n))
    for d, rest in enumerate(rests.tolist()):
        at = 0
        for a, n in sorted(covered[d]):
            assert a == at
            at += n
        assert at == rest
    fills = []
    for own in pieces.values():
        at = 0
        for o, n in sorted(own):
            assert o == at
            at += n
        assert at <= length
        fills.append(at)
    assert not pieces or (min(pieces) >= 0 and max(pieces) < plan.sequences)
    return plan, fills


@settings(deadline=None, max_examples=150)
@given(st.dictionaries(st.integers(1, 63), st.integers(1, 40), max_size=20), st.sampled_from([1, 2, 4, 8]))
def test_plans_lose_nothing(histogram, grain):
    check_plan(histogram, 64, grain)


def test_little_padding():
    rng = random.Random(1)
    histogram = defaultdict(int)
    for _ in range(40_000):
        histogram[min(2047, int(rng.lognormvariate(6, 1)) + 1)] += 1
    plan, fills = check_plan(dict(histogram), 2048, 8)
    tokens = sum(r * n for r, n in histogram.items())
    assert padding(fills, 2048) < 0.01 * tokens
    assert plan.stream_tokens < 0.05 * tokens


def test_a_hot_length_of_just_over_half():
    """Two such rests never share a sequence whole: they are cut instead of padded."""
    histogram = {1025: 3000, 1000: 10, 500: 100}
    plan, fills = check_plan(histogram, 2048, 8)
    assert padding(fills, 2048) < 0.01 * sum(r * n for r, n in histogram.items()) and plan.stream_tokens > 2_000_000


def test_program_is_solved_to_its_bound():
    rng = random.Random(2)
    sizes = np.array(sorted(rng.sample(range(1, 129), 60)))
    counts = np.array([float(rng.randrange(1, 500)) for _ in sizes])
    patterns, uses = packing.solve_patterns(sizes, counts, 128, gap=-1)
    assert np.allclose(uses @ patterns, counts) and (patterns @ sizes <= 128).all() and (uses >= 0).all()
    prices = np.linalg.solve(patterns.astype(float), np.ones(len(sizes)))
    worth, _ = packing.best_pattern(prices, sizes, 128)
    assert worth <= 1 + 1e-6 and abs(prices @ counts - uses.sum()) < 1e-6 * uses.sum()
    whole = packing.round_patterns(patterns, uses, sizes, counts.astype(int), 0)
    assert (whole @ patterns <= counts).all() and whole.sum() >= uses.sum() - len(sizes)
    tight = packing.round_patterns(patterns, uses, sizes, counts.astype(int), 128)
    assert ((tight == 0) | (patterns @ sizes == 128)).all()


@given(st.lists(st.integers(1, 12), min_size=1, max_size=5, unique=True), st.data())
def test_knapsack_is_best(sizes, data):
    sizes = np.array(sorted(sizes))
    values = np.array([data.draw(st.integers(-3, 9)) for _ in sizes], dtype=float)
    worth, copies = packing.best_pattern(values, sizes, 12)

    def brute(room, i):
        if i == len(sizes):
            return 0.0
        return max(n * values[i] + brute(room - n * sizes[i], i + 1) for n in range(room // sizes[i] + 1))

    assert worth == brute(12, 0) == copies @ values and copies @ sizes <= 12


@pytest.mark.parametrize("length", [64, 2048])
def test_pieces_hold_every_id_once(spark, tmp_path, tokenizer, length):
    rng = random.Random(4)
    rows = awkward() + [(100 + i % 9, " ".join(words(rng, 30)), "en", "s", 1, 1, "s", "f", 2, 3) for i in range(300)]
    rows += [(500, "same text of a hot length", "en", "s", 1, 1, "s", "f", 2, 3)] * 200
    docs = frame(spark, rows, tmp_path)
    pieces = packing.pack(docs, BPE, length=length, end_id=1)
    found = pieces.collect()
    texts = defaultdict(list)
    for r in rows:
        texts[r[0]].append(tuple(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [1]))
    fills = defaultdict(list)
    for r in found:
        assert len(r.ids) == r.length
        fills[r.sequence_id].append((r.offset, r.length))
        assert any(t[r.start : r.start + r.length] == tuple(r.ids) and len(t) == r.doc_tokens for t in texts[r.doc_id])
    assert sum(r.length for r in found) == sum(len(t) for own in texts.values() for t in own)
    for own in fills.values():
        at = 0
        for o, n in sorted(own):
            assert o == at
            at += n
        assert at <= length
    lone = {i: t for i, t in texts.items() if len(t) == 1}
    for i, (ids,) in lone.items():
        own = sorted((r.start, r.ids) for r in found if r.doc_id == i)
        assert tuple(x for _, part in own for x in part) == ids
    digests = packing.pack(docs, BPE, length=length, end_id=1, digest=True).collect()
    crc = [(r.doc_id, r.start, r.length, zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in found]
    assert sorted(map(str, crc)) == sorted(str((r.doc_id, r.start, r.length, r.ids_crc32)) for r in digests)
    whole = packing.sequences(pieces, length, pad_id=7).collect()
    assert sorted(r.sequence_id for r in whole) == sorted(fills)
    assert {len(r.ids) for r in whole if r.n_tokens & (r.n_tokens - 1)} <= {length}
    assert all(len(r.ids) == r.n_tokens for r in whole if r.n_tokens & (r.n_tokens - 1) == 0)


def test_empty_table_and_a_very_long_text(spark, tmp_path, tokenizer):
    assert packing.pack(frame(spark, [], tmp_path), BPE).collect() == []
    text = "word " * 2_000_000
    one = frame(spark, [(1, text, "en", "s", 1, 1, "s", "f", 2, 3)], tmp_path / "long")
    rows = sorted(packing.pack(one, BPE, digest=True).collect(), key=lambda r: r.start)
    total = len(tokenizer.encode(text, add_special_tokens=False).ids) + 1
    assert sum(r.length for r in rows) == total == rows[0].doc_tokens
    assert len({r.sequence_id for r in rows}) == len(rows) and all(r.length & (r.length - 1) == 0 for r in rows)


def test_length_must_be_a_power_of_two(spark, tmp_path):
    with pytest.raises(ValueError, match="power of two"):
        packing.pack(frame(spark, [], tmp_path), BPE, length=100)
