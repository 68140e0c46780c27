from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st

from tests.llm.data import awkward, frame
from tidemark.llm import token_counts, token_files
from tidemark.llm.pieces import Tier, segments

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
PARTS = [*"abÉß1² \n\t.,'▁_-", "\x1c", "\u3000", "日", "<s>", "<|endoftext|>", "'s", "  ", " word", "Word", ",\nNext"]
LETTERS = st.lists(st.sampled_from(PARTS), max_size=30).map("".join)


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BPE)


@pytest.fixture(scope="module")
def processor():
    return token_counts._processor(PIECES)


def ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


def test_round_trip(spark, tmp_path, tokenizer):
    docs = frame(spark, None, tmp_path)
    path = f"{tmp_path}/tokens"
    token_files.write_token_files(docs, path, BPE, parts=4)
    read = token_files.read_token_files(spark, path)
    rows = sorted(read.collect(), key=lambda r: r.start)
    assert [r.doc_id is None for r in rows] == sorted([r.doc_id is None for r in rows], reverse=True)
    known = [r.doc_id for r in rows if r.doc_id is not None]
    assert known == sorted(known)
    at = 0
    for r in rows:
        assert r.start == at and r.n_tokens == len(r.ids)
        at += len(r.ids)
    assert sorted(str((r.doc_id, r.ids)) for r in rows) == sorted(str((r[0], ids(tokenizer, r[1]))) for r in awkward())
    digests = {(r.start): (r.n_tokens, r.ids_crc32) for r in token_files.token_digests(read).collect()}
    assert digests == {r.start: (r.n_tokens, zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in rows}


def test_empty_table(spark, tmp_path):
    token_files.write_token_files(frame(spark, [], tmp_path), f"{tmp_path}/tokens", BPE)
    assert token_files.token_digests(token_files.read_token_files(spark, f"{tmp_path}/tokens")).collect() == []
    assert token_counts.token_counts(frame(spark, [], tmp_path), PIECES).collect() == []


def test_file_has_bloom_filters_and_run_lengths(spark, tmp_path):
    token_files.write_token_files(frame(spark, None, tmp_path), f"{tmp_path}/tokens", BPE, parts=1)
    plan = spark.read.orc(f"{tmp_path}/tokens").where("doc_id = 9")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,9)" in plan
    import glob

    (file,) = glob.glob(f"{tmp_path}/tokens/*.orc")
    reader = spark._jvm.org.apache.orc.OrcFile
    conf = spark._jsc.hadoopConfiguration()
    kinds = reader.createReader(spark._jvm.org.apache.hadoop.fs.Path(file), reader.readerOptions(conf)).getFileTail().getFooter().toString()
    assert "doc_id" in kinds
    with open(file, "rb") as f:
        assert len(f.read()) < 4 * sum(len(r[1] or "") for r in awkward())


@settings(deadline=None, max_examples=300)
@given(st.lists(LETTERS, min_size=1, max_size=6))
def test_pieces_give_the_librarys_ids(tokenizer, processor, texts):
    encoder = token_files.encoder_of(BPE)
    found, sizes = encoder.encode(texts, np.array([2], "<u4").tobytes())
    assert [x.tolist() for x in np.split(found, np.cumsum(sizes)[:-1])] == [ids(tokenizer, t) for t in texts]
    tier = Tier(lambda wanted: token_counts.segment_lengths(processor, wanted), limit=4)
    for text in texts:
        parts = segments(text) if text else []
        tier.learn(set(parts))
        assert sum(tier[p] for p in parts) == len(processor.encode(text))


def test_counts(spark, tmp_path, processor):
    found = token_counts.token_counts(frame(spark, None, tmp_path), PIECES, limit=100).collect()
    want = []
    for r in awkward():
        n = len(processor.encode(r[1] or ""))
        want.append(str((r[0], len((r[1] or "").encode()), n, n > 100)))
    assert sorted(str(tuple(r)) for r in found) == sorted(want)


def test_a_full_cache_forgets_nothing_in_use(tokenizer):
    """Heads of a group's texts outnumber the cache, and marks are learnt after them."""
    encoder = token_files.Encoder(BPE)
    encoder.first.limit, encoder.first.kept = 8, 4
    texts = [f"Head{i}*** word{i}, next{i};" for i in range(40)]
    for _ in range(2):
        found, sizes = encoder.encode(texts, np.array([2], "<u4").tobytes())
        assert [x.tolist() for x in np.split(found, np.cumsum(sizes)[:-1])] == [ids(tokenizer, t) for t in texts]


def test_each_distinct_pre_token_is_kept_once(tokenizer):
    """Not once more for every mark, quote or line break beside it."""
    words = ["word", "É", "naïve", "日本", "12²"]
    texts = [f"{w}{m} {w}{m}{w}\n{w}{m}" for w in words for m in (",", "!!", "...", "'s", " ", "\n\n", "\u00a0 ", "%%%", "'")]
    encoder = token_files.Encoder(BPE)
    for _ in range(2):
        found, sizes = encoder.encode(texts, np.array([2], "<u4").tobytes())
        assert [x.tolist() for x in np.split(found, np.cumsum(sizes)[:-1])] == [ids(tokenizer, t) for t in texts]
    pattern = tokenizer.pre_tokenizer.pre_tokenize_str
    assert sorted(encoder.first) == sorted({t[a:b] for t in texts for _, (a, b) in pattern(t)})


def test_every_character_is_cut_as_the_library_cuts_it(tokenizer):
    chars = [chr(c) for c in (*range(0x300), *range(0x300, 0xD800, 7), *range(0x1F000, 0x20000, 7), 0x10FFFF)]
    texts = [f"a{c}b {c}c{c}{c} {c} 1{c}2!{c}'{c}'s{c}'s\n{c}" for c in chars]
    texts += ["'", "'s", "a'", "'re", "'r", "e's't", "!'s", " 's", "\n'll'", "'ve1", "'sx", " ", "a ", " \n", "\n b", "b  \n "]
    found, sizes = token_files.encoder_of(BPE).encode(texts, np.array([2], "<u4").tobytes())
    assert [x.tolist() for x in np.split(found, np.cumsum(sizes)[:-1])] == [ids(tokenizer, t) for t in texts]


def test_a_trimmed_cache_keeps_what_was_met_first(tokenizer):
    encoder = token_files.Encoder(BPE, cached=80)
    texts = [f"a word{i}" for i in range(60)]
    for _ in range(2):
        found, sizes = encoder.encode(texts, np.array([2], "<u4").tobytes())
        assert [x.tolist() for x in np.split(found, np.cumsum(sizes)[:-1])] == [ids(tokenizer, t) for t in texts]
        encoder.trim()
        assert len(encoder.first) == 10 and "a" in encoder.first and encoder.first.limit == 80
