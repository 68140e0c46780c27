"""Token ids as ORC files: run-length encoded ids, row indexes, Bloom filters on ids of documents.

Documents are range-partitioned by id and sorted, so files hold ascending ids
and a reader skips stripes by their statistics.  Each row carries its part and
its start inside the part; one total per part then gives every document's
start in the whole, whichever task reads its stripe.
"""

from __future__ import annotations

import gc
import os
import zlib
from collections.abc import Iterator
from itertools import accumulate, chain, islice, pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm.pieces import Tier

_GROUP_CHARS = 2_000_000
#: Longer pre-tokens are encoded where they stand and not kept, so a cache is bounded in bytes too.
_KEPT_CHARS = 64
_COLUMNS = "doc_id long, part int, start_in_part long, n_tokens int, ids array<int>"


#: The letter that stands for a byte in the vocabulary: its own where it prints, else the next free one from 256.
_PRINTS = [*range(33, 127), *range(161, 173), *range(174, 256)]
_LETTER_OF = {b: b for b in _PRINTS} | {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTS)}
#: 0xff is in no UTF-8; as a line break, which stands for no byte, it separates words.
_LETTERS = np.array([_LETTER_OF[b] for b in range(255)] + [ord("\n")], dtype="<u4")


def _byte_letters(words: list[str]) -> list[str]:
    """Each word with its bytes' letters."""
    return _LETTERS[np.frombuffer(b"\xff".join(map(str.encode, words)), np.uint8)].tobytes().decode("utf-32-le").split("\n")


#: What a character is to the tokenizer's pattern; none yet asked for.
_LETTER, _DIGIT, _MARK, _WHITE, _UNASKED = range(5)
_SPACE, _QUOTE = ord(" "), ord("'")
_SHORT, _LONG = [ord(c) for c in "stmd"], [(ord(a), ord(b)) for a, b in ("re", "ve", "ll")]


class Encoder:
    """Ids of texts as the tokenizers library gives them; those of pre-tokens are kept as little-endian bytes.

    All texts of a group are cut at once where the tokenizer's byte-level pattern cuts them,
    ``'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+``: by what its
    characters are, which the library itself is asked once for each.  Its model then gets pre-tokens that a worker
    hasn't met.
    """

    def __init__(self, path: str, cached: int = 800_000):
        # Spark sets how many cores a machine uses.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cached = cached
        self.first = Tier(self._encode, limit=cached)
        self.kinds = np.full(0x110000, _UNASKED, dtype=np.uint8)

    def _encode(self, words: list[str]) -> list[bytes]:
        """Ids of pre-tokens: the library's model takes them as they are."""
        tokenize = self.tokenizer.model.tokenize
        return self._packed([[t.id for t in tokenize(word)] for word in _byte_letters(words)])

    @staticmethod
    def _packed(found: list[list[int]]) -> list[bytes]:
        ends = list(accumulate(map(len, found), initial=0))
        flat = memoryview(np.fromiter(chain.from_iterable(found), dtype="<u4", count=ends[-1]).tobytes())
        return [bytes(flat[4 * a : 4 * b]) for a, b in pairwise(ends)]

    def _kind(self, c: str) -> int:
        """A character is what it makes one pre-token with."""
        pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str
        return next((kind for kind, x in enumerate("a1!") if len(pieces(x + c + x)) == 1), _WHITE)

    def _starts(self, chars: np.ndarray, edges: np.ndarray) -> np.ndarray:
        """Where pre-tokens start in texts one after the other, which lie between ``edges``."""
        kinds = self.kinds[chars]
        if unasked := set(chars[kinds == _UNASKED].tolist()):
            for c in unasked:
                self.kinds[c] = self._kind(chr(c))
            kinds = self.kinds[chars]
        firsts, lasts = edges[:-1][np.diff(edges) > 0], edges[1:][np.diff(edges) > 0] - 1
        starts = np.ones(len(chars), dtype=bool)
        np.not_equal(kinds[1:], kinds[:-1], out=starts[1:])
        white = kinds == _WHITE
        # The last white space before a word parts from others before it; if it is a space, the word takes it.
        parts = white.copy()
        parts[:-1] &= ~white[1:]
        parts[lasts] = False
        starts |= parts
        starts[1:] &= white[1:] | (chars[:-1] != _SPACE)
        starts[firsts] = True
        quotes = np.flatnonzero(chars == _QUOTE)
        if len(quotes):
            self._shorten(chars, kinds, edges, quotes, starts)
        return np.flatnonzero(starts)

    @staticmethod
    def _shorten(chars: np.ndarray, kinds: np.ndarray, edges: np.ndarray, quotes: np.ndarray, starts: np.ndarray) -> None:
        """Quotes that start a pre-token take the letters of short forms along."""
        text = np.searchsorted(edges, quotes, side="right")
        left = edges[text] - quotes - 1
        before = quotes - 1
        own = (quotes == edges[text - 1]) | ((chars[before] != _SPACE) & (kinds[before] != _MARK))
        one, two = (chars[np.minimum(quotes + k, len(chars) - 1)] for k in (1, 2))
        short = own & (left >= 1) & np.isin(one, _SHORT)
        long = own & (left >= 2) & np.logical_or.reduce([(one == a) & (two == b) for a, b in _LONG])
        for found, size in ((short, 1), (long, 2)):
            starts[quotes[found] + 1] = False
            starts[(quotes + size + 1)[found & (left > size)]] = True

    def _numbered(self, texts: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
        """The pre-tokens of all texts, and how many there are up to each text's end."""
        joined = "".join(texts)
        chars = np.frombuffer(joined.encode("utf-32-le"), dtype="<u4")
        edges = np.cumsum([0, *map(len, texts)])
        starts = self._starts(chars, edges)
        width = np.ones(len(chars), dtype=np.uint8)
        for wider in (0x80, 0x800, 0x10000):
            width += chars >= wider
        places = np.cumsum(np.append(0, np.add.reduceat(width, starts, dtype=np.int64)))
        cut = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(places), pa.py_buffer(joined.encode()))
        return cut.dictionary_encode(), np.searchsorted(starts, edges[1:])

    def encode(self, texts: list[str | None], end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, each followed by ``end``, and how many each text has.

        Each distinct pre-token is looked up once; the ids are then gathered by number.
        """
        texts = [t or "" for t in texts]
        # A text with an added token's string is left to the library as a whole.
        odd = [i for i, t in enumerate(texts) if any(map(t.__contains__, self.special))]
        whole = [self.tokenizer.encode(texts[i], add_special_tokens=False).ids for i in odd]
        for i in odd:
            texts[i] = ""
        numbered, after = self._numbered(texts)
        known = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        parts = self._looked_up(known)
        # A text ends with the end's ids, or as a whole with its own and those.
        parts += [end, *(ids + end for ids in self._packed(whole))]
        closing = np.full(len(texts), len(known))
        closing[odd] = len(known) + 1 + np.arange(len(odd))
        sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) // 4
        ids, at = np.frombuffer(b"".join(parts), dtype="<u4"), np.cumsum(sizes) - sizes
        number = np.insert(numbered.indices.to_numpy(), after, closing)
        size = sizes[number]
        ends = np.cumsum(size)
        places = np.repeat(at[number] - (ends - size), size)
        places += np.arange(len(places))
        last = ends[after + np.arange(len(texts))]
        return ids[places], np.diff(last, prepend=0)

    def trim(self) -> None:
        """Keep an eighth of a full cache, met first, where the common pre-tokens are: a worker may wait with it."""
        common = dict(islice(self.first.items(), self.cached // 8))
        self.first = Tier(self._encode, common, limit=self.cached - len(common))
        pa.default_memory_pool().release_unused()

    def _looked_up(self, words: list[str]) -> list[bytes]:
        """Ids of distinct pre-tokens; new ones are kept."""
        found = list(map(self.first.get, words))
        missing = [word for word, ids in zip(words, found) if ids is None]
        if missing:
            fresh = self._encode(missing)
            self.first.make_room(len(fresh))
            self.first.update(entry for entry in zip(missing, fresh) if len(entry[0]) <= _KEPT_CHARS)
            new = iter(fresh)
            found = [next(new) if ids is None else ids for ids in found]
        return found


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder_of(path: str, cached: int = 800_000) -> Encoder:
    """One encoder per worker, with a cache of so many pre-tokens, for all its tasks."""
    if (path, cached) not in _ENCODERS:
        _ENCODERS[path, cached] = Encoder(path, cached)
    return _ENCODERS[path, cached]


def forget_encoders() -> None:
    """Give back the memory of a worker's encoders; the next text to encode makes a new one."""
    if _ENCODERS:
        _ENCODERS.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()


def encoded_groups(encoder: Encoder, texts: pa.Array, end: bytes) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, ids of a group of texts one after the other, how many each has), each text followed by ``end``."""
    at = 0
    while at < len(texts):
        group, chars = [], 0
        while at + len(group) < len(texts) and chars < _GROUP_CHARS:
            group.append(texts[at + len(group)].as_py())
            chars += len(group[-1] or "")
        gc.disable()  # the many small objects of a group hold no cycles
        try:
            ids, sizes = encoder.encode(group, end)
        finally:
            gc.enable()
        yield at, ids, sizes
        at += len(sizes)


def write_token_files(
    docs: DataFrame, path: str, tokenizer_path: str, *, id_column: str = "doc_id", text_column: str = "text",
    end_id: int = 2, parts: int | None = None, text_bytes_per_part: int = 32 << 20, cached_segments: int = 800_000,
) -> None:
    """Write every row's ids, then ``end_id``, as ORC below ``path``, in ascending order of id.

    Null and empty texts are the end id alone.  Null ids come first; rows with
    the same id follow each other, ordered by a hash of their text.  Parts are
    sized by the bytes of text, measured over all rows, unless ``parts`` is given.  A worker keeps the
    ids of at most ``cached_segments`` pre-tokens; fewer take more time and less memory.
    ``docs`` must be a table scan: its rows are numbered, so that even a third of
    all rows with one id is spread over parts.
    """
    if parts is None:
        total = docs.agg(F.sum(F.octet_length(text_column))).first()[0] or 0
        parts = max(1, -(-total // text_bytes_per_part))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, start = encoder_of(tokenizer_path, cached_segments), TaskContext.get().partitionId(), 0
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            for at, ids, sizes in encoded_groups(encoder, batch.column(1), end):
                ends = np.cumsum(sizes)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids.view("<i4"))
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(sizes)),
                        pa.array(np.full(len(sizes), part), pa.int32()),
                        pa.array(start + ends - sizes, pa.int64()),
                        pa.array(sizes, pa.int32()),
                        lists,
                    ],
                    names=["doc_id", "part", "start_in_part", "n_tokens", "ids"],
                )
                start += int(ends[-1])
        encoder.trim()

    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(text_column).alias("text"),
        F.xxhash64(text_column).alias("tie"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = ("doc_id", "tie", "row")
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")
    (
        ordered.mapInArrow(encode, _COLUMNS)
        .write.option("orc.compress", "SNAPPY")
        .option("orc.stripe.size", 16 << 20)
        .option("orc.row.index.stride", 1000)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", 0.01)
        .orc(path)
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of the written rows; ``start`` counts the ids of all rows before."""
    rows = spark.read.schema(_COLUMNS).orc(path)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # One row per part: the window sees no documents.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    joined = rows.join(F.broadcast(bases), "part")  # bounded: one row per part
    return joined.select("doc_id", (F.col("base") + F.col("start_in_part")).alias("start"), "n_tokens", "ids")


def token_digests(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): the unsigned crc32 of the ids as little-endian 32-bit numbers."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_encoders()  # all ids are written when they are read back
        for batch in batches:
            lists = batch.column(2)
            ids = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            offsets = lists.offsets.to_numpy()
            view = memoryview(ids).cast("B")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(np.diff(offsets).astype(np.int64)),
                    pa.array([zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(offsets, offsets[1:])], pa.int64()),
                ],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return tokens.select("doc_id", "start", "ids").mapInArrow(
        digest, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
