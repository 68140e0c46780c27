"""Packing documents into sequences by cutting-stock column generation.

A document gives as many full sequences as it has whole lengths; its rest shares one.  The
rests are counted by length, and a linear program over patterns (how many rests of each
length class one sequence takes) finds the fewest sequences.  Its columns are generated: a
knapsack dynamic program over the capacity prices them with the program's dual values.
Patterns are rounded down, then up where rests are left; documents of a class, ranked by
length, fill the patterns' places in turn.  What no whole and well filled pattern takes is
laid end to end and cut at the sequences' borders.

Only the histogram (one row per length) reaches the driver, and a plan of that size goes
back to the tasks: every document's place follows from its length and its rank among all
documents of that length, so no token is shuffled to be packed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.ranks import stored
from tidemark.llm.token_files import encoded_groups, encoder_of

#: Numbers of full sequences: the task's number above these bits, a count below.
_TASK_BITS = 33
_ENCODED = "doc_id long, ids binary, n_tokens int, part int, nth int, full_before long"
_PIECES = "doc_id long, start long, length long, {}, doc_tokens long, sequence_id long, offset long"


# The linear program -------------------------------------------------------------
#
# Its products and inverses are sums of numpy's own: a driver's BLAS threads were seen to hang in an inversion.


def inverted(matrix: np.ndarray) -> np.ndarray:
    """Inverse by elimination with row pivots."""
    n = len(matrix)
    both = np.hstack([matrix.astype(float), np.eye(n)])
    for i in range(n):
        pivot = i + int(np.abs(both[i:, i]).argmax())
        both[[i, pivot]] = both[[pivot, i]]
        both[i] /= both[i, i]
        factors = both[:, i].copy()
        factors[i] = 0
        both -= factors[:, None] * both[i]
    return both[:, n:]


def times_vector(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    return (matrix * vector).sum(axis=1)


def best_pattern(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the copies of each size that are worth most inside the capacity."""
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fitting = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        n = fitting[room]
        best[room] = best[room - 1]
        if n:
            worth = best[room - sizes[:n]] + values[:n]
            i = int(worth.argmax())
            if worth[i] > best[room]:
                best[room], choice[room] = worth[i], i
    copies, room = np.zeros(len(sizes)), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            copies[choice[room]] += 1
            room -= int(sizes[choice[room]])
    return float(best[capacity]), copies


def solve_patterns(
    sizes: np.ndarray, counts: np.ndarray, capacity: int, gap: float = 5e-4, max_columns: int = 5000
) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows) and how often each is used, fractional, to cover all counts exactly with few sequences.

    Stops when the total size or the dual values prove the number of sequences within ``gap``
    of the least; after ``max_columns`` the cover is whole all the same, only less tight.
    """
    patterns = np.diag((capacity // sizes).astype(float))
    inverse = np.diag(1 / np.diag(patterns))
    uses, bound = times_vector(inverse, counts), (counts * sizes).sum() / capacity
    for column in range(1, max_columns + 1):
        prices = inverse.sum(axis=0)
        worth, pattern = best_pattern(prices, sizes, capacity)
        # Prices divided by the best pattern's worth are feasible for the dual: a lower bound.
        bound = max(bound, (prices * counts).sum() / worth)
        if worth <= 1 + 1e-9 or uses.sum() <= (1 + gap) * bound:
            break
        change = times_vector(inverse, pattern)
        rows = np.flatnonzero(change > 1e-9)
        row = rows[(uses[rows] / change[rows]).argmin()]
        step = uses[row] / change[row]
        uses = np.maximum(uses - step * change, 0)
        uses[row], patterns[row] = step, pattern
        inverse[row] /= change[row]
        others = np.arange(len(sizes)) != row
        inverse[others] -= np.outer(change[others], inverse[row])
        if column % 100 == 0:
            inverse = inverted(patterns.T)
            uses = np.maximum(times_vector(inverse, counts), 0)
    return patterns.astype(int), uses


def round_patterns(
    patterns: np.ndarray, uses: np.ndarray, sizes: np.ndarray, counts: np.ndarray, least: float
) -> np.ndarray:
    """Whole uses that take no more than the counts: rounded down, then once more where enough rests are left.

    Patterns that fill less than ``least`` are not used: a cut costs less than their padding.
    """
    full = patterns @ sizes >= least
    uses = np.nan_to_num(uses, posinf=0.0)
    whole, left = np.zeros(len(uses), dtype=int), counts.copy()
    for ups in (0, 1):
        for p in np.argsort(-uses if not ups else whole - uses, kind="stable"):
            if not full[p] or uses[p] <= 1e-9:
                continue
            # No more than what is left, whatever rounding errors the program has.
            room = int((left[patterns[p] > 0] // patterns[p][patterns[p] > 0]).min())
            times = room if ups else min(room, int(min(uses[p] + 1e-6, room)))
            whole[p] += times
            left = left - times * patterns[p]
    return whole


# The plan -----------------------------------------------------------------------


@dataclass
class Plan:
    """Where the rest of each document goes.

    All rests are thought of in ascending order of length: ``before[r]`` rests are shorter
    than r.  ``starts`` cuts that order into entries; an entry is ``copies`` places of a
    pattern for each of its sequences, or, with pattern -1, a part of the stream that is cut.
    """

    length: int
    before: np.ndarray
    tokens_before: np.ndarray
    starts: np.ndarray
    pattern: np.ndarray
    copies: np.ndarray
    stream_at: np.ndarray
    times: np.ndarray
    first_sequence: np.ndarray
    stream_sequence: int
    stream_tokens: int

    @property
    def sequences(self) -> int:
        """Sequences of patterns and of the stream; numbers of full ones begin here."""
        return self.stream_sequence + self.stream_tokens // self.length + len(self.tail_edges()) - 1

    def tail_edges(self) -> np.ndarray:
        """Where the stream's last part, less than a sequence, is cut: into powers of two, which need no padding."""
        whole, rest = divmod(self.stream_tokens, self.length)
        edges = [whole * self.length]
        for bit in reversed(range(self.length.bit_length())):
            if rest >> bit & 1:
                edges.append(edges[-1] + (1 << bit))
        return np.array(edges, dtype=np.int64)

    def stream_part(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number, start, end) of the stream's sequence at each position."""
        tail = self.tail_edges()
        last = np.clip(np.searchsorted(tail, at, side="right") - 1, 0, len(tail) - 2) if len(tail) > 1 else np.zeros_like(at)
        ends = np.append(tail, tail[-1])[last + 1]
        number, inside = at // self.length, at >= tail[0]
        start = np.where(inside, tail[last], number * self.length)
        return np.where(inside, tail[0] // self.length + last, number), start, np.where(inside, ends, start + self.length)

    def rest_at(self, places: np.ndarray) -> np.ndarray:
        """Length of the rest at each place of the ascending order."""
        return np.searchsorted(self.before, places, side="right") - 1

    def stream_position(self, places: np.ndarray, entry: np.ndarray) -> np.ndarray:
        def tokens(at):
            rest = self.rest_at(at)
            return self.tokens_before[rest] + (at - self.before[rest]) * rest

        return self.stream_at[entry] + tokens(places) - tokens(self.starts[entry])

    def locate(self, rests: np.ndarray, ranks: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Pieces (document, start in the rest, length, sequence, offset) of some rests, group by group."""
        places = self.before[rests] + ranks
        entry = np.searchsorted(self.starts, places, side="right") - 1
        pattern = self.pattern[entry]
        for p in np.unique(pattern).tolist():
            docs = np.flatnonzero(pattern == p)
            if p < 0:
                yield from self._cut(docs, rests[docs], self.stream_position(places[docs], entry[docs]))
                continue
            times, within = self.times[p], places[docs] - self.starts[entry[docs]]
            copy, sequence = np.divmod(within, times)
            offset, filled = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
            for e in np.flatnonzero(self.pattern == p)[::-1].tolist():
                for c in range(int(self.copies[e])):
                    here = (entry[docs] == e) & (copy == c)
                    offset[here] = filled[here]
                    filled += self.rest_at(self.starts[e] + c * times + sequence)
            yield docs, np.zeros(len(docs), np.int64), rests[docs], self.first_sequence[p] + sequence, offset

    def _cut(self, docs: np.ndarray, rests: np.ndarray, position: np.ndarray):
        start = np.zeros(len(docs), np.int64)
        while len(docs):
            at = position + start
            part, begin, end = self.stream_part(at)
            length = np.minimum(rests - start, end - at)
            yield docs, start, length, self.stream_sequence + part, at - begin
            more = start + length < rests
            docs, rests, position, start = docs[more], rests[more], position[more], (start + length)[more]


def make_plan(histogram: dict[int, int], length: int, grain: int = 16, least_fill: float = 0.98) -> Plan:
    """Plan the rests of 1 to ``length`` - 1 tokens counted in ``histogram``.

    Lengths that agree when rounded up to ``grain`` are one class of the linear program, so a
    place of a pattern is at most ``grain`` - 1 tokens wider than its rest.  Rests that find no
    pattern filled to ``least_fill`` go to the stream, however many they are: their places in
    it follow from the histogram as well.
    """
    counts = np.zeros(length, dtype=np.int64)
    for rest, n in histogram.items():
        counts[rest] = n
    before = np.concatenate([[0], np.cumsum(counts)[:-1]])
    tokens_before = np.concatenate([[0], np.cumsum(counts * np.arange(length))[:-1]])
    kinds = -(-np.arange(length) // grain)
    per_class = np.bincount(kinds, weights=counts).astype(np.int64)
    sizes = np.flatnonzero(per_class)
    present = per_class[sizes]
    capacity = length // grain
    if len(sizes):
        patterns, uses = solve_patterns(sizes, present.astype(float), capacity)
        times = round_patterns(patterns, uses, sizes, present, least_fill * capacity)
    else:
        patterns, times = np.zeros((0, 0), int), np.zeros(0, int)
    first = np.concatenate([[0], np.cumsum(times)]).astype(np.int64)
    entries, stream = [], 0
    for i, size in enumerate(sizes.tolist()):
        at = int(before[(size - 1) * grain + 1])
        end = at + int(present[i])
        for p in np.flatnonzero((patterns[:, i] > 0) & (times > 0)).tolist():
            entries.append((at, p, int(patterns[p, i]), 0))
            at += int(patterns[p, i] * times[p])
        if at < end:
            entries.append((at, -1, 0, stream))
            rests = np.arange((size - 1) * grain + 1, min(size * grain + 1, length))
            taken = np.minimum(np.maximum(before[rests] + counts[rests] - at, 0), counts[rests])
            stream += int((taken * rests).sum())
    columns = [np.array(c, dtype=np.int64) for c in zip(*entries)] or [np.zeros(0, np.int64)] * 4
    return Plan(length, before, tokens_before, *columns, times, first, int(first[-1]), stream)


# On Spark -------------------------------------------------------------------------


def encoded(docs: DataFrame, tokenizer_path: str, length: int, end_id: int, id_column: str, text_column: str) -> DataFrame:
    """Every row's ids as little-endian numbers, its count, and its place among the rows of its task.

    ``nth`` counts the task's rows before with a rest of the same length, ``full_before`` its full sequences.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = encoder_of(tokenizer_path), TaskContext.get().partitionId()
        kind, end = id_type(encoder.tokenizer.get_vocab_size()), np.array([end_id], dtype="<u4").tobytes()
        seen, full = np.zeros(length, dtype=np.int64), 0
        for batch in batches:
            for at, ids, sizes in encoded_groups(encoder, batch.column(1), end):
                rests, whole = sizes % length, sizes // length
                order = np.argsort(rests, kind="stable")
                new = np.concatenate([[True], np.diff(rests[order]) != 0])
                run_start = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
                nth = np.empty(len(order), dtype=np.int64)
                nth[order] = np.arange(len(order)) - run_start + seen[rests[order]]
                seen += np.bincount(rests, minlength=length)
                edges = np.concatenate([[0], np.cumsum(sizes)]) * kind.itemsize
                data = pa.py_buffer(ids.astype(kind).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(sizes)),
                        pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(edges.astype(np.int32).tobytes()), data]),
                        pa.array(sizes, pa.int32()),
                        pa.array(np.full(len(sizes), part), pa.int32()),
                        pa.array(nth, pa.int32()),
                        pa.array(full + np.cumsum(whole) - whole, pa.int64()),
                    ],
                    names=["doc_id", "ids", "n_tokens", "part", "nth", "full_before"],
                )
                full += int(whole.sum())

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(run, _ENCODED)


def id_type(vocabulary: int) -> np.dtype:
    return np.dtype("<u2" if vocabulary <= 1 << 16 else "<u4")


def pack(
    docs: DataFrame, tokenizer_path: str, *, length: int = 2048, end_id: int = 1, grain: int = 16, digest: bool = False,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Pieces (doc_id, start, length, ids, doc_tokens, sequence_id, offset) of all rows of ``docs``.

    Each id of a row, its ``end_id`` included, lies in exactly one piece; the pieces of a
    sequence follow each other from offset 0.  A row has a piece per full sequence and one
    for its rest; only rests of the cut stream have more.  With ``digest`` the ids' unsigned
    crc32 as little-endian 32-bit numbers, ``ids_crc32``, stands in their place, computed
    where the ids are.  Null and empty texts are the end id alone; null ids and repeated rows
    are packed like all others; very long texts are cut into full sequences; an empty table
    gives no rows.  Other columns, whatever their names, have no part.  ``sequence_id`` is
    unique but leaves gaps.  A task's rows must fit 2 GB of ids per Arrow batch.
    """
    if length & (length - 1) or length < grain:
        raise ValueError("length must be a power of two and not below the grain")
    rows = stored(encoded(docs, tokenizer_path, length, end_id, id_column, text_column), "packing-ids")
    rest = (F.col("n_tokens") % length).alias("rest")
    # Per task and length: how many, and how many in the tasks before.  Windows hold one row per task.
    per_task = rows.groupBy("part", rest).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = stored(
        per_task.where("rest > 0").select("part", "rest", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")),
        "packing-bases",
    )
    histogram = {r["rest"]: r["n"] for r in bases.groupBy("rest").agg(F.sum("n").alias("n")).collect()}
    plan = make_plan(histogram, length, grain)
    # The planner broadcasts the bases only if their files are small.
    ranked = rows.withColumn("rest", rest).join(bases.drop("n"), ["part", "rest"], "left").select(
        "doc_id", "ids", "n_tokens", "rest", (F.col("nth") + F.coalesce("base", F.lit(0))).alias("rank"),
        (F.lit(plan.sequences) + F.shiftleft(F.col("part").cast("long"), _TASK_BITS) + F.col("full_before")).alias("full"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _pieces(batch, plan, digest)

    return ranked.mapInArrow(run, _PIECES.format("ids_crc32 long" if digest else "ids array<int>"))


def _pieces(batch: pa.RecordBatch, plan: Plan, digest: bool) -> pa.RecordBatch:
    sizes, rests, ranks, full = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (2, 3, 4, 5))
    whole = sizes // plan.length
    docs = np.repeat(np.arange(len(sizes)), whole)
    nth = np.arange(len(docs)) - np.repeat(np.cumsum(whole) - whole, whole)
    parts = [(docs, nth * plan.length, np.full(len(docs), plan.length), full[docs] + nth, np.zeros(len(docs), np.int64))]
    some = np.flatnonzero(rests)
    for which, start, length, sequence, offset in plan.locate(rests[some], ranks[some]):
        own = some[which]
        parts.append((own, whole[own] * plan.length + start, length, sequence, offset))
    docs, start, length, sequence, offset = (np.concatenate(c).astype(np.int64) for c in zip(*parts))
    column = batch.column(1)
    edges = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(sizes) + 1]
    data = memoryview(column.buffers()[2] or b"")[edges[0] : edges[-1]]
    kind = np.dtype(f"<u{(edges[-1] - edges[0]) // max(1, int(sizes.sum()))}")
    ids = np.frombuffer(data, dtype=kind).astype("<u4")
    first = (np.cumsum(sizes) - sizes)[docs] + start
    if digest:
        view = memoryview(ids).cast("B")
        content = pa.array([zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(first.tolist(), (first + length).tolist())], pa.int64())
    else:
        ends = np.cumsum(length)
        picked = ids[np.repeat(first - (ends - length), length) + np.arange(ends[-1])]
        content = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(picked.view("<i4")))
    arrays = [batch.column(0).take(pa.array(docs)), pa.array(start), pa.array(length), content]
    arrays += [pa.array(sizes[docs]), pa.array(sequence), pa.array(offset)]
    names = ["doc_id", "start", "length", "ids_crc32" if digest else "ids", "doc_tokens", "sequence_id", "offset"]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def sequences(pieces: DataFrame, length: int = 2048, pad_id: int = 0) -> DataFrame:
    """(sequence_id, ids, n_tokens) of packed pieces with their ids; padded to ``length``, except at a power of two.

    A sequence has at most ``length`` pieces, so no group is large.
    """
    grouped = pieces.groupBy("sequence_id").agg(
        F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])).alias("ids")
    )
    n = F.size("ids")
    padding = F.when(F.bit_count(n) == 1, F.lit(0)).otherwise(F.lit(length) - n)
    padded = F.concat("ids", F.array_repeat(F.lit(pad_id), padding))
    return grouped.select("sequence_id", padded.alias("ids"), n.alias("n_tokens"))
