"""Secret scans: fixed patterns, and automata inferred from the credentials they find.

Values of each kind of pattern in all texts label credentials.  Spark counts their
prefix tree; states whose outcomes agree statistically are merged into a probabilistic
automaton, whose weights then are counted over all values again.  Another one is inferred
from ordinary tokens.  Every other token of every text is scored by how much likelier a
credential's format makes it.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import accumulate
from math import log, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.session import ensure_checkpoint_dir

#: The kinds of the patterns, in the order that spans with one start are listed.
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(
    r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A
)
_KEYWORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
# A run that is long enough is found at its start, so its least length can be part of the pattern.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_TOKEN = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{12,}")
_LEARNED = "learned"
_BACKGROUND = "ordinary"

#: Classes of letters; a letter's likelihood is its class's, shared by the class.
_CLASSES = ("0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", "+/", "_-", ".", "=")
_CLASS_OF = {c: i for i, letters in enumerate(_CLASSES) for c in letters}
_LOG_SIZE = [log(len(x)) for x in _CLASSES]
_N = len(_CLASSES)


def base_matches(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) by start, then kind as listed: leftmost matches that don't overlap, per kind."""
    found = []
    lower = text.lower()
    if any(k in lower for k in _KEYWORDS):
        found += [(*m.span(), "assign", m[1]) for m in _ASSIGN.finditer(text) if len(m[1]) >= 12]
    found += [(*m.span(), "access", m[0]) for m in _ACCESS.finditer(text)]
    found += [(*m.span(), "hex", m[0]) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


class Automaton:
    """A probabilistic automaton over classes of letters, inferred by merging prefix-tree states."""

    def __init__(self, words: list[str], alpha: float = 0.05):
        self.next: list[list[int]] = []
        self.count: list[list[int]] = []
        self.end: list[int] = []
        self._new()
        for word in words:
            at = 0
            for letter in word:
                c = _CLASS_OF[letter]
                self.count[at][c] += 1
                if self.next[at][c] < 0:
                    self.next[at][c] = self._new()
                at = self.next[at][c]
            self.end[at] += 1
        self._bound = sqrt(0.5 * log(2 / alpha))
        self._merge_states()
        self._weigh()

    @classmethod
    def of_tree(cls, nodes: dict[str, list[int]], alpha: float = 0.05) -> Automaton:
        """From a counted prefix tree: per prefix of classes, how many values go on with each class, and how many end.

        What lies below the tree is too rare to tell states apart; :meth:`reweigh` then counts every value whole.
        """
        made = cls([], alpha)
        at = {"": 0}
        for prefix in sorted(nodes, key=len):
            if prefix not in at:
                if prefix[:-1] not in at:
                    continue
                at[prefix] = made.next[at[prefix[:-1]]][int(prefix[-1])] = made._new()
            made.count[at[prefix]], made.end[at[prefix]] = list(nodes[prefix][:_N]), nodes[prefix][_N]
        made._merge_states()
        made._weigh()
        return made

    def walk(self, word: str, counts: dict[int, list[int]]) -> None:
        """Add a value's steps and its end to ``counts``; a step out of the tree goes back to the start."""
        at = 0
        for letter in word:
            c = _CLASS_OF[letter]
            counts.setdefault(at, [0] * (_N + 1))[c] += 1
            at = max(0, self.next[at][c])
        counts.setdefault(at, [0] * (_N + 1))[_N] += 1

    def reweigh(self, counts: dict[int, list[int]]) -> None:
        """Take the counts of all values' steps; a step that only rare or long values take goes back to the start too."""
        for q in self.states:
            found = counts.get(q, [0] * (_N + 1))
            self.count[q], self.end[q] = list(found[:_N]), found[_N]
            self.next[q] = [0 if n and to < 0 else to for n, to in zip(self.count[q], self.next[q])]
        self._weigh()

    def _new(self) -> int:
        self.next.append([-1] * _N)
        self.count.append([0] * _N)
        self.end.append(0)
        return len(self.end) - 1

    def _total(self, q: int) -> int:
        return self.end[q] + sum(self.count[q])

    def _alike(self, p: int, q: int) -> bool:
        """Whether all outcomes below two states agree within Hoeffding's bound."""
        stack = [(p, q)]
        while stack:
            p, q = stack.pop()
            m, n = self._total(p), self._total(q)
            if not m or not n:
                continue
            bound = self._bound * (1 / sqrt(m) + 1 / sqrt(n))
            if abs(self.end[p] / m - self.end[q] / n) > bound:
                return False
            for c in range(_N):
                if abs(self.count[p][c] / m - self.count[q][c] / n) > bound:
                    return False
                if self.next[p][c] >= 0 and self.next[q][c] >= 0 and self.next[p][c] != self.next[q][c]:
                    stack.append((self.next[p][c], self.next[q][c]))
        return True

    def _fold(self, into: int, tree: int) -> None:
        """Add a subtree's counts to a state and to those it leads to."""
        stack = [(into, tree)]
        while stack:
            p, q = stack.pop()
            self.end[p] += self.end[q]
            for c in range(_N):
                self.count[p][c] += self.count[q][c]
                if self.next[q][c] >= 0:
                    if self.next[p][c] < 0:
                        self.next[p][c] = self.next[q][c]
                    else:
                        stack.append((self.next[p][c], self.next[q][c]))

    def _merge_states(self) -> None:
        kept = [0]
        settled = {0}
        while True:
            fringe = [(p, c) for p in kept for c in range(_N) if self.next[p][c] >= 0 and self.next[p][c] not in settled]
            if not fringe:
                break
            p, c = max(fringe, key=lambda x: self._total(self.next[x[0]][x[1]]))
            q = self.next[p][c]
            for other in kept:
                if self._alike(other, q):
                    self.next[p][c] = other
                    self._fold(other, q)
                    break
            else:
                kept.append(q)
                settled.add(q)
        self.states = kept

    def _weigh(self, smooth: float = 0.2) -> None:
        self.log = {}
        for q in self.states:
            n = self._total(q) + smooth * (_N + 1)
            self.log[q] = [log((self.count[q][c] + smooth) / n) - _LOG_SIZE[c] for c in range(_N)], log((self.end[q] + smooth) / n)
        self.unseen = [-log(_N + 1) - size for size in _LOG_SIZE]

    def likelihood(self, word: str) -> float:
        """Log likelihood of a word; after a step the sample never took, every class is as likely."""
        at, total = 0, 0.0
        for letter in word:
            c = _CLASS_OF[letter]
            total += self.log[at][0][c] if at >= 0 else self.unseen[c]
            at = self.next[at][c] if at >= 0 else -1
        return total + (self.log[at][1] if at >= 0 else -log(_N + 1))


@dataclass
class Formats:
    """Automata of the credentials' kinds, that of ordinary tokens, and the gain a letter that tells them apart."""

    kinds: dict[str, Automaton] = field(default_factory=dict)
    ordinary: Automaton | None = None
    threshold: float = float("inf")

    def gain(self, token: str) -> float:
        """How much likelier, per letter, the best kind makes a token."""
        if not self.kinds or self.ordinary is None:
            return float("-inf")
        return (max(a.likelihood(token) for a in self.kinds.values()) - self.ordinary.likelihood(token)) / len(token)


def _tokens(text: str, base: list[tuple[int, int, str, str]]) -> Iterator[tuple[int, int, str]]:
    """Tokens of 12 letters or more that no match of a pattern overlaps."""
    at, reach = 0, 0
    for m in _TOKEN.finditer(text):
        while at < len(base) and base[at][0] < m.end():
            reach = max(reach, base[at][1])
            at += 1
        if reach <= m.start():
            yield m.start(), m.end(), m[0]


def sample_values(
    docs: DataFrame, text_column: str = "text", size: int = 600, longest: int = 4096, letters: int = 300_000
) -> dict[str, list[str]]:
    """Per kind, and of ordinary tokens, the ``size`` distinct values with the smallest hashes over all texts.

    A task passes on at most ``size`` values of each.  Values are kept whole, as a cut would
    teach an end that is none: those of over ``longest`` letters teach nothing, and the last ones are
    left out where all would have over ``letters`` letters.
    """
    ensure_checkpoint_dir(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[str, dict[int, str]] = {k: {} for k in (*KINDS, _BACKGROUND)}
        for batch in batches:
            for text in batch.column(0):
                text = text.as_py()
                if not text:
                    continue
                base = base_matches(text)
                found = [(kind, value) for _, _, kind, value in base]
                found += [(_BACKGROUND, token) for _, _, token in _tokens(text, base)]
                for kind, value in found:
                    if len(value) <= longest:
                        least[kind][xxhash.xxh64_intdigest(value.encode(), 7)] = value
                for kind, values in least.items():
                    if len(values) > 4 * size:
                        least[kind] = {h: values[h] for h in heapq.nsmallest(size, values)}
        rows = [(k, h >> 1, v[h]) for k, v in least.items() for h in heapq.nsmallest(size, v)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.string())],
            names=["kind", "place", "value"],
        )

    rows = docs.select(F.col(text_column)).mapInArrow(run, "kind string, place long, value string").distinct().checkpoint()
    samples = {}
    for kind in (*KINDS, _BACKGROUND):
        drawn = [r.value for r in rows.where(F.col("kind") == kind).orderBy("place", "value").limit(size).collect()]
        samples[kind] = [value for value, total in zip(drawn, accumulate(map(len, drawn))) if total <= letters]
    return samples


def infer_formats(samples: dict[str, list[str]], false_share: float = 0.001) -> Formats:
    """Automata of the sampled kinds; the threshold leaves ``false_share`` of ordinary tokens above it."""
    kinds = {k: Automaton(samples[k]) for k in KINDS if samples.get(k)}
    ordinary = samples.get(_BACKGROUND)
    if not kinds or not ordinary:
        return Formats(kinds, Automaton(ordinary) if ordinary else None)
    formats = Formats(kinds, Automaton(ordinary))
    gains = np.array([formats.gain(t) for t in ordinary])
    own = np.array([formats.gain(v) for k in kinds for v in samples[k]])
    above = float(np.quantile(gains, 1 - false_share))
    formats.threshold = max(0.05, above + 0.25 * max(0.0, float(np.median(own)) - above))
    return formats


def _counted(rows: DataFrame, keys: str, count: Callable[[str, str, dict], None]) -> DataFrame:
    """Counts of classes and ends by (kind, place) over all values, added up by Spark."""
    names = [f"n{i}" for i in range(_N + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple, list[int]] = {}
            for kind, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                count(kind, value, found)
            columns = [pa.array([k for k, _ in found], pa.string()), pa.array([p for _, p in found])]
            columns[1] = columns[1].cast(pa.string() if keys == "string" else pa.int64())
            columns += [pa.array([n[i] for n in found.values()], pa.int64()) for i in range(_N + 1)]
            yield pa.RecordBatch.from_arrays(columns, names=["kind", "place", *names])

    counted = rows.mapInArrow(run, f"kind string, place {keys}, " + ", ".join(f"{n} long" for n in names))
    return counted.groupBy("kind", "place").agg(*[F.sum(n).alias(n) for n in names])


def _count_prefixes(depth: int) -> Callable[[str, str, dict], None]:
    def count(kind: str, value: str, found: dict) -> None:
        path = "".join([str(_CLASS_OF[letter]) for letter in value[:depth]])
        for i, c in enumerate(path):
            found.setdefault((kind, path[:i]), [0] * (_N + 1))[int(c)] += 1
        if len(value) < depth:
            found.setdefault((kind, path), [0] * (_N + 1))[_N] += 1

    return count


def all_values(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """(kind, value): every distinct value of each kind, and every distinct ordinary token, of all texts, whole."""
    ensure_checkpoint_dir(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = set()
            for text in batch.column(0).to_pylist():
                if text:
                    base = base_matches(text)
                    found.update((kind, value) for _, _, kind, value in base)
                    found.update((_BACKGROUND, token) for _, _, token in _tokens(text, base))
            rows = list(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string())], names=["kind", "value"]
            )

    return docs.select(F.col(text_column)).mapInArrow(run, "kind string, value string").distinct().checkpoint()


def learn_formats(values: DataFrame, false_share: float = 0.001, nodes: int = 600, depth: int = 64) -> Formats:
    """Automata of ``values(kind, value)``, one of each kind, and the threshold that leaves ``false_share`` of all ordinary tokens above it.

    All values count.  States are told apart on the prefixes of up to ``depth`` letters that at least one in
    ``nodes`` values of the kind has, so what the driver holds does not grow with the values; weights come from
    all letters of all values, and the threshold from the gains of all ordinary tokens (its rank is right to one
    in 100,000 of them).
    """
    totals = {r["kind"]: r["n"] for r in values.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not totals:
        return Formats()
    least = F.coalesce(*[F.when(F.col("kind") == k, F.lit(max(1, n // nodes))) for k, n in totals.items()])
    passing = sum((F.col(f"n{i}") for i in range(1, _N + 1)), F.col("n0"))
    trees: dict[str, dict[str, list[int]]] = {k: {} for k in totals}
    for kind, prefix, *counts in _counted(values, "string", _count_prefixes(depth)).where(passing >= least).collect():
        trees[kind][prefix] = counts
    automata = {k: Automaton.of_tree(tree) for k, tree in trees.items()}

    def steps(kind: str, value: str, found: dict) -> None:
        walked: dict[int, list[int]] = {}
        automata[kind].walk(value, walked)
        for q, counts in walked.items():
            known = found.setdefault((kind, q), [0] * (_N + 1))
            known[:] = [a + b for a, b in zip(known, counts)]

    weights: dict[str, dict[int, list[int]]] = {k: {} for k in totals}
    for kind, q, *counts in _counted(values, "long", steps).collect():
        weights[kind][q] = counts
    for kind, automaton in automata.items():
        automaton.reweigh(weights[kind])
    formats = Formats({k: automata[k] for k in KINDS if k in automata}, automata.get(_BACKGROUND))
    if not formats.kinds or formats.ordinary is None:
        return formats

    @F.pandas_udf("double")
    def gain(tokens: pd.Series) -> pd.Series:
        return tokens.map(formats.gain).astype("float64")

    ordinary = F.col("kind") == _BACKGROUND
    gains = values.select(ordinary.alias("ordinary"), gain("value").alias("gain"))
    above, own = gains.agg(
        F.percentile_approx(F.when(F.col("ordinary"), F.col("gain")), 1 - false_share, 100_000),
        F.percentile_approx(F.when(~F.col("ordinary"), F.col("gain")), 0.5, 100_000),
    ).first()
    formats.threshold = max(0.05, above + 0.25 * max(0.0, own - above))
    return formats


def find_spans(text: str | None, formats: Formats) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the patterns' matches, and of learned formats elsewhere, by start."""
    if not text:
        return []
    base = base_matches(text)
    spans = [(kind, start, end) for start, end, kind, _ in base]
    spans += [
        (_LEARNED, start, end) for start, end, token in _tokens(text, base) if formats.gain(token) > formats.threshold
    ]
    place = {k: i for i, k in enumerate((*KINDS, _LEARNED))}
    return sorted(spans, key=lambda s: (s[1], place[s[0]]))


def secret_spans(text: Column | str, formats: Formats) -> Column:
    """Spans of a text column, code points with the end exclusive; null and empty texts have none."""

    @F.pandas_udf("array<struct<kind:string,start:int,end:int>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([
                [{"kind": k, "start": a, "end": b} for k, a, b in find_spans(t, formats)] for t in texts
            ])

    return run(text)


def scan(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, spans) of every row: the patterns' matches stay, the inferred formats add to them.

    The formats are inferred from all distinct values of all texts, so repeated rows don't weigh more.
    Repeated rows and null ids come out as they went in.
    """
    formats = learn_formats(all_values(docs, text_column))
    return docs.select(F.col(id_column).alias("doc_id"), secret_spans(F.col(text_column), formats).alias("spans"))
