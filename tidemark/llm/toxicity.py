"""Toxicity: a learned lexicon, matched by Levenshtein automata, weighed by context windows.

The lexicon holds words and word stems that labelled toxic texts use far more
often than others.  Automata of all its terms, one edit wide, are run side by
side over its trie and made deterministic as words come, so a word is read once
and dropped at the first letter no term allows.  Each hit is weighed by its
context window: inside quotation marks or not, alone or among other hits.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.session import ensure_checkpoint_dir

_WORD = re.compile(r"\w+")
#: Marks that open or close a quotation.
_QUOTES = re.compile('["“”„«»‹›]')
_STEM_LENGTHS = (4, 5, 6, 7)
#: Words before and after a hit that make its context.
CONTEXT = 10
N_FEATURES = 7


@dataclass(frozen=True)
class Term:
    text: str
    stem: bool
    weight: float

    @property
    def edits(self) -> int:
        """One edit is allowed where a term is long enough not to meet other words by it."""
        return int(len(self.text) >= (6 if self.stem else 5))


class Automaton:
    """Levenshtein automata of all terms on their trie, determinised on demand."""

    def __init__(self, terms: list[Term], max_states: int = 200_000):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[Term]] = [[]]
        self.reach = [0]
        self.max_states = max_states
        for term in terms:
            at = 0
            for letter in term.text:
                self.reach[at] = max(self.reach[at], term.edits)
                if letter not in self.children[at]:
                    self.children[at][letter] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.reach.append(0)
                at = self.children[at][letter]
            self.reach[at] = max(self.reach[at], term.edits)
            self.ends[at].append(term)
        self._forget()

    def _forget(self) -> None:
        self.numbers: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.words: list[tuple | None] = []
        self.stems: list[tuple | None] = []
        self.start = self._state({(0, 0)})

    def _state(self, pairs: set[tuple[int, int]]) -> int:
        """Number of the state of (trie node, edits so far), with letters a word may leave out; -1 if none."""
        stack = list(pairs)
        while stack:
            node, edits = stack.pop()
            for below in self.children[node].values():
                if edits + 1 <= self.reach[below] and (below, edits + 1) not in pairs:
                    pairs.add((below, edits + 1))
                    stack.append((below, edits + 1))
        if not pairs:
            return -1
        key = frozenset(pairs)
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
            for stem, best in ((False, self.words), (True, self.stems)):
                found = [(-e, t.weight, t.text) for n, e in key for t in self.ends[n] if t.stem == stem and e <= t.edits]
                best.append(max(found) if found else None)
        return number

    def _step(self, state: int, letter: str) -> int:
        pairs = set()
        for node, edits in self.sets[state]:
            below = self.children[node].get(letter)
            if below is not None and edits <= self.reach[below]:
                pairs.add((below, edits))
            if edits + 1 <= self.reach[node]:
                pairs.add((node, edits + 1))
            for other in self.children[node].values():
                if edits + 1 <= self.reach[other]:
                    pairs.add((other, edits + 1))
        return self._state(pairs)

    def match(self, word: str) -> tuple[int, float, str] | None:
        """(edits, weight, term) of the best term: fewest edits, then the heaviest."""
        if len(self.sets) > self.max_states:
            self._forget()
        state, best = self.start, None
        for letter in word:
            step = self.steps[state].get(letter)
            if step is None:
                step = self.steps[state][letter] = self._step(state, letter)
            state = step
            if state < 0:
                break
            if self.stems[state] and (best is None or self.stems[state] > best):
                best = self.stems[state]
        if state >= 0 and self.words[state] and (best is None or self.words[state] > best):
            best = self.words[state]
        return (-best[0], best[1], best[2]) if best else None


@dataclass
class Model:
    terms: list[Term] = field(default_factory=list)
    #: Words one edit from a term that clean texts use.
    exempt: frozenset = frozenset()
    coefficients: np.ndarray = field(default_factory=lambda: np.zeros(N_FEATURES))


class Matcher(dict):
    """Word to (weight, edits) or None, remembered up to a bound."""

    def __init__(self, model: Model, limit: int = 500_000):
        super().__init__()
        self.automaton, self.exempt, self.limit = Automaton(model.terms), model.exempt, limit

    def __missing__(self, word: str):
        if len(self) >= self.limit:
            self.clear()
        found = self.automaton.match(word)
        if found and found[0] and word in self.exempt:
            found = None
        value = self[word] = (found[1], found[0]) if found else None
        return value


def features(text: str | None, matcher: Matcher) -> np.ndarray:
    """What the hits of a text and their context windows say; zeros without hits."""
    out = np.zeros(N_FEATURES)
    out[0] = 1.0
    if not text:
        return out
    lower = text.lower()
    words = _WORD.findall(lower)
    hits = [(i, m) for i, m in enumerate(map(matcher.__getitem__, words)) if m]
    if not hits:
        return out
    places = [m.span() for m in _WORD.finditer(lower)]
    marks = np.array([m.start() for m in _QUOTES.finditer(lower)])
    exact = fuzzy = quoted = 0.0
    plain: list[tuple[int, float]] = []
    for i, (weight, edits) in hits:
        begin = places[max(0, i - CONTEXT)][0]
        end = places[min(len(places) - 1, i + CONTEXT)][1]
        before = np.count_nonzero((marks >= begin) & (marks < places[i][0]))
        after = np.count_nonzero((marks >= places[i][1]) & (marks < end))
        if before % 2 and after:
            quoted += weight
            continue
        plain.append((i, weight))
        if edits:
            fuzzy += weight
        else:
            exact += weight
    at, weights = np.array([i for i, _ in plain], dtype=np.int64), np.cumsum([0.0] + [w for _, w in plain])
    near = weights[np.searchsorted(at, at + CONTEXT, side="right")] - weights[np.searchsorted(at, at - CONTEXT)]
    crowd = float(near.max()) if len(near) else 0.0
    out[1:] = (
        np.log1p(exact), np.log1p(fuzzy), np.log1p(quoted), np.log1p(crowd),
        np.log1p(100.0 * (exact + fuzzy) / len(words)), float(bool(plain)),
    )
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 40) -> np.ndarray:
    """Penalised logistic regression by Newton steps; the first column is the constant."""
    b = np.zeros(x.shape[1])
    penalty = np.full(len(b), ridge)
    penalty[0] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - penalty * b
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, gradient)
        b = b + step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return b


def _counts(sample: DataFrame, stems: bool) -> DataFrame:
    """(term, toxic, clean): texts of either label with the word, or with words that start with the stem."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = (Counter(), Counter())
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = set(_WORD.findall((text or "").lower()))
                if stems:
                    words = {w[:n] for w in words for n in _STEM_LENGTHS if len(w) > n}
                seen[int(toxic)].update(words)
            terms = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(terms, pa.string()),
                    pa.array([seen[1][t] for t in terms], pa.int64()),
                    pa.array([seen[0][t] for t in terms], pa.int64()),
                ],
                names=["term", "toxic", "clean"],
            )

    counted = sample.select("text", "toxic").mapInArrow(count, "term string, toxic long, clean long")
    return counted.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _evidence(n_toxic: int, n_clean: int) -> tuple[Column, Column]:
    """Log odds ratio of a term's rates, and twice its log likelihood ratio."""
    a, b = F.col("toxic").cast("double"), F.col("clean").cast("double")
    odds = F.log((a + 0.5) / (n_toxic + 1)) - F.log((b + 0.5) / (n_clean + 1))
    share = n_toxic / max(1, n_toxic + n_clean)
    grow = F.when(a > 0, a * F.log(a / ((a + b) * share))).otherwise(0.0)
    fall = F.when(b > 0, b * F.log(b / ((a + b) * (1 - share)))).otherwise(0.0)
    return odds, 2 * (grow + fall)


def train(
    docs: DataFrame, labels: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "toxic", fit_rows: int = 20_000,
    min_texts: int = 5, min_gain: float = 25.0, min_odds: float = 2.5,
) -> Model:
    """Learn the lexicon and the weights from at most ``fit_rows`` labelled texts.

    Half of them at most are of either label, drawn by a hash of the id; the
    constant is set for the shares among all labelled rows.  All terms of those texts that
    pass the thresholds make the lexicon, and all their clean words that come within an edit
    of it are exempt; the sample bounds both.  An id with several labels is
    toxic if one says so; labels other than 0 and 1, and null ids, teach nothing.  Without texts
    of both labels the model has no terms and gives the share of label 1.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    known = (
        labels.where(F.col(label_column).isin(0, 1) & F.col(id_column).isNotNull())
        .groupBy(F.col(id_column).cast("long").alias("id"))
        .agg(F.max(label_column).alias("toxic"))
    )
    totals = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    n_toxic, n_clean = totals.get(1, 0), totals.get(0, 0)
    if not n_toxic or not n_clean:
        coefficients = np.zeros(N_FEATURES)
        coefficients[0] = 8.0 if n_toxic else -8.0
        return Model(coefficients=coefficients)
    drawn = None
    for label in (0, 1):
        part = known.where(F.col("toxic") == label).orderBy(F.xxhash64("id"), "id").limit(fit_rows // 2)
        drawn = part if drawn is None else drawn.union(part)
    sample = (
        docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
        .join(F.broadcast(drawn), "id")  # at most fit_rows ids
        .groupBy("id")
        .agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
        .repartition(12)
        .checkpoint()
    )
    used = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not used.get(0) or not used.get(1):
        coefficients = np.zeros(N_FEATURES)
        coefficients[0] = np.log(n_toxic / n_clean)
        return Model(coefficients=coefficients)
    odds, gain = _evidence(used[1], used[0])
    strong = (F.col("toxic") >= min_texts) & (gain >= min_gain) & (odds >= min_odds)
    words = _counts(sample, stems=False).checkpoint()
    stems = _counts(sample, stems=True).where(strong)
    # A stem is one only if several words share it.
    shared = words.select(F.explode(F.array(*[F.when(F.length("term") > n, F.substring("term", 1, n)) for n in _STEM_LENGTHS])).alias("term"))
    stems = stems.join(shared.groupBy("term").agg(F.count("*").alias("n")).where("n >= 4"), "term", "left_semi")
    pick = lambda df, stem: [
        Term(r.term, stem, float(r.odds))
        for r in df.select("term", odds.alias("odds"), gain.alias("gain")).orderBy(F.desc("gain"), "term").collect()
    ]
    terms = pick(words.where(strong & (F.length("term") >= 3)), False) + pick(stems, True)
    automaton = Automaton(terms)

    @F.pandas_udf("int")
    def edits(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            found = (automaton.match(w) for w in batch)
            yield pd.Series([m[0] if m else -1 for m in found], dtype="int32")

    near = words.where((F.col("clean") > 0) & (odds < min_odds)).where(edits("term") > 0)
    exempt = frozenset(r.term for r in near.select("term").collect())
    model = Model(terms, exempt)
    rows = sample.select("toxic", _features_udf(model)(F.col("text")).alias("x")).collect()  # at most fit_rows
    x, y = np.array([r.x for r in rows]), np.array([float(r.toxic) for r in rows])
    scale = {1: n_toxic / used[1], 0: n_clean / used[0]}
    weight = np.where(y == 1, scale[1], scale[0])
    model.coefficients = fit_logistic(x, y, weight * len(y) / weight.sum())
    return model


def _features_udf(model: Model):
    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(model)
        for texts in batches:
            yield pd.Series([features(t, matcher) for t in texts])

    return run


def toxicity(text: Column | str, model: Model) -> Column:
    """Score of a text column from 0 to 1; a text without hits, null and empty ones too, has the score of none."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(model)
        for texts in batches:
            z = np.array([features(t, matcher) @ model.coefficients for t in texts], dtype=float)
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    return score(text)


def not_held_out(id_column: str = "doc_id") -> Column:
    """Rows that may teach: those whose id's crc32, as text, leaves no remainder 1 by 3."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 3 != 1, F.lit(True))


def scored(
    docs: DataFrame, labels: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
    threshold: float = 0.7, **options,
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row.

    Labels teach only where the id is not held out.  Repeated rows get equal
    scores; a null id is scored and not held out.
    """
    model = train(
        docs, labels.where(not_held_out(id_column)), id_column=id_column, text_column=text_column, **options
    )
    return docs.select(
        F.col(id_column).alias("doc_id"),
        (~not_held_out(id_column)).alias("held_out"),
        toxicity(F.col(text_column), model).alias("score"),
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
