"""Quality by hierarchical empirical Bayes: a text's own evidence, its path's, its host's and the corpus's.

A logistic classifier reads each text alone.  Hosts and the paths below them
have posteriors of their mean quality, shrunk towards the level above by as many
pseudo documents as the spread between sites calls for; a sparse site is worth
little more than its parent.  Sites are summed by grouped aggregation, and a
text's odds are moved by those of its path.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.toxicity import fit_logistic
from tidemark.session import ensure_checkpoint_dir

_N = 13
_MARK = re.compile(r"[^\w\s]")
_DIGIT = re.compile(r"\d")
_CLIP = 6.0


def signals(text: str | None) -> list[float]:
    """How a text looks: length, repetition, marks, digits, letter case; zeros if it has no words."""
    words = text.split() if text else []
    if not words:
        return [0.0] * _N
    n, chars = len(words), len(text)
    counts = Counter(words)
    pairs = Counter(zip(words, words[1:]))
    lines = [x for x in text.split("\n") if x.strip()]
    top = counts.most_common(1)[0][1]
    return [
        float(np.log1p(n)),
        chars / n / 10.0,
        len(counts) / n,
        top / n,
        (max(pairs.values()) / len(pairs)) if pairs else 1.0,
        1.0 - len(set(lines)) / max(1, len(lines)),
        float(np.log1p(len(lines))),
        len(_MARK.findall(text)) / chars * 10.0,
        len(_DIGIT.findall(text)) / chars * 10.0,
        sum(w.isupper() for w in words) / n,
        sum(w.istitle() for w in words) / n,
        text.count("|") / chars * 10.0,
        sum(not w[:1].isalpha() for w in words) / n,
    ]


@dataclass
class Classifier:
    mean: np.ndarray
    spread: np.ndarray
    coefficients: np.ndarray

    def odds(self, rows: list[list[float]]) -> np.ndarray:
        x = (np.array(rows, dtype=float).reshape(-1, _N) - self.mean) / self.spread
        x = np.hstack([np.ones((len(x), 1)), x, x**2])
        return np.clip(x @ self.coefficients, -_CLIP, _CLIP)


def train_classifier(
    docs: DataFrame, labels: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "quality", fit_rows: int = 20_000,
) -> Classifier:
    """Fit on at most ``fit_rows`` labelled texts, drawn by a hash of the id.

    Labels other than 0 and 1 and null ids teach nothing; an id with several labels has the lowest.
    Without labels every text has even odds.
    """
    known = (
        labels.where(F.col(label_column).isin(0, 1) & F.col(id_column).isNotNull())
        .groupBy(F.col(id_column).cast("long").alias("id"))
        .agg(F.min(label_column).alias("y"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(fit_rows)
    )
    sample = (
        docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
        .join(F.broadcast(known), "id")  # at most fit_rows ids
        .groupBy("id")
        .agg(F.min("text").alias("text"), F.max("y").alias("y"))
    )

    @F.pandas_udf("array<double>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([signals(t) for t in texts])

    rows = sample.select("y", run("text").alias("x")).collect()  # numbers of at most fit_rows texts
    if not rows:
        return Classifier(np.zeros(_N), np.ones(_N), np.zeros(2 * _N + 1))
    x, y = np.array([r.x for r in rows]), np.array([float(r.y) for r in rows])
    model = Classifier(x.mean(axis=0), x.std(axis=0) + 1e-6, np.zeros(2 * _N + 1))
    z = (x - model.mean) / model.spread
    model.coefficients = fit_logistic(np.hstack([np.ones((len(z), 1)), z, z**2]), y, np.ones(len(y)))
    return model


def text_odds(text: Column | str, model: Classifier) -> Column:
    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.odds([signals(t) for t in texts]))

    return run(text)


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _prior_size(sites: DataFrame, parent: str) -> float:
    """Pseudo documents of the level above, from the spread of site means beyond what chance gives.

    ``sites`` has n, mean and the parent's mean.  One row of sums reaches the driver.
    """
    p = F.col(parent)
    row = sites.where("n > 0").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * (F.col("mean") - p) ** 2).alias("between"),
        F.sum(p * (1 - p)).alias("chance"),
        F.sum(F.col("n") * p * (1 - p)).alias("all"),
    ).first()
    if not row or not row.n or not row["all"]:
        return 1.0
    extra = max(0.0, (row.between - row.chance) / row["all"])  # variance of sites over that of one text
    return float(min(1e6, max(1.0, 1.0 / extra - 1.0))) if extra > 0 else 1e6


def quality_scores(
    docs: DataFrame, labels: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
    host: str = "source", path: str = "lang", threshold: float = 0.5, **options,
) -> DataFrame:
    """(doc_id, text_score, host_quality, path_quality, score, keep) of every row.

    ``text_score`` is the classifier's alone; ``score`` moves its odds by those of the
    path's posterior against the corpus mean.  A path is a host's rows with one
    value of ``path``.  Null hosts and paths are sites like any other; null and
    empty texts are scored as texts without words; repeated rows count as they come.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    model = train_classifier(docs, labels, id_column=id_column, text_column=text_column, **options)
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        F.col(host).cast("string").alias("host"),
        F.col(path).cast("string").alias("path"),
        text_odds(F.col(text_column), model).alias("odds"),
    ).withColumn("text_score", 1 / (1 + F.exp(-F.col("odds")))).checkpoint()
    paths = rows.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("text_score").alias("good")).checkpoint()
    total = paths.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    mean = min(1 - 1e-6, max(1e-6, (total.good or 0.0) / total.n)) if total.n else 0.5
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).select(
        F.col("host").alias("of_host"), "n", (F.col("good") / F.col("n")).alias("mean"), F.lit(mean).alias("corpus")
    )
    strength = _prior_size(hosts, "corpus")
    hosts = hosts.select(
        "of_host", ((F.col("n") * F.col("mean") + strength * mean) / (F.col("n") + strength)).alias("host_quality")
    )
    paths = paths.join(hosts, F.col("host").eqNullSafe(F.col("of_host"))).select(
        F.col("host").alias("of_host"), F.col("path").alias("of_path"), "n", "good",
        (F.col("good") / F.col("n")).alias("mean"), "host_quality",
    )
    strength = _prior_size(paths, "host_quality")
    posterior = (F.col("good") + strength * F.col("host_quality")) / (F.col("n") + strength)
    paths = paths.select("of_host", "of_path", "host_quality", posterior.alias("path_quality"))
    at = F.col("host").eqNullSafe(F.col("of_host")) & F.col("path").eqNullSafe(F.col("of_path"))
    inside = lambda p: F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    moved = F.col("odds") + _logit(inside(F.col("path_quality"))) - float(np.log(mean / (1 - mean)))
    return (
        rows.join(paths, at)
        .withColumn("score", 1 / (1 + F.exp(-moved)))
        .select("doc_id", "text_score", "host_quality", "path_quality", "score", (F.col("score") >= threshold).alias("keep"))
    )
