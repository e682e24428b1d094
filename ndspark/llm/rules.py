"""Quality classifier: a sparse ensemble of rules over text statistics.

Boosted trees over a bounded labelled sample (``SAMPLE`` documents at most, by the order of a hash) yield
paths; each path is a rule, a conjunction of conditions on statistics. A lasso logistic regression over the
rules keeps few of them, and the score is compiled into Spark columns, so that scoring runs inside the JVM
with no Python.

Cases: a null or empty text has all statistics 0 and is scored like any other; without labels of both
kinds the score is the share of ones (1 without labels, so that nothing is rejected); rows that repeat
get equal scores; of labelled rows that share an id one is learned from; texts have any length, and words above
``LONGEST`` characters count as that long; empty tables give no rows; ``judge`` reads no other columns.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ndspark.llm.common import SPACE, fold, let, word_array
from ndspark.llm.outliers import dup_lines
from ndspark.llm.sample import labelled_sample
from ndspark.llm.trees import boost, lasso_logistic, log_loss

SAMPLE = 8_000
LONGEST = 200
PENALTIES = (0.03, 0.01, 0.003, 0.001)
STATISTICS = ("log_words", "word_chars", "distinct", "adjacent", "symbols", "shouts", "capitals", "digits", "dup_lines", "longest")


def statistics(text: Column) -> Column:
    """Struct of STATISTICS of a text."""
    text = F.coalesce(text, F.lit(""))

    def of(w: Column) -> Column:
        n = F.greatest(F.size(w), F.lit(1)).cast("double")
        adjacent = F.size(F.filter(w, lambda x, i: x == F.get(w, i + 1)))
        chars = F.greatest(F.length(text), F.lit(1)).cast("double")
        left = lambda pattern: F.length(text) - F.length(F.regexp_replace(text, pattern, ""))
        return F.struct(
            F.log1p(F.size(w).cast("double")).alias("log_words"),
            (F.length(F.regexp_replace(text, SPACE, "")) / n).alias("word_chars"),
            (F.size(F.array_distinct(w)) / n).alias("distinct"),
            (adjacent / n).alias("adjacent"),
            (left("[#*$%&|<>]") / n).alias("symbols"),
            (left("!") / n).alias("shouts"),
            (left("[A-Z]") / chars).alias("capitals"),
            (left("[0-9]") / chars).alias("digits"),
            (dup_lines(text) / n).alias("dup_lines"),
            F.least(F.coalesce(F.array_max(F.transform(w, F.length)), F.lit(0)), F.lit(LONGEST)).cast("double").alias("longest"),
        )

    return let(word_array(text), of)


@dataclass
class Rules:
    """score = 1 / (1 + exp(-(intercept + sum of the weights of the rules that hold)))."""

    intercept: float
    weights: list[tuple[float, tuple[tuple[int, bool, float], ...]]]

    def column(self, stats: str) -> Column:
        z = F.lit(self.intercept)
        for w, rule in self.weights:
            holds = None
            for f, at_most, t in rule:
                c = F.col(f"{stats}.{STATISTICS[f]}")
                one = (c <= t) if at_most else (c > t)
                holds = one if holds is None else holds & one
            z = z + F.when(holds, F.lit(w)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))

    def text(self) -> list[str]:
        """The rules as one reads them."""
        return [f"{w:+.3f} if " + " and ".join(f"{STATISTICS[f]} {'<=' if m else '>'} {t:.4g}" for f, m, t in rule) for w, rule in self.weights]


def holds(x: np.ndarray, rule: tuple[tuple[int, bool, float], ...]) -> np.ndarray:
    out = np.ones(len(x), bool)
    for f, at_most, t in rule:
        out &= (x[:, f] <= t) if at_most else (x[:, f] > t)
    return out


def ensemble(x: np.ndarray, y: np.ndarray) -> Rules:
    """Rules of boosted trees, weighed by the lasso; the penalty is the largest within 2 % of the least held-out loss."""
    if len(set(y.tolist())) < 2:
        share = float(np.clip(y.mean() if len(y) else 1.0, 1e-3, 1 - 1e-3))
        return Rules(float(np.log(share / (1 - share))), [])
    trees = boost(x, y, rounds=25, depth=3, rate=0.3)
    rules = sorted({tuple(sorted(p)) for t in trees.trees for p in t.paths()})
    on = np.stack([holds(x, r) for r in rules], 1)
    first: dict[bytes, int] = {}
    for k in range(on.shape[1]):  # of rules that hold for the same rows, the first
        if 0 < on[:, k].sum() < len(x):
            first.setdefault(on[:, k].tobytes(), k)
    kept = sorted(first.values())
    if not kept:
        return Rules(float(np.log(y.mean() / (1 - y.mean()))), [])
    on = on[:, kept].astype(float)
    test = np.arange(len(x)) % 4 == 0
    losses = {}
    for penalty in PENALTIES:
        b, w = lasso_logistic(on[~test], y[~test], penalty)
        losses[penalty] = log_loss(on[test] @ w + b, y[test])
    penalty = next(p for p in PENALTIES if losses[p] <= 1.02 * min(losses.values()) + 1e-3)
    b, w = lasso_logistic(on, y, penalty)
    return Rules(b, [(float(w[k]), rules[kept[k]]) for k in np.flatnonzero(np.abs(w) > 1e-4)])


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> Rules:
    sample = labelled_sample(docs, labels, "quality", rows)
    stats = F.array(*(F.col(f"s.{s}") for s in STATISTICS))
    data = sample.select("doc_id", "y", statistics(F.col("text")).alias("s")).select("doc_id", "y", stats.alias("x")).collect()
    data.sort(key=lambda r: (r["doc_id"] * 2654435761 % (1 << 32), r["doc_id"]))  # at most ``rows`` rows of numbers
    return ensemble(np.array([r["x"] for r in data]).reshape(-1, len(STATISTICS)), np.array([r["y"] for r in data]))


def scored(docs: DataFrame, model: Rules, into: str = "score") -> DataFrame:
    """docs with a column of scores, which takes the place of one of its name."""
    own = f"stats_{uuid.uuid4().hex}"
    return docs.withColumn(own, statistics(F.col("text"))).withColumn(into, model.column(own)).drop(own)


def judge(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, rows: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs."""
    out = scored(docs.select("doc_id", "text"), fit(docs, labels, rows))
    return out.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, rows: int = SAMPLE) -> DataFrame:
    """The rows of docs, all columns, that score at or above the threshold."""
    own = f"stats_{uuid.uuid4().hex}"
    good = docs.withColumn(own, statistics(F.col("text"))).where(fit(docs, labels, rows).column(own) >= threshold)
    return good.drop(own)
