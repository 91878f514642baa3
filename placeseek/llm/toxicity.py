"""Toxicity by classifier chains over words.

Categories are predicted one after the other by logistic models. Each later model also gets
the log odds of the earlier categories; for training these are out-of-fold predictions, so
that a later model sees earlier ones as good as they will be on new texts. The models are
fitted on a bounded sample of labelled documents: ``SAMPLE_ROWS`` rows, those with the
smallest hash of their id, one of each group of near copies. Words enter a model when their share among the documents of a
category differs by ``LEAST_Z`` standard errors. Every document is scored by its whole text.

Null or empty text has no words and gets each category's base rate. Of several labels of one
document the highest counts; null labels count as 0. Without labelled rows, or with one
class only, a category's probability is its smoothed base rate. Other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_ROWS = 20_000
TERMS = 400
LEAST_Z = 5.0
LEAST_DOCS = 8
FOLDS = 3
REJECT_AT = 0.5
# Longer words also count by their first letters.
STEM = 5

WORD = re.compile(r"[^\W\d_]+")


def features(text: str | None) -> set[str]:
    """Distinct words without case, their beginnings, and three traits of the text's form."""
    text = text or ""
    words = WORD.findall(text.casefold())
    found = set(words)
    if words:
        kinds = len(found)
        letters = sum(map(len, words))
        found |= {w[:STEM] + "~" for w in found if len(w) > STEM}
        found.add(f"#letters{10 * letters // max(1, len(text))}")
        found.add(f"#distinct{10 * kinds // len(words)}")
        found.add(f"#length{min(12, letters // len(words))}")
    return found


@dataclass
class Chain:
    """Weights of each category over words and over the log odds of earlier categories."""

    categories: list[str]
    terms: dict[str, int] = field(default_factory=dict)
    bias: list[float] = field(default_factory=list)
    weights: list[np.ndarray] = field(default_factory=list)
    earlier: list[np.ndarray] = field(default_factory=list)

    def odds(self, text: str | None) -> list[float]:
        at = [self.terms[w] for w in self.terms.keys() & features(text)]
        odds: list[float] = []
        for k in range(len(self.categories)):
            value = self.bias[k] + float(self.weights[k][at].sum())
            odds.append(clipped(value + sum(w * o for w, o in zip(self.earlier[k], odds, strict=True))))
        return odds


def clipped(value):
    return float(np.clip(value, -12, 12))


def fit_logistic(
    rows: np.ndarray, cols: np.ndarray, extra: np.ndarray, y: np.ndarray, n_cols: int, l2: float = 1.0, steps: int = 300
) -> tuple[float, np.ndarray, np.ndarray]:
    """(bias, weights, weights of ``extra``) of an L2-penalised logistic model.

    ``rows`` and ``cols`` list the features present, ``extra`` has dense columns. Each step
    moves every weight by its gradient over a bound of its curvature, with momentum.
    """
    n, m = len(y), extra.shape[1]
    mass = np.bincount(rows, minlength=n) + 1.0 + np.abs(extra).sum(axis=1)
    curve = 0.25 * np.bincount(cols, weights=mass[rows], minlength=n_cols) + l2
    curve_x = 0.25 * (np.abs(extra) * mass[:, None]).sum(axis=0) + l2
    curve_b = 0.25 * mass.sum()
    base = (y.sum() + 1.0) / (n + 2.0)
    w = np.zeros(n_cols + m + 1)
    w[-1] = np.log(base / (1 - base))
    if not 0 < y.sum() < n:
        return w[-1], w[:n_cols], w[n_cols:-1]
    ahead, before = w.copy(), w.copy()
    scale = np.concatenate([curve, curve_x, [curve_b]])
    for k in range(steps):
        z = np.bincount(rows, weights=ahead[cols], minlength=n) + extra @ ahead[n_cols:-1] + ahead[-1]
        gap = y - 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))
        grad = np.concatenate([np.bincount(cols, weights=gap[rows], minlength=n_cols), gap @ extra, [gap.sum()]])
        grad[:-1] -= l2 * ahead[:-1]
        before, w = w, ahead + grad / scale
        ahead = w + (k / (k + 3.0)) * (w - before)
    return w[-1], w[:n_cols], w[n_cols:-1]


def _labelled(docs: DataFrame, labels: DataFrame, categories: Sequence[str], sample_rows: int) -> DataFrame:
    """(doc_id, text, categories) of the bounded sample."""
    top = [F.max(F.coalesce(F.col(c).cast("int"), F.lit(0))).alias(c) for c in categories]
    chosen = (
        labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(*top)
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    categories: Sequence[str],
    sample_rows: int = SAMPLE_ROWS,
    terms: int = TERMS,
    folds: int = FOLDS,
) -> Chain:
    """A chain in the order of ``categories``, which are 0/1 columns of ``labels``."""
    categories = list(categories)

    @F.udf("array<string>", useArrow=True)
    def found(text):
        return sorted(features(text))

    sample = _labelled(docs, labels, categories, sample_rows).select(
        "doc_id", *categories, found("text").alias("words")
    )
    # Near copies of one text must not pass for evidence from many texts.
    marks = [F.array_min(F.transform("words", lambda w, k=k: F.xxhash64(w, F.lit(k)))) for k in (1, 2)]
    sample = sample.select("*", *[m.alias(f"_m{k}") for k, m in enumerate(marks)])
    first = F.min("doc_id").over(Window.partitionBy("_m0", "_m1"))
    sample = sample.withColumn("_first", first).filter("doc_id = _first").drop("_m0", "_m1", "_first").cache()
    totals = sample.agg(F.count(F.lit(1)), *[F.sum(c) for c in categories]).first()
    n, positives = totals[0], [x or 0 for x in totals[1:]]
    chain = Chain(categories)
    if n:
        counted = (
            sample.select(F.explode("words").alias("term"), *categories)
            .groupBy("term")
            .agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in categories])
            .filter(F.col("n") >= LEAST_DOCS)
        )
        kept: set[str] = set()
        for c, p in zip(categories, positives, strict=True):
            share = F.col("n") / n
            error = F.sqrt(share * (1 - share) / max(1, p) + 1e-12)
            z = F.abs(F.col(c) / max(1, p) - share) / error
            best = counted.select("term", z.alias("z")).filter(F.col("z") >= LEAST_Z)
            kept.update(r.term for r in best.orderBy(F.desc("z"), "term").limit(terms).collect())
        chain.terms = {t: k for k, t in enumerate(sorted(kept))}
    names = sorted(chain.terms)
    listed = F.array(*[F.lit(t) for t in names]) if names else F.array().cast("array<string>")
    # At most ``sample_rows`` rows with the chosen words only.
    rows = sample.select("doc_id", *categories, F.array_intersect("words", listed).alias("words")).toPandas()
    sample.unpersist()
    rows = rows.sort_values("doc_id", kind="stable").reset_index(drop=True)
    at = np.repeat(np.arange(len(rows)), [len(w) for w in rows["words"]])
    cols = np.array([chain.terms[t] for w in rows["words"] for t in w], dtype=np.int64)
    fold = np.arange(len(rows)) % folds
    extra = np.empty((len(rows), 0))
    for c in categories:
        y = rows[c].to_numpy(dtype=float)
        bias, weights, earlier = fit_logistic(at, cols, extra, y, len(names))
        chain.bias.append(float(bias))
        chain.weights.append(weights)
        chain.earlier.append(earlier)
        held_out = np.zeros(len(rows))
        for k in range(folds):
            train, test = fold != k, fold == k
            if not train.any() or not test.any():
                continue
            place = np.cumsum(train) - 1
            own = train[at]
            b, w, e = fit_logistic(place[at[own]], cols[own], extra[train], y[train], len(names))
            z = np.bincount(at, weights=w[cols], minlength=len(rows)) + extra @ e + b
            held_out[test] = np.clip(z[test], -12, 12)
        extra = np.column_stack([extra, held_out])
    return chain


def probabilities(chain: Chain, text: Column) -> Column:
    """Struct of the probability of each category, from the whole text."""
    names = ", ".join(f"`{c}` double" for c in chain.categories)

    @F.pandas_udf(f"struct<{names.replace(' double', ':double')}>")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            odds = np.array([chain.odds(t) for t in texts], dtype=float).reshape(-1, len(chain.categories))
            yield pd.DataFrame(1.0 / (1.0 + np.exp(-odds)), columns=chain.categories)

    return score(text)


def training_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, low_quality, toxic): poor form first, as it tells about the rest."""
    return labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")


CATEGORIES = ("low_quality", "toxic")


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, n_chars, p_low_quality, p_toxic, toxic) of every document."""
    chain = fit(docs, training_labels(labels), CATEGORIES)
    p = docs.select("doc_id", "text").withColumn("p", probabilities(chain, F.col("text")))
    return p.select(
        "doc_id",
        F.col("p.low_quality").alias("p_low_quality"),
        F.col("p.toxic").alias("p_toxic"),
        (F.col("p.toxic") >= REJECT_AT).alias("toxic"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, with their columns."""
    chain = fit(docs, training_labels(labels), CATEGORIES)
    kept = docs.withColumn("__p", probabilities(chain, F.col("text")))
    return kept.filter(F.col("__p.toxic") < REJECT_AT).select(*docs.columns)
