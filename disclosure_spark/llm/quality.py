"""Document quality by positive-unlabelled learning.

Trusted positives are documents labelled good; everything else counts as unlabelled web
text, whatever its label. A linear model on statistics of the whole text minimises the
non-negative unbiased risk under a class prior that is estimated from the same data.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import arrow_batch, saved

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
MOST_POSITIVE = 20_000  # labelled rows that are fitted on
MOST_UNLABELLED = 40_000  # unlabelled rows that are fitted on
STEPS, RATE, SHRINK = 1500, 0.05, 1e-4
SEED = "pu-1"

_SIGNS = re.compile(r"[^\w\s]")
_ENDS = re.compile(r"[.!?…](?=\s|$)")


def features(text: str) -> list[float]:
    """Statistics of a whole text; an empty one has zeros but for the first."""
    words = text.split()
    n, size = len(words), len(text)
    if not n:
        return [1.0] + [0.0] * (COUNT - 1)
    counts = Counter(words)
    same = sum(map(str.__eq__, words, words[1:])) / (n + 5)
    lines = [x for x in text.split("\n") if x.strip()]
    signs = Counter(_SIGNS.findall(text))
    plain = signs["."] + signs[","] + signs["'"] + signs["-"]
    odd = (sum(signs.values()) - plain) / n
    upper = sum(map(str.isupper, words)) / n
    digits = sum(text.count(d) for d in "0123456789") / size
    return [
        1.0,
        # Chance alone repeats words in a long text and makes shares coarse in a short one.
        (n - len(counts)) / (n + 10),
        (counts.most_common(1)[0][1] - 1) / (n + 5),
        same,
        float(np.sqrt(same)),
        1 - len(set(lines)) / len(lines),
        min(odd, 2.0),
        float(np.sqrt(min(odd, 4.0))),
        min(signs["|"] / n, 2.0),
        float(np.sqrt(min(signs["|"] / n, 2.0))),
        min(signs["!"] / n, 2.0),
        upper,
        float(np.sqrt(upper)),
        min(size / n, 40.0) / 10,
        digits,
        float(np.sqrt(digits)),
        len(_ENDS.findall(text)) / (n + 10),
        min(plain / n, 2.0),
        len(lines) / (n + 10),
    ]


COUNT = 19


def with_features(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of every whole text, and nothing else of the row."""

    def task(batches):
        import pyarrow as pa

        for batch in batches:
            flat = [x for t in batch.column(1).to_pylist() for x in features(t or "")]
            lists = pa.FixedSizeListArray.from_arrays(pa.array(flat, pa.float64()), COUNT).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["doc_id", "x"])

    return docs.selectExpr("CAST(doc_id AS LONG) AS doc_id", "text").mapInArrow(task, "doc_id long, x array<double>")


def held_out(doc_id: Column) -> Column:
    """Whether a row's labels are never learnt from. A null id has no fold and is not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


def _risk_gradient(w: np.ndarray, p: np.ndarray, u: np.ndarray, prior: float) -> np.ndarray:
    """Gradient of prior R+(p) + max(0, R-(u) - prior R-(p)) for the logistic loss."""
    at = lambda x: 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
    sp, su = at(p), at(u)
    # The loss of a positive is log(1 + exp(-z)), of a negative log(1 + exp(z)).
    good = prior * (p.T @ (sp - 1)) / len(p)
    bad = (u.T @ su) / len(u) - prior * (p.T @ sp) / len(p)
    zu, zp = np.clip(u @ w, -30, 30), np.clip(p @ w, -30, 30)
    negative = np.log1p(np.exp(zu)).mean() - prior * np.log1p(np.exp(zp)).mean()
    # Where the estimate of the negatives' risk is below zero, its descent is undone.
    return good + bad if negative >= 0 else -bad


def _descend(gradient, size: int) -> np.ndarray:
    """Adam with all rows in each step, from zero."""
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, STEPS + 1):
        g = gradient(w) + SHRINK * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The least ratio of unlabelled to positive mass over the upper sets of a score.

    Among what a classifier of positive against unlabelled ranks highest there are hardly any negatives,
    so the ratio comes near the share of positives.
    """
    both = np.concatenate([positive, unlabelled])
    target = np.concatenate([np.ones(len(positive)), np.zeros(len(unlabelled))])
    weight = np.where(target == 1, 0.5 / len(positive), 0.5 / len(unlabelled))
    w = _descend(lambda w: both.T @ (weight * (1 / (1 + np.exp(-np.clip(both @ w, -30, 30))) - target)), both.shape[1])
    ps, us = np.sort(positive @ w), np.sort(unlabelled @ w)
    cuts = np.quantile(ps, np.linspace(0.02, 0.6, 30))
    mass = lambda s: 1 - np.searchsorted(s, cuts) / len(s)
    return float(np.clip((mass(us) / np.maximum(mass(ps), 1e-9)).min(), 0.05, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Centre, scale and weights of the model, and the prior it was fitted under."""
    centre, scale = unlabelled.mean(0), unlabelled.std(0)
    centre[0], scale[0] = 0.0, 1.0
    scale[scale < 1e-9] = 1.0
    p, u = ((x - centre) / scale for x in (positive, unlabelled))
    prior = estimate_prior(p, u)
    return centre, scale, _descend(lambda w: _risk_gradient(w, p, u, prior), p.shape[1]), prior


def sample(rows: DataFrame, most: int) -> list:
    """At most so many rows of doc_id and x, equal ones once, by the least hashes.

    Of a larger table only rows with a hash below a cutoff, which leaves a little more than ``most``
    of them, are sorted; so what reaches the driver does not grow with the number of tasks.
    """
    rows = rows.select("doc_id", "x", F.xxhash64(F.lit(SEED), "doc_id", "x").alias("_hash"))
    total = rows.count()
    if total > most:
        share = min(1.0, (most + 6 * most**0.5 + 100) / total)
        rows = rows.filter(F.col("_hash") < int(share * 2**64) - 2**63 if share < 1 else F.lit(True))
    distinct = rows.groupBy("doc_id", "x").agg(F.min("_hash").alias("_hash"))
    return distinct.orderBy("_hash", "doc_id", "x").limit(most).select("x").collect()


def train(rows: DataFrame, labels: DataFrame) -> tuple[list[float], float] | None:
    """Weights of the statistics and the offset, from rows of doc_id, x and held_out; None without a positive."""
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality").filter("doc_id is not null")
    trusted = own.groupBy("doc_id").agg(F.min("quality").alias("least"), F.count_if(F.col("quality").isNull()).alias("unknown"))
    trusted = trusted.filter((F.col("least") == 1) & (F.col("unknown") == 0)).select("doc_id")
    learnt = rows.filter(~F.col("held_out"))
    positive = sample(learnt.join(trusted, "doc_id", "left_semi"), MOST_POSITIVE)
    unlabelled = sample(learnt, MOST_UNLABELLED)
    if not positive:
        return None
    centre, scale, w, _ = fit(*(np.array([r.x for r in part]) for part in (positive, unlabelled)))
    return (w / scale).tolist(), float(-(centre * w / scale).sum())


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``score`` predicts to be good, as they are. Without any positive, all of them."""
    rows = saved(with_features(docs).withColumn("held_out", held_out(F.col("doc_id"))), "quality_features")
    model = train(rows, labels)
    if model is None:
        return docs
    weights, offset = np.array(model[0]), model[1]
    place = docs.columns.index("text")
    least = float(np.log(THRESHOLD / (1 - THRESHOLD)))

    def task(batches):
        import pyarrow as pa

        for batch in batches:
            x = np.array([features(t or "") for t in batch.column(place).to_pylist()]).reshape(-1, COUNT)
            yield batch.filter(pa.array(x @ weights + offset >= least))

    return docs.mapInArrow(task, docs.schema)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The quality of every whole text: doc_id, held_out, score, predicted.

    Trusted positives are ids outside the held-out fold whose label rows all say 1.
    At most ``MOST_POSITIVE`` of them and ``MOST_UNLABELLED`` other rows outside that
    fold, those with the least hashes, are fitted on; every row is scored. A null
    text counts as empty; rows that repeat are scored each. Without any positive, all
    scores are 0.5. An empty table gives an empty result.
    """
    rows = saved(with_features(docs).withColumn("held_out", held_out(F.col("doc_id"))), "quality_features")
    model = train(rows, labels)
    if model is None:
        done = rows.withColumn("score", F.lit(0.5))
    else:
        weights = F.array(*map(F.lit, model[0]))
        z = F.aggregate(F.zip_with("x", weights, lambda a, b: a * b), F.lit(model[1]), lambda s, a: s + a)
        done = rows.withColumn("score", 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z)))))
    return done.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
