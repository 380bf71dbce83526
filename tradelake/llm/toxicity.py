"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

One weight vector is shared by all thresholds: P(grade <= k) = sigmoid(threshold[k] - weights . x),
with ascending thresholds.  Features are hashed words; those that go with the grade are found by
counting over the sample.  The result is the expected grade.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm import bytetext as bt
from tradelake.llm.sampling import labelled_ids
from tradelake.llm.ship import ship
from tradelake.session import stage

LABELLED, FEATURES = 20_000, 2048
SPACE_BITS = 22


def word_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashed words of each text: first feature of each row, feature, count.  A-Z count as a-z, and
    all signs of ASCII part words."""
    w = bt.Words(column, bt.sign_table(), lower=True)
    rows = len(w.first) - 1
    key = w.doc.astype(np.uint64) << np.uint64(SPACE_BITS) | w.hashes() >> np.uint64(64 - SPACE_BITS)
    key.sort()
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    head = np.flatnonzero(new)
    feature = (key[head] & np.uint64((1 << SPACE_BITS) - 1)).astype(np.int32)
    row = (key[head] >> np.uint64(SPACE_BITS)).astype(np.int64)
    return np.searchsorted(row, np.arange(rows + 1)), feature, np.diff(np.append(head, len(key)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Ordinal:
    """Features in ascending order, a weight for each, and the thresholds between grades."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def linear(self, first: np.ndarray, feature: np.ndarray, count: np.ndarray) -> np.ndarray:
        row = np.repeat(np.arange(len(first) - 1), np.diff(first))
        at = np.minimum(np.searchsorted(self.features, feature), max(0, len(self.features) - 1))
        known = self.features[at] == feature if len(self.features) else np.zeros(len(feature), bool)
        value = self.weights[at[known]] * (1 + np.log(count[known])) if len(self.features) else np.zeros(0)
        return np.bincount(row[known], weights=value, minlength=len(first) - 1)

    def above(self, linear: np.ndarray) -> np.ndarray:
        """P(grade > k) for each threshold k."""
        return _sigmoid(linear[:, None] - self.thresholds[None, :])


def fit(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, grade: np.ndarray, n_features: int, grades: int,
        steps: int = 400, ridge: float = 2e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of the greatest penalised likelihood, by full-batch Adam.

    The entries are those of a sparse matrix.  Thresholds are a first one and logarithms of the steps between them, so they
    stay in order.
    """
    n = len(grade)
    w = np.zeros(n_features)
    share = np.clip([(grade <= k).mean() for k in range(grades - 1)], 1e-4, 1 - 1e-4)
    cut = np.log(share / (1 - share))
    gaps = np.log(np.maximum(np.diff(cut), 1e-2))
    state = np.concatenate((w, cut[:1], gaps))
    m, v = np.zeros_like(state), np.zeros_like(state)
    for step in range(1, steps + 1):
        w, cut = state[:n_features], np.cumsum(np.concatenate((state[n_features:n_features + 1], np.exp(state[n_features + 1:]))))
        linear = np.bincount(rows, weights=values * w[columns], minlength=n)
        below = np.column_stack((np.zeros(n), _sigmoid(cut[None, :] - linear[:, None]), np.ones(n)))
        upper, lower = below[np.arange(n), grade + 1], below[np.arange(n), grade]
        p = np.maximum(upper - lower, 1e-12)
        du, dl = upper * (1 - upper) / p, lower * (1 - lower) / p  # derivatives of log p by its two thresholds
        g_linear = (du - dl) / n
        g_cut = np.array([(-(du * (grade == k)) + dl * (grade == k + 1)).sum() / n for k in range(grades - 1)])
        g_w = np.bincount(columns, weights=values * g_linear[rows], minlength=n_features) + ridge * w
        tail = np.cumsum(g_cut[::-1])[::-1]
        g = np.concatenate((g_w, tail[:1], tail[1:] * np.exp(state[n_features + 1:])))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        rate = 0.15 * (1 - step / (steps + 1)) + 1e-3
        state = state - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return state[:n_features], np.cumsum(np.concatenate((state[n_features:n_features + 1], np.exp(state[n_features + 1:]))))


def labelled(docs: DataFrame, grades: DataFrame, rows: int = LABELLED) -> DataFrame:
    """(doc_id, grade, features, counts) of about ``rows`` texts with a grade, written to the shared folder."""
    ship(docs.sparkSession)
    ids = labelled_ids(grades.filter("grade is not null"), rows, "grade")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    own = own.join(F.broadcast(ids), "doc_id").select("doc_id", F.col("grade").cast("int").alias("grade"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bt.portions(batches, "text"):
            first, feature, count = word_features(batch.column(2))
            at = pa.array(first, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.ListArray.from_arrays(at, pa.array(feature)),
                 pa.ListArray.from_arrays(at, pa.array(count, pa.int32()))], ["doc_id", "grade", "features", "counts"])

    return stage(own.mapInArrow(run, "doc_id long, grade int, features array<int>, counts array<int>"), "labelled")


def _association(sample: DataFrame) -> DataFrame:
    """For each feature how far its share among graded texts exceeds that among others, in standard errors."""
    total = sample.agg(F.count("*").alias("all"), F.sum((F.col("grade") > 0).cast("int")).alias("graded"))
    each = sample.select("grade", F.explode("features").alias("feature")).groupBy("feature").agg(
        F.count("*").alias("texts"), F.sum((F.col("grade") > 0).cast("int")).alias("hits"))
    rate = F.col("graded") / F.col("all")
    each = each.filter("texts >= 3").crossJoin(F.broadcast(total))  # one row of totals
    z = (F.col("hits") - F.col("texts") * rate) / F.sqrt(F.col("texts") * rate * (1 - rate) + 1e-9)
    return each.select("feature", z.alias("z"))


def telling(sample: DataFrame, limit: int, least: float) -> list[int]:
    """The features that go with a grade most, in ascending order; ``limit`` at most."""
    found = _association(sample).filter(F.col("z") >= least).orderBy(F.desc("z"), "feature").limit(limit)
    return sorted(r.feature for r in found.collect())


def _entries(sample: DataFrame, chosen: list[int]) -> DataFrame:
    """(doc_id, feature, times) of the chosen features; these are few, by a parameter."""
    wanted = sample.sparkSession.createDataFrame([(c,) for c in chosen], "feature int")
    each = sample.select("doc_id", F.explode(F.arrays_zip("features", "counts")).alias("x"))
    each = each.select("doc_id", F.col("x.features").alias("feature"), F.col("x.counts").alias("times"))
    return each.join(F.broadcast(wanted), "feature")


def with_severity(sample: DataFrame, least: float = 5.0) -> DataFrame:
    """A sample whose grades only tell toxic (1) from not (0), with grade 2 for toxic texts that hold more than
    the median number of telling words."""
    hits = _entries(sample, telling(sample, FEATURES, least)).groupBy("doc_id").agg(F.sum("times").alias("hits"))
    sample = stage(sample.join(hits, "doc_id", "left").withColumn("hits", F.coalesce("hits", F.lit(0))), "labelled")
    middle = sample.filter("grade > 0").agg(F.percentile_approx("hits", 0.5, 100_000)).first()[0] or 0
    harder = (F.col("grade") > 0) & (F.col("hits") > F.lit(middle))
    return sample.withColumn("grade", F.when(harder, 2).otherwise(F.col("grade"))).drop("hits")


def train(sample: DataFrame, limit: int = FEATURES, least: float = 3.0) -> Ordinal | None:
    """The model for a sample of ``labelled``; None if it has fewer than two grades.

    The grades of the sample and its entries for the chosen features come to the driver: the sample's size is a
    parameter.
    """
    chosen = telling(sample, limit, least)
    texts = sample.select("doc_id", "grade").orderBy("doc_id").toArrow()
    grade = np.maximum(0, texts.column("grade").to_numpy()).astype(np.int64)
    if len(set(grade.tolist())) < 2:
        return None
    entries = _entries(sample, chosen).orderBy("doc_id", "feature").toArrow()
    rows = np.searchsorted(texts.column("doc_id").to_numpy(), entries.column("doc_id").to_numpy())
    columns = np.searchsorted(chosen, entries.column("feature").to_numpy()).astype(np.int64)
    values = 1 + np.log(entries.column("times").to_numpy().astype(float))
    weights, thresholds = fit(rows, columns, values, grade, len(chosen), int(grade.max()) + 1)
    return Ordinal(np.array(chosen, np.int32), weights, thresholds)


def graded(docs: DataFrame, model: Ordinal | None) -> DataFrame:
    """Per row of ``docs``: doc_id, severity (the expected grade), grade (the highest that is as likely as not
    reached) and toxic (that grade is above 0).

    Only the text counts: equal texts have equal results, null and empty ones those of a text without
    words.  Without a model (labels of one grade or none) the severity is 0.  Other columns are not looked at.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bt.portions(batches, "text"):
            n = batch.num_rows
            above = np.zeros((n, 1)) if model is None else model.above(model.linear(*word_features(batch.column(1))))
            grade = (above >= 0.5).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(above.sum(axis=1)), pa.array(grade, pa.int32()), pa.array(grade > 0)],
                ["doc_id", "severity", "grade", "toxic"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, severity double, grade int, toxic boolean")
