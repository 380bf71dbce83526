"""A quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text are all it learns from.  The share of positives in
the unlabelled text is estimated first: a plain positive-against-unlabelled model ranks
both, and where the ranking is purest the unlabelled text holds its positives only, so there
the ratio of the two tail shares is the class prior.  Then a small network minimises the non-negative
unbiased risk: prior * loss of positives + max(0, loss of the unlabelled as negatives - prior * loss
of positives as negatives).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake.llm import bytetext as bt
from tradelake.llm.sampling import by_hash, labelled_ids
from tradelake.llm.ship import ship

POSITIVES, UNLABELLED = 20_000, 40_000
HIDDEN = 24
BINS, REACH = 4096, 16.0
# Signs counted as symbols
SYMBOLS = b"#*$%&|<>"
PUNCTUATION = b".,;:?'\"()-"


def _table(signs: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(signs)] = True
    return out


def features(column: pa.Array) -> np.ndarray:
    """What a text looks like, whatever its language: one row of numbers per text."""
    w = bt.Words(column)
    rows = len(w.offsets) - 1
    text_row = np.repeat(np.arange(rows), np.diff(w.offsets))
    n_bytes = np.maximum(np.diff(w.offsets), 1)
    n_words = np.diff(w.first)
    many = np.maximum(n_words, 1)

    def share(mask: np.ndarray, of: np.ndarray) -> np.ndarray:
        return np.bincount(text_row[mask], minlength=rows) / of

    def per_word(mask: np.ndarray) -> np.ndarray:
        return np.bincount(w.doc[mask], minlength=rows) / many

    d = w.data
    upper, lower = (d >= 65) & (d <= 90), (d >= 97) & (d <= 122)
    length = (w.ends - w.starts).astype(float)
    mean = np.bincount(w.doc, weights=length, minlength=rows) / many
    square = np.bincount(w.doc, weights=length ** 2, minlength=rows) / many
    h = w.hashes()
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (w.doc[1:] == w.doc[:-1])
    order = np.lexsort((h, w.doc))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (w.doc[order][1:] != w.doc[order][:-1])
    distinct = np.bincount(w.doc[order][new], minlength=rows)
    at, grams = w.windows(3, h)
    pair = np.lexsort((grams, w.doc[at]))
    again = np.zeros(len(at), bool)
    again[1:] = (grams[pair][1:] == grams[pair][:-1]) & (w.doc[at][pair][1:] == w.doc[at][pair][:-1])
    repeated = np.bincount(w.doc[at][pair][again], minlength=rows) / many
    last = d[np.maximum(w.ends - 1, 0)] if len(d) else d
    first = d[w.starts] if len(d) else d
    lines = np.bincount(text_row[d == 10], minlength=rows)
    out = np.stack([
        np.log1p(n_words), distinct / many, np.sqrt(distinct) / np.sqrt(many), per_word(same), repeated, mean, np.sqrt(np.maximum(square - mean ** 2, 0)),
        share(upper, n_bytes), share(lower, n_bytes), share((d >= 48) & (d <= 57), n_bytes), share(d >= 128, n_bytes),
        share(_table(SYMBOLS)[d], many), share(_table(PUNCTUATION)[d], many), share(d == 33, many),
        per_word(_table(SYMBOLS)[last]), per_word((first >= 65) & (first <= 90)), per_word(length > 18), per_word(length == 1), lines / many,
    ], axis=1)
    return np.minimum(out, 50)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Network:
    """Standardised features, one hidden layer, one output."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, b, c, d = self.weights
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        hidden = np.tanh(z @ a + b)
        return z, hidden, hidden @ c + d[0]

    def gradient(self, z: np.ndarray, hidden: np.ndarray, out: np.ndarray) -> list[np.ndarray]:
        back = out[:, None] * self.weights[2] * (1 - hidden ** 2)
        return [z.T @ back, back.sum(0), hidden.T @ out, np.array([out.sum()])]


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, epochs: int = 60, batch: int = 1024, seed: int = 5) -> Network:
    """By the non-negative risk for ``prior``; without one, positives against unlabelled (for the prior)."""
    r = np.random.default_rng(seed)
    both = np.concatenate((positive, unlabelled))
    k = both.shape[1]
    net = Network(both.mean(0), both.std(0) + 1e-6, [
        r.normal(0, 1 / np.sqrt(k), (k, HIDDEN)), np.zeros(HIDDEN), r.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)])
    m, v, step = [np.zeros_like(w) for w in net.weights], [np.zeros_like(w) for w in net.weights], 0
    parts = max(1, round(max(len(positive), len(unlabelled)) / batch))
    for epoch in range(epochs):
        for p, u in zip(np.array_split(r.permutation(len(positive)), parts), np.array_split(r.permutation(len(unlabelled)), parts)):
            if not len(p) or not len(u):
                continue
            zp, hp, fp = net.forward(positive[p])
            zu, hu, fu = net.forward(unlabelled[u])
            if prior is None:
                gp, gu = (_sigmoid(fp) - 1) / len(p), _sigmoid(fu) / len(u)
            else:
                loss = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()  # negatives' risk
                gp, gu = prior * (_sigmoid(fp) - 1) / len(p), np.zeros(len(u))
                sign = 1.0 if loss >= 0 else -1.0  # below zero it is overfitted: step back
                if sign < 0:
                    gp = np.zeros(len(p))
                gp = gp - sign * prior * _sigmoid(fp) / len(p)
                gu = sign * _sigmoid(fu) / len(u)
            step += 1
            rate = 0.01 * (0.5 + 0.5 * np.cos(np.pi * epoch / epochs)) + 1e-5
            for i, g in enumerate(a + b for a, b in zip(net.gradient(zp, hp, gp), net.gradient(zu, hu, gu))):
                g = g + 1e-4 * net.weights[i]
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                net.weights[i] = net.weights[i] - rate * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
    return net


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, least: float = 0.02) -> float:
    """The least ratio of the shares of unlabelled and positive scores above a cut, allowing for chance.

    Cuts that leave less than ``least`` of the positives are too noisy to look at.
    """
    return prior_of(positive, np.bincount(bins(unlabelled), minlength=BINS), least)


def bins(scores: np.ndarray) -> np.ndarray:
    """The bin of each score: ``BINS`` equal ones between -``REACH`` and ``REACH``, the outer ones open."""
    return np.clip((scores + REACH) * (BINS / (2 * REACH)), 0, BINS - 1).astype(np.int64)


def prior_of(positive: np.ndarray, counts: np.ndarray, least: float = 0.02) -> float:
    """``class_prior`` with the unlabelled scores given as the number in each bin."""
    own = np.sort(bins(positive))
    cuts = np.unique(np.quantile(own, np.linspace(0, 1 - least, 200), method="lower"))
    above = np.append(np.cumsum(counts[::-1])[::-1], 0)
    n = above[0]
    tail_p = 1 - np.searchsorted(own, cuts) / len(own)
    tail_u = above[cuts] / n
    slack = np.sqrt(np.log(40) / 2) * (1 / np.sqrt(n) + tail_u / tail_p / np.sqrt(len(own)))
    best = int(np.argmin((tail_u + slack) / tail_p))
    return float(np.clip(tail_u[best] / tail_p[best], 0.01, 0.99))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _measured(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns`` and the features of each row's text."""
    schema = docs.select(*columns).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bt.portions(batches, "text"):
            x = features(batch.column(len(columns)))
            own = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(columns))), own], [*columns, "x"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    return docs.select(*columns, "text").mapInArrow(run, f"{kinds}, x array<double>")


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> tuple[Network | None, float]:
    """The network and the class prior.

    The network is fitted on about ``positives`` labelled rows at most, with quality 1 and not held out, and on about
    ``unlabelled`` rows at most that are not held out and whose labels are not looked at, both chosen by a hash of
    doc_id.  The prior comes from the scores of all rows, counted in bins by Spark.
    """
    ship(docs.sparkSession)
    good = labelled_ids(labels.filter((F.col("quality") == 1) & ~held_out(F.col("doc_id"))), positives)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.join(F.broadcast(good.withColumn("good", F.lit(True))), "doc_id", "left")
    rows = rows.withColumn("open", by_hash(unlabelled, docs.count(), _own_id()) & ~held_out(F.col("doc_id")))
    chosen = rows.select(F.coalesce("good", F.lit(False)).alias("good"), "open", "text").filter("good or open")
    got = _measured(chosen, "good", "open").toArrow()
    width = len(features(pa.array([""]))[0])
    x = np.array(got.column("x").combine_chunks().flatten(), float).reshape(-1, width)
    is_good, is_open = (np.array(got.column(c).to_pylist(), bool) for c in ("good", "open"))
    order = np.lexsort(x.T)  # the same order whatever the partitions
    x, is_good, is_open = x[order], is_good[order], is_open[order]
    if not is_good.any() or not is_open.any():
        return None, 0.5
    p, u = x[is_good], x[is_open]
    half_p, half_u = np.arange(len(p)) % 2 == 0, np.arange(len(u)) % 2 == 0
    first = fit(p[half_p], u[half_u], None, epochs=20)  # ranks positives that it has not seen, and all rows
    prior = prior_of(first.forward(p[~half_p])[2], score_counts(rows, first)) if (~half_p).any() else 0.5
    return fit(p, u, prior), prior


def _own_id() -> Column:
    """What a row is chosen by; rows without doc_id are chosen each by itself, whatever texts they share."""
    return F.coalesce(F.col("doc_id"), -1 - F.monotonically_increasing_id())


def score_counts(rows: DataFrame, model: Network) -> np.ndarray:
    """How many texts have their score in each bin."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BINS, np.int64)
        for batch in bt.portions(batches, "text"):
            counts += np.bincount(bins(model.forward(features(batch.column(0)))[2]), minlength=BINS)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["bin", "n"])

    out = np.zeros(BINS, np.int64)
    for r in rows.select("text").mapInArrow(run, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect():
        out[r.bin] = r.n  # a row per bin
    return out


def scored(docs: DataFrame, model: Network | None) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out and score, the estimated chance that the text is good.

    Only the text counts: equal texts have equal scores, null and empty ones that of a text without
    words; without a model (no positives to learn from) all scores are 0.5.  Other columns are not looked at.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bt.portions(batches, "text"):
            score = np.full(batch.num_rows, 0.5) if model is None else _sigmoid(model.forward(features(batch.column(2)))[2])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score)], ["doc_id", "held_out", "score"])

    ids = F.col("doc_id").cast("long")
    rows = docs.select(ids.alias("doc_id"), held_out(ids).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double")
