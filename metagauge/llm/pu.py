"""A quality classifier from trusted positives and unlabelled web text.

1. Each document's form is measured (style.NAMES), in one pass.
2. A logistic model tells trusted positives from all documents. From the histograms of its scores over all positives and all
   documents the share of positives among documents (the class prior) is
   estimated: the least ratio of upper tails with a confidence margin (best bin
   estimation).
3. With that prior the model is trained anew to minimise the non-negative
   unbiased risk ``prior R_p+ + max(0, R_u- - prior R_p-)`` with the sigmoid loss.
4. A document stays if its score is at least 0, the boundary of that risk.
   Positives below it are rejected like any other document, so wrong positive
   labels don't move the cutoff.

MAX_POSITIVES bounds the sample of positives in training, chosen by a hash of
doc_id. Everything else covers all documents: means and deviations, the
unlabelled part of both losses, prior and decisions. Each step of training is a
pass over the measured table, of which a task returns sums; descent goes on
until no step of a pass gains STOP, without a bound on passes.

Defined results: null and empty texts are rejected as soon as there is a model.
Without positives, or without documents, there is no model and every document
stays with a null posterior. doc_ids are integers (ValueError otherwise); a null one has no label. Repeated rows are scored alike; a document with
several labels is positive only if all are. Extra columns pass through (filter)
or are ignored (score).
"""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import integer
from .sample import lowest
from .scratch import drop, written
from .style import NAMES, measure, table
from .sums import total
from .textcore import slices

MAX_POSITIVES = 20_000
BINS = 1000
TOLERANCE, STOP = 1e-5, 1e-6
#: Lengths that a pass tries along its direction.
LENGTHS = np.array([4, 2, 1, 0.5, 0.25, 0.1, 0.03, 0.005])
MEMORY = 12

#: Gives the mean over unlabelled rows of what a function sums over some of them.
Mean = Callable[[Callable[[np.ndarray], np.ndarray]], np.ndarray]


def expand(x: np.ndarray) -> np.ndarray:
    """Inputs of the model: the logarithm of words, the shares and their roots."""
    shares = x[:, 2:]
    return np.concatenate([np.log1p(x[:, :2]), shares, np.sqrt(shares)], axis=1)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def _mean(u: np.ndarray | Mean) -> Mean:
    return u if callable(u) else lambda value: value(u) / len(u)


def _minimise(loss: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], metric: np.ndarray) -> np.ndarray:
    """Weights at which no step gains STOP (L-BFGS in coordinates that metric makes alike).

    loss gives the values and the gradients at rows of weights, all in one pass.
    """
    to = np.linalg.inv(np.linalg.cholesky(metric))

    def at(rows):
        values, grads = loss(rows @ to)
        return values, grads @ to.T

    w = np.zeros(len(metric))
    (v,), (g,) = at(w[None])
    past: list[tuple] = []
    while np.abs(g).max() > TOLERANCE:
        d, took = g.copy(), []
        for s, y in reversed(past):
            took.append((s @ d) / (s @ y))
            d -= took[-1] * y
        d *= (past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1]) if past else 1 / np.sqrt(g @ g)
        for (s, y), a in zip(past, reversed(took)):
            d += s * (a - (y @ d) / (s @ y))
        tried = w - LENGTHS[:, None] * d
        values, grads = at(tried)
        i = int(values.argmin())
        if values[i] > v - STOP:
            if not past:
                break
            past = []  # down the gradient itself before giving up
            continue
        s, y = tried[i] - w, grads[i] - g
        w, v, g = tried[i], values[i], grads[i]
        if s @ y > 0:
            past = [*past, (s, y)][-MEMORY:]
    return w @ to


def _metric(u: Mean) -> np.ndarray:
    second = u(lambda x: x.T @ x)
    return second + 0.01 * np.eye(len(second))


def fit_logistic(p: np.ndarray, u: np.ndarray | Mean, ridge: float = 1e-4) -> np.ndarray:
    """Tells p from u, with a half weight each."""
    u = _mean(u)

    def loss(w):
        def sums(x):
            z = x @ w.T
            return np.concatenate([np.logaddexp(0, z).sum(axis=0)[:, None], _sigmoid(z).T @ x], axis=1)

        z, of_u = p @ w.T, u(sums)
        return np.logaddexp(0, -z).mean(axis=0) + of_u[:, 0] + ridge / 2 * (w**2).sum(axis=1), of_u[:, 1:] - (1 - _sigmoid(z)).T @ p / len(p) + ridge * w

    return _minimise(loss, _metric(u))


def fit_nnpu(p: np.ndarray, u: np.ndarray | Mean, prior: float, ridge: float = 1e-4) -> np.ndarray:
    """Weights with the least non-negative risk. The sigmoid loss of z is sigmoid(-z)."""
    u = _mean(u)

    def loss(w):
        def sums(x):
            z = _sigmoid(x @ w.T)
            return np.concatenate([z.sum(axis=0)[:, None], (z * (1 - z)).T @ x], axis=1)  # of the loss of u as negatives

        of_p, of_u = sums(p) / len(p), u(sums)
        rest = of_u - prior * of_p
        value = prior * (1 - of_p[:, 0]) + np.maximum(0, rest[:, 0])
        return value + ridge / 2 * (w**2).sum(axis=1), -prior * of_p[:, 1:] + (rest[:, :1] >= 0) * rest[:, 1:] + ridge * w

    return _minimise(loss, _metric(u))


def risk(p: np.ndarray, u: np.ndarray, w: np.ndarray, prior: float) -> float:
    zp, zu = _sigmoid(p @ w), _sigmoid(u @ w)
    return float(prior * (1 - zp).mean() + max(0.0, zu.mean() - prior * zp.mean()))


def estimate_prior(positives: np.ndarray, unlabelled: np.ndarray, delta: float = 0.1, gamma: float = 0.01) -> float:
    """Share of positives in unlabelled, from histograms of scores in ascending bins."""
    n_p, n_u = positives.sum(), unlabelled.sum()
    q_p, q_u = np.cumsum(positives[::-1]) / n_p, np.cumsum(unlabelled[::-1]) / n_u
    margin = np.sqrt(np.log(4 / delta) / 2) * (1 / np.sqrt(n_p) + 1 / np.sqrt(n_u))
    some = q_p > 0
    ratio = q_u[some] / q_p[some]
    best = int((ratio + (1 + gamma) * margin / q_p[some]).argmin())
    return float(np.clip(ratio[best], 0.01, 0.99))


def _inputs(rows: list) -> np.ndarray:
    return expand(np.array([[r[c] for c in NAMES] for r in rows], float).reshape(len(rows), len(NAMES)))


def _standard(x: np.ndarray, center: np.ndarray, scale: np.ndarray) -> np.ndarray:
    z = np.clip((x - center) / scale, -8, 8)
    return np.concatenate([z, np.ones((len(x), 1))], axis=1)


def scores(x: np.ndarray, model: dict) -> np.ndarray:
    """Of measured texts."""
    return _standard(expand(x), np.array(model["center"]), np.array(model["scale"])) @ np.array(model["weights"])


def _with_scores(measured: DataFrame, model: dict) -> DataFrame:
    @F.arrow_udf("double")
    def score(*columns: pa.Array) -> pa.Array:
        return pa.array(scores(np.stack([c.to_numpy(zero_copy_only=False) for c in columns], axis=1), model))

    return measured.withColumn("score", score(*NAMES))


def _sum(measured: DataFrame, value: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all rows of value(texts x NAMES), which adds them up and has the same shape for any rows."""
    return total(measured.select(*NAMES), lambda b: value(np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in b.columns], axis=1)))


def fit(measured: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> dict | None:
    """The model: center, scale, weights, prior; None without positives. measured is style.table()."""
    good = labels.groupBy(integer(labels, id_col).alias("doc_id")).agg(F.min(F.col(f"`{label_col}`")).alias("good")).where("good = 1").select("doc_id")
    trusted = written(measured.join(good, "doc_id").select("doc_id", *NAMES), "pu-trusted")
    p = _inputs(lowest(trusted, MAX_POSITIVES, trusted.count(), F.xxhash64("doc_id", F.lit("pu")), *NAMES))
    n = measured.count()
    if not len(p) or not n:
        return None
    center = _sum(measured, lambda x: expand(x).sum(axis=0)) / n
    scale = np.maximum(np.sqrt(_sum(measured, lambda x: ((expand(x) - center) ** 2).sum(axis=0)) / n), 1e-6)
    model = {"center": center.tolist(), "scale": scale.tolist()}
    zp = _standard(p, center, scale)
    all_rows = lambda value: _sum(measured, lambda x: value(_standard(expand(x), center, scale))) / n
    model["weights"] = fit_logistic(zp, all_rows).tolist()
    at = lambda df: {r["b"]: r["n"] for r in _with_scores(df, model).groupBy(F.least(F.floor(F.lit(BINS) / (1 + F.exp(-F.col("score")))), F.lit(BINS - 1)).cast("int").alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()}
    hists = [np.array([h.get(b, 0) for b in range(BINS)], float) for h in (at(trusted), at(measured))]
    model["prior"] = estimate_prior(*hists)
    model["weights"] = fit_nnpu(zp, all_rows, model["prior"]).tolist()
    drop(trusted)
    return json.loads(json.dumps(model))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, posterior, keep) of each row; posterior is the sigmoid of its score, which is 0.5 at the boundary and not calibrated beyond that."""
    measured = written(table(docs, id_col, text_col), "pu-measured")
    model = fit(measured, labels)
    if model is None:
        return measured.select("doc_id", F.lit(None).cast("double").alias("posterior"), F.lit(True).alias("keep"))
    return _with_scores(measured, model).select("doc_id", (1 / (1 + F.exp(-F.col("score")))).alias("posterior"), ((F.col("score") >= 0) & (F.col("n_words") > 0)).alias("keep"))


def quality_filter(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the documents that the classifier rejects. Texts are read once to measure and once to decide, and never shuffled."""
    measured = written(table(docs, id_col, text_col), "pu-measured")
    model = fit(measured, labels)
    drop(measured)
    if model is None:
        return docs

    @F.arrow_udf("boolean")
    def stays(texts: pa.Array) -> pa.Array:
        out = []
        for part in slices(pa.RecordBatch.from_arrays([texts], ["t"]), "t"):
            x = measure(part.column("t"))
            out.append((scores(x, model) >= 0) & (x[:, 0] > 0))
        return pa.array(np.concatenate(out) if out else np.zeros(0, bool))

    return docs.where(stays(F.col(f"`{text_col}`").cast("string")))
