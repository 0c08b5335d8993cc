"""Mixing documents to target weights of domains, by soft membership.

1. A multinomial logistic model over hashed words is fitted to a bounded sample
   of labelled documents (those in the labels table, with the column that names
   their domain); it gives every document a posterior over domains.
2. Rates r >= 0 of documents are fitted by least squares so that the expected
   tokens of each domain, the sum of r * tokens * posterior, match
   weight * all tokens. Projected gradient steps start from r = 1; a step's
   direction depends on a document through its posterior alone, so iterates
   aren't stored: a pass over (tokens, posterior) rows replays the steps so far
   and adds up the domains' totals. Steps go on until the targets are met or, where
   no rates meet them, until passes gain next to nothing; ``gap`` is what is left.
3. A document occurs floor(r) times, and once more with probability r - floor(r)
   by a hash of its doc_id.

MAX_LABELLED bounds the labelled sample (by a hash of doc_id), of which the
driver gets hashed words' shares, no texts. Tokens are words between ASCII white
space.

Defined results: null and empty texts have no tokens and the model's prior as
posterior. Target domains without labelled documents are left out and the other
weights scaled up; with none left, all rates are 1. Weights of 0 are allowed,
negative ones are not. Repeated rows have equal rates. Labelled rows with a
null domain or one without a target are not used. doc_ids are integers (ValueError
otherwise); null ones have the luck of 0. Extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import free, integer
from .sample import lowest
from .scratch import drop, written
from .sums import total
from .textcore import Words, slices

MAX_LABELLED = 4_000
BUCKET_BITS = 14
TOLERANCE, STILL, RIDGE = 1e-5, 1e-3, 1e-6
#: Lengths of steps that a pass tries.
LENGTHS = (0.125, 0.5, 1, 2, 8, 64)


def _buckets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    words = Words.of(texts, fold=True)
    return (words.hash >> np.uint64(64 - BUCKET_BITS)).astype(np.int32), words.first


def shares(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """n + 1 offsets of texts in the other two: the buckets that occur in each, and their shares of its words."""
    ids, first = _buckets(texts)
    counts = np.diff(first)
    doc = np.repeat(np.arange(len(counts)), counts)
    pair, times = np.unique(doc << BUCKET_BITS | ids, return_counts=True)
    row = pair >> BUCKET_BITS
    return np.searchsorted(row, np.arange(len(counts) + 1)), (pair & (1 << BUCKET_BITS) - 1).astype(np.int32), times / counts[row]


def fit_classifier(offsets: np.ndarray, col: np.ndarray, value: np.ndarray, domains: list[int], classes: int, steps: int = 80) -> np.ndarray:
    """(buckets + 1) x classes weights from texts' shares() and domains; the last row is the bias."""
    n = len(domains)
    row = np.repeat(np.arange(n), np.diff(offsets))
    y = np.eye(classes)[np.array(domains)]
    size = 1 << BUCKET_BITS
    w = np.zeros((size + 1, classes))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        z = np.stack([np.bincount(row, value * w[col, k], n) for k in range(classes)], axis=1) + w[-1]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        off = (z / z.sum(axis=1, keepdims=True) - y) / n
        g = np.empty_like(w)
        for k in range(classes):
            g[:-1, k] = np.bincount(col, value * off[row, k], size)
        g[-1] = off.sum(axis=0)
        g += 1e-7 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.5 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def posteriors(texts: pa.Array, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of each text, and texts x classes."""
    ids, first = _buckets(texts)
    counts = np.diff(first)
    z = np.zeros((len(counts), w.shape[1]))
    some = counts > 0
    for k in range(w.shape[1]):
        if some.any():
            z[some, k] = np.add.reduceat(np.ascontiguousarray(w[:-1, k])[ids], first[:-1][some]) / counts[some]
    z += w[-1]
    z = np.exp(z - z.max(axis=1, keepdims=True)) if w.shape[1] else z
    return counts, z / z.sum(axis=1, keepdims=True)


def replay(p: np.ndarray, steps: list[np.ndarray]) -> np.ndarray:
    """Rates after these steps, from posteriors."""
    r = np.ones(len(p))
    for u in steps:
        r = np.maximum(0, r - p @ u)
    return r


def _sum(measured: DataFrame, classes: int, value) -> np.ndarray:
    """Sum over rows of value(tokens, posteriors), an array of equal shape in every batch."""
    return total(measured.select("n_tokens", "p"), lambda b: value(b.column("n_tokens").to_numpy().astype(float), b.column("p").flatten().to_numpy().reshape(b.num_rows, classes)))


def fit_rates(measured: DataFrame, weights: np.ndarray, tolerance: float = TOLERANCE) -> tuple[list[np.ndarray], np.ndarray]:
    """The steps that replay() takes, and the domains' expected shares of all tokens after them.

    measured has n_tokens and p, a list of as many doubles as weights. Each pass tries projected gradient steps of several
    lengths, scaled by the curvature of all rates and by that of those that aren't 0, and takes the one after which the least
    squares are least. Passes end when every share is within tolerance of its weight, or when none lessens the
    squares by more than a share STILL of what they are: then targets are beyond reach, or all but reached.
    """
    k = len(weights)
    first = _sum(measured, k, lambda n, p: np.concatenate([[n.sum()], n @ p, np.einsum("d,di,dj->ij", n, p, p).ravel()]))
    tokens, now, gram = first[0], first[1 : 1 + k], first[1 + k :].reshape(k, k)
    if tokens == 0:
        return [], np.zeros(k)
    target = tokens * weights
    ridge = RIDGE * np.trace(gram) / k * np.eye(k)
    # Squares of residuals are weighed by the curvature where all rates are free, so that a step of length 1 meets targets if it clips no rate.
    inverse = np.linalg.inv(gram + ridge)
    free_inverse = inverse
    cost = lambda x: float((x - target) @ inverse @ (x - target))
    steps: list[np.ndarray] = []
    while np.abs(now - target).max() > tolerance * tokens:
        tried = [a * (m @ (now - target)) for m in (inverse, free_inverse) for a in LENGTHS]
        so_far = list(steps)

        def sums(n, p, so_far=so_far, tried=tried):
            r, out = replay(p, so_far), []
            for u in tried:
                x = n * np.maximum(0, r - p @ u)
                free = p * (n * (x > 0))[:, None]
                out.append(np.concatenate([x @ p, (free.T @ p).ravel()]))
            return np.array(out)

        got = _sum(measured, k, sums)
        costs = [cost(x[:k]) for x in got]
        i = int(np.argmin(costs))
        if costs[i] >= (1 - STILL) * cost(now):
            break
        steps, now = [*steps, tried[i]], got[i, :k]
        free_inverse = np.linalg.inv(got[i, k:].reshape(k, k) + ridge)
    return steps, now / tokens


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            offsets, buckets, share = shares(part.column("text"))
            at = pa.array(offsets.astype(np.int32))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("domain"), pa.ListArray.from_arrays(at, pa.array(buckets)), pa.ListArray.from_arrays(at, pa.array(share))], ["doc_id", "domain", "buckets", "shares"])


class Mix:
    """A fitted mix: domains, their weights, the classifier and the steps."""

    def __init__(self, docs: DataFrame, labels: DataFrame, targets: dict[str, float], id_col: str = "doc_id", text_col: str = "text", domain_col: str = "lang", max_labelled: int = MAX_LABELLED):
        if any(not w >= 0 for w in targets.values()):
            raise ValueError("weights must not be negative")
        self.id_col, self.text_col = id_col, text_col
        # Documents are chosen by a hash before any text is looked at.
        key = F.xxhash64("doc_id", F.lit("mix"))
        own = integer(docs, id_col).alias("doc_id")
        names = docs.select(own, F.col(f"`{domain_col}`").cast("string").alias("domain")).where(F.col("domain").isin(*sorted(targets)) if targets else F.lit(False))
        known = labels.select(integer(labels, "doc_id").alias("doc_id"))
        chosen = lowest(names.join(known.distinct(), "doc_id", "left_semi").distinct(), max_labelled, known.count(), key, "doc_id", "domain")
        chosen = docs.sparkSession.createDataFrame(chosen, "doc_id long, domain string")  # at most max_labelled rows of two values
        rows = docs.select(own, F.col(f"`{domain_col}`").cast("string").alias("domain"), F.col(f"`{text_col}`").cast("string").alias("text"))
        # Executors hash the words; the driver gets no text.
        rows = rows.join(F.broadcast(chosen), ["doc_id", "domain"], "left_semi").mapInArrow(_hashed, "doc_id long, domain string, buckets array<int>, shares array<double>").toArrow().combine_chunks()
        found = rows.column("domain").to_pylist()
        self.domains = sorted(set(found))
        weights = np.array([targets[d] for d in self.domains])
        self.weights = weights / weights.sum() if weights.sum() > 0 else weights
        self.w, self.steps, self.measured, self.gap = np.zeros((1, 0)), [], None, None
        if not len(weights) or weights.sum() <= 0:
            self.domains = []
            return
        order = sorted(range(len(found)), key=lambda i: (rows["doc_id"][i].as_py(), found[i], rows["buckets"][i].as_py()))  # as partitions come in any order
        rows = rows.take(order).combine_chunks()
        sizes = pa.compute.list_value_length(rows["buckets"]).to_numpy()
        self.w = fit_classifier(np.concatenate(([0], np.cumsum(sizes))), pa.compute.list_flatten(rows["buckets"]).to_numpy(), pa.compute.list_flatten(rows["shares"]).to_numpy(), [self.domains.index(found[i]) for i in order], len(self.domains))
        w = self.w

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, "text"):
                    n, p = posteriors(part.column("text"), w)
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * p.shape[1]), pa.array(p.ravel()))
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n.astype(np.int64)), lists], ["doc_id", "n_tokens", "p"])

        rows = docs.select(own, F.col(f"`{text_col}`").cast("string").alias("text"))
        self.measured = written(rows.mapInArrow(run, "doc_id long, n_tokens long, p array<double>"), "mix-measured")
        self.steps, shares = fit_rates(self.measured, self.weights)
        #: The largest difference of a domain's expected share of tokens from its weight.
        self.gap = float(np.abs(shares - self.weights).max())

    def _copies(self, rate, doc_id):
        luck = F.pmod(F.xxhash64(F.coalesce(doc_id.cast("long"), F.lit(0)), F.lit("copies")), F.lit(1 << 30)) / F.lit(float(1 << 30))
        return (F.floor(rate) + F.when(luck < rate - F.floor(rate), 1).otherwise(0)).cast("int")

    def rates(self, docs: DataFrame) -> DataFrame:
        """(doc_id, n_tokens, domains, p, rate, copies, gap) of each row."""
        if not self.domains:
            return docs.select(integer(docs, self.id_col).alias("doc_id"), F.lit(None).cast("long").alias("n_tokens"), F.array().cast("array<string>").alias("domains"), F.array().cast("array<double>").alias("p"), F.lit(1.0).alias("rate"), F.lit(1).alias("copies"), F.lit(None).cast("double").alias("gap"))
        steps, k = self.steps, len(self.domains)

        @F.arrow_udf("double")
        def rate(p: pa.Array) -> pa.Array:
            return pa.array(replay(p.flatten().to_numpy().reshape(len(p), k), steps))

        rows = self.measured.withColumn("rate", rate("p"))
        return rows.select("doc_id", "n_tokens", F.array(*map(F.lit, self.domains)).alias("domains"), "p", "rate", self._copies(F.col("rate"), F.col("doc_id")).alias("copies"), F.lit(self.gap).alias("gap"))

    def mixed(self, docs: DataFrame) -> DataFrame:
        """docs, each row as often as its rate says. Texts are scored where they are read, and never shuffled."""
        if not self.domains:
            return docs
        steps, w = self.steps, self.w

        @F.arrow_udf("double")
        def rate(texts: pa.Array) -> pa.Array:
            out = [replay(posteriors(part.column("t"), w)[1], steps) for part in slices(pa.RecordBatch.from_arrays([texts], ["t"]), "t")]
            return pa.array(np.concatenate(out) if out else np.zeros(0))

        r, c, n = (free(docs, f"_mix_{x}") for x in ("rate", "copies", "n"))
        rows = docs.withColumn(r, rate(F.col(f"`{self.text_col}`").cast("string")))
        rows = rows.withColumn(c, self._copies(F.col(r), F.col(f"`{self.id_col}`"))).where(F.col(c) > 0)
        return rows.withColumn(n, F.explode(F.sequence(F.lit(1), F.col(c)))).select(*[f"`{x}`" for x in docs.columns])

    def drop(self) -> None:
        """Deletes the table that rates() reads; mixed() doesn't need it."""
        if self.measured is not None:
            drop(self.measured)
