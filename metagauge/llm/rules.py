"""Quality rules whose cutoffs are certified on labelled holdouts.

A rule rejects a text for one measure of its form beyond a cutoff. Labelled
documents are parted by the family of their text (the least hash of its runs of
five words), so that copies, and most near copies, fall to one part. Per stratum
a fifth of the families propose a ladder of cutoffs, ever stricter, at first
beyond all good documents: between the farthest of them and the median of the
bad documents that are farther (of this stratum, or of all where it has none),
then shares of the good documents themselves.

The other families test the rungs, each by one good document: rung by rung, the exact
binomial probability of so few rejections, were the share of good families that
any rule rejects above ``alpha``, must not exceed the level of its test. Levels
are those of a sequentially rejective graph over all strata and rungs: each
stratum begins with ``delta`` / strata at its first rung; a rung that passes hands half of its
level to the next one and half to the other strata. So with probability 1 -
delta no stratum loses more than a share alpha of its good families. The last rung
that passes holds.

Counts and quantiles cover all labelled rows; quantiles are approximate, which
only moves what is proposed, not what is certified.

Defined results: a stratum without enough labelled documents to certify the
first rung has no rules and keeps everything. Null and empty texts break no
rule but too few stop words, and are rejected only where that is certified; a null stratum
counts as "". A document with several labels is good only if all are. doc_ids are
integers (ValueError otherwise); a null one has no label. Repeated
rows count once in tests and are decided alike. Extra columns are ignored.
"""

from __future__ import annotations

from itertools import groupby
from math import exp, lgamma, log

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import integer
from .scratch import drop, written
from .style import table

#: Rules and whether they reject values above (or below) their cutoff.
RULES = {"word_chars": True, "symbols": True, "capitals": True, "digits": True, "bare_words": True, "stop_words": False, "same_as_last": True, "repeated_grams": True, "repeated_lines": True}
#: First places between the farthest good document (0) and the median of farther bad ones (1), then shares of good documents.
GAPS = (0.9, 0.7, 0.5, 0.3, 0.15, 0.05, 0.0)
RUNGS = (0.0001, 0.0002, 0.0005, 0.001, 0.002, 0.003, 0.005, 0.008)
ALPHA, DELTA = 0.02, 0.05
ACCURACY = 100_000
#: One of so many parts of the families proposes.
PARTS = 5


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Bin(n, p), exactly, summed in logarithms."""
    if k >= n or p <= 0:
        return 1.0
    if p >= 1:
        return 0.0
    i = np.arange(k + 1)
    terms = np.array([lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) for j in i.tolist()]) + i * log(p) + (n - i) * np.log1p(-p)
    top = terms.max()
    return float(min(1.0, exp(top) * np.exp(terms - top).sum()))


def upper_bound(k: int, n: int, error: float) -> float:
    """The one-sided Clopper-Pearson bound on a share of which k of n were seen."""
    if n == 0 or k >= n:
        return 1.0
    low, high = k / n, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if binomial_tail(k, n, mid) > error else (low, mid)
    return high


def graph(p_values: list[list[float]], error: float) -> tuple[list[int], list[float]]:
    """How many rungs of each stratum, from the first on, pass together at this error, and the level of the last that did.

    A sequentially rejective procedure: a passing rung's level goes half to the stratum's next rung and half to the other
    strata's, or all of it to what there is.
    """
    nodes = [(s, i) for s, ps in enumerate(p_values) for i in range(len(ps))]
    at = {x: n for n, x in enumerate(nodes)}
    p = np.array([x for ps in p_values for x in ps])
    firsts = [at[s, i] for s, i in nodes if i == 0]
    level, edge = np.zeros(len(p)), np.zeros((len(p), len(p)))
    level[firsts] = error / max(1, len(firsts))
    for (s, i), n in at.items():
        others = [f for f in firsts if f != at[s, 0]]
        if (s, i + 1) in at:
            edge[n, at[s, i + 1]] = 0.5 if others else 1
        edge[n, others] = (0.5 if (s, i + 1) in at else 1) / max(1, len(others))
    passed, held = [0] * len(p_values), [0.0] * len(p_values)
    while len(hits := np.flatnonzero((level > 0) & (p <= level))):
        j = int(hits[0])
        s = nodes[j][0]
        passed[s], held[s] = passed[s] + 1, float(level[j])
        level = level + level[j] * edge[j]
        keeps = 1 - edge[:, j] * edge[j]
        edge = (edge + np.outer(edge[:, j], edge[j])) / np.where(keeps > 1e-12, keeps, np.inf)[:, None]
        np.fill_diagonal(edge, 0)
        edge[:, j] = edge[j] = level[j] = 0
    return passed, held


def certified(counts: list[int], n: int, alpha: float, error: float) -> int:
    """How many rungs of a single stratum, from the first on, pass: counts are holdout rejections at each."""
    return graph([[binomial_tail(k, n, alpha) if n else 1.0 for k in counts]], error)[0][0]


def _broken(cuts: list[float | None]) -> list[Column]:
    """Whether each rule that has a cutoff is broken."""
    return [F.coalesce(F.col(r) > F.lit(float(c)) if up else F.col(r) < F.lit(float(c)), F.lit(False)) if c is not None else F.lit(False) for (r, up), c in zip(RULES.items(), cuts)]


def proposals(rows: DataFrame) -> dict[str, list[list[float | None]]]:
    """Per stratum, from the labelled rows that propose: cutoffs of RULES at each of GAPS and RUNGS, ever stricter; None for no cutoff."""
    stratum = "stratum"
    sign = {r: 1 if up else -1 for r, up in RULES.items()}
    of = lambda r: F.col(r) * sign[r]
    good = rows.where("good = 1").groupBy(stratum).agg(*[F.max(of(r)).alias(f"{r}_most") for r in RULES], *[F.percentile_approx(of(r), [1 - q for q in RUNGS], ACCURACY).alias(r) for r in RULES]).collect()
    good = {x[stratum]: x for x in good}

    def medians(of_all: bool) -> dict:
        most = lambda r: F.coalesce(*[F.when(F.col(stratum) == s, F.lit(x[f"{r}_most"])) for s, x in good.items()])
        beyond = [F.percentile_approx(F.when(of(r) > most(r), of(r)), 0.5, ACCURACY).alias(r) for r in RULES]
        bad = rows.where("good = 0")
        return {x[stratum]: x for x in bad.groupBy(F.lit("").alias(stratum) if of_all else F.col(stratum)).agg(*beyond).collect()}

    if not good:
        return {}
    own, pooled = medians(False), medians(True).get("")
    out = {}
    for s, x in good.items():
        ladder: list[list[float | None]] = []
        for r in RULES:
            most, bad = x[f"{r}_most"], own[s][r] if s in own else pooled[r] if pooled else None
            gaps = [None if bad is None or bad <= most else sign[r] * (most + g * (bad - most)) for g in GAPS]
            ladder.append([*gaps, *(sign[r] * v for v in x[r])])
        out[s] = [list(rung) for rung, _ in groupby(zip(*ladder)) if any(c is not None for c in rung)]  # equal rungs are one
    return out


def fit(measured: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA, id_col: str = "doc_id", label_col: str = "quality") -> dict[str, dict]:
    """Per stratum: cuts (of RULES, or None), rung, families that tested n and rejections, and the exact upper bound on false rejection.

    measured is style.table() with families and the stratum in k0.
    """
    graded = labels.groupBy(integer(labels, id_col).alias("doc_id")).agg(F.min(F.col(f"`{label_col}`")).cast("int").alias("good")).where("good is not null")
    rows = measured.join(graded, "doc_id").select("doc_id", "family", F.coalesce("k0", F.lit("")).alias("stratum"), "good", *RULES)
    rows = written(rows.withColumn("part", F.pmod(F.xxhash64("family", F.lit("rules")), F.lit(PARTS))), "rules-labelled")
    proposed = proposals(rows.where("part = 0"))
    tested = rows.where("part > 0 and good = 1").groupBy("stratum", "family").agg(F.min(F.struct("doc_id", *RULES)).alias("x")).select("stratum", "x.*")

    any_of = lambda cs: F.greatest(*[c.cast("int") for c in cs])
    tests = [F.count(F.lit(1)).alias("n")]
    for i in range(max(map(len, proposed.values()), default=0)):
        hit = F.lit(0)
        for s, rungs in proposed.items():
            if i < len(rungs):
                hit = F.when(F.col("stratum") == s, any_of(_broken(rungs[i]))).otherwise(hit)
        tests.append(F.sum(hit).alias(f"r{i}"))
    seen = {x["stratum"]: x for x in tested.groupBy("stratum").agg(*tests).collect()}
    strata = sorted(x["stratum"] for x in rows.select("stratum").distinct().collect())
    counts = [[seen[s][f"r{i}"] for i in range(len(proposed[s]))] if s in seen and s in proposed else [] for s in strata]
    passed, level = graph([[binomial_tail(k, seen[s]["n"], alpha) for k in ks] for s, ks in zip(strata, counts)], delta)
    out = {}
    for s, ks, rung, error in zip(strata, counts, passed, level):
        n, k = seen[s]["n"] if s in seen else 0, ks[rung - 1] if rung else 0
        out[s] = {"cuts": proposed[s][rung - 1] if rung else None, "rung": rung, "n": n, "rejected": k, "bound": upper_bound(k, n, error) if rung else 1.0}
    drop(rows)
    return out


def failed(fitted: dict[str, dict]) -> Column:
    """array<string>: names of the rules that a measured row breaks."""
    out = F.array().cast("array<string>")
    for s, x in fitted.items():
        if x["cuts"]:
            out = F.when(F.coalesce("k0", F.lit("")) == s, F.array_compact(F.array(*[F.when(b, F.lit(r)) for r, b in zip(RULES, _broken(x["cuts"]))]))).otherwise(out)
    return out


def decide(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(doc_id, stratum, keep, failed, bound) of each row; bound is the stratum's certified share of false rejections, null without rules."""
    measured = written(table(docs, id_col, text_col, (stratum_col,), family=True), "rules-measured")
    fitted = fit(measured, labels, alpha, delta)
    bound = F.lit(None).cast("double")
    for s, x in fitted.items():
        if x["cuts"]:
            bound = F.when(F.coalesce("k0", F.lit("")) == s, F.lit(x["bound"])).otherwise(bound)
    rows = measured.withColumn("failed", failed(fitted))
    return rows.select("doc_id", F.col("k0").alias("stratum"), (F.size("failed") == 0).alias("keep"), "failed", bound.alias("bound"))
