"""Certified rules, the positive-unlabelled classifier and mixing: exact parts by brute force, learned parts on held-out rows."""

from __future__ import annotations

import random
from math import comb

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from metagauge.llm import mixing, pu, rules, style, textcore
from metagauge.llm.sample import lowest


@pytest.mark.parametrize(("k", "n", "p"), [(0, 10, 0.02), (3, 150, 0.02), (20, 400, 0.05), (5, 5, 0.3), (0, 0, 0.5)])
def test_binomial_tail_is_exact(k, n, p):
    assert rules.binomial_tail(k, n, p) == pytest.approx(sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(min(k, n) + 1)))


def test_bounds_and_sequences():
    assert rules.upper_bound(0, 299, 0.05) == pytest.approx(1 - 0.05 ** (1 / 299), abs=1e-6)
    assert rules.upper_bound(0, 0, 0.05) == 1.0
    assert rules.certified([0, 0, 30, 0], 400, 0.02, 0.0125) == 2  # nothing after the first that fails
    assert rules.certified([0], 100, 0.02, 0.0125) == 0
    assert rules.certified([], 0, 0.02, 0.05) == 0


def test_certified_share_holds(spark):
    """Over many draws of labels, false rejection exceeds alpha in no more than about a share delta of them."""
    rng = np.random.default_rng(4)
    over = 0
    for _ in range(300):
        propose, hold, fresh = (rng.exponential(size=n) for n in (600, 600, 20_000))
        cuts = np.quantile(propose, [1 - q for q in rules.RUNGS])
        rung = rules.certified([int((hold > c).sum()) for c in cuts], len(hold), rules.ALPHA, rules.DELTA)
        over += rung > 0 and (fresh > cuts[rung - 1]).mean() > rules.ALPHA
    assert over <= 300 * rules.DELTA


def prose(rng: random.Random, n: int) -> str:
    pool = ["".join(rng.choices("abcdefghilmnoprstu", k=rng.randrange(3, 9))) for _ in range(300)]
    return " ".join(rng.choice(["the", "of", "and", "in", *rng.choices(pool, k=6)]) for _ in range(n))


def junk(rng: random.Random, n: int) -> str:
    return rng.choice([lambda: " ".join(rng.choices(["BUY", "NOW", "$$$", "!!!"], k=n)), lambda: "".join(rng.choices("#$%&*<>{}0123456789 ", k=4 * n)), lambda: "same " * n])()


@pytest.fixture(scope="module")
def graded(spark):
    rng = random.Random(9)
    rows = [(i, prose(rng, rng.randrange(40, 300)) if i % 4 else junk(rng, rng.randrange(40, 300)), "en" if i % 3 else "fr") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(8).cache()
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(4000) if i % 5 < 4], "doc_id long, quality int")
    return docs, labels


def ladder_of(rows: list, sign: dict) -> list[list]:
    """Cutoffs that proposing rows give, by sorting."""
    good, bad = ([r for r in rows if r["good"] == g] for g in (1, 0))
    out = []
    for r, up in sign.items():
        k = 1 if up else -1
        v = sorted(k * x[r] for x in good)
        beyond = sorted(k * x[r] for x in bad if k * x[r] > v[-1])
        middle = beyond[(len(beyond) - 1) // 2] if beyond else None
        gaps = [None if middle is None else k * (v[-1] + g * (middle - v[-1])) for g in rules.GAPS]
        out.append(gaps + [k * v[max(0, int(np.ceil((1 - q) * len(v) - 1e-9)) - 1)] for q in rules.RUNGS])
    rungs = [list(x) for x in zip(*out)]
    return [x for i, x in enumerate(rungs) if any(c is not None for c in x) and (i == 0 or x != rungs[i - 1])]


def broken(x, cuts) -> bool:
    return any(c is not None and (x[r] > c if up else x[r] < c) for (r, up), c in zip(rules.RULES.items(), cuts))


def test_cutoffs_equal_brute_force(spark, graded):
    """Proposals, tests and decisions recomputed from all labelled rows in Python."""
    docs, labels = graded
    copies = docs.where("doc_id % 4 = 1 and doc_id < 400").select((F.col("doc_id") + 10**6).alias("doc_id"), "text", "lang")
    docs = docs.union(copies)
    labels = labels.union(copies.select("doc_id", F.lit(1)))
    fitted = rules.fit(style.table(docs, keep=("lang",), family=True), labels)
    good = {r.doc_id: r.quality for r in labels.collect()}
    rows = [r.asDict() | {"good": good[r.doc_id]} for r in style.table(docs, keep=("lang",), family=True).withColumn("part", F.pmod(F.xxhash64("family", F.lit("rules")), F.lit(rules.PARTS))).collect() if r.doc_id in good]
    by_text = {r.doc_id: r.text for r in docs.collect()}
    parts = {}
    for r in rows:  # copies fall to one part
        assert parts.setdefault(by_text[r["doc_id"]], r["part"]) == r["part"]
    ps, tests = [], []
    for s in sorted(fitted):
        ladder = ladder_of([r for r in rows if r["k0"] == s and r["part"] == 0], rules.RULES)
        first = {}
        for r in sorted((r for r in rows if r["k0"] == s and r["part"] and r["good"] == 1), key=lambda r: r["doc_id"]):
            first.setdefault(r["family"], r)
        counts = [sum(broken(r, cuts) for r in first.values()) for cuts in ladder]
        ps.append([sum(comb(len(first), i) * rules.ALPHA**i * (1 - rules.ALPHA) ** (len(first) - i) for i in range(k + 1)) for k in counts])
        tests.append((ladder, counts, len(first)))
    passed, _ = rules.graph(ps, rules.DELTA)
    for s, n, (ladder, counts, families) in zip(sorted(fitted), passed, tests):
        x = fitted[s]
        assert n > 0 and (x["rung"], x["n"], x["rejected"]) == (n, families, counts[n - 1]) and x["bound"] <= rules.ALPHA + 1e-9
        assert [c is None for c in x["cuts"]] == [c is None for c in ladder[n - 1]] and [c for c in x["cuts"] if c is not None] == pytest.approx([c for c in ladder[n - 1] if c is not None])
    measured = {(r.doc_id, r.k0): r.asDict() for r in style.table(docs, keep=("lang",), family=True).collect()}
    for r in rules.decide(docs, labels).collect():
        x = measured[r.doc_id, r.stratum]
        assert r.failed == [name for (name, up), c in zip(rules.RULES.items(), fitted[r.stratum]["cuts"]) if c is not None and (x[name] > c if up else x[name] < c)] and r.keep == (not r.failed)


def test_rules_keep_good_and_reject_bad(graded):
    docs, labels = graded
    out = {r.doc_id: r for r in rules.decide(docs, labels).collect()}
    assert np.mean([r.keep for d, r in out.items() if d % 4]) > 1 - rules.ALPHA
    assert np.mean([not r.keep for d, r in out.items() if d % 4 == 0]) > 0.9


def test_levels_are_handed_on():
    """Sums of levels, Holm's gain over fixed shares, and the error over draws in which some hypotheses are true."""
    assert rules.graph([[0.001], [0.03]], 0.05)[0] == [1, 1]  # 0.03 is over 0.025 but not over all of 0.05
    assert rules.graph([[0.001], [0.06]], 0.05)[0] == [1, 0]
    assert rules.graph([[0.03, 0.0]], 0.05)[0] == [2] and rules.graph([[0.06, 0.0]], 0.05)[0] == [0]
    assert rules.graph([[], [0.01]], 0.05)[0] == [0, 1] and rules.graph([], 0.05) == ([], [])
    passed, level = rules.graph([[0.0, 0.0, 1.0], [0.02, 1.0], [1.0]], 0.06)
    assert passed == [2, 1, 0] and level[1] >= 0.02
    rng = np.random.default_rng(6)
    wrong = 0
    for _ in range(2000):  # rungs after the first two are true nulls, and so is all of the last stratum
        p = [[*(rng.random(2) * 1e-4), *rng.random(3)] for _ in range(4)] + [list(rng.random(3))]
        passed, _ = rules.graph(p, 0.05)
        wrong += any(n > 2 for n in passed[:4]) or passed[4] > 0
    assert wrong <= 2000 * 0.05 + 3 * (2000 * 0.05 * 0.95) ** 0.5


def test_rules_awkward(awkward, labels):
    rows = rules.decide(awkward, labels).collect()
    assert len(rows) == awkward.count() and all(r.keep and r.bound is None for r in rows)
    assert rules.decide(awkward.limit(0), labels).count() == 0
    assert all(r.keep for r in rules.decide(awkward, labels.limit(0)).collect())
    with pytest.raises(ValueError, match="ids are integers"):
        rules.decide(awkward.withColumn("doc_id", F.concat(F.lit("a"), F.col("doc_id").cast("string"))), labels)


def plain_measures(t: str | None) -> list[float]:
    """All of style.NAMES, character by character."""
    t = t or ""
    white = " \t\n\r\x0b\x0c"
    words = [w for w in "".join(" " if c in white else c.lower() if c.isascii() else c for c in t).split(" ") if w]
    raw = [w for w in "".join(" " if c in white else c for c in t).split(" ") if w]
    n, some = len(words), max(1, len(words))
    solid = max(1, sum(c not in white for c in t))
    ascii_letters = [c for c in t if c.isascii() and c.isalpha()]
    grams = [tuple(words[i : i + 5]) for i in range(n - 4)]
    lines = [x for x in t.lower().replace("\r", "\n").split("\n") if x]
    return [
        n, sum(map(len, raw)) / n if n else 0, sum(c in "!#$%&*+/<=>@[\\]^_`{|}~" for c in t) / solid, sum(c.isupper() for c in ascii_letters) / max(1, len(ascii_letters)), sum(c in "0123456789" for c in t) / solid,
        sum(not any(c.isalpha() or not c.isascii() for c in w) for w in raw) / some, sum(w in style._STOP for w in words) / some, sum(a == b for a, b in zip(words, words[1:])) / some,
        (len(grams) - len(set(grams))) / max(1, n - 4), (len(lines) - len(set(lines))) / max(1, len(lines)),
    ]


def test_all_measures_equal_python(awkward, docs):
    texts = [r.text for r in awkward.select("text").collect()] + [r.text for r in docs.select("text").collect()] + ["A b\r\nA b\n\n12 $$ é FÜR für", "x" * 3_000_000, "ab " * 1_000_001]
    assert style.measure(pa.array(texts)).tolist() == [pytest.approx(plain_measures(t)) for t in texts]


def test_long_words_and_texts_hash_alike(monkeypatch):
    """However texts are cut into blocks."""
    texts = pa.array(["abc defg  " * 50 + "z" * 500 + " abc", "", None, "z" * 500, "A" + "z" * 499, " q"])
    want = [textcore.Words.of(texts, fold=f) for f in (False, True)]
    for size in (1, 7, 100):
        monkeypatch.setattr(textcore, "BLOCK_BYTES", size)
        for w, f in zip(want, (False, True)):
            got = textcore.Words.of(texts, fold=f)
            assert all((getattr(got, x) == getattr(w, x)).all() for x in ("start", "end", "first", "doc", "hash"))
    assert want[0].hash[-2] != want[0].hash[-3] == want[0].hash[100] and len(want[0].hash) == 105


def test_measures_equal_python(awkward):
    def want(t):
        w = (t or "").split()
        if not w:
            return (0, 0, 0)
        grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        return (len(w), sum(a == b for a, b in zip(w, w[1:])) / len(w), (len(grams) - len(set(grams))) / max(1, len(w) - 4))

    texts = [None, "", "a a a a a a a", "b c d e f b c d e f", "  x\n y ", "one", "p q r s t u v w"]
    import pyarrow as pa

    got = style.measure(pa.array(texts))
    at = [style.NAMES.index(n) for n in ("n_words", "same_as_last", "repeated_grams")]
    assert [tuple(r) for r in got[:, at]] == [pytest.approx(want(t)) for t in texts]


def test_sample_is_of_the_least_hashes(spark):
    df = spark.range(5000).withColumnRenamed("id", "doc_id").repartition(5)
    key = F.xxhash64("doc_id", F.lit("t"))
    want = [r.doc_id for r in df.orderBy(F.pmod(key, F.lit(1 << 40)), "doc_id").limit(100).collect()]
    assert [r.doc_id for r in lowest(df, 100, 5000, key, "doc_id")] == want
    assert len(lowest(df, 9000, 5000, key, "doc_id")) == 5000
    assert len(lowest(df.withColumn("doc_id", F.lit(1)), 100, 5000, F.xxhash64("doc_id"), "doc_id")) == 100  # hashes that repeat


def test_classifier_on_held_out_rows(graded):
    docs, labels = graded
    out = {r.doc_id: r for r in pu.score(docs, labels).collect()}
    known = {r.doc_id for r in labels.collect()}
    held = [r for d, r in out.items() if d not in known]
    assert np.mean([r.keep == (r.doc_id % 4 > 0) for r in held]) > 0.95
    assert np.mean([r.keep for r in held if r.doc_id % 4]) > 0.97
    kept = {r.doc_id for r in pu.quality_filter(docs, labels).collect()}
    assert kept == {d for d, r in out.items() if r.keep}


def test_wrong_positive_labels_keep_no_junk(graded):
    """1% of the positive labels are of junk; other junk goes nevertheless."""
    docs, labels = graded
    wrong = {i for i in range(0, 4000, 4) if i % 5 < 4 and i % 33 == 0}
    assert 0.008 < len(wrong) / labels.where("quality = 1").count() < 0.015
    quality = F.when(F.col("doc_id").isin(*wrong), 1).otherwise(F.col("quality")).alias("quality")
    out = {r.doc_id: r.keep for r in pu.score(docs, labels.select("doc_id", quality)).collect()}
    assert np.mean([k for d, k in out.items() if d % 4 == 0]) < 0.05
    assert np.mean([k for d, k in out.items() if d % 4]) > 0.97


def test_model_is_of_all_documents(spark):
    """Means, deviations and weights of a table past any sample's size equal those of all of its rows in numpy."""
    rng = np.random.default_rng(6)
    n = 60_000
    x = rng.random((n, len(style.NAMES)))
    x[:, 0] = rng.integers(1, 500, n)
    good = np.arange(n) % 4 > 0
    x[~good, 2] += 1
    df = spark.createDataFrame(pa.table({"doc_id": np.arange(n), **{c: x[:, i] for i, c in enumerate(style.NAMES)}}))
    labels = spark.range(0, 6000).where("id % 4 > 0").select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    model = pu.fit(df, labels)
    u = pu.expand(x)
    assert model["center"] == pytest.approx(u.mean(axis=0).tolist(), rel=1e-9)
    assert model["scale"] == pytest.approx(u.std(axis=0).tolist(), rel=1e-9)
    z = pu._standard(u, u.mean(axis=0), u.std(axis=0))
    want = pu.fit_nnpu(z[:6000][good[:6000]], z, model["prior"])
    s, t = z @ want, z @ np.array(model["weights"])
    assert ((s >= 0) == (t >= 0)).mean() > 0.999
    assert ((t >= 0) == good).mean() > 0.97


def test_risk_equals_brute_force():
    """No weights that plain gradient descent finds from many starts have a lower non-negative risk."""
    rng = np.random.default_rng(12)
    p = np.concatenate([rng.normal(1, 1, (400, 2)), np.ones((400, 1))], axis=1)
    u = np.concatenate([np.concatenate([rng.normal(1, 1, (500, 2)), rng.normal(-1.5, 1, (500, 2))]), np.ones((1000, 1))], axis=1)
    s = lambda z: 1 / (1 + np.exp(-z))

    def value(w):
        return 0.5 * (1 - s(p @ w)).mean() + max(0.0, s(u @ w).mean() - 0.5 * s(p @ w).mean())

    best = np.inf
    for _ in range(20):
        w = rng.normal(0, 2, 3)
        for _ in range(2000):
            zp, zu = s(p @ w), s(u @ w)
            g = -0.5 * (zp * (1 - zp)) @ p / len(p)
            rest = zu.mean() - 0.5 * zp.mean()
            if rest >= 0:
                g += (zu * (1 - zu)) @ u / len(u) - 0.5 * (zp * (1 - zp)) @ p / len(p)
            w = w - 2 * (g + 1e-4 * w)
        best = min(best, value(w) + 0.5e-4 * w @ w)
    got = pu.fit_nnpu(p, u, 0.5)
    assert value(got) == pytest.approx(pu.risk(p, u, got, 0.5)) and value(got) + 0.5e-4 * got @ got <= best + 1e-3


def test_prior_and_risk():
    rng = np.random.default_rng(2)
    p = np.concatenate([rng.normal(2, 1, (3000, 1)), np.ones((3000, 1))], axis=1)
    u = np.concatenate([np.concatenate([rng.normal(2, 1, (1800, 1)), rng.normal(-2, 1, (1200, 1))]), np.ones((3000, 1))], axis=1)
    w = pu.fit_nnpu(p, u, 0.6)
    assert 0 <= pu.risk(p, u, w, 0.6) < 0.1
    assert (p @ w > 0).mean() > 0.95 and (u[1800:] @ w < 0).mean() > 0.95
    edges = np.linspace(-6, 6, 101)
    assert pu.estimate_prior(np.histogram(p[:, 0], edges)[0].astype(float), np.histogram(u[:, 0], edges)[0].astype(float)) == pytest.approx(0.6, abs=0.06)


def test_classifier_awkward(awkward, labels):
    rows = pu.score(awkward, labels).collect()
    assert len(rows) == awkward.count() and not any(r.keep for r in rows if r.doc_id in (1, 2, 4))
    assert pu.quality_filter(awkward, labels).columns == awkward.columns
    assert pu.score(awkward.limit(0), labels).count() == 0
    assert all(r.keep and r.posterior is None for r in pu.score(awkward, labels.limit(0)).collect())


@pytest.fixture(scope="module")
def mixable(spark):
    rng = random.Random(3)
    own = {d: [f"{d}{i}" for i in range(200)] for d in ("en", "fr", "de")}
    both = [f"c{i}" for i in range(100)]
    rows = []
    for i in range(1500):
        d = rng.choices(("en", "fr", "de"), (8, 1, 1))[0]
        rows.append((i, " ".join(rng.choices(own[d] + both, k=rng.randrange(1, 200))), d))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(6).cache()
    return docs, spark.createDataFrame([(i,) for i in range(0, 1500, 3)], "doc_id long"), {"en": 0.5, "fr": 0.3, "de": 0.2}


def test_expected_tokens_match_targets(mixable):
    docs, labels, targets = mixable
    fitted = mixing.Mix(docs, labels, targets)
    rows = fitted.rates(docs).collect()
    n, p, rate = np.array([r.n_tokens for r in rows], float), np.array([r.p for r in rows]), np.array([r.rate for r in rows])
    assert (rate >= 0).all() and len(rows) == 1500
    got = (rate * n) @ p / n.sum()
    assert got == pytest.approx([targets[d] for d in fitted.domains], abs=1e-4)
    assert rate == pytest.approx(mixing.replay(p, fitted.steps))
    truth = {r.doc_id: r.lang for r in docs.collect()}
    held = [fitted.domains[int(np.argmax(r.p))] == truth[r.doc_id] for r in rows if r.doc_id % 3 and r.n_tokens > 20]
    assert np.mean(held) > 0.97
    out = fitted.mixed(docs).groupBy("lang").agg(F.sum(F.size(F.split("text", " "))).alias("n")).collect()
    total = sum(r.n for r in out)
    assert {r.lang: r.n / total for r in out} == pytest.approx(targets, abs=0.05)
    copies = {r.doc_id: r.copies for r in rows}
    assert {r.doc_id: r["count"] for r in fitted.mixed(docs).groupBy("doc_id").count().collect()} == {d: c for d, c in copies.items() if c}


def plain_gradient(n: np.ndarray, p: np.ndarray, target: np.ndarray, inverse: np.ndarray, steps: int = 100_000) -> np.ndarray:
    """Rates by projected gradient steps of one length on every rate."""
    r = point = np.ones(len(n))
    t = 1.0
    pace = 1 / np.linalg.eigvals(inverse @ (n[:, None] * p).T @ p).real.max()
    for _ in range(steps):
        to = np.maximum(0, point - pace * p @ (inverse @ ((n * point) @ p - target)))
        after = 1.0 if (point - to) @ (n * (to - r)) > 0 else (1 + (1 + 4 * t * t) ** 0.5) / 2
        point = to + (t - 1) / after * (to - r) if after > 1 else to
        r, t, moved = to, after, np.abs(to - r).max()
        if moved < 1e-12:
            break
    return r


@pytest.mark.parametrize(("weights", "alike"), [((0.7, 0.2, 0.1), 0.2), ((0.98, 0.01, 0.01), 0.2), ((1.0, 0.0, 0.0), 0.05), ((0.4, 0.3, 0.3), 30.0), ((0.9, 0.05, 0.05), 30.0)])
def test_rates_equal_brute_force(spark, weights, alike):
    """fit_rates and replay against plain gradient steps, with rates clipped at 0, targets of 0 and targets that no rates reach."""
    rng = np.random.default_rng(1)
    n, p = rng.integers(1, 100, 300).astype(float), rng.dirichlet([alike] * 3, 300)
    target = n.sum() * np.array(weights)
    df = spark.createDataFrame(pa.table({"n_tokens": n.astype(np.int64), "p": p.tolist()})).coalesce(2)
    steps, shares = mixing.fit_rates(df, np.array(weights))
    rates = mixing.replay(p, steps)
    gram = (n[:, None] * p).T @ p
    inverse = np.linalg.inv(gram + mixing.RIDGE * np.trace(gram) / 3 * np.eye(3))
    want = plain_gradient(n, p, target, inverse)
    cost = lambda r: ((n * r) @ p - target) @ inverse @ ((n * r) @ p - target)
    assert (rates >= 0).all() and shares == pytest.approx((n * rates) @ p / n.sum(), abs=1e-9)
    assert cost(rates) <= 1.1 * cost(want) + 1e-4 * cost(np.ones(300))
    if weights[0] < 0.9 or alike < 1:
        assert shares == pytest.approx(weights, abs=2e-3)
        assert weights[0] < 0.9 or (rates == 0).sum() > 20
    else:
        assert np.abs(shares - weights).max() > 0.5


def test_mixing_awkward(awkward, labels):
    fitted = mixing.Mix(awkward, labels, {"en": 0.5, "fr": 0.3, "es": 0.2})
    assert fitted.rates(awkward).count() == awkward.count()
    assert fitted.mixed(awkward).columns == awkward.columns
    none = mixing.Mix(awkward, labels.limit(0), {"en": 1.0})
    assert {(r.rate, r.copies) for r in none.rates(awkward).collect()} == {(1.0, 1)} and none.mixed(awkward).count() == awkward.count()
    empty = awkward.limit(0)
    assert mixing.Mix(empty, labels, {"en": 1.0}).mixed(empty).count() == 0
    assert mixing.Mix(awkward, labels, {}).mixed(awkward).count() == awkward.count()
    assert mixing.Mix(awkward, labels, {"en": 0.0, "es": 1.0}).mixed(awkward).columns == awkward.columns
    with pytest.raises(ValueError):
        mixing.Mix(awkward, labels, {"en": -1.0})
