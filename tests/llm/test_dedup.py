"""Near and substring deduplication against brute force over all pairs and windows."""

from __future__ import annotations

import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest

from metagauge.llm import minhash, substring

from .conftest import words


def shingle_set(text: str) -> set:
    w = (text or "").split()
    return {tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))} if w else set()


def copies_of(text: str, rng: random.Random, n: int, share: float) -> list[str]:
    out = []
    for _ in range(n):
        w = text.split()
        for i in rng.sample(range(len(w)), int(share * len(w))):
            w[i] = f"z{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.fixture(scope="module")
def near(spark, docs):
    rng = random.Random(5)
    base = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    more = [t for i in range(40) for t in copies_of(words(100 + i, rng.choice([30, 120, 600])), rng, 3, rng.choice([0.0, 0.01, 0.03, 0.05]))]
    rows = base + [(10**6 + i, t) for i, t in enumerate(more)]
    got = minhash.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return dict(rows), {d: r.doc_id for r in got for d in r.copies}


def test_near_duplicates_equal_brute_force(near):
    texts, group = near
    assert set(group) <= set(texts)
    sets = {d: shingle_set(t) for d, t in texts.items()}
    found = total = 0
    parent = {d: d for d in texts}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(texts, 2):
        both = len(sets[a] & sets[b])
        if both and (j := both / len(sets[a] | sets[b])) >= 0.45:
            parent[top(a)] = top(b)
            if j >= minhash.THRESHOLD:
                total += 1
                found += group.get(a) is not None and group.get(a) == group.get(b)
    assert total > 100 and found >= 0.9 * total, (found, total)
    wrong = [(d, k) for d, k in group.items() if top(d) != top(k)]
    assert not wrong
    assert all(k <= d for d, k in group.items())


@pytest.mark.parametrize("bits", [1, 2, 4, 8])
def test_similarity_is_corrected_for_collisions(spark, monkeypatch, bits):
    monkeypatch.setattr(minhash, "BITS", bits)
    monkeypatch.setattr(minhash, "LONGS", minhash.PERMUTATIONS * bits // 64)
    monkeypatch.setattr(minhash, "SIGS", [f"s{i}" for i in range(minhash.LONGS)])
    rng = np.random.default_rng(3)
    for share in (0.0, 0.5, 0.9, 1.0):
        common = rng.integers(0, 2**63, int(2000 * share), dtype=np.uint64)
        own = [np.concatenate([common, rng.integers(0, 2**63, int(1000 * (1 - share)), dtype=np.uint64)]) for _ in range(2)]
        truth = len(common) / max(1, len(common) + 2 * int(1000 * (1 - share)))
        low = minhash.minima(np.concatenate(own), np.array([0, len(own[0]), len(own[0]) + len(own[1])]))
        sig = minhash.packed(low).view(np.int64)
        row = spark.createDataFrame([tuple(map(int, sig[:, 0])) + tuple(map(int, sig[:, 1]))], ", ".join(f"{x}s{i} long" for x in "ab" for i in range(minhash.LONGS)))
        got = row.select(minhash.similarity("a", "b")).first()[0]
        agree = np.mean((low[:, 0] & (2**bits - 1)) == (low[:, 1] & (2**bits - 1)))
        assert got == pytest.approx((agree - 2.0**-bits) / (1 - 2.0**-bits)) and abs(got - truth) < (0.35 if bits == 1 else 0.2)


def test_thousands_of_copies_and_a_chain(spark):
    text, far = words(1, 200), words(2, 200)
    rows = [(i, text) for i in range(3000)] + [(5000, far)]
    got = sorted((r.doc_id, r.n_copies) for r in minhash.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(0, 3000)] or got == [(0, 3000), (5000, 1)]
    kept = sorted(r.doc_id for r in minhash.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert kept == [0, 5000]


def test_components_of_a_long_path(spark):
    rng = random.Random(1)
    nodes = list(range(200))
    rng.shuffle(nodes)
    edges = list(zip(nodes, nodes[1:])) + [(1000, 1001), (1001, 1002)]
    got = {r.node: r.root for r in minhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got.get(n, n) for n in nodes} == {0} and {got.get(n, n) for n in (1000, 1001, 1002)} == {1000}


def test_null_ids_count(spark):
    text, far = words(1, 200), words(2, 200)
    rows = [(None, text), (3, text), (5, text), (None, far), (9, words(3, 200))]
    got = {(r.doc_id, r.n_copies, tuple(r.copies)) for r in minhash.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(None, 3, (None, 3, 5)), (None, 1, (None,)), (9, 1, (9,))}


def test_near_dedup_awkward(awkward):
    out = minhash.near_dedup(awkward)
    assert out.columns == awkward.columns
    kept = sorted(((r.doc_id, (r.text or "")[:20]) for r in out.collect()), key=repr)
    ids = [k[0] for k in kept]
    assert ids.count(6) == 1 and ids.count(7) + ids.count(8) + ids.count(-5) == 1 and -5 in ids
    assert {1, 2, 4, 5, 10} <= set(ids) and ids.count(9) == 2 and ids.count(None) == 2
    assert minhash.near_dedup(awkward.limit(0)).count() == 0 and minhash.groups(awkward.limit(0)).count() == 0
    assert minhash.groups(awkward).count() >= 5


WORKING = {minhash: ("_mh_key", "_mh_hash", "_mh_text", "_mh_row"), substring: ("_sd_key", "_sd_hash", "_sd_text", "_sd_spots", "_sd_marks", "_sd_level", "_sd_whole", "cuts", "longest_repeat")}


@pytest.mark.parametrize(("module", "run"), [(minhash, minhash.near_dedup), (substring, substring.substring_dedup)])
def test_columns_of_working_names_pass_through(spark, module, run):
    text = words(1, 200)
    names = WORKING[module]
    df = spark.createDataFrame([(i, t, *[5] * len(names)) for i, t in enumerate((text, text, words(2, 200)))], "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    rows = run(df).collect()
    assert len(rows) == (2 if module is minhash else 3) and all(list(r)[2 : 2 + len(names)] == [5] * len(names) for r in rows)
    with pytest.raises(ValueError, match="ids are integers"):
        run(df.withColumn("doc_id", substring.F.lit("a17")))


def brute(rows: list[tuple[int, str]], n: int) -> dict[int, list[str]]:
    """Words left of each document, which have different doc_ids."""
    first, out = {}, {}
    for d, t in sorted(rows):
        w = (t or "").split()
        dead = [False] * len(w)
        for i in range(len(w) - n + 1):
            if first.setdefault(tuple(w[i : i + n]), (d, i)) != (d, i):
                dead[i : i + n] = [True] * n
        out[d] = [x for x, gone in zip(w, dead) if not gone]
    return out


def longest(rows: list[tuple[int, str]], n: int) -> dict[int, int]:
    """The longest window that repeats, of lengths n / 2, n, 2n ..."""
    n //= 2
    out = defaultdict(int)
    while True:
        seen = defaultdict(set)
        for d, t in rows:
            w = t.split()
            for i in range(len(w) - n + 1):
                seen[tuple(w[i : i + n])].add((d, i))
        again = {d for s in seen.values() if len(s) > 1 for d, _ in s}
        if not again:
            return out
        out.update(dict.fromkeys(again, n))
        n *= 2


def corpus(seed: int, n: int) -> list[tuple[int, str]]:
    rng = random.Random(seed)
    passages = [words(seed * 100 + i, rng.choice([n - 1, n, n + 1, 2 * n, 5 * n])) for i in range(6)]
    rows = []
    for d in range(40):
        parts = []
        for _ in range(rng.randrange(5)):
            parts.append(words(rng.randrange(10**9), rng.randrange(1, 2 * n)))
            if rng.random() < 0.5:
                parts.append(rng.choice(passages))
        rows.append((d, " ".join(parts)))
    rows += [(100, "a " * 3 * n), (101, "a b " * 2 * n), (102, rows[1][1]), (103, "")]
    return rows


@pytest.mark.parametrize(("seed", "n", "hot"), [(1, 8, substring.HOT), (2, 8, substring.HOT), (2, 8, 2), (3, 20, 1), (4, 50, substring.HOT), (4, 50, 3)])
def test_cuts_equal_brute_force(spark, seed, n, hot):
    """Also with minimizers that are hot from few places on."""
    rows = corpus(seed, n)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = substring.substring_dedup(df, min_words=n, hot=hot).collect()
    want = brute(rows, n)
    assert {r.doc_id: r.text.split() for r in out} == want
    most = longest(rows, n)
    for r in out:
        before = dict(rows)[r.doc_id]
        assert (r.cuts is None) == (len(want[r.doc_id]) == len(before.split()))
        assert r.longest_repeat == (most[r.doc_id] if most[r.doc_id] >= n else None)
        if r.cuts is None:
            assert r.text == before
    if hot < substring.HOT:
        assert {r.doc_id: r.text.split() for r in substring.substring_dedup(df, min_words=n, hot=hot, report=False).collect()} == want


def test_blocks_of_buckets_are_whole(spark, monkeypatch):
    """Buckets that span batches and blocks are compared as one."""
    rng = np.random.default_rng(8)
    bucket = np.sort(rng.integers(0, 40, 3000))
    value, k = rng.integers(0, 30, 3000), rng.integers(0, 300, 3000)
    no = np.zeros(3000, bool)
    one = substring._parts([bucket, k, k * 7, np.zeros(3000, np.int32), np.ones(3000, np.int64), no, no], substring._lists(value, np.ones(3000, np.int64), substring.pa.int64()), most=100)
    monkeypatch.setattr(substring, "BLOCK", 50)
    got = [r for b in substring._survive(iter(list(one))) for r in b.to_pylist()]
    group = defaultdict(set)
    for b, v, d in zip(bucket.tolist(), value.tolist(), k.tolist()):
        group[b, v].add(d)
    want = sorted((d, int(min(group[b, v]) != d)) for b, v, d in zip(bucket.tolist(), value.tolist(), k.tolist()) if len(group[b, v]) > 1)
    assert sorted((r["k"], r["dead"]) for r in got) == want and all(r["again"] == 1 for r in got)


def test_cuts_on_documents_equal_brute_force(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    out = substring.substring_dedup(docs).collect()
    assert {r.doc_id: r.text.split() for r in out} == brute(rows, 50)


def test_substring_awkward(awkward):
    out = substring.substring_dedup(awkward)
    assert out.columns == [*awkward.columns, "_cuts", "_longest_repeat"]
    rows = out.collect()
    by = {(r.doc_id, r.source): r for r in rows}
    assert len(rows) == awkward.count() and sum(r.doc_id == 6 for r in rows) == 2
    assert by[2, "s"].text is None and by[1, "s"].text == "" and by[4, "s"].text == " \n\t "
    assert by[-5, None].text.split() and [r.text for r in rows if r.doc_id in (7, 8)] == [""] * 3
    assert [r.n_chars for r in rows if r.doc_id == 7] == [0, 0]
    assert len({r.text for r in rows if r.doc_id == 6}) == 1 and all(len(r.text) > 300_000 for r in rows if r.doc_id == 6)
    assert substring.substring_dedup(awkward, report=False).columns == awkward.columns
    assert substring.substring_dedup(awkward.limit(0)).count() == 0
