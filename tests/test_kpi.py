"""Indicators against a row-by-row model in Python, quirks and golden identities."""

from __future__ import annotations

import random

import pytest

from metagauge.functions import expr
from metagauge.operators import kpi

C, R = kpi.CATALOG, kpi.RESOURCE


def nb(v):
    return v is not None and v.strip() != ""


def http(v):
    return v.startswith(("http://", "https://"))


def model_resource(r):
    link = r[R["url"]] if r[R["url"]] is not None else r[R["file"]]
    whole = nb(r[R["title"]]) and nb(r[R["format"]]) and link is not None
    fmt = r[R["format"]]
    sector = r[R["sector"]] if r[R["sector"]] is not None else "nan"
    api = (r[R["api"]] if r[R["api"]] is not None else "nan").strip().lower()
    state = nb(r[R["govt"]]) and (r[R["govt"]].strip().lower() != "state" or nb(r[R["department"]]))
    return [
        whole, whole, fmt is not None and "/" in fmt and nb(r[R["category"]]), state, False, nb(fmt) and link is not None,
        any(ord(ch) > 127 for c in ("title", "note") for ch in r[R[c]] or ""), api not in ("", "nan") or (fmt is not None and "json" in fmt.lower()),
        link is not None and http(link), nb(r[R["title"]]) and nb(fmt), sector.strip().lower() not in ("", "all"),
    ]


def rows_of(names, n, seed, values):
    rng = random.Random(seed)
    return [{name: rng.choice(values[role]) for role, name in names.items()} for _ in range(n)]


_ANY = [None, "", "  ", " ", "x", "Ä x"]
RESOURCES = rows_of(R, 300, 1, {
    "parent": [None, "a", "b", "c", "d "], "title": _ANY, "format": [None, "", " ", "text/csv", "JSON", "WMS"], "file": [None, "", "http://x/y", "ftp://x"], "url": [None, None, "https://x", "x"],
    "note": _ANY, "category": [None, "open", " "], "govt": [None, "State", " state", "Central", ""], "department": _ANY, "api": [None, "", "nan", "NaN ", "http://api"], "sector": [None, "", "All", " all ", "Health"],
})
CATALOGS = rows_of(C, 200, 2, {"title": [None, "", "a", "b", "c", "d ", "e"], **{r: ["x", "x", "y ü", None, " "] for r in C if r not in ("title", "sector")}, "sector": [None, "All", "Health", ""]})


@pytest.fixture(scope="module")
def tables(spark):
    res = spark.createDataFrame([tuple(r.values()) + (i,) for i, r in enumerate(RESOURCES)], ", ".join(f"`{n}` string" for n in R.values()) + ", ord long")
    cat = spark.createDataFrame([tuple(c.values()) for c in CATALOGS], ", ".join(f"`{n}` string" for n in C.values()))
    return cat, res


def test_resource_flags_equal_model(tables):
    got = sorted(tuple(r[k] for k in kpi.RESOURCE_KPIS) for r in kpi.resource_kpis(tables[1]).collect())
    assert got == sorted(tuple(int(bool(x)) for x in model_resource(r)) for r in RESOURCES)


def test_catalog_flags_equal_model(tables):
    def model(c):
        kids = [r for r in RESOURCES if c[C["title"]] is not None and r[R["parent"]] == c[C["title"]]]
        whole = all(nb(c[C[r]]) for r in ("title", "description", "published", "ministry", "alias"))
        valid = [nb(r[R["format"]]) and (r[R["url"]] is not None or r[R["file"]] is not None) for r in kids]
        link = [r[R["url"]] if r[R["url"]] is not None else r[R["file"]] for r in kids]
        sector = "nan" if c[C["sector"]] is None else c[C["sector"]]
        return (
            whole, whole and bool(kids), all(nb(c[C[r]]) for r in ("jurisdiction", "govt", "ministry", "sector")), nb(c[C["jurisdiction"]]), False, None if valid and valid[0] else 0,
            any(ord(ch) > 127 for r in ("title", "description") for ch in c[C[r]] or ""), bool(kids) and all(x is not None and http(x) for x in link),
            all(nb(c[C[r]]) for r in ("title", "description", "published", "ministry", "keywords")), sector.strip().lower() not in ("", "all"), any(valid),
        )

    names = (*kpi.CATALOG_KPIS, "DistributionIntegrityAny")
    got = sorted((tuple(r[k] for k in names) for r in kpi.catalog_kpis(*tables).collect()), key=repr)
    assert got == sorted((tuple(x if x is None else int(bool(x)) for x in model(c)) for c in CATALOGS), key=repr)
    assert len(got) == len(CATALOGS)


def test_optional_columns_may_be_absent_and_required_may_not(spark):
    df = spark.createDataFrame([("t", "text/csv", None, "http://x", None)], "title string, file_format string, datafile string, datafile_url string, note string")
    row = kpi.resource_kpis(df).first()
    assert (row.SectorAccuracy, row.JurisdictionComplete, row.LinkValidity, row.TotalScore) == (0, 0, 1, 5)
    with pytest.raises(KeyError):
        kpi.resource_kpis(df.drop("note"))


def test_empty_tables(tables):
    cat, res = (t.limit(0) for t in tables)
    assert kpi.catalog_kpis(cat, res).count() == 0
    assert {(r.Fulfilled, r.Total, r.Percent) for r in kpi.fulfilment_summary(kpi.resource_kpis(res), "Resource").collect()} == {(0, 0, 0.0)}
    assert kpi.completeness(res, ["title"]).first().pct is None


def test_completeness_counts_blanks_and_vocabulary_trims(spark):
    df = spark.createDataFrame([("a", " State "), ("", "state"), (None, None), ("b", "Central")], "title string, govt_type string")
    assert kpi.completeness(df, ["title"]).first().pct == 75.0
    got = {r.field: r.pct for r in kpi.vocabulary_compliance(df, ["govt_type", "frequency", "title", "govt_type"], kpi.VOCABULARIES).collect()}
    assert got == {"govt_type": 50.0, "frequency": 0.0, "title": None}


@pytest.mark.parametrize(("fulfilled", "total", "percent"), [(84, 86, 97.7), (51, 86, 59.3), (83, 86, 96.5), (80, 86, 93.0), (51, 54, 94.4), (13, 54, 24.1), (50, 54, 92.6)])
def test_known_percentages(spark, fulfilled, total, percent):
    df = spark.range(total).selectExpr(f"cast(id < {fulfilled} as int) as k", "'x' as CatalogTitle")
    got = {r.KPI: r for r in kpi.fulfilment_summary(df, "Catalog").collect()}
    assert (got["k"].Fulfilled, got["k"].Total, got["k"].Percent) == (fulfilled, total, percent)
    assert got["CatalogTitle"].Fulfilled == 0


@pytest.mark.parametrize("s", ["", " ", " ", "\x1c", "　\n", " a ", "\ta ", "é"])
def test_strip_and_missing_follow_python(spark, s):
    from pyspark.sql import functions as F

    row = spark.createDataFrame([(s,)], "s string").select(expr.strip(F.col("s")).alias("a"), expr.is_missing(F.col("s")).alias("m"), expr.non_ascii(F.col("s")).alias("n")).first()
    assert (row.a, row.m, row.n) == (s.strip(), s.strip() == "", any(ord(c) > 127 for c in s))
