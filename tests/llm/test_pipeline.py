"""The queries as registered, and the pipeline stage by stage."""

from __future__ import annotations

import ast
from pathlib import Path

import pytest

from pyspark.sql import functions as F

import corpus_pipeline
from metagauge.llm import merkle, minhash, mixing, pfor, pu, queries, spm, substring

ROOT = Path(__file__).resolve().parents[2]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(name, same_rows):
    same_rows(queries.queries()[name], queries.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(queries.oracle_sql())))
def test_query_runs(name, spark, sf):
    assert queries.queries()[name](spark, sf).count() > 0


def test_stages(spark, sf, docs, tmp_path):
    """Each stage's decisions are its operator's, on all that the one before kept."""
    at = {}
    rows = docs
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = rows
        stage(spark, before, sf).write.parquet(str(tmp_path / name))
        rows = at[name] = spark.read.parquet(str(tmp_path / name))
        if i < len(corpus_pipeline.STAGES) - 1:
            assert rows.columns == docs.columns
        if name == "quality_classifier":
            labels = spark.read.parquet(f"{sf}/labels.parquet")
            want = {r.doc_id for r in pu.score(before, labels).where("keep").collect()}
            assert {r.doc_id for r in rows.collect()} == want
        if name == "minhash_near_dedup":
            assert sorted(r.doc_id for r in rows.collect()) == sorted({r.doc_id for r in before.collect()} - {c for g in minhash.groups(before).collect() for c in g.copies if c != g.doc_id})
        if name == "substring_dedup":
            want = {r.doc_id: r.text for r in substring.substring_dedup(before).collect()}
            assert {r.doc_id: r.text for r in rows.collect()} == want
            assert all(r.n_chars == len(r.text) for r in rows.collect())
    assert rows.where("not library_equal or not decoded_equal").count() == 0
    again = sorted((r.doc_id, r.ids) for r in corpus_pipeline.run(spark, sf).collect())
    assert again == sorted((r.doc_id, r.ids) for r in rows.collect())


@pytest.mark.parametrize("rows", ["awkward", "empty"])
def test_chain_on_awkward_tables(spark, awkward, labels, tmp_path, rows):
    """Nulls, empty and long texts, repeated rows, clashing columns; and no rows at all."""
    docs = awkward if rows == "awkward" else awkward.limit(0)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    at = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, at, str(tmp_path)).write.parquet(str(tmp_path / name))
        at = spark.read.parquet(str(tmp_path / name))
        if i < len(corpus_pipeline.STAGES) - 1:
            assert at.columns == docs.columns
        if name == "quality_classifier":
            kept = at.select("doc_id", "text").collect()
            assert all((r.text or "").strip() for r in kept) and rows == "empty" or len(kept) > 0
        if name == "minhash_near_dedup":
            assert sorted(map(repr, {r.doc_id for r in at.collect()})) == sorted(map(repr, {r.doc_id for r in kept} - ({7, 8} if -5 in {r.doc_id for r in kept} else set())))
    again = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((repr(r.doc_id), r.ids) for r in again) == sorted((repr(r.doc_id), r.ids) for r in at.collect()) and (len(again) == 0) == (rows == "empty")


def test_ids_that_are_no_integers_are_refused(awkward, labels):
    named = awkward.withColumn("doc_id", F.lit("a17"))
    for run in (merkle.fingerprints, pfor.tokenized, spm.encode, minhash.groups, substring.substring_dedup, lambda d: pu.score(d, labels), lambda d: pu.quality_filter(d, labels), lambda d: mixing.Mix(d, labels, {"en": 1.0})):
        with pytest.raises(ValueError, match="ids are integers"):
            run(named)


def test_nothing_else_imports_the_subpackage():
    for file in (ROOT / "metagauge").rglob("*.py"):
        if "llm" in file.relative_to(ROOT / "metagauge").parts:
            continue
        for node in ast.walk(ast.parse(file.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in n.split(".") for n in names), file
