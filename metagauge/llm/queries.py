"""Queries over the corpus tables, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import html_blocks, merkle, minhash, mixing, pfor, pu, rules, spm, substring, urlfilter

#: Shares of all tokens that each language is to have.
TARGETS = {"en": 0.55, "fr": 0.16, "de": 0.16, "es": 0.13}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that break no certified rule."""
    return rules.decide(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).where("keep").select("doc_id", "stratum", "bound")


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprints(_table(spark, sf_dir, "documents"))


def document_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where documents and a second version of them differ."""
    docs = _table(spark, sf_dir, "documents")
    return merkle.differences(merkle.tree(docs), merkle.tree(merkle.edited(docs)))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that stay, each with the list of its group."""
    return minhash.groups(_table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, without the later copies of passages of 50 words or more."""
    return substring.substring_dedup(_table(spark, sf_dir, "documents"))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = urlfilter.build(spark, urlfilter.BLOCKLIST)
    return urlfilter.blocked(_table(spark, sf_dir, "pages").select("page_id", "url"), index)


def op6_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pfor.tokenized(_table(spark, sf_dir, "documents"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return mixing.Mix(docs, _table(spark, sf_dir, "labels"), TARGETS).rates(docs)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps."""
    return pu.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).where("keep").select("doc_id", "posterior")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(_table(spark, sf_dir, "pages"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spm.encode(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_quality_rules, op2_document_fingerprints, op3_minhash_near_dedup, op4_substring_dedup, op5_url_filters,
            op6_token_id_output, op7_source_mixing, op8_quality_classifier, op9_html_extraction, op10_sentencepiece, document_edits,
        )
    }


_ENTRIES = ", ".join(f"('{e}')" for e in urlfilter.BLOCKLIST)
_URL_SQL = rf"""
with parts as (
  select page_id, url, regexp_extract(url, '^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://)?(?:[^/?#@]*@)?([^/:?#\s]*)(?::[0-9]*)?([^?#\s]*)', ['host', 'path']) as u from pages
), hosts as (
  select page_id, url, rtrim(lower(u.host), '.') as host, rtrim(lower(u.host), '.') || rtrim(u.path, '/') as whole from parts
), list as (
  select entry, contains(entry, '/') as has_path from (values {_ENTRIES}) as e(entry)
)
select page_id, url, entry is not null as blocked, entry from (
  select page_id, url, (
    select arg_min(entry, case when has_path then 1000000 else 0 end + length(entry)) from list
    where host = entry or ends_with(host, '.' || entry) or has_path and (whole = entry or starts_with(whole, entry || '/'))
  ) as entry from hosts
)
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_document_fingerprints": merkle.SQL, "document_edits": merkle.EDITS_SQL, "op5_url_filters": _URL_SQL}
