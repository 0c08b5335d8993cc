"""The corpus pipeline: classify, drop near duplicates, cut repeated passages, mix, tokenize."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from metagauge.llm import minhash, mixing, pu, spm, substring
from metagauge.llm.queries import TARGETS
from metagauge.llm.scratch import drop, written


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps.

    Null and empty texts go; without positive labels everything stays. Repeated rows and ties in score are decided alike.
    """
    return pu.quality_filter(docs, _labels(spark, sf_dir))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the least by (doc_id, text hash); a null doc_id comes first.

    Null and empty texts are near to nothing and stay; of repeated rows one stays.
    """
    return minhash.near_dedup(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of passages of 50 words or more; all stay, some of them empty.

    Null, empty and shorter texts stay as they are. Rows with the same doc_id and text are cut alike.
    """
    return substring.substring_dedup(docs, report=False)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rates say.

    Null and empty texts get the rate of the model's prior; without labelled documents of a target domain each stays once.
    """
    fitted = mixing.Mix(docs, _labels(spark, sf_dir), TARGETS)
    fitted.drop()
    return fitted.mixed(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document: null for a null text, none for an empty one."""
    return spm.encode(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality),
    ("minhash_near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("source_mixing", mix),
    ("sentencepiece", tokenize),
]

#: Training, signatures and token ids are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet in the shared folder and read again; a table goes when the next is written."""
    docs = before = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, before, sf_dir), f"pipeline-{name}")
        drop(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
