"""Tables written between steps, in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from metagauge.sources.files import shared_folder as shared_dir

def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read from a Parquet table in the shared folder: lineage ends there."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def drop(df: DataFrame) -> None:
    """Deletes a table that no plan still to run reads."""
    path = getattr(df, "_scratch", None)
    if path:
        at, fs = _path(df.sparkSession, path)
        fs.delete(at, True)
