"""The stateless operators on streams, and windowed counts of events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metagauge.operators import kpi, pii


def read_stream(spark: SparkSession, path: str, schema: T.StructType, form: str = "parquet", files_per_trigger: int = 16) -> DataFrame:
    return spark.readStream.format(form).schema(schema).option("maxFilesPerTrigger", files_per_trigger).load(path)


def resource_scores(stream: DataFrame) -> DataFrame:
    """kpi.resource_kpis of each record as it comes."""
    return kpi.resource_kpis(stream)


def catalog_scores(stream: DataFrame, resources: DataFrame) -> DataFrame:
    """kpi.catalog_kpis of each record as it comes, against a static resource table."""
    return kpi.catalog_kpis(stream, resources)


def pii_spans(stream: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """pii.analyze of each text as it comes."""
    return pii.analyze(stream, text_col, **options)


def entity_windows(spans: DataFrame, time_col: str, width: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """(start, end, entity, count) of tumbling windows; spans later than the watermark are dropped."""
    counts = spans.withWatermark(time_col, late).groupBy(F.window(time_col, width), "entity").agg(F.count(F.lit(1)).alias("count"))
    return counts.select("window.start", "window.end", "entity", "count")
