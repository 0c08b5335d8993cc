"""Readers and writers of files."""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Iterable
from datetime import datetime

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metagauge.functions.expr import col, none_or_list

#: Strings that read as null.
NULLS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def escaped(path: str) -> str:
    """The path with glob signs taken literally."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def normalised(df: DataFrame, nulls: Iterable[str] = NULLS) -> DataFrame:
    """String columns with the null tokens as null."""
    tokens = list(nulls)
    return df.select(*[F.when(~col(f.name).isin(tokens), col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else col(f.name) for f in df.schema.fields])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, order: str | None = None, literal: bool = True, infer: bool = False, **options) -> DataFrame:
    """A CSV with a heading: all strings unless there is a schema or types are to be inferred, null tokens as null.

    A column is inferred to be of long or double if all of its values that aren't null tokens are such numbers, which takes a pass of its own.

    order names a column that gets each row's place in reading order (of one file, in file order).
    Quotes are doubled to escape them; options go to Spark's reader. A file with nothing but a byte
    order mark has no columns and no rows.
    """
    reader = spark.read.options(header=True, quote='"', escape='"', **options)
    df = (reader.schema(schema) if schema else reader).csv(escaped(path) if literal else path)
    df = normalised(df) if df.columns else df
    df = inferred(df) if infer and not schema and df.columns else df
    return df.withColumn(order, F.monotonically_increasing_id()) if order else df


def inferred(df: DataFrame) -> DataFrame:
    """String columns whose values are all numbers as long or double, from one aggregation; columns without values stay."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    number = lambda c, pattern: F.count_if(~F.trim(col(c)).rlike(pattern))
    whole, real = r"^[+-]?[0-9]{1,18}$", r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
    seen = df.agg(*[x.alias(f"{kind}{i}") for i, c in enumerate(text) for kind, x in (("n", F.count(col(c))), ("w", number(c, whole)), ("r", number(c, real)))]).first() if text else {}
    kinds = {c: "long" if not seen[f"w{i}"] else "double" if not seen[f"r{i}"] else None for i, c in enumerate(text) if seen[f"n{i}"]}
    return df.select(*[F.trim(col(c)).cast(kinds[c]).alias(c) if kinds.get(c) else col(c) for c in df.columns])


def read_sheets(spark: SparkSession, path: str, sheets: Iterable[str]) -> dict[str, DataFrame]:
    """Sheets of a workbook, all strings, or the CSV files of those names in a folder where path is one."""
    if os.path.isdir(path):
        return {s: read_csv(spark, os.path.join(path, f"{s}.csv")) for s in sheets}
    import pandas as pd

    frames = pd.read_excel(path, sheet_name=list(sheets), dtype=str)
    out = {}
    for name, frame in frames.items():
        schema = T.StructType([T.StructField(str(c), T.StringType()) for c in frame.columns])
        out[name] = normalised(spark.createDataFrame(frame.astype(object).where(frame.notna(), None), schema))
    return out


def sql_over_csv(spark: SparkSession, path: str, query: str = "SELECT * FROM {source}") -> DataFrame:
    """A query over a CSV with a heading, read in place; {source} stands for it."""
    view = f"csv_{abs(hash(path))}"
    read_csv(spark, path).createOrReplaceTempView(view)
    return spark.sql(query.format(source=view))


def texts(spark: SparkSession, values: Iterable[str | None]) -> DataFrame:
    return spark.createDataFrame([(v,) for v in values], "text string")


def write_csv(df: DataFrame, path: str, index: str | None = None, single: bool = False) -> None:
    """A folder with CSV files with a heading, a single one if asked for (by one task, so for small tables); index is a column to come first, under an empty heading."""
    rest = [c for c in df.columns if c != index]
    rows = df.select(*([col(index)] if index else []), *[col(c) for c in rest])
    if index:
        rows = rows.toDF("", *rest)
    (rows.coalesce(1) if single else rows).write.mode("overwrite").options(header=True, emptyValue="").csv(path)


def write_link_log(histogram: DataFrame, path: str, now: datetime | None = None) -> None:
    """Overwrites the log with a row for each status; the histogram is small."""
    lines = ["Link Statistics Log", f"Generated on: {(now or datetime.now()):%Y-%m-%d %H:%M:%S}", "", "HTTP Response Code Counts:"]
    lines += [f"- {r['status']}: {r['count']}" for r in histogram.orderBy(F.desc("count"), "status").collect()]
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def append_mapping_log(lists: DataFrame, counts: DataFrame, effort: DataFrame, path: str) -> None:
    """Appends proposed fields, bucket counts and effort of each level; all three are small."""
    lines = ["### Proposed New Fields", ""]
    for title, name in (("DCAT v3", "dcat"), ("Dublin Core", "dublin")):
        lines.append(f"#### {title}")
        lines += [f"- {r['level']} ({r['n']}): {r['l']}" for r in lists.select("level", F.size(name).alias("n"), none_or_list(F.col(name)).alias("l")).orderBy("level").collect()]
        lines.append("")
    lines += ["### Transformation Stats", ""]
    lines += [f"- {r['level']}: Exact={r['exact']}, Partial={r['partial']}, Unmapped={r['unmapped']}, Total={r['total']}" for r in counts.orderBy("level").collect()]
    lines += ["", *(f"- TES {r['level']}: {r['TES']:.2f}" for r in effort.orderBy("level").collect()), ""]
    with open(path, "a", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder for files that all executors see: ``spark.checkpoint.dir``, else the context's checkpoint folder.

    Where neither is set, a session on this machine alone gets a folder of its own; on a cluster, whose executors could not
    see it, RuntimeError is raised.
    """
    context = spark.sparkContext
    given = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if given:
        return given.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _own:
        _own[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="metagauge-")
    return _own[context.applicationId]


def file_system(folder: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a folder, given as a URI or as a path, and the folder's path in it; made if it isn't there."""
    fs, at = pa.fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else os.path.abspath(folder))
    fs.create_dir(at, recursive=True)
    return fs, at
