"""Small building blocks by their usual names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metagauge.functions.expr import col


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(value, n), nulls left out, most frequent first, ties by value."""
    return df.where(col(column).isNotNull()).groupBy(col(column).alias("value")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "value")


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Those of value_counts that occur more than once."""
    return value_counts(df, column).where("n > 1")


def sorted_unique(df: DataFrame, column: str) -> DataFrame:
    return df.select(col(column).alias("value")).where("value is not null").distinct().orderBy("value")


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    return df.orderBy(*[col(o) for o in order]).limit(n)


def first_row(df: DataFrame, *order: str) -> dict | None:
    row = first_rows(df, 1, *order).first()
    return row.asDict() if row else None


def insert_first(df: DataFrame, name: str, value) -> DataFrame:
    return df.select(value.alias(name), *[col(c) for c in df.columns if c != name])


def without(df: DataFrame, exclude: Iterable[str]) -> DataFrame:
    gone = set(exclude)
    return df.select(*[col(c) for c in df.columns if c not in gone])


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """By name; columns that a frame lacks are null."""
    frames = iter(frames)
    out = next(frames)
    for df in frames:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def to_int(df: DataFrame, column: str) -> DataFrame:
    """The column as a whole number; 0 for what isn't one."""
    return df.withColumn(column, F.coalesce(col(column).cast("string").try_cast("double"), F.lit(0.0)).cast("long"))


def exists_in(df: DataFrame, key: str, other: DataFrame, other_key: str, name: str | None = None) -> DataFrame:
    """Rows whose key occurs in the other frame; with name all rows and a flag of that name. Nulls never match."""
    keys = other.select(col(other_key).alias("_key"))
    if name is None:
        return df.join(keys, col(key) == F.col("_key"), "left_semi")
    return df.join(keys.distinct(), col(key) == F.col("_key"), "left").withColumn(name, F.col("_key").isNotNull()).drop("_key")
