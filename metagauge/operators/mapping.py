"""How far a metadata schema maps to standards, and what it lacks."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metagauge.functions.expr import col, is_missing, nonblank, opt_col, required, strip

LEVELS = ("Catalog", "Dataset", "Distribution")
STANDARDS = {"DCAT v3": "dcat_field", "Dublin Core": "dc_field"}
WEIGHTS = {"exact": 0, "partial": 1, "unmapped": 3}


def sheet(df: DataFrame, level: str, source: str | None = None, dcat: str | None = None, dublin: str | None = None, kind: str = "Mapping Type") -> DataFrame:
    """(level, source_field, dcat_field, dc_field, mapping_type, action) of one mapping sheet; rows without a mapping type are dropped.

    Columns that aren't named are found by the form of their headings; KeyError where that doesn't find one.
    """

    def find(given: str | None, pattern: str) -> str:
        if given is None:
            given = next((c for c in df.columns if re.fullmatch(pattern, c, re.I)), pattern)
        required(df, [given])
        return given

    source, dcat, dublin = find(source, r"equivalent .* metadata"), find(dcat, r"dcat.*mapping"), find(dublin, r"dublin\w* core element")
    required(df, [kind])
    action = next((c for c in df.columns if re.fullmatch(r"action for .*|notes/action", c, re.I)), "action")
    return df.where(col(kind).isNotNull()).select(
        F.lit(level).alias("level"), col(source).cast("string").alias("source_field"), col(dcat).cast("string").alias("dcat_field"), col(dublin).cast("string").alias("dc_field"),
        col(kind).cast("string").alias("mapping_type"), opt_col(df, action).alias("action"),
    )


def sheets(frames: Mapping[str, DataFrame]) -> DataFrame:
    """All sheets as one long table: UNION ALL."""
    out = None
    for level, df in frames.items():
        one = sheet(df, level)
        out = one if out is None else out.unionByName(one)
    return out


def _kinds() -> dict[str, Column]:
    kind = F.lower(F.coalesce("mapping_type", F.lit("nan")))
    return {"exact": kind.contains("exact"), "partial": kind.rlike("partial|closest"), "unmapped": kind.rlike("no match|no direct")}


def _each_level(df: DataFrame, levels: tuple[str, ...] | None, fill: Mapping[str, object]) -> DataFrame:
    """A row for each of the levels, or those that occur."""
    if levels is None:
        return df
    known = df.sparkSession.createDataFrame([(x,) for x in levels], "level string")
    return known.join(df, "level", "left").fillna(dict(fill))


def bucket_counts(table: DataFrame, levels: tuple[str, ...] | None = None) -> DataFrame:
    """(level, exact, partial, unmapped, total): a row may count in several; total has rows that count in any."""
    kinds = _kinds()
    any_of = kinds["exact"] | kinds["partial"] | kinds["unmapped"]
    out = table.groupBy("level").agg(*[F.count_if(c).alias(k) for k, c in kinds.items()], F.count_if(any_of).alias("total"))
    return _each_level(out, levels, dict.fromkeys([*kinds, "total"], 0))


def bucket(exact_first: bool = True) -> Column:
    """The one bucket of a row, exact before partial before unmapped; null for none."""
    kinds = _kinds()
    order = list(kinds) if exact_first else list(kinds)[::-1]
    out = F.when(kinds[order[0]], order[0])
    for k in order[1:]:
        out = out.when(kinds[k], k)
    return out


def bucketed_fields(table: DataFrame) -> DataFrame:
    """(level, bucket, field, n): source fields of each bucket, "(None)" where there is none, and their rows. Counted with map-side combine; no list is gathered."""
    rows = table.select("level", bucket().alias("bucket"), F.coalesce(strip(F.col("source_field")), F.lit("(None)")).alias("field")).where("bucket is not null")
    return rows.groupBy("level", "bucket", "field").agg(F.count(F.lit(1)).alias("n"))


def coverage(counts: DataFrame) -> DataFrame:
    """(level, exact, partial, unmapped) as percentages of total; 0 where that is 0."""
    return counts.select("level", *[F.when(F.col("total") > 0, 100.0 * F.col(k) / F.col("total")).otherwise(0.0).alias(k) for k in WEIGHTS])


def effort_score(counts: DataFrame, weights: Mapping[str, float] = WEIGHTS) -> DataFrame:
    """(level, TES): weighted mean effort of a mapping."""
    cost = sum((F.col(k) * F.lit(float(w)) for k, w in weights.items()), F.lit(0.0))
    return counts.select("level", (cost / F.greatest("total", F.lit(1))).alias("TES"))


def proposed_fields(table: DataFrame, equivalent: str = "Source Equivalent") -> DataFrame:
    """Fields that a standard has and the source lacks, one row for each row of the table and standard."""
    out = None
    for standard, name in STANDARDS.items():
        one = table.where(is_missing(F.col("source_field")) & nonblank(F.col(name))).select(
            F.col("level").alias("Metadata Level"), F.lit(standard).alias("Standard"), strip(F.col(name)).alias("Standard Field"), F.lit("(None)").alias(equivalent),
            strip(F.col("mapping_type")).alias("Mapping Type"), F.coalesce("action", F.lit("")).alias("Notes/Action"),
        )
        out = one if out is None else out.unionByName(one)
    return out


def proposed_lists(proposed: DataFrame, levels: tuple[str, ...] | None = None) -> DataFrame:
    """(level, dcat, dublin): distinct proposed fields of each level, in order of code points."""
    lists = proposed.groupBy(F.col("Metadata Level").alias("level")).agg(*[F.sort_array(F.collect_set(F.when(F.col("Standard") == s, F.col("Standard Field")))).alias(a) for s, a in zip(STANDARDS, ("dcat", "dublin"))])
    if levels is None:
        return lists
    known = proposed.sparkSession.createDataFrame([(x,) for x in levels], "level string")
    empty = F.array().cast("array<string>")
    return known.join(lists, "level", "left").select("level", F.coalesce("dcat", empty).alias("dcat"), F.coalesce("dublin", empty).alias("dublin"))


def proposed_counts(lists: DataFrame) -> DataFrame:
    return lists.select("level", F.size("dcat").cast("long").alias("DCAT v3"), F.size("dublin").cast("long").alias("Dublin Core"))


def overlap(lists: DataFrame) -> DataFrame:
    """(level, Intersection, Union, Jaccard); the union of two empty lists is reported as 1."""
    both, either = F.size(F.array_intersect("dcat", "dublin")), F.greatest(F.size(F.array_union("dcat", "dublin")), F.lit(1))
    return lists.select("level", both.cast("long").alias("Intersection"), either.cast("long").alias("Union"), (both / either).alias("Jaccard"))


def duplicates(table: DataFrame, levels: tuple[str, ...] | None = None) -> DataFrame:
    """(level, rows, fields): source fields that are mapped more than once, and their rows."""
    repeated = table.where(nonblank(F.col("source_field"))).groupBy("level", "source_field").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    out = repeated.groupBy("level").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("fields"))
    return _each_level(out, levels, {"rows": 0, "fields": 0})
