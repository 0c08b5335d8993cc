"""Quality indicators of catalog and resource records, completeness and vocabularies."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metagauge.functions.expr import all_of, col, flag, http_link, in_vocabulary, non_ascii, nonblank, opt_col, required, share, strip

#: Roles of catalog columns and the names they have by default.
CATALOG = {
    "title": "title", "description": "body:value", "published": "published_date", "ministry": "field_ministry_department:name", "alias": "node_alias",
    "keywords": "keywords", "jurisdiction": "field_asset_jurisdiction:name", "govt": "field_ds_govt_type", "sector": "field_sector:name",
}
RESOURCE = {
    "parent": "catalog_title", "title": "title", "format": "file_format", "file": "datafile", "url": "datafile_url", "note": "note", "category": "resource_category",
    "govt": "govt_type", "department": "state_department", "api": "external_api_reference", "sector": "sector",
}
CATALOG_OPTIONAL = ("jurisdiction", "govt", "sector")
RESOURCE_OPTIONAL = ("category", "govt", "department", "api", "sector")

CATALOG_KPIS = ("FieldCoverage", "DCATCompliance", "ControlledVocab", "JurisdictionComplete", "LegislationCoverage", "DistributionIntegrity", "Multilingual", "LinkValidity", "DublinCoreCoverage", "SectorAccuracy")
RESOURCE_KPIS = ("FieldCoverage", "DCATCompliance", "ControlledVocab", "JurisdictionComplete", "LegislationCoverage", "DistributionIntegrity", "Multilingual", "Harvestability", "LinkValidity", "DublinCoreCoverage", "SectorAccuracy")


def _roles(df: DataFrame, names: Mapping[str, str], optional: Iterable[str]) -> dict[str, Column]:
    required(df, [n for r, n in names.items() if r not in optional])
    return {r: opt_col(df, n) for r, n in names.items()}


def _sector_ok(df: DataFrame, name: str) -> Column:
    """Neither empty nor "all". Null, where the column exists, reads as the word nan and passes."""
    c = F.lower(strip(F.coalesce(col(name).cast("string"), F.lit("nan")))) if name in df.columns else F.lit("")
    return ~c.isin("", "all")


def total_score(names: Iterable[str]) -> Column:
    """Sum of flags; null flags count 0."""
    return sum((F.coalesce(col(n), F.lit(0)) for n in names), F.lit(0))


def resource_kpis(df: DataFrame, names: Mapping[str, str] = RESOURCE) -> DataFrame:
    """ResourceTitle, RESOURCE_KPIS and TotalScore of each row, in one projection."""
    c = _roles(df, {r: n for r, n in names.items() if r != "parent"}, RESOURCE_OPTIONAL)
    linked = c["url"].isNotNull() | c["file"].isNotNull()
    titled, formatted = nonblank(c["title"]), nonblank(c["format"])
    api = F.lower(strip(F.coalesce(c["api"], F.lit("nan"))))
    whole = titled & formatted & linked
    flags = {
        "FieldCoverage": whole,
        "DCATCompliance": whole,
        "ControlledVocab": F.coalesce(c["format"].contains("/"), F.lit(False)) & nonblank(c["category"]),
        "JurisdictionComplete": nonblank(c["govt"]) & ((F.lower(strip(c["govt"])) != "state") | nonblank(c["department"])),
        "LegislationCoverage": F.lit(False),
        "DistributionIntegrity": formatted & linked,
        "Multilingual": non_ascii(c["title"]) | non_ascii(c["note"]),
        "Harvestability": ~api.isin("", "nan") | F.coalesce(F.lower(c["format"]).contains("json"), F.lit(False)),
        "LinkValidity": F.coalesce(http_link(F.coalesce(c["url"], c["file"])), F.lit(False)),
        "DublinCoreCoverage": titled & formatted,
        "SectorAccuracy": _sector_ok(df, names["sector"]),
    }
    rows = df.select(c["title"].alias("ResourceTitle"), *[flag(flags[k]).alias(k) for k in RESOURCE_KPIS])
    return rows.withColumn("TotalScore", total_score(RESOURCE_KPIS))


def children(resources: DataFrame, names: Mapping[str, str] = RESOURCE, order: str = "ord") -> DataFrame:
    """Per parent title: links_ok, first_valid (of the first child in file order) and any_valid. Map-side combined."""
    required(resources, [names[r] for r in ("parent", "format", "file", "url")] + [order])
    url, file = (col(names[r]).cast("string") for r in ("url", "file"))
    valid = (url.isNotNull() | file.isNotNull()) & nonblank(col(names["format"]).cast("string"))
    rows = resources.select(
        col(names["parent"]).cast("string").alias("_parent"), valid.alias("valid"), F.coalesce(http_link(F.coalesce(url, file)), F.lit(False)).alias("link"), col(order).alias("ord")
    ).where("_parent is not null")
    return rows.groupBy("_parent").agg(F.bool_and("link").alias("links_ok"), F.min_by("valid", "ord").alias("first_valid"), F.bool_or("valid").alias("any_valid"))


def catalog_kpis(catalog: DataFrame, resources: DataFrame, names: Mapping[str, str] = CATALOG, resource_names: Mapping[str, str] = RESOURCE, order: str = "ord") -> DataFrame:
    """CatalogTitle, CATALOG_KPIS, DistributionIntegrityAny and TotalScore of each catalog row.

    DistributionIntegrity is faithful to a loop that never reports success: null
    where the first child is valid, else 0. DistributionIntegrityAny is what was
    meant: whether any child is valid. It isn't part of TotalScore.
    """
    c = _roles(catalog, names, CATALOG_OPTIONAL)
    kids = children(resources, resource_names, order)
    df = catalog.join(kids, c["title"] == kids["_parent"], "left")
    whole = all_of(nonblank(c[r]) for r in ("title", "description", "published", "ministry", "alias"))
    has_kids = F.col("_parent").isNotNull()
    flags = {
        "FieldCoverage": flag(whole),
        "DCATCompliance": flag(whole & has_kids),
        "ControlledVocab": flag(all_of(nonblank(c[r]) for r in ("jurisdiction", "govt", "ministry", "sector"))),
        "JurisdictionComplete": flag(nonblank(c["jurisdiction"])),
        "LegislationCoverage": F.lit(0),
        "DistributionIntegrity": F.when(F.coalesce("first_valid", F.lit(False)), F.lit(None).cast("int")).otherwise(0),
        "Multilingual": flag(non_ascii(c["title"]) | non_ascii(c["description"])),
        "LinkValidity": flag(F.coalesce("links_ok", F.lit(False))),
        "DublinCoreCoverage": flag(all_of(nonblank(c[r]) for r in ("title", "description", "published", "ministry", "keywords"))),
        "SectorAccuracy": flag(_sector_ok(catalog, names["sector"])),
    }
    rows = df.select(c["title"].alias("CatalogTitle"), *[flags[k].alias(k) for k in CATALOG_KPIS], flag(F.coalesce("any_valid", F.lit(False))).alias("DistributionIntegrityAny"))
    return rows.withColumn("TotalScore", total_score(CATALOG_KPIS))


def fulfilment_summary(scores: DataFrame, level: str, exclude: Iterable[str] = ("DatasetTitle", "ResourceTitle", "TotalScore", "Type", "HTTP_Status", "DistributionIntegrityAny")) -> DataFrame:
    """(Type, KPI, Fulfilled, Total, Percent) of each column, from one aggregation.

    Values that aren't numbers count 0, so a title column that isn't excluded
    gives a row of 0; pass its name in exclude to leave it out.
    """
    names = [c for c in scores.columns if c not in set(exclude)]
    kinds = dict(scores.dtypes)

    def whole(c: str) -> Column:
        if kinds[c] in ("tinyint", "smallint", "int", "bigint"):
            return F.coalesce(col(c), F.lit(0))
        number = F.coalesce(col(c).cast("string").try_cast("double"), F.lit(0.0))
        return F.when(F.isnan(number), 0.0).otherwise(number).cast("long")

    sums = scores.agg(F.count(F.lit(1)).alias("_n"), *[F.coalesce(F.sum(whole(c)), F.lit(0)).alias(f"_{i}") for i, c in enumerate(names)])
    percent = lambda i: F.coalesce(F.bround(F.try_divide(100.0 * F.col(f"_{i}"), F.col("_n")), 1), F.lit(0.0))
    rows = [F.struct(F.lit(level).alias("Type"), F.lit(c).alias("KPI"), F.col(f"_{i}").alias("Fulfilled"), F.col("_n").alias("Total"), percent(i).alias("Percent")) for i, c in enumerate(names)]
    return sums.select(F.explode(F.array(*rows)).alias("r")).select("r.*") if rows else scores.sparkSession.createDataFrame([], "Type string, KPI string, Fulfilled long, Total long, Percent double")


def average_score(scores: DataFrame) -> DataFrame:
    return scores.agg(F.avg("TotalScore").alias("avg_score"), F.count(F.lit(1)).alias("n"))


def completeness(df: DataFrame, fields: Iterable[str]) -> DataFrame:
    """(pct): share of rows in which no field is null. Blank counts as filled."""
    fields = list(fields)
    required(df, fields)
    return df.agg(share(all_of(col(f).isNotNull() for f in fields)).alias("pct"))


def vocabulary_compliance(df: DataFrame, fields: Iterable[str], vocabularies: Mapping[str, Iterable[str]]) -> DataFrame:
    """(field, pct) from one aggregation: share of all rows whose value, trimmed, is in the field's vocabulary.

    0 for a field that the frame lacks, null for one without vocabulary; a field listed twice is reported once.
    """
    fields = list(dict.fromkeys(fields))
    known = [f for f in fields if f in vocabularies and f in df.columns]
    sums = df.agg(F.count(F.lit(1)).alias("_n"), *[share(in_vocabulary(col(f), list(vocabularies[f]))).alias(f"_{i}") for i, f in enumerate(known)])
    value = lambda f: F.col(f"_{known.index(f)}") if f in known else F.lit(0.0 if f in vocabularies else None).cast("double")
    return sums.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), value(f).alias("pct")) for f in fields])).alias("r")).select("r.*")


#: Fields that a resource record must have, by what they are for.
MANDATORY = ("title", "catalog_title", *("govt_type", "resource_category"), *("changed", "created"), *("ministry_department", "sector"), "cdos_state_ministry")
_YES_NO = ("TRUE", "FALSE")
VOCABULARIES = {
    "is_api_available": _YES_NO, "field_high_value_dataset": _YES_NO, "field_from_api": _YES_NO, "field_show_export": _YES_NO, "govt_type": ("Central", "State"),
    "Access Type (on dataset creation page)": ("Private", "Public", "Restricted"),
    "frequency": ("continual", "daily", "weekly", "fortnightly", "monthly", "quarterly", "biannual", "annual", "irregular"),
}
#: Fields reported on though they have no vocabulary.
FREE = ("cdos_state_ministry", "sector", "sector_resource", "ministry_department", "published", "created", "changed", "resource_category", "Duration of Date (from- to)", "fied_resource_type")
