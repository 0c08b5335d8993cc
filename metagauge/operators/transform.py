"""Projections of resource records into DCAT and Dublin Core."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metagauge.functions.expr import opt_col

#: Target column: source column, or None for one that stays empty.
DCAT = {"dcat:downloadURL": "datafile", "dcat:endpointURL": "datafile_url", "dcat:mediaType": "file_format", "dcat:ByteSize": "file_size", "dcat:endpointDescription": None, "dcat:landingpage": None, "dcterms:title": None}
DUBLIN_CORE = {"Title": "title", "Relation [datafile_url]": "datafile_url", "Relation [datafile]": "datafile", "Format/Media Size": "file_format", "Extent": "file_size"}


def project(df: DataFrame, targets: Mapping[str, str | None]) -> DataFrame:
    """Renamed columns in order of targets, as strings; null where the source is None or the frame lacks it."""
    return df.select(*[(opt_col(df, source) if source else F.lit(None).cast("string")).alias(target) for target, source in targets.items()])


def to_dcat(df: DataFrame, targets: Mapping[str, str | None] = DCAT) -> DataFrame:
    return project(df, targets)


def to_dublin_core(df: DataFrame, targets: Mapping[str, str | None] = DUBLIN_CORE) -> DataFrame:
    return project(df, targets)
