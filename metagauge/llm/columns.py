"""Keys and names of columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Stands for a null id, so an id of -2**63 is taken for null.
NO_ID = -(2**63)
_WHOLE = ("tinyint", "smallint", "int", "bigint", "void")


def integer(df: DataFrame, name: str) -> Column:
    """The id column as a long; ids of other types than integers raise ValueError here rather than in a task."""
    kind = df.select(f"`{name}`").dtypes[0][1]
    if kind not in _WHOLE:
        raise ValueError(f"ids are integers, but {name} is {kind}")
    return F.col(f"`{name}`").cast("long")


def key(df: DataFrame, name: str) -> Column:
    """The id column as a long that is never null."""
    return F.coalesce(integer(df, name), F.lit(NO_ID))


def free(df: DataFrame, name: str) -> str:
    """The name, with underscores before it where df has such a column (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
