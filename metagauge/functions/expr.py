"""Column expressions that all operators share.

White space is Python's: Unicode white space and U+001C to U+001F. A value is
*missing* if it is null or has no other characters.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPACE = r"\s\x1c-\x1f"


def col(name: str) -> Column:
    """A column by its exact name, which may have dots, colons and spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def opt_col(df: DataFrame, name: str, default: str | None = None) -> Column:
    """The column as a string, or the default where the frame lacks it."""
    return col(name).cast("string") if name in df.columns else F.lit(default).cast("string")


def required(df: DataFrame, names: Iterable[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise KeyError(f"missing columns: {missing}")


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"(?U)^[{_SPACE}]+|[{_SPACE}]+$", "")


def nonblank(c: Column) -> Column:
    return F.coalesce(c.rlike(rf"(?U)[^{_SPACE}]"), F.lit(False))


def is_missing(c: Column) -> Column:
    return ~nonblank(c)


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(and_, conditions, F.lit(True))


def non_ascii(c: Column) -> Column:
    return F.coalesce(c.rlike(r"[^\x00-\x7F]"), F.lit(False))


def http_link(c: Column) -> Column:
    """Scheme http or https, in lower case and at the very start; null for null."""
    return c.startswith("http://") | c.startswith("https://")


def in_vocabulary(c: Column, values: Iterable[str]) -> Column:
    return F.coalesce(strip(c.cast("string")).isin(*values), F.lit(False))


def flag(condition: Column) -> Column:
    """1 or 0."""
    return F.when(condition, 1).otherwise(0)


def share(condition: Column) -> Column:
    """Percentage of all rows, those with nulls among them; null for no rows."""
    return F.try_divide(100.0 * F.count_if(condition), F.count(F.lit(1)))


def base_name(url: Column, default: Column) -> Column:
    """What follows the last slash, query and all; the default where nothing does."""
    return F.coalesce(F.nullif(F.substring_index(url, "/", -1), F.lit("")), default)


def none_or_list(values: Column) -> Column:
    """Values with commas between, or the word None."""
    return F.when(F.size(values) > 0, F.array_join(values, ", ")).otherwise("None")
