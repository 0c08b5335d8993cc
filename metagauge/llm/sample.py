"""Bounded samples by hash, of which the driver gets little more than it asked for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

_SPAN = 1 << 40
SPARE = 1.3


def low(key: Column, n: int, total: int, spare: float = SPARE) -> Column | None:
    """Condition that about spare * n of total rows meet, by a 64-bit hash; None if that is all of them."""
    return None if total <= spare * n else F.pmod(key, F.lit(_SPAN)) < int(_SPAN * spare * n / total)


def lowest(df: DataFrame, n: int, total: int, key: Column, *ties: str) -> list[Row]:
    """n rows of df, which has total, or all if it has fewer: those with the least hashes, ties by these columns.

    Only rows under a cut are sorted, so partitions don't send n rows each. If
    hashes that repeat leave too few under it, all rows are looked at.
    """
    order = [F.pmod(key, F.lit(_SPAN)), *ties]
    cut = low(key, n, total)
    rows = df.where(cut).orderBy(*order).limit(n).collect() if cut is not None else []
    return rows if len(rows) == n else df.orderBy(*order).limit(n).collect()
