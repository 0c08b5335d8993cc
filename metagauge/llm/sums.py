"""Sums over all rows that don't depend on the order in which tasks end."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema


def total(rows: DataFrame, value: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """Sum of value over the batches of all rows; for no rows it is zeros of its shape.

    A task adds up its own batches and sends one row for each number; those are
    added as decimals with 12 places, so executors combine them, in any order, to
    the same sum.
    """
    empty = pa.RecordBatch.from_pylist([], schema=to_arrow_schema(rows.schema))
    shape = np.shape(value(empty))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                own = own + value(batch)
        own = own.ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(own), dtype=np.int32)), pa.array(own)], ["i", "x"])

    found = rows.mapInArrow(run, "i int, x double").where("x != 0").groupBy("i").agg(F.sum(F.col("x").cast("decimal(38,12)")).alias("x")).collect()
    out = np.zeros(int(np.prod(shape)))
    for r in found:
        out[r.i] = float(r.x)
    return out.reshape(shape)
