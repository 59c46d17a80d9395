"""Helpers that several operators share."""

from __future__ import annotations

import sys
import types

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_bytes(column: str = "text") -> Column:
    """The text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def process_cache(key: str, make):
    """One object per Python worker process.

    Functions reach the workers by value, so what they keep in globals ends with a task; this lasts as long
    as the process, which serves many tasks.
    """
    store = sys.modules.setdefault("_dockline_process_cache", types.ModuleType("_dockline_process_cache")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


def slices(batches, most_rows: int = 512, most_bytes: int = 16 << 20):
    """Record batches cut so that one piece holds at most so many rows, and bytes unless one row has more."""
    for batch in batches:
        at, rows = 0, batch.num_rows
        width = max(1, batch.nbytes // max(1, rows))
        step = int(max(1, min(most_rows, most_bytes // width)))
        while at < rows:
            yield batch.slice(at, step)
            at += step


def list_column(lengths, values, kind) -> pa.Array:
    """A list array from the lengths of the lists and all their values."""
    offsets = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))


def ragged(lengths) -> np.ndarray:
    """0, 1, .. n-1 for every n of ``lengths``, one after the other."""
    lengths = np.asarray(lengths, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)
