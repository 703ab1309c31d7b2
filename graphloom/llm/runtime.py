"""What the operators share: shipping the package, shared checkpoints, and Arrow helpers."""

from __future__ import annotations

import contextlib
import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from graphloom.operators.frames import common_keys, settled, ship_package, skew_join, superseded

BATCH_ROWS = 2000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once for each Spark application.

    Batches for Python hold 10,000 rows by default, which for long texts is too much memory; unless the
    session says otherwise they get BATCH_ROWS.
    """
    if spark.conf.get(_BATCH, "10000") == "10000":
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    ship_package(spark)


#: What workers remember between tasks, by operator: functions that forget it.
MEMORIES: dict[str, Callable[[], None]] = {}


def trim() -> None:
    """Gives this process's freed memory back."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def worker(name: str):
    """For functions over Arrow batches: a worker that another operator has used forgets what it remembered for that,
    and gives freed memory back at the end, as workers of all stages share an executor's memory."""

    def wrap(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
        @functools.wraps(run)
        def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for other, forget in MEMORIES.items():
                if other != name:
                    forget()
            yield from run(batches)
            trim()

        return tidy

    return wrap


#: A table, computed once and written to the shared folder, so that no lost executor undoes it.
saved = settled


@worker("press")
def _press(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(1)
    for batch in batches:
        texts = pa.array([None if t is None else press.compress(t.encode()) for t in batch["text"].to_pylist()], pa.binary())
        others = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*(batch[c] for c in others), texts], [*others, "z"])


def packed(docs: DataFrame) -> DataFrame:
    """docs with text as compressed bytes z, which shuffle at less than half their size."""
    schema = T.StructType([f for f in docs.schema if f.name != "text"]).add("z", "binary")
    return docs.mapInArrow(_press, schema)


def matrix(column: pa.Array | pa.ChunkedArray, dtype: type) -> np.ndarray:
    """Lists of one length, without nulls, as the rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return np.zeros((0, 0), dtype)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    return flat.reshape(n, -1)


def numbers(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy() if isinstance(column, pa.ChunkedArray) else column.to_numpy(zero_copy_only=False)


def ragged(counts: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from the length of each list and all lists' values in a row."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
