"""Folders for what operators write between steps."""

from __future__ import annotations

import ctypes
import functools
import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from emberlog.session import shared_folder


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "step") -> DataFrame:
    """The same rows from files in the shared folder: cuts the lineage, survives executors."""
    path = work_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.work_path = path
    return out


def forget(df: DataFrame) -> None:
    """Delete the files of ``written`` once nothing reads them any more."""
    path = getattr(df, "work_path", None)
    if path:
        jvm = df.sparkSession._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)


def unsized(df: DataFrame) -> DataFrame:
    """Marks rows that a pass or an explode makes. Spark plans with the size of what they are
    made from, which may be a hundredth of theirs, and would broadcast them through the
    driver; a join with them sorts both sides instead."""
    return df.hint("merge")


def shuffle_parts(spark: SparkSession) -> int:
    return max(1, math.ceil(float(spark.conf.get("spark.sql.shuffle.partitions"))))


def small(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``most`` bytes of a text column, or of one text, so
    that what a pass holds as Python objects stays small."""
    for batch in batches:
        ends = np.cumsum(np.nan_to_num(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)))
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(first, last - first)
            first = last


def lean(run: Callable) -> Callable:
    """A pass that gives its memory back to the system when it ends. Worker processes stay
    for later passes, and what each leaves unused in the allocators would add up."""

    @functools.wraps(run)
    def passed(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return passed


def whole_groups(batches, keys: tuple[str, ...], rows: int = 50_000):
    """From batches sorted by ``keys``: (table, starts) with whole groups only, about
    ``rows`` rows at a time. ``starts`` has each group's first row, and the end."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            table = pa.Table.from_batches(held).combine_chunks()
            starts = _starts(table, keys)
            if len(starts) > 2:
                yield table.slice(0, starts[-2]), starts[:-1]
                held = table.slice(starts[-2]).to_batches()
            else:
                held = table.to_batches()
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table, _starts(table, keys)


def _starts(table: pa.Table, keys: tuple[str, ...]) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for key in keys:
        values = table.column(key).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.append(np.flatnonzero(new), table.num_rows)


def join_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union in place: ``labels`` holds for each row the smallest row joined to it."""
    while len(a):
        low, high = np.minimum(labels[a], labels[b]), np.maximum(labels[a], labels[b])
        apart = low != high
        if not apart.any():
            break
        a, b, low, high = a[apart], b[apart], low[apart], high[apart]
        np.minimum.at(labels, high, low)
        while True:
            up = labels[labels]
            if (up == labels).all():
                break
            labels[:] = up
