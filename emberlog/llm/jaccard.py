"""Exact Jaccard links inside groups of candidates, dealt out as cells."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm.work import join_labels, lean, unsized, whole_groups


def once_each(rows: DataFrame, group: str, node: str) -> DataFrame:
    """Groups of two nodes at least, with their ``count``; of groups that hold the same nodes,
    one. ``rows`` (group, node) are distinct. The same nodes are told by the smallest, the
    largest, their number and a 64-bit hash of all."""
    told = rows.groupBy(group).agg(
        F.count(F.lit(1)).alias("count"), F.min(node).alias("lo"), F.max(node).alias("hi"), F.bit_xor(F.xxhash64(node)).alias("mix")
    )
    return told.where("count > 1").groupBy("count", "lo", "hi", "mix").agg(F.min(group).alias(group)).select(group, "count")


def cells(rows: DataFrame, keys: list[str], node: str, cell_rows: int, sizes: DataFrame | None = None) -> DataFrame:
    """Rows of groups (``keys``) with two rows at least, or of those in ``sizes`` (keys,
    count), as cells (keys, i, j, side). A group over ``cell_rows`` is cut into chunks, and
    each pair of chunks is a cell of its own: side 0 is compared with side 1, side 2 with
    itself."""
    if sizes is None:
        sizes = rows.groupBy(*keys).count().where("count > 1")
    dealt = unsized(rows).join(sizes, keys).withColumn("chunks", F.ceil(F.col("count") / cell_rows).cast("int")).drop("count")
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64(node), F.col("chunks")).cast("int"))
    each = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1),
        lambda c: F.struct(
            F.least(c, "chunk").alias("i"), F.greatest(c, "chunk").alias("j"),
            F.when(c == F.col("chunk"), 2).when(F.col("chunk") < c, 0).otherwise(1).alias("side"),
        ),
    )
    return dealt.select("*", F.explode(each).alias("cell")).select("cell.*", *rows.columns)


def joined(values: np.ndarray, offsets: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Labels of the components of row pairs (left x right) whose sets, the values between
    two offsets, reach the threshold. A row is compared with all others at once, by counts
    of its values in theirs, and only if some of them are not joined to it yet."""
    n = len(offsets) - 1
    names, ids = np.unique(values[offsets[0] : offsets[-1]], return_inverse=True)
    row = np.repeat(np.arange(n), np.diff(offsets))
    cells_ = np.unique(row * np.int64(len(names) + 1) + ids)
    row, ids = cells_ // (len(names) + 1), cells_ % (len(names) + 1)
    size = np.bincount(row, minlength=n)
    starts = np.cumsum(size) - size
    labels, marked = np.arange(n), np.zeros(len(names) + 1, bool)
    for x in left.tolist():
        if (labels[right] == labels[x]).all():
            continue
        own = ids[starts[x] : starts[x] + size[x]]
        marked[own] = True
        both = np.bincount(row[marked[ids]], minlength=n)
        marked[own] = False
        near = right[both[right] >= threshold * (size[x] + size[right] - both[right])]
        join_labels(labels, np.full(len(near), x), near)
    return labels


def jaccard_edges(dealt: DataFrame, group: str, node: str, threshold: float) -> DataFrame:
    """Edges (a, b) between nodes of ``cells`` rows (group, i, j, side, node, shingles: array
    of int) whose sets are similar enough, as a star for each component in a cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, (group, "i", "j"), rows=2048):
            nodes, side = table.column(node).to_numpy(), table.column("side").to_numpy()
            shingles = pa.concat_arrays(table.column("shingles").chunks)
            values, offsets = shingles.values.to_numpy(), shingles.offsets.to_numpy()
            out_a, out_b = [], []
            for a, b in zip(starts[:-1], starts[1:], strict=True):
                left, right = np.flatnonzero(side[a:b] != 1), np.flatnonzero(side[a:b] != 0)
                labels = joined(values, offsets[a : b + 1], left, right, threshold)
                moved = np.flatnonzero(labels != np.arange(b - a))
                out_a.append(nodes[a + moved])
                out_b.append(nodes[a + labels[moved]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], ["a", "b"])

    ordered = dealt.select(group, "i", "j", "side", node, "shingles").repartition(group, "i", "j").sortWithinPartitions(group, "i", "j")
    return ordered.mapInArrow(lean(run), "a long, b long").distinct()
