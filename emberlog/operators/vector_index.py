"""Cosine search by inverted lists.

Centres are learned by k-means on a bounded sample; every item lies in the list of its
nearest centre, in files by list. A query visits the lists of its nearest centres until
they hold ``max_candidates`` items, and is compared exactly with these. An item's angle to
the query is at least the query's angle to the centre less the widest angle in the list, so
a list whose bound is under the query's k-th score (or the threshold) cannot matter. Queries
for which some unvisited list could still matter are sent to those lists in a second round
(``exact=True``), and the result is that of a full comparison.

Neighbouring lists form shelves, and a longer list is cut into several. A cell compares a
block of queries with a shelf; a query goes there once, with a bit for each list it visits.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.operators.stats import top_n_per_key
from emberlog.operators.vectors import (
    CORPUS_BLOCK,
    QUERY_BLOCK,
    best_pairs,
    grid,
    hit_schema,
    hits_table,
    id_values,
    places,
    unit_rows,
    vector_rows,
)
from emberlog.session import shared_folder, stored

MOST_LISTS = 4096
SLACK = 1e-6


@dataclass
class VectorIndex:
    """``centres`` (a unit row each) with the sizes of their lists and the least cosine of
    an item to its centre; ``items`` has list, item_id and vector."""

    centres: np.ndarray
    sizes: np.ndarray
    reach: np.ndarray
    items: DataFrame | None
    item_id: str


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return unit_rows(flat.reshape(len(column), -1)) if len(column) else np.zeros((0, 0))


def fit_centres(vectors: np.ndarray, lists: int, seed: int = 42, rounds: int = 12) -> np.ndarray:
    """Spherical k-means of unit rows; an empty centre moves to the row farthest from its own."""
    rng = np.random.default_rng(seed)
    centres = vectors[rng.choice(len(vectors), lists, replace=False)]
    for _ in range(rounds):
        cosine = vectors @ centres.T
        own = cosine.argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, vectors)
        far = np.argsort(cosine[np.arange(len(own)), own], kind="stable")
        empty = np.flatnonzero(np.bincount(own, minlength=lists) == 0)
        sums[empty] = vectors[far[: len(empty)]]
        centres = unit_rows(sums)
    return centres


def build_index(items: DataFrame, lists: int | None = None, item_id: str = "item_id", vector: str = "vector",
                sample_rows: int = 20_000, seed: int = 42) -> VectorIndex:
    """Every item is indexed; ``sample_rows`` bounds what the centres are learned from."""
    spark = items.sparkSession
    rows = items.where(F.col(vector).isNotNull()).select(F.col(item_id), F.col(vector).cast("array<float>").alias("vector"))
    sample = rows.orderBy(F.xxhash64(item_id), item_id).limit(sample_rows).select("vector").toArrow()
    known = _matrix(sample.column("vector").combine_chunks()) if sample.num_rows else np.zeros((0, 0))
    n_lists = min(lists or max(1, round(math.sqrt(rows.count()))), MOST_LISTS, len(known))
    centres = fit_centres(known, n_lists, seed) if n_lists else known
    kind = rows.schema[item_id].dataType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = _matrix(batch.column("vector"))
                cosine = v @ centres.T
                own = cosine.argmax(1)
                near = np.where((v == 0).all(1), -1.0, cosine[np.arange(len(own)), own])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(near), pa.array(own.astype(np.int32))], [item_id, "vector", "near", "list"]
                )

    path = f"{shared_folder(spark)}/vector-lists-{uuid.uuid4().hex}"
    placed = rows.mapInArrow(assign, f"`{item_id}` {kind}, vector array<float>, near double, list int")
    placed.hint("rebalance", "list").write.partitionBy("list").parquet(path)
    stored = spark.read.schema(placed.schema).parquet(path)
    sizes, reach = np.zeros(n_lists, np.int64), np.ones(n_lists)
    for r in stored.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.min("near").alias("reach")).collect():  # a row for each list
        sizes[r["list"]], reach[r["list"]] = r["n"], r["reach"]
    return VectorIndex(centres, sizes, reach, stored.drop("near"), item_id)


def _shelves(sizes: np.ndarray, most: int) -> list[tuple[int, int, int]]:
    """(first list, list after the last, parts): neighbouring lists of ``most`` items in all;
    a longer list is alone and in parts."""
    out: list[tuple[int, int, int]] = []
    held = most + 1
    for i, n in enumerate(sizes.tolist()):
        if n > most:
            out.append((i, i + 1, -(-n // most)))
            held = most + 1
        elif held + n <= most:
            out[-1] = (out[-1][0], i + 1, 1)
            held += n
        else:
            out.append((i, i + 1, 1))
            held = n
    return out


def _lists_to_visit(index: VectorIndex, vectors: np.ndarray, max_candidates: int, least: np.ndarray | None = None) -> np.ndarray:
    """Whether a query (row) visits a list (column): in the first round the nearest ones, in
    the second those left that could hold a better item than ``least``."""
    cosine = vectors @ index.centres.T
    order = np.argsort(-cosine, axis=1, kind="stable")
    held = np.cumsum(index.sizes[order], axis=1)
    first = (held <= max_candidates) | (np.arange(len(index.centres)) == 0)
    visited = np.zeros(cosine.shape, bool)
    np.put_along_axis(visited, order, first, axis=1)
    if least is not None:
        widest = np.arccos(np.clip(index.reach, -1, 1))
        bound = np.cos(np.maximum(0.0, np.arccos(np.clip(cosine, -1, 1)) - widest)) + SLACK
        visited = ~visited & (bound >= least[:, None])
    return visited & (index.sizes > 0)


def _known(index: VectorIndex) -> VectorIndex:
    """What tasks need of an index."""
    return replace(index, items=None)


def _visits(index: VectorIndex, queries: DataFrame, query_id: str, threshold: float, max_candidates: int, second: bool, shelves: list) -> DataFrame:
    """(q, v, least, c, bits) for each part of a shelf to visit; the bits tell its lists."""
    kind = queries.schema[query_id].dataType.simpleString()
    known, names = _known(index), ["q", "v", "least", "c", "bits"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                least = np.full(part.num_rows, threshold)
                if second:
                    least = np.maximum(part.column("least").to_numpy(zero_copy_only=False), threshold)
                visited = _lists_to_visit(known, _matrix(part.column("v")), max_candidates, least if second else None)
                c = 0
                for first, after, parts in shelves:
                    q = np.flatnonzero(visited[:, first:after].any(1))
                    bits = pa.array([x.tobytes() for x in np.packbits(visited[q, first:after], axis=1)], pa.binary())
                    asked = [part.column("q").take(pa.array(q)), part.column("v").take(pa.array(q)), pa.array(least[q])]
                    for _ in range(parts if len(q) else 0):
                        yield pa.RecordBatch.from_arrays([*asked, pa.array(np.full(len(q), c, np.int32)), bits], names)
                        c += 1
                    c += 0 if len(q) else parts

    asked = queries.select(F.col(query_id).alias("q"), "v", *(["least"] if second else []))
    return asked.mapInArrow(run, f"q {kind}, v array<float>, least double, c int, bits binary")


def _shelf_search(query_id: str, item_id: str, k: int, skip_same: bool):
    """The k best items (i, v, list) for each query (q, v, least, bits) of a cell, each
    query compared with the lists that its bits name."""

    def spans(bits: np.ndarray, known: np.ndarray, lists: np.ndarray, first: int):
        starts = np.append(0, np.flatnonzero(np.diff(lists)) + 1).tolist()
        for lo, hi in zip(starts, [*starts[1:], len(lists)], strict=True):
            at = int(lists[lo]) - first
            yield lo, hi, np.flatnonzero(known & (bits[:, at >> 3] >> (7 - (at & 7)) & 1).astype(bool))

    def search(ours: pa.Table, theirs: pa.Table) -> pa.Table:
        found = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        if ours.num_rows and theirs.num_rows:
            theirs = theirs.sort_by("list")
            bits = np.frombuffer(b"".join(ours.column("bits").to_pylist()), np.uint8).reshape(ours.num_rows, -1)
            known = ours.column("q").combine_chunks().is_valid().to_numpy(zero_copy_only=False)
            lists = theirs.column("list").to_numpy()
            found = best_pairs(
                vector_rows(ours.column("v")), vector_rows(theirs.column("v")), id_values(ours.column("q")), id_values(theirs.column("i")),
                places(theirs.column("i")), k, ours.column("least").to_numpy(), skip_same,
                spans(bits, known, lists, theirs.column("first")[0].as_py()),
            )
        return hits_table(ours, theirs, found, query_id, item_id)

    return search


def _compared(index: VectorIndex, queries: DataFrame, rows: int, columns: int, query_id: str, k: int, threshold: float,
              skip_same: bool, max_candidates: int, second: bool) -> DataFrame:
    """The k best of each query in each shelf that it visits. A query goes to a shelf once,
    however many of its lists it visits, and an item to each of ``rows`` blocks of queries."""
    spark = queries.sparkSession
    shelves = _shelves(index.sizes, min(CORPUS_BLOCK, max(1, -(-int(index.sizes.sum()) // columns))))
    bases = np.cumsum([0, *(parts for *_, parts in shelves)]).tolist()
    held = [(i, first, c, parts) for (first, after, parts), c in zip(shelves, bases[:-1], strict=True) for i in range(first, after)]
    lists = F.broadcast(spark.createDataFrame(held, "list int, first int, c int, parts int"))
    block = F.pmod(F.xxhash64("q"), F.lit(rows)).cast("int").alias("r")
    left = _visits(index, queries, query_id, threshold, max_candidates, second, shelves).select(block, "c", "q", "v", "least", "bits")
    right = index.items.join(lists, "list").select(
        F.explode(F.sequence(F.lit(0), F.lit(rows - 1))).alias("r"), (F.col("c") + F.pmod(F.xxhash64(index.item_id), "parts")).cast("int").alias("c"),
        F.col(index.item_id).alias("i"), F.col("vector").alias("v"), "list", "first",
    )
    schema = hit_schema(query_id, queries.schema[query_id], index.item_id, index.items.schema[index.item_id])
    return left.groupBy("r", "c").cogroup(right.groupBy("r", "c")).applyInArrow(_shelf_search(query_id, index.item_id, k, skip_same), schema)


def indexed_top_k(
    index: VectorIndex, queries: DataFrame, k: int = 5, threshold: float = 0.7, query_id: str = "query_id",
    vector: str = "vector", skip_same: bool = False, max_candidates: int = 4096, exact: bool = True,
) -> DataFrame:
    """The ``k`` most similar items of each query with at least ``threshold``, as
    ``vectors.cosine_top_k`` gives them; without ``exact``, those of the first lists only."""
    item_id = index.item_id
    asked = queries.where(F.col(vector).isNotNull()).select(query_id, F.col(vector).cast("array<float>").alias("v"))
    if not len(index.centres):
        schema = hit_schema(query_id, asked.schema[query_id], item_id, index.items.schema[item_id])
        return top_n_per_key(queries.sparkSession.createDataFrame([], schema), [query_id], [F.desc("score"), F.asc(item_id)], k)
    order = [F.desc("score"), F.asc(item_id)]
    rows, columns = grid(queries.sparkSession, asked.count(), int(index.sizes.sum()), QUERY_BLOCK, CORPUS_BLOCK)
    first = _compared(index, asked, rows, columns, query_id, k, threshold, skip_same, max_candidates, False)
    if not exact:
        return top_n_per_key(first, [query_id], order, k)
    best = stored(top_n_per_key(first, [query_id], order, k).drop("rank"))
    least = best.groupBy(query_id).agg(F.min("score").alias("low"), F.count(F.lit(1)).alias("n"))
    open_ = asked.join(least, query_id, "left").withColumn("least", F.when(F.col("n") >= k, F.col("low")).otherwise(-1.0))
    second = _compared(index, open_, rows, columns, query_id, k, threshold, skip_same, max_candidates, True)
    return top_n_per_key(best.unionByName(second), [query_id], order, k)


def candidates_seen(index: VectorIndex, queries: DataFrame, query_id: str = "query_id", vector: str = "vector", max_candidates: int = 4096) -> DataFrame:
    """How many items each query is compared with in the first round."""
    asked = queries.where(F.col(vector).isNotNull()).select(query_id, F.col(vector).cast("array<float>").alias("v"))
    kind = asked.schema[query_id].dataType.simpleString()
    known = _known(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                visited = _lists_to_visit(known, _matrix(part.column("v")), max_candidates)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(visited @ known.sizes), pa.array(visited.sum(1))], [query_id, "candidates", "lists"]
                )

    counted = asked.mapInArrow(run, f"`{query_id}` {kind}, candidates long, lists long").where("lists > 0")
    return counted.groupBy(query_id).agg(F.sum("candidates").alias("candidates"), F.sum("lists").alias("lists"))
