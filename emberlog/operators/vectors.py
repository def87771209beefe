"""Exact cosine search and the retrieval tables built on it."""

from __future__ import annotations

import math
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlog.operators.stats import top_n_per_key

#: Rows of a block at most, on either side: what a task holds.
QUERY_BLOCK = 131072
CORPUS_BLOCK = 131072
#: Pairs that are worth a cell, cells for each core, and rows of one matrix product.
CELL_PAIRS, CELLS_A_CORE, PRODUCT_ROWS = 1_000_000, 4, 4096


def unit_rows(m: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norm == 0, 1.0, norm)


def hit_schema(query_id: str, query: T.StructField, item_id: str, item: T.StructField) -> T.StructType:
    fields = [T.StructField(query_id, query.dataType), T.StructField(item_id, item.dataType)]
    return T.StructType([*fields, T.StructField("score", T.DoubleType())])


def grid(spark: SparkSession, queries: int, items: int, query_block: int, corpus_block: int) -> tuple[int, int]:
    """Blocks of queries and of items. Their number follows the cores, not the rows, so what
    is copied grows as the rows do; only where a block would exceed its bound are there more."""
    cells = CELLS_A_CORE * spark.sparkContext.defaultParallelism
    cells = max(1, min(cells, -(-queries * items // CELL_PAIRS)))
    rows = min(max(1, round(math.sqrt(cells * queries / max(items, 1)))), cells)
    return max(rows, -(-queries // query_block)), max(-(-cells // rows), -(-items // corpus_block))


def vector_rows(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    if lists.null_count or (sizes != sizes[:1]).any():
        raise ValueError("vectors must have one length and not be null")
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _float_units(m: np.ndarray) -> np.ndarray:
    out = np.empty(m.shape, np.float32)
    for at in range(0, len(m), PRODUCT_ROWS):
        out[at : at + PRODUCT_ROWS] = unit_rows(m[at : at + PRODUCT_ROWS].astype(np.float64))
    return out


def best_pairs(
    ours: np.ndarray, theirs: np.ndarray, names: np.ndarray, ids: np.ndarray, place: np.ndarray, k: int,
    least: np.ndarray, skip_same: bool, spans: Iterable[tuple[int, int, np.ndarray]],
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, item row, score) of the ``k`` best items for each query, of those that
    score ``least`` or more; equal scores by ``place``. ``spans`` has ranges of item rows and
    the query rows they are compared with. Products in single precision tell which pairs can
    matter, by a bound on their error; these are scored in double precision."""
    a, b = _float_units(ours), _float_units(theirs)
    slack = 2.4e-7 * (ours.shape[1] + 8)
    cut = least.astype(np.float64)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    held, most = 0, 1_000_000 + 2 * k * len(ours)

    def exact(q: np.ndarray, i: np.ndarray) -> np.ndarray:
        out = np.empty(len(q))
        for at in range(0, len(q), 65536):
            to = slice(at, at + 65536)
            out[to] = np.einsum("ij,ij->i", unit_rows(ours[q[to]].astype(np.float64)), unit_rows(theirs[i[to]].astype(np.float64)))
        return np.round(out, 9)

    def best() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        q, i, score = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
        order = np.lexsort((place[i], -score, q))
        q, i, score = q[order], i[order], score[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q, "left")
        cut[q[rank == k - 1]] = score[rank == k - 1]
        return q[rank < k], i[rank < k], score[rank < k]

    for first, last, rows in spans:
        for lo in range(first, last, PRODUCT_ROWS):
            hi = min(lo + PRODUCT_ROWS, last)
            for at in range(0, len(rows), PRODUCT_ROWS):
                part = rows[at : at + PRODUCT_ROWS]
                near = a[part] @ b[lo:hi].T
                here = near >= (cut[part] - slack).astype(np.float32)[:, None]
                if hi - lo > k and np.count_nonzero(here) > 4 * k * len(part):
                    if skip_same:
                        here &= names[part][:, None] != ids[None, lo:hi]
                    near[~here] = -np.inf
                    kth = np.partition(near, hi - lo - k, axis=1)[:, hi - lo - k]
                    here &= near >= (kth - 2 * slack)[:, None]
                q, i = np.nonzero(here)
                q, i = part[q], i + lo
                if skip_same:
                    other = names[q] != ids[i]
                    q, i = q[other], i[other]
                score = exact(q, i)
                keep = score >= cut[q]
                found.append((q[keep], i[keep], score[keep]))
                held += int(keep.sum())
                if held > most:
                    found = [best()]
                    held = len(found[0][0])
    return best()


def hits_table(ours: pa.Table, theirs: pa.Table, found: tuple[np.ndarray, np.ndarray, np.ndarray], query_id: str, item_id: str) -> pa.Table:
    q, i, score = found
    return pa.table([ours.column("q").take(pa.array(q)), theirs.column("i").take(pa.array(i)), pa.array(score)], [query_id, item_id, "score"])


def id_values(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().to_numpy(zero_copy_only=False)


def places(column: pa.ChunkedArray) -> np.ndarray:
    """Each row's place in ascending order of the column."""
    out = np.empty(len(column), np.int64)
    out[pc.sort_indices(column).to_numpy()] = np.arange(len(column))
    return out


def block_search(query_id: str, item_id: str, k: int, threshold: float, skip_same: bool):
    """The k best items (i, v) for each query (q, v) of a cell."""

    def search(ours: pa.Table, theirs: pa.Table) -> pa.Table:
        found = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        if ours.num_rows and theirs.num_rows:
            known = np.flatnonzero(ours.column("q").combine_chunks().is_valid().to_numpy(zero_copy_only=False))
            found = best_pairs(
                vector_rows(ours.column("v")), vector_rows(theirs.column("v")), id_values(ours.column("q")), id_values(theirs.column("i")),
                places(theirs.column("i")), k, np.full(ours.num_rows, threshold), skip_same, [(0, theirs.num_rows, known)],
            )
        return hits_table(ours, theirs, found, query_id, item_id)

    return search


def cosine_top_k(
    queries: DataFrame, corpus: DataFrame, k: int = 5, threshold: float = 0.7, query_id: str = "query_id",
    item_id: str = "item_id", vector: str = "vector", skip_same: bool = False,
    query_block: int = QUERY_BLOCK, corpus_block: int = CORPUS_BLOCK,
) -> DataFrame:
    """The ``k`` most similar items per query with a score of at least ``threshold``.

    Exact search on a grid: queries and items are hashed into blocks of bounded size,
    each (query block, item block) cell is searched by matrix products in its own group,
    and a cell returns at most ``k`` rows per query. Neither side has to fit anywhere; a
    single query block costs one pass over the items. Scores are rounded to nine digits
    before ranking, so ties fall to the smaller id however the sums were ordered.
    """
    rows, columns = grid(queries.sparkSession, queries.count(), corpus.count(), query_block, corpus_block)

    def pick(name: str, of: int) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(of)).cast("int")

    left = queries.select(
        pick(query_id, rows).alias("r"), F.explode(F.sequence(F.lit(0), F.lit(columns - 1))).alias("c"),
        F.col(query_id).alias("q"), F.col(vector).cast("array<float>").alias("v"),
    )
    right = corpus.select(
        F.explode(F.sequence(F.lit(0), F.lit(rows - 1))).alias("r"), pick(item_id, columns).alias("c"),
        F.col(item_id).alias("i"), F.col(vector).cast("array<float>").alias("v"),
    )
    schema = hit_schema(query_id, queries.schema[query_id], item_id, corpus.schema[item_id])
    search = block_search(query_id, item_id, k, threshold, skip_same)
    cells = left.groupBy("r", "c").cogroup(right.groupBy("r", "c")).applyInArrow(search, schema)
    return top_n_per_key(cells, [query_id], [F.desc("score"), F.asc(item_id)], k)


def collection_stats(points: DataFrame, id_column: str = "id") -> DataFrame:
    return points.agg(
        F.count(F.lit(1)).alias("points_count"), F.count_distinct(id_column).alias("vectors_count")
    )


def retrieval_accuracy(hits: DataFrame, labels: DataFrame, query_id: str, item_id: str, id_column: str, label: str) -> DataFrame:
    """Share of retrieved items with the query's label, and of queries with at least one."""
    q = labels.select(F.col(id_column).alias(query_id), F.col(label).alias("_ql"))
    i = labels.select(F.col(id_column).alias(item_id), F.col(label).alias("_il"))
    judged = hits.join(q, query_id).join(i, item_id).groupBy(query_id).agg(
        F.avg((F.col("_ql") == F.col("_il")).cast("int")).alias("p"),
        F.max((F.col("_ql") == F.col("_il")).cast("int")).alias("h"),
    )
    return judged.agg(
        F.count(F.lit(1)).alias("queries"), F.avg("p").alias("precision_at_k"), F.avg("h").alias("hit_rate")
    )


# The wording of the analysis prompt.
PROMPT_HEAD = "You are an expert system administrator analyzing log anomalies.\n\nCurrent Anomaly:\nLog: "
PROMPT_TAIL = (
    "\n\nBased on the anomaly and similar past incidents, provide:\n"
    "1. Root Cause Analysis: What likely caused this anomaly?\n"
    "2. Impact Assessment: How severe is this issue?\n"
    "3. Recommended Actions: What should be done to resolve it?\n"
    "4. Prevention: How to prevent this in the future?\n\n"
    "Be specific and actionable in your response.\n\nAnalysis:"
)
CONTEXT_HEAD = "\n\nSimilar past incidents:\n"
CONTEXT_TEXT_CHARS = 200


def prompt_table(
    anomalies: DataFrame, hits: DataFrame, items: DataFrame, query_id: str = "query_id", item_id: str = "item_id",
) -> DataFrame:
    """One explanation record per anomaly ``(query_id, log, anomaly_score)``.

    ``hits`` are ranked matches, ``items`` carry ``(item_id, text, log_level)``. The
    context array has at most ``k`` entries per anomaly.
    """
    detail = hits.join(items.select(item_id, "text", "log_level"), item_id)
    context = detail.groupBy(query_id).agg(
        F.sort_array(F.collect_list(F.struct("rank", "log_level", "text", "score"))).alias("retrieved_context")
    )
    joined = anomalies.join(context, query_id, "left").withColumn(
        "retrieved_context", F.coalesce("retrieved_context", F.array().cast(context.schema["retrieved_context"].dataType))
    )
    lines = F.array_join(
        F.transform(
            "retrieved_context",
            lambda c: F.concat(
                c["rank"].cast("string"), F.lit(". ["), c["log_level"], F.lit("] "),
                F.substring(c["text"], 1, CONTEXT_TEXT_CHARS), F.lit("\n   Similarity: "),
                F.format_string("%.2f", c["score"]), F.lit("\n"),
            ),
        ),
        "",
    )
    block = F.when(F.size("retrieved_context") > 0, F.concat(F.lit(CONTEXT_HEAD), lines)).otherwise("")
    return joined.withColumns(
        {
            "similar_incidents": F.size("retrieved_context"),
            "prompt_used": F.concat(
                F.lit(PROMPT_HEAD), F.col("log"), F.lit("\nAnomaly Score: "),
                F.format_string("%.2f", F.col("anomaly_score")), F.lit("\n"), block, F.lit(PROMPT_TAIL),
            ),
        }
    )
