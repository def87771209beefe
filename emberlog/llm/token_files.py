"""Token ids as Parquet list columns, and selective reads of them.

``write_token_files`` orders documents by id, encodes each range in one Arrow pass and
writes Parquet: ids dictionary-encoded (a vocabulary is far smaller than a row group),
ordered numbers delta-encoded, row groups and pages of set size, so that page indexes cut
reads of an id range down to its pages. A read of the numbers alone touches no id page.

Cases: a null text is empty and has the end id only; a null id comes first; rows that share
an id stay, ordered by text; an empty table gives files without rows; other columns of the
input, whatever their names, are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emberlog.llm.encoding import encoder, parts

FILE_SCHEMA = "doc_id long, n_tokens long, part int, part_start long, ids array<int>"


def _encoded(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, start = encoder(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = batch.column("text")
            for first, last in parts(texts):
                plain, offsets = words.encode(texts.slice(first, last - first))
                ids = np.insert(plain.astype(np.int32), offsets[1:], end_id)
                sizes = np.diff(offsets) + 1
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, last - first),
                        pa.array(sizes),
                        pa.array(np.full(len(sizes), part, np.int32)),
                        pa.array(start + ends - sizes),
                        pa.ListArray.from_arrays(
                            pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids)
                        ),
                    ],
                    ["doc_id", "n_tokens", "part", "part_start", "ids"],
                )
                start += int(ends[-1])

    return run


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    row_group_bytes: int = 32 << 20,
    page_bytes: int = 1 << 20,
    page_rows: int = 2_000,
) -> None:
    """Encode every text, add ``end_id``, write in ascending order of ``doc_id``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    (
        ordered.mapInArrow(_encoded(tokenizer, end_id), FILE_SCHEMA)
        .write.option("compression", "zstd")
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.page.size", page_bytes)
        .option("parquet.page.row.count.limit", page_rows)
        .option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.enable.dictionary#doc_id", "false")
        .option("parquet.enable.dictionary#part_start", "false")
        .parquet(path)
    )


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, n_tokens and start (ids of all documents before it); no id page is read.

    Starts are kept in the files relative to the file's range; the ranges' totals, one row
    for each written partition, are summed up here and sent to the tasks.
    """
    return _with_start(spark.read.schema(FILE_SCHEMA).parquet(path).drop("ids"))


def read_tokens(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """The same with the ids; ``where`` on doc_id reaches row groups and page indexes."""
    rows = spark.read.schema(FILE_SCHEMA).parquet(path)
    totals = _totals(rows)
    return _with_start(rows if where is None else rows.where(where), totals)


def _totals(rows: DataFrame) -> DataFrame:
    by_part = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return by_part.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("before"))


def _with_start(rows: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    totals = _totals(rows) if totals is None else totals
    return rows.join(F.broadcast(totals), "part").select(
        "doc_id",
        (F.col("before") + F.col("part_start")).alias("start"),
        "n_tokens",
        *[c for c in rows.columns if c not in ("doc_id", "n_tokens", "part", "part_start")],
    )


def token_checksums(tokens: DataFrame) -> DataFrame:
    """Replaces ids by the checksum of their bytes as little-endian unsigned 32-bit ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            values = np.asarray(lists.values).astype("<u4", copy=False)
            ends = np.asarray(lists.offsets)
            sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "start", "n_tokens")), pa.array(sums, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
