"""Result tables out, tracking tables in."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_report(tables: Mapping[str, DataFrame], path: str) -> None:
    """Each result table as JSON lines under ``path/<name>``."""
    for name, df in tables.items():
        df.write.mode("overwrite").json(f"{path.rstrip('/')}/{name}")


def read_trials(spark: SparkSession, path: str) -> DataFrame:
    """Trial table from CSV: fixed columns typed, parameters gathered in a map."""
    raw = spark.read.option("header", True).option("escape", '"').csv(path)
    fixed = {"number": "bigint", "value": "double", "datetime_start": "timestamp", "datetime_complete": "timestamp",
             "state": "string", "user_attrs_mean_score": "double", "user_attrs_std_score": "double"}
    params = [c for c in raw.columns if c.startswith("params_")]
    entries = F.array(*[F.struct(F.lit(c[len("params_"):]).alias("k"), F.col(c).alias("v")) for c in params])
    pairs = F.filter(entries, lambda e: e["v"].isNotNull())
    return raw.select(
        *[F.col(c).cast(t).alias(c.replace("user_attrs_", "")) for c, t in fixed.items() if c in raw.columns],
        F.map_from_entries(pairs).alias("params"),
    )


def _run_files(spark: SparkSession, root: str, kind: str) -> DataFrame:
    files = spark.read.text(f"{root.rstrip('/')}/*/*/{kind}/*").withColumn("_path", F.col("_metadata.file_path"))
    part = r"([^/]+)/([^/]+)/" + kind + r"/([^/]+)$"
    return files.select(
        F.regexp_extract("_path", part, 1).alias("experiment_id"), F.regexp_extract("_path", part, 2).alias("run_id"),
        F.regexp_extract("_path", part, 3).alias("key"), "value",
    )


def read_run_metrics(spark: SparkSession, root: str) -> DataFrame:
    """Metric history ``(experiment_id, run_id, key, ts, value, step)`` of file-tracked runs."""
    parts = F.split("value", " ")
    return _run_files(spark, root, "metrics").where(F.col("value") != "").select(
        "experiment_id", "run_id", "key", F.timestamp_millis(parts[0].cast("bigint")).alias("ts"),
        parts[1].cast("double").alias("value"), F.coalesce(F.get(parts, F.lit(2)).cast("bigint"), F.lit(0)).alias("step"),
    )


def read_run_params(spark: SparkSession, root: str) -> DataFrame:
    return _run_files(spark, root, "params")


def read_run_tags(spark: SparkSession, root: str) -> DataFrame:
    return _run_files(spark, root, "tags")
