"""Session helpers.

The library never overrides what a cluster has configured; the builder below only
serves local runs (tests, the bench) and keeps the time zone fixed to UTC.
"""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "emberlog", cores: str = "*", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def range_parts(spark: SparkSession) -> int:
    """Number of ordered ranges to cut a table into: the power of two at or above the
    shuffle partition count, so that every task of a range-wise window has work."""
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return 1 << max(3, math.ceil(math.log2(max(shuffle, 2))))


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, from ``spark.checkpoint.dir``. A scratch folder is
    used only where that is unset, which is the case in local tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="emberlog-")
    return folder.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """Write a result once to the shared folder and go on from the files.

    For results that several ordered steps read: each of those steps scans its input a few
    times, so stacking them on an unfinished plan would multiply the work. Parquet rather
    than ``checkpoint()``, because later steps then read only the columns they need.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
