"""Reading, scanning, exporting and tailing log events."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlog.functions.parsing import matches_filter

RAW_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("log_stream", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("log_level", T.StringType()),
        T.StructField("service_name", T.StringType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("memory_used", T.DoubleType()),
        T.StructField("request_id", T.StringType()),
        T.StructField("error_type", T.StringType()),
        T.StructField("error_message", T.StringType()),
    ]
)

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("message", T.StringType()),
        T.StructField("log_stream", T.StringType()),
        T.StructField("ingestion_time", T.TimestampType()),
    ]
)


def load_logs(
    spark: SparkSession, path: str, fmt: str | None = None, schema: T.StructType | None = RAW_SCHEMA, multi_line: bool = True
) -> DataFrame:
    """Load raw logs; the URI scheme picks the file system, the suffix the format.

    ``multi_line`` reads quoted CSV fields with line ends whole, for which a file must be
    one task; without it large CSV files are split among tasks.
    """
    if fmt is None:
        fmt = next((f for f in ("parquet", "json", "csv", "orc") if path.rstrip("/").endswith(f)), "csv")
    reader = spark.read.format(fmt)
    if schema is not None and fmt != "parquet":
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("multiLine", multi_line).option("escape", '"')
    return reader.load(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_features(df: DataFrame, path: str, also_csv: str | None = None) -> None:
    """Feature table as Parquet; a CSV copy leaves out nothing but nested columns, which the
    format cannot hold."""
    df.write.mode("overwrite").parquet(path)
    if also_csv is not None:
        nested = (T.ArrayType, T.MapType, T.StructType, T.BinaryType)
        flat = [f.name for f in df.schema if not isinstance(f.dataType, nested)]
        write_csv(df.sparkSession.read.parquet(path).select(flat), also_csv)


def in_time_range(df: DataFrame, start: datetime | str, end: datetime | str, ts: str = "timestamp") -> DataFrame:
    """Rows with ``start <= ts <= end``; literals, so the bounds reach the file scan."""
    return df.where((F.col(ts) >= F.lit(start).cast("timestamp")) & (F.col(ts) <= F.lit(end).cast("timestamp")))


def scan_events(
    df: DataFrame,
    start: datetime | None = None,
    end: datetime | None = None,
    pattern: str | None = None,
    stream: str | None = None,
    limit: int = 10000,
) -> DataFrame:
    """The earliest ``limit`` events of a time range (default: the last hour).

    ``orderBy().limit()`` plans as a per-partition top-n, not as a full sort.
    """
    end = end or datetime.now(timezone.utc)
    start = start or end - timedelta(hours=1)
    out = in_time_range(df, start, end)
    if stream is not None:
        out = out.where(F.col("log_stream") == stream)
    if pattern:
        out = out.where(matches_filter(F.col("message"), pattern))
    order = [c for c in ("timestamp", "event_id", "log_stream", "message") if c in out.columns]
    return out.orderBy(*order).limit(limit)


def list_streams(df: DataFrame, limit: int = 50) -> DataFrame:
    """Streams by last event time, newest first."""
    return (
        df.where(F.col("log_stream").isNotNull())
        .groupBy("log_stream")
        .agg(F.max("timestamp").alias("last_event"), F.count(F.lit(1)).alias("events"))
        .orderBy(F.desc("last_event"), "log_stream")
        .limit(limit)
    )


def _hour_layout(df: DataFrame, ts: str) -> DataFrame:
    parts = {name: F.date_format(ts, fmt) for name, fmt in
             (("year", "yyyy"), ("month", "MM"), ("day", "dd"), ("hour", "HH"))}
    return df.withColumns(parts)


def write_hourly(df: DataFrame, path: str, ts: str = "timestamp", rows_per_file: int = 5_000_000) -> None:
    """Raw layout ``year=/month=/day=/hour=``.

    Rows are gathered by hour, and a busy hour is split among many writers at run time, so
    there are few files for each hour and no hour in one task. Only the hours that occur in
    ``df`` are replaced.
    """
    hours = _hour_layout(df, ts)
    (
        hours.hint("rebalance", *[F.col(c) for c in ("year", "month", "day", "hour")])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy("year", "month", "day", "hour")
        .parquet(path)
    )


def read_hourly(spark: SparkSession, path: str, start: datetime, end: datetime, ts: str = "timestamp") -> DataFrame:
    """Read a time range of the hourly layout with partition pruning."""
    hour = F.concat("year", "month", "day", "hour")
    df = spark.read.option("spark.sql.sources.partitionColumnTypeInference.enabled", "false").parquet(path)
    df = df.withColumns({c: F.lpad(F.col(c).cast("string"), n, "0") for c, n in
                         (("year", 4), ("month", 2), ("day", 2), ("hour", 2))})
    pruned = df.where(hour.between(start.strftime("%Y%m%d%H"), end.strftime("%Y%m%d%H")))
    return in_time_range(pruned, start, end, ts).drop("year", "month", "day", "hour")


def export_logs(
    df: DataFrame, prefix: str, task: str, start: datetime | None = None, end: datetime | None = None
) -> str:
    """Write a time range (default: the last 24 hours) under ``prefix/task``."""
    end = end or datetime.now(timezone.utc)
    start = start or end - timedelta(days=1)
    target = f"{prefix.rstrip('/')}/{task}"
    write_hourly(in_time_range(df, start, end), target)
    return target


def tail_source(spark: SparkSession, path: str, schema: T.StructType = EVENT_SCHEMA, fmt: str = "parquet",
                pattern: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """Streaming tail of a folder; the query checkpoint remembers what was read."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.load(path)
    return stream.where(matches_filter(F.col("message"), pattern)) if pattern else stream


def expire_hourly(spark: SparkSession, path: str, days: int, newest: datetime) -> list[str]:
    """Retention of the hourly layout: deletes the hours more than ``days`` days before
    ``newest`` and returns their folders. No file is read or rewritten."""
    oldest = (newest - timedelta(days=days)).strftime("%Y%m%d%H")
    jvm = spark._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{path}/year=*/month=*/day=*/hour=*")
    files = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for status in files.globStatus(pattern) or []:
        folder = status.getPath()
        parts = [p.split("=")[1] for p in folder.toString().split("/")[-4:]]
        if "".join(p.zfill(4 if i == 0 else 2) for i, p in enumerate(parts)) < oldest:
            files.delete(folder, True)
            gone.append(folder.toString())
    return sorted(gone)


def keep_recent(df: DataFrame, days: int, ts: str = "timestamp") -> DataFrame:
    """Rows of the last ``days`` days before the newest row (retrain window, retention)."""
    newest = df.agg(F.max(ts).alias("m")).scalar()
    return df.where(F.col(ts) > newest - F.make_dt_interval(F.lit(days)))
