"""Log streams: tail, late rows, boundary duplicates, windowed rates, scoring."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from emberlog.session import shared_folder

LATENESS = "10 minutes"
POLL = "5 seconds"


def tail_to(
    stream: DataFrame, path: str, checkpoint: str, follow: bool = True, poll: str = POLL, mode: str = "append",
    fmt: str = "parquet",
) -> StreamingQuery:
    """Append a stream to a folder. ``follow`` keeps polling, else what is there is read
    once. The checkpoint remembers the position across restarts."""
    writer = stream.writeStream.format(fmt).outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=poll) if follow else writer.trigger(availableNow=True)
    return writer.start(path)


def run_once(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Drive a stream over the available data and return what it wrote.

    Output and checkpoint go below ``spark.checkpoint.dir`` where that is set.
    """
    spark = stream.sparkSession
    home = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    schema = stream.schema
    if mode == "append":
        tail_to(stream, f"{home}/out", f"{home}/checkpoint", follow=False).awaitTermination()
    else:
        # updates replace earlier rows of their key, so each batch keeps its number
        def save(batch: DataFrame, number: int) -> None:
            batch.withColumn("_batch", F.lit(number)).write.mode("overwrite").parquet(f"{home}/out/n={number}")

        query = (
            stream.writeStream.outputMode(mode).foreachBatch(save)
            .option("checkpointLocation", f"{home}/checkpoint").trigger(availableNow=True).start()
        )
        query.awaitTermination()
        schema = StructType([*schema.fields, StructField("_batch", IntegerType())])
    return spark.read.schema(schema).parquet(f"{home}/out" if mode == "append" else f"{home}/out/n=*")


def stream_table(spark: SparkSession, sf_dir: str, name: str, files_per_batch: int = 64) -> DataFrame:
    """A given table as a file stream; zone-less times become instants. A micro-batch takes
    ``files_per_batch`` files at most, which bounds what a keyed state sees at once."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    stream = reader.parquet(f"{sf_dir}/{name[:-1]}[{name[-1]}].parquet")
    casts = {f.name: F.col(f.name).cast("timestamp") for f in schema if f.dataType.typeName() == "timestamp_ntz"}
    return stream.withColumns(casts) if casts else stream


def drop_boundary_duplicates(stream: DataFrame, id_column: str, ts: str, lateness: str = LATENESS) -> DataFrame:
    """Events seen in two overlapping polls pass once; state is bounded by the watermark."""
    return stream.withWatermark(ts, lateness).dropDuplicatesWithinWatermark([id_column])


def windowed_rates(
    stream: DataFrame, ts: str = "timestamp", width: str = "5 minutes", slide: str = "1 minute", lateness: str | None = LATENESS
) -> DataFrame:
    """Error rate, request count and duration statistics per sliding window.

    The same function serves batch frames; pass ``lateness=None`` when the stream already
    has its watermark.
    """
    if stream.isStreaming and lateness is not None:
        stream = stream.withWatermark(ts, lateness)
    return (
        stream.groupBy(F.window(ts, width, slide).alias("w"))
        .agg(
            F.count("log_level").alias("request_count"), F.sum("has_error").alias("error_count"),
            F.avg("has_error").alias("error_rate"), F.avg("duration").alias("avg_duration"),
            F.max("duration").alias("max_duration"),
        )
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                "request_count", "error_count", "error_rate", "avg_duration", "max_duration")
    )


def split_late(df: DataFrame, ts: str, arrival: str, lateness_seconds: int = 600) -> DataFrame:
    """Mark rows that arrive behind the newest event time of earlier arrivals by more
    than the lateness: the rows a stream would drop, for a side output in replay.

    The newest earlier event time is a running maximum over arrivals: the maxima of whole
    slots are carried over and a window inside the slot adds its own earlier arrivals, so
    no task sees more than one slot.
    """
    from pyspark.sql import Window

    slot = F.floor(F.unix_micros(arrival) / (lateness_seconds * 1_000_000))
    slotted = df.withColumn("_slot", slot)
    per_slot = slotted.groupBy("_slot").agg(F.max(ts).alias("_top"))
    before = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)  # one row per slot
    carried = per_slot.select(F.col("_slot").alias("_s"), F.max("_top").over(before).alias("_carried"))
    inside = Window.partitionBy("_slot").orderBy(F.unix_micros(arrival)).rangeBetween(Window.unboundedPreceding, -1)
    return (
        slotted.withColumn("_inside", F.max(ts).over(inside))
        .join(carried, F.col("_slot") == F.col("_s"), "left")
        .withColumn("_newest", F.unix_micros(F.greatest("_carried", "_inside")))
        .withColumn("is_late", F.coalesce(F.unix_micros(ts) < F.col("_newest") - lateness_seconds * 1_000_000, F.lit(False)))
        .drop("_slot", "_s", "_carried", "_inside", "_newest")
    )


def daily_counters(stream: DataFrame, ts: str, variant: str, prediction: str, latency: str, lateness: str = "30 days") -> DataFrame:
    """Running counters per variant, day and class; a day is dropped from the state once
    the watermark has passed it."""
    if stream.isStreaming:
        stream = stream.withWatermark(ts, lateness)
    return (
        stream.groupBy(F.window(ts, "1 day").alias("w"), variant, prediction)
        .agg(F.count(F.lit(1)).alias("predictions"), F.sum(latency).alias("total_latency"))
        .select(F.col("w.start").alias("day"), variant, prediction, "predictions", "total_latency")
    )


def latest_update(updates: DataFrame, keys: list[str]) -> DataFrame:
    """Last written row per key of an update-mode output."""
    values = [c for c in updates.columns if c not in (*keys, "_batch")]
    return updates.groupBy(*keys).agg(F.max_by(F.struct(*values), "_batch").alias("v")).select(*keys, "v.*")


def score_stream(stream: DataFrame, model, keep: list[str]) -> DataFrame:
    """Score a feature stream with a fitted model; no state, so it is the batch path."""
    from emberlog.operators.models import predict

    return predict(model, stream, keep=keep)
