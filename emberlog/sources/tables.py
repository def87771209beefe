"""Adapters that present the given tables as the inputs the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder; zone-less timestamps are read as UTC instants."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    casts = {f.name: F.col(f.name).cast("timestamp") for f in df.schema if f.dataType.typeName() == "timestamp_ntz"}
    return df.withColumns(casts) if casts else df


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan with fewer splits than cores, ahead of per-row work that is heavier
    than moving the row. A large table has splits enough and is left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


# Spark and the checking engine evaluate the same expressions over ``events``.
LOG_STREAM_SQL = """CASE WHEN event_id % 97 = 0 THEN NULL
     WHEN event_id % 89 = 0 THEN 'x'
     WHEN event_id % 83 = 0 THEN '/ecs/batch'
     ELSE concat('/aws/', CASE user_id % 4 WHEN 0 THEN 'lambda' WHEN 1 THEN 'ecs'
                                           WHEN 2 THEN 'rds' ELSE 'apigateway' END,
                 '/instance-', CAST(event_id % 5 + 1 AS VARCHAR(20))) END"""

MESSAGE_SQL = """CASE WHEN event_id % 2 = 0 THEN concat('{',
       CASE WHEN event_type = 'error' THEN '"level":"ERROR",'
            WHEN event_id % 5 = 0 THEN '"level":"WARN",'
            WHEN event_id % 5 = 1 THEN ''
            WHEN event_id % 5 = 2 THEN '"level":"DEBUG",'
            ELSE '"level":"INFO",' END,
       '"requestId":"req-', CAST(event_id AS VARCHAR(20)), '"',
       CASE WHEN event_id % 7 = 0 THEN ''
            ELSE concat(',"duration":', CAST(CAST(round(value * 20) AS BIGINT) AS VARCHAR(20))) END,
       ',"memoryUsed":', CAST((event_id * 7919) % 150000000 + 50000000 AS VARCHAR(20)),
       CASE WHEN event_type = 'error' THEN concat(',"errorType":"',
              CASE event_id % 3 WHEN 0 THEN 'TimeoutError' WHEN 1 THEN 'MemoryError' ELSE 'ConnectionError' END,
              '","errorMessage":"call ', CAST(user_id AS VARCHAR(20)), ' did not finish"') ELSE '' END,
       '}')
     WHEN event_type = 'error' THEN 'Failed to connect to database: connection timeout'
     WHEN event_type = 'click' THEN concat('click handled for user ', CAST(user_id AS VARCHAR(20)))
     WHEN event_type = 'view' THEN 'Deprecated endpoint used, will retry view'
     WHEN event_type = 'signup' THEN concat('Authorization granted  to account ', CAST(user_id AS VARCHAR(20)))
     ELSE 'debug: purchase stored on disk' END"""


def log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw log events: ``event_id, timestamp, message, log_stream, ingestion_time``."""
    message = MESSAGE_SQL.replace("VARCHAR(20)", "STRING")
    stream = LOG_STREAM_SQL.replace("VARCHAR(20)", "STRING")
    return spread(table(spark, sf_dir, "events")).select(
        "event_id",
        F.col("ts").alias("timestamp"),
        F.expr(message).alias("message"),
        F.expr(stream).alias("log_stream"),
        (F.col("ts") + F.expr("INTERVAL 2 SECONDS")).alias("ingestion_time"),
    )


EXPERIMENT_NAME = "model_comparison"

# Share of traffic per variant, the five-way split of the experiment parameters.
VARIANT_WEIGHTS = {
    "control": 0.30,
    "catboost": 0.25,
    "xgb_v1": 0.20,
    "xgb_v2": 0.15,
    "xgb_v3": 0.10,
}


def experiment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One experiment observation per order, keyed by customer."""
    from emberlog.operators.experiment import assign_variant

    orders = table(spark, sf_dir, "orders")
    rows = orders.select(
        F.col("o_orderkey").alias("row_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("o_orderdate").alias("timestamp"),
        F.round(F.col("o_totalprice") / 10000.0, 6).alias("latency_ms"),
        F.round((F.col("o_orderkey") % 1000) / 1000.0, 3).alias("f1_score"),
        F.round(((F.col("o_orderkey") * 37 + F.col("o_custkey")) % 1009) / 1009.0, 6).alias("accuracy"),
        (F.col("o_orderstatus") == "F").cast("int").alias("success"),
        F.col("o_orderpriority").alias("segment"),
        F.col("o_orderstatus").alias("status"),
    )
    return assign_variant(rows, "user_id", EXPERIMENT_NAME, VARIANT_WEIGHTS)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored predictions of three models per event with ground truth."""
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("ts").alias("timestamp"),
        (F.col("event_type") == "error").cast("int").alias("label"),
        "value",
    )
    noise = (F.col("id") * 7919) % 1000
    scored = events.select(
        "id", "timestamp", "label",
        F.explode(
            F.array(
                F.struct(F.lit("booster_a").alias("model"),
                         F.round(F.col("label") * 0.4 + noise / 2000.0, 4).alias("score")),
                F.struct(F.lit("booster_b").alias("model"),
                         F.round(F.col("label") * 0.3 + ((F.col("id") * 104729) % 700) / 1000.0, 4).alias("score")),
                F.struct(F.lit("isolation").alias("model"),
                         F.round(((F.col("id") * 31) % 100) / 100.0, 2).alias("score")),
            )
        ).alias("p"),
    )
    return scored.select(
        "id", "timestamp", "label", "p.model", "p.score",
        (F.col("p.score") >= 0.5).cast("int").alias("prediction"),
    )
