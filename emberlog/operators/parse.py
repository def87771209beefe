"""Raw events to parsed log rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlog.functions.parsing import (
    json_fields,
    level_from_text,
    parse_epoch,
    parse_text_timestamp,
    service_from_stream,
    to_number,
)

PARSED_COLUMNS = (
    "timestamp", "message", "log_stream", "service_name", "log_level", "request_id",
    "duration", "memory_used", "error_type", "error_message", "raw_json",
)


def parse_timestamps(df: DataFrame, column: str = "timestamp", layout: str | None = None) -> DataFrame:
    """Bring a timestamp, epoch or text column to TIMESTAMP.

    Values that cannot be read become NULL and set ``<column>_bad``, so that they can be
    quarantined instead of passing as the current time.
    """
    kind = df.schema[column].dataType
    value = F.col(column)
    if isinstance(kind, T.StringType):
        parsed = parse_text_timestamp(value, layout)
    elif isinstance(kind, T.NumericType):
        parsed = parse_epoch(value)
    else:
        parsed = value.cast("timestamp")
    return df.withColumn("_parsed", parsed).withColumns(
        {column: F.col("_parsed"), f"{column}_bad": value.isNotNull() & F.col("_parsed").isNull()}
    ).drop("_parsed")


def parse_logs(df: DataFrame, keep_existing: bool = False) -> DataFrame:
    """Parse ``message`` of every row; other columns of ``df`` pass through.

    Non-empty JSON objects give their own fields, anything else is plain text. With
    ``keep_existing`` a structured column already present wins over the parsed value.
    A frame without ``message`` is returned unchanged.
    """
    if "message" not in df.columns:
        return df
    stream = F.col("log_stream") if "log_stream" in df.columns else F.lit(None).cast("string")
    fields = F.col("_fields")
    is_json = F.coalesce(F.size(fields) > 0, F.lit(False))
    has_level = F.map_contains_key(fields, "level")
    parsed = {
        "log_stream": stream,
        "service_name": service_from_stream(stream),
        "log_level": F.when(is_json, F.when(has_level, fields["level"]).otherwise("INFO")).otherwise(
            level_from_text(F.col("message"))
        ),
        "request_id": fields["requestId"],
        "duration": to_number(fields["duration"]),
        "memory_used": to_number(fields["memoryUsed"]),
        "error_type": fields["errorType"],
        "error_message": fields["errorMessage"],
        "raw_json": F.when(is_json, F.col("message")),
    }
    if keep_existing:
        parsed = {
            name: F.coalesce(F.col(name), made) if name in df.columns else made
            for name, made in parsed.items()
        }
    others = [c for c in df.columns if c not in parsed]
    return df.withColumn("_fields", json_fields(F.col("message"))).select(
        *others, *[made.alias(name) for name, made in parsed.items()]
    )
