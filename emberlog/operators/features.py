"""Feature engineering on parsed log rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberlog.functions.binning import bucketize, finite_or_zero, flag, lookup
from emberlog.functions.parsing import to_number, word_count
from emberlog.operators.ordered import trailing_window, with_lags, with_position
from emberlog.session import stored

# Severity per level, unknown levels count as 2.
SEVERITY = {"DEBUG": 1, "INFO": 2, "WARN": 3, "ERROR": 4, "FATAL": 5}
LEVELS = ("DEBUG", "INFO", "WARN", "ERROR", "FATAL")

# Keyword groups searched for in messages.
KEYWORD_PATTERNS = {
    "timeout": "timeout|timed out",
    "connection": "connection|connect",
    "auth": "auth|authorization|unauthorized",
    "permission": "permission|denied|forbidden",
    "memory": "memory|oom|out of memory",
    "cpu": "cpu|processor",
    "disk": "disk|storage|space",
    "network": "network|dns|socket",
}

SLOW_MS = 3000
FIVE_MINUTES_US = 300_000_000
FILLED_WITH_ZERO = (
    "duration", "memory_used", "error_rate", "error_count", "request_count",
    "avg_duration", "max_duration",
)
NON_FEATURES = (
    "timestamp", "message", "log_stream", "service_name", "request_id",
    "error_type", "error_message", "raw_json", "is_anomaly", "log_level",
)


def _column(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def time_features(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    if ts not in df.columns:
        return df
    hour, weekday = F.hour(ts), F.weekday(ts)
    return df.withColumns(
        {
            "hour": hour,
            "day_of_week": weekday,
            "day_of_month": F.dayofmonth(ts),
            "month": F.month(ts),
            "year": F.year(ts),
            "is_weekend": flag(weekday.isin(5, 6)),
            "is_business_hours": flag((hour >= 9) & (hour < 17) & (weekday < 5)),
            "time_of_day": bucketize(
                hour, [0, 6, 12, 18, 24], ["night", "morning", "afternoon", "evening"]
            ),
        }
    )


def level_features(df: DataFrame, levels: Sequence[str] = LEVELS) -> DataFrame:
    """One column per level of a fixed vocabulary, so a stream has a fixed schema too."""
    if "log_level" not in df.columns:
        return df
    level = F.col("log_level")
    dummies = {f"log_level_{v}": F.coalesce(level == v, F.lit(False)) for v in levels}
    return df.withColumns({**dummies, "log_severity": lookup(level, SEVERITY, 2)})


def occurring_levels(df: DataFrame, column: str = "log_level", most: int = 100) -> list[str]:
    """The fixed levels, then by name the others among the ``most`` frequent values: with
    these, ``level_features`` has a column for each level that occurs. Column names do not
    tell upper from lower case, so of spellings that differ in case alone the first has one."""
    names = {v.upper(): v for v in LEVELS}
    for v in sorted(vocabulary(df, column, most)):
        names.setdefault(v.upper(), v)
    return list(names.values())


def one_hot(df: DataFrame, column: str, values: Sequence[str], prefix: str | None = None) -> DataFrame:
    prefix = column if prefix is None else prefix
    return df.withColumns({f"{prefix}_{v}": flag(F.col(column) == v) for v in values})


def vocabulary(df: DataFrame, column: str, top: int) -> list[str]:
    """The ``top`` most frequent values, ties by name. Brings ``top`` names to the driver."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).count()
    return [r[0] for r in counted.orderBy(F.desc("count"), F.asc(column)).limit(top).collect()]


def error_features(df: DataFrame) -> DataFrame:
    level, kind = _column(df, "log_level"), _column(df, "error_type")
    added = {"has_error": flag(F.coalesce(level == "ERROR", F.lit(False)) | kind.isNotNull())}
    if "error_message" in df.columns:
        added["error_message_length"] = F.length(F.coalesce(F.col("error_message"), F.lit("")))
    return df.withColumns(added)


def performance_features(df: DataFrame) -> DataFrame:
    added = {}
    if "duration" in df.columns:
        duration = to_number(F.col("duration"))
        added |= {
            "duration": duration,
            "duration_log": F.log1p(F.coalesce(duration, F.lit(0.0))),
            "is_slow": flag(duration > SLOW_MS),
        }
    if "memory_used" in df.columns:
        memory = to_number(F.col("memory_used"))
        added |= {"memory_used": memory, "memory_used_mb": memory / (1024 * 1024)}
    return df.withColumns(added) if added else df


def text_features(df: DataFrame) -> DataFrame:
    if "message" not in df.columns:
        return df
    message = F.col("message")
    low = F.lower(message)
    flags = {f"has_{name}": flag(low.rlike(p)) for name, p in KEYWORD_PATTERNS.items()}
    return df.withColumns(
        {"message_length": F.length(message), "word_count": word_count(message), **flags}
    )


def _text_key(column: Column, start: int) -> Column:
    """Seven bytes of the text as a number that sorts like them."""
    piece = F.substring(F.encode(column, "UTF-8"), start, 7)
    return F.conv(F.rpad(F.hex(piece), 14, "0"), 16, 10).cast("bigint")


def value_codes(df: DataFrame, column: str, null_as: str | None = None) -> DataFrame:
    """Dictionary ``(column, code)`` with codes from 0 in lexical order.

    Built from the distinct values by exact position, so it does not need the dictionary
    to fit anywhere.
    """
    value = F.col(column).cast("string")
    if null_as is not None:
        value = F.coalesce(value, F.lit(null_as))
    distinct = (
        df.select(value.alias(column)).where(F.col(column).isNotNull()).distinct()
        .withColumns({"_k1": _text_key(F.col(column), 1), "_k2": _text_key(F.col(column), 8)})
    )
    placed = with_position(distinct, [], ["_k1", "_k2", column], tie="_k2", name="_at")
    return placed.select(column, (F.col("_at") - 1).cast("int").alias("code"))


SMALL_DICTIONARY = 1000


def small_dictionary(df: DataFrame, column: str, limit: int = SMALL_DICTIONARY) -> list[str] | None:
    """The sorted distinct values if there are at most ``limit`` of them, else None.

    The check itself brings at most ``limit + 1`` values to the driver.
    """
    found = df.select(column).where(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()
    return None if len(found) > limit else sorted(r[0] for r in found)


def encode_ordinal(
    df: DataFrame,
    column: str,
    out: str,
    null_as: str | None = None,
    null_code: int = -1,
    values: Sequence[str] | None = None,
    limit: int = SMALL_DICTIONARY,
) -> DataFrame:
    """Attach the position of ``column`` among its sorted distinct values.

    A dictionary of checked small size (or a given one) becomes a map literal, so the rows
    are only projected. A larger one is ranked in parallel, written, and joined with the
    strategy its size calls for.
    """
    value = F.col(column).cast("string")  # one order of codes for every type and size
    value = value if null_as is None else F.coalesce(value, F.lit(null_as))
    if values is None:
        values = small_dictionary(df.select(value.alias(column)), column, limit)
    if values is not None:
        if not values:
            return df.withColumn(out, F.lit(null_code))
        codes = F.create_map(*[F.lit(x) for i, v in enumerate(values) for x in (v, i)])
        return df.withColumn(out, F.coalesce(F.try_element_at(codes, value), F.lit(null_code)))
    codes = stored(value_codes(df, column, null_as).select(F.col(column).alias("_v"), F.col("code").alias(out)))
    joined = df.withColumn("_value", value).join(codes, F.col("_value") == F.col("_v"), "left")
    return joined.withColumn(out, F.coalesce(out, F.lit(null_code))).drop("_v", "_value")


def service_features(df: DataFrame, top: int = 10, services: Sequence[str] | None = None) -> DataFrame:
    """Code of the service and one flag for each of the ``top`` most frequent ones.

    ``services`` fixes the vocabulary for both, as a stream needs.
    """
    if "service_name" not in df.columns:
        return df
    names = vocabulary(df, "service_name", top) if services is None else services
    coded = encode_ordinal(df, "service_name", "service_encoded", values=services)
    return one_hot(coded, "service_name", names, "service")


def rolling_features(df: DataFrame, width_us: int = FIVE_MINUTES_US, ts: str = "timestamp") -> DataFrame:
    """Trailing error rate, error count, request count and duration statistics."""
    if ts not in df.columns:
        return df
    measures = {"request_count": ("count", F.col("log_level"))}
    if "has_error" in df.columns:
        measures |= {"error_count": ("sum", F.col("has_error")), "_rows": ("count", F.col("has_error"))}
    if "duration" in df.columns:
        measures |= {
            "_dur_sum": ("sum", F.col("duration")),
            "_dur_n": ("count", F.col("duration")),
            "max_duration": ("max", F.col("duration")),
        }
    out = trailing_window(df, ts, width_us, measures)
    if "has_error" in df.columns:
        out = out.withColumn("error_rate", F.try_divide(F.col("error_count"), F.col("_rows")))
    if "duration" in df.columns:
        out = out.withColumn("avg_duration", F.try_divide(F.col("_dur_sum"), F.col("_dur_n")))
    return out.drop("_rows", "_dur_sum", "_dur_n")


def fill_zero(df: DataFrame, columns: Sequence[str] = FILLED_WITH_ZERO) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return df.fillna(0, subset=present) if present else df


def create_features(
    df: DataFrame, width_us: int = FIVE_MINUTES_US, services: Sequence[str] | None = None
) -> DataFrame:
    """All feature groups in order, then the null fill."""
    out = df.transform(time_features).transform(level_features).transform(error_features)
    if "error_type" in out.columns:
        out = encode_ordinal(out, "error_type", "error_type_encoded", null_as="None")
    out = out.transform(performance_features).transform(service_features, services=services)
    return out.transform(text_features).transform(rolling_features, width_us).transform(fill_zero)


def numeric_features(df: DataFrame, drop: Sequence[str] = NON_FEATURES) -> list[str]:
    """Names of the model inputs: numeric columns that are no id, text or label."""
    return [
        f.name for f in df.schema if f.name not in drop and isinstance(f.dataType, T.NumericType)
    ]


def clean_vector(df: DataFrame, columns: Sequence[str], out: str = "features") -> DataFrame:
    """Assemble ``columns`` as an ML vector with NULL, NaN and infinities as 0."""
    from pyspark.ml.functions import array_to_vector

    return df.withColumn(out, array_to_vector(F.array(*[finite_or_zero(F.col(c)) for c in columns])))


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with ``<c>_mean`` and ``<c>_std`` (population; 1 for a constant column)."""
    stats = []
    for c in columns:
        spread = F.stddev_pop(c)
        stats += [F.avg(c).alias(f"{c}_mean"), F.when(spread > 0, spread).otherwise(1.0).alias(f"{c}_std")]
    return df.agg(*stats)


def apply_scaler(df: DataFrame, scaler: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Scale with the fitted row, read once as a scalar subquery."""
    row = scaler.select(F.struct("*").alias("s")).scalar()
    return (
        df.withColumn("_s", row)
        .withColumns({c: (F.col(c) - F.col(f"_s.{c}_mean")) / F.col(f"_s.{c}_std") for c in columns})
        .drop("_s")
    )


def lag_features(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], column: str, lags: Sequence[int] = (1, 5, 15)
) -> DataFrame:
    wanted = {f"{column}_lag_{k}": (column, k) for k in lags}
    return with_lags(df, keys, order, wanted, tie=order[-1] if len(order) > 1 else None)


def rate_of_change(df: DataFrame, keys: Sequence[str], order: Sequence[str], column: str) -> DataFrame:
    """Relative change against the previous row; NULL when that is missing or 0."""
    out = with_lags(df, keys, order, {"_prev": (column, 1)}, tie=order[-1] if len(order) > 1 else None)
    change = F.try_divide(F.col(column) - F.col("_prev"), F.col("_prev"))
    return out.withColumn(f"{column}_change", change).drop("_prev")


def rolling_statistics(
    df: DataFrame, ts: str, column: str, width_us: int, keys: Sequence[str] = ()
) -> DataFrame:
    """Trailing mean, sample std, min, max and sum of one column."""
    # sums are taken around the mean, or large values would swallow the spread
    center = df.agg(F.avg(F.col(column).cast("double"))).first()[0] or 0.0
    raw = F.col(column).cast("double")
    value = raw - center
    out = trailing_window(
        df, ts, width_us,
        {
            "_n": ("count", value), "_sum": ("sum", value), "_sq": ("sum", value * value),
            "_min": ("min", raw), "_max": ("max", raw),
        },
        keys,
    )
    variance = F.try_divide(
        F.col("_sq") - F.try_divide(F.col("_sum") * F.col("_sum"), F.col("_n")), F.col("_n") - 1
    )
    return out.withColumns(
        {
            f"{column}_mean": F.try_divide(F.col("_sum"), F.col("_n")) + center,
            f"{column}_std": F.sqrt(F.greatest(variance, F.lit(0.0)) + F.when(F.col("_n") > 1, 0.0)),
            f"{column}_min": F.col("_min"),
            f"{column}_max": F.col("_max"),
            f"{column}_sum": F.col("_sum") + F.col("_n") * center,
        }
    ).drop("_n", "_sum", "_sq", "_min", "_max")
