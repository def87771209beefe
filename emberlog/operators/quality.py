"""Data quality checks.

Single-pass aggregates wherever the check allows; every check reports rows of
``(check_name, column_name, passed, metric, detail)``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.functions.parsing import to_number
from emberlog.operators.ordered import _join_on, exact_percentiles, time_gaps, with_lags
from emberlog.operators.stats import metrics_long
from emberlog.session import stored

LOG_LEVELS = ("DEBUG", "INFO", "WARN", "ERROR", "FATAL")
CRITICAL_COLUMNS = ("timestamp", "log_level")


def _rows(one: DataFrame, entries: Sequence[tuple[str, str]], names: Sequence[str]) -> DataFrame:
    """Turn the columns of a one-row frame into ``names`` rows."""
    return one.select(
        F.explode(F.array(*[F.struct(F.lit(label).alias(names[0]), F.col(c).alias(names[1])) for label, c in entries])).alias("r")
    ).select("r.*")


def missing_percent(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, missing_percent)`` for all columns in one pass."""
    columns = list(columns or df.columns)
    one = df.agg(*[(100.0 * F.avg(F.col(c).isNull().cast("int"))).alias(f"m{i}") for i, c in enumerate(columns)])
    return _rows(one, [(c, f"m{i}") for i, c in enumerate(columns)], ("column_name", "missing_percent"))


def out_of_range(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """``(column_name, out_of_range)``; null and unreadable values are not counted."""
    present = {c: r for c, r in ranges.items() if c in df.columns}
    counts = []
    for i, (c, (low, high)) in enumerate(present.items()):
        number = to_number(F.col(c))
        counts.append(F.count_if((number < low) | (number > high)).alias(f"c{i}"))
    return _rows(df.agg(*counts), [(c, f"c{i}") for i, c in enumerate(present)], ("column_name", "out_of_range"))


def duplicate_count(df: DataFrame, subset: Sequence[str] | None = None, digest: bool = False) -> DataFrame:
    """Rows beyond the first of each equal group; nulls are equal.

    ``digest`` groups by a 256-bit hash of the columns instead, so that long texts are
    not shuffled.
    """
    columns = list(subset or df.columns)
    if digest:
        packed = F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
        groups = df.groupBy(packed.alias("_h"))
    else:
        groups = df.groupBy(*columns)
    return groups.agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates")
    )


def unexpected_values(df: DataFrame, valid: Mapping[str, Sequence[str]]) -> DataFrame:
    """``(column_name, value, n)`` of non-null values outside the valid lists."""
    present = [c for c in valid if c in df.columns]
    parts = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in present])
    bad = reduce(
        lambda a, b: a | b,
        [(F.col("column_name") == c) & ~F.col("value").isin(*valid[c]) for c in present],
    )
    return (
        df.select(F.explode(parts).alias("x")).select("x.*")
        .where(F.col("value").isNotNull() & bad)
        .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    )


def type_mismatches(df: DataFrame, expected: Mapping[str, str]) -> list[str]:
    """Columns that are absent or whose type name does not contain the expected text."""
    types = dict(df.dtypes)
    return [c for c, want in expected.items() if c not in types or want not in types[c]]


def missing_values_difference(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Distinct values of ``left`` that do not occur in ``right``."""
    return left.select(column).where(F.col(column).isNotNull()).distinct().join(
        right.select(column).distinct(), column, "left_anti"
    )


def out_of_order_count(df: DataFrame, sequence: str, ts: str) -> DataFrame:
    """Rows whose timestamp lies before that of the preceding row by ``sequence``."""
    checked = with_lags(df.select(sequence, ts), [], [sequence], {"_prev": (ts, 1)})
    return checked.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(ts) < F.col("_prev")).alias("out_of_order"))


def outlier_percent(df: DataFrame, columns: Sequence[str], reach: float = 1.5) -> DataFrame:
    """Share outside ``[q1 - reach*iqr, q3 + reach*iqr]`` and missing share per column."""
    long = metrics_long(df, [], columns, "column_name")
    fences = exact_percentiles(long, ["column_name"], "value", {"q1": 0.25, "q3": 0.75})
    iqr = F.col("q3") - F.col("q1")
    outside = (F.col("value") < F.col("q1") - reach * iqr) | (F.col("value") > F.col("q3") + reach * iqr)
    joined = _join_on(long, stored(fences), ["column_name"], "left")
    return joined.groupBy("column_name").agg(
        (100.0 * F.avg(F.col("value").isNull().cast("int"))).alias("missing_percent"),
        (100.0 * F.try_divide(F.count_if(outside), F.count("value"))).alias("outlier_percent"),
    )


def _report(df: DataFrame, check: str, column, passed, metric, detail) -> DataFrame:
    return df.select(
        F.lit(check).alias("check_name"), column.alias("column_name"), passed.alias("passed"),
        metric.cast("double").alias("metric"), detail.cast("string").alias("detail"),
    )


def validate_all(
    df: DataFrame,
    critical: Sequence[str] | None = None,
    types: Mapping[str, str] | None = None,
    ranges: Mapping[str, tuple[float, float]] | None = None,
    categories: Mapping[str, Sequence[str]] | None = None,
    ts: str = "timestamp",
    max_gap_minutes: int = 60,
    digest_duplicates: bool = True,
) -> DataFrame:
    """All checks as one long table; the row ``overall`` carries the verdict.

    Missing values, types, ranges and categories decide the verdict; duplicates and time
    gaps are reported only.
    """
    spark = df.sparkSession
    critical = set(critical or ())
    none = F.lit(None)
    is_critical = F.col("column_name").isin(*critical) if critical else F.lit(False)
    missing = missing_percent(df)
    parts = [
        _report(missing, "missing_values", F.col("column_name"),
                ~(is_critical & (F.col("missing_percent") > 0)), F.col("missing_percent"), none)
    ]
    if types:
        wrong = set(type_mismatches(df, types))
        rows = [("data_types", c, c not in wrong, None, dict(df.dtypes).get(c)) for c in types]
        parts.append(spark.createDataFrame(
            rows, "check_name string, column_name string, passed boolean, metric double, detail string"))
    if ranges:
        parts.append(_report(out_of_range(df, ranges), "value_ranges", F.col("column_name"),
                             F.col("out_of_range") == 0, F.col("out_of_range"), none))
    if categories:
        parts.append(_report(unexpected_values(df, categories), "categorical_values", F.col("column_name"),
                             F.lit(False), F.col("n"), F.col("value")))
    deciding = reduce(lambda a, b: a.unionByName(b), parts)
    overall = deciding.agg(F.coalesce(F.every("passed"), F.lit(True)).alias("ok"))
    out = [
        deciding,
        _report(overall, "overall", none.cast("string"), F.col("ok"), none, none),
        _report(duplicate_count(df, digest=digest_duplicates), "duplicates", none.cast("string"),
                F.col("duplicates") == 0, F.col("duplicates"), none),
    ]
    if ts in df.columns:
        gaps = time_gaps(df, ts, max_gap_minutes * 60_000_000)
        out.append(_report(gaps, "timestamp_continuity", F.lit(ts), F.lit(False),
                           F.col("gap_minutes"), F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")))
    return reduce(lambda a, b: a.unionByName(b), out)


def validate_logs(df: DataFrame) -> DataFrame:
    """The pipeline's own call: critical time and level, known levels. Never raises."""
    return validate_all(df, critical=CRITICAL_COLUMNS, categories={"log_level": LOG_LEVELS})
