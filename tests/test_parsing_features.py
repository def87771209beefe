from datetime import datetime

import pytest
from pyspark.sql import functions as F

from emberlog.functions.binning import bucketize, finite_or_zero
from emberlog.functions.parsing import level_from_text, matches_filter, parse_text_timestamp, service_from_stream, word_count
from emberlog.operators import features as ft
from emberlog.operators.labels import label_anomalies
from emberlog.operators.parse import parse_logs, parse_timestamps


def one(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", expr(F.col("v")).alias("x")).orderBy("i").collect()]


def test_levels_and_order(spark):
    texts = ["Connection Timeout, will retry", "retry later", "some information", "debug mode", "", None, "WARNING", "info debug"]
    assert one(spark, texts, level_from_text) == ["ERROR", "WARN", "INFO", "DEBUG", "INFO", "INFO", "WARN", "INFO"]


def test_services(spark):
    streams = ["/aws/lambda/f", "/ecs/svc", "x", "", None, "a/b"]
    assert one(spark, streams, service_from_stream) == ["lambda", "svc", "unknown", "unknown", "unknown", "unknown"]


def test_text_timestamps(spark):
    values = ["2024-01-02 03:04:05", "2024-01-02T03:04:05", "2024-01-02T03:04:05.5", "2024-01-02T03:04:05Z",
              "2024-01-02T03:04:05.123456Z", "2024-01-02 03:04:05.000001", "yesterday", None]
    base = datetime(2024, 1, 2, 3, 4, 5)
    assert one(spark, values, parse_text_timestamp) == [
        base, base, base.replace(microsecond=500000), base, base.replace(microsecond=123456),
        base.replace(microsecond=1), None, None,
    ]


def test_epoch_and_quarantine(spark):
    df = spark.createDataFrame([(1_700_000_000,), (1_700_000_000_123,)], "timestamp bigint")
    got = [r.timestamp for r in parse_timestamps(df).orderBy("timestamp").collect()]
    assert got[1].microsecond == 123000 and got[0].replace(microsecond=0) == got[1].replace(microsecond=0)
    bad = parse_timestamps(spark.createDataFrame([("nope",), (None,)], "timestamp string"))
    assert sorted(r.timestamp_bad for r in bad.collect()) == [False, True]


def test_parse_entries(spark):
    rows = [
        (1, '{"level":"ERROR","requestId":"r1","duration":12.5,"memoryUsed":"77","errorType":"T"}'),
        (2, '{"requestId":"r2"}'), (3, '{"level":null,"a":1}'), (4, "{}"), (5, "5"), (6, "[1]"), (7, "null"),
        (8, "request failed"), (9, ""), (10, None), (11, '{"a":1} trailing error'), (12, '{"duration":"slow","b":{"c":1}}'),
    ]
    df = spark.createDataFrame(rows, "i int, message string").withColumn("log_stream", F.lit("/aws/rds/x"))
    got = {r.i: r for r in parse_logs(df).collect()}
    assert (got[1].log_level, got[1].duration, got[1].memory_used, got[1].error_type) == ("ERROR", 12.5, 77.0, "T")
    assert got[2].log_level == "INFO" and got[2].raw_json is not None
    assert got[3].log_level is None
    for i in (4, 5, 6, 7, 9, 10):
        assert got[i].raw_json is None and got[i].log_level == "INFO"
    assert got[8].log_level == "ERROR" and got[11].log_level == "ERROR"
    assert got[11].raw_json is None and got[12].duration is None
    assert {r.service_name for r in got.values()} == {"rds"}


def test_no_message_column_is_left_alone(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert parse_logs(df).columns == ["a"]


def test_keep_existing(spark):
    df = spark.createDataFrame([("plain", "WARN")], "message string, log_level string")
    assert parse_logs(df, keep_existing=True).first().log_level == "WARN"
    assert parse_logs(df).first().log_level == "INFO"


def test_word_count(spark):
    assert one(spark, ["a  b\tc", "", "  ", " x ", None], word_count) == [3, 0, 0, 1, None]


def test_filter_pattern(spark):
    texts = ["disk error on node", "error timeout", "all fine", "disk space low", None]
    df = spark.createDataFrame([(t,) for t in texts], "m string")
    def hits(p):
        return [r.m for r in df.where(matches_filter(F.col("m"), p)).collect()]
    assert hits("disk error") == ["disk error on node"]
    assert hits("?timeout ?fine") == ["error timeout", "all fine"]
    assert hits("disk -low") == ["disk error on node"]
    assert hits('"space low"') == ["disk space low"]


def test_bins(spark):
    hours = [0, 6, 7, 12, 13, 18, 19, 23]
    cut = lambda c: bucketize(c, [0, 6, 12, 18, 24], ["n", "m", "a", "e"])
    assert one(spark, hours, cut, "int") == ["n", "n", "m", "m", "a", "a", "e", "e"]
    left = lambda c: bucketize(c, [0, 1, 2], ["x", "y"], right=False)
    assert one(spark, [0.0, 1.0, 2.0, 3.0], left, "double") == ["x", "y", "y", None]


def test_finite(spark):
    assert one(spark, [1.5, float("nan"), float("inf"), None], finite_or_zero, "double") == [1.5, 0.0, 0.0, 0.0]


def test_business_hours(spark):
    df = spark.createDataFrame([("2024-01-05 08:59:00",), ("2024-01-05 09:00:00",), ("2024-01-05 17:00:00",), ("2024-01-06 10:00:00",)], "t string")
    got = ft.time_features(df.select(F.col("t").cast("timestamp").alias("timestamp"))).orderBy("timestamp").collect()
    assert [r.is_business_hours for r in got] == [0, 1, 0, 0]
    assert [r.is_weekend for r in got] == [0, 0, 0, 1]


@pytest.mark.parametrize("limit", [1, 100])
def test_codes_small_and_large_dictionary(spark, limit):
    df = spark.createDataFrame([("b",), ("aaaaaaaaaa",), ("aaaaaaaaab",), (None,), ("é",), ("b",)], "v string")
    got = {(r.v, r.c) for r in ft.encode_ordinal(df, "v", "c", limit=limit).collect()}
    assert got == {("aaaaaaaaaa", 0), ("aaaaaaaaab", 1), ("b", 2), ("é", 3), (None, -1)}


def test_top_services_ties_by_name(spark):
    df = spark.createDataFrame([(f"s{i:02d}",) for i in range(12)] + [("s11",)], "service_name string")
    assert ft.vocabulary(df, "service_name", 10) == ["s11"] + [f"s{i:02d}" for i in range(9)]


def test_scaler_keeps_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "a double, b double")
    got = ft.apply_scaler(df, ft.fit_scaler(df, ["a", "b"]), ["a", "b"]).orderBy("a").collect()
    assert [(r.a, r.b) for r in got] == [(-1.0, 0.0), (1.0, 0.0)]


def test_labels_without_any_error(spark):
    rows = [("INFO", 0, 0.0, 0, 1.0 * i, 100.0) for i in range(100)]
    df = spark.createDataFrame(rows, "log_level string, has_error int, error_rate double, is_slow int, memory_used_mb double, duration double")
    got = label_anomalies(df)
    assert got.where("is_anomaly = 1").count() == 5


def test_numeric_features(spark):
    df = spark.createDataFrame([(1, "a", True, 2.0)], "n int, message string, b boolean, d double")
    assert ft.numeric_features(df) == ["n", "d"]


def test_strict_json_objects(spark):
    from emberlog.functions.parsing import json_fields

    cases = {
        '{"level":"INFO"}': "INFO", "{'level': 'DEBUG'}": None, '{"level":"A"} {"b":2}': None, '{"level":"A"},{"b":2}': None,
        '{"level":"A"} x}': None, '{"level":"A","level":"B"}': "B", '{"level":"A","k":1,"level":null}': None, "5": None, "[1]": None,
        ' {"k":[1,{"a":"}"}],"level":"C"} ': "C", "{level:1}": None,
    }
    rows = spark.createDataFrame([(k,) for k in cases], "m string")
    found = {r.m: r.v for r in rows.select("m", F.try_element_at(json_fields(F.col("m")), F.lit("level")).alias("v")).collect()}
    assert found == cases


def test_numbers_have_no_type_suffix(spark):
    from emberlog.functions.parsing import to_number

    cases = {"1": 1.0, " 2.5 ": 2.5, "1e3": 1000.0, "-.5": -0.5, "1d": None, "1f": None, "12.5D": None, "x": None, "": None, "NaN": None}
    rows = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: r.v for r in rows.select("t", to_number(F.col("t")).alias("v")).collect()} == cases


def test_ordinal_codes_do_not_depend_on_the_size_limit(spark):
    from emberlog.operators.features import encode_ordinal

    rows = spark.createDataFrame([(2,), (10,), (100,), (None,)], "v int")
    small, large = ({r.v: r.c for r in encode_ordinal(rows, "v", "c", limit=n).collect()} for n in (1000, 1))
    assert small == large == {10: 0, 100: 1, 2: 2, None: -1}


def test_rolling_std_of_large_values(spark):
    import statistics
    from datetime import datetime, timedelta

    from emberlog.operators.features import rolling_statistics

    values = [1e9 + 0.7 * (i % 5) for i in range(40)]
    start = datetime(2024, 1, 1)
    rows = spark.createDataFrame([(start + timedelta(seconds=i), v) for i, v in enumerate(values)], "t timestamp, v double")
    last = rolling_statistics(rows, "t", "v", 10_000_000).orderBy(F.desc("t")).first()
    assert abs(last.v_std - statistics.stdev(values[-10:])) < 1e-6
