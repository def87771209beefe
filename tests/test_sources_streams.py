from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from emberlog.sources import logs as src
from emberlog.sources import reports as rep
from emberlog.streaming import logs as sl
from emberlog.streaming import stateful as ss

START = datetime(2024, 3, 1, 22, 30)


@pytest.fixture(scope="module")
def events(spark):
    rows = [(START + timedelta(minutes=7 * i), f"line {i}\nwith \"quotes\", comma", f"/aws/s{i % 3}/x") for i in range(40)]
    return spark.createDataFrame(rows, "timestamp timestamp, message string, log_stream string")


def test_csv_round_trip(spark, events, tmp_path):
    path = str(tmp_path / "x.csv")
    src.write_csv(events, path)
    back = src.load_logs(spark, path, schema=events.schema)
    assert back.exceptAll(events).count() == 0 and back.count() == 40


def test_hourly_layout_prunes(spark, events, tmp_path):
    path = str(tmp_path / "raw")
    src.write_hourly(events, path)
    got = src.read_hourly(spark, path, START + timedelta(minutes=60), START + timedelta(minutes=120))
    assert got.count() == events.where(F.col("timestamp").between(START + timedelta(minutes=60), START + timedelta(minutes=120))).count()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_scan_and_export(spark, events, tmp_path):
    got = src.scan_events(events, START, START + timedelta(hours=1), "line", limit=3).collect()
    assert [r.timestamp for r in got] == [START + timedelta(minutes=7 * i) for i in range(3)]
    target = src.export_logs(events, str(tmp_path), "task", START, START + timedelta(hours=1))
    assert target.endswith("/task") and spark.read.parquet(target).count() == 9
    assert src.list_streams(events, 2).count() == 2


def test_keep_recent(events):
    assert src.keep_recent(events.withColumn("timestamp", F.col("timestamp")), 1).count() == 40


def test_tracking_tables(spark, tmp_path):
    run = tmp_path / "1" / "abc"
    (run / "metrics").mkdir(parents=True)
    (run / "params").mkdir()
    (run / "metrics" / "f1").write_text("1700000000000 0.5 0\n1700000001000 0.75 1\n")
    (run / "params" / "depth").write_text("6")
    metrics = rep.read_run_metrics(spark, str(tmp_path)).orderBy("step").collect()
    assert [(m.experiment_id, m.run_id, m.key, m.value, m.step) for m in metrics] == [("1", "abc", "f1", 0.5, 0), ("1", "abc", "f1", 0.75, 1)]
    assert rep.read_run_params(spark, str(tmp_path)).first().value == "6"
    trials = tmp_path / "trials.csv"
    trials.write_text("number,value,params_depth,params_eta,state\n0,0.9,3,,COMPLETE\n")
    row = rep.read_trials(spark, str(trials)).first()
    assert (row.number, row.value, row.params) == (0, 0.9, {"depth": "3"})
    rep.write_report({"a": spark.range(2)}, str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report" / "a")).count() == 2


def test_tail_continues_from_checkpoint(spark, events, tmp_path):
    folder, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    first = events.withColumn("ingestion_time", F.col("timestamp")).select([f.name for f in src.EVENT_SCHEMA])
    first.write.parquet(folder)
    for extra in (0, 5):
        if extra:
            first.limit(extra).write.mode("append").parquet(folder)
        sl.tail_to(src.tail_source(spark, folder, pattern="line"), out, check, follow=False).awaitTermination()
    assert spark.read.parquet(out).count() == 45


def stream_of(spark, df, tmp_path, name):
    """Three files, so three micro-batches, in time order."""
    folder = tmp_path / name
    rows = df.count()
    numbered = df.orderBy("ts" if "ts" in df.columns else "timestamp").toPandas()
    for i in range(3):
        part = numbered.iloc[i * rows // 3 : (i + 1) * rows // 3]
        spark.createDataFrame(part, df.schema).coalesce(1).write.parquet(str(folder / f"part={i}"))
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(folder / "part=*"))


def test_holding_across_batches(spark, tmp_path):
    states = [1, 1, 0, 1, 1, 1, 1, 1, 0]
    rows = [("s", START + timedelta(minutes=i), bool(x), 180) for i, x in enumerate(states)]
    df = spark.createDataFrame(rows, "series string, ts timestamp, active boolean, for_seconds int")
    got = sl.run_once(ss.held_alert_notices(stream_of(spark, df, tmp_path, "h"))).collect()
    first = int((START - datetime(1970, 1, 1)).total_seconds())
    assert [(r.started_us // 1_000_000 - first, r.notified_us // 1_000_000 - first) for r in got] == [(180, 360)]


def test_sticky_across_batches(spark, tmp_path):
    rows = [("u", i, START + timedelta(days=i), f"v{i}") for i in range(15)]
    df = spark.createDataFrame(rows, "user_id string, row_id int, timestamp timestamp, offered string")
    got = sl.run_once(ss.sticky_assignments(stream_of(spark, df, tmp_path, "s"))).orderBy("row_id").collect()
    assert [r.variant_id for r in got] == ["v0"] * 7 + ["v7"] * 7 + ["v14"]


def test_stream_scoring_equals_batch(spark, tmp_path):
    from emberlog.operators import features as ft
    from emberlog.operators import models as md

    df = spark.range(200).select("id", (F.col("id") % 5 == 0).cast("int").alias("label"), (F.col("id") % 5).cast("double").alias("x"))
    model = md.fit_booster(ft.clean_vector(df, ["x"]), md.BoosterParams(max_depth=2, rounds=2))
    df.write.parquet(str(tmp_path / "d"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "d"))
    streamed = sl.run_once(sl.score_stream(ft.clean_vector(stream, ["x"]), model, ["id"]))
    batch = md.predict(model, ft.clean_vector(df, ["x"]), keep=["id"])
    assert streamed.exceptAll(batch).count() == 0 and streamed.count() == 200
