import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from emberlog.operators import features as ft
from emberlog.operators import iforest as fo
from emberlog.operators import models as md

QUICK = md.BoosterParams(max_depth=3, rounds=3)


@pytest.fixture(scope="module")
def matrix(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 5))
    frame = pd.DataFrame(x, columns=list("abcde"))
    frame["label"] = (frame["a"] + 0.2 * rng.normal(size=400) > 0.8).astype(int)
    frame["id"] = range(400)
    df = ft.clean_vector(spark.createDataFrame(frame), list("abcde")).select("id", "label", "features").cache()
    df.count()
    return df


def test_booster_fit_predict_reload(spark, matrix, tmp_path):
    model = md.fit_booster(matrix, QUICK)
    scored = md.predict(model, matrix).orderBy("id").toPandas()
    assert scored["score"].between(0, 1).all() and set(scored["prediction"]) <= {0, 1}
    assert (scored["prediction"] == scored["label"]).mean() > 0.8
    md.save_model(model, str(tmp_path / "m"))
    again = md.predict(md.load_model(str(tmp_path / "m")), matrix).orderBy("id").toPandas()
    assert (again["score"] == scored["score"]).all()
    importance = md.feature_importance(spark, model, list("abcde")).toPandas()
    assert importance["importance"].sum() == pytest.approx(1) and (importance["importance"] >= 0).all()
    assert md.top_features(md.feature_importance(spark, model, list("abcde")), 1).first().feature == "a"


def test_class_weights(matrix):
    weighted = md.class_weights(matrix).groupBy("label").agg(F.max("weight").alias("w")).collect()
    assert {r.label: r.w for r in weighted} == {0: 5.0, 1: 95.0}


def test_isolation_forest(spark, tmp_path):
    rng = np.random.default_rng(0)
    normal = rng.normal(0, 1, (950, 2))
    odd = rng.normal(0, 1, (50, 2)) * 0.3 + 8
    rows = [(i, [float(a), float(b)], int(i >= 950)) for i, (a, b) in enumerate(np.vstack([normal, odd]))]
    df = spark.createDataFrame(rows, "id int, x array<double>, odd int")
    forest = fo.fit_isolation_forest(df, "id", "x", trees=40)
    got = fo.predict_isolation(forest, df, "x").orderBy("id").toPandas()
    assert 0.05 <= got["prediction"].mean() <= 0.15
    assert got["score_samples"].between(-1, 0).all()
    assert got.loc[got["odd"] == 1, "prediction"].mean() > 0.9
    again = fo.fit_isolation_forest(df, "id", "x", trees=40)
    pd.testing.assert_frame_equal(forest.nodes, again.nodes)
    forest.save(spark, str(tmp_path / "f"))
    loaded = fo.predict_isolation(fo.IsolationForest.load(spark, str(tmp_path / "f")), df, "x").orderBy("id").toPandas()
    assert (loaded["score_samples"] == got["score_samples"]).all()


def test_constant_rows_score_alike(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(10)], "id int, x array<double>")
    forest = fo.fit_isolation_forest(df, "id", "x", trees=5)
    assert fo.score_samples(forest, df, "x").select("score_samples").distinct().count() == 1


def test_average_path():
    assert fo.average_path(1) == 0 and fo.average_path(2) == 1
    assert fo.average_path(256) == pytest.approx(10.244770920)
