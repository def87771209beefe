"""Boosters against plain trees, the sampler and the pruner against plain versions."""

import json
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from emberlog.operators import boosting as bo
from emberlog.operators import features as ft
from emberlog.operators import tuning as tu


def plain_tree(x, g, h, p, depth=0):
    """Leaf values of a tree by trying every split of every node."""
    value = -g.sum() / (h.sum() + p.reg_lambda) * p.eta
    best, where = 1e-6, None
    if depth < p.max_depth:
        score = lambda m: g[m].sum() ** 2 / (h[m].sum() + p.reg_lambda)
        everything = np.ones(len(g), bool)
        for f in range(x.shape[1]):
            for c in range(bo.MAX_BINS - 1):
                low = x[:, f] <= c
                if min(h[low].sum(), h[~low].sum()) < p.min_child_weight:
                    continue
                won = score(low) + score(~low) - score(everything)
                if won > max(best, p.gamma) + 1e-9:
                    best, where = won, low
    if where is None:
        return np.full(len(g), value)
    out = np.empty(len(g))
    for side in (where, ~where):
        out[side] = plain_tree(x[side], g[side], h[side], p, depth + 1)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_one_tree_equals_brute_force(seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 12, (300, 4)).astype(np.uint8)
    g, h = rng.normal(size=300), rng.uniform(0.05, 0.25, 300)
    p = bo.TreeParams(max_depth=3, eta=0.3, min_child_weight=2.0, gamma=0.1)
    tree = bo.grow_tree(x, g, h, np.arange(4), p)
    assert np.allclose(tree.value[tree.leaves(x)], plain_tree(x, g, h, p))


def test_measures():
    y, s = np.array([0, 0, 1, 1, 1]), np.array([0.1, 0.4, 0.4, 0.8, 0.3])
    pairs = [(a > b) + 0.5 * (a == b) for a in s[y == 1] for b in s[y == 0]]
    assert bo.auc(y, s) == pytest.approx(np.mean(pairs))
    assert bo.f1_score(y, (s > 0.35).astype(int)) == pytest.approx(2 * 2 / (3 + 3))
    assert math.isnan(bo.auc(np.ones(3), s[:3]))


def test_early_stop_keeps_the_best_round():
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 9, (400, 3)).astype(np.uint8), (rng.random(400) > 0.5).astype(float)
    held = np.arange(400) % 2 == 0
    model = bo.fit_trees(x, y, np.ones(400), bo.TreeParams(rounds=60, patience=5, eta=0.5), held)
    losses = [bo.log_loss(y[held], bo.margins(model[:k], x)[held], np.ones(held.sum())) for k in range(1, len(model) + 1)]
    assert len(model) < 60 and losses[-1] == min(losses)


def test_dart_margins_are_those_of_its_weighted_trees():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 9, (300, 3)).astype(np.uint8)
    y = (x[:, 0] > 4).astype(float)
    for kind in ("tree", "forest"):
        p = bo.TreeParams(booster="dart", rounds=20, rate_drop=0.3, normalize_type=kind, sample_type="weighted")
        model = bo.fit_trees(x, y, np.ones(300), p)
        assert len(model) == 20 and any(w < 1 for w, _ in model)
        assert ((bo.margins(model, x) > 0) == (y == 1)).mean() > 0.95


@pytest.fixture(scope="module")
def matrix(spark):
    rng = np.random.default_rng(3)
    frame = pd.DataFrame(rng.normal(size=(600, 4)), columns=list("abcd"))
    frame["label"] = (frame["a"] + 0.2 * rng.normal(size=600) > 0.6).astype(int)
    frame["id"] = range(600)
    return ft.clean_vector(spark.createDataFrame(frame), list("abcd")).select("id", "label", "features").cache()


def test_models_in_one_job(spark, matrix):
    binned = bo.bin_rows(matrix, max_rows=10_000)
    assert binned.x.shape == (600, 4) and all(len(c) <= bo.MAX_BINS - 1 for c in binned.cuts)
    quick = bo.TreeParams(rounds=20, max_depth=3)
    a, b = bo.fit_models(spark, binned, [(quick, None), (bo.TreeParams(rounds=1, max_depth=1), None)])
    scored = a.predict(matrix, "a").toPandas()
    assert set(scored.columns) == {"id", "label", "model", "prediction", "score"} and len(scored) == 600
    assert (scored["prediction"] == scored["label"]).mean() > 0.9 and scored["score"].between(0, 1).all()
    assert a.importance().argmax() == 0 and a.importance().sum() == pytest.approx(1)
    assert len(b.trees) == 1
    again = bo.fit_models(spark, bo.bin_rows(matrix.repartition(7), max_rows=10_000), [(quick, None)])[0]
    assert again.predict(matrix).orderBy("id").toPandas()["score"].tolist() == a.predict(matrix).orderBy("id").toPandas()["score"].tolist()
    assert len(bo.bin_rows(matrix, max_rows=50).y) == 50


def test_rows_without_features_or_labels(spark):
    df = spark.createDataFrame([(1, None, None), (2, 1, None)], "id int, label int, x double")
    binned = bo.bin_rows(ft.clean_vector(df, ["x"]))
    assert len(binned.y) == 1
    model = bo.fit_models(spark, binned, [(bo.TreeParams(rounds=2), None)])[0]
    assert model.predict(ft.clean_vector(df, ["x"]), keep=["id"]).count() == 2


def test_densities_against_plain_formulas():
    span = tu.Span(1e-3, 1.0, log=True)
    seen = [0.01, 0.2, 0.5]
    parzen = tu.Parzen(span, seen)
    cdf = lambda x, m, s: 0.5 * (1 + math.erf((x - m) / s / math.sqrt(2)))
    for x in np.linspace(*span.bounds, 7):
        parts = []
        for part in parzen.parts:
            m, s = part.mean, part.stdev
            inside = cdf(parzen.high, m, s) - cdf(parzen.low, m, s)
            parts.append(math.exp(-((x - m) ** 2) / 2 / s**2) / s / math.sqrt(2 * math.pi) / inside)
        assert parzen.log_density(x) == pytest.approx(math.log(np.mean(parts)))
    grid = np.linspace(*span.bounds, 4001)
    assert np.trapezoid([math.exp(parzen.log_density(x)) for x in grid], grid) == pytest.approx(1, abs=1e-3)
    rng = np.random.default_rng(0)
    assert all(parzen.low <= parzen.draw(rng) <= parzen.high for _ in range(200))
    assert tu.choice_shares(("a", "b"), ["a", "a", "b"]) == pytest.approx([2.5 / 4, 1.5 / 4])


def test_sampler_learns_and_is_seeded():
    space = {"eta": tu.Span(0.01, 1.0, log=True), "max_depth": tu.Span(3, 12, step=1)}
    value = lambda p: -((math.log(p["eta"]) - math.log(0.2)) ** 2) - 0.1 * (p["max_depth"] - 7) ** 2

    def run(seed, startup):
        rng, done = np.random.default_rng(seed), []
        for i in range(40):
            params = tu.propose(done, rng, startup, space=space)
            done.append(tu.Trial(i, params, [value(params)], state="COMPLETE"))
        return done

    assert [t.params for t in run(1, 10)] == [t.params for t in run(1, 10)]
    learned = np.mean([np.mean([t.mean() for t in run(s, 10)[20:]]) for s in range(5)])
    random = np.mean([np.mean([t.mean() for t in run(s, 1000)[20:]]) for s in range(5)])
    assert learned > random + 0.5
    assert all(3 <= t.params["max_depth"] <= 12 and t.params["max_depth"] == int(t.params["max_depth"]) for t in run(2, 10))
    dart = [tu.propose([], np.random.default_rng(s)) for s in range(20)]
    assert all(("rate_drop" in p) == (p["booster"] == "dart") for p in dart)


def test_pruner_against_the_plain_median():
    rng = np.random.default_rng(5)
    for _ in range(50):
        earlier = [tu.Trial(i, {}, rng.random(rng.integers(1, 4)).tolist()) for i in range(8)]
        trial = tu.Trial(99, {}, rng.random(rng.integers(1, 4)).tolist())
        step = len(trial.scores)
        means = sorted(sum(t.scores[:step]) / step for t in earlier if len(t.scores) >= step)
        n = len(means)
        middle = (means[(n - 1) // 2] + means[n // 2]) / 2 if n else 0
        assert tu.should_stop(trial, earlier) == (n >= 5 and sum(trial.scores) / step < middle)


def test_search_to_experiment(spark, matrix, tmp_path, monkeypatch):
    quick = lambda params, seed=42: bo.TreeParams(rounds=4, max_depth=int(params["max_depth"]) % 3 + 1, eta=params["eta"], seed=seed)
    monkeypatch.setattr(tu, "tree_params", quick)
    trials, binned = tu.search(matrix, n_trials=9, folds=2, batch=3, startup=6)
    assert [t.number for t in trials] == list(range(9)) and all(t.state in ("COMPLETE", "PRUNED") for t in trials)
    assert all(len(t.scores) == 2 for t in trials if t.state == "COMPLETE")
    variants = tu.best_variants(tu.trials_table(spark, trials)).orderBy("variant_id").collect()
    assert [v.variant_id for v in variants] == [f"xgb_optimized_v{i}" for i in (1, 2, 3)]
    whole = sorted((t.mean() for t in trials if t.state == "COMPLETE"), reverse=True)
    assert [v.score for v in variants] == pytest.approx(whole[:3]) and sum(v.weight for v in variants) == pytest.approx(1)
    table = tu.best_variants(tu.trials_table(spark, trials))
    models = tu.fit_variants(spark, table, binned)
    assert set(models) == {v.variant_id for v in variants}
    place = tu.write_experiment_config(table, str(tmp_path))
    config = json.loads(spark.read.text(place).first().value)
    assert config["type"] == "hyperparameter" and [v["id"] for v in config["variants"]] == [v.variant_id for v in variants]
    assert models["xgb_optimized_v1"].predict(matrix.where(F.col("id") < 5)).count() == 5


def test_leaves_equal_a_walk_of_each_row():
    rng = np.random.default_rng(6)
    x = rng.integers(0, 32, (500, 5)).astype(np.uint8)
    g, h = rng.normal(size=500), rng.uniform(0.05, 0.25, 500)
    for depth in (0, 1, 5, 9):
        tree = bo.grow_tree(x, g, h, np.arange(5), bo.TreeParams(max_depth=depth, min_child_weight=0.1))
        want = []
        for row in x:
            at = 0
            while tree.left[at]:
                at = tree.left[at] + int(row[tree.feature[at]] > tree.cut[at])
            want.append(at)
        assert tree.leaves(x).tolist() == want and tree.leaves(x[:0]).tolist() == []
        assert tree.leaves(np.asfortranarray(x)).tolist() == want


def test_training_rows_and_scores_are_computed_once(spark, sf_dir, monkeypatch):
    from emberlog.plans import model_queries as mq

    written, scored = [], []
    monkeypatch.setattr(mq, "stored", lambda df: written.append(df.columns) or df.cache())
    monkeypatch.setattr(mq, "evaluate_models", lambda df: scored.append(df) or df)
    monkeypatch.setattr(bo, "TREES_A", bo.TreeParams(rounds=2))
    monkeypatch.setattr(bo, "TREES_B", bo.TreeParams(rounds=2))
    assert mq.booster_comparison(spark, sf_dir).count() > 0
    # before the split, after it, and the scores, which the evaluation reads twice
    assert written[0] == ["id", "label", "features"] and "split" in written[1] and "score" in written[2] and len(scored) == 1


def _numbered(spark, n):
    return ft.clean_vector(spark.range(n).selectExpr("id", "cast(id % 3 = 0 as int) as label", "cast(id as double) as x"), ["x"])


def test_every_row_reaches_every_model(spark):
    binned = bo.bin_rows(_numbered(spark, 60_000), group=F.col("id") % 5)
    assert binned.n == 60_000

    def work(rows, task):
        return len(rows.y), float((rows.x[:, 0] * (np.arange(len(rows.y)) % 97)).sum() + rows.group.sum() + rows.y.sum()) * task

    got = bo.run_tasks(spark, binned, work, [1, 2, 3], "task long, n long, sum double")
    want = work(binned.arrays, 1)
    assert [tuple(r) for r in got] == [(i, 60_000, want[1] * (i + 1)) for i in range(3)]
    assert bo.run_tasks(spark, bo.bin_rows(_numbered(spark, 0)), lambda rows, task: (len(rows.y),), [0, 1], "task long, n long")[1].n == 0


def test_parts_and_files_change_nothing(monkeypatch):
    rng = np.random.default_rng(8)
    x = rng.integers(0, 32, (700, 5)).astype(np.uint8)
    y = (x[:, 0] + rng.integers(0, 9, 700) > 20).astype(float)
    p = bo.TreeParams(booster="dart", rounds=12, rate_drop=0.4)
    whole = bo.fit_trees(x, y, np.ones(700), p)
    for name, value in (("PART", 64), ("PART_BINS", 128), ("HELD", 0), ("SLICE", 50)):
        monkeypatch.setattr(bo, name, value)
    parts = bo.fit_trees(np.asfortranarray(x), y, np.ones(700), p)
    assert np.allclose(bo.margins(whole, x), bo.margins(parts, x)) and len(parts) == 12


def test_queries_set_no_limit_of_rows(spark, sf_dir, monkeypatch):
    from emberlog.plans import model_queries as mq

    monkeypatch.setattr(mq, "training_table", lambda *_: (spark.createDataFrame([(1, 0, "val"), (2, 1, "train")], "id int, label int, split string"), ["x"]))
    asked = []

    def stop(*_, **options):
        asked.append(options)
        raise StopIteration

    monkeypatch.setattr(bo, "bin_rows", stop)
    for query in (mq.booster_comparison, mq.feature_importance):
        with pytest.raises(StopIteration):
            query(spark, sf_dir)
    assert len(asked) == 2 and all(o.get("max_rows") is None for o in asked)


def test_search_takes_all_rows(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(tu, "judge_folds", lambda _, binned, tasks: seen.append(binned.n) or [(0.5, 0.5)] * len(tasks))
    trials, binned = tu.search(_numbered(spark, 21_000), n_trials=2, folds=2, startup=2)
    assert seen == [21_000] and binned.n == 21_000 and len(trials) == 2
