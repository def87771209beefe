"""Parameter search that learns from its own trials.

Trials run in batches, every (trial, fold) of a batch as a task of one job. After some
random trials the sampler splits what has finished into good and other trials, models each
parameter's values in both by Parzen estimators, and proposes the candidate with the
greatest ratio of the two densities. After each fold a trial whose mean score so far is
under the median of the earlier trials' means at the same fold is stopped. Both are seeded:
a search is repeatable.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field
from statistics import NormalDist, median

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.operators.boosting import BinnedTable, TreeModel, TreeParams, bin_rows, fit_models, judge_folds, params_from, params_map
from emberlog.operators.splits import stratified_folds


@dataclass(frozen=True)
class Span:
    """Values from ``low`` to ``high``, in steps if whole, by their logarithm if ``log``."""

    low: float
    high: float
    log: bool = False
    step: float = 0.0

    def inner(self, value: float) -> float:
        return math.log(value) if self.log else value

    @property
    def bounds(self) -> tuple[float, float]:
        return self.inner(self.low) if self.log else self.low - self.step / 2, self.inner(self.high) if self.log else self.high + self.step / 2

    def outer(self, inner: float) -> float:
        value = math.exp(inner) if self.log else inner
        if self.step:
            value = self.low + self.step * round((value - self.low) / self.step)
        return min(max(value, self.low), self.high)


# The search space. A tuple is a choice; the parameters of DART come with it.
SPACE: dict[str, Span | tuple[str, ...]] = {
    "booster": ("gbtree", "dart"),
    "reg_lambda": Span(1e-8, 1.0, log=True),
    "reg_alpha": Span(1e-8, 1.0, log=True),
    "max_depth": Span(3, 12, step=1),
    "eta": Span(0.01, 0.3, log=True),
    "gamma": Span(1e-8, 1.0, log=True),
    "min_child_weight": Span(1, 10, step=1),
    "subsample": Span(0.5, 1.0),
    "column_share": Span(0.5, 1.0),
    "rounds": Span(100, 1000, step=100),
    "sample_type": ("uniform", "weighted"),
    "normalize_type": ("tree", "forest"),
    "rate_drop": Span(0.0, 1.0),
    "skip_drop": Span(0.0, 1.0),
}
DART_ONLY = ("sample_type", "normalize_type", "rate_drop", "skip_drop")
WHOLE = ("max_depth", "rounds")


@dataclass
class Trial:
    number: int
    params: dict[str, float | str]
    scores: list[float] = field(default_factory=list)
    other: list[float] = field(default_factory=list)
    state: str = "RUNNING"

    def mean(self, folds: int | None = None) -> float:
        return float(np.mean(self.scores[:folds]))


# ---------------------------------------------------------------- sampler


class Parzen:
    """Truncated normals around the seen values, and a wide one over the whole span."""

    def __init__(self, span: Span, seen: Sequence[float]):
        low, high = span.bounds
        mus = np.sort(np.array([span.inner(v) for v in seen] + [(low + high) / 2]))
        around = np.concatenate(([low], mus, [high]))
        wide = np.maximum(around[1:-1] - around[:-2], around[2:] - around[1:-1])
        wide = np.clip(wide, (high - low) / min(100.0, 1.0 + len(mus)), high - low)
        wide[np.argmax(mus == (low + high) / 2)] = high - low
        self.low, self.high = low, high
        self.parts = [NormalDist(m, s) for m, s in zip(mus.tolist(), wide.tolist(), strict=True)]

    def draw(self, rng: np.random.Generator) -> float:
        part = self.parts[int(rng.integers(len(self.parts)))]
        a, b = part.cdf(self.low), part.cdf(self.high)
        return min(max(part.inv_cdf(min(max(a + (b - a) * rng.random(), 1e-12), 1 - 1e-12)), self.low), self.high)

    def log_density(self, x: float) -> float:
        inside = [p.pdf(x) / max(p.cdf(self.high) - p.cdf(self.low), 1e-300) for p in self.parts]
        return math.log(max(sum(inside) / len(inside), 1e-300))


def choice_shares(choices: Sequence[str], seen: Sequence[str]) -> list[float]:
    """Frequencies with one value spread over all choices before any is seen."""
    return [(1 / len(choices) + sum(s == c for s in seen)) / (1 + len(seen)) for c in choices]


def split_trials(done: Sequence[Trial]) -> tuple[list[Trial], list[Trial]]:
    """The best tenth (one at least, 25 at most), and the rest. Whole trials come before
    stopped ones, of these the ones that got further."""
    order = sorted(done, key=lambda t: (t.state != "COMPLETE", -len(t.scores), -t.mean(), t.number))
    n = min(25, math.ceil(0.1 * len(order)))
    return order[:n], order[n:]


def _active(name: str, params: Mapping) -> bool:
    return name not in DART_ONLY or params.get("booster") == "dart"


def propose(done: Sequence[Trial], rng: np.random.Generator, startup: int = 10, candidates: int = 24, space=None) -> dict:
    """The next trial's parameters, each by its own: random ones while ``startup`` trials
    have not finished, then the best of some candidates drawn from the good trials."""
    space = SPACE if space is None else space
    good, rest = split_trials(done) if len(done) >= startup else ([], [])
    params: dict[str, float | str] = {}
    for name, over in space.items():
        if not _active(name, params):
            continue
        seen = [[t.params[name] for t in group if name in t.params] for group in (good, rest)]
        if isinstance(over, tuple):
            if not good:
                params[name] = over[int(rng.integers(len(over)))]
                continue
            here, there = (choice_shares(over, s) for s in seen)
            drawn = rng.choice(len(over), candidates, p=np.array(here) / sum(here))
            params[name] = over[max(drawn.tolist(), key=lambda i: here[i] / there[i])]
        elif not good:
            low, high = over.bounds
            params[name] = over.outer(low + (high - low) * rng.random())
        else:
            here, there = (Parzen(over, s) for s in seen)
            drawn = [here.draw(rng) for _ in range(candidates)]
            params[name] = over.outer(max(drawn, key=lambda x: here.log_density(x) - there.log_density(x)))
    return params


def tree_params(params: Mapping, seed: int = 42) -> TreeParams:
    return TreeParams(seed=seed, **{k: int(v) if k in WHOLE else v for k, v in params.items()})


def should_stop(trial: Trial, earlier: Sequence[Trial], startup: int = 5) -> bool:
    """Whether the mean so far is under the median of the earlier trials' at this fold."""
    step = len(trial.scores)
    means = [t.mean(step) for t in earlier if t.number != trial.number and len(t.scores) >= step]
    return len(means) >= startup and trial.mean() < median(means)


# ---------------------------------------------------------------- search


def search(
    df: DataFrame, n_trials: int = 30, folds: int = 3, metric: str = "f1_score", batch: int = 10, startup: int = 10,
    seed: int = 42, row_id: str = "id", label: str = "label",
) -> tuple[list[Trial], BinnedTable]:
    """Trials on stratified folds of all rows, and the rows they ran on."""
    folded = stratified_folds(df, row_id, label, folds)
    binned = bin_rows(folded, label=label, row_id=row_id, group=F.col("fold"))
    rng = np.random.default_rng(seed)
    first = metric == "f1_score"
    trials: list[Trial] = []
    while len(trials) < n_trials:
        done = list(trials)
        size = min(batch if len(done) >= startup else startup - len(done), n_trials - len(done))
        running = [Trial(len(done) + i, propose(done, rng, startup)) for i in range(size)]
        trials += running
        # nothing can be stopped before the first trials are done, so their folds need no wait
        steps = [list(range(folds))] if not done else [[k] for k in range(folds)]
        for step in steps:
            tasks = [(t, k) for t in running if t.state == "RUNNING" for k in step]
            found = judge_folds(df.sparkSession, binned, [(tree_params(t.params, seed), k) for t, k in tasks])
            for (t, _), (f1, area) in zip(tasks, found, strict=True):
                t.scores.append(f1 if first else area)
                t.other.append(area if first else f1)
            for t in running:
                if done and t.state == "RUNNING" and len(t.scores) < folds and should_stop(t, trials):
                    t.state = "PRUNED"
        for t in running:
            t.state = "COMPLETE" if t.state == "RUNNING" else t.state
    return trials, binned


TRIALS = "number int, state string, value double, std double, folds int, cv_scores array<double>, params map<string,string>"


def trials_table(spark: SparkSession, trials: Sequence[Trial], seed: int = 42) -> DataFrame:
    """A row for each trial: value is the mean over its folds."""
    rows = [
        (t.number, t.state, t.mean(), float(np.std(t.scores)), len(t.scores), t.scores, params_map(tree_params(t.params, seed)))
        for t in trials
    ]
    return spark.createDataFrame(rows, TRIALS)


# Ids and names of the variants that come from a search.
VARIANT_ID, VARIANT_NAME = "xgb_optimized_v", "Optimized Variant "


def best_variants(trials: DataFrame, n: int = 3, prefix: str = VARIANT_ID) -> DataFrame:
    """Variants of an experiment with equal weights from the best whole trials."""
    from pyspark.sql import Window

    best = trials.where("state = 'COMPLETE'").orderBy(F.desc("value"), "number").limit(n)
    # at most ``n`` rows reach this window
    place = best.withColumn("place", F.row_number().over(Window.orderBy(F.desc("value"), "number")))
    return place.select(
        F.concat(F.lit(prefix), "place").alias("variant_id"), F.concat(F.lit(VARIANT_NAME), "place").alias("name"),
        F.lit(1.0 / n).alias("weight"), F.col("value").alias("score"), "std", "params",
    )


def fit_variants(spark: SparkSession, variants: DataFrame, binned: BinnedTable) -> dict[str, TreeModel]:
    """Every variant fitted with its own parameters on all of the rows, in one job."""
    rows = variants.select("variant_id", "params").orderBy("variant_id").collect()  # a handful
    models = fit_models(spark, binned, [(params_from(r.params), None) for r in rows])
    return {r.variant_id: m for r, m in zip(rows, models, strict=True)}


# What an experiment asks of its metrics, and for how long.
CONFIG = {
    "type": "hyperparameter",
    "metrics": [
        {"name": "f1_score", "threshold": 0.90},
        {"name": "auc_roc", "threshold": 0.95},
        {"name": "latency_p99", "threshold": 100},
    ],
    "duration_days": 7,
    "min_samples": 1000,
}


def write_experiment_config(variants: DataFrame, path: str, name: str = "xgboost_optimized_comparison") -> str:
    """The experiment as one JSON document in a new folder under ``path``; its place."""
    spark = variants.sparkSession
    rows = [
        {"id": r.variant_id, "name": r.name, "params": asdict(params_from(r.params)), "score": r.score, "std": r.std, "weight": r.weight}
        for r in variants.select("variant_id", F.col("name"), "params", "score", "std", "weight").orderBy("variant_id").toLocalIterator()
    ]
    config = {"name": name, "description": f"Compare top {len(rows)} optimized XGBoost variants", **CONFIG, "variants": rows}
    place = f"{path.rstrip('/')}/experiment-{uuid.uuid4().hex}"
    spark.createDataFrame([(json.dumps(config),)], "value string").coalesce(1).write.text(place)
    return place
