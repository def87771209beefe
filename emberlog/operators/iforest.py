"""Isolation forest: sampled trees fitted in parallel, scored in Arrow batches."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from emberlog.operators.ordered import exact_percentiles
from emberlog.operators.splits import hash_bits

NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, depth double"


def average_path(n: float) -> float:
    """Mean depth of an unsuccessful search among ``n`` points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


@dataclass(frozen=True)
class IsolationForest:
    """Fitted forest. ``nodes`` has at most ``trees * (2 * sample - 1)`` rows, whatever
    the size of the training table."""

    nodes: pd.DataFrame
    sample: int
    offset: float

    def save(self, spark, path: str) -> None:
        meta = {"sample": self.sample, "offset": self.offset}
        spark.createDataFrame(self.nodes.assign(**meta)).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark, path: str) -> "IsolationForest":
        stored = spark.read.parquet(path).toPandas()
        nodes = stored.drop(columns=["sample", "offset"]).sort_values(["tree", "node"], ignore_index=True)
        return IsolationForest(nodes, int(stored["sample"].iloc[0]), float(stored["offset"].iloc[0]))


def _grow(points: np.ndarray, limit: int, rng) -> list[tuple]:
    """Node rows of one tree; children are numbered after their parent."""
    nodes: list[tuple] = []
    waiting = [(points, 0, None, None)]
    while waiting:
        rows, depth, parent, side = waiting.pop()
        number = len(nodes)
        if parent is not None:
            nodes[parent][side] = number
        low, high = rows.min(axis=0), rows.max(axis=0)
        open_columns = np.flatnonzero(high > low)
        if len(rows) <= 1 or depth >= limit or len(open_columns) == 0:
            nodes.append([number, -1, 0.0, -1, -1, depth + average_path(len(rows))])
            continue
        column = int(rng.choice(open_columns))
        cut = float(rng.uniform(low[column], high[column]))
        nodes.append([number, column, cut, -1, -1, 0.0])
        goes_left = rows[:, column] <= cut
        waiting.append((rows[~goes_left], depth + 1, number, 4))
        waiting.append((rows[goes_left], depth + 1, number, 3))
    return [tuple(n) for n in nodes]


def fit_isolation_forest(
    df: DataFrame, id_column: str, features: str, trees: int = 100, max_samples: int = 256,
    contamination: float = 0.1, seed: int = 42,
) -> IsolationForest:
    """Fit on an array column.

    A pool of ``trees * max_samples`` rows with the smallest seeded hashes is taken from
    the table, every tree draws its rows from the pool by a hash of its own, and the
    trees are grown one per group. The score cutoff is the exact ``contamination``
    percentile of the training scores.
    """
    total = df.count()
    sample = min(max_samples, total)
    pool_size = trees * sample
    keyed = df.select(
        F.col(id_column).cast("string").alias("_id"), F.col(features).cast("array<double>").alias("x"),
        hash_bits(F.concat(F.col(id_column).cast("string"), F.lit(f":{seed}"))).alias("_h"),
    )
    if total > 4 * pool_size:  # hashes are uniform: twice the share holds the pool for sure
        keyed = keyed.where(F.col("_h") < int(16**13 * min(1.0, 2.0 * pool_size / total)))
    pool = keyed.orderBy("_h", "_id").limit(pool_size)
    # four times the wanted share of the pool is enough for every tree to fill its sample
    draw = min(1.0, 4.0 * sample / min(pool_size, total))
    drawn = (
        pool.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
        .withColumn("_o", F.pmod(F.xxhash64("_id", "tree", F.lit(seed)), F.lit(10**9)))
        .where(F.col("_o") < int(draw * 10**9))
    )
    place = F.row_number().over(Window.partitionBy("tree").orderBy("_o", "_id"))
    chosen = drawn.withColumn("_p", place).where(F.col("_p") <= sample).select("tree", "_p", "x")
    limit = max(1, math.ceil(math.log2(max(sample, 2))))

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        tree = int(group["tree"].iloc[0])
        points = np.vstack(group.sort_values("_p")["x"].to_numpy())
        rows = _grow(points, limit, np.random.default_rng([seed, tree]))
        out = pd.DataFrame(rows, columns=["node", "feature", "threshold", "left", "right", "depth"])
        out.insert(0, "tree", tree)
        return out

    nodes = chosen.groupBy("tree").applyInPandas(grow, NODE_SCHEMA).toPandas()
    nodes = nodes.sort_values(["tree", "node"], ignore_index=True)
    fitted = IsolationForest(nodes, sample, 0.0)
    scores = score_samples(fitted, df.select(features), features)
    cut = exact_percentiles(scores, [], "score_samples", {"offset": contamination}).first()["offset"]
    return IsolationForest(nodes, sample, float(cut))


def score_samples(forest: IsolationForest, df: DataFrame, features: str) -> DataFrame:
    """Add ``score_samples`` in [-1, 0]; lower is more anomalous."""
    parts = [g for _, g in forest.nodes.groupby("tree", sort=True)]
    packed = [
        tuple(g[c].to_numpy() for c in ("feature", "threshold", "left", "right", "depth")) for g in parts
    ]
    shared = df.sparkSession.sparkContext.broadcast(packed)
    scale = average_path(forest.sample) or 1.0

    @pandas_udf(T.DoubleType())
    def score(rows: pd.Series) -> pd.Series:
        if len(rows) == 0:
            return pd.Series([], dtype=float)
        x = np.vstack(rows.to_numpy()).astype(float)
        index = np.arange(len(x))
        depth = np.zeros(len(x))
        for feature, threshold, left, right, leaf_depth in shared.value:
            at = np.zeros(len(x), dtype=int)
            while True:
                column = feature[at]
                inner = column >= 0
                if not inner.any():
                    break
                value = x[index, np.where(inner, column, 0)]
                step = np.where(value <= threshold[at], left[at], right[at])
                at = np.where(inner, step, at)
            depth += leaf_depth[at]
        return pd.Series(-(2.0 ** (-depth / len(shared.value) / scale)))

    return df.withColumn("score_samples", score(F.col(features).cast("array<double>")))


def predict_isolation(forest: IsolationForest, df: DataFrame, features: str) -> DataFrame:
    """Scores, ``decision`` (negative = anomaly) and the 0/1 ``prediction``."""
    scored = score_samples(forest, df, features)
    decision = F.col("score_samples") - F.lit(forest.offset)
    return scored.withColumn("decision", decision).withColumn("prediction", (F.col("decision") < 0).cast("int"))


def signed_confidence(df: DataFrame, decision: str = "decision", out: str = "score") -> DataFrame:
    """Decision values scaled to [-1, 1] on each side of 0."""
    ends = df.agg(F.struct(F.min(decision).alias("low"), F.max(decision).alias("high")).alias("b")).scalar()
    value = F.col(decision)
    scaled = F.when(value < 0, F.try_divide(value, -F.col("_b.low"))).otherwise(F.try_divide(value, F.col("_b.high")))
    return df.withColumn("_b", ends).withColumn(out, scaled).drop("_b")


def pseudo_labels(df: DataFrame, id_column: str, tier: str = "tier") -> DataFrame:
    """Labels from the two high-confidence tiers."""
    label = F.when(F.col(tier) == "high_anomaly", 1).when(F.col(tier) == "high_normal", 0)
    return df.select(id_column, label.alias("label")).where(F.col("label").isNotNull())
