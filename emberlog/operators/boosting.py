"""Boosted trees on features that are binned once, many models in one job.

The cut points come from quantiles of all rows, and all labelled rows are fitted, one byte
for each feature. They are written once; every model of a job, be it a fold of a search or a
variant, is a task of its own, which takes its copy of the rows out of a shuffle in the order
of a hash of the id. The driver holds none of them. A task keeps what is large in unnamed
temporary files; what is left in memory is about 100 bytes a row. Scoring runs over all rows where
they are.

A tree grows level by level: one histogram of gradient sums over (node, feature, bin) for
each level, from which all of its splits follow.
"""

from __future__ import annotations

import functools
import json
import tempfile
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberlog.session import stored

MAX_BINS = 32
#: Rows that a tree is walked with at once: few enough for a processor's cache.
SLICE = 8192
#: Rows of a histogram that are summed at once, and bins of these.
PART, PART_BINS = 1 << 16, 1 << 18
#: Bytes of bins, and of the leaves of dropped trees, that a task holds in memory.
HELD = 128 << 20


@dataclass(frozen=True)
class TreeParams:
    booster: str = "gbtree"
    reg_lambda: float = 1.0
    reg_alpha: float = 0.0
    max_depth: int = 6
    eta: float = 0.1
    gamma: float = 0.0
    min_child_weight: float = 1.0
    subsample: float = 0.8
    column_share: float = 0.8
    rounds: int = 500
    patience: int = 0
    sample_type: str = "uniform"
    normalize_type: str = "tree"
    rate_drop: float = 0.0
    skip_drop: float = 0.0
    seed: int = 42


# The two boosters of the comparison.
TREES_A = TreeParams()
TREES_B = TreeParams(eta=0.05, rounds=1000, reg_lambda=3.0, subsample=1.0, column_share=1.0, patience=50)


# ---------------------------------------------------------------- one model


def _sigmoid(margin: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(margin, -60, 60)))


def _score(g: np.ndarray, h: np.ndarray, p: TreeParams) -> np.ndarray:
    """What a leaf with these gradient sums gains."""
    g = np.sign(g) * np.maximum(np.abs(g) - p.reg_alpha, 0.0)
    return g * g / (h + p.reg_lambda + 1e-16)


@dataclass
class Tree:
    """Nodes in level order; ``left`` is 0 for leaves, the right child follows the left."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @functools.cached_property
    def walk(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Feature, cut and left child of each node, where a leaf leads to itself; levels."""
        leaf = self.left == 0
        cut, left = np.where(leaf, 255, self.cut).astype(np.uint8), np.where(leaf, np.arange(len(leaf)), self.left)
        levels, level = 0, np.zeros(1, np.int64)
        while len(level := level[~leaf[level]]):
            levels, level = levels + 1, np.concatenate((left[level], left[level] + 1))
        return self.feature.astype(np.int64), cut, left.astype(np.int64), levels

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """``x`` holds bins as single bytes, one row each."""
        feature, cut, left, levels = self.walk
        bins, starts = np.ascontiguousarray(x).ravel(), np.arange(len(x)) * x.shape[1]
        at = np.zeros(len(x), np.int64)
        for _ in range(levels):
            above = bins.take(feature.take(at) + starts) > cut.take(at)
            at = left.take(at)
            at += above
        return at


def grow_tree(x: np.ndarray, g: np.ndarray, h: np.ndarray, columns: np.ndarray, p: TreeParams, chosen: np.ndarray | None = None) -> Tree:
    """``x`` holds bins, one row each; only ``columns`` are split on. ``g`` and ``h`` belong
    to the rows ``chosen``, by default all."""
    chosen = np.arange(len(x)) if chosen is None else chosen
    n, f = len(chosen), len(columns)
    feature, cut, left, value, gain = ([0], [0], [0], [0.0], [0.0])
    rows, node, level = np.arange(n), np.zeros(n, np.int64), [0]
    for depth in range(p.max_depth + 1):
        k = len(level)
        sum_g, sum_h = np.bincount(node, g[rows], k), np.bincount(node, h[rows], k)
        leaf = -np.sign(sum_g) * np.maximum(np.abs(sum_g) - p.reg_alpha, 0.0) / (sum_h + p.reg_lambda + 1e-16) * p.eta
        for i, at in enumerate(level):
            value[at] = float(leaf[i])
        if depth == p.max_depth or f == 0:
            break
        # nodes too light for two children stay leaves
        heavy = np.flatnonzero(sum_h >= 2 * p.min_child_weight)
        if not len(heavy):
            break
        if len(heavy) < k:
            to = np.full(k, -1)
            to[heavy] = np.arange(len(heavy))
            keep = to[node] >= 0
            rows, node = rows[keep], to[node[keep]]
            level, sum_g, sum_h, k = [level[i] for i in heavy.tolist()], sum_g[heavy], sum_h[heavy], len(heavy)
        below_g, below_h = (b.cumsum(2)[:, :, :-1] for b in _histograms(x, g, h, columns, chosen, rows, node, k))
        all_g, all_h = sum_g[:, None, None], sum_h[:, None, None]
        won = _score(below_g, below_h, p) + _score(all_g - below_g, all_h - below_h, p) - _score(all_g, all_h, p)
        won[(below_h < p.min_child_weight) | (all_h - below_h < p.min_child_weight)] = -np.inf
        best = won.reshape(k, -1).argmax(1)
        best_gain = won.reshape(k, -1)[np.arange(k), best]
        split = best_gain > max(p.gamma, 1e-6)
        if not split.any():
            break
        first = np.full(k, -1, np.int64)
        following = []
        for i in np.flatnonzero(split).tolist():
            where = level[i]
            feature[where], cut[where] = int(columns[best[i] // (MAX_BINS - 1)]), int(best[i] % (MAX_BINS - 1))
            left[where], gain[where], first[i] = len(value), float(best_gain[i]), len(following)
            following += [len(value), len(value) + 1]
            for one, empty in ((feature, 0), (cut, 0), (left, 0), (value, 0.0), (gain, 0.0)):
                one += [empty, empty]
        keep = first[node] >= 0
        rows, node = rows[keep], node[keep]
        for at in range(0, len(rows), PART):
            part = slice(at, at + PART)
            taken = best[node[part]]
            above = x[chosen[rows[part]], columns[taken // (MAX_BINS - 1)]] > taken % (MAX_BINS - 1)
            node[part] = first[node[part]] + above
        level = following
    return Tree(np.array(feature), np.array(cut), np.array(left), np.array(value), np.array(gain))


def _histograms(x, g, h, columns, chosen, rows, node, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of ``g`` and ``h`` over (node, feature, bin), some rows and features at a time."""
    f = len(columns)
    out_g, out_h = np.zeros((k, f, MAX_BINS)), np.zeros((k, f, MAX_BINS))
    for at in range(0, len(rows), PART):
        own, where = rows[at : at + PART], node[at : at + PART]
        place, own_g, own_h = chosen[own], g[own], h[own]
        wide = max(1, min(f, PART_BINS // len(own)))
        for low in range(0, f, wide):
            some = columns[low : low + wide]
            bins = x[place[:, None], some] + (np.arange(len(some)) + (where * len(some))[:, None]) * MAX_BINS
            for out, values in ((out_g, own_g), (out_h, own_h)):
                sums = np.bincount(bins.ravel(), np.repeat(values, len(some)), k * len(some) * MAX_BINS)
                out[:, low : low + wide] += sums.reshape(k, len(some), MAX_BINS)
    return out_g, out_h


class _Laid:
    """The leaf that each tree so far puts each row in; beyond ``HELD`` bytes in a file."""

    def __init__(self):
        self.held, self.bytes, self.file = [], 0, None

    def add(self, leaves: np.ndarray, n_leaves: int) -> None:
        leaves = leaves.astype(np.min_scalar_type(n_leaves))
        if self.bytes + leaves.nbytes <= HELD:
            self.bytes += leaves.nbytes
            self.held.append(leaves)
            return
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        self.held.append((self.file.tell(), len(leaves), leaves.dtype))
        self.file.write(leaves)

    def get(self, k: int) -> np.ndarray:
        if isinstance(self.held[k], np.ndarray):
            return self.held[k]
        at, n, kind = self.held[k]
        self.file.seek(at)
        return np.frombuffer(self.file.read(n * kind.itemsize), kind)


def log_loss(y: np.ndarray, margin: np.ndarray, w: np.ndarray) -> float:
    return float(np.average(np.logaddexp(0.0, margin) - y * margin, weights=w))


def fit_trees(x: np.ndarray, y: np.ndarray, w: np.ndarray, p: TreeParams, held: np.ndarray | None = None) -> list[tuple[float, Tree]]:
    """(weight, tree) of each round. ``held`` marks rows that are not learned from; with
    ``patience`` the rounds after the best one on these rows are cut off."""
    rng = np.random.default_rng(p.seed)
    held = np.zeros(len(y), bool) if held is None else held
    learn = np.flatnonzero(~held)
    margin = np.zeros(len(y))
    trees: list[Tree] = []
    weights: list[float] = []
    laid = _Laid()
    given = lambda ks: sum((weights[k] * trees[k].value)[laid.get(k)] for k in ks)
    best, best_loss = 0, np.inf
    for _ in range(p.rounds):
        dropped: list[int] = []
        base = margin
        if p.booster == "dart" and trees and rng.random() >= p.skip_drop:
            chance = np.full(len(trees), p.rate_drop)
            if p.sample_type == "weighted":
                chance = np.minimum(1.0, p.rate_drop * len(trees) * np.array(weights) / max(sum(weights), 1e-16))
            dropped = np.flatnonzero(rng.random(len(trees)) < chance).tolist()
            if dropped:
                base = margin - given(dropped)
        rows = learn if p.subsample >= 1 else learn[rng.random(len(learn)) < p.subsample]
        columns = np.arange(x.shape[1])
        if p.column_share < 1:
            columns = np.sort(rng.choice(columns, max(1, int(p.column_share * len(columns))), replace=False))
        share = _sigmoid(base[rows])
        tree = grow_tree(x, (share - y[rows]) * w[rows], np.maximum(share * (1 - share), 1e-16) * w[rows], columns, p, rows)
        leaves = _leaves(tree, x)
        scale = 1.0
        if dropped:
            n = len(dropped) if p.normalize_type == "tree" else 1
            scale, shrink = 1.0 / (n + p.eta), n / (n + p.eta)
            for k in dropped:
                weights[k] *= shrink
            base = base + given(dropped)
        trees.append(tree)
        weights.append(scale)
        if p.booster == "dart":
            laid.add(leaves, len(tree.value))
        margin = base + scale * tree.value[leaves]
        if p.patience and held.any():
            loss = log_loss(y[held], margin[held], w[held])
            if loss < best_loss - 1e-12:
                best, best_loss = len(trees), loss
            elif len(trees) - best >= p.patience:
                break
    if p.patience and held.any() and p.booster != "dart":
        trees, weights = trees[:best], weights[:best]
    return list(zip(weights, trees, strict=True))


def _leaves(tree: Tree, x: np.ndarray) -> np.ndarray:
    out = np.empty(len(x), np.min_scalar_type(len(tree.value)))
    for first in range(0, len(x), SLICE):
        out[first : first + SLICE] = tree.leaves(x[first : first + SLICE])
    return out


def margins(model: Sequence[tuple[float, Tree]], x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x))
    for first in range(0, len(x), SLICE):
        rows = np.ascontiguousarray(x[first : first + SLICE])
        for weight, tree in model:
            out[first : first + SLICE] += weight * tree.value[tree.leaves(rows)]
    return out


def f1_score(y: np.ndarray, predicted: np.ndarray) -> float:
    hit = int(((y == 1) & (predicted == 1)).sum())
    return 2 * hit / max(1, int((y == 1).sum() + (predicted == 1).sum()))


def auc(y: np.ndarray, score: np.ndarray) -> float:
    """Area under the ROC curve, tied scores by their mean rank; NaN for one class only."""
    _, at, counts = np.unique(score, return_inverse=True, return_counts=True)
    rank = (np.cumsum(counts) - (counts - 1) / 2)[at]
    ones = int((y == 1).sum())
    zeros = len(y) - ones
    return float((rank[y == 1].sum() - ones * (ones + 1) / 2) / (ones * zeros)) if ones and zeros else float("nan")


# ---------------------------------------------------------------- binned rows


@dataclass
class Binned:
    """Rows ready to be fitted: bins, labels, weights, and a group (a fold, say) each."""

    cuts: list[np.ndarray]
    x: np.ndarray
    y: np.ndarray
    w: np.ndarray
    group: np.ndarray


#: A row's place in the order (a hash of its id), its id, bins, label, weight and group.
ROW = "place long, row_id string, x binary, y double, w double, g int"
ORDER = [c.split()[0] for c in ROW.split(", ")]


@dataclass
class BinnedTable:
    """Binned rows as a written table; ``n`` of them. The arrays are for small tables."""

    cuts: list[np.ndarray]
    rows: DataFrame
    n: int

    @functools.cached_property
    def arrays(self) -> Binned:
        return _filled(self.rows.orderBy(*ORDER).toArrow().to_batches(), self.cuts, self.n)

    x = property(lambda self: self.arrays.x)
    y = property(lambda self: self.arrays.y)
    w = property(lambda self: self.arrays.w)
    group = property(lambda self: self.arrays.group)


def _filled(batches, cuts: list[np.ndarray], n: int) -> Binned:
    """Arrays of ``n`` rows, the bins feature by feature and in a file if they are many."""
    wide = len(cuts)
    x = np.memmap(tempfile.TemporaryFile(), np.uint8, "w+", shape=(n, wide), order="F") if n * wide > HELD else np.empty((n, wide), np.uint8, "F")
    out = Binned(cuts, x, np.empty(n), np.empty(n), np.empty(n, np.int32))
    at = 0
    for batch in batches:
        part = slice(at, at + batch.num_rows)
        x[part] = np.frombuffer(b"".join(batch.column("x").to_pylist()), np.uint8).reshape(batch.num_rows, wide)
        out.y[part], out.w[part] = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "w"))
        out.group[part] = batch.column("g").fill_null(-1).to_numpy(zero_copy_only=False)
        at += batch.num_rows
    if at != n:
        raise ValueError(f"{at} of {n} rows arrived")
    return out


def _bins(values: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(c, values[:, i], "left") for i, c in enumerate(cuts)], axis=1).astype(np.uint8)


def _matrix(column: pa.Array, wide: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, wide)


def bin_rows(
    df: DataFrame, features: str = "features", label: str = "label", row_id: str = "id", weight: str | None = None,
    group: Column | None = None, max_rows: int | None = None,
) -> BinnedTable:
    """All rows, binned, or the first ``max_rows`` in the order of a hash of the id; cut points
    from all rows. Rows without a label take no part, missing features count as 0."""
    values = F.transform(vector_to_array(F.col(features)), lambda x: F.when(x.isNull() | F.isnan(x), 0.0).otherwise(x))
    rows = df.where(F.col(label).isNotNull()).select(
        F.xxhash64(row_id).alias("place"), F.col(row_id).cast("string").alias("row_id"), values.alias("v"), F.col(label).cast("double").alias("y"),
        (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"), (F.lit(0) if group is None else group).cast("int").alias("g"),
    )
    wide = rows.agg(F.max(F.size("v"))).first()[0] or 0
    shares = [(i + 1) / MAX_BINS for i in range(MAX_BINS - 1)]
    points = [F.percentile_approx(F.col("v")[i], F.lit(shares), 2000).alias(f"c{i}") for i in range(wide)]
    found = rows.agg(*points).first() if wide else []
    cuts = [np.unique(np.array(c, float)) if c else np.zeros(0) for c in found]
    if max_rows is not None:
        rows = rows.orderBy("place", "row_id").limit(max_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [b""] * batch.num_rows
            if wide and batch.num_rows:
                bins = _bins(_matrix(batch.column("v"), wide), cuts).tobytes()
                raw = [bins[at : at + wide] for at in range(0, len(bins), wide)]
            columns = [pa.array(raw, pa.binary()) if c == "x" else batch.column(c) for c in ORDER]
            yield pa.RecordBatch.from_arrays(columns, ORDER)

    binned = stored(rows.select("place", "row_id", "v", "y", "w", "g").mapInArrow(run, ROW))
    return BinnedTable(cuts, binned, binned.count())


# ---------------------------------------------------------------- many models in one job


def _pack(model: Sequence[tuple[float, Tree]]) -> bytes:
    parts = [[w, *(getattr(t, c).tolist() for c in ("feature", "cut", "left", "value", "gain"))] for w, t in model]
    return json.dumps(parts).encode()


def _unpack(raw: bytes) -> list[tuple[float, Tree]]:
    return [(w, Tree(*(np.array(c) for c in columns))) for w, *columns in json.loads(raw)]


def _keys(spark: SparkSession, n: int) -> DataFrame:
    """(task, key): keys that a shuffle by them deals to ``n`` different partitions."""
    ids = spark.range(0, 64 * n).select("id", F.pmod(F.hash("id"), F.lit(n)).alias("part"))
    found = sorted(r[0] for r in ids.groupBy("part").agg(F.min("id")).select("min(id)").collect())
    found += [64 * n + i for i in range(n - len(found))]
    return spark.createDataFrame(list(enumerate(found)), "task long, key long")


def run_tasks(spark: SparkSession, binned: BinnedTable, work, tasks: Sequence, schema: str) -> list:
    """``work(rows, task)`` gives a row for each of ``tasks``; one task of the job each, with
    a copy of the rows of its own, in their order."""
    names = [x.split()[0] for x in schema.split(", ")]
    cuts, n = binned.cuts, binned.n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a mark comes first, also where there are no rows
        for at, own in _by_task(batches):
            row = work(_filled(own, cuts, n), tasks[at])
            yield pa.RecordBatch.from_pylist([dict(zip(names, (at, *row), strict=True))], schema=kinds)

    kinds = pa.schema([(n, {"long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}[t]) for n, t in (x.split() for x in schema.split(", "))])
    keys = _keys(spark, len(tasks))
    marks = keys.select("task", "key", F.lit(0).alias("kind"), *[F.lit(None).cast(k).alias(c) for c, k in (x.split() for x in ROW.split(", "))])
    copies = F.broadcast(keys).crossJoin(binned.rows).select("task", "key", F.lit(1).alias("kind"), *ORDER)
    dealt = marks.unionByName(copies).repartition(max(1, len(tasks)), "key").sortWithinPartitions("key", "kind", *ORDER)
    return sorted(dealt.drop("key").mapInArrow(run, schema).collect(), key=lambda r: r[0])


def _by_task(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[pa.RecordBatch]]]:
    """Each task that stands in sorted ``batches`` with its rows, which are to be used up
    before the next."""
    parts = _cut(batches)
    part = next(parts, None)

    def own(task: int) -> Iterator[pa.RecordBatch]:
        nonlocal part
        while part is not None and part[0] == task:
            rows = part[1].filter(pc.equal(part[1].column("kind"), 1))
            part = None
            if rows.num_rows:
                yield rows
            part = next(parts, None)

    while part is not None:
        yield part[0], own(part[0])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    for batch in batches:
        task = batch.column("task").to_numpy()
        ends = np.append(np.flatnonzero(task[1:] != task[:-1]) + 1, len(task))
        at = 0
        for end in ends.tolist():
            if end > at:
                yield int(task[at]), batch.slice(at, end - at)
            at = end


@dataclass
class TreeModel:
    """A fitted booster; small, so it travels with the tasks that score."""

    cuts: list[np.ndarray]
    trees: list[tuple[float, Tree]]

    def importance(self) -> np.ndarray:
        """Each feature's share of all gain."""
        out = np.zeros(len(self.cuts))
        for _, tree in self.trees:
            inner = tree.left > 0
            np.add.at(out, tree.feature[inner], tree.gain[inner])
        return out / out.sum() if out.sum() > 0 else out

    def predict(self, df: DataFrame, name: str | None = None, keep: Sequence[str] = ("id", "label"), features: str = "features") -> DataFrame:
        """``prediction`` and ``score`` for every row of a table or a stream."""
        rows = df.select(*keep, vector_to_array(F.col(features)).alias("__v"))
        kept = rows.drop("__v").schema
        cuts, trees = self.cuts, self.trees

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                v = _matrix(batch.column("__v"), len(cuts)) if batch.num_rows else np.zeros((0, len(cuts)))
                score = _sigmoid(margins(trees, _bins(np.nan_to_num(v), cuts)))
                columns = [batch.column(i) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array((score >= 0.5).astype(np.int32)), pa.array(score)], [*keep, "prediction", "score"])

        out = rows.mapInArrow(run, f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in kept)}, prediction int, score double")
        return out if name is None else out.select(*keep, F.lit(name).alias("model"), "prediction", "score")


def _fit_one(binned: Binned, task: tuple[TreeParams, int | None]):
    params, held_group = task
    held = None if held_group is None else binned.group == held_group
    return (_pack(fit_trees(binned.x, binned.y, binned.w, params, held)),)


def fit_models(spark: SparkSession, binned: BinnedTable, tasks: Sequence[tuple[TreeParams, int | None]]) -> list[TreeModel]:
    """A model for each (parameters, group that is held out, if any), in one job."""
    rows = run_tasks(spark, binned, _fit_one, tasks, "task long, model binary")
    return [TreeModel(binned.cuts, _unpack(bytes(r.model))) for r in rows]


def _judge(binned: Binned, task: tuple[TreeParams, int]):
    params, fold = task
    held = binned.group == fold
    model = fit_trees(binned.x, binned.y, binned.w, params, held)
    score = _sigmoid(margins(model, binned.x[held]))
    y = binned.y[held]
    return f1_score(y, (score >= 0.5).astype(int)), auc(y, score)


def judge_folds(spark: SparkSession, binned: BinnedTable, tasks: Sequence[tuple[TreeParams, int]]) -> list[tuple[float, float]]:
    """(F1, AUC) on the held-out fold of each (parameters, fold), in one job."""
    return [(r.f1_score, r.auc_roc) for r in run_tasks(spark, binned, _judge, tasks, "task long, f1_score double, auc_roc double")]


def params_map(params: TreeParams) -> dict[str, str]:
    return {k: str(v) for k, v in asdict(params).items()}


@functools.cache
def _kinds() -> dict[str, type]:
    return {k: type(v) for k, v in asdict(TreeParams()).items()}


def params_from(given: dict[str, str]) -> TreeParams:
    return TreeParams(**{k: _kinds()[k](v) for k, v in given.items()})
