"""Hard negatives by coordinate pruning: inner-product search in length buckets.

Vectors are quantised to integers, sorted by label and falling length and cut into buckets
of ``bucket_rows`` rows of one label. A bucket keeps, for each coordinate, its rows in the
order of their normalised value there (the sorted coordinate list); ``pack`` buckets are a
group. Anchors are packed in blocks, and each block meets each group once: a task holds one
group and streams the blocks by. An anchor goes through a group's buckets from the longest
vectors down, with the score that a row must reach to matter (its k-th best so far, or the
given bound). That score, divided by the anchor's and the bucket's longest length, is a
cosine, and bounds the angle between the vectors and so the values that a matching row can
have in a coordinate. The anchor's ``focus`` largest coordinates give such ranges; each is
a stretch of the sorted list, and rows in all of them are the candidates, whose integer
inner products are computed exactly. Anchors whose ranges span whole lists are verified
together, as one product. Two rounds: positives (same label), then negatives (other labels,
scores within the given shares of each positive's score).

What leaves a task is at most ``k`` rows for each anchor (and positive) and group.

Cases: rows with a null id, label or vector or a null or non-finite component take no part;
components after scaling are held within 2 to the 20th, so that all scores are exact; of
vectors of different sizes the shared leading components count; an empty vector has score
0 with every row; rows alike in id, label and vector count once, other rows that share an id
are rows of their own, but never partners of an anchor of that id; an anchor id with
several rows is the first of them by label and vector; ties go to the smaller id; an anchor
without positives, or a positive without negatives, gives no rows; an empty table gives
none; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlog.llm.work import shuffle_parts, unsized, written

LARGEST = float(1 << 20)
INDEX = "grp long, seq long, label long, n int, dim int, ids binary, sizes binary, vectors binary, orders binary"
BLOCKS = "block long, n int, dim int, ids binary, labels binary, vectors binary, block_labels array<long>"
SLACK = 1e-9


def _quantised(vectors: DataFrame, scale: float, vector: str) -> DataFrame:
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    whole = F.transform(v, lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(LARGEST)), F.lit(-LARGEST))).cast("int"))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull()).where(finite)
    rows = rows.select(F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), whole.alias("v"))
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    return rows.withColumn("size", F.sqrt(squares))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column, short ones filled with zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    wide = int(lengths.max(initial=0))
    if (lengths == wide).all():
        return flat.reshape(len(lengths), wide)
    out = np.zeros((len(lengths), wide), np.int32)
    row = np.repeat(np.arange(len(lengths)), lengths)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    wide = max(p.shape[1] for p in parts)
    return np.vstack([np.pad(p, ((0, 0), (0, wide - p.shape[1]))) for p in parts])


def _unit(vectors: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return vectors / np.where(sizes == 0, 1.0, sizes)[:, None]


def build_index(rows: DataFrame, bucket_rows: int, pack: int) -> DataFrame:
    """One row for each bucket, with its sorted coordinate lists; written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, first_group = 0, TaskContext.get().partitionId() << 32

        def bucket(label, ids, sizes, vectors):
            nonlocal made
            orders = np.argsort(_unit(vectors, sizes), axis=0, kind="stable").T.astype(np.uint16)
            values = [first_group + made // pack, made, label, len(ids), vectors.shape[1]]
            values += [np.ascontiguousarray(x).tobytes() for x in (ids, sizes, vectors, orders)]
            made += 1
            kinds = [pa.int64()] * 3 + [pa.int32()] * 2 + [pa.binary()] * 4
            names = [x.split()[0] for x in INDEX.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(values, kinds, strict=True)], names)

        held: tuple | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            labels, ids, sizes = (batch.column(c).to_numpy() for c in ("label", "id", "size"))
            vectors = _matrix(batch.column("v"))
            if held is not None:
                labels, ids, sizes = (np.concatenate(x) for x in zip(held[:3], (labels, ids, sizes), strict=True))
                vectors = _joined([held[3], vectors])
            # alike rows lie next to each other
            new = np.ones(len(ids), bool)
            new[1:] = (labels[1:] != labels[:-1]) | (ids[1:] != ids[:-1]) | (vectors[1:] != vectors[:-1]).any(axis=1)
            labels, ids, sizes, vectors = labels[new], ids[new], sizes[new], vectors[new]
            ends = np.append(np.flatnonzero(labels[1:] != labels[:-1]) + 1, len(labels))
            at = 0
            for end in ends.tolist():
                while end - at > bucket_rows or (end - at and end < len(labels)):
                    to = min(at + bucket_rows, end)
                    yield bucket(int(labels[at]), ids[at:to], sizes[at:to], vectors[at:to])
                    at = to
            held = labels[at:], ids[at:], sizes[at:], vectors[at:]
        if held is not None and len(held[0]):
            yield bucket(int(held[0][0]), *held[1:])

    order = [F.col("label"), F.col("size").desc(), F.col("id")]
    parts = shuffle_parts(rows.sparkSession)
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order, "v")
    return written(ranged.select("label", "id", "size", "v").mapInArrow(run, INDEX), "vector-index")


def _blocks(anchors: DataFrame, block_rows: int) -> DataFrame:
    """Anchors of few labels each, packed; written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, block_rows):
                part = batch.slice(at, block_rows)
                vectors = np.ascontiguousarray(_matrix(part.column("v")), np.int32)
                values = [block, part.num_rows, vectors.shape[1]]
                values += [part.column(c).to_numpy().tobytes() for c in ("id", "label")] + [vectors.tobytes()]
                values.append(np.unique(part.column("label").to_numpy()).tolist())
                kinds = [pa.int64(), pa.int32(), pa.int32()] + [pa.binary()] * 3 + [pa.list_(pa.int64())]
                names = [x.split()[0] for x in BLOCKS.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(values, kinds, strict=True)], names)
                block += 1

    one = anchors.groupBy("id").agg(F.min(F.struct("label", "v")).alias("row")).select("id", "row.label", "row.v")
    parts = max(1, min(shuffle_parts(anchors.sparkSession), -(-one.count() // block_rows)))
    ranged = one.repartitionByRange(parts, "label", "id").sortWithinPartitions("label", "id")
    return written(ranged.mapInArrow(run, BLOCKS), "anchor-blocks")


class _Bucket:
    """A bucket of the index, ready for searches."""

    def __init__(self, row: dict):
        n, dim = row["n"], row["dim"]
        self.label, self.n, self.dim = row["label"], n, dim
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.vectors = np.frombuffer(row["vectors"], np.int32).reshape(n, dim)
        sizes = np.frombuffer(row["sizes"], np.float64)
        self.longest, self.shortest = sizes.max(initial=0), sizes.min(initial=0)
        self.orders = np.frombuffer(row["orders"], np.uint16).reshape(dim, n)
        self.unit = _unit(self.vectors, sizes)
        self.lists = np.take_along_axis(self.unit.T, self.orders.astype(np.int64), axis=1)
        self.wide = np.abs(self.vectors).max(initial=0)

    def scores(self, anchors: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
        """Exact inner products of anchors (one row each) with all or some rows."""
        d = min(anchors.shape[1], self.dim)
        mine = self.vectors[:, :d] if rows is None else self.vectors[rows, :d]
        # floats hold whole numbers below 2 to the 53rd exactly
        kind = np.float64 if float(self.wide) * float(np.abs(anchors).max(initial=0)) * d < 2.0**53 else np.int64
        return (anchors[:, :d].astype(kind) @ mine.T.astype(kind)).astype(np.int64)

    def ranges(self, unit: np.ndarray, size: np.ndarray, least: np.ndarray, focus: np.ndarray):
        """For each anchor: whether the bucket can hold a row of the score ``least``, and the
        feasible values of such rows in the anchor's focus coordinates."""
        at = np.where(least > 0, self.longest, self.shortest) * size
        # without a length the cosine says nothing: none can reach a positive score, all another
        cosine = np.where(at > 0, np.maximum(least, -1e300) / np.where(at > 0, at, 1.0), np.where(least > 0, 2.0, -1.0))
        can = cosine <= 1 + SLACK
        if self.shortest == 0:
            cosine = np.where(least > 0, cosine, -1.0)
        angle = np.arccos(np.clip(cosine - SLACK, -1, 1))[:, None]
        own = np.arccos(np.clip(np.take_along_axis(unit, focus, axis=1), -1, 1))
        return can, np.cos(np.minimum(np.pi, own + angle)) - SLACK, np.cos(np.maximum(0, own - angle)) + SLACK

    def candidates(self, focus: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Rows whose values lie in all ranges: the shortest stretch of a list, then the rest."""
        spans = [(int(np.searchsorted(self.lists[f], a, "left")), int(np.searchsorted(self.lists[f], b, "right"))) for f, a, b in zip(focus, low, high, strict=True)]
        best = min(range(len(spans)), key=lambda i: spans[i][1] - spans[i][0])
        rows = self.orders[focus[best], spans[best][0] : spans[best][1]].astype(np.int64)
        for i, f in enumerate(focus):
            if i != best and spans[i] != (0, self.n):
                values = self.unit[rows, f]
                rows = rows[(values >= low[i]) & (values <= high[i])]
        return rows


class _Best:
    """The k best (score, id) within bounds, ties to the smaller id."""

    __slots__ = ("high", "ids", "k", "low", "scores")

    def __init__(self, k: int, low: float, high: float):
        self.k, self.low, self.high = k, low, high
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    def least(self) -> float:
        return float(self.scores[-1]) if len(self.scores) == self.k else self.low

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        take = (scores >= self.least()) & (scores <= self.high)
        if not take.any():
            return
        scores, ids = scores[take], ids[take]
        if len(scores) > 4 * self.k:
            enough = scores >= np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            scores, ids = scores[enough], ids[enough]
        scores, ids = np.append(self.scores, scores), np.append(self.ids, ids)
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]


def _search(buckets: list[_Bucket], anchors: dict, wanted: list[list[_Best]], same: bool, focus_count: int) -> None:
    """All anchors of a block through a group's buckets, from the longest vectors down."""
    ids, labels, vectors = anchors["ids"], anchors["labels"], anchors["vectors"]
    size = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
    unit = _unit(vectors, size)
    focus = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :focus_count]
    asked = np.array([len(w) > 0 for w in wanted], bool)
    for bucket in buckets:
        at = np.flatnonzero(asked & ((labels == bucket.label) == same))
        if not len(at):
            continue
        least = np.array([min(b.least() for b in wanted[i]) for i in at.tolist()])
        own = focus[at][:, : max(1, focus.shape[1])]
        if bucket.dim < vectors.shape[1]:
            # the bucket lacks some coordinates: its lists cannot bound these
            own = np.where(own < bucket.dim, own, 0)
        if bucket.dim == 0 or vectors.shape[1] == 0:
            can, low, high = np.ones(len(at), bool), np.full((len(at), 1), -2.0), np.full((len(at), 1), 2.0)
            whole = can
        else:
            can, low, high = bucket.ranges(unit[at], size[at], least, own)
            whole = can & ((low <= bucket.lists[own, 0]) & (high >= bucket.lists[own, -1])).all(axis=1)
        together = np.flatnonzero(whole)
        if len(together):
            scores = bucket.scores(vectors[at[together]])
            for i, found in zip(at[together].tolist(), scores, strict=True):
                _offer(wanted[i], found, bucket.ids, ids[i])
        for j in np.flatnonzero(can & ~whole).tolist():
            rows, i = bucket.candidates(own[j], low[j], high[j]), int(at[j])
            if len(rows):
                _offer(wanted[i], bucket.scores(vectors[i : i + 1], rows)[0], bucket.ids[rows], ids[i])


def _offer(wanted: list[_Best], scores: np.ndarray, ids: np.ndarray, own_id: int) -> None:
    keep = (scores >= min(b.least() for b in wanted)) & (scores <= max(b.high for b in wanted)) & (ids != own_id)
    if keep.any():
        for best in wanted:
            best.add(scores[keep], ids[keep])


def _passes(index: DataFrame, blocks: DataFrame, wanted, same: bool, focus: int, schema: str, given: str | None = None) -> DataFrame:
    """Every block by every group that can matter. ``wanted`` gives from a block's row each
    anchor's lists to fill; what they hold at the end comes out with its list's number."""
    groups = index.select("grp", "label").distinct()
    if same:
        meet = blocks.select("block", F.explode("block_labels").alias("label")).join(groups, "label")
    else:
        meet = blocks.select("block").crossJoin(groups.select("grp").distinct())
    # numbers meet first: copies of the vectors would be counted as one each, and broadcast;
    # by a fixed number, or these few bytes would become one task that makes all copies
    parts = shuffle_parts(index.sparkSession)
    copies = unsized(meet.select("block", "grp").distinct().repartition(parts, "block")).join(blocks, "block")
    columns = ["grp", "kind", "seq", "label", "n", "dim", "ids", "labels", "vectors", "sizes", "orders", "positives"]
    empty = F.lit(None).cast("binary")
    ours = index.select("*", F.lit(0).alias("kind"), empty.alias("labels"), F.lit(None).cast(given or "int").alias("positives")).select(columns)
    theirs = copies.select(
        "grp", F.lit(1).alias("kind"), F.col("block").alias("seq"), F.lit(0).cast("long").alias("label"), "n", "dim", "ids", "labels",
        "vectors", empty.alias("sizes"), empty.alias("orders"), (F.col("positives") if given else F.lit(None).cast("int")).alias("positives"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, buckets = None, []
        for batch in batches:
            out = []
            for at in range(batch.num_rows):
                row = {c: batch.column(c)[at].as_py() for c in ("grp", "kind", "seq", "label", "n", "dim")}
                if row["grp"] != group:
                    group, buckets = row["grp"], []
                if row["kind"] == 0:
                    buckets.append(_Bucket(row | {c: batch.column(c)[at].as_py() for c in ("ids", "sizes", "vectors", "orders")}))
                    continue
                if not buckets:
                    continue
                anchors = {
                    "ids": np.frombuffer(batch.column("ids")[at].as_py(), np.int64),
                    "labels": np.frombuffer(batch.column("labels")[at].as_py(), np.int64),
                    "vectors": np.frombuffer(batch.column("vectors")[at].as_py(), np.int32).reshape(row["n"], row["dim"]),
                }
                named, lists = wanted(anchors, batch.column("positives")[at].as_py())
                _search(buckets, anchors, lists, same, focus)
                for names, filled in zip(named, lists, strict=True):
                    for name, best in zip(names, filled, strict=True):
                        out += [(row["seq"], *name, s, i) for s, i in zip(best.scores.tolist(), best.ids.tolist(), strict=True)]
            columns = list(zip(*out, strict=True)) or [[]] * len(schema.split(","))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], [x.split()[0] for x in schema.split(", ")])

    both = ours.unionByName(theirs).repartition(parts, "grp").sortWithinPartitions("grp", "kind", "seq")
    return both.mapInArrow(run, schema)


def _first(df: DataFrame, keys: list[str], k: int, score: str, item: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc(item))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame,
    anchor: Column | None = None,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: float = 256.0,
    vector: str = "embedding",
    bucket_rows: int = 1024,
    pack: int = 16,
    block_rows: int = 512,
    focus: int = 4,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, label and ``vector``; ``anchor`` is a condition on ``id``, the
    vec_id (by default every hundredth). A negative's score lies from ``low`` to ``high``
    hundredths of the positive's, both included. ``bucket_rows`` is at most 65536."""
    rows = _quantised(vectors, scale, vector)
    is_anchor = (F.col("id") % 100 == 0) if anchor is None else anchor
    index = build_index(rows, bucket_rows, pack)
    blocks = _blocks(rows.where(is_anchor), block_rows)

    def five(anchors, _):
        n = len(anchors["ids"])
        return [[(i,)] for i in range(n)], [[_Best(positives, -np.inf, np.inf)] for _ in range(n)]

    found = _passes(index, blocks, five, True, focus, "block long, place long, score long, other long")
    best = _first(found, ["block", "place"], positives, "score", "other").dropDuplicates(["block", "place", "score", "other"])
    by_block = best.groupBy("block").agg(F.collect_list(F.struct("place", "other", "score")).alias("positives"))
    with_positives = written(unsized(blocks).join(by_block, "block"), "anchor-positives")
    given = "array<struct<place: long, other: long, score: long>>"

    def ten(anchors, pairs):
        names: list[list] = [[] for _ in anchors["ids"]]
        lists: list[list] = [[] for _ in anchors["ids"]]
        for p in pairs:
            # whole scores within the shares, by whole-number division
            least, most = -(-low * p["score"] // 100), high * p["score"] // 100
            if least <= most:
                names[p["place"]].append((int(anchors["ids"][p["place"]]), p["other"], p["score"]))
                lists[p["place"]].append(_Best(negatives, least, most))
        return names, lists

    schema = "block long, anchor_id long, positive_id long, positive_score long, negative_score long, negative_id long"
    near = _passes(index, with_positives, ten, False, focus, schema, given)
    ranked = _first(near, ["anchor_id", "positive_id", "positive_score"], negatives, "negative_score", "negative_id")
    return ranked.select("anchor_id", "positive_id", F.col("rank").cast("int"), "negative_id", "positive_score", "negative_score")
