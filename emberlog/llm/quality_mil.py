"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of 64 words, all of them encoded. A passage's vector has
shares of character kinds, word lengths, repetition, and a hashed histogram of word shapes
(runs of letters, capitals, digits and single marks). Hidden vectors of the passages get
gated attention weights, softmax over w . (tanh(V h) * sigmoid(U h)); the weighted sum of
the hidden vectors is scored by a logistic unit. Only document labels are needed.

The model is fitted in numpy on at most ``max_bags`` labelled documents (a documented bound
of the sample, drawn by hash) and scores every document in one Arrow pass.

Cases: a null or empty text is one passage without words and is scored like any other; null
ids are scored; labels that are null, or two different ones for an id, are left out, and
rows that share an id train as one bag each; with no label, or of one kind only, every score
is the share of label 1 (0.5 if none); empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.llm.work import lean, small

PASSAGE, LEAST, SHAPES = 64, 16, 64
FEATURES = 16 + SHAPES
SPACE, LOWER, UPPER, DIGIT, MARK, SYMBOL = range(6)
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _kinds() -> np.ndarray:
    out = np.full(0x110000, SYMBOL, np.uint8)
    for code in range(0x30000):
        c = chr(code)
        if c.isspace():
            out[code] = SPACE
        elif c.isupper():
            out[code] = UPPER
        elif c.isalpha():
            out[code] = LOWER
        elif c.isdigit():
            out[code] = DIGIT
    for c in ".,;:!?'\"()-’“”¿¡…":
        out[ord(c)] = MARK
    return out


_tables: dict[str, np.ndarray] = {}


def _powers(n: int, base: np.uint64, name: str) -> np.ndarray:
    if len(_tables.get(name, ())) < n:
        grown = np.full(max(n, 1 << 16), base, np.uint64)
        grown[0] = 1
        _tables[name] = np.multiply.accumulate(grown)
    return _tables[name][:n]


def _hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of each run values[start:end], from one running sum."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * _powers(len(values), MULTIPLIER, "up"))))
    return (sums[ends] - sums[starts]) * _powers(len(values) + 1, INVERSE, "down")[starts]


def passages(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of all passages of all texts, and the number of passages of each text."""
    if "kinds" not in _tables:
        _tables["kinds"] = _kinds()
    sizes = np.array([len(x) + 1 for x in texts])
    code = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _tables["kinds"][code]
    edge = np.diff((kind != SPACE).astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    doc = np.searchsorted(np.cumsum(sizes), starts, "right")
    n_words = np.bincount(doc, minlength=len(texts))
    n_passages = np.maximum(1, (n_words + PASSAGE - LEAST) // PASSAGE)
    first = np.cumsum(n_passages) - n_passages
    place = np.arange(len(starts)) - (np.cumsum(n_words) - n_words)[doc]
    passage = first[doc] + np.minimum(place // PASSAGE, n_passages[doc] - 1)
    total = int(n_passages.sum())
    out = np.zeros((total, FEATURES), np.float32)
    if not len(starts):
        return out, n_passages

    def within(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate((np.zeros(1, np.int32), np.cumsum(flags, dtype=np.int32)))
        return sums[ends] - sums[starts]

    length = ends - starts
    of_kind = {k: within(kind == k) for k in (UPPER, DIGIT, MARK, SYMBOL)}
    letters = length - of_kind[DIGIT] - of_kind[MARK] - of_kind[SYMBOL]
    word = _hashes(code.astype(np.uint64), starts, ends)
    # runs of one kind count once in a shape; marks and symbols stand for themselves
    shown = np.where(kind >= MARK, code, kind).astype(np.uint64)
    new = np.append(True, shown[1:] != shown[:-1])
    run = np.cumsum(new) - 1
    shape = _hashes(shown[new] + np.uint64(1), run[starts], run[ends - 1] + 1)
    bucket = ((shape * MULTIPLIER) >> np.uint64(58)).astype(np.int64)
    add = lambda values: np.bincount(passage, values, minlength=total)
    n, chars = np.maximum(add(None), 1), np.maximum(add(length), 1)
    order = np.lexsort((word, passage))
    fresh = np.append(True, (word[order][1:] != word[order][:-1]) | (passage[order][1:] != passage[order][:-1]))
    again = np.append(False, (word[1:] == word[:-1]) & (passage[1:] == passage[:-1]))
    last = code[ends - 1]
    columns = (
        np.log1p(add(None)), add(length) / n, np.sqrt(np.maximum(add(length * length) / n - (add(length) / n) ** 2, 0)),
        add(of_kind[UPPER]) / chars, add(of_kind[DIGIT]) / chars, add(of_kind[MARK]) / chars, add(of_kind[SYMBOL]) / chars,
        add(letters) / chars, add(fresh[np.argsort(order)]) / n, add(again) / n,
        add((of_kind[UPPER] == letters) & (letters > 1)) / n, add(of_kind[SYMBOL] > 0) / n,
        add(np.isin(last, [ord(c) for c in ".!?"])) / n, add(kind[starts] == UPPER) / n, add(letters == 0) / n,
        add(code[np.maximum(starts, 1) - 1] == 10) / n,
    )
    out[:, :16] = np.stack(columns, 1)
    histogram = np.bincount(passage * SHAPES + bucket, minlength=total * SHAPES).reshape(total, SHAPES)
    out[:, 16:] = np.sqrt(histogram / n[:, None])
    return out, n_passages


class GatedAttention:
    """The network; ``params`` in the order of ``_start``."""

    def __init__(self, mean, spread, params, constant: float | None = None):
        self.mean, self.spread, self.params, self.constant = mean, spread, params, constant

    @staticmethod
    def _start(rng, hidden: int, gate: int) -> list[np.ndarray]:
        draw = lambda a, b: (rng.standard_normal((a, b)) / np.sqrt(a)).astype(np.float32)
        zero = lambda n: np.zeros(n, np.float32)
        return [draw(FEATURES, hidden), zero(hidden), draw(hidden, gate), zero(gate), draw(hidden, gate), zero(gate),
                draw(gate, 1)[:, 0], draw(hidden, 1)[:, 0], zero(1)]

    def _forward(self, x: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        w, b, v, vb, u, ub, a, c, c0 = self.params
        h = np.tanh(x @ w + b)
        t, s = np.tanh(h @ v + vb), 1 / (1 + np.exp(-(h @ u + ub)))
        e = (t * s) @ a
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), sizes))
        weight = e / np.repeat(np.add.reduceat(e, starts), sizes)
        bag = np.add.reduceat(h * weight[:, None], starts)
        score = 1 / (1 + np.exp(-np.clip(bag @ c + c0, -30, 30)))
        return h, t, s, weight, bag, score

    def _gradients(self, x, starts, sizes, y):
        w, _, v, _, u, _, a, c, _ = self.params
        h, t, s, weight, bag, score = self._forward(x, starts, sizes)
        error = (score - y) / len(y)
        to_bag = np.repeat(error, sizes)[:, None] * c
        pull = (h * to_bag).sum(1)
        to_e = weight * (pull - np.repeat(np.add.reduceat(weight * pull, starts), sizes))
        to_gate = to_e[:, None] * a
        to_t, to_s = to_gate * s * (1 - t * t), to_gate * t * s * (1 - s)
        to_h = (weight[:, None] * to_bag + to_t @ v.T + to_s @ u.T) * (1 - h * h)
        return [x.T @ to_h, to_h.sum(0), h.T @ to_t, to_t.sum(0), h.T @ to_s, to_s.sum(0), (t * s).T @ to_e,
                bag.T @ error, np.array([error.sum()])]

    @classmethod
    def fit(cls, x, sizes, y, epochs=16, batch=128, rate=3e-3, decay=1e-4, hidden=32, gate=16, seed=7) -> GatedAttention:
        share = float(y.mean()) if len(y) else 0.5
        if share in (0.0, 1.0) or not len(y):
            return cls(None, None, None, share)
        mean, spread = x.mean(0), x.std(0)
        spread = np.where(spread > 1e-6, spread, 1).astype(np.float32)
        rng = np.random.default_rng(seed)
        model = cls(mean, spread, cls._start(rng, hidden, gate))
        x = np.clip((x - mean) / spread, -6, 6).astype(np.float32)
        first = np.cumsum(sizes) - sizes
        slow = [np.zeros_like(p) for p in model.params]
        fast = [np.zeros_like(p) for p in model.params]
        step, steps = 0, epochs * -(-len(y) // batch)
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for at in range(0, len(y), batch):
                chosen = order[at : at + batch]
                n = sizes[chosen]
                starts = np.cumsum(n) - n
                rows = np.repeat(first[chosen] - starts, n) + np.arange(n.sum())
                step += 1
                now = rate * 0.5 * (1 + np.cos(np.pi * step / steps))
                for p, m, q, g in zip(model.params, slow, fast, model._gradients(x[rows], starts, n, y[chosen]), strict=True):
                    m += 0.1 * (g - m)
                    q += 0.001 * (g * g - q)
                    p -= now * (m / (1 - 0.9**step) / (np.sqrt(q / (1 - 0.999**step)) + 1e-8) + decay * p)
        return model

    def score(self, x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(sizes), self.constant)
        starts = np.cumsum(sizes) - sizes
        scaled = np.clip((x - self.mean) / self.spread, -6, 6).astype(np.float32)
        return self._forward(scaled, starts, sizes)[-1].astype(np.float64)


def held_out(doc_id: str = "doc_id") -> Column:
    """The fifth of the ids whose labels are never learned; null ids belong to it."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _chunks(batch: pa.RecordBatch, most: int = 1 << 19):
    at = 0
    for part in small([batch], "text", most):
        yield at, part.column("text").to_pylist()
        at += part.num_rows


def _texts(docs: DataFrame, *more: Column) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *more)


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", max_bags: int = 12_000) -> GatedAttention:
    """Learns from labels outside the held-out fifth."""
    given = labels.where(F.col(label).isNotNull() & ~held_out()).groupBy(F.col("doc_id").cast("long").alias("labelled"))
    given = given.agg(F.min(label).alias("y"), F.max(label).alias("y_max")).where("y = y_max")
    given = given.orderBy(F.xxhash64("labelled"), "labelled").limit(max_bags).select("labelled", F.col("y").cast("double").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ys = batch.column("y").to_numpy()
            for at, texts in _chunks(batch):
                x, sizes = passages(texts)
                ends = np.append(0, np.cumsum(sizes))
                raw = [x[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(texts)), pa.array(ys[at : at + len(texts)]), pa.array(raw, pa.binary())],
                    ["doc_id", "y", "x"],
                )

    rows = docs.join(F.broadcast(given), F.col("doc_id").cast("long") == F.col("labelled"))
    bags = _texts(rows, F.col("y")).mapInArrow(lean(run), "doc_id long, y double, x binary").toArrow().sort_by("doc_id")
    x = np.frombuffer(b"".join(bags.column("x").to_pylist()), np.float32).reshape(-1, FEATURES)
    sizes = np.array([len(v) // (4 * FEATURES) for v in bags.column("x").to_pylist()], np.int64)
    return GatedAttention.fit(x, sizes, bags.column("y").to_numpy())


def score_quality(docs: DataFrame, model: GatedAttention) -> DataFrame:
    """doc_id, held_out, score of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in _chunks(batch):
                scores = np.clip(model.score(*passages(texts)), 0.0, 1.0)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(texts)), pa.array(scores)], ["doc_id", "score"])

    return _texts(docs).mapInArrow(lean(run), "doc_id long, score double").select("doc_id", held_out().alias("held_out"), "score")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, all columns as they are."""
    model = fit_quality(docs, labels)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.RecordBatch.from_arrays([batch.column(names.index("text")).fill_null("")], ["text"])
            scores = [model.score(*passages(x)) for _, x in _chunks(texts)]
            if scores:
                yield batch.filter(pa.array(np.concatenate(scores) >= threshold))

    return docs.mapInArrow(lean(run), docs.schema)
