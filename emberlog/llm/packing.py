"""Vector bin packing of examples into training sequences.

Each task packs the examples of its own input split, so no text or id is shuffled. Whole
sequences are cut off long examples first. What is left of each example waits in a pool
(``window`` examples at most); a sequence is filled by taking, again and again, the example
with the largest dot product of its demands and the room left, both as shares of the limits
on tokens, segments and loss-bearing tokens, among those that fit. When none fits, the next
largest is cut to fill the gap, unless the gap is under ``min_piece``. The last, partly
filled sequence of a task is cut into power-of-two sequences, which need no padding.

Cases: a null or empty text is the end id alone; examples with the same id are packed
separately; an empty table gives no rows; other input columns are not read, but for
``prompt_column`` if given (leading ids without loss; null counts as 0).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm.work import lean, small

from emberlog.llm.encoding import encoder, parts

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, loss_tokens long"
)


class _Item:
    __slots__ = ("at", "doc_id", "ids", "prompt")

    def __init__(self, doc_id, ids, prompt):
        self.doc_id, self.ids, self.prompt, self.at = doc_id, ids, prompt, 0

    def left(self) -> int:
        return len(self.ids) - self.at

    def loss(self, length: int) -> int:
        """Loss-bearing ids among the next ``length``: not the prompt's, not the end id."""
        last = min(self.at + length, len(self.ids) - 1)
        return max(0, last - max(self.at, self.prompt))

    def fitting(self, tokens: int, loss: int) -> int:
        """Most ids from here within both limits."""
        length = min(tokens, self.left())
        over = self.loss(length) - loss
        return length if over <= 0 else max(self.at, self.prompt) + loss - self.at


class _Packer:
    def __init__(self, first_id: int, tokens: int, segments: int, loss: int, min_piece: int, window: int, keep_ids: bool):
        self.limits = np.array([tokens, segments, loss], np.float64)
        self.min_piece, self.window, self.keep_ids = min_piece, window, keep_ids
        self.sequence, self.pool, self.rows = first_id, [], []

    def _piece(self, item: _Item, length: int, offset: int) -> None:
        ids = item.ids[item.at : item.at + length]
        row = (
            item.doc_id, item.at, length, zlib.crc32(ids.astype("<u4").tobytes()), len(item.ids),
            self.sequence, offset, item.loss(length),
        )
        self.rows.append((*row, ids.astype(np.int32)) if self.keep_ids else row)
        item.at += length

    def add(self, item: _Item) -> None:
        tokens, _, loss = map(int, self.limits)
        while item.left() >= tokens and item.fitting(tokens, loss) == tokens:
            self._piece(item, tokens, 0)
            self.sequence += 1
        if item.left():
            self.pool.append(item)
            if len(self.pool) >= self.window:
                self.pack(self.window // 2)

    def pack(self, until: int) -> None:
        """Fill sequences until the pool has at most ``until`` examples."""
        pool = self.pool
        need = np.array([(x.left(), 1, x.loss(x.left())) for x in pool], np.float64).reshape(-1, 3)
        there = np.ones(len(pool), bool)
        scaled = need / self.limits
        left = len(pool)
        while left > until:
            room, fill, chosen = self.limits.copy(), 0, []
            while room[0] > 0 and room[1] > 0:
                fits = there & (need <= room).all(1)
                if fits.any():
                    score = np.where(fits, scaled @ (room / self.limits), -1.0)
                    i = int(score.argmax())
                    length = int(need[i, 0])
                else:
                    if room[0] < self.min_piece or not there.any():
                        break
                    i = int(np.where(there, need[:, 0], -1.0).argmax())
                    length = pool[i].fitting(int(room[0]), int(room[2]))
                    if length < self.min_piece:
                        break
                chosen.append((i, pool[i].at, length))
                room -= (length, 1, pool[i].loss(length))
                if length == pool[i].left():
                    there[i], left = False, left - 1
                    pool[i].at += length
                else:
                    pool[i].at += length
                    need[i] = (pool[i].left(), 1, pool[i].loss(pool[i].left()))
                    scaled[i] = need[i] / self.limits
                fill += length
            if not chosen:
                raise ValueError("no example fits into an empty sequence")
            last = left == 0 and fill < self.limits[0]
            self._write([(pool[i], at, length) for i, at, length in chosen], fill, last)
        self.pool = [x for x, here in zip(pool, there, strict=True) if here]

    def _write(self, chosen: list, fill: int, last: bool) -> None:
        """One sequence, or for the last one, sequences of powers of two."""
        ends = [1 << b for b in range(fill.bit_length() - 1, -1, -1) if fill >> b & 1] if last else [fill]
        room, offset = ends.pop(0), 0
        for item, at, length in chosen:
            after, item.at = item.at, at
            while length:
                take = min(length, room)
                self._piece(item, take, offset)
                length, room, offset = length - take, room - take, offset + take
                if not room:
                    self.sequence += 1
                    room, offset = (ends.pop(0) if ends else 0), 0
            item.at = after

    def taken(self) -> list:
        rows, self.rows = self.rows, []
        return rows


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    max_tokens: int = 1024,
    max_segments: int = 128,
    max_loss: int = 1024,
    min_piece: int = 8,
    window: int = 2048,
    prompt_column: str | None = None,
    keep_ids: bool = False,
) -> DataFrame:
    """One row for each piece. Sequence ids are unique, with gaps between tasks; with
    ``keep_ids`` a column ``ids`` holds each piece's ids. Documents are cut freely."""
    if max_tokens < 1 or max_segments < 1 or max_loss < 1:
        raise ValueError("limits must be positive")
    prompt = F.coalesce(F.col(prompt_column).cast("long"), F.lit(0)) if prompt_column else F.lit(0).cast("long")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), prompt.alias("prompt")
    )
    schema = SCHEMA + (", ids array<int>" if keep_ids else "")
    kinds = [pa.int64()] * 8 + ([pa.list_(pa.int32())] if keep_ids else [])
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer)
        packer = _Packer(
            TaskContext.get().partitionId() << 40, max_tokens, max_segments, max_loss, min_piece, window, keep_ids
        )

        def made():
            columns = list(zip(*packer.taken(), strict=True)) or [[] for _ in kinds]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in small(batches):
            ids, texts, prompts = batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("prompt").to_pylist()
            for first, last in parts(texts):
                found, ends = words.encode(texts.slice(first, last - first))
                for at, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True), first):
                    packer.add(_Item(ids[at], np.append(found[a:b], found.dtype.type(end_id)), prompts[at]))
                yield made()
        packer.pack(0)
        yield made()

    return rows.mapInArrow(lean(run), schema)
