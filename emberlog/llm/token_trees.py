"""Token counts that follow edits: a segment tree of pre-token runs for each document.

A leaf is a run of whole pre-tokens, about ``leaf_chars`` code points long, that ends where
a single space stands between two other characters: the tokenizer's first split always
cuts there, whatever lies around it, so leaves are counted on their own and a document's
count is the sum. The sums above the leaves are kept level by level (``tree``, the leaf
counts first, then sums of pairs, and so on to the total).

An edit replaces code points. Only the leaves that it touches are counted anew, widened by
whole leaves until both ends lie on such a boundary in the new text too; counts of all
other leaves stay. Where the number of leaves is unchanged, only the sums on the paths from
changed leaves to the root are redone; otherwise the levels are summed anew, which takes no
tokenizer.

Cases: a null text is empty (no leaf, count 0); null or empty edits change nothing; a null
position or length in an edit counts as 0, a null insert as empty; positions beyond the end
are the end; edits of a document refer to its text before all of them and are applied from
the last to the first (overlapping ones see what later ones left); repeated rows are
handled one by one; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm.encoding import SPACE, encoder, parts

EDITS = "array<struct<start: long, n_deleted: long, inserted: string>>"
STATE = "doc_id long, text string, leaf_chars array<int>, tree array<long>, n_tokens long"
#: A space between two characters that are no white space.
BOUNDARY = re.compile(f"(?<=[^{SPACE}]) (?=[^{SPACE}])")


def cut(text: str, leaf_chars: int) -> list[str]:
    """Leaves of a text: each ends at the first boundary from ``leaf_chars`` on."""
    leaves, at = [], 0
    while at < len(text):
        found = BOUNDARY.search(text, at + leaf_chars)
        end = found.start() if found else len(text)
        leaves.append(text[at:end])
        at = end
    return leaves


def summed(counts: list[int]) -> list[int]:
    """The leaf counts, then sums of pairs level by level, to the total."""
    tree, level = list(counts), list(counts)
    while len(level) > 1:
        level = [sum(level[i : i + 2]) for i in range(0, len(level), 2)]
        tree += level
    return tree


def _redone(tree: list[int], n_leaves: int, first: int, counts: list[int]) -> list[int]:
    """The tree with new counts of the leaves from ``first`` on: their paths only."""
    tree[first : first + len(counts)] = counts
    base, size, low, high = 0, n_leaves, first, first + len(counts)
    while size > 1:
        above, low, high = base + size, low // 2, (high + 1) // 2
        for node in range(low, high):
            tree[above + node] = sum(tree[base + 2 * node : base + min(2 * node + 2, size)])
        base, size = above, (size + 1) // 2
    return tree


class Edited:
    """A document's text, leaf sizes and tree while edits are applied one after another. An
    edit is begun here and gives the leaves to count; their counts end it."""

    __slots__ = ("leaf_chars", "pending", "recounted", "sizes", "text", "tree")

    def __init__(self, text: str, sizes: list[int], tree: list[int], leaf_chars: int):
        self.text, self.sizes, self.tree, self.leaf_chars = text, sizes, tree, leaf_chars
        self.recounted, self.pending = 0, None

    def begin(self, start: int, n_deleted: int, inserted: str) -> list[str]:
        """The new text, and the leaves of its changed stretch."""
        text = self.text
        start = min(max(start, 0), len(text))
        end = min(start + max(n_deleted, 0), len(text))
        new = text[:start] + inserted + text[end:]
        grown = len(new) - len(text)
        places = list(accumulate(self.sizes, initial=0))
        n = len(self.sizes)
        # the leaves touched, with those that meet the edit at its ends
        first = min(max(bisect_left(places, start) - 1, 0), n)
        last = min(bisect_right(places, end), n)
        # widen until both ends are boundaries of the new text
        while first > 0 and not BOUNDARY.match(new, places[first]):
            first -= 1
        while last < n and not BOUNDARY.match(new, places[last] + grown):
            last += 1
        begin, stop = places[first], places[last] + grown
        leaves = cut(new[begin:stop], self.leaf_chars)
        self.text, self.pending = new, (first, last, [len(x) for x in leaves])
        self.recounted += stop - begin
        return leaves

    def end(self, counts: list[int]) -> None:
        first, last, sizes = self.pending
        n = len(self.sizes)
        self.sizes = self.sizes[:first] + sizes + self.sizes[last:]
        if len(counts) == last - first:
            self.tree = _redone(self.tree, n, first, counts)
        else:
            self.tree = summed(self.tree[:first] + counts + self.tree[last:n])


def _counter(tokenizer: str):
    words = encoder(tokenizer)
    return lambda leaves: words.counts(pa.array(leaves, pa.string())).tolist() if leaves else []


def build_trees(docs: DataFrame, tokenizer: str, leaf_chars: int = 512) -> DataFrame:
    """doc_id, text, leaf_chars (sizes of the leaves), tree and n_tokens of each document.
    Columns named in ``STATE`` or ``edits`` of the input are not kept, but for doc_id, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(tokenizer)
        for batch in batches:
            texts = batch.column("text")
            for first, last in parts(texts):
                split = [cut(x, leaf_chars) for x in texts.slice(first, last - first).to_pylist()]
                flat, at, trees = count([x for leaves in split for x in leaves]), 0, []
                for leaves in split:
                    trees.append(summed(flat[at : at + len(leaves)]))
                    at += len(leaves)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, last - first),
                        batch.column("text").slice(first, last - first),
                        pa.array([[len(x) for x in leaves] for leaves in split], pa.list_(pa.int32())),
                        pa.array(trees, pa.list_(pa.int64())),
                        pa.array([x[-1] if x else 0 for x in trees], pa.int64()),
                    ],
                    ["doc_id", "text", "leaf_chars", "tree", "n_tokens"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, STATE)


def gather_edits(state: DataFrame, edits: DataFrame) -> DataFrame:
    """Adds to each tree its edits from a table (doc_id, start, n_deleted, inserted). A
    document's edits are held together, as they must be applied in order."""
    by_doc = edits.groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct(*(F.col(c) for c in ("start", "n_deleted", "inserted"))))).alias("edits")
    )
    return state.join(by_doc, "doc_id", "left")


def apply_edits(state: DataFrame, tokenizer: str, leaf_chars: int = 512) -> DataFrame:
    """The trees after ``edits`` (type ``EDITS``), with the count before them, the code
    points that were counted anew and the number of edits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(tokenizer)
        for batch in batches:
            for first, last in parts(batch.column("text")):
                yield changed(batch.slice(first, last - first), count)

    def changed(batch: pa.RecordBatch, count) -> pa.RecordBatch:
        """A round for the k-th edits of all documents: their leaves are counted together."""
        held = [batch.column(c).to_pylist() for c in ("text", "leaf_chars", "tree", "edits")]
        docs = [Edited(text, sizes, tree, leaf_chars) for text, sizes, tree, _ in zip(*held, strict=True)]
        before = [d.tree[-1] if d.tree else 0 for d in docs]
        todo = [
            sorted(((x["start"] or 0, x["n_deleted"] or 0, x["inserted"] or "") for x in edits or [] if x), reverse=True)
            for edits in held[3]
        ]
        for k in range(max(map(len, todo), default=0)):
            now = [(d, d.begin(*edits[k])) for d, edits in zip(docs, todo, strict=True) if k < len(edits)]
            counts = count([x for _, leaves in now for x in leaves])
            at = 0
            for d, leaves in now:
                d.end(counts[at : at + len(leaves)])
                at += len(leaves)
        columns = [
            batch.column("doc_id").to_pylist(), [d.text for d in docs], [d.sizes for d in docs], [d.tree for d in docs],
            [d.tree[-1] if d.tree else 0 for d in docs], before, [d.recounted for d in docs], [len(x) for x in todo],
        ]
        kinds = [pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int64()), *[pa.int64()] * 4]
        names = ["doc_id", "text", "leaf_chars", "tree", "n_tokens", "tokens_before", "recounted_chars", "n_edits"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    columns = [F.col(c) for c in ("doc_id", "text", "leaf_chars", "tree")]
    return state.select(*columns, F.col("edits").cast(EDITS).alias("edits")).mapInArrow(
        run, STATE + ", tokens_before long, recounted_chars long, n_edits long"
    )
