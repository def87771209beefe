"""Prefix trie of conversations: z-fast tries in the tasks, merged by prefix hash.

A turn at depth d has a hash of (d, role, digest of the text), 128 bits in two longs; the
key of a prefix is the exclusive or of its turns' hashes. So keys need no order of work, a
conversation's own key is one aggregate, and equal keys mean equal prefixes.

A task builds a z-fast trie of its conversations: nodes are compacted (a node stands for
the depths from its parent's to its own), and a dictionary holds each node at its handle,
the prefix whose depth is the two-fattest number on the node's edge (the one divisible by
the highest power of two). Conversations are inserted in batches: equal ones once, each
located by fat binary search, which asks the dictionary for a logarithmic number of
prefixes and ends at the exit node; the edge there is split where the keys part. At the end
edges are expanded to one row for each depth, with sums over the subtree. What tasks have
found is merged by one aggregate over keys, so that a first turn which a third of all
conversations share comes as one row from each task.

The trie is built twice: with one for each conversation at its end (members, smallest
member), then with each node's savings and leaves at the place where its smallest member
passes (sums over subtrees). A conversation of over ``TIER`` turns is dealt as segments of
that many, each with the key before it, so that no task holds one whole.

Cases: rows without a conv_id take no part; a null role or text is empty; turns that are
equal in ``turn`` (null comes first) are ordered by role and by the digest of the text, and
repeated rows are turns of their own; a conversation without turns ends at the root; an
empty table has no nodes; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlog.llm.work import shuffle_parts, whole_groups, written
from emberlog.operators.ordered import with_position

#: Turns in a segment.
TIER = 4096
KEY = ["k1", "k2"]


def two_fattest(low: int, high: int) -> int:
    """The number in (low, high] that the highest power of two divides."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


class _Node:
    """Depths from above ``low``, the parent's, to ``high``; ``keys[d - a]`` for depth d."""

    __slots__ = ("high", "keys", "kids", "lens", "low", "parent")

    def __init__(self, parent, low, high, keys, lens):
        self.parent, self.low, self.high, self.keys, self.lens, self.kids = parent, low, high, keys, lens, {}


class ZFastTrie:
    """Strings of prefix keys below roots. A root stands at the depth ``a`` of its tier."""

    def __init__(self):
        self.handles: dict[bytes, _Node] = {}
        self.roots: dict[bytes, tuple[int, _Node]] = {}
        self.nodes: list[tuple[int, _Node]] = []
        self.size = 0

    def _hang(self, a: int, node: _Node) -> None:
        self.handles[node.keys[two_fattest(node.low, node.high) - a]] = node
        node.parent.kids[node.keys[node.low + 1 - a]] = node

    def locate(self, a: int, keys: list[bytes], start: _Node) -> tuple[_Node, _Node | None]:
        """By fat binary search: the deepest node found whose whole extent the string has,
        and the exit node if the string leaves or ends inside its edge beyond the handle."""
        end = a + len(keys) - 1
        found, low, high = start, start.high, end
        while low < high:
            fat = two_fattest(low, high)
            node = self.handles.get(keys[fat - a])
            if node is None:
                high = fat - 1
            elif node.high <= end and node.keys[node.high - a] == keys[node.high - a]:
                found, low = node, node.high
            else:
                return found, node
        return found, None

    def insert(self, a: int, keys: list[bytes], lens: list[int], start: _Node | None = None) -> None:
        """A string that begins with its root's key, at depth ``a``."""
        if keys[0] not in self.roots:
            self.roots[keys[0]] = (a, _Node(None, a, a, keys[:1], lens[:1]))
            self.nodes.append(self.roots[keys[0]])
        node, end = start or self.roots[keys[0]][1], a + len(keys) - 1
        while True:
            node, leaves = self.locate(a, keys, node)
            if leaves is None:
                if node.high == end:
                    return
                leaves = node.kids.get(keys[node.high + 1 - a])
                if leaves is None:
                    self._add(a, node, end, keys, lens)
                    return
            # the last depth at which the edge and the string agree
            low, high = leaves.low + 1, min(leaves.high, end)
            while low < high:
                middle = (low + high + 1) // 2
                if leaves.keys[middle - a] == keys[middle - a]:
                    low = middle
                else:
                    high = middle - 1
            if low == leaves.high:
                node = leaves
                continue
            del self.handles[leaves.keys[two_fattest(leaves.low, leaves.high) - a]]
            split = self._add(a, leaves.parent, low, leaves.keys, leaves.lens)
            leaves.parent, leaves.low = split, low
            self._hang(a, leaves)
            if low < end:
                self._add(a, split, end, keys, lens)
            return

    def _add(self, a, parent, high, keys, lens) -> _Node:
        node = _Node(parent, parent.high, high, keys, lens)
        self._hang(a, node)
        self.nodes.append((a, node))
        self.size += high - parent.high
        return node

    def insert_batch(self, strings: dict[bytes, tuple[int, list[bytes], list[int]]]) -> None:
        """Distinct strings by their last key: all are located first, each is then hung
        below the node that its search has found, which splits never move."""
        starts = {}
        for last, (a, keys, _) in strings.items():
            if keys[0] in self.roots:
                starts[last] = self.locate(a, keys, self.roots[keys[0]][1])[0]
        for last, (a, keys, lens) in strings.items():
            self.insert(a, keys, lens, starts.get(last))

    def expanded(self, laid: dict[bytes, tuple[int, int, int]]) -> Iterator[tuple]:
        """(key, parent's key, depth, chars, sums of what is ``laid`` on the subtree's keys:
        two sums and a minimum) for each depth of each edge, the children first. Roots
        beyond depth 0 are left to the tier above."""
        totals: dict[int, list] = {}
        for a, node in sorted(self.nodes, key=lambda n: -n[1].high):
            sums = totals.pop(id(node), None) or [0, 0, None]
            lowest = node.low if node.parent is not None else node.high - 1
            for depth in range(node.high, lowest, -1):
                key = node.keys[depth - a]
                if key in laid:
                    one, two, least = laid[key]
                    sums = [sums[0] + one, sums[1] + two, least if sums[2] is None else min(sums[2], least)]
                if depth == 0 or depth > a:
                    yield key, node.keys[depth - a - 1] if depth > a else None, depth, node.lens[depth - a], *sums
            if node.parent is not None:
                up = totals.setdefault(id(node.parent), [0, 0, None])
                up[0], up[1] = up[0] + sums[0], up[1] + sums[1]
                up[2] = sums[2] if up[2] is None else up[2] if sums[2] is None else min(up[2], sums[2])


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, position (from 1), n_turns, role, digest and n_chars of each turn."""
    text = F.coalesce("text", F.lit(""))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.md5(text).alias("digest"), F.length(text).cast("long").alias("n_chars"),
    )
    placed = with_position(turns, ["conv_id"], ["turn", "role", "digest"])
    return placed.select("conv_id", "position", F.col("position_total").alias("n_turns"), "role", "digest", "n_chars")


def rebuilt(turns: DataFrame, base_of: Column, shared: Column, most_shared: int) -> DataFrame:
    """Conversations whose first ``shared`` turns are those of another one, ``base_of``
    (both from conv_id, ``shared`` at most ``most_shared``). A row with depth 0 for each."""
    convs = turns.groupBy("conv_id").agg(F.max("n_turns").alias("n_turns"))
    convs = convs.select("conv_id", "n_turns", base_of.alias("base"), shared.cast("long").alias("shared"))
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n_turns").alias("base_turns"))
    convs = written(
        convs.join(bases, "base", "left").withColumn("taken", F.least("shared", F.coalesce("base_turns", F.lit(0)))), "conversations"
    )
    own = turns.drop("n_turns").join(convs.select("conv_id", "shared", "taken"), "conv_id").where("position > shared")
    own = own.select("conv_id", (F.col("taken") + F.col("position") - F.col("shared")).alias("depth"), "role", "digest", "n_chars")
    first = turns.where(F.col("position") <= most_shared).select(F.col("conv_id").alias("base"), "position", "role", "digest", "n_chars")
    lent = first.join(convs.select("conv_id", "base", "shared"), "base").where("position <= shared")
    lent = lent.select("conv_id", F.col("position").alias("depth"), "role", "digest", "n_chars")
    begin = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit("").alias("role"), F.lit("").alias("digest"), F.lit(0).cast("long").alias("n_chars"))
    return own.unionByName(lent).unionByName(begin)


def _segments(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns with their hashes and tiers; and with a row for the key before each tier."""
    hashed = lambda seed: F.when(F.col("depth") == 0, F.lit(0).cast("long")).otherwise(
        F.xxhash64(F.lit(seed), F.col("depth"), F.col("role"), F.col("digest"))
    )
    tier = F.when(F.col("depth") == 0, F.lit(0)).otherwise(F.floor((F.col("depth") - 1) / TIER)).cast("long")
    rows = written(
        turns.select("conv_id", tier.alias("tier"), "depth", hashed(1).alias("z1"), hashed(2).alias("z2"), "n_chars"), "turns"
    )
    longer = rows.where(F.col("depth") > TIER).select("conv_id").distinct()
    totals = rows.join(longer, "conv_id", "left_semi").groupBy("conv_id", "tier").agg(F.bit_xor("z1").alias("z1"), F.bit_xor("z2").alias("z2"))
    before = Window.partitionBy("conv_id").orderBy("tier").rowsBetween(Window.unboundedPreceding, -1)
    begin = totals.select("conv_id", "tier", *(F.bit_xor(z).over(before).alias(z) for z in ("z1", "z2"))).where("tier > 0")
    begin = begin.select("conv_id", "tier", (F.col("tier") * TIER).alias("depth"), "z1", "z2", F.lit(0).cast("long").alias("n_chars"))
    return rows, written(rows.unionByName(begin), "segments")


def _merged(segments: DataFrame, counted: bool, limit: int) -> DataFrame:
    """The nodes that the tasks' tries have, one row each. With ``counted`` each segment
    lays one and its conv_id on its end, else each row its ``one`` and ``two``."""
    schema = "k1 long, k2 long, p1 long, p2 long, depth long, n_chars long, one long, two long, least long"

    def rows_of(trie, laid):
        out = list(trie.expanded(laid))
        columns = list(zip(*out, strict=True)) or [[]] * 7
        none = b"\0" * 16
        keys, above = (np.frombuffer(b"".join(x or none for x in c), np.int64).reshape(-1, 2) for c in columns[:2])
        whole = [pa.array(columns[i], pa.int64()) for i in range(2, 7)]
        return pa.RecordBatch.from_arrays(
            [pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(above[:, 0]), pa.array(above[:, 1]), *whole],
            [x.split()[0] for x in schema.split(", ")],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, laid, ends = ZFastTrie(), {}, set()
        for table, starts in whole_groups(batches, ("conv_id", "tier"), rows=20_000):
            value = {c: table.column(c).to_numpy() for c in table.column_names}
            prefix = []
            for z in ("z1", "z2"):
                run_on = np.bitwise_xor.accumulate(value[z])
                before = np.where(starts[:-1] > 0, run_on[starts[:-1] - 1], 0)
                prefix.append(run_on ^ np.repeat(before, np.diff(starts)))
            keys = [x.tobytes() for x in np.stack(prefix, axis=1)]
            lens, tiers, convs = value["n_chars"].tolist(), value["tier"].tolist(), value["conv_id"].tolist()
            strings = {}
            for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                last = keys[b - 1]
                if last not in ends and last not in strings:
                    strings[last] = (tiers[a] * TIER, keys[a:b], lens[a:b])
                if counted:
                    one, two, least = laid.get(last, (0, 0, convs[a]))
                    laid[last] = (one + 1, two, min(least, convs[a]))
            if not counted:
                for at in np.flatnonzero((value["one"] != 0) | (value["two"] != 0)).tolist():
                    one, two, least = laid.get(keys[at], (0, 0, convs[at]))
                    laid[keys[at]] = (one + int(value["one"][at]), two + int(value["two"][at]), min(least, convs[at]))
            trie.insert_batch(strings)
            ends.update(strings)
            if trie.size > limit:
                yield rows_of(trie, laid)
                trie, laid, ends = ZFastTrie(), {}, set()
        yield rows_of(trie, laid)

    parts = shuffle_parts(segments.sparkSession)
    dealt = segments.repartition(parts, "conv_id", "tier").sortWithinPartitions("conv_id", "tier", "depth")
    found = dealt.mapInArrow(run, schema)
    return found.groupBy(*KEY).agg(
        F.max("depth").alias("depth"), F.max("n_chars").alias("n_chars"), F.max("p1").alias("p1"), F.max("p2").alias("p2"),
        F.sum("one").alias("one"), F.sum("two").alias("two"), F.min("least").alias("least"),
    )


def _end_digests(rows: DataFrame) -> DataFrame:
    """SHA-256 of the ids that end at a key, comma-joined in order: written out in pieces by
    ranges of ids, hashed piece after piece."""
    parts = shuffle_parts(rows.sparkSession)
    ends = rows.groupBy("conv_id").agg(F.bit_xor("z1").alias("k1"), F.bit_xor("z2").alias("k2"))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_or_cut(batches):
            k1, k2, ids = (table.column(c).to_numpy() for c in ("k1", "k2", "conv_id"))
            names = ids.astype(str).tolist()
            spans = list(zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True))
            first = starts[:-1]
            texts = [",".join(names[a:b]) for a, b in spans]
            yield pa.RecordBatch.from_arrays(
                [pa.array(k1[first]), pa.array(k2[first]), pa.array(ids[first]), pa.array(texts)], ["k1", "k2", "first_id", "ids"]
            )

    def whole_or_cut(batches):
        for batch in batches:
            if batch.num_rows:
                table = pa.Table.from_batches([batch])
                k1, k2 = (table.column(c).to_numpy() for c in KEY)
                new = np.flatnonzero((k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])) + 1
                yield table, np.concatenate(([0], new, [table.num_rows]))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("k1", "k2", "ids"))
            for k1, k2, ids in zip(*columns, strict=True):
                if (k1, k2) == key:
                    sha.update(b"," + ids.encode())
                else:
                    if key is not None:
                        out.append((*key, sha.hexdigest()))
                    key, sha = (k1, k2), hashlib.sha256(ids.encode())
            yield _digests(out)
        if key is not None:
            yield _digests([(*key, sha.hexdigest())])

    order = [*KEY, "conv_id"]
    cut = ends.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(pieces, "k1 long, k2 long, first_id long, ids string")
    dealt = cut.repartition(parts, *KEY).sortWithinPartitions(*KEY, "first_id")
    return dealt.mapInArrow(hashed, "k1 long, k2 long, ends_sha256 string")


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    k1, k2, sha = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(sha, pa.string())], [*KEY, "ends_sha256"])


def _laid(segments: DataFrame, known: DataFrame) -> DataFrame:
    """The segments with each node's savings and leaf on the row where its smallest member
    passes; what lies in later tiers of a conversation is added at the end of each tier."""
    own = known.select(
        "conv_id", "depth", F.col("own_saved").alias("one"), (F.col("n_children") == 0).cast("long").alias("two")
    )
    # a tier's begin repeats the last depth of the tier before, where the node itself lies
    begin = (F.col("depth") > 0) & (F.col("depth") == F.col("tier") * TIER)
    rows = segments.join(own, ["conv_id", "depth"], "left")
    none = lambda c: F.when(begin, F.lit(0)).otherwise(F.coalesce(c, F.lit(0))).cast("long").alias(c)
    rows = rows.select("conv_id", "tier", "depth", "z1", "z2", "n_chars", none("one"), none("two"))
    longer = segments.where("tier > 0").select("conv_id").distinct()
    later = rows.join(longer, "conv_id", "left_semi").groupBy("conv_id", "tier").agg(F.sum("one").alias("one"), F.sum("two").alias("two"))
    after = Window.partitionBy("conv_id").orderBy(F.desc("tier")).rowsBetween(Window.unboundedPreceding, -1)
    later = later.select("conv_id", "tier", *(F.sum(c).over(after).alias(c) for c in ("one", "two"))).where("one IS NOT NULL")
    later = later.select("conv_id", "tier", ((F.col("tier") + 1) * TIER).alias("depth"), F.col("one").alias("more_one"), F.col("two").alias("more_two"))
    both = rows.join(later, ["conv_id", "tier", "depth"], "left")
    return both.select(
        "conv_id", "tier", "depth", "z1", "z2", "n_chars",
        (F.col("one") + F.coalesce("more_one", F.lit(0))).alias("one"), (F.col("two") + F.coalesce("more_two", F.lit(0))).alias("two"),
    )


def prefix_nodes(turns: DataFrame, limit: int = 300_000) -> DataFrame:
    """One row for each node of the trie of ``turns`` (conv_id, depth, role, digest, n_chars,
    with a row of depth 0 for each conversation, as ``rebuilt`` gives them). ``limit`` is the
    number of nodes that a task holds before it hands them on."""
    rows, segments = _segments(turns)
    nodes = written(_merged(segments, True, limit), "trie-nodes")
    kids = nodes.where("depth > 0").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count(F.lit(1)).alias("n_children"))
    known = nodes.join(kids, KEY, "left").select(
        *KEY, "p1", "p2", "depth", F.col("least").alias("conv_id"), F.col("one").alias("n_convs"),
        F.coalesce("n_children", F.lit(0)).alias("n_children"), ((F.col("one") - 1) * F.col("n_chars")).alias("own_saved"),
    )
    known = written(known, "trie-known")
    sums = _merged(_laid(segments, known), False, limit).select(*KEY, F.col("one").alias("saved_tokens"), F.col("two").alias("n_leaves"))
    above = known.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    out = known.join(sums, KEY).join(_end_digests(rows), KEY, "left")
    top, rest = out.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long")), out.where("depth > 0").join(above, ["p1", "p2"])
    return rest.unionByName(top).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
