"""SimHash near-duplicates: banded buckets, bit-sliced comparison inside them, components.

Fingerprints are collapsed first, so copies cost one row. 64 bits are cut into ``blocks``
pieces; two fingerprints within ``radius`` differing bits agree on at least
``blocks - radius`` whole pieces, so each choice of that many pieces is a table of buckets
and no link is missed. Buckets of more than ``cell_rows`` fingerprints are dealt out as
cells, one for each pair of their chunks, to different tasks.

In a cell 64 fingerprints share a machine word for each bit position (a bit plane). A
fingerprint is compared with 64 others at once: plane by plane, the differing lanes are
added to bitwise counters by carry-save addition, and after every few planes the words
whose lanes have all passed the radius are dropped. Found links are joined inside the cell
and leave it as a star, at most one row for each fingerprint.

Cases: a null or empty text, or one of white space, has fingerprint zero and is linked like
any other; a null id gets its fingerprint and a null component and joins nothing; rows that
share an id each give a row; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm.components import components
from emberlog.llm.jaccard import cells, jaccard_edges
from emberlog.llm.work import join_labels, lean, small, whole_groups, written

SEED = 42
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """XXH64 of each run of ``size`` words (of all words, if fewer), repeats included."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = np.concatenate(([0], gaps + 1))
    ends = np.append(gaps, len(joined))
    size = min(size, len(words))
    spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)
    hashed = xxhash.xxh64_intdigest
    return np.array([hashed(joined[a:b], SEED) for a, b in spans], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half the hashes; zero for none."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at : at + 4096]
        counts += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int32)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view(np.uint64)[0])


def _second(hashes: np.ndarray) -> np.ndarray:
    """Other 64 bits for each hash."""
    mixed = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)


def fingerprints(docs: DataFrame, size: int = 4, wide: bool = False) -> DataFrame:
    """doc_id and fp, the fingerprint's bits as a signed long; ``wide`` takes
    distinct shingles, as Jaccard does, and adds fp2, 64 more."""
    names = ["doc_id", "fp", "fp2"] if wide else ["doc_id", "fp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            found = [shingle_hashes(x, size) for x in batch.column("text").to_pylist()]
            found = [np.unique(h) for h in found] if wide else found
            columns = [np.array([majority(h) for h in found], np.uint64).view(np.int64)]
            if wide:
                columns.append(np.array([majority(_second(h)) for h in found], np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, columns)], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(lean(run), ", ".join(f"{n} long" for n in names))


def _buckets(blocks: int, radius: int) -> F.Column:
    """Struct (tab, key) for each choice of pieces."""
    sizes = [64 // blocks + (i < 64 % blocks) for i in range(blocks)]
    offsets = [sum(sizes[:i]) for i in range(blocks)]
    out = []
    for number, chosen in enumerate(itertools.combinations(range(blocks), blocks - radius)):
        key = F.lit(0).cast("long")
        for i in chosen:
            piece = F.shiftrightunsigned("fp", offsets[i]).bitwiseAND(F.lit((1 << sizes[i]) - 1).cast("long"))
            key = F.shiftleft(key, sizes[i]).bitwiseOR(piece)
        out.append(F.struct(F.lit(number).alias("tab"), key.alias("key")))
    return F.array(*out)


def planes_of(fps: np.ndarray) -> np.ndarray:
    """(words, 64): word w of plane p has bit p of fingerprints 64 w .. 64 w + 63."""
    padded = np.zeros(-(-len(fps) // 64) * 64, np.uint64)
    padded[: len(fps)] = fps
    out = np.empty((len(padded) // 64, 64), np.uint64)
    for at in range(0, len(out), 4096):
        part = padded[at * 64 : (at + 4096) * 64]
        bits = np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, 64, 64)
        turned = np.packbits(bits.transpose(0, 2, 1), axis=2, bitorder="little")
        out[at : at + 4096] = np.ascontiguousarray(turned).view(np.uint64)[:, :, 0]
    return out


def _beyond(counters: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose bitwise count is over the radius."""
    over, equal = over.copy(), np.full_like(over, FULL)
    for level in range(len(counters) - 1, -1, -1):
        if radius >> level & 1:
            equal &= counters[level]
        else:
            over |= equal & counters[level]
            equal &= ~counters[level]
    return over


def close_pairs(
    fps: np.ndarray, low: np.ndarray, high: np.ndarray, radius: int, block: int = 1 << 13, labels: np.ndarray | None = None
):
    """Yields (row, other) arrays: every other row in [low, high) of a row within the radius.
    ``fps`` has a row of 64-bit words for each fingerprint (or one word each). The first
    words of all rows are compared first, then the second ones, and so on. With ``labels``,
    which the caller keeps up to date, words whose rows all have the row's label already are
    passed over: a tight group costs about one word for each row instead of all pairs."""
    fps = fps.reshape(len(low), -1)
    planes = np.concatenate([planes_of(fps[:, w]) for w in range(fps.shape[1])], 1)
    first, last = low // 64, np.where(high > low, (high - 1) // 64 + 1, low // 64)
    n_words = last - first
    most = int(n_words.max()) if len(n_words) else 0
    padded = np.arange(len(planes) * 64) if labels is not None else None
    for turn, at in ((k, at) for k in range(most) for at in range(0, len(low), block)):
        row = at + np.flatnonzero(n_words[at : at + block] > turn)
        word = first[row] + turn
        if labels is not None and len(row):
            padded[: len(labels)] = labels
            lanes = padded.reshape(-1, 64)
            least = lanes.min(1)
            even = least == lanes.max(1)
            needed = ~(even[word] & (least[word] == labels[row]))
            row, word = row[needed], word[needed]
        if not len(row):
            continue
        base = word * 64
        bits = lambda n: np.where(n >= 64, FULL, (np.uint64(1) << np.minimum(n, 63).astype(np.uint64)) - np.uint64(1))
        valid = bits(np.clip(high[row] - base, 0, 64)) & ~bits(np.clip(low[row] - base, 0, 64))
        counters = [np.zeros(len(row), np.uint64) for _ in range(max(1, radius.bit_length()))]
        over = ~valid
        for plane in range(planes.shape[1]):
            mine = (fps[row, plane // 64] >> np.uint64(plane % 64)) & np.uint64(1)
            carry = planes[word, plane] ^ (np.uint64(0) - mine)
            for level, counter in enumerate(counters):
                counters[level] = counter ^ carry
                carry &= counter
            over |= carry
            if plane % 8 == 7:
                beyond = _beyond(counters, over, radius)
                live = beyond != FULL
                if not live.all():
                    row, word, over, beyond = row[live], word[live], over[live], beyond[live]
                    counters = [c[live] for c in counters]
                if not len(row):
                    break
        if len(row):
            for part in range(0, len(row), 4096):
                hits = np.unpackbits((~beyond[part : part + 4096]).view(np.uint8), bitorder="little").reshape(-1, 64)
                which, lane = np.nonzero(hits)
                yield row[part + which], word[part + which] * 64 + lane


def _links(radius: int, words: tuple[str, ...]):
    """Links of sorted cells as stars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, ("tab", "key", "i", "j"), rows=20_000):
            fps = np.stack([table.column(w).to_numpy().view(np.uint64) for w in words], 1)
            reps, side = table.column("rep").to_numpy(), table.column("side").to_numpy()
            sizes = np.diff(starts)
            end = np.repeat(starts[1:], sizes)
            seconds = np.repeat(starts[:-1] + np.add.reduceat(side == 0, starts[:-1]), sizes)
            low = np.where(side == 2, np.arange(len(fps)) + 1, seconds)
            high = np.where(side == 1, low, end)
            labels = np.arange(len(fps))
            for a, b in close_pairs(fps, low, high, radius, labels=labels):
                join_labels(labels, a, b)
            # the smallest document is the star's centre, so that cells with the same
            # documents give the same edges
            centre = reps.copy()
            np.minimum.at(centre, labels, reps)
            centre = centre[labels]
            moved = centre != reps
            yield pa.RecordBatch.from_arrays([pa.array(reps[moved]), pa.array(centre[moved])], ["a", "b"])

    return run


def _bucket_edges(spread: DataFrame, words: tuple[str, ...], radius: int, cell_rows: int) -> DataFrame:
    dealt = cells(spread, ["tab", "key"], "rep", cell_rows)
    dealt = dealt.repartition("tab", "key", "i", "j").sortWithinPartitions("tab", "key", "i", "j", "side")
    return dealt.mapInArrow(lean(_links(radius, words)), "a long, b long").distinct()


def link_edges(reps: DataFrame, radius: int = 4, blocks: int = 6, cell_rows: int = 4096) -> DataFrame:
    """Edges (a, b) between ``rep`` values whose ``fp`` are linked; their components are
    those of all links."""
    spread = reps.select("fp", "rep", F.explode(_buckets(blocks, radius)).alias("x")).select("x.*", "fp", "rep")
    return _bucket_edges(spread, ("fp",), radius, cell_rows)


def near_duplicates(docs: DataFrame, radius: int = 4, size: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of each document."""
    prints = written(fingerprints(docs, size), "fingerprints")
    reps = written(prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep")), "reps")
    # one id may stand on several fingerprints (repeated rows): it links them by itself
    same = components(link_edges(reps, radius))
    owner = reps.join(same, reps["rep"] == same["node"], "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return (
        prints.join(owner, "fp", "left")
        .select(
            "doc_id",
            F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
            F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
        )
    )


def _sampled_keys(tables: int, bits: int):
    """Keys of 128-bit fingerprints: for each table the bits at its own random places."""
    draw = np.random.default_rng(3)
    places = np.stack([draw.permutation(128)[:bits] for _ in range(tables)])
    weight = 1 << np.arange(bits, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                fps = np.stack([part.column(c).to_numpy() for c in ("fp", "fp2")], 1)
                on = np.unpackbits(np.ascontiguousarray(fps).view(np.uint8), axis=1, bitorder="little")
                key = (on[:, places] * weight).sum(2)
                n = part.num_rows
                repeated = [np.repeat(part.column(c).to_numpy(), tables) for c in ("fp", "fp2", "rep")]
                tab = np.tile(np.arange(tables, dtype=np.int32), n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tab), pa.array(key.ravel()), *map(pa.array, repeated)], ["tab", "key", "fp", "fp2", "rep"]
                )

    return run


def similar_groups(
    docs: DataFrame, threshold: float = 0.8, size: int = 5, radius: int = 34, tables: int = 96, bits: int = 14, cell_rows: int = 2048
) -> DataFrame:
    """doc_id and component_id: documents whose sets of ``size``-word shingles have a Jaccard
    similarity of the threshold at least are linked.

    A similarity of 0.8 leaves 19 of 128 (often up to 26) fingerprint bits different, far more than
    whole-piece buckets can take, so buckets are made of sampled bits (0.995 of such pairs
    meet). Pairs within the radius by bit-sliced comparison form groups, and
    exact Jaccard inside the groups decides. Equal fingerprints are links by themselves."""
    prints = written(fingerprints(docs, size, wide=True).where("doc_id is not null"), "fingerprints")
    reps = written(prints.groupBy("fp", "fp2").agg(F.min("doc_id").alias("rep")), "reps")
    spread = reps.mapInArrow(lean(_sampled_keys(tables, bits)), "tab int, key long, fp long, fp2 long, rep long")
    near = written(components(_bucket_edges(spread, ("fp", "fp2"), radius, 4096)), "near")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            sets = [np.unique(shingle_hashes(x, size) >> np.uint64(32)).astype(np.uint32).view(np.int32) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("component"), batch.column("node"), pa.array(sets, pa.list_(pa.int32()))], ["component", "node", "shingles"]
            )

    asked = docs.select(F.col("doc_id").cast("long").alias("node"), F.coalesce("text", F.lit("")).alias("text")).join(near, "node")
    sets = asked.select("component", "node", "text").mapInArrow(lean(run), "component long, node long, shingles array<int>")
    same = components(jaccard_edges(cells(sets, ["component"], "node", cell_rows), "component", "node", threshold))
    owner = reps.join(same, reps["rep"] == same["node"], "left").select("fp", "fp2", F.coalesce("component", "rep").alias("component_id"))
    return prints.join(owner, ["fp", "fp2"]).select("doc_id", "component_id")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One row of each group of ``similar_groups``, the one with the smallest id (of rows
    that share it, one); rows with a null id stay."""
    groups = similar_groups(docs, **options)
    gone = groups.where("doc_id != component_id").select("doc_id").distinct()
    left = docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    known = left.where("doc_id is not null").dropDuplicates(["doc_id"])
    return known.unionAll(left.where("doc_id is null"))
