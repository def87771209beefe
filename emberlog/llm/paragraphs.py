"""Paragraph deduplication by MinHash banding.

A paragraph is a block of lines between blank lines, of five words or more; wrapped lines are
one block. Inside a block of several lines each line of ``min_words`` words is a paragraph
as well (shorter lines there, a licence or a contact line, say, go only with their block, or
as part of a passage; a smaller ``min_words`` takes them too). Paragraphs get a content key
and a MinHash signature of their five-word shingles, cut into bands. Bands are chosen for recall: the
widest that still find a pair at the threshold with the wanted probability. Band values
with two different contents at least are bucketed; inside a bucket exact Jaccard of the
shingle sets decides, and pairs already joined by others are not compared again, so a
bucket of near-copies costs one comparison each. Buckets over ``cell_rows`` contents are
dealt out as cells of chunk pairs. Links leave a cell as a star; contents joined by links
form a class, whose first paragraph by document and place stays and whose others go; a line
of a block that goes is not listed again. Shingles are kept for no paragraph; those that met
another are found in a second scan by a bit map of fixed size.

A passage set into other text fills no line, so its line is no near-copy of another. For
those, windows of ``PASSAGE`` words are sampled min-wise from the whole text (the smallest
hash of each ``PICK`` in a row), which meets every run of PASSAGE + PICK - 1 = 50 words that
two documents share. The sampled windows that repeat are seeds: in all documents that hold
one, every window that starts less than PICK words from it is looked up as well. Each word
of a shared run of 50 words or more stands in such a window, so the run is found from its
first word to its last; it goes from all documents but the first, where no removed
paragraph covers it.

Cases: a null or empty text, or one under five words, has no paragraph; a null id takes no
part; rows with the same id and text are one document, rows with the same id and another
text are told apart by the text's hash and ordered by it; repeated paragraphs inside one
document count like others; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberlog.llm.components import components
from emberlog.llm.jaccard import cells, jaccard_edges, once_each
from emberlog.llm.quality_mil import MULTIPLIER, _hashes
from emberlog.llm.work import forget, lean, small, unsized, whole_groups, written

SHINGLE = 5
PASSAGE, PICK = 25, 26
PARAGRAPHS = (
    "doc_id long, text_hash long, place int, n_lines int, block int, start int, end int, n_words int, content long, bands array<long>"
)
SETS = "content long, shingles array<int>"
#: Bits of the map that thins out a second scan.
MAP_BITS = 24
_tables: dict[str, np.ndarray] = {}
#: Code points that are looked up at once.
SLICE = 1 << 18


WINDOWS = "key long, doc_id long, text_hash long, start int, end int, seed boolean"
SALTED = WINDOWS + ", salt int"


def _word_hashes(texts: list[str]):
    """Code points, word starts and ends, word hashes (lower-cased), and the texts' ends, in
    the joined texts."""
    _load()
    joined = "\n".join(texts) + "\n"
    sizes = np.array([len(x) + 1 for x in texts])
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    # one more place on each side, which no word holds
    inside, low = np.zeros(len(code) + 2, np.int8), np.empty(len(code), np.uint64)
    for at in range(0, len(code), SLICE):
        part = code[at : at + SLICE].astype(np.intp)
        np.take(_tables["word"], part, out=inside[at + 1 : at + 1 + len(part)], mode="clip")
        np.take(_tables["low"], part, out=low[at : at + SLICE], mode="clip")
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return code, start, end, _mixed(_hashes(low, start, end)), sizes


def _numbered(bounds: np.ndarray, start: np.ndarray) -> np.ndarray:
    """How many of the sorted ``bounds`` each of the sorted starts has reached."""
    return np.repeat(np.arange(len(bounds) + 1), np.diff(np.searchsorted(start, bounds), prepend=0, append=len(start)))


def _passages(texts: list[str], seeds: list[list[int]] | None = None):
    """Sampled windows: text number, start, end, key and whether it is a seed; with
    ``seeds``, the starts of each text's seeds, the windows around those instead."""
    _, start, end, word, sizes = _word_hashes(texts)
    bounds = np.cumsum(sizes)
    text = _numbered(bounds, start)
    n = len(word) - PASSAGE + 1
    if n < 1 or (seeds is None and n < PICK):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64), np.zeros(0, bool))
    at = np.arange(n)
    key = _mixed(_hashes(word, slice(0, n), slice(PASSAGE, PASSAGE + n)))
    if seeds is None:
        # the low bits hold the place; a text of over 16 million words takes some more
        low = np.uint64((1 << max(24, n.bit_length())) - 1)
        ranked = (key & ~low) | at.astype(np.uint64)
        blocks = np.full(-(-(n + PICK) // PICK) * PICK, np.uint64(0xFFFFFFFFFFFFFFFF))
        blocks[:n] = ranked
        blocks = blocks.reshape(-1, PICK)
        before = np.minimum.accumulate(blocks, 1).ravel()
        after = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
        row = at[: n - PICK + 1]
        row = row[text[row] == text[row + PICK + PASSAGE - 2]]
        chosen = np.unique((np.minimum(after[row], before[row + PICK - 1]) & low).astype(np.int64))
        seed = np.ones(len(chosen), bool)
    else:
        places = np.repeat(bounds - sizes, [len(x) for x in seeds]) + np.array([x for own in seeds for x in own], np.int64)
        places = np.searchsorted(start, places)
        near = np.zeros(n + 1, np.int64)
        np.add.at(near, np.maximum(places - PICK + 1, 0), 1)
        np.add.at(near, np.minimum(places + PICK, n), -1)
        chosen = np.flatnonzero((np.cumsum(near)[:n] > 0) & (text[:n] == text[PASSAGE - 1 :]))
        seed = np.isin(chosen, places)
    begin = (bounds - sizes)[text[chosen]]
    return text[chosen], start[chosen] - begin, end[chosen + PASSAGE - 1] - begin, key[chosen], seed


def bands_for(threshold: float, hashes: int, recall: float) -> tuple[int, int]:
    """(bands, rows): most rows in a band, of ``hashes`` values, that keep the recall."""
    for rows in range(hashes, 0, -1):
        bands = hashes // rows
        if 1 - (1 - threshold**rows) ** bands >= recall:
            return bands, rows
    raise ValueError("too few hashes for this recall")


def _load() -> None:
    if not _tables:
        word, low = np.ones(0x110000, np.int8), np.arange(0x110000, dtype=np.uint64)
        for code in range(0x30000):
            c = chr(code)
            word[code] = not c.isspace()
            if len(c.lower()) == 1:
                low[code] = ord(c.lower())
        _tables.update(word=word, low=low)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(29))


class _Units:
    """The paragraphs of several texts, each with its text's number, place (first line),
    lines, place of its block, start and end in its text, words and content key."""

    def __init__(self, texts: list[str], min_words: int):
        code, start, end, word, sizes = _word_hashes(texts)
        bounds = np.cumsum(sizes)
        breaks = np.flatnonzero(code == 10)
        line = _numbered(breaks, start)
        first = np.flatnonzero(np.append(True, line[1:] != line[:-1])) if len(line) else np.zeros(0, np.int64)
        number, words = line[first], np.diff(np.append(first, len(line)))
        text = np.searchsorted(bounds, start[first], "right")
        # a blank line or another text begins a block
        fresh = np.append(True, (text[1:] != text[:-1]) | (np.diff(number) > 1))[: len(first)]
        head = np.flatnonzero(fresh)
        of = np.cumsum(fresh) - 1
        block_words = np.add.reduceat(words, head) if len(head) else words
        tail = np.append(head[1:], len(first))[: len(head)] - 1
        lines = number[tail] - number[head] + 1
        long = (words >= max(min_words, SHINGLE)) & (lines[of] > 1) if len(head) else np.zeros(0, bool)
        whole = block_words >= SHINGLE
        row = np.append(head[whole], np.flatnonzero(long))
        self.n_lines = np.append(lines[whole], np.ones(long.sum(), np.int64))
        self.n_words = np.append(block_words[whole], words[long])
        order = np.lexsort((-self.n_lines, row))
        row, self.n_lines, self.n_words = row[order], self.n_lines[order], self.n_words[order]
        self.first, self.word = first[row], word
        last = self.first + self.n_words - 1
        self.content = _mixed(_hashes(word, self.first, last + 1) + self.n_words.astype(np.uint64)) if len(row) else np.zeros(0, np.uint64)
        self.text = text[row]
        begin = bounds[self.text] - sizes[self.text]
        base = np.searchsorted(breaks, begin)
        self.place, self.block = number[row] - base, number[head][of[row]] - base
        self.start, self.end = start[self.first] - begin, end[last] - begin
        n = max(0, len(word) - SHINGLE + 1)
        self.shingle = np.zeros(n + 1, np.uint64)
        for k in range(SHINGLE):
            self.shingle[:-1] = (self.shingle[:-1] ^ word[k : k + n]) * MULTIPLIER
            self.shingle ^= self.shingle >> np.uint64(32)

    def bands(self, bands: int, rows: int) -> np.ndarray:
        """Band values, a row for each paragraph."""
        banded = np.empty((len(self.first), bands), np.uint64)
        if not len(self.first):
            return banded
        # minima from each paragraph's first shingle to its last; what lies between is unused
        spans = np.column_stack((self.first, self.first + self.n_words - SHINGLE + 1)).ravel()
        draws = np.random.default_rng(11).integers(1, 1 << 63, (bands * rows, 2), dtype=np.uint64) | np.uint64(1)
        drawn = np.empty_like(self.shingle)
        for band in range(bands):
            value = np.full(len(self.first), band + 1, np.uint64)
            for a, b in draws[band * rows : (band + 1) * rows]:
                np.multiply(self.shingle, a, out=drawn)
                drawn += b
                least = np.minimum.reduceat(drawn, spans)[::2] >> np.uint64(32)
                value = _mixed(value * MULTIPLIER + least)
            banded[:, band] = value
        return banded

    def shingles(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Short hashes of the shingles of some paragraphs, and their offsets."""
        n = self.n_words[at] - SHINGLE + 1
        ends = np.cumsum(n)
        place = np.repeat(self.first[at] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)
        return (self.shingle[place] >> np.uint64(32)).astype(np.uint32), np.append(0, ends)


def paragraphs(docs: DataFrame, min_words: int, bands: int, rows: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, most=1 << 19):
            u = _Units(batch.column("text").to_pylist(), min_words)
            ids, hashes = batch.column("doc_id").to_numpy(), batch.column("text_hash").to_numpy()
            i32 = lambda x: pa.array(x.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[u.text]), pa.array(hashes[u.text]), i32(u.place), i32(u.n_lines), i32(u.block), i32(u.start), i32(u.end),
                    i32(u.n_words), pa.array(u.content.view(np.int64)),
                    pa.ListArray.from_arrays(i32(np.arange(len(u.text) + 1) * bands), pa.array(u.bands(bands, rows).ravel().view(np.int64))),
                ],
                [x.split()[0] for x in PARAGRAPHS.split(", ")],
            )

    return _texts(docs).mapInArrow(lean(run), PARAGRAPHS)


def _bit_map(keys: DataFrame, key: str) -> np.ndarray:
    """A map of ``2 ** MAP_BITS`` bits with those of all keys set; of that size whatever the
    number of keys. It thins out a scan, what passes is still joined."""
    word = F.shiftrightunsigned(key, 64 - MAP_BITS + 6).cast("int")
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned({key}, {64 - MAP_BITS}) & 63 AS int))")
    found = keys.select(word.alias("at"), bit.alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (MAP_BITS - 6), np.uint64)
    out[found.column("at").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def _in_map(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = keys >> np.uint64(64 - MAP_BITS)
    return (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


def _sets(docs: DataFrame, asked: DataFrame, min_words: int, seen_most: int = 200_000) -> DataFrame:
    """Shingles of one paragraph of each content of ``asked``."""
    bits = _bit_map(asked, "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in small(batches, most=1 << 19):
            u = _Units(batch.column("text").to_pylist(), min_words)
            at, new = np.unique(u.content, return_index=True)
            new = new[_in_map(bits, at)]
            new = np.array([i for i, c in zip(new.tolist(), u.content[new].tolist(), strict=True) if c not in seen], np.int64)
            if len(seen) > seen_most:
                seen.clear()
            seen.update(u.content[new].tolist())
            shingles, offsets = u.shingles(new)
            yield pa.RecordBatch.from_arrays(
                [pa.array(u.content[new].view(np.int64)), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(shingles.view(np.int32)))],
                ["content", "shingles"],
            )

    found = _texts(docs).mapInArrow(lean(run), SETS)
    return found.join(asked, "content", "left_semi").dropDuplicates(["content"])


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("text_hash")
    ).where("doc_id is not null and text is not null")


#: A window key is hot beyond this many rows, and beyond a share of 1 / HOT_KEYS of all: so
#: there are at most HOT_KEYS of them, whatever the table.
HOT_ROWS, HOT_KEYS = 2000, 2000


def _windows(bits: np.ndarray | None = None, hot: dict[int, int] | None = None):
    """Windows of texts; with ``bits``, those whose key is in the map, and ``salt``, which
    deals the rows of each hot key out to as many parts as ``hot`` says."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in (WINDOWS if bits is None else SALTED).split(", ")]
        hot_keys = np.array(sorted(hot or ()), np.int64)
        hot_parts = np.array([(hot or {})[k] for k in hot_keys.tolist()], np.int64)
        for batch in small(batches, most=1 << 19):
            ids, hashes = batch.column("doc_id").to_numpy(), batch.column("text_hash").to_numpy()
            seeds = batch.column("seeds").to_pylist() if "seeds" in batch.schema.names else None
            text, start, end, key, seed = _passages(batch.column("text").to_pylist(), seeds)
            if bits is not None:
                kept = _in_map(bits, key)
                text, start, end, key, seed = text[kept], start[kept], end[kept], key[kept], seed[kept]
            key = key.view(np.int64)
            columns = [pa.array(key), pa.array(ids[text]), pa.array(hashes[text]), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32)), pa.array(seed)]
            if bits is not None:
                salt = np.zeros(len(key), np.int32)
                if len(hot_keys):
                    at = np.minimum(np.searchsorted(hot_keys, key), len(hot_keys) - 1)
                    parts = np.where(hot_keys[at] == key, hot_parts[at], 1)
                    salt = ((hashes[text].view(np.uint64) >> np.uint64(7)) % parts.astype(np.uint64)).astype(np.int32)
                columns.append(pa.array(salt))
            yield pa.RecordBatch.from_arrays(columns, names)

    return lean(run)


def _repeated(rows: DataFrame) -> DataFrame:
    """Windows of ``rows`` whose key stands in two documents at least, with the smallest id
    as ``kept_doc_id``. Keys are counted by partial sums. In a second scan the windows of
    repeated keys meet their key's row in a running minimum; the rows of a hot key are dealt
    out to parts, each with a copy of the key's row."""
    keys = rows.mapInArrow(_windows(), WINDOWS).groupBy("key").agg(
        F.min("doc_id").alias("kept_doc_id"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("n")
    )
    keys = written(keys.where("kept_doc_id != last").drop("last"), "window-keys")
    total = keys.agg(F.sum("n")).first()[0] or 0
    most = max(HOT_ROWS, total // HOT_KEYS)
    hot = {r["key"]: -(-r["n"] // most) for r in keys.where(F.col("n") > most).select("key", "n").collect()}
    windows = rows.mapInArrow(_windows(_bit_map(keys, "key"), hot), SALTED).withColumn("kept_doc_id", F.lit(None).cast("long"))
    salts = F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("n") / most).cast("int") - 1)))
    none = [F.lit(None).cast(k).alias(c) for c, k in (x.split() for x in WINDOWS.split(", ")) if c != "key"]
    both = windows.unionByName(keys.select("key", *none, salts.alias("salt"), "kept_doc_id"))
    met = both.withColumn("kept_doc_id", F.min("kept_doc_id").over(Window.partitionBy("key", "salt")))
    return met.where("doc_id IS NOT NULL AND kept_doc_id IS NOT NULL").drop("salt")


def _with_keys(windows: DataFrame, keys: DataFrame) -> DataFrame:
    """Windows whose key is one of ``keys``, by a maximum over the rows of a key; those of a
    hot key are dealt out to parts, each with a copy of the key's row."""
    counts = windows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.agg(F.sum("n").alias("total"), F.max("n").alias("top")).first()
    most = max(HOT_ROWS, (sizes["total"] or 0) // HOT_KEYS)
    hot = [r["key"] for r in counts.where(F.col("n") > most).select("key").collect()]
    parts = -(-(sizes["top"] or 1) // most)
    part = F.pmod(F.col("text_hash"), F.lit(parts)).cast("int")
    is_hot = F.col("key").isin(hot) if hot else F.lit(False)
    every = F.when(is_hot, F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))
    rows = windows.select("*", F.when(is_hot, part).otherwise(0).alias("salt"), F.lit(False).alias("asked"))
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in windows.schema if f.name != "key"]
    named = keys.select("key", *none, F.explode(every).alias("salt"), F.lit(True).alias("asked"))
    met = rows.unionByName(named).withColumn("asked", F.max("asked").over(Window.partitionBy("key", "salt")))
    return met.where("asked AND doc_id IS NOT NULL").drop("salt", "asked")


def repeated_windows(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """Windows in and around the sampled ones that also stand in a document with a smaller
    id: key, doc_id, text_hash, start, end, seed and kept_doc_id. Sampled windows inside the
    removed ``lines`` are no seeds."""
    shared = written(_repeated(_texts(docs)), "shared-windows")
    asked = _by_text(shared.where("doc_id != kept_doc_id"), lines).mapInArrow(lean(_uncovered), "key long").distinct()
    spots = _with_keys(shared, asked).groupBy("doc_id", "text_hash").agg(F.collect_set("start").alias("seeds"))
    around = written(_texts(docs).join(spots, ["doc_id", "text_hash"]), "seeded-texts")
    return _repeated(around).where("doc_id != kept_doc_id")


def link_edges(docs: DataFrame, found: DataFrame, threshold: float, min_words: int, cell_rows: int = 1024) -> DataFrame:
    """Edges between contents (a, b) of the paragraphs ``found`` in ``docs``, whose
    components are those of all links."""
    banded = found.select("content", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.min("content").alias("lo"), F.max("content").alias("hi")).where("lo != hi").select("band")
    met = written(unsized(banded).join(shared, "band").distinct(), "met-bands")
    sets = written(_sets(docs, met.select("content").distinct(), min_words), "sets")
    # near-copies meet in most of their bands, often with nothing else there
    dealt = cells(met, ["band"], "content", cell_rows, once_each(met, "band", "content")).join(sets, "content")
    return jaccard_edges(dealt, "band", "content", threshold)


def repeated_paragraphs(
    docs: DataFrame, threshold: float = 0.8, min_words: int = 25, hashes: int = 48, recall: float = 0.998
) -> DataFrame:
    """What to remove: doc_id, text_hash, unit ("paragraph" or "passage"), place (first line),
    n_lines, start and end (code points), kept_doc_id and kept_place (what stays) and
    class_size; place, n_lines, kept_place and class_size are null for passages, which are
    maximal runs of windows."""
    found = written(paragraphs(docs, min_words, *bands_for(threshold, hashes, recall)), "paragraphs")
    classes = components(link_edges(docs, found, threshold, min_words))
    spans = found.drop("bands", "n_words").distinct()
    named = spans.join(classes, spans["content"] == classes["node"], "left").select(
        *[c for c in spans.columns if c != "content"], F.coalesce("component", "content").alias("cluster")
    )
    named = written(named, "named")
    first = F.min(F.struct("doc_id", "text_hash", "place", "n_lines")).alias("kept")
    kept = named.groupBy("cluster").agg(first, F.count("*").alias("class_size")).where("class_size > 1")
    here = F.struct("doc_id", "text_hash", "place", "n_lines")
    gone = named.join(kept, "cluster").where(here != F.col("kept")).select(
        "doc_id", "text_hash", F.lit("paragraph").alias("unit"), "place", "n_lines", "start", "end",
        F.col("kept.doc_id").alias("kept_doc_id"), F.col("kept.place").alias("kept_place"), "class_size", "block",
    )
    gone = written(gone, "gone")
    blocks = gone.where("n_lines > 1").select("doc_id", "text_hash", "block").distinct()
    within = gone.where("n_lines = 1").join(blocks, ["doc_id", "text_hash", "block"], "left_anti").select(gone.columns)
    lines = written(gone.where("n_lines > 1").unionByName(within).drop("block"), "lines")
    forget(found)
    forget(named)
    return _by_text(repeated_windows(docs, lines), lines).mapInArrow(lean(_runs), lines.schema)


def _by_text(windows: DataFrame, lines: DataFrame) -> DataFrame:
    """Removed lines and windows of each text together, by start."""
    none = lambda kind: F.lit(None).cast(kind)
    both = lines.select("*", none("boolean").alias("seed"), none("long").alias("key")).unionAll(
        windows.select(
            "doc_id", "text_hash", F.lit("passage").alias("unit"), none("int").alias("place"), none("int").alias("n_lines"), "start", "end",
            "kept_doc_id", none("int").alias("kept_place"), none("long").alias("class_size"), "seed", "key",
        )
    )
    return both.repartition("doc_id", "text_hash").sortWithinPartitions("doc_id", "text_hash", "start", "unit", "end")


def _axis(table: pa.Table, starts: np.ndarray):
    """Which rows are removed lines; start and end with each text on an axis of its own;
    text of each row and the axis' width."""
    start, end = table.column("start").to_numpy(), table.column("end").to_numpy()
    line = pc.equal(table.column("unit"), "paragraph").to_numpy()
    group = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    width = np.int64(int(end.max()) + 2)
    return line, start + group * width, end + group * width, group, width


def _uncovered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of the windows that lie in no removed line as a whole."""
    for table, starts in whole_groups(batches, ("doc_id", "text_hash"), rows=20_000):
        line, a, b, _, _ = _axis(table, starts)
        # lines of one text do not overlap, so only the last that starts no later can cover
        before = np.searchsorted(a[line], a, "right")
        covered = line.copy()
        some = before > 0
        covered[some] |= b[line][before[some] - 1] >= b[some]
        yield from table.select(["key"]).filter(pa.array(~covered)).to_batches()


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by text and start: paragraphs as they are; windows that overlap joined to
    maximal runs, of which those with a seed stay, less what the paragraphs cover. A run
    keeps the first window's kept_doc_id."""
    for table, starts in whole_groups(batches, ("doc_id", "text_hash"), rows=20_000):
        line, a, b, group, width = _axis(table, starts)
        rows = np.flatnonzero(~line)
        far = np.maximum.accumulate(b[rows]) if len(rows) else b[rows]
        first = np.flatnonzero(np.append(True, a[rows][1:] >= far[:-1])[: len(rows)])
        out_row, out_a, out_b = [np.flatnonzero(line)], [a[line]], [b[line]]
        if len(first):
            seed = pc.fill_null(table.column("seed"), False).to_numpy()[rows]
            seeded = np.logical_or.reduceat(seed, first)
            lead, run_a, run_b = rows[first][seeded], a[rows[first]][seeded], np.maximum.reduceat(b[rows], first)[seeded]
            line_a, line_b = np.unique(a[line]), np.unique(b[line])
            lo, hi = np.searchsorted(line_b, run_a, "right"), np.searchsorted(line_a, run_b, "left")
            for k, (x, y, i, j) in enumerate(zip(run_a, run_b, lo, hi, strict=True)):
                cuts = [x, *np.column_stack((line_a[i:j], line_b[i:j])).ravel(), y]
                pieces = [(p, q) for p, q in zip(cuts[::2], cuts[1::2], strict=True) if q > p + (i < j)]
                out_row.append(np.full(len(pieces), lead[k], np.int64))
                out_a.append(np.array([p for p, _ in pieces], np.int64))
                out_b.append(np.array([q for _, q in pieces], np.int64))
        row, out_a, out_b = np.concatenate(out_row), np.concatenate(out_a), np.concatenate(out_b)
        order = np.lexsort((out_a, group[row]))
        row, base = row[order], group[row[order]] * width
        out = table.take(pa.array(row)).drop_columns(["seed", "key"])
        for name, values in (("start", out_a[order] - base), ("end", out_b[order] - base)):
            out = out.set_column(out.column_names.index(name), name, pa.array(values.astype(np.int32)))
        yield from out.to_batches()


def without_repeats(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with what ``repeated_paragraphs`` finds cut out of ``text``, each piece with
    a line end right after it; n_chars, where there is such a column, follows. Rows are never dropped."""
    spans = repeated_paragraphs(docs, **options).groupBy("doc_id", "text_hash").agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans")
    )
    keys = spans.toDF("__doc_id", "__text_hash", "__cut")
    on = (F.col("d.doc_id").cast("long") == keys["__doc_id"]) & (F.xxhash64("d.text") == keys["__text_hash"])
    names = docs.columns
    rows = docs.alias("d").join(keys, on, "left").select(*[F.col(f"d.`{c}`") for c in names], "__cut")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            out = []
            for text, cut in zip(batch.column(names.index("text")).to_pylist(), batch.column("__cut").to_pylist(), strict=True):
                if cut:
                    parts, at = [], 0
                    for span in cut:
                        if span["end"] <= at:
                            continue
                        parts.append(text[at : max(span["start"], at)])
                        at = span["end"]
                        if text[at : at + 1] == "\n":
                            at += 1
                    text = "".join([*parts, text[at:]])
                out.append(text)
            columns = [batch.column(i) for i in range(len(names))]
            columns[names.index("text")] = pa.array(out, pa.string())
            if "n_chars" in names:
                i = names.index("n_chars")
                cut = np.array([bool(x) for x in batch.column("__cut").to_pylist()])
                sizes = pa.array([None if x is None else len(x) for x in out], columns[i].type)
                columns[i] = pc.if_else(pa.array(cut), sizes, columns[i])
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(lean(run), docs.schema)
