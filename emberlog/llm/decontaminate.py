"""Benchmark decontamination by template canonicalisation.

Texts become token sequences in which numbers, names and units are typed placeholders; the
placeholders' values are kept as slots. Windows of five tokens are hashed. A fixed-size bit
map of the benchmark's window hashes thins out the documents' windows inside the scan; the
rest meets the benchmark's windows in a hash join. A document holds an item if, along any
alignment (small shifts allowed), at least ``share`` of the item's windows occur, with
enough literal words, and its slots are consistent: one value of the item always stands for
one value in the document. Slots are read from one match for each window of the item, so a
stretch that also matches itself shifted is no contradiction. Re-parameterised questions are caught, texts that merely share
phrases are not.

Tokens: runs of letters, or of digits with points and commas inside; a number word is a
number; a unit word right after a number is a unit; a capitalised word that does not follow
a sentence's end or a line end is a name, and names in a row are one. Other characters part
tokens.

Cases: a null text is empty and holds nothing; a text or item of fewer than five tokens has
one window, all its tokens, so a short item is found only as a whole text; an item without
tokens is never found; null ids are not reported; rows that share an id count as one; items
that share an id are joined under it; an empty table on either side gives no rows; other
columns are not read.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberlog.llm.quality_mil import MULTIPLIER, _hashes
from emberlog.llm.work import lean, small, unsized, written

SIZE = 5
MAP_BITS = 24
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
).split()
UNIT_WORDS = (
    "mm cm m km metre metres meter meters kilometre kilometres kilometer kilometers inch inches foot feet yard yards mile miles "
    "mg g kg gram grams kilogram kilograms tonne tonnes ton tons pound pounds lb lbs ounce ounces oz ml cl l litre litres "
    "liter liters gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months "
    "year years mph kph knots hz khz mhz ghz w kw mw watt watts kwh j kj joule joules v volt volts a amp amps n newton "
    "newtons pa kpa bar c f k degree degrees percent dollar dollars euro euros cent cents pence byte bytes kb mb gb tb"
).split()
NUMBER, NAME, UNIT = (np.uint64(x) for x in (1, 2, 3))
OTHER, LETTER, DIGIT = 0, 1, 2
BREAK = "\n\r.!?:;\"“”«»()[]"

_tables: dict[str, np.ndarray] = {}


def _load() -> None:
    if _tables:
        return
    kind, low = np.zeros(0x110000, np.uint8), np.arange(0x110000, dtype=np.uint32)
    upper, stop = np.zeros(0x110000, bool), np.zeros(0x110000, bool)
    for code in range(0x30000):
        c = chr(code)
        category = unicodedata.category(c)
        if category[0] in "LM":
            kind[code] = LETTER
            upper[code] = category in ("Lu", "Lt")
            if len(c.lower()) == 1:
                low[code] = ord(c.lower())
        elif category == "Nd":
            kind[code] = DIGIT
    stop[[ord(c) for c in BREAK]] = True
    _tables.update(kind=kind, low=low, upper=upper, stop=stop)
    for name, words in (("numbers", NUMBER_WORDS), ("units", UNIT_WORDS)):
        _tables[name] = np.array([_word_hash(w) for w in words], np.uint64)


def _word_hash(word: str) -> np.uint64:
    code = np.array([ord(c) for c in word], np.uint64)
    return _hashes(code, np.array([0]), np.array([len(word)]))[0]


class Templates:
    """Tokens and windows of several texts: ``token`` hashes with character ``start`` and
    ``end`` in the joined text, the text's number ``doc``, and ``window`` hashes; window i
    covers the tokens from ``first[i]`` to ``first[i] + length[i]``."""

    def __init__(self, texts: list[str], size: int = SIZE):
        _load()
        self.joined = "\n".join(texts) + "\n"
        bounds = np.cumsum([len(x) + 1 for x in texts])
        self.base = bounds - np.array([len(x) + 1 for x in texts])
        code = np.frombuffer(self.joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = _tables["kind"][code]
        inner = ((code == 46) | (code == 44)) & (np.append(0, kind[:-1]) == DIGIT) & (np.append(kind[1:], 0) == DIGIT)
        kind[inner] = DIGIT
        change = np.flatnonzero(np.diff(kind, prepend=255))
        ends = np.append(change[1:], len(kind))
        of_token = kind[change] != OTHER
        start, end = change[of_token], ends[of_token]
        doc = np.searchsorted(bounds, start, "right")
        token = _hashes(_tables["low"][code].astype(np.uint64), start, end) | np.uint64(8)
        number = (kind[start] == DIGIT) | np.isin(token, _tables["numbers"] | np.uint64(8))
        after = lambda flags: np.append(False, flags[:-1]) & (np.append(-1, doc[:-1]) == doc)
        unit = after(number) & ~number & np.isin(token, _tables["units"] | np.uint64(8))
        stops = np.append(0, np.cumsum(_tables["stop"][code]))
        no_stop = stops[start] == stops[np.append(0, end[:-1])]
        lowered = ~_tables["upper"][code[np.minimum(start + 1, len(code) - 1)]] | (end - start == 1)
        capital = _tables["upper"][code[start]] & lowered & (kind[start] == LETTER)
        name = capital & after(np.ones(len(doc), bool)) & no_stop & ~number & ~unit
        token[number], token[name], token[unit] = NUMBER, NAME, UNIT
        joins = name & after(name)
        if joins.any():
            group = np.cumsum(~joins) - 1
            end = np.maximum.reduceat(end, np.flatnonzero(~joins))
            start, doc, token = start[~joins], doc[~joins], token[~joins]
            assert group[-1] + 1 == len(start)
        self.start, self.end, self.doc, self.token = start, end, doc, token
        counts = np.bincount(doc, minlength=len(texts))
        self.first_token = np.cumsum(counts) - counts
        n_windows = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
        self.window_doc = np.repeat(np.arange(len(texts)), n_windows)
        self.place = np.arange(n_windows.sum()) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
        self.first = self.first_token[self.window_doc] + self.place
        self.length = np.minimum(size, counts[self.window_doc])
        window = self.length.astype(np.uint64)
        for k in range(size):
            at = np.minimum(self.first + k, len(token) - 1)
            part = np.where(k < self.length, token[at], np.uint64(0))
            window = (window ^ part) * MULTIPLIER
            window ^= window >> np.uint64(29)
        self.window = window

    def slots(self, at: int) -> list[tuple[int, str]]:
        """(token place in its text, type and value) of the placeholders of a window."""
        out = []
        for t in range(self.first[at], self.first[at] + self.length[at]):
            if self.token[t] <= UNIT:
                value = " ".join(self.joined[self.start[t] : self.end[t]].lower().split())
                out.append((int(t - self.first_token[self.doc[t]]), f"{self.token[t]} {value}"))
        return out


ROWS = "id long, place int, start int, end int, literal int, hash long, n_windows int, slots array<struct<at: int, value: string>>"


def _windows(table: DataFrame, id_column: str, bits: np.ndarray | None) -> DataFrame:
    """Windows of each text; with ``bits``, those whose place in the bit map is set."""
    shift = np.uint64(64 - MAP_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            ids, texts = batch.column("id").to_pylist(), batch.column("text").to_pylist()
            at = 0
            while at < len(texts):
                last, held = at, 0
                while last < len(texts) and (last == at or held + len(texts[last]) <= 1 << 19):
                    held += len(texts[last])
                    last += 1
                found = Templates(texts[at:last])
                keep = np.arange(len(found.window))
                if bits is not None:
                    place = (found.window >> shift).astype(np.int64)
                    keep = np.flatnonzero(bits[place >> 3] >> (place & 7).astype(np.uint8) & 1)
                per_text = np.bincount(found.window_doc, minlength=last - at)
                doc, first = found.window_doc[keep], found.first[keep]
                final = first + found.length[keep] - 1
                literal = np.array([int((found.token[a : b + 1] > UNIT).sum()) for a, b in zip(first, final, strict=True)], np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[at + d] for d in doc], pa.int64()),
                        pa.array(found.place[keep].astype(np.int32)),
                        pa.array((found.start[first] - found.base[doc]).astype(np.int32)),
                        pa.array((found.end[final] - found.base[doc]).astype(np.int32)),
                        pa.array(literal, pa.int32()),
                        pa.array(found.window[keep].view(np.int64)),
                        pa.array(per_text[doc].astype(np.int32)),
                        pa.array(
                            [[{"at": a, "value": v} for a, v in found.slots(i)] for i in keep],
                            pa.list_(pa.struct([("at", pa.int32()), ("value", pa.string())])),
                        ),
                    ],
                    ["id", "place", "start", "end", "literal", "hash", "n_windows", "slots"],
                )
                at = last

    rows = table.select(F.col(id_column).cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text")).where("id is not null")
    return rows.mapInArrow(lean(run), ROWS)


def find_leaks(docs: DataFrame, benchmark: DataFrame, share: float = 0.8, min_literal: int = 5, slack: int = 3) -> DataFrame:
    """doc_id, item_id, n_windows (of the item's that occur), item_windows, start and end of
    the passage in code points, n_slots, n_changed (slots whose value differs)."""
    items = written(_windows(benchmark, "item_id", None), "benchmark-windows")
    shift = 64 - MAP_BITS
    places = items.select(F.shiftrightunsigned("hash", shift).cast("int").alias("p")).distinct().toArrow().column("p").to_numpy()
    bits = np.zeros(1 << (MAP_BITS - 3), np.uint8)
    np.bitwise_or.at(bits, places >> 3, (1 << (places & 7)).astype(np.uint8))
    found = _windows(docs, "doc_id", bits)
    item = items.select(
        F.col("id").alias("item_id"), F.col("place").alias("item_place"), F.col("slots").alias("item_slots"),
        F.col("n_windows").alias("item_windows"), "hash",
    ).dropDuplicates(["item_id", "item_place", "hash"])
    met = written(
        found.dropDuplicates(["id", "place", "hash"])
        .join(item, "hash")
        .select(
            F.col("id").alias("doc_id"), "item_id", "place", "item_place", "start", "end", "literal", "slots", "item_slots",
            "item_windows", (F.col("place") - F.col("item_place")).alias("offset"),
        ),
        "met-windows",
    )
    by_offset = met.groupBy("doc_id", "item_id", "offset").agg(F.countDistinct("item_place").alias("n"))
    # every offset is an alignment of its own: a sibling of the item may match as well or better
    enough = met.groupBy("doc_id", "item_id").agg(F.countDistinct("item_place").alias("all"), F.max("item_windows").alias("of"))
    pairs = enough.where(F.col("all") >= share * F.col("of")).select("doc_id", "item_id")
    centres = by_offset.join(pairs, ["doc_id", "item_id"]).withColumnRenamed("offset", "best").withColumnRenamed("n", "n_best")
    around = met.withColumn("best", F.explode(F.sequence(F.col("offset") - slack, F.col("offset") + slack)))
    near = unsized(around).join(centres, ["doc_id", "item_id", "best"])
    # at most 2 * slack + 1 matches of each window of the item
    match = F.struct("item_place", "place", "offset", "start", "end", "literal", "slots", "item_slots")
    along = near.groupBy("doc_id", "item_id", "best", "n_best").agg(F.max("item_windows").alias("item_windows"), F.collect_list(match).alias("met"))
    literal_windows = F.size(F.array_distinct(F.filter("met", lambda m: m["literal"] > 0)["place"]))
    hits = along.where(
        (F.size(F.array_distinct("met.item_place")) >= share * F.col("item_windows"))
        & (F.least(F.lit(min_literal), F.array_max("met.literal") + literal_windows - 1) >= F.least(F.lit(min_literal), "item_windows"))
    )
    told = hits.mapInArrow(lean(_told), f"{LEAKS}, best int, n_best long")
    names = [x.split()[0] for x in LEAKS.split(", ")]
    one = F.max_by(F.struct(*names), F.struct("n_best", -F.col("best"))).alias("one")
    return told.groupBy("doc_id", "item_id").agg(one).select("one.*")


LEAKS = "doc_id long, item_id long, n_windows long, item_windows long, start int, end int, n_slots long, n_changed long"


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The alignments whose slots are consistent, with their passage and slots."""
    names = [x.split()[0] for x in LEAKS.split(", ")] + ["best", "n_best"]
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            path = _path(row["met"], row["best"])
            taken, at = {}, {}
            for m in path:
                for given, here in zip(m["item_slots"], m["slots"], strict=True):
                    taken.setdefault(given["value"], set()).add(here["value"])
                    at.setdefault(given["value"], set()).add(given["at"])
            if any(len(x) > 1 for x in taken.values()):
                continue
            changed = sum(len(at[v]) for v, x in taken.items() if x != {v})
            start, end = min(m["start"] for m in path), max(m["end"] for m in path)
            out.append((row["doc_id"], row["item_id"], len(path), row["item_windows"], start, end, sum(map(len, at.values())), changed, row["best"], row["n_best"]))
        kinds = [pa.int32() if n in ("start", "end", "best") else pa.int64() for n in names]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)


def _path(met: list[dict], centre: int) -> list[dict]:
    """One match for each place of the item: the way through the item with the least change
    of offset, and of those the nearest to ``centre``. A stretch that repeats itself also
    matches itself shifted; such matches are not on the way."""
    every: list[tuple[int, int, int, int]] = []  # changes, distance, number of the match, way before
    ways: list[int] = []
    last = None
    for k in sorted(range(len(met)), key=lambda k: (met[k]["item_place"], met[k]["offset"])):
        if met[k]["item_place"] != last:
            last, before, ways = met[k]["item_place"], ways, []
        offset = met[k]["offset"]
        far = abs(offset - centre)
        steps = ((every[w][0] + abs(offset - met[every[w][2]]["offset"]), every[w][1] + far, w) for w in before)
        changes, distance, w = min(steps, default=(0, far, -1))
        every.append((changes, distance, k, w))
        ways.append(len(every) - 1)
    at, path = min(ways, key=lambda w: every[w][:2]), []
    while at >= 0:
        path.append(met[every[at][2]])
        at = every[at][3]
    return path[::-1]


def drop_leaks(docs: DataFrame, benchmark: DataFrame, share: float = 0.8) -> DataFrame:
    """The rows of ``docs`` whose id holds no item; rows with a null id stay."""
    return docs.join(find_leaks(docs, benchmark, share).select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)
