"""I-Match fingerprints over randomised lexicon subsets, in DataFrame functions only.

The lexicon holds the terms whose inverse document frequency, ln(documents / documents with
the term), lies in a band. Sixty random subsets of it, six for each rate 1/2 .. 1/1024, are
drawn by hashes of the term, so they need no table of their own. A text's digest for a
subset is the exclusive or of the keyed hashes of its distinct terms in that subset: a hash
of the sorted set, as equal sets and only they (up to hash collisions) give equal values,
which can be summed before the shuffle. A further digest is the hash of all its distinct
terms in sorted order, band or not.

Likeness of two fingerprints: of the subsets at rates that leave about two of the larger
text's terms or fewer, the share of equal digests among those where either has a term. With
no such subset, or where all terms are equal, the digests of all terms decide (0 or 1).

Cases: a null or empty text has no term, and two such have likeness 1; rows that share an
id are ordered by their text's hash, and each gives a row; a null id is taken as the
smallest; an only row is its own neighbour; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberlog.llm.work import shuffle_parts, written

LANES, PER_LEVEL = 60, 6
LEVELS = LANES // PER_LEVEL
#: Stands in every term list and in the lexicon, in no subset: keeps texts without terms.
SENTINEL = 0


def _level(lane: int) -> int:
    return 1 + lane // PER_LEVEL


def terms(text: str | Column) -> Column:
    """Hashes of the distinct terms: lower-cased runs of letters and digits."""
    words = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.array_distinct(F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, min_idf: float, max_idf: float) -> DataFrame:
    """term and its lanes: four 16-bit values in each of 15 longs, zero outside a subset."""
    n = docs.count()
    counts = docs.select(F.explode(terms("text")).alias("term")).groupBy("term").count()
    idf = F.log(F.lit(float(max(n, 1))) / F.col("count"))
    kept = counts.where((idf >= min_idf) & (idf <= max_idf)).select("term")
    kept = kept.unionAll(docs.sparkSession.range(1).select(F.lit(SENTINEL).cast("long").alias("term")))

    def lane(k: int) -> Column:
        h = F.xxhash64("term", F.lit(k))
        drawn = (h.bitwiseAND(F.lit((1 << _level(k)) - 1).cast("long")) == 0) & (F.col("term") != SENTINEL)
        value = F.shiftrightunsigned(h, 40).bitwiseAND(F.lit(0xFFFF).cast("long"))
        return F.when(drawn, F.shiftleft(F.greatest(value, F.lit(1).cast("long")), 16 * (k % 4))).otherwise(0)

    longs = [
        lane(4 * j).bitwiseOR(lane(4 * j + 1)).bitwiseOR(lane(4 * j + 2)).bitwiseOR(lane(4 * j + 3)).alias(f"l{j}")
        for j in range(LANES // 4)
    ]
    return written(kept.select("term", *longs), "lexicon")


def likeness(a: str, b: str) -> Column:
    """Of two structs (n_terms, whole, l0 ..)."""
    most = F.greatest(F.col(f"{a}.n_terms"), F.col(f"{b}.n_terms"), F.lit(1))
    level = F.least(F.greatest(F.floor(F.log2(most.cast("double"))), F.lit(1)), F.lit(LEVELS))

    def both(k: int) -> tuple[Column, Column]:
        x, y = (
            F.shiftrightunsigned(F.col(f"{s}.l{k // 4}"), 16 * (k % 4)).bitwiseAND(F.lit(0xFFFF).cast("long")) for s in (a, b)
        )
        told = (level <= _level(k)) & ((x != 0) | (y != 0))
        return told.cast("int"), (told & (x == y)).cast("int")

    pairs = [both(k) for k in range(LANES)]
    told, equal = (F.aggregate(F.array(*p), F.lit(0), lambda s, v: s + v) for p in zip(*pairs, strict=True))
    whole = F.col(f"{a}.whole") == F.col(f"{b}.whole")
    return F.when(whole, 1.0).when(told > 0, equal / told).otherwise(0.0)


def _printed(side: str) -> Column:
    parts = [F.lpad(F.hex(F.col(f"{side}.n_terms")), 8, "0")]
    parts += [F.lpad(F.hex(F.col(f"{side}.{c}")), 16, "0") for c in ("whole", *(f"l{j}" for j in range(LANES // 4)))]
    return F.lower(F.concat(*parts))


def _bucketed(docs: DataFrame) -> DataFrame:
    """doc_id, text, h (the text's hash) and b: ranges of doc_id of about equal row counts,
    as many as shuffle partitions; nulls in range 0."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = shuffle_parts(docs.sparkSession)
    points = rows.select(F.percentile_approx("doc_id", [i / n for i in range(n)], 10 * n).alias("p")).first().p or []
    cuts = F.array(*[F.lit(x).cast("long") for x in sorted(set(points))]) if points else F.array().cast("array<long>")
    b = F.size(F.filter(cuts, lambda c: c <= F.col("doc_id")))
    return rows.select("*", F.xxhash64("text").alias("h"), F.when(F.col("doc_id").isNull(), 0).otherwise(b).alias("b"))


def _followed(spans: DataFrame) -> DataFrame:
    """b and for_b: the range whose last row, downwards, is followed by b's first. One row
    for each range, so a window without keys is small here."""
    w = Window.orderBy("b")
    return spans.select("*", F.coalesce(F.lead("b").over(w), F.min("b").over(Window.partitionBy())).alias("for_b"))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, b, rn (place in b) and next_text, the text of the next row downwards by
    doc_id; after the last comes the first. The texts are shuffled once; only the first row
    of each range is sent to other tasks, so the broadcast is bounded by the partitions."""
    rows = _bucketed(docs)
    w = Window.partitionBy("b").orderBy(F.desc("doc_id"), F.desc("h"))
    tops = _followed(rows.groupBy("b").agg(F.max(F.struct("doc_id", "h")).alias("top")))
    is_top = rows["doc_id"].eqNullSafe(tops["top.doc_id"]) & (rows["h"] == tops["top.h"]) & (rows["b"] == tops["b"])
    heads = rows.join(F.broadcast(tops), is_top).select("for_b", F.col("text").alias("head")).dropDuplicates(["for_b"])
    placed = rows.select("doc_id", "text", "b", F.row_number().over(w).alias("rn"), F.lead("text").over(w).alias("follower"))
    return placed.join(F.broadcast(heads), placed["b"] == heads["for_b"]).select(
        "doc_id", "text", "b", "rn", F.coalesce("follower", "head").alias("next_text")
    )


def fingerprint_with_edits(
    docs: DataFrame, min_idf: float = math.log(4), max_idf: float = math.log(1000), broadcast_terms: int = 1_000_000
) -> DataFrame:
    """Fingerprints of each text and of its edited text (the last third replaced by the
    start of the next row's), with their likeness and that of the next row's fingerprint.

    The lexicon has at most (mean distinct terms of a document) x e^max_idf terms, however
    many documents there are; it is sent to all tasks if under ``broadcast_terms``, else
    joined by shuffle."""
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    words = lexicon(base, min_idf, max_idf)
    if words.count() <= broadcast_terms:
        words = F.broadcast(words)
    n = F.length("text")
    gone = F.floor(n / 3).cast("int")
    texts = with_next(docs).select(
        "b", "rn", "doc_id", n.cast("long").alias("n_chars"), "text",
        F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 3) as int))"),
                 F.substring("next_text", F.lit(1), gone)).alias("edited"),
    )
    listed = texts.select(
        "b", "rn", "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        F.array(F.struct(F.lit(0).alias("side"), terms("text").alias("terms")),
                F.struct(F.lit(1).alias("side"), terms("edited").alias("terms"))).alias("sides"),
    )
    whole = lambda i: F.xxhash64(F.sort_array(F.col("sides")[i]["terms"])).alias(f"whole{i}")
    keys = ["b", "rn", "doc_id", "n_chars", "edited_sha256", "whole0", "whole1"]
    spread = (
        listed.select("b", "rn", "doc_id", "n_chars", "edited_sha256", whole(0), whole(1), F.explode("sides").alias("x"))
        .select(*keys, "x.side", F.explode(F.concat("x.terms", F.array(F.lit(SENTINEL).cast("long")))).alias("term"))
        .join(words, "term")
    )
    sums = []
    for side in (0, 1):
        here = F.col("side") == side
        lanes = [F.coalesce(F.bit_xor(F.when(here, F.col(f"l{j}"))), F.lit(0).cast("long")).alias(f"l{j}") for j in range(LANES // 4)]
        count = F.count(F.when(here & (F.col("term") != SENTINEL), 1)).alias("n_terms")
        sums.append((count, lanes))
    flat = spread.groupBy(*keys).agg(
        *[c.alias(f"s{i}_n_terms") for i, (c, _) in enumerate(sums)],
        *[x.alias(f"s{i}_l{j}") for i, (_, lanes) in enumerate(sums) for j, x in enumerate(lanes)],
    )
    side = lambda i: F.struct(
        F.col(f"s{i}_n_terms").alias("n_terms"), F.col(f"whole{i}").alias("whole"),
        *[F.col(f"s{i}_l{j}").alias(f"l{j}") for j in range(LANES // 4)],
    )
    prints = flat.select("b", "rn", "doc_id", "n_chars", "edited_sha256", side(0).alias("own"), side(1).alias("changed"))
    w = Window.partitionBy("b").orderBy("rn")
    heads = _followed(prints.where("rn = 1").select("b", F.col("own").alias("head"))).select("for_b", "head")
    placed = prints.select("*", F.lead("own").over(w).alias("follower"))
    near = placed.join(F.broadcast(heads), placed["b"] == heads["for_b"]).withColumn("after", F.coalesce("follower", "head"))
    return near.select(
        "doc_id", "n_chars", "edited_sha256",
        _printed("own").alias("fingerprint"), _printed("changed").alias("edited_fingerprint"),
        likeness("own", "changed").alias("near_edited"), likeness("own", "after").alias("near_next"),
    )
