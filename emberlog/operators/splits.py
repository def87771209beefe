"""Exact, reproducible splits and label unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberlog.operators.ordered import ordered_running
from emberlog.session import range_parts

HASH_SPAN = 16**13


def hash_fraction(*parts: Column) -> Column:
    """Uniform number in [0, 1) from the md5 of the concatenated parts."""
    text = F.concat(*[p.cast("string") for p in parts])
    return hash_bits(text) / float(HASH_SPAN)


def hash_bits(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")


def shuffled_position(df: DataFrame, id_column: str, label: str, seed: int = 42) -> DataFrame:
    """``place`` (1-based) of each row in a seeded random order inside its label, and
    ``place_total``. Hash values are uniform, so equal-width hash ranges balance without
    looking at the data, and one huge class is spread over all ranges."""
    width = -(-HASH_SPAN // range_parts(df.sparkSession))
    keyed = df.withColumn("_h", hash_bits(F.concat(F.col(id_column).cast("string"), F.lit(f":{seed}"))))
    ranged = keyed.withColumn("_bucket", F.floor(F.col("_h") / width))
    placed = ordered_running(
        ranged, [label], ["_h", id_column], {"place": F.lit(1).cast("bigint")}, bucketed=True
    )
    return placed.drop("_h")


def stratified_split(df: DataFrame, id_column: str, label: str, shares: Mapping[str, float], seed: int = 42) -> DataFrame:
    """Add ``split``: every label is divided by ``shares`` with exact sizes."""
    placed = shuffled_position(df, id_column, label, seed)
    names = list(shares)
    split: Column = F.lit(names[-1])
    edge = 1.0
    cuts = []
    for name in names[:-1]:
        edge -= shares[name]
        cuts.append((name, round(1.0 - edge, 10)))
    for name, upto in reversed(cuts):
        limit = F.floor(F.col("place_total") * F.lit(upto) + 0.5)
        split = F.when(F.col("place") <= limit, name).otherwise(split)
    return placed.withColumn("split", split).drop("place", "place_total")


def stratified_folds(df: DataFrame, id_column: str, label: str, k: int = 3, seed: int = 42) -> DataFrame:
    placed = shuffled_position(df, id_column, label, seed)
    return placed.withColumn("fold", ((F.col("place") - 1) % k).cast("int")).drop("place", "place_total")


def label_priority_union(sources: Sequence[DataFrame], id_column: str, columns: Sequence[str]) -> DataFrame:
    """One row per id from several label sources, earlier sources win."""
    ranked = [s.select(id_column, *columns).withColumn("_p", F.lit(i)) for i, s in enumerate(sources)]
    union = reduce(lambda a, b: a.unionByName(b), ranked)
    return (
        union.groupBy(id_column)
        .agg(F.min_by(F.struct(*columns, "_p"), "_p").alias("x"))
        .select(id_column, *[f"x.{c}" for c in columns], F.col("x._p").alias("source"))
    )


def review_sample(df: DataFrame, id_column: str, stratum: Column, rates: Mapping[str, float], seed: int = 42) -> DataFrame:
    """Keep a fixed hash share of each stratum; strata without a rate are left out."""
    keep = None
    for name, rate in rates.items():
        keep = F.when(F.col("stratum") == name, rate) if keep is None else keep.when(F.col("stratum") == name, rate)
    marked = df.withColumn("stratum", stratum)
    return marked.where(hash_fraction(F.col(id_column), F.lit(f":{seed}")) < keep)
