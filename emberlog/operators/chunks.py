"""Message chunking and embedding points."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_CHUNK = 512
_STRIP = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def chunk_lines(text: Column, limit: int = MAX_CHUNK) -> Column:
    """Array of chunks: short texts stay whole, longer ones are packed line by line.

    A line longer than the limit stays in one piece. Chunks are stripped.
    """

    def strip(c: Column) -> Column:
        return F.regexp_replace(c, _STRIP, "")

    def step(state: Column, line: Column) -> Column:
        fits = F.length(state["open"]) + F.length(line) <= limit
        closed = F.when(fits | (state["open"] == ""), state["done"]).otherwise(
            F.array_append(state["done"], strip(state["open"]))
        )
        opened = F.concat(F.when(fits, state["open"]).otherwise(F.lit("")), line, F.lit("\n"))
        return F.struct(closed.alias("done"), opened.alias("open"))

    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))
    packed = F.aggregate(F.split(text, "\n"), start, step, lambda s: F.array_append(s["done"], strip(s["open"])))
    return F.when(F.length(text) <= limit, F.array(text)).otherwise(packed)


def content_id(text: Column) -> Column:
    return F.md5(text)


def chunk_rows(
    df: DataFrame, text: str = "message", timestamp: str | None = "timestamp", level: str | None = "level",
    source: str | None = "source", metadata: Mapping[str, Column] | None = None, limit: int = MAX_CHUNK,
) -> DataFrame:
    """One row per chunk with its metadata; absent columns take the defaults."""

    def column(name: str | None, default: str) -> Column:
        return F.col(name).cast("string") if name in df.columns else F.lit(default)

    meta = [x for key, c in (metadata or {}).items() for x in (F.lit(key), c.cast("string"))]
    body = F.coalesce(F.col(text), F.lit(""))
    keep = [c for c in df.columns if c not in (text, timestamp, level, source)]
    return df.select(
        *keep,
        F.posexplode(chunk_lines(body, limit)).alias("chunk_no", "text"),
        column(timestamp, "").alias("timestamp"),
        F.coalesce(column(level, "INFO"), F.lit("INFO")).alias("log_level"),
        F.coalesce(column(source, "unknown"), F.lit("unknown")).alias("source"),
        (F.create_map(*meta) if meta else F.create_map().cast("map<string,string>")).alias("metadata"),
    ).withColumn("id", content_id(F.col("text")))


def upsert(points: DataFrame, changes: DataFrame, id_column: str = "id", sequence: str = "seq") -> DataFrame:
    """Last write wins per id. An aggregate, so repeats of one id combine before the shuffle."""
    both = points.unionByName(changes)
    others = [c for c in both.columns if c != id_column]
    return both.groupBy(id_column).agg(F.max_by(F.struct(*others), sequence).alias("p")).select(
        id_column, *[f"p.{c}" for c in others]
    )


def fit_text_vectors(df: DataFrame, text: str = "text", dims: int = 1024, min_docs: int = 1) -> PipelineModel:
    """Built-in text vectors: hashed terms, inverse document frequency, unit length."""
    return Pipeline(
        stages=[
            RegexTokenizer(inputCol=text, outputCol="_terms", pattern=r"\W+", gaps=True),
            HashingTF(inputCol="_terms", outputCol="_tf", numFeatures=dims),
            IDF(inputCol="_tf", outputCol="_idf", minDocFreq=min_docs),
            Normalizer(inputCol="_idf", outputCol="_unit", p=2.0),
        ]
    ).fit(df)


def embed(model: PipelineModel, df: DataFrame, out: str = "vector") -> DataFrame:
    scored = model.transform(df).withColumn(out, vector_to_array("_unit", "float32"))
    return scored.drop("_terms", "_tf", "_idf", "_unit")


def embed_with(
    df: DataFrame, load: Callable[[], Callable[[list[str]], list]], text: str = "text", out: str = "vector"
) -> DataFrame:
    """Embed with any model: ``load`` runs once per task and returns a batch encoder."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + f", `{out}` array<float>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = load()
        for batch in batches:
            vectors = encode(batch[text].tolist())
            yield batch.assign(**{out: [[float(x) for x in v] for v in vectors]})

    return df.mapInPandas(run, schema)
