"""Model, chunk, vector and retrieval queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from emberlog.functions.binning import finite_or_zero
from emberlog.operators import boosting as bo
from emberlog.operators import chunks as ch
from emberlog.operators import features as ft
from emberlog.operators import iforest as fo
from emberlog.operators import models as md
from emberlog.operators import splits as sp
from emberlog.operators import tuning as tu
from emberlog.operators import vector_index as vi
from emberlog.operators import vectors as ve
from emberlog.operators.evaluate import evaluate_models
from emberlog.operators.labels import confidence_tier
from emberlog.plans.log_queries import labelled
from emberlog.plans.registry import query
from emberlog.session import stored
from emberlog.sources.tables import spread, table

TRIALS, FOLDS = 30, 3
#: Items that an indexed query may be compared with in a small collection.
LEAST_SEEN, RECALL_SHARE = 128, 0.8


def training_table(spark, sf_dir):
    """Labelled features as a vector with a persisted split column.

    Every model reads it several times, so it is written once. The split reads its input
    twice, so the rows are written before it too, or the windows would run twice.
    """
    frame = labelled(spark, sf_dir).withColumnRenamed("is_anomaly", "label")
    names = [c for c in ft.numeric_features(frame) if c not in ("event_id", "label")]
    vectors = stored(ft.clean_vector(frame, names).select(F.col("event_id").alias("id"), "label", "features"))
    split = sp.stratified_split(vectors, "id", "label", {"train": 0.7, "val": 0.15, "test": 0.15})
    return stored(split), names


@query("booster_comparison")
def booster_comparison(spark, sf_dir):
    """Both boosters from one job over all rows but the test split, and judged on that."""
    data, _ = training_table(spark, sf_dir)
    fitting = data.where("split <> 'test'")
    binned = bo.bin_rows(fitting, group=(F.col("split") == "val").cast("int"))
    a, b = bo.fit_models(spark, binned, [(bo.TREES_A, 1), (bo.TREES_B, 1)])
    test = data.where("split = 'test'")
    # scored once: the evaluation reads the scores several times
    return evaluate_models(stored(a.predict(test, "booster_a").unionByName(b.predict(test, "booster_b"))))


@query("feature_importance")
def feature_importance(spark, sf_dir):
    data, names = training_table(spark, sf_dir)
    weighted = md.class_weights(data.where("split = 'train'"))
    (model,) = bo.fit_models(spark, bo.bin_rows(weighted, weight="weight"), [(bo.TREES_A, None)])
    rows = [(n, float(v)) for n, v in zip(names, model.importance(), strict=True)]
    return md.top_features(spark.createDataFrame(rows, "feature string, importance double"))


@query("parameter_search")
def parameter_search(spark, sf_dir):
    """30 trials on three folds, the best three fitted anew and judged on the test split."""
    data, _ = training_table(spark, sf_dir)
    trials, binned = tu.search(data.where("split <> 'test'").drop("split"), TRIALS, FOLDS)
    variants = stored(tu.best_variants(tu.trials_table(spark, trials)))
    test = data.where("split = 'test'")
    fitted = [model.predict(test, name) for name, model in tu.fit_variants(spark, variants, binned).items()]
    judged = evaluate_models(stored(reduce(lambda x, y: x.unionByName(y), fitted)))
    judged = judged.select(F.col("model").alias("variant_id"), F.col("f1_score").alias("test_f1"), F.col("auc_roc").alias("test_auc"))
    return variants.join(judged, "variant_id")


def numeric_points(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    inputs = [F.col("value"), F.hour("ts"), F.weekday("ts"), F.get_json_object("props", "$.k")]
    return events.select(F.col("event_id").alias("id"), F.array(*[finite_or_zero(c) for c in inputs]).alias("x"))


@query("isolation_forest_summary")
def isolation_forest_summary(spark, sf_dir):
    from emberlog.operators.evaluate import score_summary

    points = numeric_points(spark, sf_dir)
    forest = fo.fit_isolation_forest(points, "id", "x")
    return score_summary(fo.predict_isolation(forest, points, "x"), "decision", "prediction")


@query("pseudo_label_tiers")
def pseudo_label_tiers(spark, sf_dir):
    points = numeric_points(spark, sf_dir)
    forest = fo.fit_isolation_forest(points, "id", "x")
    tiers = confidence_tier(fo.signed_confidence(fo.predict_isolation(forest, points, "x")))
    labels = fo.pseudo_labels(tiers, "id").withColumnRenamed("label", "pseudo")
    return tiers.join(labels, "id", "left").groupBy("tier", "pseudo").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- chunks

CHUNKS = """lines AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents WHERE length(text) > 512),
walk(doc_id, i, cur, done) AS (
  SELECT doc_id, 0::BIGINT, '', NULL::VARCHAR FROM lines
  UNION ALL
  SELECT w.doc_id, w.i + 1,
    CASE WHEN length(w.cur) + length(s.l[w.i + 1]) <= 512 THEN concat(w.cur, s.l[w.i + 1], chr(10)) ELSE concat(s.l[w.i + 1], chr(10)) END,
    CASE WHEN length(w.cur) + length(s.l[w.i + 1]) > 512 AND w.cur <> '' THEN w.cur END
  FROM walk w JOIN lines s USING (doc_id) WHERE w.i < len(s.l)),
raw_chunks AS (
  SELECT doc_id, i, done AS c FROM walk WHERE done IS NOT NULL
  UNION ALL SELECT w.doc_id, w.i + 1, w.cur FROM walk w JOIN lines s USING (doc_id) WHERE w.i = len(s.l)
  UNION ALL SELECT doc_id, 0, text FROM documents WHERE length(text) <= 512),
chunks AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INTEGER) AS chunk_no,
  CASE WHEN i = 0 THEN c ELSE regexp_replace(c, '^\\s+|\\s+$', '', 'g') END AS text FROM raw_chunks)"""


def document_chunks(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return ch.chunk_rows(docs, text="text", metadata={"lang": F.lit("any")})


@query("chunk_documents", f"WITH RECURSIVE {CHUNKS} SELECT doc_id, chunk_no, md5(text) AS id FROM chunks")
def chunk_documents(spark, sf_dir):
    return document_chunks(spark, sf_dir).select("doc_id", "chunk_no", "id")


@query(
    "chunk_metadata",
    f"""WITH RECURSIVE {CHUNKS} SELECT source, 'INFO' AS log_level, count(*) AS n FROM chunks JOIN documents d USING (doc_id) GROUP BY 1, 2""",
)
def chunk_metadata(spark, sf_dir):
    return document_chunks(spark, sf_dir).groupBy("source", "log_level").agg(F.count(F.lit(1)).alias("n"))


@query(
    "upsert_points",
    """SELECT md5(text) AS id, max(seq) AS seq FROM (SELECT text, doc_id AS seq FROM documents
  UNION ALL SELECT text, doc_id + 1000000 FROM documents WHERE doc_id % 5 = 0) GROUP BY 1""",
)
def upsert_points(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(ch.content_id(F.col("text")).alias("id"), F.col("doc_id").alias("seq"))
    changes = table(spark, sf_dir, "documents").where("doc_id % 5 = 0").select(
        ch.content_id(F.col("text")).alias("id"), (F.col("doc_id") + 1000000).alias("seq")
    )
    return ch.upsert(docs, changes)


@query(
    "collection_stats",
    "SELECT count(*) AS points_count, count(DISTINCT md5(text)) AS vectors_count FROM documents",
)
def collection_stats(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return ve.collection_stats(docs.select(ch.content_id(F.col("text")).alias("id")))


@query("embed_text", "SELECT conv_id, count(*) AS n, 1.0::DOUBLE AS length FROM conversations GROUP BY 1")
def embed_text(spark, sf_dir):
    talk = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    vectors = ch.embed(ch.fit_text_vectors(talk), talk)
    size = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    return vectors.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.max(F.round(F.sqrt(size), 3)).alias("length"))


# ---------------------------------------------------------------- search

TOP = """sims AS (SELECT a.vec_id AS query_id, b.vec_id AS item_id,
    round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9) AS score
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
hits AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS INTEGER) AS rank FROM sims
  WHERE score >= {t} QUALIFY rank <= {k})"""


def search(spark, sf_dir, k, threshold):
    points = table(spark, sf_dir, "embeddings")
    return ve.cosine_top_k(
        points.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector")),
        points.select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("vector")),
        k, threshold, skip_same=True,
    )


@query(
    "cosine_top_k",
    f"WITH {TOP.format(t=0.2, k=5)} SELECT query_id, item_id, rank, round(score, 6) AS score FROM hits",
)
def cosine_top_k(spark, sf_dir):
    return search(spark, sf_dir, 5, 0.2).select("query_id", "item_id", "rank", F.round("score", 6).alias("score"))


@query(
    "indexed_search",
    f"WITH {TOP.format(t=0.3, k=5)} SELECT query_id, item_id, rank, round(score, 6) AS score FROM hits",
)
def indexed_search(spark, sf_dir):
    """By inverted lists, every query made certain by a second round where needed."""
    points = table(spark, sf_dir, "embeddings")
    index = vi.build_index(points.select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("vector")))
    queries = points.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    found = vi.indexed_top_k(index, queries, 5, 0.3, skip_same=True)
    return found.select("query_id", "item_id", "rank", F.round("score", 6).alias("score"))


@query(
    "index_recall",
    """SELECT count(*) AS queries, true AS recall_met, true AS within_bound FROM embeddings""",
)
def index_recall(spark, sf_dir):
    """Recall of the first round alone against the exact grid (5 items of 0.3 at least): 0.95
    or more. The given vectors have no clusters, so that takes ``RECALL_SHARE`` of the items;
    near copies lie in the first lists."""
    points = table(spark, sf_dir, "embeddings")
    queries = stored(points.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector")))
    index = vi.build_index(queries.withColumnRenamed("query_id", "item_id"))
    most = max(LEAST_SEEN, int(index.sizes.sum() * RECALL_SHARE))
    near = vi.indexed_top_k(index, queries, 5, 0.3, skip_same=True, max_candidates=most, exact=False)
    truth = search(spark, sf_dir, 5, 0.3)
    met = truth.select("query_id", "item_id").join(near.select("query_id", "item_id", F.lit(1).alias("met")), ["query_id", "item_id"], "left")
    recall = met.agg(F.coalesce(F.avg(F.coalesce("met", F.lit(0))), F.lit(1.0)).alias("recall")).scalar()
    seen = vi.candidates_seen(index, queries, max_candidates=most)
    bound = max(most, int(index.sizes.max(initial=0)))
    found = seen.agg(F.count(F.lit(1)).alias("queries"), F.max("candidates").alias("most"))
    return found.select("queries", (recall >= 0.95).alias("recall_met"), (F.col("most") <= bound).alias("within_bound"))


@query(
    "retrieval_accuracy",
    f"""WITH {TOP.format(t=-1, k=5)}, j AS (SELECT query_id, avg(CAST(q.label = i.label AS INTEGER)) AS p, max(CAST(q.label = i.label AS INTEGER)) AS h
  FROM hits JOIN embeddings q ON q.vec_id = query_id JOIN embeddings i ON i.vec_id = item_id GROUP BY 1)
SELECT count(*) AS queries, round(avg(p), 6) AS precision_at_k, round(avg(h), 6) AS hit_rate FROM j""",
)
def retrieval_accuracy(spark, sf_dir):
    labels = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    out = ve.retrieval_accuracy(search(spark, sf_dir, 5, -1.0), labels, "query_id", "item_id", "vec_id", "label")
    return out.select("queries", F.round("precision_at_k", 6).alias("precision_at_k"), F.round("hit_rate", 6).alias("hit_rate"))


_PROMPT = ve.PROMPT_HEAD.replace("'", "''"), ve.PROMPT_TAIL.replace("'", "''"), ve.CONTEXT_HEAD


@query(
    "prompt_table",
    f"""WITH {TOP.format(t=0.6, k=3)}, ctx AS (SELECT query_id, count(*) AS n, string_agg(concat(CAST(rank AS VARCHAR), '. [', d.lang, '] ',
    substr(d.text, 1, 200), chr(10), '   Similarity: ', printf('%.2f', score), chr(10)), '' ORDER BY rank) AS lines
  FROM hits JOIN documents d ON d.doc_id = item_id GROUP BY 1)
SELECT e.vec_id AS query_id, CAST(coalesce(n, 0) AS INTEGER) AS similar_incidents, md5(concat('{_PROMPT[0]}', d.text, chr(10), 'Anomaly Score: ',
  printf('%.2f', e.label / 10.0), chr(10), CASE WHEN n > 0 THEN concat('{_PROMPT[2]}', lines) ELSE '' END, '{_PROMPT[1]}')) AS prompt_id
FROM embeddings e JOIN documents d ON d.doc_id = e.vec_id LEFT JOIN ctx ON ctx.query_id = e.vec_id""",
)
def prompt_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    points = table(spark, sf_dir, "embeddings")
    anomalies = points.join(docs, F.col("vec_id") == F.col("doc_id")).select(
        F.col("vec_id").alias("query_id"), F.col("text").alias("log"), (F.col("label") / 10.0).alias("anomaly_score")
    )
    items = docs.select(F.col("doc_id").alias("item_id"), "text", F.col("lang").alias("log_level"))
    out = ve.prompt_table(anomalies, search(spark, sf_dir, 3, 0.6), items)
    return out.select("query_id", "similar_incidents", F.md5("prompt_used").alias("prompt_id"))
