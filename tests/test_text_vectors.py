import numpy as np
import pytest
from pyspark.sql import functions as F

from emberlog.operators import chunks as ch
from emberlog.operators import vectors as ve


def chunk_by_hand(text, limit):
    if len(text) <= limit:
        return [text]
    done, cur = [], ""
    for line in text.split("\n"):
        if len(cur) + len(line) > limit:
            if cur:
                done.append(cur.strip())
            cur = ""
        cur += line + "\n"
    return done + [cur.strip()]


@pytest.mark.parametrize(
    "text",
    ["short", "\n".join(["Line 1"] * 100), "x" * 80, "a\n" + "y" * 90 + "\n\nb", "\n" * 60, "  lead\n" * 20, "é" * 51 + "\nz"],
)
def test_chunks(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(ch.chunk_lines(F.col("t"), 50).alias("c")).first().c
    assert got == chunk_by_hand(text, 50)
    if "Line 1" in text:
        assert all(len(c) <= 50 for c in got)


def test_chunk_rows_defaults(spark):
    df = spark.createDataFrame([("m", None)], "message string, level string")
    r = ch.chunk_rows(df).first()
    assert (r.text, r.log_level, r.source, r.chunk_no) == ("m", "INFO", "unknown", 0)
    assert r.id == "6f8f57715090da2632453988d9a1501b"


def test_upsert(spark):
    a = spark.createDataFrame([("x", 1, "old"), ("y", 1, "keep")], "id string, seq int, v string")
    b = spark.createDataFrame([("x", 2, "new"), ("z", 1, "add")], "id string, seq int, v string")
    assert {r.id: r.v for r in ch.upsert(a, b).collect()} == {"x": "new", "y": "keep", "z": "add"}


@pytest.mark.parametrize("blocks", [(4096, 32768), (7, 11)])
def test_top_k_equals_brute_force(spark, blocks):
    rng = np.random.default_rng(2)
    m = rng.normal(size=(60, 8)).astype(np.float32)
    m[10] = m[11] = m[12]  # ties
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "i int, vector array<float>")
    q, c = df.withColumnRenamed("i", "query_id"), df.withColumnRenamed("i", "item_id")
    got = ve.cosine_top_k(q, c, 4, 0.1, skip_same=True, query_block=blocks[0], corpus_block=blocks[1])
    u = m.astype(float) / np.linalg.norm(m.astype(float), axis=1, keepdims=True)
    sims = np.round(u @ u.T, 9)
    want = set()
    for i in range(60):
        order = sorted((j for j in range(60) if j != i and sims[i, j] >= 0.1), key=lambda j: (-sims[i, j], j))
        want |= {(i, j, r + 1) for r, j in enumerate(order[:4])}
    assert {(r.query_id, r.item_id, r["rank"]) for r in got.collect()} == want


def test_nothing_above_threshold(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "i int, vector array<float>")
    got = ve.cosine_top_k(df.withColumnRenamed("i", "query_id"), df.withColumnRenamed("i", "item_id"), 3, 0.5, skip_same=True)
    assert got.count() == 0


def test_prompt(spark):
    anomalies = spark.createDataFrame([(1, "disk full", 0.95), (2, "lonely", 0.5)], "query_id int, log string, anomaly_score double")
    hits = spark.createDataFrame([(1, 7, 0.91, 1), (1, 8, 0.8, 2)], "query_id int, item_id int, score double, rank int")
    items = spark.createDataFrame([(7, "x" * 300, "ERROR"), (8, "low space", "WARN")], "item_id int, text string, log_level string")
    got = {r.query_id: r for r in ve.prompt_table(anomalies, hits, items).collect()}
    assert "Log: disk full\nAnomaly Score: 0.95\n" in got[1].prompt_used
    assert "1. [ERROR] " + "x" * 200 + "\n   Similarity: 0.91\n2. [WARN] low space\n   Similarity: 0.80\n" in got[1].prompt_used
    assert got[1].similar_incidents == 2 and got[2].similar_incidents == 0
    assert "Similar past incidents" not in got[2].prompt_used and got[2].prompt_used.endswith("Analysis:")


def test_embed_with_custom_model(spark):
    df = spark.createDataFrame([("a",), ("bbb",)], "text string")
    got = ch.embed_with(df, lambda: lambda texts: [[len(t), 1] for t in texts])
    assert sorted(r.vector for r in got.collect()) == [[1.0, 1.0], [3.0, 1.0]]


def test_text_vectors_find_the_same_text(spark):
    df = spark.createDataFrame([(0, "disk is full on node one"), (1, "user logged in"), (2, "disk is full on node two")], "id int, text string")
    v = ch.embed(ch.fit_text_vectors(df), df).select("id", "vector")
    top = ve.cosine_top_k(v.withColumnRenamed("id", "query_id"), v.withColumnRenamed("id", "item_id"), 1, 0.0, skip_same=True)
    assert {r.query_id: r.item_id for r in top.where("query_id <> 1").collect()} == {0: 2, 2: 0}


def test_copies_of_rows_follow_the_cores_not_the_table(spark):
    copies = [sum(ve.grid(spark, n, n, ve.QUERY_BLOCK, ve.CORPUS_BLOCK)) for n in (10_000, 100_000, 600_000)]
    assert len(set(copies)) == 1
    rows, columns = ve.grid(spark, 50_000_000, 1000, ve.QUERY_BLOCK, ve.CORPUS_BLOCK)
    assert rows * ve.QUERY_BLOCK >= 50_000_000 and columns == 1
    assert ve.grid(spark, 0, 0, 10, 10) == (1, 1)


@pytest.mark.parametrize("threshold", [-1.0, 0.3])
def test_best_pairs_prunes_nothing_that_counts(threshold, monkeypatch):
    monkeypatch.setattr(ve, "PRODUCT_ROWS", 32)
    rng = np.random.default_rng(2)
    m = rng.normal(size=(300, 8)).astype(np.float32)
    m[40:90] = m[40]  # equal scores fall to the smaller id
    m[7] = 0
    m[9, 3] = np.nan
    ids, everything = rng.permutation(300), np.arange(300)
    place = np.argsort(np.argsort(ids))
    found = ve.best_pairs(m, m, ids, ids, place, 4, np.full(300, threshold), True, [(0, 130, everything), (130, 300, everything)])
    unit = ve.unit_rows(m.astype(float))
    score = np.round(unit @ unit.T, 9)
    want = set()
    for q in range(300):
        order = sorted((i for i in range(300) if i != q and score[q, i] >= threshold), key=lambda i: (-score[q, i], ids[i]))
        want |= {(q, i) for i in order[:4]}
    assert {(int(q), int(i)) for q, i in zip(*found[:2], strict=True)} == want and len(found[0]) == len(want)
