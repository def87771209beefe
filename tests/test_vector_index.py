"""Inverted lists against the full comparison."""

import numpy as np
import pytest

from emberlog.operators import vector_index as vi
from emberlog.operators import vectors as ve


def points(spark, n=400, clusters=12, dim=16, spread=0.15):
    rng = np.random.default_rng(7)
    middle = rng.normal(size=(clusters, dim))
    rows = middle[rng.integers(clusters, size=n)] + spread * rng.normal(size=(n, dim))
    rows[5] = 0.0
    rows[7] = rows[6]
    data = [(i, rows[i].astype(float).tolist()) for i in range(n)] + [(n, None)]
    return spark.createDataFrame(data, "id int, vector array<float>")


def hits(df):
    return sorted((r.query_id, r.item_id, r.rank, r.score) for r in df.collect())


@pytest.mark.parametrize(("k", "threshold"), [(5, 0.7), (3, -1.0)])
def test_second_round_makes_it_exact(spark, k, threshold):
    df = points(spark)
    items, queries = df.withColumnRenamed("id", "item_id"), df.withColumnRenamed("id", "query_id")
    index = vi.build_index(items, lists=12)
    assert index.sizes.sum() == 400 and len(index.centres) == 12
    found = vi.indexed_top_k(index, queries, k, threshold, skip_same=True, max_candidates=60)
    known = queries.where("vector IS NOT NULL")
    assert hits(found) == hits(ve.cosine_top_k(known, items.where("vector IS NOT NULL"), k, threshold, skip_same=True))


def test_first_round_is_bounded_and_finds_clusters(spark):
    df = points(spark)
    items, queries = df.withColumnRenamed("id", "item_id"), df.withColumnRenamed("id", "query_id")
    index = vi.build_index(items, lists=12, sample_rows=100)
    near = set((r.query_id, r.item_id) for r in vi.indexed_top_k(index, queries, 5, 0.7, max_candidates=120, exact=False).collect())
    exact = [(q, i) for q, i, *_ in hits(vi.indexed_top_k(index, queries, 5, 0.7, max_candidates=120))]
    assert np.mean([h in near for h in exact]) > 0.95
    seen = vi.candidates_seen(index, queries, max_candidates=120).toPandas()
    assert seen["candidates"].max() <= max(120, index.sizes.max()) and len(seen) == 400


def test_hot_list_is_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(vi, "CORPUS_BLOCK", 16)
    monkeypatch.setattr(vi, "QUERY_BLOCK", 16)
    df = points(spark, n=120, clusters=1, spread=0.5)
    items, queries = df.withColumnRenamed("id", "item_id"), df.withColumnRenamed("id", "query_id")
    index = vi.build_index(items, lists=2)
    found = hits(vi.indexed_top_k(index, queries, 4, 0.0))
    assert found == hits(ve.cosine_top_k(queries.where("vector IS NOT NULL"), items.where("vector IS NOT NULL"), 4, 0.0))


def test_nothing_to_search(spark):
    empty = spark.createDataFrame([], "item_id int, vector array<float>")
    index = vi.build_index(empty)
    assert vi.indexed_top_k(index, empty.withColumnRenamed("item_id", "query_id")).count() == 0


def test_a_query_goes_to_a_shelf_once(spark):
    df = points(spark, n=300, clusters=1, spread=1.0).where("vector IS NOT NULL")
    index = vi.build_index(df.withColumnRenamed("id", "item_id"), lists=40)
    shelves = vi._shelves(index.sizes, 100)
    assert [i for first, after, _ in shelves for i in range(first, after)] == list(range(40)) and len(shelves) <= 8
    asked = df.select("id", df.vector.cast("array<float>").alias("v"))
    visits = vi._visits(index, asked, "id", 0.0, 300, False, shelves).toPandas()
    # all 40 lists, and still a row for each shelf only
    assert len(visits) == 300 * len(shelves) and not visits.duplicated(["q", "c"]).any()
    assert sum(bin(x).count("1") for b in visits["bits"] for x in b) == 300 * int((index.sizes > 0).sum())


def test_shelves_of_long_lists():
    assert vi._shelves(np.array([3, 4, 0, 25, 2, 0, 9]), 10) == [(0, 3, 1), (3, 4, 3), (4, 6, 1), (6, 7, 1)]


def test_seen_counts_come_with_each_query(spark):
    df = points(spark)
    index = vi.build_index(df.withColumnRenamed("id", "item_id"), lists=12)
    twice = df.unionByName(df.where("id = 3")).withColumnRenamed("id", "query_id")
    seen = vi.candidates_seen(index, twice, max_candidates=10_000).toPandas().set_index("query_id")
    assert seen.loc[3, "candidates"] == 800 and (seen["candidates"].drop(3) == 400).all() and len(seen) == 400
