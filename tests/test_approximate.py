"""Approximate neighbours: exact scores, measured recall, odd vectors, long lists."""

import numpy as np
import pytest

from pairsmith.operators import approximate, neighbours
from test_neighbours import as_float32, brute_force, clustered, found_by, frame


def recall(got, expected):
    return np.mean([len({d for d, _ in got[q]} & {d for d, _ in hits}) / len(hits) for q, hits in expected.items()])


@pytest.mark.parametrize("tile", [2048, 50])
def test_scores_are_exact_and_recall_is_high(spark, monkeypatch, tile):
    """Also with lists that are cut into many tiles."""
    monkeypatch.setattr(approximate, "TILE_ROWS", tile)
    monkeypatch.setattr(neighbours, "TILE_ROWS", tile)
    docs, queries = clustered(3000, 16, 1, copies=20), [(i + 9000, v) for i, v in clustered(200, 16, 2)]
    vectors = {**dict(docs), **dict(queries)}
    got = found_by(approximate.top_k(frame(spark, queries, "q"), frame(spark, docs, "d"), 10))
    assert all(abs(s - np.dot(vectors[q], vectors[d])) < 1e-6 for q, hits in got.items() for d, s in hits)
    assert all(hits == sorted(hits, key=lambda x: (-x[1], x[0])) and len(hits) == 10 for hits in got.values())
    assert recall(got, brute_force(queries, docs, 10)) >= 0.9


def test_all_lists_and_all_candidates_are_exact(spark):
    docs, queries = clustered(300, 10, 3, unit=False), clustered(40, 10, 4, unit=False)
    corpus = frame(spark, docs, "d")
    quantiser = approximate.fit(corpus, 300, parts=4)
    quantiser.probes = len(quantiser.centroids)
    got = found_by(approximate.top_k(frame(spark, queries, "q"), corpus, 5, rerank=60, quantiser=quantiser))
    assert got == brute_force(queries, docs, 5)


def test_an_index_serves_several_calls(spark):
    docs, queries = frame(spark, clustered(500, 8, 5), "d"), frame(spark, clustered(50, 8, 6), "q")
    quantiser = approximate.fit(docs, 500, k=3, lists=12)
    index = approximate.build(docs, quantiser)
    assert index.count() == 500 and index.select("cell").distinct().count() <= 12 and 1 <= quantiser.probes <= 12
    one = found_by(approximate.top_k(queries, docs, 3, quantiser=quantiser, index=index))
    assert one == found_by(approximate.top_k(queries, docs, 3, lists=12))


def test_vectors_without_clusters_meet_more_lists():
    rng = np.random.default_rng(0)
    scattered = rng.normal(size=(2000, 32))
    grouped = np.repeat(rng.normal(size=(40, 32)), 50, axis=0) + 0.02 * rng.normal(size=(2000, 32))
    few, many = (approximate._probes(v, approximate._means(v, 40, 1), 10, 0.97) for v in (rng.permutation(grouped), scattered))
    assert few < 8 < many <= 40


def test_odd_vectors(spark):
    docs, queries = as_float32([(1, [1.0, 0.0]), (2, [0.6, 0.8])]), as_float32([(5, [1.0, 0.0])])
    bad = spark.createDataFrame([(9, None), (8, []), (7, [float("nan"), 1.0]), (6, [None, 1.0])], "d long, vector array<float>")
    corpus, asked = frame(spark, docs, "d").unionByName(bad), frame(spark, queries, "q").unionByName(bad.withColumnRenamed("d", "q"))
    matched = approximate.top_k(asked, corpus, 4)
    assert matched.count() == 5 and found_by(matched) == {5: [(1, 1.0), (2, 0.6)]}
    assert approximate.top_k(asked, corpus.where("false"), 4).where("size(neighbours) = 0").count() == 5


def test_candidates_stay_in_their_slab(spark, monkeypatch):
    """Of a query's k * rerank candidates only the k best of each slab leave a task, with exact scores."""
    for module in (approximate, neighbours):
        monkeypatch.setattr(module, "TILE_ROWS", 50)
    monkeypatch.setattr(neighbours, "SLAB_TILES", 4)
    monkeypatch.setattr(neighbours, "SIDES", 2)
    docs, queries = clustered(900, 10, 3, copies=30), [(i + 9000, v) for i, v in clustered(120, 10, 4)]
    corpus, asked = frame(spark, docs, "d"), frame(spark, queries, "q")
    quantiser = approximate.fit(corpus, 900, parts=4)
    quantiser.probes = len(quantiser.centroids)
    held = approximate.build(corpus, quantiser).join(corpus, "d")
    rows = approximate._found(asked, held, quantiser, 900, 5, 100).collect()
    assert 120 * 5 <= len(rows) <= 120 * 5 * 9
    vectors = {**dict(docs), **dict(queries)}
    assert all(abs(r.score - np.dot(vectors[r.q], vectors[r.d])) < 1e-6 for r in rows)
    got = found_by(approximate.top_k(asked, corpus, 5, rerank=180, quantiser=quantiser))
    assert got == brute_force(queries, docs, 5)
