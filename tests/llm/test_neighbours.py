"""Nearest neighbours against brute force: recall, exact scores, order."""

import numpy as np
import pyarrow as pa
import pytest

from weftwork.llm import queries
from weftwork.llm.neighbours import grouped, nearest


def brute(ids, vectors, query, k=20):
    scores = vectors @ query
    return [ids[i] for i in np.lexsort((ids, -scores))]


def check(rows, ids, vectors, wanted):
    place, by_query = {i: n for n, i in enumerate(ids)}, {}
    for r in rows:
        by_query.setdefault(r.query_id, []).append(r)
    hits = total = 0
    for i in ids:
        if i % 20:
            assert i not in by_query
            continue
        found = sorted(by_query[i], key=lambda r: r.rank)
        assert [r.rank for r in found] == list(range(1, len(found) + 1)) and i not in [r.vec_id for r in found]
        for r in found:
            assert abs(r.score - float(vectors[place[r.vec_id]] @ vectors[place[i]])) < 1e-9
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)
        true = [x for x in brute(np.array(ids), vectors, vectors[place[i]]) if x != i][:20]
        least = vectors[place[true[-1]]] @ vectors[place[i]] - 1e-9
        hits += sum(r.score >= least for r in found)
        total += len(true)
    assert hits >= wanted * total
    return hits / total


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1"])
def test_query(spark, folder):
    folder = f"/root/testdata/{folder}"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, vectors = [r.vec_id for r in rows], np.array([r.embedding for r in rows], dtype=np.float64)
    print(check(queries.QUERIES["op3_neighbours"](spark, folder).collect(), ids, vectors, 0.93))


def test_one_vector_in_a_third_of_the_rows(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(6000, 8)) * rng.random((6000, 1)) * 3
    vectors[::3] = vectors[0]
    rows = [(i, v.tolist(), "x") for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, leaf string").repartition(6)
    found = nearest(frame, sample=1500, leaf=30).collect()
    check(found, list(range(6000)), vectors, 0.93)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (20, None), (40, []), (60, [0.0, 0.0]), (80, [1.0, None]), (100, [nan, 1.0]), (120, [inf, 1.0])]
    rows += [(None, [1.0, 1.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [5.0, 5.0, 5.0]), (1, [1.0, 0.0]), (-20, [-1.0, 1.0])]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, rank int")
    found = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in nearest(frame).collect())
    assert found == [
        (-20, 1, 0, 1.0), (-20, 2, 1, -1.0), (-20, 3, 1, -1.0), (-20, 4, 2, -1.0),
        (0, 1, -20, 1.0), (0, 2, 1, 1.0), (0, 3, 1, 1.0), (0, 4, 2, 1.0),
    ]
    assert nearest(frame.limit(0)).count() == 0
    assert nearest(frame.filter("vec_id = 60")).count() == 0
    assert nearest(frame.filter("vec_id = 0")).count() == 0


@pytest.mark.parametrize("sample", [20_000, 5_000])
def test_recall_on_fifty_thousand_vectors(spark, sample):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 32))
    vectors = (centres[rng.integers(0, 40, 50_000)] + rng.normal(size=(50_000, 32)) * 0.8).astype(np.float32).astype(np.float64)
    ids = np.arange(50_000)
    frame = spark.createDataFrame(pa.table({"vec_id": ids, "embedding": pa.array(list(vectors))}))
    rows = nearest(frame, every=100, sample=sample).collect()
    hits = total = 0
    by_query = {}
    for r in rows:
        by_query.setdefault(r.query_id, []).append(r)
    for q in range(0, 50_000, 100):
        scores = vectors @ vectors[q]
        scores[q] = -np.inf
        least = np.partition(scores, -20)[-20] - 1e-9
        hits += sum(r.score >= least for r in by_query[q])
        total += 20
    assert hits >= 0.95 * total


def test_leaves_are_grouped_without_loss():
    group, blocks = grouped(np.array([3, 0, 4, 30, 1, 9, 2, 10, 0]), 10)
    assert group.tolist() == [0, 0, 0, 1, 2, 2, 3, 4, 4] and blocks.tolist() == [1, 3, 1, 1, 1]
    assert grouped(np.zeros(0, np.int64), 10)[1].tolist() == []
