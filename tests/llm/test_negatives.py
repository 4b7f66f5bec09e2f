"""Hard negatives against all pairs in plain integers."""

import math
import random

import numpy as np
import pytest

from weftwork.llm.negatives import Packing, hard_negatives, quantized

SCHEMA = "vec_id long, embedding array<float>, label int, anchor_id string, place int"


def plain(rows, every=100, positives=5, negatives=10):
    least = {}
    for i, v, y, *_ in rows:
        if i is None or v is None or y is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        y = (y + 1) % 10 if i % 7 == 0 else y
        v = [float(np.float32(x)) for x in v]
        if i not in least or (y, v) < least[i]:
            least[i] = (y, v)
    ints = {i: (y, [math.floor(256 * x) for x in v]) for i, (y, v) in least.items()}
    score = lambda a, b: max(-(2**63) + 1, min(2**63 - 1, sum(x * y for x, y in zip(ints[a][1], ints[b][1]))))
    result = set()
    for a in ints:
        if a % every:
            continue
        others = sorted((-score(a, b), b) for b in ints if b != a)
        for minus, p in [(s, b) for s, b in others if ints[b][0] == ints[a][0]][:positives]:
            fits = [(s, b) for s, b in others if ints[b][0] != ints[a][0] and -30 * minus <= -100 * s <= -90 * minus][:negatives]
            result |= {(a, p, k + 1, b, -minus, -s) for k, (s, b) in enumerate(fits)}
    return result


def found(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA).repartition(3)
    collected = [tuple(r) for r in hard_negatives(frame, **options).collect()]
    assert len(collected) == len(set(collected))
    return set(collected)


def clustered(seed, n=700, dimension=6, spread=0.4):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dimension)] for _ in range(4)]
    return [(i, [c + rng.gauss(0, spread) for c in rng.choice(centres)], rng.randrange(4)) for i in range(n)]


def test_equals_all_pairs(spark):
    rows = clustered(1)
    expected = plain(rows, every=20)
    assert len(expected) > 500 and found(spark, rows, every=20) == expected


def test_ties_repeats_and_rows_that_take_no_part(spark):
    rng = random.Random(2)
    rows = [(i, [float(rng.randrange(0, 3)) for _ in range(3)], rng.randrange(3)) for i in range(300)]
    rows += rows[:40] + [(i, [1.0, 2.0, 0.0], 1) for i in range(30)]  # repeated rows, ids with other vectors
    rows += [(None, [1.0] * 3, 1), (400, None, 1), (500, [1.0, None, 1.0], 1), (600, [1.0, float("nan"), 1.0], 1)]
    rows += [(700, [1.0, float("inf"), 1.0], 1), (800, [1.0] * 3, None), (900, [2.0], 2), (1000, [], 1)]
    expected = plain(rows, every=20)
    assert expected and found(spark, rows, every=20) == expected


def test_components_beyond_a_double(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) * 2.0 ** rng.randrange(0, 24) for _ in range(4)], rng.randrange(2)) for i in range(200)]
    expected = plain(rows, every=20)
    assert expected and found(spark, rows, every=20) == expected


def test_without_rows_or_anchors(spark):
    assert found(spark, []) == set()
    assert found(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == set()
    assert found(spark, [(100, [1.0], 1), (2, [1.0], 2)]) == set()  # no positive


@pytest.mark.parametrize("size", [1.0, 3.0, 1e3, 1e5, 1e9, 1e18])
def test_packed_products_are_exact(size):
    rng = np.random.default_rng(4)
    vectors = quantized(rng.normal(0, size, (37, 5)))
    anchors = quantized(rng.normal(0, size, (11, 5)))
    least, greatest = (int(f(np.concatenate([vectors, anchors]))) for f in (np.min, np.max))
    packing = Packing(5, least, greatest)
    assert packing.wide == (size > 1e4) and packing.fields >= 1
    scores = packing.scores(anchors, packing.pack(vectors), vectors)
    for i, a in enumerate(anchors.tolist()):
        for j, c in enumerate(vectors.tolist()):
            exact = sum(int(x) * int(y) for x, y in zip(a, c))
            assert scores[i, j] == max(-(2**63) + 1, min(2**63 - 1, exact))


def test_a_label_of_most_rows(spark):
    rows = [(i, v, 3 if i % 3 else y) for i, v, y in clustered(5, 400)]
    assert found(spark, rows, every=20) == plain(rows, every=20)


def test_anchors_in_blocks(spark, monkeypatch):
    import weftwork.llm.negatives as module

    monkeypatch.setattr(module, "BLOCK_BYTES", 8 * 6 * 9)
    rows = clustered(6, 300)
    assert found(spark, rows, every=10) == plain(rows, every=10)
