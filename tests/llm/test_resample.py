"""Importance resampling against plain counts, and its effect on held-out labels."""

import math
import random
from collections import Counter

from pyspark.sql import functions as F

from weftwork.llm import queries
from weftwork.llm.resample import buckets_for, kth_largest, resample

FOLDER = "/root/testdata/sf0.1"


def test_weights_equal_plain_models(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("abcde" if i % 4 else "xyz") for _ in range(rng.randrange(1, 20)))) for i in range(300)]
    labels = [(i, int(i % 4 > 0)) for i in range(0, 300, 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r.doc_id: r for r in resample(docs, spark.createDataFrame(labels, "doc_id long, quality int"), buckets=100_003).collect()}
    grams = lambda t: t.split() + list(zip(t.split(), t.split()[1:]))
    raw, target = Counter(), Counter()
    for i, t in rows:
        raw.update(grams(t))
        if (i, 1) in labels:
            target.update(grams(t))
    ratio = {g: math.log((target[g] + 1) / (sum(target.values()) + 100_003)) - math.log((raw[g] + 1) / (sum(raw.values()) + 100_003)) for g in raw}
    for i, t in rows:
        assert abs(found[i].log_weight - sum(ratio[g] for g in grams(t))) < 1e-9
        assert found[i].n_ngrams == len(grams(t))
    k = round(sum(y for _, y in labels) / len(labels) * 300)
    assert sum(r.kept for r in found.values()) == k
    assert min(r.gumbel_key for r in found.values() if r.kept) > max(r.gumbel_key for r in found.values() if not r.kept)


def test_good_documents_are_kept(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = queries.QUERIES["op2_importance"](spark, FOLDER).collect()
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    good = [r.kept for r in rows if labels.get(r.doc_id) == 1]
    bad = [r.kept for r in rows if labels.get(r.doc_id) == 0]
    assert sum(good) > 0.9 * len(good)
    assert sum(bad) < 0.5 * len(bad)


def test_kth_largest(spark):
    rng = random.Random(1)
    values = [rng.choice([1e9, -3.0, 2.5, rng.random()]) for _ in range(500)]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    for k in (1, 2, 100, 250, 499, 500, 900):
        assert kth_largest(frame, "v", k) == sorted(values, reverse=True)[min(k, 500) - 1]
    assert kth_largest(frame, "v", 0) is None and kth_largest(frame.limit(0), "v", 3) is None


def test_awkward_rows(spark):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "a b"), (3, "a b"), (4, "w " * 300000)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, kept int")
    labels = spark.createDataFrame([(3, 1), (None, 1), (4, None), (4, 0)], "doc_id long, quality int")
    found = resample(docs, labels, fraction=0.5).collect()
    assert len(found) == 6 and all(r.log_weight == 0 for r in found if r.n_ngrams == 0)
    assert len({r.kept for r in found if r.doc_id == 3}) == 1
    assert resample(docs.limit(0), labels).count() == 0
    assert resample(docs, labels.limit(0)).filter(F.col("kept")).count() == 6


def test_buckets_grow_with_the_corpus():
    sizes = [buckets_for(n) for n in (0, 10**6, 10**8, 10**10, 10**14)]
    assert sizes == [16_384, 16_384, 32_768, 262_144, 33_554_432]


def test_gumbel_keys_sample_in_proportion_to_weights(spark):
    # one document in ten is of the target's words: its weight is higher, so it is drawn more often, but not always
    rows = [(i, "good words here" if i % 10 == 0 else "other words here") for i in range(20_000)]
    labels = [(i, int(i % 10 == 0)) for i in range(0, 2000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = resample(docs, spark.createDataFrame(labels, "doc_id long, quality int"), fraction=0.1).collect()
    noise = sorted(r.gumbel_key - r.log_weight for r in found)
    for share in (0.1, 0.5, 0.9):  # quantiles of the standard Gumbel distribution
        assert abs(noise[int(share * len(noise))] + math.log(-math.log(share))) < 0.05
    weights = {bool(r.doc_id % 10 == 0): math.exp(r.log_weight) for r in found}
    kept = [r for r in found if r.kept]
    first = sorted(found, key=lambda r: -r.gumbel_key)[:400]  # early draws follow the weights of all rows
    expected = weights[True] / (weights[True] + 9 * weights[False])
    assert len(kept) == 2000 and abs(sum(r.doc_id % 10 == 0 for r in first) / 400 - expected) < 0.09
