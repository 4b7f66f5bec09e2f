import pytest
from pyspark.sql import functions as F

from weftwork.operators.dedup import dedup_by_key, distinct_payloads
from weftwork.operators.joins import adaptive_join, fits_broadcast, sized_join
from weftwork.operators.metrics import one_per_partition, reconcile, sized_partitions


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows has key 7, some have no key, and there are copies."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 50)
    return spark.range(3000).repartition(6).select(key.alias("k"), (F.col("id") % 4).alias("v"))


@pytest.fixture(scope="module")
def lookup(spark):
    """Keys 0 to 39, key 7 three times."""
    return spark.range(42).select(F.when(F.col("id") > 39, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("w"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_large_sides_give_the_plain_join(skewed, lookup, how):
    plain = skewed.join(lookup, "k", how)
    large = sized_join(skewed, lookup, ["k"], how, max_rows=10)
    assert large.columns == plain.columns
    assert large.exceptAll(plain).isEmpty() and plain.exceptAll(large).isEmpty()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_adaptive_join_splits_hot_keys_beside_an_aggregate(spark, how):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50)
        left = spark.range(0, 20000, numPartitions=8).select(key.alias("k"), F.col("id").alias("v"))
        right = spark.range(100).groupBy((F.col("id") % 40).alias("k")).agg(F.count("*").alias("n"))
        joined = adaptive_join(left, right, ["k"], how)
        plain = left.join(right, "k", how)
        assert joined.columns == plain.columns
        assert sorted(map(tuple, joined.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
        assert "(skew=true)" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_sized_join_broadcasts_only_within_the_bound(skewed, lookup):
    small = sized_join(skewed, lookup, ["k"], "left_semi")
    large = sized_join(skewed, lookup, ["k"], "left_semi", max_rows=10)
    assert "BroadcastHashJoin" in plan_of(small) and "_key_hash" not in plan_of(small)
    assert "_key_hash" in plan_of(large)
    assert small.exceptAll(large).isEmpty() and large.exceptAll(small).isEmpty()


def test_size_is_measured_in_rows_and_bytes(lookup):
    assert fits_broadcast(lookup)
    assert not fits_broadcast(lookup, max_rows=41)
    assert not fits_broadcast(lookup, max_bytes=100)



def test_dedup_is_deterministic_and_keeps_maps(spark):
    rows = [(1, 5, {"a": "x"}), (1, 9, {"a": "y"}), (1, 9, {"a": "z"}), (2, 1, None)]
    frame = spark.createDataFrame(rows, "k int, t int, m map<string,string>")
    for shuffled in (frame, frame.orderBy(F.desc("t")), frame.repartition(3)):
        last = {r["k"]: (r["t"], r["m"]) for r in dedup_by_key(shuffled, ["k"], ["t"]).collect()}
        assert last == {1: (9, {"a": "z"}), 2: (1, None)}
        first = {r["k"]: r["t"] for r in dedup_by_key(shuffled, ["k"], ["t"], keep="first").collect()}
        assert first == {1: 5, 2: 1}


def test_dedup_collapses_copies_before_its_one_shuffle(skewed):
    scan = skewed.sparkSession.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    tree = plan_of(dedup_by_key(scan, ["l_orderkey", "l_linenumber"])).split("\n\n")[0]
    assert "Window" not in tree
    assert tree.count("Aggregate") == 2 and tree.count("Exchange") == 1


def test_distinct_payloads(spark):
    frame = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "x")], "t string, p string")
    assert sorted(map(tuple, distinct_payloads(frame, "t", "p").collect())) == [("a", "x"), ("b", "x")]


def test_reconcile_counts_tasks_without_output(spark):
    schema = "res_id string, task_id string"
    inputs = spark.createDataFrame([("r", "1"), ("r", "1"), ("r", "2")], schema)
    outputs = spark.createDataFrame([("r", "1"), ("r", "1"), ("r", "1")], schema)
    found = sorted(map(tuple, reconcile(inputs, outputs).collect()))
    assert found == [("r", "1", 2, 3), ("r", "2", 1, 0)]


def test_partition_count_follows_the_size(spark):
    total_mb = 300_001_413 * 432 // (1024 * 1024)
    assert total_mb == 123_596
    assert sized_partitions(total_mb, current=8) == 482
    assert sized_partitions(500, current=8) == 8
    assert sized_partitions(500, current=21) == 1
    assert sized_partitions(100, current=21) == 21


def test_one_row_per_partition(spark):
    frame = spark.range(0, 100, numPartitions=5)
    assert one_per_partition(frame).count() == 5
