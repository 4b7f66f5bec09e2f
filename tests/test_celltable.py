"""The table of merged cells."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from weftwork.jobs import compact_cells
from weftwork.operators.cells import scan_cells
from weftwork.sinks.celltable import CELLS, NOTHING_MERGED, merge_batches, merge_cells, read_cells
from weftwork.sinks.tables import read_history, write_batch


def cells(spark, *rows):
    return spark.createDataFrame([(r, "property", q, v, ts, t) for t, r, q, v, ts in rows], CELLS)


def stored(spark, path, *bounds):
    return {(r.table_name, r.row_key, r.qualifier, r.since): r.value for r in read_cells(spark, path, *bounds).collect()}


def newest(rows):
    best = {}
    for t, r, q, v, ts in rows:
        key = (t, r, q, ts.date().replace(day=1))
        best[key] = max(best.get(key, (datetime.min, "")), (ts, v))
    return {k: v for k, (_, v) in best.items()}


def test_merging_keeps_the_newest_of_each_period_at_any_order(spark, tmp_path):
    rng, path, seen = random.Random(3), f"{tmp_path}/table", []
    for n in range(4):
        rows = [
            (rng.choice("ab"), str(rng.randrange(5)), rng.choice("xy"), str(rng.randrange(9)), datetime(2023, 11, 1) + timedelta(days=rng.randrange(120)))
            for _ in range(60)
        ]
        rows += rows[:3]
        seen += rows
        merge_cells(spark, cells(spark, *rows).withColumn("since", F.lit("mine")).repartition(5), path)
        assert stored(spark, path) == newest(seen)
    merge_cells(spark, cells(spark, *rows), path)
    merge_cells(spark, cells(spark).limit(0), path)
    assert stored(spark, path) == newest(seen)
    some = stored(spark, path, date(2023, 12, 1), date(2024, 2, 1))
    assert some == {k: v for k, v in newest(seen).items() if date(2023, 12, 1) <= k[3] < date(2024, 2, 1)}
    with pytest.raises(ValueError, match="first day"):
        read_cells(spark, path, date(2023, 12, 2))


def test_cells_without_a_place_and_nulls(spark, tmp_path):
    at, path = datetime(1969, 12, 31, 23, 59, 59), f"{tmp_path}/table"
    assert stored(spark, path) == {}
    rows = [("t", "1", "q", None, at), (None, "1", "q", "v", at), ("t", None, "q", "v", at), ("t", "1", None, "v", at), ("t", "1", "q", "v", None)]
    merge_cells(spark, cells(spark, *rows), path)
    assert stored(spark, path) == {("t", "1", "q", date(1969, 12, 1)): None}
    merge_cells(spark, cells(spark, ("t", "1", "q", "", at), ("a b/c=%", "é", "q", "v", at)), path)
    assert stored(spark, path) == {("t", "1", "q", date(1969, 12, 1)): "", ("a b/c=%", "é", "q", date(1969, 12, 1)): "v"}


def test_a_failed_merge_leaves_the_table_as_it_was(spark, tmp_path):
    path, at = f"{tmp_path}/table", datetime(2024, 1, 5)
    merge_cells(spark, cells(spark, ("t", "1", "q", "old", at)), path)
    bad = cells(spark, ("t", "1", "q", "new", at + timedelta(1)), ("t", "2", "q", "bad", at))
    bad = bad.withColumn("value", F.when(F.col("value") == "bad", F.raise_error(F.lit("no"))).otherwise(F.col("value")))
    with pytest.raises(PySparkException):
        merge_cells(spark, bad, path)
    assert stored(spark, path) == {("t", "1", "q", date(2024, 1, 1)): "old"}


def test_only_new_batches_and_touched_folders(spark, tmp_path):
    batches, path, at = f"{tmp_path}/batches", f"{tmp_path}/table", datetime(2024, 1, 5)
    assert merge_batches(spark, batches, path) == NOTHING_MERGED
    write_batch(cells(spark, ("t", "1", "q", "a", at)), batches, 0)
    write_batch(cells(spark, ("u", "1", "q", "a", at)), batches, 1)
    assert merge_batches(spark, batches, path) == 1
    write_batch(cells(spark, ("u", "2", "q", "whole", at)), batches, 1)  # the last one ran again
    write_batch(cells(spark, ("u", "1", "q", "b", at + timedelta(40))), batches, 2)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "table" / "table_name=t").rglob("*.parquet")}
    assert merge_batches(spark, batches, path, 1) == 2 and before
    assert before == {p: p.stat().st_mtime_ns for p in (tmp_path / "table" / "table_name=t").rglob("*.parquet")}
    assert sorted(stored(spark, path).values()) == ["a", "a", "b", "whole"]
    plan = scan_cells(read_cells(spark, path, date(2024, 2, 1), date(2024, 3, 1)), "u", ["q"])._jdf.queryExecution().toString()
    chosen = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    chosen = chosen[chosen.index("PartitionFilters") : chosen.index("PushedFilters")]
    assert "table_name" in chosen and "since" in chosen


def test_the_job_goes_on_where_it_stopped(spark, tmp_path):
    out, at = str(tmp_path), datetime(2024, 1, 5)
    compact_cells(spark, out)
    for n in range(3):
        write_batch(cells(spark, ("t", str(n), "q", str(n), at)), f"{out}/cells", n)
        compact_cells(spark, out)
    assert sorted(stored(spark, f"{out}/cell-table").values()) == ["0", "1", "2"]
    assert sorted(r.merged for r in read_history(spark, f"{out}/cell-history").collect()) == ["-1", "0", "1", "2"]
