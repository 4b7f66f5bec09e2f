"""The document index, files of other schemas, rejected records, and messages once over batches."""

import pytest
from pyspark.sql import functions as F

from weftwork.catalog.streams import web_mappings
from weftwork.operators.rejects import INCOMPLETE, SHORT_KEY, UNMAPPED, UNREADABLE
from weftwork.sinks.index import _IndexWriter, delete_from_index, read_index, write_index
from weftwork.sources.files import load_files, read_sequence, scan_files
from weftwork.sources.kafka import start_policy
from weftwork.streaming.jobs import start_alerts, start_distinct, start_transform

DOCUMENT = "collection string, id string, fields map<string,string>"


def docs(spark, *rows):
    return spark.createDataFrame([("c", i, {"v": v}) for i, v in rows], DOCUMENT)


def stored(spark, path):
    return {(r["collection"], r["id"]): r["fields"]["v"] for r in read_index(spark, path).collect()}


def test_an_index_replaces_by_id_and_deletes(spark, tmp_path):
    path = f"{tmp_path}/a b/index"
    assert stored(spark, path) == {}
    write_index(docs(spark, ("1", "a"), ("2", "b"), ("3", None)).repartition(3), path)
    write_index(docs(spark, ("2", "c"), ("4", "d")), path)
    assert stored(spark, path) == {("c", "1"): "a", ("c", "2"): "c", ("c", "3"): None, ("c", "4"): "d"}
    delete_from_index(spark, path, F.col("fields")["v"] == "c")
    assert set(stored(spark, path)) == {("c", "1"), ("c", "3"), ("c", "4")}
    write_index(docs(spark, ("2", "again")), path)
    assert stored(spark, path)["c", "2"] == "again"
    write_index(docs(spark, ("9", "z")), path, "overwrite")
    assert stored(spark, path) == {("c", "9"): "z"}
    write_index(docs(spark).limit(0), path)
    assert stored(spark, path) == {("c", "9"): "z"}


def test_a_failed_write_leaves_nothing_behind(spark, tmp_path):
    path = f"{tmp_path}/index"
    write_index(docs(spark, ("1", "a")), path)
    bad = spark.range(0, 1000, 1, 4).select(
        F.lit("c").alias("collection"), F.when(F.col("id") == 999, F.raise_error(F.lit("lost"))).otherwise(F.col("id").cast("string")).alias("id"),
        F.create_map(F.lit("v"), F.lit("x")).alias("fields"),
    )
    with pytest.raises(Exception, match="lost"):
        write_index(bad, path)
    assert stored(spark, path) == {("c", "1"): "a"}
    assert len(list((tmp_path / "index" / "log").iterdir())) == 1
    write_index(docs(spark, ("2", "b")), path)  # whatever a task that was still ending has left counts for nobody
    assert stored(spark, path) == {("c", "1"): "a", ("c", "2"): "b"}


def test_an_aborted_write_takes_its_files_away(tmp_path):
    writer, other = _IndexWriter(str(tmp_path), False), _IndexWriter(str(tmp_path), False)
    (tmp_path / "data").mkdir()
    names = [f"{writer._write}-0-1.parquet", f"{writer._write}-1-2.parquet", f"{other._write}-0-1.parquet"]
    for name in names:
        (tmp_path / "data" / name).write_bytes(b"")
    writer.abort([])
    assert [p.name for p in (tmp_path / "data").iterdir()] == names[2:]


def test_an_index_needs_its_keys(spark, tmp_path):
    with pytest.raises(Exception, match="lack"):
        write_index(spark.range(3), f"{tmp_path}/index")


def test_csv_files_of_other_headers_are_read_by_name(spark, tmp_path):
    folder = tmp_path / "with space"
    folder.mkdir()
    (folder / "1.csv").write_text("id,name\n1,Ann\n2,Bob\n")
    (folder / "2.csv").write_text('name,id,city\nCid,3,"Bonn, Rhein"\n')
    (folder / "3.csv").write_text("id,name\n4,Dora\n")
    (folder / "4.csv").write_text("id\nx5\n")
    found = {(r["id"], r["name"], r["city"]) for r in load_files(spark, str(folder), "csv", header="true").collect()}
    assert found == {("1", "Ann", None), ("2", "Bob", None), ("3", "Cid", "Bonn, Rhein"), ("4", "Dora", None), ("x5", None, None)}
    typed = scan_files(spark, [str(folder), f"{tmp_path}/absent"], "csv", header="true", inferSchema="true")
    assert {r["id"] for r in typed.collect()} == {"1", "2", "3", "4", "x5"}
    some = read_sequence(spark, str(folder), 1, "csv", ".csv", header="true")  # the cursor is a sequence itself
    assert some.count() == 0 and read_sequence(spark, str(folder), -1, "csv", ".csv", header="true").count() == 5
    assert {r["city"] for r in read_sequence(spark, str(folder), 3, "csv", ".csv", header="true").collect()} == {None, "Bonn, Rhein"}


def test_columns_of_files_that_merge_stay(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "x int, y string").write.json(f"{tmp_path}/j/1.json")
    spark.createDataFrame([(2.5, True)], "z double, x2 boolean").write.json(f"{tmp_path}/j/2.json")
    found = load_files(spark, f"{tmp_path}/j", "json", recursiveFileLookup="true")
    assert sorted(found.columns) == ["x", "x2", "y", "z"] and found.count() == 2


def _stream(spark, folder, *batches, time=False):
    for rows in batches:
        spark.createDataFrame(rows, "key string, value string, moment timestamp").coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema("key string, value string, moment timestamp").option("maxFilesPerTrigger", 1).parquet(folder)


def test_every_record_is_accepted_or_rejected_with_a_reason(spark, tmp_path):
    value = '{"event_id": 1, "user_id": 2, "event_type": "view", "resId": "r"}'
    cases = {
        "1@view@r@t": None, "1@view": SHORT_KEY, "x@view@r@t": SHORT_KEY, None: SHORT_KEY, "": SHORT_KEY,
        "2@absent@r@t": UNMAPPED, "3@view@r@t": INCOMPLETE, "4@view@r@t": UNREADABLE, "5@view@r@t": UNREADABLE, "6@click@r@t": None,
    }
    values = {"3@view@r@t": '{"user_id": 2}', "4@view@r@t": "no json", "5@view@r@t": None}
    rows = [(k, values.get(k, value), None) for k in cases]
    stream, out = _stream(spark, f"{tmp_path}/in", rows[:5], rows[5:]), f"{tmp_path}/out"
    start_transform(stream, web_mappings(spark), out, f"{out}/checkpoint", None, with_rejected=True).awaitTermination()
    rejected = spark.read.parquet(f"{out}/rejected")
    assert {r["key"]: r["reason"] for r in rejected.collect()} == {k: reason for k, reason in cases.items() if reason}
    assert rejected.count() + spark.read.parquet(f"{out}/messages").count() == len(rows)


def test_equal_messages_count_once_over_batches_and_restarts(spark, tmp_path):
    from datetime import datetime, timedelta

    at = lambda minutes: datetime(2024, 1, 1) + timedelta(minutes=minutes)
    folder, out = f"{tmp_path}/in", f"{tmp_path}/out"

    def run(*batches):
        stream = _stream(spark, folder, *batches)
        start_distinct(stream, "moment", "1 hour", ["key", "value"], out, f"{tmp_path}/checkpoint", None).awaitTermination()
        return sorted((r["key"], r["value"], r["moment"]) for r in spark.read.parquet(out).collect())

    first = run([("a", "1", at(0)), ("b", None, at(1)), ("a", "1", at(2))], [("a", "1", at(3)), ("a1", "", at(3)), ("a", "2", at(3))])
    assert [(k, v) for k, v, _ in sorted(first, key=str)] == sorted([("a", "1"), ("a", "2"), ("a1", ""), ("b", None)], key=str)
    again = run([("a", "2", at(9)), ("b", None, at(9)), ("c", "3", at(300))])
    assert len(again) == 5
    # once the watermark has passed, the state of a message is gone: an equal one is a new one
    assert len(run([("a", "2", at(301))], [("a", "2", at(302))])) == 6


def test_alerts_on_a_property_whose_id_holds_dots(spark, tmp_path):
    rows = [("k1", '{"body": {"a.b c": {"type": "text", "value": "7"}}}', None), ("k2", '{"body": {"a": {"value": "7"}}}', None), ("k3", "no", None)]
    stream = _stream(spark, f"{tmp_path}/in", rows).select("key", "value")
    listed = spark.createDataFrame([("7",)], "number string")
    start_alerts(stream, listed, "a.b c", f"{tmp_path}/out", f"{tmp_path}/checkpoint", None).awaitTermination()
    assert [r["key"] for r in spark.read.parquet(f"{tmp_path}/out").collect()] == ["k1"]


def test_a_jump_begins_a_checkpoint_of_its_own(spark, tmp_path):
    value = '{"event_id": 1, "user_id": 2, "event_type": "view", "resId": "r"}'
    stream = _stream(spark, f"{tmp_path}/in", [("1@view@r@t", value, None)])
    for policy in (start_policy(), start_policy(), start_policy("MODIFY")):
        start_transform(stream, web_mappings(spark), f"{tmp_path}/out", f"{tmp_path}/checkpoint", None, policy=policy).awaitTermination()
    checkpoints = sorted(p.name for p in (tmp_path / "checkpoint").iterdir())
    assert "standing" in checkpoints and len(checkpoints) == 2
