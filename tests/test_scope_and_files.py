import pytest
from pyspark.sql import functions as F

from weftwork.operators.documents import latest_documents, stamped
from weftwork.operators.selection import (
    active_watchlist,
    effective_sequences,
    exclude_resources,
    last_task_time,
    latest_row,
    replay_filter,
    sorted_sequences,
    watched,
)
from weftwork.plans.model import load_changes, load_date_patterns
from weftwork.plans.scope import changed_types, cursor_of, has_cursor, plan_changes, task_scope, upsert_cursor
from weftwork.session import shared_folder
from weftwork.sinks.tables import (
    CursorStore,
    append_history,
    read_history,
    write_cells,
    write_documents,
)
from weftwork.sources.config import jdbc_options, matching, read_collection
from weftwork.sources.files import (
    dealt_out,
    list_files,
    list_schemas,
    read_sequence,
    read_text_lines,
    scan_files,
    sequence_files,
)
from weftwork.sources.kafka import start_policy

CURSOR = "model string, kind string, type_id string, update_id string, data_schema_id string, seq_id bigint"


def ids(spark, *numbers):
    return spark.createDataFrame([(n,) for n in numbers], "sequence_id bigint")


@pytest.mark.parametrize(
    "cursor, expected",
    [
        (12100, [11111, 12121]),
        (12121, [11111]),
        (11111, []),
        (5, [11111]),
        (99999, [11111, 12121, 33333]),
        (-1, [11111, 12121, 33333]),
    ],
)
def test_effective_sequences(spark, cursor, expected):
    found = sorted_sequences(effective_sequences(ids(spark, 11111, 33333, 12121), cursor))
    assert [r[0] for r in found.collect()] == expected


@pytest.mark.parametrize("cursor, expected", [(150, {100, 200}), (200, {100}), (-1, {100, 200, 300}), (1000, {100, 200, 300})])
def test_sequence_files_are_chosen_by_name(spark, tmp_path, cursor, expected):
    import pyarrow as pa
    import pyarrow.parquet as pq

    for number in (100, 200, 300):
        pq.write_table(pa.table({"v": [number]}), f"{tmp_path}/{number}.parquet")
    pq.write_table(pa.table({"v": [0]}), f"{tmp_path}/other.parquet")
    assert {r["sequence_id"] for r in sequence_files(spark, str(tmp_path)).collect()} == {100, 200, 300}
    assert {r["v"] for r in read_sequence(spark, str(tmp_path), cursor).collect()} == expected


def test_files_not_chosen_are_not_opened(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    for number in (100, 200):
        pq.write_table(pa.table({"v": [number]}), f"{tmp_path}/{number}.parquet")
    (tmp_path / "300.parquet").write_text("this is not parquet")
    frame = spark.read.schema("v bigint").format("parquet")
    assert frame.load(str(tmp_path)).filter(F.col("_metadata.file_name") < "250").count() == 2


def test_scan_skips_absent_paths(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "x int, y string").write.parquet(f"{tmp_path}/read")
    spark.createDataFrame([(2, 5)], "x int, z int").write.parquet(f"{tmp_path}/compact")
    found = scan_files(spark, [f"{tmp_path}/{p}" for p in ("read", "compact", "absent")])
    assert sorted(map(tuple, found.collect()), key=str) == [(1, "a", None), (2, None, 5)]
    with pytest.raises(FileNotFoundError):
        scan_files(spark, [f"{tmp_path}/absent"])


def test_text_files_by_extension_one_level_deep(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo\n")
    (tmp_path / "b.csv").write_text("three\n")
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "c.txt").write_text("four\n")
    assert sorted(r[0] for r in read_text_lines(spark, str(tmp_path)).collect()) == ["one", "two"]
    assert {r["name"] for r in list_files(spark, str(tmp_path)).collect()} == {"a.txt", "b.csv"}


def test_schemas_are_the_sub_folders(spark, tmp_path):
    base = tmp_path / "data"
    for name in ("s1", "data_schema_id=s2", "data"):
        (base / name / "x").mkdir(parents=True)
        (base / name / "x" / "f.avro").write_text("content")
    (base / "top.avro").write_text("content")
    assert sorted(r[0] for r in list_schemas(spark, str(base)).collect()) == ["data", "s1", "s2"]


def test_collections_are_filtered_by_equality(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"code": "a", "v": 1}\n{"code": "b"}\n')
    documents = read_collection(spark, f"{tmp_path}/c.json")
    assert matching(documents, "code", "a").count() == 1
    parsed = read_collection(spark, f"{tmp_path}/c.json", fmt="json")
    assert matching(parsed, "code", "b").count() == 1


def test_date_patterns_of_one_code(spark):
    documents = spark.createDataFrame(
        [('{"code": "x", "value": {"date": "yyyy@dd", "datetime": " "}}',), ('{"code": "y", "value": {"date": "MM"}}',)],
        "value string",
    )
    assert [tuple(r) for r in load_date_patterns(documents, "x").collect()] == [("x", "date", ["yyyy", "dd"])]


def test_change_plan(spark):
    request = load_changes(
        spark.createDataFrame(
            [
                ('{"elp": "m", "entities": [{"elpTypeId": "a", "updateId": "2", "dataSchemaId": "s"},'
                 '{"elpTypeId": "b", "updateId": "10", "dataSchemaId": "s"}, {"elpTypeId": "c", "updateId": "9", "dataSchemaId": "s"},'
                 '{"elpTypeId": "d", "updateId": "9"}], "links": [{"elpTypeId": "a", "updateId": "1", "dataSchemaId": "s"}]}',),
                ('{"elp": "new", "entities": [{"elpTypeId": "a", "updateId": "1", "dataSchemaId": "s"}]}',),
            ],
            "value string",
        )
    )
    stored = spark.createDataFrame(
        [("m", "Entity", "a", "1", "s", 1), ("m", "Entity", "b", "9", "s", 1), ("m", "Entity", "d", "1", "s", 1), ("old", "Entity", "x", "1", "s", 1)],
        CURSOR,
    )
    # "10" is not later than "9" as text, c was not known, d is incomplete, and the link was not known
    assert [r["type_id"] for r in changed_types(request, stored).collect()] == ["a"]
    plan = plan_changes(request, stored, stored.limit(0), sequence_id=42)
    assert {(r["model"], r["type_id"], r["seq_id"]) for r in plan.transform_cursor.collect()} == {("m", "a", 42), ("new", "a", 42)}
    assert {(r["model"], r["kind"], r["type_id"]) for r in plan.load_cursor.collect()} == {
        ("m", "Entity", "a"), ("m", "Entity", "b"), ("m", "Entity", "c"), ("m", "Entity", "d"), ("m", "Link", "a"),
        ("new", "Entity", "a"), ("old", "Entity", "x"),
    }
    with pytest.raises(ValueError):
        plan_changes(request.withColumn("type_id", F.lit(None).cast("string")), stored, stored)
    with pytest.raises(ValueError):
        task_scope("SOME", request)


def test_cursor_store_keeps_versions(spark, tmp_path):
    store = CursorStore(spark, f"{tmp_path}/cursor")
    assert store.read() is None
    one = spark.createDataFrame([("a", "Entity", "x", "1", "s", 1), ("b", "Entity", "y", "1", "s", 1)], CURSOR)
    store.upsert(one)
    after = store.upsert(spark.createDataFrame([("a", "Entity", "z", "2", "s", 2)], CURSOR))
    assert {(r["model"], r["type_id"]) for r in after.collect()} == {("a", "z"), ("b", "y")}
    assert has_cursor(after, "a") and not has_cursor(after, "c")
    assert cursor_of(after, "b").count() == 1
    assert upsert_cursor(after, one).count() == 2


def test_history_and_last_time(spark, tmp_path):
    path = f"{tmp_path}/history"
    for time, status in (("9", "successful"), ("100", "successful"), ("none", "successful"), ("500", "failure")):
        append_history(spark, path, docType="T", elpModel="m", status=status, lastSynTimeStamp=time)
    history = read_history(spark, path)
    assert last_task_time(history, "T", "m").first()[0] == 100
    assert last_task_time(history, "U", "m").first()[0] == 0
    assert latest_row(history.withColumn("n", F.col("lastSynTimeStamp").try_cast("int")), "n").first()["status"] == "failure"


def test_replay_filter(spark):
    messages = spark.createDataFrame([(1, "a"), (5, "a"), (5, "b"), (9, None)], "sequence_id bigint, t string")
    changed = spark.createDataFrame([("b",), ("b",)], "t string")
    assert sorted(r["sequence_id"] for r in replay_filter(messages, changed, 1, ["t"]).collect()) == [5, 9]
    assert replay_filter(messages, changed.limit(0), 1, ["t"]).count() == 4
    assert replay_filter(messages, None, 1, ["t"]).count() == 4


def test_lists_of_values(spark):
    frame = spark.createDataFrame([("1", "x"), ("2", "y"), ("3", None)], "v string, resid string")
    listed = spark.createDataFrame([("1", 1), ("1", 1), ("2", 0), (None, 1)], "number string, is_use int")
    assert [r["v"] for r in watched(frame, active_watchlist(listed, "number"), "v").collect()] == ["1"]
    resources = spark.createDataFrame([("x",), (None,)], "resId string")
    assert [r["v"] for r in exclude_resources(frame, resources).collect()] == ["2"]


def test_written_tables_are_partitioned(spark, tmp_path):
    cells = spark.createDataFrame([("t1", "k", "property", "q", "v", None)], "table_name string, row_key string, family string, qualifier string, value string, ts timestamp")
    write_cells(cells, f"{tmp_path}/cells")
    assert (tmp_path / "cells" / "table_name=t1").is_dir()
    docs = spark.createDataFrame([("i", "c1", {"a": "b"})], "id string, collection string, fields map<string,string>")
    write_documents(docs, f"{tmp_path}/docs")
    row = spark.read.parquet(f"{tmp_path}/docs").first()
    assert row["collection"] == "c1" and sorted(row["fields"]) == ["_indexed_at_tdt", "a"]


def test_start_policy():
    assert start_policy("ADD").options() == {"startingOffsets": "latest", "failOnDataLoss": "false"}
    assert start_policy("MODIFY").fresh and start_policy("ADD").fresh and not start_policy("DELETE").fresh
    assert start_policy("OTHER", "smallest").starting_offsets == "earliest"
    assert start_policy("OTHER", "largest").starting_offsets == "latest"
    assert start_policy("ADD").checkpoint("/c/", "run1") == "/c/run1"
    assert start_policy().checkpoint("/c", "run1") == start_policy().checkpoint("/c", "run2")


def test_a_policy_may_fail_on_lost_offsets():
    assert start_policy().options()["failOnDataLoss"] == "false"
    assert start_policy("ADD", fail_on_loss=True).options() == {"startingOffsets": "latest", "failOnDataLoss": "true"}


def test_documents_written_again_win_over_the_change_of_clocks(spark):
    first = F.lit("2024-10-27 00:59:59.25Z").cast("timestamp")  # 02:59 in summer, the later one 02:10 in winter
    later = F.lit("2024-10-27 01:10:00Z").cast("timestamp")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        docs = spark.createDataFrame([("c", "1")], "collection string, id string")
        as_fields = lambda text: F.create_map(F.lit("a"), F.lit(text))
        both = stamped(docs.withColumn("fields", as_fields("old")), first).unionByName(
            stamped(docs.withColumn("fields", as_fields("new")), later)
        )
        (row,) = latest_documents(both).collect()
        assert row["fields"] == {"a": "new", "_indexed_at_tdt": "2024-10-27 01:10:00"}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_jdbc_options_come_from_the_caller():
    options = jdbc_options("d.Driver", "jdbc:x", "(select a from t where is_use = 1) as s", user="u", numPartitions=4)
    assert options == {
        "driver": "d.Driver", "url": "jdbc:x", "dbtable": "(select a from t where is_use = 1) as s", "user": "u", "numPartitions": "4",
    }


def test_shared_folder_is_under_the_checkpoint_dir(spark):
    folder = shared_folder(spark, "x")
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert folder != shared_folder(spark, "x")


def test_small_scans_are_dealt_out_and_others_stay(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    spark.range(1000).coalesce(1).write.parquet(f"{tmp_path}/small")
    small = dealt_out(spark.read.parquet(f"{tmp_path}/small"))
    assert small.rdd.getNumPartitions() == cores
    assert sorted(r.id for r in small.collect()) == list(range(1000))
    many = spark.range(0, 1000, 1, cores + 3)
    assert dealt_out(many) is many
    empty = spark.read.schema("id long").parquet(f"{tmp_path}/small").filter("id < 0")
    assert dealt_out(empty).count() == 0
