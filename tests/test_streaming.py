import pytest
from pyspark.sql import functions as F

from weftwork.catalog.streams import _messages, event_stream, web_mappings
from weftwork.operators.cells import element_cells
from weftwork.operators.elements import canonical, fan_out
from weftwork.sinks.messages import element_messages
from weftwork.sources.kafka import as_messages, raw_records
from weftwork.streaming.jobs import (
    start_alerts,
    start_load,
    start_running_counts,
    start_transform,
    stop_gracefully,
)

EVENTS = "event_id bigint, user_id bigint, event_type string, value double"


def events(spark, start, count):
    kinds = F.element_at(F.array(*[F.lit(k) for k in ("view", "click", "purchase", "other")]), (F.col("id") % 4 + 1).cast("int"))
    return spark.range(start, start + count).select(
        F.col("id").alias("event_id"), (F.col("id") % 9).alias("user_id"), kinds.alias("event_type"), F.lit(1.5).alias("value")
    )


def message_stream(spark, folder):
    return _messages(spark.readStream.schema(EVENTS).parquet(folder))


def rows(frame):
    return sorted(map(str, frame.collect()))


def test_transform_equals_batch_and_resumes_without_repeats(spark, tmp_path):
    folder, out = f"{tmp_path}/in", f"{tmp_path}/out"
    run = lambda: start_transform(
        message_stream(spark, folder), web_mappings(spark), out, f"{out}/checkpoint", interval=None
    ).awaitTermination()
    events(spark, 0, 40).write.parquet(folder)
    run()
    events(spark, 40, 20).write.mode("append").parquet(folder)
    run()
    run()
    expected = element_messages(fan_out(raw_records(_messages(events(spark, 0, 60))), web_mappings(spark)))
    assert rows(spark.read.parquet(f"{out}/messages").select("key", "value")) == rows(expected.select("key", "value"))
    metrics = spark.read.parquet(f"{out}/metrics")
    assert metrics.agg(F.sum("in_total_records"), F.sum("out_total_records")).first()[:] == (60, 60)
    assert metrics.select("batch_id").distinct().count() == 2


def test_transform_can_send_batches_elsewhere(spark, tmp_path):
    folder, out, sent = f"{tmp_path}/in", f"{tmp_path}/out", []
    events(spark, 0, 8).write.parquet(folder)
    start_transform(
        message_stream(spark, folder), web_mappings(spark), out, f"{out}/checkpoint", None,
        send=lambda batch, batch_id: sent.append((batch_id, batch.count())),
    ).awaitTermination()
    assert sent == [(0, 8)]


def test_an_error_fails_the_query_and_the_batch_runs_again(spark, tmp_path):
    folder, out = f"{tmp_path}/in", f"{tmp_path}/out"
    events(spark, 0, 8).write.parquet(folder)

    def broken(batch, batch_id):
        raise RuntimeError("broken sink")

    with pytest.raises(Exception, match="broken sink"):
        start_transform(
            message_stream(spark, folder), web_mappings(spark), out, f"{out}/checkpoint", None, send=broken
        ).awaitTermination()
    start_transform(message_stream(spark, folder), web_mappings(spark), out, f"{out}/checkpoint", None).awaitTermination()
    assert spark.read.parquet(f"{out}/messages").count() == 8


def _elements(spark, folder):
    return element_messages(fan_out(raw_records(message_stream(spark, folder)), web_mappings(spark)))


def test_load_writes_equal_messages_once(spark, tmp_path):
    folder, out = f"{tmp_path}/in", f"{tmp_path}/out"
    events(spark, 0, 12).union(events(spark, 0, 12)).write.parquet(folder)
    start_load(_elements(spark, folder), out, f"{out}/checkpoint", {}, interval=None).awaitTermination()
    built = canonical(fan_out(raw_records(_messages(events(spark, 0, 12))), web_mappings(spark)))
    expected = element_cells(built).drop("ts")
    written = spark.read.parquet(f"{out}/cells").select(*expected.columns)
    assert rows(written) == rows(expected)
    assert spark.read.parquet(f"{out}/documents").count() == built.count()
    # metrics count what came in
    assert spark.read.parquet(f"{out}/metrics").agg(F.sum("in_total_records")).first()[0] == 2 * built.count()


def test_alerts(spark, tmp_path):
    folder, out = f"{tmp_path}/in", f"{tmp_path}/out"
    events(spark, 0, 36).write.parquet(folder)
    listed = spark.createDataFrame([("3",), ("100",)], "number string")
    start_alerts(_elements(spark, folder), listed, "user", f"{out}/a", f"{out}/checkpoint", interval=None).awaitTermination()
    assert {r["watched_value"] for r in spark.read.parquet(f"{out}/a").collect()} == {"3"}


def test_running_counts_go_on_over_restarts(spark, tmp_path):
    folder, out = f"{tmp_path}/in", f"{tmp_path}/out"
    for start, count in ((0, 9), (9, 18)):
        events(spark, start, count).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(EVENTS).parquet(folder)
        start_running_counts(stream, ["user_id"], f"{out}/c", f"{out}/checkpoint", interval=None).awaitTermination()
    found = spark.read.parquet(f"{out}/c").groupBy("user_id").agg(F.max("running_count").alias("n"))
    assert {r["n"] for r in found.collect()} == {3}


def test_a_query_on_an_interval_stops_gracefully(spark, tmp_path):
    folder, out = f"{tmp_path}/in", f"{tmp_path}/out"
    events(spark, 0, 9).write.parquet(folder)
    stream = spark.readStream.schema(EVENTS).parquet(folder)
    query = start_running_counts(stream, ["user_id"], f"{out}/c", f"{out}/checkpoint", interval="1 second")
    stop_gracefully(query)
    assert not query.isActive
    assert spark.read.parquet(f"{out}/c").count() == 9


def test_messages_keep_their_topic(spark):
    frame = spark.createDataFrame([("t", b"k", b"v")], "topic string, key binary, value binary")
    assert tuple(as_messages(frame).first()) == ("t", "k", "v")
    assert as_messages(frame.drop("topic")).first()["topic"] is None


def test_event_stream_is_a_stream(spark):
    assert event_stream(spark, "/root/testdata/sf0.001").isStreaming


def test_event_stream_reads_a_folder_of_files_too(spark, tmp_path):
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    out = f"{tmp_path}/out"
    stream = event_stream(spark, str(tmp_path)).select("user_id")
    start_running_counts(stream, ["user_id"], f"{out}/c", f"{out}/checkpoint", interval=None).awaitTermination()
    assert spark.read.parquet(f"{out}/c").agg(F.sum("running_count")).first()[0] == 1000
