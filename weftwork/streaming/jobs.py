"""The streaming jobs.

Each micro-batch is an ordinary frame, so the batch operators apply, and sizes
are measured per batch. What a batch writes goes to a folder named after it:
one that runs again after a failure replaces its own output. An error stops
the query, and its offsets are not committed.
"""

import uuid
from collections.abc import Callable
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weftwork.constants import PATTERN_ZONE
from weftwork.operators.cells import element_cells
from weftwork.operators.dedup import distinct_payloads
from weftwork.operators.documents import search_documents, stamped
from weftwork.operators.elements import RECORD_KEYS, fan_out
from weftwork.operators.metrics import load_metrics, transform_metrics
from weftwork.operators.rejects import is_message_key, rejected_records
from weftwork.operators.selection import replay_filter, watched
from weftwork.sinks.messages import element_messages, elements_of, keyed_elements
from weftwork.sinks.tables import write_batch
from weftwork.sources.kafka import StartPolicy, raw_columns, raw_records

TRANSFORM_INTERVAL = "4 seconds"
ALERT_INTERVAL = "2 seconds"


@contextmanager
def _kept(frame: DataFrame):
    """A frame used several times within a batch, computed once and released."""
    frame = frame.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield frame
    finally:
        frame.unpersist()


def _start(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, interval: str | None, name: str
) -> StreamingQuery:
    """Start a query; without an interval it takes what is there and ends."""
    writer = stream.writeStream.queryName(name).foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def _checkpoint(base: str, policy: StartPolicy | None) -> str:
    """The query's checkpoint: under a policy its standing one, or a new one where the stream must jump."""
    return base if policy is None else policy.checkpoint(base, uuid.uuid4().hex)


def _started_at():
    return F.lit(datetime.now(timezone.utc)).cast("timestamp")


def start_transform(
    messages: DataFrame,
    compiled_mappings: DataFrame,
    out: str,
    checkpoint: str,
    interval: str | None = TRANSFORM_INTERVAL,
    send: Callable[[DataFrame, int], None] | None = None,
    with_rejected: bool = False,
    policy: StartPolicy | None = None,
) -> StreamingQuery:
    """Raw records to element messages, with the counts of each batch and task.

    Messages go to ``out/messages`` or, with ``send``, wherever it writes a
    batch of ``key, value``. Metrics go to ``out/metrics``. ``with_rejected``
    writes the records that give no element to ``out/rejected``, with the
    reason, so that accepted and rejected ones together are all that came in;
    records whose key has not all its parts are rejected then as well.
    ``policy`` is the one that the source was read with: when it jumps, the
    query begins a checkpoint of its own, else it resumes the standing one.
    """
    keep = (*RECORD_KEYS, "record") if with_rejected else RECORD_KEYS

    def handle(batch: DataFrame, batch_id: int) -> None:
        started = _started_at()
        parsed = raw_records(batch)
        if with_rejected:
            numbered = batch.select("key", "value", F.monotonically_increasing_id().alias("record"))
            parsed = numbered.filter(is_message_key(F.col("key"))).select("record", *raw_columns())
        with _kept(parsed) as records, _kept(fan_out(records, compiled_mappings, keep=keep)) as elements:
            if with_rejected:
                accepted = elements.select(F.col("record_record").alias("record"))
                with _kept(compiled_mappings.select("data_schema_id").distinct()) as covered:
                    write_batch(rejected_records(numbered, accepted, covered), f"{out}/rejected", batch_id)
            produced = element_messages(elements)
            if send is None:
                write_batch(produced, f"{out}/messages", batch_id)
            else:
                send(produced, batch_id)
            outputs = elements.select(
                F.col("record_res_id").alias("res_id"), F.col("record_task_id").alias("task_id")
            )
            write_batch(transform_metrics(records, outputs, started), f"{out}/metrics", batch_id)

    return _start(messages, handle, _checkpoint(checkpoint, policy), interval, "transform")


def start_load(
    messages: DataFrame,
    out: str,
    checkpoint: str,
    patterns: dict[str, list[str]] | None = None,
    changed: DataFrame | None = None,
    start_sequence: int = 0,
    interval: str | None = TRANSFORM_INTERVAL,
    zone: str = PATTERN_ZONE,
    policy: StartPolicy | None = None,
) -> StreamingQuery:
    """Element messages to cells and search documents, equal messages of a batch once.

    ``changed`` holds the ``element_name`` of types to leave out of a replay;
    ``policy`` is that of the source, as in `start_transform`.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        started = _started_at()
        chosen = replay_filter(keyed_elements(batch), changed, start_sequence, ["element_name"])
        with _kept(chosen) as keyed:
            write_batch(load_metrics(keyed, "element_name", started), f"{out}/metrics", batch_id)
            with _kept(elements_of(distinct_payloads(keyed, "element_name", "value"))) as elements:
                write_batch(element_cells(elements, started), f"{out}/cells", batch_id)
                documents = stamped(search_documents(elements, patterns or {}, zone), started)
                write_batch(documents, f"{out}/documents", batch_id)

    return _start(messages, handle, _checkpoint(checkpoint, policy), interval, "load")


def start_alerts(
    messages: DataFrame,
    watchlist: DataFrame,
    property_uuid: str,
    out: str,
    checkpoint: str,
    interval: str | None = ALERT_INTERVAL,
) -> StreamingQuery:
    """Element messages whose property value is on the watch list.

    The list is read anew for each batch.
    """
    # a map by property id, so that an id may hold any characters
    body = F.from_json("value", "body map<string,struct<value:string>>")["body"]
    value = F.try_element_at(body, F.lit(property_uuid))["value"]

    def handle(batch: DataFrame, batch_id: int) -> None:
        alerts = watched(batch.withColumn("watched_value", value), watchlist, "watched_value")
        write_batch(alerts, out, batch_id)

    return _start(messages, handle, checkpoint, interval, "alerts")


def distinct_in_stream(messages: DataFrame, event_time: str, delay: str, columns: list[str]) -> DataFrame:
    """Messages that are equal in ``columns`` once over all batches, as long as they come within ``delay``.

    The state is a digest for each message, kept until the watermark has passed the message's time by ``delay``; it lies
    in the query's checkpoint, so a restart goes on with it. What comes later than the watermark is dropped by Spark.
    """
    measured = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-")) for c in columns]
    marked = messages.withColumn("_digest", F.md5(F.concat(*measured))).withWatermark(event_time, delay)
    return marked.dropDuplicatesWithinWatermark(["_digest"]).drop("_digest")


def start_distinct(
    messages: DataFrame, event_time: str, delay: str, columns: list[str], out: str, checkpoint: str, interval: str | None = TRANSFORM_INTERVAL
) -> StreamingQuery:
    """Write each message once, whichever batches and runs bring it again."""
    once = distinct_in_stream(messages, event_time, delay, columns)
    return _start(once, lambda batch, batch_id: write_batch(batch, out, batch_id), checkpoint, interval, "distinct")


def running_counts(stream: DataFrame, keys: list[str]) -> DataFrame:
    """Rows seen so far per key, over all batches."""
    return stream.groupBy(*keys).agg(F.count(F.lit(1)).alias("running_count"))


def start_running_counts(
    stream: DataFrame, keys: list[str], out: str, checkpoint: str, interval: str | None = TRANSFORM_INTERVAL
) -> StreamingQuery:
    """Write the counts that changed in each batch; the newest batch of a key holds its count."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, out, batch_id)

    writer = running_counts(stream, keys).writeStream.queryName("running_counts").outputMode("update")
    writer = writer.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def stop_gracefully(query: StreamingQuery) -> None:
    """Let the batches at hand finish, then stop."""
    query.processAllAvailable()
    query.stop()
