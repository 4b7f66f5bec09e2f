"""The streaming jobs over the events table, run until the input is used up.

Messages are derived from the stream of events. A job writes to the shared
folder, and the query is the table it wrote.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftwork.catalog import query, table
from weftwork.constants import ENTITY, LINK
from weftwork.functions.keys import message_key
from weftwork.operators.elements import fan_out
from weftwork.operators.selection import active_watchlist
from weftwork.plans.model import (
    EntityType,
    LinkType,
    Mapping,
    Model,
    Property,
    compiled,
    definition_table,
    mapping_table,
)
from weftwork.session import shared_folder
from weftwork.sinks.messages import element_messages
from weftwork.sources.kafka import as_messages, raw_records
from weftwork.streaming.jobs import (
    start_alerts,
    start_distinct,
    start_load,
    start_running_counts,
    start_transform,
)

_VISIT = EntityType("visit", "visit", (Property("kind", "text"), Property("value", "number"), Property("user", "text")))
_BY = LinkType("made_by", "visit", "user", "visit", "user", True)
WEB = Model("web", (_VISIT,), (_BY,))
TASKS_A_CORE = 2  # over which a batch of events is spread; a file of events has few splits
_KINDS = ("view", "click", "purchase")


def web_mappings(spark: SparkSession) -> DataFrame:
    """Every kind of event gives a visit; purchases also say who made them."""
    visits = [
        Mapping(k, "web", ENTITY, "visit", {"kind": "event_type", "value": "value", "user": "user_id"}, ("event_id",))
        for k in _KINDS
    ]
    made = Mapping("purchase", "web", LINK, "made_by", {}, ("event_id",), ("event_id",), ("user_id",))
    return compiled(mapping_table(spark, *visits, made), definition_table(spark, WEB))


def _messages(events: DataFrame) -> DataFrame:
    """Raw records of events: a four-part key, and the event as flat JSON."""
    value = F.to_json(
        F.struct(
            "event_id",
            "user_id",
            "event_type",
            F.col("value").cast("decimal(18,2)").cast("string").alias("value"),
            F.concat(F.lit("res"), (F.col("user_id") % 7).cast("string")).alias("resId"),
        )
    )
    key = message_key(F.col("event_id"), F.col("event_type"), F.col("user_id") % 7, F.col("user_id") % 3)
    return as_messages(events.select(F.lit("events").alias("topic"), key.alias("key"), value.alias("value")))


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The events table, a file or a folder of files, as a stream."""
    schema = table(spark, folder, "events").schema
    # a stream takes a single file only by a pattern
    return spark.readStream.schema(schema).parquet(f"{folder}/events.parque[t]")


def _run_transform(spark: SparkSession, folder: str) -> str:
    out = shared_folder(spark, "transform")
    start_transform(
        _messages(event_stream(spark, folder)), web_mappings(spark), out, f"{out}/checkpoint", interval=None
    ).awaitTermination()
    return out


_TASK = "CAST(user_id % 7 AS VARCHAR) || '@' || CAST(user_id % 3 AS VARCHAR)"


@query(f"""
WITH e AS (
  SELECT *, 'res' || (user_id % 7) AS res, {_TASK} AS task, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS amount FROM events)
SELECT event_id || '@web_entity_visit@' || task AS key,
  '{{"rowkey":"' || res || '@visit~`#' || event_id || '","entity_id":"visit~`#' || event_id
  || '","entity_type":"visit","owner":"","dsId":"' || res || '","body":{{"kind":{{"value":"' || event_type
  || '","type":"string"}},' || coalesce('"value":{{"value":"' || amount || '","type":"number"}},', '')
  || '"user":{{"value":"' || user_id || '","type":"string"}}}}}}' AS value
FROM e WHERE event_type IN {_KINDS}
UNION ALL
SELECT event_id || '@web_relation_made_by@' || task,
  '{{"rowkey":"' || res || '@made_by~`#' || event_id || '","relation_id":"made_by~`#' || event_id
  || '","relation_type":"made_by","direction_type":"1","from_entity_type":"visit","from_entity_id":"visit~`#' || event_id
  || '","to_entity_type":"user","to_entity_id":"user~`#' || user_id || '","owner":"","dsId":"' || res || '","body":{{}}}}'
FROM e WHERE event_type = 'purchase'
""")
def q_stream_transform(spark: SparkSession, folder: str) -> DataFrame:
    """Element messages that the transform job writes, whole."""
    return spark.read.parquet(f"{_run_transform(spark, folder)}/messages").select("key", "value")


@query(f"""
SELECT 'trans.task.resid' AS metric_name, CAST(user_id % 7 AS VARCHAR) AS res_id, CAST(user_id % 3 AS VARCHAR) AS task_id,
  CAST(count(*) AS BIGINT) AS in_total_records,
  CAST(coalesce(sum(CASE WHEN event_type = 'purchase' THEN 2 WHEN event_type IN {_KINDS} THEN 1 END), 0) AS BIGINT) AS out_total_records
FROM events GROUP BY ALL
""")
def q_stream_task_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics of the transform job, summed over its batches."""
    written = spark.read.parquet(f"{_run_transform(spark, folder)}/metrics")
    return written.groupBy("metric_name", "res_id", "task_id").agg(
        F.sum("in_total_records").alias("in_total_records"), F.sum("out_total_records").alias("out_total_records")
    )


def _element_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Element messages as a stream: the transform without its job, stateless throughout, spread over all cores."""
    events = event_stream(spark, folder).repartition(TASKS_A_CORE * spark.sparkContext.defaultParallelism)
    return element_messages(fan_out(raw_records(_messages(events)), web_mappings(spark)))


def _run_load(spark: SparkSession, folder: str, changed: DataFrame | None = None, after: int = 0) -> str:
    out = shared_folder(spark, "load")
    stream = _element_stream(spark, folder)
    start_load(stream, out, f"{out}/checkpoint", changed=changed, start_sequence=after, interval=None).awaitTermination()
    return out


@query(f"""
WITH v AS (SELECT *, md5('res' || (user_id % 7) || '@visit~`#' || event_id) AS row_key FROM events WHERE event_type IN {_KINDS}),
l AS (SELECT *, md5('res' || (user_id % 7) || '@made_by~`#' || event_id) AS row_key FROM events WHERE event_type = 'purchase')
SELECT 'web_entity_visit' AS table_name, row_key, 'property' AS family, q AS qualifier, v AS value FROM (
  SELECT row_key, 'entity_id' AS q, 'visit~`#' || event_id AS v FROM v UNION ALL SELECT row_key, 'entity_type', 'visit' FROM v
  UNION ALL SELECT row_key, 'resid', 'res' || (user_id % 7) FROM v UNION ALL SELECT row_key, 'owner', '' FROM v
  UNION ALL SELECT row_key, 'kind', event_type FROM v UNION ALL SELECT row_key, 'user', CAST(user_id AS VARCHAR) FROM v
  UNION ALL SELECT row_key, 'value', CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) FROM v)
UNION ALL
SELECT 'web_relation_made_by', row_key, f, q, v FROM (
  SELECT row_key, 'link' AS f, 'from_entity_type' AS q, 'visit' AS v FROM l
  UNION ALL SELECT row_key, 'link', 'from_entity_id', 'visit~`#' || event_id FROM l
  UNION ALL SELECT row_key, 'link', 'to_entity_type', 'user' FROM l
  UNION ALL SELECT row_key, 'link', 'to_entity_id', 'user~`#' || user_id FROM l
  UNION ALL SELECT row_key, 'link', 'direction_type', '1' FROM l
  UNION ALL SELECT row_key, 'property', 'relation_type', 'made_by' FROM l
  UNION ALL SELECT row_key, 'property', 'relation_id', 'made_by~`#' || event_id FROM l
  UNION ALL SELECT row_key, 'property', 'resid', 'res' || (user_id % 7) FROM l
  UNION ALL SELECT row_key, 'property', 'owner', '' FROM l)
""")
def q_stream_load(spark: SparkSession, folder: str) -> DataFrame:
    """Cells that the load job writes."""
    written = spark.read.parquet(f"{_run_load(spark, folder)}/cells")
    return written.select("table_name", "row_key", "family", "qualifier", "value")


@query(f"""
SELECT 'web_entity_index' AS collection, md5('res' || (user_id % 7) || '@visit~`#' || event_id) AS id,
  CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS value, event_type AS kind, true AS stamped
FROM events WHERE event_type IN {_KINDS} AND event_id > 1000
""")
def q_stream_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that the load job writes in a replay without the changed link type."""
    changed = table(spark, folder, "events").filter(F.col("event_type") == "purchase")
    names = changed.select(F.lit("web_relation_made_by").alias("element_name")).distinct()
    written = spark.read.parquet(f"{_run_load(spark, folder, names, 1000)}/documents")
    field = lambda name: F.try_element_at("fields", F.lit(name))
    return written.select(
        "collection",
        "id",
        field("g_de11_value").alias("value"),
        field("g_tk11_kind").alias("kind"),
        field("_indexed_at_tdt").isNotNull().alias("stamped"),
    )


@query(f"""
SELECT res_id, task_id, string_agg(t || '=' || n, ';' ORDER BY t) AS types, CAST(sum(n) AS BIGINT) AS in_total_records FROM (
  SELECT CAST(user_id % 7 AS VARCHAR) AS res_id, CAST(user_id % 3 AS VARCHAR) AS task_id, 'web_entity_visit' AS t, count(*) AS n
  FROM events WHERE event_type IN {_KINDS} GROUP BY ALL
  UNION ALL SELECT CAST(user_id % 7 AS VARCHAR), CAST(user_id % 3 AS VARCHAR), 'web_relation_made_by', count(*)
  FROM events WHERE event_type = 'purchase' GROUP BY ALL) GROUP BY ALL
""")
def q_stream_type_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics of the load job by element type, summed over its batches."""
    written = spark.read.parquet(f"{_run_load(spark, folder)}/metrics")
    each = written.select("res_id", "task_id", F.inline("elp_type_statistic"))
    totals = each.groupBy("res_id", "task_id", "elp_type").agg(F.sum("count").alias("n"))
    entry = F.concat(F.col("elp_type"), F.lit("="), F.col("n").cast("string"))
    return totals.groupBy("res_id", "task_id").agg(
        F.array_join(F.array_sort(F.collect_list(entry)), ";").alias("types"), F.sum("n").alias("in_total_records")
    )


@query(f"""
SELECT event_id || '@web_entity_visit@' || {_TASK} AS key, CAST(user_id AS VARCHAR) AS watched_value FROM events
WHERE event_type IN {_KINDS} AND user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0 AND c_custkey % 4 <> 0)
""")
def q_stream_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Messages of watched users, from the alert job."""
    out = shared_folder(spark, "alerts")
    in_use = F.when(F.col("c_custkey") % 4 != 0, 1).otherwise(0)
    listed = table(spark, folder, "customer").filter(F.col("c_acctbal") < 0)
    listed = listed.select(F.col("c_custkey").cast("string").alias("number"), in_use.alias("is_use"))
    start_alerts(
        _element_stream(spark, folder), active_watchlist(listed, "number"), "user", f"{out}/alerts", f"{out}/checkpoint",
        interval=None,
    ).awaitTermination()
    return spark.read.parquet(f"{out}/alerts").select("key", "watched_value")


@query("SELECT user_id, CAST(count(*) AS BIGINT) AS running_count FROM events GROUP BY user_id")
def q_running_count(spark: SparkSession, folder: str) -> DataFrame:
    """Events seen so far per user, from a stateful stream."""
    out = shared_folder(spark, "counts")
    stream = event_stream(spark, folder).select("user_id")
    start_running_counts(stream, ["user_id"], f"{out}/counts", f"{out}/checkpoint", interval=None).awaitTermination()
    counts = spark.read.parquet(f"{out}/counts")
    return counts.groupBy("user_id").agg(F.max("running_count").alias("running_count"))


QUARTER_ROWS = 100_000  # events in a file of a quarter, about


def _quarter_files(spark: SparkSession, folder: str, rows: int) -> int:
    """The number of files of each quarter: as many as the events ask for, so that a batch is not the work of one task."""
    return max(1, -(-table(spark, folder, "events").count() // (4 * rows)))


def _write_quarter(
    spark: SparkSession, folder: str, path: str, number: int, repeats: bool = False, rows: int = QUARTER_ROWS
) -> None:
    """The files of one batch of events: every fourth one and, with ``repeats``, a third of those that the batch before held."""
    events, quarter = table(spark, folder, "events"), F.pmod("event_id", F.lit(4))
    again = (quarter == number - 1) & (F.pmod("event_id", F.lit(3)) == 0) if repeats else F.lit(False)
    chosen, files = events.filter((quarter == number) | again), _quarter_files(spark, folder, rows)
    (chosen.repartition(files) if files > 1 else chosen.coalesce(1)).write.mode("append").parquet(path)
    # a task without rows writes no file, and the stream counts files
    missing = files * (number + 1) - len(spark.read.schema(events.schema).parquet(path).inputFiles()) if files > 1 else 0
    for _ in range(missing):
        events.limit(0).coalesce(1).write.mode("append").parquet(path)


def _quarters(spark: SparkSession, folder: str, path: str, rows: int = QUARTER_ROWS) -> DataFrame:
    """The files of a folder as a stream, those of a quarter in each batch, in the order in which they were written."""
    schema = table(spark, folder, "events").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", _quarter_files(spark, folder, rows)).parquet(path)


@query("""
WITH q AS (SELECT event_id % 4 AS batch, user_id, count(*) AS n FROM events GROUP BY ALL)
SELECT CAST(batch AS INTEGER) AS batch, user_id, CAST(sum(n) OVER (PARTITION BY user_id ORDER BY batch) AS BIGINT) AS running_count FROM q
""")
def q_running_count_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Events seen so far per user, after each of four batches; the query is started anew after the second."""
    base = shared_folder(spark, "batches")
    for numbers in ((0, 1), (2, 3)):
        for number in numbers:
            _write_quarter(spark, folder, f"{base}/in", number)
        stream = _quarters(spark, folder, f"{base}/in").select("user_id")
        start_running_counts(stream, ["user_id"], f"{base}/counts", f"{base}/checkpoint", interval=None).awaitTermination()
    return spark.read.parquet(f"{base}/counts").select(F.col("batch_id").cast("int").alias("batch"), "user_id", "running_count")


@query(f"""
SELECT event_id || '@' || event_type || '@' || {_TASK} AS key, strftime(ts, '%Y-%m-%d %H:%M:%S') AS moment FROM (SELECT DISTINCT * FROM events)
""")
def q_stream_distinct(spark: SparkSession, folder: str) -> DataFrame:
    """Messages of four batches that bring a third of each other again, once; the query is started anew after the second."""
    base = shared_folder(spark, "repeats")
    for numbers in ((0, 1), (2, 3)):
        for number in numbers:
            _write_quarter(spark, folder, f"{base}/in", number, repeats=True)
        events = _quarters(spark, folder, f"{base}/in").withColumn("moment", F.col("ts").cast("timestamp"))
        key = message_key(F.col("event_id"), F.col("event_type"), F.col("user_id") % 7, F.col("user_id") % 3)
        messages = events.select(key.alias("key"), "moment")
        start_distinct(messages, "moment", "3650 days", ["key"], f"{base}/out", f"{base}/checkpoint", interval=None).awaitTermination()
    return spark.read.parquet(f"{base}/out").select("key", F.date_format("moment", "yyyy-MM-dd HH:mm:ss").alias("moment"))


@query(f"""
SELECT event_id, CASE event_id % 10
    WHEN 3 THEN 'the key has not four parts led by a number' WHEN 5 THEN 'the value is no flat JSON object'
    WHEN 7 THEN CASE WHEN event_type IN {_KINDS} THEN 'an id or a link end is missing' ELSE 'no mapping covers the data schema' END
    ELSE CASE WHEN event_type IN {_KINDS} THEN 'accepted' ELSE 'no mapping covers the data schema' END END AS outcome
FROM events
""")
def q_stream_rejected(spark: SparkSession, folder: str) -> DataFrame:
    """What becomes of each record when some are broken: accepted, or rejected with the reason."""
    base = shared_folder(spark, "rejected")
    for number in range(4):
        _write_quarter(spark, folder, f"{base}/in", number)
    messages, last = _messages(_quarters(spark, folder, f"{base}/in")), F.regexp_extract("key", r"(\d)@", 1)
    broken = messages.select(
        "topic",
        F.when(last == "3", F.regexp_replace("key", r"@\d+@\d+$", "")).otherwise(F.col("key")).alias("key"),
        F.when(last == "5", F.concat(F.lit("<"), "value"))
        .when(last == "7", F.regexp_replace("value", '"event_id":', '"other":'))
        .otherwise(F.col("value"))
        .alias("value"),
    )
    start_transform(broken, web_mappings(spark), f"{base}/out", f"{base}/checkpoint", interval=None, with_rejected=True).awaitTermination()
    event = F.substring_index("key", "@", 1).cast("long").alias("event_id")
    rejected = spark.read.parquet(f"{base}/out/rejected").select(event, F.col("reason").alias("outcome"))
    accepted = spark.read.parquet(f"{base}/out/messages").select(event, F.lit("accepted").alias("outcome")).distinct()
    return rejected.unionByName(accepted)
