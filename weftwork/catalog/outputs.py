"""Cells, search documents, metrics, and history."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftwork.catalog import query, table
from weftwork.catalog.shop import (
    CUSTOMERS_SQL,
    MAP_CUSTOMER,
    MAP_PART,
    MAP_PLACED,
    PARTS_SQL,
    SHOP,
    customers,
    orders,
    parts,
)
from weftwork.functions.identity import has_text
from weftwork.operators.cells import body_cells, element_cells, latest_cells, scan_cells
from weftwork.operators.documents import (
    delete_by_query,
    index_documents,
    search_documents,
)
from weftwork.operators.elements import build_elements
from weftwork.operators.metrics import (
    count_by,
    counts_by_type,
    metric_records,
    nested_counts,
    one_per_partition,
    reconcile,
    size_estimate,
    stage_counts,
)
from weftwork.operators.selection import last_task_time, latest_row
from weftwork.sinks.index import delete_from_index, read_index, write_index
from weftwork.sinks.tables import append_history, read_history
from weftwork.session import shared_folder


def _part_elements(spark: SparkSession, folder: str) -> DataFrame:
    return build_elements(parts(spark, folder), SHOP, [MAP_PART], res_id=F.lit("shop"), owner=F.lit(None))


@query(f"""
WITH p AS (SELECT *, 'shop@part~`#' || p_partkey AS row_key FROM ({PARTS_SQL}))
SELECT row_key, 'name' AS qualifier, p_name AS value, 'text' AS type FROM p
UNION ALL SELECT row_key, 'brand', p_brand, 'string' FROM p
UNION ALL SELECT row_key, 'size', CAST(size_or_null AS VARCHAR), 'integer' FROM p WHERE size_or_null IS NOT NULL
UNION ALL SELECT row_key, 'price', price, 'number' FROM p
""")
def q_body_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Body properties as one row each; absent values give none."""
    return body_cells(_part_elements(spark, folder))


@query(f"""
WITH p AS (SELECT *, md5('shop@part~`#' || p_partkey) AS row_key FROM ({PARTS_SQL}))
SELECT 'shop_entity_part' AS table_name, row_key, 'property' AS family, q AS qualifier, v AS value FROM (
  SELECT row_key, 'entity_id' AS q, 'part~`#' || p_partkey AS v FROM p
  UNION ALL SELECT row_key, 'entity_type', 'part' FROM p
  UNION ALL SELECT row_key, 'resid', 'shop' FROM p
  UNION ALL SELECT row_key, 'owner', '' FROM p
  UNION ALL SELECT row_key, 'name', p_name FROM p
  UNION ALL SELECT row_key, 'brand', p_brand FROM p
  UNION ALL SELECT row_key, 'size', CAST(size_or_null AS VARCHAR) FROM p WHERE size_or_null IS NOT NULL
  UNION ALL SELECT row_key, 'price', price FROM p)
""")
def q_entity_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Wide-column cells of entities."""
    return element_cells(_part_elements(spark, folder)).drop("ts")


_PLACED_SQL = """
  SELECT md5('res' || (o_custkey % 5) || '@placed~`#' || o_custkey || '~`#' || o_orderkey) AS row_key,
    'placed~`#' || o_custkey || '~`#' || o_orderkey AS link_id, 'res' || (o_custkey % 5) AS res_id,
    CASE o_orderstatus WHEN 'P' THEN '2' ELSE '1' END AS code, o_orderstatus = 'F' AS swap, o_orderstatus AS status,
    'customer~`#' || o_custkey AS c_id, 'order~`#' || o_orderkey AS o_id, strftime(o_orderdate, '%Y-%m-%d') AS ordered
  FROM orders
"""


@query(f"""
WITH l AS ({_PLACED_SQL})
SELECT 'shop_relation_placed' AS table_name, row_key, family, qualifier, value FROM (
  SELECT row_key, 'link' AS family, 'from_entity_type' AS qualifier, CASE WHEN swap THEN 'order' ELSE 'customer' END AS value FROM l
  UNION ALL SELECT row_key, 'link', 'from_entity_id', CASE WHEN swap THEN o_id ELSE c_id END FROM l
  UNION ALL SELECT row_key, 'link', 'to_entity_type', CASE WHEN swap THEN 'customer' ELSE 'order' END FROM l
  UNION ALL SELECT row_key, 'link', 'to_entity_id', CASE WHEN swap THEN c_id ELSE o_id END FROM l
  UNION ALL SELECT row_key, 'link', 'direction_type', code FROM l
  UNION ALL SELECT row_key, 'property', 'relation_type', 'placed' FROM l
  UNION ALL SELECT row_key, 'property', 'relation_id', link_id FROM l
  UNION ALL SELECT row_key, 'property', 'resid', res_id FROM l
  UNION ALL SELECT row_key, 'property', 'owner', '' FROM l
  UNION ALL SELECT row_key, 'property', 'ordered', ordered FROM l
  UNION ALL SELECT row_key, 'property', 'status', status FROM l)
""")
def q_link_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Wide-column cells of links, in the link and property families."""
    return element_cells(build_elements(orders(spark, folder), SHOP, [MAP_PLACED])).drop("ts")


@query(f"""
WITH c AS (SELECT md5(coalesce(res_id, 'null') || '@customer~`#' || key_text) AS id, * FROM ({CUSTOMERS_SQL})
           WHERE length(trim(key_text)) > 0)
SELECT id, 'shop_entity_index' AS collection, name, value FROM (
  SELECT id, 'id' AS name, id AS value FROM c
  UNION ALL SELECT id, 'entity_id', 'customer~`#' || key_text FROM c
  UNION ALL SELECT id, 'entity_type', 'customer' FROM c
  UNION ALL SELECT id, 'resid', res_id FROM c WHERE res_id IS NOT NULL
  UNION ALL SELECT id, 'owner', coalesce(owner_or_null, '') FROM c
  UNION ALL SELECT id, 'g_tt11_name', c_name FROM c
  UNION ALL SELECT id, 'g_tk11_segment', c_mktsegment FROM c
  UNION ALL SELECT id, 'g_de11_balance', balance FROM c
  UNION ALL SELECT id, 'g_it11_nation', CAST(c_nationkey AS VARCHAR) FROM c)
""")
def q_search_doc(spark: SparkSession, folder: str) -> DataFrame:
    """Search documents of entities, one row per field."""
    docs = search_documents(build_elements(customers(spark, folder), SHOP, [MAP_CUSTOMER]))
    return docs.select("id", "collection", F.explode("fields").alias("name", "value"))


@query(f"""
WITH l AS ({_PLACED_SQL})
SELECT row_key AS id, 'shop_relation_index' AS collection, name, value FROM (
  SELECT row_key, 'id' AS name, row_key AS value FROM l
  UNION ALL SELECT row_key, 'relation_id', link_id FROM l
  UNION ALL SELECT row_key, 'relation_type', 'placed' FROM l
  UNION ALL SELECT row_key, 'direction_type', code FROM l
  UNION ALL SELECT row_key, 'from_entity_id', CASE WHEN swap THEN o_id ELSE c_id END FROM l
  UNION ALL SELECT row_key, 'from_entity_type', CASE WHEN swap THEN 'order' ELSE 'customer' END FROM l
  UNION ALL SELECT row_key, 'to_entity_id', CASE WHEN swap THEN c_id ELSE o_id END FROM l
  UNION ALL SELECT row_key, 'to_entity_type', CASE WHEN swap THEN 'customer' ELSE 'order' END FROM l
  UNION ALL SELECT row_key, 'resid', res_id FROM l
  UNION ALL SELECT row_key, 'owner', '' FROM l
  UNION ALL SELECT row_key, 'g_rd11_ordered', ordered || ' 00:00:00' FROM l
  UNION ALL SELECT row_key, 'g_tk11_status', status FROM l)
""")
def q_link_search_doc(spark: SparkSession, folder: str) -> DataFrame:
    """Search documents of links, dates in index form, by the rules of the streamed load."""
    docs = search_documents(build_elements(orders(spark, folder), SHOP, [MAP_PLACED]), patterns={})
    return docs.select("id", "collection", F.explode("fields").alias("name", "value"))


@query("SELECT 'shop_entity_index' AS collection, CAST(count(*) AS BIGINT) AS documents, 0 AS failed FROM part")
def q_index_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Documents delivered in batches from the tasks, summed from the status rows."""

    def send(collection: str, batch: list[dict]) -> None:
        for document in batch:
            if not document["id"]:
                raise ConnectionError(collection)

    status = index_documents(search_documents(_part_elements(spark, folder)), send, batch_size=500)
    return status.groupBy("collection").agg(
        F.sum("documents").alias("documents"), F.count("error").cast("int").alias("failed")
    )


_INDEX_SQL = """
SELECT CAST(md5('shop@part~`#' || p_partkey) AS VARCHAR) AS id, 'shop_entity_index' AS collection,
  'part~`#' || p_partkey AS entity_id, CASE WHEN p_partkey % 3 = 0 THEN 'second' ELSE 'first' END AS version FROM part
"""


def _written_twice(spark: SparkSession, folder: str) -> str:
    """An index of parts: all of them written, a write that fails in a task, and a third of them written again."""
    path = shared_folder(spark, "index")
    number = F.substring_index(F.col("fields")["entity_id"], "#", -1).cast("long")
    docs = search_documents(_part_elements(spark, folder)).select("collection", "id", "fields", number.alias("number"))
    marked = lambda frame, version: frame.select(
        "collection", "id", F.map_concat("fields", F.create_map(F.lit("version"), F.lit(version))).alias("fields")
    )
    write_index(marked(docs, "first"), path)
    broken = docs.withColumn("id", F.when(F.col("number") == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("id")))
    try:
        write_index(marked(broken, "broken"), path)
    except Exception as error:  # the job fails as a whole, whichever class tells it
        if "lost" not in str(error):
            raise
    write_index(marked(docs.filter(F.col("number") % 3 == 0), "second"), path)
    return path


def _of_index(frame: DataFrame) -> DataFrame:
    return frame.select("id", "collection", F.col("fields")["entity_id"].alias("entity_id"), F.col("fields")["version"].alias("version"))


@query(_INDEX_SQL)
def q_document_index(spark: SparkSession, folder: str) -> DataFrame:
    """Documents put in place by a data source: those written again replace the first, a failed write leaves nothing."""
    return _of_index(read_index(spark, _written_twice(spark, folder)))


@query(f"SELECT * FROM ({_INDEX_SQL}) WHERE version = 'first'")
def q_document_index_deleted(spark: SparkSession, folder: str) -> DataFrame:
    """The stored documents that a deletion leaves."""
    path = _written_twice(spark, folder)
    delete_from_index(spark, path, F.col("fields")["version"] == "second")
    return _of_index(read_index(spark, path))


def _history_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Each order as two cells of its customer, written at the order date."""
    cell = F.array(
        F.struct(F.lit("status").alias("qualifier"), F.col("o_orderstatus").alias("value")),
        F.struct(F.lit("order").alias("qualifier"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("value")),
    )
    return table(spark, folder, "orders").select(
        F.lit("shop_entity_customer").alias("table_name"),
        F.col("o_custkey").cast("string").alias("row_key"),
        F.lit("property").alias("family"),
        F.col("o_orderdate").alias("ts"),
        F.inline(cell),
    )


@query("""
SELECT CAST(o_custkey AS VARCHAR) AS row_key, 'status' AS qualifier, arg_max(o_orderstatus, strftime(o_orderdate, '%Y%m%d') || o_orderstatus) AS value
FROM orders GROUP BY o_custkey
UNION ALL
SELECT CAST(o_custkey AS VARCHAR), 'order', arg_max(lpad(CAST(o_orderkey AS VARCHAR), 12, '0'), strftime(o_orderdate, '%Y%m%d') || lpad(CAST(o_orderkey AS VARCHAR), 12, '0'))
FROM orders GROUP BY o_custkey
""")
def q_cells_latest(spark: SparkSession, folder: str) -> DataFrame:
    """The newest value of each row and qualifier."""
    return latest_cells(_history_cells(spark, folder)).select("row_key", "qualifier", "value")


@query("""
SELECT CAST(o_custkey AS VARCHAR) AS row_key, arg_max(o_orderstatus, strftime(o_orderdate, '%Y%m%d') || o_orderstatus) AS status,
  arg_max(lpad(CAST(o_orderkey AS VARCHAR), 12, '0'), strftime(o_orderdate, '%Y%m%d') || lpad(CAST(o_orderkey AS VARCHAR), 12, '0')) AS "order"
FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' GROUP BY o_custkey
""")
def q_cells_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Rows with wanted qualifiers as columns, from cells of a time range."""
    start, end = (F.lit(f"{year}-01-01 00:00:00").cast("timestamp_ntz") for year in (1996, 1998))
    return scan_cells(_history_cells(spark, folder), "shop_entity_customer", ["status", "order"], start, end)


@query("SELECT doc_id, source, n_chars FROM documents WHERE NOT coalesce(lang = 'en' AND n_chars % 2 = 0, false)")
def q_delete_by_query(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that a deletion leaves."""
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source", "n_chars")
    return delete_by_query(docs, (F.col("lang") == "en") & (F.col("n_chars") % 2 == 0)).drop("lang")


def _task_events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        "event_type",
        (F.col("user_id") % 7).cast("string").alias("res_id"),
        (F.col("user_id") % 3).cast("string").alias("task_id"),
        "value",
    )


@query("""
SELECT CAST(user_id % 7 AS VARCHAR) AS res_id, CAST(user_id % 3 AS VARCHAR) AS task_id,
  CAST(count(*) AS BIGINT) AS in_total_records,
  CAST(coalesce(sum(CASE WHEN user_id % 7 <> 2 AND value > 20 THEN CASE WHEN value > 100 THEN 2 ELSE 1 END END), 0) AS BIGINT) AS out_total_records
FROM events GROUP BY ALL
""")
def q_task_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Records in and elements out of each task; a task without output counts zero."""
    events = _task_events(spark, folder)
    copies = F.when(F.col("value") > 100, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    produced = events.filter((F.col("res_id") != "2") & (F.col("value") > 20)).withColumn("copy", F.explode(copies))
    return reconcile(events, produced)


@query("""
SELECT CAST(user_id % 7 AS VARCHAR) AS res_id, CAST(count(*) AS BIGINT) AS records FROM events GROUP BY ALL
""")
def q_input_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Records per resource."""
    return count_by(_task_events(spark, folder), ["res_id"])


@query("""
SELECT res_id, task_id, string_agg(event_type || '=' || n, ';' ORDER BY event_type) AS types, CAST(sum(n) AS BIGINT) AS in_total_records
FROM (SELECT CAST(user_id % 7 AS VARCHAR) AS res_id, CAST(user_id % 3 AS VARCHAR) AS task_id, event_type, count(*) AS n FROM events GROUP BY ALL)
GROUP BY ALL
""")
def q_type_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Counts per task and type, nested under the task with their total."""
    nested = nested_counts(counts_by_type(_task_events(spark, folder), "event_type"), "event_type")
    entry = F.transform(
        "elp_type_statistic", lambda e: F.concat(e["elp_type"], F.lit("="), e["count"].cast("string"))
    )
    return nested.select("res_id", "task_id", F.array_join(entry, ";").alias("types"), "in_total_records")


@query("""
SELECT 'load.task.resid' AS metric_name, CAST(task AS VARCHAR) AS task_id, CAST(res AS VARCHAR) AS res_id,
  CAST(sum(n) AS BIGINT) AS in_total_records, CAST(sum(n) AS BIGINT) AS out_total_records,
  string_agg(event_type || '=' || n, ';' ORDER BY event_type) AS types, true AS open
FROM (SELECT user_id % 3 AS task, user_id % 7 AS res, event_type, count(*) AS n FROM events GROUP BY ALL) GROUP BY task, res
""")
def q_metric_records(spark: SparkSession, folder: str) -> DataFrame:
    """Metric rows of the load."""
    nested = nested_counts(counts_by_type(_task_events(spark, folder), "event_type"), "event_type")
    rows = metric_records(nested, "load.task.resid", F.current_timestamp())
    entry = F.transform("elp_type_statistic", lambda e: F.concat(e["elp_type"], F.lit("="), e["count"].cast("string")))
    return rows.select(
        "metric_name",
        "task_id",
        "res_id",
        "in_total_records",
        "out_total_records",
        F.array_join(F.array_sort(entry), ";").alias("types"),
        (F.col("end_time").isNull() & F.col("start_time").isNotNull()).alias("open"),
    )


@query("""
SELECT CAST(count(*) AS BIGINT) AS source, CAST(count(*) FILTER (l_partkey % 9 <> 0) AS BIGINT) AS parsed,
  CAST(count(*) FILTER (l_partkey % 9 <> 0 AND l_suppkey % 5 <> 0) AS BIGINT) AS linked
FROM lineitem
""")
def q_stage_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that reach each stage, from one pass."""
    part = F.when(F.col("l_partkey") % 9 != 0, F.col("l_partkey").cast("string"))
    supplier = F.when(F.col("l_suppkey") % 5 != 0, F.col("l_suppkey").cast("string"))
    return stage_counts(
        table(spark, folder, "lineitem"),
        {"source": F.lit(True), "parsed": has_text(part), "linked": has_text(part) & has_text(supplier)},
    )


@query("""
SELECT total_count, avg_bytes, total_count * avg_bytes // 1048576 AS total_mb, total_count * avg_bytes // 1048576 // 2 AS partitions
FROM (SELECT CAST(count(*) AS BIGINT) AS total_count, CAST(sum(strlen(CAST(doc_id AS VARCHAR)) + strlen(text) + strlen(lang)) // count(*) AS BIGINT) AS avg_bytes FROM documents)
""")
def q_size_estimate(spark: SparkSession, folder: str) -> DataFrame:
    """Average bytes of a record over whole texts, total size and partitions to write."""
    return size_estimate(table(spark, folder, "documents"), ["doc_id", "text", "lang"], block_mb=2)


@query("SELECT CAST(count(*) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS unknown, true AS one_each FROM lineitem")
def q_partition_sample(spark: SparkSession, folder: str) -> DataFrame:
    """One row of each partition that is read: every one is in the table, and no partition gives two."""
    keys = ["l_orderkey", "l_linenumber"]
    lines = table(spark, folder, "lineitem").select(*keys)
    sample = one_per_partition(lines)
    found = sample.join(lines.distinct().withColumn("known", F.lit(True)), keys, "left")
    marked = found.select(F.lit(0).alias("row"), F.col("known").isNull().cast("long").alias("lost"), "partition")
    both = marked.unionByName(lines.select(F.lit(1).alias("row"), F.lit(0).cast("long").alias("lost"), F.lit(None).cast("int").alias("partition")))
    return both.agg(
        F.sum("row").cast("long").alias("rows"),
        F.sum("lost").alias("unknown"),
        (F.count("partition") == F.count_distinct("partition")).alias("one_each"),
    )


def _history(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as task history: their status decides how the task ended."""
    status = F.when(F.col("o_orderstatus") == "F", "successful").when(F.col("o_orderstatus") == "O", "running")
    return table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("docType"),
        status.otherwise("failure").alias("status"),
        F.lit("shop").alias("elpModel"),
        F.when(F.col("o_orderkey") % 10 == 0, "none").otherwise(F.col("o_orderkey").cast("string")).alias("lastSynTimeStamp"),
    )


@query("""
SELECT coalesce(max(o_orderkey), 0) AS last_sync FROM orders
WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' AND o_orderkey % 10 <> 0
""")
def q_last_task(spark: SparkSession, folder: str) -> DataFrame:
    """The time of the last finished task, compared as a number."""
    return last_task_time(_history(spark, folder), "1-URGENT", "shop")


@query("""
SELECT o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS ordered FROM orders
ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1
""")
def q_latest_row(spark: SparkSession, folder: str) -> DataFrame:
    """The row with the latest date, without a sort."""
    frame = table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", F.col("o_orderdate").cast("date").cast("string").alias("ordered")
    )
    return latest_row(frame, "ordered", "o_orderkey")


@query("""
SELECT 'append' AS status, CAST(count(*) AS VARCHAR) AS count, 'lineitem' AS "tableName" FROM lineitem
UNION ALL SELECT 'successful', CAST(count(*) AS VARCHAR), 'lineitem' FROM lineitem WHERE l_returnflag = 'R'
""")
def q_task_history(spark: SparkSession, folder: str) -> DataFrame:
    """History rows appended with the counts of a task, and read back."""
    path = shared_folder(spark, "history")
    counts = stage_counts(
        table(spark, folder, "lineitem"), {"read": F.lit(True), "kept": F.col("l_returnflag") == "R"}
    ).first()
    append_history(spark, path, tableName="lineitem", status="append", count=counts["read"])
    append_history(spark, path, tableName="lineitem", status="successful", count=counts["kept"])
    return read_history(spark, path).select("status", "count", "tableName")
