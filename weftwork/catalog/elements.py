"""Entities and links from records."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftwork.catalog import query, table
from weftwork.catalog.shop import (
    BY_STATUS,
    CUSTOMERS_SQL,
    MAP_CONTAINS,
    MAP_CUSTOMER,
    MAP_HALF,
    MAP_ORDER,
    MAP_PLACED,
    MAP_SUPPLIES,
    SHOP,
    as_records,
    customers,
    lines,
    orders,
)
from weftwork.constants import (
    BIDIRECTIONAL,
    LINK,
    NOT_DIRECTED,
    SOURCE_TO_TARGET,
    TARGET_TO_SOURCE,
)
from weftwork.functions.properties import body_entries, property_value
from weftwork.operators.dedup import dedup_by_key, distinct_payloads
from weftwork.operators.elements import (
    build_elements,
    entities,
    fan_out,
    links,
    union_all,
    unmapped_schemas,
)
from weftwork.operators.joins import adaptive_join
from weftwork.operators.selection import with_identity
from weftwork.plans.model import (
    LinkType,
    Mapping,
    Model,
    compiled,
    definition_table,
    mapping_table,
)
from weftwork.sinks.messages import element_messages
from weftwork.sources.files import dealt_out


@query(f"""
WITH ents AS (
  SELECT 'customer~`#' || key_text AS entity_id, min(c_name) AS name FROM ({CUSTOMERS_SQL})
  WHERE length(trim(key_text)) > 0 GROUP BY ALL
), raw AS (
  SELECT 'res' || (o_custkey % 5) AS res_id, 'placed~`#' || o_custkey || '~`#' || o_orderkey AS relation_id,
    CASE o_orderstatus WHEN 'P' THEN '2' WHEN 'N' THEN '0' ELSE '1' END AS direction_type,
    o_orderstatus = 'F' AS swap, 'customer~`#' || o_custkey AS c_id, 'order~`#' || o_orderkey AS o_id,
    strftime(o_orderdate, '%Y-%m-%d') AS ordered
  FROM orders
)
SELECT DISTINCT md5(res_id || '@' || relation_id) AS row_hash, relation_id, direction_type,
  CASE WHEN swap THEN o_id ELSE c_id END AS from_entity_id, CASE WHEN swap THEN c_id ELSE o_id END AS to_entity_id,
  ordered, name AS customer_name
FROM raw JOIN ents ON ents.entity_id = raw.c_id
""")
def q_link_placed(spark: SparkSession, folder: str) -> DataFrame:
    """Deduplicated links between customers and their orders, with the name of the customer they touch."""
    built = build_elements(orders(spark, folder), SHOP, [MAP_PLACED])
    placed = dedup_by_key(links(built), ["row_key"])
    people = dedup_by_key(entities(build_elements(customers(spark, folder), SHOP, [MAP_CUSTOMER])), ["entity_id"])
    named = people.select("entity_id", property_value(F.col("body"), "name").alias("customer_name"))
    end = F.when(F.col("from_entity_type") == "customer", F.col("from_entity_id")).otherwise(F.col("to_entity_id"))
    return adaptive_join(placed.withColumn("entity_id", end), named, ["entity_id"]).select(
        "row_hash",
        "relation_id",
        "direction_type",
        "from_entity_id",
        "to_entity_id",
        property_value(F.col("body"), "ordered").alias("ordered"),
        "customer_name",
    )


@query(f"""
SELECT coalesce(res_id, 'null') || '@customer~`#' || key_text AS row_key,
  md5(coalesce(res_id, 'null') || '@customer~`#' || key_text) AS row_hash,
  'customer~`#' || key_text AS entity_id, 'customer' AS entity_type, res_id, coalesce(owner_or_null, '') AS owner,
  c_name AS name, balance
FROM ({CUSTOMERS_SQL}) WHERE length(trim(key_text)) > 0
""")
def q_entity_customer(spark: SparkSession, folder: str) -> DataFrame:
    """Customer entities; records without a full id are dropped."""
    built = entities(build_elements(customers(spark, folder), SHOP, [MAP_CUSTOMER]))
    return built.select(
        "row_key",
        "row_hash",
        "entity_id",
        "entity_type",
        "res_id",
        "owner",
        property_value(F.col("body"), "name").alias("name"),
        property_value(F.col("body"), "balance").alias("balance"),
    )


@query(f"SELECT c_custkey, key_text, c_mktsegment FROM ({CUSTOMERS_SQL}) WHERE length(trim(key_text)) > 0 AND owner_or_null IS NOT NULL")
def q_identity_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Rows in which every identifying column holds text."""
    return with_identity(customers(spark, folder), ["key_text", "owner"]).select("c_custkey", "key_text", "c_mktsegment")


_ENDS = [
    ("undirected", False, BIDIRECTIONAL, True),
    ("not_directed", True, NOT_DIRECTED, True),
    ("forward", True, SOURCE_TO_TARGET, True),
    ("backward", True, TARGET_TO_SOURCE, True),
    ("by_column", True, BIDIRECTIONAL, True),
    ("both_ways", True, BIDIRECTIONAL, False),
    ("unstated", True, None, False),
]


@query("""
WITH raw AS (
  SELECT o_orderkey, CASE WHEN o_custkey % 17 = 0 THEN NULL ELSE o_custkey END AS cust,
    CASE WHEN o_orderpriority = '1-URGENT' THEN NULL WHEN o_orderpriority = '5-LOW' THEN 'N' ELSE o_orderstatus END AS way
  FROM orders
), kinds(t) AS (VALUES ('undirected'), ('not_directed'), ('forward'), ('backward'), ('by_column'), ('both_ways'), ('unstated')),
resolved AS (
  SELECT t AS relation_type, o_orderkey, cust,
    CASE WHEN t = 'undirected' THEN '0' WHEN t IN ('not_directed', 'forward', 'backward', 'unstated') THEN '1'
         WHEN t = 'both_ways' THEN '2' WHEN way IS NULL THEN '2' WHEN way = 'N' THEN '0' WHEN way = 'P' THEN '2'
         ELSE '1' END AS direction_type,
    t = 'backward' OR (t = 'by_column' AND way IS NOT NULL AND way = 'F') AS swap
  FROM raw CROSS JOIN kinds WHERE cust IS NOT NULL
)
SELECT relation_type, relation_type || '~`#' || o_orderkey AS relation_id, direction_type,
  CASE WHEN swap THEN 'order' ELSE 'customer' END AS from_entity_type,
  CASE WHEN swap THEN 'order~`#' || o_orderkey ELSE 'customer~`#' || cust END AS from_entity_id,
  CASE WHEN swap THEN 'customer' ELSE 'order' END AS to_entity_type,
  CASE WHEN swap THEN 'customer~`#' || cust ELSE 'order~`#' || o_orderkey END AS to_entity_id
FROM resolved
""")
def q_direction(spark: SparkSession, folder: str) -> DataFrame:
    """Every kind of direction a mapping can give, from one scan; a missing end drops the link."""
    priority = F.col("o_orderpriority")
    frame = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_custkey") % 17 != 0, F.col("o_custkey")).alias("cust"),
        F.when(priority == "1-URGENT", None).when(priority == "5-LOW", "N").otherwise(F.col("o_orderstatus")).alias("way"),
    )
    model = Model(
        "ways", (), tuple(LinkType(t, "customer", "order", "customer", "order", d) for t, d, _, _ in _ENDS)
    )
    mappings = [
        Mapping("orders", "ways", LINK, t, {}, ("o_orderkey",), ("cust",), ("o_orderkey",), way,
                "way" if by_column else None, BY_STATUS if by_column else {})
        for t, _, way, by_column in _ENDS
    ]
    built = links(build_elements(frame, model, mappings, res_id=F.lit("r"), owner=F.lit(None)))
    return built.select(
        "relation_type", "relation_id", "direction_type", "from_entity_type", "from_entity_id", "to_entity_type", "to_entity_id"
    )


def raw_records(spark: SparkSession, folder: str) -> DataFrame:
    """Orders and lines as raw records with a task each."""
    order = dealt_out(orders(spark, folder))
    line = dealt_out(lines(spark, folder))
    return union_all(
        [
            as_records(order, "orders", F.col("o_orderkey"), F.col("o_orderkey") % 3),
            as_records(line, "lineitem", F.col("l_orderkey"), F.col("l_orderkey") % 3),
        ]
    )


def shop_mappings(spark: SparkSession) -> DataFrame:
    mappings = mapping_table(spark, MAP_PLACED, MAP_ORDER, MAP_CONTAINS, MAP_SUPPLIES, MAP_HALF)
    return compiled(mappings, definition_table(spark, SHOP))


FANOUT_SQL = """
  SELECT o_orderkey AS sequence_id, CAST(o_orderkey % 3 AS VARCHAR) AS task_id, 'Link' AS kind, 'placed' AS type_id,
    'placed~`#' || o_custkey || '~`#' || o_orderkey AS element_id, 'res' || (o_custkey % 5) AS res_id,
    CASE o_orderstatus WHEN 'P' THEN '2' WHEN 'N' THEN '0' ELSE '1' END AS direction_type,
    CASE WHEN o_orderstatus = 'F' THEN 'order' ELSE 'customer' END AS from_entity_type,
    CASE WHEN o_orderstatus = 'F' THEN 'order~`#' || o_orderkey ELSE 'customer~`#' || o_custkey END AS from_entity_id,
    CASE WHEN o_orderstatus = 'F' THEN 'customer' ELSE 'order' END AS to_entity_type,
    CASE WHEN o_orderstatus = 'F' THEN 'customer~`#' || o_custkey ELSE 'order~`#' || o_orderkey END AS to_entity_id,
    'ordered=' || strftime(o_orderdate, '%Y-%m-%d') || ':date;status=' || o_orderstatus || ':string' AS body_text
  FROM orders
  UNION ALL
  SELECT o_orderkey, CAST(o_orderkey % 3 AS VARCHAR), 'Entity', 'order', 'order~`#' || o_orderkey, 'res' || (o_custkey % 5),
    NULL, NULL, NULL, NULL, NULL,
    'ordered=' || strftime(o_orderdate, '%Y-%m-%d') || ':date;status=' || o_orderstatus || ':string'
  FROM orders
  UNION ALL
  SELECT l_orderkey, CAST(l_orderkey % 3 AS VARCHAR), 'Link', 'contains', 'contains~`#' || l_orderkey || '~`#' || l_linenumber,
    'res' || (l_suppkey % 5), '1', 'part', 'part~`#' || l_partkey, 'order', 'order~`#' || l_orderkey,
    'quantity=' || CAST(l_quantity AS BIGINT) || ':number'
  FROM lineitem
  UNION ALL
  SELECT l_orderkey, CAST(l_orderkey % 3 AS VARCHAR), 'Link', 'supplies', 'supplies~`#' || l_suppkey || '~`#' || l_partkey,
    'res' || (l_suppkey % 5), '1', 'supplier', 'supplier~`#' || l_suppkey, 'part', 'part~`#' || l_partkey, ''
  FROM lineitem
"""


@query(FANOUT_SQL)
def q_fanout(spark: SparkSession, folder: str) -> DataFrame:
    """Records times the mappings of their schema, by a table of compiled mappings."""
    built = fan_out(raw_records(spark, folder), shop_mappings(spark))
    body = F.transform(
        body_entries(F.col("body")), lambda e: F.concat(e["key"], F.lit("="), e["value"]["value"], F.lit(":"), e["value"]["type"])
    )
    return built.select(
        F.col("record_sequence_id").alias("sequence_id"),
        F.col("record_task_id").alias("task_id"),
        "kind",
        "type_id",
        "element_id",
        "res_id",
        "direction_type",
        "from_entity_type",
        "from_entity_id",
        "to_entity_type",
        "to_entity_id",
        F.array_join(body, ";").alias("body_text"),
    )


@query("""
SELECT 'supplies' AS type_id, 'supplies~`#' || l_suppkey || '~`#' || l_partkey AS element_id,
  CAST(count(*) AS BIGINT) AS copies FROM lineitem GROUP BY ALL
UNION ALL
SELECT 'contains', 'contains~`#' || l_orderkey || '~`#' || l_linenumber, CAST(count(*) AS BIGINT) FROM lineitem GROUP BY ALL
""")
def q_batch_fanout(spark: SparkSession, folder: str) -> DataFrame:
    """Two mappings of one table over a single scan."""
    built = build_elements(dealt_out(lines(spark, folder)), SHOP, [MAP_CONTAINS, MAP_SUPPLIES])
    return built.groupBy("type_id", "element_id").agg(F.count(F.lit(1)).alias("copies"))


@query(f"""
SELECT sequence_id || '@shop_' || CASE kind WHEN 'Entity' THEN 'entity' ELSE 'relation' END || '_' || type_id || '@' || res_id
    || '@' || task_id AS key,
  CASE kind WHEN 'Entity' THEN
    '{{"rowkey":"' || res_id || '@' || element_id || '","entity_id":"' || element_id || '","entity_type":"' || type_id || '",'
  ELSE
    '{{"rowkey":"' || res_id || '@' || element_id || '","relation_id":"' || element_id || '","relation_type":"' || type_id
    || '","direction_type":"' || direction_type || '","from_entity_type":"' || from_entity_type || '","from_entity_id":"'
    || from_entity_id || '","to_entity_type":"' || to_entity_type || '","to_entity_id":"' || to_entity_id || '",'
  END || '"owner":"","dsId":"' || res_id || '","body":{{' || replace(regexp_replace(
    body_text, '(\\w+)=([^;:]*):(\\w+)', '"\\1":{{"value":"\\2","type":"\\3"}}', 'g'), ';', ',') || '}}}}' AS value
FROM ({FANOUT_SQL})
""")
def q_element_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Elements as keyed JSON messages."""
    return element_messages(fan_out(raw_records(spark, folder), shop_mappings(spark)))


@query("""
SELECT DISTINCT event_type AS data_schema_id FROM events
WHERE event_type NOT IN (SELECT event_type FROM events WHERE user_id % 2 = 0 AND event_type < 'p')
""")
def q_unmapped(spark: SparkSession, folder: str) -> DataFrame:
    """Schema ids of records that no mapping covers."""
    events = table(spark, folder, "events")
    mapped = events.filter((F.col("user_id") % 2 == 0) & (F.col("event_type") < "p"))
    as_schema = F.col("event_type").alias("data_schema_id")
    return unmapped_schemas(events.select(as_schema), mapped.select(as_schema))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT) AS quantity,
  strftime(l_shipdate, '%Y-%m-%d') AS shipped
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) AS n FROM lineitem)
WHERE n = 1
""")
def q_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The latest line per order and line number."""
    frame = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_shipdate").cast("date").cast("string").alias("shipped"),
    )
    return dedup_by_key(frame, ["l_orderkey", "l_linenumber"], order_by=["shipped"])


@query("SELECT DISTINCT l_returnflag AS type, l_linestatus || '/' || l_linenumber || '/' || l_suppkey AS payload FROM lineitem")
def q_distinct_payload(spark: SparkSession, folder: str) -> DataFrame:
    """Each payload once per type."""
    payload = F.concat_ws("/", "l_linestatus", F.col("l_linenumber").cast("string"), F.col("l_suppkey").cast("string"))
    frame = table(spark, folder, "lineitem").select(F.col("l_returnflag").alias("type"), payload.alias("payload"))
    return distinct_payloads(frame, "type", "payload")
