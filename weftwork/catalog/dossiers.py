"""Dossiers of customers: their orders, their events, and the parts they ordered."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftwork.catalog import query, table
from weftwork.constants import ENTITY, LINK
from weftwork.operators.cells import element_cells
from weftwork.operators.dossier import (
    Reader,
    build_dossiers,
    cell_reader,
    combined,
    documents,
    dossier_values,
    field_values,
    gather,
    join_properties,
    root_rows,
    root_values,
    table_reader,
    two_hop,
)
from weftwork.operators.elements import build_elements
from weftwork.operators.joins import adaptive_join
from weftwork.plans.model import EntityType, Mapping, Model, Property
from weftwork.plans.rules import DossierRule, Extension, Related, rule_from_json
from weftwork.session import shared_folder

PARTS = Extension(
    Related("d_order", "placed", "o_custkey", "o_orderkey"), (Related("d_part", "line", "l_orderkey", "l_partkey"),)
)
RULE = DossierRule(
    doc_type="CUSTOMER",
    model="shop",
    root_type="customer",
    key="c_custkey",
    root_fields=(("c_name", "tab_s_name"), ("c_mktsegment", "tab_s_segment"), ("c_name", "d_name")),
    entity_fields=(Related("d_event", "event", "user_id", "event_type"), Related("d_kind", "event", "user_id", "kind")),
    relation_fields=(Related("d_status", "placed", "o_custkey", "o_orderstatus"),),
    extensions=(PARTS,),
)


def reader(spark: SparkSession, folder: str) -> Reader:
    """The tables as element types; customers with a key divisible by 19 have none."""
    customer = F.when(F.col("c_custkey") % 19 != 0, F.col("c_custkey"))
    none = F.lit("r")
    return table_reader(
        {
            (ENTITY, "customer"): table(spark, folder, "customer").select(
                customer.alias("c_custkey"),
                "c_name",
                "c_mktsegment",
                F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("resid"),
            ),
            (ENTITY, "event"): table(spark, folder, "events").select(
                "user_id",
                "event_type",
                F.when(F.col("event_type") == "view", F.lit("")).otherwise(F.lit("active")).alias("kind"),
                none.alias("resid"),
            ),
            (LINK, "placed"): table(spark, folder, "orders").select(
                "o_custkey", "o_orderkey", "o_orderstatus", none.alias("resid")
            ),
            (ENTITY, "line"): table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", none.alias("resid")),
        }
    )


_ROOT_SQL = "SELECT CAST(c_custkey AS VARCHAR) AS k, * FROM customer WHERE c_custkey % 19 <> 0"
_VALUES_SQL = f"""
  SELECT k, 'tab_s_name' AS field, c_name AS value FROM ({_ROOT_SQL})
  UNION ALL SELECT k, 'd_name', c_name FROM ({_ROOT_SQL})
  UNION ALL SELECT k, 'tab_s_segment', c_mktsegment FROM ({_ROOT_SQL})
  UNION ALL SELECT CAST(user_id AS VARCHAR), 'd_event', event_type FROM events
  UNION ALL SELECT CAST(user_id AS VARCHAR), 'd_kind', CASE WHEN event_type = 'view' THEN '' ELSE 'active' END FROM events
  UNION ALL SELECT CAST(o_custkey AS VARCHAR), 'd_status', o_orderstatus FROM orders
  UNION ALL SELECT CAST(o_custkey AS VARCHAR), 'd_order', CAST(o_orderkey AS VARCHAR) FROM orders
  UNION ALL SELECT CAST(o_custkey AS VARCHAR), 'd_part', CAST(l_partkey AS VARCHAR) FROM orders JOIN lineitem ON l_orderkey = o_orderkey
"""


def _joined(values: str | Column) -> Column:
    return F.array_join(values, "|")


@query(f"""
SELECT 'CUSTOMER@' || k AS doc_id, 0 AS part, field, CAST(count(*) AS INTEGER) AS n, string_agg(value, '|' ORDER BY value) AS joined
FROM ({_VALUES_SQL}) WHERE k IN (SELECT k FROM ({_ROOT_SQL})) GROUP BY ALL
""")
def q_dossier(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents with root, related and two-hop fields, one row per field."""
    docs = build_dossiers(reader(spark, folder), RULE)
    return field_values(docs).select("doc_id", "part", "field", F.size("values").alias("n"), _joined("values").alias("joined"))


@query(f"""
WITH found AS (SELECT k, field, value FROM ({_VALUES_SQL}) WHERE k IN (SELECT k FROM ({_ROOT_SQL})))
SELECT 'CUSTOMER@' || k AS doc_id, field, value, CAST(count(*) AS BIGINT) AS copies, n > 7 AS large,
  true AS own_ids, true AS parts_fit
FROM found JOIN (SELECT k, count(*) AS n FROM found GROUP BY k) USING (k) GROUP BY k, field, value, n
""")
def q_dossier_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Values of documents that are cut into parts of about seven, counted over the parts.

    ``own_ids``: every part of the document has another id; ``parts_fit``: only a document of more values has several.
    """
    path = shared_folder(spark, "dossier-parts")  # stored, so that they are built once for both uses
    build_dossiers(reader(spark, folder), RULE, part_size=7).write.parquet(path)
    docs = spark.read.parquet(path)
    per_doc = docs.groupBy("doc_id").agg(
        (F.count_distinct("id") == F.count_distinct("part")).alias("own_ids"), F.max("part").alias("last_part")
    )
    each = field_values(docs).select("doc_id", "field", F.explode("values").alias("value"))
    found = each.groupBy("doc_id", "field", "value").agg(F.count(F.lit(1)).alias("copies"))
    sizes = each.groupBy("doc_id").agg((F.count(F.lit(1)) > 7).alias("large"))
    fits = ((F.col("last_part") == 0) | F.col("large")).alias("parts_fit")
    whole = adaptive_join(found, sizes.join(per_doc, "doc_id"), ["doc_id"])
    return whole.select("doc_id", "field", "value", "copies", "large", "own_ids", fits)


@query(f"""
SELECT 'CUSTOMER@' || k AS doc_id, field, CAST(count(*) AS INTEGER) AS n, string_agg(value, '|' ORDER BY value) AS joined
FROM ({_VALUES_SQL}) WHERE k IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_custkey % 19 <> 0
            AND c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 2)) GROUP BY ALL
""")
def q_dossier_excluding(spark: SparkSession, folder: str) -> DataFrame:
    """Dossiers without the rows of listed resources."""
    listed = table(spark, folder, "nation").filter(F.col("n_regionkey") < 2)
    resources = listed.select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("resId"))
    docs = build_dossiers(reader(spark, folder), RULE, resources)
    return field_values(docs).select("doc_id", "field", F.size("values").alias("n"), _joined("values").alias("joined"))


_PEOPLE = """
{"docType": "PEOPLE", "elpModel": "shop", "elpType": "customer", "key": "c_custkey", "docCollectionName": "docs",
 "propertyMappings": [
   {"needRelation": false, "sPropertyName": "c_name", "dPropertyName": "tab_s_name", "sourceTargetEntities": []},
   {"needRelation": false, "sPropertyName": "", "dPropertyName": "tab_s_nothing", "sourceTargetEntities": []},
   {"needRelation": true, "dPropertyName": "tab_s_showTag", "sourceTargetEntities": [
     {"onlyFromRel": false, "targetEntityType": "event", "sPropertyName": "kind", "sPropertyId": "user_id"}]}],
 "indexPropertyMappings": [
   {"needRelation": true, "dPropertyName": "d_status", "sourceTargetEntities": [
     {"onlyFromRel": true, "linkedRelationType": "placed", "sPropertyName": "o_orderstatus", "sPropertyId": "o_custkey"}]}]}
"""


@query(f"""
SELECT 'PEOPLE@' || k AS doc_id, field, string_agg(value, '|' ORDER BY value) AS joined FROM (
  SELECT k, field, value FROM ({_VALUES_SQL}) WHERE field IN ('tab_s_name', 'd_status')
  UNION ALL SELECT DISTINCT k, 'tab_s_showTag', '重点人员' FROM ({_VALUES_SQL}) WHERE field = 'd_kind' AND value <> ''
  UNION ALL SELECT k, 'tab_s_showTag', '' FROM ({_VALUES_SQL}) WHERE field = 'd_kind' AND value = '')
WHERE k IN (SELECT k FROM ({_ROOT_SQL})) GROUP BY ALL
""")
def q_dossier_tag(spark: SparkSession, folder: str) -> DataFrame:
    """A rule document in JSON; a non-empty tag field becomes the one constant tag."""
    docs = build_dossiers(reader(spark, folder), rule_from_json(_PEOPLE))
    return field_values(docs).select("doc_id", "field", _joined("values").alias("joined"))


@query(f"""
SELECT k AS doc_key, field, value, CAST(count(*) AS BIGINT) AS copies FROM ({_VALUES_SQL})
WHERE field IN ('tab_s_name', 'd_name', 'tab_s_segment') OR (field = 'd_status' AND k IN (SELECT k FROM ({_ROOT_SQL})))
GROUP BY ALL
""")
def q_left_join_props(spark: SparkSession, folder: str) -> DataFrame:
    """Root properties with those of the orders of the same key."""
    read = reader(spark, folder)
    root = root_values(root_rows(read, RULE), RULE)
    return combined(join_properties(root, gather(read, LINK, RULE.relation_fields)))


@query(f"""
SELECT k AS doc_key, field, value, CAST(count(*) AS BIGINT) AS copies FROM ({_VALUES_SQL})
WHERE field IN ('d_event', 'd_kind') GROUP BY ALL
""")
def q_gather(spark: SparkSession, folder: str) -> DataFrame:
    """Related values under their dossier field, two fields from one reading of the table."""
    return combined(gather(reader(spark, folder), ENTITY, RULE.entity_fields))


@query(f"""
SELECT k AS doc_key, field, value, CAST(count(*) AS BIGINT) AS copies FROM ({_VALUES_SQL})
WHERE field IN ('d_order', 'd_part') GROUP BY ALL
""")
def q_two_hop(spark: SparkSession, folder: str) -> DataFrame:
    """Customer to orders to parts, all under the customer."""
    return combined(two_hop(reader(spark, folder), PARTS))


_BY_STATUS = Extension(
    Related("d_priority", "priority", "o_custkey", "o_orderpriority"),
    (Related("d_segment", "part", "segment", "p_brand"),),
)


@query("""
WITH hops AS (SELECT CAST(o_custkey AS VARCHAR) AS doc_key, o_orderpriority AS hop, count(*) AS m FROM orders GROUP BY ALL),
held AS (SELECT p_size % 5 + 1 AS level, p_brand, count(*) AS n FROM part GROUP BY ALL)
SELECT doc_key, 'd_priority' AS field, hop AS value, CAST(m AS BIGINT) AS copies FROM hops
UNION ALL
SELECT doc_key, 'd_segment', p_brand, CAST(sum(m * n) AS BIGINT) FROM hops JOIN held ON level = CAST(hop[1] AS INTEGER) GROUP BY doc_key, p_brand
""")
def q_two_hop_shared(spark: SparkSession, folder: str) -> DataFrame:
    """Two hops over a handful of shared values: copies are multiplied as counts, never joined row by row."""
    priorities = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
    level = F.element_at(F.array(*[F.lit(p) for p in priorities]), F.col("p_size") % 5 + 1)
    read = table_reader(
        {
            (LINK, "priority"): table(spark, folder, "orders").select("o_custkey", "o_orderpriority", F.lit("r").alias("resid")),
            (ENTITY, "part"): table(spark, folder, "part").select(level.alias("segment"), "p_brand", F.lit("r").alias("resid")),
        }
    )
    return combined(two_hop(read, _BY_STATUS))


@query("""
SELECT 'ORDERS@' || o_custkey AS doc_id, CAST(count(*) AS INTEGER) AS n, string_agg(CAST(o_orderkey AS VARCHAR), '|' ORDER BY CAST(o_orderkey AS VARCHAR)) AS orders
FROM orders GROUP BY o_custkey
""")
def q_concat_per_key(spark: SparkSession, folder: str) -> DataFrame:
    """The order keys of each customer as one array."""
    values = table(spark, folder, "orders").select(
        F.col("o_custkey").cast("string").alias("doc_key"),
        F.lit("order").alias("field"),
        F.col("o_orderkey").cast("string").alias("value"),
        F.lit(1).cast("bigint").alias("copies"),
    )
    docs = documents(values.select("doc_key").distinct(), values, "ORDERS")
    held = F.try_element_at("fields", F.lit("order"))
    return docs.select("doc_id", F.size(held).alias("n"), _joined(held).alias("orders"))


_VIEWER = Model("shop", (EntityType("viewer", "viewer", (Property("code", "text"), Property("name", "text"))),))
_MAP_VIEWER = Mapping("customer", "shop", ENTITY, "viewer", {"code": "c_custkey", "name": "c_name"}, ("c_custkey",))
_VIEWER_RULE = DossierRule("VIEWER", "shop", "viewer", "code", (("name", "tab_s_name"),))


@query("SELECT 'VIEWER@' || c_custkey AS doc_id, c_name AS name FROM customer WHERE c_nationkey % 3 <> 0")
def q_dossier_from_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Dossiers read back from wide-column cells of a time range."""
    frame = table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey")
    elements = build_elements(frame, _VIEWER, [_MAP_VIEWER], F.lit("r"), F.lit(None), keep=("c_nationkey",))
    day = F.concat(F.lit("2024-01-0"), (F.col("c_nationkey") % 3 + 1).cast("string"), F.lit(" 00:00:00"))
    cells = element_cells(elements, day.cast("timestamp_ntz"))
    start, end = (F.lit(f"2024-01-{d} 00:00:00").cast("timestamp_ntz") for d in ("02", "04"))
    docs = build_dossiers(cell_reader(cells, "shop", start, end), _VIEWER_RULE)
    return docs.select("doc_id", _joined(F.try_element_at("fields", F.lit("tab_s_name"))).alias("name"))


@query(f"""
SELECT CAST(count(*) AS BIGINT) AS values_found, CAST(count(DISTINCT k) AS BIGINT) AS keys_found FROM ({_VALUES_SQL})
""")
def q_dossier_volume(spark: SparkSession, folder: str) -> DataFrame:
    """How many values a rule gathers, and for how many keys, before documents are made."""
    _, values = dossier_values(reader(spark, folder), RULE)
    per_key = values.groupBy("doc_key").agg(F.sum("copies").alias("n"))
    return per_key.agg(F.sum("n").alias("values_found"), F.count(F.lit(1)).alias("keys_found"))
