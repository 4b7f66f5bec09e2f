"""Models, mappings, change requests and task scopes kept as JSON configuration."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftwork.catalog import query, table
from weftwork.operators.selection import effective_sequences, sorted_sequences
from weftwork.operators.elements import union_all
from weftwork.plans.model import (
    compiled,
    load_changes,
    load_date_patterns,
    load_definitions,
    load_mappings,
    load_origin_schemas,
    load_topic_mappings,
    mappings_by_schema,
    of_model,
    types_by_schema,
    with_both_ends,
)
from weftwork.plans.scope import (
    changed_types,
    effective_mappings,
    plan_changes,
    task_scope,
    upsert_cursor,
)
from weftwork.sources.config import matching


def _json(*fields: Column) -> Column:
    return F.to_json(F.struct(*fields)).alias("value")


def _property(uuid: str, type_: str, analyse: bool) -> Column:
    return F.struct(F.lit(uuid).alias("uuid"), F.lit(type_).alias("type"), F.lit(analyse).alias("analyse"))


def model_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One model document per supplier; every third lacks a link end."""
    name = F.concat(F.lit("model"), (F.col("s_suppkey") % 4).cast("string"))
    uuid = F.concat(F.lit("s"), F.col("s_suppkey").cast("string"))
    entity = F.struct(
        uuid.alias("uuid"),
        F.lit("supplier").alias("rootSemanticType"),
        F.array(_property("name", "text", True), _property("code", "text", False), _property("name", "text", False)).alias(
            "properties"
        ),
    )
    link = F.struct(
        F.concat(uuid, F.lit("_link")).alias("uuid"),
        (F.col("s_nationkey") % 2 == 0).alias("directed"),
        uuid.alias("sourceEntity"),
        F.when(F.col("s_suppkey") % 3 != 0, F.lit("nation")).alias("targetEntity"),
        F.lit("supplier").alias("sourceRootSemanticType"),
        F.lit("nation").alias("targetRootSemanticType"),
        F.array(_property("since", "date", False)).alias("properties"),
    )
    return table(spark, folder, "supplier").select(
        _json(name.alias("modelId"), F.array(entity).alias("entities"), F.array(link).alias("links"))
    )


def _schema() -> Column:
    return F.concat(F.lit("schema"), F.floor(F.col("s_suppkey") / 20).cast("string"))


def mapping_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One entity mapping per supplier, twenty to a data schema."""
    uuid = F.concat(F.lit("s"), F.col("s_suppkey").cast("string"))
    pair = lambda p, c: F.struct(F.lit(p).alias("propertyUuid"), F.lit(c).alias("columnName"))
    return table(spark, folder, "supplier").select(
        _json(
            _schema().alias("dataSchemaId"),
            F.concat(F.lit("model"), (F.col("s_suppkey") % 4).cast("string")).alias("elp"),
            uuid.alias("elpType"),
            F.lit("Entity").alias("elpTypeDesc"),
            F.array(pair("name", "s_name"), pair("name", "other"), pair("unknown", "s_acctbal")).alias("dbmap"),
            F.array(F.lit("s_suppkey")).alias("idToColumns"),
            F.lit("SourceToTarget").alias("directivity"),
        )
    )


@query("""
SELECT 'model' || (s_suppkey % 4) AS model, 'Entity' AS kind, 's' || s_suppkey AS type_id, 'supplier' AS root, false AS directed,
  3 AS properties FROM supplier
UNION ALL
SELECT 'model' || (s_suppkey % 4), 'Link', 's' || s_suppkey || '_link', 's' || s_suppkey || '_link', s_nationkey % 2 = 0, 1 FROM supplier
""")
def q_model_definitions(spark: SparkSession, folder: str) -> DataFrame:
    """Element definitions of model documents."""
    return load_definitions(model_documents(spark, folder)).select(
        "model", "kind", "type_id", "root", "directed", F.size("properties").alias("properties")
    )


@query("""
SELECT 'model1' AS model, 's' || s_suppkey || '_link' AS type_id, 's' || s_suppkey AS source_entity, 'nation' AS target_entity
FROM supplier WHERE s_suppkey % 4 = 1 AND s_suppkey % 3 <> 0
UNION ALL SELECT 'model1', 's' || s_suppkey, NULL, NULL FROM supplier WHERE s_suppkey % 4 = 1
""")
def q_link_ends(spark: SparkSession, folder: str) -> DataFrame:
    """Definitions of one model without the links that lack an end."""
    chosen = matching(model_documents(spark, folder), "modelId", "model1")
    whole = with_both_ends(of_model(load_definitions(chosen), "model1"))
    return whole.select("model", "type_id", "source_entity", "target_entity")


@query("""
SELECT 'schema' || (s_suppkey // 20) AS data_schema_id, 'model' || (s_suppkey % 4) AS model, 's' || s_suppkey AS type_id,
  'supplier' AS root, 'name:text:s_name' AS fields
FROM supplier
""")
def q_compiled_mappings(spark: SparkSession, folder: str) -> DataFrame:
    """Mappings joined with their definitions: the first column and the first definition of a property count."""
    made = compiled(load_mappings(mapping_documents(spark, folder)), load_definitions(model_documents(spark, folder)))
    text = F.transform("fields", lambda f: F.concat_ws(":", f["uuid"], f["type"], f["column"]))
    return made.select("data_schema_id", "model", "type_id", "root", F.array_join(text, ";").alias("fields"))


@query("""
SELECT 'schema' || (s_suppkey // 20) AS data_schema_id, CAST(count(*) AS INTEGER) AS mappings,
  min('model' || (s_suppkey % 4) || '/' || 's' || s_suppkey) AS least
FROM supplier GROUP BY s_suppkey // 20
""")
def q_mappings_by_schema(spark: SparkSession, folder: str) -> DataFrame:
    """The mappings of each data schema."""
    grouped = mappings_by_schema(load_mappings(mapping_documents(spark, folder)))
    least = F.array_min(F.transform("mappings", lambda m: F.concat_ws("/", m["model"], m["type_id"])))
    return grouped.select("data_schema_id", F.size("mappings").alias("mappings"), least.alias("least"))


def _change(schema: Column, type_id: Column, update: Column) -> Column:
    return F.struct(type_id.alias("elpTypeId"), update.alias("updateId"), schema.alias("dataSchemaId"))


def change_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One change record per part, naming its brand and its type."""
    update = F.col("p_size").cast("string")
    return table(spark, folder, "part").select(
        _json(
            F.lit("shop").alias("elp"),
            F.col("p_partkey").alias("seqId"),
            F.array(_change(F.col("p_type"), F.col("p_brand"), update)).alias("entities"),
            F.array(_change(F.col("p_type"), F.concat(F.col("p_brand"), F.lit("_link")), update)).alias("links"),
        )
    )


@query("""
SELECT 'shop' AS model, kind, data_schema_id, string_agg(DISTINCT type_id, ',' ORDER BY type_id) AS type_ids FROM (
  SELECT 'Entity' AS kind, p_type AS data_schema_id, p_brand AS type_id FROM part
  UNION ALL SELECT 'Link', p_type, p_brand || '_link' FROM part) GROUP BY ALL
""")
def q_types_by_schema(spark: SparkSession, folder: str) -> DataFrame:
    """Changed types per data schema, from change documents."""
    grouped = types_by_schema(load_changes(change_documents(spark, folder)))
    return grouped.select("model", "kind", "data_schema_id", F.array_join("type_ids", ",").alias("type_ids"))


@query("""
SELECT 'load' || p_partkey AS topic, 'shop' AS model, p_brand AS type_id, NULL AS fields FROM part
UNION ALL SELECT NULL, NULL, p_type, 'p_name,' || lower(p_brand) FROM part
""")
def q_topics_and_schemas(spark: SparkSession, folder: str) -> DataFrame:
    """Topic mappings and original schemas."""
    parts = table(spark, folder, "part")
    topics = load_topic_mappings(
        parts.select(
            _json(
                F.concat(F.lit("load"), F.col("p_partkey").cast("string")).alias("topic"),
                F.lit("shop").alias("elp"),
                F.col("p_brand").alias("elpType"),
            )
        )
    )
    schemas = load_origin_schemas(
        parts.select(_json(F.col("p_type").alias("typeId"), F.array(F.lit("p_name"), F.lower("p_brand")).alias("fields")))
    )
    return union_all(
        [
            topics.select("topic", F.col("elp").alias("model"), F.col("elpType").alias("type_id")),
            schemas.select(F.col("typeId").alias("type_id"), F.array_join("fields", ",").alias("fields")),
        ]
    )


@query("""
SELECT 'formats' AS code, t AS type, p AS patterns, CAST(count(*) AS BIGINT) AS documents FROM (
  SELECT 'date' AS t, 'yyyy-' || p_size || '|dd' AS p FROM part WHERE p_partkey % 2 = 0
  UNION ALL SELECT 'time', 'HH' || p_size FROM part WHERE p_partkey % 2 = 0 AND p_size % 2 = 0) GROUP BY t, p
""")
def q_date_pattern_config(spark: SparkSession, folder: str) -> DataFrame:
    """Pattern lists of the configuration documents with one code; blank lists are absent."""
    size = F.col("p_size").cast("string")
    value = F.struct(
        F.concat(F.lit("yyyy-"), size, F.lit("@dd")).alias("date"),
        F.lit(" ").alias("datetime"),
        F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("HH"), size)).otherwise("").alias("time"),
    )
    code = F.when(F.col("p_partkey") % 2 == 0, "formats").otherwise("others")
    documents = table(spark, folder, "part").select(_json(code.alias("code"), value.alias("value")))
    loaded = load_date_patterns(documents, "formats")
    return loaded.groupBy("code", "type", F.array_join("patterns", "|").alias("patterns")).agg(
        F.count(F.lit(1)).alias("documents")
    )


def _cursor(frame: DataFrame, model: Column, type_id: Column, update: Column, schema: Column) -> DataFrame:
    return frame.select(
        model.alias("model"),
        F.lit("Entity").alias("kind"),
        type_id.alias("type_id"),
        update.alias("update_id"),
        schema.alias("data_schema_id"),
        F.lit(None).cast("bigint").alias("seq_id"),
    )


def _stored(spark: SparkSession, folder: str) -> DataFrame:
    """Every second customer is known from the last run; segment HOUSEHOLD is not known at all."""
    frame = table(spark, folder, "customer").filter((F.col("c_custkey") % 2 == 0) & (F.col("c_mktsegment") != "HOUSEHOLD"))
    return _cursor(
        frame, F.col("c_mktsegment"), F.col("c_name"), (F.col("c_custkey") % 50).cast("string"), F.lit("old")
    )


def _request(spark: SparkSession, folder: str) -> DataFrame:
    """Customers not in AUTOMOBILE ask for a change; some requests are incomplete."""
    frame = table(spark, folder, "customer").filter(F.col("c_mktsegment") != "AUTOMOBILE")
    schema = F.when(F.col("c_custkey") % 7 != 0, F.concat(F.lit("n"), F.col("c_nationkey").cast("string")))
    return _cursor(frame, F.col("c_mktsegment"), F.col("c_name"), F.col("c_nationkey").cast("string"), schema)


_CHANGED_SQL = """
  SELECT c_mktsegment AS model, c_name AS type_id, CAST(c_nationkey AS VARCHAR) AS update_id, 'n' || c_nationkey AS data_schema_id
  FROM customer
  WHERE c_mktsegment NOT IN ('AUTOMOBILE', 'HOUSEHOLD') AND c_custkey % 2 = 0 AND c_custkey % 7 <> 0
    AND CAST(c_nationkey AS VARCHAR) > CAST(c_custkey % 50 AS VARCHAR)
"""


@query(_CHANGED_SQL)
def q_changed_types(spark: SparkSession, folder: str) -> DataFrame:
    """Requests for known types that are later than what is stored, compared as text."""
    changed = changed_types(_request(spark, folder), _stored(spark, folder))
    return changed.select("model", "type_id", "update_id", "data_schema_id")


@query(f"""
SELECT 'transform' AS cursor, model, type_id, update_id, data_schema_id FROM ({_CHANGED_SQL})
UNION ALL
SELECT 'transform', c_mktsegment, c_name, CAST(c_nationkey AS VARCHAR), CASE WHEN c_custkey % 7 <> 0 THEN 'n' || c_nationkey END
FROM customer WHERE c_mktsegment = 'HOUSEHOLD'
UNION ALL
SELECT 'load', c_mktsegment, c_name, CAST(c_nationkey AS VARCHAR), CASE WHEN c_custkey % 7 <> 0 THEN 'n' || c_nationkey END
FROM customer WHERE c_mktsegment <> 'AUTOMOBILE'
UNION ALL
SELECT 'load', c_mktsegment, c_name, CAST(c_custkey % 50 AS VARCHAR), 'old' FROM customer
WHERE c_mktsegment = 'AUTOMOBILE' AND c_custkey % 2 = 0
""")
def q_change_plan(spark: SparkSession, folder: str) -> DataFrame:
    """Both cursors after a request: known models give their changes, new models everything."""
    stored = _stored(spark, folder)
    plan = plan_changes(_request(spark, folder), stored, stored.limit(0), sequence_id=7)
    rows = [
        plan.transform_cursor.withColumn("cursor", F.lit("transform")),
        plan.load_cursor.withColumn("cursor", F.lit("load")),
    ]
    return union_all(rows).select("cursor", "model", "type_id", "update_id", "data_schema_id")


@query("""
SELECT model, CAST(sum(n) AS BIGINT) AS types, max(origin) AS origin FROM (
  SELECT c_mktsegment AS model, count(*) AS n, 'new' AS origin FROM customer WHERE c_mktsegment <> 'AUTOMOBILE' GROUP BY 1
  UNION ALL SELECT 'AUTOMOBILE', count(*), 'old' FROM customer WHERE c_mktsegment = 'AUTOMOBILE' AND c_custkey % 2 = 0)
GROUP BY model HAVING sum(n) > 0
""")
def q_cursor_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Models of a cursor replaced, added, or kept."""
    after = upsert_cursor(_stored(spark, folder), _request(spark, folder))
    origin = F.when(F.max("data_schema_id") == "old", "old").otherwise("new")
    return after.groupBy("model").agg(F.count(F.lit(1)).alias("types"), origin.alias("origin"))


def _task_cursor(spark: SparkSession, folder: str) -> DataFrame:
    """A cursor that names the suppliers of the first ten nations with a high balance."""
    frame = table(spark, folder, "supplier").filter((F.col("s_nationkey") < 10) & (F.col("s_acctbal") > 7000))
    return _cursor(
        frame,
        F.lit("model"),
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string")),
        F.lit("1"),
        _schema(),
    )


_EFFECTIVE_SQL = """
  SELECT 'schema' || (s_suppkey // 20) AS data_schema_id, 's' || s_suppkey AS type_id FROM supplier
  WHERE s_suppkey // 20 IN (SELECT s_suppkey // 20 FROM supplier WHERE s_nationkey < 10 AND s_acctbal > 7000)
    AND s_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 10 AND s_acctbal > 7000)
"""


@query(_EFFECTIVE_SQL)
def q_effective_mapping(spark: SparkSession, folder: str) -> DataFrame:
    """Mappings of the schemas and types that a cursor names."""
    mappings = load_mappings(mapping_documents(spark, folder))
    return effective_mappings(mappings, _task_cursor(spark, folder)).select("data_schema_id", "type_id")


@query(f"""
SELECT 'FULL' AS mode, 'schema' || (s_suppkey // 20) AS data_schema_id, 's' || s_suppkey AS type_id FROM supplier
UNION ALL SELECT 'SUB', data_schema_id, type_id FROM ({_EFFECTIVE_SQL})
UNION ALL SELECT 'SPE', 'schema' || (s_suppkey // 20), 's' || s_suppkey FROM supplier WHERE s_suppkey // 20 = 1
""")
def q_task_scope(spark: SparkSession, folder: str) -> DataFrame:
    """The mappings of a full task, of one by cursor, and of one for a single schema."""
    mappings = load_mappings(mapping_documents(spark, folder))
    cursor = _task_cursor(spark, folder)
    scopes = {
        "FULL": task_scope("FULL", mappings, schemas=mappings),
        "SUB": task_scope("SUB", mappings, cursor=cursor),
        "SPE": task_scope("SPE", mappings, special_schema="schema1"),
    }
    return union_all(
        [
            chosen.join(schemas, "data_schema_id", "left_semi").select(
                F.lit(mode).alias("mode"), "data_schema_id", "type_id"
            )
            for mode, (schemas, chosen) in scopes.items()
        ]
    )


@query("""
WITH days AS (SELECT *, CAST(datediff('day', DATE '2024-01-01', CAST(ts AS DATE)) * 10 AS BIGINT) AS sequence_id FROM events)
SELECT sequence_id, CAST(count(*) AS BIGINT) AS records FROM days
WHERE sequence_id < 75 OR sequence_id = (SELECT min(sequence_id) FROM days WHERE sequence_id > 75) GROUP BY 1
""")
def q_incremental_files(spark: SparkSession, folder: str) -> DataFrame:
    """Records of the sequences that a cursor takes: those below it and the first above it."""
    day = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
    events = table(spark, folder, "events").select((day * 10).cast("bigint").alias("sequence_id"))
    chosen = sorted_sequences(effective_sequences(events, 75))
    counted = events.groupBy("sequence_id").agg(F.count(F.lit(1)).alias("records"))
    return counted.join(chosen, "sequence_id", "left_semi")
