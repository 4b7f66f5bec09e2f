"""Models and mappings: declared in code, or loaded from a configuration collection.

The loaders are DataFrame to DataFrame. A mapping joined with its element
definition is one *compiled* row, which `operators.elements.fan_out` joins to
records. `Model` and `Mapping` are the same things declared in code, for plans
whose mappings are known when the plan is built.
"""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftwork.constants import (
    DATE,
    DATE_PATTERN_CODE,
    DATETIME,
    ENTITY,
    LINK,
    PATTERN_SEPARATOR,
    SOURCE_TO_TARGET,
    TEXT,
    TIME,
)
from weftwork.functions.properties import stored_type
from weftwork.plans.schemas import (
    CHANGE_RECORD,
    DATE_PATTERN_RECORD,
    DEFINITION_PROPERTIES,
    MAPPING_RECORD,
    MODEL_RECORD,
    ORIGIN_SCHEMA_RECORD,
    TOPIC_RECORD,
)


@dataclass(frozen=True)
class Property:
    uuid: str
    type: str = TEXT
    analyse: bool = False
    name: str | None = None


@dataclass(frozen=True)
class EntityType:
    uuid: str
    root: str
    properties: tuple[Property, ...] = ()


@dataclass(frozen=True)
class LinkType:
    uuid: str
    source_entity: str | None
    target_entity: str | None
    source_root: str
    target_root: str
    directed: bool = True
    properties: tuple[Property, ...] = ()


@dataclass(frozen=True)
class Model:
    model_id: str
    entities: tuple[EntityType, ...] = ()
    links: tuple[LinkType, ...] = ()

    def find(self, kind: str, type_id: str) -> EntityType | LinkType | None:
        for element in self.entities if kind == ENTITY else self.links:
            if element.uuid == type_id:
                return element
        return None


@dataclass(frozen=True)
class Mapping:
    """How the columns of one data schema feed one element type."""

    data_schema_id: str
    model_id: str
    kind: str
    type_id: str
    columns: dict[str, str] = field(default_factory=dict)  # property uuid -> column
    id_columns: tuple[str, ...] = ()
    source_columns: tuple[str, ...] = ()
    target_columns: tuple[str, ...] = ()
    directivity: str | None = SOURCE_TO_TARGET
    direction_column: str | None = None
    direction_values: dict[str, str] = field(default_factory=dict)  # column value -> directivity


# --- rows of configuration ---------------------------------------------------------------


def records(collection: DataFrame, schema: str) -> DataFrame:
    """The ``value`` column of JSON documents, read with an explicit schema."""
    return collection.select(F.from_json("value", schema).alias("r")).select("r.*")


def definitions(models: DataFrame) -> DataFrame:
    """One row per entity type and link type of each model record."""

    def properties(column: Column) -> Column:
        named = F.transform(
            column,
            lambda p: F.struct(
                p["uuid"].alias("uuid"),
                p["name"].alias("name"),
                p["type"].alias("type"),
                F.coalesce(p["analyse"], F.lit(False)).alias("analyse"),
            ),
        ).cast(DEFINITION_PROPERTIES)
        return F.coalesce(named, F.array().cast(DEFINITION_PROPERTIES))

    nothing = F.lit(None).cast("string")
    entities = models.select(F.col("modelId").alias("model"), F.explode("entities").alias("e")).select(
        "model",
        F.lit(ENTITY).alias("kind"),
        F.col("e.uuid").alias("type_id"),
        F.col("e.rootSemanticType").alias("root"),
        F.lit(False).alias("directed"),
        nothing.alias("source_entity"),
        nothing.alias("target_entity"),
        nothing.alias("source_root"),
        nothing.alias("target_root"),
        properties(F.col("e.properties")).alias("properties"),
    )
    links = models.select(F.col("modelId").alias("model"), F.explode("links").alias("l")).select(
        "model",
        F.lit(LINK).alias("kind"),
        F.col("l.uuid").alias("type_id"),
        F.col("l.uuid").alias("root"),
        F.coalesce("l.directed", F.lit(False)).alias("directed"),
        F.col("l.sourceEntity").alias("source_entity"),
        F.col("l.targetEntity").alias("target_entity"),
        F.col("l.sourceRootSemanticType").alias("source_root"),
        F.col("l.targetRootSemanticType").alias("target_root"),
        properties(F.col("l.properties")).alias("properties"),
    )
    return entities.unionByName(links)


def of_model(frame: DataFrame, model_id: str, column: str = "model") -> DataFrame:
    return frame.filter(F.col(column) == model_id)


def with_both_ends(element_definitions: DataFrame) -> DataFrame:
    """Drop link types that lack a source or a target entity: they build nothing."""
    is_link = F.col("kind") == LINK
    return element_definitions.filter(
        ~is_link | (F.col("source_entity").isNotNull() & F.col("target_entity").isNotNull())
    )


def mapping_rows(mapping_records: DataFrame) -> DataFrame:
    return mapping_records.select(
        F.col("dataSchemaId").alias("data_schema_id"),
        F.col("elp").alias("model"),
        F.col("elpTypeDesc").alias("kind"),
        F.col("elpType").alias("type_id"),
        F.transform(
            "dbmap",
            lambda d: F.struct(d["propertyUuid"].alias("property_uuid"), d["columnName"].alias("column")),
        ).alias("dbmap"),
        F.col("idToColumns").alias("id_columns"),
        F.col("sourceColumns").alias("source_columns"),
        F.col("targetColumns").alias("target_columns"),
        "directivity",
        F.col("directionColumn").alias("direction_column"),
        F.col("directionValues").alias("direction_values"),
    )


def load_definitions(collection: DataFrame) -> DataFrame:
    return definitions(records(collection, MODEL_RECORD))


def load_mappings(collection: DataFrame) -> DataFrame:
    return mapping_rows(records(collection, MAPPING_RECORD))


def load_topic_mappings(collection: DataFrame) -> DataFrame:
    return records(collection, TOPIC_RECORD)


def load_origin_schemas(collection: DataFrame) -> DataFrame:
    return records(collection, ORIGIN_SCHEMA_RECORD)


def load_date_patterns(collection: DataFrame, code: str = DATE_PATTERN_CODE) -> DataFrame:
    """``(code, type, patterns)`` rows of the pattern documents with this code; blank lists are absent."""
    documents = records(collection, DATE_PATTERN_RECORD).filter(F.col("code") == code)
    typed = documents.select(
        "code",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(t).alias("type"), F.col(f"value.{t}").alias("joined"))
                    for t in (DATE, DATETIME, TIME)
                ]
            )
        ),
    )
    return typed.filter(F.length(F.trim("joined")) > 0).select(
        "code", "type", F.split("joined", PATTERN_SEPARATOR).alias("patterns")
    )


def load_changes(collection: DataFrame) -> DataFrame:
    """Change records, one row per changed element type."""
    changed = records(collection, CHANGE_RECORD)

    def side(kind: str, column: str) -> DataFrame:
        return changed.select(
            F.col("elp").alias("model"), F.col("seqId").alias("seq_id"), F.explode(column).alias("c")
        ).select(
            "model",
            F.lit(kind).alias("kind"),
            F.col("c.elpTypeId").alias("type_id"),
            F.col("c.updateId").alias("update_id"),
            F.col("c.dataSchemaId").alias("data_schema_id"),
            "seq_id",
        )

    return side(ENTITY, "entities").unionByName(side(LINK, "links"))


def mappings_by_schema(mappings: DataFrame) -> DataFrame:
    """The mappings of each data schema as one sorted array.

    A group is the mappings of one schema, a handful of configuration rows.
    """
    entry = F.struct("model", "kind", "type_id")
    return mappings.groupBy("data_schema_id").agg(F.array_sort(F.collect_set(entry)).alias("mappings"))


def types_by_schema(changes: DataFrame) -> DataFrame:
    """Changed type ids per model, kind and data schema."""
    return changes.groupBy("model", "kind", "data_schema_id").agg(
        F.array_sort(F.collect_set("type_id")).alias("type_ids")
    )


def compiled(mappings: DataFrame, element_definitions: DataFrame) -> DataFrame:
    """Mappings joined with their element definitions.

    An unknown element or a link type without both ends gives no row. For each
    property the first column mapped to it is taken, and a property defined
    twice counts once.
    """
    joined = mappings.join(with_both_ends(element_definitions), ["model", "kind", "type_id"], "inner")
    return joined.select(*mappings.columns, "root", "directed", "source_entity", "target_entity",
                         "source_root", "target_root", _mapped_properties().alias("fields")).drop("dbmap")


def _mapped_properties() -> Column:
    def column_of(p: Column) -> Column:
        return F.get(F.filter(F.col("dbmap"), lambda d: d["property_uuid"] == p["uuid"]), F.lit(0))["column"]

    distinct = F.filter(
        F.col("properties"),
        lambda p, i: ~F.exists(F.slice(F.col("properties"), F.lit(1), i), lambda q: q["uuid"] == p["uuid"]),
    )
    fields = F.transform(
        distinct,
        lambda p: F.struct(
            p["uuid"].alias("uuid"),
            stored_type(p["type"], p["analyse"]).alias("type"),
            column_of(p).alias("column"),
        ),
    )
    return F.filter(fields, lambda f: f["column"].isNotNull() & (f["column"] != ""))


# --- declared in code --------------------------------------------------------------------


def definition_table(spark: SparkSession, *models: Model) -> DataFrame:
    """The declared models in the shape of `definitions`."""
    rows = []
    for m in models:
        for e in m.entities:
            rows.append((m.model_id, ENTITY, e.uuid, e.root, False, None, None, None, None, _property_rows(e)))
        for link in m.links:
            rows.append(
                (m.model_id, LINK, link.uuid, link.uuid, link.directed, link.source_entity, link.target_entity,
                 link.source_root, link.target_root, _property_rows(link))
            )
    schema = (
        "model string, kind string, type_id string, root string, directed boolean, source_entity string, "
        f"target_entity string, source_root string, target_root string, properties {DEFINITION_PROPERTIES}"
    )
    return spark.createDataFrame(rows, schema)


def _property_rows(element: EntityType | LinkType) -> list[tuple]:
    return [(p.uuid, p.name, p.type, p.analyse) for p in element.properties]


def mapping_table(spark: SparkSession, *mappings: Mapping) -> DataFrame:
    """The declared mappings in the shape of `mapping_rows`."""
    rows = [
        (m.data_schema_id, m.model_id, m.kind, m.type_id, list(m.columns.items()), list(m.id_columns),
         list(m.source_columns), list(m.target_columns), m.directivity, m.direction_column, dict(m.direction_values))
        for m in mappings
    ]
    schema = (
        "data_schema_id string, model string, kind string, type_id string, "
        "dbmap array<struct<property_uuid:string,column:string>>, id_columns array<string>, "
        "source_columns array<string>, target_columns array<string>, directivity string, "
        "direction_column string, direction_values map<string,string>"
    )
    return spark.createDataFrame(rows, schema)
