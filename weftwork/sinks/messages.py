"""Elements as keyed JSON messages, and back."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from weftwork.constants import ENTITY, ENTITY_TABLE, LINK, LINK_TABLE, NAME_SEPARATOR
from weftwork.functions.identity import row_hash
from weftwork.functions.keys import message_key, message_key_parts, table_name
from weftwork.functions.properties import BODY_TYPE
from weftwork.sources.kafka import ELEMENT_KEY

_ENDS = ["direction_type", "from_entity_type", "from_entity_id", "to_entity_type", "to_entity_id"]
_MESSAGE = (
    "struct<rowkey:string,entity_id:string,entity_type:string,relation_id:string,relation_type:string,"
    + ",".join(f"{name}:string" for name in _ENDS)
    + f",owner:string,dsId:string,body:{BODY_TYPE}>"
)


def element_messages(elements: DataFrame) -> DataFrame:
    """``key, value``: ``sequence@model_kind_type@resource@task`` and the element as JSON.

    The elements are those of `operators.elements.fan_out`, which carry the
    record's key parts.
    """
    is_entity = F.col("kind") == ENTITY
    name = table_name(F.col("model"), F.col("kind"), F.col("type_id"))

    def when(condition: Column, column: str, alias: str) -> Column:
        return F.when(condition, F.col(column)).alias(alias)

    value = F.to_json(
        F.struct(
            F.col("row_key").alias("rowkey"),
            when(is_entity, "element_id", "entity_id"),
            when(is_entity, "type_id", "entity_type"),
            when(~is_entity, "element_id", "relation_id"),
            when(~is_entity, "type_id", "relation_type"),
            *_ENDS,
            "owner",
            F.col("res_id").alias("dsId"),
            "body",
        )
    )
    return elements.select(
        message_key(
            F.col("record_sequence_id"), name, F.col("record_res_id"), F.col("record_task_id")
        ).alias("key"),
        value.alias("value"),
    )


def keyed_elements(messages: DataFrame) -> DataFrame:
    """Messages with their key split into ``sequence_id, element_name, res_id, task_id``."""
    return messages.select(*message_key_parts(F.col("key"), ELEMENT_KEY), "value")


def elements_of(payloads: DataFrame) -> DataFrame:
    """Element rows of ``element_name, value`` rows; a value that is no element gives nothing."""
    parsed = payloads.select("element_name", F.from_json("value", _MESSAGE).alias("m"))
    is_entity = F.col("m.entity_id").isNotNull()
    type_id = F.coalesce("m.entity_type", "m.relation_type")
    marker = F.when(is_entity, F.lit(ENTITY_TABLE)).otherwise(F.lit(LINK_TABLE))
    tail = F.concat(F.lit(NAME_SEPARATOR), marker, F.lit(NAME_SEPARATOR), type_id)
    model = F.substring(F.col("element_name"), F.lit(1), F.length("element_name") - F.length(tail))
    return parsed.filter(F.coalesce("m.entity_id", "m.relation_id").isNotNull()).select(
        model.alias("model"),
        F.when(is_entity, F.lit(ENTITY)).otherwise(F.lit(LINK)).alias("kind"),
        type_id.alias("type_id"),
        F.col("m.rowkey").alias("row_key"),
        row_hash(F.col("m.rowkey")).alias("row_hash"),
        F.coalesce("m.entity_id", "m.relation_id").alias("element_id"),
        *[F.col(f"m.{name}").alias(name) for name in _ENDS],
        F.col("m.dsId").alias("res_id"),
        F.coalesce("m.owner", F.lit("")).alias("owner"),
        F.coalesce(F.col("m.body"), F.create_map().cast(BODY_TYPE)).alias("body"),
    )


def kafka_stream(messages: DataFrame, brokers: str, topic: str, **options) -> DataStreamWriter:
    """Stream writer of ``key, value`` to a Kafka topic."""
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("topic", topic)
        .options(**options)
    )


def write_kafka(messages: DataFrame, brokers: str, topic: str, **options) -> None:
    """Write one batch of ``key, value`` to a Kafka topic."""
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("topic", topic)
        .options(**options)
        .save()
    )
