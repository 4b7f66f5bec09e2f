"""Message keys, table and collection names, and flat JSON records."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftwork.constants import (
    ENTITY,
    ENTITY_TABLE,
    KEY_SEPARATOR,
    LINK_TABLE,
    NAME_SEPARATOR,
)
from weftwork.functions.identity import as_column


def message_key_parts(key: Column, names: list[str]) -> list[Column]:
    """The four parts of ``sequence@x@resource@task``; the first is a number or null."""
    parts = F.split(key, KEY_SEPARATOR)
    texts = [F.get(parts, F.lit(i)) for i in range(4)]
    return [texts[0].try_cast("bigint").alias(names[0])] + [
        text.alias(name) for text, name in zip(texts[1:], names[1:])
    ]


def message_key(sequence_id, middle, res_id, task_id) -> Column:
    parts = [as_column(p).cast("string") for p in (sequence_id, middle, res_id, task_id)]
    return F.concat_ws(KEY_SEPARATOR, *[F.coalesce(p, F.lit("")) for p in parts])


def table_kind(kind: Column) -> Column:
    return F.when(kind == ENTITY, F.lit(ENTITY_TABLE)).otherwise(F.lit(LINK_TABLE))


def table_name(model, kind: Column, type_id) -> Column:
    return F.concat_ws(NAME_SEPARATOR, as_column(model), table_kind(kind), as_column(type_id))


def collection_name(model, kind: Column) -> Column:
    return F.concat_ws(NAME_SEPARATOR, as_column(model), table_kind(kind), F.lit("index"))


def collection_of_table(table: Column) -> Column:
    """Collection of a table name: what precedes the first kind marker, then ``<kind>_index``."""

    def named(kind: str) -> Column:
        return F.concat(F.substring_index(table, kind + NAME_SEPARATOR, 1), F.lit(f"{kind}_index"))

    return F.when(table.contains(ENTITY_TABLE + NAME_SEPARATOR), named(ENTITY_TABLE)).when(
        table.contains(LINK_TABLE + NAME_SEPARATOR), named(LINK_TABLE)
    )


def flat_record(value: Column) -> Column:
    """A flat JSON object as ``map<string,string>``."""
    return F.from_json(value, "map<string,string>")
