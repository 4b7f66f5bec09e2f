"""Property bodies: ``map<property uuid, struct<value, type>>``."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftwork.constants import STRING, TEXT
from weftwork.functions.identity import as_column

BODY_TYPE = "map<string,struct<value:string,type:string>>"


def stored_type(property_type, analyse) -> Column:
    """Text that is not analysed is stored as a plain string."""
    declared = as_column(property_type)
    return F.when((declared == TEXT) & ~as_column(analyse), F.lit(STRING)).otherwise(declared)


def property_body(typed_values: list[tuple[str, Column, Column]]) -> Column:
    """Body from ``(uuid, value, type)`` triples known when the plan is built; null values are left out."""
    if not typed_values:
        return F.create_map().cast(BODY_TYPE)
    nothing = F.create_map().cast(BODY_TYPE)
    cells = []
    for uuid, value, type_ in typed_values:
        cell = F.create_map(F.lit(uuid), F.struct(value.cast("string").alias("value"), type_.alias("type")))
        cells.append(F.when(value.isNotNull(), cell.cast(BODY_TYPE)).otherwise(nothing))
    # no lambda here: a higher-order function would end whole-stage code generation
    return cells[0] if len(cells) == 1 else F.map_concat(*cells)


def property_body_from(properties: Column, values: Column) -> Column:
    """Body where the properties are an ``array<struct<uuid,type,column>>`` column and the values a map."""
    entries = F.transform(
        properties,
        lambda p: F.struct(
            p["uuid"].alias("key"),
            F.struct(
                F.try_element_at(values, p["column"]).alias("value"),
                p["type"].alias("type"),
            ).alias("value"),
        ),
    )
    present = F.filter(entries, lambda e: e["value"]["value"].isNotNull())
    return F.map_from_entries(present).cast(BODY_TYPE)


def property_value(body: Column, uuid: str) -> Column:
    return F.try_element_at(body, F.lit(uuid))["value"]


def body_entries(body: Column) -> Column:
    """The body as an ordered array, so that it can be compared, grouped or aggregated."""
    return F.array_sort(F.map_entries(body))
