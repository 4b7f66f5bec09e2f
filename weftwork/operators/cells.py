"""Elements as wide-column cells, and cells back as rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftwork.constants import ENTITY, LINK_FAMILY, PROPERTY_FAMILY, RESOURCE_QUALIFIER
from weftwork.functions import computed_once
from weftwork.functions.keys import table_name

CELL_COLUMNS = ["table_name", "row_key", "family", "qualifier", "value", "ts"]


def _cell(family: str, qualifier: str, value: str) -> Column:
    return F.struct(
        F.lit(family).alias("family"), F.lit(qualifier).alias("qualifier"), F.col(value).alias("value")
    )


def _body_cells() -> Column:
    return F.transform(
        F.map_entries("body"),
        lambda e: F.struct(
            F.lit(PROPERTY_FAMILY).alias("family"), e["key"].alias("qualifier"), e["value"]["value"].alias("value")
        ),
    )


def body_cells(elements: DataFrame, keep: tuple[str, ...] = ("row_key",)) -> DataFrame:
    """One row per property of the body."""
    bodies = computed_once(elements, list(keep), {"_body": F.col("body")})
    return bodies.select(*keep, F.explode("_body").alias("qualifier", "_p")).select(
        *keep, "qualifier", F.col("_p.value").alias("value"), F.col("_p.type").alias("type")
    )


def element_cells(elements: DataFrame, ts: Column | None = None) -> DataFrame:
    """Cells of entities and links in long form; the row id is the hashed row key."""
    common = [_cell(PROPERTY_FAMILY, RESOURCE_QUALIFIER, "res_id"), _cell(PROPERTY_FAMILY, "owner", "owner")]
    entity = F.array(
        _cell(PROPERTY_FAMILY, "entity_id", "element_id"), _cell(PROPERTY_FAMILY, "entity_type", "type_id"), *common
    )
    link = F.array(
        *[
            _cell(LINK_FAMILY, name, name)
            for name in ("from_entity_type", "from_entity_id", "to_entity_type", "to_entity_id", "direction_type")
        ],
        _cell(PROPERTY_FAMILY, "relation_type", "type_id"),
        _cell(PROPERTY_FAMILY, "relation_id", "element_id"),
        *common,
    )
    fixed = F.when(F.col("kind") == ENTITY, entity).otherwise(link)
    named = [
        table_name(F.col("model"), F.col("kind"), F.col("type_id")).alias("table_name"),
        F.col("row_hash").alias("row_key"),
        (F.current_timestamp() if ts is None else ts).alias("ts"),
    ]
    listed = computed_once(elements, named, {"_cells": F.concat(fixed, _body_cells())})
    cells = listed.select("table_name", "row_key", "ts", F.inline("_cells"))
    return cells.filter(F.col("value").isNotNull()).select(*CELL_COLUMNS)


def latest_cells(cells: DataFrame, *within: str) -> DataFrame:
    """The newest value of each (row, qualifier), or of each within the columns given; of equal times the greater value."""
    keys = ["table_name", "row_key", "family", "qualifier", *within]
    return (
        cells.groupBy(*keys)
        .agg(F.max(F.struct("ts", "value")).alias("_c"))
        .select(*keys, F.col("_c.value").alias("value"), F.col("_c.ts").alias("ts"))
    )


def scan_cells(
    cells: DataFrame,
    table: str,
    qualifiers: list[str],
    min_ts=None,
    max_ts=None,
    family: str = PROPERTY_FAMILY,
) -> DataFrame:
    """Rows of one table with one column per wanted qualifier, from cells in ``[min_ts, max_ts)``.

    The table and qualifier filters reach the scan, and the newest value of
    every qualifier comes out of a single aggregation per row.
    """
    wanted = cells.filter(
        (F.col("table_name") == table) & (F.col("family") == family) & F.col("qualifier").isin(list(qualifiers))
    )
    if min_ts is not None:
        wanted = wanted.filter(F.col("ts") >= min_ts)
    if max_ts is not None:
        wanted = wanted.filter(F.col("ts") < max_ts)
    newest = [
        F.max(F.when(F.col("qualifier") == q, F.struct("ts", "value")))["value"].alias(q)
        for q in dict.fromkeys(qualifiers)
    ]
    return wanted.groupBy("row_key").agg(*newest)
