"""What a task works on: changed types, the change cursor, and the mappings in effect."""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftwork.operators.joins import sized_join

TYPE_KEYS = ["model", "kind", "type_id"]
FULL, SUB, SPECIAL = "FULL", "SUB", "SPE"


def complete_requests(request: DataFrame) -> DataFrame:
    """Entries that name a type, a data schema and an update id."""
    return request.dropna(subset=["type_id", "data_schema_id", "update_id"])


def changed_types(request: DataFrame, stored: DataFrame) -> DataFrame:
    """Complete requests for types known at the last run whose update id is later, compared as text."""
    known = stored.select(*TYPE_KEYS, F.col("update_id").alias("_known"))
    joined = sized_join(complete_requests(request), known, TYPE_KEYS)
    return joined.filter(F.col("update_id") > F.col("_known")).drop("_known")


def upsert_cursor(stored: DataFrame, new: DataFrame) -> DataFrame:
    """The cursor after a run: the models of ``new`` replaced or added, the others kept."""
    kept = sized_join(stored, new.select("model").distinct(), ["model"], "left_anti")
    return kept.unionByName(new)


def cursor_of(stored: DataFrame, model: str) -> DataFrame:
    return stored.filter(F.col("model") == model)


def has_cursor(stored: DataFrame, model: str) -> bool:
    return not cursor_of(stored, model).isEmpty()


@dataclass(frozen=True)
class ChangePlan:
    changed: DataFrame  # types to leave out of the replay
    load_cursor: DataFrame  # cursor of the streaming load after this run
    transform_cursor: DataFrame  # cursor of the batch transform after this run


def plan_changes(
    request: DataFrame, load_cursor: DataFrame, transform_cursor: DataFrame, sequence_id: int | None = None
) -> ChangePlan:
    """Compare a request with the stored cursor, model by model.

    A model seen for the first time has no changed types, and its whole request
    becomes both cursors. For a known model the batch cursor gets the changed
    entries only.
    """
    if not request.filter(F.col("type_id").isNull()).isEmpty():
        raise ValueError("a change request names no element type")
    if sequence_id is not None:
        request = request.withColumn("seq_id", F.lit(sequence_id).cast("bigint"))
    changed = changed_types(request, load_cursor)
    first = sized_join(request, load_cursor.select("model").distinct(), ["model"], "left_anti")
    return ChangePlan(
        changed=changed,
        load_cursor=upsert_cursor(load_cursor, request),
        transform_cursor=upsert_cursor(transform_cursor, changed.unionByName(first)),
    )


def effective_schemas(cursor: DataFrame) -> DataFrame:
    return cursor.select("data_schema_id").distinct()


def effective_mappings(mappings: DataFrame, cursor: DataFrame) -> DataFrame:
    """Mappings of the schemas and of the types that the cursor names."""
    named = cursor.select("kind", "type_id").distinct()
    in_schema = sized_join(mappings, effective_schemas(cursor), ["data_schema_id"], "left_semi")
    return sized_join(in_schema, named, ["kind", "type_id"], "left_semi")


def task_scope(
    mode: str,
    mappings: DataFrame,
    schemas: DataFrame | None = None,
    cursor: DataFrame | None = None,
    special_schema: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(data schema ids, mappings)`` of a task.

    FULL takes every schema found, SUB those of the cursor, SPE a single one.
    """
    if mode == FULL:
        return schemas.select("data_schema_id").distinct(), mappings
    if mode == SUB:
        return effective_schemas(cursor), effective_mappings(mappings, cursor)
    if mode == SPECIAL:
        one = mappings.filter(F.col("data_schema_id") == special_schema)
        return one.select("data_schema_id").distinct(), one
    raise ValueError(f"unknown task mode {mode}; use {FULL}, {SUB} or {SPECIAL}")
