"""Entities and links from raw records.

Two ways lead to the same element rows. `build_elements` takes mappings declared
in code and turns them into plain column expressions. `fan_out` takes records
that carry their values in a map, and a table of compiled mappings.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftwork.constants import ENTITY, LINK
from weftwork.functions import computed_once
from weftwork.functions.direction import direction_code, is_reversed
from weftwork.functions.identity import (
    all_have_text,
    as_column,
    composite_id_from,
    joined_id,
    row_hash,
    row_key,
)
from weftwork.functions.properties import (
    property_body,
    property_body_from,
    stored_type,
)
from weftwork.operators.joins import sized_join
from weftwork.plans.model import EntityType, LinkType, Mapping, Model, Property
from weftwork.plans.schemas import ELEMENT_COLUMNS, ELEMENT_FIELDS


def _element(columns: dict[str, Column]) -> list[Column]:
    """Every element column in order; absent ones are null."""
    return [columns.get(name, F.lit(None)).cast(type_).alias(name) for name, type_ in ELEMENT_FIELDS]


def _reader(frame: DataFrame):
    """Column access by name, where a column the frame lacks reads as null."""
    known = set(frame.columns)
    return lambda name: F.col(f"`{name}`") if name in known else F.lit(None).cast("string")


def _body(definition: EntityType | LinkType, mapping: Mapping, read) -> Column:
    seen: dict[str, tuple] = {}
    for p in definition.properties:
        column = mapping.columns.get(p.uuid)
        if column and p.uuid not in seen:
            seen[p.uuid] = (p.uuid, read(column), stored_type(p.type, p.analyse))
    return property_body(list(seen.values()))


@dataclass(frozen=True)
class _Plan:
    """A mapping turned into expressions, and what is the same for all its elements."""

    constants: dict[str, str | None]
    complete: Column  # the record has every id part and, for a link, both ends
    ids: dict[str, Column]
    body: Column


def _plan(model: Model, mapping: Mapping, read) -> _Plan | None:
    definition = model.find(mapping.kind, mapping.type_id)
    if definition is None:
        return None
    is_link = mapping.kind == LINK
    if is_link and not (definition.source_entity and definition.target_entity):
        return None
    id_parts = [read(c) for c in mapping.id_columns]
    complete = all_have_text(id_parts)
    ids = {"_id": joined_id(definition.uuid if is_link else definition.root, id_parts)}
    constants = {"model": model.model_id, "kind": mapping.kind, "type_id": definition.uuid}
    if is_link:
        chosen = _column_directivity(mapping, read)
        source, target = [read(c) for c in mapping.source_columns], [read(c) for c in mapping.target_columns]
        complete = complete & all_have_text(source) & all_have_text(target)
        ids["_source"] = joined_id(definition.source_root, source)
        ids["_target"] = joined_id(definition.target_root, target)
        ids["_swap"] = is_reversed(definition.directed, mapping.directivity, chosen)
        ids["_code"] = direction_code(definition.directed, mapping.directivity, chosen)
        constants |= {"_source_type": definition.source_entity, "_target_type": definition.target_entity}
    return _Plan(constants, complete, ids, _body(definition, mapping, read))


def _column_directivity(mapping: Mapping, read) -> Column:
    if not mapping.direction_column or not mapping.direction_values:
        return F.lit(None).cast("string")
    pairs = [F.lit(x) for item in mapping.direction_values.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), read(mapping.direction_column).cast("string"))


def _ends(swap: Column, source_type: Column, source_id: Column, target_type: Column, target_id: Column) -> dict:
    """Types and ids swap together."""
    return {
        "from_entity_type": F.when(swap, target_type).otherwise(source_type),
        "from_entity_id": F.when(swap, target_id).otherwise(source_id),
        "to_entity_type": F.when(swap, source_type).otherwise(target_type),
        "to_entity_id": F.when(swap, source_id).otherwise(target_id),
    }


def build_elements(
    frame: DataFrame,
    model: Model,
    mappings: list[Mapping],
    res_id="resId",
    owner="owner",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Elements of all mappings of ``frame``, in one pass over it.

    ``res_id`` and ``owner`` are column names, or columns such as a literal
    resource id. ``keep`` names record columns to carry along. Records that
    lack an id part or a link end give nothing.
    """
    return build_mapped(frame, [(model, m) for m in mappings], res_id, owner, keep)


def build_mapped(
    frame: DataFrame, mapped: list[tuple[Model, Mapping]], res_id="resId", owner="owner", keep: tuple[str, ...] = ()
) -> DataFrame:
    """As `build_elements`, where each mapping comes with its model."""
    read = _reader(frame)
    res_id = read(res_id) if isinstance(res_id, str) else res_id
    owner = read(owner) if isinstance(owner, str) else owner
    built = [_plan(model, mapping, read) for model, mapping in mapped]
    plans = [p for p in built if p is not None]
    if not plans:
        return frame.select(*keep, *_element({})).filter(F.lit(False))
    return _one_pass(frame, plans, F.array(*[F.lit(i) for i in range(len(plans))]), res_id, owner, keep)


def _one_pass(frame: DataFrame, plans: list[_Plan], tags: Column, res_id, owner, keep: tuple[str, ...]) -> DataFrame:
    """Each record once for each of its ``tags``, the numbers of plans, and the element of that plan.

    A record is repeated before its elements are built, so the generated code evaluates for each row the expressions
    of its own plan only. Constants come from lists, which keeps that code short enough to be compiled.
    """
    one = len(plans) == 1

    def own(values: list[Column | None]) -> Column:
        if one:
            return values[0]
        chosen = None
        for i, value in enumerate(values):
            if value is not None:
                chosen = (F if chosen is None else chosen).when(F.col("_tag") == i, value)
        return chosen

    def constant(name: str) -> Column:
        values = [F.lit(p.constants.get(name)).cast("string") for p in plans]
        return values[0] if one or len({p.constants.get(name) for p in plans}) == 1 else F.get(F.array(*values), F.col("_tag"))

    tagged = frame if one else frame.withColumn("_tag", F.explode(tags))
    names = list(dict.fromkeys(n for p in plans for n in p.ids))
    identified = tagged.filter(own([p.complete for p in plans])).withColumns({n: own([p.ids.get(n) for p in plans]) for n in names})
    keyed = identified.withColumn("_key", row_key(res_id, F.col("_id")))
    columns = {n: constant(n) for n in ("model", "kind", "type_id")} | {
        "row_key": F.col("_key"),
        "row_hash": row_hash(F.col("_key")),
        "element_id": F.col("_id"),
        "res_id": as_column(res_id),
        "owner": F.coalesce(as_column(owner).cast("string"), F.lit("")),
        "body": own([p.body for p in plans]),
    }
    if "_swap" in names:
        columns["direction_type"] = F.col("_code")
        columns |= _ends(F.col("_swap"), constant("_source_type"), F.col("_source"), constant("_target_type"), F.col("_target"))
    return keyed.select(*keep, *_element(columns))


RECORD_KEYS = ("sequence_id", "data_schema_id", "res_id", "task_id")
MAX_WRITTEN_OUT = 64  # mappings that are written out as expressions; both ways go over the records once
MAX_READ_AHEAD = 32  # values of a record that get a column of their own; others are read where they are used


def fan_out(
    frame: DataFrame,
    compiled_mappings: DataFrame,
    values: str = "value",
    res_id: str = "resId",
    owner: str = "owner",
    keep: tuple[str, ...] = RECORD_KEYS,
    max_written_out: int = MAX_WRITTEN_OUT,
) -> DataFrame:
    """Each record times all mappings of its ``data_schema_id``.

    ``values`` is a ``map<string,string>`` column; the resource and owner of an
    element are read from it. Columns in ``keep`` come out prefixed ``record_``.

    Up to ``max_written_out`` mappings are written out as expressions, more, or
    those of a stream, are joined as a table. Either way the records are read
    once, and only those of the schemas that have mappings.
    """
    if not frame.isStreaming:
        rows = compiled_mappings.limit(max_written_out + 1).collect()
        if 0 < len(rows) <= max_written_out:
            return _written_out(frame, rows, values, res_id, owner, keep)
    return _joined_out(frame, compiled_mappings, values, res_id, owner, keep)


def declared(row) -> tuple[Model, Mapping]:
    """A row of compiled mappings as a model of its one element, and the mapping."""
    # the types are refined already, which the analysed flag leaves as they are
    properties = tuple(Property(f["uuid"], f["type"], True) for f in row["fields"])
    if row["kind"] == ENTITY:
        model = Model(row["model"], (EntityType(row["type_id"], row["root"], properties),))
    else:
        link = LinkType(
            row["type_id"],
            row["source_entity"],
            row["target_entity"],
            row["source_root"],
            row["target_root"],
            row["directed"],
            properties,
        )
        model = Model(row["model"], (), (link,))
    mapping = Mapping(
        row["data_schema_id"],
        row["model"],
        row["kind"],
        row["type_id"],
        {f["uuid"]: f["column"] for f in row["fields"]},
        tuple(row["id_columns"] or ()),
        tuple(row["source_columns"] or ()),
        tuple(row["target_columns"] or ()),
        row["directivity"],
        row["direction_column"],
        dict(row["direction_values"] or {}),
    )
    return model, mapping


def _written_out(frame: DataFrame, rows: list, values: str, res_id: str, owner: str, keep) -> DataFrame:
    """The elements of a list of compiled mappings."""

    # values that mappings name are read out of the map once for each record, not in every expression of every element
    ahead: dict[str, str] = {}

    def read(name: str) -> Column:
        if name not in ahead and len(ahead) < MAX_READ_AHEAD:
            ahead[name] = f"_v{len(ahead)}"
        return F.col(ahead[name]) if name in ahead else F.try_element_at("_v", F.lit(name))

    carried = tuple(f"record_{c}" for c in keep)
    built = [(row["data_schema_id"], _plan(*declared(row), read)) for row in rows]
    built = [(schema, plan) for schema, plan in built if plan is not None]
    by_schema: dict[str, list[int]] = {}
    for i, (schema, _) in enumerate(built):
        by_schema.setdefault(schema, []).append(i)
    resource, owned_by = read(res_id), read(owner)
    wanted = frame.filter(F.col("data_schema_id").isin(list(by_schema)))
    schema_of = F.col("data_schema_id").alias("_schema")
    record = computed_once(wanted, [schema_of, *[F.col(c).alias(f"record_{c}") for c in keep]], {"_v": F.col(values)})
    named = [F.try_element_at("_v", F.lit(name)).alias(column) for name, column in ahead.items()]
    record = record.select("_schema", *carried, "_v", *named)
    if not built:
        return record.select(*carried, *_element({})).filter(F.lit(False))
    tags = F.lit(None)
    for schema, own in by_schema.items():
        tags = F.when(F.col("_schema") == schema, F.array(*[F.lit(i) for i in own])).otherwise(tags)
    return _one_pass(record, [plan for _, plan in built], tags, resource, owned_by, carried)


def _joined_out(
    frame: DataFrame, compiled_mappings: DataFrame, values: str, res_id: str, owner: str, keep: tuple[str, ...]
) -> DataFrame:
    """The elements of a table of compiled mappings."""
    record = frame.select(
        F.col("data_schema_id"),
        F.col(values).alias("_v"),
        *[F.col(c).alias(f"record_{c}") for c in keep],
    )
    joined = sized_join(record, compiled_mappings, ["data_schema_id"])
    v = F.col("_v")
    is_link = F.col("kind") == LINK
    chosen = F.try_element_at("direction_values", F.try_element_at(v, F.col("direction_column")))
    carried = [f"record_{c}" for c in keep]
    identified = joined.select(
        *carried,
        "_v",
        "model",
        "kind",
        "type_id",
        "fields",
        "source_entity",
        "target_entity",
        composite_id_from(F.col("root"), F.col("id_columns"), v).alias("_id"),
        F.when(is_link, composite_id_from(F.col("source_root"), F.col("source_columns"), v)).alias("_source"),
        F.when(is_link, composite_id_from(F.col("target_root"), F.col("target_columns"), v)).alias("_target"),
        is_reversed(F.col("directed"), F.col("directivity"), chosen).alias("_swap"),
        F.when(is_link, direction_code(F.col("directed"), F.col("directivity"), chosen)).alias("_code"),
        F.try_element_at(v, F.lit(res_id)).alias("_resource"),
        F.coalesce(F.try_element_at(v, F.lit(owner)), F.lit("")).alias("_owner"),
    )
    has_ends = F.col("_source").isNotNull() & F.col("_target").isNotNull()
    complete = identified.filter(F.col("_id").isNotNull() & (~is_link | has_ends))
    keyed = complete.withColumn("_key", row_key(F.col("_resource"), F.col("_id")))
    ends = _ends(
        F.col("_swap"), F.col("source_entity"), F.col("_source"), F.col("target_entity"), F.col("_target")
    )
    columns = {
        "model": F.col("model"),
        "kind": F.col("kind"),
        "type_id": F.col("type_id"),
        "row_key": F.col("_key"),
        "row_hash": row_hash(F.col("_key")),
        "element_id": F.col("_id"),
        "direction_type": F.col("_code"),
        "res_id": F.col("_resource"),
        "owner": F.col("_owner"),
        "body": property_body_from(F.col("fields"), v),
    } | ends
    return keyed.select(*carried, *_element(columns))


def entities(elements: DataFrame) -> DataFrame:
    """Entity view of element rows."""
    return elements.filter(F.col("kind") == ENTITY).select(
        "row_key", "row_hash", F.col("element_id").alias("entity_id"), F.col("type_id").alias("entity_type"),
        "model", "res_id", "owner", "body",
    )


def links(elements: DataFrame) -> DataFrame:
    """Link view of element rows."""
    return elements.filter(F.col("kind") == LINK).select(
        "row_key", "row_hash", F.col("element_id").alias("relation_id"), F.col("type_id").alias("relation_type"),
        "direction_type", "from_entity_id", "from_entity_type", "to_entity_id", "to_entity_type",
        "model", "res_id", "owner", "body",
    )


def unmapped_schemas(frame: DataFrame, mappings: DataFrame) -> DataFrame:
    """The data schema ids of records that no mapping covers, each once."""
    present = frame.select("data_schema_id").distinct()
    return sized_join(present, mappings.select("data_schema_id").distinct(), ["data_schema_id"], "left_anti")


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union by name; a column missing on one side is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def canonical(elements: DataFrame) -> DataFrame:
    return elements.select(*ELEMENT_COLUMNS)
