"""Dossiers: one document per key, with fields gathered from many tables.

Until the last step everything is in long form, ``doc_key, field, value,
copies``: equal values are one row with a count. So a key with a third of all
values is spread like any other data. `documents` turns the rows into field
maps; the values of a large key make several parts of bounded size.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftwork.constants import (
    CONSTANT_TAGS,
    DOC_KEY_SEPARATOR,
    ENTITY,
    ENTITY_TABLE,
    LINK,
    LINK_TABLE,
    NAME_SEPARATOR,
    RESOURCE_QUALIFIER,
)
from weftwork.functions.properties import property_value
from weftwork.operators.cells import scan_cells
from weftwork.operators.dedup import dedup_by_key
from weftwork.operators.elements import union_all
from weftwork.operators.joins import adaptive_join
from weftwork.operators.selection import exclude_resources, with_key
from weftwork.plans.rules import DossierRule, Extension, Related

VALUE_COLUMNS = ["doc_key", "field", "value", "copies"]
PART_SIZE = 100_000  # values in one part of a document

# (kind, element type, properties) -> frame with ``resid`` and the properties as columns
Reader = Callable[[str, str, list[str]], DataFrame]


def cell_reader(cells: DataFrame, model: str, min_ts=None, max_ts=None) -> Reader:
    """Read element tables from wide-column cells written in ``[min_ts, max_ts)``."""

    def read(kind: str, type_id: str, properties: list[str]) -> DataFrame:
        names = list(dict.fromkeys([RESOURCE_QUALIFIER, *properties]))
        marker = ENTITY_TABLE if kind == ENTITY else LINK_TABLE
        return scan_cells(cells, NAME_SEPARATOR.join((model, marker, type_id)), names, min_ts, max_ts)

    return read


def element_reader(elements: DataFrame) -> Reader:
    """Read element tables from element rows."""

    def read(kind: str, type_id: str, properties: list[str]) -> DataFrame:
        rows = elements.filter((F.col("kind") == kind) & (F.col("type_id") == type_id))
        return rows.select(
            F.col("res_id").alias(RESOURCE_QUALIFIER),
            *[property_value(F.col("body"), p).alias(p) for p in dict.fromkeys(properties)],
        )

    return read


def table_reader(tables: dict[tuple[str, str], DataFrame]) -> Reader:
    """Read element tables that are frames already; values become text."""

    def read(kind: str, type_id: str, properties: list[str]) -> DataFrame:
        frame = tables[kind, type_id]
        return frame.select(
            F.col(RESOURCE_QUALIFIER), *[F.col(p).cast("string").alias(p) for p in dict.fromkeys(properties)]
        )

    return read


def excluding(read: Reader, resources: DataFrame) -> Reader:
    """A reader without the rows of listed resources."""
    return lambda kind, type_id, properties: exclude_resources(read(kind, type_id, properties), resources)


def root_rows(read: Reader, rule: DossierRule) -> DataFrame:
    """One row per dossier key with the root properties."""
    properties = list(dict.fromkeys(p for p, _ in rule.root_fields))
    rows = with_key(read(ENTITY, rule.root_type, [rule.key, *properties]), rule.key)
    keyed = rows.select(F.col(rule.key).alias("doc_key"), *[F.col(p).alias(f"p_{p}") for p in properties])
    return dedup_by_key(keyed, ["doc_key"])


def root_values(roots: DataFrame, rule: DossierRule) -> DataFrame:
    entries = [
        F.struct(F.lit(target).alias("field"), F.col(f"p_{source}").alias("value"))
        for source, target in rule.root_fields
    ]
    if not entries:
        return _values(roots.select("doc_key", F.lit(None).cast("string").alias("field"),
                                    F.lit(None).cast("string").alias("value")))
    return _values(roots.select("doc_key", F.inline(F.array(*entries))))


def _values(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("value").isNotNull()).withColumn("copies", F.lit(1).cast("bigint"))


def combined(values: DataFrame) -> DataFrame:
    """Equal values of a field as one row, counted; this runs before the shuffle as well."""
    return values.groupBy("doc_key", "field", "value").agg(F.sum("copies").alias("copies"))


def gather(read: Reader, kind: str, fields: tuple[Related, ...]) -> DataFrame | None:
    """Values of related elements under their dossier field, each table read once.

    Rows with an empty key are left out.
    """
    frames = []
    for type_id in dict.fromkeys(f.type_id for f in fields):
        own = [f for f in fields if f.type_id == type_id]
        rows = read(kind, type_id, [p for f in own for p in (f.key, f.value)])
        entries = [
            F.struct(F.col(f.key).alias("doc_key"), F.lit(f.field).alias("field"), F.col(f.value).alias("value"))
            for f in own
        ]
        frames.append(_values(with_key(rows.select(F.inline(F.array(*entries))), "doc_key")))
    return union_all(frames) if frames else None


def two_hop(read: Reader, extension: Extension) -> DataFrame:
    """Key → relation → value → elements with that value → what they hold, all under the key.

    The first-hop value is a field itself, once per relation row. Both sides
    are counted per distinct value first, so copies are multiplied as numbers
    and never joined row by row. Every key that shares a value gets its fields.
    """
    first = extension.first
    relation = with_key(read(LINK, first.type_id, [first.key, first.value]), first.key)
    hops = combined(
        _values(
            relation.select(
                F.col(first.key).alias("doc_key"), F.lit(first.field).alias("field"), F.col(first.value).alias("value")
            )
        )
    )
    held = gather(read, ENTITY, extension.second)
    if held is None:
        return hops
    found = combined(held).select(
        F.col("doc_key").alias("hop"), "field", "value", F.col("copies").alias("held")
    )
    # a value may hold many others, so the rows are spread over all tasks first: each then combines its share of what is reached
    tasks = int(hops.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = hops.select("doc_key", F.col("value").alias("hop"), "copies").repartition(tasks, "doc_key", "hop")
    reached = adaptive_join(left, found, ["hop"]).select(
        "doc_key", "field", "value", (F.col("copies") * F.col("held")).alias("copies")
    )
    return hops.unionByName(reached)


def join_properties(root: DataFrame, other: DataFrame) -> DataFrame:
    """Left outer join that concatenates properties: the root's values, and the others' of the same keys.

    As a semi join it repeats nothing.
    """
    keys = root.select("doc_key").distinct()
    return root.unionByName(adaptive_join(other, keys, ["doc_key"], "left_semi"))


def tagged(values: DataFrame, doc_type: str, tags: dict | None = None) -> DataFrame:
    """Some fields of some document types only say that a value exists: one constant, once."""
    for name, constant in (CONSTANT_TAGS if tags is None else tags).get(doc_type, {}).items():
        replaced = (F.col("field") == name) & (F.col("value") != "")
        values = values.withColumns(
            {
                "value": F.when(replaced, F.lit(constant)).otherwise(F.col("value")),
                "copies": F.when(replaced, F.lit(0).cast("bigint")).otherwise(F.col("copies")),
            }
        )
    return combined(values).withColumn("copies", F.greatest("copies", F.lit(1).cast("bigint")))


def dossier_values(read: Reader, rule: DossierRule) -> tuple[DataFrame, DataFrame]:
    """``(root keys, values)`` of a rule, the values of unknown keys possibly among them."""
    roots = root_rows(read, rule)
    related = [
        gather(read, ENTITY, rule.entity_fields),
        gather(read, LINK, rule.relation_fields),
        *[two_hop(read, e) for e in rule.extensions],
    ]
    related = [r for r in related if r is not None]
    values = root_values(roots, rule)
    return roots.select("doc_key"), union_all([values, *related])


def documents(
    keys: DataFrame, values: DataFrame, doc_type: str, part_size: int = PART_SIZE, collection: str | None = None
) -> DataFrame:
    """``id, collection, doc_id, doc_type, doc_key, part, fields``: the values of each key as ``map<field, array>``.

    ``id`` names the row: it is the ``doc_id`` for the first part, and has the number of the part added for others, so
    a store that replaces by id keeps all parts. Without a ``collection`` they go to one named after the type.

    Keys missing in ``keys`` give nothing, and a key without values gives an
    empty document. A key with more than ``part_size`` values gets several
    parts; a value repeated more often than that is itself cut, so no group
    grows beyond a few parts' worth.
    """
    counted = tagged(values, doc_type)
    nothing = F.lit(None).cast("string")
    roots = keys.select(
        "doc_key", nothing.alias("field"), nothing.alias("value"), F.lit(0).cast("bigint").alias("copies")
    )
    rows = counted.filter(F.col("field").isNotNull()).unionByName(roots)
    totals = rows.groupBy("doc_key").agg(
        F.sum("copies").alias("total"), F.bool_or(F.col("field").isNull()).alias("large_root")
    )
    large = totals.filter(F.col("total") > part_size).select(
        "doc_key", "large_root", F.ceil(F.col("total") / part_size).cast("int").alias("parts")
    )
    # adaptive execution broadcasts the large keys when they are few, and else splits the rows of a hot key
    slices = F.ceil(F.col("copies") / part_size).cast("int")
    placed = (
        adaptive_join(rows, large, ["doc_key"], "left")
        .withColumn("parts", F.coalesce("parts", F.lit(1)))
        .filter(F.col("field").isNotNull() | (F.col("parts") == 1))
        .select(
            "doc_key",
            "parts",
            "field",
            "value",
            "copies",
            (F.col("field").isNull() | F.coalesce("large_root", F.lit(False))).alias("is_root"),
            F.explode(F.sequence(F.lit(0), F.greatest(slices, F.lit(1)) - 1)).alias("slice"),
        )
    )
    part = F.when(F.col("parts") > 1, F.pmod(F.xxhash64("field", "value", "slice"), F.col("parts"))).otherwise(0)
    repeats = F.least(F.col("copies") - F.col("slice") * part_size, F.lit(part_size))
    sized = placed.select(
        "doc_key",
        part.cast("int").alias("part"),
        "field",
        "is_root",
        F.array_repeat("value", repeats.cast("int")).alias("values"),
    ).repartition("doc_key", "part")
    per_field = sized.groupBy("doc_key", "part", "field").agg(
        F.array_sort(F.flatten(F.collect_list("values"))).alias("values"), F.bool_or("is_root").alias("is_root")
    )
    entry = F.when(F.col("field").isNotNull(), F.struct("field", "values"))
    assembled = per_field.groupBy("doc_key", "part").agg(
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("fields"), F.bool_or("is_root").alias("is_root")
    )
    doc_id = F.concat(F.lit(doc_type + DOC_KEY_SEPARATOR), F.col("doc_key"))
    part_id = F.when(F.col("part") > 0, F.concat(doc_id, F.lit(DOC_KEY_SEPARATOR), F.col("part").cast("string")))
    return assembled.filter("is_root").select(
        F.coalesce(part_id, doc_id).alias("id"),
        F.lit(collection or doc_type.lower()).alias("collection"),
        doc_id.alias("doc_id"),
        F.lit(doc_type).alias("doc_type"),
        "doc_key",
        "part",
        "fields",
    )


def build_dossiers(
    read: Reader, rule: DossierRule, resources: DataFrame | None = None, part_size: int = PART_SIZE
) -> DataFrame:
    """The documents of one rule, without the rows of the listed resources."""
    source = read if resources is None else excluding(read, resources)
    keys, values = dossier_values(source, rule)
    return documents(keys, values, rule.doc_type, part_size, rule.collection)


def field_values(docs: DataFrame) -> DataFrame:
    """Documents as one row per field."""
    return docs.select("doc_id", "part", F.explode("fields").alias("field", "values"))
