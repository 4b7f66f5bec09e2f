"""Entities and links from records that list identifiers seen together."""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftwork.constants import (
    CODE_ONE_WAY,
    ENTITY,
    ENTITY_TABLE,
    ID_SEPARATOR,
    IDENTIFIER_TYPES,
    KEY_SEPARATOR,
    LINK,
    LINK_TABLE,
    MAC_SEPARATOR,
    MAC_TYPE,
    NAME_SEPARATOR,
)
from weftwork.functions import computed_once
from weftwork.functions.identity import has_text, row_key
from weftwork.functions.keys import collection_name

MEMBERS = "array<struct<id_type:string,id:string>>"
_MEMBER_BYTES = 20  # no member of a JSON line is shorter
BLOCK = 128  # members paired inside one row; longer arrays are cut into blocks


@dataclass(frozen=True)
class IdentifierEntity:
    """The entity type of an identifier type."""

    id_type: str
    model: str
    type_id: str
    root: str


@dataclass(frozen=True)
class PairLink:
    """The link type between two identifier types, found in either order."""

    first: str
    second: str
    model: str
    type_id: str
    source_entity: str
    target_entity: str


def parse_identifiers(
    lines: DataFrame, types: tuple[str, ...] = IDENTIFIER_TYPES, column: str = "value"
) -> DataFrame:
    """JSON array lines as ``members``: allowed types with an id, mac ids without colons, no empty arrays."""
    parsed = F.from_json(F.col(column), MEMBERS)
    allowed = F.filter(parsed, lambda m: _one_of(m["id_type"], types) & m["id"].isNotNull())

    def clean(m: Column) -> Column:
        bare = F.struct(m["id_type"].alias("id_type"), F.replace(m["id"], F.lit(MAC_SEPARATOR), F.lit("")).alias("id"))
        return F.when(m["id_type"] == MAC_TYPE, bare).otherwise(m)  # others are handed on, not built again

    cleaned = F.transform(allowed, clean)
    others = [c for c in lines.columns if c != column]
    parsed = computed_once(lines, [*others, F.octet_length(column).alias("line_bytes")], {"members": cleaned})
    return parsed.filter(F.size("members") > 0)


def _one_of(column: Column, values: tuple[str, ...]) -> Column:
    """``isin`` as plain comparisons: a lambda evaluates them without the exception that ends its search."""
    return reduce(lambda x, y: x | y, [column == v for v in values], F.lit(False))


def identifier_entities(records: DataFrame, types: list[IdentifierEntity], res_id: str) -> DataFrame:
    """An entity document for each member whose type is mapped; copies are kept."""
    member = F.explode("members").alias("m")

    def constants(t: IdentifierEntity) -> Column:
        root = f"{t.root}{ID_SEPARATOR}" if t.root else ""  # what `composite_id` puts before a single part
        collection, key = collection_name(F.lit(t.model), F.lit(ENTITY)), row_key(res_id, F.lit(root))
        return F.struct(F.lit(t.type_id).alias("type_id"), F.lit(root).alias("root"), collection.alias("collection"), key.alias("key"))

    by_type = _lookup({t.id_type: t for t in types}, constants)
    found = records.select(member).filter(has_text(F.col("m.id")))
    found = found.select(F.col("m.id").alias("part"), F.try_element_at(by_type, F.col("m.id_type")).alias("t"))
    return found.filter(F.col("t").isNotNull()).select(
        F.concat("t.key", "part").alias("id"),
        F.col("t.collection").alias("collection"),
        F.concat("t.root", "part").alias("entity_id"),
        F.col("t.type_id").alias("entity_type"),
        F.lit(res_id).alias("resid"),
    )


def _fields(**values: str) -> Column:
    return F.struct(*[F.lit(v).alias(k) for k, v in values.items()])


def one_collection(declared: list[IdentifierEntity] | list[PairLink], kind: str) -> str | None:
    """The collection of the documents where all types have one model."""
    models = {d.model for d in declared}
    if len(models) != 1 or None in models:
        return None
    return NAME_SEPARATOR.join([models.pop(), ENTITY_TABLE if kind == ENTITY else LINK_TABLE, "index"])


def _lookup(entries: dict, value) -> Column:
    return F.create_map(*[c for key, entry in entries.items() for c in (F.lit(key), value(entry))])


def _linked_types(links: list[PairLink]) -> list[str]:
    return sorted({t for link in links for t in (link.first, link.second)})


def _type_code(id_type: Column, types: list[str]) -> Column:
    """The place of a type among the linked ones; null for others."""
    return reduce(lambda found, n: found.when(id_type == types[n], F.lit(n)), range(1, len(types)), F.when(id_type == types[0], F.lit(0)))


def _link_number(links: list[PairLink], first: Column, second: Column) -> Column:
    """Number of the link by the codes of two types; a pair declared as written wins over the same pair reversed."""
    ordered = {(link.second, link.first): i for i, link in reversed(list(enumerate(links)))}
    ordered |= {(link.first, link.second): i for i, link in reversed(list(enumerate(links)))}
    types = _linked_types(links)
    numbers = F.array(*[F.lit(ordered.get((x, y))).cast("int") for x in types for y in types])
    return F.get(numbers, first * len(types) + second)


def _link(links: list[PairLink]) -> Column:
    """The link type of a numbered pair."""
    types = [_fields(model=t.model, type_id=t.type_id, source=t.source_entity, target=t.target_entity) for t in links]
    return F.get(F.array(*types), F.col("number"))


def _paired(blocks: DataFrame, links: list[PairLink]) -> DataFrame:
    """Mapped pairs of a ``left`` and a ``right`` block; within the ``same`` block a member pairs with later ones only."""
    types = _linked_types(links)

    def useful(member: str) -> Column:
        return _type_code(F.col(f"{member}.id_type"), types).isNotNull() & has_text(F.col(f"{member}.id"))

    first = blocks.select("right", "same", F.posexplode("left").alias("i", "a")).filter(useful("a"))
    coded = first.select("right", "same", "i", "a", _type_code(F.col("a.id_type"), types).alias("code"))
    both = coded.select("same", "i", "a", "code", F.posexplode("right").alias("j", "b"))
    later = both.filter((~F.col("same") | (F.col("j") > F.col("i"))) & useful("b"))
    number = _link_number(links, F.col("code"), _type_code(F.col("b.id_type"), types))
    return later.select("a", "b", number.alias("number")).filter(F.col("number").isNotNull())


def mapped_pairs(records: DataFrame, links: list[PairLink], block: int = BLOCK) -> DataFrame:
    """``a, b, link`` for every two members in array order whose types are linked.

    Members of types without a link, or without an id, go before anything is
    paired. An array of more than ``block`` members becomes one row
    per block, with the members from there on. Those rows are spread over the
    cluster before they are cut, so no task pairs a long array alone. Where
    `parse_identifiers` left the length of the line, lines too short for so
    many members are passed over unparsed when long arrays are looked for.
    """
    return _numbered_pairs(records, links, block).select("a", "b", _link(links).alias("link"))


def _numbered_pairs(records: DataFrame, links: list[PairLink], block: int) -> DataFrame:
    """`mapped_pairs` with the number of the link in its place."""
    types = _linked_types(links)
    members = F.col("members")
    short = records.filter(F.size(members).between(2, block)).select(
        members.alias("left"), members.alias("right"), F.lit(True).alias("same")
    )
    long = records.filter(F.size(members) > block)
    if "line_bytes" in records.columns:
        long = long.filter(F.col("line_bytes") > block * _MEMBER_BYTES)
    linked = F.filter("members", lambda m: m["id_type"].isin(types) & has_text(m["id"]))
    long = computed_once(long, [], {"members": linked}).filter(F.size(members) > 1)
    # the reading task is part of the key, so copies of one array spread too
    starts = F.sequence(F.lit(1), F.size(members), F.lit(block))
    begun = long.select(F.spark_partition_id().alias("task"), F.xxhash64(members).alias("array"), members, F.explode(starts).alias("start"))
    rest = begun.select("task", "array", "start", F.slice(members, F.col("start"), F.size(members)).alias("rest"))
    dealt = rest.repartition("task", "array", "start")
    rights = F.transform(F.sequence(F.lit(1), F.size("rest"), F.lit(block)), lambda k: F.slice("rest", k, block))
    crossed = dealt.select(F.slice("rest", 1, block).alias("left"), F.posexplode(rights).alias("j", "right"))
    spread = crossed.select("left", "right", (F.col("j") == 0).alias("same"))
    return _paired(short, links).unionByName(_paired(spread, links))


def _distinct_pairs(pairs: DataFrame, links: list[PairLink]) -> DataFrame:
    """One pair for each link document that differs.

    Two pairs make one document only if their links say the same, and they are equal or list the same two members of
    different types in either order; that order tells nothing where the ids are equal, or where both ends are of one entity type.
    """
    said = [(t.model, t.type_id, t.source_entity, t.target_entity) for t in links]
    first = F.get(F.array(*[F.lit(said.index(t)) for t in said]), F.col("number"))
    alike = F.get(F.array(*[F.lit(t.source_entity == t.target_entity) for t in links]), F.col("number"))
    a, b = F.col("a"), F.col("b")
    turned = (a["id_type"] > b["id_type"]) & ((a["id"] == b["id"]) | alike)
    ends = {"a_type": (a, b, "id_type"), "a_id": (a, b, "id"), "b_type": (b, a, "id_type"), "b_id": (b, a, "id")}
    keyed = pairs.select(first.alias("number"), *[F.when(turned, y[f]).otherwise(x[f]).alias(n) for n, (x, y, f) in ends.items()])

    def member(end: str) -> Column:
        return F.struct(F.col(f"{end}_type").alias("id_type"), F.col(f"{end}_id").alias("id")).alias(end)

    return keyed.distinct().select("number", member("a"), member("b"))


def pair_links(
    records: DataFrame,
    links: list[PairLink],
    res_id: str,
    block: int = BLOCK,
    copies: bool = True,
    more: dict[str, Column] | None = None,
) -> DataFrame:
    """A link document for each mapped pair; copies are kept, or each document comes once.

    Without ``copies`` the pairs are made distinct before documents are built, so types and ids are shuffled only.

    The greater id, compared as text, comes first in the label and is the from
    end. The end types follow: the first member stands for the source entity.
    Both ids are kept as fields named after the link and the identifier type;
    of two ids of one type the second remains. ``more`` fields follow, put in as the map is made.
    """
    a, b = F.col("a"), F.col("b")
    swap = a["id"] < b["id"]
    big, small = F.when(swap, b["id"]).otherwise(a["id"]), F.when(swap, a["id"]).otherwise(b["id"])
    from_type = F.when(swap, F.col("link.target")).otherwise(F.col("link.source"))
    to_type = F.when(swap, F.col("link.source")).otherwise(F.col("link.target"))
    label = F.concat(F.lit(res_id + KEY_SEPARATOR), big, F.lit(ID_SEPARATOR), small)

    def field(member: Column) -> Column:
        return F.concat(F.col("link.type_id"), F.lit(NAME_SEPARATOR), member["id_type"], F.lit("id"))

    rest = [c for name, value in (more or {}).items() for c in (F.lit(name), value)]
    fields = F.when(
        a["id_type"] == b["id_type"], F.create_map(field(b), b["id"], *rest)
    ).otherwise(F.create_map(field(a), a["id"], field(b), b["id"], *rest))
    pairs = _numbered_pairs(records, links, block)
    pairs = pairs if copies else _distinct_pairs(pairs, links)
    return pairs.select("a", "b", _link(links).alias("link")).select(
        label.alias("id"),
        collection_name(F.col("link.model"), F.lit(LINK)).alias("collection"),
        label.alias("relation_id"),
        F.col("link.type_id").alias("relation_type"),
        F.lit(CODE_ONE_WAY).alias("direction_type"),
        from_type.alias("from_entity_type"),
        F.concat(from_type, F.lit(ID_SEPARATOR), big).alias("from_entity_id"),
        to_type.alias("to_entity_type"),
        F.concat(to_type, F.lit(ID_SEPARATOR), small).alias("to_entity_id"),
        F.lit(res_id).alias("resid"),
        fields.alias("fields"),
    )
