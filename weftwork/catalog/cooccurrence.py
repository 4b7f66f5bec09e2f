"""Identifiers seen together.

A record is one order line with what it names: part (``phone``), supplier
(``mail``), order (``imsi``), and the part again as ``mac`` with colons.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftwork.catalog import query, table
from weftwork.operators.cooccur import (
    IdentifierEntity,
    PairLink,
    identifier_entities,
    mapped_pairs,
    pair_links,
    parse_identifiers,
)
from weftwork.operators.dedup import dedup_by_key
from weftwork.session import shared_folder
from weftwork.sources.files import dealt_out, read_text_lines

ENTITIES = [
    IdentifierEntity("phone", "std", "phone_number", "phone"),
    IdentifierEntity("mail", "std", "mail_box", "mail"),
    IdentifierEntity("mac", "std", "mac_address", "mac"),
]
LINKS = [
    PairLink("phone", "mail", "std", "phone_mail", "phone_number", "mail_box"),
    PairLink("imsi", "phone", "std", "imsi_phone", "imsi", "phone_number"),
    PairLink("phone", "phone", "std", "phone_phone", "phone_number", "phone_number"),
]


def _member(id_type: str, id_) -> F.struct:
    return F.struct(F.lit(id_type).alias("id_type"), id_.cast("string").alias("id"))


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """One JSON array per order line, with members of a type that is not wanted, without an id, and with a blank one."""
    read = table(spark, folder, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey", "l_returnflag", "l_linestatus", "l_linenumber")
    part, supplier = F.col("l_partkey"), F.col("l_suppkey")
    members = F.array(
        _member("phone", part),
        _member("mail", F.when(supplier % 10 == 0, F.lit(" ")).otherwise(supplier.cast("string"))),
        _member("imsi", F.when(F.col("l_orderkey") % 3 != 0, F.col("l_orderkey"))),
        _member("mac", F.concat_ws(":", F.lit("a"), (part % 100).cast("string"), (supplier % 100).cast("string"))),
        _member("colour", F.col("l_returnflag")),
        _member("phone", part + 1),
    )
    # a third of the lines holds nothing of use
    useless = F.array(_member("colour", F.col("l_linestatus")))
    shown = F.when(F.col("l_linenumber") % 3 == 0, useless).otherwise(members)
    return dealt_out(read).select(F.to_json(shown).alias("value"))


LINES_A_FILE = 100_000  # a packed file is read by one task, so files stay small


def write_lines(spark: SparkSession, folder: str, path: str) -> None:
    """The lines as packed text files; a higher level of packing takes twice the time for a tenth of the bytes."""
    packed = {"compression": "gzip", "zlib.compress.level": "THREE", "maxRecordsPerFile": LINES_A_FILE}
    lines(spark, folder).write.options(**packed).text(path)


_MEMBERS_SQL = """
  SELECT CAST(l_partkey AS VARCHAR) AS phone, CASE WHEN l_suppkey % 10 = 0 THEN ' ' ELSE CAST(l_suppkey AS VARCHAR) END AS mail,
    CASE WHEN l_orderkey % 3 <> 0 THEN CAST(l_orderkey AS VARCHAR) END AS imsi,
    'a' || (l_partkey % 100) || (l_suppkey % 100) AS mac, CAST(l_partkey + 1 AS VARCHAR) AS phone2
  FROM lineitem WHERE l_linenumber % 3 <> 0
"""


@query(f"""
SELECT 'phone=' || phone || ';mail=' || mail || coalesce(';imsi=' || imsi, '') || ';mac=' || mac || ';phone=' || phone2 AS members,
  CAST(count(*) AS BIGINT) AS records
FROM ({_MEMBERS_SQL}) GROUP BY 1
""")
def q_array_parse(spark: SparkSession, folder: str) -> DataFrame:
    """Identifier arrays with the members of allowed types that have an id."""
    parsed = parse_identifiers(lines(spark, folder))
    text = F.array_join(F.transform("members", lambda m: F.concat(m["id_type"], F.lit("="), m["id"])), ";")
    return parsed.groupBy(text.alias("members")).agg(F.count(F.lit(1)).alias("records"))


@query(f"""
WITH m AS ({_MEMBERS_SQL}), e AS (
  SELECT 'phone_number' AS entity_type, 'phone~`#' || phone AS entity_id FROM m
  UNION ALL SELECT 'phone_number', 'phone~`#' || phone2 FROM m
  UNION ALL SELECT 'mail_box', 'mail~`#' || mail FROM m WHERE mail <> ' '
  UNION ALL SELECT 'mac_address', 'mac~`#' || mac FROM m)
SELECT 'rel@' || entity_id AS id, 'std_entity_index' AS collection, entity_id, entity_type, CAST(count(*) AS BIGINT) AS copies
FROM e GROUP BY ALL
""")
def q_identifier_entities(spark: SparkSession, folder: str) -> DataFrame:
    """An entity document for each mapped member, with how often it is seen."""
    found = identifier_entities(parse_identifiers(lines(spark, folder)), ENTITIES, "rel")
    return found.groupBy("id", "collection", "entity_id", "entity_type").agg(F.count(F.lit(1)).alias("copies"))


_PAIRS_SQL = f"""
  SELECT type, a, b, fields FROM (
    SELECT 'phone_mail' AS type, phone AS a, mail AS b, 'phone_mail_mailid=' || mail || ';phone_mail_phoneid=' || phone AS fields
    FROM ({_MEMBERS_SQL}) WHERE mail <> ' '
    UNION ALL SELECT 'phone_mail', mail, phone2, 'phone_mail_mailid=' || mail || ';phone_mail_phoneid=' || phone2
    FROM ({_MEMBERS_SQL}) WHERE mail <> ' '
    UNION ALL SELECT 'imsi_phone', phone, imsi, 'imsi_phone_imsiid=' || imsi || ';imsi_phone_phoneid=' || phone
    FROM ({_MEMBERS_SQL}) WHERE imsi IS NOT NULL
    UNION ALL SELECT 'imsi_phone', imsi, phone2, 'imsi_phone_imsiid=' || imsi || ';imsi_phone_phoneid=' || phone2
    FROM ({_MEMBERS_SQL}) WHERE imsi IS NOT NULL
    UNION ALL SELECT 'phone_phone', phone, phone2, 'phone_phone_phoneid=' || phone2 FROM ({_MEMBERS_SQL}))
"""


@query(f"SELECT type AS relation_type, a AS first, b AS second, CAST(count(*) AS BIGINT) AS pairs FROM ({_PAIRS_SQL}) GROUP BY ALL")
def q_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of members whose types are linked, in array order, with how often each is seen."""
    pairs = mapped_pairs(parse_identifiers(lines(spark, folder)), LINKS)
    ends = (F.col("link.type_id").alias("relation_type"), F.col("a.id").alias("first"), F.col("b.id").alias("second"))
    return pairs.groupBy(*ends).agg(F.count(F.lit(1)).alias("pairs"))


@query(f"""
WITH ends AS (
  SELECT *, CASE type WHEN 'phone_mail' THEN 'phone_number' WHEN 'imsi_phone' THEN 'imsi' ELSE 'phone_number' END AS source,
    CASE type WHEN 'phone_mail' THEN 'mail_box' ELSE 'phone_number' END AS target FROM ({_PAIRS_SQL}))
SELECT DISTINCT 'rel@' || greatest(a, b) || '~`#' || least(a, b) AS id, 'std_relation_index' AS collection, type AS relation_type,
  '1' AS direction_type,
  CASE WHEN a >= b THEN source ELSE target END AS from_entity_type,
  CASE WHEN a >= b THEN source ELSE target END || '~`#' || greatest(a, b) AS from_entity_id,
  CASE WHEN a >= b THEN target ELSE source END AS to_entity_type,
  CASE WHEN a >= b THEN target ELSE source END || '~`#' || least(a, b) AS to_entity_id,
  'rel' AS resid, fields
FROM ends
""")
def q_pair_links(spark: SparkSession, folder: str) -> DataFrame:
    """Link documents of pairs, each once, with their fields as ``name=id`` in the order of the names."""
    made = pair_links(parse_identifiers(lines(spark, folder)), LINKS, "rel", copies=False)
    ends = ("from_entity_type", "from_entity_id", "to_entity_type", "to_entity_id")
    fields = F.sort_array(F.map_entries("fields"))  # one or two; without a lambda the stage is compiled whole
    each = [F.concat(F.get(fields, F.lit(i))["key"], F.lit("="), F.get(fields, F.lit(i))["value"]) for i in (0, 1)]
    shown = made.withColumn("fields", F.concat_ws(";", *each))
    return shown.select("id", "collection", "relation_type", "direction_type", *ends, "resid", "fields")


@query(f"""
SELECT 'phone_phone' AS relation_type, 'rel@' || greatest(phone, phone2) || '~`#' || least(phone, phone2) AS id,
  'phone_phone_phoneid' AS field, max(phone2) AS value
FROM ({_MEMBERS_SQL}) GROUP BY 2
""")
def q_pair_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Links within one identifier type, one survivor per id, with their field."""
    made = pair_links(parse_identifiers(lines(spark, folder)), [LINKS[2]], "rel")
    survivors = dedup_by_key(made, ["id"])
    return survivors.select("relation_type", "id", F.explode("fields").alias("field", "value"))


@query("SELECT CAST(count(*) AS BIGINT) AS lines, CAST(count(*) FILTER (l_linenumber % 3 <> 0) AS BIGINT) AS parsed FROM lineitem")
def q_text_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines written to text files and read back by extension, then parsed."""
    path = shared_folder(spark, "lines")
    write_lines(spark, folder, path)
    read = read_text_lines(spark, path)
    parsed = parse_identifiers(read).select(F.lit(0).alias("lines"), F.lit(1).alias("parsed"))
    return (
        read.select(F.lit(1).alias("lines"), F.lit(0).alias("parsed"))
        .unionByName(parsed)
        .agg(F.sum("lines").alias("lines"), F.sum("parsed").alias("parsed"))
    )
