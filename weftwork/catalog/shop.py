"""The model that the queries build: customers, suppliers, parts, nations, and how they are linked."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftwork.catalog import table
from weftwork.constants import (
    BIDIRECTIONAL,
    ENTITY,
    LINK,
    NOT_DIRECTED,
    SOURCE_TO_TARGET,
    TARGET_TO_SOURCE,
)
from weftwork.plans.model import EntityType, LinkType, Mapping, Model, Property


def money(column: str):
    return F.col(column).cast("decimal(18,2)").cast("string")


CUSTOMER = EntityType(
    "customer",
    "customer",
    (
        Property("name", "text", analyse=True),
        Property("segment", "text"),
        Property("balance", "number"),
        Property("nation", "integer"),
    ),
)
SUPPLIER = EntityType("supplier", "supplier", (Property("name", "text", analyse=True), Property("balance", "number")))
PART = EntityType(
    "part",
    "part",
    (
        Property("name", "text", analyse=True),
        Property("brand", "text"),
        Property("size", "integer"),
        Property("price", "number"),
    ),
)
ORDER = EntityType("order", "order", (Property("ordered", "date"), Property("status", "text")))


def _link(uuid: str, source: str, target: str, directed: bool = True, *properties: Property) -> LinkType:
    return LinkType(uuid, source, target, source, target, directed, properties)


PLACED = _link("placed", "customer", "order", True, Property("ordered", "date"), Property("status", "text"))
CONTAINS = _link("contains", "order", "part", True, Property("quantity", "number"))
SUPPLIES = _link("supplies", "supplier", "part")
CO_ORDERED = _link("co_ordered", "part", "part", False)
HALF = LinkType("half", "customer", None, "customer", "order")

SHOP = Model(
    "shop",
    (CUSTOMER, SUPPLIER, PART, ORDER),
    (PLACED, CONTAINS, SUPPLIES, CO_ORDERED, HALF),
)

BY_STATUS = {"O": SOURCE_TO_TARGET, "F": TARGET_TO_SOURCE, "P": BIDIRECTIONAL, "N": NOT_DIRECTED}

MAP_CUSTOMER = Mapping(
    "customer",
    "shop",
    ENTITY,
    "customer",
    {"name": "c_name", "segment": "c_mktsegment", "balance": "balance", "nation": "c_nationkey"},
    id_columns=("key_text",),
)
MAP_PART = Mapping(
    "part",
    "shop",
    ENTITY,
    "part",
    {"name": "p_name", "brand": "p_brand", "size": "size_or_null", "price": "price"},
    id_columns=("p_partkey",),
)
MAP_PLACED = Mapping(
    "orders",
    "shop",
    LINK,
    "placed",
    {"ordered": "ordered", "status": "o_orderstatus"},
    id_columns=("o_custkey", "o_orderkey"),
    source_columns=("o_custkey",),
    target_columns=("o_orderkey",),
    directivity=BIDIRECTIONAL,
    direction_column="o_orderstatus",
    direction_values=BY_STATUS,
)
MAP_ORDER = Mapping(
    "orders",
    "shop",
    ENTITY,
    "order",
    {"ordered": "ordered", "status": "o_orderstatus"},
    id_columns=("o_orderkey",),
)
MAP_CONTAINS = Mapping(
    "lineitem",
    "shop",
    LINK,
    "contains",
    {"quantity": "quantity"},
    id_columns=("l_orderkey", "l_linenumber"),
    source_columns=("l_orderkey",),
    target_columns=("l_partkey",),
    directivity=TARGET_TO_SOURCE,
)
MAP_SUPPLIES = Mapping(
    "lineitem",
    "shop",
    LINK,
    "supplies",
    {},
    id_columns=("l_suppkey", "l_partkey"),
    source_columns=("l_suppkey",),
    target_columns=("l_partkey",),
    directivity=NOT_DIRECTED,
)
MAP_HALF = Mapping("orders", "shop", LINK, "half", {}, ("o_orderkey",), ("o_custkey",), ("o_orderkey",))


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers of which some have no key, a blank key, no resource or no owner."""
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        "c_custkey",
        "c_name",
        "c_nationkey",
        "c_mktsegment",
        money("c_acctbal").alias("balance"),
        F.when(key % 11 == 0, None).when(key % 13 == 0, F.lit("  ")).otherwise(key.cast("string")).alias("key_text"),
        F.when(F.col("c_nationkey") == 3, None)
        .otherwise(F.concat(F.lit("res"), (F.col("c_nationkey") % 7).cast("string")))
        .alias("resId"),
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("owner"),
    )


CUSTOMERS_SQL = """
    SELECT *,
      CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 13 = 0 THEN '  '
           ELSE CAST(c_custkey AS VARCHAR) END AS key_text,
      CASE WHEN c_nationkey = 3 THEN NULL ELSE 'res' || (c_nationkey % 7) END AS res_id,
      nullif(c_mktsegment, 'BUILDING') AS owner_or_null,
      CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS balance
    FROM customer
"""


def parts(spark: SparkSession, folder: str) -> DataFrame:
    """Parts of which some have no size."""
    return table(spark, folder, "part").select(
        "p_partkey",
        "p_name",
        "p_brand",
        "p_type",
        F.when(F.col("p_size") % 5 != 0, F.col("p_size")).alias("size_or_null"),
        money("p_retailprice").alias("price"),
    )


PARTS_SQL = """
    SELECT p_partkey, p_name, p_brand, p_type, CASE WHEN p_size % 5 <> 0 THEN p_size END AS size_or_null,
      CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) AS price
    FROM part
"""


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_orderpriority",
        F.col("o_orderdate").cast("date").cast("string").alias("ordered"),
        F.concat(F.lit("res"), (F.col("o_custkey") % 5).cast("string")).alias("resId"),
    )


def lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        F.col("l_quantity").cast("bigint").cast("string").alias("quantity"),
        F.concat(F.lit("res"), (F.col("l_suppkey") % 5).cast("string")).alias("resId"),
    )


def as_records(frame: DataFrame, schema_id: str, sequence, task) -> DataFrame:
    """Rows in the form of raw stream records: a split key and a flat map of text."""
    pairs = [c for name in frame.columns for c in (F.lit(name), F.col(name).cast("string"))]
    return frame.select(
        sequence.cast("bigint").alias("sequence_id"),
        F.lit(schema_id).alias("data_schema_id"),
        F.col("resId").alias("res_id"),
        task.cast("string").alias("task_id"),
        F.create_map(*pairs).alias("value"),
    )
