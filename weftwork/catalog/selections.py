"""Which rows are taken: unions, replays, watch lists, exclusions."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftwork.catalog import query, table
from weftwork.operators.selection import (
    active_watchlist,
    distinct_resources,
    exclude_resources,
    replay_filter,
    watched,
    with_key,
)
from weftwork.session import shared_folder
from weftwork.sources.files import list_schemas, read_sequence, scan_files


@query("""
SELECT c_custkey, c_name, NULL AS s_suppkey, NULL AS s_name FROM customer
UNION ALL SELECT NULL, NULL, s_suppkey, s_name FROM supplier
""")
def q_union_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Several files as one frame; one that is absent is skipped."""
    paths = [f"{folder}/{name}.parquet" for name in ("customer", "supplier", "absent")]
    return scan_files(spark, paths).select("c_custkey", "c_name", "s_suppkey", "s_name")


@query("""
SELECT event_id, event_type, CAST(NULL AS BIGINT) AS user_id, CAST(NULL AS DOUBLE) AS value FROM events WHERE event_id % 3 = 0
UNION ALL SELECT event_id, NULL, CAST(user_id AS BIGINT), CAST(value AS DOUBLE) FROM events WHERE event_id % 3 = 1
""")
def q_sequence_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Sequence files of two schemas, read up to a cursor with the columns of all of them."""
    events, path = table(spark, folder, "events"), shared_folder(spark, "sequences")
    of = lambda n: events.filter(F.pmod("event_id", F.lit(3)) == n)
    of(0).select("event_id", "event_type").write.parquet(f"{path}/10.parquet")
    of(1).select("event_id", F.col("user_id").cast("long"), F.col("value").cast("double")).write.parquet(f"{path}/20.parquet")
    of(2).write.parquet(f"{path}/30.parquet")
    return read_sequence(spark, path, 15).select("event_id", "event_type", "user_id", "value")


def _sequences_of_two_headers(spark: SparkSession, folder: str, fmt: str) -> str:
    """Three sequences of events with other columns in another order, the last beyond the cursor."""
    events, path = table(spark, folder, "events"), shared_folder(spark, "sequences")
    of = lambda n: events.filter(F.pmod("event_id", F.lit(3)) == n)
    user, value = F.col("user_id").cast("long").alias("user_id"), F.col("value").cast("decimal(18,2)").cast("string").alias("value")
    parts = {10: ("event_id", "event_type"), 20: (value, "event_id", user), 30: ("event_type", user, "event_id", "ts")}
    for n, (number, columns) in enumerate(parts.items()):
        of(n).select(*columns).write.option("header", "true").format(fmt).save(f"{path}/{number}.{fmt}")
    return path


_HEADERS_SQL = """
SELECT event_id, event_type, CAST(NULL AS BIGINT) AS user_id, CAST(NULL AS VARCHAR) AS value FROM events WHERE event_id % 3 = 0
UNION ALL SELECT event_id, NULL, CAST(user_id AS BIGINT), CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) FROM events WHERE event_id % 3 = 1
"""


def _sequence_columns(frame: DataFrame) -> DataFrame:
    long = lambda c: F.col(c).cast("long").alias(c)
    return frame.select(long("event_id"), "event_type", long("user_id"), "value")


@query(_HEADERS_SQL)
def q_sequence_columns_csv(spark: SparkSession, folder: str) -> DataFrame:
    """CSV files of other headers, each read by its own, up to a cursor."""
    path = _sequences_of_two_headers(spark, folder, "csv")
    return _sequence_columns(read_sequence(spark, path, 15, "csv", ".csv", header="true"))


@query(_HEADERS_SQL)
def q_sequence_columns_json(spark: SparkSession, folder: str) -> DataFrame:
    """JSON lines of other keys, up to a cursor."""
    return _sequence_columns(read_sequence(spark, _sequences_of_two_headers(spark, folder, "json"), 15, "json", ".json"))


@query("""
SELECT event_id, event_type, user_id FROM events
WHERE event_id > 500 AND event_type NOT IN (SELECT event_type FROM events WHERE value > 95 AND event_type > 'p')
""")
def q_replay_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Messages of unchanged types after the start of the replay."""
    events = table(spark, folder, "events").select("event_id", "event_type", "user_id", "value")
    changed = events.filter((F.col("value") > 95) & (F.col("event_type") > "p")).select("event_type")
    return replay_filter(events, changed, 500, ["event_type"], sequence="event_id").drop("value")


@query("SELECT event_id, event_type, user_id FROM events")
def q_replay_unchanged(spark: SparkSession, folder: str) -> DataFrame:
    """Without changed types every message passes."""
    events = table(spark, folder, "events").select("event_id", "event_type", "user_id")
    return replay_filter(events, events.filter(F.col("event_id") < 0).select("event_type"), 500, ["event_type"], "event_id")


_WATCHED_SQL = "SELECT c_custkey FROM customer WHERE c_acctbal < 0 AND c_custkey % 4 <> 0"


@query(_WATCHED_SQL)
def q_active_watchlist(spark: SparkSession, folder: str) -> DataFrame:
    """The values of a watch list that are in use."""
    return active_watchlist(_watchlist(spark, folder), "c_custkey")


def _watchlist(spark: SparkSession, folder: str) -> DataFrame:
    in_use = F.when(F.col("c_custkey") % 4 != 0, 1).otherwise(0)
    return table(spark, folder, "customer").filter(F.col("c_acctbal") < 0).select("c_custkey", in_use.alias("is_use"))


@query(f"SELECT event_id, user_id, event_type FROM events WHERE user_id IN ({_WATCHED_SQL})")
def q_watchlist(spark: SparkSession, folder: str) -> DataFrame:
    """Events of watched users."""
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type")
    return watched(events, active_watchlist(_watchlist(spark, folder), "c_custkey"), "user_id")


_REGION_SQL = "SELECT s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey = 0"


@query(f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey AS resid FROM lineitem
WHERE l_partkey % 6 <> 0 AND l_suppkey NOT IN ({_REGION_SQL})
""")
def q_resource_exclusion(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of suppliers outside a region; lines without a supplier go too."""
    supplier = F.when(F.col("l_partkey") % 6 != 0, F.col("l_suppkey"))
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", supplier.alias("resid"))
    return exclude_resources(lines, _region_suppliers(spark, folder))


def _region_suppliers(spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "nation").filter(F.col("n_regionkey") == 0)
    suppliers = table(spark, folder, "supplier")
    return suppliers.join(nations, suppliers.s_nationkey == nations.n_nationkey, "left_semi").select("s_suppkey")


@query("SELECT DISTINCT o_custkey AS \"resId\" FROM orders")
def q_distinct_resources(spark: SparkSession, folder: str) -> DataFrame:
    """Each resource id once."""
    return distinct_resources(table(spark, folder, "orders").select(F.col("o_custkey").alias("resId")))


@query("SELECT doc_id, source AS key FROM documents WHERE doc_id % 4 NOT IN (0, 1)")
def q_empty_key(spark: SparkSession, folder: str) -> DataFrame:
    """Rows whose key is neither null nor empty."""
    form = F.col("doc_id") % 4
    key = F.when(form == 0, F.lit("")).when(form > 1, F.col("source"))
    return with_key(table(spark, folder, "documents").select("doc_id", key.alias("key")), "key")


@query("SELECT DISTINCT event_type AS data_schema_id FROM events")
def q_schema_directories(spark: SparkSession, folder: str) -> DataFrame:
    """Data schema ids found as the folders of a written table."""
    path = shared_folder(spark, "schemas")
    events = table(spark, folder, "events").select("event_id", F.col("event_type").alias("data_schema_id"))
    events.write.partitionBy("data_schema_id").parquet(path)
    return list_schemas(spark, path)
