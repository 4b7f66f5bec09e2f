"""The batch jobs, run more than once over files made of the tables."""

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftwork.catalog import query
from weftwork.catalog.cooccurrence import ENTITIES, LINKS, _MEMBERS_SQL, _PAIRS_SQL, write_lines
from weftwork.catalog.shop import MAP_CUSTOMER, MAP_PART, SHOP, customers, parts
from weftwork.jobs import INCREMENTAL, collect_dossiers, relate_identifiers, relate_mapped, transform_files
from weftwork.operators.cells import element_cells
from weftwork.operators.elements import build_elements
from weftwork.plans.model import compiled, definition_table, mapping_table
from weftwork.plans.rules import DossierRule
from weftwork.session import shared_folder
from weftwork.sinks.tables import read_documents


@query("""
SELECT md5('shop@part~`#' || p_partkey) AS id, 'shop_entity_index' AS collection, 'part~`#' || p_partkey AS entity_id,
  p_brand AS brand, CAST(2 AS BIGINT) AS writes
FROM part
""")
def q_job_transform_twice(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of parts in two trees of sequence files, after the job has run twice: the same ids, each read once."""
    base = shared_folder(spark, "transform-job")
    made = parts(spark, folder).withColumn("resId", F.lit("shop"))
    made.filter("p_partkey % 3 <> 0").write.parquet(f"{base}/data/part/read/10.parquet")
    made.filter("p_partkey % 3 <> 1").write.parquet(f"{base}/data/part/compact/20.parquet")
    mappings = compiled(mapping_table(spark, MAP_PART), definition_table(spark, SHOP))
    for _ in range(2):
        transform_files(spark, f"{base}/data", mappings, f"{base}/out")
    stored = f"{base}/out/documents"
    writes = spark.read.parquet(stored).groupBy("id").agg(F.count(F.lit(1)).alias("writes"))
    field = lambda name: F.try_element_at("fields", F.lit(name))
    docs = read_documents(spark, stored).select("id", "collection", field("entity_id").alias("entity_id"), field("g_tk11_brand").alias("brand"))
    return docs.join(writes, "id")


@query(f"""
WITH m AS ({_MEMBERS_SQL}), counts AS (
  SELECT (SELECT count(*) FROM lineitem) AS srcCount, (SELECT count(*) FROM m) AS countAfterParseJson,
    (SELECT count(phone) + count(phone2) + count(mac) + count(nullif(mail, ' ')) FROM m) AS entityDataCount,
    (SELECT count(*) FROM ({_PAIRS_SQL})) AS linkDataCount)
SELECT CAST(srcCount AS VARCHAR) AS "srcCount", CAST(countAfterParseJson AS VARCHAR) AS "countAfterParseJson",
  CAST(entityDataCount AS VARCHAR) AS "entityDataCount", CAST(linkDataCount AS VARCHAR) AS "linkDataCount", 'successful' AS status
FROM counts, range(2)
""")
def q_job_identifiers(spark: SparkSession, folder: str) -> DataFrame:
    """The counts of every stage of the identifier job, for each of two runs over the same lines."""
    base = shared_folder(spark, "identifier-job")
    write_lines(spark, folder, f"{base}/lines")
    for _ in range(2):
        relate_identifiers(spark, f"{base}/lines", ENTITIES, LINKS, "rel", f"{base}/out")
    return spark.read.parquet(f"{base}/out/history").select("srcCount", "countAfterParseJson", "entityDataCount", "linkDataCount", "status")


@query("""
SELECT md5('task@part~`#' || p_partkey) AS id, 'shop_entity_index' AS collection, 'part~`#' || p_partkey AS entity_id, p_brand AS brand,
  'task' AS resid, CAST((SELECT count(*) FROM part) AS VARCHAR) AS counted
FROM part
""")
def q_job_mapped_files(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of parts in files of two layouts, with the resource of the task, after the job has run twice."""
    base = shared_folder(spark, "mapped-job")
    made = parts(spark, folder).select("p_partkey", "p_name", "p_brand", F.lit("own").alias("resId"))
    made.filter("p_partkey % 3 = 0").write.option("header", True).csv(f"{base}/data/part/a")
    made.filter("p_partkey % 3 <> 0").select("resId", "p_brand", "p_partkey").write.option("header", True).csv(f"{base}/data/part/b")
    mappings = compiled(mapping_table(spark, MAP_PART), definition_table(spark, SHOP))
    for _ in range(2):
        relate_mapped(spark, f"{base}/data", mappings, "task", f"{base}/out", "csv", header=True, recursiveFileLookup=True)
    field = lambda name: F.try_element_at("fields", F.lit(name))
    counted = spark.read.parquet(f"{base}/out/history").agg(F.max("elementDataCount")).first()[0]
    docs = spark.read.parquet(f"{base}/out/elements/resource=task")
    return docs.select(
        "id", "collection", field("entity_id").alias("entity_id"), field("g_tk11_brand").alias("brand"), field("resid").alias("resid"),
        F.lit(counted).alias("counted"),
    )


_SEGMENTS = DossierRule("CUSTOMER", "shop", "customer", "name", (("segment", "d_segment"),))
_RUNS = (datetime(2024, 1, 15, tzinfo=timezone.utc), datetime(2024, 2, 15, tzinfo=timezone.utc))
_DOSSIER_SQL = """
SELECT c_custkey % 2 AS run, 'CUSTOMER@' || c_name AS doc_id, c_mktsegment AS segment FROM customer
WHERE c_custkey % 11 <> 0 AND c_custkey % 13 <> 0
"""


def _two_dossier_runs(spark: SparkSession, folder: str) -> str:
    """Customers of even keys come in January, the others in February; the second run takes what is new."""
    base = shared_folder(spark, "dossier-job")
    for run, month in enumerate((1, 2)):
        chosen = customers(spark, folder).filter(F.col("c_custkey") % 2 == run)
        elements = build_elements(chosen, SHOP, [MAP_CUSTOMER])
        cells = element_cells(elements, F.lit(datetime(2024, month, 1, tzinfo=timezone.utc)).cast("timestamp"))
        cells.write.mode("append").parquet(f"{base}/cells")
        modes = {} if run == 0 else {"mode": INCREMENTAL}
        collect_dossiers(spark, spark.read.parquet(f"{base}/cells"), _SEGMENTS, base, until=_RUNS[run], **modes)
    return f"{base}/documents/CUSTOMER"


@query(f"SELECT CAST(run AS INTEGER) AS run, doc_id, segment FROM ({_DOSSIER_SQL})")
def q_job_dossier_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Dossiers of a full run and of an incremental one that starts where it stopped."""
    path = _two_dossier_runs(spark, folder)
    runs = [spark.read.parquet(f"{path}/{int(at.timestamp() * 1000)}").withColumn("run", F.lit(n)) for n, at in enumerate(_RUNS)]
    return runs[0].unionByName(runs[1]).select("run", "doc_id", F.try_element_at("fields", F.lit("d_segment"))[0].alias("segment"))


@query(f"SELECT CAST(run AS INTEGER) AS run, CAST(count(*) AS BIGINT) AS dossiers, true AS few_files FROM ({_DOSSIER_SQL}) GROUP BY run")
def q_dossier_files(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and files of each run's table: files are as many as the bytes ask for, not one for each task."""
    path, found = _two_dossier_runs(spark, folder), None
    for run, at in enumerate(_RUNS):
        stored = spark.read.parquet(f"{path}/{int(at.timestamp() * 1000)}").select(F.col("_metadata.file_path").alias("file"))
        counted = stored.agg(F.count(F.lit(1)).alias("dossiers"), (F.countDistinct("file") <= F.ceil(F.count(F.lit(1)) / 10_000)).alias("few_files"))
        counted = counted.select(F.lit(run).alias("run"), "dossiers", "few_files")
        found = counted if found is None else found.unionByName(counted)
    return found
