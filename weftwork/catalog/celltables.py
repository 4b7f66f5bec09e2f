"""Cells of many small outputs, merged into one table by period."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftwork.catalog import REGISTRY, query
from weftwork.catalog.outputs import _history_cells
from weftwork.catalog.streams import _run_load
from weftwork.jobs import compact_cells
from weftwork.operators.cells import scan_cells
from weftwork.session import shared_folder
from weftwork.sinks.celltable import NOTHING_MERGED, merge_batches, read_cells
from weftwork.sinks.tables import write_batch


def _merged_twice(spark: SparkSession, folder: str) -> str:
    """Cells of orders come in four batches; two are merged, then all that came since."""
    base = shared_folder(spark, "cell-batches")
    cells = _history_cells(spark, folder).withColumn("ts", F.col("ts").cast("timestamp"))
    part, last = F.pmod(F.xxhash64("row_key", "ts", "value"), F.lit(4)), NOTHING_MERGED
    for batch_id in range(4):
        write_batch(cells.filter(part == batch_id), f"{base}/batches", batch_id)
        if batch_id % 2:
            last = merge_batches(spark, f"{base}/batches", f"{base}/table", last)
    return f"{base}/table"


@query("""
SELECT CAST(o_custkey AS VARCHAR) AS row_key, CAST(date_trunc('month', o_orderdate) AS DATE) AS since, 'status' AS qualifier,
  arg_max(o_orderstatus, strftime(o_orderdate, '%Y%m%d') || o_orderstatus) AS value
FROM orders GROUP BY 1, 2
UNION ALL
SELECT CAST(o_custkey AS VARCHAR), CAST(date_trunc('month', o_orderdate) AS DATE), 'order',
  arg_max(lpad(CAST(o_orderkey AS VARCHAR), 12, '0'), strftime(o_orderdate, '%Y%m%d') || lpad(CAST(o_orderkey AS VARCHAR), 12, '0'))
FROM orders GROUP BY 1, 2
""")
def q_cells_merged(spark: SparkSession, folder: str) -> DataFrame:
    """What the table of cells holds after two merges: the newest cell of each qualifier and month."""
    return read_cells(spark, _merged_twice(spark, folder)).select("row_key", "since", "qualifier", "value")


@query(REGISTRY["q_cells_scan"].sql)
def q_cells_period(spark: SparkSession, folder: str) -> DataFrame:
    """Rows with wanted qualifiers as columns, from the folders of one table and two years."""
    cells = read_cells(spark, _merged_twice(spark, folder), date(1996, 1, 1), date(1998, 1, 1))
    return scan_cells(cells, "shop_entity_customer", ["status", "order"])


@query(REGISTRY["q_stream_load"].sql)
def q_stream_cells_merged(spark: SparkSession, folder: str) -> DataFrame:
    """Cells of a load stream after two runs of the merging job."""
    out = _run_load(spark, folder)
    for _ in range(2):
        compact_cells(spark, out)
    return read_cells(spark, f"{out}/cell-table").select("table_name", "row_key", "family", "qualifier", "value")
