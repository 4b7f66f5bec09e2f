"""A table of cells by element table and period, into which the many small outputs of a stream are merged."""

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftwork.operators.cells import latest_cells
from weftwork.session import shared_folder

CELLS = "row_key string, family string, qualifier string, value string, ts timestamp, table_name string"
STORED = f"{CELLS}, since date"
NOTHING_MERGED = -1
PERIODS = {
    "day": lambda d: True,
    "week": lambda d: d.weekday() == 0,
    "month": lambda d: d.day == 1,
    "year": lambda d: (d.month, d.day) == (1, 1),
}


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def period_of(ts: Column, period: str) -> Column:
    """The first day, in UTC, of the period that a time lies in."""
    day = F.date_from_unix_date(F.floor(F.unix_seconds(ts) / 86400).cast("int"))
    return day if period == "day" else F.trunc(day, period)


def _stored(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(STORED).parquet(path)
    except AnalysisException as error:
        if not _missing(error):
            raise
        return spark.createDataFrame([], STORED)


def read_cells(spark: SparkSession, path: str, since: date | None = None, until: date | None = None, period: str = "month") -> DataFrame:
    """The stored cells of the periods in ``[since, until)``; one bound or both may be left out.

    Within a period only the newest cell of a qualifier is stored, so bounds are first days of periods, and others are
    refused. The bounds, and a filter on ``table_name``, choose folders; other folders are not read.
    """
    cells = _stored(spark, path)
    for bound, inside in ((since, F.col("since") >= F.lit(since)), (until, F.col("since") < F.lit(until))):
        if bound is not None:
            if not PERIODS[period](bound):
                raise ValueError(f"{bound} is not the first day of a {period}")
            cells = cells.filter(inside)
    return cells


def merge_cells(spark: SparkSession, cells: DataFrame, path: str, period: str = "month") -> None:
    """Put cells into the table: of each row and qualifier the newest one of a period stays, of equal times the greater value.

    Only folders that get cells are read and written. The result is written aside first and then takes their place, so a
    run that fails before leaves the table as it was, and merging the same cells again changes nothing. A cell without
    table, row, qualifier or time has no place in the table and is left out. Other columns are not read.
    """
    keys = ["table_name", "row_key", "qualifier", "ts"]
    new = cells.dropna(subset=keys).select("row_key", "family", "qualifier", "value", F.col("ts").cast("timestamp").alias("ts"), "table_name")
    new = new.withColumn("since", period_of(F.col("ts"), period))
    touched: dict[str, list] = {}
    for row in new.select("table_name", "since").distinct().collect():  # folders, of which the driver lists as many anyway
        touched.setdefault(row["table_name"], []).append(row["since"])
    if not touched:
        return
    changed = F.lit(False)
    for name, periods in sorted(touched.items()):
        changed = changed | ((F.col("table_name") == name) & F.col("since").isin(sorted(periods)))
    both = _stored(spark, path).filter(changed).unionByName(new)
    merged = latest_cells(both, "since")
    aside = shared_folder(spark, "merged-cells")
    merged.hint("rebalance", "table_name", "since").write.parquet(aside)
    ready = spark.read.parquet(aside).hint("rebalance", "table_name", "since")
    ready.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("table_name", "since").parquet(path)


def merge_batches(spark: SparkSession, batches: str, path: str, last: int = NOTHING_MERGED, period: str = "month") -> int:
    """Merge the micro-batches that came since the ``last`` one merged, and say which one is the last now.

    The last one itself is merged again, since it may have been half written when it was read.
    """
    try:
        written = spark.read.schema(f"{CELLS}, batch_id long").parquet(batches)
    except AnalysisException as error:
        if not _missing(error):
            raise
        return last
    fresh = written.filter(F.col("batch_id") >= last)
    newest = fresh.agg(F.max("batch_id")).first()[0]
    if newest is None:
        return last
    merge_cells(spark, fresh.filter(F.col("batch_id") <= newest), path, period)
    return newest
