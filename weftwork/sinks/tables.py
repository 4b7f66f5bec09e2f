"""Tables of cells, documents, task history and cursors."""

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftwork.operators.documents import delete_by_query, latest_documents, stamped
from weftwork.session import shared_folder
from weftwork.plans.scope import upsert_cursor


def write_cells(cells: DataFrame, path: str, mode: str = "append") -> None:
    """Cells in one folder per table; a reader takes the newest of each qualifier."""
    cells.write.mode(mode).partitionBy("table_name").parquet(path)


def _without_rows(frame: DataFrame) -> DataFrame:
    """The columns of a frame, without the work that makes its rows, nor workers of Python."""
    return frame.sparkSession.range(0, 0, 1, 1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in frame.schema.fields])


#: Columns of documents whose values are too many for a dictionary; it would be built and given up in each file.
_MANY_VALUES = ("id", "entity_id", "relation_id", "from_entity_id", "to_entity_id", "fields.key_value.value")


def write_documents(
    documents: DataFrame,
    path: str,
    mode: str = "append",
    fmt: str = "parquet",
    stamp: bool = True,
    collection: str | None = None,
) -> None:
    """Documents with their index time, in one folder per collection; their ids repeat each other, so Parquet is packed by zstd.

    Without ``stamp`` the documents have their `index_stamp` already. With ``collection`` all are of that one, and go
    straight into its folder: a writer of many folders looks at each row's and copies the row without it.
    """
    documents = stamped(documents) if stamp else documents
    options = {"compression": "zstd"} | {f"parquet.enable.dictionary#{c}": "false" for c in _MANY_VALUES} if fmt == "parquet" else {}

    def put(frame: DataFrame, how: str, **more: str) -> None:
        frame.write.mode(how).partitionBy("collection").format(fmt).options(**options, **more).save(path)

    if collection is None:
        return put(documents, mode)
    if mode not in ("append", "overwrite") or not re.fullmatch(r"[\w.-]+", collection, re.ASCII):  # a folder may need other names
        return put(documents.withColumn("collection", F.lit(collection)), mode)
    empty = _without_rows(documents)
    if mode == "overwrite":  # takes away other collections too
        put(empty, mode, **{"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"})
    documents.drop("collection").write.mode(mode).format(fmt).options(**options).save(f"{path}/collection={collection}")
    put(empty, "append")  # marks the whole as written


RECORDS_A_FILE = 20_000  # readers count 4 MB for opening a file, so many small ones give them many tasks


@contextmanager
def stored_between(frame: DataFrame, path: str) -> Iterator[DataFrame]:
    """The frame stored for steps that each read it; no rows are left there afterwards."""
    spark = frame.sparkSession
    packed = {"compression": "zstd", "parquet.enable.dictionary": "false", "maxRecordsPerFile": RECORDS_A_FILE}
    frame.write.mode("overwrite").options(**packed).parquet(path)
    try:
        yield spark.read.schema(frame.schema).parquet(path)
    finally:
        _without_rows(frame).write.mode("overwrite").parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Stored documents, the newest of each id: what was written again replaces what was there."""
    return latest_documents(spark.read.parquet(path))


def delete_documents(spark: SparkSession, path: str, predicate: Column) -> None:
    """Remove the documents that satisfy the predicate; only the collections that hold some are rewritten.

    What remains is written aside first, so a run that is cut short leaves the stored table or its copy whole.
    """
    stored = read_documents(spark, path)
    touched = [r["collection"] for r in stored.filter(predicate).select("collection").distinct().collect()]
    if not touched:
        return
    remaining = delete_by_query(stored.filter(F.col("collection").isin(touched)), predicate)
    aside = shared_folder(spark, "remaining")
    remaining.write.parquet(aside)
    kept = spark.read.schema(remaining.schema).parquet(aside)
    emptied = [c for c in touched if kept.filter(F.col("collection") == c).isEmpty()]
    kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("collection").parquet(path)
    for collection in emptied:  # a dynamic overwrite leaves partitions without rows as they are
        kept.limit(0).drop("collection").write.mode("overwrite").parquet(f"{path}/collection={collection}")


def write_sized(frame: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a frame in files by its bytes, however many tasks made it and whatever one key weighs.

    Adaptive execution measures the shuffle's partitions, joins small ones and splits large ones at its advisory size.
    """
    frame.hint("rebalance").write.mode(mode).parquet(path)


def write_batch(frame: DataFrame, path: str, batch_id: int) -> None:
    """The output of one micro-batch in a folder of its own, which a batch that runs again replaces."""
    frame.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def append_history(spark: SparkSession, path: str, **entry) -> None:
    """One row of task history: status, counts and times as text."""
    columns = [F.lit(None if v is None else str(v)).cast("string").alias(k) for k, v in entry.items()]
    spark.range(1).select(*columns).write.mode("append").parquet(path)


HISTORY = "docType string, elpModel string, status string, lastSynTimeStamp string"


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The task history; one that does not exist yet has no rows."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], HISTORY)


class CursorStore:
    """Change cursors by version.

    An upsert writes a new folder and then one row that says so. Readers go by
    these rows, so they never see half a cursor, and what a failed run left
    behind is overwritten.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _version(self) -> int:
        try:
            commits = self.spark.read.schema("version int").parquet(f"{self.path}/commits")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0
        return commits.agg(F.max("version")).first()[0] or 0

    def read(self) -> DataFrame | None:
        version = self._version()
        return self.spark.read.parquet(f"{self.path}/v{version}") if version else None

    def upsert(self, new: DataFrame) -> DataFrame:
        version, stored = self._version(), self.read()
        cursor = new if stored is None else upsert_cursor(stored, new)
        cursor.write.mode("overwrite").parquet(f"{self.path}/v{version + 1}")
        committed = self.spark.range(1).select(F.lit(version + 1).alias("version"))
        committed.write.mode("append").parquet(f"{self.path}/commits")
        return self.read()
