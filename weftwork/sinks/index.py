"""A stored index of documents, written by Spark as a data source of its own.

``documents.write.format("document_index").option("path", …).mode("append").save()`` puts documents in place: one written
again replaces what its collection and id held. Every task writes a file of its own and sends its name to the driver as
the commit message. The driver then writes one entry of the commit log, which names the files that count. So a task that
runs again, a job that fails, and a reader at the same time never show half a write: files no entry names are nobody's.

A reader takes of each collection and id the row of the newest entry; a row marked ``deleted`` takes its document out. Of
several rows of one write the greatest in the order of a hash counts. ``mode("overwrite")`` hides all earlier entries.
"""

import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from weftwork.operators.joins import sized_join

FORMAT = "document_index"
_LOG = "written_at bigint, write string, replaces boolean, files array<string>"
_KEYS = ["collection", "id"]


def _filesystem(path: str):
    """The store of a path or address, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if ":" in path.split("/")[0] else (fs.LocalFileSystem(), path)


@dataclass
class _Part(WriterCommitMessage):
    """The file that a task has written, none if it had no rows."""

    file: str | None


class _IndexWriter(DataSourceArrowWriter):
    def __init__(self, path: str, replaces: bool):
        self._path, self._replaces, self._write = path.rstrip("/"), replaces, uuid.uuid4().hex

    def write(self, iterator: Iterator) -> _Part:
        import pyarrow.parquet as pq

        context = TaskContext.get()
        store, base = _filesystem(self._path)
        file, writer = f"{self._write}-{context.partitionId()}-{context.taskAttemptId()}.parquet", None
        for batch in iterator:
            if not batch.num_rows:
                continue
            if writer is None:
                store.create_dir(f"{base}/data", recursive=True)
                writer = pq.ParquetWriter(f"{base}/data/{file}", batch.schema, filesystem=store, compression="zstd")
            writer.write_batch(batch)
        if writer is None:
            return _Part(None)
        writer.close()
        return _Part(file)

    def commit(self, messages: list) -> None:
        entry = {
            "written_at": time.time_ns(),
            "write": self._write,
            "replaces": self._replaces,
            "files": [m.file for m in messages if m and m.file],
        }
        store, base = _filesystem(self._path)
        store.create_dir(f"{base}/log", recursive=True)
        with store.open_output_stream(f"{base}/log/_{self._write}") as out:
            out.write(json.dumps(entry).encode())
        store.move(f"{base}/log/_{self._write}", f"{base}/log/{self._write}.json")  # readers see whole entries only

    def abort(self, messages: list) -> None:
        """Take away what the write's tasks have left so far; a task that is still ending may leave a file nobody names."""
        from pyarrow import fs

        store, base = _filesystem(self._path)
        for found in store.get_file_info(fs.FileSelector(f"{base}/data", allow_not_found=True)):
            if found.base_name.startswith(self._write):
                store.delete_file(found.path)


class DocumentIndex(DataSource):
    """The write side of the index; reading is `read_index`, on Spark's own Parquet reader."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> _IndexWriter:
        missing = set(_KEYS) - set(schema.fieldNames())
        if missing:
            raise ValueError(f"documents lack {sorted(missing)}")
        return _IndexWriter(self.options["path"], overwrite)


def write_index(documents: DataFrame, path: str, mode: str = "append") -> None:
    """Put documents ``(collection, id, …)`` in place, all or none; ``overwrite`` replaces the whole index."""
    documents.sparkSession.dataSource.register(DocumentIndex)
    documents.write.format(FORMAT).option("path", path).mode(mode).save()


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """All rows that count, with ``_version``; None where nothing is committed."""
    try:
        log = spark.read.schema(_LOG).json(f"{path.rstrip('/')}/log")
        last = log.filter("replaces").agg(F.max("written_at")).first()[0] or 0
        files = log.filter(F.col("written_at") >= last).select(
            F.explode("files").alias("_file"), F.struct("written_at", "write").alias("_version")
        )
        if files.isEmpty():
            return None
        rows = spark.read.option("mergeSchema", "true").parquet(f"{path.rstrip('/')}/data")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return sized_join(rows.withColumn("_file", F.col("_metadata.file_name")), files, ["_file"]).drop("_file")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The documents of the index, each once; one that does not exist yet has none."""
    rows = _stored(spark, path)
    if rows is None:
        return spark.createDataFrame([], "collection string, id string, fields map<string,string>")
    if "deleted" not in rows.columns:
        rows = rows.withColumn("deleted", F.lit(False))
    values = [c for c in rows.columns if c not in (*_KEYS, "deleted", "_version")]
    tie = F.xxhash64(F.to_json(F.struct(*values))) if values else F.lit(0)
    newest = rows.groupBy(*_KEYS).agg(F.max_by(F.struct("deleted", *values), F.struct("_version", tie)).alias("_d"))
    present = newest.filter(~F.coalesce(F.col("_d.deleted"), F.lit(False)))
    return present.select(*_KEYS, *[F.col("_d")[c].alias(c) for c in values])


def delete_from_index(spark: SparkSession, path: str, predicate: Column) -> None:
    """Take out the documents that satisfy the predicate; what is written is their keys."""
    gone = read_index(spark, path).filter(predicate).select(*_KEYS, F.lit(True).alias("deleted"))
    write_index(gone, path)
