"""From raw documents to packed sequences: each stage reads what the one before wrote.

A null text stays null, a row with a null id is never linked, matched or rejected as a copy, and repeated rows of one
document stay together. Columns beyond those the stages name are carried along untouched, whatever their names.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftwork.llm import toxicity
from weftwork.llm.common import free_name, quoted, table, written
from weftwork.llm.decontaminate import contaminated
from weftwork.llm.linededup import without_repeated_lines
from weftwork.llm.minhash import near_duplicates
from weftwork.llm.packing import pack


#: Ids, 8 bytes each, up to which a list of rejected documents is broadcast; a longer one is joined by a shuffle.
BROADCAST_IDS = 1_000_000


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is not among ``ids (doc_id)``."""
    name = free_name("gone", docs)
    gone = written(ids.filter("doc_id is not null").select(F.col("doc_id").alias(name)).distinct(), "rejected")
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone.hint("merge")
    return docs.join(gone, F.col("doc_id") == F.col(name), "left_anti")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches one half go, those with a null id as well."""
    return toxicity.without_toxic(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines go; a document of which nothing is left goes with them. ``n_chars`` follows the text."""
    count = free_name("lines_dropped", docs)
    dropped = F.col(count)
    left = without_repeated_lines(docs, count_column=count).filter((dropped == 0) | (F.trim(F.regexp_replace("text", r"\s+", " ")) != ""))
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(dropped > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return left.select([quoted(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return _without(docs, near_duplicates(docs).filter("not kept"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold most of a benchmark text go."""
    return _without(docs, contaminated(docs, table(spark, sf_dir, "benchmark")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, in sequences of 2048 ids."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("line dedup", line_dedup),
    ("minhash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]

#: None: the stages learn, tile and pack, which SQL cannot state. They are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
