"""Configuration collections and tables behind JDBC."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_collection(spark: SparkSession, path: str | None = None, fmt: str = "text", **options) -> DataFrame:
    """A collection of documents as JSON text in ``value``; another store is another ``fmt`` with its options."""
    reader = spark.read.format(fmt).options(**options)
    frame = reader.load(path) if path else reader.load()
    if frame.columns == ["value"]:
        return frame
    return frame.select(F.to_json(F.struct("*")).alias("value"))


def matching(collection: DataFrame, name: str, value: str) -> DataFrame:
    """Documents whose top-level ``name`` equals ``value``."""
    return collection.filter(F.get_json_object("value", f"$.{name}") == value)


def jdbc_options(driver: str, url: str, dbtable: str, **options) -> dict[str, str]:
    """Options of a JDBC read; ``dbtable`` is a table or a bracketed subquery with an alias."""
    return {"driver": driver, "url": url, "dbtable": dbtable} | {k: str(v) for k, v in options.items()}


def read_jdbc(spark: SparkSession, driver: str, url: str, dbtable: str, **options) -> DataFrame:
    """A table of a database. Filters on the frame are pushed to it.

    For a large table pass ``partitionColumn``, ``lowerBound``, ``upperBound``
    and ``numPartitions``, or one task reads it all.
    """
    return spark.read.format("jdbc").options(**jdbc_options(driver, url, dbtable, **options)).load()
