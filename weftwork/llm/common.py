"""What several operators of this subpackage share: tables, intermediate tables, session ids."""

from pyspark.sql import DataFrame, SparkSession

from weftwork.session import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame written once to the shared folder and read back, which cuts its lineage and survives lost executors."""
    spark = frame.sparkSession
    path = shared_folder(spark, purpose)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def free_name(name: str, frame: DataFrame) -> str:
    """``name``, led by as many underscores as it takes to be no column of the frame."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def quoted(name: str) -> str:
    """A column name of any characters as an expression."""
    return "`" + name.replace("`", "``") + "`"
