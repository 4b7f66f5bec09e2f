"""Counts per task, metric records, and size estimates."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftwork.constants import LOAD_METRIC, TRANSFORM_METRIC

TASK_KEYS = ["res_id", "task_id"]


def count_by(frame: DataFrame, keys: list[str], name: str = "records") -> DataFrame:
    return frame.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def reconcile(inputs: DataFrame, outputs: DataFrame, keys: list[str] = TASK_KEYS) -> DataFrame:
    """Records in and elements out of each task; a task without output counts zero.

    Both sides are counted by one aggregation over their union.
    """
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    counted = inputs.select(*keys, one.alias("_in"), none.alias("_out")).unionByName(
        outputs.select(*keys, none.alias("_in"), one.alias("_out"))
    )
    totals = counted.groupBy(*keys).agg(
        F.sum("_in").alias("in_total_records"), F.sum("_out").alias("out_total_records")
    )
    return totals.filter(F.col("in_total_records") > 0)


def counts_by_type(frame: DataFrame, type_column: str, keys: list[str] = TASK_KEYS) -> DataFrame:
    return count_by(frame, [*keys, type_column], "count")


def nested_counts(counts: DataFrame, type_column: str, keys: list[str] = TASK_KEYS) -> DataFrame:
    """Per task its ``(type, count)`` list and total; a list has one entry per element type of the model."""
    entry = F.struct(F.col(type_column).alias("elp_type"), F.col("count"))
    return counts.groupBy(*keys).agg(
        F.array_sort(F.collect_list(entry)).alias("elp_type_statistic"), F.sum("count").alias("in_total_records")
    )


def metric_records(
    totals: DataFrame, name: str, start_time: Column, record_time: Column | None = None
) -> DataFrame:
    """Metric rows from the totals of `reconcile` or `nested_counts`."""
    has_types = "elp_type_statistic" in totals.columns
    out = "out_total_records" if "out_total_records" in totals.columns else "in_total_records"
    types = F.col("elp_type_statistic") if has_types else F.lit(None)
    return totals.select(
        F.lit(name).alias("metric_name"),
        "task_id",
        "res_id",
        "in_total_records",
        F.col(out).alias("out_total_records"),
        types.cast("array<struct<elp_type:string,count:bigint>>").alias("elp_type_statistic"),
        (F.current_timestamp() if record_time is None else record_time).alias("record_time"),
        start_time.alias("start_time"),
        F.lit(None).cast("timestamp").alias("end_time"),
    )


def transform_metrics(inputs: DataFrame, outputs: DataFrame, start_time: Column) -> DataFrame:
    return metric_records(reconcile(inputs, outputs), TRANSFORM_METRIC, start_time)


def load_metrics(elements: DataFrame, type_column: str, start_time: Column) -> DataFrame:
    return metric_records(nested_counts(counts_by_type(elements, type_column), type_column), LOAD_METRIC, start_time)


def stage_counts(frame: DataFrame, stages: dict[str, Column]) -> DataFrame:
    """How many rows reach each stage, from one pass; a stage is a condition on the row."""
    return frame.agg(*[F.count_if(condition).alias(name) for name, condition in stages.items()])


def record_bytes(columns: list[str]) -> Column:
    """Bytes of a record: the text of its columns."""
    sizes = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in columns]
    total = sizes[0]
    for size in sizes[1:]:
        total = total + size
    return total.cast("bigint")


def size_estimate(frame: DataFrame, columns: list[str], block_mb: int = 256) -> DataFrame:
    """Row count, average record bytes, total megabytes and the partitions of ``block_mb`` they need."""
    measured = frame.agg(
        F.count(F.lit(1)).alias("total_count"), F.coalesce(F.sum(record_bytes(columns)), F.lit(0)).alias("_bytes")
    )
    average = F.when(F.col("total_count") > 0, F.floor(F.col("_bytes") / F.col("total_count"))).otherwise(F.lit(0))
    return (
        measured.select("total_count", average.cast("bigint").alias("avg_bytes"))
        .withColumn("total_mb", F.floor(F.col("total_count") * F.col("avg_bytes") / (1024 * 1024)).cast("bigint"))
        .withColumn("partitions", F.floor(F.col("total_mb") / block_mb).cast("bigint"))
    )


def sized_partitions(
    total_mb: int, current: int, block_mb: int = 256, large_mb: int = 10_240, many: int = 20
) -> int:
    """Partition count to write with: by block size when the data is large or already in many partitions."""
    if (total_mb > large_mb or current > many) and total_mb > block_mb:
        return total_mb // block_mb
    return current


def one_per_partition(frame: DataFrame) -> DataFrame:
    """One row of every non-empty partition; a task sends a single row."""
    row = F.struct(*frame.columns)
    return frame.groupBy(F.spark_partition_id().alias("partition")).agg(F.first(row).alias("_r")).select(
        "partition", "_r.*"
    )
