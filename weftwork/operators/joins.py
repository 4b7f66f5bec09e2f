"""Joins whose broadcast is decided by a size that is measured up to a bound, with an adaptive join beyond it."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def fits_broadcast(
    frame: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> bool:
    """Whether rows and the bytes of their JSON text stay within the bounds; no more rows than that are looked at."""
    measured = frame.limit(max_rows + 1).agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0)).alias("bytes"),
    ).first()
    return measured["rows"] <= max_rows and measured["bytes"] <= max_bytes


def adaptive_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join of two sides whose sizes are known at run time only.

    Adaptive execution broadcasts a side that turns out small, and splits the
    partitions of hot keys. It splits only where both sides are shuffled for
    this very join. A side that an aggregation has left partitioned by the keys
    would not be, so the join gets one more key, computed from the others.
    """
    extra = F.xxhash64(*keys)
    joined = left.withColumn("_key_hash", extra).join(right.withColumn("_key_hash", extra), [*keys, "_key_hash"], how)
    return joined.drop("_key_hash")


def sized_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "inner",
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Broadcast the right side when it is small, as measured up to the bound, else `adaptive_join`.

    A streaming left side gets no hint: a size measured now would not hold for
    later micro-batches, so Spark decides for each batch from the statistics.
    """
    if left.isStreaming:
        return left.join(right, keys, how)
    if fits_broadcast(right, max_rows, max_bytes):
        return left.join(F.broadcast(right), keys, how)
    return adaptive_join(left, right, keys, how)
