"""One row per key, always the same one."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _comparable(frame: DataFrame, name: str) -> Column:
    """A map as its sorted entries, since maps have no order."""
    if isinstance(frame.schema[name].dataType, T.MapType):
        return F.array_sort(F.map_entries(name))
    return F.col(name)


def dedup_by_key(
    frame: DataFrame, keys: list[str], order_by: list[str | Column] = (), keep: str = "last"
) -> DataFrame:
    """The greatest row per key by ``order_by``, then by the remaining columns; ``keep='first'`` takes the least.

    It is an aggregate, not a window: copies collapse before the shuffle, so a
    key with a third of all rows sends one row per map task.
    """
    payload = [c for c in frame.columns if c not in keys]
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    row = F.struct(
        *[o.alias(f"_o{i}") for i, o in enumerate(order)],
        *[_comparable(frame, c).alias(c) for c in payload],
    )
    choose = F.max if keep == "last" else F.min
    chosen = frame.groupBy(*keys).agg(choose(row).alias("_row"))

    def restored(name: str) -> Column:
        value = F.col("_row")[name]
        if isinstance(frame.schema[name].dataType, T.MapType):
            value = F.map_from_entries(value)
        return value.alias(name)

    return chosen.select(*[F.col(c) if c in keys else restored(c) for c in frame.columns])


def distinct_payloads(frame: DataFrame, type_column: str, payload: str) -> DataFrame:
    """Each payload once per type."""
    return frame.select(type_column, payload).distinct()
