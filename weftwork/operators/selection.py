"""Which input to take: sequences, replays, lists of resources or watched values, task history."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftwork.constants import TASK_SUCCESSFUL
from weftwork.functions.identity import has_text
from weftwork.operators.joins import sized_join

READ_ALL = -1


def effective_sequences(ids: DataFrame, cursor: int, column: str = "sequence_id") -> DataFrame:
    """Ids below the cursor, and the first id above it unless the cursor itself is one; ``-1`` takes all."""
    distinct = ids.select(column).distinct()
    if cursor == READ_ALL:
        return distinct
    below = distinct.filter(F.col(column) < cursor)
    following = distinct.filter(F.col(column) >= cursor).agg(F.min(column).alias(column))
    return below.unionByName(following.filter(F.col(column) > cursor))


def sorted_sequences(ids: DataFrame, column: str = "sequence_id") -> DataFrame:
    return ids.orderBy(column)


def replay_filter(
    messages: DataFrame,
    changed: DataFrame | None,
    start_sequence: int,
    keys: list[str],
    sequence: str = "sequence_id",
) -> DataFrame:
    """Messages of unchanged types that come after the start; without changed types all pass.

    ``changed`` holds the changed types in the ``keys`` columns.
    """
    if changed is None or changed.isEmpty():
        return messages
    return sized_join(
        messages.filter(F.col(sequence) > start_sequence), changed.select(*keys).distinct(), keys, "left_anti"
    )


def active_watchlist(watchlist: DataFrame, value: str, flag: str = "is_use") -> DataFrame:
    """The distinct values in use."""
    return watchlist.filter(F.col(flag) == 1).select(value).filter(F.col(value).isNotNull()).distinct()


def watched(frame: DataFrame, watchlist: DataFrame, column: str) -> DataFrame:
    """Rows whose value is on the list."""
    (listed,) = watchlist.columns
    return sized_join(frame, watchlist.withColumnRenamed(listed, column), [column], "left_semi")


def distinct_resources(records: DataFrame, column: str = "resId") -> DataFrame:
    return records.select(column).distinct()


def exclude_resources(frame: DataFrame, resources: DataFrame, column: str = "resid") -> DataFrame:
    """Rows with a resource id that is not listed; rows without one go too."""
    (listed,) = resources.columns
    excluded = resources.select(F.col(listed).alias(column)).distinct()
    return sized_join(frame.filter(F.col(column).isNotNull()), excluded, [column], "left_anti")


def with_key(frame: DataFrame, key: str) -> DataFrame:
    """Rows whose key is neither null nor empty."""
    return frame.filter(F.col(key).isNotNull() & (F.col(key) != ""))


def with_identity(frame: DataFrame, columns: list[str]) -> DataFrame:
    """Rows in which every identifying column holds text."""
    complete: Column = F.lit(True)
    for column in columns:
        complete = complete & has_text(F.col(column).cast("string"))
    return frame.filter(complete)


def last_task_time(
    history: DataFrame, doc_type: str, model: str, status: str = TASK_SUCCESSFUL
) -> DataFrame:
    """One row, ``last_sync``: the greatest synchronisation time of the finished tasks, or 0."""
    finished = history.filter(
        (F.col("docType") == doc_type) & (F.col("status") == status) & (F.col("elpModel") == model)
    )
    newest = F.max(F.col("lastSynTimeStamp").try_cast("bigint"))
    return finished.agg(F.coalesce(newest, F.lit(0).cast("bigint")).alias("last_sync"))


def latest_row(frame: DataFrame, order: str, *ties: str) -> DataFrame:
    """The one row with the greatest ``order``, without sorting the frame."""
    row = F.struct(order, *ties, *[c for c in frame.columns if c not in (order, *ties)])
    return frame.agg(F.max(row).alias("_r")).select(*[F.col("_r")[c].alias(c) for c in frame.columns])
