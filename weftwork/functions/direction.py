"""Which way a link points."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from weftwork.constants import (
    BIDIRECTIONAL,
    CODE_ONE_WAY,
    CODE_TWO_WAY,
    CODE_UNDIRECTED,
    NOT_DIRECTED,
    SOURCE_TO_TARGET,
    TARGET_TO_SOURCE,
)
from weftwork.functions.identity import as_column


def _decided_by_column(directivity: Column) -> Column:
    fixed = directivity.isin(NOT_DIRECTED, SOURCE_TO_TARGET, TARGET_TO_SOURCE)
    return ~F.coalesce(fixed, F.lit(False))


def is_reversed(directed, directivity, column_result) -> Column:
    """True when the ends swap: a directed link that points from target to source."""
    directivity = as_column(directivity)
    by_mapping = F.coalesce(directivity == TARGET_TO_SOURCE, F.lit(False))
    by_column = F.coalesce(as_column(column_result) == TARGET_TO_SOURCE, F.lit(False))
    return as_column(directed) & (by_mapping | (_decided_by_column(directivity) & by_column))


def direction_code(directed, directivity, column_result) -> Column:
    """The stored code: ``0`` undirected, ``1`` one way, ``2`` two ways."""
    directivity = as_column(directivity)
    decided = F.when(
        _decided_by_column(directivity),
        F.coalesce(as_column(column_result).cast("string"), directivity),
    ).otherwise(F.lit(SOURCE_TO_TARGET))
    return (
        F.when(~as_column(directed), F.lit(CODE_UNDIRECTED))
        .when(decided == NOT_DIRECTED, F.lit(CODE_UNDIRECTED))
        .when(decided == BIDIRECTIONAL, F.lit(CODE_TWO_WAY))
        .otherwise(F.lit(CODE_ONE_WAY))
    )
