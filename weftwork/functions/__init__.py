"""Column expressions. Everything here is built-in Spark functions; there is no UDF."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(frame: DataFrame, keep: list, columns: dict[str, Column]) -> DataFrame:
    """``keep`` and the new columns, where each of these is computed once per row.

    Spark moves a filter below the select that defines its columns, and adds
    filters below an explode, each time with a copy of the whole expression. It
    does not move one below a generator, so costly columns go through a
    generator of a single row.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return frame.select(*keep, F.inline(F.array(row)))
