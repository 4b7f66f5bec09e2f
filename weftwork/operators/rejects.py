"""Records that give no element, and why."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftwork.constants import KEY_SEPARATOR
from weftwork.functions.keys import flat_record
from weftwork.operators.joins import sized_join

SHORT_KEY = "the key has not four parts led by a number"
UNREADABLE = "the value is no flat JSON object"
UNMAPPED = "no mapping covers the data schema"
INCOMPLETE = "an id or a link end is missing"


def is_message_key(key: Column) -> Column:
    parts = F.split(key, KEY_SEPARATOR)
    return F.coalesce((F.size(parts) >= 4) & F.get(parts, F.lit(0)).try_cast("bigint").isNotNull(), F.lit(False))


def rejected_records(messages: DataFrame, produced: DataFrame, mappings: DataFrame, record: str = "record") -> DataFrame:
    """``key, value, reason`` of the messages without an element.

    ``messages`` hold a ``record`` number, ``produced`` those numbers that gave elements, in a column of that name, and
    ``mappings`` the ``data_schema_id`` that are covered. The first reason that applies is told.
    """
    left = sized_join(messages, produced.select(record).distinct(), [record], "left_anti")
    schema = F.get(F.split("key", KEY_SEPARATOR), F.lit(1))
    covered = mappings.select("data_schema_id").distinct().withColumn("_covered", F.lit(True))
    named = sized_join(left.withColumn("data_schema_id", schema), covered, ["data_schema_id"], "left")
    reason = (
        F.when(~is_message_key(F.col("key")), SHORT_KEY)
        .when(flat_record(F.col("value")).isNull(), UNREADABLE)
        .when(F.col("_covered").isNull(), UNMAPPED)
        .otherwise(INCOMPLETE)
    )
    return named.select("key", "value", reason.alias("reason"))
