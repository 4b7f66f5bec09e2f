"""Kafka records as message frames, and where a stream starts."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftwork.functions.keys import flat_record, message_key_parts

RECORD_KEY = ["sequence_id", "data_schema_id", "res_id", "task_id"]
ELEMENT_KEY = ["sequence_id", "element_name", "res_id", "task_id"]
ADD, DELETE, MODIFY, OTHER = "ADD", "DELETE", "MODIFY", "OTHER"


@dataclass(frozen=True)
class StartPolicy:
    """``startingOffsets`` of a new query, and whether an old checkpoint must not be resumed.

    Offsets that have expired are raised to the earliest ones left; with ``fail_on_loss`` the query fails instead, so
    that no record is passed over unseen.
    """

    starting_offsets: str
    fresh: bool
    fail_on_loss: bool = False

    def options(self) -> dict[str, str]:
        return {"startingOffsets": self.starting_offsets, "failOnDataLoss": str(self.fail_on_loss).lower()}

    def checkpoint(self, base: str, run_id: str) -> str:
        """Checkpoint folder: the standing one, or a new one when the stream must jump."""
        return f"{base.rstrip('/')}/{run_id if self.fresh else 'standing'}"


def start_policy(operator: str = OTHER, reset: str = "largest", fail_on_loss: bool = False) -> StartPolicy:
    """ADD and MODIFY jump to the latest offsets; otherwise a stream resumes, and ``reset`` decides its first start."""
    if operator in (ADD, MODIFY):
        return StartPolicy("latest", True, fail_on_loss)
    return StartPolicy({"smallest": "earliest", "largest": "latest"}.get(reset, reset), False, fail_on_loss)


def read_kafka(spark: SparkSession, brokers: str, topics: str, policy: StartPolicy, **options) -> DataFrame:
    """Streaming ``topic, key, value`` as text; Spark's checkpoint keeps the offsets and commits after each batch."""
    stream = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topics)
        .options(**policy.options(), **options)
        .load()
    )
    return as_messages(stream)


def as_messages(frame: DataFrame) -> DataFrame:
    """Topic, key and value as text, whichever source they come from."""
    topic = F.col("topic") if "topic" in frame.columns else F.lit(None).cast("string")
    return frame.select(
        topic.alias("topic"), F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")
    )


def raw_columns() -> list[Column]:
    """The parts of a message's key, and its value as a flat map."""
    return [*message_key_parts(F.col("key"), RECORD_KEY), flat_record(F.col("value")).alias("value")]


def raw_records(messages: DataFrame) -> DataFrame:
    """Messages with the key split and the value as a flat map."""
    return messages.select(*raw_columns())
