"""Search documents of elements, and their delivery to an index."""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftwork.constants import ENTITY, INDEXED_AT_FIELD, PATTERN_ZONE, RESOURCE_QUALIFIER
from weftwork.functions import computed_once
from weftwork.functions.fields import typed_fields
from weftwork.functions.keys import collection_name

STATUS_SCHEMA = "collection string, documents bigint, attempts int, error string"


def search_documents(
    elements: DataFrame,
    patterns: dict[str, list[str]] | None = None,
    zone: str = PATTERN_ZONE,
) -> DataFrame:
    """``id, collection, fields`` of every element.

    With ``patterns`` (property type to date patterns) values follow the rules
    of the streamed load, without them those of the batch load.
    """

    def fixed(names: dict[str, str]) -> Column:
        pairs = [c for name, column in names.items() for c in (F.lit(name), F.col(column))]
        return F.create_map(*pairs)

    common = {RESOURCE_QUALIFIER: "res_id", "owner": "owner"}
    entity = fixed({"id": "row_hash", "entity_id": "element_id", "entity_type": "type_id"} | common)
    ends = {
        name: name
        for name in ("direction_type", "from_entity_id", "from_entity_type", "to_entity_id", "to_entity_type")
    }
    link = fixed({"id": "row_hash", "relation_id": "element_id", "relation_type": "type_id"} | ends | common)
    own = F.when(F.col("kind") == ENTITY, entity).otherwise(link)
    present = F.map_filter(own, lambda _, value: value.isNotNull())
    return computed_once(
        elements,
        [F.col("row_hash").alias("id"), collection_name(F.col("model"), F.col("kind")).alias("collection")],
        {"fields": F.map_concat(present, typed_fields(F.col("body"), patterns, zone))},
    )


def _utc_text(moment: Column) -> Column:
    """A time as text in UTC, whatever the zone of the session, so that later times are greater texts."""
    seconds = (F.unix_micros(moment.cast("timestamp")).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    return (F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)).cast("string")


def index_stamp(indexed_at: Column | None = None) -> dict[str, Column]:
    """The field that says when a document was indexed, in UTC."""
    return {INDEXED_AT_FIELD: _utc_text(F.current_timestamp() if indexed_at is None else indexed_at)}


def stamped(documents: DataFrame, indexed_at: Column | None = None) -> DataFrame:
    """Documents with the time they were indexed, in UTC."""
    text = index_stamp(indexed_at)[INDEXED_AT_FIELD]
    if "fields" in documents.columns and documents.schema["fields"].dataType.valueType.typeName() == "array":
        text = F.array(text)
    stamp = F.create_map(F.lit(INDEXED_AT_FIELD), text)
    fields = F.map_concat("fields", stamp) if "fields" in documents.columns else stamp
    return documents.withColumn("fields", fields)


def latest_documents(documents: DataFrame) -> DataFrame:
    """Of the stored documents the newest of each collection and id, as an index that replaces by id has them."""
    stamp = F.try_element_at("fields", F.lit(INDEXED_AT_FIELD))
    others = [c for c in documents.columns if c not in ("collection", "id")]
    newest = documents.groupBy("collection", "id").agg(F.max_by(F.struct(*others), stamp.cast("string")).alias("_d"))
    return newest.select(*[F.col(c) if c in ("collection", "id") else F.col("_d")[c].alias(c) for c in documents.columns])


def delete_by_query(documents: DataFrame, predicate: Column) -> DataFrame:
    """The documents that remain; one for which the predicate is unknown remains."""
    return documents.filter(~F.coalesce(predicate, F.lit(False)))


def index_documents(
    documents: DataFrame,
    send: Callable[[str, list[dict]], None],
    batch_size: int = 20_000,
    retries: int = 1,
    report_failures: bool = False,
) -> DataFrame:
    """Send documents to an index from the tasks, and return one status row per batch.

    ``send(collection, batch)`` must replace by ``id``, since a task may run
    again. A connection error is tried once more. A batch that still fails
    fails its task, so that nothing is lost unseen; with ``report_failures``
    it becomes a status row with the error instead.
    """

    def attempt(collection: str, batch: list[dict]) -> tuple[int, str | None]:
        for number in range(1, retries + 2):
            try:
                send(collection, batch)
                return number, None
            except OSError as error:  # connection and socket errors
                failure = str(error)
        return retries + 1, failure

    def deliver(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: dict[str, list[dict]] = {}

        def flush(collection: str) -> pd.DataFrame:
            batch = waiting.pop(collection)
            attempts, error = attempt(collection, batch)
            if error and not report_failures:
                raise ConnectionError(f"{collection}: {error}")
            return pd.DataFrame(
                {"collection": [collection], "documents": [len(batch)], "attempts": [attempts], "error": [error]}
            )

        for frame in frames:
            for collection, id_, fields in zip(frame["collection"], frame["id"], frame["fields"]):
                waiting.setdefault(collection, []).append({"id": id_, **dict(fields)})
                if len(waiting[collection]) >= batch_size:
                    yield flush(collection)
        for collection in list(waiting):
            yield flush(collection)

    return documents.select("collection", "id", "fields").mapInPandas(deliver, STATUS_SCHEMA)
