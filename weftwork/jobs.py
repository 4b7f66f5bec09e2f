"""The batch jobs from end to end: transform, co-occurrence, dossiers.

Each writes its tables and one row of task history, which says how it ended
also when it fails.
"""

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from weftwork.constants import ENTITY, LINK
from weftwork.operators.cells import element_cells
from weftwork.operators.cooccur import (
    IdentifierEntity,
    PairLink,
    identifier_entities,
    one_collection,
    pair_links,
    parse_identifiers,
)
from weftwork.operators.dedup import dedup_by_key
from weftwork.operators.documents import index_stamp, search_documents, stamped
from weftwork.operators.dossier import build_dossiers, cell_reader
from weftwork.operators.elements import build_mapped, declared, union_all
from weftwork.operators.selection import READ_ALL, last_task_time
from weftwork.plans.rules import DossierRule
from weftwork.sinks.celltable import NOTHING_MERGED, merge_batches
from weftwork.sinks.tables import append_history, read_history, stored_between, write_cells, write_documents, write_sized
from weftwork.sources.files import load_files, read_sequence, read_text_lines

FULL, INCREMENTAL = "FULL", "INC"
TREES = ("read", "compact")


@contextmanager
def task_history(spark: SparkSession, path: str, **entry) -> Iterator[dict]:
    """A history row that is filled while a task runs and written when it ends."""
    entry |= {"startTime": datetime.now(timezone.utc).isoformat(), "status": "running"}
    try:
        yield entry
        entry["status"] = "successful"
    except Exception as error:
        entry |= {"status": "failure", "errorMsg": str(error)}
        raise
    finally:
        entry["endTime"] = datetime.now(timezone.utc).isoformat()
        append_history(spark, path, **entry)


def _trees(spark: SparkSession, folder: str, cursor: int, fmt: str, extension: str) -> DataFrame | None:
    """The chosen files of the trees of a schema; a tree may be absent or empty."""
    frames = []
    for tree in TREES:
        try:
            frames.append(read_sequence(spark, f"{folder}/{tree}", cursor, fmt, extension))
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
    return union_all(frames) if frames else None


def transform_files(
    spark: SparkSession,
    data_path: str,
    compiled_mappings: DataFrame,
    out: str,
    cursor: int = READ_ALL,
    fmt: str = "parquet",
    extension: str = ".parquet",
) -> None:
    """Files of each data schema to deduplicated elements, stored as cells and as documents.

    A run that repeats another writes the same ids again; `sinks.tables.read_documents` and `operators.cells` give the
    newest of each.

    A schema is a folder with the trees ``read`` and ``compact`` of sequence
    files. The mappings are those in scope, see `plans.scope.task_scope`; they
    are configuration, and are collected.
    """
    with task_history(spark, f"{out}/history", task="transform", cursor=cursor) as entry:
        by_schema: dict[str, list] = {}
        for row in compiled_mappings.collect():
            by_schema.setdefault(row["data_schema_id"], []).append(declared(row))
        built = []
        for schema_id, plans in sorted(by_schema.items()):
            frame = _trees(spark, f"{data_path}/{schema_id}", cursor, fmt, extension)
            if frame is not None:
                built.append(build_mapped(frame, plans))
        entry["schemas"] = len(by_schema)
        if not built:
            return
        elements = dedup_by_key(union_all(built), ["model", "kind", "type_id", "row_key"])
        elements = elements.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_cells(element_cells(elements), f"{out}/cells")
            write_documents(search_documents(elements), f"{out}/documents")
            entry["count"] = elements.count()
        finally:
            elements.unpersist()


def compact_cells(spark: SparkSession, out: str, period: str = "month") -> None:
    """The cells of a load stream's batches, merged into one table of cells; a run takes what came since the last one.

    The batches stay; those up to the one before the last merged, as the history has it, may be deleted.
    """
    history = read_history(spark, f"{out}/cell-history")
    last = None
    if "merged" in history.columns:
        last = history.filter("status = 'successful'").agg(F.max(F.col("merged").cast("long"))).first()[0]
    with task_history(spark, f"{out}/cell-history", task="cells") as entry:
        entry["merged"] = merge_batches(spark, f"{out}/cells", f"{out}/cell-table", NOTHING_MERGED if last is None else last, period)


def relate_identifiers(
    spark: SparkSession,
    path: str,
    entity_types: list[IdentifierEntity],
    links: list[PairLink],
    res_id: str,
    out: str,
    extension: str = ".txt",
) -> None:
    """Identifier lines to entity and pair-link documents, with the counts of every stage.

    Lines are parsed once; their records are stored packed for both kinds of documents, and given up afterwards. The
    documents of a resource replace those of an earlier run. The counts are those of this run, observed while the
    documents are written.
    """
    with task_history(spark, f"{out}/history", tableName="relation", resourceId=res_id) as entry:
        one = F.count(F.lit(1)).alias("n")
        seen = {name: Observation(name) for name in ("srcCount", "countAfterParseJson", "entityDataCount", "linkDataCount")}
        records = parse_identifiers(read_text_lines(spark, path, extension).observe(seen["srcCount"], one))
        between = f"{out}/records/{hashlib.md5(str(res_id).encode()).hexdigest()}"
        with stored_between(records.observe(seen["countAfterParseJson"], one), between) as parsed:
            found = identifier_entities(parsed, entity_types, res_id).observe(seen["entityDataCount"], one)
            write_documents(
                found, f"{out}/entities/resource={res_id}", mode="overwrite", collection=one_collection(entity_types, ENTITY)
            )
            linked = pair_links(parsed, links, res_id, more=index_stamp()).observe(seen["linkDataCount"], one)
            write_documents(
                linked, f"{out}/links/resource={res_id}", mode="overwrite", stamp=False, collection=one_collection(links, LINK)
            )
        entry |= {name: observation.get["n"] for name, observation in seen.items()}


def relate_mapped(
    spark: SparkSession,
    path: str,
    compiled_mappings: DataFrame,
    res_id: str,
    out: str,
    fmt: str = "parquet",
    **options,
) -> None:
    """Files of mapped schemas, a folder for each, to documents of one resource, with the counts of the run.

    The task names the resource; one that the records have is not asked for. Elements that come more than once are stored
    as often, as those of identifier lines are, and readers take one of each id. The documents of a resource replace those
    of an earlier run; a schema without a folder gives none. The mappings are configuration, and are collected.
    """
    with task_history(spark, f"{out}/history", tableName="mapped", resourceId=res_id) as entry:
        by_schema: dict[str, list] = {}
        for row in compiled_mappings.collect():
            by_schema.setdefault(row["data_schema_id"], []).append(declared(row))
        one = F.count(F.lit(1)).alias("n")
        read, made = [], Observation("elementDataCount")
        built = []
        for schema_id, plans in sorted(by_schema.items()):
            try:
                frame = load_files(spark, f"{path}/{schema_id}", fmt, **options)
            except AnalysisException as error:
                if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                    raise
                continue
            if not frame.columns:
                continue
            read.append(Observation(f"source {schema_id}"))
            built.append(build_mapped(frame.observe(read[-1], one), plans, F.lit(res_id), F.lit(None).cast("string")))
        entry |= {"srcCount": 0, "elementDataCount": 0}
        if built:
            documents = search_documents(union_all(built)).observe(made, one)
            write_documents(documents, f"{out}/elements/resource={res_id}", mode="overwrite")
            entry |= {"srcCount": sum(seen.get["n"] for seen in read), "elementDataCount": made.get["n"]}


def collect_dossiers(
    spark: SparkSession,
    cells: DataFrame,
    rule: DossierRule,
    out: str,
    resources: DataFrame | None = None,
    mode: str = FULL,
    until: datetime | None = None,
) -> None:
    """Documents of a rule from the cells up to a time; INC starts where the last finished task stopped."""
    until = until or datetime.now(timezone.utc)
    millis = int(until.timestamp() * 1000)
    history = f"{out}/history"
    with task_history(
        spark, history, docType=rule.doc_type, elpModel=rule.model, elpType=rule.root_type, lastSynTimeStamp=millis
    ) as entry:
        since = 0
        if mode == INCREMENTAL:
            since = last_task_time(read_history(spark, history), rule.doc_type, rule.model).first()["last_sync"]
        bounds = [F.timestamp_millis(F.lit(t)) for t in (since, millis)]
        documents = build_dossiers(cell_reader(cells, rule.model, *bounds), rule, resources)
        write_sized(stamped(documents), f"{out}/documents/{rule.doc_type}/{millis}")
        entry["count"] = spark.read.parquet(f"{out}/documents/{rule.doc_type}/{millis}").count()
