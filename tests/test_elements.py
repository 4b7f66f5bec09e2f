import pytest
from pyspark.sql import functions as F

from weftwork.constants import BIDIRECTIONAL, ENTITY, LINK, TARGET_TO_SOURCE
from weftwork.operators.cells import element_cells, latest_cells, scan_cells
from weftwork.operators.documents import delete_by_query, index_documents, search_documents
from weftwork.operators.elements import build_elements, canonical, entities, fan_out, links, union_all, unmapped_schemas
from weftwork.plans.model import (
    EntityType,
    LinkType,
    Mapping,
    Model,
    Property,
    compiled,
    definition_table,
    mapping_table,
)
from weftwork.plans.schemas import ELEMENT_COLUMNS
from weftwork.sinks.messages import element_messages, elements_of, keyed_elements

PERSON = EntityType("person", "human", (Property("name", "text", True), Property("code", "text"), Property("age", "integer")))
KNOWS = LinkType("knows", "person", "person", "human", "human", True, (Property("since", "date"),))
OPEN = LinkType("open", "person", None, "human", "human")
MODEL = Model("m", (PERSON,), (KNOWS, OPEN))
MAPPINGS = [
    Mapping("s", "m", ENTITY, "person", {"name": "n", "code": "c", "age": "missing"}, ("id", "id2")),
    Mapping("s", "m", LINK, "knows", {"since": "d"}, ("id",), ("id",), ("other",), BIDIRECTIONAL, "way", {"<": TARGET_TO_SOURCE}),
    Mapping("s", "m", LINK, "open", {}, ("id",), ("id",), ("other",)),
    Mapping("s", "m", ENTITY, "unknown", {}, ("id",)),
    Mapping("s", "m", ENTITY, "person", {"name": "n"}, ()),
]
ROWS = [
    ("1", "a", "9", "<", "Ann", None, "2024-1-1", "r1", "o"),
    ("2", "b", "8", ">", "Bob", "x", None, "r1", None),
    ("3", " ", "7", None, "Cid", "y", "soon", None, "o"),
    ("4", "d", "", "<", "Dan", "z", "", "r2", "o"),
    (None, "e", "6", "<", "Eve", "z", "", "r2", "o"),
]
COLUMNS = "id string, id2 string, other string, way string, n string, c string, d string, resId string, owner string"


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(ROWS, COLUMNS)


@pytest.fixture(scope="module")
def records(frame):
    pairs = [x for c in frame.columns for x in (F.lit(c), F.col(c))]
    return frame.select(
        F.lit(5).cast("bigint").alias("sequence_id"), F.lit("s").alias("data_schema_id"), F.lit("r").alias("res_id"),
        F.lit("t").alias("task_id"), F.create_map(*pairs).alias("value"),
    )


def plain(frame):
    rows = [tuple(str(sorted(v.items())) if isinstance(v, dict) else v for v in r) for r in frame.collect()]
    return sorted(rows, key=str)


def table_of(spark):
    return compiled(mapping_table(spark, *MAPPINGS), definition_table(spark, MODEL))


def test_the_ways_to_build_agree(spark, frame, records):
    separate = union_all([build_elements(frame, MODEL, [m]) for m in MAPPINGS])
    together = build_elements(frame, MODEL, MAPPINGS)
    written = fan_out(records, table_of(spark))
    joined = fan_out(records, table_of(spark), max_written_out=0)
    assert separate.columns == together.columns == ELEMENT_COLUMNS
    assert written.columns == joined.columns
    assert plain(separate) == plain(together) == plain(canonical(written)) == plain(canonical(joined))


def test_entities_need_a_whole_id(frame):
    found = {r["entity_id"]: r for r in entities(build_elements(frame, MODEL, MAPPINGS)).collect()}
    assert sorted(found) == ["human~`#1~`#a", "human~`#2~`#b", "human~`#4~`#d"]
    assert found["human~`#2~`#b"]["owner"] == ""
    body = {k: tuple(v) for k, v in found["human~`#2~`#b"]["body"].items()}
    assert body == {"name": ("Bob", "text"), "code": ("x", "string")}


def test_links_need_both_ends_and_swap_them_with_their_types(frame):
    found = {r["relation_id"]: r for r in links(build_elements(frame, MODEL, MAPPINGS)).collect()}
    assert sorted(found) == ["knows~`#1", "knows~`#2", "knows~`#3"]
    assert (found["knows~`#1"]["from_entity_id"], found["knows~`#1"]["direction_type"]) == ("human~`#9", "1")
    assert (found["knows~`#2"]["from_entity_id"], found["knows~`#2"]["direction_type"]) == ("human~`#2", "2")
    assert found["knows~`#3"]["row_key"] == "null@knows~`#3"


def test_fixed_resource_and_no_mapping(frame):
    built = build_elements(frame, MODEL, MAPPINGS[:1], res_id=F.lit("fixed"), owner=F.lit(None))
    assert {r["res_id"] for r in built.collect()} == {"fixed"}
    assert build_elements(frame, MODEL, MAPPINGS[2:4]).isEmpty()


def test_outputs_are_at_most_records_times_mappings(spark, records):
    assert fan_out(records, table_of(spark)).count() <= records.count() * len(MAPPINGS)


def test_unmapped(spark, records):
    assert unmapped_schemas(records, mapping_table(spark, *MAPPINGS)).isEmpty()
    other = records.withColumn("data_schema_id", F.lit("other"))
    assert [r[0] for r in unmapped_schemas(other, mapping_table(spark, *MAPPINGS)).collect()] == ["other"]


def test_messages_and_back(spark, records):
    built = fan_out(records, table_of(spark))
    keyed = keyed_elements(element_messages(built))
    assert {r["element_name"] for r in keyed.collect()} == {"m_entity_person", "m_relation_knows"}
    assert {(r["sequence_id"], r["res_id"], r["task_id"]) for r in keyed.collect()} == {(5, "r", "t")}
    assert plain(canonical(elements_of(keyed))) == plain(canonical(built))


def test_cells_and_back(frame):
    built = build_elements(frame, MODEL, MAPPINGS)
    cells = element_cells(built, F.lit("2024-01-01 00:00:00").cast("timestamp"))
    newer = element_cells(
        build_elements(frame.withColumn("n", F.upper("n")), MODEL, MAPPINGS), F.lit("2024-01-02 00:00:00").cast("timestamp")
    )
    both = cells.unionByName(newer)
    rows = scan_cells(both, "m_entity_person", ["entity_id", "name", "code"])
    assert {(r["entity_id"], r["name"], r["code"]) for r in rows.collect()} == {
        ("human~`#1~`#a", "ANN", None), ("human~`#2~`#b", "BOB", "x"), ("human~`#4~`#d", "DAN", "z"),
    }
    early = scan_cells(both, "m_entity_person", ["name"], max_ts=F.lit("2024-01-02 00:00:00").cast("timestamp"))
    assert {r["name"] for r in early.collect()} == {"Ann", "Bob", "Dan"}
    newest = latest_cells(both)
    assert newest.count() == cells.count()
    assert newest.filter("qualifier = 'name' and value = 'ANN'").count() == 1


def test_documents_and_deletion(frame):
    docs = search_documents(build_elements(frame, MODEL, MAPPINGS), {"date": ["yyyy"]})
    assert {r["collection"] for r in docs.collect()} == {"m_entity_index", "m_relation_index"}
    left = delete_by_query(docs, F.try_element_at("fields", F.lit("g_tk11_code")) == "x")
    assert left.count() == docs.count() - 1


def test_index_delivery_retries_and_reports(spark, tmp_path):
    docs = spark.range(25).repartition(1).select(
        F.lit("c").alias("collection"), F.col("id").cast("string").alias("id"), F.create_map(F.lit("f"), F.lit("v")).alias("fields")
    )
    folder = str(tmp_path)

    def flaky(collection, batch):
        import os

        name = f"{folder}/{batch[0]['id']}"
        if not os.path.exists(name):
            open(name, "w").close()
            raise ConnectionError("busy")

    rows = index_documents(docs, flaky, batch_size=10).collect()
    assert sorted((r["documents"], r["attempts"], r["error"]) for r in rows) == [(5, 2, None), (10, 2, None), (10, 2, None)]

    def down(collection, batch):
        raise ConnectionError("down")

    rows = index_documents(docs, down, batch_size=10, report_failures=True).collect()
    assert {r["error"] for r in rows} == {"down"}
    with pytest.raises(Exception, match="down"):
        index_documents(docs, down, batch_size=10).collect()


def scans(frame) -> int:
    return frame._jdf.queryExecution().executedPlan().toString().count("FileScan")


def test_sixty_mappings_are_one_scan(spark, frame, tmp_path):
    frame.write.parquet(f"{tmp_path}/t")
    stored = spark.read.parquet(f"{tmp_path}/t")
    mappings = [m for _ in range(60) for m in MAPPINGS][:60]
    built = build_elements(stored, MODEL, mappings)
    assert scans(built) == 1
    assert built.count() == sum(build_elements(stored, MODEL, [m]).count() for m in mappings)
