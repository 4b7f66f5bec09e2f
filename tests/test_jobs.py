import json
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from weftwork.constants import ENTITY, LINK
from weftwork.jobs import INCREMENTAL, collect_dossiers, relate_identifiers, relate_mapped, transform_files
from weftwork.operators.cooccur import IdentifierEntity, PairLink
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
from weftwork.plans.rules import DossierRule, Related
from weftwork.sinks.tables import delete_documents, read_documents

MODEL = Model(
    "m",
    (EntityType("person", "human", (Property("code"), Property("name", "text", True))),),
    (LinkType("knows", "person", "person", "human", "human", False, (Property("who"), Property("whom"))),),
)
MAPPINGS = [
    Mapping("people", "m", ENTITY, "person", {"code": "id", "name": "name"}, ("id",)),
    Mapping("pairs", "m", LINK, "knows", {"who": "a", "whom": "b"}, ("a", "b"), ("a",), ("b",)),
    Mapping("absent", "m", ENTITY, "person", {}, ("id",)),
]


def write(path, columns):
    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table(columns), str(path))


@pytest.fixture()
def stored(spark, tmp_path):
    """Elements built from files: two trees, copies, and a file after the cursor."""
    data = tmp_path / "data"
    write(data / "people" / "read" / "10.parquet", {"id": ["1", "2"], "name": ["Ann", "Bob"], "resId": ["r", "r"]})
    write(data / "people" / "compact" / "5.parquet", {"id": ["1", None], "name": ["Ann", "Nobody"], "resId": ["r", "r"]})
    write(data / "people" / "read" / "30.parquet", {"id": ["3"], "name": ["Cid"], "resId": ["r"]})
    write(data / "people" / "read" / "40.parquet", {"id": ["4"], "name": ["Dan"], "resId": ["r"]})
    write(data / "pairs" / "read" / "10.parquet", {"a": ["1", "1", "2"], "b": ["2", "2", ""], "resId": ["r", "r", "r"]})
    table = compiled(mapping_table(spark, *MAPPINGS), definition_table(spark, MODEL))
    out = str(tmp_path / "out")
    transform_files(spark, str(data), table, out, cursor=20)
    return out


def test_transform_stores_each_element_once(spark, stored):
    docs = spark.read.parquet(f"{stored}/documents")
    ids = [r["fields"]["entity_id"] for r in docs.filter("collection = 'm_entity_index'").collect()]
    assert sorted(ids) == ["human~`#1", "human~`#2", "human~`#3"]
    (link,) = docs.filter("collection = 'm_relation_index'").collect()
    assert (link["fields"]["relation_id"], link["fields"]["direction_type"]) == ("knows~`#1~`#2", "0")
    assert "_indexed_at_tdt" in link["fields"]
    assert spark.read.parquet(f"{stored}/cells").select("row_key").distinct().count() == 4
    (entry,) = spark.read.parquet(f"{stored}/history").collect()
    assert (entry["status"], entry["count"], entry["schemas"]) == ("successful", "4", "3")


def test_dossiers_full_then_incremental(spark, stored, tmp_path):
    cells = spark.read.parquet(f"{stored}/cells")
    rule = DossierRule(
        "PERSON", "m", "person", "code", (("name", "d_name"),), relation_fields=(Related("d_knows", "knows", "who", "whom"),)
    )
    out = str(tmp_path / "dossiers")
    collect_dossiers(spark, cells, rule, out)
    found = {r["doc_id"]: r["fields"] for r in spark.read.parquet(f"{out}/documents/PERSON/*").collect()}
    assert all(fields.pop("_indexed_at_tdt") for fields in found.values())
    assert found == {
        "PERSON@1": {"d_name": ["Ann"], "d_knows": ["2"]}, "PERSON@2": {"d_name": ["Bob"]}, "PERSON@3": {"d_name": ["Cid"]},
    }
    later = datetime(2100, 1, 1, tzinfo=timezone.utc)
    collect_dossiers(spark, cells, rule, out, mode=INCREMENTAL, until=later)
    assert spark.read.parquet(f"{out}/documents/PERSON/{int(later.timestamp() * 1000)}").count() == 0
    history = spark.read.parquet(f"{out}/history").select("status", "count")
    assert sorted(map(tuple, history.collect())) == [("successful", "0"), ("successful", "3")]


def test_first_incremental_run_has_no_history(spark, stored, tmp_path):
    rule = DossierRule("PERSON", "m", "person", "code", (("name", "d_name"),), collection="people")
    out = str(tmp_path / "first")
    collect_dossiers(spark, spark.read.parquet(f"{stored}/cells"), rule, out, mode=INCREMENTAL)
    found = spark.read.parquet(f"{out}/documents/PERSON/*")
    assert sorted((r["id"], r["collection"]) for r in found.collect()) == [(f"PERSON@{k}", "people") for k in (1, 2, 3)]


def test_repeated_runs_and_deletion_by_id(spark, stored, tmp_path):
    table = compiled(mapping_table(spark, *MAPPINGS), definition_table(spark, MODEL))
    transform_files(spark, str(tmp_path / "data"), table, stored, cursor=20)
    path = f"{stored}/documents"
    assert spark.read.parquet(path).count() == 8 and read_documents(spark, path).count() == 4
    delete_documents(spark, path, F.try_element_at("fields", F.lit("entity_id")) == "human~`#2")
    left = read_documents(spark, path)
    assert left.count() == 3 and spark.read.parquet(path).filter("collection = 'm_entity_index'").count() == 2
    delete_documents(spark, path, F.col("collection") == "m_relation_index")
    assert {r["collection"] for r in read_documents(spark, path).collect()} == {"m_entity_index"}


def test_a_failure_is_recorded(spark, stored, tmp_path):
    out = str(tmp_path / "failed")
    rule = DossierRule("PERSON", "m", "person", "code", (("name", "d_name"),))
    with pytest.raises(Exception):
        collect_dossiers(spark, spark.range(1), rule, out)
    assert spark.read.parquet(f"{out}/history").first()["status"] == "failure"


def test_identifier_lines(spark, tmp_path):
    lines = [
        [{"id_type": "phone", "id": "1234"}, {"id_type": "mail", "id": "1234@sina.com"}],
        [{"id_type": "car", "id": "1"}],
        [{"id_type": "phone", "id": "1234"}],
    ]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "day.txt").write_text("\n".join(json.dumps(line) for line in lines))
    out = str(tmp_path / "out")
    relate_identifiers(
        spark,
        str(tmp_path / "in"),
        [IdentifierEntity("phone", "std", "phone_number", "phone"), IdentifierEntity("mail", "std", "mail_box", "mail")],
        [PairLink("mail", "phone", "std", "mail_phone", "mail_box", "phone_number")],
        "day",
        out,
    )
    entry = spark.read.parquet(f"{out}/history").first()
    counts = ("srcCount", "countAfterParseJson", "entityDataCount", "linkDataCount")
    assert [entry[c] for c in counts] == ["3", "2", "3", "1"]
    again = spark.read.parquet(f"{out}/entities").count()
    relate_identifiers(
        spark, str(tmp_path / "in"), [IdentifierEntity("phone", "std", "phone_number", "phone"), IdentifierEntity("mail", "std", "mail_box", "mail")],
        [PairLink("mail", "phone", "std", "mail_phone", "mail_box", "phone_number")], "day", out,
    )
    rows = spark.read.parquet(f"{out}/history").select(*counts).collect()
    assert [tuple(r) for r in rows] == [("3", "2", "3", "1")] * 2 and spark.read.parquet(f"{out}/entities").count() == again == 3
    links = spark.read.parquet(f"{out}/links")
    assert links.filter(F.col("collection") == "std_relation_index").first()["id"] == "day@1234@sina.com~`#1234"


def test_mapped_files_of_one_resource(spark, tmp_path):
    data, out = tmp_path / "data", str(tmp_path / "out")
    table = compiled(mapping_table(spark, *MAPPINGS), definition_table(spark, MODEL))
    relate_mapped(spark, str(data), table, "task", out)
    write(data / "people" / "a.parquet", {"id": ["1", "1", None], "name": ["Ann", "Ann", "x"], "resId": ["r", "r", "r"]})
    write(data / "people" / "b.parquet", {"name": ["Bob"], "id": ["2"]})
    write(data / "pairs" / "a.parquet", {"a": ["1", "2"], "b": ["2", " "]})
    for _ in range(2):
        relate_mapped(spark, str(data), table, "task", out)
    relate_mapped(spark, str(data), table, "other", out)
    docs = spark.read.parquet(f"{out}/elements/resource=task").collect()
    assert {r["fields"]["resid"] for r in docs} == {"task"} and len({r["id"] for r in docs}) == 3
    assert sorted(r["fields"].get("entity_id") or "" for r in docs) == ["", "human~`#1", "human~`#1", "human~`#2"]
    entries = spark.read.parquet(f"{out}/history").filter("resourceId = 'task'").collect()
    assert sorted((r["status"], r["srcCount"], r["elementDataCount"]) for r in entries) == [("successful", "0", "0")] + [("successful", "6", "4")] * 2
    assert spark.read.parquet(f"{out}/elements").filter("resource = 'other'").count() == 4
