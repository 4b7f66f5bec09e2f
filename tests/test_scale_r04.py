"""The identifier job's single parse and single folder, on rows made here."""

import glob
import json
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from weftwork import jobs
from weftwork.operators.cooccur import IdentifierEntity, PairLink, mapped_pairs, parse_identifiers


def _types(model):
    entities = [IdentifierEntity("phone", model, "number", "tel"), IdentifierEntity("mail", model, "box", "")]
    return entities, [PairLink("mail", "phone", model, "mail_phone", "box", "number")]


def _write(folder, *lines):
    folder.mkdir()
    (folder / "day.txt").write_text("\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines))


def _member(id_type, id_):
    return {"id_type": id_type, "id": id_}


def test_lines_are_parsed_once_for_both_kinds_of_documents(spark, tmp_path, monkeypatch):
    """Documents of one model lie in one folder, which a run of another model replaces; no records are left between."""
    calls = []
    monkeypatch.setattr(jobs, "parse_identifiers", lambda *a: calls.append(a) or parse_identifiers(*a))
    pair = [_member("phone", "1"), _member("mail", "m"), _member("mail", " ")]
    _write(tmp_path / "in", pair, pair, [_member("car", "1")], "no json")
    out = str(tmp_path / "out")
    for model in ("old", "std"):
        jobs.relate_identifiers(spark, str(tmp_path / "in"), *_types(model), "day", out)
    assert len(calls) == 2
    for kind, collection, n in (("entities", "std_entity_index", 4), ("links", "std_relation_index", 2)):
        folder = f"{out}/{kind}/resource=day"
        assert [f.rsplit("/", 1)[1] for f in glob.glob(f"{folder}/*=*")] == [f"collection={collection}"]
        assert glob.glob(f"{folder}/_SUCCESS") and glob.glob(f"{folder}/collection={collection}/_SUCCESS")
        docs = spark.read.parquet(folder)
        assert docs.count() == n and docs.filter(F.col("fields")["_indexed_at_tdt"].isNull()).count() == 0
    ids = {(r["id"], r["entity_id"]) for r in spark.read.parquet(f"{out}/entities").collect()}
    assert ids == {("day@tel~`#1", "tel~`#1"), ("day@m", "m")}
    (between,) = glob.glob(f"{out}/records/*")
    assert spark.read.parquet(between).count() == 0
    counts = spark.read.parquet(f"{out}/history").select("srcCount", "countAfterParseJson", "entityDataCount", "linkDataCount")
    assert [tuple(r) for r in counts.collect()] == [("4", "2", "4", "2")] * 2


@pytest.mark.parametrize("model", ["a/b", "two"])
def test_collections_that_need_folders_of_their_own(spark, tmp_path, model):
    """A name that a folder cannot have as it is, and types of two models, are left to Spark's writer."""
    entities, links = _types(model)
    entities = entities + [IdentifierEntity("imsi", "one" if model == "two" else model, "sim", "s")]
    _write(tmp_path / "in", [_member("phone", "1"), _member("imsi", "2"), _member("mail", "m")])
    jobs.relate_identifiers(spark, str(tmp_path / "in"), entities, links, "day", str(tmp_path / "out"))
    found = {r["collection"] for r in spark.read.parquet(f"{tmp_path}/out/entities").select("collection").collect()}
    assert found == ({"one_entity_index", "two_entity_index"} if model == "two" else {"a/b_entity_index"})


def test_a_run_without_documents(spark, tmp_path):
    _write(tmp_path / "in", [_member("imei", "1")], "no json")
    jobs.relate_identifiers(spark, str(tmp_path / "in"), *_types("std"), "day", str(tmp_path / "out"))
    row = spark.read.parquet(f"{tmp_path}/out/history").first()
    assert (row["status"], row["srcCount"], row["countAfterParseJson"], row["entityDataCount"], row["linkDataCount"]) == (
        "successful", "2", "1", "0", "0",
    )


@pytest.mark.parametrize("block", [1, 2, 4, 128])
def test_members_without_a_link_or_an_id_pair_with_nothing(spark, block):
    """Such members count when an array is cut into blocks, and only then; short and long arrays have the same pairs."""
    arrays = [[_member(("phone", "mail", "imei", "mac")[i % 4], " " if i % 5 == 0 else f"{n}-{i}") for i in range(n)] for n in (1, 3, 9, 14)]
    arrays += [[_member("imei", str(i)) for i in range(9)] + [_member("phone", "p"), _member("mail", "m")], [_member("imei", "1")] * 6]
    lines = spark.createDataFrame([(json.dumps(a),) for a in arrays], "value string")
    useful = [[m for m in a if m["id_type"] in ("phone", "mail") and m["id"].strip()] for a in arrays]
    wanted = Counter((a["id"], b["id"]) for array in useful for a, b in combinations(array, 2) if a["id_type"] != b["id_type"])
    pairs = mapped_pairs(parse_identifiers(lines), _types("std")[1], block)
    assert Counter((r["a"]["id"], r["b"]["id"]) for r in pairs.collect()) == wanted
