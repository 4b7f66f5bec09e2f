import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from weftwork.constants import ENTITY, LINK
from weftwork.operators.dossier import (
    build_dossiers,
    cell_reader,
    combined,
    documents,
    element_reader,
    field_values,
    join_properties,
    table_reader,
    two_hop,
)
from weftwork.operators.elements import build_elements
from weftwork.operators.cells import element_cells
from weftwork.plans.model import EntityType, LinkType, Mapping, Model, Property
from weftwork.plans.rules import DossierRule, Extension, Related, load_rule, rule_from_json

VALUES = "doc_key string, field string, value string, copies bigint"


def as_dict(docs):
    """doc_id -> field -> all values over all parts."""
    found = {}
    for row in docs.collect():
        fields = found.setdefault(row["doc_id"], {})
        for field, values in row["fields"].items():
            fields.setdefault(field, []).extend(values)
    return {doc: {f: sorted(v) for f, v in fields.items()} for doc, fields in found.items()}


@pytest.mark.parametrize("part_size", [1, 3, 10, 1000])
def test_parts_keep_every_value_and_stay_small(spark, part_size):
    """Key a holds most values, one of them 50 times; key c has none; key d is unknown."""
    rows = [("a", "f", f"v{i}", 1) for i in range(40)] + [("a", "g", "same", 50), ("b", "f", "x", 2), ("d", "f", "y", 1)]
    values = spark.createDataFrame(rows, VALUES)
    keys = spark.createDataFrame([("a",), ("b",), ("c",)], "doc_key string")
    docs = documents(keys, values, "T", part_size).cache()
    assert as_dict(docs) == {
        "T@a": {"f": sorted(f"v{i}" for i in range(40)), "g": ["same"] * 50},
        "T@b": {"f": ["x", "x"]},
        "T@c": {},
    }
    assert docs.groupBy("doc_id", "part").count().filter("count > 1").isEmpty()
    if part_size == 10:
        sizes = [r["n"] for r in field_values(docs).groupBy("doc_id", "part").agg(F.sum(F.size("values")).alias("n")).collect()]
        assert max(sizes) < 60 and len(sizes) > 4


def test_two_hop_keeps_every_root_and_multiplies_copies(spark):
    read = table_reader(
        {
            (LINK, "rel"): spark.createDataFrame(
                [("k1", "m", "r"), ("k1", "m", "r"), ("k2", "m", "r"), ("k3", "none", "r"), ("", "m", "r"), (None, "m", "r")],
                "key string, via string, resid string",
            ),
            (ENTITY, "acc"): spark.createDataFrame(
                [("m", "q1", "r"), ("m", "q1", "r"), ("m", "q2", "r"), ("other", "q3", "r"), ("m", None, "r")],
                "via string, name string, resid string",
            ),
        }
    )
    extension = Extension(Related("l1", "rel", "key", "via"), (Related("l2", "acc", "via", "name"),))
    found = {tuple(r)[:3]: r["copies"] for r in combined(two_hop(read, extension)).collect()}
    assert found == {
        ("k1", "l1", "m"): 2, ("k2", "l1", "m"): 1, ("k3", "l1", "none"): 1,
        ("k1", "l2", "q1"): 4, ("k1", "l2", "q2"): 2, ("k2", "l2", "q1"): 2, ("k2", "l2", "q2"): 1,
    }


def test_two_hop_equals_brute_force_on_a_shared_value(spark):
    links = [(f"k{i % 11}", "hot" if i % 3 else f"v{i % 7}") for i in range(60)]
    accounts = [("hot" if i % 2 else f"v{i % 7}", f"a{i % 5}") for i in range(40)]
    read = table_reader(
        {
            (LINK, "rel"): spark.createDataFrame([(*r, "r") for r in links], "key string, via string, resid string"),
            (ENTITY, "acc"): spark.createDataFrame([(*r, "r") for r in accounts], "via string, name string, resid string"),
        }
    )
    extension = Extension(Related("l1", "rel", "key", "via"), (Related("l2", "acc", "via", "name"),))
    expected = Counter((k, "l1", v) for k, v in links)
    expected.update((k, "l2", name) for k, v in links for via, name in accounts if via == v)
    assert {tuple(r)[:3]: r["copies"] for r in combined(two_hop(read, extension)).collect()} == expected


def test_join_properties_is_a_left_join(spark):
    root = spark.createDataFrame([("a", "f", "1", 1), ("b", "f", "2", 1)], VALUES)
    other = spark.createDataFrame([("a", "g", "3", 1), ("a", "g", "4", 1), ("z", "g", "5", 1)], VALUES)
    assert sorted(r["value"] for r in join_properties(root, other).collect()) == ["1", "2", "3", "4"]


RULE_JSON = {
    "docType": "PEOPLE", "elpModel": "m", "elpType": "person", "key": "code", "docCollectionName": "docs",
    "propertyMappings": [
        {"needRelation": False, "sPropertyName": "name", "dPropertyName": "tab_s_name", "sourceTargetEntities": []},
        {"needRelation": False, "sPropertyName": "", "dPropertyName": "incomplete", "sourceTargetEntities": []},
        {"needRelation": True, "dPropertyName": "tab_s_showTag", "sourceTargetEntities": [
            {"onlyFromRel": False, "targetEntityType": "special", "sPropertyName": "code", "sPropertyId": "code"}]},
        {"needRelation": True, "dPropertyName": "no_type", "sourceTargetEntities": [
            {"onlyFromRel": True, "linkedRelationType": "", "sPropertyName": "a", "sPropertyId": "b"}]},
    ],
    "indexPropertyMappings": [
        {"needRelation": True, "dPropertyName": "d_org", "sourceTargetEntities": [
            {"onlyFromRel": True, "linkedRelationType": "employed", "sPropertyName": "org", "sPropertyId": "who"}]},
        {"needExtendsion": True, "sourceTargetEntities": [
            {"onlyFromRel": True, "linkedRelationType": "mobile", "sPropertyName": "number", "dPropertyName": "d_phone",
             "sPropertyId": "who", "secondLevel": [
                 {"targetEntityType": "account", "sPropertyName": "name", "dPropertyName": "d_account", "sPropertyId": "number"}]}]},
    ],
}


def test_rule_documents_are_sorted_into_their_kinds(spark):
    rule = rule_from_json(json.dumps(RULE_JSON))
    assert rule == DossierRule(
        "PEOPLE", "m", "person", "code", (("name", "tab_s_name"),),
        (Related("tab_s_showTag", "special", "code", "code"),),
        (Related("d_org", "employed", "who", "org"),),
        (Extension(Related("d_phone", "mobile", "who", "number"), (Related("d_account", "account", "number", "name"),)),),
        "docs",
    )
    assert rule.skipped == ("incomplete", "no_type")
    collection = spark.createDataFrame([(json.dumps(RULE_JSON),), ('{"docType": "CASE"}',)], "value string")
    assert load_rule(collection, "PEOPLE") == rule
    with pytest.raises(ValueError):
        load_rule(collection.union(collection), "PEOPLE")
    with pytest.raises(ValueError):
        load_rule(collection, "VEHICLE")


def _entity(uuid, *names):
    return EntityType(uuid, uuid, tuple(Property(n) for n in names))


def _link(uuid, *names):
    return LinkType(uuid, "x", "y", "x", "y", True, tuple(Property(n) for n in names))


MODEL = Model(
    "m",
    (_entity("person", "code", "name"), _entity("special", "code"), _entity("account", "number", "name")),
    (_link("employed", "who", "org"), _link("mobile", "who", "number")),
)


def _elements(spark):
    tables = {
        (ENTITY, "person"): (["code", "name"], [("1", "Ann", "r"), ("1", "Ann", "r"), ("2", "Bob", "r"), ("3", "Cid", "bad"), (" ", "Dan", "r")]),
        (ENTITY, "special"): (["code"], [("1", "r"), ("1", "r"), ("3", "r")]),
        (ENTITY, "account"): (["number", "name"], [("555", "qq1", "r"), ("555", "qq2", "bad"), ("556", "qq3", "r")]),
        (LINK, "employed"): (["who", "org"], [("1", "A", "r"), ("1", "B", "r"), ("9", "C", "r")]),
        (LINK, "mobile"): (["who", "number"], [("1", "555", "r"), ("2", "555", "r"), ("2", "557", None)]),
    }
    frames = []
    for (kind, type_id), (names, rows) in tables.items():
        frame = spark.createDataFrame(
            [(str(i), *r) for i, r in enumerate(rows)], ", ".join(f"{n} string" for n in ["i", *names, "resId"])
        )
        mapping = Mapping("s", "m", kind, type_id, {n: n for n in names}, ("i",), ("i",), ("i",))
        frames.append(build_elements(frame, MODEL, [mapping]))
    from weftwork.operators.elements import union_all

    return union_all(frames)


def test_dossiers_from_elements_and_from_cells(spark):
    elements = _elements(spark)
    rule = rule_from_json(json.dumps(RULE_JSON))
    bad = spark.createDataFrame([("bad",)], "resId string")
    expected = {
        "PEOPLE@1": {"tab_s_name": ["Ann"], "tab_s_showTag": ["重点人员"], "d_org": ["A", "B"], "d_phone": ["555"], "d_account": ["qq1"]},
        "PEOPLE@2": {"tab_s_name": ["Bob"], "d_phone": ["555"], "d_account": ["qq1"]},
        "PEOPLE@ ": {"tab_s_name": ["Dan"]},
    }
    assert as_dict(build_dossiers(element_reader(elements), rule, bad)) == expected
    cells = element_cells(elements, F.lit("2024-01-01 00:00:00").cast("timestamp"))
    assert as_dict(build_dossiers(cell_reader(cells, "m"), rule, bad)) == expected
    after = F.lit("2024-02-01 00:00:00").cast("timestamp")
    assert build_dossiers(cell_reader(cells, "m", min_ts=after), rule, bad).isEmpty()
