"""Steps whose cost a record must stay small on large tables, on rows made here."""

import json

from pyspark.sql import functions as F

from weftwork.catalog import load
from weftwork.catalog.elements import shop_mappings
from weftwork.operators.cooccur import PairLink, pair_links, parse_identifiers
from weftwork.operators.dossier import documents, field_values
from weftwork.operators.elements import fan_out


def _plan(frame, which="optimizedPlan"):
    return getattr(frame._jdf.queryExecution(), which)().toString()


def test_links_without_copies_are_the_distinct_links(spark):
    links = [
        PairLink("phone", "mail", "std", "seen", "thing", "thing"),
        PairLink("mac", "mail", "std", "at", "mac_address", "mail_box"),
        PairLink("imsi", "imsi", "std", "seen", "thing", "thing"),
        PairLink("mac", "imsi", "std", "seen", "thing", "thing"),
        PairLink("imei", "mac", "std", "at", "mac_address", "mail_box"),
    ]
    names = ("phone", "mail", "mac", "imsi", "imei")
    arrays = [[(a, i), (b, j)] for a in names for b in names for i in "12" for j in "12"] * 2
    arrays.append([(n, str(i)) for i in range(30) for n in names])
    rows = [(json.dumps([{"id_type": t, "id": i} for t, i in array]),) for array in arrays]
    records = parse_identifiers(spark.createDataFrame(rows, "value string"))

    def shown(made):
        return sorted(tuple(tuple(sorted(v.items())) if isinstance(v, dict) else v for v in r) for r in made.collect())

    for block in (4, 128):
        every = shown(pair_links(records, links, "r", block))
        once = shown(pair_links(records, links, "r", block, copies=False))
        assert len(every) > len(once) and once == sorted(set(every))


def test_pair_links_shuffles_pairs_only(spark, tmp_path):
    names = "l_partkey long, l_suppkey long, l_orderkey long, l_returnflag string, l_linestatus string, l_linenumber int"
    spark.createDataFrame([(1, 2, 4, "A", "F", 1)] * 3, names).write.parquet(f"{tmp_path}/lineitem.parquet")
    made = load()["q_pair_links"].build(spark, str(tmp_path))
    exchanges = [line for line in _plan(made, "executedPlan").splitlines() if "hashpartitioning" in line and "REPARTITION" not in line]
    assert exchanges and all("a_id" in line and "entity" not in line and "fields" not in line for line in exchanges)
    assert sorted(r.fields for r in made.collect()) == [
        "imsi_phone_imsiid=4;imsi_phone_phoneid=1", "imsi_phone_imsiid=4;imsi_phone_phoneid=2", "phone_mail_mailid=2;phone_mail_phoneid=1",
        "phone_mail_mailid=2;phone_mail_phoneid=2", "phone_phone_phoneid=2",
    ]


def test_large_keys_come_once_for_each_key(spark):
    values = spark.range(300).select(
        F.when(F.col("id") < 200, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 20).cast("string"))).alias("doc_key"),
        F.lit("f").alias("field"), F.col("id").cast("string").alias("value"), F.lit(3).cast("bigint").alias("copies"),
    )
    docs = documents(values.select("doc_key").distinct(), values, "T", 7)
    assert "sequence(0, 31" not in _plan(docs, "analyzed") and "_salt" not in _plan(docs)
    each = field_values(docs).select("doc_id", F.explode("values").alias("value")).groupBy("doc_id", "value").count()
    assert each.count() == 300 and {r["count"] for r in each.collect()} == {3}


def test_dossier_parts_are_built_once(spark):
    made = load()["q_dossier_parts"].build(spark, "/root/testdata/sf0.001")
    assert "dossier-parts" in "".join(made.inputFiles()) and "lineitem" not in "".join(made.inputFiles())


def test_values_are_read_once_for_each_record(spark):
    named = {"o_orderkey": "1", "o_custkey": "2", "o_orderstatus": "F", "ordered": "2020-01-01", "resId": "res2", "l_orderkey": "1"}
    named |= {"l_linenumber": "3", "l_partkey": "4", "l_suppkey": "5", "quantity": "6"}
    record = "sequence_id long, data_schema_id string, res_id string, task_id string, value map<string,string>"
    frame = spark.createDataFrame([(1, s, "res2", "0", named) for s in ("orders", "lineitem")], record)
    made = fan_out(frame, shop_mappings(spark))
    text = _plan(made)
    assert all(text.count(f"[{name}]") + text.count(f", {name},") <= 1 for name in named)
    assert sorted(r.element_id for r in made.collect()) == [
        "contains~`#1~`#3", "order~`#1", "placed~`#2~`#1", "supplies~`#5~`#4",
    ]
