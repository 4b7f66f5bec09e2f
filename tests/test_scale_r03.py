"""Steps that keep a task's share bounded, on rows made here."""

import glob

from pyspark.sql import functions as F

from weftwork.catalog import streams
from weftwork.catalog.cooccurrence import ENTITIES, LINKS, write_lines
from weftwork.constants import ENTITY, LINK
from weftwork.jobs import relate_identifiers
from weftwork.operators.dossier import combined, table_reader, two_hop
from weftwork.plans.rules import Extension, Related


def _events(spark, folder, ids):
    rows = [(i, i % 3, "view", 1.0) for i in ids]
    spark.createDataFrame(rows, "event_id long, user_id long, event_type string, value double").write.parquet(f"{folder}/events.parquet")


def test_quarters_of_several_files(spark, tmp_path):
    """Every quarter has the same number of files, also one without rows, and each batch holds one quarter."""
    _events(spark, str(tmp_path), [i for i in range(80) if i % 4 != 1])
    path, seen = str(tmp_path / "in"), {}
    for number in range(4):
        streams._write_quarter(spark, str(tmp_path), path, number, rows=5)
    assert len(glob.glob(f"{path}/*.parquet")) == 4 * streams._quarter_files(spark, str(tmp_path), 5) == 12

    def handle(batch, batch_id):
        seen[batch_id] = sorted(r[0] for r in batch.select("event_id").collect())

    stream = streams._quarters(spark, str(tmp_path), path, rows=5).writeStream.foreachBatch(handle)
    stream.option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination()
    wanted = {n: [] if n == 1 else list(range(n, 80, 4)) for n in range(4)}
    assert {n: seen.get(n, []) for n in range(4)} == wanted


def test_two_hop_spreads_before_it_reaches(spark):
    placed = spark.createDataFrame([(str(i), "h", "r") for i in range(50)] * 2, "k string, v string, resid string")
    held = spark.createDataFrame([("h", str(i), "r") for i in range(5)], "h string, p string, resid string")
    read = table_reader({(LINK, "l"): placed, (ENTITY, "e"): held})
    made = two_hop(read, Extension(Related("f", "l", "k", "v"), (Related("g", "e", "h", "p"),)))
    assert "REPARTITION_BY_NUM" in made._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in combined(made).collect()} == {(str(i), "f", "h", 2) for i in range(50)} | {
        (str(i), "g", str(j), 2) for i in range(50) for j in range(5)
    }


def test_identifier_documents_are_packed(spark, tmp_path):
    line = [(1, 2, 3, "A", "F", 1), (5, 10, 4, "R", "F", 2), (7, 8, 9, "N", "O", 3)]
    names = "l_partkey long, l_suppkey long, l_orderkey long, l_returnflag string, l_linestatus string, l_linenumber int"
    spark.createDataFrame(line, names).write.parquet(f"{tmp_path}/lineitem.parquet")
    write_lines(spark, str(tmp_path), f"{tmp_path}/lines")
    assert glob.glob(f"{tmp_path}/lines/*.txt.gz") and not glob.glob(f"{tmp_path}/lines/*.txt")
    relate_identifiers(spark, f"{tmp_path}/lines", ENTITIES, LINKS, "rel", f"{tmp_path}/out")
    for kind, collection, n in (("entities", "std_entity_index", 7), ("links", "std_relation_index", 6)):
        folder = f"{tmp_path}/out/{kind}/resource=rel"
        assert glob.glob(f"{folder}/collection={collection}/*.zstd.parquet")
        assert spark.read.parquet(folder).filter(F.col("collection") == collection).count() == n


def test_element_stream_is_spread(spark, tmp_path):
    _events(spark, str(tmp_path), range(8))
    stream = streams._element_stream(spark, str(tmp_path))
    assert stream.isStreaming and "Repartition" in stream._jdf.queryExecution().analyzed().toString()
