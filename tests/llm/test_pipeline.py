"""The pipeline, stage by stage, against plain versions of what each stage has to keep."""

from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_decontaminate import plain_tiles, words
from tests.llm.test_linededup import plain as plain_lines
from tests.llm.test_minhash import plain as plain_copies
from tests.llm.test_tokens import check_packed, plain_ids
from weftwork.llm.common import table, written
from weftwork.llm import toxicity as toxicity_of
from weftwork.llm.toxicity import learn, toxicity

FOLDER = "/root/testdata/sf0.01"


def test_stages(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line dedup", "minhash near-dedup", "benchmark decontamination", "packing"]
    start = table(spark, FOLDER, "documents")
    docs, seen = start, []
    for name, stage in corpus_pipeline.STAGES:
        seen.append([(r.doc_id, r.text) for r in docs.collect()])
        out = stage(spark, docs, FOLDER)
        if name != "packing":
            assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in start.schema]
        docs = written(out, "test-stage")
    before_lines, before_copies, before_benchmark, before_packing = seen[1:]
    toxic = {r.doc_id for r in toxicity(start, learn(start, table(spark, FOLDER, "labels"))).collect() if r.predicted}
    assert {i for i, _ in before_lines} == {i for i, _ in seen[0]} - toxic and toxic

    _, may = plain_lines(before_lines)
    left = dict(before_copies)
    earlier = set()
    for i, text in sorted(before_lines):
        lines = {x.strip() for x in text.split("\n")}
        if not may[i]:
            assert left[i] == text
        assert i in left or lines - {""} <= earlier  # only a text that is repeated as a whole goes
        earlier |= lines

    assert {i for i, _ in before_benchmark} == {i for i, _, _, kept in plain_copies(before_copies) if kept}
    items = [words(r.text) for r in table(spark, FOLDER, "benchmark").collect()]

    def leaks(text):
        own = words(text)
        grams = {tuple(own[k : k + 5]) for k in range(len(own) - 4)}
        return any(
            any(tuple(item[k : k + 5]) in grams for k in range(len(item) - 4)) and 100 * plain_tiles(own, item) >= 75 * len(item)
            for item in items
        )

    assert {i for i, _ in before_packing} == {i for i, text in before_benchmark if not leaks(text)}
    want = dict(zip([i for i, _ in before_packing], plain_ids("byte_bpe_50k.json", [t for _, t in before_packing])))
    check_packed(docs.collect(), want, 0.01)


def test_awkward_documents(spark):
    rows = [(1, None, "x"), (None, "a b c d e f", None), (2, "", "y"), (2, "", "y"), (3, "word " * 3000, "z"), (4, "word " * 3000, "z")]
    docs = spark.createDataFrame([(*r, None, 1, 2.0) for r in rows], "doc_id long, text string, lang string, n_chars long, component_id int, score double")
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, FOLDER), "test-odd")
    assert {r.doc_id for r in docs.collect()} == {None, 1, 2, 3}


def test_columns_of_any_name_come_through(spark):
    names = "doc_id long, text string, lang string, n_chars long, lines_dropped string, __drop string, __gone string, gone string, score string"
    text = "\n".join(f"these are the words of line {k} here" for k in range(30))
    rows = [(k, f"{text}\nown words {k}" if k < 3 else f"text {k} " * 12, "en", 5, "a", "b", "c", "d", "e") for k in range(6)]
    docs = spark.createDataFrame(rows, names)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, FOLDER), "test-names")
        assert docs.columns == [n.split()[0] for n in names.split(", ")]
        assert {tuple(r)[4:] for r in docs.collect()} == {("a", "b", "c", "d", "e")}
    assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() > 0


def test_toxic_documents_go_whatever_their_id(spark):
    start = table(spark, FOLDER, "documents")
    model = learn(start, table(spark, FOLDER, "labels"))
    docs = start.withColumn("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("doc_id")))
    clean = {r.text for r in toxicity_of.without_toxic(docs, model).collect()}
    texts = {r.doc_id: r.text for r in start.collect()}
    assert clean == {texts[r.doc_id] for r in toxicity(start, model).filter("predicted = 0").collect()}
