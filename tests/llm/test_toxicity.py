"""Toxicity: the automaton against plain edit distances, held-out accuracy, contexts and awkward rows."""

import random

import numpy as np
import pyarrow as pa

from weftwork.llm import queries
from weftwork.llm.textbatch import spans
from weftwork.llm.toxicity import _WORD, EXACT, FUZZY, STEM, Lexicon, Scanner, Trie, context_of, inside_words, learn, toxicity

FOLDER = "/root/testdata/sf0.1"


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        row, old = [i + 1], row
        for j, y in enumerate(b):
            row.append(min(old[j] + (x != y), old[j + 1] + 1, row[j] + 1))
    return row[-1]


def test_automaton_and_look_up():
    rng = random.Random(1)
    terms = ["".join(rng.choice("abc") for _ in range(rng.randrange(5, 9))) for _ in range(40)]
    trie, lexicon = Trie(), Lexicon({t: 1.0 for t in terms}, {})
    for t in terms:
        trie.add(t)
    for _ in range(3000):
        word = "".join(rng.choice("abcd") for _ in range(rng.randrange(3, 10)))
        near = {t for t in terms if edits(word, t) <= 1}
        assert {t for _, t in trie.within(word)} == near
        found = lexicon.look_up(word)
        assert (found is not None) == bool(near)
        assert found is None or found[0] == (EXACT if word in terms else FUZZY)
    assert Lexicon({}, {"vequ": 2.0}).look_up("vequais") == (STEM, 2.0)


def test_contexts():
    assert context_of("he said ", " to him") == 1
    assert context_of('it reads "an ', '" there') == 1
    assert context_of("you are an ", ", really") == 2
    assert context_of("the ", " thing") == 0


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = queries.QUERIES["op10_toxicity"](spark, FOLDER).collect()
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(labels[r.doc_id], r.score, r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    toxic, clean = [s for y, s, _ in held if y], [s for y, s, _ in held if not y]
    auc = sum((a > b) + (a == b) / 2 for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert auc > 0.95
    assert sum(y == p for y, _, p in held) > 0.95 * len(held)
    assert sum(p for y, _, p in held if not y) < 0.02 * len(clean)


def test_awkward_rows(spark):
    rng = random.Random(2)
    words = [f"w{k}" for k in range(300)]
    rows = []
    for i in range(600):
        text = [rng.choice(words) for _ in range(30)]
        if i % 3 == 0:
            text[rng.randrange(30)] = "nastyword"
        rows.append((i, " ".join(text), "x", 0.5))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic string, score double")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(600)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    model = learn(docs, labels)
    assert set(model.lexicon.terms) == {"nastyword"}
    odd = [(1, None), (2, ""), (None, "w1 nastyword w2"), (3, "the nastywrod nastyw0rd here"), (4, "w1 " * 300000), (4, "w1"), (5, "x" * 500000)]
    odd = spark.createDataFrame([(*r, 1) for r in odd], "doc_id long, text string, held_out int")
    found = toxicity(odd, model).collect()
    assert len(found) == 7 and all(0 <= r.score <= 1 for r in found)
    assert [r.predicted for r in found if r.doc_id is None] == [1]
    assert all(r.predicted == 0 for r in found if r.doc_id in (1, 2, 4, 5))
    assert max(r.score for r in found if r.doc_id == 3) > max(r.score for r in found if r.doc_id in (1, 2, 4, 5))
    assert toxicity(docs.limit(0), model).count() == 0
    assert [r.predicted for r in toxicity(docs.limit(2), learn(docs, labels.limit(0))).collect()] == [0, 0]


def test_words_end_at_marks_of_all_scripts():
    lexicon = Lexicon({"nastyword": 2.0, "été": 1.0, "x" * 60: 1.0, "悪い言葉です": 1.0, "ка́к": 1.0}, {})
    hits = lambda text: Scanner(lexicon).column(pa.array([text]))[0]
    for text in ("“nastyword”", "« nastyword »", "so—nastyword—then", "well…nastyword…", "a nastyword b", "これは、悪い言葉です。", "ÉTÉ!", "ка́к"):
        assert hits(text)[EXACT] > 0, text
    assert hits("said“ nastyword ”")[4] > 0 and hits("the “nastyword” here")[4] > 0 and hits("« nastyword »")[4] > 0
    assert hits("y" * 300 + " nastyword")[EXACT] > 0 and hits("x" * 60)[EXACT] > 0 and hits("x" * 500000)[EXACT] == 0
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(chr(rng.choice([*range(32, 700), *range(0x900, 0x950), *range(0x2000, 0x2070), *range(0x3000, 0x3050), *range(0x1F600, 0x1F610), 0x20000])) for _ in range(40))
        data = np.frombuffer(text.encode(), np.uint8)
        starts, ends = spans(inside_words(data), np.array([0, len(data)]))
        assert [data[a:b].tobytes().decode() for a, b in zip(starts, ends)] == _WORD.findall(text)
