"""Suffix arrays against plain sorting; repeated strings against a table of all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from weftwork.llm import queries, suffixarray, suffixdedup
from weftwork.llm.suffixarray import suffix_array
from weftwork.llm.suffixdedup import merged, repeated_spans, with_spans, without_repeats

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("alphabet", [600, 4])
def test_suffix_array(monkeypatch, alphabet):
    monkeypatch.setattr(suffixarray, "ALPHABET", alphabet)
    rng = random.Random(1)
    for _ in range(600):
        s = [rng.randrange(rng.choice([1, 2, 3, 26])) for _ in range(rng.randrange(80))]
        s = s + s[: rng.randrange(len(s) + 1)] if rng.random() < 0.5 else s
        assert suffix_array(np.array(s, dtype=np.int64)).tolist() == sorted(range(len(s)), key=lambda i: s[i:])


def plain(rows, length):
    seen = Counter()
    texts = [(i, (t or "").encode()) for i, t in rows]
    for _, data in texts:
        seen.update(data[p : p + length] for p in range(len(data) - length + 1))
    out = []
    for i, data in texts:
        spans = merged([(p, p + length) for p in range(len(data) - length + 1) if seen[data[p : p + length]] > 1])
        kept, at = b"", 0
        for a, b in spans:
            kept, at = kept + data[at:a], b
        kept += data[at:]
        out.append((i, len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    found = sorted(map(tuple, queries.QUERIES["op9_suffix_dedup"](spark, FOLDER).collect()), key=str)
    assert found == plain(rows, 400)


@pytest.mark.parametrize("hot", [3000, 5])
def test_shared_passages_edits_and_hot_anchors(spark, hot):
    rng = random.Random(hot)
    letters = "abcdefgh é"
    passage = "".join(rng.choice(letters) for _ in range(700))
    rows = []
    for i in range(120):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(300)))
        a = rng.randrange(300)
        part = list(passage[a : a + rng.randrange(100, 400)])
        for _ in range(rng.randrange(3)):
            part[rng.randrange(len(part))] = "X"
        at = rng.randrange(len(text) + 1)
        rows.append((i, text[:at] + "".join(part) + text[at:]))
    rows += [(500, "ab" * 400), (501, "z" * 90), (502, None), (503, ""), (None, passage), (504, passage), (504, passage), (505, "q" * 59)]
    frame = spark.createDataFrame([(*r, 1, "v") for r in rows], "doc_id long, text string, version int, anchor string").repartition(5)
    spans = repeated_spans(frame, length=60, gram=16, hot=hot)
    left = []
    for r in with_spans(frame, spans).collect():
        data, kept, at = r.text.encode(), b"", 0
        for a, b in zip(r.starts or (), r.stops or ()):
            kept, at = kept + data[at:a], b
        kept += data[at:]
        left.append((r.doc_id, len(data), len(data) - len(kept), len(r.starts or ()), hashlib.sha256(kept).hexdigest()))
    assert sorted(left, key=str) == plain(rows, 60)


def test_long_and_empty(spark):
    rng = random.Random(9)
    once = "".join(rng.choice("abcdefghij") for _ in range(5_000_000))
    rows = [(1, once), (2, once[4_199_000:4_199_900]), (3, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.n_removed, r.n_spans) for r in without_repeats(frame).collect()}
    assert found == {1: (900, 1), 2: (900, 1), 3: (0, 0)}
    assert without_repeats(frame.limit(0)).count() == 0


@pytest.mark.parametrize("direct", [0, 10, 10**6])
def test_suffix_array_with_and_without_recursion(monkeypatch, direct):
    monkeypatch.setattr(suffixarray, "DIRECT", direct)
    rng = random.Random(2)
    for _ in range(200):
        part = [rng.randrange(rng.choice([1, 2, 3, 26])) for _ in range(rng.randrange(1, 120))]
        s = part * rng.randrange(1, 4) + part[: rng.randrange(len(part))]
        assert suffix_array(np.array(s, dtype=np.int64)).tolist() == sorted(range(len(s)), key=lambda i: s[i:])


def test_sorting_a_large_shard_takes_bounded_memory():
    import subprocess
    import sys

    code = """
import random, resource
import pyarrow as pa
from weftwork.llm.suffixdedup import _sort_shard
rng = random.Random(1)
base = [bytes(rng.randrange(97, 123) for _ in range(700)) for _ in range(60)]
pieces = [b[k : k + 600] for b in base for k in range(0, 100, 3)]
pieces = pieces[: (1 << 20) // 600]
shard = pa.table({"doc_id": list(range(len(pieces))), "version": [0] * len(pieces), "first": [0] * len(pieces), "n": [1] * len(pieces), "piece": pieces})
most = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024
before = most()
assert _sort_shard(400)(shard).num_rows == len(pieces)
print(most() - before)
"""
    taken = int(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout)
    assert taken < 200  # MB for a shard of 1 MB


@pytest.mark.parametrize("hot", [3000, 5])
def test_rows_of_a_common_line_are_not_shuffled_to_one_task(spark, monkeypatch, hot):
    """A line that fills the texts gives one key most rows; a join by a shuffle must not get them."""
    rng = random.Random(3)
    line = "".join(rng.choice("abcdefgh") for _ in range(20))
    rows = [(i, "".join(rng.choice("abcdefgh") for _ in range(40 + i)) + line * 100) for i in range(40)]
    rows += [(i, rows[i % 40][1][:90] + "".join(rng.choice("abcdefgh") for _ in range(50))) for i in range(40, 60)]
    rows += [(70, "z" * 59), (71, None), (None, line * 4), (72, line * 4), (72, line * 4)]
    most, shuffled = [], suffixdedup.adaptive_join

    def join(left, right, keys, how="inner"):
        most.append(left.groupBy(*keys).count().agg({"count": "max"}).first()[0] or 0)
        return shuffled(left, right, keys, how)

    monkeypatch.setattr(suffixdedup, "adaptive_join", join)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    spans = repeated_spans(frame, length=60, gram=16, hot=hot)
    found = [tuple(r) for r in with_spans(frame, spans).mapInArrow(suffixdedup._digests, suffixdedup._DIGESTS).collect()]
    assert sorted(found, key=str) == plain(rows, 60)
    assert max(most) <= 1000
