"""Near-duplicates against plain sets, and the components against union-find."""

import random
import re
from collections import defaultdict

import pytest

from weftwork.llm import minhash, queries
from weftwork.llm.components import components
from weftwork.llm.minhash import near_duplicates

FOLDER = "/root/testdata/sf0.01"


def shingle_set(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    words = [bytes(b + 32 if 65 <= b <= 90 else b for b in w) for w in words]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def plain(rows):
    sets = {}
    for i, text in rows:
        sets.setdefault(i, shingle_set(text))
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    common = defaultdict(int)
    for ids in holders.values():
        for x in range(len(ids)):
            for y in range(x):
                common[ids[y], ids[x]] += 1
    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return sorted((i, len(sets[i]), root(i), root(i) == i) for i in sets)


def test_query_equals_plain_sets(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    found = queries.QUERIES["op8_minhash"](spark, FOLDER)
    assert sorted(map(tuple, found.collect())) == plain(rows)


def test_chains_and_hot_groups(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    rows = []
    for i in range(900):  # near copies of one text, some far enough from each other to hang on a third only
        words = list(base)
        for _ in range(rng.randrange(6)):
            words[rng.randrange(120)] = f"x{rng.randrange(9999)}"
        rows.append((i * 3, " ".join(words)))
    shared = " ".join(f"s{k}" for k in range(40))
    rows += [(i * 3 + 1, shared + " " + " ".join(f"u{rng.randrange(99999)}" for _ in range(40))) for i in range(300)]
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(7))
    assert sorted(map(tuple, found.collect())) == plain(rows)


@pytest.mark.parametrize("block", [3, 20])
def test_blocks_of_large_and_small_components_lose_no_link(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = random.Random(block)
    rows = []
    for family in range(3):  # chains in which neighbours are linked, so that a bucket holds several pieces at first
        words = [f"f{family}w{k}" for k in range(150)]
        for i in range(70):
            words = list(words)
            for _ in range(1 + i % 4):
                words[rng.randrange(150)] = f"x{rng.randrange(99999)}"
            rows.append((len(rows), " ".join(words)))
    rng.shuffle(rows)
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, found.collect())) == plain(rows)


def test_members_meet_all_other_components_once(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    rng = random.Random(5)
    placed = [(bucket, 100 * bucket + k, 100 * bucket + (0 if k < 13 else 13 if k < 19 else k // 2 * 2), 10) for bucket in (1, 2) for k in range(40)]
    placed += [(3, 300 + k, 300, 10) for k in range(9)]  # one component: nothing to compare
    rng.shuffle(placed)
    blocks = defaultdict(lambda: ([], []))
    for r in minhash._blocks(spark.createDataFrame(placed, "bucket long, node long, component long, n_shingles long")).collect():
        blocks[r.bucket, r.i, r.j][r.side].append((r.node, r.component))
    met = defaultdict(int)
    for (bucket, i, j), (left, right) in blocks.items():
        pairs = [(a, b) for a in left for b in (left if i == j else right) if i != j or a < b]
        for a, b in pairs:
            if a[1] != b[1]:
                met[tuple(sorted((a[0], b[0])))] += 1
            assert not (i.own and j.own and i.component == j.component)
    wanted = {tuple(sorted((a[1], b[1]))) for a in placed for b in placed if a[0] == b[0] and a[2] != b[2]}
    assert set(met) == wanted and set(met.values()) == {1}


def test_awkward_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one TWO"), (None, "one two"), (6, "É é"), (7, "é É"), (4, "One two")]
    rows += [(8, "a b c d e " * 40000), (9, "A b c d e " * 40000)]
    frame = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, bucket string, component long")
    found = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(frame).collect()}
    assert found == {
        (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (None, 1, None, True),
        (6, 1, 6, True), (7, 1, 7, True), (8, 5, 8, True), (9, 5, 8, False),
    }
    assert near_duplicates(frame.limit(0)).count() == 0
    shared = [(1, "a b c d e f"), (1, "u v w x y z"), (1, ""), (2, "A b c d e f"), (3, "U v w x y z")]
    found = near_duplicates(spark.createDataFrame(shared, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.component_id) for r in found} == {(1, 1), (2, 1), (3, 1)} and len(found) == 5


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(64)]
    edges += [(5000, 5001 + i) for i in range(200)] + [(7, 7), (None, 3)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    found = components(spark.createDataFrame(edges, "u long, v long"))
    assert sorted(map(tuple, found.collect())) == sorted((x, root(x)) for x in parent)
