"""Decontamination against tiling by exhaustive search."""

import random
import re

from weftwork.llm import queries
from weftwork.llm.decontaminate import contaminated, tiles

FOLDER = "/root/testdata/sf0.01"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def plain_tiles(text, item, least=5):
    """Greedy string tiling as it is defined: the longest match of unmarked words, again and again."""
    free_text, free_item, covered = [True] * len(text), [True] * len(item), 0
    while True:
        best = (0, 0, 0)
        for a in range(len(text)):
            for b in range(len(item)):
                n = 0
                while (
                    a + n < len(text) and b + n < len(item) and free_text[a + n] and free_item[b + n] and text[a + n] == item[b + n]
                ):
                    n += 1
                if n > best[0]:
                    best = (n, a, b)
        n, a, b = best
        if n < least:
            return covered
        free_text[a : a + n] = free_item[b : b + n] = [False] * n
        covered += n


def test_tiles_cover_as_much_as_the_definition():
    rng = random.Random(4)
    equal = 0
    for _ in range(150):
        text = [rng.randrange(6) for _ in range(rng.randrange(60))]
        item = [rng.randrange(6) for _ in range(rng.randrange(30))]
        if text and rng.random() < 0.7:
            item += text[len(text) // 2 :] + text[: len(text) // 3]
        got = tiles(text, item)
        assert all(text[a : a + n] == item[b : b + n] and n >= 5 for a, b, n in got)
        assert len({x for a, _, n in got for x in range(a, a + n)}) == sum(n for _, _, n in got)
        assert len({x for _, b, n in got for x in range(b, b + n)}) == sum(n for _, _, n in got)
        equal += abs(sum(n for _, _, n in got) - plain_tiles(text, item)) <= 4
    assert equal >= 145  # equally long matches may be taken in another order


def test_query(spark):
    items = [(r.item_id, words(r.text)) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    want = set()
    for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect():
        own = words(r.text)
        grams = {tuple(own[k : k + 5]) for k in range(len(own) - 4)}
        for item_id, item in items:
            if any(tuple(item[k : k + 5]) in grams for k in range(len(item) - 4)) and 100 * plain_tiles(own, item) >= 75 * len(item):
                want.add((r.doc_id, item_id))
    found = queries.QUERIES["op4_decontamination"](spark, FOLDER).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want and len(want) > 5


def test_reordered_and_awkward(spark):
    item = [f"w{k}" for k in range(40)]
    swapped = item[20:] + ["x"] + item[:20]
    docs = [
        (1, "Start " + " ".join(swapped) + " end"), (2, " ".join(item[:25])), (3, " ".join(item[:30])), (4, None), (5, ""),
        (6, " ".join(item[k] for k in range(0, 40, 2))), (None, " ".join(item)), (7, "a " * 30000), (3, " ".join(item[:30])),
    ]
    bench = [(9, " ".join(item).upper()), (12, " ".join(item)), (None, "q r s t u v"), (13, None), (14, "one two"), (15, "a a a a a a a")]
    docs = spark.createDataFrame([(*r, 5) for r in docs], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame(bench, "item_id long, text string")
    for size in (1 << 20, 40):  # in one block, and in several
        found = contaminated(docs, bench, block_bytes=size).collect()
        assert sorted((r.doc_id or 0, r.item_id, r.covered) for r in found if r.item_id != 15) == [(0, 9, 40), (1, 9, 40), (3, 9, 30), (3, 9, 30)]
        assert [(r.doc_id, r.covered) for r in found if r.item_id == 15] == [(7, 7)]
    assert contaminated(docs.limit(0), bench).count() == 0
    assert contaminated(docs, bench.limit(0)).count() == 0


def test_a_phrase_of_many_items_and_documents_makes_no_pairs(spark):
    rng = random.Random(8)
    phrase = "this text may be copied for any use without a fee"
    own = lambda n: " ".join(f"v{rng.randrange(10**6)}" for _ in range(n))
    bench = [(k, f"{own(15)} {phrase} {own(15)}") for k in range(100_000)]
    docs = [(k, f"{own(20)} {phrase} {own(20)}") for k in range(300)] + [(1000, f"{own(5)} {bench[77][1]} {own(5)}")]
    found = contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string"), block_bytes=64 << 20)
    assert [(r.doc_id, r.item_id) for r in found.collect()] == [(1000, 77)]


def test_candidates_hold_every_item_that_tiles_can_cover():
    import numpy as np

    from weftwork.llm.decontaminate import Items
    from weftwork.llm.textbatch import shingles

    rng = random.Random(9)
    common = Items(list(range(50)), np.concatenate([np.arange(8), *([np.append(np.arange(100 * k + 10, 100 * k + 40), np.arange(8)) for k in range(49)])]).astype(np.uint64),
                   np.concatenate([[0, 8], 8 + 38 * np.arange(1, 50)]), 5, 75)
    shared = np.isin(common.seeds, shingles(np.arange(8).astype(np.uint64), np.array([0, 8]), 5)[0])
    assert common.candidates(shared) == [0]  # the others share no rare seed: they are not even looked at
    for _ in range(60):
        lists = [[rng.randrange(9) for _ in range(rng.randrange(5, 25))] for _ in range(20)]
        ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
        items = Items(list(range(20)), np.array([w for x in lists for w in x], dtype=np.uint64), ends, 5, 75)
        text = [rng.randrange(9) for _ in range(60)] + lists[3][len(lists[3]) // 5 :] + lists[4][3:] + lists[4][:5]
        grams, _ = shingles(np.array(text, dtype=np.uint64), np.array([0, len(text)]), 5)
        found = items.candidates(np.isin(items.seeds, grams))
        covered = [sum(n for _, _, n in tiles(text, x)) for x in lists]
        assert {k for k, x in enumerate(lists) if 100 * covered[k] >= 75 * len(x)} <= set(found)
