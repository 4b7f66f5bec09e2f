"""The Merkle manifest against a plain one with hashlib."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from weftwork.llm import queries
from weftwork.llm.merkle import folded, manifest, proof_digest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, idx int, run string"
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (doc_id, source, lang, n_chars, text)))


def levels(nodes):
    result = [nodes]
    while len(result[-1]) > 1:
        now = result[-1]
        result.append([sha("".join(now[k : k + 8])) for k in range(0, len(now), 8)])
    return result


def climb(tree, at):
    proof = []
    for nodes in tree[:-1]:
        run = nodes[at - at % 8 : at - at % 8 + 8]
        proof.append(("".join(run[: at % 8]), "".join(run[at % 8 + 1 :])))
        at //= 8
    return proof


def lower(text):
    return text and "".join(c.lower() if c.isascii() else c for c in text)


def plain(rows):
    changed = lambda r: (r[0], lower(r[1]), *r[2:]) if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 else r
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(*r), leaf(*changed(r)), r[0]))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([m[2] for m in sorted(groups[g])]) for g in names}
    top = levels([trees[g][-1][0] for g in names])
    result = []
    for place, g in enumerate(names):
        for at, (_, _, own, found, doc_id) in enumerate(sorted(groups[g])):
            proof, now = climb(trees[g], at) + climb(top, place), found
            for left, right in proof:
                now = sha(left + now + right)
            root = top[-1][0]
            result.append((doc_id, own, trees[g][-1][0], root, sha("".join(a + b for a, b in proof)), now, now == root))
    return sorted(result, key=str)


def found(spark, rows):
    frame = spark.createDataFrame([(*r, "k", 3, "r") for r in rows], SCHEMA).repartition(3)
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    text = F.when(tampered, F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.col("text"))
    proofs = manifest(frame, {"text": text}).withColumn("f", folded(F.col("found_leaf"), F.col("proof")))
    proofs = proofs.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")), "f", F.col("f") == F.col("root"))
    return sorted((tuple(r) for r in proofs.collect()), key=str)


def made(seed, counts):
    rng = random.Random(seed)
    words = ["Aé", "b", "ÀB", "x" * 30, "", "日本", "Qq"]
    rows = []
    for lang, n in counts.items():
        rows += [(len(rows) + k, " ".join(rng.choice(words) for _ in range(4)), lang, rng.choice(["s", None, "S:1"]), k) for k in range(n)]
    return rows


@pytest.mark.parametrize(
    "counts",
    [{"en": 1}, {"en": 2}, {"en": 8}, {"en": 9}, {"en": 65}, {"en": 1, "de": 1}, {"en": 600, "de": 1, None: 9, "fr": 64, "é": 8, "": 3},
     {f"l{k}": 1 + k % 3 for k in range(70)}],
    ids=str,
)
def test_equals_a_plain_tree(spark, counts):
    rows = made(1, counts)
    assert found(spark, rows) == plain(rows)


def test_nulls_ties_and_repeated_rows(spark):
    rows = made(2, {"en": 20, None: 5})
    rows += rows[:7] * 12 + [(3, None, "en", None, None), (3, "other", "en", "s", 1), (None, "A", "en", None, 1), (None, None, None, None, None)] * 2
    assert found(spark, rows) == plain(rows)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_a_changed_hash_breaks_exactly_the_changed_leaves(spark):
    rows = queries.QUERIES["op12_merkle_manifest"](spark, "/root/testdata/sf0.01").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        changed = zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and texts[r.doc_id] != lower(texts[r.doc_id])
        assert r.verified == (not changed)
