"""Token ids, packing and token files against the tokenizer library on whole texts."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from weftwork.llm import queries, textbatch
from weftwork.llm.packing import pack
from weftwork.llm.tokenfile import read_chunk, read_token_files, write_chunk, write_token_files
from weftwork.llm.tokens import Encoder, vocabulary
from weftwork.session import shared_folder

FOLDER = "/root/testdata/sf0.01"
KINDS = [("byte_bpe_50k.json", "space-led"), ("word_bpe_49k.json", "word")]


def plain_ids(name, texts, end=True):
    tokenizer = Tokenizer.from_file(vocabulary(name))
    tokenizer.encode_special_tokens = True
    return [e.ids + [1] * end for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@pytest.mark.parametrize("name,pieces", KINDS)
def test_pieces_give_the_ids_of_whole_texts(name, pieces):
    rng = random.Random(5)
    parts = [*"ab Z,.-<É 1\n\n\t  é!ß'0", "\xa0", "　", "'s", "'ll", " '", "\r\n", "<|endoftext|>", "İ", "é", " ", "日本", "Σ", "ŉ"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(20000)] + ["", None, " ", "x" * 5000]
    ids, before = Encoder(vocabulary(name), pieces).column(pa.array(texts))
    for k, want in enumerate(plain_ids(name, texts, end=False)):
        assert ids[before[k] : before[k + 1]].tolist() == want, repr(texts[k])


def test_packing_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    want = dict(zip(docs, plain_ids("byte_bpe_50k.json", docs.values())))
    check_packed(queries.QUERIES["op5_packing"](spark, FOLDER).collect(), want, 0.01)


def check_packed(rows, want, padding):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.ids_crc32 == crc(want[r.doc_id][r.start : r.start + r.length])
        assert r.doc_tokens == len(want[r.doc_id])
        by_doc[r.doc_id].append((r.start, r.length))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(want)
    for i, parts in by_doc.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at and length > 0
            at += length
        assert at == len(want[i])
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    used = sum(map(len, want.values()))
    assert len(by_sequence) * 2048 - used <= padding * used + 2048


def test_packing_over_many_tasks(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["a", "the", "zebra,", "x1"]) for _ in range(rng.randrange(900)))) for i in range(1500)]
    rows += [(9000, "word " * 9000), (9001, None), (9002, "")]
    want = {i: ids for (i, _), ids in zip(rows, plain_ids("byte_bpe_50k.json", [t for _, t in rows]))}
    frame = spark.createDataFrame([(*r, "s", 5) for r in rows], "doc_id long, text string, sequence_id string, offset int")
    packed = pack(frame.repartition(40), with_ids=True)
    found = packed.collect()
    check_packed(found, want, 0.01)
    assert all(np.frombuffer(r.ids, "<u4").tolist() == want[r.doc_id][r.start : r.start + r.length] for r in found)
    twice = pack(frame.filter("doc_id > 8999").unionAll(frame.filter("doc_id > 8999")))
    assert sum(r.length for r in twice.collect()) == 2 * sum(len(want[i]) for i in (9000, 9001, 9002))
    assert pack(frame.limit(0)).count() == 0
    assert pack(spark.createDataFrame([(None, "a b")], "doc_id long, text string")).first().doc_tokens == 3


def test_token_files_query(spark):
    docs = dict(sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()))
    start, want = 0, []
    for i, ids in zip(docs, plain_ids("word_bpe_49k.json", docs.values())):
        want.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(map(tuple, queries.QUERIES["op6_token_files"](spark, FOLDER).collect())) == want


def test_token_files_round_trip(spark):
    rows = [(3, "b"), (None, "z"), (1, None), (2, ""), (2, "two two"), (2, "two two"), (7, "long " * 300)] + [(i, f"n {i}") for i in range(10, 90)]
    frame = spark.createDataFrame([(*r, 4) for r in rows], "doc_id long, text string, shard int").repartition(5)
    path = shared_folder(spark, "t")
    write_token_files(frame, path, block=64, chunk_ids=100)
    found = sorted(read_token_files(spark, path, with_ids=True).collect(), key=lambda r: r.start)
    ids = [np.frombuffer(r.ids, "<u4").tolist() for r in found]
    assert [r.doc_id for r in found] == [None, 1, 2, 2, 2, 3, 7, *range(10, 90)]
    assert [r.start for r in found] == [sum(map(len, ids[:k])) for k in range(len(ids))]
    texts = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert sorted(ids) == sorted(plain_ids("word_bpe_49k.json", [t for _, t in texts]))
    empty = shared_folder(spark, "t")
    write_token_files(frame.limit(0), empty)
    assert read_token_files(spark, empty).count() == 0


@pytest.mark.parametrize("values", [[0], [0, 0, 0], [1, 4294967295, 7], list(range(1000)), [49407] * 513])
def test_chunks(values):
    ids = np.array(values, dtype=np.uint32)
    doc_ids, counts, back, first = read_chunk(write_chunk([5, None], [len(ids) - 0, 0], ids, 99, block=100))
    assert (doc_ids, counts.tolist(), back.tolist(), first) == ([5, None], [len(ids), 0], values, 99)


def test_every_id_and_none_come_back(spark):
    ids = [-(1 << 63), (1 << 63) - 1, 0, None, -1, 5, 6, 7, 8, None]
    doc_ids, *_ = read_chunk(write_chunk(ids, [0] * len(ids), np.zeros(0, np.uint32), 0))
    assert doc_ids == ids
    path = shared_folder(spark, "ids")
    write_token_files(spark.createDataFrame([(i, "a b") for i in ids], "doc_id long, text string"), path)
    assert sorted((r.doc_id for r in read_token_files(spark, path).collect()), key=str) == sorted(ids, key=str)


def test_a_worker_holds_one_encoder_of_bounded_size(monkeypatch):
    import weftwork.llm.tokens as module

    one = module.encoder(vocabulary(KINDS[0][0]), KINDS[0][1])
    assert module.encoder(vocabulary(KINDS[0][0]), KINDS[0][1]) is one
    other = module.encoder(vocabulary(KINDS[1][0]), KINDS[1][1])
    assert list(textbatch._held.values()) == [other]
    assert list(textbatch.sliced(iter([]), "text", holds=True)) == [] and list(textbatch._held.values()) == [other]
    assert list(textbatch.sliced(iter([]), "text")) == [] and not textbatch._held
    monkeypatch.setattr(module, "CACHE_BYTES", 1000)
    texts = [f"word{k} and more" for k in range(300)]
    for _ in range(2):  # forgotten between calls, the same ids
        ids, before = other.column(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(before[:-1], before[1:])] == plain_ids(KINDS[1][0], texts, end=False)
