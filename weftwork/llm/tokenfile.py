"""Token files: blocks of ids as bit planes, each compressed, with an index of chunks and documents.

A chunk is one byte string that holds whole documents, so it can be read alone:

====================  ==========================================================================
``b"WTF2"``           mark
``<IIQIB``            documents, ids, position of the first id in its shard, ids in a block, planes
``documents x <q``    document ids
``documents bits``    which documents have an id, eight to a byte
``documents x <I``    ids of each document
``blocks x planes``   ``<I`` compressed bytes of each plane, then the planes themselves
====================  ==========================================================================

The ids of a block are transposed: plane ``k`` holds bit ``k`` of every id, eight to a byte, compressed with zstandard.
Only as many planes are kept as the largest id of the chunk needs. A shard is the chunks of one range of document ids;
the index is a column set beside the chunks: shard, chunk, position of the first id, ids, documents, bytes. Chunks and
index are the rows of a Parquet table, which every store that Spark can reach holds.
"""

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftwork.llm.textbatch import sliced
from weftwork.llm.tokens import encoder, vocabulary

MARK, HEAD = b"WTF2", "<IIQIB"
BLOCK, CHUNK_IDS, END_ID = 65_536, 262_144, 1

_FILE = "shard long, chunk long, first_id long, n_ids long, n_docs long, n_bytes long, content binary"


def pack_planes(ids: np.ndarray, planes: int) -> list[bytes]:
    """The compressed bit planes of one block."""
    press = zstandard.ZstdCompressor(level=3)
    out = []
    for k in range(planes):
        out.append(press.compress(np.packbits(((ids >> np.uint32(k)) & np.uint32(1)).astype(np.uint8)).tobytes()))
    return out


def unpack_planes(parts: list[bytes], n: int) -> np.ndarray:
    """The ids of one block of ``n``."""
    press = zstandard.ZstdDecompressor()
    ids = np.zeros(n, dtype=np.uint32)
    for k, part in enumerate(parts):
        bits = np.unpackbits(np.frombuffer(press.decompress(part), dtype=np.uint8), count=n)
        ids |= bits.astype(np.uint32) << np.uint32(k)
    return ids


def write_chunk(doc_ids: list, counts: list[int], ids: np.ndarray, first: int, block: int = BLOCK) -> bytes:
    planes = int(ids.max()).bit_length() if len(ids) else 0
    blocks = [pack_planes(ids[k : k + block], planes) for k in range(0, len(ids), block)]
    parts = [p for b in blocks for p in b]
    return b"".join(
        [
            MARK,
            struct.pack(HEAD, len(doc_ids), len(ids), first, block, planes),
            np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes(),
            np.packbits([d is not None for d in doc_ids]).tobytes(),
            np.array(counts, dtype="<u4").tobytes(),
            np.array([len(p) for p in parts], dtype="<u4").tobytes(),
            *parts,
        ]
    )


def read_chunk(content: bytes) -> tuple[list, np.ndarray, np.ndarray, int]:
    """Document ids, ids of each, all ids, and the position of the first id in the shard."""
    if content[:4] != MARK:
        raise ValueError("this is no chunk of a token file")
    n_docs, n_ids, first, block, planes = struct.unpack_from(HEAD, content, 4)
    at = 4 + struct.calcsize(HEAD)
    doc_ids = np.frombuffer(content, "<i8", n_docs, at).tolist()
    at += 8 * n_docs
    known = np.unpackbits(np.frombuffer(content, np.uint8, -(-n_docs // 8), at), count=n_docs)
    doc_ids = [d if k else None for d, k in zip(doc_ids, known.tolist())]
    at += -(-n_docs // 8)
    counts = np.frombuffer(content, "<u4", n_docs, at)
    at += 4 * n_docs
    blocks = -(-n_ids // block)
    sizes = np.frombuffer(content, "<u4", blocks * planes, at).tolist()
    at += 4 * blocks * planes
    out = []
    for b in range(blocks):
        parts = []
        for size in sizes[b * planes : (b + 1) * planes]:
            parts.append(content[at : at + size])
            at += size
        out.append(unpack_planes(parts, min(block, n_ids - b * block)))
    return doc_ids, counts, np.concatenate(out) if out else np.zeros(0, np.uint32), first


def _encode_shard(path: str, pieces: str | None, end_id: int, block: int, chunk_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, chunk, first, encode = TaskContext.get().partitionId(), 0, 0, encoder(path, pieces)
        docs, counts, held, size = [], [], [], 0

        def leave() -> pa.RecordBatch:
            content = write_chunk(docs, counts, np.concatenate(held), first, block)
            row = [shard, chunk, first, size, len(docs), len(content), content]
            return pa.RecordBatch.from_pylist([dict(zip((p.split()[0] for p in _FILE.split(", ")), row))])

        for batch in sliced(batches, "text", holds=True):
            ids, before = encode.column(batch.column(1))
            for k, doc_id in enumerate(batch.column(0).to_pylist()):
                own = np.append(ids[before[k] : before[k + 1]], np.uint32(end_id))
                docs.append(doc_id)
                counts.append(len(own))
                held.append(own)
                size += len(own)
                if size >= chunk_ids:
                    yield leave()
                    chunk, first = chunk + 1, first + size
                    docs, counts, held, size = [], [], [], 0
        if docs:
            yield leave()

    return run


def write_token_files(
    docs: DataFrame,
    path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    tokenizer: str | None = None,
    pieces: str | None = "word",
    end_id: int = END_ID,
    block: int = BLOCK,
    chunk_ids: int = CHUNK_IDS,
) -> None:
    """Write the ids of all rows in ascending order of their id, nulls first, equal ids in the order of a hash of the text.

    A null or empty text is ``end_id`` alone. Every row is written, repeated ones too; other columns are not read.
    A chunk closes after the document that brings it to ``chunk_ids``.
    """
    vocab = tokenizer or vocabulary("word_bpe_49k.json")
    texts = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"), F.xxhash64(F.col(text_column)).alias("order"), F.rand(6).alias("tie")
    )  # the tie lets rows that are equal throughout spread over tasks
    order = ["doc_id", "order", "tie"]
    ordered = texts.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    files = ordered.mapInArrow(_encode_shard(vocab, pieces, end_id, block, chunk_ids), _FILE)
    files.write.option("compression", "none").parquet(path)


def _decode(with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                doc_ids, counts, ids, first = read_chunk(content.as_py())
                ends = np.cumsum(counts, dtype=np.int64)
                starts = ends - counts
                data = ids.astype("<u4").tobytes()
                own = [data[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist())]
                columns = {
                    "shard": pa.array([shard] * len(doc_ids), pa.int64()),
                    "doc_id": pa.array(doc_ids, pa.int64()),
                    "at": pa.array(starts + first),
                    "n_tokens": pa.array(counts.astype(np.int64)),
                    "ids_crc32": pa.array([zlib.crc32(x) for x in own], pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array(own, pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    return run


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, and its ids (little-endian, 4 bytes each) if wanted."""
    files = spark.read.parquet(path)
    # One row a shard; there are as many shards as the writing job had tasks.
    totals = files.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()
    bases, base = [], 0
    for shard, n in totals:
        bases.append((shard, base))
        base += n
    schema = "shard long, doc_id long, at long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    rows = files.select("shard", "content").mapInArrow(_decode(with_ids), schema)
    based = rows.join(F.broadcast(spark.createDataFrame(bases, "shard long, base long")), "shard")
    return based.select(
        "doc_id", (F.col("at") + F.col("base")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])
    )
