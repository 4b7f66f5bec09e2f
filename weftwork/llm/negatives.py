"""Hard negatives of a stated set of anchors, by exact integer inner products of packed vectors.

Components become integers. Several candidates' components, biased to be non-negative, are laid into separated fields of
one wide integer (Kronecker's substitution): ``P[d] = sum_j (c_j[d] - low) * 2**(width * j)``. One multiplication per
anchor component, ``sum_d (a[d] - low) * P[d]``, then holds the inner products of all those candidates side by side, no
field ever running into the next, and each is cut out and freed of the bias exactly. The wide integer is the 53-bit
integer range of a double as long as a field fits into it, so that the multiplications are one exact matrix product;
components too large for that are packed into integers of any length.

Anchors are worked on in blocks of bounded bytes against all rows, which stay where they are: one pass finds the positives,
a second one, which then knows the admissible scores, the negatives. A task keeps the best few for each anchor and drops
a score only when as many better ones are known, so what it sends on does not grow with the candidates. Labels are
compared, not grouped by, so a label that holds a third of all rows costs nothing extra.

Defined results: rows with a null id, label or vector, or a null or non-finite component take no part; of rows that share an
id the one with the smallest label and vector counts; a shorter vector continues with zeros; scores beyond a long count
as the nearest long; ties go to the smaller id; without rows, positives or admissible negatives there is no result.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftwork.llm.common import written

BLOCK_BYTES = 16 << 20  # of anchors in the driver and in each task at a time
CHUNK = 2048  # candidates that are scored at once
SCALE = 256
CONTAINER_BITS = 53  # a double holds all integers up to here
_LONG = 2**63 - 1


class Packing:
    """How the components of a table are packed, from the dimension and the least and greatest component."""

    def __init__(self, dimension: int, least: int, greatest: int):
        self.dimension = dimension
        self.low = min(int(least), 0)
        reach = max(int(greatest), 0) - self.low
        self.width = max(1, (dimension * reach * reach).bit_length())
        self.fields = CONTAINER_BITS // self.width
        self.wide = self.fields == 0  # beyond a double: integers of any length
        if self.wide:
            self.fields = 64

    def pack(self, vectors: np.ndarray) -> np.ndarray:
        """One row for each ``fields`` consecutive vectors; missing ones are zero fields."""
        n = -(-len(vectors) // self.fields)
        kind = object if self.wide else np.float64
        biased = np.zeros((n * self.fields, self.dimension), dtype=kind)
        biased[: len(vectors)] = self.biased(vectors)
        packed = biased[0 :: self.fields].copy()
        for j in range(1, self.fields):
            packed += biased[j :: self.fields] * (1 << self.width * j if self.wide else float(1 << self.width * j))
        return packed

    def biased(self, vectors: np.ndarray) -> np.ndarray:
        if self.wide:
            return np.array([[int(x) - self.low for x in row] for row in vectors.tolist()], dtype=object).reshape(vectors.shape)
        return vectors - float(self.low)

    def scores(self, anchors: np.ndarray, packed: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """Inner products of anchors and vectors: one product for each anchor and wide integer, then the fields."""
        products = self.biased(anchors) @ packed.T
        if self.wide:
            mask, sums = (1 << self.width) - 1, lambda rows: np.array([sum(int(x) for x in row) for row in rows.tolist()], dtype=object)
        else:
            products, mask = products.astype(np.int64), np.int64((1 << self.width) - 1)
            sums = lambda rows: rows.sum(axis=1).astype(np.int64)
        fields = np.stack([(products >> (self.width * j)) & mask for j in range(self.fields)], axis=2)
        fields = fields.reshape(len(anchors), -1)[:, : len(vectors)]
        # sum (a - low)(c - low) = score - low * (sum a + sum c) + dimension * low**2
        bias = self.low * (sums(anchors)[:, None] + sums(vectors)[None, :]) - self.dimension * self.low * self.low
        scores = fields + bias
        return np.clip(scores, -_LONG, _LONG).astype(np.int64) if self.wide else scores


class Best:
    """The ``k`` best (score, id) of each slot, as chunks of candidates come in."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.least = np.full(slots, -_LONG - 1)  # a lower score can't be among the best any more
        self.slot, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score, ids = (np.concatenate(pair) for pair in ((self.slot, slot), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        firsts = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))
        rank = np.arange(len(slot)) - np.repeat(firsts, np.diff(np.append(firsts, len(slot))))
        keep = rank < self.k
        self.slot, self.score, self.id = slot[keep], score[keep], ids[keep]
        full = rank == self.k - 1
        self.least[slot[full]] = score[full]


def matrix(column: pa.Array, dimension: int) -> np.ndarray:
    """The vectors as rows of doubles, shorter ones continued by zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (lengths == dimension).all():
        return flat.reshape(len(lengths), dimension)
    result = np.zeros((len(lengths), dimension))
    row = np.repeat(np.arange(len(lengths)), lengths)
    result[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return result


def quantized(vectors: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * vectors) + 0.0


class _Anchors:
    """A block of anchors and, in the second pass, the range of admissible scores of each of their positives."""

    def __init__(self, packing: Packing, ids, labels, vectors, positives=None):
        self.packing, self.ids, self.labels, self.vectors = packing, ids, labels, vectors
        self.positives = positives  # None, or per place: (index of the anchor, id and score of the positive)
        if positives is not None:
            of, _, score = positives
            self.first = np.searchsorted(of, np.arange(len(ids) + 1))
            self.most_places = int(np.diff(self.first).max(initial=0))
            whole = [int(s) for s in score]
            self.low = np.array([-(-30 * s // 100) for s in whole], dtype=np.int64)
            self.high = np.array([90 * s // 100 for s in whole], dtype=np.int64)

    def search(self, batches: Iterator[pa.RecordBatch], k: int) -> Best:
        best = Best(len(self.ids) if self.positives is None else len(self.positives[0]), k)
        rows_at_once = max(1, (1 << 20) // CHUNK)
        size = 128  # the first chunks are small: they set the bars
        for batch in batches:
            ids, labels = (batch.column(k).to_numpy().astype(np.int64) for k in (0, 1))
            vectors = quantized(matrix(batch.column(2), self.packing.dimension))
            start = 0
            while start < len(ids):
                part = slice(start, start + size)
                packed = self.packing.pack(vectors[part])
                for a in range(0, len(self.ids), rows_at_once):
                    here = slice(a, a + rows_at_once)
                    scores = self.packing.scores(self.vectors[here], packed, vectors[part])
                    same = self.labels[here, None] == labels[None, part]
                    if self.positives is None:
                        hit = same & (scores >= best.least[here, None]) & (self.ids[here, None] != ids[None, part])
                        row, col = np.nonzero(hit)
                        best.add(a + row, scores[row, col], ids[part][col])
                    else:
                        self._negatives(best, a, scores, same, ids[part])
                start += size
                size = min(CHUNK, size * 2)
        return best

    def _negatives(self, best: Best, a: int, scores: np.ndarray, same: np.ndarray, ids: np.ndarray) -> None:
        first, after = self.first[a : a + len(scores)], self.first[a + 1 : a + 1 + len(scores)]
        for j in range(self.most_places):
            row = np.flatnonzero(first + j < after)
            place = first[row] + j
            low = np.maximum(self.low[place], best.least[place])
            found = scores[row]
            hit = ~same[row] & (found >= low[:, None]) & (found <= self.high[place, None])
            at, col = np.nonzero(hit)
            best.add(place[at], found[at, col], ids[col])


def _rows(embeddings: DataFrame) -> DataFrame:
    """``(vec_id, label, vector)`` of all rows that take part, once for each id, with the labels as they are mined."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.select("vec_id", "label", "embedding").filter("vec_id is not null and label is not null and embedding is not null").filter(finite)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").alias("vector"))
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row")).select("vec_id", "row.*")


def _top(frame: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The best ``k`` rows of each key; Spark limits each partition's share before it shuffles them."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), "found_id")
    return frame.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(embeddings: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Anchors are the rows whose id is divisible by ``every``, their positives the ``positives`` best other rows of their
    label, and for each positive come the ``negatives`` best rows of other labels that score between three and nine
    tenths of it.
    """
    spark = embeddings.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = written(_rows(embeddings), "vectors")
    facts = rows.agg(
        F.count(F.when(F.col("vec_id") % every == 0, 1)).alias("anchors"),
        F.max(F.size("vector")).alias("dimension"),
        F.min(F.array_min("vector")).cast("double").alias("least"),
        F.max(F.array_max("vector")).cast("double").alias("greatest"),
    ).first()
    if not facts["anchors"]:
        return spark.createDataFrame([], schema)
    dimension = facts["dimension"]
    bounds = quantized(np.array([facts["least"] or 0.0, facts["greatest"] or 0.0]))
    packing = Packing(max(dimension, 1), int(bounds[0]), int(bounds[1]))
    blocks = -(-facts["anchors"] * 8 * max(dimension, 1) // BLOCK_BYTES)
    result = None
    for block in range(blocks):
        chosen = rows.filter(F.col("vec_id") % every == 0).filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block)
        anchors = chosen.orderBy("vec_id").toArrow().combine_chunks()
        if not anchors.num_rows:
            continue
        ids, labels = (anchors.column(c).to_numpy().astype(np.int64) for c in ("vec_id", "label"))
        vectors = quantized(matrix(anchors.column("vector").combine_chunks(), packing.dimension))
        found = written(_top(_searched(rows, _Anchors(packing, ids, labels, vectors), positives), ["place"], positives), "positives")
        # at most `positives` rows for each anchor of the block
        table = found.orderBy("place", "rank").select("place", "found_id", "score").toArrow()
        of, positive, score = (table.column(c).to_numpy().astype(np.int64) for c in ("place", "found_id", "score"))
        hits = _searched(rows, _Anchors(packing, ids, labels, vectors, (of, positive, score)), negatives)
        known = spark.createDataFrame(pa.table({"place": np.arange(len(of)), "anchor_id": ids[of], "positive_id": positive, "positive_score": score}))
        part = _top(hits, ["place"], negatives).join(F.broadcast(known), "place")
        part = written(part.select("anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")), "negatives")
        result = part if result is None else result.unionByName(part)
    return result


def _searched(rows: DataFrame, anchors: _Anchors, k: int) -> DataFrame:
    """``(place, found_id, score)``: for each partition of the rows the best ``k`` of each place of the block."""
    shared = rows.sparkSession.sparkContext.broadcast(anchors)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = shared.value.search(batches, k)
        for start in range(0, len(best.slot), 100_000):
            part = slice(start, start + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(x[part]) for x in (best.slot, best.id, best.score)], ["place", "found_id", "score"])

    return rows.select("vec_id", "label", "vector").mapInArrow(search, "place long, found_id long, score long")
