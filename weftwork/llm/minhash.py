"""MinHash near-duplicates: universal hash minima, banding, verification, components.

Steps, each a Spark job over all rows:

1. Every text becomes its number of distinct shingles, a digest of the shingle set, ``bands`` bucket keys
   of ``rows`` minima each, and a sketch of one byte per minimum.
2. Texts with the same digest are one class, represented by the smallest id, so exact copies never meet in a bucket.
3. In every bucket each member is paired with one leader only (another one in every bucket, chosen by hash).
   Pairs whose sketches leave a link possible are confirmed on the full shingle sets.
4. Buckets whose members are still in several components are compared whole, in blocks of bounded size, each pair in
   the first bucket that it shares and never within a component. Sketches say which members of two blocks may be
   linked; their full shingle sets decide. Only members and links leave a block, so no rows are made for pairs.

So a group of thousands of near copies costs one pair for each member and bucket, and no link between different
components that share a bucket is lost. A pair of similarity 0.75 shares no bucket with probability 2e-5
(40 bands of 5); above 0.8 below 1e-7.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftwork.llm.common import written
from weftwork.llm.components import components
from weftwork.llm.textbatch import mix, shingles, signed, sliced, text_buffers, word_hashes

WIDTH, PERCENT, BANDS, ROWS = 5, 75, 40, 5
BLOCK, BLOCK_SHINGLES = 256, 1_000_000  # members of a bucket that are compared at once, and their shingles, on average
BROADCAST_IDS = 1_000_000  # ids, 8 bytes each, up to which the list of candidate texts is broadcast

_LABEL = "struct<own:boolean,component:long,part:int>"  # a block: of one component, or shared by small ones
_SIGNATURE = "doc_id long, n_shingles long, digest_a long, digest_b long, bands array<long>, sketch binary"


def distinct_sorted(values: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each text in order, and the number before each text."""
    text = np.repeat(np.arange(len(before) - 1), np.diff(before))
    order = np.argsort(values, kind="stable")
    order = order[np.argsort(text[order], kind="stable")]
    values = values[order]
    text = text[order]
    keep = np.ones(len(values), dtype=bool)
    keep[1:] = (values[1:] != values[:-1]) | (text[1:] != text[:-1])
    counts = np.bincount(text[keep], minlength=len(before) - 1)
    return values[keep], np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def _signatures(seed: int, bands: int, rows: int, width: int):
    draw = np.random.default_rng(seed)
    factors = draw.integers(0, 1 << 31, bands * rows, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    offsets = draw.integers(0, 1 << 32, bands * rows, dtype=np.uint32)

    def run(batches):
        for batch in sliced(batches, "text"):
            data, starts = text_buffers(batch.column(1))
            words, firsts = word_hashes(data, starts)
            values, before = distinct_sorted(*shingles(words, firsts, width))
            counts = np.diff(before)
            full = np.flatnonzero(counts)
            minima = np.zeros((bands * rows, batch.num_rows), dtype=np.uint32)
            digests = np.zeros((2, batch.num_rows), dtype=np.uint64)
            if len(full):
                at = before[:-1][full]
                low = (values >> np.uint64(32)).astype(np.uint32) ^ values.astype(np.uint32)
                for i in range(bands * rows):
                    minima[i, full] = np.minimum.reduceat(low * factors[i] + offsets[i], at)
                digests[0, full] = np.add.reduceat(values, at)
                digests[1, full] = np.add.reduceat(mix(values + np.uint64(77)), at)
            keys = np.zeros((bands, batch.num_rows), dtype=np.uint64)
            for b in range(bands):
                key = np.full(batch.num_rows, b + 1, dtype=np.uint64)
                for r in range(rows):
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + minima[b * rows + r])
                keys[b] = key
            sketch = np.ascontiguousarray((minima >> np.uint32(11)).astype(np.uint8).T)
            flat = pa.array(signed(np.ascontiguousarray(keys.T)).reshape(-1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts),
                    pa.array(signed(digests[0])),
                    pa.array(signed(digests[1])),
                    pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * bands), flat),
                    pa.FixedSizeBinaryArray.from_buffers(
                        pa.binary(bands * rows), batch.num_rows, [None, pa.py_buffer(sketch)]
                    ).cast(pa.binary()),
                ],
                names=["doc_id", "n_shingles", "digest_a", "digest_b", "bands", "sketch"],
            )

    return run


def _possible(one: np.ndarray, two: np.ndarray, n_one: np.ndarray, n_two: np.ndarray, percent: int) -> np.ndarray:
    """Pairs whose sizes and sketches leave the wanted similarity possible (within five standard deviations)."""
    n = one.shape[-1]
    same = (one == two).sum(axis=-1) / n
    wanted = percent / 100
    share = wanted + (1 - wanted) / 256
    enough = same >= share - 5 * np.sqrt(share * (1 - share) / n)
    return enough & (100 * np.minimum(n_one, n_two) >= percent * np.maximum(n_one, n_two))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, width)


def _keep_possible(width: int, percent: int):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                c = [batch.column(i) for i in range(6)]
                ok = _possible(_matrix(c[2], width), _matrix(c[3], width), c[4].to_numpy(), c[5].to_numpy(), percent)
                yield pa.RecordBatch.from_arrays([c[0].filter(pa.array(ok)), c[1].filter(pa.array(ok))], names=["a", "b"])

    return run


class _Members:
    """Members of one block, or of a pair of blocks, of a bucket, and whom each may be linked with."""

    def __init__(self, group: pa.Table, width: int, percent: int):
        column = {name: group.column(name).combine_chunks() for name in group.column_names}
        self.ids, self.component, self.sizes, self.side = (
            column[c].to_numpy() for c in ("node", "component", "n_shingles", "side")
        )
        self.sketch = _matrix(column["sketch"], width)
        self.keys = column["bands"].values.to_numpy().reshape(len(self.ids), -1)
        self.bucket, self.percent, self.column = column["bucket"][0].as_py(), percent, column
        self.within = column["i"][0].as_py() == column["j"][0].as_py()
        self.left = np.flatnonzero(self.side == 0)
        self.right = self.left if self.within else np.flatnonzero(self.side == 1)

    def possible(self, x: int) -> np.ndarray:
        """Members of other components that sketches leave possible, where this bucket is the first one shared."""
        others = self.right[(self.component[self.right] != self.component[x]) & ((self.ids[self.right] > self.ids[x]) | (not self.within))]
        if len(others):
            others = others[_possible(self.sketch[x], self.sketch[others], self.sizes[x], self.sizes[others], self.percent)]
        if len(others):
            shared = self.keys[others] == self.keys[x]
            others = others[self.keys[x][shared.argmax(axis=1)] == self.bucket]
        return others


_OPEN = f"bucket long, i {_LABEL}, j {_LABEL}, node long, component long, side int"


def _keep_open(width: int, percent: int):
    """The members that may be linked with another one here, by sketches alone: no row is made for a pair."""

    def run(group: pa.Table) -> pa.Table:
        members = _Members(group, width, percent)
        open_ = np.zeros(len(members.ids), dtype=bool)
        for x in members.left:
            others = members.possible(x)
            open_[others] = True
            open_[x] |= len(others) > 0
        return group.select(["bucket", "i", "j", "node", "component", "side"]).filter(pa.array(open_))

    return run


def _compare_blocks(width: int, percent: int):
    """Links between different components within a block, or between the two blocks of a pair."""

    def run(group: pa.Table) -> pa.Table:
        members = _Members(group, width, percent)
        lists = members.column["shingles"]
        sets, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
        full = np.diff(ends)
        u, v = [], []
        for x in members.left:
            others = members.possible(x)
            if not len(others):
                continue
            own = sets[ends[x] : ends[x + 1]]
            theirs = np.concatenate([sets[ends[y] : ends[y + 1]] for y in others])
            at = np.searchsorted(own, theirs)
            at[at == len(own)] = 0
            starts = np.concatenate([[0], np.cumsum(full[others])[:-1]])
            common = np.add.reduceat((own[at] == theirs).astype(np.int64), starts)
            linked = others[100 * common >= percent * (len(own) + full[others] - common)]
            _, one = np.unique(members.component[linked], return_index=True)
            u.extend([members.ids[x]] * len(one))
            v.extend(members.ids[linked[one]])
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return run


def _blocks(placed: DataFrame) -> DataFrame:
    """Members of buckets with several components, once for each block that they are compared with.

    ``placed`` is ``(bucket, node, component, n_shingles)``. A component that fills a block by itself has blocks of its
    own, which are never compared with each other; the other components of the bucket share blocks, each in one of them.
    So a group of copies that fills a bucket meets the few members outside it, and never itself.
    """
    fill = lambda members, volume: F.greatest(F.col(members) / BLOCK, F.col(volume) / BLOCK_SHINGLES)
    sizes = placed.groupBy("bucket", "component").agg(F.count("*").alias("members"), F.sum("n_shingles").alias("volume"))
    large = fill("members", "volume") >= 1
    small = lambda c: F.coalesce(F.sum(F.when(~large, F.col(c))), F.lit(0)).alias(c)
    parts = F.ceil(fill("members", "volume")).cast("int").alias("parts")
    layout = sizes.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), small("members"), small("volume"),
        F.collect_list(F.when(large, F.struct("component", parts))).alias("large"),
    ).filter("low < high").select("bucket", "large", parts.alias("shared"))
    members = written(placed.join(layout, "bucket"), "open-members")

    def numbered(own: bool, component, parts):
        label = lambda k: F.struct(F.lit(own).alias("own"), component.alias("component"), k.cast("int").alias("part"))
        return F.when(parts > 0, F.transform(F.sequence(F.lit(0), parts - 1), label)).otherwise(F.array().cast(f"array<{_LABEL}>"))

    mine = F.filter("large", lambda c: c["component"] == F.col("component"))[0]
    part = lambda key, parts: F.pmod(F.xxhash64(key), parts).cast("int").alias("part")
    block = F.when(
        F.exists("large", lambda c: c["component"] == F.col("component")),
        F.struct(F.lit(True).alias("own"), F.col("component").alias("component"), part("node", mine["parts"])),
    ).otherwise(F.struct(F.lit(False).alias("own"), F.lit(0).cast("long").alias("component"), part("component", F.col("shared"))))
    every = F.concat(
        numbered(False, F.lit(0).cast("long"), F.col("shared")),
        F.flatten(F.transform("large", lambda c: numbered(True, c["component"], c["parts"]))),
    )
    met = F.filter(every, lambda b: ~(b["own"] & (b["component"] == F.col("component"))))
    spread = members.withColumn("block", block).withColumn("other", F.explode(met))
    return spread.select(
        "bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "node", "component", (F.col("block") > F.col("other")).cast("int").alias("side"),
    )


def _shingle_sets(width: int):
    def run(batches):
        for batch in sliced(batches, "text"):
            data, starts = text_buffers(batch.column(1))
            values, before = distinct_sorted(*shingles(*word_hashes(data, starts), width))
            if batch.num_rows and len(values):  # in the order of signed values, as they are read
                text = np.repeat(np.arange(batch.num_rows), np.diff(before))
                values = values[np.lexsort((signed(values), text))]
            sets = pa.ListArray.from_arrays(pa.array(before.astype(np.int32)), pa.array(signed(values)))
            yield pa.RecordBatch.from_arrays([batch.column(0), sets], names=["node", "shingles"])

    return run


def _confirm(percent: int):
    def run(batches):
        for batch in batches:
            ok = np.zeros(batch.num_rows, dtype=bool)
            for k in range(batch.num_rows):
                one, two = (batch.column(i)[k].values.to_numpy() for i in (2, 3))
                common = len(np.intersect1d(one, two, assume_unique=True))
                ok[k] = 100 * common >= percent * (len(one) + len(two) - common)
            keep = pa.array(ok)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["u", "v"])

    return run


def shingle_sets(ids: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """``(node, shingles)``, hashes in order, of the ``texts (node, text)`` that ``ids`` names."""
    ids = written(ids.distinct(), "candidate-ids")
    few = ids.count() <= BROADCAST_IDS
    wanted = texts.join(F.broadcast(ids) if few else ids, "node", "left_semi")
    sets = wanted.mapInArrow(_shingle_sets(width), "node long, shingles array<long>").filter(F.size("shingles") > 0)
    return written(sets, "shingle-sets")


def confirmed(pairs: DataFrame, texts: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Pairs ``(a, b)`` linked on the full shingle sets of ``texts (node, text)``, as edges ``(u, v)``."""
    sets = shingle_sets(pairs.select(F.explode(F.array("a", "b")).alias("node")), texts, width)
    both = pairs.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b")), "b").join(
        sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a")), "a"
    )
    return both.select("a", "b", "of_a", "of_b").mapInArrow(_confirm(percent), "u long, v long").distinct()


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
    seed: int = 7,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs``.

    Words are lower-cased (A-Z) runs of bytes that are not white space. Null or blank texts have no shingles
    and are linked with nothing. A row with a null id has a null component and is kept. Rows that share an id
    are one node. Repeated rows are returned as often as they come. Other columns, of any name, are not read.
    """
    n = bands * rows
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    signatures = written(texts.mapInArrow(_signatures(seed, bands, rows, width), _SIGNATURE), "signatures")
    known = signatures.filter("n_shingles > 0 and doc_id is not null")
    # A node is the smallest id with a digest; members of a class hang on it.
    classes = written(known.groupBy("digest_a", "digest_b", "n_shingles").agg(F.min("doc_id").alias("node")), "classes")
    nodes = classes.select("node", "digest_a", "digest_b")
    chosen = known.withColumnRenamed("doc_id", "node").join(nodes, ["node", "digest_a", "digest_b"])
    chosen = chosen.dropDuplicates(["node", "digest_a", "digest_b"])
    chosen = written(chosen.select("node", "n_shingles", "bands", "sketch"), "nodes")
    sizes = chosen.select("node", "n_shingles", "sketch")

    members = chosen.select("node", F.explode("bands").alias("bucket"))
    order = F.struct(F.xxhash64("bucket", "node").alias("h"), F.col("node").alias("leader"))
    led = members.groupBy("bucket").agg(F.min(order).alias("first"), F.count("*").alias("size")).filter("size > 1")
    buckets = written(members.join(led.select("bucket", "size", F.col("first.leader").alias("leader")), "bucket"), "buckets")
    pairs = buckets.filter("node <> leader").select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()
    of = lambda side: sizes.select(F.col("node").alias(side), F.col("sketch").alias(f"s{side}"), F.col("n_shingles").alias(f"n{side}"))
    pairs = pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "sa", "sb", "na", "nb")
    pairs = written(pairs.mapInArrow(_keep_possible(n, percent), "a long, b long"), "pairs")
    by_node = texts.filter("doc_id is not null").select(F.col("doc_id").alias("node"), "text")
    edges = written(confirmed(pairs, by_node, width, percent), "links")
    found = components(edges)

    # Buckets that hold several components still: members of different ones, block against block. Sketches go round
    # first, and shingle sets only of members that these leave open, to where they are open.
    placed = buckets.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = placed.join(sizes.select("node", "n_shingles"), "node").select("bucket", "node", "component", "n_shingles")
    spread = _blocks(written(placed, "placed"))
    places = ("bucket", "i", "j")
    left_open = spread.join(chosen, "node").groupBy(*places).applyInArrow(_keep_open(n, percent), _OPEN)
    left_open = written(left_open, "left-open")
    if not left_open.isEmpty():
        sets = shingle_sets(left_open.select("node"), by_node, width)
        full = left_open.join(chosen, "node").join(sets, "node")
        late = full.groupBy(*places).applyInArrow(_compare_blocks(n, percent), "u long, v long")
        found = components(edges.unionByName(written(late, "late-links")))

    named = classes.join(found, "node", "left").select(
        "digest_a", "digest_b", "n_shingles", F.coalesce("component", "node").alias("component_id")
    )
    result = signatures.select("doc_id", "n_shingles", "digest_a", "digest_b").join(
        named, ["digest_a", "digest_b", "n_shingles"], "left"
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return result.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
