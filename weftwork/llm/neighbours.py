"""Approximate nearest neighbours by inner product: a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample of distinct vectors. For the largest inner product, vectors are lengthened by one
component, so that all have the same norm and the nearest is the one with the largest product. Every vector is put into
a leaf. A query walks the tree with a priority queue of branches, best first, and visits leaves in the order in which
they leave the queue. How many it visits is widened until queries of the sample reach the wanted recall on the sample;
of the ``k`` nearest of all vectors the sample holds its share, so that many are looked for there.

Neighbouring leaves form groups of about ``BLOCK`` vectors, and a leaf beyond that is a group of several blocks. A query
goes once to each group that it visits leaves of, with their numbers, and is held against those leaves exactly. So the
rows that are shuffled follow the vectors and the groups, not the leaves visited.
"""

import heapq
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftwork.llm.common import written

SAMPLE, BRANCHES, LEAF = 20_000, 12, 60  # vectors of the sample; children of a node; vectors of the sample in a leaf
RECALL, CALIBRATION = 0.97, 300  # wanted recall, and the queries of the sample on which it is measured
BLOCK = 4096  # vectors, and queries, that are compared in one task
AT_ONCE = 256  # queries of them whose products stand in memory at a time
ROUNDS = 12


@dataclass
class Node:
    """A branch of the tree: centroids of its children, which are nodes or numbers of leaves."""

    centroids: np.ndarray
    children: list = field(default_factory=list)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """The cluster of each row; centroids start far from each other."""
    centroids = x[rng.integers(len(x))][None]
    distance = ((x - centroids[0]) ** 2).sum(axis=1)
    while len(centroids) < k and distance.sum() > 0:
        centroids = np.vstack([centroids, x[rng.choice(len(x), p=distance / distance.sum())]])
        distance = np.minimum(distance, ((x - centroids[-1]) ** 2).sum(axis=1))
    for _ in range(ROUNDS):
        own = (x @ centroids.T - (centroids**2).sum(axis=1) / 2).argmax(axis=1)
        for c in range(len(centroids)):
            if (own == c).any():
                centroids[c] = x[own == c].mean(axis=0)
    return (x @ centroids.T - (centroids**2).sum(axis=1) / 2).argmax(axis=1)


class Tree:
    """The fitted tree. ``length`` is the norm to which vectors are lengthened."""

    def __init__(self, sample: np.ndarray, branches: int = BRANCHES, leaf: int = LEAF, seed: int = 5):
        sample = np.unique(sample, axis=0)
        self.length = float(np.sqrt((sample**2).sum(axis=1).max())) if len(sample) else 1.0
        self.leaves = 0
        self._rng = np.random.default_rng(seed)
        self.root = self._grow(self.lengthened(sample), branches, leaf)

    def lengthened(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.length**2 - (x**2).sum(axis=1), 0))
        return np.hstack([x, rest[:, None]])

    def _grow(self, x: np.ndarray, branches: int, leaf: int):
        own = _kmeans(x, branches, self._rng) if len(x) > leaf else np.zeros(len(x), int)
        groups = [x[own == c] for c in np.unique(own)]
        if len(groups) < 2:
            self.leaves += 1
            return self.leaves - 1
        node = Node(np.array([g.mean(axis=0) for g in groups]))
        node.children = [self._grow(g, branches, leaf) for g in groups]
        return node

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf that each vector falls into, at every branch towards the nearest centroid."""
        out = np.zeros(len(x), dtype=np.int64)
        stack = [(self.root, self.lengthened(x), np.arange(len(x)))]
        while stack:
            node, rows, at = stack.pop()
            if not isinstance(node, Node):
                out[at] = node
                continue
            own = (rows @ node.centroids.T - (node.centroids**2).sum(axis=1) / 2).argmax(axis=1)
            stack += [(child, rows[own == c], at[own == c]) for c, child in enumerate(node.children) if (own == c).any()]
        return out

    def visits(self, query: np.ndarray, limit: int) -> list[int]:
        """The first ``limit`` leaves in best-bin-first order."""
        query = np.append(query, 0.0)
        queue, count, out = [(0.0, 0, self.root)], 1, []
        while queue and len(out) < limit:
            _, _, node = heapq.heappop(queue)
            if not isinstance(node, Node):
                out.append(node)
                continue
            for value, child in zip((node.centroids @ query - (node.centroids**2).sum(axis=1) / 2).tolist(), node.children):
                heapq.heappush(queue, (-value, count, child))
                count += 1
        return out

    def calibrate(self, sample: np.ndarray, k: int, recall: float, queries: int, total: int) -> int:
        """The least number of leaves that finds ``recall`` of the nearest of the sample, widened step by step.

        A query finds itself in its own leaf, so it does not count. Of the ``k`` nearest among ``total`` vectors the
        sample holds its share, and as many are looked for in it.
        """
        chosen = self._rng.permutation(len(sample))[:queries]
        k = min(max(1, round(k * len(sample) / max(total, 1))), len(sample) - 1)
        if k < 1:
            return self.leaves
        leaf = self.leaf_of(sample)
        products = sample[chosen] @ sample.T
        products[np.arange(len(chosen)), chosen] = -np.inf
        nearest = np.argpartition(-products, k - 1, axis=1)[:, :k]
        rank = np.full((len(chosen), self.leaves), self.leaves)
        for i, query in enumerate(sample[chosen]):
            order = self.visits(query, self.leaves)
            rank[i, order] = np.arange(len(order))
        needed = np.sort(np.take_along_axis(rank, leaf[nearest], axis=1).ravel())
        return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]) + 1


def _usable(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows of an Arrow column of lists that hold finite numbers, not all zero, and their lengths."""
    rows = column.to_pylist()
    ok = [r is not None and len(r) > 0 and None not in r and bool(np.isfinite(r).all()) and any(r) for r in rows]
    return np.array(ok, dtype=bool), np.array([len(r) if r is not None else 0 for r in rows], dtype=np.int64)


def _check(batches):
    for batch in batches:
        ok, sizes = _usable(batch.column(1))
        keep = pa.array(ok)
        rows = batch.column(1).filter(keep).to_pylist()
        packed = pa.array([np.array(r, dtype="<f8").tobytes() for r in rows], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), pa.array(sizes[ok]), packed], names=["vec_id", "size", "vector"])


def _matrix(column) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), "<f8").reshape(len(rows), -1) if rows else np.zeros((0, 1))


def _place(tree: Tree):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                leaf = tree.leaf_of(_matrix(batch.column(1)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=["vec_id", "vector", "leaf"])

    return run


def grouped(counts: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """The group of each leaf, from the leaves' vectors, and the blocks of each group: neighbours together up to ``block``."""
    group, blocks, held = np.zeros(len(counts), np.int64), [], 0
    for leaf, n in enumerate(counts.tolist()):
        if not blocks or held + n > block:
            blocks.append(max(1, -(-n // block)))
            held = 0
        group[leaf] = len(blocks) - 1
        held += n
    return group, np.array(blocks, dtype=np.int64)


def _visit(tree: Tree, limit: int, group: np.ndarray):
    """For each query one row for each group of leaves that it visits."""

    def run(batches):
        for batch in batches:
            rows, groups, leaves = [], [], []
            for k, query in enumerate(_matrix(batch.column(1)) if batch.num_rows else ()):
                found = np.array(tree.visits(query, limit), dtype=np.int64)
                of = group[found]
                for g in np.unique(of).tolist():
                    rows.append(k)
                    groups.append(g)
                    leaves.append(found[of == g].astype(np.int32))
            at = pa.array(rows, pa.int64())
            columns = [batch.column(0).take(at), batch.column(1).take(at), pa.array(groups, pa.int64()), pa.array(leaves, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["query_id", "vector", "cell", "leaves"])

    return run


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """The places of the ``k`` largest scores, ties to smaller ids."""
    return np.lexsort((ids, -scores))[:k]


_FOUND = "query_id long, ids array<long>, scores array<double>"


def _lists(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) or [[], [], []]
    types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64())]
    return pa.table({n: pa.array(c, t) for n, c, t in zip(("query_id", "ids", "scores"), columns, types)})


def _search(k: int):
    """The ``k`` best of a block of vectors, in the leaves that it visits, for each query of a block of queries."""

    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        if not vectors.num_rows or not queries.num_rows:
            return _lists([])
        v, ids = _matrix(vectors.column("vector")), vectors.column("vec_id").to_numpy()
        leaves, leaf = np.unique(vectors.column("leaf").to_numpy(), return_inverse=True)
        rows = []
        for start in range(0, queries.num_rows, AT_ONCE):
            part = queries.slice(start, AT_ONCE)
            q, asked = _matrix(part.column("vector")), part.column("leaves").combine_chunks()
            wanted = asked.flatten().to_numpy()
            at = np.minimum(np.searchsorted(leaves, wanted), len(leaves) - 1)
            row = np.repeat(np.arange(len(q)), asked.value_lengths().to_numpy())
            visited = np.zeros((len(q), len(leaves)), dtype=bool)
            there = leaves[at] == wanted
            visited[row[there], at[there]] = True
            products = q @ v.T
            products[~visited[:, leaf]] = -np.inf
            for i, query_id in enumerate(part.column("query_id").to_pylist()):
                line = products[i]
                near = np.flatnonzero(line > -np.inf)
                if len(near) > k + 1:  # the product of a matrix may differ in the last bits: leave room at the edge
                    least = np.partition(line, len(line) - k - 1)[len(line) - k - 1]
                    near = np.flatnonzero(line >= least - 1e-9 * (1 + abs(least)))
                near = near[ids[near] != query_id]
                if len(near):
                    exact = (v[near] * q[i]).cumsum(axis=1)[:, -1]
                    top = best(ids[near], exact, k)
                    rows.append((query_id, ids[near][top].tolist(), exact[top].tolist()))
        return _lists(rows)

    return run


def _merge(k: int):
    def run(batches):
        for batch in batches:
            rows = []
            for query_id, parts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.array([i for p in parts for i in p["ids"]], dtype=np.int64)
                scores = np.array([s for p in parts for s in p["scores"]], dtype=np.float64)
                top = best(ids, scores, k)
                rows.append((query_id, ids[top].tolist(), scores[top].tolist()))
            yield from _lists(rows).to_batches()

    return run


def nearest(
    vectors: DataFrame,
    every: int = 20,
    k: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    sample: int = SAMPLE,
    leaf: int = LEAF,
    recall: float = RECALL,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row whose id is divisible by ``every`` its ``k`` nearest others found.

    Vectors that are null, empty, all zero, or hold a null or a non-finite number take no part, nor do rows with a null
    id and vectors of another length than most have (the shortest of equally frequent lengths). Rows that share an id
    are candidates of their own, but a query never finds its own id; of several vectors of one query id the one that
    comes first in the order of their bytes is asked. Other columns are not read.
    """
    spark = vectors.sparkSession
    given = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("v")).filter("vec_id is not null")
    usable = written(given.mapInArrow(_check, "vec_id long, size long, vector binary"), "vectors")
    common = usable.groupBy("size").count().orderBy(F.desc("count"), "size").first()
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    usable = usable.filter(F.col("size") == common["size"]).select("vec_id", "vector")
    total = usable.count()
    rows = usable.select("vector").orderBy(F.xxhash64("vec_id", "vector")).limit(sample).collect()  # bounded by ``sample``
    matrix = np.frombuffer(b"".join(r.vector for r in rows), "<f8").reshape(len(rows), -1)
    tree = Tree(matrix, leaf=leaf)
    visits = tree.calibrate(matrix, k, recall, CALIBRATION, total)

    placed = written(usable.mapInArrow(_place(tree), "vec_id long, vector binary, leaf long"), "leaves")
    counts = np.zeros(tree.leaves, np.int64)
    for row in placed.groupBy("leaf").count().collect():  # as many rows as the tree has leaves
        counts[row["leaf"]] = row["count"]
    group, blocks = grouped(counts, BLOCK)
    asked = placed.filter(F.pmod("vec_id", F.lit(every)) == 0).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("vector").alias("vector"))
    # Few bytes mean much walking here, so the queries are not gathered into partitions by their size.
    asked = asked.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("query_id"))
    asked = written(asked.mapInArrow(_visit(tree, visits, group), "query_id long, vector binary, cell long, leaves array<int>"), "visits")
    q_blocks = asked.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("q_blocks"))
    v_blocks = spark.createDataFrame(pa.table({"cell": np.arange(len(blocks)), "v_blocks": blocks}))
    cells = F.broadcast(v_blocks.join(q_blocks, "cell"))
    cell_of = F.broadcast(spark.createDataFrame(pa.table({"leaf": np.arange(len(group)), "cell": group})))
    block = lambda column, n: F.pmod(F.xxhash64(column), F.col(n)).cast("int")
    one = placed.join(cell_of, "leaf").join(cells, "cell").select(
        "cell", block("vec_id", "v_blocks").alias("i"), F.explode(F.sequence(F.lit(0), F.col("q_blocks") - 1)).alias("j"), "vec_id", "vector", "leaf"
    )
    two = asked.join(cells, "cell").select(
        "cell", F.explode(F.sequence(F.lit(0), F.col("v_blocks").cast("int") - 1)).alias("i"), block("query_id", "q_blocks").alias("j"), "query_id", "vector", "leaves"
    )
    found = one.groupBy("cell", "i", "j").cogroup(two.groupBy("cell", "i", "j")).applyInArrow(_search(k), _FOUND)
    # First the finds of a share of the leaves and blocks, then those of the shares, so that no list grows with the data.
    part = F.pmod(F.monotonically_increasing_id(), F.lit(16)).alias("part")
    lists = F.collect_list(F.struct("ids", "scores")).alias("parts")
    found = found.withColumn("part", part).groupBy("query_id", "part").agg(lists).select("query_id", "parts").mapInArrow(_merge(k), _FOUND)
    found = found.groupBy("query_id").agg(lists).select("query_id", "parts").mapInArrow(_merge(k), _FOUND)
    return found.select("query_id", F.posexplode(F.arrays_zip("ids", "scores")).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.ids").alias("vec_id"), F.col("hit.scores").alias("score")
    )
