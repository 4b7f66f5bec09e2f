"""A Merkle manifest of a table of documents, with a proof for every document.

Leaves are hashes of the rows. The leaves of one group (a language) in the order of their ids form one tree, whose runs
of eight neighbours become one node each, level by level; the roots of all groups form one more tree. A proof holds, for
each level, the hashes left and right of the node on the way to the root.

Proofs come by pointer jumping. Every node starts with one segment, its siblings, and points to its parent. Then the
table of nodes is joined with itself: a node's segments are followed by those of the node it points to, and it points
where that one pointed. Each round doubles the distance, so all leaves reach the root after log2(height) rounds. A node
at distance ``d`` above the leaves has at most ``8**d`` of them below it while only ``rows / 8**d`` such nodes exist, so
the joins are broadcast where keys would be hot and shuffled where they cannot be.

Only hashes are shuffled, never texts. Leaves are numbered by a range partitioning over (group, id), in which a group of
any size spreads over partitions; no task or driver holds a group.

Defined results: a null field hashes as ``-``; null ids come first within their group and null groups before all others;
rows of one id follow each other by their hash, and rows that are equal throughout are leaves of their own; an empty
table has no root and no proofs; columns beyond the named fields are ignored, whatever their names.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftwork.llm.common import written
from weftwork.operators.joins import sized_join

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
RUN = 8  # nodes that become one node of the next level
BROADCAST_BYTES = 16 << 20  # the upper nodes of a round are broadcast up to this size, shuffled beyond it

_NODE = ["key", "level", "idx"]
_ABOVE = ["above_key", "above_level", "above_idx"]


def _measured(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value: no two rows read alike."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(fields: tuple[str, ...] = FIELDS, found: dict[str, Column] | None = None) -> Column:
    """The hash of a row, with the columns ``found`` in place of the fields of their names."""
    values = {name: F.col(name) for name in fields} | (found or {})
    return F.sha2(F.concat(*(_measured(values[name]) for name in fields)), 256)


def _numbered(frame: DataFrame, group: str, order: list[str]) -> DataFrame:
    """The frame, written, with ``idx``, the place of a row within its group by ``order``, and ``n``, the group's rows.

    Rows are dealt by ranges of (group, order), so a large group lies in several partitions one after the other; only
    the counts of (group, partition) are needed to turn places within a partition into places within the group. A random
    last key lets rows that are equal throughout spread as well.
    """
    dealt = written(
        frame.withColumn("_tie", F.rand(12))
        .repartitionByRange(group, *order, "_tie")
        .sortWithinPartitions(group, *order, "_tie")
        .drop("_tie")
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_line", F.monotonically_increasing_id()),
        "numbered",
    )
    parts = dealt.groupBy(group, "_part").agg(F.min("_line").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    whole = Window.partitionBy(group)
    parts = written(
        parts.withColumn("n", F.sum("_rows").over(whole)).withColumn(
            "_before", F.sum("_rows").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_rows")
        ),
        "parts",
    )
    placed = sized_join(dealt, parts, [group, "_part"])
    return placed.withColumn("idx", F.col("_before") + F.col("_line") - F.col("_first")).drop("_part", "_line", "_first", "_rows", "_before")


def _tree(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The runs of each level above the nodes ``(key, idx, n, hash, row)``, and the roots ``(key, level, hash, row)``."""
    runs, roots, level = [], [], 0
    most = nodes.agg(F.max("n")).first()[0] or 0
    while True:
        roots.append(nodes.filter("n = 1").select("key", F.lit(level).alias("level"), "hash", "row"))
        if most <= 1:
            break
        members = F.array_sort(F.collect_list(F.struct((F.col("idx") % RUN).alias("place"), "hash", "row")))
        above = F.expr(f"idx div {RUN}").alias("idx"), F.expr(f"(n + {RUN - 1}) div {RUN}").alias("n")
        run = written(nodes.filter("n > 1").groupBy("key", *above).agg(members.alias("run")).withColumn("level", F.lit(level)), f"level-{level}")
        runs.append(run)
        parent = F.sha2(F.array_join(F.col("run.hash"), ""), 256)
        nodes = run.select("key", "idx", "n", parent.alias("hash"), F.lit(None).cast(nodes.schema["row"].dataType).alias("row"))
        level, most = level + 1, -(-most // RUN)
    union = roots[0]
    for more in roots[1:]:
        union = union.unionByName(more)
    return runs, written(union, "roots")


def _segments(runs: DataFrame) -> DataFrame:
    """For each node of the runs its siblings as one segment, and its parent."""
    member = runs.select("key", "level", F.col("idx").alias("above_idx"), F.col("run.hash").alias("hashes"), F.posexplode("run").alias("place", "node"))
    left = F.array_join(F.slice("hashes", F.lit(1), F.col("place")), "")
    right = F.array_join(F.slice("hashes", F.col("place") + 2, F.lit(RUN)), "")
    return member.select(
        "key",
        "level",
        (F.col("above_idx") * RUN + F.col("place")).alias("idx"),
        F.col("node.hash").alias("hash"),
        F.col("node.row").alias("row"),
        F.array(F.struct(left.alias("left"), right.alias("right"))).alias("segments"),
        F.col("key").alias("above_key"),
        (F.col("level") + 1).alias("above_level"),
        "above_idx",
    )


def _jump(nodes: DataFrame, upper: DataFrame, distance: int) -> DataFrame:
    """The nodes with the segments of the nodes they point to behind their own, pointing where those point.

    Those who have reached the root find nobody there and stay as they are.
    """
    reached = upper.filter((F.col("key") == "") | (F.col("level") >= distance)).select(
        *(F.col(name).alias(above) for name, above in zip(_NODE, _ABOVE)),
        F.col("segments").alias("more"),
        *(F.col(above).alias(f"next_{above}") for above in _ABOVE),
    )
    joined = sized_join(nodes, reached, _ABOVE, "left", max_bytes=BROADCAST_BYTES)
    onward = {above: F.when(F.col("more").isNull(), F.col(above)).otherwise(F.col(f"next_{above}")) for above in _ABOVE}
    segments = F.when(F.col("more").isNull(), F.col("segments")).otherwise(F.concat("segments", "more"))
    return joined.select(*(c for c in nodes.columns if c not in ("segments", *_ABOVE)), segments.alias("segments"), *(c.alias(name) for name, c in onward.items()))


def manifest(
    docs: DataFrame, found: dict[str, Column] | None = None, fields: tuple[str, ...] = FIELDS, group: str = "lang", order: str = "doc_id"
) -> DataFrame:
    """One row for each row of ``docs``: ``order``'s column, ``leaf``, ``subroot``, ``root``, ``proof`` and ``found_leaf``.

    ``proof`` lists the hashes ``left`` and ``right`` of the way from the leaf to the root, lowest level first;
    ``found_leaf`` is the leaf of the row with the columns ``found`` in place of its own, as a later reader may find it.
    """
    key = F.when(F.col(group).isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col(group)))
    rows = docs.select(key.alias("key"), F.col(order).alias("id"), leaf_hash(fields).alias("hash"), leaf_hash(fields, found).alias("found"))
    rows = written(rows, "leaves")  # the range partitioning reads its input twice: the hashes, not the texts
    leaves = _numbered(rows, "key", ["id", "hash", "found"]).withColumn("row", F.struct("id", "hash", "found")).drop("id", "found")
    runs, roots = _tree(leaves)

    tops = roots.withColumn("all", F.lit(""))
    tops = written(_numbered(tops, "all", ["key"]), "subroots")
    top_runs, top_roots = _tree(tops.select(F.lit("").alias("key"), "idx", "n", "hash", F.lit(None).cast(roots.schema["row"].dataType).alias("row")))
    top = top_roots.first()
    if top is None:  # an empty table
        return docs.limit(0).select(F.col(order), *(F.lit("").alias(n) for n in ("leaf", "subroot", "root")), F.array(F.struct(F.lit("").alias("left"), F.lit("").alias("right"))).alias("proof"), F.lit("").alias("found_leaf"))

    # a group's root is the node of the upper tree's lowest level that has its place
    names = tops.select("key", "level", "row", F.col("idx").alias("top_idx"))
    upper = [_segments(run).drop("hash") for run in runs[1:] + top_runs[1:]]
    climbing = [_segments(run).drop("hash") for run in runs[:1]]
    if top_runs:
        lowest = _segments(top_runs[0]).select(F.col("idx").alias("top_idx"), "segments", *_ABOVE)
        root_nodes = written(sized_join(names, lowest, ["top_idx"]).withColumn("idx", F.lit(0).cast("long")).drop("top_idx"), "root-nodes")
        upper.append(root_nodes.filter("row is null"))
        climbing.append(root_nodes.filter("row is not null"))
        height = tops.agg(F.max("level")).first()[0] + len(top_runs)
    else:
        height = len(runs)
        alone = names.filter("row is not null").select("key", "level", "row", F.lit(0).cast("long").alias("idx"))
        none = F.array().cast("array<struct<left:string,right:string>>")
        climbing.append(alone.select(*_NODE, "row", none.alias("segments"), F.col("key").alias("above_key"), F.col("level").alias("above_level"), F.col("idx").alias("above_idx")))

    columns = [*_NODE, "row", "segments", *_ABOVE]
    union = lambda frames: _union([f.select(columns) for f in frames])
    lower, distance = union(climbing), 1
    if upper:
        above = written(union(upper).drop("row"), "jump-1")
        while distance < height:
            lower = _jump(lower, above, distance)
            distance *= 2
            if distance < height:
                above = written(_jump(above, above, distance // 2), f"jump-{distance}")

    subroots = roots.select("key", F.col("hash").alias("subroot"))
    return sized_join(lower, subroots, ["key"], max_bytes=BROADCAST_BYTES).select(
        F.col("row.id").alias(order),
        F.col("row.hash").alias("leaf"),
        "subroot",
        F.lit(top["hash"]).alias("root"),
        F.col("segments").alias("proof"),
        F.col("row.found").alias("found_leaf"),
    )


def _union(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """The hash of all siblings of a proof, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), ""), 256)
