"""Connected components by alternating large-star and small-star over a table of edges."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftwork.llm.common import written

#: A round more than halves the height of every tree, so this is far beyond any graph of 2**63 nodes.
MAX_ROUNDS = 200


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour, itself included."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, move to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for all nodes of edges ``(u, v)``; a component is named by its smallest node.

    Each round is written to the shared folder, so a lost executor costs one round at most. The loop ends
    when a round changes nothing: then every node hangs directly on the smallest node of its component.
    Nulls and loops are ignored; repeated edges count once.
    """
    clean = lambda e: e.filter("u <> v").distinct()
    now = written(clean(edges.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v"))), "edges")
    before = None
    for _ in range(MAX_ROUNDS):
        now = written(clean(_small_star(clean(_large_star(now)))), "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"the components were still changing after {MAX_ROUNDS} rounds")
    return now.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component").unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
