"""Connected components of an edge table by hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_engine.llm import common as C


def starred(rows: DataFrame, node: str, near: str, path: str) -> DataFrame:
    """Edges (a, b) with the components of ``rows`` (node, near): about one a node instead of one a row.

    A node is tied to the least of its neighbours, and each further neighbour to that least one; those ties recur
    for most nodes of a dense group and are kept once.  One aggregation, no join; null ends and loops are ignored.
    """
    rows = rows.where(F.col(node).isNotNull() & F.col(near).isNotNull() & (F.col(node) != F.col(near)))
    per = C.store(rows.groupBy(F.col(node).alias("a")).agg(F.min(near).alias("b"), F.collect_set(near).alias("all")), f"{path}/stars")
    others = (per.where(F.size("all") > 1).select(F.explode("all").alias("a"), "b").where("a != b").distinct())
    return per.select("a", "b").unionByName(others)


def components(edges: DataFrame, path: str, max_rounds: int = 100) -> DataFrame:
    """(node, component) for every node of ``edges`` (long columns a, b); a component is named by its least node.

    Each round hooks every node to the neighbour of the least hash, if that is less than its own, and contracts:
    both ends of all edges become what they are hooked to, loops and repeats go, so that what is joined costs
    nothing more.  In the order of a hash a fixed share of the nodes is hooked in each round, whatever the ids; rounds end when no
    edge is left.  Hooks and edges of a round are written below ``path`` in the shared folder, so lineage stays
    short and a lost executor costs one round.  Null ends and loops are ignored.
    """
    spark = edges.sparkSession
    ends = lambda a, b: (F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    pairs = C.store(edges.where("a is not null and b is not null and a != b").select(*ends("a", "b")).distinct(), f"{path}/edges0")
    hooks = []
    for k in range(1, max_rounds + 1):
        both = pairs.union(pairs.select("b", "a"))
        near = both.groupBy(F.col("a").alias("node")).agg(F.min(F.struct(F.xxhash64("b").alias("h"), F.col("b").alias("to"))).alias("near"))
        own = F.struct(F.xxhash64("node").alias("h"), F.col("node").alias("to"))
        hook = C.store(near.select("node", F.least("near", own)["to"].alias("label")), f"{path}/hooks{k}")
        hooks.append(hook)
        to = lambda c: hook.select(F.col("node").alias(c), F.col("label").alias(f"l{c}"))
        moved = pairs.join(to("a"), "a").join(to("b"), "b").where("la != lb").select(*ends("la", "lb")).distinct()
        pairs = C.store(moved, f"{path}/edges{k}")
        C.discard(spark, f"{path}/edges{k - 1}")
        if pairs.isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    found = hooks.pop()
    while hooks:
        then = found.select(F.col("node").alias("label"), F.col("label").alias("end"))
        found = hooks.pop().join(then, "label", "left").select("node", F.coalesce("end", "label").alias("label"))
    found = C.store(found, f"{path}/ends")
    names = found.groupBy("label").agg(F.min("node").alias("component"))
    return found.join(names, "label").select("node", "component")
