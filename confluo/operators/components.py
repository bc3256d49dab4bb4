"""Connected components of an edge table by alternating large-star and small-star rounds
(Kiveris et al., SoCC 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.shared import discard, settle


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link each node's neighbours to the smallest of them (a > b holds in ``edges``).

    The minimum is a partial aggregate, so a hub costs one row for each task. The join
    key is rebuilt from the aggregate so that both of its sides are exchanged by the
    planner, which lets adaptive execution split a hub's rows.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.struct("a").alias("k"), F.least("a", "m").alias("m"))
    linked = both.select(F.struct("a").alias("k"), "b").join(least, "k")
    if large:
        return linked.where(F.col("b") > F.col("k.a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    rest = linked.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.unionByName(least.select(F.col("k.a").alias("a"), F.col("m").alias("b")))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 50) -> DataFrame:
    """(node, component) for every node of an edge; component is the smallest node reachable.

    Edges may repeat, run either way, or be loops; rows with a null end are skipped.
    The nodes may be of any orderable type. Each round is written to the shared folder,
    so neither lineage nor plan grows. The driver sees a count and two sums per round.
    """
    whole = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    start = whole.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    nodes = settle(start.distinct(), "edges")
    now, seen = nodes.where("a <> b"), None
    for k in range(max_rounds):
        before, now = now, settle(_star(_star(now, True).where("a <> b"), False).where("a <> b").distinct(), "star")
        if k:
            discard(before)
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("b", "a"))).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components have not settled after {max_rounds} rounds")
    linked = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component"))
    loops = nodes.where("a = b").select(F.col("a").alias("node"), F.col("b").alias("component"))
    found = settle(linked.unionByName(roots).unionByName(loops).groupBy("node").agg(F.min("component").alias("component")), "components")
    discard(now, nodes)
    return found
