"""Connected components of a table of links, by hooking and contraction.

Every round is one aggregation on node ids and joins with the labels found so far, by broadcast
while these are few; nothing is gathered per component, so a component may hold any share of
the nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import small_side, written


def _contracted(links: DataFrame, found: DataFrame) -> DataFrame:
    """``links`` between the components that they still part, the larger id first."""
    side = small_side(found)
    of = lambda x: side.select(F.col("node").alias(x), F.col("component").alias(f"of_{x}"))
    ends = links.join(of("a"), "a", "left").join(of("b"), "b", "left")
    return _oriented(ends.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")))


def _oriented(links: DataFrame) -> DataFrame:
    return links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def _lifted(labels: DataFrame, parents: DataFrame) -> DataFrame:
    """``labels`` whose component is the parent of what it was, where that has one (``moved``)."""
    up = small_side(parents).select(F.col("node").alias("component"), F.col("component").alias("parent"))
    return labels.join(up, "component", "left").select("node", F.coalesce("parent", "component").alias("component"), F.col("parent").isNotNull().alias("moved"))


def joined(links: DataFrame, found: DataFrame | None = None, most_rounds: int = 60) -> DataFrame:
    """node, component (least node reachable) for every node that is not the least of its
    component, over ``links`` (a, b) and those that gave ``found``, a result of this function.

    In each round every component that has a smaller neighbour is hooked to the least; paths of
    hooks are halved until each node names the end of its own. Of two rounds a component that
    still has neighbours takes in another, so their number halves at least. Links within a
    component are dropped, and what is left is all that the next round reads."""
    now = written(_oriented(links) if found is None else _contracted(links, found), "links")
    for _ in range(most_rounds):
        if not now.count():
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")) if found is None else found
        parents = written(now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")), "parents")
        while (step := written(_lifted(parents, parents), "parents")).where("moved").count():
            parents = step.select("node", "component")
        found = parents if found is None else written(_lifted(found, parents).select("node", "component").unionByName(parents), "components")
        now = written(_contracted(now, parents), "links")
    raise RuntimeError("components did not settle")


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """node, component (least node reachable) for every node that has a link; links are taken
    both ways; links of a node to itself and null ends are ignored."""
    found = joined(edges.select(F.col(a).alias("a"), F.col(b).alias("b")), most_rounds=most_rounds)
    return found.unionByName(found.select(F.col("component").alias("node"), "component").distinct())
