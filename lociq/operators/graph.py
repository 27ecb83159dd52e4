"""Connected components by contraction, then minimum-label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lociq.plans.storage import discard, materialise

#: Times that a graph is drawn together, at most, before labels are passed along what is left.
CONTRACTIONS = 3


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", *, rounds: int = 200) -> DataFrame:
    """(node, component) for every node of an edge; component is its least node.

    Works on any orderable key type. Edges with a null end are dropped; self-loops make
    their node a component; repeated edges count once. First each node is drawn into the least of
    its neighbours and itself, and the edges between different such nodes are a smaller graph with the same
    components; this is done a few times while it halves the edges. On what is left each round takes the least
    label among a node's neighbours and then that label's own label, so long chains close in a logarithmic
    number of rounds; ``rounds`` is far beyond what any graph that can be stored needs, and
    one that isn't settled by then is an error, never a partial result. Whether a round moved
    anything is observed as it is written. A node with very many edges is met by partial
    aggregation and by adaptive skew joins.
    """
    e = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a is not null and b is not null")
    links, n = _written(e.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    drawn: list[DataFrame] = []
    while True:
        both = links.union(links.select("b", "a"))
        near = materialise(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component")), "labels")
        drawn.append(near)
        to = lambda side: near.select(F.col("node").alias(side), F.col("component").alias(f"p{side}"))
        apart = links.filter("a <> b").join(to("a"), "a").join(to("b"), "b").filter("pa <> pb")
        fewer, left = _written(apart.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct())
        discard(links)
        links, halved, n = fewer, left * 2 <= n, left
        if not n or not halved or len(drawn) == CONTRACTIONS:
            break
    labels = _propagated(links, rounds) if n else None
    discard(links)
    for near in reversed(drawn):
        if labels is None:
            labels = near
            continue
        up = labels.select(F.col("node").alias("n"), F.col("component").alias("c"))
        told = materialise(near.join(up, near.component == up.n, "left").select("node", F.coalesce("c", "component").alias("component")), "labels")
        discard(near)
        discard(labels)
        labels = told
    return labels.select("node", "component")


def _written(links: DataFrame) -> tuple[DataFrame, int]:
    seen = Observation()
    out = materialise(links.observe(seen, F.count(F.lit(1)).alias("n")), "edges")
    return out, seen.get["n"]


def _propagated(links: DataFrame, rounds: int) -> DataFrame:
    """(node, component) of the nodes of distinct links without self-loops."""
    both = materialise(links.union(links.select("b", "a")), "edges")
    labels = materialise(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component")), "labels")
    for _ in range(rounds):
        seen = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("component").alias("m"))
        near = labels.join(seen, labels.node == seen.a, "left").select("node", F.least("component", F.coalesce("m", "component")).alias("l"), F.col("component").alias("old"))
        up = labels.select(F.col("node").alias("n"), F.col("component").alias("c"))
        least, moved = F.least("l", F.coalesce("c", "l")), Observation()
        told = near.join(up, near.l == up.n, "left").select("node", least.alias("component"), "old")
        new = materialise(told.observe(moved, F.count(F.when(F.col("component") < F.col("old"), 1)).alias("n")).select("node", "component"), "labels")
        discard(labels)
        labels = new
        if not moved.get["n"]:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    discard(both)
    return labels
