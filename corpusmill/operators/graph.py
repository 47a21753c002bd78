"""Graph algorithms as DataFrame iterations. Edges are (src, dst[, weight]); lineage is cut by reliable checkpoints."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.runtime import settle


def undirected(edges: DataFrame) -> DataFrame:
    """Both directions of (entity_a, entity_b, weight)."""
    e = edges.select(F.col("entity_a").alias("src"), F.col("entity_b").alias("dst"), F.col("weight").cast("double").alias("weight"))
    return e.union(e.select("dst", "src", "weight")).toDF("src", "dst", "weight")


def pagerank(edges: DataFrame, rounds: int = 20, damping: float = 0.85, cut: int = 5) -> DataFrame:
    """(node, rank) after a fixed number of rounds; the weight of dangling nodes spreads evenly. Parallel edges add up.

    Each round joins on src, which the edges stay partitioned by, and aggregates with map-side
    combining, so that hubs don't gather in one task before they are summed.
    """
    e = edges.groupBy("src", "dst").agg(F.sum("weight").alias("weight"))
    out = e.groupBy("src").agg(F.sum("weight").alias("total"))
    links = settle(e.join(out, "src").select("src", "dst", (F.col("weight") / F.col("total")).alias("p")))
    nodes = settle(links.select(F.col("src").alias("node")).union(links.select("dst")).distinct())
    n = nodes.count()
    if not n:
        return nodes.select("node", F.lit(0.0).alias("rank"))
    rank = nodes.select("node", F.lit(1.0 / n).alias("rank"))
    for i in range(1, rounds + 1):
        sent = links.join(rank, links.src == rank.node).groupBy("dst").agg(F.sum(F.col("p") * F.col("rank")).alias("got"))
        got = nodes.join(sent, nodes.node == sent.dst, "left").select("node", F.coalesce("got", F.lit(0.0)).alias("got"))
        lost = got.agg((1 - F.sum("got")).alias("lost"))
        rank = got.crossJoin(F.broadcast(lost)).select("node", ((1 - damping) / n + damping * (F.col("got") + F.col("lost") / n)).alias("rank"))
        if i % cut == 0 or i == rounds:
            rank = settle(rank)
    return rank


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node of each connected component, by label propagation with pointer jumping until nothing changes."""
    e = settle(edges.select("src", "dst").union(edges.select("dst", "src")).distinct())
    label = settle(e.select(F.col("src").alias("node")).distinct().select("node", F.col("node").alias("component")))
    while True:  # each round lowers a label at least, and pointer jumping makes their number logarithmic in long chains
        near = e.join(label, e.dst == label.node).groupBy("src").agg(F.min("component").alias("m"))
        new = label.join(near, label.node == near.src, "left").select("node", F.least("component", F.coalesce("m", "component")).alias("component"))
        jump = new.toDF("j_node", "j_component")
        new = settle(new.join(jump, new.component == jump.j_node).select("node", F.col("j_component").alias("component")))
        changed = new.join(label.toDF("node", "old"), "node").where("component <> old").isEmpty()
        label = new
        if changed:
            break
    return label


def degree_centrality(edges: DataFrame) -> DataFrame:
    """(node, degree, centrality) of an undirected simple graph."""
    d = edges.select("src", "dst").union(edges.select("dst", "src")).distinct().groupBy(F.col("src").alias("node")).agg(F.count("*").alias("degree"))
    n = d.agg(F.greatest(F.count("*") - 1, F.lit(1)).alias("m"))
    return d.crossJoin(F.broadcast(n)).select("node", "degree", (F.col("degree") / F.col("m")).alias("centrality"))


def bfs_depth(edges: DataFrame, roots: DataFrame, max_depth: int | None = None) -> DataFrame:
    """(node, depth) of everything reachable from the roots along the edges, in at most max_depth steps if given."""
    seen = settle(roots.select("node").distinct().withColumn("depth", F.lit(0)))
    frontier = seen
    for depth in count(1) if max_depth is None else range(1, max_depth + 1):
        frontier = settle(edges.join(frontier, edges.src == frontier.node, "left_semi").select(F.col("dst").alias("node")).distinct().join(seen, "node", "left_anti").withColumn("depth", F.lit(depth)))
        if frontier.isEmpty():
            break
        seen = settle(seen.union(frontier))
    return seen


def louvain(edges: DataFrame, max_levels: int = 10, least_gain: float = 1e-6) -> DataFrame:
    """(node, community) of an undirected graph given in both directions, by moves that raise the modularity.

    A level moves nodes between communities until the modularity stops rising, then the communities
    become the nodes of the next level. In a pass each node sees its links to the communities around
    it and their totals, takes the one of the greatest gain (ties: the least name), and half of the
    nodes, drawn by hash, move at a time; a pass that doesn't raise the modularity is taken back.
    The edges of a level are partial sums by pairs of communities, so hubs are never gathered.
    """
    e = settle(edges.where("weight > 0").groupBy("src", "dst").agg(F.sum("weight").alias("weight")))
    whole = settle(e.select(F.col("src").alias("node")).distinct().withColumn("community", F.col("node")))
    m2 = e.agg(F.sum("weight")).first()[0]
    if not m2:
        return whole
    for _ in range(max_levels):
        degree = settle(e.groupBy("src").agg(F.sum("weight").alias("k")).withColumnRenamed("src", "node"))
        label = degree.select("node", F.col("node").alias("community"))
        best = start = modularity(e, label).first()[0]
        idle, i = 0, 0
        while idle < 3:
            at = label.join(degree, "node")
            total = at.groupBy("community").agg(F.sum("k").alias("tot"))
            links = e.where("src <> dst").join(label.toDF("dst", "near"), "dst").groupBy("src", "near").agg(F.sum("weight").alias("w"))
            seen = links.join(at.toDF("src", "community", "k"), "src").join(total.toDF("near", "tot"), "near")
            gain = F.col("w") - F.col("k") * (F.col("tot") - F.when(F.col("near") == F.col("community"), F.col("k")).otherwise(0.0)) / m2
            choice = seen.withColumn("gain", F.round(gain, 9)).groupBy("src").agg(F.min_by("near", F.struct(-F.col("gain"), "near")).alias("to"), F.max("gain").alias("gain"), F.max(F.when(F.col("near") == F.col("community"), F.col("gain"))).alias("stay"))
            own = at.join(total, "community").select("node", "community", F.round(-F.col("k") * (F.col("tot") - F.col("k")) / m2, 9).alias("alone"))
            odd = F.xxhash64("node", F.lit(i)).bitwiseAND(F.lit(1)) == 1
            moved = own.join(choice, own.node == choice.src, "left")
            better = odd & F.col("to").isNotNull() & (F.col("gain") > F.coalesce("stay", "alone") + 1e-9)
            new = settle(moved.select("node", F.when(better, F.col("to")).otherwise(F.col("community")).alias("community")))
            now = modularity(e, new).first()[0]
            i += 1
            if now > best + least_gain:
                label, best, idle = new, now, 0
            else:
                idle += 1
        if best <= start + least_gain:
            break
        whole = settle(whole.join(label.toDF("community", "up"), "community").select("node", F.col("up").alias("community")))
        names = label.toDF("node", "c")
        e = settle(e.join(names.toDF("src", "a"), "src").join(names.toDF("dst", "b"), "dst").groupBy(F.col("a").alias("src"), F.col("b").alias("dst")).agg(F.sum("weight").alias("weight")))
    return whole


def modularity(edges: DataFrame, community: DataFrame) -> DataFrame:
    """One row: the modularity of a division of an undirected graph given in both directions."""
    c = community.select("node", "community")
    x = edges.join(c.toDF("src", "cs"), "src").join(c.toDF("dst", "cd"), "dst")
    total = x.agg(F.sum("weight").alias("m2"))
    inside = x.agg(F.sum(F.when(F.col("cs") == F.col("cd"), F.col("weight")).otherwise(0.0)).alias("inside"))
    deg = x.groupBy("cs").agg(F.sum("weight").alias("k")).agg(F.sum(F.col("k") * F.col("k")).alias("k2"))
    return total.crossJoin(inside).crossJoin(deg).select((F.col("inside") / F.col("m2") - F.col("k2") / (F.col("m2") * F.col("m2"))).alias("modularity"))
