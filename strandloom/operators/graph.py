"""Graph operators over plain edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandloom.operators.positions import numbered
from strandloom.plans.snapshot import snapshot


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """Label every vertex of ``edges`` with one representative of its component.

    Contraction: each vertex points to its smallest neighbour in hashed order
    (or itself), endpoints are replaced by what they point to, loops and
    repeats are dropped, until no edge is left; then the maps are composed.
    Hashed order makes long chains shrink by a constant factor a round. All
    state is tables; only the edge count reaches the driver.

    Returns ``(node, component)``; ``component`` is a vertex of the component,
    the same for all of its vertices. Loops give a row; null ends are dropped.
    """
    e = edges.select(F.col(src).alias("s"), F.col(dst).alias("d")).where("s is not null and d is not null")
    rank = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v"))
    e = snapshot(e.distinct(), "cc-edges")
    maps = []
    for _ in range(max_rounds):
        both = e.select("s", "d").union(e.select(F.col("d").alias("s"), F.col("s").alias("d")))
        m = both.groupBy("s").agg(F.min(rank("d")).alias("m")).select(F.col("s").alias("node"), F.least(F.col("m"), rank("s"))["v"].alias("to"))
        m = snapshot(m, "cc-map")
        maps.append(m)
        to_s = m.select(F.col("node").alias("s"), F.col("to").alias("s2"))
        to_d = m.select(F.col("node").alias("d"), F.col("to").alias("d2"))
        nxt = e.join(to_s, "s").join(to_d, "d").where("s2 <> d2")
        nxt = nxt.select(F.least("s2", "d2").alias("s"), F.greatest("s2", "d2").alias("d")).distinct()
        e = snapshot(nxt, "cc-edges")
        if e.isEmpty():
            break
    else:
        raise RuntimeError("connected_components did not converge")
    out = maps[0].select("node", F.col("to").alias("component"))
    for k, m in enumerate(maps[1:]):
        step = m.select(F.col("node").alias("component"), "to")
        out = out.join(step, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
        if k % 4 == 3:
            out = snapshot(out, "cc-labels")
    return out


def component_numbers(edges: DataFrame, nodes: DataFrame, node: str, ord_: str, src: str = "src", dst: str = "dst") -> DataFrame:
    """``nodes`` with the number (from 1) of its component by its first node, and its place in it."""
    labels = connected_components(edges, src, dst).withColumnRenamed("node", node)
    own = nodes.join(labels, node, "left").withColumn("component", F.coalesce("component", node))
    first = own.groupBy("component").agg(F.min(ord_).alias("_first"))
    number = numbered(first, ["_first"], 1, "fragment").select("component", "fragment")
    place = F.row_number().over(Window.partitionBy("component").orderBy(ord_)).cast("long")
    return own.join(number, "component").withColumn("place", place).drop("component")


def both_ways(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    e = edges.select(F.col(src).alias("a"), F.col(dst).alias("b"))
    return e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()


def degrees(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Number of incident edges; a loop counts twice."""
    e = edges.select(F.explode(F.array(F.col(src), F.col(dst))).alias("node"))
    return e.groupBy("node").agg(F.count("*").alias("degree"))


def k_hop(edges: DataFrame, seeds: DataFrame, k: int, src: str = "src", dst: str = "dst", seed: str = "node") -> DataFrame:
    """(seed, node, depth) of nodes within k steps; depth 0 is the seed itself. Frontiers shrink by an anti-join with what was seen."""
    pairs = both_ways(edges, src, dst)
    seen = seeds.select(F.col(seed).alias("seed"), F.col(seed).alias("node"), F.lit(0).alias("depth")).distinct()
    frontier = seen
    for d in range(1, k + 1):
        step = frontier.join(pairs, F.col("node") == F.col("a")).select("seed", F.col("b").alias("node")).distinct()
        frontier = snapshot(step.join(seen, ["seed", "node"], "left_anti").withColumn("depth", F.lit(d)), "khop")
        seen = seen.unionByName(frontier)
    return seen


def shortest_paths(edges: DataFrame, pairs: DataFrame, most: int, src: str = "src", dst: str = "dst", a: str = "a", b: str = "b") -> DataFrame:
    """Steps between given pairs, null beyond ``most`` steps. Searches grow from the left ends only."""
    ends = pairs.select(F.col(a).alias("seed")).distinct()
    reach = k_hop(edges, ends, most, src, dst, "seed").select(F.col("seed").alias(a), F.col("node").alias(b), F.col("depth").alias("steps"))
    return pairs.join(reach, [a, b], "left")


def trim_tips(nodes: DataFrame, edges: DataFrame, node: str, size: str, least: int, rounds: int, src: str = "src", dst: str = "dst") -> tuple[DataFrame, DataFrame]:
    """Drop nodes of at most one neighbour and less support than ``least``, again and again until none is left or ``rounds`` are over.

    Returns the nodes and edges that stay.
    """
    n, e = nodes, edges
    for _ in range(rounds):
        deg = degrees(e.where(F.col(src) != F.col(dst)), src, dst).withColumnRenamed("node", node)
        bad = snapshot(n.join(deg, node, "left").where((F.coalesce("degree", F.lit(0)) <= 1) & (F.col(size) < least)).select(node), "tips")
        if bad.isEmpty():
            break
        n = snapshot(n.join(bad, node, "left_anti"), "trim-nodes")
        e = e.join(bad.withColumnRenamed(node, src), src, "left_anti").join(bad.withColumnRenamed(node, dst), dst, "left_anti")
        e = snapshot(e.select(*edges.columns), "trim-edges")
    return n, e


def clean_edges(edges: DataFrame, nodes: DataFrame, node: str, size: str, has_end: str, threshold: float, src: str = "u", dst: str = "v", edge_size: str = "size") -> DataFrame:
    """Edges less those under the threshold that touch a contig end, or have under 5 % of the support of both nodes."""
    x = nodes.select(F.col(node).alias(src), F.col(size).alias("_su"), F.col(has_end).alias("_eu"))
    y = nodes.select(F.col(node).alias(dst), F.col(size).alias("_sv"), F.col(has_end).alias("_ev"))
    few = F.col(edge_size) < threshold
    bad = few & (F.col("_eu") | F.col("_ev") | (F.col(edge_size) < 0.05 * F.least("_su", "_sv")))
    return edges.join(x, src).join(y, dst).where(~bad).select(*edges.columns)


def delete_nodes(edge_genomes: DataFrame, gone: DataFrame, node: str = "node") -> DataFrame:
    """Edge memberships (u, v, genome) after nodes go: each genome's neighbours of a node that goes become neighbours.

    For nodes that are not neighbours of one another; neighbours go one after
    the other.
    """
    two = edge_genomes.select("u", "v", "genome").union(edge_genomes.select(F.col("v").alias("u"), F.col("u").alias("v"), "genome")).distinct()
    at = two.join(gone.select(F.col(node).alias("u")), "u", "left_semi")
    left = at.select("u", "genome", F.col("v").alias("a"))
    right = at.select("u", "genome", F.col("v").alias("b"))
    new = left.join(right, ["u", "genome"]).where("a < b").select(F.col("a").alias("u"), F.col("b").alias("v"), "genome")
    keep = edge_genomes.join(gone.select(F.col(node).alias("u")), "u", "left_anti").join(gone.select(F.col(node).alias("v")), "v", "left_anti")
    return keep.select("u", "v", "genome").union(new).distinct()


def remove_members(edge_genomes: DataFrame, gone: DataFrame, node: str = "node", genome: str = "genome") -> DataFrame:
    """As ``delete_nodes``, for single genomes of nodes: (node, genome) pairs that go."""
    g = gone.select(F.col(node).alias("u"), F.col(genome).alias("genome"))
    two = edge_genomes.select("u", "v", "genome").union(edge_genomes.select(F.col("v").alias("u"), F.col("u").alias("v"), "genome")).distinct()
    at = two.join(g, ["u", "genome"], "left_semi")
    new = at.select("u", "genome", F.col("v").alias("a")).join(at.select("u", "genome", F.col("v").alias("b")), ["u", "genome"]).where("a < b").select(F.col("a").alias("u"), F.col("b").alias("v"), "genome")
    keep = edge_genomes.join(g, ["u", "genome"], "left_anti").join(g.withColumnRenamed("u", "v"), ["v", "genome"], "left_anti")
    return keep.select("u", "v", "genome").union(new).distinct()


def merge_nodes(edge_genomes: DataFrame, relabel: DataFrame, old: str = "old", new: str = "new") -> DataFrame:
    """Edge memberships after nodes are merged: ends relabelled, inner edges dropped, members united."""
    r = relabel.select(F.col(old).alias("_o"), F.col(new).alias("_n"))
    e = edge_genomes.join(r, F.col("u") == F.col("_o"), "left").withColumn("u", F.coalesce("_n", "u")).drop("_o", "_n")
    e = e.join(r, F.col("v") == F.col("_o"), "left").withColumn("v", F.coalesce("_n", "v")).drop("_o", "_n")
    return e.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"), "genome").distinct()


def subgraph(edges: DataFrame, nodes: DataFrame, node: str, src: str = "src", dst: str = "dst") -> DataFrame:
    n = nodes.select(F.col(node).alias("_n")).distinct()
    return edges.join(n, F.col(src) == F.col("_n"), "left_semi").join(n, F.col(dst) == F.col("_n"), "left_semi")


def is_connected(edges: DataFrame, nodes: DataFrame, node: str, ord_: str, src: str = "src", dst: str = "dst") -> bool:
    return component_numbers(edges, nodes, node, ord_, src, dst).agg(F.max("fragment")).first()[0] in (None, 1)
