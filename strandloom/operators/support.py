"""Support of nodes and edges, and what is reported from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Class by percent of genomes (at least), most common first.
CLASSES = (("core", 99.0), ("soft_core", 95.0), ("shell", 15.0), ("cloud", 0.0))


def node_support(genes: DataFrame, node: str, genome: str, has_end: str | None = None) -> DataFrame:
    """size (occurrences), n_genomes, and whether any occurrence is at a contig end."""
    end = F.bool_or(has_end) if has_end else F.lit(False)
    return genes.groupBy(node).agg(F.count("*").alias("size"), F.countDistinct(genome).alias("n_genomes"), end.alias("has_end"))


def edge_support(adjacent: DataFrame, a: str, b: str, genome: str) -> DataFrame:
    """Undirected edges u <= v with traversals and the number of different genomes."""
    e = adjacent.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v"), F.col(genome).alias("_g"))
    return e.groupBy("u", "v").agg(F.count("*").alias("traversals"), F.countDistinct("_g").alias("n_genomes"))


def edge_members(adjacent: DataFrame, a: str, b: str, genome: str) -> DataFrame:
    return adjacent.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v"), F.col(genome).alias("genome")).distinct()


def is_paralog(genes: DataFrame, cluster: str, genome: str, out: str = "paralog") -> DataFrame:
    """Whether some genome has a cluster more than once (exact counts)."""
    return genes.groupBy(cluster).agg(F.count(genome).alias("occurrences"), F.countDistinct(genome).alias("n_genomes")).withColumn(out, F.col("occurrences") != F.col("n_genomes"))


def class_of(n: Column, total: Column) -> Column:
    percent = n * 100.0 / total
    out = F.lit(CLASSES[-1][0])
    for name, least in reversed(CLASSES[:-1]):
        out = F.when(percent >= least, name).otherwise(out)
    return out


def class_counts(nodes: DataFrame, n: str, total: DataFrame) -> DataFrame:
    """Number of nodes of each class, zeros included, and in all. ``total``: one row with the number of genomes."""
    spark = nodes.sparkSession
    t = total.toDF("_total")
    counts = nodes.crossJoin(F.broadcast(t)).groupBy(class_of(F.col(n), F.col("_total")).alias("class")).agg(F.count("*").alias("n_nodes"))
    names = spark.createDataFrame([(c,) for c, _ in CLASSES], "class string")
    each = names.join(counts, "class", "left").select("class", F.coalesce("n_nodes", F.lit(0)).cast("long").alias("n_nodes"))
    return each.unionByName(nodes.agg(F.lit("total").alias("class"), F.count("*").alias("n_nodes")))


def presence_matrix(genes: DataFrame, node: str, genome: str, seq_id: str, genomes: list) -> DataFrame:
    """A row for each node, a column for each genome: its ids in order joined by ``;``, empty where it has none.

    The genome list is the matrix's columns, so it is given, not collected here.
    """
    wide = genes.groupBy(node).pivot(genome, genomes).agg(F.array_join(F.array_sort(F.collect_list(seq_id)), ";"))
    return wide.select(node, *(F.coalesce(F.col(f"`{g}`"), F.lit("")).alias(str(g)) for g in genomes))


def presence_calls(matrix: DataFrame, node: str) -> DataFrame:
    """The 0/1 form of a presence matrix."""
    return matrix.select(node, *(F.when(F.col(f"`{c}`") == "", 0).otherwise(1).alias(c) for c in matrix.columns if c != node))


def core_nodes(nodes: DataFrame, n: str, total: DataFrame, threshold: float) -> DataFrame:
    return nodes.crossJoin(F.broadcast(total.toDF("_total"))).where(F.col(n) / F.col("_total") >= threshold).drop("_total")


def core_subset(core: DataFrame, order: list[str], most: int) -> DataFrame:
    """The first ``most`` core nodes in node order; an error if there are fewer."""
    got = core.orderBy(*order).limit(most)
    enough = got.agg((F.count("*") >= most).alias("_ok")).select(F.when(~F.col("_ok"), F.raise_error(F.lit("fewer core genes than asked for")).cast("boolean")).otherwise(F.lit(True)).alias("_ok"))
    return got.join(F.broadcast(enough), F.col("_ok")).drop("_ok")


def clashing(members: DataFrame, group: str, genome: str) -> DataFrame:
    """Genomes that stand in more than one node of a merge."""
    return members.groupBy(group, genome).agg(F.count("*").alias("n_nodes")).where("n_nodes > 1")


def singleton_share(members: DataFrame, group: str, genome: str) -> DataFrame:
    """Per merge, the share of genomes that stand in exactly one node."""
    each = members.groupBy(group, genome).agg(F.count("*").alias("_k"))
    return each.groupBy(group).agg(F.count(F.when(F.col("_k") == 1, 1)).alias("ones"), F.count("*").alias("genomes")).withColumn("share", F.col("ones") / F.col("genomes"))


def overused(incident: DataFrame, node: str, genome: str, most: int = 3) -> DataFrame:
    """(node, genome) with more than ``most`` incident edges."""
    return incident.groupBy(node, genome).agg(F.count("*").alias("n_edges")).where(F.col("n_edges") > most)


def consensus_removal(hits: DataFrame, nodes: DataFrame, node: str, size: str) -> DataFrame:
    """Nodes with more failed hits than occurrences."""
    return hits.groupBy(node).agg(F.count("*").alias("n_hits")).join(nodes.select(node, size), node).where(F.col("n_hits") > F.col(size))


def length_outlier(protein_length: Column, mode: Column) -> Column:
    """As published: the mode is a nucleotide length and stands on both sides, so this holds for tiny modes only."""
    return F.abs(protein_length - mode) / mode > 0.05 * mode


def matrix_order() -> list[Column]:
    """Rows of a matrix: most isolates first, then the later entry."""
    return [F.desc("n_isolates"), F.desc("entry")]
