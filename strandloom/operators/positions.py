"""Position-dependent operators: each is one window over the order within a contig."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.plans.snapshot import snapshot


def gene_index(genes: DataFrame, contig: list[str], order: list[str], out: str = "pos") -> DataFrame:
    """Zero-based place of a gene on its contig."""
    return genes.withColumn(out, (F.row_number().over(Window.partitionBy(*contig).orderBy(*order)) - 1).cast("long"))


def contig_rank(genes: DataFrame, genome: str, contig: str, ordinal: str, out: str = "contig_rank") -> DataFrame:
    """Zero-based number of a contig by where its genome first shows it."""
    first = genes.groupBy(genome, contig).agg(F.min(ordinal).alias("_first"))
    return first.withColumn(out, (F.dense_rank().over(Window.partitionBy(genome).orderBy("_first", contig)) - 1).cast("long")).drop("_first")


def adjacency(genes: DataFrame, contig: list[str], pos: str, node: str) -> DataFrame:
    """A row for each gene that follows another on its contig: the columns of ``genes`` and prev_node."""
    w = Window.partitionBy(*contig).orderBy(pos)
    return genes.withColumn("prev_node", F.lag(node).over(w)).where(F.col("prev_node").isNotNull())


def contig_ends(genes: DataFrame, contig: list[str], pos: str, out: str = "has_end") -> DataFrame:
    """Whether a gene is the first or last of its contig."""
    w = Window.partitionBy(*contig).orderBy(pos)
    return genes.withColumn(out, F.lag(pos).over(w).isNull() | F.lead(pos).over(w).isNull())


def numbered(rows: DataFrame, order: list[str], start: int | Column = 0, out: str = "id", buckets: int | None = None) -> DataFrame:
    """Consecutive numbers in a global order, without sending all rows to one task.

    Rows are dealt into ranges of the order, counted per range, numbered
    within their range, and moved by what the ranges before hold: the only
    window over everything has a row for each range. The ranges are written
    once, so both readings see the same ones. As many ranges as the session
    has shuffle partitions, 64 at least.
    """
    buckets = buckets or max(64, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = snapshot(rows.repartitionByRange(buckets, *order).withColumn("_range", F.spark_partition_id()), "numbered")
    counts = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_skip", F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_range", "_skip")
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return ranged.join(F.broadcast(before), "_range").withColumn(out, (F.col("_skip") + within + start).cast("long")).drop("_range", "_skip")


def paralog_copy_ids(genes: DataFrame, genome: str, cluster: str, order: list[str], n_clusters: int, out: str = "node") -> DataFrame:
    """Fresh node ids, from ``n_clusters`` + 1 in gene order, for genes of clusters that some genome has twice."""
    twice = genes.groupBy(cluster).agg(F.count(genome).alias("_a"), F.countDistinct(genome).alias("_b")).where("_a <> _b").select(cluster)
    return numbered(genes.join(twice, cluster, "left_semi"), order, n_clusters + 1, out)


def running_spans(rows: DataFrame, order: list[str], length: str, group: list[str] | None = None) -> DataFrame:
    """Running start (1-based) and end of parts that are laid one after the other."""
    end = F.sum(length).over(Window.partitionBy(*(group or [])).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("end", end.cast("long")).withColumn("start", (F.col("end") - F.col(length) + 1).cast("long"))


def unique_names(rows: DataFrame, name: str, order: list[str], out: str = "unique_name") -> DataFrame:
    """The first row of each name (whatever its case, not empty) keeps it, the others are group_0, group_1, ... in order."""
    first = F.row_number().over(Window.partitionBy(F.lower(name)).orderBy(*order))
    marked = rows.withColumn("_again", (first > 1) | (F.col(name) == ""))
    again = numbered(marked.where("_again"), order, 0, "_k").withColumn(out, F.concat(F.lit("group_"), F.col("_k").cast("string")))
    kept = marked.where("not _again").withColumn("_k", F.lit(None).cast("long")).withColumn(out, F.col(name))
    return kept.unionByName(again).drop("_again", "_k")


def unique_ids(rows: DataFrame, group: list[str], base: str, order: list[str], out: str = "unique_id") -> DataFrame:
    """Repeated ids get _1, _2, ... in order.

    A suffixed id that some row has as its own is passed over: suffixes are
    taken from the numbers that are free in the group.
    """
    w = Window.partitionBy(*group, base).orderBy(*order)
    n = rows.withColumn("_n", F.row_number().over(w) - 1)
    taken = rows.select(*group, F.regexp_extract(base, r"^(.*)_([1-9]\d*)$", 1).alias("_base"), F.regexp_extract(base, r"_([1-9]\d*)$", 1).cast("long").alias("_s")).where("_base <> ''")
    taken = taken.groupBy(*group, "_base").agg(F.array_sort(F.collect_set("_s")).alias("_taken")).withColumnRenamed("_base", base)
    # the n-th free number: n plus the taken ones that are not beyond it
    free = F.aggregate(F.coalesce("_taken", F.array().cast("array<bigint>")), F.col("_n").cast("long"), lambda acc, x: F.when(x <= acc, acc + 1).otherwise(acc))
    return n.join(taken, [*group, base], "left").withColumn(out, F.when(F.col("_n") == 0, F.col(base)).otherwise(F.concat_ws("_", base, free.cast("string")))).drop("_n", "_taken")


def first_mode(values: DataFrame, group: list[str], value: str, ordinal: str) -> DataFrame:
    """Smallest, largest, mean and most frequent value, of equally frequent ones that seen first."""
    each = values.groupBy(*group, value).agg(F.count("*").alias("_k"), F.min(ordinal).alias("_o"))
    return each.groupBy(*group).agg(
        F.min(value).alias("len_min"), F.max(value).alias("len_max"),
        (F.sum(F.col(value) * F.col("_k")) / F.sum("_k")).alias("len_mean"),
        F.max_by(value, F.struct(F.col("_k"), (-F.col("_o")).alias("o"))).alias("len_mode"),
    )
