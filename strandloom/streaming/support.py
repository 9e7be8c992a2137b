"""Edge support over a stream of genes: an addition of this engine's own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_support(genes: DataFrame, time: str, node: str, genome: str, window: str = "1 day", late: str = "2 hours") -> DataFrame:
    """Occurrences and (about how many) genomes of each node per window; rows later than ``late`` are dropped."""
    g = genes.withWatermark(time, late)
    return g.groupBy(F.window(time, window), node).agg(F.count("*").alias("size"), F.approx_count_distinct(genome).alias("n_genomes"))


def sessions(genes: DataFrame, time: str, genome: str, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """Runs of genes of one genome without a gap: the stream's contigs."""
    return genes.withWatermark(time, late).groupBy(F.session_window(time, gap), genome).agg(F.count("*").alias("n_genes"))
