"""The corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet to the shared folder and reads it back as the next
stage's documents. Stages one to four return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.llm.jaccard_join import jaccard_components
from strandloom.llm.packing import pack_documents
from strandloom.llm.quality import score_quality
from strandloom.llm.substring_dedup import deduplicate
from strandloom.llm.toxicity import score_toxicity
from strandloom.plans.session import bound_arrow_batches, give_back
from strandloom.plans.snapshot import mark, release, snapshot

#: Rejected rows (16 bytes each) that may be broadcast; beyond it both sides are shuffled.
BROADCAST_ROWS = 1 << 21


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_arrow_batches(spark)
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _written(make: Callable[[], DataFrame], spark: SparkSession, name: str) -> DataFrame:
    """The result of ``make``, written; what it wrote on its way goes then, and the driver's unused memory before and after."""
    give_back(spark)
    since = mark()
    out = snapshot(make(), name)
    release(spark, since)
    give_back(spark)
    return out


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model doesn't reject.

    Null, empty and blank texts say nothing and stay. Rows that repeat an id
    and text go or stay together; rows of one id and other texts are judged
    each, as are rows without an id. An empty table gives no rows. All columns
    stay, whatever their names.
    """
    scored = _written(lambda: score_toxicity(docs, _labels(spark, sf_dir), text_hash=True).select("doc_id", "text_hash", "predicted"), spark, "toxic-scores")
    return _without(docs, scored.where("predicted = 1"))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality vote doesn't reject. Null, empty and blank texts get the rate of good labels; other rows as in ``drop_toxic``."""
    scored = _written(lambda: score_quality(docs, _labels(spark, sf_dir), text_hash=True).select("doc_id", "text_hash", "predicted"), spark, "quality-scores")
    return _without(docs, scored.where("predicted = 0"))


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rows whose id (null is an id too) and text are not among the rejected."""
    rejected = rejected.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("h")).distinct()
    if rejected.count() <= BROADCAST_ROWS:
        rejected = F.broadcast(rejected)
    cols = [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]
    key, text = (f"_{docs.columns.index(c)}" for c in ("doc_id", "text"))
    numbered = docs.select(*(c.alias(f"_{i}") for i, c in enumerate(cols)))
    same = F.col(key).cast("long").eqNullSafe(F.col("id")) & (F.xxhash64(F.col(text).cast("string")) == F.col("h"))
    return numbered.join(rejected, same, "left_anti").select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(docs.columns)))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near copies.

    Documents without words are groups of their own. Rows that repeat the id
    and text of the document that stays, stay with it; rows without an id stay
    where no document of their group has one. An empty table gives no rows.
    """
    bound_arrow_batches(spark)
    groups = _written(lambda: jaccard_components(docs, text_hash=True), spark, "near-groups")
    return _without(docs, groups.where("not (component_id <=> doc_id)"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines and long passages that an earlier one has; n_chars follows the text (0 for null). Other rows as in ``deduplicate``."""
    bound_arrow_batches(spark)
    done = deduplicate(docs, spans="_removed").drop("_removed").withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.lit(0).cast("long")))
    return done.select(*(F.col("`" + c.replace("`", "``") + "`") for c in docs.columns))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 1024 ids. Null and empty texts are their end id; other rows as in ``pack_documents``."""
    bound_arrow_batches(spark)
    packed = pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("quality classifier", drop_low_quality),
    ("n-gram Jaccard join", one_of_each_group),
    ("substring dedup", drop_repeated_lines),
    ("packing", pack_sequences),
]

#: Trained models and exact joins of shingle sets with components are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn. Each one's result is written; what it wrote on the way and its input then go."""
    docs, since = spark.read.parquet(f"{sf_dir}/documents.parquet"), mark()
    for name, stage in STAGES:
        docs = snapshot(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
        release(spark, since)
    return docs
