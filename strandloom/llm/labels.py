"""Labelled documents, by the fold rules of the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Label rows (12 bytes each) that may be broadcast; beyond it the texts are shuffled to the labels.
BROADCAST_ROWS = 1 << 22


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def with_label(docs: DataFrame, labels: DataFrame, label: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, t, y): every row of ``docs`` with its label or null; several labels of an id count as the largest."""
    y = labels.select(F.col("doc_id").cast("long").alias("_k"), F.col(label).cast("int").alias("y")).where("_k is not null and y is not null").groupBy("_k").agg(F.max("y").alias("y"))
    if y.count() <= BROADCAST_ROWS:
        y = F.broadcast(y)
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("t"))
    return d.join(y, F.col("doc_id") == F.col("_k"), "left").select("doc_id", "t", "y")
