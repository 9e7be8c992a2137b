"""Set algebra on memberships: long form for joins, arrays and bitmaps for single rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def members_of(rows: DataFrame, key: str, member: str, out: str = "members") -> DataFrame:
    """Ascending distinct members of each key."""
    return rows.groupBy(key).agg(F.array_sort(F.collect_set(member)).alias(out))


def union(a: Column, b: Column) -> Column:
    return F.array_sort(F.array_union(a, b))


def intersection(a: Column, b: Column) -> Column:
    return F.array_sort(F.array_intersect(a, b))


def difference(a: Column, b: Column) -> Column:
    return F.array_sort(F.array_except(a, b))


def disjoint(a: Column, b: Column) -> Column:
    return ~F.arrays_overlap(a, b)


def bitmap_of(rows: DataFrame, key: str, member: str, out: str = "bits") -> DataFrame:
    """One bitmap for each key and block of 32768 member numbers; ``bitmap_or_agg`` unites and ``bitmap_count`` counts them."""
    m = F.col(member).cast("long")
    return rows.groupBy(key, F.bitmap_bucket_number(m).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(m)).alias(out))


def shared_pairs(rows: DataFrame, key: str, member: str, pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Number of members that both keys of each given pair have."""
    left = rows.select(F.col(key).alias(a), F.col(member).alias("_m")).distinct()
    right = rows.select(F.col(key).alias(b), F.col(member).alias("_m")).distinct()
    return pairs.join(left, a).join(right, [b, "_m"]).groupBy(a, b).agg(F.count("*").alias("shared"))
