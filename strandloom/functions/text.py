"""Identifiers, attributes and formatting as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sample_key(seq_id: Column) -> Column:
    """An id without its last two fields."""
    return F.regexp_replace(seq_id, r"_[^_]*_[^_]*$", "")


def clean_gene_name(annotation: Column) -> Column:
    """Non-empty parts between semicolons joined by ~~~, keeping letters, digits, _ and ~."""
    parts = F.filter(F.split(annotation, ";"), lambda x: x != "")
    return F.regexp_replace(F.array_join(parts, "~~~"), r"[^\p{L}\p{Nl}\p{Nd}\p{No}_~]", "")


def percent_decode(s: Column) -> Column:
    """Escapes of two hex digits decoded, other percent signs and plus signs kept."""
    safe = F.replace(F.regexp_replace(s, r"%(?![0-9A-Fa-f]{2})", "%25"), F.lit("+"), F.lit("%2B"))
    return F.when(s.contains("%"), F.url_decode(safe)).otherwise(s)


def strip_quotes(s: Column) -> Column:
    t = F.trim(s)
    return F.when((F.length(t) >= 2) & t.startswith('"') & t.endswith('"'), F.substring(t, F.lit(2), F.length(t) - 2)).otherwise(t)


def attributes(field: Column) -> Column:
    """(key, values) of column nine in order: split raw, then unquoted and decoded; repeated keys add to the first."""
    parts = F.filter(F.transform(F.split(field, ";"), lambda p: F.trim(p)), lambda p: p != "")
    key = lambda p: F.trim(F.split(p, "=", 2)[0])
    raw = lambda p: F.coalesce(F.get(F.split(p, "=", 2), F.lit(1)), F.lit(""))
    values = lambda p: F.when(raw(p) == "", F.array().cast("array<string>")).otherwise(F.transform(F.split(raw(p), ","), lambda v: percent_decode(strip_quotes(v))))
    pairs = F.transform(parts, lambda p: F.struct(key(p).alias("key"), values(p).alias("values")))
    keys = F.array_distinct(F.transform(pairs, lambda x: x["key"]))
    return F.transform(keys, lambda k: F.struct(k.alias("key"), F.flatten(F.transform(F.filter(pairs, lambda x: x["key"] == k), lambda x: x["values"])).alias("values")))


def attribute(attrs: Column, key: str) -> Column:
    """All values of a key, null where it is absent."""
    return F.try_element_at(F.filter(attrs, lambda x: x["key"] == key), F.lit(1))["values"]


def wrap(seq: Column, width: int = 60) -> Column:
    """Lines of a sequence; an empty one is an empty line."""
    return F.regexp_replace(seq, f"(.{{{width}}})(?!$)", "$1\n")


def stem(path: Column) -> Column:
    """The file name without folders and its last extension."""
    return F.regexp_extract(path, r"([^/]*?)(\.[^./]*)?$", 1)


def extension(path: Column) -> Column:
    return F.regexp_extract(path, r"[^/](\.[^./]*)$", 1)


def name_to_first_dot(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/.]*)[^/]*$", 1)


def number_text(x: Column) -> Column:
    """Shortest decimal text of a double, plain up to 1e16 as scripts print it."""
    whole = (x == F.floor(x)) & (F.abs(x) < 1e16)
    return F.when(whole, F.concat(F.format_string("%d", F.when(whole, x).cast("long")), F.lit(".0"))).otherwise(x.cast("string"))


def floor_div(a: Column, b: Column) -> Column:
    """Integer quotient towards minus infinity, exact for all longs; null where b is 0."""
    x, y = a.cast("long"), F.nullif(b.cast("long"), F.lit(0).cast("long"))
    return F.when(y.isNotNull(), F.call_function("div", x, y) - F.when((x % y != 0) & ((x < 0) != (y < 0)), F.lit(1)).otherwise(F.lit(0))).cast("long")


def floor_mod(a: Column, b: Column) -> Column:
    """What ``floor_div`` leaves; of b's sign."""
    y = F.nullif(b.cast("long"), F.lit(0).cast("long"))
    return (a.cast("long") % y + F.when((a.cast("long") % y != 0) & ((a.cast("long") < 0) != (y < 0)), y).otherwise(F.lit(0))).cast("long")


def utc_now_text() -> Column:
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def alignment_name(name: Column, most: int = 248) -> Column:
    """A gene's file base name, cut where file systems would refuse it."""
    return F.substring(name, F.lit(1), F.lit(most))
