"""The ``opN_<name>`` queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.llm import pieces, url_filter, warc
from strandloom.llm.fingerprints import fingerprint_edits
from strandloom.llm.jaccard_join import jaccard_components
from strandloom.llm.packing import pack_documents
from strandloom.llm.quality import score_quality
from strandloom.llm.substring_dedup import deduplicate
from strandloom.llm.toxicity import score_toxicity
from strandloom.llm.vector_search import nearest
from strandloom.plans.session import bound_arrow_batches


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_arrow_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its number of ids, their hash, and whether decoding gives the text back."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"))
    back = pieces.encode(docs, path, keep=("doc_id", "sha"), decoded="decoded")  # in one worker, not in two that each hold the model
    back = back.withColumn("decoded_sha256", F.sha2("decoded", 256))
    return back.select("doc_id", F.size("ids").cast("long").alias("n_ids"), F.xxhash64("ids").alias("ids_hash"), (F.col("decoded_sha256") == F.col("sha")).alias("round_trip"), "decoded_sha256")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = warc.read_archives(warc.write_archives(_table(spark, sf_dir, "pages")))
    number = lambda c: F.nullif(F.substring_index(c, ":", -1), F.lit("null")).cast("long")
    digest = F.when(F.col("record_type") == "revisit", F.col("declared_digest")).otherwise(F.col("digest_so_far"))
    return chunks.where("last").select(number("record_id").alias("page_id"), "payload_bytes", digest.alias("payload_digest"), "record_type", number("refers_to").alias("refers_to"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(_table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"), url_filter.listing(spark))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: how much went, the spans as start-end text, and the digest of what stays."""
    done = deduplicate(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda acc, x: acc + x["end"] - x["start"])
    spans = F.array_join(F.transform("removed", lambda x: F.concat_ws("-", x["start"].cast("string"), x["end"].cast("string"))), ",")
    return done.select("doc_id", F.size("removed").cast("long").alias("n_removed"), gone.alias("removed_chars"), spans.alias("removed_spans"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(_table(spark, sf_dir, "embeddings"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_warc": op2_warc,
    "op3_fingerprints": op3_fingerprints,
    "op4_packing": op4_packing,
    "op5_toxicity": op5_toxicity,
    "op6_url_filter": op6_url_filter,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_quality": op8_quality,
    "op9_vector_search": op9_vector_search,
    "op10_jaccard_join": op10_jaccard_join,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _fits(host: str, path: str) -> str:
    return f"(host = '{host}' OR host LIKE '%.{host}') AND path LIKE '{path}%'"


_RULES = sorted(url_filter.RULES, key=lambda r: -len(r[0] + r[1]))

ORACLES: dict[str, str] = {
    "op2_warc": """WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages), q AS (SELECT *, max(page_id) OVER (PARTITION BY t) AS m FROM p)
SELECT page_id, CAST(strlen(t) AS BIGINT) AS payload_bytes, sha1(t) AS payload_digest,
CASE WHEN strlen(t) >= 1000 AND m <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
CASE WHEN strlen(t) >= 1000 AND m <> page_id THEN m END AS refers_to FROM q""",
    "op6_url_filter": f"""WITH u AS (SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{_UPPER}', '{_LOWER}') AS host,
coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages)
SELECT page_id, host, path, CASE {" ".join(f"WHEN {_fits(h, p)} THEN '{h}{p}'" for h, p, _ in _RULES)} END AS rule,
CASE {" ".join(f"WHEN {_fits(h, p)} THEN '{v}'" for h, p, v in _RULES)} {" ".join(f"WHEN host = '{x[:-1]}' OR host LIKE '%.{x[:-1]}' THEN 'block'" for x in url_filter.LISTED)} ELSE 'allow' END AS verdict FROM u""",
    "op10_jaccard_join": rf"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
two AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, two.b FROM r JOIN two ON two.a = r.b)
SELECT r.a AS doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.b) AS component_id FROM r LEFT JOIN n ON n.doc_id = r.a GROUP BY r.a""",
}
