"""One-permutation MinHash fingerprints of documents.

Every shingle is hashed once: the top bits pick one of ``BINS`` bins, the rest
is the value, and a bin keeps its least value. Empty bins borrow from full
ones by optimal densification: bin i tries h(i, 1), h(i, 2), ... of a fixed
2-universal sequence until it meets a full bin, so two sets agree in a
borrowed bin with the probability of their similarity. The lowest ``BITS``
bits of each bin are packed. Chance agreement of 2**-BITS is taken out of the
likeness: (agreement - 2**-BITS) / (1 - 2**-BITS), at least 0.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm import textkit as tk

BINS, BITS = 512, 4
#: Rows aimed at in a bucket of consecutive doc_ids, and the most buckets (the driver holds one id of each).
BUCKET_ROWS, BUCKETS_MOST = 250, 100_000
_EMPTY = np.uint64(2**64 - 1)


def signatures(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(low bits of every bin, whether the text has words), a row per text."""
    sig, some = [], []
    for _, data, off in tk.slices(texts):
        h, _, _, first = tk.words(data, off)
        s, at = tk.shingles(h, first)
        n = len(off) - 1
        low = np.full(n * BINS, _EMPTY)
        row = np.repeat(np.arange(n), np.diff(at))
        slot = row * BINS + (s >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
        np.minimum.at(low, slot, s & np.uint64((1 << 54) - 1))
        low = low.reshape(n, BINS)
        sig.append(densify(low))
        some.append(np.diff(at) > 0)
    if not sig:
        return np.zeros((0, BINS), np.uint8), np.zeros(0, bool)
    return np.concatenate(sig), np.concatenate(some)


def densify(low: np.ndarray) -> np.ndarray:
    """Fill empty bins and keep the low bits of a finalised value; rows without any value give zeros."""
    full = low != _EMPTY
    filled = low.copy()
    row, bin_ = np.nonzero(~full & full.any(1)[:, None])
    step = 1
    while len(row):
        probe = (tk.mix((bin_ * 1_000_003 + step).astype(np.uint64)) % np.uint64(BINS)).astype(np.int64)
        hit = full[row, probe]
        filled[row[hit], bin_[hit]] = low[row[hit], probe[hit]]
        row, bin_ = row[~hit], bin_[~hit]
        step += 1
    return (tk.mix(filled) & np.uint64((1 << BITS) - 1)).astype(np.uint8) * full.any(1)[:, None].astype(np.uint8)


def packed(sig: np.ndarray, some: np.ndarray) -> list[str]:
    """Base64 of two bins a byte; the empty string for texts without words."""
    both = (sig[:, ::2] << 4) | sig[:, 1::2]
    return [base64.b64encode(r.tobytes()).decode() if x else "" for r, x in zip(both, some, strict=True)]


def likeness(a: np.ndarray, b: np.ndarray, some_a: np.ndarray, some_b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity; 1 for two texts without words, 0 for one."""
    chance = 2.0**-BITS
    near = np.maximum(((a == b).mean(1) - chance) / (1 - chance), 0)
    return np.where(some_a & some_b, near, (~some_a & ~some_b).astype(float))


_OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprint_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text, and the likenesses.

    The edited text has its last floor(n_chars / 4) code points replaced by as
    many first code points (or all) of the next document by ascending doc_id;
    after the last comes the first. Null texts are empty. Equal doc_ids are
    ordered by text; null doc_ids come first. A table of one row is its own
    next document; an empty table gives no rows.

    Neighbours are found without a global sort: quantiles of doc_id (at most
    ``BUCKETS_MOST`` numbers) cut the ids into buckets, and the first id of
    each bucket is also sent to the bucket before it.
    """
    sc = docs.sparkSession.sparkContext
    d = docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    n, least = d.select(F.count("*"), F.min("id")).first()
    if not n:
        return d.mapInArrow(lambda it: iter(()), _OUT)
    parts = int(min(max(1, n // BUCKET_ROWS), BUCKETS_MOST))
    cuts = np.zeros(0, np.int64)
    if parts > 1:
        share = [i / parts for i in range(1, parts)]
        got = d.select(F.percentile_approx("id", share, 20 * parts)).first()[0]
        cuts = np.unique(np.array(got, np.int64))
        cuts = cuts[cuts > least] if least is not None else cuts
    shared = sc.broadcast(cuts)
    nulls = d.where("id is null").limit(1).count() > 0

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The bucket of each row, and the head of a bucket once more for the one before."""
        cuts = shared.value
        for b in batches:
            ids = b.column(0)
            key = np.where(ids.is_null().to_numpy(zero_copy_only=False), np.iinfo(np.int64).min, ids.fill_null(0).to_numpy(zero_copy_only=False))
            bucket = np.searchsorted(cuts, key, side="right").astype(np.int32)
            head = np.zeros(len(key), bool)
            if len(cuts):
                head = (bucket > 0) & (cuts[np.maximum(bucket - 1, 0)] == key)
            very_first = ids.is_null().to_numpy(zero_copy_only=False) if nulls else key == least
            ends = np.full(int(very_first.sum()), len(cuts), np.int32)
            for level, pick, where in ((0, np.arange(len(key)), bucket), (1, np.flatnonzero(head), bucket[head] - 1), (2, np.flatnonzero(very_first), ends)):
                if len(pick):
                    x = b.take(pa.array(pick))
                    yield pa.RecordBatch.from_arrays([pa.array(where.astype(np.int32)), pa.array(np.full(len(pick), level, np.int32)), x.column(0), x.column(1)], ["bucket", "level", "id", "t"])

    dealt = d.mapInArrow(deal, "bucket int, level int, id long, t string")
    width = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    ordered = dealt.repartition(width, "bucket").sortWithinPartitions("bucket", "level", "id", "t")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows wait until the next document has come; a look-ahead row only serves as next."""
        held: list[tuple] = []  # (bucket, level, id, text)
        size = 0

        def done(rows: list[tuple]) -> pa.RecordBatch | None:
            own = [i for i in range(len(rows) - 1) if rows[i][1] == 0 and rows[i + 1][0] == rows[i][0]]
            if not own:
                return None
            texts = [rows[i][3] for i in own]
            edited = []
            for i in own:
                t, k = rows[i][3], len(rows[i][3]) // 4
                edited.append(t[: len(t) - k] + rows[i + 1][3][:k] if k else t)
            need = sorted({*own, *(i + 1 for i in own)})
            place = {i: p for p, i in enumerate(need)}
            sig, some = signatures(pa.array([rows[i][3] for i in need], pa.large_string()))
            e_sig, e_some = signatures(pa.array(edited, pa.large_string()))
            a, b = np.array([place[i] for i in own]), np.array([place[i + 1] for i in own])
            fp = packed(sig[a], some[a])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([rows[i][2] for i in own], pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited]), pa.array(fp), pa.array(packed(e_sig, e_some)),
                    pa.array(likeness(sig[a], e_sig, some[a], e_some)), pa.array(likeness(sig[a], sig[b], some[a], some[b])),
                ],
                [x.split()[0] for x in _OUT.split(", ")],
            )

        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                held.append(r)
                size += len(r[3])
                if size > 1 << 20:
                    out = done(held)
                    if out is not None:
                        yield out
                    held, size = held[-1:], len(held[-1][3])
        out = done(held)
        if out is not None:
            yield out

    return ordered.mapInArrow(walk, _OUT)
