"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

A text becomes counts of hashed terms: byte triples, word shapes and pairs of
equal neighbouring words. Logarithms of the counts, scaled to length one, are
projected on the leading singular vectors of a bounded sample of labelled
training rows. The sample's latent vectors (``SAMPLE`` rows of ``LATENT``
numbers) are broadcast; every document meets all of them in blocked cosine
products, and its nearest ``NEIGHBOURS`` vote with their similarity as weight.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm import textkit as tk
from strandloom.llm.labels import fold, with_label

#: Bound on the labelled rows the classifier is fitted on: those of smallest hashed doc_id.
SAMPLE = 4096
TERMS, SHAPES, REPEATS, LATENT, NEIGHBOURS, BLOCK = 1 << 11, 1 << 8, 8, 64, 15, 512
FOLDS, HELD_OUT = 3, 1
#: Rounds of the block Krylov method at most.
ROUNDS = 12
WIDTH = TERMS + SHAPES + REPEATS
#: Similarity to this power weighs a vote.
SHARPNESS = 4

# kinds of characters for word shapes: other, lower, upper, digit, mark, beyond ASCII
_KIND = np.zeros(256, np.uint64)
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 1, 2, 3, 5
_KIND[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 4


def term_vectors(texts: pa.Array) -> np.ndarray:
    """One row of ``WIDTH`` scaled term weights per text; zeros without words."""
    out = []
    for _, data, off in tk.slices(texts, 1 << 20):
        n = len(off) - 1
        v = np.zeros((n, WIDTH), np.float32)
        if len(data):
            row = np.repeat(np.arange(n), np.diff(off))
            x = data.astype(np.uint32)
            three = np.zeros(len(x), np.uint32)
            three[:-2] = (x[:-2] << 16) | (x[1:-1] << 8) | x[2:]
            ok = np.zeros(len(x), bool)
            ok[:-2] = row[:-2] == row[2:]
            slot = ((three * np.uint32(2654435761)) >> np.uint32(21)).astype(np.int64)
            v[:, :TERMS] = np.bincount((row * TERMS + slot)[ok], minlength=n * TERMS).reshape(n, TERMS)
            h, start, end, first = tk.words(data, off)
            if len(h):
                w_row = np.repeat(np.arange(n), np.diff(first))
                # shape: kinds at the word's first, second, last but one and last place, and a length class
                size = end - start
                shape = _KIND[data[start]]
                for at in (np.minimum(start + 1, end - 1), np.maximum(end - 2, start), end - 1):
                    shape = shape * np.uint64(6) + _KIND[data[at]]
                shape = shape * np.uint64(8) + np.minimum(size // 3, 7).astype(np.uint64)
                slot = (tk.mix(shape) % np.uint64(SHAPES)).astype(np.int64)
                v[:, TERMS : TERMS + SHAPES] = 2 * np.bincount(w_row * SHAPES + slot, minlength=n * SHAPES).reshape(n, SHAPES)
                same = np.flatnonzero((h[1:] == h[:-1]) & (w_row[1:] == w_row[:-1]))
                share = np.bincount(w_row[same], minlength=n) / np.maximum(1, np.diff(first))
                level = np.minimum((share * REPEATS * 2).astype(np.int64), REPEATS - 1)
                some = np.flatnonzero(share > 0.02)
                v[some, TERMS + SHAPES + level[some]] = np.expm1(12)
        np.log1p(v, out=v)
        length = np.sqrt(np.einsum("ij,ij->i", v, v))
        v /= np.maximum(length, 1e-12)[:, None]
        out.append(v)
    return np.concatenate(out) if out else np.zeros((0, WIDTH), np.float32)


def fit_latent(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection) of the leading right singular vectors of the centred rows.

    Block Krylov: the rows' products with blocks of vectors, all held
    orthogonal, until the leading ones settle. No matrix of all columns by all
    columns is made, as the driver has little memory.
    """
    mean = x.mean(0, dtype=np.float64).astype(np.float32)
    k = min(LATENT, x.shape[1])
    if x.shape[1] <= 4 * LATENT:
        cov = np.zeros((x.shape[1], x.shape[1]))
        for a in range(0, len(x), BLOCK):
            z = (x[a : a + BLOCK] - mean).astype(np.float64)
            cov += z.T @ z
        return mean, np.linalg.eigh(cov)[1][:, ::-1][:, :k].astype(np.float32)

    def times(v: np.ndarray) -> np.ndarray:
        out = np.zeros(v.shape)
        for a in range(0, len(x), BLOCK):
            z = (x[a : a + BLOCK] - mean).astype(np.float64)
            out += z.T @ (z @ v)
        return out

    q = np.linalg.qr(np.random.default_rng(0).standard_normal((x.shape[1], k + 16)))[0]
    last = None
    for _ in range(ROUNDS):
        base, block = [q], q
        for _ in range(2):
            block = times(block)
            for _ in range(2):  # twice is enough to be orthogonal
                for b in base:
                    block -= b @ (b.T @ block)
                block = np.linalg.qr(block)[0]
            base.append(block)
        basis = np.concatenate(base, axis=1)
        values, turn = np.linalg.eigh(basis.T @ times(basis))
        q, values = basis @ turn[:, ::-1][:, : k + 16], values[::-1][:k]
        if last is not None and np.abs(values - last).max() <= 1e-9 * values[0]:
            break
        last = values
    return mean, q[:, :k].astype(np.float32)


def _unit(z: np.ndarray) -> np.ndarray:
    return z / np.maximum(np.sqrt(np.einsum("ij,ij->i", z, z)), 1e-9)[:, None]


def vote(z: np.ndarray, known: np.ndarray, y: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
    """Similarity-weighted share of label 1 among the k most similar known rows; all rows, in blocks."""
    k = min(k, len(known))
    out = np.empty(len(z))
    for a in range(0, len(z), BLOCK):
        sim = z[a : a + BLOCK] @ known.T
        near = np.argpartition(-sim, k - 1, axis=1)[:, :k]
        w = np.maximum(np.take_along_axis(sim, near, 1).astype(np.float64), 1e-3) ** SHARPNESS
        out[a : a + BLOCK] = (w * y[near]).sum(1) / w.sum(1)
    return out


def score_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", text_hash: bool = False) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Null, empty and blank texts score the training rate of label 1, as does
    every text where the sample has one class or no rows (then a half).
    Repeated rows are scored each; a null doc_id is held out. Equal texts have
    equal scores; ties among neighbours weigh the same. An empty table gives
    no rows; columns other than the two named are ignored, whatever their
    names. ``text_hash`` adds a hash of the text, which tells rows of one id
    apart.
    """
    sc = docs.sparkSession.sparkContext
    rows = with_label(docs, labels, label, doc_id, text)
    train = rows.where(F.col("y").isNotNull() & (fold(F.col("doc_id"), FOLDS) != HELD_OUT)).withColumn("o", F.xxhash64("doc_id"))
    # the sample is chosen by ids alone, so that few texts are turned into vectors
    last = train.select("o").orderBy("o").limit(SAMPLE).agg(F.max("o"), F.count("*")).first()

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = term_vectors(b.column(0))
            yield pa.RecordBatch.from_arrays([pa.array([r.astype(np.float16).tobytes() for r in x], pa.binary()), b.column(1), b.column(2)], ["x", "y", "o"])

    model = None
    rate = 0.5
    if last[1]:
        got = train.where(F.col("o") <= last[0]).select("t", "y", "o").mapInArrow(vectors, "x binary, y int, o long").orderBy("o", "x").limit(SAMPLE).collect()
        x, y = np.empty((len(got), WIDTH), np.float16), np.array([r["y"] for r in got], np.float64)
        for i, r in enumerate(got):
            x[i] = np.frombuffer(r["x"], np.float16)
        del got
        rate = float(y.mean())
        if 0 < y.sum() < len(y):
            mean, proj = fit_latent(x)
            model = (mean, proj, _unit(np.concatenate([(x[a : a + BLOCK] - mean) @ proj for a in range(0, len(x), BLOCK)])), y)
    shared = sc.broadcast((model, rate))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, rate = shared.value
        for b in batches:
            p = []
            for a in range(0, b.num_rows, 1024):
                x = term_vectors(b.column(2).slice(a, 1024))
                q = np.full(len(x), rate)
                if model is not None:
                    mean, proj, known, y = model
                    some = x.any(1)
                    q[some] = vote(_unit((x[some] - mean) @ proj), known, y)
                p.append(q)
            p = np.clip(np.concatenate(p) if p else np.zeros(0), 0, 1)
            more = [b.column(i) for i in range(3, b.num_columns)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(p), pa.array((p >= 0.5).astype(np.int32)), *more], ["doc_id", "held_out", "score", "predicted", "text_hash"][: 4 + len(more)])

    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(fold(F.col(doc_id).cast("long"), FOLDS) == HELD_OUT, F.lit(True)).alias("held_out"), F.col(text).cast("string").alias("t"))
    out = "doc_id long, held_out boolean, score double, predicted int"
    if text_hash:
        d, out = d.withColumn("h", F.xxhash64("t")), out + ", text_hash long"
    return d.mapInArrow(score, out)
