"""Remove repeated lines and passages, keeping the earliest occurrence.

Units are all lines, whatever their length, and all windows of ``WINDOW``
words, wherever they begin; so a repeated passage of that length goes to its
last word, and matches reach as far as the words are equal. A window that
repeats holds a repeated seed, the smallest hash of the ``SEED``-word runs in
it. Seeds are counted first, and only windows whose seed repeats go on: all of
them where the seed's neighbouring windows differ from place to place, else
the first and last. The bit maps that tell may let more windows pass, which
changes nothing. A window that overlaps the first of its kind in its own text
doesn't count, so a text of one word over and over keeps a window.

A unit is normalised (A-Z lower-cased, single blanks), hashed to 96 bits and
grouped over all documents; the occurrence with the smallest (doc_id, start)
stays, all others go. A task first groups the units of a block of documents:
what isn't the earliest there can't be the earliest of all, so each block sends
one occurrence of a unit, packed by hash range, however often a line stands in
it. Offsets are code points of the original text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm import textkit as tk
from strandloom.plans.snapshot import snapshot

#: Words of a window and of the runs that its seed is chosen from; the most bits of a seed map, and bytes of text to a bit.
WINDOW, SEED, BITS_MOST, BYTES_A_BIT = 50, 25, 1 << 28, 12
#: Least words of a line that counts.
LINE_WORDS = 1
#: Units and bytes of text that a task groups together, units aimed at in a hash range, and bytes of text to a unit.
BLOCK_UNITS, BLOCK_BYTES, RANGE_UNITS, UNIT_BYTES = 1 << 20, 1 << 25, 400_000, 40

def _runs(h: np.ndarray, size: int, base: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words, over the bounds of rows too."""
    n = len(h) - size + 1
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * tk._power(base, len(h)), out=total[1:])
    return tk.mix((total[size:] - total[:n]) * tk._power(pow(base, -1, 1 << 64), len(h))[:n])


def _slide(x: np.ndarray, size: int, pick: np.ufunc) -> np.ndarray:
    """The least or largest of every ``size`` neighbours, by doubling."""
    done = 1
    while done < size:
        step = min(done, size - done)
        x = pick(x[:-step], x[step:])
        done += step
    return x


_FIRST, _SECOND = 0xD6E8FEB86659FD93 | 1, 0xA0761D6478BD642F | 1


def _stretches(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first words of the windows of some rows, seed of each window; first window of each stretch and the total, digest of each).

    A stretch is a run of neighbouring windows of one seed.
    """
    last = np.repeat(first[1:], np.diff(first))
    at = np.flatnonzero((np.arange(len(h)) + WINDOW <= last)[: max(len(h) - WINDOW + 1, 0)])
    if not len(at):
        return at, np.empty(0, np.uint64), np.zeros(1, np.int64), np.empty(0, np.uint64)
    seed = _slide(_runs(h, SEED, _FIRST), WINDOW - SEED + 1, np.minimum)[at]
    new = np.ones(len(at) + 1, bool)
    new[1:-1] = (seed[1:] != seed[:-1]) | (at[1:] != at[:-1] + 1)
    bound = np.flatnonzero(new)
    one = _runs(h, WINDOW, _FIRST)[at]
    return at, seed, bound, tk.mix(tk.mix(one[bound[:-1]]) + one[bound[1:] - 1] + np.diff(bound).astype(np.uint64))


def _holds(bits: np.ndarray, seed: np.ndarray) -> np.ndarray:
    slot = (seed >> np.uint64(64 - (8 * len(bits)).bit_length() + 1)).astype(np.int64)
    return bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1 == 1


def _spans(words: np.ndarray, first: np.ndarray, last: np.ndarray, base: int) -> np.ndarray:
    """Hashes of the words ``first`` to ``last`` (not with it) of each span."""
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * tk._power(base, len(words)), out=total[1:])
    return tk.mix((total[last] - total[first]) * tk._power(pow(base, -1, 1 << 64), len(words) + 1)[first] + (last - first).astype(np.uint64))


def units(data: np.ndarray, off: np.ndarray, maps: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, ...]:
    """(row, two digests, start, end) of the lines of some texts and of all their windows, or of those that ``maps`` (repeated, mixed) ask for."""
    h, start, _, first = tk.words(data, off)
    other = tk.mix(h ^ np.uint64(_SECOND))
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    # lines
    brk = (data == 10) | (data == 13)
    crlf = np.flatnonzero((data[:-1] == 13) & (data[1:] == 10))
    brk[crlf[~np.isin(crlf + 1, off)]] = False
    begin = np.unique(np.concatenate([off[:-1], np.flatnonzero(brk) + 1]))
    begin = begin[begin < len(data)]
    end = np.append(begin[1:], len(data))
    w0, w1 = np.searchsorted(start, begin), np.searchsorted(start, end)
    ok = w1 - w0 >= LINE_WORDS
    begin, end, w0, w1 = begin[ok], end[ok], w0[ok], w1[ok]
    row = np.searchsorted(off, begin, side="right") - 1
    lines = (row, ~_spans(h, w0, w1, _FIRST), _spans(other, w0, w1, _SECOND), begin, end)  # a line is no window of its words
    # windows
    at, seed, bound, _ = _stretches(h, first)
    if maps is not None and len(at):
        # where all stretches of a seed are equal, so are the places of their windows: the first and last cover the rest
        ends = np.zeros(len(at), bool)
        ends[bound[:-1]] = ends[bound[1:] - 1] = True
        long = np.repeat(np.diff(bound) > WINDOW, np.diff(bound))
        at = at[_holds(maps[0], seed) & (ends | long | _holds(maps[1], seed))]
    one, two = _spans(h, at, at + WINDOW, _FIRST), _spans(other, at, at + WINDOW, _SECOND)
    own = np.searchsorted(first, at, side="right") - 1
    by = np.lexsort((at, two, one, own))
    new = np.ones(len(by), bool)
    new[1:] = (own[by][1:] != own[by][:-1]) | (one[by][1:] != one[by][:-1]) | (two[by][1:] != two[by][:-1])
    lead = at[by][np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))] if len(by) else at
    keep = np.zeros(len(at), bool)
    keep[by] = new | (at[by] >= lead + WINDOW)
    at, own, one, two = at[keep], own[keep], one[keep], two[keep]
    after = at + WINDOW
    stop = np.where(after < first[own + 1], np.append(start, 0)[after], off[own + 1])
    row, one, two, begin, end = (np.concatenate(x) for x in zip(lines, (own, one, two, start[at], stop), strict=True))
    base = points[off[row]]
    return row, one, two, points[begin] - base, points[end] - base


def seed_maps(texts: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bit maps of the seeds of two stretches or more, and of those whose stretches differ. ``texts``: one string column of ``size`` bytes."""
    wide = min(BITS_MOST, max(1 << 16, 1 << (size // BYTES_A_BIT).bit_length()))  # a power of two
    bits = min(wide.bit_length() - 10, max(3, int(size // UNIT_BYTES // RANGE_UNITS).bit_length()))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        n = 0

        def flush():
            seed, digest, many = (np.concatenate(c) for c in zip(*held, strict=True))
            order = np.lexsort((digest, seed))
            seed, digest, many = seed[order], digest[order], many[order]
            new = np.ones(len(seed), bool)
            new[1:] = (seed[1:] != seed[:-1]) | (digest[1:] != digest[:-1])
            at = np.flatnonzero(new)
            many = np.minimum(np.add.reduceat(many, at), 2).astype(np.uint8) if len(at) else many.astype(np.uint8)
            seed, digest = seed[at], digest[at]
            r = (seed >> np.uint64(64 - bits)).astype(np.int64)
            cut = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1], [True]])) if len(r) else [0]
            pairs = list(zip(cut[:-1], cut[1:], strict=True))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([int(r[a]) for a, _ in pairs], pa.int32())] + [pa.array([x[a:b].tobytes() for a, b in pairs], pa.binary()) for x in (seed, digest, many)], ["rng", "seed", "digest", "n"])

        for b in batches:
            for _, data, off in tk.slices(b.column(0)):
                h, _, _, first = tk.words(data, off)
                _, seed, bound, digest = _stretches(h, first)
                if len(digest):
                    held.append((seed[bound[:-1]], digest, 1 + (np.diff(bound) > WINDOW)))  # a long stretch repeats in itself
                    n += len(digest)
                if n >= BLOCK_UNITS:
                    yield flush()
                    n = 0
        if held:
            yield flush()

    def mark(g: pa.Table) -> pa.Table:
        seed, digest, n = (np.concatenate([np.frombuffer(x.as_buffer(), k) for x in g[c]]) for c, k in (("seed", np.uint64), ("digest", np.uint64), ("n", np.uint8)))
        order = np.argsort(seed, kind="stable")
        seed, digest, n = seed[order], digest[order], n[order]
        at = np.flatnonzero(np.concatenate([[True], seed[1:] != seed[:-1]]))
        repeated = np.add.reduceat(n.astype(np.int64), at) > 1
        mixed = np.minimum.reduceat(digest, at) != np.maximum.reduceat(digest, at)
        slot = (seed[at] >> np.uint64(64 - wide.bit_length() + 1)).astype(np.int64) & (wide // (1 << bits) - 1)
        out = np.zeros((2, wide >> bits), bool)
        out[0, slot[repeated]] = True
        out[1, slot[mixed]] = True
        return pa.table({"part": pa.array([g["rng"][0].as_py()], pa.int32()), "bits": pa.array([np.packbits(out, axis=1, bitorder="little").tobytes()], pa.binary())})

    made = texts.mapInArrow(emit, "rng int, seed binary, digest binary, n binary").groupBy("rng").applyInArrow(mark, "part int, bits binary")
    out = np.zeros((2, wide // 8), np.uint8)
    span = (wide >> bits) // 8
    for r in made.toLocalIterator():  # 2 x 32 MB in all at most
        out[:, r["part"] * span : (r["part"] + 1) * span] = np.frombuffer(r["bits"], np.uint8).reshape(2, -1)
    return out[0], out[1]


_PACKED = "rng long, block long, h1 binary, h2 binary, doc binary, about binary, start binary, end binary, idx binary"


def _sent(texts: DataFrame, maps, bits: int) -> DataFrame:
    """Per block its documents with what goes for certain (rng < 0), and the earliest occurrence of each unit there by hash range."""
    names = [x.split()[0] for x in _PACKED.split(", ")]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, blocks, n, size = tk.partition_id(), 0, 0, 0
        docs: dict[tuple[bool, int, int], int] = {}  # (known, id, hash of the text)
        held: list[tuple[np.ndarray, ...]] = []

        def flush():
            nonlocal blocks
            block = (part << 24) | blocks
            blocks += 1
            keys = np.array(list(docs), np.int64).reshape(-1, 3)
            rank = np.empty(len(keys), np.int64)
            order = np.lexsort((keys[:, 2], keys[:, 1], keys[:, 0]))
            rank[order] = np.arange(len(keys))
            idx, one, two, start, end = (np.concatenate(c) for c in zip(*held, strict=True)) if held else (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
            o = np.lexsort((start, rank[idx], two, one))
            idx, one, two, start, end = (v[o] for v in (idx, one, two, start, end))
            new = np.ones(len(idx), bool)
            new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
            gone = np.column_stack([idx[~new], start[~new], end[~new]]).astype(np.uint32)
            idx, one, two, start, end = (v[new] for v in (idx, one, two, start, end))
            r = (one >> np.uint64(64 - bits)).astype(np.int64)
            cut = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1], [True]])) if len(r) else [0]
            pairs = list(zip(cut[:-1], cut[1:], strict=True))
            known, ids, text = keys[idx, 0], keys[idx, 1], keys[idx, 2]
            about = (known | ((text & 0x7FFFFFFF) << 1)).astype(np.uint32)
            cols = (one, (two >> np.uint64(32)).astype(np.uint32), ids, about, start.astype(np.uint32), end.astype(np.uint32), idx.astype(np.uint32))
            out = pa.RecordBatch.from_arrays(
                [pa.array([-1 - block, *(int(r[a]) for a, _ in pairs)], pa.int64()), pa.array([block] * (len(pairs) + 1), pa.int64())]
                + [pa.array([lead, *(x[a:b].tobytes() for a, b in pairs)], pa.binary()) for lead, x in zip((keys.tobytes(), gone.tobytes(), None, None, None, None, None), cols, strict=True)],
                names,
            )
            docs.clear()
            held.clear()
            return out

        for b in batches:
            known = np.array(b.column(0).is_valid(), bool)
            ids, text = b.column(0).fill_null(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)
            for row, data, off in tk.slices(b.column(2)):
                place = np.full(len(off) - 1, -1, np.int64)
                for i in range(len(off) - 1):
                    key = (bool(known[row + i]), int(ids[row + i]), int(text[row + i]))
                    if key not in docs:  # a row that repeats is the same document
                        place[i] = docs[key] = len(docs)
                if len(data):
                    got = units(data, off, maps.value)
                    use = place[got[0]] >= 0
                    held.append((place[got[0][use]], *(v[use] for v in got[1:])))
                    n, size = n + len(held[-1][0]), size + len(data)
                if n >= BLOCK_UNITS or size >= BLOCK_BYTES:
                    yield flush()
                    n = size = 0
        if docs:
            yield flush()

    return texts.mapInArrow(emit, _PACKED)


def _gone(sent: DataFrame) -> DataFrame:
    """(block, keys, gone): the documents of a block, and units of it (document, start, end) that go."""
    schema = pa.schema([("block", pa.int64()), ("keys", pa.binary()), ("gone", pa.binary())])

    def pick(g: pa.Table) -> pa.Table:
        if g["rng"][0].as_py() < 0:
            return pa.table([g["block"], g["h1"], g["h2"]], schema=schema)
        kinds = {"h1": np.uint64, "h2": np.uint32, "doc": np.int64, "about": np.uint32, "start": np.uint32, "end": np.uint32, "idx": np.uint32}
        one, two, ids, about, start, end, idx = (np.concatenate([np.frombuffer(x.as_buffer(), k) for x in g[c]]) for c, k in kinds.items())
        block = np.repeat(g["block"].to_numpy(), [len(x.as_buffer()) // 4 for x in g["idx"]])
        # null ids rank first
        o = np.lexsort((start, about >> 1, ids, about & 1, two, one))
        new = np.ones(len(o), bool)
        a, b = o[1:], o[:-1]
        new[1:] = (one[a] != one[b]) | (two[a] != two[b])
        lead = o[np.maximum.accumulate(np.where(new, np.arange(len(o)), 0))]
        out = np.zeros(len(o), bool)
        out[o] = (ids[o] != ids[lead]) | (about[o] != about[lead]) | (start[o] != start[lead])
        gone, block = np.column_stack([idx[out], start[out], end[out]]), block[out]
        cut = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1], [True]])) if len(block) else [0]
        pairs = list(zip(cut[:-1], cut[1:], strict=True))
        return pa.table([pa.array([int(block[a]) for a, _ in pairs], pa.int64()), pa.nulls(len(pairs), pa.binary()), pa.array([gone[a:b].tobytes() for a, b in pairs], pa.binary())], schema=schema)

    return sent.groupBy("rng").applyInArrow(pick, "block long, keys binary, gone binary")


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, th, spans): documents by id and hash of the text, and what goes of them as sorted disjoint (start, end)."""
    t = F.col(text).cast("string")
    size = docs.agg(F.sum(F.octet_length(t))).first()[0] or 0
    bits = max(3, int(size // UNIT_BYTES // RANGE_UNITS).bit_length())
    maps = docs.sparkSession.sparkContext.broadcast(seed_maps(docs.select(t), size))
    sent = _sent(docs.select(F.col(doc_id).cast("long"), F.xxhash64(t), t), maps, bits)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    schema = pa.schema([("id", pa.int64()), ("th", pa.int64()), ("spans", kind)])

    def merge(g: pa.Table) -> pa.Table:
        keys = np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in g["keys"] if x.is_valid]).reshape(-1, 3)
        gone = np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in g["gone"]]).reshape(-1, 3).astype(np.int64)
        idx, start, end = gone[np.lexsort((gone[:, 1], gone[:, 0]))].T
        # a span opens where none of the document before it reaches
        reach = np.maximum.accumulate(end + (idx << 33))
        new = np.ones(len(idx), bool)
        new[1:] = (idx[1:] != idx[:-1]) | (start[1:] + (idx[1:] << 33) > reach[:-1])
        at = np.flatnonzero(new)
        start, end = start[at], np.maximum.reduceat(end, at) if len(at) else end
        idx = idx[at]
        cut = np.flatnonzero(np.concatenate([[True], idx[1:] != idx[:-1], [True]])) if len(idx) else np.zeros(1, np.int64)
        own = keys[idx[cut[:-1]]]
        spans = pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.StructArray.from_arrays([pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))], ["start", "end"]))
        return pa.table([pa.array(own[:, 1], mask=own[:, 0] == 0), pa.array(own[:, 2]), spans.cast(kind)], schema=schema)

    made = _gone(sent).groupBy("block").applyInArrow(merge, "id long, th long, spans array<struct<start:int,end:int>>")
    return snapshot(made, "dedup-spans").dropDuplicates(["id", "th"])  # rows of one document in several blocks lose the same


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", out: str = "text", spans: str = "removed") -> DataFrame:
    """``docs`` with repeated units cut out of the text and the cut spans (start, end) of the original.

    Null texts stay null; empty and blank ones have no units. A row that
    repeats another's id and text counts as the same document: its units stay
    where the other's do. Rows of one id and other texts are ranked by a hash
    of the text. Null doc_ids rank first. An empty table gives no rows. Every
    column of ``docs`` is kept, whatever its name; ``removed`` is added (an
    input column of that name is replaced).
    """
    cut = repeated_spans(docs, doc_id, text)
    cols = [c for c in docs.columns if c != spans]
    others = [c for c in cols if c != text]
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    quoted = lambda c: F.col("`" + c.replace("`", "``") + "`")
    # columns travel under numbers, so their names can't clash with ours
    plain = docs.select(quoted(doc_id).cast("long").alias("_id"), quoted(text).cast("string").alias("_t"), *(quoted(c).alias(f"_{i}") for i, c in enumerate(others)))
    joined = plain.withColumn("_h", F.xxhash64("_t")).join(cut.toDF("_cut", "_th", "_spans"), F.col("_id").eqNullSafe(F.col("_cut")) & (F.col("_h") == F.col("_th")), "left")
    inner = joined.select("_t", "_spans", *(f"_{i}" for i in range(len(others))))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                kept = []
                for t, sp in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    if t is not None and sp:
                        at = [0, *(x for s in sp for x in (s["start"], s["end"])), len(t)]
                        t = "".join(t[a:b] for a, b in zip(at[::2], at[1::2], strict=True))
                    kept.append(t)
                gone = part.column(1)
                if gone.null_count:
                    gone = pa.array([x or [] for x in gone.to_pylist()], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
                rest = [part.column(i) for i in range(2, part.num_columns)]
                yield pa.RecordBatch.from_arrays([pa.array(kept, pa.string()), gone, *rest], ["_t", "_s", *(f"_{i}" for i in range(len(rest)))])

    schema = ", ".join(["_t string", "_s array<struct<start:int,end:int>>", *(f"_{i} {kinds[c]}" for i, c in enumerate(others))])
    done = inner.mapInArrow(apply, schema)
    back = {c: F.col(f"_{i}").alias(c) for i, c in enumerate(others)} | {text: F.col("_t").alias(out)}
    return done.select(*(back[c] for c in cols), F.col("_s").alias(spans))
