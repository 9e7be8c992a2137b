"""Toxicity by class-conditional Kneser-Ney models.

One model is counted from all toxic training texts, one from all ordinary
ones: P_c(v | u) = max(c(uv) - D2, 0) / c(u.) + L_c(u) P_c(v), with the
continuation level P_c(v) = max(N_c(.v) - D1, 0) / N_c(..) + L_c P(v), where
N_c(.v) counts the different words before v. The last backoff P(v) is the
continuation distribution of *all* documents, shared by both classes: exact
counts of the different words that each word of the vocabulary follows in the
whole corpus. What a class lacks is left to it, so rare expressions weigh
little. Words that no training text has would back off to the same value in
both models and say nothing.

A text is scored by differences of log-likelihoods divided by length: of the
whole text under the pair models, and of its best word and its ``BEST`` best words
under the continuation levels. Of documents with many copies the pair level
learns whole passages by heart, so single words are left to the continuation
level, in which a copy counts once; how much that is discounted
(``DISCOUNTS``) is chosen, and the three numbers are mapped to 0..1 by a
logistic function, on rows that the counts have not seen.

No row is left out: class counts come from every training row, P(v) from all
documents, the logistic function from every calibration row. A word stands in
one of ``SLOTS`` slots by its hash; words of a slot count as one. Pairs of
slots are counted exactly, in tables that Spark aggregates by hash range and
that grow with the corpus. The model is of fixed size: counts of pairs in
``PAIRS`` slots, discounts and totals (from the exact counts) by word slot.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm import textkit as tk
from strandloom.llm.labels import fold, with_label
from strandloom.plans.snapshot import mark, release, snapshot

#: Slots of words (a pair of them fits 40 bits; slot 0 is the begin of a text) and of pairs in the model, and slots that are summed together.
SLOT_BITS = 20
SLOTS, PAIRS, SLOTS_AT_ONCE = 1 << SLOT_BITS, 1 << 20, 1 << 13
#: Of five folds by crc32: 0 is held out, 1 calibrates, 2-4 are counted.
FOLDS, HELD_OUT, CALIBRATION = 5, 0, 1
#: Discounts of the continuation level that are tried, and how many best words of a text are taken together.
DISCOUNTS, BEST = (0.75, 2.0, 3.5, 5.0), 3
#: Words a task counts at a time, and words aimed at in a hash range (``WORD_BYTES`` of text each).
COUNT_AT_ONCE, RANGE_WORDS, WORD_BYTES = 1 << 20, 1 << 20, 6
#: The hash that stands before the first word of a text.
BEGIN = np.uint64(0)


def neighbours(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """(word before, word, first word of each row and the total, first row) of slices of texts."""
    for row, data, off in tk.slices(texts):
        h, _, _, first = tk.words(data, off)
        before = np.empty_like(h)
        before[1:] = h[:-1]
        before[first[:-1][first[:-1] < len(h)]] = BEGIN
        yield before, h, first, row


def word_slots(h: np.ndarray) -> np.ndarray:
    """Slots of word hashes, 0 for the begin of a text."""
    return np.where(h == BEGIN, 0, 1 + (h % np.uint64(SLOTS - 1)).astype(np.int64))


def pair_slots(key: np.ndarray) -> np.ndarray:
    """Slots of pairs, given as 40 bits."""
    return (tk.mix(key.astype(np.uint64)) & np.uint64(PAIRS - 1)).astype(np.int64)


def _bytes_of(x: np.ndarray, wide: int) -> np.ndarray:
    """The low ``wide`` bytes of 64-bit numbers."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :wide])


def _numbers(chunks, wide: int, turned: bool = False) -> np.ndarray:
    """Numbers of ``wide`` bytes; ``turned``: all first bytes, then all second ones and so on."""
    low = np.concatenate([np.frombuffer(x.as_buffer(), np.uint8) for x in chunks])
    low = low.reshape(wide, -1).T if turned else low.reshape(-1, wide)
    out = np.zeros((len(low), 8), np.uint8)
    out[:, :wide] = low
    return out.view(np.uint64).ravel()


def class_tables(rows: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts over all ``rows`` (t, y) with ``size`` bytes of text; first toxic, then ordinary.

    (class, pair slot): how often its pairs stand there. (class, k, word
    slot), of the exact pairs of word slots: k = 0 how often it is the word
    before, 1-3 in how many pairs with count 1, 2 and more, 4 how many
    different words it follows. (class, k): pairs with count k + 1, to four.
    """
    # values of half a megabyte and more would each take whole regions of the JVM's heap
    ranges = 1 << min(max(5, (4 * size // WORD_BYTES // RANGE_WORDS).bit_length()), 14)
    share = PAIRS // ranges

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush():
            key, many = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            r = (pair_slots(key >> np.uint64(1)) // share).astype(np.int32)
            order = np.argsort(r, kind="stable")
            key, many, r = key[order], many[order].astype(np.uint32), r[order]
            cut = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1], [True]])) if len(r) else [0]
            low = _bytes_of(key, 6)
            got = [(int(r[a]), low[a:b].T.tobytes(), many[a:b].tobytes()) for a, b in zip(cut[:-1], cut[1:], strict=True)]
            r, *rest = zip(*got, strict=True) if got else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(r, pa.int32()), *(pa.array(x, pa.binary()) for x in rest)], ["rng", "k", "many"])

        for b in batches:
            y = b.column(1).to_numpy(zero_copy_only=False)
            for u, v, first, row in neighbours(b.column(0)):
                kind = np.repeat(y[row : row + len(first) - 1] != 1, np.diff(first)).astype(np.uint64)
                held.append(((word_slots(u) << SLOT_BITS | word_slots(v)).astype(np.uint64) << np.uint64(1)) | kind)
                n += len(u)
                if n >= COUNT_AT_ONCE:
                    yield flush()
                    n = 0
        if held:
            yield flush()

    def count(g: pa.Table) -> pa.Table:
        # sorted numbers, byte by byte: the high bytes take no room when compressed
        key, many = np.concatenate([_numbers([x], 6, True) for x in g["k"]]), np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in g["many"]])
        key, own = np.unique(key, return_inverse=True)
        c = np.bincount(own, many, len(key)).astype(np.int64)
        kind, pair = (key & np.uint64(1)).astype(np.int64), key >> np.uint64(1)
        u, v, slot = (pair >> np.uint64(SLOT_BITS)).astype(np.int64), (pair & np.uint64(SLOTS - 1)).astype(np.int64), pair_slots(pair)
        dense = np.stack([np.bincount(slot[kind == k] % share, c[kind == k], share) for k in (0, 1)]).astype(np.float32)
        often = np.stack([np.bincount(c[(kind == k) & (c <= 4)], minlength=5)[1:] for k in (0, 1)]).astype(np.int64)
        at = np.union1d(u, v)
        a, b = np.searchsorted(at, u), np.searchsorted(at, v)
        of = np.zeros((len(at), 10), np.uint32)
        for k in (0, 1):
            for j, w in enumerate((c, c == 1, c == 2, c >= 3)):
                of[:, 5 * k + j] = np.bincount(a[kind == k], w[kind == k], len(at))
            of[:, 5 * k + 4] = np.bincount(b[kind == k], minlength=len(at))
        out = [(-1, int(slot[0]) // share, dense.tobytes(), often.tobytes())] if len(slot) else []
        cut = np.searchsorted(at, np.arange(0, SLOTS + 1, SLOTS_AT_ONCE))
        out += [(i, 0, at[x:y].astype(np.uint32).tobytes(), of[x:y].T.tobytes()) for i, (x, y) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if x < y]
        part, rng, x, y = zip(*out, strict=True) if out else ((), (), (), ())
        return pa.table({"part": pa.array(part, pa.int32()), "rng": pa.array(rng, pa.int32()), "x": pa.array(x, pa.binary()), "y": pa.array(y, pa.binary())})

    def total(g: pa.Table) -> pa.Table:
        part = g["part"][0].as_py()
        sums = np.zeros((SLOTS_AT_ONCE, 10))
        for x, y in zip(g["x"], g["y"], strict=True):
            sums[np.frombuffer(x.as_buffer(), np.uint32) - np.uint32(part * SLOTS_AT_ONCE)] += np.frombuffer(y.as_buffer(), np.uint32).reshape(10, -1).T
        return pa.table({"part": pa.array([part], pa.int32()), "x": pa.array([np.ascontiguousarray(sums.T).astype(np.float32).tobytes()], pa.binary())})

    since = mark()
    counted = snapshot(rows.mapInArrow(emit, "rng int, k binary, many binary").groupBy("rng").applyInArrow(count, "part int, rng int, x binary, y binary"), "toxic-counts")
    pairs, often, words = np.zeros((2, PAIRS), np.float32), np.zeros((2, 4), np.int64), np.zeros((2, 5, SLOTS), np.float32)
    for r in counted.where("part < 0").toLocalIterator():
        pairs[:, r["rng"] * share : (r["rng"] + 1) * share] = np.frombuffer(r["x"], np.float32).reshape(2, -1)
        often += np.frombuffer(r["y"], np.int64).reshape(2, 4)
    for r in counted.where("part >= 0").select("part", "x", "y").groupBy("part").applyInArrow(total, "part int, x binary").toLocalIterator():
        words[:, :, r["part"] * SLOTS_AT_ONCE : (r["part"] + 1) * SLOTS_AT_ONCE] = np.frombuffer(r["x"], np.float32).reshape(2, 5, -1)
    release(rows.sparkSession, since, keep=0)
    return pairs, words, often


def class_counts(rows: DataFrame) -> tuple[np.ndarray, ...]:
    """(word before, word, count in toxic, count in ordinary texts) of all pairs of ``rows`` (t, y), which must be few; ``class_tables`` counts any number."""

    def merge(u: np.ndarray, v: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.lexsort((v, u))
        u, v, c = u[order], v[order], c[order]
        del order
        at = np.flatnonzero(np.concatenate([[True], (u[1:] != u[:-1]) | (v[1:] != v[:-1])])) if len(u) else np.zeros(0, np.int64)
        return u[at], v[at], np.add.reduceat(c, at, axis=0).astype(np.uint32) if len(at) else c

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for b in batches:
            y = b.column(1).to_numpy(zero_copy_only=False)
            for u, v, first, row in neighbours(b.column(0)):
                own = np.repeat(y[row : row + len(first) - 1], np.diff(first))
                held.append(merge(u, v, np.column_stack([own == 1, own != 1]).astype(np.uint32)))
        if held:
            u, v, c = merge(*(np.concatenate(x) for x in zip(*held, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (u, v, c)], ["u", "v", "c"])

    got = rows.mapInArrow(count, "u binary, v binary, c binary").collect()
    kinds = (("u", np.uint64), ("v", np.uint64), ("c", np.uint32))
    u, v, c = (np.concatenate([np.frombuffer(r[k], d) for r in got] or [np.zeros(0, d)]) for k, d in kinds)
    u, v, c = merge(u, v, c.reshape(-1, 2))
    return u, v, c[:, 0].astype(np.int64), c[:, 1].astype(np.int64)


def _place(vocabulary: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Places in the sorted vocabulary; its length for other words."""
    if not len(vocabulary):
        return np.zeros(len(words), np.int64)
    at = np.searchsorted(vocabulary, words)
    at[at == len(vocabulary)] = 0
    return np.where(vocabulary[at] == words, at, len(vocabulary))


def continuations(texts: DataFrame, vocabulary: np.ndarray | None, often: np.ndarray, size: int) -> np.ndarray:
    """How many different words each word of the vocabulary follows in all texts (one string column of ``size`` bytes).

    Without a vocabulary: how many different word slots each slot follows that ``often`` has.
    ``often``: share of a word among all words, by which frequent ones are parted over ranges.
    """
    ranges = max(4, int(size // WORD_BYTES // RANGE_WORDS))
    parts = np.maximum(1, np.ceil(4 * ranges * often)).astype(np.int64)
    shared = texts.sparkSession.sparkContext.broadcast((vocabulary, parts, often > 0))
    wide = 5 if vocabulary is not None else 3

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, parts, some = shared.value
        held, n = [], 0

        def flush():
            # 24 bits of the word's place, 40 of the hash before it
            key = np.unique(np.concatenate(held))
            v, u = (key >> np.uint64(40)).astype(np.int64), key & np.uint64((1 << 40) - 1)
            r = (tk.mix((v << 20).astype(np.uint64) + u % parts[v].astype(np.uint64)) % np.uint64(ranges)).astype(np.int32)
            order = np.argsort(r, kind="stable")  # keeps words together
            v, u, r = v[order], u[order], r[order]
            cut = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1], [True]])) if len(r) else [0]
            low = _bytes_of(u, wide)
            rows = []
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                at = np.flatnonzero(np.concatenate([[True], v[a + 1 : b] != v[a : b - 1], [True]]))
                rows.append((int(r[a]), v[a:b][at[:-1]].astype(np.uint32).tobytes(), np.diff(at).astype(np.uint32).tobytes(), low[a:b].tobytes()))
            held.clear()
            r, *rest = zip(*rows, strict=True) if rows else ((), (), (), ())
            return pa.RecordBatch.from_arrays([pa.array(r, pa.int32()), *(pa.array(x, pa.binary()) for x in rest)], ["rng", "v", "many", "u"])

        for b in batches:
            for u, v, _, _ in neighbours(b.column(0)):
                if vocabulary is None:
                    at, u = word_slots(v), word_slots(u).astype(np.uint64)
                    ok = some[at]
                else:
                    at, u = _place(vocabulary, v), tk.mix(u) >> np.uint64(24)
                    ok = at < len(vocabulary)
                held.append(np.unique((at[ok].astype(np.uint64) << np.uint64(40)) | u[ok]))
                n += len(held[-1])
                if n >= COUNT_AT_ONCE:
                    yield flush()
                    n = 0
        if held:
            yield flush()

    def count(g: pa.Table) -> pa.Table:
        v, many = (np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in g[c]]) for c in ("v", "many"))
        key = np.unique(_numbers(g["u"], wide) | (np.repeat(v, many).astype(np.uint64) << np.uint64(40)))
        own, n = np.unique((key >> np.uint64(40)).astype(np.uint32), return_counts=True)
        return pa.table({"v": pa.array([own.tobytes()], pa.binary()), "n": pa.array([n.astype(np.int64).tobytes()], pa.binary())})

    out = np.zeros(len(often), np.int64)
    for r in texts.mapInArrow(emit, "rng int, v binary, many binary, u binary").groupBy("rng").applyInArrow(count, "v binary, n binary").toLocalIterator():
        np.add.at(out, np.frombuffer(r["v"], np.uint32), np.frombuffer(r["n"], np.int64))
    return out


def discount_values(n: list[int]) -> np.ndarray:
    """What is taken from counts of 0, 1, 2 and more, by the usual estimate from how often counts of 1 to 4 are."""
    n = [max(int(x), 1) for x in n]
    y = n[0] / (n[0] + 2 * n[1])
    return np.array([0.0, *(min(max(i - (i + 1) * y * n[i] / n[i - 1], 0.1 * i), 0.95 * i) for i in (1, 2, 3))])


def discounts(counts: np.ndarray) -> np.ndarray:
    """What is taken from each count."""
    return discount_values([np.count_nonzero(counts == i) for i in (1, 2, 3, 4)])[np.minimum(counts, 3)]


def continuation_level(follows: np.ndarray, shared: np.ndarray, fixed: float | None = None) -> np.ndarray:
    """P(v) of a class from how many different words each word follows in it; ``fixed``: its discount, else estimated."""
    taken = np.minimum(follows, fixed) if fixed else np.where(follows > 0, discounts(follows), 0.0)
    total = max(follows.sum(), 1)
    return (follows - taken) / total + (taken.sum() / total if follows.any() else 1.0) * shared


def class_model(u: np.ndarray, v: np.ndarray, c: np.ndarray, shared: np.ndarray, fixed: float | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(discounted share of each pair, backoff weight of each word before, continuation probability of each word).

    ``u``, ``v``: places of the pairs' words (u may be one past the
    vocabulary, the begin of a text); ``c``: their counts in the class;
    ``shared``: the backoff distribution; ``fixed``: discount of the
    continuation level, else estimated. A word before that the class lacks
    has weight 1.
    """
    some = c > 0
    follows = np.bincount(v[some], minlength=len(shared))
    p1 = continuation_level(follows, shared, fixed)
    taken2 = np.zeros(len(c))
    taken2[some] = discounts(c[some])
    of = np.bincount(u, c, minlength=len(shared) + 1)
    back = np.where(of > 0, np.bincount(u, taken2, minlength=len(shared) + 1) / np.maximum(of, 1), 1.0)
    return (c - taken2) / np.maximum(of[u], 1), back, p1


def fit_model(pairs: np.ndarray, words: np.ndarray, often: np.ndarray, follows: np.ndarray) -> dict[str, np.ndarray]:
    """What ``features`` needs, by slot, toxic and ordinary side by side, of the tables of ``class_tables`` and the shared ``follows``.

    ``seen``: words of training texts. ``pair``: discounted counts. ``share``:
    one by the count of the word before. ``back``: backoff weights. ``p``:
    continuation levels. ``single``: log ratios of those for each discount.
    """
    seen = words[:, 4].sum(0) > 0
    shared = np.where(seen, np.maximum(follows, 1), 0) / max(np.where(seen, np.maximum(follows, 1), 0).sum(), 1)
    out = {"seen": seen, "pair": np.empty((PAIRS, 2), np.float32), "single": np.zeros((SLOTS, len(DISCOUNTS)), np.float16)}
    out |= {k: np.empty((SLOTS, 2), np.float32) for k in ("share", "back", "p")}
    for k in (0, 1):
        taken, of = discount_values(often[k]), words[k, 0]
        out["pair"][:, k] = pairs[k] - taken.astype(np.float32)[np.minimum(pairs[k], 3).astype(np.int8)]
        out["share"][:, k] = np.where(of > 0, 1 / np.maximum(of, 1), 0)
        out["back"][:, k] = np.where(of > 0, (taken[1:].astype(np.float32) @ words[k, 1:4]) / np.maximum(of, 1), 1)
        out["p"][:, k] = continuation_level(words[k, 4].astype(np.int64), shared)
    toxic, ordinary = (words[k, 4].astype(np.int64) for k in (0, 1))
    for d, fixed in enumerate(DISCOUNTS):
        out["single"][seen, d] = np.log(continuation_level(toxic, shared, fixed)[seen] / continuation_level(ordinary, shared, fixed)[seen])
    return out


def features(texts: pa.Array, model: dict[str, np.ndarray], picks: tuple[int, ...]) -> np.ndarray:
    """Rows of (mean over the text by pairs; for each of the picked discounts the best word and the mean of the best ones) per text; zeros without words."""
    out = []
    for u, h, first, _ in neighbours(texts):
        n = np.diff(first)
        f = np.zeros((len(n), 1 + 2 * len(picks)))
        some = np.flatnonzero(n > 0)
        if len(some):
            start = first[:-1][some]
            a, v = word_slots(u), word_slots(h)
            seen = np.flatnonzero(model["seen"][v])
            b, c = a[seen], v[seen]
            # a word before that no training text has is no context: its share is 0, its weight 1
            x = model["pair"][pair_slots(b << SLOT_BITS | c)] * model["share"][b]
            x = np.log(np.maximum(np.minimum(x, 1) + model["back"][b] * model["p"][c], 1e-30))
            r = np.zeros(len(v))
            r[seen] = x[:, 0] - x[:, 1]
            f[some, 0] = np.add.reduceat(r, start) / n[some]
            row = np.repeat(np.arange(len(n)), n)
            few = np.arange(len(v)) - np.repeat(first[:-1], n) < BEST
            for k, d in enumerate(picks):
                r = model["single"][v, d].astype(np.float64)
                order = np.lexsort((-r, row))[few]  # the best of each row
                f[some, 1 + 2 * k] = np.maximum.reduceat(r, start)
                f[:, 2 + 2 * k] = np.bincount(row[few], r[order], minlength=len(n)) / BEST
        out.append(f)
    return np.concatenate(out) if out else np.zeros((0, 1 + 2 * len(picks)))


def fit_logistic(rows: DataFrame, names: list[str], picks: list[list[int]], ridge: float = 1e-2) -> list[tuple[float, np.ndarray, np.ndarray, np.ndarray]]:
    """(mean loss, mean, scale, weights with the intercept last) for each pick of the columns ``names``, over all ``rows`` with y.

    Newton steps: tasks add up slopes and curvatures, the driver only steps.
    One class only gives its rate.
    """
    wide = len(names)

    def summed(f) -> np.ndarray:
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            got = None
            for b in batches:
                x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns]).astype(np.float64)
                if len(x):
                    now = f(x[:, :-1], x[:, -1])
                    got = now if got is None else got + now
            if got is not None:
                yield pa.RecordBatch.from_arrays([pa.array([got.tobytes()], pa.binary())], ["s"])

        parts = [np.frombuffer(r["s"]) for r in rows.select(*names, "y").mapInArrow(add, "s binary").collect()]  # a short array a task
        return np.sum(parts, axis=0) if parts else np.zeros(0)

    one = summed(lambda x, y: np.concatenate([[len(y), y.sum()], x.sum(0)]))
    n, good, mean = (one[0], one[1], one[2:] / one[0]) if len(one) else (0.0, 0.0, np.zeros(wide))
    scale = np.maximum(np.sqrt(summed(lambda x, y: ((x - mean) ** 2).sum(0)) / n), 1e-9) if n else np.ones(wide)
    rate = min(max((good + 0.5) / (n + 1), 1e-3), 1 - 1e-3)
    ws = [np.append(np.zeros(len(p)), math.log(rate / (1 - rate))) for p in picks]
    if not 0 < good < n:
        return [(0.0, mean[p], scale[p], w) for p, w in zip(picks, ws, strict=True)]

    def curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        out = []
        for pick, w in zip(picks, ws, strict=True):
            z = np.column_stack([((x - mean) / scale)[:, pick], np.ones(len(x))])
            t = np.clip(z @ w, -30, 30)
            p = 1 / (1 + np.exp(-t))
            out += [[np.log1p(np.exp(np.where(y == 1, -t, t))).sum()], z.T @ (y - p), ((z * (p * (1 - p))[:, None]).T @ z).ravel()]
        return np.concatenate(out)

    for _ in range(50):
        got, at, most, losses = summed(curve), 0, 0.0, []
        for i, w in enumerate(ws):
            k = len(w)
            slope, bend = got[at + 1 : at + 1 + k], got[at + 1 + k : at + 1 + k + k * k].reshape(k, k)
            losses.append(got[at] / n)
            at += 1 + k + k * k
            pull = np.append(np.full(k - 1, ridge * n**0.5), 1e-6)
            step = np.clip(np.linalg.solve(bend + np.diag(pull), slope - pull * w), -4, 4)
            ws[i], most = w + step, max(most, np.abs(step).max())
        if most < 1e-4:
            break
    # the order of sums is open, and so are the last digits
    mean, scale, *ws = (np.array([float(f"{x:.8g}") for x in v]) for v in (mean, scale, *ws))
    return [(loss, mean[p], scale[p], w) for loss, p, w in zip(losses, picks, ws, strict=True)]


def score_toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", text_hash: bool = False) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Null, empty and blank texts have the score of a text that says nothing.
    Without labels of both classes all scores are the rate of the one there
    is (a half without any). Repeated rows are scored each; a null doc_id is
    held out. Equal texts have equal scores, and ties no say. An empty table
    gives no rows. Scores use the text alone; columns other than the two named
    are ignored, whatever their names. ``text_hash`` adds a hash of the text,
    which tells rows of one id apart.
    """
    sc = docs.sparkSession.sparkContext
    rows = with_label(docs, labels, label, doc_id, text)
    f = fold(F.col("doc_id"), FOLDS)
    train = rows.where(F.col("y").isNotNull() & ~f.isin(HELD_OUT, CALIBRATION)).select("t", "y")
    pairs, words, often = class_tables(train, train.agg(F.sum(F.octet_length("t"))).first()[0] or 0)
    total = words[:, 0].sum(0, dtype=np.float64) + words[:, 4].sum(0)  # as the word before; the last words of texts are none
    follows = np.zeros(SLOTS, np.int64)
    if total.any():
        t = docs.select(F.col(text).cast("string").alias("t"))
        share = np.where(words[:, 4].sum(0) > 0, total, 0) / total.sum()
        follows = continuations(t, None, share, t.agg(F.sum(F.octet_length("t"))).first()[0] or 0)
    model = fit_model(pairs, words, often, follows)
    del pairs, words, total, follows
    shared = sc.broadcast(model)
    del model  # workers and the disk have it
    every = tuple(range(len(DISCOUNTS)))
    names = [f"x{i}" for i in range(1 + 2 * len(every))]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = features(b.column(0), shared.value, every)
            yield pa.RecordBatch.from_arrays([*(pa.array(x[:, i]) for i in range(x.shape[1])), b.column(1)], [*names, "y"])

    fit = rows.where((f == CALIBRATION) & F.col("y").isNotNull()).select("t", "y")
    measured = snapshot(fit.mapInArrow(measure, ", ".join(f"{n} double" for n in names) + ", y int"), "toxic-calibration")
    fits = fit_logistic(measured, names, [[0, 1 + 2 * d, 2 + 2 * d] for d in every])
    pick = min(every, key=lambda d: fits[d][0])
    _, mean, scale, w = fits[pick]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = (features(b.column(2), shared.value, (pick,)) - mean) / scale
            p = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
            more = [b.column(i) for i in range(3, b.num_columns)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(p), pa.array((p >= 0.5).astype(np.int32)), *more], ["doc_id", "held_out", "score", "predicted", "text_hash"][: 4 + len(more)])

    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(fold(F.col(doc_id).cast("long"), FOLDS) == HELD_OUT, F.lit(True)).alias("held_out"), F.col(text).cast("string").alias("t"))
    out = "doc_id long, held_out boolean, score double, predicted int"
    if text_hash:
        d, out = d.withColumn("h", F.xxhash64("t")), out + ", text_hash long"
    return d.mapInArrow(score, out)
