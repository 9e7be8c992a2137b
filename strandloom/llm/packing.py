"""Tokenise documents and pack them by minimum bin slack.

Every document becomes its ids and an end id, cut at multiples of the
capacity. Only the number of pieces of each length (at most ``capacity``
numbers) reaches the driver; there minimum bin slack fills one window after
the other: the longest remaining length is fixed, a bitset subset-sum over
the multiset of remaining lengths finds the fullest window, and backtracking
yields how many pieces of each length it takes. A pattern is applied as often
as the counts allow, so planning costs a few thousand steps at any scale. If
a window would still miss more than ``SLACK_MOST`` ids, a remaining length is
cut to close it. Pieces then find their place by their rank among the pieces
of their length: a running number within each task plus the task's offset.
"""

from __future__ import annotations

import json
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandloom.llm import textkit as tk
from strandloom.plans.snapshot import snapshot

CAPACITY = 1024
#: Ids that a window may miss before a piece is cut for it.
SLACK_MOST = 4
#: Bytes of ids that a task holds before it hands them on.
HELD_BYTES = 1 << 21

#: Tasks whose offsets may be broadcast (times 1024 lengths at 16 bytes: 64 MB at most).
BROADCAST_TASKS = 4096

_engines: dict[str, "ByteBpe"] = {}


class ByteBpe:
    """Ids of a byte-level BPE file. It keeps no words, so a worker's memory doesn't grow with what it has read."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        vocab = model["model"]["vocab"]
        special = {x["content"] for x in model.get("added_tokens", ())}
        keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
        back = {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(keep))}
        ranks = {bytes(back[c] for c in w): i for w, i in vocab.items() if w not in special}
        import public_tokenizers

        self.bpe = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids; strings of special tokens are ordinary text."""
        return self.bpe.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes() if text else b""


def engine(path: str) -> ByteBpe:
    if path not in _engines:
        _engines[path] = ByteBpe(path)
    return _engines[path]


_PIECES = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("doc_id", "start", "length", "doc_tokens")]
    + [T.StructField("ids", T.BinaryType()), T.StructField("task", T.IntegerType()), T.StructField("nth", T.LongType())]
)


def tokenize_and_cut(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Pieces of at most ``capacity`` ids, numbered by length within each task."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end, task = engine(tokenizer), np.array([end_id], dtype="<u4").tobytes(), tk.partition_id()
        nth = np.zeros(capacity + 1, np.int64)
        wide = 4 * capacity
        cols: list[list] = [[] for _ in range(6)]
        held = 0

        def flush():
            out = pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.binary()), pa.array([task] * len(cols[0]), pa.int32()), pa.array(cols[5], pa.int64())], _PIECES.names)
            for c in cols:
                c.clear()
            return out

        for batch in batches:
            for i in range(batch.num_rows):
                doc = batch.column(0)[i].as_py()
                ids = bpe.encode(batch.column(1)[i].as_py() or "") + end
                n = len(ids) // 4
                for a in range(0, len(ids), wide):
                    x = ids[a : a + wide]
                    k = len(x) // 4
                    for c, v in zip(cols, (doc, a // 4, k, n, x, int(nth[k])), strict=True):
                        c.append(v)
                    nth[k] += 1
                held += len(ids)
                if held > HELD_BYTES:
                    yield flush()
                    held = 0
        if cols[0]:
            yield flush()

    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(cut, _PIECES)


def fullest_window(supply: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of lengths with the longest one whose sum is nearest to ``capacity``.

    Bit s of ``reach`` tells that s can be made from the lengths seen so far;
    counts are split in powers of two; the walk back over the stored bitsets
    gives how many of each length are taken, longer ones first.
    """
    top = max(x for x, n in supply.items() if n > 0)
    room, taken = capacity - top, defaultdict(int, {top: 1})
    if not room:
        return dict(taken)
    full, reach, steps = (1 << (room + 1)) - 1, 1, []
    for x in sorted((x for x, n in supply.items() if n > 0 and x <= room), reverse=True):
        left, k = min(supply[x] - (x == top), room // x), 1
        while left > 0:
            k = min(k, left)
            steps.append((reach, x, k))
            reach |= (reach << (x * k)) & full
            left -= k
            k *= 2
        if reach >> room & 1:
            break
    at = reach.bit_length() - 1
    for before, x, k in reversed(steps):
        if not before >> at & 1:
            at -= x * k
            taken[x] += k
    return dict(taken)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Placements as rows (origin length, first rank, ranks, start, length, first sequence, per sequence, first item, offset)."""
    supply: dict[int, int] = defaultdict(int, counts)
    stock: dict[int, deque] = defaultdict(deque)
    for x, n in counts.items():
        stock[x].append((x, 0, n, 0))  # origin length, first rank, ranks, start within the piece
    rows, base = [], 0

    def take(x: int, n: int) -> Iterator[tuple[int, int, int, int]]:
        supply[x] -= n
        while n:
            o, r, k, s = stock[x].popleft()
            if k > n:
                stock[x].appendleft((o, r + n, k - n, s))
                k = n
            n -= k
            yield o, r, k, s

    while any(supply.values()):
        window = fullest_window(supply, capacity)
        times = min(supply[x] // n for x, n in window.items())
        slack = capacity - sum(x * n for x, n in window.items())
        donor = None
        if slack > SLACK_MOST:
            donor = max((x for x, n in supply.items() if n > window.get(x, 0) and x > slack), default=None)
            if donor:
                spare = window.get(donor, 0)
                times = max(1, min(times, supply[donor] // (spare + 1)))
                if supply[donor] < times * (spare + 1):
                    donor = None
        off = 0
        for x, c in sorted(window.items(), reverse=True):
            item = 0
            for o, r, k, s in take(x, c * times):
                rows.append((o, r, k, s, x, base, c, item, off))
                item += k
            off += x * c
        if donor:
            item = 0
            for o, r, k, s in list(take(donor, times)):
                rows.append((o, r, k, s, slack, base, 1, item, off))
                stock[donor - slack].append((o, r, k, s + slack))
                supply[donor - slack] += k
                item += k
        base += times
    return np.array(rows, dtype=np.int64).reshape(-1, 9)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; some are cut further."""
    sc = pieces.sparkSession.sparkContext
    pieces = snapshot(pieces, "pack-pieces")
    each = snapshot(pieces.groupBy("task", "length").agg(F.count("*").alias("k")), "pack-counts")
    counts = {r["length"]: r["k"] for r in each.groupBy("length").agg(F.sum("k").alias("k")).collect()}  # at most ``capacity`` rows
    rows = plan(counts, capacity)
    shared = sc.broadcast({int(x): rows[rows[:, 0] == x] for x in np.unique(rows[:, 0])} if len(rows) else {})
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = each.select("task", "length", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("skip"))
    names = ["doc_id", "start", "length", "doc_tokens", "ids", "sequence_id", "offset"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length = b.column("length").to_numpy(zero_copy_only=False)
            rank = b.column("rank").to_numpy(zero_copy_only=False)
            out: list[np.ndarray] = []
            for x in np.unique(length):
                here = np.flatnonzero(length == x)
                r = rank[here]
                for _, first, k, s, n, base, per, item, off in shared.value[int(x)]:
                    hit = (r >= first) & (r < first + k)
                    if hit.any():
                        i = r[hit] - first + item
                        m = len(i)
                        out.append(np.stack([here[hit], np.full(m, s), np.full(m, n), base + i // per, off + i % per * n]))
            if not out:
                continue
            at, s, n, seq, off = np.concatenate(out, axis=1)
            order = np.lexsort((s, at))
            at, s, n, seq, off = (v[order] for v in (at, s, n, seq, off))
            ids = b.column("ids")
            whole = n == length[at]
            cut = [ids[i].as_py() if w else ids[i].as_py()[4 * a : 4 * (a + k)] for i, a, k, w in zip(at.tolist(), s.tolist(), n.tolist(), whole.tolist(), strict=True)]
            pick = b.select(["doc_id", "start", "doc_tokens"]).take(pa.array(at))
            yield pa.RecordBatch.from_arrays([pick.column(0), pa.array(pick.column(1).to_numpy(zero_copy_only=False) + s), pa.array(n), pick.column(2), pa.array(cut, pa.binary()), pa.array(seq), pa.array(off)], names)

    return _ranked(pieces, offsets).mapInArrow(place, "doc_id long, start long, length long, doc_tokens long, ids binary, sequence_id long, offset long")


def _ranked(pieces: DataFrame, offsets: DataFrame) -> DataFrame:
    """Ranks by the task's offsets. The ids stay where they are: the offsets of a task travel as one map."""
    maps = offsets.groupBy("task").agg(F.map_from_entries(F.collect_list(F.struct("length", "skip"))).alias("skips"))  # at most ``capacity`` entries
    if offsets.select("task").distinct().count() <= BROADCAST_TASKS:
        maps = F.broadcast(maps)
    joined = pieces.join(maps, "task")
    return joined.select("doc_id", "start", "length", "doc_tokens", "ids", (F.col("nth") + F.element_at("skips", F.col("length"))).alias("rank"))


def pack_documents(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their ids, sequence and offset.

    Null and empty texts give the end id only. Repeated rows are packed each
    on their own; a null doc_id stays null. An empty table gives no rows.
    Columns of ``docs`` other than the two named are ignored.
    """
    return pack(tokenize_and_cut(docs, tokenizer, doc_id, text, capacity), capacity)
