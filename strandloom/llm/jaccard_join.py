"""Exact Jaccard self-join of shingle sets by pivots in metric space.

Distance is 1 - Jaccard similarity, a metric. Two sets within the threshold
share one of the rarest ``n - ceil(t n) + 1`` shingles of each, whatever the
common order, so the sets around every such shingle form a *group*. The most
central set of a group is its pivot, and all groups with one pivot form its
*cell*: a set is copied into the cells of all pivots it may have to do with,
and every link is inside some cell.

The order is that of exact counts over the whole table. Every task sends its
distinct shingles to hash ranges; a range counts them and sends back only those
of two sets or more, so shingles of one set, nearly all, travel once. A set
whose unique shingles alone fill its prefix is linked with nothing and ends
there. As a common shingle is a shared one, sizes and shared shingles are all
that is needed to measure pairs exactly.

Round one measures the sets of a cell against their pivot: no pair list of a
group is made. Components found so far resolve most cells. Round two takes
what a cell has outside its largest component and joins it exactly to the
cell, in blocks of bounded size: a link that joins two components has a side
outside the largest. A block is joined recursively: pivots are drawn from it,
each asking set goes to the Voronoi region of its nearest pivot, and a set is
copied to every region whose distances from all pivots are within the
threshold of its own (triangle inequality), until regions are small or no
longer shrink. Only links that join components leave a block.

Voronoi cells over the whole table can't prune here: unrelated sets have
distance 1 from every pivot, so each would be copied to each cell. The groups
by rare shingle come first for that reason.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm import textkit as tk
from strandloom.operators.graph import connected_components
from strandloom.plans.session import give_back
from strandloom.plans.snapshot import mark, release, snapshot

#: Shingles and sets that a task numbers together, and shingles aimed at in a hash range (an English word and a blank take ``WORD_BYTES``).
BLOCK_ENTRIES, BLOCK_NODES, RANGE_ENTRIES, WORD_BYTES = 1 << 20, 1 << 16, 400_000, 6
#: Bounds of a block of round two: sets that ask, sets they are held against, bytes of the latter.
BLOCK_OUTER, BLOCK_SETS, BLOCK_BYTES = 512, 4096, 16 << 20
#: Sets of a shingle up to which each pair's places are looked at.
SHORT_GROUP = 8
#: Pivots of a step of the recursion, comparisons up to which a region is joined at once, and how far a region must shrink to be parted again.
PIVOTS, SMALL_REGION, SHRINK = 6, 2048, 0.8

_SHARED = "block long, kind int, tok binary, idx binary, cnt binary"


def _digest(s: np.ndarray) -> int:
    """64 bits of a sorted set; the empty set is never linked and has 0."""
    if not len(s):
        return 0
    with np.errstate(over="ignore"):
        x = np.bitwise_xor.reduce(tk.mix(s + np.uint64(0x1234567))) + tk.mix(np.array([len(s)], np.uint64))[0] * np.uint64(3) + np.add.reduce(s)
    return int(tk.mix(np.array([x], np.uint64)).view(np.int64)[0])


def _prefix_size(n: np.ndarray, t: tuple[int, int]) -> np.ndarray:
    return n - -(-t[0] * n // t[1]) + 1


def _cuts(x: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal neighbours, and the end."""
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1], [True]])) if len(x) else np.zeros(1, np.int64)


def _all(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in column] or [np.zeros(0, kind)])


def _sent(docs: DataFrame, doc_id: str, text: str, bits: int) -> DataFrame:
    """Blocks of documents: a row of what is known of each (rng < 0), and rows of their shingles for each range.

    A shingle goes as the 48 bits of its hash below the range's.
    """
    names = ["rng", "block", "tok", "idx", "cnt"]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, blocks = tk.partition_id(), 0
        number: dict[int, int] = {}
        sets: list[np.ndarray] = []
        rows: list[tuple[int, bool, int, int, int]] = []
        held = 0

        def flush():
            nonlocal blocks, held
            block = (part << 24) | blocks
            h = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            idx = np.repeat(np.arange(len(sets), dtype=np.uint16), [len(s) for s in sets])
            r = (h >> np.uint64(64 - bits)).astype(np.uint16 if bits <= 16 else np.uint32)
            order = np.argsort(r, kind="stable")
            r, idx = r[order], idx[order]
            low = np.ascontiguousarray(((h[order] << np.uint64(bits)) >> np.uint64(16)).view(np.uint8).reshape(-1, 8)[:, :6])
            cut = _cuts(r)
            pairs = list(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)) if len(r) else []
            about = np.array(rows, np.int64)
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([-1 - block, *(r[a].item() for a, _ in pairs)], pa.int64()),
                    pa.array([block] * (len(pairs) + 1), pa.int64()),
                    pa.array([about.tobytes(), *(low[a:b].tobytes() for a, b in pairs)], pa.binary()),
                    pa.array([None, *(idx[a:b].tobytes() for a, b in pairs)], pa.binary()),
                    pa.array([np.array(list(number), np.int64).tobytes()] + [None] * len(pairs), pa.binary()),
                ],
                names,
            )
            blocks, held = blocks + 1, 0
            number.clear()
            sets.clear()
            rows.clear()
            return out

        for b in batches:
            ids = b.column(0).to_pylist()
            for doc, s, text in zip(ids, tk.shingle_sets(b.column(1)), b.column(2).to_pylist(), strict=True):
                d = _digest(s)
                if len(s) and d not in number:
                    number[d] = len(sets)
                    sets.append(s)
                    held += len(s)
                rows.append((0 if doc is None else doc, doc is not None, len(s), d, text))
                if held >= BLOCK_ENTRIES or len(rows) >= BLOCK_NODES:
                    yield flush()
        if rows:
            yield flush()

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("t"), F.xxhash64(F.col(text).cast("string"))).mapInArrow(emit, "rng long, block long, tok binary, idx binary, cnt binary")


def _shared(sent: DataFrame, bits: int) -> DataFrame:
    """For each block its documents (kind 0) and the shingles that other sets have too, with their counts (kind 1)."""
    schema = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("tok", pa.binary()), ("idx", pa.binary()), ("cnt", pa.binary())])

    def count(g: pa.Table) -> pa.Table:
        rng = g["rng"][0].as_py()
        if rng < 0:
            return pa.table([g["block"], pa.array([0] * g.num_rows, pa.int32()), g["tok"], g["idx"], g["cnt"]], schema=schema)
        raw = _all(g["tok"], np.uint8).reshape(-1, 6)
        wide = np.zeros((len(raw), 8), np.uint8)
        wide[:, :6] = raw
        tok, idx = wide.view(np.uint64).ravel(), _all(g["idx"], np.uint16)
        block = np.repeat(g["block"].to_numpy(), [len(x.as_buffer()) // 2 for x in g["idx"]])
        order = np.argsort(tok, kind="stable")
        cut = _cuts(tok[order])
        many = np.diff(cut)
        cnt = np.empty(len(tok), np.uint32)
        cnt[order] = np.repeat(many, many)
        keep = cnt > 1  # rows come block by block, so what is kept does too
        tok, idx, block, cnt = (tok[keep] | np.uint64(rng << 48 if bits <= 16 else 0)), idx[keep], block[keep], cnt[keep]
        if bits > 16:  # 48 bits of the hash below the range, the range's lowest bits above
            tok |= np.uint64(rng & 0xFFFF) << np.uint64(48)
        cut = _cuts(block)
        pairs = list(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)) if len(block) else []
        return pa.table(
            [pa.array([block[a].item() for a, _ in pairs], pa.int64()), pa.array([1] * len(pairs), pa.int32())] + [pa.array([x[a:b].tobytes() for a, b in pairs], pa.binary()) for x in (tok, idx, cnt)],
            schema=schema,
        )

    return sent.groupBy("rng").applyInArrow(count, _SHARED)


_NODES = "kind int, doc_id long, n long, digest long, text_hash long, rng int, tok binary, cnt binary, place binary, size binary, mid binary"


def _nodes(shared: DataFrame, t: tuple[int, int], ranges: int) -> DataFrame:
    """Rows of documents (kind 0), sets that may be linked with their shared shingles (kind 1), and prefixes by range (kind 2)."""
    schema = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.int64()), ("text_hash", pa.int64()), ("rng", pa.int32())] + [(c, pa.binary()) for c in ("tok", "cnt", "place", "size", "mid")])

    def join(g: pa.Table) -> pa.Table:
        info = g.filter(pa.array(g["kind"].to_numpy() == 0))
        rest = g.filter(pa.array(g["kind"].to_numpy() == 1))
        about = np.frombuffer(info["tok"][0].as_buffer(), np.int64).reshape(-1, 5)
        digests = np.frombuffer(info["cnt"][0].as_buffer(), np.int64)
        first = dict(zip(about[:, 3].tolist(), about[:, 2].tolist(), strict=True))
        n = np.array([first[d] for d in digests.tolist()], np.int64)
        tok, idx, cnt = _all(rest["tok"], np.uint64), _all(rest["idx"], np.uint16).astype(np.int64), _all(rest["cnt"], np.uint32)
        # in a set: unique shingles first, then by count, equal counts by hash
        order = np.lexsort((tok, cnt, idx))
        tok, idx, cnt = tok[order], idx[order], cnt[order]
        many = np.bincount(idx, minlength=len(n))
        start = np.concatenate([[0], np.cumsum(many)])
        place = n[idx] - many[idx] + np.arange(len(idx)) - start[idx]
        inside = place < _prefix_size(n, t)[idx]
        open_ = np.bincount(idx[inside], minlength=len(n)) > 0
        cols: list[list] = [[] for _ in schema.names]

        def add(**values):
            for name, col in zip(schema.names, cols, strict=True):
                col.append(values.get(name))

        for doc, known, size, d, text in about.tolist():
            add(kind=0, doc_id=doc if known else None, n=size, digest=d, text_hash=text)
        for i in np.flatnonzero(open_).tolist():
            add(kind=1, n=int(n[i]), digest=int(digests[i]), tok=np.sort(tok[start[i] : start[i + 1]]).tobytes())
        tok, idx, place = tok[inside], idx[inside], place[inside]
        r = (tk.mix(tok) % np.uint64(ranges)).astype(np.int64)
        order = np.argsort(r, kind="stable")
        tok, idx, place, r = tok[order], idx[order], place[order], r[order]
        cut = _cuts(r)
        mid = 255 * many // np.maximum(n, 1)
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True) if len(r) else ():
            i = idx[a:b]
            add(kind=2, rng=int(r[a]), tok=tok[a:b].tobytes(), cnt=digests[i].tobytes(), place=place[a:b].astype(np.uint32).tobytes(), size=n[i].astype(np.uint32).tobytes(), mid=mid[i].astype(np.uint8).tobytes())
        return pa.table([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    return shared.groupBy("block").applyInArrow(join, _NODES)


def _cells(post: DataFrame, t: tuple[int, int]) -> DataFrame:
    """(x, p): sets and the pivots of the groups they are in, each once per range."""
    names = pa.schema([("x", pa.int64()), ("p", pa.int64())])

    def group(g: pa.Table) -> pa.Table:
        tok, x = _all(g["tok"], np.uint64), _all(g["cnt"], np.int64)
        place, size, mid = _all(g["place"], np.uint32).astype(np.int64), _all(g["size"], np.uint32).astype(np.int64), _all(g["mid"], np.uint8)
        # equal sets of different blocks are one; sizes that differ by more than the threshold part the sets of a shingle
        o = np.lexsort((x, size, tok))
        tok, x, place, size, mid = (v[o] for v in (tok, x, place, size, mid))
        new = np.ones(len(tok), bool)
        new[1:] = (tok[1:] != tok[:-1]) | (x[1:] != x[:-1])
        tok, x, place, size, mid = (v[new] for v in (tok, x, place, size, mid))
        run = np.cumsum(np.concatenate([[True], (tok[1:] != tok[:-1]) | (t[0] * size[1:] > t[1] * size[:-1])])[: len(tok)]) - 1
        length = np.bincount(run)[run] if len(run) else run
        # a set may leave a short group if with no other set there the shingle can be their first common one
        keep = length > SHORT_GROUP
        for k in range(1, SHORT_GROUP):
            a = np.flatnonzero((run[k:] == run[:-k]) & (length[k:] <= SHORT_GROUP)) if len(run) > k else np.zeros(0, np.int64)
            b = a + k
            most = np.minimum(size[a] - place[a], size[b] - place[b])
            ok = (t[1] + t[0]) * most >= t[0] * (size[a] + size[b])
            keep[a[ok]] = True
            keep[b[ok]] = True
        run, x, size, mid = run[keep], x[keep], size[keep], mid[keep]
        if not len(run):
            return names.empty_table()
        o = np.lexsort((x, size, 255 - mid.astype(np.int64), run))
        best = o[np.concatenate([[True], run[o][1:] != run[o][:-1]])]
        _, dense = np.unique(run, return_inverse=True)
        pairs = np.unique(np.column_stack([x, x[best][dense]])[x != x[best][dense]], axis=0)
        return pa.table([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=names)

    return post.groupBy("rng").applyInArrow(group, "x long, p long")


def _overlap(one: np.ndarray, tok: np.ndarray, off: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of a sorted set with sets ``rows`` of ``tok``/``off``."""
    many = off[rows + 1] - off[rows]
    start = np.concatenate([[0], np.cumsum(many)])
    x = tok[np.repeat(off[rows] - start[:-1], many) + np.arange(start[-1])]
    at = np.searchsorted(one, x)
    at[at == len(one)] = 0
    total = np.concatenate([[0], np.cumsum(one[at] == x)]) if len(one) else np.zeros(len(x) + 1, np.int64)
    return total[start[1:]] - total[start[:-1]]


def _measure(pairs: DataFrame, sets: DataFrame, t: tuple[int, int]) -> DataFrame:
    """(x, p, dist, linked) of pairs, by exact counts over whole sets; a pivot is searched by all its sets of a batch at once."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            p, nx, np_ = (batch.column(i).to_numpy() for i in (1, 3, 5))
            tok = np.concatenate([np.frombuffer(v.as_buffer(), np.uint64) for v in batch.column(2)])
            off = np.concatenate([[0], np.cumsum([len(v.as_buffer()) // 8 for v in batch.column(2)])])
            both = np.zeros(len(p), np.int64)
            order = np.argsort(p, kind="stable")
            cut = _cuts(p[order])
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                both[order[a:b]] = _overlap(np.frombuffer(batch.column(4)[int(order[a])].as_buffer(), np.uint64), tok, off, order[a:b])
            either = nx + np_ - both
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(1 - both / either), pa.array(t[1] * both >= t[0] * either)], ["x", "p", "dist", "linked"])

    sx = sets.select(F.col("digest").alias("x"), F.col("tok").alias("tx"), F.col("n").alias("nx"))
    sp = sets.select(F.col("digest").alias("p"), F.col("tok").alias("tp"), F.col("n").alias("np"))
    return pairs.join(sx, "x").join(sp, "p").select("x", "p", "tx", "nx", "tp", "np").mapInArrow(merge, "x long, p long, dist double, linked boolean")


def region_join(ask: np.ndarray, held: np.ndarray, comp: np.ndarray, n: np.ndarray, tok: np.ndarray, off: np.ndarray, t: tuple[int, int], box: np.ndarray) -> list[tuple[int, int]]:
    """Links (asking set, held set) that join different components; ``comp`` is updated.

    ``box``: known distances, a row a set, that must be within the threshold of each other.
    """
    tau, out = 1 - t[0] / t[1] + 1e-9, []

    def compare(ask: np.ndarray, held: np.ndarray, d: np.ndarray, e: np.ndarray) -> None:
        for k, o in enumerate(ask.tolist()):
            y = held[(comp[held] != comp[o]) & (np.abs(e - d[k]) <= tau).all(1)]
            y = y[t[1] * np.minimum(n[y], n[o]) >= t[0] * np.maximum(n[y], n[o])]
            if not len(y):
                continue
            both = _overlap(tok[off[o] : off[o + 1]], tok, off, y)
            for m in y[t[1] * both >= t[0] * (n[o] + n[y] - both)].tolist():
                if comp[m] != comp[o]:
                    out.append((o, m))
                    comp[comp == comp[m]] = comp[o]

    def part(ask: np.ndarray, held: np.ndarray, d: np.ndarray, e: np.ndarray, was: int) -> None:
        if not len(ask) or not len(held):
            return
        if len(ask) * len(held) <= SMALL_REGION or len(held) > SHRINK * was:
            return compare(ask, held, d, e)
        # pivots spread over the sets in order of their distances so far
        pivots = held[np.lexsort((n[held], e[:, -1]))[np.linspace(0, len(held) - 1, PIVOTS).astype(np.int64)]]
        far = []
        for rows in (ask, held):
            both = np.stack([_overlap(tok[off[p] : off[p + 1]], tok, off, rows) for p in pivots], axis=1)
            far.append(1 - both / (n[rows][:, None] + n[pivots][None, :] - both))
        near = np.argmin(far[0], axis=1)
        for r in range(PIVOTS):
            own = near == r
            if own.any():
                x = far[0][own]
                ok = ((far[1] >= x.min(0) - tau) & (far[1] <= x.max(0) + tau)).all(1)
                part(ask[own], held[ok], np.column_stack([d[own], x]), np.column_stack([e[ok], far[1][ok]]), len(held))

    part(ask, held, box[ask], box[held], 2 * len(held))
    return out


def _blocks(cells: DataFrame, first: DataFrame, label: DataFrame, sets: DataFrame, t: tuple[int, int]) -> DataFrame:
    """(x, p): links that join different components of a cell, found block by block."""
    dist = first.select("x", "p", "dist")
    known = dist.unionByName(cells.select("p").distinct().select(F.col("p").alias("x"), "p", F.lit(0.0).alias("dist")))
    known = known.join(label.withColumnRenamed("node", "x"), "x", "left").withColumn("c", F.coalesce("component", "x")).drop("component")
    per = known.groupBy("p", "c").agg(F.count("*").alias("k"))
    main = per.groupBy("p").agg(F.max(F.struct("k", "c"))["c"].alias("main"), F.count("*").alias("n_c")).where("n_c > 1").select("p", "main")
    sizes = sets.select(F.col("digest").alias("x"), F.octet_length("tok").alias("w"))
    known = snapshot(known.join(main, "p").join(sizes, "x").withColumn("outer", F.col("c") != F.col("main")).select("p", "x", "c", "dist", "w", "outer"), "jj-open")
    weigh = lambda rows, n, w: F.greatest(F.ceil(F.count(rows) / n), F.ceil(F.sum(F.when(rows.isNotNull(), F.col("w"))) / w), F.lit(1)).cast("int")
    parts = known.groupBy("p").agg(weigh(F.when(F.col("outer"), 1), BLOCK_OUTER, BLOCK_BYTES // 4).alias("n_i"), weigh(F.lit(1), BLOCK_SETS, BLOCK_BYTES).alias("n_j"))
    dealt = known.join(parts, "p")
    own = lambda n, seed: F.pmod(F.xxhash64("x", F.lit(seed)), F.col(n).cast("long")).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = dealt.where("outer").select("p", own("n_i", 1).alias("i"), each("n_j").alias("j"), "x", "c", "dist", F.lit(True).alias("ask"))
    right = dealt.select("p", each("n_i").alias("i"), own("n_j", 2).alias("j"), "x", "c", "dist", F.lit(False).alias("ask"))
    both = left.unionByName(right).join(sets.select(F.col("digest").alias("x"), "n", "tok"), "x")
    names = pa.schema([("x", pa.int64()), ("p", pa.int64())])

    def join(block: pa.Table) -> pa.Table:
        ask = block["ask"].to_numpy()
        x, n = block["x"].to_numpy(), block["n"].to_numpy()
        tok = _all(block["tok"], np.uint64)
        off = np.concatenate([[0], np.cumsum([len(v.as_buffer()) // 8 for v in block["tok"]])])
        _, comp = np.unique(block["c"].to_numpy(), return_inverse=True)
        found = region_join(np.flatnonzero(ask), np.flatnonzero(~ask), comp.copy(), n, tok, off, t, block["dist"].to_numpy()[:, None])
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.table([pa.array(x[list(a)], pa.int64()), pa.array(x[list(b)], pa.int64())], schema=names)

    return both.groupBy("p", "i", "j").applyInArrow(join, "x long, p long")


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: tuple[int, int] = (75, 100), text_hash: bool = False) -> DataFrame:
    """Components of documents under links of Jaccard similarity at or over the threshold.

    Returns ``(doc_id, n_shingles, component_id)`` for every input row;
    ``component_id`` is the smallest doc_id reachable by links. Null, empty
    and blank texts have no shingles and only themselves. Equal texts are
    linked. Repeated rows give repeated results; rows whose doc_id is null
    take part and have the smallest known id of their component. An empty
    table gives no rows. Other columns of ``docs`` are ignored, whatever
    their names. ``text_hash`` adds a hash of the text, which tells rows of
    one id apart.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    bits = max(3, int(size // WORD_BYTES // RANGE_ENTRIES).bit_length())
    since = mark()
    shared = snapshot(_shared(_sent(docs, doc_id, text, bits), bits), "jj-shared")
    made = snapshot(_nodes(shared, threshold, 1 << max(3, bits - 2)), "jj-nodes")
    release(spark, since)  # the nodes have all of it
    give_back(spark)
    sets = snapshot(made.where("kind = 1").select("digest", "n", "tok").dropDuplicates(["digest"]), "jj-sets")
    cells = snapshot(_cells(made.where("kind = 2"), threshold).distinct(), "jj-cells")
    first = snapshot(_measure(cells, sets, threshold), "jj-round1")
    links = first.where("linked").select("x", "p")
    label = snapshot(connected_components(links, "x", "p"), "jj-label1")
    give_back(spark)

    joining = snapshot(_blocks(cells, first, label, sets, threshold), "jj-round2")
    if not joining.isEmpty():
        label = snapshot(connected_components(links.union(joining), "x", "p"), "jj-label2")

    more = ["text_hash"] if text_hash else []
    rows = made.where("kind = 0").select("doc_id", F.col("n").alias("n_shingles"), "digest", *more)
    some = rows.where("n_shingles > 0").join(label.withColumnRenamed("node", "digest"), "digest", "left").withColumn("c", F.coalesce("component", "digest"))
    least = some.groupBy("c").agg(F.min("doc_id").alias("component_id"))
    none = rows.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    names = ["doc_id", "n_shingles", "component_id", *more]
    return some.join(least, "c").select(*names).unionByName(none.select(*names))
