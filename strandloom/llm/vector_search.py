"""Largest inner products by inverted lists and adaptive dimension scans.

Vectors are extended by sqrt(M^2 - |x|^2), M the largest length, so that the
nearest by distance is the largest by inner product; queries get 0 there. A
fixed random rotation then spreads the energy over all columns. Centroids
fitted on a bounded sample part the vectors into lists; each query probes its
nearest lists, as many as hold ``PROBE_AIM`` of the neighbours that sampled
queries have in a sample (whose neighbours are farther, and so in more lists,
than those in the whole table).

Candidates are written list by list. They are scanned where they lie: queries
come to them as a broadcast block of at most ``PASS_QUERIES``, one pass over
the candidates for each block, so vectors are never copied per probe. For all
pairs of a list and the queries that probe it, partial distances grow by
blocks of columns; after each a hypothesis test drops the pairs whose scaled
partial distance is beyond the query's bound by more than the rotation's error
allows. The bound starts as the distance of the last neighbour in the sample
and sinks with what the task finds. Survivors get exact double-precision
products of the original vectors.

Equal vectors are searched once: a class of copies is one candidate and one
query, so a hot vector costs as much as any other. As at most K+1 members of a
class can be among a query's K nearest, only its smallest ids travel.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandloom.plans.snapshot import snapshot

#: Rows (of smallest hashed id) that centroids are fitted on, rows a list should have, and the most lists.
SAMPLE, LIST_ROWS, LISTS_MOST = 16_384, 512, 4_096
#: Share of sampled neighbours that must lie in probed lists, sampled queries it is measured with, and the least number of lists probed.
PROBE_AIM, PROBE_QUERIES, PROBE_LEAST = 0.97, 512, 16
#: Columns added per scan step, and the test's width in units of the rotation's error (higher: fewer wrong drops).
COLUMNS, WIDTH = 16, 2.1
#: Queries of a pass, of a block of a scan, and candidates of a file of lists.
PASS_QUERIES, SCAN_QUERIES, FILE_ROWS = 1 << 16, 1024, 1 << 16
#: Share of pairs up to which survivors are gathered one by one.
SPARSE = 0.08
#: Components of a vector at most.
DIM_MOST = 1 << 16


def rotation(dim: int, seed: int = 7) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def fit_centroids(x: np.ndarray, k: int, rounds: int = 12, seed: int = 11) -> np.ndarray:
    """Lloyd's algorithm on the sample."""
    c = x[np.random.default_rng(seed).choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        own = np.argmin((c * c).sum(1)[None, :] - 2 * x @ c.T, axis=1)
        n = np.bincount(own, minlength=k)
        s = np.zeros_like(c)
        np.add.at(s, own, x)
        c[n > 0] = s[n > 0] / n[n > 0, None]
    return c


def own_lists(z: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.concatenate([np.argmin((c * c).sum(1)[None, :] - 2 * z[a : a + 2048] @ c.T, axis=1) for a in range(0, len(z), 2048)])


def probes_for(x: np.ndarray, z: np.ndarray, q: np.ndarray, c: np.ndarray, keep: int) -> int:
    """Nearest lists to probe so that ``PROBE_AIM`` of the ``keep`` neighbours lie in them.

    ``x``: sampled vectors; ``z``: the same lifted as candidates; ``q``: the
    first of them lifted as queries.
    """
    if len(c) <= PROBE_LEAST or len(x) <= keep:
        return len(c)
    own, ranks = own_lists(z, c), []
    for a in range(0, len(q), 64):
        part = q[a : a + 64]
        score = x[a : a + len(part)] @ x.T
        score[np.arange(len(part)), np.arange(a, a + len(part))] = -np.inf  # a query is no neighbour of its own
        top = np.argpartition(-score, keep - 1, axis=1)[:, :keep]
        near = np.argsort((c * c).sum(1)[None, :] - 2 * part @ c.T, axis=1)
        rank = np.empty_like(near)
        np.put_along_axis(rank, near, np.broadcast_to(np.arange(len(c)), near.shape), axis=1)
        ranks.append(np.take_along_axis(rank, own[top], axis=1).ravel())
    most = np.sort(np.concatenate(ranks))
    return min(len(c), max(PROBE_LEAST, int(most[math.ceil(PROBE_AIM * len(most)) - 1]) + 1))


def scan(q: np.ndarray, x: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, candidate) of the pairs that may be within the queries' squared bounds; rows of q and x are rotated."""
    dim = x.shape[1]
    part = np.zeros((len(q), len(x)), np.float32)
    i = j = some = None
    for a in range(0, dim, COLUMNS):
        d = min(a + COLUMNS, dim)
        allow = bound * ((d / dim) * (1 + WIDTH / math.sqrt(d)) ** 2 if d < dim else 1) * (1 + 1e-4) + 1e-6
        if i is None:
            u, v = q[:, a:d], x[:, a:d]
            part += (u * u).sum(1)[:, None] + (v * v).sum(1)[None, :] - 2 * (u @ v.T)
            ok = part <= allow[:, None]
            if d == dim or np.count_nonzero(ok) <= SPARSE * part.size:
                i, j = np.nonzero(ok)
                some = part[i, j]
        else:
            diff = q[i, a:d] - x[j, a:d]
            some = some + np.einsum("ij,ij->i", diff, diff)
            ok = some <= allow[i]
            i, j, some = i[ok], j[ok], some[ok]
    return i, j


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products found for each query.

    Queries are the rows whose id is divisible by ``every``, candidates all
    rows but those of the query's own id. Ties go to the smaller id. Vectors
    that are null, empty, zero, or hold null or non-finite components take no
    part, nor do null ids; of rows that repeat an id and its vector one
    counts. Shorter vectors count as ending in zeros; more than ``DIM_MOST``
    components are an error. Fewer than ``k`` candidates are all returned; an
    empty table gives no rows. Columns other than the two named are ignored.
    """
    spark = vectors.sparkSession
    e = F.transform(F.col(embedding), lambda x: x.cast("double"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), e.alias("v")).where("id is not null and v is not null").where(~bad & F.exists("v", lambda x: x != 0))
    sizes = rows.agg(F.max(F.size("v")).alias("most"), F.min(F.size("v")).alias("least")).first()
    dim = sizes["most"]
    if dim is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if dim > DIM_MOST:
        raise ValueError(f"vectors of {dim} components")
    if dim != sizes["least"]:
        rows = rows.withColumn("v", F.concat("v", F.array_repeat(F.lit(0.0), F.lit(dim) - F.size("v"))))
    rows = rows.withColumns({"h": F.xxhash64("v"), "g": F.md5(F.array_join("v", ","))})
    # classes of equal vectors with the smallest ids of candidates; a hot vector's ids are limited before they are shuffled
    first = Window.partitionBy("h", "g").orderBy("id")
    ids = rows.select("h", "g", "id").distinct().withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1)
    ids = ids.groupBy("h", "g").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    classes = rows.groupBy("h", "g").agg(F.first("v").alias("v")).join(ids, ["h", "g"])
    classes = snapshot(classes.withColumn("c", F.element_at("ids", 1)).select("c", "v", "ids", "h", "g"), "ann-classes")
    stats = classes.agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("m")).first()
    n, top = stats["n"], stats["m"]
    lists = int(max(1, min(LISTS_MOST, n // LIST_ROWS)))
    turn = rotation(dim + 1)

    def lift(x: np.ndarray, query: bool) -> np.ndarray:
        extra = np.zeros(len(x)) if query else np.sqrt(np.maximum(top - (x * x).sum(1), 0))
        return np.column_stack([x, extra]) @ turn

    def block(column) -> np.ndarray:
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        return np.array(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dim)

    # centroids lie nearer to the rows they were fitted on, so probes are measured on others where there are
    got = classes.select("h", "v").orderBy("h").limit(min(2 * SAMPLE, n)).select("v").toArrow()["v"]
    sample = block(got)
    lists = min(lists, len(sample))
    centroids = fit_centroids(lift(sample[:SAMPLE], False), lists)
    test = sample[-SAMPLE:][::-1]
    probes = probes_for(test, lift(test, False), lift(test[:PROBE_QUERIES], True), centroids, k)
    shared = spark.sparkContext.broadcast((centroids, sample.astype(np.float32)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value[0]
        for b in batches:
            if b.num_rows:
                own = np.argmin((c * c).sum(1)[None, :] - 2 * lift(block(b.column(1)), False) @ c.T, axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), b.column(0), b.column(1)], ["list", "c", "v"])

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Queries with the squared distances of the last list that they probe and of the last neighbour in the sample."""
        c, near = shared.value
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                x = b.slice(lo, 256)
                v = block(x.column(1))
                far = (c * c).sum(1)[None, :] - 2 * lift(v, True) @ c.T
                reach = np.partition(far, probes - 1, axis=1)[:, probes - 1] + (v * v).sum(1)
                bound = np.full(len(v), np.inf)
                if len(near) > k:
                    score = v.astype(np.float32) @ near.T
                    last = np.partition(score, len(near) - k - 1, axis=1)[:, len(near) - k - 1].astype(np.float64)
                    bound = (v * v).sum(1) + top - 2 * last
                    bound += 1e-5 * (np.abs(bound) + top)  # of single precision
                yield pa.RecordBatch.from_arrays([x.column(0), x.column(1), pa.array(reach), pa.array(bound)], ["c", "v", "reach", "bound"])

    asked = rows.where(F.col("id") % every == 0).select("h", "g", F.col("id").alias("query_id")).distinct()
    asked = snapshot(asked.join(classes.select("h", "g", "c"), ["h", "g"]).select("query_id", "c"), "ann-asked")
    queries = classes.select("c", "v").join(asked.select("c").distinct(), "c").mapInArrow(prepare, "c long, v array<double>, reach double, bound double")
    queries = snapshot(queries, "ann-queries")
    files = int(max(min(n // LIST_ROWS // 8, 64), n // FILE_ROWS, 1))
    members = classes.select("c", "v").mapInArrow(assign, "list int, c long, v array<double>")
    members = snapshot(members.repartitionByRange(files, "list", "c").sortWithinPartitions("list"), "ann-lists")
    passes = max(1, -(-queries.count() // PASS_QUERIES))

    def one_pass(number: int) -> DataFrame:
        mine = queries.where(F.pmod(F.xxhash64("c"), F.lit(passes)) == number).toArrow()
        if not mine.num_rows:
            return spark.createDataFrame([], "qc long, xc long, score double")
        held = spark.sparkContext.broadcast((mine["c"].to_numpy(), block(mine["v"]), mine["reach"].to_numpy(), mine["bound"].to_numpy()))

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            c = shared.value[0]
            qc, v, reach, bound = held.value
            z, norm, bound = lift(v, True), (v * v).sum(1), bound.copy()
            z32 = z.astype(np.float32)
            best_s, best_x = np.full((len(qc), k + 1), -np.inf), np.zeros((len(qc), k + 1), np.int64)

            def offer(i: np.ndarray, x: np.ndarray, s: np.ndarray) -> None:
                """Keep the k + 1 best of each query, ties to the smaller class."""
                who = np.unique(i)
                at = np.searchsorted(who, i)
                order = np.lexsort((x, -s, at))
                at, x, s = at[order], x[order], s[order]
                place = np.arange(len(at)) - np.searchsorted(at, at)
                keep = place <= k
                all_s, all_x = np.full((len(who), 2 * k + 2), -np.inf), np.zeros((len(who), 2 * k + 2), np.int64)
                all_s[:, : k + 1], all_x[:, : k + 1] = best_s[who], best_x[who]
                all_s[at[keep], k + 1 + place[keep]], all_x[at[keep], k + 1 + place[keep]] = s[keep], x[keep]
                order = np.lexsort((all_x, -all_s), axis=1)[:, : k + 1]
                best_s[who], best_x[who] = np.take_along_axis(all_s, order, 1), np.take_along_axis(all_x, order, 1)
                last = best_s[who, k]
                full = last > -np.inf
                bound[who[full]] = np.minimum(bound[who[full]], norm[who[full]] + top - 2 * last[full])

            for b in batches:
                own, x, xc = b.column(0).to_numpy(), block(b.column(2)), b.column(1).to_numpy()
                w = lift(x, False).astype(np.float32)
                for at in np.split(np.arange(len(own)), np.flatnonzero(np.diff(own)) + 1):
                    if not len(at):
                        continue
                    centre = c[own[at[0]]]
                    ask = np.flatnonzero(norm + (centre * centre).sum() - 2 * (z @ centre) <= reach * (1 + 1e-9) + 1e-12)
                    for lo in range(0, len(ask), SCAN_QUERIES):
                        part = ask[lo : lo + SCAN_QUERIES]
                        i, j = scan(z32[part], w[at], bound[part])
                        if len(i):
                            offer(part[i], xc[at[j]], np.einsum("ij,ij->i", v[part[i]], x[at[j]]))
            q, r = np.nonzero(best_s > -np.inf)
            for lo in range(0, len(q), 1 << 16):
                i, j = q[lo : lo + (1 << 16)], r[lo : lo + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(qc[i]), pa.array(best_x[i, j]), pa.array(best_s[i, j])], ["qc", "xc", "score"])

        return snapshot(members.mapInArrow(search, "qc long, xc long, score double"), "ann-pass")

    found = one_pass(0)
    for number in range(1, passes):
        found = found.unionByName(one_pass(number))
    best = Window.partitionBy("qc").orderBy(F.desc("score"), "xc")
    found = snapshot(found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).drop("r"), "ann-found")
    pairs = asked.join(found, F.col("c") == F.col("qc")).select("query_id", "xc", "score")
    pairs = pairs.join(classes.select(F.col("c").alias("xc"), "ids"), "xc").select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
