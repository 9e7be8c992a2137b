"""Judge URLs by rules and listed canonical URLs.

Every URL is turned into the keys that could list it: each suffix of its host
with each prefix of its path that some listed path could be. A blocked Bloom
filter (one 512-bit block per key, ``PROBES`` bits in it) of all listed keys
passes the possible hits; an exact hash join with the list removes the false
ones. The longest remaining rule wins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.llm import textkit as tk
from strandloom.plans.snapshot import snapshot

#: Size of the filter: blocks of 64 bytes by the number of keys, at most 64 MB.
KEYS_A_BLOCK, BLOCKS_MOST, PROBES = 32, 1 << 20, 6

#: Fixed values: (host, path, verdict) of the rules of the URL query.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
#: Listed hosts of the URL query, blocked where no rule fits: those of the kinds that block lists name (adult, pills, games, ads, spam).
LISTED = ("adult-x.example.com/", "cheap-pills.example.com/", "casino-win.example.com/", "free-bets.example.com/", "ads-track.example.com/", "spam-farm.example.com/")
#: Hit lists that may be broadcast to the pages; beyond it both sides are shuffled.
BROADCAST_ROWS = 1 << 16


_PORT, _PERCENT = re.compile(r":\d*$"), re.compile(r"%[0-9A-Fa-f]{2}")


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path); both empty without ``://``."""
    if url is None:
        return "", ""
    at = url.find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    cut = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    end = min((i for i in map(rest.find, "?#") if i >= 0), default=len(rest))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), rest[:end]


def canonical(host: str, path: str) -> tuple[str, str]:
    """What the list is asked for: no user, port or dots at the host's end; no dot segments in the path, percent codes in upper case."""
    host = host.rpartition("@")[2]
    host = _PORT.sub("", host).rstrip(".")
    path = _PERCENT.sub(lambda m: m[0].upper(), path)
    if "/." in path:
        out: list[str] = []
        parts = path.split("/")[1:] if path.startswith("/") else path.split("/")
        for i, x in enumerate(parts):
            if x == "..":
                del out[-1:]
            elif x != ".":
                out.append(x)
            if x in (".", "..") and i + 1 == len(parts):
                out.append("")
        path = "/" + "/".join(out)
    return host, path or "/"


def keys(host: str, path: str, lengths: tuple[int, ...]) -> list[str]:
    """Host suffixes at dots, with path prefixes of the lengths that listed paths have."""
    hosts = [host] + [host[i + 1 :] for i, c in enumerate(host) if c == "."]
    return [h + path[:n] for h in hosts if h for n in lengths if n <= len(path)]


def _hash(texts: list[str]) -> np.ndarray:
    out = []
    for _, data, off in tk.slices(pa.array(texts, pa.large_string())):
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * tk._power(tk._BASE, len(data)), out=total[1:])
        back = tk._power(tk._BASE_INV, len(data) + 1)
        out.append(tk.mix((total[off[1:]] - total[off[:-1]]) * back[off[:-1]]))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _bits(h: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, bit numbers) of each hash."""
    block = (h % np.uint64(blocks)).astype(np.int64)
    g = tk.mix(h + np.uint64(0x51ED270B))
    return block, np.stack([(g >> np.uint64(9 * i)) & np.uint64(511) for i in range(PROBES)], axis=1).astype(np.int64)


def bloom(listed: DataFrame, n: int) -> np.ndarray:
    """The filter as (blocks, 8) words; tasks fill partial filters, which are then or-ed by block range."""
    blocks = int(min(BLOCKS_MOST, max(1, -(-n // KEYS_A_BLOCK))))
    step = 4096

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros((blocks, 8), np.uint64)
        for b in batches:
            block, bit = _bits(_hash(b.column(0).to_pylist()), blocks)
            np.bitwise_or.at(bits, (block[:, None], bit >> 6), np.uint64(1) << (bit & 63).astype(np.uint64))
        for a in range(0, blocks, step):
            if bits[a : a + step].any():
                yield pa.RecordBatch.from_arrays([pa.array([a // step], pa.int32()), pa.array([bits[a : a + step].tobytes()], pa.binary())], ["part", "bits"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for p, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                x = np.frombuffer(x, np.uint64)
                held[p] = held[p] | x if p in held else x
        for p, x in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([x.tobytes()], pa.binary())], ["part", "bits"])

    shape = "part int, bits binary"
    out = np.zeros((blocks, 8), np.uint64)
    for r in listed.select("key").mapInArrow(fill, shape).repartition("part").mapInArrow(merge, shape).toLocalIterator():  # 64 MB at most
        x = np.frombuffer(r["bits"], np.uint64).reshape(-1, 8)
        out[r["part"] * step : r["part"] * step + len(x)] = x
    return out


def listing(spark: SparkSession, rules=RULES, listed=LISTED) -> DataFrame:
    """(key, verdict, is_rule, path_chars) rows of rules and canonical listed URLs; any table of this shape will do, of any size."""
    urls = ["".join(canonical(*split_url("http://" + x))) for x in listed]
    rows = [(h + p, v, True, len(p)) for h, p, v in rules] + [(x, "block", False, len(x) - x.index("/")) for x in urls]
    return spark.createDataFrame(rows, "key string, verdict string, is_rule boolean, path_chars int")


def judge(urls: DataFrame, listed: DataFrame, row_id: str = "page_id", url: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row.

    ``rule`` is the longest rule that fits the host and path as they stand,
    else null; of equal rules one counts. Without a rule, a URL whose canonical
    form is under a listed key is blocked, any other allowed. Null URLs and
    URLs without ``://`` have an empty host and path and are allowed. Repeated
    rows give repeated results, an empty table none; columns other than the
    two named are ignored, whatever their names.
    """
    sc = urls.sparkSession.sparkContext
    lengths = tuple(sorted(r[0] for r in listed.select("path_chars").distinct().collect()))  # path lengths, not rows
    listed = listed.withColumn("key", F.concat(F.when(F.col("is_rule"), "r:").otherwise("l:"), "key"))
    shared = sc.broadcast((bloom(listed, listed.count()), lengths))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, lengths = shared.value
        for b in batches:
            hosts, paths, own, rows = [], [], [], []
            for i, u in enumerate(b.column(1).to_pylist()):
                h, p = split_url(u)
                hosts.append(h)
                paths.append(p)
                # rules are about the URL as it stands, the list about its canonical form
                k = ["r:" + x for x in keys(h, p, lengths)] + ["l:" + x for x in keys(*canonical(h, p), lengths)]
                own += k
                rows += [i] * len(k)
            hits: list[list[str]] = [[] for _ in hosts]
            if own:
                block, bit = _bits(_hash(own), len(bits))
                ok = ((bits[block[:, None], bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1)).all(1)
                for i in np.flatnonzero(ok).tolist():
                    hits[rows[i]].append(own[i])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(hits, pa.list_(pa.string()))], ["page_id", "host", "path", "hits"])

    seen = urls.select(F.col(row_id).alias("page_id"), F.col(url).cast("string").alias("u")).mapInArrow(probe, f"page_id {urls.schema[row_id].dataType.simpleString()}, host string, path string, hits array<string>")
    seen = snapshot(seen, "url-seen")
    # what is looked up is the set of different hit lists, not the pages: few, however many pages share them
    asked = seen.select("hits").where(F.size("hits") > 0).distinct()
    exact = asked.select("hits", F.explode("hits").alias("key")).join(listed, "key")
    best = snapshot(exact.groupBy("hits").agg(F.max(F.when(F.col("is_rule"), F.struct(F.length("key").alias("n"), F.substring("key", F.lit(3), F.length("key")).alias("key"), "verdict"))).alias("r"), F.bool_or(~F.col("is_rule")).alias("l")), "url-best")
    if best.count() <= BROADCAST_ROWS:
        best = F.broadcast(best)
    out = seen.join(best, "hits", "left")
    return out.select("page_id", "host", "path", F.col("r.key").alias("rule"), F.coalesce(F.col("r.verdict"), F.when(F.col("l"), "block"), F.lit("allow")).alias("verdict"))
