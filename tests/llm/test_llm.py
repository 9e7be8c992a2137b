"""The ten operators against brute force, libraries and held-out labels, on whole small tables and odd rows."""

import collections
import glob
import hashlib
import os
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from strandloom.llm import fingerprints, jaccard_join, packing, pieces, quality, substring_dedup, toxicity, url_filter, vector_search, warc
from strandloom.llm import queries as q
from strandloom.llm.jaccard_join import jaccard_components
from strandloom.plans.snapshot import shared_dir, snapshot

SMALL, TINY = "/root/testdata/sf0.01", "/root/testdata/sf0.001"
ODD = "doc_id long, text string, ids string, kept string, removed string, `a.b` int"
ODD_ROWS = [
    (1, None, "x", "y", "z", 1), (2, "", "x", "y", "z", 1), (3, "  \n ", "x", "y", "z", 1), (4, "one", "x", "y", "z", 1),
    (5, "word " * 30_000, "x", "y", "z", 1), (6, "a b c d e f g h", None, None, None, None), (6, "a b c d e f g h", None, None, None, None),
    (7, "a b c d e f g h", "x", "y", "z", 1), (None, "a b c d e f g h", "x", "y", "z", 1), (8, "é漢字 ñ\t\n¿", "x", "y", "z", 1),
]


def odd(spark):
    return spark.createDataFrame(ODD_ROWS, ODD)


def none(spark):
    return spark.createDataFrame([], ODD)


def words(t):
    low = re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def shingle_set(t):
    w = words(t)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def documents(spark, sf=SMALL):
    return spark.read.parquet(f"{sf}/documents.parquet")


def components(rows):
    """Brute force over all pairs of (id, text)."""
    sets, root = [shingle_set(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    post = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            post[x].append(i)
    pairs = {(a, b) for v in post.values() for b in v for a in v if a < b}
    for a, b in pairs:
        if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return sorted(((d, len(s), least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


@pytest.mark.parametrize("make", [lambda s: documents(s, TINY), odd, none])
def test_jaccard_join_equals_all_pairs(spark, make):
    docs = make(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = [tuple(r) for r in jaccard_join.jaccard_components(docs).collect()]
    assert sorted(got, key=str) == components(rows)


def test_jaccard_join_near_copy_chain(spark):
    base = [f"w{i}" for i in range(60)]
    rows = []
    for k in range(12):  # each is near the next, the ends are far apart
        w = base[k * 2 :] + [f"v{j}" for j in range(k * 2)]
        rows.append((100 + k, " ".join(w)))
    rows += [(200 + k, " ".join([f"u{k}{i}" for i in range(40)] + base[:20])) for k in range(40)]
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert sorted((tuple(r) for r in got), key=str) == components(rows)


def test_sentencepiece_equals_library(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [r["text"] for r in documents(spark, TINY).collect()] + ["", " ", "  a  b ", "a\n\n b", "▁x", "x" * 300, "🙂é ﬁ", "a  " * 9, "the" * 90]
    import random

    r = random.Random(3)
    texts += ["".join(r.choice("aabcdeil noprst▁.é漢🙂") for _ in range(r.choice([5, 30, 200]))) for _ in range(400)]
    # many words of a length advance together, few on their own
    texts += [" ".join("".join(r.choice("aeinorst") for _ in range(r.choice([3, 6, 9, 12]))) for _ in range(3000)), " ".join("".join(r.choice("nmaé漢") for _ in range(7)) for _ in range(300))]
    m = pieces.model(path)
    m.forget()
    for t, ids in zip(texts, m.encode(texts)):
        got = np.frombuffer(ids, "<i4")
        assert got.tolist() == lib.encode(t), t[:50]
        assert m.decode(got) == lib.decode(got.tolist())


def test_sentencepiece_viterbi_equals_library(tmp_path):
    """The same pieces as a unigram model: only the type in the file is another."""
    import sentencepiece

    data = open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read()
    at = next(m.start() for m in re.finditer(rb"\x18\x02", data) if _loads(data[: m.start() + 1] + b"\x01" + data[m.start() + 2 :], 1))
    patched = data[: at + 1] + b"\x01" + data[at + 2 :]
    lib = sentencepiece.SentencePieceProcessor(model_proto=patched)
    m = pieces.PieceModel(patched)
    texts = ["this is a test of words", "Zu und. Dieüauß der.", "naïve 漢 zz", "thing " * 40]
    assert [np.frombuffer(x, "<i4").tolist() for x in m.encode(texts)] == [lib.encode(t) for t in texts]


def _loads(data, kind):
    try:
        m = pieces.PieceModel(data)
        return m.bpe == (kind == 2)
    except Exception:
        return False


def test_op1_equals_library(spark):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = {r["doc_id"]: (len(lib.encode(r["text"])), hashlib.sha256(lib.decode(lib.encode(r["text"])).encode()).hexdigest()) for r in documents(spark, TINY).collect()}
    got = q.op1_sentencepiece(spark, TINY).collect()
    assert {r["doc_id"]: (r["n_ids"], r["decoded_sha256"]) for r in got} == want and all(r["round_trip"] for r in got)


def test_sentencepiece_odd_rows(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    for make in (odd, none):
        ids = pieces.encode(make(spark), path, keep=("doc_id", "text", "a.b"), out="got")
        for r in pieces.decode(ids, path, ids="got", keep=("doc_id", "text")).collect():
            assert r["decoded"] == (r["text"] or "")


def test_warc_round_trip(spark):
    rows = [(1, "http://a/", "x" * 1500), (2, None, "x" * 1500), (3, "u\r\nv", "é" * 600), (4, "q", None), (5, "q", "small"), (6, "q", "small"), (7, "q", "z" * 3_000_000), (None, "q", "é" * 600), (8, "q", "é" * 600)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    manifest = warc.write_archives(pages)
    chunks = warc.read_archives(manifest).collect()
    assert manifest.agg({"records": "sum"}).first()[0] == len(rows)
    assert max(len(r["payload"]) for r in chunks) <= warc.CHUNK and sum(r["record_id"] == "urn:page:7" for r in chunks) == 3
    body = collections.defaultdict(bytes)
    for r in sorted(chunks, key=lambda r: r["chunk"]):
        body[r["record_id"]] += r["payload"]
        assert r["digest_so_far"] == hashlib.sha1(body[r["record_id"]]).hexdigest()
    last = {r["record_id"]: r for r in chunks if r["last"]}
    large = {}
    for i, _, t in rows:
        large[t] = max(large.get(t, 0), i or 0)
    for i, _, t in rows:
        data, r = (t or "").encode(), last[f"urn:page:{'null' if i is None else i}"]
        again = i is not None and len(data) >= 1000 and large[t] != i
        assert r["declared_digest"] == hashlib.sha1(data).hexdigest() and r["payload_bytes"] == len(data)
        assert (r["record_type"], r["refers_to"]) == (("revisit", f"urn:page:{large[t]}") if again else ("response", None))
        assert body[r["record_id"]] == (b"" if again else data)
    assert warc.read_archives(warc.write_archives(pages.limit(0))).count() == 0
    clash = pages.where("page_id = 5").selectExpr("page_id", "url", "html", "1 as id", "2 as digest", "3 as page", "4 as p", "5 as refers_to")
    assert warc.read_archives(warc.write_archives(clash)).count() == 1


def test_op2_whole_table(spark):
    got = {r["page_id"]: r for r in q.op2_warc(spark, SMALL).collect()}
    for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect():
        g = got.pop(r["page_id"])
        assert g["payload_digest"] == hashlib.sha1(r["html"].encode()).hexdigest() and g["payload_bytes"] == len(r["html"].encode())
    assert not got


@pytest.mark.parametrize("make", [lambda s: documents(s, TINY), odd, none, lambda s: odd(s).limit(1)])
def test_fingerprints(spark, make):
    rows = [(r["doc_id"], r["text"] or "") for r in make(spark).select("doc_id", "text").collect()]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    got = fingerprints.fingerprint_edits(make(spark)).collect()
    assert len(got) == len(rows)
    got = sorted(got, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["n_chars"]))
    near, same = [], {}
    for i, ((d, t), g) in enumerate(zip(rows, got)):
        after = rows[(i + 1) % len(rows)][1]
        k = len(t) // 4
        edited = t[: len(t) - k] + after[:k]
        assert (g["doc_id"], g["n_chars"]) == (d, len(t))
        assert g["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert same.setdefault(t, g["fingerprint"]) == g["fingerprint"] and same.setdefault(edited, g["edited_fingerprint"]) == g["edited_fingerprint"]
        for other, value in ((edited, g["near_edited"]), (after, g["near_next"])):
            a, b = shingle_set(t), shingle_set(other)
            near.append(value - (len(a & b) / len(a | b) if a | b else 1))
    if near:
        assert np.abs(near).max() < 0.15 and np.abs(np.mean(near)) < 0.02


@pytest.mark.parametrize("make", [lambda s: documents(s, TINY), odd, none])
def test_packing(spark, make):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    rows = [(r["doc_id"], r["text"]) for r in make(spark).select("doc_id", "text").collect()]
    want = collections.Counter((d, tuple(t.encode(x or "", add_special_tokens=False).ids + [0])) for d, x in rows)
    got = packing.pack_documents(make(spark), path).collect()
    seq, total = collections.defaultdict(list), sum(len(k[1]) * n for k, n in want.items())
    for r in got:
        seq[r["sequence_id"]].append((r["offset"], r["length"]))
        assert len(r["ids"]) == 4 * r["length"] and 0 < r["length"] <= 1024
    for v in seq.values():
        end = 0
        for a, n in sorted(v):
            assert a == end
            end += n
        assert end <= 1024
    assert sum(r["length"] for r in got) == total
    if total:
        assert len(seq) * 1024 - total < 1024 + 4 * len(seq)
    if len({d for d, _ in rows}) == len(rows):
        docs = collections.defaultdict(dict)
        for r in got:
            docs[r["doc_id"]][r["start"]] = (np.frombuffer(r["ids"], "<u4").tolist(), r["doc_tokens"])
        for (d, ids) in want:
            joined = [i for s in sorted(docs[d]) for i in docs[d][s][0]]
            assert tuple(joined) == ids and docs[d][0][1] == len(ids)
    else:  # rows that repeat have as many pieces of each kind
        pieces_ = collections.Counter((r["doc_id"], r["doc_tokens"], r["start"] + k, i) for r in got for k, i in enumerate(np.frombuffer(r["ids"], "<u4").tolist()))
        assert pieces_ == collections.Counter((d, len(ids), k, i) for (d, ids), n in want.items() for _ in range(n) for k, i in enumerate(ids))


def test_byte_bpe_equals_library():
    import random

    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    r = random.Random(1)
    texts = ["".join(r.choice(["a", "b1", " ", "\n", "\t", "é", "'s", ".", "漢", " "]) for _ in range(14)) for _ in range(2000)] + ["<|endoftext|> a", " ", ""]
    bpe = packing.engine(path)
    for x, e in zip(texts, t.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(bpe.encode(x), "<u4").tolist() == e.ids, repr(x)


def test_plan_fills_windows():
    rows = packing.plan({600: 1000, 1024: 50})
    assert rows[:, 5].max() + 1 <= 640
    assert packing.fullest_window({700: 1, 300: 1, 24: 1, 20: 3}, 1024) == {700: 1, 300: 1, 24: 1}


def _auc(score, y):
    import pandas as pd

    rank = pd.Series(score).rank().to_numpy()
    n = y.sum()
    return (rank[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n))


@pytest.mark.parametrize("score, label, folds, out, least", [(toxicity.score_toxicity, "toxic", 5, 0, 0.9), (quality.score_quality, "quality", 3, 1, 0.97)])
def test_classifiers(spark, score, label, folds, out, least):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = score(documents(spark, sf), labels).toPandas()
    assert len(got) == 10_000 and got["score"].between(0, 1).all()
    assert all(h == (zlib.crc32(str(d).encode()) % folds == out) for d, h in zip(got["doc_id"], got["held_out"]))
    both = got.merge(labels.toPandas(), on="doc_id")
    both = both[both["held_out"]]
    assert _auc(both["score"].to_numpy(), both[label].to_numpy()) > least
    if label == "toxic":  # a seventh of these labels say nothing of the text
        assert both["predicted"][both[label] == 1].mean() > 0.8 and both["predicted"][both[label] == 0].mean() < 0.005
    # labels of held-out rows have no say
    flipped = labels.selectExpr("doc_id", f"case when crc32(cast(cast(doc_id as string) as binary)) % {folds} = {out} then 1 - {label} else {label} end as {label}")
    again = score(documents(spark, sf), flipped).toPandas()
    assert (again.sort_values("doc_id")["score"].to_numpy() == got.sort_values("doc_id")["score"].to_numpy()).all()
    # odd rows, no labels, one class only
    empty = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    one = spark.createDataFrame([(i, 1, 1) for i in range(9)] + [(None, 1, 0), (4, None, None)], "doc_id long, toxic int, quality int")
    for lab in (empty, one):
        assert len(score(odd(spark), lab).toPandas()) == len(ODD_ROWS)
        assert score(none(spark), lab).count() == 0


def test_toxicity_models_equal_a_plain_model(spark):
    """Class counts, shared continuation counts and probabilities against dictionaries; probabilities sum to one."""
    docs = documents(spark, TINY).limit(60).collect()
    texts = [r["text"] for r in docs] + ["", None, "so so so"]
    y = [int(i % 3 == 0) for i in range(len(texts))]
    df = spark.createDataFrame(list(zip(texts, y)), "t string, y int").repartition(5)
    u, v, toxic, ordinary = toxicity.class_counts(df)
    h = {w: toxicity.tk.words(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w.encode())]))[0][0] for t in texts for w in words(t)}
    pairs = [collections.Counter(), collections.Counter()]
    for t, k in zip(texts, y):
        w = words(t)
        pairs[k].update(zip([None, *w], w))
    place = {int(b): a for a, b in h.items()} | {0: None}
    got = {(place[int(a)], place[int(b)]): (m, n) for a, b, m, n in zip(u, v, toxic, ordinary)}
    assert got == {p: (pairs[1][p], pairs[0][p]) for p in pairs[0] | pairs[1]}
    vocabulary = np.unique(v)
    all_texts = documents(spark, TINY).select("text")
    follows = toxicity.continuations(all_texts.repartition(3), vocabulary, np.full(len(vocabulary), 0.2), 1 << 26)
    want = collections.defaultdict(set)
    for r in all_texts.collect():
        w = words(r["text"])
        for a, b in zip([None, *w], w):
            want[b].add(a)
    assert follows.tolist() == [len(want[place[int(x)]]) for x in vocabulary]
    shared = follows / follows.sum()
    a, b = toxicity._place(vocabulary, u), toxicity._place(vocabulary, v)
    for c in (toxic, ordinary):
        for fixed in (None, 0.75, 5.0):
            hi, back, p1 = toxicity.class_model(a, b, c, shared, fixed)
            assert p1.sum() == pytest.approx(1) and (hi >= 0).all() and (back >= 0).all()
            mass = np.bincount(a, hi, minlength=len(back)) + back
            assert mass[np.unique(a[c > 0])] == pytest.approx(1)
    hi, back, p1 = toxicity.class_model(a, b, toxic, shared)
    n2 = collections.Counter(pairs[1].values())
    yy = n2[1] / (n2[1] + 2 * n2[2])
    take = [0] + [min(max(i - (i + 1) * yy * max(n2[i + 1], 1) / max(n2[i], 1), 0.1 * i), 0.95 * i) for i in (1, 2, 3)]
    of = collections.Counter()
    for (x, _), n in pairs[1].items():
        of[x] += n
    for i in range(0, len(u), 97):
        n, x = pairs[1][place[int(u[i])], place[int(v[i])]], place[int(u[i])]
        assert hi[i] == pytest.approx((n - take[min(n, 3)]) / max(of[x], 1))


def test_quality_votes_equal_brute_force():
    r = np.random.default_rng(3)
    known, z, y = r.standard_normal((40, 5)).astype(np.float32), r.standard_normal((700, 5)).astype(np.float32), r.integers(0, 2, 40).astype(float)
    known, z = quality._unit(known), quality._unit(z)
    got = quality.vote(z, known, y, 7)
    for i in range(len(z)):
        sim = sorted(((float(z[i] @ k), v) for k, v in zip(known, y)), reverse=True)[:7]
        w = [max(s, 1e-3) ** quality.SHARPNESS for s, _ in sim]
        assert got[i] == pytest.approx(sum(a * v for a, (_, v) in zip(w, sim)) / sum(w), rel=1e-4)
    same = np.array([[1, 0], [1, 0], [0, 1]], np.float32)
    assert quality.vote(same[:1], same, np.array([1.0, 0.0, 0.0]), 2)[0] == pytest.approx(0.5)
    x = r.standard_normal((50, 8)).astype(np.float32)
    mean, proj = quality.fit_latent(x)
    _, _, vt = np.linalg.svd(x - x.mean(0))
    assert np.abs(np.abs((proj * vt.T).sum(0)) - 1).max() < 1e-3


def test_quality_odd_rows(spark):
    docs, labels = documents(spark, SMALL), spark.read.parquet(f"{SMALL}/labels.parquet")
    more = docs.select("doc_id", "text").union(spark.createDataFrame([(10**6, None), (10**6 + 1, ""), (10**6 + 2, " \n"), (None, "same text"), (10**6 + 3, "same text")], "doc_id long, text string"))
    out = {r["doc_id"]: r for r in quality.score_quality(more.withColumn("y", F.lit("x")).withColumn("o", F.lit(1)), labels).collect() if r["doc_id"] is None or r["doc_id"] >= 10**6}
    train = [r["quality"] for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1]
    assert all(out[10**6 + k]["score"] == pytest.approx(np.mean(train)) for k in range(3))
    assert out[None]["held_out"] and out[None]["score"] == out[10**6 + 3]["score"]
    assert {r["score"] for r in quality.score_quality(odd(spark), spark.createDataFrame([], "doc_id long, quality int")).collect()} == {0.5}


def test_shuffled_ways_give_the_same(spark, monkeypatch):
    """Every switch between a broadcast and a shuffle, with the limit at nothing."""
    from strandloom.llm import labels as labelled

    docs, labels = documents(spark, TINY), spark.read.parquet(f"{TINY}/labels.parquet")
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    ways = [lambda: rows(labelled.with_label(docs, labels, "toxic")), lambda: rows(q.op6_url_filter(spark, TINY)), lambda: rows(q.op2_warc(spark, TINY)), lambda: rows(q.op4_packing(spark, TINY))]
    before = [w() for w in ways]
    for m, name in ((labelled, "BROADCAST_ROWS"), (url_filter, "BROADCAST_ROWS"), (warc, "BROADCAST_ROWS"), (packing, "BROADCAST_TASKS")):
        monkeypatch.setattr(m, name, -1)
    assert [w() for w in ways] == before


def test_jaccard_regions_equal_all_pairs():
    """The recursion finds the components of all links, at two thresholds."""
    r = np.random.default_rng(8)
    bases = [r.integers(0, 2**62, 60).astype(np.uint64) for _ in range(12)]
    sets = []
    for k in range(400):
        b = bases[r.integers(12)].copy()
        b[r.integers(0, 60, r.integers(0, 16))] = r.integers(0, 2**62)
        sets.append(np.unique(np.concatenate([b, r.integers(0, 2**62, r.integers(0, 12)).astype(np.uint64)])))
    tok, n = np.concatenate(sets), np.array([len(s) for s in sets])
    off = np.concatenate([[0], np.cumsum(n)])
    p = sets[0]
    box = np.array([[1 - len(np.intersect1d(p, s)) / len(np.union1d(p, s))] for s in sets])
    for t in ((75, 100), (60, 100)):
        found = jaccard_join.region_join(np.arange(400), np.arange(400), np.arange(400), n, tok, off, t, box)
        root = list(range(400))

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        want = list(range(400))
        for a in range(400):
            for b in range(a):
                both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                linked = t[1] * both >= t[0] * (n[a] + n[b] - both)
                if linked:
                    want = [want[a] if x == want[b] else x for x in want] if want[a] != want[b] else want
        for a, b in found:
            both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
            assert t[1] * both >= t[0] * (n[a] + n[b] - both)
            root[find(a)] = find(b)
        groups = lambda label: sorted(sorted(i for i in range(400) if label(i) == g) for g in {label(i) for i in range(400)})
        assert groups(find) == groups(lambda i: want[i])


def test_toxicity_odd_rows(spark):
    none_, one = spark.createDataFrame([], "doc_id long, toxic int"), spark.createDataFrame([(i, 1) for i in range(9)], "doc_id long, toxic int")
    scores = {r["score"] for r in toxicity.score_toxicity(odd(spark), none_).collect()}
    assert scores == {0.5}
    got = toxicity.score_toxicity(odd(spark), one).collect()
    assert len({r["score"] for r in got}) == 1 and got[0]["score"] > 0.5
    # texts without words score alike, equal texts too
    docs, labels = documents(spark, SMALL), spark.read.parquet(f"{SMALL}/labels.parquet")
    more = docs.select("doc_id", "text").union(spark.createDataFrame([(10**6, None), (10**6 + 1, ""), (10**6 + 2, " \n"), (None, "same text"), (10**6 + 3, "same text")], "doc_id long, text string"))
    out = {r["doc_id"]: r for r in toxicity.score_toxicity(more.withColumn("y", F.lit("x")).withColumn("score", F.lit(1)), labels).collect() if r["doc_id"] is None or r["doc_id"] >= 10**6}
    assert len({out[10**6 + k]["score"] for k in range(3)}) == 1 and out[None]["held_out"] and out[None]["score"] == out[10**6 + 3]["score"]


def test_url_filter(spark):
    rows = [(i, u) for i, u in enumerate([None, "", "no-scheme/en/", "http://", "HTTP://WWW.Example.NET/en/x?y", "http://net", "http://net/", "ftp://a.net#x", "http://x.org/fr/", "http://x.org/fr", "https://example.com/de/1#t", "https://notexample.com/de/", "https://adult-x.example.com/de/", "https://w.adult-x.example.com/en/?a=b", "http://é.net/é", "://h.org/fr/a", "http://u:p@m.Free-Bets.example.com.:8080", "http://ads-track.example.com/../x", "http://example.com:80/de/", "http://example.com/en/../de/", "http://h/" + "x/" * 20_000])]
    rows.append(rows[-1])
    got = [tuple(r) for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string"), url_filter.listing(spark)).collect()]

    def one(i, u):
        h, p = url_filter.split_url(u)
        fit = [(len(a + b), a + b, v) for a, b, v in url_filter.RULES if (h == a or h.endswith("." + a)) and p.startswith(b)]
        c = h.rpartition("@")[2].split(":")[0].rstrip(".")
        listed = any(c == x[:-1] or c.endswith("." + x[:-1]) for x in url_filter.LISTED)
        return (i, h, p, max(fit)[1] if fit else None, max(fit)[2] if fit else ("block" if listed else "allow"))

    assert sorted(got) == sorted(one(*r) for r in rows)
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url").collect()
    assert sorted(tuple(r) for r in q.op6_url_filter(spark, SMALL).collect()) == sorted(one(*r) for r in pages)
    assert url_filter.canonical("a.b:80", "/x/./y/../z/%e4%2f") == ("a.b", "/x/z/%E4%2F") and url_filter.canonical("u@h.", "/a/..") == ("h", "/") and url_filter.canonical("h", "") == ("h", "/")
    clash = spark.createDataFrame([(1, "http://a.scum/x", "k", 2, True)], "page_id long, url string, key string, hits int, verdict boolean")
    paths = spark.createDataFrame([("scum/x", "block", False, 2), ("scum/x", "block", False, 2)], "key string, verdict string, is_rule boolean, path_chars int")
    assert [tuple(r) for r in url_filter.judge(clash, paths).collect()] == [(1, "a.scum", "/x", None, "block")]
    many = spark.createDataFrame([(f"h{i}.com/", "block", False, 1) for i in range(5000)], "key string, verdict string, is_rule boolean, path_chars int")
    some = spark.createDataFrame([(i, f"http://a.h{i}.com/x") for i in range(0, 10_000, 7)], "page_id long, url string")
    assert {r["page_id"] for r in url_filter.judge(some, many).where("verdict = 'block'").collect()} == {i for i in range(0, 10_000, 7) if i < 5000}
    assert url_filter.judge(some.limit(0), many).count() == 0


def test_substring_dedup(spark):
    line = "this line has some words in it"
    passage = "first sentence of the passage is here and long. second sentence of the passage follows with more words. the third ends it all with words."
    rows = [(3, f"{line}\nown text of three."), (1, f"own text of one.\n{line}\n"), (2, f"x y {passage} z"), (5, f"before it {passage} after it."), (4, None), (6, ""), (7, "short\nshort"), (8, f"{line}\n{line}\n")]
    docs = spark.createDataFrame([(a, b, 1) for a, b in rows], "doc_id long, text string, removed int").repartition(3)
    got = {r["doc_id"]: r for r in substring_dedup.deduplicate(docs).collect()}
    assert got[1]["text"] == rows[1][1] and got[3]["text"] == "own text of three." and got[8]["text"] == ""
    assert [(s["start"], s["end"]) for s in got[3]["removed"]] == [(0, len(line) + 1)]
    assert got[2]["text"] == rows[2][1] and got[5]["text"] == rows[3][1]  # neither a line nor a window of fifty words
    assert got[4]["text"] is None and got[6]["text"] == "" and got[7]["text"] == "short\n"
    assert substring_dedup.deduplicate(odd(spark)).columns == ["doc_id", "text", "ids", "kept", "a.b", "removed"]
    assert substring_dedup.deduplicate(odd(spark)).count() == len(ODD_ROWS) and substring_dedup.deduplicate(none(spark)).count() == 0


def brute_dedup(rows):
    """Lines and 50-word windows of (id, text), found and compared as texts."""
    found = []
    for d, t in rows:
        for m in re.finditer(r"[^\r\n]*(?:\r\n|\r|\n|$)", t or ""):
            w = words(m.group())
            if w:
                found.append((d, m.start(), m.end(), ("line", *w)))
        at = list(re.finditer(r"[^\x20\x09-\x0D]+", t or ""))
        low, seen = words(t), {}
        for i in range(len(at) - 49):
            key = tuple(low[i : i + 50])
            if seen.setdefault(key, i) == i or i >= seen[key] + 50:
                found.append((d, at[i].start(), at[i + 50].start() if i + 50 < len(at) else len(t), key))
    first = {}
    for d, s, e, key in found:
        first[key] = min(first.get(key, (d, s)), (d, s))
    gone = {d: np.zeros(len(t or ""), bool) for d, t in rows}
    for d, s, e, key in found:
        if first[key] != (d, s):
            gone[d][s:e] = True
    return {d: "".join(c for c, g in zip(t or "", gone[d]) if not g) for d, t in rows}


def test_op7_equals_brute_force(spark, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in documents(spark, TINY).collect()]
    want = brute_dedup(rows)
    for r in q.op7_substring_dedup(spark, TINY).collect():
        assert r["kept_sha256"] == hashlib.sha256(want[r["doc_id"]].encode()).hexdigest()
    # many blocks and ranges, and texts cut into slices
    monkeypatch.setattr(substring_dedup, "BLOCK_UNITS", 700)
    monkeypatch.setattr(substring_dedup, "RANGE_UNITS", 100)
    got = substring_dedup.deduplicate(documents(spark, TINY).repartition(3)).collect()
    assert {r["doc_id"]: r["text"] for r in got} == want


def test_substring_dedup_odd_rows(spark):
    rows = [(1, "a\r\nb c\ra\n\nx"), (1, "b c\nother"), (None, "x\ny"), (2, "y\nz\n"), (2, "y\nz\n"), (3, "z"), (4, "é\u2028é\nü")]
    got = [tuple(r) for r in substring_dedup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).select("doc_id", "text").collect()]
    assert sorted(got, key=str)[:2] in ([(1, "a\r\nb c\r\n"), (1, "other")], [(1, "a\r\n\n"), (1, "b c\nother")])
    assert sorted(got, key=str)[2:] == [(2, "z\n"), (2, "z\n"), (3, ""), (4, "é\u2028é\nü"), (None, "x\ny")]


def exact(rows, every, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    out = {}
    for i, v in rows:
        if i % every == 0:
            s = x @ np.asarray(v, np.float64)
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def test_vector_search_recall(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    got = collections.defaultdict(list)
    for r in q.op9_vector_search(spark, "/root/testdata/sf0.1").orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    want = exact(rows, 20, 20)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    recall = np.mean([len({a for a, _ in got[i]} & {a for a, _ in want[i]}) / 20 for i in want])
    assert recall >= 0.9
    scores = dict(rows)
    for i, v in got.items():
        for j, s in v:
            assert s == pytest.approx(float(np.dot(np.array(scores[i], np.float64), np.array(scores[j], np.float64))), abs=1e-12)


def test_vector_search_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (40, None), (60, [0.0, 0.0]), (80, [nan, 1.0]), (100, [inf, 1.0]), (120, [None, 1.0]), (None, [1.0, 1.0]), (1, [1.0, 0.0]), (2, [2.0, 1.0]), (3, [-1.0, 3.0]), (4, [0.5]), (0, [1.0, 0.0])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as v", "2 as c", "3 as list")
    got = sorted(tuple(r) for r in vector_search.nearest(docs).collect())
    assert got == [(0, 1, 2, 2.0), (0, 2, 1, 1.0), (0, 3, 20, 1.0), (0, 4, 4, 0.5), (0, 5, 3, -1.0), (20, 1, 2, 2.0), (20, 2, 0, 1.0), (20, 3, 1, 1.0), (20, 4, 4, 0.5), (20, 5, 3, -1.0)]
    assert vector_search.nearest(docs.limit(0)).count() == 0
    many = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(100)], "vec_id long, embedding array<float>")
    first = [r["vec_id"] for r in vector_search.nearest(many).where("query_id = 20").orderBy("rank").collect()]
    assert first == [i for i in range(21) if i != 20]


def test_vector_search_recall_of_many_lists(spark, monkeypatch):
    monkeypatch.setattr(vector_search, "PASS_QUERIES", 70)  # some passes
    r = np.random.default_rng(5)
    x = r.standard_normal((20_000, 64)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x = x.astype(np.float32)
    docs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(4)
    got = collections.defaultdict(set)
    for row in vector_search.nearest(docs, every=100).collect():
        got[row["query_id"]].add(row["vec_id"])
    x = x.astype(np.float64)
    s = x[::100] @ x.T
    s[np.arange(200), np.arange(0, 20_000, 100)] = -np.inf
    want = np.argsort(-s, axis=1)[:, :20]
    recall = np.mean([len(got[100 * i] & set(w.tolist())) / 20 for i, w in enumerate(want)])
    print("recall", recall)
    assert recall >= 0.93


def test_substring_dedup_takes_whole_passages(spark):
    w = [f"w{i}" for i in range(60)]
    cut = " ".join(w[:45]) + ". " + " ".join(w[45:57]) + ". É " + " ".join(w[57:])
    short = "\n".join(" ".join(w[i : i + 3]) for i in range(0, 60, 3))
    few = "one two\nthree four\nfive six\nseven eight"
    rows = [(1, f"é own words {cut} and on"), (2, f"ü then other {cut} goes off"), (3, f"first\n{short}\nx"), (4, f"second\n{short}\ny"), (5, f"a\n\n{few}\n\nb"), (6, f"c\n\n{few}\n\nd"), (7, "so " * 200), (8, "so " * 200)]
    got = {r["doc_id"]: r["text"] for r in substring_dedup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    for d in (1, 3, 5):
        assert got[d] == dict(rows)[d]
    assert got[2] == "ü then other goes off" and got[4].split() == ["second", "y"] and got[6].split() == ["c", "d"]
    assert got[7] == "so " * 50 and got[8] == ""
    docs = documents(spark, "/root/testdata/sf0.001").select("doc_id", "text")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = {r["doc_id"]: r["removed"] for r in substring_dedup.deduplicate(docs).collect()}
    first = {}
    for d in sorted(texts):
        m = list(re.finditer(r"[^\x20\x09-\x0D]+", texts[d]))
        low = words(texts[d])
        gone = np.zeros(len(texts[d]), bool)
        for x in kept[d]:
            gone[x["start"] : x["end"]] = True
        for i in range(len(m) - 49):
            a = first.setdefault(tuple(low[i : i + 50]), (d, i))
            if a != (d, i) and (a[0] != d or i >= a[1] + 50):
                assert gone[m[i].start() : m[i + 49].end()].all()


def test_warc_ids_that_repeat_with_other_payloads(spark):
    a, b, c = "a" * 1200, "b" * 1200, "c" * 1200
    rows = [(1, "u", a), (1, "u", b), (1, "u", c), (2, "u", a), (3, "u", b)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = warc.read_archives(warc.write_archives(pages)).where("last").select("record_id", "record_type", "refers_to", "payload_bytes").collect()
    kinds = sorted((r["record_id"].split(":")[-1], r["record_type"], (r["refers_to"] or "").split(":")[-1]) for r in got)
    assert kinds == [("1", "response", ""), ("1", "revisit", "2"), ("1", "revisit", "3"), ("2", "response", ""), ("3", "response", "")]


def test_toxicity_counts_every_row(spark):
    """Tables, model and logistic function over all rows against the plain ones; rows beyond any former bound have a say."""
    docs = documents(spark, TINY).limit(80).collect()
    rows = [(r["text"], int(i % 3 == 0)) for i, r in enumerate(docs)] + [("", 1), (None, 0)] + [(f"word{i} common", i % 2) for i in range(3000)]
    df = spark.createDataFrame(rows, "t string, y int").repartition(7)
    u, v, *counts = toxicity.class_counts(df)
    a, b = toxicity.word_slots(u), toxicity.word_slots(v)
    pairs, words_, often = toxicity.class_tables(df, 1 << 26)
    merged = collections.defaultdict(lambda: [0, 0])
    for x, y, m, n in zip(a.tolist(), b.tolist(), *counts):
        merged[x, y][0] += m
        merged[x, y][1] += n
    key = np.array([x << toxicity.SLOT_BITS | y for x, y in merged])
    x, y = np.array(list(merged)).T
    assert pairs.sum(1).tolist() == [c.sum() for c in counts] and counts[0].sum() > 3000
    for k in (0, 1):
        c = np.array([n[k] for n in merged.values()])
        assert (pairs[k] == np.bincount(toxicity.pair_slots(key), c, toxicity.PAIRS)).all()
        assert often[k].tolist() == [int((c == i).sum()) for i in (1, 2, 3, 4)]
        for j, w in enumerate((c, c == 1, c == 2, c > 2)):
            assert (words_[k, j] == np.bincount(x, w, toxicity.SLOTS)).all()
        assert (words_[k, 4] == np.bincount(y[c > 0], minlength=toxicity.SLOTS)).all()
    follows = toxicity.continuations(df.select("t"), None, words_[:, 4].sum(0) / words_[:, 4].sum(), 1 << 26)
    assert (follows == np.bincount(y, minlength=toxicity.SLOTS)).all()
    model = toxicity.fit_model(pairs, words_, often, follows)
    shared = follows / follows.sum()
    for k in (0, 1):
        c = np.array([n[k] for n in merged.values()])
        hi, back, p = toxicity.class_model(np.where(x == 0, toxicity.SLOTS, x), y, c, shared)
        alone = np.bincount(toxicity.pair_slots(key), minlength=toxicity.PAIRS)[toxicity.pair_slots(key)] == 1
        got = model["pair"][toxicity.pair_slots(key), k] * model["share"][x, k]
        assert alone.mean() > 0.9 and got[alone] == pytest.approx(hi[alone], rel=1e-4, abs=1e-7)
        assert model["back"][x, k] == pytest.approx(back[np.where(x == 0, toxicity.SLOTS, x)], rel=1e-4)
        assert model["p"][y, k] == pytest.approx(p[y], rel=1e-4)


def test_toxicity_logistic_over_all_rows(spark):
    r = np.random.default_rng(5)
    x = r.standard_normal((30_000, 3)) * [1, 5, 0.1] + 2
    y = (r.random(30_000) < 1 / (1 + np.exp(-(x @ [1.0, -0.3, 2.0] - 2)))).astype(int)
    df = spark.createDataFrame([(*map(float, z), int(k)) for z, k in zip(x, y)], "a double, b double, c double, y int").repartition(5)
    (loss, mean, scale, w), (_, _, _, w2) = toxicity.fit_logistic(df, ["a", "b", "c"], [[0, 1, 2], [1]], 0.0)
    z = np.column_stack([(x - x.mean(0)) / x.std(0), np.ones(len(x))])
    assert mean == pytest.approx(x.mean(0)) and scale == pytest.approx(x.std(0))
    assert np.abs(z.T @ (y - 1 / (1 + np.exp(-z @ w)))).max() < 1e-2 and np.abs(z[:, [1, 3]].T @ (y - 1 / (1 + np.exp(-z[:, [1, 3]] @ w2)))).max() < 1e-2


def test_quality_projection_without_a_square_matrix(monkeypatch):
    r = np.random.default_rng(6)
    x = (r.standard_normal((900, 120)) * np.linspace(8, 0, 120) @ r.standard_normal((120, 700)) + r.standard_normal((900, 700))).astype(np.float16)
    mean, proj = quality.fit_latent(x)
    z = x.astype(np.float64) - x.mean(0, dtype=np.float64)
    want = np.linalg.svd(z, full_matrices=False)[2][: quality.LATENT]
    assert np.linalg.svd(want @ proj, compute_uv=False).min() > 0.9999
    assert np.abs(np.abs((proj.T * want).sum(1)) - 1).max() < 1e-3
    import tracemalloc

    tracemalloc.start()
    quality.fit_latent(np.zeros((300, 2312), np.float16) + r.standard_normal((300, 1)).astype(np.float16))
    assert tracemalloc.get_traced_memory()[1] < 2312 * 2312 * 8
    tracemalloc.stop()


def shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {p: os.path.getsize(p) for d in dirs for p in glob.glob(f"{d.getPath()}/**/shuffle_*", recursive=True)}


def test_jaccard_join_leaves_little_on_disk(spark):
    docs, shared = documents(spark), shared_dir(spark).removeprefix("file://")
    was, stages = shuffle_files(spark), set(os.listdir(shared))
    result = jaccard_components(docs)  # the frame stays, so no collection of garbage may take its files
    size = docs.selectExpr("sum(octet_length(text))").first()[0]
    for _ in range(50):  # files go a moment after the plan has ended
        left = sum(n for p, n in shuffle_files(spark).items() if p not in was)
        if left < size // 20:
            break
        time.sleep(0.2)
    assert left < size // 20
    made = {x.rsplit("-", 1)[0] for x in set(os.listdir(shared)) - stages}
    assert "jj-nodes" in made and "jj-shared" not in made
    assert result.count() == docs.count()


def test_snapshot_keeps_the_session_setting(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, None)
    df = snapshot(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count(), "kept")
    assert spark.conf.get(key, None) == was and df.count() == 7
