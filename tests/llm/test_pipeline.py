"""Each stage of the corpus pipeline works on what the one before kept."""

import os

import pytest

import corpus_pipeline
from strandloom.plans.session import give_back
from strandloom.plans.snapshot import shared_dir

TINY = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    sf = "/root/testdata/sf0.001"
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality classifier", "n-gram Jaccard join", "substring dedup", "packing"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = {r["doc_id"] for r in docs.select("doc_id").collect()}
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = corpus_pipeline.snapshot(stage(spark, docs, sf), "test-stage")
        assert docs.columns == COLUMNS
        rows = docs.collect()
        ids = {r["doc_id"] for r in rows}
        assert ids <= before and len(rows) == len(ids)
        if name != "n-gram Jaccard join":
            clean = {d for d in before if d in labels and labels[d]["toxic"] == 0 and labels[d]["quality"] == 1}
            assert len(clean & ids) >= 0.95 * len(clean)
        assert all(r["n_chars"] == len(r["text"]) for r in rows)
        before = ids
    packed = corpus_pipeline.pack_sequences(spark, docs, sf)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == before


ODD = [
    (1, None, "en", "s", 0, 1), (2, "", "en", "s", 0, 1), (3, " \n ", None, None, None, None), (4, "one", "en", "s", 3, 1), (5, "long word " * 20_000, "en", "s", 200_000, 1),
    (6, "a b c d e f g h\nand more words here", "en", "s", 8, 1), (6, "a b c d e f g h\nand more words here", "en", "s", 8, 1), (7, "a b c d e f g h\nand more words here", "en", "s", 8, 1),
    (None, "a b c d e f g h\nand more words here", "en", "s", 8, 1), (6, "quite another text of the same id", "en", "s", 8, 1), (None, "text without an id", "en", "s", 8, 1),
]


@pytest.mark.parametrize("limit", [corpus_pipeline.BROADCAST_ROWS, -1])
def test_odd_rows(spark, monkeypatch, limit):
    """Nulls, empty and long texts, repeated rows and ids, clashing names, an empty table; both ways to drop rows."""
    monkeypatch.setattr(corpus_pipeline, "BROADCAST_ROWS", limit)
    sf = "/root/testdata/sf0.001"
    docs = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string, n_chars long, `id` int").withColumnRenamed("id", "h.x")
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, sf).collect()
        empty = stage(spark, docs.limit(0), sf)
        assert empty.count() == 0
        if name == "packing":
            assert {r["doc_id"] for r in got} == {None, 1, 2, 3, 4, 5, 6, 7}
            assert sum(r["length"] for r in got) == sum({(r["doc_id"], r["doc_tokens"]): r["doc_tokens"] * sum(x["start"] == 0 and (x["doc_id"], x["doc_tokens"]) == (r["doc_id"], r["doc_tokens"]) for x in got) for r in got}.values())
            continue
        assert empty.columns == docs.columns
        key = lambda r: (str(r[0]), r[1] or "")
        rows = sorted(((r["doc_id"], r["text"]) for r in got), key=key)
        if name in ("toxicity", "quality classifier"):
            assert set(rows) <= {(r[0], r[1]) for r in ODD} and {(1, None), (2, ""), (3, " \n ")} <= set(rows)
            kept = [r for r in ODD if (r[0], r[1]) in set(rows)]
            assert len(kept) == len(rows)  # equal rows share their fate
        elif name == "n-gram Jaccard join":
            assert rows == sorted(((r[0], r[1]) for r in ODD if not (r[0] in (7, None) and r[1].startswith("a b"))), key=key)
        else:
            assert len(rows) == len(ODD)  # null ids rank first
            assert (6, "") in rows and (7, "") in rows and (6, "quite another text of the same id") in rows and (1, None) in rows
            assert (None, "a b c d e f g h\nand more words here") in rows
        assert all(r["n_chars"] is None or name != "substring dedup" or r["n_chars"] == len(r["text"] or "") for r in got)


def test_run_leaves_the_last_stage_alone(spark):
    import os

    from strandloom.plans.snapshot import shared_dir

    where = shared_dir(spark).removeprefix("file://")
    before = set(os.listdir(where))
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert got.count() > 0 and {x.split("-")[0] for x in set(os.listdir(where)) - before} == {"stage"}
    assert len(set(os.listdir(where)) - before) == 1


def test_give_back_shrinks_the_driver(spark):
    heap = spark._jvm.java.lang.management.ManagementFactory.getMemoryMXBean()
    waste = spark.sparkContext._gateway.new_array(spark._jvm.long, 12_000_000)
    used = heap.getHeapMemoryUsage().getUsed()
    del waste
    give_back(spark)
    assert heap.getHeapMemoryUsage().getUsed() < used - 90_000_000


def test_stages_give_back_and_leave_their_result_only(spark, monkeypatch):
    docs, shared, calls = spark.read.parquet(f"{TINY}/documents.parquet"), shared_dir(spark).removeprefix("file://"), []
    monkeypatch.setattr(corpus_pipeline, "give_back", lambda s: calls.append(s))
    for stage, name in ((corpus_pipeline.drop_toxic, "toxic-scores"), (corpus_pipeline.drop_low_quality, "quality-scores"), (corpus_pipeline.one_of_each_group, "near-groups")):
        was = set(os.listdir(shared))
        calls.clear()
        stage(spark, docs, TINY)
        assert len(calls) == 2
        assert [x.rsplit("-", 1)[0] for x in set(os.listdir(shared)) - was if not x.startswith(".")] == [name]
