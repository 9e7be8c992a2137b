"""Golden cases, plain models, and an end-to-end run on small genomes."""

import random

import pytest
from pyspark.sql import functions as F

from strandloom.functions import codons
from strandloom.functions import sequences as S
from strandloom.functions import text as X
from strandloom.operators import alignment as A
from strandloom.operators import families as M
from strandloom.operators import graph as G
from strandloom.operators import positions as P
from strandloom.operators import refind
from strandloom.operators import relations as R
from strandloom.operators import similarity as C
from strandloom.operators import support as U
from strandloom.sources import sequences as src
from strandloom.sources import sinks


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("dna, code, want", [("ATGAAATTTTAA", 11, "MKF*"), ("TTGAAATTT", 11, "MKF"), ("ATGNNNAAA", 11, "MXK"), ("AAATTT", 11, "KF"), ("ATGTGAAAA", 4, "MWK"), ("ATGTGAAAA", 11, "M*K"), ("", 11, "")])
def test_translate(spark, dna, code, want):
    assert one(spark, S.translate_codons(F.col("s"), code), s=dna) == want


def test_codes():
    assert len(codons.DIFFERENCES) == 27 and all(len(codons.codon_table(c)) == 64 for c in codons.DIFFERENCES)
    assert {c for c, a in codons.codon_table(2).items() if a == "*"} == {"TAA", "TAG", "AGA", "AGG"}
    assert codons.codon_table(31)["TGA"] == "W" and codons.codon_table(28)["TGA"] == "*"


@pytest.mark.parametrize("dna, want", [("CGN", "R"), ("AAN", "X"), ("TTGAAA", "LK"), ("ATGAAAT", "MK"), ("auguuy", "MF"), ("A-G", "X")])
def test_translate_standard(spark, dna, want):
    assert one(spark, S.translate_standard(F.col("s")), s=dna) == want


def test_small_sequence_functions(spark):
    assert one(spark, S.reverse_complement(F.col("s")), s="ACGTRYKM") == "KMRYACGT"
    assert one(spark, S.reverse_complement(F.col("s")), s="ACGT-N") == "N-ACGT"
    valid = S.is_valid_gene(F.col("d"), F.col("p"))
    assert [one(spark, valid, d=d, p=p) for d, p in (("ATGAAA", "MK"), ("ATGA", "MK"), ("ATGAAA", "M*K"), ("ATGAAA", "MXK*"))] == [True, False, False, True]
    with pytest.raises(Exception, match="nothing but X"):
        one(spark, valid, d="ATGAAA", p="XXX")
    assert one(spark, S.terminal_inserts(F.col("c")), c="3I4=100I") == 103 and one(spark, S.terminal_inserts(F.col("c")), c="4=") == 0
    assert one(spark, S.trim_found(F.col("s")), s="NEXACXTEGNXE") == "ACNTNG"
    assert one(spark, S.back_translate(F.col("p"), F.col("d")), p="M-K", d="ATGAAA") == "ATG---AAA"
    assert one(spark, S.kmers(F.col("s"), 3), s="AC") == [] and one(spark, S.kmers(F.col("s"), 3), s="AAAA") == ["AAA"]
    assert one(spark, S.codon_failures(F.col("d"), F.col("p")), d="ATGAANNNA", p="MQ") == [1, 2, 3]


def test_best_frame_against_plain_model(spark):
    r = random.Random(3)
    table = codons.ambiguous_codons(1)

    def plain(s, f):
        s = s[f:] + "N" * (3 - len(s[f:]) % 3)
        return "".join(table.get(s[i : i + 3], "X") for i in range(0, len(s), 3))

    rows = []
    for _ in range(30):
        s = "".join(r.choice("ACGTN") for _ in range(r.randint(0, 60)))
        t = plain(C._rc(s), r.randint(0, 2))
        frames = [plain(x, f) for f in range(3) for x in (s, C._rc(s))]
        words = lambda p: {p[i : i + 3] for i in range(len(p) - 2)}
        rows.append((s, t, max(frames, key=lambda p: len(words(p) & words(t)))))
    got = spark.createDataFrame(rows, "s string, t string, want string").withColumn("got", S.best_frame(F.col("s"), F.col("t"))).collect()
    assert all(x["got"] == x["want"] for x in got)


def test_text_functions(spark):
    assert one(spark, X.clean_gene_name(F.col("s")), s=";;geneA;gene-B; ;x_y~z;;") == "geneA~~~geneB~~~~~~x_y~z"
    assert one(spark, X.sample_key(F.col("s")), s="sample_name_gene_1") == "sample_name"
    assert one(spark, X.percent_decode(F.col("s")), s="50% a+b%2C%C3%A9") == "50% a+b,é"
    assert one(spark, X.wrap(F.col("s")), s="A" * 120) == "A" * 60 + "\n" + "A" * 60
    got = one(spark, X.attributes(F.col("s")), s='ID=a;note=foo%2Cbar;x=foo,bar;note="q";flag;')
    assert [(a["key"], a["values"]) for a in got] == [("ID", ["a"]), ("note", ["foo,bar", "q"]), ("x", ["foo", "bar"]), ("flag", [])]
    assert [one(spark, X.number_text(F.col("x")), x=v) for v in (100.0, 0.30000000000000004, 1e7)] == ["100.0", "0.30000000000000004", "10000000.0"]


@pytest.mark.parametrize("values, want", [([9, 5, 9, 5], 9), ([4, 7, 7, 4, 7, 4], 4), ([3, 10, 4, 10, 5], 10)])
def test_first_mode(spark, values, want):
    rows = spark.createDataFrame([("g", v, i) for i, v in enumerate(values)], "g string, v int, o int")
    assert P.first_mode(rows, ["g"], "v", "o").first()["len_mode"] == want


def test_entropy(spark):
    rows = spark.createDataFrame([("a", "ACGTNN"), ("a", "ACGTAA"), ("a", "aCgTNa"), ("b", "AAA"), ("b", "ACA"), ("c", "NN")], "g string, s string")
    got = {r["g"]: r["entropy"] for r in A.weighted_entropy(A.column_counts(rows, "g", "s"), "g").collect()}
    assert got["a"] == pytest.approx(0.06045494935779483) and got["b"] == pytest.approx(0.23104906018664842) and got["c"] is None


def test_classes_and_core(spark):
    n = spark.createDataFrame([(10, 4), (20, 3), (30, 2), (40, 0)], "node long, n long")
    total = spark.createDataFrame([(4,)], "t long")
    assert {r["class"]: r["n_nodes"] for r in U.class_counts(n, "n", total).collect()} == {"core": 1, "soft_core": 0, "shell": 2, "cloud": 1, "total": 4}
    edge = spark.createDataFrame([(1, 99), (2, 98), (3, 95), (4, 94), (5, 15), (6, 14)], "node long, n long")
    got = {r["class"]: r["n_nodes"] for r in U.class_counts(edge, "n", spark.createDataFrame([(100,)], "t long")).collect()}
    assert got == {"core": 1, "soft_core": 2, "shell": 2, "cloud": 1, "total": 6}
    core = U.core_nodes(spark.createDataFrame([(10, 4), (20, 3), (30, 4), (40, 1)], "node long, n long"), "n", total, 0.75)
    assert [r["node"] for r in U.core_subset(core, ["node"], 2).orderBy("node").collect()] == [10, 20]
    with pytest.raises(Exception, match="fewer core genes"):
        U.core_subset(core, ["node"], 4).collect()


def test_unique_ids_pass_over_taken_ones(spark):
    rows = spark.createDataFrame([(0, "dup"), (1, "dup_1"), (2, "dup"), (3, "dup")], "o int, id string")
    got = [r["unique_id"] for r in P.unique_ids(rows.withColumn("g", F.lit(1)), ["g"], "id", ["o"]).orderBy("o").collect()]
    assert got == ["dup", "dup_1", "dup_2", "dup_3"]


def dp(a, b, infix, wild=()):
    eq = lambda x, y: x == y or (x, y) in wild or (y, x) in wild
    row = [0 if infix else j for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (not eq(x, y)), row[j] + 1, new[-1] + 1))
        row = new
    return row


def test_edit_distance_against_plain_model():
    r = random.Random(5)
    for _ in range(200):
        a, b = ("".join(r.choice("ACGTN") for _ in range(r.randint(1, 20))) for _ in range(2))
        assert list(C.edit_columns(a, b, C.DNA_WILDCARDS)) == dp(a, b, True, C.DNA_WILDCARDS)[1:]
        assert C.global_distance(a, b) == dp(a, b, False)[-1]
    assert C.locations("ACGT", "TTACGTTT") == (0, [(2, 5)]) and C.extended_cigar("ACGT", "ACGT") == "4="
    assert C.infix_distance("AAAA", "TTTT", most=1) == (-1, []) and C.infix_distance("ACNT", "GGACGTGG", C.DNA_WILDCARDS)[0] == 0
    assert C.identity("ACGTACGT", C._rc("TTACGTACGTTT"), True) == 1.0


def test_greedy_clusters_against_plain_model(spark):
    r = random.Random(9)
    seqs = []
    for f in range(4):
        base = "".join(r.choice("ACGT") for _ in range(60 + 7 * f))
        for k in range(4):
            s = list(base)
            for _ in range(k):
                s[r.randrange(len(s))] = r.choice("ACGT")
            seqs.append("".join(s)[: len(s) - k])
    rows = [(f"s{i:02d}", s) for i, s in enumerate(seqs)]
    reps, want = [], {}
    for k, s in sorted(rows, key=lambda x: (-len(x[1]), x[0])):
        hit = next((q for q, t in reps if C.identity(s, t, True, 0.9) >= 0.9), None)
        if hit is None:
            reps.append((k, s))
        want[k] = hit or k
    got = {x["k"]: x["centroid"] for x in C.greedy_clusters(spark.createDataFrame(rows, "k string, s string"), "k", "s", 0.9, True, 7).collect()}
    assert got == want


def test_greedy_clusters_of_hot_words_and_long_chains(spark):
    r = random.Random(4)
    text = lambda n, letters="ACDE": "".join(r.choice(letters) for _ in range(n))
    hot = [(f"l{i:03d}", text(80)) for i in range(210)]
    one = text(30)
    short = [("s1", one), ("s2", one[:29]), ("s3", one[:12] + "E" * (one[12] != "E") + "A" * (one[12] == "E") + one[13:28])]
    line = text(300, "FGHIKLMNPQRSTVWY")
    chain = [(f"t{i:02d}", line[4 * i : 4 * i + 40]) for i in range(54)]
    rows = hot + short + chain
    reps, want = [], {}
    for k, s in sorted(rows, key=lambda x: (-len(x[1]), x[0])):
        hit = next((q for q, t in reps if C.identity(s, t, False, 0.9) >= 0.9), None)
        if hit is None:
            reps.append((k, s))
        want[k] = hit or k
    got = {x["k"]: x["centroid"] for x in C.greedy_clusters(spark.createDataFrame(rows, "k string, s string").repartition(4), "k", "s", 0.9, False, 2).collect()}
    assert want["s2"] == want["s3"] == "s1" and got == want


def test_search_finds_a_mutated_gene_on_either_strand():
    r = random.Random(2)
    gene = "".join(r.choice("ACGT") for _ in range(60))
    left, right = ("".join(r.choice("ACGT") for _ in range(80)) for _ in range(2))
    changed = gene[:30] + ("A" if gene[30] != "A" else "C") + gene[31:]
    assert refind.search(left + changed + right, gene, 0.2, 0.9) == (changed, 80, 140, 0)
    found, a, b, strand = refind.search(left + C._rc(changed) + right, gene, 0.2, 0.9)
    assert (found, a, b, strand) == (changed, 80, 140, 1)
    assert refind.search(left + right, gene, 0.2, 0.98)[0] == ""
    found, a, b, _ = refind.search(gene[25:] + right, gene, 0.2, 0.9)
    assert found == gene[25:] and a == 0 and b == 35


def test_graph(spark):
    e = spark.createDataFrame([(0, 2), (1, 4), (4, 5), (5, 6), (7, 7)], "src long, dst long")
    n = spark.range(8).withColumnRenamed("id", "node").withColumn("ord", F.col("node"))
    got = {r["node"]: r["fragment"] for r in G.component_numbers(e, n, "node", "ord").collect()}
    assert got == {0: 1, 1: 2, 2: 1, 3: 3, 4: 2, 5: 2, 6: 2, 7: 4}
    chain = spark.createDataFrame([(i, i + 1) for i in range(200)], "src long, dst long")
    assert G.connected_components(chain).select("component").distinct().count() == 1
    assert not G.is_connected(e, n, "node", "ord")
    d = {(r["seed"], r["node"]): r["depth"] for r in G.k_hop(e, spark.createDataFrame([(1,)], "node long"), 2).collect()}
    assert d == {(1, 1): 0, (1, 4): 1, (1, 5): 2}


def test_greedy_coverage(spark):
    rows = [("c", 1, 0, 100, 100, 9), ("c", 2, 50, 150, 100, 8), ("c", 3, 120, 200, 80, 7), ("c", 4, 190, 260, 70, 6)]
    hits = spark.createDataFrame(rows, "contig string, node long, s long, e long, m long, size long")
    got = {r["node"]: (r["covered"], r["kept"]) for r in R.greedy_coverage(hits, ["contig"], "node", ["size desc", "node desc"], "s", "e", "m").collect()}
    assert got == {1: (0, True), 2: (50, False), 3: (0, True), 4: (10, True)}


def test_families():
    web = M.Web()
    for n in range(5):
        web.add(n, {n}, 1, [f"c{n}"], {n: {f"c{n}"}})
    for n in range(1, 5):
        web.link(0, n, {n})
    M.merge_families(web, {"c1": {"c2"}, "c2": {"c1"}, "c3": {"c4"}, "c4": {"c3"}})
    assert sorted(sorted(o) for o in web.origin.values()) == [[0], [1, 2], [3, 4]]
    copies = M.Web()
    for n, g in ((1, 0), (2, 0), (3, 1), (4, 1), (5, 0), (6, 0)):
        copies.add(n, {g}, 1, ["p" if n < 5 else f"q{n}"], {g: {"p"}})
    for a, b in ((1, 5), (3, 5), (2, 6), (4, 6)):
        copies.link(a, b, {0})
    M.merge_copies(copies, {"p": [(1, 0), (2, 0), (3, 1), (4, 1)]})
    assert sorted(sorted(o) for o in copies.origin.values()) == [[1, 3], [2, 4], [5], [6]]


def test_alignment():
    rows = A.centre_star(["a", "b", "c"], ["ACGTACGT", "ACGACGT", "ACGTAGT"])
    assert len({len(r) for r in rows}) == 1 and [r.replace("-", "") for r in rows] == ["ACGTACGT", "ACGACGT", "ACGTAGT"]
    assert A.pairwise("AC", "AC") == ("AC", "AC")


def test_sources(spark, tmp_path):
    fa = tmp_path / "x.fa"
    fa.write_text("junk\n>a first one\nACGT\nAC\n\n>b\n\n")
    got = [tuple(r)[1:] for r in src.read_fasta(spark, str(fa)).orderBy("ordinal").collect()]
    assert got == [(0, "a", "a first one", "ACGTAC"), (1, "b", "b", "")]
    assert src.location_parts("complement(join(1..10,20..30))") == (-1, [(19, 30), (0, 10)])
    gb = tmp_path / "x.gbk"
    gb.write_text("LOCUS       R1 30 bp\nFEATURES             Location/Qualifiers\n     gene            1..9\n                     /locus_tag=\"g1\"\n     CDS             join(1..4,6..9)\n                     /locus_tag=\"g1\"\n                     /product=\"long\n                     name\"\nORIGIN\n        1 acgtacgtac gtacgtacgt\n//\n")
    f = src.read_genbank(spark, str(gb)).orderBy("ordinal").collect()
    assert [x["key"] for x in f] == ["gene", "CDS"] and f[0]["seq"] == "ACGTACGTACGTACGTACGT" and f[1]["qualifiers"][1]["values"] == ["long name"]
    rows = src.genbank_to_gff(src.read_genbank(spark, str(gb))).where("type = 'CDS'").orderBy("nth").collect()
    assert [(r["start"], r["stop"], r["phase"]) for r in rows] == [(1, 4, "0"), (6, 9, "2")]
    cl = tmp_path / "x.clstr"
    cl.write_text(">Cluster 0\n0\t10aa, >a_1... *\n1\t9aa, >b_1... at 99%\n>Cluster 1\n0\t5aa, >c... *\n")
    assert [tuple(r) for r in src.read_clusters(spark, str(cl)).orderBy("cluster", "place").collect()] == [(0, 0, "a_1", True), (0, 1, "b_1", False), (1, 0, "c", True)]
    lst = tmp_path / "in.txt"
    lst.write_text("a.gff\nb.gff b.fa\n")
    assert [tuple(r) for r in src.read_input_list(spark, str(lst)).orderBy("ordinal").collect()] == [(0, "a.gff", None), (1, "b.gff", "b.fa")]
    lst.write_text("a.gff\n\nb.gff\n")
    with pytest.raises(Exception, match="not an input"):
        src.read_input_list(spark, str(lst)).collect()


def test_manifest_and_graph_file(spark, tmp_path):
    path = f"file://{tmp_path}/m.json"
    sinks.write_manifest(spark, path, {"aligner": "x", "codons": False})
    with pytest.raises(FileExistsError):
        sinks.write_manifest(spark, path, {"aligner": "x", "codons": False})
    assert sinks.write_manifest(spark, path, {"aligner": "x", "codons": False}, resume=True)["aligner"] == "x"
    with pytest.raises(ValueError):
        sinks.write_manifest(spark, path, {"aligner": "y", "codons": False}, resume=True)
    nodes = spark.createDataFrame([(0, 7, 3, ["a"], 'q"&', 3_000_000_000)], "ord long, node long, size long, members array<string>, name string, big long")
    edges = spark.createDataFrame([(0, 0, 2)], "source long, target long, size long")
    text = "\n".join(r["value"] for r in sinks.gml(nodes, edges).orderBy("k", "n").collect())
    assert text.startswith("graph [") and '_networkx_list_start' in text and "q&#34;&amp;" in text and 'big "3000000000"' in text


def test_streaming_support(spark, tmp_path):
    from strandloom.streaming.support import windowed_support

    rows = spark.createDataFrame([(f"2024-01-01 0{h}:00:00", "n", h) for h in range(6)], "t string, node string, genome int").select(F.to_timestamp("t").alias("t"), "node", "genome")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = windowed_support(stream, "t", "node", "genome", "3 hours").writeStream.outputMode("complete").format("memory").queryName("support").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r["size"] for r in spark.table("support").collect()) == [3, 3]


def gene(r, n):
    stops = {"TAA", "TAG", "TGA"}
    return "ATG" + "".join(r.choice([a + b + c for a in "ACGT" for b in "ACGT" for c in "ACGT" if a + b + c not in stops]) for _ in range(n)) + "TAA"


def test_end_to_end(spark, tmp_path):
    from strandloom.plans import pangenome
    from strandloom.plans.options import Options

    r = random.Random(4)
    pool = [gene(r, 40 + 3 * i) for i in range(6)]
    paths = []
    for g in range(3):
        have = [0, 1, 2, 3, 4] if g < 2 else [0, 1, 2, 3, 5]
        seq, rows, at = "", [], 1
        for i in have:
            rows.append(f"c1\tx\tCDS\t{at}\t{at + len(pool[i]) - 1}\t.\t+\t0\tID=g{g}_{i};gene=name{i};product=p{i}")
            seq += pool[i] + "GATTACA"
            at = len(seq) + 1
        p = tmp_path / f"genome{g}.gff"
        p.write_text("##gff-version 3\n##sequence-region c1 1 9\n" + "\n".join(rows) + "\n##FASTA\n>c1\n" + seq + "\n")
        paths.append(str(p))
    res = pangenome.run(spark, paths, Options(mode="sensitive"))
    assert res.genes.count() == 15
    sizes = {x["name"]: x["size"] for x in res.nodes.collect()}
    assert sizes == {"name0": 3, "name1": 3, "name2": 3, "name3": 3, "name4": 2, "name5": 1}
    assert {x["class"]: x["n_nodes"] for x in res.classes.collect()} == {"core": 4, "soft_core": 0, "shell": 2, "cloud": 0, "total": 6}
    assert sorted(x["size"] for x in res.edges.collect()) == [1, 2, 3, 3, 3]
    row = {x["name"]: x for x in res.matrix.collect()}
    assert row["name4"]["genome0"] == "g0_4" and row["name4"]["genome2"] == ""
    assert {x["seq_id"]: x["seq"] for x in res.reference.collect()}["name5"] == pool[5]


def genome(path, contig, genes, names, comment=""):
    """A GFF3 file of genes one after the other; those without a name are in the sequence but not annotated."""
    seq, rows, at = "", [], 1
    for dna, name in zip(genes, names):
        if name:
            rows.append(f"{contig}\tx\tCDS\t{at}\t{at + len(dna) - 1}\t.\t+\t0\tID={name};gene={name.split('_')[-1]};product=product of {name.split('_')[-1]}")
        seq += dna + "GATTACA"
        at = len(seq) + 1
    path.write_text("##gff-version 3\n" + "\n".join(rows) + "\n##FASTA\n>" + contig + "\n" + seq + "\n")
    return seq, rows


def test_whole_run_refinds_a_gene_and_writes_all(spark, tmp_path):
    """Five genomes as GFF3, a pair and a GenBank file; one annotation misses a gene that its sequence has."""
    from strandloom.plans import pangenome
    from strandloom.plans.options import Options

    r = random.Random(7)
    pool = [gene(r, 40 + 3 * i) for i in range(7)]
    paths = []
    for g in range(3):
        names = [f"g{g}_n{i}" if (g, i) != (2, 3) else None for i in range(7)]
        genome(tmp_path / f"genome{g}.gff", "c1", pool, names)
        paths.append(str(tmp_path / f"genome{g}.gff"))
    seq, rows = genome(tmp_path / "genome3.gff", "c1", pool, [f"g3_n{i}" for i in range(7)])
    (tmp_path / "genome3.gff").write_text("##gff-version 3\n" + "\n".join(rows) + "\n")
    (tmp_path / "genome3.fa").write_text(f">c1\n{seq}\n")
    paths.append(f"{tmp_path}/genome3.gff {tmp_path}/genome3.fa")
    features, at, whole = "", 1, ""
    for i, dna in enumerate(pool):
        features += f"     gene            {at}..{at + len(dna) - 1}\n                     /locus_tag=\"g4_n{i}\"\n                     /gene=\"n{i}\"\n     CDS             {at}..{at + len(dna) - 1}\n                     /locus_tag=\"g4_n{i}\"\n                     /gene=\"n{i}\"\n                     /product=\"product of n{i}\"\n"
        whole += dna + "GATTACA"
        at = len(whole) + 1
    lines = "".join(f"{k + 1:9d} {whole[k:k + 60].lower()}\n" for k in range(0, len(whole), 60))
    (tmp_path / "genome4.gbk").write_text(f"LOCUS       c1 {len(whole)} bp\nFEATURES             Location/Qualifiers\n{features}ORIGIN\n{lines}//\n")
    paths.append(str(tmp_path / "genome4.gbk"))
    (tmp_path / "list.txt").write_text("\n".join(paths) + "\n")
    out = f"file://{tmp_path}/out"
    res = pangenome.run(spark, [str(tmp_path / "list.txt")], Options(mode="moderate", alignment="core", codons=True, remove_by_consensus=True), out)
    found = res.refound.collect()
    assert [(x["genome"], x["dna_sequence"], x["clustering_id"]) for x in found] == [(2, pool[3], "2_refound_0")]
    assert {x["name"]: x["size"] for x in res.nodes.collect()} == {f"n{i}": 5 for i in range(7)}
    read = lambda name: [x["value"] for x in spark.read.text(f"{out}/{name}").collect()]
    table = read("gene_presence_absence_roary.csv")
    assert table[0].split(",")[:4] == ["Gene", "Non-unique Gene name", "Annotation", "No. isolates"] and table[0].split(",")[14:] == [f"genome{g}" for g in range(5)]
    row = next(x for x in table if x.startswith("n3,")).split(",")
    assert row[3] == "5" and row[16] == "2_refound_0" and row[14] == "g0_n3"
    assert len(read("gene_presence_absence.csv")) == 8 and len(read("gene_data.csv")) >= 36
    assert "Core genes\t(99% <= strains <= 100%)\t7" in read("summary_statistics.txt")
    assert sum(x.startswith(">") for x in read("pan_genome_reference.fa")) == 7
    final = "\n".join(read("final_graph.gml"))
    assert final.count("node [") == 7 and final.count("edge [") == 7 and "\n".join(read("pre_filt_graph.gml")).count("node [") == 7
    core = "\n".join(read("core_gene_alignment.aln")).split(">")[1:]
    assert len(core) == 5 and all("".join(x.split("\n")[1:]) == "".join(dna if i == 3 else dna[:-3] for i, dna in enumerate(pool)) for x in core)  # codons of residues; the found gene fails the check and is aligned whole
    assert len(read("core_alignment_header.embl")) >= 7 and len(read("alignment_entropy.csv")) >= 8
    assert {x["class"]: x["n_nodes"] for x in res.classes.collect()}["core"] == 7
    off = pangenome.run(spark, [str(tmp_path / "genome0.gff"), str(tmp_path / "genome2.gff")], Options(mode="sensitive", refind="off"))
    assert {x["name"]: x["size"] for x in off.nodes.collect()}["n3"] == 1


def test_cleaned_edges_stay_out_after_paralogs_merge(spark, tmp_path):
    from strandloom.plans import pangenome
    from strandloom.plans.options import Options

    r = random.Random(9)
    pool = [gene(r, 40 + 3 * i) for i in range(8)]
    paths = []
    for g in range(4):
        order = [0, 1, 2, 3, 4, 5] if g < 3 else [0, 1, 2, 3, 4, 5, 6, 7]  # a tail that one genome has
        genome(tmp_path / f"genome{g}.gff", "c1", [pool[i] for i in order], [f"g{g}_n{i}" for i in order])
        paths.append(str(tmp_path / f"genome{g}.gff"))
    res = pangenome.run(spark, paths, Options(mode="strict", merge_paralogs=True, refind="off"))
    nodes = {x["node"] for x in res.nodes.collect()}
    edges = res.edges.collect()
    assert len(nodes) == 6 and len(edges) == 5 and all(x["u"] in nodes and x["v"] in nodes for x in edges)


def test_floor_of_large_numbers(spark):
    from strandloom.functions import text as X

    rows = [(9007199254740993, 1), (-7, 2), (7, -2), (-8, 2), (5, 0), (None, 2)]
    got = spark.createDataFrame(rows, "a long, b long").select("a", "b", X.floor_div(F.col("a"), F.col("b")).alias("q"), X.floor_mod(F.col("a"), F.col("b")).alias("r")).collect()
    for x in got:
        assert (x["q"], x["r"]) == ((None, None) if not x["b"] or x["a"] is None else divmod(x["a"], x["b"]))


def test_all_genetic_codes():
    import itertools

    for code, diff in codons.DIFFERENCES.items():
        table, own = codons.codon_table(code), dict(x.split("=") for x in diff.split())
        every = ["".join(c) for c in itertools.product("TCAG", repeat=3)]
        assert len(table) == 64 and all(table[c] == own.get(c, codons.STANDARD[i]) for i, c in enumerate(every))
        assert codons.start_codons(code) == codons.STARTS[code].split() and set(codons.start_codons(code)) <= set(every)


def test_distances_of_many_pairs_equal_one_by_one():
    r = random.Random(12)
    for alphabet, wild in (("ACGTN", C.DNA_WILDCARDS), ("ACDEFGHIKLMNPQRSTVWYXBZ", C.PROTEIN_WILDCARDS)):
        pairs = []
        for _ in range(150):
            a = "".join(r.choice(alphabet) for _ in range(r.choice([1, 20, 63, 64, 65, 130, 200])))
            b = list(a) if r.random() < 0.5 else [r.choice(alphabet) for _ in range(r.choice([0, 10, 90, 210]))]
            for _ in range(r.choice([0, 2, 9])):
                b.insert(r.randrange(len(b) + 1), r.choice(alphabet))
            pairs.append((a, "".join(b)))
        got = C.infix_distances([a for a, _ in pairs], [b for _, b in pairs], wild)
        assert got.tolist() == [C.infix_distance(a, b, wild)[0] for a, b in pairs]
        dna = wild == C.DNA_WILDCARDS
        assert C.identities(pairs, dna, 0.7).tolist() == [C.identity(a, b, dna, 0.7) for a, b in pairs]


def test_sessions_and_small_text_functions(spark, tmp_path):
    from strandloom.functions import text as X
    from strandloom.operators import families
    from strandloom.streaming.support import sessions

    times = ["00:00", "00:10", "00:35", "02:00", "02:20"]
    rows = spark.createDataFrame([(f"2024-01-01 {t}:00", g) for t in times for g in (1, 2)], "t string, genome int").select(F.to_timestamp("t").alias("t"), "genome")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    # append gives a session once the watermark has passed it; a batch table gives all
    assert sorted(tuple(r) for r in sessions(rows, "t", "genome").select("genome", "n_genes").collect()) == [(1, 2), (1, 3), (2, 2), (2, 3)]
    q = sessions(stream, "t", "genome", late="1 minute").writeStream.outputMode("append").format("memory").queryName("sessions").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sorted((r["genome"], r["n_genes"]) for r in spark.table("sessions").collect()) in ([], [(1, 3), (2, 3)])
    assert one(spark, S.strip_stop(F.col("s")), s="MK*") == "MK"
    with pytest.raises(Exception, match="premature stop"):
        one(spark, S.strip_stop(F.col("s")), s="M*K")
    assert one(spark, X.name_to_first_dot(F.col("s")), s="/a/b.c.d") == "b" and len(one(spark, X.alignment_name(F.col("s")), s="x" * 300)) == 248
    clusters = spark.createDataFrame([("a", "a", 3), ("b", "a", 1), ("c", "c", 2)], "k string, centroid string, o int")
    assert {r["centroid"]: (r["members"], r["n"]) for r in C.ordered_members(clusters, "k", "o").collect()} == {"a": (["b", "a"], 2), "c": (["c"], 1)}
    nodes = spark.createDataFrame([(1, 2, [1, 2], ["x"], True, False, (9, "x")), (2, 1, [3], ["y", "x"], False, True, (12, "y"))], "node long, size long, members array<long>, centroids array<string>, has_end boolean, paralog boolean, longest struct<length:int,id:string>")
    r = families.merged_attributes(nodes, spark.createDataFrame([(1, 1), (2, 1)], "node long, merged long")).collect()
    assert len(r) == 1 and (r[0]["node"], r[0]["size"], r[0]["members"], r[0]["has_end"], r[0]["paralog"], r[0]["longest"]["id"]) == (1, 3, [1, 2, 3], True, True, "y")


def test_pieces_find_all_similar_pairs(spark):
    """Pairs by pieces against all pairs: edits, both strands, containment, copies, short, wild and empty sequences, blocks."""
    r = random.Random(12)
    text = lambda n: "".join(r.choice("ACGT") for _ in range(n))
    seqs = []
    for n in (23, 30, 60, 150, 400, 900):
        base = text(n)
        for k in range(6):
            s = list(base)
            for _ in range(k * n // 200):
                i = r.randrange(len(s))
                s[i : i + 1] = r.choice(("", "A", "CG"))
            s = "".join(s)
            seqs += [s, C._rc(s) if k % 2 else text(5) + s + text(4)]
        seqs += [base, base[: n // 2] + "N" * (n > 50) + base[n // 2 + 1 :]]
    rows = [(f"s{i:03d}", s, f"b{i % 3}") for i, s in enumerate([*seqs, "", ""])]
    df = spark.createDataFrame(rows, "k string, s string, b string").repartition(5)
    plain = {(k, q): C.identity(s, t, True, 0.98) for k, s, _ in rows for q, t, _ in rows if k < q}
    want = {p for p, i in plain.items() if i >= 0.98}
    block = {k: b for k, _, b in rows}
    for group in ([], ["b"]):
        got = {(x["a"], x["b"]) for x in C.similar_pairs(df, group, "k", "s", 0.98, True, 7).collect()}
        assert got == {p for p in want if not group or block[p[0]] == block[p[1]]} and len(got) > 100 / (1 + 2 * len(group))
    reps, clusters = [], {}
    for k, s, _ in sorted(rows, key=lambda x: (-len(x[1]), x[0])):
        hit = next((q for q, t in reps if plain.get((min(k, q), max(k, q)), 0) >= 0.98), None)
        if hit is None:
            reps.append((k, s))
        clusters[k] = hit or k
    got = {x["k"]: x["centroid"] for x in C.greedy_clusters(df, "k", "s", 0.98, True, 7).collect()}
    assert got == clusters


def test_banded_distances_equal_infix_distances():
    """Edits, both strands, containment, repeats and wildcards at four thresholds."""
    r = random.Random(3)
    for letters in ("ACGT", "AC", "AAAAAAC"):
        text = lambda n: "".join(r.choice(letters) for _ in range(n))  # noqa: B023, E731
        for threshold in C.DNA_THRESHOLDS:
            pairs = []
            for k in range(40):
                n = r.choice((10, 24, 30, 60, 130, 300))
                a = text(n)
                s = list(a)
                for _ in range(int(r.random() * 2 * (1 - threshold) * n + 0.5)):
                    i = r.randrange(len(s))
                    s[i : i + 1] = r.choice(("", "A", "CG", "T"))
                b = text(k % 3 * r.randrange(30)) + "".join(s) + text(k % 3 * r.randrange(30)) + "A"
                b = C._rc(b) if k % 2 else b
                b = b[:5] + "N" + b[6:] if k % 7 == 0 else b
                pairs.append((a, b) if k % 4 else (b, a))
            want = [C.identity(a, b, True, threshold) for a, b in pairs]
            got = C.near_identities(pairs, True, threshold, 7)
            assert [w if w >= threshold else 0 for w in want] == [g if g >= threshold else 0 for g in got.tolist()] and max(want) >= threshold


def test_pairs_of_a_common_passage_are_no_candidates(spark):
    """Each two sequences share a rare passage of their own, which is too little; only the near copy of one is left."""
    r = random.Random(21)
    text = lambda n: "".join(r.choice("ACGT") for _ in range(n))
    shared = {(i, j): text(140) for i in range(12) for j in range(i)}
    seqs = ["".join(shared[max(i, j), min(i, j)] + text(10) for j in range(12) if j != i) for i in range(12)]
    rows = [(f"s{i:02d}", s) for i, s in enumerate([*seqs, seqs[0][:700] + "A" + seqs[0][700:]])]
    near = C.candidates(spark.createDataFrame(rows, "k string, s string"), "k", "s", 7, 0.98, True, 0.98).collect()
    assert [(x["a"], x["b"]) for x in near] == [("s00", "s12")]


def test_short_rows_alone_ask_by_words(spark):
    """Rows without enough pieces meet those that hold them; the others don't meet by the same words."""
    r = random.Random(22)
    text = lambda n: "".join(r.choice("ACGT") for _ in range(n))
    short = text(18)
    rows = [("short", short), *((f"s{i:02d}", text(300) + (short if i % 2 else C._rc(short)) + text(300)) for i in range(20))]
    near = {(x["a"], x["b"]) for x in C.candidates(spark.createDataFrame(rows, "k string, s string"), "k", "s", 7, 0.98, True).collect()}
    assert near == {("short", k) for k, _ in rows[1:]}
