"""The whole run: annotated genomes in, graph and reports out. Every stage is a table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandloom.functions import sequences as S
from strandloom.functions.text import clean_gene_name
from strandloom.operators import alignment as A
from strandloom.operators import families as M
from strandloom.operators import graph as G
from strandloom.operators import positions as P
from strandloom.operators import refind
from strandloom.operators import relations as R
from strandloom.operators import similarity as C
from strandloom.operators import support as U
from strandloom.plans.options import Options
from strandloom.plans.snapshot import snapshot
from strandloom.sources import sequences as src
from strandloom.sources import sinks


@dataclass
class Result:
    """Tables of a run. ``alignments``, ``core``, ``filtered`` and ``entropy`` are None unless an alignment was asked for."""

    genes: DataFrame
    members: DataFrame
    nodes: DataFrame
    edges: DataFrame
    matrix: DataFrame
    classes: DataFrame
    reference: DataFrame
    isolates: list[str]
    pre_filter: tuple[DataFrame, DataFrame]
    refound: DataFrame
    variants: DataFrame
    alignments: DataFrame | None = None
    core: DataFrame | None = None
    filtered: DataFrame | None = None
    header: DataFrame | None = None
    entropy: DataFrame | None = None


def inputs(spark: SparkSession, paths: list[str]) -> list[tuple[str, str | None]]:
    """(annotation, sequence or None) of each genome: files, pairs "annotation sequence", or one list file of either."""
    if len(paths) == 1 and paths[0].endswith(".txt"):
        return [(r["path"], r["fasta"]) for r in src.read_input_list(spark, paths[0]).orderBy("ordinal").collect()]  # a row a genome
    return [(p.split(" ")[0], p.split(" ")[1] if " " in p else None) for p in paths]


def _name(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def annotation_texts(spark: SparkSession, files: list[tuple[str, str | None]]) -> DataFrame:
    """(path, text, genome): GFF3 with sequence of every genome, made from pairs and GenBank files where it isn't there."""
    order = spark.createDataFrame([(i, _name(p), None if f is None else _name(f)) for i, (p, f) in enumerate(files)], "genome long, file string, pair string")
    short = F.regexp_extract("path", r"([^/]*)$", 1)
    out = None
    flat = [p for p, f in files if f is None and not p.endswith((".gb", ".gbk", ".gbff"))]
    pairs = [(p, f) for p, f in files if f is not None]
    banks = [p for p, f in files if f is None and p.endswith((".gb", ".gbk", ".gbff"))]
    if flat:
        out = src.read_whole(spark, flat)
    if pairs:
        seqs = src.read_whole(spark, [f for _, f in pairs]).withColumn("pair", short).drop("path").join(order.where("pair is not null"), "pair").select(F.col("file"), F.col("text").alias("text_f"))
        gff = src.read_whole(spark, [p for p, _ in pairs]).withColumn("file", short)
        both = src.splice_fasta(gff.select("path", "text"), gff.join(seqs, "file").select("path", F.col("text_f").alias("text")))
        out = both if out is None else out.unionByName(both)
    if banks:
        features = snapshot(src.read_genbank(spark, banks), "genbank")
        line = sinks.gff_line(*(F.col(c) for c in ("seqid", "source", "type", "start", "stop", "score", "strand", "phase", "attributes")))
        rows = src.genbank_to_gff(features).select("path", F.struct("ordinal", "nth", line.alias("line")).alias("r"))
        body = rows.groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda r: r["line"]), "\n").alias("body"))
        fasta = features.where("seq is not null").groupBy("path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("record", "seqid", "seq"))), lambda r: F.concat(F.lit(">"), r["seqid"], F.lit("\n"), r["seq"])), "\n").alias("fasta"))
        made = body.join(fasta, "path").select("path", F.concat(F.lit("##gff-version 3\n"), "body", F.lit("\n##FASTA\n"), "fasta", F.lit("\n")).alias("text"))
        out = made if out is None else out.unionByName(made)
    return out.withColumn("file", short).join(order.select("genome", "file"), "file").select("path", "text", "genome")


def read_genes(spark: SparkSession, paths: list[str], options: Options) -> tuple[DataFrame, DataFrame]:
    """(gene table, contigs) of annotated genomes; genomes are numbered in the order given."""
    files = inputs(spark, paths)
    texts = annotation_texts(spark, files)
    parts = src.split_gff(texts.select("path", "text")).join(texts.select("path", "genome"), "path")
    features = src.gff_features(parts, "annotation", ["genome", "path"])
    contigs = snapshot(src.fasta_records(parts, "fasta", ["genome"]), "contigs")
    genes = snapshot(src.genes_of(features, contigs, options.code, options.remove_invalid), "genes")
    order = spark.createDataFrame([(i, _name(p)) for i, (p, _) in enumerate(files)], "genome long, file string")
    empty = order.join(genes.select("genome").distinct(), "genome", "left_anti").select("file").limit(3).collect()
    if empty:
        raise ValueError(f"no valid gene in {[r[0] for r in empty]}")
    return genes, contigs.select("genome", F.col("seq_id").alias("contig"), "seq")


def cluster(genes: DataFrame, options: Options) -> DataFrame:
    """(clustering_id, centroid) of the proteins."""
    return snapshot(C.greedy_clusters(genes.select("clustering_id", "prot_sequence"), "clustering_id", "prot_sequence", options.threshold, False, 2, options.len_dif), "clusters")


def place(genes: DataFrame, clusters: DataFrame) -> DataFrame:
    """Genes with their node: a cluster's number, or a fresh number for each gene of a cluster that a genome has twice."""
    own = genes.join(clusters, "clustering_id")
    number = P.numbered(clusters.select("centroid").distinct(), ["centroid"], 0, "cluster")
    own = snapshot(own.join(number, "centroid"), "placed")
    n = number.count()
    copies = P.paralog_copy_ids(own, "genome", "cluster", ["genome", "contig", "pos"], n, "node").withColumn("paralog", F.lit(True))
    single = own.join(copies.select("clustering_id"), "clustering_id", "left_anti").withColumn("node", F.col("cluster")).withColumn("paralog", F.lit(False))
    return snapshot(P.contig_ends(single.unionByName(copies), ["genome", "contig"], "pos"), "nodes-of-genes")


def node_table(placed: DataFrame) -> DataFrame:
    longest = F.max(F.struct(F.length("dna_sequence").alias("length"), F.col("centroid").alias("id")))
    return placed.groupBy("node").agg(
        F.countDistinct("genome").alias("size"), F.array_sort(F.collect_set("genome")).alias("members"), F.array_sort(F.collect_set("centroid")).alias("centroids"),
        F.collect_set(F.struct("genome", "centroid")).alias("genes"), F.bool_or("has_end").alias("has_end"), F.bool_or("paralog").alias("paralog"), longest.alias("longest"),
    )


def edge_table(placed: DataFrame) -> DataFrame:
    adj = P.adjacency(placed, ["genome", "contig"], "pos", "node")
    return U.edge_members(adj, "prev_node", "node", "genome").where("u <> v")


def relabel(placed: DataFrame, merged: DataFrame) -> DataFrame:
    """Genes with their node after a merge."""
    m = merged.withColumnRenamed("merged", "_m")
    return snapshot(placed.join(m, "node", "left").withColumn("node", F.coalesce("_m", "node")).drop("_m"), "relabelled")


def similar_centroids(placed: DataFrame, dna: bool, threshold: float, len_dif: float = 0.0) -> DataFrame:
    """Similar pairs of centroids, compared inside the clusters of a coarser clustering."""
    col = "dna_sequence" if dna else "prot_sequence"
    rows = placed.where("clustering_id = centroid").select(F.col("centroid").alias("key"), F.col(col).alias("seq"))
    blocks = C.iterative_clusters(rows, "key", "seq", dna, word=7 if dna else 3, len_dif=len_dif).withColumnRenamed("centroid", "block")
    return C.similar_pairs(rows.join(blocks, "key"), ["block"], "key", "seq", threshold, dna, 7 if dna else 3).select("a", "b")


def refind_genes(placed: DataFrame, edge_genomes: DataFrame, contigs: DataFrame, o: Options) -> tuple[DataFrame, DataFrame]:
    """(gene rows found in genomes that lack a node, nodes that go).

    A genome is searched around its genes next to the node, where no known
    gene lies. Hits of larger nodes come first; one that lies half in what
    they cover goes. With ``remove_by_consensus``, a node found more often
    than it was annotated goes altogether. ``strict`` refinding keeps whole
    genes only.
    """
    nodes = placed.groupBy("node").agg(F.countDistinct("genome").alias("size"), F.max(F.struct(F.length("dna_sequence").alias("n"), "dna_sequence", "prot_sequence", "centroid", "cluster")).alias("l"))
    nodes = snapshot(nodes.select("node", "size", F.col("l.dna_sequence").alias("dna"), F.col("l.prot_sequence").alias("protein"), F.col("l.n").alias("longest"), F.col("l.centroid").alias("centroid"), F.col("l.cluster").alias("cluster")), "refind-nodes")
    genes = placed.select(F.col("clustering_id").alias("gene_id"), "node", "genome")
    members = genes.select("node", "genome").distinct()
    searches = snapshot(refind.search_list(edge_genomes.select("u", "v").distinct(), members, genes, nodes), "refind-searches")
    features = placed.select("genome", F.col("clustering_id").alias("gene_id"), F.col("scaffold_name").alias("contig"), "start", F.col("stop").alias("end"))
    known = R.conflict_pairs(searches, "genome", "node", "gene_id").select("genome", "gene_id").distinct().join(features, ["genome", "gene_id"])
    hits = snapshot(refind.find(searches, features, refind.masked_contigs(contigs, known), o.search_radius, o.refind_share, o.threshold), "refind-hits")
    ranked = hits.join(nodes.select("node", "size", "longest"), "node")
    walked = R.greedy_coverage(ranked, ["genome", "contig"], "node", ["size desc", "node desc"], "hit_start", "hit_end", "longest")
    bad_pairs = walked.where("not kept").select("node", "genome").distinct()
    none = nodes.select("node").limit(0)
    found = R.accepted_hits(hits, none, bad_pairs, "node", "genome", "dna")
    bad = snapshot(U.consensus_removal(found, nodes, "node", "size").select("node") if o.remove_by_consensus else none, "refind-bad")
    rows = refind.refound_genes(R.accepted_hits(found, bad, bad_pairs, "node", "genome", "dna"), nodes.select("node", "protein"))
    if o.refind == "strict":
        rows = rows.where((F.length("dna") % 3 == 0) & ~S.internal_stop(F.col("protein")))
    files = placed.select("genome", "gff_file").distinct()
    rows = rows.join(files, "genome").join(nodes.select("node", "centroid", "cluster"), "node")
    blank = F.lit(None)
    made = rows.select(
        "genome", blank.cast("long").alias("contig_no"), "gff_file", F.col("contig").alias("scaffold_name"), F.col("gene_id").alias("clustering_id"), F.col("gene_id").alias("annotation_id"),
        F.regexp_replace("protein", r"\*$", "").alias("prot_sequence"), F.col("dna").alias("dna_sequence"), F.lit("").alias("gene_name"), "description", "node", "centroid", "cluster",
    ).drop("contig_no")
    return snapshot(made, "refound"), bad


def with_refound(placed: DataFrame, refound: DataFrame) -> DataFrame:
    """The gene rows and those found; these have no place on their contig."""
    return snapshot(placed.unionByName(refound, allowMissingColumns=True).withColumn("has_end", F.coalesce("has_end", F.lit(False))).withColumn("paralog", F.coalesce("paralog", F.lit(False))), "with-refound")


def representatives(placed: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, seq_id, dna) of each node: its first centroid, unless a longer one is a valid gene; a centroid that an earlier node has used gives none."""
    own = nodes.select("node", F.posexplode("centroids").alias("nth", "clustering_id")).join(placed.select("clustering_id", "dna_sequence", "prot_sequence").distinct(), "clustering_id")
    rest = F.regexp_replace("prot_sequence", "X", "")
    valid = F.when(rest != "", S.is_valid_gene(F.col("dna_sequence"), F.when(rest != "", F.col("prot_sequence")).otherwise("M"))).otherwise(False)
    fit = own.where(valid | (F.col("nth") == 0)).withColumn("n", F.length("dna_sequence"))
    best = fit.withColumn("_r", F.row_number().over(Window.partitionBy("node").orderBy(F.desc("n"), "nth"))).where("_r = 1")
    first = best.withColumn("_u", F.row_number().over(Window.partitionBy("clustering_id").orderBy("node"))).where("_u = 1")
    return first.select("node", F.col("clustering_id").alias("seq_id"), F.col("dna_sequence").alias("dna"))


def long_matrix(placed: DataFrame, named: DataFrame, edges: DataFrame, matrix: DataFrame, isolates: list[str]) -> DataFrame:
    """The presence matrix behind its fourteen columns, most isolates first."""
    size = F.length("dna_sequence")
    stats = placed.groupBy("node").agg(F.countDistinct("genome").alias("isolates"), F.count("*").alias("sequences"), F.min(size).alias("least"), F.max(size).alias("most"), F.avg(size).alias("mean"), F.array_join(F.array_sort(F.collect_set(F.nullif("description", F.lit("")))), ";").alias("described"))
    where = G.component_numbers(edges.select(F.col("u").alias("src"), F.col("v").alias("dst")), named.select("node"), "node", "node").select("node", "fragment", "place")
    j = named.select("node", "name", "annotation").join(stats, "node").join(where, "node")
    blank = F.lit("")
    values = (F.col("name"), F.col("annotation"), F.col("described"), F.col("isolates"), F.col("sequences"), F.col("sequences") / F.col("isolates"), F.col("fragment"), F.col("place"), blank, blank, blank, F.col("least"), F.col("most"), F.col("mean"))
    lead = j.select(*(v.alias(c.replace(".", "_")) for v, c in zip(values, sinks.MATRIX_COLUMNS, strict=True)), "isolates")
    wide = lead.join(matrix.withColumnRenamed("name", "Gene"), "Gene").orderBy(F.desc("isolates"), "Gene")
    return wide.select(*(F.col(c.replace(".", "_")).alias(c) for c in sinks.MATRIX_COLUMNS), *(F.col("`" + i + "`") for i in isolates))


def short_matrix(placed: DataFrame, named: DataFrame, isolates: list[str]) -> DataFrame:
    """Names and ids only; an id has ``_len`` if its protein's length is an outlier and ``_pseudo`` if it has a stop inside."""
    size = F.length("dna_sequence")
    mode = placed.groupBy("node").agg(F.mode(size, True).alias("mode"))
    p = placed.join(mode, "node").withColumn("flagged", F.concat("annotation_id", F.when(U.length_outlier(F.length("prot_sequence"), F.col("mode")), "_len").otherwise(""), F.when(S.internal_stop(F.col("prot_sequence")), "_pseudo").otherwise("")))
    wide = U.presence_matrix(p.join(named.select("node", "name"), "node"), "name", "gff_file", "flagged", isolates)
    lead = named.select("name", "annotation").join(placed.join(named.select("node", "name"), "node").groupBy("name").agg(F.array_join(F.array_sort(F.collect_set(F.nullif("description", F.lit("")))), ";").alias("described")), "name")
    return lead.join(wide, "name").orderBy("name").select(F.col("name").alias("Gene"), F.col("annotation").alias("Non-unique Gene name"), F.col("described").alias("Annotation"), *(F.col("`" + i + "`") for i in isolates))


def variant_matrix(edge_genomes: DataFrame, named: DataFrame, files: DataFrame, isolates: list[str], least: int) -> DataFrame:
    """A row for each pair of edges at a node that at least ``least`` genomes take together, 1 where a genome does."""
    two = edge_genomes.select(F.col("u").alias("node"), F.col("v").alias("other"), "genome").union(edge_genomes.select("v", "u", "genome")).distinct()
    pairs = R.edge_pairs(two, least).select("node", "a", "b")
    have = pairs.join(two.toDF("node", "a", "genome"), ["node", "a"]).join(two.toDF("node", "b", "genome"), ["node", "b", "genome"]).join(files, "genome")
    label = lambda k: named.select(F.col("node").alias(k), F.col("name").alias(f"{k}_name"))
    rows = have.join(label("node"), "node").join(label("a"), "a").join(label("b"), "b").withColumn("name", F.concat_ws("-", "a_name", "node_name", "b_name"))
    return U.presence_calls(U.presence_matrix(rows, "name", "gff_file", "gff_file", isolates), "name").withColumnRenamed("name", "Gene")


def aligned_genes(placed: DataFrame, named: DataFrame, o: Options, genomes: int) -> DataFrame:
    """(gene, seq_id, genome, seq): alignments of the core genes, or of all with two sequences or more.

    With codons, proteins are aligned and turned back into codons; genes with
    a sequence that fails a codon check are aligned as they are.
    """
    total = placed.sparkSession.createDataFrame([(genomes,)], "n long")
    nodes = named.select("node", "name", "size")
    if o.alignment == "core":
        nodes = U.core_nodes(nodes, "size", total, o.core_threshold)
        if o.core_subset:
            nodes = U.core_subset(nodes, ["node"], o.core_subset)
    rows = snapshot(placed.join(nodes.select("node", F.col("name").alias("gene")), "node").select("gene", F.col("clustering_id").alias("seq_id"), "genome", F.col("dna_sequence").alias("dna"), F.col("prot_sequence").alias("protein")), "to-align")
    many = rows.groupBy("gene").agg(F.count("*").alias("k")).where("k > 1").select("gene")
    plain, coded = rows.join(many, "gene", "left_semi"), None
    if o.codons:
        checked = plain.withColumn("fails", F.size(S.codon_failures(F.col("dna"), F.col("protein"), o.code)) > 0)
        failed = snapshot(checked.where("fails").select("gene").distinct(), "codon-fails")
        good = plain.join(failed, "gene", "left_anti")
        proteins = A.align_genes(good.select("gene", "seq_id", F.col("protein").alias("p")), "gene", "seq_id", "p")
        coded = A.codon_alignment(proteins, good.select("gene", "seq_id", F.col("dna").alias("seq")), "gene", "seq_id", "p", "seq")
        plain = plain.join(failed, "gene", "left_semi")
    out = A.align_genes(plain.select("gene", "seq_id", F.col("dna").alias("seq")), "gene", "seq_id", "seq")
    out = out if coded is None else out.unionByName(coded)
    out = out.unionByName(rows.join(many, "gene", "left_anti").select("gene", "seq_id", F.col("dna").alias("seq")))
    return snapshot(out.join(rows.select("seq_id", "genome"), "seq_id").select("gene", "seq_id", "genome", "seq"), "alignments")


def core_alignment(aligned: DataFrame, files: DataFrame) -> DataFrame:
    """(gff_file, seq): the least gapped sequence of each gene and genome, genes in order of name, gaps where one lacks."""
    best = A.least_gapped(aligned, "gene", "genome", "seq", "seq_id")
    genes = best.groupBy("gene").agg(F.max(F.length("seq")).alias("length"))
    return A.concatenated(R.gap_filled(files.select("genome"), genes, best, "genome", "gene", "seq", "length"), "genome", "seq", "gene").join(files, "genome").select("gff_file", "seq")


def run(spark: SparkSession, paths: list[str], options: Options = Options(), out: str | None = None) -> Result:
    """Genes, clusters, graph, merges, refinding, cleaning, reports and alignments of annotated genomes; files too where ``out`` names a folder."""
    count = len(inputs(spark, paths))
    o = options.for_genomes(count)
    genes, contigs = read_genes(spark, paths, o)
    placed = place(genes, cluster(genes, o))
    placed = relabel(placed, snapshot(M.collapse_paralogs(node_table(placed), edge_table(placed)), "m1"))
    pre_filter = (snapshot(node_table(placed), "pre-nodes"), snapshot(edge_table(placed).groupBy("u", "v").agg(F.count("*").alias("size")), "pre-edges"))
    near = None
    for dna, threshold, len_dif in ((True, 0.98, 0.0), (False, o.family_threshold, o.family_len_dif)):
        near = snapshot(similar_centroids(placed, dna, threshold, len_dif), "near")
        placed = relabel(placed, snapshot(M.collapse_families(node_table(placed), edge_table(placed), near, share=o.length_outlier_share), "m2"))
    nodes, eg = snapshot(node_table(placed), "n"), snapshot(edge_table(placed), "e")
    kept, _ = G.trim_tips(nodes.select("node", "size"), eg.select("u", "v").distinct(), "node", "size", o.min_trailing_support, min(o.trailing_recursive, 1000), "u", "v")
    kept = snapshot(kept.select("node"), "kept")
    placed, eg = snapshot(placed.join(kept, "node", "left_semi"), "kept-genes"), snapshot(G.subgraph(eg, kept, "node", "u", "v"), "kept-edges")
    refound = None
    if o.refind != "off":
        refound, bad = refind_genes(placed, eg, contigs, o)
        placed = with_refound(placed.join(bad, "node", "left_anti"), refound)
        if not bad.isEmpty():
            eg = snapshot(G.delete_nodes(eg, bad), "refind-edges")
        changed = {r["genome"] for r in refound.select("genome").distinct().collect()}  # numbers of genomes
        if changed:
            merged = snapshot(M.collapse_families(node_table(placed), eg, near, share=o.length_outlier_share, only=changed), "m4")
            placed, eg = relabel(placed, merged), snapshot(G.merge_nodes(eg, merged, "node", "merged"), "refind-merged")
    nodes = node_table(placed)
    sized = eg.groupBy("u", "v").agg(F.count("*").alias("size"))
    if o.clean_edges:
        sized = G.clean_edges(sized, nodes.withColumnRenamed("size", "node_size"), "node", "node_size", "has_end", o.edge_support_threshold)
        eg = snapshot(eg.join(sized.select("u", "v"), ["u", "v"], "left_semi"), "clean-edges")  # what is cleaned stays out
    if o.merge_paralogs:
        merged = snapshot(M.merge_paralogs(nodes.select("node", "centroids", "paralog")), "m3")
        placed, eg = relabel(placed, merged), snapshot(G.merge_nodes(eg, merged, "node", "merged"), "paralog-edges")
        nodes = node_table(placed)
    edges = snapshot(eg.groupBy("u", "v").agg(F.count("*").alias("size"), F.array_sort(F.collect_set("genome")).alias("members")), "edges")
    nodes, placed = snapshot(nodes, "nodes"), snapshot(placed, "members")
    names = placed.groupBy("node").agg(F.array_join(F.array_sort(F.collect_set(F.nullif("gene_name", F.lit("")))), ";").alias("annotation"))
    named = snapshot(P.unique_names(nodes.join(names, "node").withColumn("clean", clean_gene_name(F.col("annotation"))), "clean", ["node"], "name"), "named")
    files = placed.select("genome", "gff_file").distinct()
    isolates = [r["gff_file"] for r in files.orderBy("genome").collect()]  # the matrix's columns
    matrix = U.presence_matrix(placed.join(named.select("node", "name"), "node"), "name", "gff_file", "annotation_id", isolates)
    total = spark.createDataFrame([(count,)], "n long")
    reference = representatives(placed, nodes).join(named.select("node", "name"), "node").select(F.col("name").alias("seq_id"), F.col("dna").alias("seq"))
    variants = variant_matrix(eg, named, files, isolates, o.min_edge_support_sv)
    result = Result(genes, placed, named, edges, matrix, U.class_counts(nodes, "size", total), reference, isolates, pre_filter, refound if refound is not None else placed.limit(0), variants)
    if o.alignment:
        result.alignments = aligned_genes(placed, named, o, count)
        entropy = A.weighted_entropy(A.column_counts(result.alignments, "gene", "seq"), "gene")
        result.entropy = snapshot(entropy, "entropy")
        limit = F.lit(o.entropy_filter) if o.entropy_filter is not None else F.col("threshold")
        low = result.entropy.join(F.broadcast(A.entropy_threshold(result.entropy)), F.lit(True)).where(F.coalesce(F.col("entropy"), F.lit(0.0)) <= limit).select("gene")
        result.core = core_alignment(result.alignments, files)
        result.filtered = core_alignment(result.alignments.join(low, "gene", "left_semi"), files)
        result.header = A.feature_header(result.alignments.groupBy("gene").agg(F.max(F.length("seq")).alias("length")), "gene", "gene", "length")
    if out:
        write(result, out)
    return result


#: Lines of the summary.
SUMMARY = (
    ("core", "Core genes", "(99% <= strains <= 100%)"), ("soft_core", "Soft core genes", "(95% <= strains < 99%)"), ("shell", "Shell genes", "(15% <= strains < 95%)"),
    ("cloud", "Cloud genes", "(0% <= strains < 15%)"), ("total", "Total genes", "(0% <= strains <= 100%)"),
)


def _graph(nodes: DataFrame, edges: DataFrame, path: str, label: str) -> None:
    simple = [f.name for f in nodes.schema.fields if f.dataType.simpleString() in ("string", "int", "bigint", "boolean", "double", "array<string>", "array<bigint>")]
    order = P.numbered(nodes.select(*simple), ["node"], 0, "ord")
    order = snapshot(order, "graph-nodes")
    at = order.select("node", "ord")
    e = edges.join(at.toDF("u", "source"), "u").join(at.toDF("v", "target"), "v").drop("u", "v")
    sinks.write_gml(order, e, path, node=label)


def write(result: Result, out: str) -> None:
    """Every file of a run, each a folder of parts in order."""
    spark = result.genes.sparkSession
    genes = result.genes.select(*sinks.GENE_COLUMNS)
    if result.refound.columns and not result.refound.isEmpty():
        genes = genes.unionByName(result.refound.select(*sinks.GENE_COLUMNS))
    sinks.write_csv(genes, f"{out}/gene_data.csv")
    sinks.write_fasta(genes, f"{out}/combined_DNA_CDS.fasta", "clustering_id", "dna_sequence")
    sinks.write_fasta(genes, f"{out}/combined_protein_CDS.fasta", "clustering_id", "prot_sequence")
    sinks.write_csv(long_matrix(result.members, result.nodes, result.edges, result.matrix, result.isolates).coalesce(1), f"{out}/gene_presence_absence_roary.csv")
    sinks.write_csv(short_matrix(result.members, result.nodes, result.isolates).coalesce(1), f"{out}/gene_presence_absence.csv")
    sinks.write_csv(U.presence_calls(result.matrix, "name").withColumnRenamed("name", "Gene").orderBy("Gene"), f"{out}/gene_presence_absence.Rtab", "\t")
    sinks.write_csv(result.variants.orderBy("Gene"), f"{out}/struct_presence_absence.Rtab", "\t")
    lines = spark.createDataFrame([(i, *x) for i, x in enumerate(SUMMARY)], "i int, class string, label string, bounds string").join(result.classes, "class")
    lines.select("i", F.concat_ws("\t", "label", "bounds", F.col("n_nodes").cast("string")).alias("value")).coalesce(1).sortWithinPartitions("i").select("value").write.mode("overwrite").text(f"{out}/summary_statistics.txt")
    sinks.write_fasta(result.reference, f"{out}/pan_genome_reference.fa", "seq_id", "seq")
    _graph(result.pre_filter[0], result.pre_filter[1], f"{out}/pre_filt_graph.gml", "node")
    _graph(result.nodes, result.edges, f"{out}/final_graph.gml", "name")
    if result.alignments is not None:
        sinks.write_fasta(result.alignments, f"{out}/aligned_gene_sequences", "seq_id", "seq", partition_by="gene")
        sinks.write_fasta(result.core, f"{out}/core_gene_alignment.aln", "gff_file", "seq")
        sinks.write_fasta(result.filtered, f"{out}/core_gene_alignment_filtered.aln", "gff_file", "seq")
        result.header.orderBy("start").select(F.col("line").alias("value")).write.mode("overwrite").text(f"{out}/core_alignment_header.embl")
        sinks.write_csv(result.entropy.orderBy("gene"), f"{out}/alignment_entropy.csv")
