"""Scans of annotated genomes: GFF3 with FASTA, FASTA, GenBank, cluster files."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandloom.functions.text import attributes, stem
from strandloom.operators.positions import unique_ids


def read_input_list(spark: SparkSession, path: str) -> DataFrame:
    """(ordinal, path, fasta) of a list file: a GFF3 or GenBank file a line, or a GFF3 and a FASTA file; any other line is an error."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split(F.regexp_replace("value", r"\r?\n$", ""), r"\r?\n")).alias("ordinal", "line"))
    t = F.split(F.trim("line"), r"\s+")
    one = (F.size(t) == 1) & t[0].rlike(r"\.(gff3?|gbk?|gbff)$")
    two = F.size(t) == 2
    ok = F.when(one | two, t).otherwise(F.raise_error(F.concat(F.lit("not an input: "), "line")).cast("array<string>"))
    return lines.select("ordinal", ok.alias("t")).select("ordinal", F.col("t")[0].alias("path"), F.get("t", F.lit(1)).alias("fasta"))


def read_whole(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, text) of each file: a genome is the unit of parsing."""
    return spark.read.text(paths, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def fasta_records(texts: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep`` and (ordinal, seq_id, description, seq) of each record; what stands before the first ``>`` is ignored."""
    body = F.regexp_replace(F.concat(F.lit("\n"), text), "\r", "")
    parts = F.slice(F.split(body, "\n>"), F.lit(2), F.greatest(F.size(F.split(body, "\n>")) - 1, F.lit(0)))
    rec = texts.select(*keep, F.posexplode(parts).alias("ordinal", "_r"))
    head = F.regexp_extract("_r", r"^([^\n]*)", 1)
    seq = F.regexp_replace(F.regexp_replace("_r", r"^[^\n]*", ""), r"\s", "")
    return rec.select(*keep, "ordinal", F.regexp_extract(head, r"^(\S*)", 1).alias("seq_id"), head.alias("description"), seq.alias("seq"))


def read_fasta(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return fasta_records(read_whole(spark, paths), "text", ["path"])


def split_gff(texts: DataFrame) -> DataFrame:
    """(path, annotation, fasta): commas go, exactly one ##FASTA line is required, sequence-region lines are dropped."""
    clean = F.regexp_replace(F.replace("text", F.lit(","), F.lit("")), "\r", "")
    parts = F.split(clean, "##FASTA\n")
    ok = F.when(F.size(parts) == 2, parts).otherwise(F.raise_error(F.concat(F.lit("not GFF3 with one ##FASTA: "), "path")).cast("array<string>"))
    return texts.select("path", ok.alias("p")).select("path", F.regexp_replace(F.col("p")[0], r"(?m)^.*##sequence-region.*\n?", "").alias("annotation"), F.col("p")[1].alias("fasta"))


def splice_fasta(gff: DataFrame, fasta: DataFrame) -> DataFrame:
    """(path, text) of GFF3 and FASTA pairs, with the accn| prefix taken off where records have it."""
    seq = F.when(F.col("text_f").contains("\naccn"), F.replace("text_f", F.lit("accn|"), F.lit(""))).otherwise(F.col("text_f"))
    return gff.join(fasta.select("path", F.col("text").alias("text_f")), "path").select("path", F.concat(F.regexp_replace("text", r"(?s)##FASTA.*", ""), F.lit("\n##FASTA\n"), seq).alias("text"))


def gff_features(annotations: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """Features in file order with their parsed attributes and an id unique in the file.

    Blank and # lines are passed over; fewer than nine columns is an error;
    columns one to eight are taken as they are. A feature without ID is named
    by its type and number among those of its type that have none.
    """
    lines = annotations.select(*keep, F.posexplode(F.split(text, "\n")).alias("ordinal", "line"))
    lines = lines.where((F.trim("line") != "") & ~F.col("line").startswith("#"))
    c = F.split("line", "\t", 9)
    c = F.when(F.size(c) == 9, c).otherwise(F.raise_error(F.concat(F.lit("fewer than nine columns: "), "line")).cast("array<string>"))
    at = lambda i: F.col("c")[i]
    f = lines.select(*keep, "ordinal", c.alias("c")).select(
        *keep, "ordinal", at(0).alias("seqid"), at(1).alias("source"), at(2).alias("type"), F.trim(at(3)).cast("long").alias("start"), F.trim(at(4)).cast("long").alias("stop"),
        at(5).alias("score"), at(6).alias("strand"), at(7).alias("phase"), attributes(at(8)).alias("attributes"),
    )
    own = F.try_element_at(F.filter("attributes", lambda x: x["key"] == "ID"), F.lit(1))["values"]
    nth = F.sum(F.when(own.isNull() | (F.size(own) == 0), 1).otherwise(0)).over(Window.partitionBy(*keep, "type").orderBy("ordinal"))
    f = f.withColumn("base_id", F.when(own.isNotNull() & (F.size(own) > 0), own[0]).otherwise(F.concat_ws("_", "type", nth.cast("string"))))
    return unique_ids(f, keep, "base_id", ["ordinal"], "feature_id").drop("base_id")


_LOCATION = re.compile(r"(\d+)(?:\.\.(\d+))?")


def location_parts(text: str) -> tuple[int, list[tuple[int, int]]]:
    """(strand, [(start, end)]) of a GenBank location, 0-based half-open; parts of a complement in reverse."""
    text = text.replace("<", "").replace(">", "").replace(" ", "")
    strand = 1
    while text.startswith("complement("):
        strand, text = -strand, text[len("complement(") : -1]
    parts = []
    inner = re.sub(r"^(join|order)\((.*)\)$", r"\2", text)
    for piece in re.findall(r"complement\([^()]*\)|[^,()]+", inner):
        m = _LOCATION.search(piece)
        if m:
            if piece.startswith("complement("):
                strand = -1
            parts.append((int(m[1]) - 1, int(m[2] or m[1])))
    return strand, parts[::-1] if strand < 0 else parts


def parse_genbank(text: str) -> Iterator[dict]:
    """Records with name, sequence and features (key, strand, parts, qualifiers as key and values in order)."""
    record, section, feature = None, None, None
    seq: list[str] = []
    for line in text.splitlines():
        if line.startswith("LOCUS"):
            record, seq, section = {"name": line.split()[1], "features": []}, [], None
        elif record is None:
            continue
        elif line.startswith("VERSION") and len(line.split()) > 1:
            record["name"] = line.split()[1]
        elif line.startswith("FEATURES"):
            section = "features"
        elif line.startswith("ORIGIN"):
            section = "origin"
        elif line.startswith("//"):
            for f in record["features"]:
                f["strand"], f["parts"] = location_parts(f.pop("location"))
            yield record | {"seq": "".join(seq).upper()}
            record = None
        elif section == "origin":
            seq.append(re.sub(r"[^A-Za-z]", "", line))
        elif section == "features" and len(line) > 5 and line[5] != " " and line.startswith("     "):
            key, _, place = line.strip().partition(" ")
            feature = {"key": key, "location": place.strip(), "qualifiers": []}
            record["features"].append(feature)
        elif section == "features" and feature is not None and line.startswith(" " * 21):
            body = line[21:].strip()
            q = feature["qualifiers"]
            if body.startswith("/"):
                k, _, v = body[1:].partition("=")
                q.append([k, v])
            elif q:
                q[-1][1] += " " + body
            else:
                feature["location"] += body
        elif line and not line.startswith(" "):
            section = None


_GENBANK = "path string, record int, seqid string, seq string, ordinal int, key string, strand int, parts array<struct<start:long,end:long>>, qualifiers array<struct<key:string,values:array<string>>>"


def read_genbank(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """A row per feature, with its record's sequence on the record's first feature only."""

    def run(batches):
        import pandas as pd

        for pdf in batches:
            rows = []
            for path, text in zip(pdf["path"], pdf["text"], strict=True):
                for r, rec in enumerate(parse_genbank(text)):
                    for i, f in enumerate(rec["features"]):
                        q: dict[str, list[str]] = {}
                        for k, v in f["qualifiers"]:
                            q.setdefault(k, []).append(v[1:-1] if len(v) > 1 and v[0] == v[-1] == '"' else v)
                        rows.append((path, r, rec["name"], rec["seq"] if i == 0 else None, i, f["key"], f["strand"], [{"start": a, "end": b} for a, b in f["parts"]], [{"key": k, "values": v} for k, v in q.items()]))
            yield pd.DataFrame(rows, columns=[c.split(" ")[0] for c in re.split(r", (?=\w+ )", _GENBANK)])

    return read_whole(spark, paths).mapInPandas(run, _GENBANK)


def genbank_to_gff(features: DataFrame) -> DataFrame:
    """GFF3 rows of genes and what they hold: a synthetic mRNA, its exons and CDS parts with their phase, and RNAs.

    A part's phase is 3 less the last part's remaining bases modulo 3, taken
    along the coding direction.
    """
    q = lambda k: F.try_element_at(F.filter("qualifiers", lambda x: x["key"] == k), F.lit(1))["values"][0]
    f = features.where(F.col("key").isin("gene", "CDS", "tRNA", "rRNA")).withColumn("locus", F.coalesce(q("locus_tag"), q("gene"), F.concat_ws("_", "key", F.col("ordinal").cast("string"))))
    part = f.select("path", "seqid", "ordinal", "key", "strand", "locus", q("product").alias("product"), q("gene").alias("gene"), F.posexplode("parts").alias("nth", "p"))
    length = F.col("p.end") - F.col("p.start")
    before = F.coalesce(F.sum(length).over(Window.partitionBy("path", "seqid", "ordinal").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    part = part.withColumn("phase", F.when(F.col("key") == "CDS", F.pmod(3 - F.pmod(before, F.lit(3)), F.lit(3)).cast("string")).otherwise("."))
    sign = F.when(F.col("strand") < 0, "-").otherwise("+")

    def rows(type_, id_, parent, source, phase=F.lit(".")):
        attr = F.concat(F.lit("ID="), id_, F.when(parent.isNotNull(), F.concat(F.lit(";Parent="), parent)).otherwise(""), F.when(F.col("gene").isNotNull(), F.concat(F.lit(";gene="), F.col("gene"))).otherwise(""), F.when(F.col("product").isNotNull(), F.concat(F.lit(";product="), F.col("product"))).otherwise(""))
        return source.select("path", "ordinal", "nth", F.col("seqid"), F.lit("GenBank").alias("source"), type_.alias("type"), (F.col("p.start") + 1).alias("start"), F.col("p.end").alias("stop"), F.lit(".").alias("score"), sign.alias("strand"), phase.alias("phase"), attr.alias("attributes"))

    span = part.groupBy("path", "seqid", "ordinal", "key", "strand", "locus", "product", "gene").agg(F.lit(-1).alias("nth"), F.struct(F.min("p.start").alias("start"), F.max("p.end").alias("end")).alias("p"))
    none = F.lit(None).cast("string")
    mrna = F.concat(F.col("locus"), F.lit(".mRNA"))
    cds, cds_span = part.where("key = 'CDS'"), span.where("key = 'CDS'")
    out = rows(F.lit("gene"), F.col("locus"), none, span.where("key = 'gene'"))
    out = out.union(rows(F.lit("mRNA"), mrna, F.col("locus"), cds_span))
    out = out.union(rows(F.lit("CDS"), F.concat(F.col("locus"), F.lit(".CDS")), mrna, cds, F.col("phase")))
    out = out.union(rows(F.lit("exon"), F.concat(F.col("locus"), F.lit(".exon"), (F.col("nth") + 1).cast("string")), mrna, cds))
    out = out.union(rows(F.lit("polypeptide"), F.concat(F.col("locus"), F.lit(".polypeptide")), mrna, cds_span))
    return out.union(rows(F.col("key"), F.concat(F.col("locus"), F.lit("."), F.col("key")), F.col("locus"), span.where("key in ('tRNA', 'rRNA')")))


def read_clusters(spark: SparkSession, path: str) -> DataFrame:
    """(cluster, place, seq_id, is_centroid) of a cluster file: its members in order, ``*`` marks the centroid."""
    text = spark.read.text(path, wholetext=True)
    blocks = text.select(F.posexplode(F.split(F.concat(F.lit("\n"), "value"), "\n>Cluster ")).alias("_k", "b")).where("_k > 0")
    rows = blocks.select((F.col("_k") - 1).cast("long").alias("cluster"), F.posexplode(F.filter(F.split("b", "\n"), lambda x: x.contains(">"))).alias("place", "line"))
    return rows.select("cluster", "place", F.regexp_extract("line", r">(.*?)\.\.\.", 1).alias("seq_id"), F.trim("line").endswith("*").alias("is_centroid"))


def genes_of(annotations: DataFrame, contigs: DataFrame, code: int = 11, drop_invalid: bool = False) -> DataFrame:
    """The gene table: coding features cut from their contigs, checked, numbered and translated.

    ``annotations``: genome long, path, and the columns of ``gff_features``.
    ``contigs``: genome, seq_id, seq. Invalid genes (see ``invalid_reason``)
    are dropped, or an error, by flag; a feature whose contig is missing is
    treated so too.
    """
    from strandloom.functions.sequences import invalid_reason, reverse_complement, translate_codons
    from strandloom.functions.text import attribute
    from strandloom.operators.positions import contig_rank, gene_index

    cds = annotations.where(F.col("type").contains("CDS"))
    j = cds.join(contigs.select("genome", F.col("seq_id").alias("seqid"), "seq"), ["genome", "seqid"], "left")
    cut = F.substring("seq", F.greatest(F.col("start"), F.lit(1)).cast("int"), F.greatest(F.col("stop") - F.greatest(F.col("start"), F.lit(1)) + 1, F.lit(0)).cast("int"))
    j = j.withColumn("dna", F.when(F.col("strand") == "-", reverse_complement(cut)).otherwise(cut)).drop("seq")
    whole = F.substring("dna", F.lit(1), F.length("dna") - F.length("dna") % 3)
    j = j.withColumn("_p", translate_codons(whole, code))
    reason = F.when(F.col("dna").isNull(), "contig").otherwise(F.coalesce(invalid_reason(F.col("dna"), F.when(F.col("phase") == "0", "0").otherwise(F.col("phase")), F.col("_p")), F.lit("")))
    j = j.withColumn("_why", reason)
    if drop_invalid:
        j = j.where("_why = ''")
    else:
        j = j.withColumn("_p", F.when(F.col("_why") == "", F.col("_p")).otherwise(F.raise_error(F.concat(F.lit("invalid gene "), "feature_id", F.lit(": "), "_why"))))
    ranks = contig_rank(j, "genome", "seqid", "ordinal", "contig_no")
    j = gene_index(j.join(ranks, ["genome", "seqid"]), ["genome", "seqid"], ["start", "ordinal"], "gene_no")
    name = F.coalesce(F.nullif(F.array_join(attribute(F.col("attributes"), "gene"), ";"), F.lit("")), F.array_join(attribute(F.col("attributes"), "name"), ";"), F.lit(""))
    clean = lambda c: F.replace(F.coalesce(c, F.lit("")), F.lit(","), F.lit(""))
    return j.select(
        "genome", F.col("contig_no").alias("contig"), F.col("gene_no").alias("pos"), stem(F.col("path")).alias("gff_file"), F.col("seqid").alias("scaffold_name"),
        F.concat_ws("_", F.col("genome").cast("string"), F.col("contig_no").cast("string"), F.col("gene_no").cast("string")).alias("clustering_id"),
        F.col("feature_id").alias("annotation_id"), F.regexp_replace("_p", r"\*$", "").alias("prot_sequence"), F.col("dna").alias("dna_sequence"),
        clean(name).alias("gene_name"), clean(F.array_join(attribute(F.col("attributes"), "product"), ";")).alias("description"), "start", "stop",
    )
