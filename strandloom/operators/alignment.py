"""Alignments as tables of (gene, id, aligned sequence)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.functions import kernels

#: Counts that a task holds at a time (4 bytes each).
COUNT_CELLS = 1 << 23


def checked(aligned: DataFrame, gene: str, seq: str) -> DataFrame:
    """The rows, with an error where sequences of a gene differ in length."""
    bad = aligned.groupBy(gene).agg(F.countDistinct(F.length(seq)).alias("_n")).where("_n > 1")
    flag = bad.agg(F.count("*").alias("_bad")).select(F.when(F.col("_bad") > 0, F.raise_error(F.lit("sequences of unequal length")).cast("boolean")).otherwise(F.lit(True)).alias("_ok"))
    return aligned.join(F.broadcast(flag), F.col("_ok")).drop("_ok")


def column_counts(aligned: DataFrame, gene: str, seq: str) -> DataFrame:
    """Per gene and place (from 0), how many sequences have a, c, g, t (either case) or another letter.

    A task counts in arrays, at most ``COUNT_CELLS`` numbers at a time, so a
    place is a row of the shuffle once for each task, not for each letter.
    """
    names = ["n_a", "n_c", "n_g", "n_t", "n_other"]
    kind = aligned.schema[gene].dataType.simpleString()

    def count(batches):
        code = np.full(256, 4, np.uint8)
        for i, c in enumerate("acgt"):
            code[ord(c)] = code[ord(c.upper())] = i
        held: dict[object, np.ndarray] = {}

        def rows():
            for g, cells in held.items():
                place = np.flatnonzero(cells.any(0))
                yield pa.RecordBatch.from_arrays([pa.array([g] * len(place), gene_type), pa.array(place.astype(np.int32)), *(pa.array(cells[k, place].astype(np.int64)) for k in range(5))], ["gene", "pos", *names])
            held.clear()

        gene_type, size = None, 0
        for b in batches:
            gene_type = b.column(0).type
            data, off = kernels._bytes(b.column(1))
            for g, lo, hi in zip(b.column(0).to_pylist(), off[:-1].tolist(), off[1:].tolist(), strict=True):
                have = held.get(g)
                if have is None or have.shape[1] < hi - lo:
                    if have is not None:
                        size -= have.size
                    held[g] = np.zeros((5, hi - lo), np.int32)
                    size += held[g].size
                    if have is not None:
                        held[g][:, : have.shape[1]] = have
                letters = code[data[lo:hi]]
                for k in range(5):
                    held[g][k, : hi - lo] += letters == k
                if size > COUNT_CELLS:
                    yield from rows()
                    size = 0
        if held:
            yield from rows()

    schema = f"gene {kind}, pos int, " + ", ".join(f"{n} long" for n in names)
    made = aligned.select(F.col(gene).alias("gene"), F.col(seq).cast("string").alias("seq")).where("seq is not null").mapInArrow(count, schema)
    return made.groupBy(F.col("gene").alias(gene), "pos").agg(*(F.sum(n).alias(n) for n in names))


def weighted_entropy(counts: DataFrame, gene: str) -> DataFrame:
    """Mean Shannon entropy (natural log) of a gene's columns, each weighted by its share of bases; null where all letters are other."""
    total = F.col("n_a") + F.col("n_c") + F.col("n_g") + F.col("n_t") + F.col("n_other")
    term = lambda n: F.when(F.col(n) > 0, -(F.col(n) / total) * F.ln(F.col(n) / total)).otherwise(F.lit(0.0))
    h = term("n_a") + term("n_c") + term("n_g") + term("n_t")
    w = 1 - F.col("n_other") / total
    return counts.groupBy(gene).agg(F.sum(w * h).alias("_wh"), F.sum(w).alias("_w")).select(gene, F.try_divide("_wh", "_w").alias("entropy"))


def entropy_threshold(entropy: DataFrame, column: str = "entropy") -> DataFrame:
    """One row: quartiles and max(0.01, Q3 + 1.5 IQR)."""
    q = F.percentile(column, F.array(F.lit(0.25), F.lit(0.75)))
    return entropy.agg(q.alias("q")).select(F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3"), F.greatest(F.lit(0.01), F.col("q")[1] + 1.5 * (F.col("q")[1] - F.col("q")[0])).alias("threshold"))


def gaps(seq: Column) -> Column:
    return F.length(seq) - F.length(F.replace(seq, F.lit("-"), F.lit("")))


def least_gapped(aligned: DataFrame, gene: str, genome: str, seq: str, order: str) -> DataFrame:
    """The sequence with fewest gaps of each gene and genome, the first of equals."""
    w = Window.partitionBy(gene, genome).orderBy(gaps(F.col(seq)), order)
    return aligned.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def concatenated(filled: DataFrame, isolate: str, seq: str, order: str) -> DataFrame:
    """One long sequence for each isolate, genes in order. A row is as long as the core alignment: that is the result."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(seq).alias("s"))))
    return filled.groupBy(isolate).agg(F.array_join(F.transform(parts, lambda x: x["s"]), "").alias(seq))


def degap(seq: Column) -> Column:
    return F.replace(seq, F.lit("-"), F.lit(""))


def pairwise(a: str, b: str, match: int = 2, mismatch: int = -1, gap: int = -2) -> tuple[str, str]:
    """Global alignment of two sequences by dynamic programming, the diagonal preferred among equals."""
    import numpy as np

    n, m = len(a), len(b)
    score = np.zeros((n + 1, m + 1), np.int64)
    score[:, 0], score[0] = gap * np.arange(n + 1), gap * np.arange(m + 1)
    x, y = np.frombuffer(a.encode("latin-1"), np.uint8), np.frombuffer(b.encode("latin-1"), np.uint8)
    steps = gap * np.arange(m + 1)
    for i in range(1, n + 1):
        best = np.empty(m + 1, np.int64)
        best[0] = score[i, 0]
        best[1:] = np.maximum(score[i - 1, :-1] + np.where(y == x[i - 1], match, mismatch), score[i - 1, 1:] + gap)
        score[i] = np.maximum.accumulate(best - steps) + steps  # gaps along the row, all at once
    i, j, p, q = n, m, [], []
    while i or j:
        if i and j and score[i, j] == score[i - 1, j - 1] + (match if a[i - 1] == b[j - 1] else mismatch):
            i, j = i - 1, j - 1
            p.append(a[i])
            q.append(b[j])
        elif i and score[i, j] == score[i - 1, j] + gap:
            i -= 1
            p.append(a[i])
            q.append("-")
        else:
            j -= 1
            p.append("-")
            q.append(b[j])
    return "".join(reversed(p)), "".join(reversed(q))


def centre_star(ids: list[str], seqs: list[str]) -> list[str]:
    """Rows of equal length: every sequence is aligned to the longest, once a gap always a gap."""
    if len(seqs) < 2:
        return list(seqs)
    centre = max(range(len(seqs)), key=lambda i: (len(seqs[i]), -i))
    rows, master = {centre: seqs[centre]}, seqs[centre]
    for i, s in enumerate(seqs):
        if i == centre:
            continue
        c, t = pairwise(seqs[centre], s)
        merged, new, old = [], [], {k: [] for k in rows}
        a = b = 0
        while a < len(master) or b < len(c):
            ga, gb = a < len(master) and master[a] == "-", b < len(c) and c[b] == "-"
            if ga and not gb:  # a gap that earlier rows put in
                merged.append("-")
                new.append("-")
                for k in rows:
                    old[k].append(rows[k][a])
                a += 1
            elif gb and not ga:  # a gap that this row puts in
                merged.append("-")
                new.append(t[b])
                for k in rows:
                    old[k].append("-")
                b += 1
            else:
                merged.append(master[a])
                new.append(t[b])
                for k in rows:
                    old[k].append(rows[k][a])
                a, b = a + 1, b + 1
        master = "".join(merged)
        rows = {k: "".join(v) for k, v in old.items()} | {i: "".join(new)}
    return [rows[i] for i in range(len(seqs))]


def align_genes(seqs: DataFrame, gene: str, seq_id: str, seq: str, aligner=centre_star) -> DataFrame:
    """(gene, seq_id, seq) with the sequences of each gene aligned.

    ``aligner(ids, sequences)`` returns rows of equal length; an external
    program can be wrapped in one. A gene is one group, as an alignment is one
    unit of work; genes are spread over the cluster.
    """
    schema = ", ".join(f"{c} {seqs.schema[c].dataType.simpleString()}" for c in (gene, seq_id, seq))

    def run(pdf):
        pdf = pdf.sort_values(seq_id).reset_index(drop=True)
        return pdf.assign(**{seq: aligner(pdf[seq_id].tolist(), pdf[seq].tolist())})

    return seqs.select(gene, seq_id, seq).groupBy(gene).applyInPandas(run, schema)


def feature_header(parts: DataFrame, order: str, name: str, length: str) -> DataFrame:
    """EMBL feature lines with running coordinates."""
    from strandloom.operators.positions import running_spans

    spans = running_spans(parts, [order], length)
    line = F.concat(F.lit("FT   feature         "), F.col("start").cast("string"), F.lit(".."), F.col("end").cast("string"), F.lit("\nFT                   /label="), F.col(name), F.lit("\nFT                   /locus_tag="), F.col(name))
    return spans.withColumn("line", line)


def codon_alignment(proteins: DataFrame, dna: DataFrame, gene: str, seq_id: str, prot: str, seq: str) -> DataFrame:
    """Aligned proteins turned into aligned codons; ids must be the same on both sides."""
    from strandloom.functions.sequences import back_translate

    return proteins.join(dna, [gene, seq_id]).select(gene, seq_id, back_translate(F.col(prot), F.col(seq)).alias(seq))


