"""Sequence functions as column expressions: built-in ones, and table lookups over Arrow columns where a codon or word is looked up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandloom.functions import kernels

#: Complements of bases and ambiguity letters, in both cases.
COMPLEMENT = ("ACGTUMRWSYKVHDBXNacgtumrwsykvhdbxn", "TGCAAKYWSRMBDHVXNtgcaakywsrmbdhvxn")
#: Codons whose residue depends on how an ambiguity is read, refused in codon alignments.
DEGENERATE_CODONS = ("AAN", "ATN", "CAN", "GAN", "TAN", "TTN", "AGN", "TGN")


def reverse_complement(dna: Column) -> Column:
    return F.reverse(F.translate(dna, *COMPLEMENT))


def places(n: Column, step: int = 1, first: int = 1) -> Column:
    """first, first + step, ... up to n; empty where n < first (``sequence`` alone would count down)."""
    return F.when(n >= first, F.sequence(F.lit(first), n, F.lit(step))).otherwise(F.array().cast("array<int>"))


def codons(dna: Column) -> Column:
    """Whole codons; a part of one at the end is left out.

    One pass of a pattern: a substring at each place would count characters
    from the start every time.
    """
    return F.regexp_extract_all(dna, F.lit("(?s)(.{3})"), F.lit(1))


def translate_codons(dna: Column, code: int = 11) -> Column:
    """Residues by a genetic code: X for other letters than ACGT, M for a start codon at the start; an error unless the length is a multiple of three."""
    return kernels.translate(dna, code)


def translate_standard(dna: Column) -> Column:
    """Residues by code 1, ambiguity letters resolved where all readings agree, X elsewhere; no change of the first residue, a part codon dropped."""
    return kernels.translate_standard(dna)


def strip_stop(protein: Column) -> Column:
    """Without one stop at the end; an error at a stop before it."""
    cut = F.regexp_replace(protein, r"\*$", "")
    return F.when(~cut.contains("*"), cut).otherwise(F.when(protein.isNotNull(), F.raise_error(F.lit("premature stop"))))


def is_valid_gene(dna: Column, protein: Column) -> Column:
    """Length a multiple of three, and without X the protein starts with M and has no stop before its end; all X is an error."""
    p = F.replace(protein, F.lit("X"), F.lit(""))
    body = F.substring(p, F.lit(1), F.length(p) - 1)
    ok = p.startswith("M") & ~body.contains("*")
    return F.when(F.length(dna) % 3 != 0, F.lit(False)).when(p == "", F.raise_error(F.lit("nothing but X")).cast("boolean")).otherwise(ok)


def internal_stop(protein: Column) -> Column:
    """A stop other than at the first or the last three places."""
    return F.substring(protein, F.lit(2), F.greatest(F.length(protein) - 4, F.lit(0))).contains("*")


def invalid_reason(dna: Column, frame: Column, protein: Column) -> Column:
    """Why a coding sequence is refused, null if it isn't."""
    body = F.substring(protein, F.lit(1), F.length(protein) - 1)
    return F.when(frame != "0", "frame").when(F.length(dna) % 3 > 0, "length").when(F.length(dna) < 34, "short").when(body.contains("*"), "stop")


def kmers(s: Column, k: int = 3) -> Column:
    """The distinct substrings of length k, found in one pass."""
    return F.array_distinct(F.regexp_extract_all(s, F.lit(f"(?s)(?=(.{{{k}}}))"), F.lit(1)))


def shared_kmers(a: Column, b: Column, k: int = 3) -> Column:
    return F.size(F.array_intersect(kmers(a, k), kmers(b, k)))


def padded_frame(dna: Column, frame: int) -> Column:
    """A reading frame, padded with N to the next multiple of three: by three where it is one already."""
    s = F.substring(dna, F.lit(frame + 1), F.length(dna))
    return translate_standard(F.concat(s, F.repeat(F.lit("N"), 3 - F.length(s) % 3)))


def best_frame(dna: Column, protein: Column) -> Column:
    """The translation of six (frames 0-2, each strand in turn) that shares most distinct 3-mers with a protein; the first of equals."""
    return kernels.nearest_frame(dna, protein)


def codon_failures(dna: Column, protein: Column, code: int = 11) -> Column:
    """The checks that a sequence fails before codon alignment (0 length, 1 translation, 2 NN, 3 degenerate codon).

    A length that is no multiple of three leaves the translation unchecked; the other checks run all the same.
    """
    whole = F.length(dna) % 3 == 0
    trimmed = F.substring(dna, F.lit(1), F.length(dna) - F.length(dna) % 3)
    other = F.regexp_replace(translate_codons(trimmed, code), r"\*$", "") != F.regexp_replace(protein, r"\*$", "")
    return F.filter(F.array(F.when(~whole, 0), F.when(whole & other, 1), F.when(dna.contains("NN"), 2), F.when(F.exists(codons(dna), lambda c: c.isin(*DEGENERATE_CODONS)), 3)), lambda x: x.isNotNull())


def back_translate(aligned_protein: Column, dna: Column) -> Column:
    """Three bases for each residue, three dashes for each gap."""
    return kernels.gapped(aligned_protein, dna)


def mask_leading_run(db: Column, run: int = 20) -> Column:
    """The start up to and with a run of N, when only letters other than N come before it, as X."""
    m = F.regexp_extract(db, f"^[ACGTEX]*N{{{run}}}", 0)
    return F.concat(F.repeat(F.lit("X"), F.length(m)), F.substring(db, F.length(m) + 1, F.length(db)))


def mask_trailing_run(db: Column, run: int = 20) -> Column:
    """The end from a run of N on, when only letters other than N follow it, as X."""
    m = F.regexp_extract(db, f"N{{{run}}}[ACGTEX]*$", 0)
    return F.concat(F.substring(db, F.lit(1), F.length(db) - F.length(m)), F.repeat(F.lit("X"), F.length(m)))


def trim_found(dna: Column) -> Column:
    """Without N, X and E at both ends; X and E elsewhere become N."""
    return F.translate(F.regexp_replace(F.regexp_replace(dna, "^[NXE]+", ""), "[NXE]+$", ""), "XE", "NN")


def letter_count(s: Column, letters: str) -> Column:
    return F.length(s) - F.length(F.translate(s, letters, ""))


def terminal_inserts(cigar: Column) -> Column:
    """Length of an insert at the start plus one at the end of an extended CIGAR; one that is the whole counts twice."""
    n = lambda p: F.coalesce(F.nullif(F.regexp_extract(cigar, p, 1), F.lit("")).cast("long"), F.lit(0).cast("long"))
    return n(r"^(\d+)I") + n(r"(\d+)I$")
