"""Sequence kernels over whole Arrow columns: one pass of table lookups for all rows of a batch.

Letters become numbers once, codons are places in a table of 4,096 residues
(three letters of 16), and 3-mers of residues are numbers below 2^15, so that
sets of them are bit maps. Letters beyond ASCII count as one unknown letter.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql.functions import arrow_udf

from strandloom.functions.codons import LETTERS, residues_by_base4, residues_by_base16, start_codons

#: Number of a letter past the known ones, and residues as numbers of five bits (0: none that a translation gives).
UNKNOWN, RESIDUES = 16, "ABCDEFGHIJKLMNOPQRSTUVWXYZ*"


@cache
def _letters(known: str, also: str = "") -> np.ndarray:
    """Number of each byte; either case, ``also`` as pairs of a letter and what it is read as."""
    out = np.full(256, UNKNOWN, np.uint16)
    for i, c in enumerate(known):
        out[ord(c)] = out[ord(c.lower())] = i
    for a, b in zip(also[::2], also[1::2], strict=True):
        out[ord(a)] = out[ord(a.lower())] = out[ord(b)]
    return out


@cache
def _exact(code: int) -> tuple[np.ndarray, np.ndarray]:
    """Residue of each codon of A, C, G, T by 17 letters a place, and whether it starts a gene."""
    out, start = np.full(17**3, ord("X"), np.uint8), np.zeros(17**3, bool)
    table = residues_by_base4(code)
    for i in range(64):
        at = (i // 16 * 17 + i // 4 % 4) * 17 + i % 4
        out[at] = ord(table[i])
        start[at] = "ACGT"[i // 16] + "ACGT"[i // 4 % 4] + "ACGT"[i % 4] in start_codons(code)
    return out, start


@cache
def _ambiguous() -> np.ndarray:
    """Residue of each codon of ambiguity letters by 17 letters a place, code 1."""
    out = np.full((17, 17, 17), ord("X"), np.uint8)
    out[:16, :16, :16] = np.frombuffer(residues_by_base16(1).encode(), np.uint8).reshape(16, 16, 16)
    return out.ravel()


@cache
def _five_bits() -> np.ndarray:
    out = np.zeros(256, np.int64)
    for i, c in enumerate(RESIDUES):
        out[ord(c)] = i + 1
    return out


#: Complement of each of the 17 letter numbers: the letter of the complementary bases.
_BASES = {"A": "A", "C": "C", "G": "G", "T": "T", "R": "AG", "Y": "CT", "S": "CG", "W": "AT", "K": "GT", "M": "AC", "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGT"}


@cache
def _complements() -> np.ndarray:
    by = {frozenset(v): k for k, v in _BASES.items()}
    swap = dict(zip("ACGT", "TGCA", strict=True))
    return np.array([LETTERS.index(by[frozenset(swap[b] for b in _BASES[c])]) if c in _BASES else i for i, c in enumerate(LETTERS)] + [UNKNOWN], np.uint16)


def _bytes(x: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a text column; null rows are empty."""
    if isinstance(x, pa.ChunkedArray):
        x = x.combine_chunks()
    x = pc.fill_null(x.cast(pa.large_string()), "")
    data = x.buffers()[2]
    off = np.frombuffer(x.buffers()[1], np.int64)[x.offset : x.offset + len(x) + 1]
    data = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and len(off) else np.zeros(0, np.uint8)
    off = off - off[0]
    if (data >= 128).any():
        return _bytes(pc.replace_substring_regex(x, r"[^\x00-\x7F]", "?"))
    return data, off


def _texts(data: np.ndarray, off: np.ndarray, like: pa.Array) -> pa.Array:
    out = pa.Array.from_buffers(pa.large_string(), len(off) - 1, [None, pa.py_buffer(off.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
    return pc.if_else(pc.is_valid(like), out, None).cast(pa.string())


def _codon_starts(off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the whole codons of all rows, and the rows' offsets among them."""
    n = np.diff(off) // 3
    out = np.concatenate([[0], np.cumsum(n)])
    return np.repeat(off[:-1] - 3 * out[:-1], n) + 3 * np.arange(out[-1]), out


def translated(dna: pa.Array, code: int) -> pa.Array:
    data, off = _bytes(dna)
    if (np.diff(off) % 3).any():
        raise ValueError("length is not a multiple of three")
    at, out = _codon_starts(off)
    x = _letters("ACGT")[data]
    codon = (x[at].astype(np.int64) * 17 + x[at + 1]) * 17 + x[at + 2] if len(at) else at
    table, start = _exact(code)
    res = table[codon]
    first = out[:-1][np.diff(out) > 0]
    res[first[start[codon[first]]]] = ord("M")
    return _texts(res, out, dna)


def translated_standard(dna: pa.Array) -> pa.Array:
    data, off = _bytes(dna)
    at, out = _codon_starts(off)
    x = _letters(LETTERS, "UT")[data]
    return _texts(_ambiguous()[(x[at].astype(np.int64) * 17 + x[at + 1]) * 17 + x[at + 2]] if len(at) else np.zeros(0, np.uint8), out, dna)


def _words(residues: np.ndarray) -> np.ndarray:
    """The 3-mers of a protein as numbers; those with other letters than a translation's are 0."""
    x = _five_bits()[residues]
    if len(x) < 3:
        return np.zeros(0, np.int64)
    out = (x[:-2] << 10) | (x[1:-1] << 5) | x[2:]
    return np.where((x[:-2] > 0) & (x[1:-1] > 0) & (x[2:] > 0), out, 0)


def nearest_frames(dna: pa.Array, protein: pa.Array) -> pa.Array:
    """Of the six padded frames (0-2, each strand in turn) the one with most different 3-mers in common with the protein; the first of equals."""
    table, turn = _ambiguous(), _complements()
    data, off = _bytes(dna)
    other, other_off = _bytes(protein)
    x = _letters(LETTERS, "UT")[data]
    n_letter = LETTERS.index("N")
    mine, seen, out = np.zeros(1 << 15, bool), np.zeros(1 << 15, bool), []
    for i in range(len(off) - 1):
        words = _words(other[other_off[i] : other_off[i + 1]])
        mine[words] = True
        mine[0] = False
        row = x[off[i] : off[i + 1]]
        strands = (row, turn[row[::-1]])
        best, most = None, -1
        for frame in range(3):
            for s in strands:
                part = s[frame:]
                whole = np.full(len(part) + 3 - len(part) % 3, n_letter, np.int64)
                whole[: len(part)] = part
                res = table[(whole[::3] * 17 + whole[1::3]) * 17 + whole[2::3]]
                w = _words(res)
                hit = w[mine[w]]
                seen[hit] = True
                common = np.count_nonzero(seen) if len(hit) > 4096 else len(np.unique(hit))
                seen[hit] = False
                if common > most:
                    best, most = res, common
        mine[words] = False
        out.append(best)
    size = np.concatenate([[0], np.cumsum([len(r) for r in out])])
    made = _texts(np.concatenate(out) if out else np.zeros(0, np.uint8), size, dna)
    return pc.if_else(pc.is_valid(protein), made, None)


def gapped_codons(protein: pa.Array, dna: pa.Array) -> pa.Array:
    """Three bases for each residue of an aligned protein, three dashes for each gap; bases that lack are left out."""
    data, off = _bytes(protein)
    bases, base_off = _bytes(dna)
    gap = data == 45
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    solid = np.cumsum(~gap)
    before = np.concatenate([[0], solid])[off[:-1]]
    nth = solid - 1 - before[row]  # of the residue in its row
    at = (base_off[row] + 3 * nth)[:, None] + np.arange(3)
    has = ~gap[:, None] & (at < base_off[row + 1][:, None])
    cells = np.full((len(data), 3), 45, np.uint8)
    cells[has] = bases[at[has]]
    keep = has | gap[:, None]
    many = np.bincount(row, keep.sum(1), minlength=len(off) - 1).astype(np.int64)
    made = _texts(cells[keep], np.concatenate([[0], np.cumsum(many)]), protein)
    return pc.if_else(pc.is_valid(dna), made, None)


@cache
def _translate(code: int):
    def by_code(dna: pa.Array) -> pa.Array:
        return translated(dna, code)

    return arrow_udf(by_code, "string")


def translate(dna: Column, code: int) -> Column:
    return _translate(code)(dna)


@cache
def _function(kernel):
    return arrow_udf(kernel, "string")


def translate_standard(dna: Column) -> Column:
    return _function(translated_standard)(dna)


def nearest_frame(dna: Column, protein: Column) -> Column:
    return _function(nearest_frames)(dna, protein)


def gapped(protein: Column, dna: Column) -> Column:
    return _function(gapped_codons)(protein, dna)
