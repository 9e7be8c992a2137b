"""Genetic codes, built from the standard code and each code's published differences."""

from __future__ import annotations

#: Amino acids of the standard code, codons in the order T, C, A, G.
STANDARD = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"

#: Codons that a code reads otherwise than the standard one. Where a codon may
#: be a stop or a residue, it is a stop.
DIFFERENCES = {
    1: "",
    2: "AGA=* AGG=* ATA=M TGA=W",
    3: "ATA=M CTT=T CTC=T CTA=T CTG=T TGA=W",
    4: "TGA=W",
    5: "AGA=S AGG=S ATA=M TGA=W",
    6: "TAA=Q TAG=Q",
    9: "AAA=N AGA=S AGG=S TGA=W",
    10: "TGA=C",
    11: "",
    12: "CTG=S",
    13: "AGA=G AGG=G ATA=M TGA=W",
    14: "AAA=N AGA=S AGG=S TAA=Y TGA=W",
    15: "TAG=Q",
    16: "TAG=L",
    21: "TGA=W ATA=M AGA=S AGG=S AAA=N",
    22: "TCA=* TAG=L",
    23: "TTA=*",
    24: "AGA=S AGG=K TGA=W",
    25: "TGA=G",
    26: "CTG=A",
    27: "TAA=Q TAG=Q",
    28: "",
    29: "TAA=Y TAG=Y",
    30: "TAA=E TAG=E",
    31: "TGA=W",
    32: "TAG=W",
    33: "TAA=Y TGA=W AGA=S AGG=K",
}

#: Start codons of each code.
STARTS = {
    1: "TTG CTG ATG",
    2: "ATT ATC ATA ATG GTG",
    3: "ATA ATG GTG",
    4: "TTA TTG CTG ATT ATC ATA ATG GTG",
    5: "TTG ATT ATC ATA ATG GTG",
    6: "ATG",
    9: "ATG GTG",
    10: "ATG",
    11: "TTG CTG ATT ATC ATA ATG GTG",
    12: "CTG ATG",
    13: "TTG ATA ATG GTG",
    14: "ATG",
    15: "ATG",
    16: "ATG",
    21: "ATG GTG",
    22: "ATG",
    23: "ATT ATG GTG",
    24: "TTG CTG ATG GTG",
    25: "TTG ATG GTG",
    26: "CTG ATG",
    27: "ATG",
    28: "ATG",
    29: "ATG",
    30: "ATG",
    31: "ATG",
    32: "TTG CTG ATT ATC ATA ATG GTG",
    33: "TTG CTG ATG GTG",
}

_ORDER = "TCAG"


def codon_table(code: int = 11) -> dict[str, str]:
    """Codon to residue, ``*`` for stops."""
    if code not in DIFFERENCES:
        raise ValueError(f"no genetic code {code}")
    table = {a + b + c: STANDARD[16 * i + 4 * j + k] for i, a in enumerate(_ORDER) for j, b in enumerate(_ORDER) for k, c in enumerate(_ORDER)}
    table.update(x.split("=") for x in DIFFERENCES[code].split())
    return table


def residues_by_base4(code: int = 11) -> str:
    """64 residues; a codon written with A, C, G, T as the digits 0-3 in base 4 is the place of its own."""
    table = codon_table(code)
    return "".join(table[a + b + c] for a in "ACGT" for b in "ACGT" for c in "ACGT")


def start_codons(code: int = 11) -> list[str]:
    return STARTS[code].split()


#: The bases that each ambiguity letter stands for.
AMBIGUOUS = {"A": "A", "C": "C", "G": "G", "T": "T", "U": "T", "R": "AG", "Y": "CT", "S": "CG", "W": "AT", "K": "GT", "M": "AC", "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGT", "X": "ACGT"}


def ambiguous_codons(code: int = 1) -> dict[str, str]:
    """Every codon of ambiguity letters that has the same residue however it is read."""
    table, out = codon_table(code), {}
    for a, xs in AMBIGUOUS.items():
        for b, ys in AMBIGUOUS.items():
            for c, zs in AMBIGUOUS.items():
                found = {table[x + y + z] for x in xs for y in ys for z in zs}
                if len(found) == 1:
                    out[a + b + c] = found.pop()
    return out


#: Letters in the order of their hexadecimal digit in ``residues_by_base16``.
LETTERS = "ACGTRYSWKMBDHVNX"


def residues_by_base16(code: int = 1) -> str:
    """4096 residues; a codon of ambiguity letters, each its place in ``LETTERS``, is the place of its own. X where readings differ."""
    table = ambiguous_codons(code)
    return "".join(table.get(a + b + c, "X") for a in LETTERS for b in LETTERS for c in LETTERS)
