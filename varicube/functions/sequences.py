"""Column functions on nucleotide sequences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The complement of each IUPAC code, and the bases that each stands for.
IUPAC = "ACGTRYKMBDHVSWN"
COMPLEMENT = "TGCAYRMKVHDBSWN"
BASES = {"A": "A", "C": "C", "G": "G", "T": "T", "R": "AG", "Y": "CT", "K": "GT", "M": "AC", "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "S": "CG", "W": "AT", "N": "ACGT"}

# Stop codons by the number of the published genetic code.
STOPS = {
    1: ("TAA", "TAG", "TGA"), 2: ("TAA", "TAG", "AGA", "AGG"), 3: ("TAA", "TAG"), 4: ("TAA", "TAG"), 5: ("TAA", "TAG"), 6: ("TGA",), 9: ("TAA", "TAG"),
    10: ("TAA", "TAG"), 11: ("TAA", "TAG", "TGA"), 12: ("TAA", "TAG", "TGA"), 13: ("TAA", "TAG"), 14: ("TAG",), 16: ("TAA", "TGA"), 21: ("TAA", "TAG"), 22: ("TCA", "TAA", "TGA"), 23: ("TTA", "TAA", "TAG", "TGA"),
}


def reverse_complement(sequence: Column) -> Column:
    return F.translate(F.reverse(sequence), IUPAC, COMPLEMENT)


def is_nucleotides(sequence: Column) -> Column:
    """Only A, C, G and T after upper-casing, and at least one of them."""
    return F.upper(sequence).rlike("^[ACGT]+$")


def stop_count(sequence: Column, frame: int, code: int = 5) -> Column:
    """Stop codons among the whole codons of reading frame 1, 2 or 3."""
    last = F.length(sequence) - 2
    starts = F.when(last >= frame, F.sequence(F.lit(frame), F.greatest(last, F.lit(frame)), F.lit(3))).otherwise(F.array().cast("array<int>"))
    return F.size(F.filter(starts, lambda i: F.substring(sequence, i, F.lit(3)).isin(*STOPS[code])))


def has_stop(sequence: Column, frame: int, code: int = 5) -> Column:
    return F.substring(sequence, F.lit(frame), F.length(sequence)).rlike("^(?:...)*?(?:" + "|".join(STOPS[code]) + ")")
