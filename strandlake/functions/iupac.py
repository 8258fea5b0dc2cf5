"""Nucleotides and codons as column expressions."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The codes, what bases they stand for, and their complements.
CODES = {"A": "A", "C": "C", "G": "G", "T": "T", "U": "T", "R": "AG", "Y": "CT", "S": "CG", "W": "AT", "K": "GT", "M": "AC", "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGT"}
COMPLEMENT_FROM, COMPLEMENT_TO = "ACGTURYSWKMBDHVN", "TGCAAYRSWMKVHDBN"
#: Fixed value: the standard genetic code, bases in the order TCAG.
BASES = "TCAG"
AMINO = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"

OTHER_LETTERS = "".join(c for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" if c not in CODES)


def sanitize_seq(seq: Column) -> Column:
    """Codes upper-cased, other ASCII letters as N, everything else dropped."""
    letters = F.upper(F.regexp_replace(seq, "[^A-Za-z]", ""))
    return F.translate(letters, OTHER_LETTERS, "N" * len(OTHER_LETTERS))


def sanitize_id(name: Column) -> Column:
    return F.translate(name, "\t", " ")


def reverse_complement(seq: Column) -> Column:
    return F.translate(F.reverse(seq), COMPLEMENT_FROM, COMPLEMENT_TO)


def plain(codon: Column) -> Column:
    """U as T, for comparing."""
    return F.replace(codon, F.lit("U"), F.lit("T"))


def amino_of(codon: str) -> str:
    """The amino acid of three bases."""
    return AMINO[16 * BASES.index(codon[0]) + 4 * BASES.index(codon[1]) + BASES.index(codon[2])]


def resolved() -> dict[str, str]:
    """Ambiguous codons all of whose readings are one amino acid."""
    out = {}
    for codon in product([c for c in CODES if c != "U"], repeat=3):
        readings = {amino_of(x) for x in map("".join, product(*(CODES[c] for c in codon)))}
        if len(readings) == 1 and not set(codon) <= set(BASES):
            out["".join(codon)] = readings.pop()
    return out


_RESOLVED = resolved()


def resolved_by_letter() -> dict[str, str]:
    """The ambiguous codons of each amino acid, joined by commas."""
    out: dict[str, list[str]] = {}
    for text, letter in _RESOLVED.items():
        out.setdefault(letter, []).append(text)
    return {letter: ",".join(texts) for letter, texts in sorted(out.items())}


def amino(codon: Column, strict: bool = False) -> Column:
    """The letter of a codon of an aligned sequence: - for three gaps, . for padding (or padding and gaps), ~ for a
    partial codon, X where ambiguous (``strict``: wherever a base is)."""
    return amino_of_plain(plain(codon), strict)


def amino_of_plain(c: Column, strict: bool = False) -> Column:
    """The same without U. Codons of bases are looked up once; only others are looked at more closely."""
    table = F.create_map(*[F.lit(x) for triple in product(BASES, repeat=3) for x in ("".join(triple), amino_of("".join(triple)))])
    unsure = F.lit("X")
    if not strict:
        for letter, texts in resolved_by_letter().items():
            unsure = F.when(F.instr(F.lit(texts), c) > 0, F.lit(letter)).otherwise(unsure)
    other = (
        F.when(c == "---", F.lit("-"))
        .when(c.rlike("^[-.]{3}$"), F.lit("."))
        .when((F.length(c) < 3) | c.rlike("[-.]"), F.lit("~"))
        .otherwise(unsure)
    )
    return F.coalesce(F.try_element_at(table, c), other)


def codons(seq: Column) -> Column:
    """Whole codons, as an array."""
    return F.coalesce(F.regexp_extract_all(seq, F.lit("(?s).{3}"), F.lit(0)), F.array().cast("array<string>"))


def amino_list(seq: Column) -> Column:
    return F.transform(codons(plain(seq)), lambda c: amino_of_plain(c))


def translate_exact(seq: Column) -> Column:
    """Whole codons only."""
    return F.array_join(amino_list(seq), "")


def translate_partial(seq: Column) -> Column:
    """One or two bases at the end are ~."""
    return F.concat(translate_exact(seq), F.when(F.length(seq) % 3 > 0, F.lit("~")).otherwise(F.lit("")))


def until_stop(letters: Column) -> Column:
    """The array up to its first stop, or all of it."""
    at = F.array_position(letters, "*").cast("int")
    return F.when(at > 0, F.slice(letters, F.lit(1), at)).otherwise(letters)


def first_codon(seq: Column) -> Column:
    return F.when(F.length(seq) >= 3, F.substring(seq, 1, 3))


def last_codon(seq: Column) -> Column:
    return F.when(F.length(seq) >= 3, F.substring(seq, -3, 3))


def is_stop(codon: Column) -> Column:
    return amino(codon) == "*"


def next_stop(seq: Column) -> Column:
    """0-based offset of the first in-frame stop codon; null without one."""
    at = F.array_position(amino_list(seq), "*").cast("int")
    return F.when(at > 0, 3 * (at - 1))


def genome_id(seq: Column) -> Column:
    """SHA-1 of nucleotides, lower-case hex."""
    return F.sha1(seq)


def variant_hash(letters: Column) -> Column:
    """MD5 of amino acids, lower-case hex; ~, * and X count."""
    return F.md5(letters)


def valid_dna(seq: Column) -> Column:
    return seq.rlike("^[" + "".join(CODES) + "]+$")


def codon_normalised(codon: Column) -> Column:
    """Upper case with T for U; null unless it is three codes."""
    c = plain(F.upper(codon))
    return F.when(c.rlike("^[" + "".join(CODES) + "]{3}$"), c)


def required_start(codon: Column) -> Column:
    """Three of ACGT, any case, U as T; null otherwise."""
    c = plain(F.upper(codon))
    return F.when(c.rlike("^[ACGT]{3}$"), c)
