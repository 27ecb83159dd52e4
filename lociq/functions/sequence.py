"""Columns over nucleotide sequences, qualities, read names and MD strings."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Complements of the IUPAC codes, in both cases.
DNA_FROM, DNA_TO = "ACGTRYMKSWHBVDNacgtrymkswhbvdn", "TGCAYRKMSWDVBHNtgcayrkmswdvbhn"
RNA_FROM, RNA_TO = "ACGURYMKSWHBVDNacgurymkswhbvdn", "UGCAYRKMSWDVBHNugcayrkmswdvbhn"


def complement(seq: Column, *, rna: bool = False) -> Column:
    return F.translate(seq, RNA_FROM if rna else DNA_FROM, RNA_TO if rna else DNA_TO)


def reverse_complement(seq: Column, *, rna: bool = False) -> Column:
    return F.reverse(complement(seq, rna=rna))


def to_rna(seq: Column) -> Column:
    return F.translate(seq, "Tt", "Uu")


def to_dna(seq: Column) -> Column:
    return F.translate(seq, "Uu", "Tt")


def quality_table(kind: str) -> dict[str, str]:
    """Quality characters of a format -> those with offset 33.

    sanger: values over 40 become 40. illumina: offset 64. solexa: offset 64, log-odds to phred.
    """
    table = {}
    for c in range(33, 127):
        if kind == "sanger":
            q = min(c - 33, 40)
        elif kind == "illumina":
            q = max(0, c - 64)
        elif kind == "solexa":
            q = round(10 * math.log10(1 + 10 ** ((c - 64) / 10)))
        else:
            raise ValueError(kind)
        table[chr(c)] = chr(33 + min(q, 93))
    return table


def convert_quality(qual: Column, kind: str) -> Column:
    table = quality_table(kind)
    return F.translate(qual, "".join(table), "".join(table.values()))


def trim(seq: Column, trim5: int, trim3: int) -> Column:
    """Without ``trim5`` leading and ``trim3`` trailing characters, but one at least."""
    return F.substring(seq, F.lit(trim5 + 1), F.greatest(F.lit(trim5 + 1), F.length(seq) - trim3) - trim5)


def wrap(seq: Column, width: int = 50) -> Column:
    return F.rtrim(F.regexp_replace(seq, f"(.{{{width}}})", "$1\n"), F.lit("\n"))


def clean_name(name: Column) -> Column:
    """Up to the first white space, then up to the first slash."""
    return F.split(F.split(F.ltrim(name), r"\s+")[0], "/")[0]


def indices(n: Column) -> Column:
    """1 to n as an array; empty for 0."""
    return F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))


def homology(a: Column, b: Column, mismatches: int = 0) -> Column:
    """Length of the longest common prefix with up to ``mismatches`` differences; 0 for an empty side."""
    n = F.least(F.length(a), F.length(b))
    wrong = F.filter(indices(n), lambda i: F.substring(a, i, F.lit(1)) != F.substring(b, i, F.lit(1)))
    return F.coalesce(F.try_element_at(wrong, F.lit(mismatches + 1)) - 1, n)


def mismatches_between(a: Column, b: Column) -> Column:
    """Differing positions among the first of both."""
    return F.size(F.filter(indices(F.least(F.length(a), F.length(b))), lambda i: F.substring(a, i, F.lit(1)) != F.substring(b, i, F.lit(1))))


def md_reverse_complement(md: Column) -> Column:
    """An MD string for the other strand: tokens reversed, bases complemented, a deletion kept as one token."""
    parts = F.regexp_extract_all(md, F.lit(r"([0-9]+|\^[A-Za-z]+|[A-Za-z])"), 1)
    turned = F.transform(parts, lambda t: F.when(t.startswith("^"), F.concat(F.lit("^"), reverse_complement(F.substring(t, F.lit(2), F.length(t))))).otherwise(complement(t)))
    return F.array_join(F.reverse(turned), "")


def md_mismatches(md: Column) -> Column:
    """Offsets in the aligned read of the mismatching bases; deletions take no room."""
    parts = F.regexp_extract_all(md, F.lit(r"([0-9]+|\^[A-Za-z]+|[A-Za-z])"), 1)
    empty = F.array().cast("array<int>")
    return F.aggregate(
        parts,
        F.struct(F.lit(0).alias("at"), empty.alias("out")),
        lambda acc, t: F.when(t.rlike("^[0-9]+$"), F.struct((acc["at"] + F.try_to_number(t, F.lit("999999999")).cast("int")).alias("at"), acc["out"].alias("out")))
        .when(t.startswith("^"), acc)
        .otherwise(F.struct((acc["at"] + 1).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))),
        lambda acc: acc["out"],
    )


def has_bases(seq: Column) -> Column:
    return seq.rlike("[ACGTacgt]")


def segment_bounds(length: int, size: int) -> list[tuple[int, int]]:
    """Near-equal segments of about ``size``: as many as fit, the remainder dealt from the first."""
    n = max(1, length // size)
    base, more = divmod(length, n)
    out, at = [], 0
    for i in range(n):
        out.append((at, at + base + (i < more)))
        at = out[-1][1]
    return out


def segment_length(p5: float, trimmed: int) -> int:
    """A third of the 5th percentile insert size, 25 at least and the trimmed read at most."""
    return max(25, min(int(math.floor(p5 / 3 + 0.5)), trimmed))
