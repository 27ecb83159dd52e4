"""Columns over CIGAR strings held as arrays of (op, len) and over exon arrays.

Ops are the numbers of the SAM format: 0 M, 1 I, 2 D, 3 N, 4 S, 5 H, 6 P, 7 =, 8 X.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OPS = "MIDNSHP=X"
#: Ops that advance on the reference, in the read, and in both.
ON_REFERENCE, IN_READ = (0, 2, 3, 7, 8), (0, 1, 4, 7, 8)
_OPS_TYPE, _BLOCKS = "array<struct<op:int,len:int>>", "array<struct<start:int,end:int>>"


def parse(cigar: Column) -> Column:
    return F.transform(F.regexp_extract_all(cigar, F.lit("([0-9]+[MIDNSHP=X])"), 1), lambda t: F.struct((F.instr(F.lit(OPS), F.substring(t, -1, 1)) - 1).cast("int").alias("op"), F.regexp_extract(t, "^[0-9]+", 0).cast("int").alias("len")))


def render(ops: Column) -> Column:
    return F.array_join(F.transform(ops, lambda x: F.concat(x["len"].cast("string"), F.substring(F.lit(OPS), x["op"] + 1, F.lit(1)))), "")


def _total(ops: Column, kinds: tuple[int, ...]) -> Column:
    return F.aggregate(F.filter(ops, lambda x: x["op"].isin(*kinds)), F.lit(0), lambda a, x: a + x["len"])


def reference_length(ops: Column) -> Column:
    return _total(ops, ON_REFERENCE)


def read_length(ops: Column) -> Column:
    return _total(ops, IN_READ)


def reference_end(pos: Column, ops: Column) -> Column:
    return pos + reference_length(ops)


def clipped_interval(pos: Column, ops: Column) -> Column:
    """[pos, end) widened by a leading clip, or else by a trailing one; a lone op is never a clip."""
    clip = lambda x: x["op"].isin(4, 5)
    first, last, end = ops[0], F.element_at(ops, -1), reference_end(pos, ops)
    many = F.size(ops) > 1
    return F.when(many & clip(first), F.struct((pos - first["len"]).alias("start"), end.alias("end"))).when(many & clip(last), F.struct(pos.alias("start"), (end + last["len"]).alias("end"))).otherwise(F.struct(pos.alias("start"), end.alias("end")))


def blocks(pos: Column, ops: Column) -> Column:
    """Aligned blocks: cut at N, advanced by M, D, = and X."""
    walked = F.aggregate(
        ops,
        F.struct(pos.cast("int").alias("st"), pos.cast("int").alias("en"), F.array().cast(_BLOCKS).alias("out")),
        lambda a, x: F.when(x["op"] == 3, F.struct((a["en"] + x["len"]).alias("st"), (a["en"] + x["len"]).alias("en"), F.when(a["en"] > a["st"], F.concat(a["out"], F.array(F.struct(a["st"].alias("start"), a["en"].alias("end"))))).otherwise(a["out"]).alias("out")))
        .when(x["op"].isin(0, 2, 7, 8), F.struct(a["st"].alias("st"), (a["en"] + x["len"]).alias("en"), a["out"].alias("out")))
        .otherwise(a),
    )
    return F.when(walked["en"] > walked["st"], F.concat(walked["out"], F.array(F.struct(walked["st"].alias("start"), walked["en"].alias("end"))))).otherwise(walked["out"])


def best_read_interval(ops: Column) -> Column:
    """The longest run of M, I, = and X in read coordinates, between other ops; the first of equal ones."""
    runs = F.aggregate(
        ops,
        F.struct(F.lit(0).alias("st"), F.lit(0).alias("en"), F.array().cast(_BLOCKS).alias("out")),
        lambda a, x: F.when(x["op"].isin(0, 1, 7, 8), F.struct(a["st"].alias("st"), (a["en"] + x["len"]).alias("en"), a["out"].alias("out")))
        .when(x["op"] == 4, F.struct((a["en"] + x["len"]).alias("st"), (a["en"] + x["len"]).alias("en"), F.concat(a["out"], F.array(F.struct(a["st"].alias("start"), a["en"].alias("end")))).alias("out")))
        .otherwise(a),
        lambda a: F.concat(a["out"], F.array(F.struct(a["st"].alias("start"), a["en"].alias("end")))),
    )
    ordered = F.array_sort(F.transform(runs, lambda r: F.struct((r["start"] - r["end"]).alias("less"), r["start"].alias("start"), r["end"].alias("end"))))
    return F.struct(ordered[0]["start"].alias("start"), ordered[0]["end"].alias("end"))


def soft_pad(ops: Column, ext: Column, reverse: Column) -> Column:
    """Ops with the trimmed part restored as a soft clip: behind for a forward read, in front for a reverse one."""
    clip = F.array(F.struct(F.lit(4).alias("op"), ext.cast("int").alias("len"))).cast(_OPS_TYPE)
    return F.when(ext <= 0, ops).when(reverse, F.concat(clip, ops)).otherwise(F.concat(ops, clip))


def _with_offsets(exons: Column, strand: Column) -> Column:
    """Exons in transcript order with the transcript position at which each begins."""
    ordered = F.when(strand == "-", F.reverse(exons)).otherwise(exons)
    return F.aggregate(
        ordered,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,at:int>>").alias("out")),
        lambda a, x: F.struct((a["at"] + x["end"] - x["start"]).cast("int").alias("at"), F.concat(a["out"], F.array(F.struct(x["start"].cast("int").alias("start"), x["end"].cast("int").alias("end"), a["at"].alias("at")))).alias("out")),
        lambda a: a["out"],
    )


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def genome_position(exons: Column, strand: Column, pos: Column) -> Column:
    """The genome position of a transcript position; null past either end."""
    hit = F.filter(_with_offsets(exons, strand), lambda x: (x["at"] <= pos) & (pos < x["at"] + x["end"] - x["start"]))
    spot = lambda x: F.when(strand == "-", x["end"] - 1 - (pos - x["at"])).otherwise(x["start"] + pos - x["at"])
    return let(F.try_element_at(hit, F.lit(1)), spot)


def exon_of(exons: Column, strand: Column, pos: Column) -> Column:
    """(exon, start, offset): index in transcript order, transcript start and offset in it; null past either end."""
    listed = _with_offsets(exons, strand)
    return F.try_element_at(F.filter(F.transform(listed, lambda x, i: F.struct(i.alias("exon"), x["at"].alias("start"), (pos - x["at"]).alias("offset"), (x["end"] - x["start"]).alias("size"))), lambda x: (x["offset"] >= 0) & (x["offset"] < x["size"])), F.lit(1))


def transcript_interval(exons: Column, strand: Column, start: Column, end: Column) -> Column:
    """Where a genome interval lies on a transcript: per overlapping exon (start, end, left_over, right_over)."""
    met = F.filter(_with_offsets(exons, strand), lambda x: (x["end"] > start) & (x["start"] < end))
    return F.transform(met, lambda x: F.struct(
        (x["at"] + F.when(strand == "-", x["end"] - F.least(x["end"], end)).otherwise(F.greatest(x["start"], start) - x["start"])).alias("start"),
        (x["at"] + F.when(strand == "-", x["end"] - F.greatest(x["start"], start)).otherwise(F.least(x["end"], end) - x["start"])).alias("end"),
        F.greatest(F.lit(0), x["start"] - start).alias("left_over"), F.greatest(F.lit(0), end - x["end"]).alias("right_over")))


def introns(exons: Column) -> Column:
    """Gaps between consecutive exons; none for a single exon."""
    return F.when(F.size(exons) > 1, F.transform(F.sequence(F.lit(1), F.size(exons) - 1), lambda i: F.struct(F.element_at(exons, i)["end"].alias("start"), F.element_at(exons, i + 1)["start"].alias("end")))).otherwise(F.array().cast("array<struct<start:int,end:int>>"))


def genome_ops(exons: Column, strand: Column, pos: Column, ops: Column) -> Column:
    """The CIGAR of a transcript alignment on the genome.

    Ops that advance on the reference are cut where an exon ends, with an N of the intron's
    length between; on the minus strand the ops are then reversed. Zero-length ops are left out.
    """
    one = lambda op, n: F.when(n > 0, F.array(F.struct(op.cast("int").alias("op"), n.cast("int").alias("len")))).otherwise(F.array().cast(_OPS_TYPE))

    def borders(listed: Column) -> Column:
        """Where each exon but the last ends on the transcript, and the gap to the next."""
        n = F.greatest(F.size(listed) - 1, F.lit(0))
        gap = lambda a, b: F.when(strand == "-", a["start"] - b["end"]).otherwise(b["start"] - a["end"])
        return F.zip_with(F.slice(listed, 1, n), F.slice(listed, 2, n), lambda a, b: F.struct((a["at"] + a["end"] - a["start"]).alias("end"), gap(a, b).alias("gap")))

    def cut(ends: Column, at: Column, x: Column) -> Column:
        """The op from ``at``, cut at the exon ends strictly inside or, for what follows, at its start."""
        inner = F.filter(ends, lambda z: (z["end"] >= at) & (z["end"] < at + x["len"]) & ((z["end"] > at) | (at > pos)))
        begin = F.struct(at.cast("int").alias("at"), F.array().cast(_OPS_TYPE).alias("out"))
        step = lambda a, z: F.struct(z["end"].cast("int").alias("at"), F.concat(a["out"], one(x["op"], z["end"] - a["at"]), one(F.lit(3), z["gap"])).alias("out"))
        return F.aggregate(inner, begin, step, lambda done: F.concat(done["out"], one(x["op"], at + x["len"] - done["at"])))

    def walked(ends: Column) -> Column:
        return F.aggregate(
            ops,
            F.struct(pos.cast("int").alias("at"), F.array().cast(_OPS_TYPE).alias("out")),
            lambda a, x: F.when(
                x["op"].isin(*ON_REFERENCE), F.struct((a["at"] + x["len"]).cast("int").alias("at"), F.concat(a["out"], cut(ends, a["at"], x)).alias("out"))
            ).otherwise(F.struct(a["at"].alias("at"), F.concat(a["out"], one(x["op"], x["len"])).alias("out"))),
            lambda a: F.when(strand == "-", F.reverse(a["out"])).otherwise(a["out"]),
        )

    return let(_with_offsets(exons, strand), lambda listed: let(borders(listed), walked))


def genome_start(exons: Column, strand: Column, pos: Column, ops: Column) -> Column:
    """Leftmost genome position of a transcript alignment."""
    return F.when(strand == "-", genome_position(exons, strand, pos + reference_length(ops) - 1)).otherwise(genome_position(exons, strand, pos))
