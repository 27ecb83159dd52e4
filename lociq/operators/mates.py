"""Reads and their mates: trimmed reads made whole, single reads paired, unpaired reads told of their mate.

Alignments have the columns that ``lociq.sources.reads.read_sam`` gives, or those named here.
Repeated rows each count; a null name or mate meets nothing in joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lociq.functions import cigar
from lociq.functions.sequence import mismatches_between, reverse_complement
from lociq.operators.classify import CONCORDANT_GENE, CONCORDANT_TX, DISCORDANT_GENE, STRAND_GENE, STRAND_TX, UNSTRANDED, orientation
from lociq.operators.intervals import overlap_join
from lociq.sources.reads import has_flag, with_flags


def restore_full_reads(alignments: DataFrame, reads: DataFrame) -> DataFrame:
    """Alignments of trimmed reads with the whole read's sequence and quality; what was trimmed becomes a soft clip.

    Joined on (qname, mate), a read with all its alignments. alignments: qname, mate, flag,
    cigar (ops), seq, and others that stay. reads: qname, mate, seq, qual. An unmapped row
    keeps its empty CIGAR.
    """
    full = reads.select("qname", "mate", F.col("seq").alias("_seq"), F.col("qual").alias("_qual"))
    met = alignments.join(full, ["qname", "mate"])
    back, ext = has_flag(F.col("flag"), "reverse"), F.length("_seq") - F.length("seq")
    padded = met.withColumn("cigar", F.when(F.size("cigar") > 0, cigar.soft_pad(F.col("cigar"), ext, back)).otherwise(F.col("cigar")))
    out = padded.withColumn("seq", F.when(back, reverse_complement(F.col("_seq"))).otherwise(F.col("_seq")))
    return out.withColumn("qual", F.when(back, F.reverse("_qual")).otherwise(F.col("_qual"))).drop("_seq", "_qual")


def as_mates(alignments: DataFrame) -> DataFrame:
    """Alignments of interleaved single reads as those of mates: the digit before the name tells the mate; not secondary any more."""
    mate = F.substring("qname", 1, 1).cast("int") + 1
    flag = with_flags(F.col("flag"), ["paired"], ["secondary", "first", "second"])
    flag = F.when(mate == 1, with_flags(flag, ["first"])).otherwise(with_flags(flag, ["second"]))
    return alignments.withColumns({"mate": mate, "flag": flag, "qname": F.expr("substring(qname, 2)")})


def full_mates(alignments: DataFrame, reads: DataFrame) -> DataFrame:
    """Single-read alignments of trimmed, interleaved mates as whole paired reads."""
    return restore_full_reads(as_mates(alignments), reads)


def outer_distance(pos: Column, end: Column, mate_pos: Column, mate_end: Column, same: Column) -> Column:
    """A mate's template length: 0 between references; positive for the mate that lies left, or for mate 1 of equal places."""
    return F.when(~F.coalesce(same, F.lit(False)), 0).when(pos > mate_pos, -(end - mate_pos)).otherwise(mate_end - pos)


def pair_mates(pairs: DataFrame, tags: dict[str, Column] | None = None) -> DataFrame:
    """Both rows of each pair with the mate's fields: flag, rnext, pnext, tlen, tags.

    pairs has a and b, structs of mates 1 and 2 with qname, flag, rname, pos, end, tags (and
    others that stay), and what ``tags`` needs; equal names are replaced. Both become paired
    and proper. Both mates at one place: mate 1 counts as the left one.
    """
    same = F.col("a.rname").eqNullSafe(F.col("b.rname"))
    size = outer_distance(F.col("a.pos"), F.col("a.end"), F.col("b.pos"), F.col("b.end"), same)
    new = F.map_from_entries(F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in (tags or {}).items()]))

    def row(me: str, mate: str, number: str, tlen: Column) -> Column:
        flag = with_flags(F.col(f"{me}.flag"), ["paired", "proper", number], ["mate_reverse", "mate_unmapped"])
        for name, own in (("mate_reverse", "reverse"), ("mate_unmapped", "unmapped")):
            flag = F.when(has_flag(F.col(f"{mate}.flag"), own), with_flags(flag, [name])).otherwise(flag)
        kept = F.coalesce(F.col(f"{me}.tags"), F.create_map().cast("map<string,string>"))
        every = F.map_concat(F.map_filter(kept, lambda k, _: ~k.isin(*tags)), new) if tags else kept
        changed = {"flag": flag, "rnext": F.col(f"{mate}.rname"), "pnext": F.col(f"{mate}.pos"), "tlen": tlen, "tags": every}
        names = pairs.schema[me].dataType.names
        return F.struct(*[changed.pop(n).alias(n) if n in changed else F.col(f"{me}.{n}") for n in names], *[v.alias(n) for n, v in changed.items()])

    both = pairs.select(F.explode(F.array(row("a", "b", "first", size.cast("int")), row("b", "a", "second", (-size).cast("int")))).alias("r"))
    return both.select("r.*")


def with_unmapped_mates(alignments: DataFrame, library: str = UNSTRANDED) -> DataFrame:
    """Mapped rows of fragments whose other mate is unmapped, with that mate's sequence and quality (r2, q2) and their orientation.

    alignments: qname, mate, flag, seq, qual and others that stay. A fragment both of whose
    mates are mapped, or neither, has no row.
    """
    un = has_flag(F.col("flag"), "unmapped")
    lost = alignments.filter(un).groupBy("qname", "mate").agg(F.min(F.struct("seq", "qual")).alias("_m"))
    lost = lost.select("qname", (3 - F.col("mate")).alias("mate"), F.col("_m.seq").alias("r2"), F.col("_m.qual").alias("q2"))
    mapped = alignments.filter(~un).join(lost, ["qname", "mate"])
    return mapped.withColumn("orient", orientation(has_flag(F.col("flag"), "reverse"), F.col("mate"), library))


def discordance(tier: Column) -> Column:
    """The discordance code of a pair of a tier of ``classify.tiered_pairs``."""
    codes = (CONCORDANT_TX, CONCORDANT_GENE, STRAND_TX, STRAND_GENE, DISCORDANT_GENE)
    return F.element_at(F.array(*[F.lit(c) for c in codes]), tier + 1)


def by_pair_prefix(reads: DataFrame, name: str = "qname") -> DataFrame:
    """Adds pair_id: reads named ``pair:name`` by their pair, the name restored."""
    cut = F.split(name, ":", 2)
    return reads.withColumn("pair_id", cut[0].cast("int")).withColumn(name, cut[1])


def reads_of_clusters(clusters: DataFrame, reads: DataFrame, names: str, *, width: int | None = None) -> DataFrame:
    """(cluster_id, and the read's columns): reads inside a cluster's interval that its list ``names`` has.

    clusters: cluster_id, rname, s, e and the array. reads: qname, rname, s2, e2.
    """
    listed = clusters.select("cluster_id", "rname", "s", "e", F.explode(F.array_distinct(names)).alias("qname"))
    return overlap_join(listed, reads, ["rname", "qname"], width=width).drop("s", "e")


def chimeras_with_reads(chimeras: DataFrame, reads: DataFrame, side: str, library: str = UNSTRANDED) -> DataFrame:
    """Chimeras with the reads on the transcript of one side (5p or 3p) that lie in its orientation.

    chimeras: chimera_id, tx5p, tx3p. reads: rname, flag, mate and others.
    """
    wanted = 1 if side == "5p" else 2
    facing = reads.filter(orientation(has_flag(F.col("flag"), "reverse"), F.col("mate"), library) == wanted)
    return chimeras.join(facing, chimeras[f"tx{side}"] == facing.rname)


def with_sequences(fragments: DataFrame, reads: DataFrame) -> DataFrame:
    """Discordant fragments (qname) with seq1, qual1, seq2, qual2 of the original reads; fragments without both mates are left out."""
    side = lambda m: reads.filter(F.col("mate") == m).select("qname", F.col("seq").alias(f"seq{m}"), F.col("qual").alias(f"qual{m}"))
    return fragments.join(side(1), "qname").join(side(2), "qname")


def reads_to_unmapped(reads: DataFrame) -> DataFrame:
    """Unaligned rows of raw reads, as an unmapped alignment file holds them: paired, both mates unmapped."""
    flag = with_flags(F.lit(0), ["paired", "unmapped", "mate_unmapped"])
    flag = F.when(F.col("mate") == 1, with_flags(flag, ["first"])).otherwise(with_flags(flag, ["second"]))
    none = F.array().cast("array<struct<op:int,len:int>>")
    return reads.select(
        F.col("qname").cast("string").alias("qname"), flag.alias("flag"), F.lit(None).cast("string").alias("rname"), F.lit(-1).alias("pos"), F.lit(0).alias("mapq"), none.alias("cigar"),
        F.lit(None).cast("string").alias("rnext"), F.lit(-1).alias("pnext"), F.lit(0).alias("tlen"), "seq", "qual", F.create_map().cast("map<string,string>").alias("tags"),
    )


def alignments_to_reads(alignments: DataFrame) -> DataFrame:
    """(qname, mate, seq, qual) of the reads as they were sequenced: reverse alignments are turned back; secondary rows are left out."""
    back = has_flag(F.col("flag"), "reverse")
    rows = alignments.filter(~has_flag(F.col("flag"), "secondary"))
    mate = F.when(has_flag(F.col("flag"), "second"), 2).otherwise(1)
    return rows.select("qname", mate.alias("mate"), F.when(back, reverse_complement(F.col("seq"))).otherwise(F.col("seq")).alias("seq"), F.when(back, F.reverse("qual")).otherwise(F.col("qual")).alias("qual"))


def resolve_by_histogram(reads: DataFrame) -> DataFrame:
    """Each read's candidates with the best (unique_reads, spanning_reads, hist, probability, fewest mismatches); ties stay.

    hist is the candidate's multimap histogram (fewest maps first), compared bin by bin.
    """
    key = F.struct("unique_reads", "spanning_reads", "hist", "probability", (-F.col("mismatches")).alias("less"))
    over = Window.partitionBy("qname").orderBy(key.desc())
    return reads.withColumn("_r", F.rank().over(over)).filter("_r = 1").drop("_r")


def spanning_reads(chimeras: DataFrame, alignments: DataFrame) -> DataFrame:
    """(chimera_id, qname): alignments over a chimera's junction whose clipped interval strictly holds its breakpoint.

    chimeras: chimera_id, breakpoint. alignments: chimera_id, qname, pos, cigar.
    """
    at = cigar.clipped_interval(F.col("pos"), F.col("cigar"))
    met = alignments.join(chimeras, "chimera_id")
    return met.filter((at["start"] < F.col("breakpoint")) & (F.col("breakpoint") < at["end"])).select("chimera_id", "qname").distinct()


def local_hits(reads: DataFrame, segments: DataFrame, *, anchor: int) -> DataFrame:
    """(read_id, ref_id, read_start, ref_start, length): exact local matches of ``anchor`` bases or more.

    reads: read_id, seq. segments: ref_id, seq. Seeds are the anchors' bases; those on one
    diagonal that follow each other are one match, so no seed is extended base by base.
    """
    def seeds(df: DataFrame, of: str, at: str) -> DataFrame:
        starts = F.sequence(F.lit(0), F.length("seq") - anchor)
        long = df.filter(F.length("seq") >= anchor)
        return long.select(of, "seq", F.explode(starts).alias(at)).select(of, at, F.col("seq").substr(F.col(at) + 1, F.lit(anchor)).alias("seed"))

    met = seeds(reads, "read_id", "i").join(seeds(segments, "ref_id", "j"), "seed").withColumn("diagonal", F.col("j") - F.col("i"))
    step = F.row_number().over(Window.partitionBy("read_id", "ref_id", "diagonal").orderBy("i"))
    runs = met.withColumn("run", F.col("i") - step).groupBy("read_id", "ref_id", "diagonal", "run").agg(F.min("i").alias("read_start"), (F.max("i") - F.min("i") + anchor).alias("length"))
    return runs.select("read_id", "ref_id", "read_start", (F.col("read_start") + F.col("diagonal")).alias("ref_start"), "length")


def homologous(chimeras: DataFrame, transcripts: DataFrame, *, tile: int, mismatches: int = 0) -> DataFrame:
    """chimera_id of candidates a tile of whose 5' interval lies in its own 3' interval with at most ``mismatches``.

    chimeras: chimera_id, tx5p, start5p, end5p, tx3p, start3p, end3p in transcript positions.
    transcripts: tx_id, seq. A candidate's two sides meet on its own id and a part of the tile: of
    ``mismatches`` + 1 parts one has none. So no aligner sees all tiles, and no match is lost.
    """
    part = lambda p: F.expr(f"substring(seq, greatest(start{p}, 0) + 1, end{p} - greatest(start{p}, 0))")
    size = max(1, tile // (mismatches + 1))

    def tiles(p: str, short: int) -> DataFrame:
        own = chimeras.join(transcripts, chimeras[f"tx{p}"] == transcripts.tx_id).select("chimera_id", part(p).alias("part"))
        own = own.filter(F.length("part") >= tile + short)
        every = own.select("chimera_id", F.explode(F.transform(F.sequence(F.lit(1), F.length("part") - tile + 1 - short), lambda i: F.col("part").substr(i, F.lit(tile)))).alias(f"tile{p}")).distinct()
        if not mismatches:
            return every.withColumnRenamed(f"tile{p}", "tile")
        seeds = F.array(*[F.struct(F.lit(i).alias("i"), F.substring(f"tile{p}", i * size + 1, size).alias("seed")) for i in range(mismatches + 1)])
        return every.withColumn("x", F.explode(seeds)).select("chimera_id", f"tile{p}", "x.i", "x.seed")

    if not mismatches:
        return tiles("5p", 1).join(tiles("3p", 0), ["chimera_id", "tile"]).select("chimera_id").distinct()
    met = tiles("5p", 1).join(tiles("3p", 0), ["chimera_id", "i", "seed"])
    return met.filter(mismatches_between(F.col("tile5p"), F.col("tile3p")) <= mismatches).select("chimera_id").distinct()
