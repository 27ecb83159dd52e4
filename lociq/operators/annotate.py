"""Annotation of cluster pairs: transcripts at each side, type and distance, evidence counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociq.functions import cigar
from lociq.operators.intervals import join_same, overlap_join

# The names of the types, spelt as users of such reports expect them.
TYPES = {
    "far": "Interchromosomal",
    "overlap": ("Overlapping_Same", "Overlapping_Complex", "Overlapping_Converging", "Overlapping_Diverging"),
    "adjacent": ("Read_Through", "Adjacent_Complex", "Adjacent_Converging", "Adjacent_Diverging"),
    "between": ("Intrachromosomal", "Intrachromosomal_Complex", "Intrachromosomal_Converging", "Intrachromsomal_Diverging"),
}


def lookup_transcripts(clusters: DataFrame, transcripts: DataFrame) -> DataFrame:
    """Cluster and transcript rows on the same reference and strand that overlap. Clusters: rname, strand, s, e; transcripts: rname, strand, s2, e2."""
    return overlap_join(clusters, transcripts, ["rname", "strand"])


def transcripts_of_reads(reads: DataFrame, exons: DataFrame, read: str = "read_id") -> tuple[DataFrame, DataFrame]:
    """Which transcripts a read's aligned blocks lie on: (read, block, start, end, transcripts) and (read, blocks, transcripts).

    reads: the read's id, rname, strand, pos, cigar (ops). exons: rname, strand, s2, e2, tx_id. The
    first table has a row for each block of a read, numbered from 0, with the sorted transcripts an
    exon of which overlaps it; the second those that every block lies on. A strand that is null
    or another than + and - fits both. Reads without a block are in neither; a null id is an id,
    and rows of one id count as one read's, whose equal blocks are one.

    Equal blocks of all reads are met once: a block is looked up by its place and strand.
    """
    known = lambda x: F.when(x.isin("+", "-"), x).otherwise(F.lit("."))
    found = reads.select(F.col(read).alias("_read"), "rname", known(F.col("strand")).alias("strand"), F.explode(cigar.blocks(F.col("pos"), F.col("cigar"))).alias("b"))
    of = found.select("_read", "rname", "strand", F.col("b.start").alias("s"), F.col("b.end").alias("e")).distinct()
    places = of.select("rname", "strand", "s", "e").distinct()
    met = overlap_join(places, exons.select("rname", known(F.col("strand")).alias("tx_strand"), "s2", "e2", "tx_id"), ["rname"])
    on = met.filter((F.col("strand") == F.col("tx_strand")) | (F.col("strand") == ".") | (F.col("tx_strand") == ".")).select("rname", "strand", "s", "e", "tx_id").distinct()
    lists = on.groupBy("rname", "strand", "s", "e").agg(F.sort_array(F.collect_list("tx_id")).alias("transcripts"))
    held = join_same(of, lists, ["rname", "strand", "s", "e"], "left")
    kind = lists.schema["transcripts"].dataType
    blocks = held.groupBy("_read").agg(F.sort_array(F.collect_list(F.struct("rname", "s", "e", "strand", F.coalesce("transcripts", F.array().cast(kind)).alias("transcripts")))).alias("_blocks"))
    each = blocks.select(F.col("_read").alias(read), F.posexplode("_blocks").alias("block", "_b"))
    every = F.aggregate(F.slice("_blocks", 2, F.size("_blocks")), F.col("_blocks")[0]["transcripts"], lambda a, x: F.array_intersect(a, x["transcripts"]))
    return each.select(read, "block", F.col("_b.s").alias("start"), F.col("_b.e").alias("end"), F.col("_b.transcripts").alias("transcripts")), blocks.select(F.col("_read").alias(read), F.size("_blocks").alias("blocks"), every.alias("transcripts"))


def oriented(start5: Column, start3: Column, strand5: Column) -> Column:
    """Whether the 5' side comes first in the direction of its own strand."""
    return ((start5 <= start3) & (strand5 == "+")) | ((start5 > start3) & (strand5 == "-"))


def intervening(pairs: DataFrame, exons: DataFrame) -> DataFrame:
    """(pair_id, between_all, between_same): transcripts with an exon strictly inside the gap of a pair.

    pairs: pair_id, rname5p, rname3p, start5p, end5p, start3p, end3p, strand5p, own (array of
    tx_id of either side). exons: rname, s2, e2, tx_id, tx_strand. Only pairs on one reference
    with a gap have rows.
    """
    gap = pairs.filter("rname5p = rname3p").select("pair_id", F.col("rname5p").alias("rname"), F.least("end5p", "end3p").alias("s"), F.greatest("start5p", "start3p").alias("e"), "strand5p", "own").filter("s < e")
    met = overlap_join(gap, exons.select("rname", "s2", "e2", "tx_id", "tx_strand"), ["rname"])
    inside = met.filter((F.col("s2") > F.col("s")) & (F.col("e2") < F.col("e")) & ~F.array_contains("own", F.col("tx_id")))
    return inside.groupBy("pair_id").agg(F.count_distinct("tx_id").alias("between_all"), F.count_distinct(F.when(F.col("tx_strand") == F.col("strand5p"), F.col("tx_id"))).alias("between_same"))


def type_and_distance(pairs: DataFrame) -> DataFrame:
    """Adds chimera_type, distance and gap from the sides and the counts of intervening transcripts.

    Needs rname5p, start5p, end5p, strand5p, the same for 3p, between_all and between_same
    (null counts are 0). distance is -1 between references, 0 for overlaps, and negative where
    the 5' side lies right; gap is the same without sign, null between references.
    """
    same = F.col("strand5p") == F.col("strand3p")
    ahead = oriented(F.col("start5p"), F.col("start3p"), F.col("strand5p"))
    column = F.when(same & ahead, 0).when(same, 1).when(ahead, 2).otherwise(3)
    name = lambda row: F.element_at(F.array(*[F.lit(x) for x in TYPES[row]]), column + 1)
    far = F.col("rname5p") != F.col("rname3p")
    over = (F.col("end5p") > F.col("start3p")) & (F.col("start5p") < F.col("end3p"))
    met = F.coalesce(F.when(same & ahead, F.col("between_same")).otherwise(F.col("between_all")), F.lit(0)) > 0
    distance = F.when(F.col("start5p") <= F.col("start3p"), F.col("start3p") - F.col("end5p")).otherwise(F.col("end3p") - F.col("start5p"))
    return pairs.withColumn("chimera_type", F.when(far, F.lit(TYPES["far"])).when(over, name("overlap")).when(met, name("between")).otherwise(name("adjacent"))).withColumn(
        "distance", F.when(far, F.lit(-1)).when(over, F.lit(0)).otherwise(distance).cast("long")).withColumn("gap", F.when(~far, F.abs("distance")))


def names_of(transcripts: DataFrame, keys: list[str], source: str | None) -> DataFrame:
    """(keys, genes, transcripts, biotypes): sorted distinct names, of the given source only; ``na`` where there is none."""
    matching = F.array_contains("annotation_sources", source) if source else F.lit(True)
    listed = lambda c: F.array_distinct(F.flatten(F.collect_list(F.when(matching, F.col(c)))))
    known = F.collect_set(F.when(F.col("gene_biotype") != "na", F.col("gene_biotype")))
    or_na = lambda a, n: F.when(F.size(a) > 0, F.array_sort(a)).otherwise(F.array(F.lit("na"))).alias(n)
    return transcripts.groupBy(*keys).agg(or_na(listed("gene_names"), "genes"), or_na(listed("tx_names"), "transcripts"), or_na(known, "biotypes"))


def annotate(pairs: DataFrame, clusters: DataFrame, transcripts: DataFrame, *, source: str | None = "ensembl") -> DataFrame:
    """Chimera rows (24 columns) for cluster pairs.

    pairs: pair_id, id5p, id3p, qnames, spanning_qnames (may be null). clusters: the columns of
    ``lociq.sources.tables.CLUSTERS``. transcripts: those of ``TRANSCRIPTS``.
    """
    tx = transcripts.select(F.col("chrom").alias("rname"), "strand", F.col("tx_start").alias("s2"), F.col("tx_end").alias("e2"), "tx_id", "gene_biotype", "tx_names", "gene_names", "annotation_sources")
    spots = clusters.select("cluster_id", "rname", "strand", F.col("start").alias("s"), F.col("end").alias("e"))
    met = lookup_transcripts(spots, tx)
    own = met.groupBy("cluster_id").agg(F.collect_set("tx_id").alias("own"))
    info = spots.select("cluster_id").join(names_of(met, ["cluster_id"], source), "cluster_id", "left").join(own, "cluster_id", "left")
    na = F.array(F.lit("na"))
    info = info.select("cluster_id", *[F.coalesce(c, na).alias(c) for c in ("genes", "transcripts", "biotypes")], F.coalesce("own", F.array().cast("array<bigint>")).alias("own"))
    full = clusters.join(info, "cluster_id")
    side = lambda p: full.select(F.col("cluster_id").alias(f"id{p}"), *[F.col(a).alias(f"{b}{p}") for a, b in (("rname", "rname"), ("start", "start"), ("end", "end"), ("strand", "strand"), ("qnames", "disc"), ("concordant_frags", "num_concordant_frags_"), ("genes", "genes_"), ("transcripts", "transcripts_"), ("biotypes", "biotypes_"), ("own", "own_"))])
    none = F.array().cast("array<string>")
    both = pairs.withColumn("spanning_qnames", F.coalesce("spanning_qnames", none)).join(side("5p"), "id5p").join(side("3p"), "id3p").withColumn("own", F.array_union("own_5p", "own_3p"))
    exons = transcripts.select(F.col("chrom").alias("rname"), "tx_id", F.col("strand").alias("tx_strand"), F.explode("exons").alias("x")).select("rname", "tx_id", "tx_strand", F.col("x.start").alias("s2"), F.col("x.end").alias("e2"))
    between = intervening(both.select("pair_id", "rname5p", "rname3p", "start5p", "end5p", "start3p", "end3p", "strand5p", "own"), exons)
    typed = type_and_distance(both.join(between, "pair_id", "left"))
    return typed.select(
        "rname5p", "start5p", "end5p", "rname3p", "start3p", "end3p", F.concat(F.lit("CHIMERA"), F.col("pair_id").cast("string")).alias("chimera_id"),
        F.size(F.array_union(F.array_distinct("qnames"), "spanning_qnames")).alias("num_frags"), "strand5p", "strand3p", "chimera_type", "distance",
        F.size("qnames").alias("num_discordant_frags"), F.size("spanning_qnames").alias("num_spanning_frags"), F.size("disc5p").alias("num_discordant_frags_5p"), F.size("disc3p").alias("num_discordant_frags_3p"),
        "num_concordant_frags_5p", "num_concordant_frags_3p", "biotypes_5p", "biotypes_3p", "genes_5p", "genes_3p", "transcripts_5p", "transcripts_3p")
