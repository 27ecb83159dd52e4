"""Discovery of fusion candidates from alignments, the annotation build and the index build, as DataFrame plans."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lociq.functions import cigar, sequence
from lociq.operators import annotate, classify, cluster, filters, intervals, spanning, stats
from lociq.plans.config import RunConfig
from lociq.plans.storage import Stages, materialise
from lociq.sources import reads as io
from lociq.sources.tables import number


def build_annotation(gtfs: list[tuple[DataFrame, str | None]]) -> DataFrame:
    """Transcripts of several GTF tables, isoforms with the same introns in a cluster merged, numbered by chromosome and start."""
    every = None
    for i, (gtf, source) in enumerate(gtfs):
        t = io.gtf_transcripts(gtf, source).withColumn("tx_id", F.col("tx_id") * len(gtfs) + i)
        every = t if every is None else every.unionByName(t)
    exons = every.select("chrom", "strand", "tx_id", F.explode("exons").alias("x")).select("chrom", "strand", "tx_id", F.col("x.start").alias("s"), F.col("x.end").alias("e"))
    comps = cluster.transcript_clusters(exons, ["chrom", "strand"])
    spot = every.join(comps, "tx_id")
    first = F.min(F.struct("chrom", "strand", "tx_start")).alias("first")
    order = spot.groupBy("component").agg(first).select("component", F.col("first.chrom").alias("chrom"), F.col("first.strand").alias("of"), F.col("first.tx_start").alias("at"))
    numbered = cluster.with_cluster_ids(order, "chrom", ["of", "at", "component"]).select("component", (F.col("cluster_id") + 1).cast("int").alias("cluster_id"))
    merged = cluster.merge_isoforms(spot.drop("cluster_id").join(numbered, "component"))
    return number(merged)


@dataclass
class Index:
    """Tables of an index: the genome in chunks, transcript sequences, transcripts, and the multi-hit bound."""

    genome: DataFrame
    sequences: DataFrame
    transcripts: DataFrame
    max_multihits: DataFrame


def build_index(genome: DataFrame, transcripts: DataFrame) -> Index:
    exons = transcripts.select("chrom", F.explode("exons").alias("x")).select("chrom", F.col("x.start").alias("s"), F.col("x.end").alias("e"))
    deepest = intervals.max_depth(exons, ["chrom"]).agg(F.max("depth").alias("max_multihits"))
    return Index(genome, io.transcript_sequences(transcripts, genome), transcripts, deepest)


def write_max_multihits(max_multihits: DataFrame, path: str) -> None:
    """The multi-hit bound as one line of text."""
    max_multihits.select(F.coalesce("max_multihits", F.lit(0)).cast("string").alias("value")).write.text(path)


def read_max_multihits(spark, path: str) -> int:
    return int(spark.read.text(path).first().value)


def insert_sizes(genomic: DataFrame, transcripts: DataFrame, config: RunConfig) -> DataFrame:
    """(isize, num_samples) from proper first mates wholly inside long unambiguous exons, max_isize_samples at most; a normal prior where too few are found."""
    ex = transcripts.select(F.col("chrom").alias("rname"), "strand", F.explode("exons").alias("x")).select("rname", "strand", F.col("x.start").alias("s"), F.col("x.end").alias("e"))
    alone = intervals.unambiguous(ex, ["rname"], shape=["strand"], min_length=config.max_isize)
    f = F.col("flag")
    clean = genomic.filter(io.has_flag(f, "proper") & ~io.has_flag(f, "second") & ~io.has_flag(f, "unmapped") & ~io.has_flag(f, "qc_fail") & (F.coalesce("nh", F.lit(1)) <= 1) & ~F.exists("cigar", lambda x: x["op"].isin(3, 4, 5, 6)))
    sized = clean.select("rname", F.least("pos", "pnext").alias("s2"), (F.least("pos", "pnext") + F.abs("tlen")).alias("e2"), F.abs("tlen").alias("isize"), "qname")
    inside = intervals.overlap_join(alone, sized, ["rname"]).filter("s2 >= s and e2 <= e").select("qname", "isize").distinct()
    inside = stats.cap_samples(inside.filter(F.col("isize").between(config.min_isize, config.max_isize)), config.max_isize_samples, ["qname", "isize"])
    hist = materialise(stats.histogram(inside, "isize", config.min_isize, config.max_isize).select(F.col("isize").cast("int").alias("isize"), F.col("n").alias("num_samples")), "isizes")
    if (hist.agg(F.sum("num_samples")).first()[0] or 0) >= config.min_isize_samples:
        return hist
    from lociq.operators.simulate import random_sizes

    prior = random_sizes(genomic.sparkSession, 100_000, config.isize_mean, config.isize_sd, config.min_isize, config.max_isize)
    return stats.histogram(prior, "isize", config.min_isize, config.max_isize).select(F.col("isize").cast("int").alias("isize"), F.col("n").alias("num_samples"))


def segment_length(sizes: DataFrame, trimmed: int) -> int:
    p5 = stats.value_at_percentile(sizes.withColumnRenamed("num_samples", "n"), "isize", [5.0]).first()
    return sequence.segment_length(float(p5.isize), trimmed)


def to_genome(alignments: DataFrame, transcripts: DataFrame, library: str = classify.UNSTRANDED) -> DataFrame:
    """Transcript alignments (rname is a tx_id) on the genome: place, CIGAR, strand, sequence, quality and MD; equal places of a mate once, with nh."""
    t = transcripts.select(F.col("tx_id").cast("string").alias("tx"), "chrom", F.col("strand").alias("tx_strand"), "exons", F.col("cluster_id").alias("gene"))
    a = alignments.join(t, alignments.rname == t.tx)
    minus, rev = F.col("tx_strand") == "-", io.has_flag(F.col("flag"), "reverse")
    placed = a.withColumns({
        "g_pos": cigar.genome_start(F.col("exons"), F.col("tx_strand"), F.col("pos"), F.col("cigar")),
        "g_cigar": cigar.genome_ops(F.col("exons"), F.col("tx_strand"), F.col("pos"), F.col("cigar")),
        "g_reverse": rev != minus,
        "xs": classify.strand(rev != minus, F.col("mate"), F.col("tx_strand"), library),
        "seq": F.when(minus, sequence.reverse_complement(F.col("seq"))).otherwise(F.col("seq")),
        "qual": F.when(minus, F.reverse("qual")).otherwise(F.col("qual")),
        "md": F.when(minus, sequence.md_reverse_complement(F.col("md"))).otherwise(F.col("md")),
    })
    flat = placed.select("qname", "mate", "tx", "gene", F.col("chrom").alias("rname"), F.col("g_pos").alias("pos"), F.col("g_cigar").alias("cigar"), cigar.reference_end(F.col("g_pos"), F.col("g_cigar")).alias("end"), F.col("g_reverse").alias("reverse"), "xs", "seq", "qual", "md", "as_score")
    return classify.dedupe_with_count(flat, ["qname", "mate"], ["rname", "pos", "end"], F.col("tx"))


def routed(alignments: DataFrame, transcripts: DataFrame, config: RunConfig) -> DataFrame:
    """(qname, route) of every fragment: multimap, unmapped, unpaired, paired, discordant or unresolved."""
    hits = classify.distinct_hits(alignments.withColumn("un", io.has_flag(F.col("flag"), "unmapped")), ["qname", "mate"], ["rname", "pos", "end"], "un")
    kinds = classify.route(hits, "qname", max_hits=config.max_multihits)
    tiers = tiers_of(alignments, transcripts).select("qname", "tier").distinct()
    named = F.when(F.col("route") != "mapped", F.col("route")).when(F.col("tier") <= 3, "paired").when(F.col("tier") == 4, "discordant").otherwise("unresolved")
    return kinds.join(tiers, "qname", "left").select("qname", named.alias("route"))


def tiers_of(alignments: DataFrame, transcripts: DataFrame) -> DataFrame:
    gene = transcripts.select(F.col("tx_id").cast("string").alias("rname"), F.col("cluster_id").alias("gene"))
    mapped = alignments.filter(~io.has_flag(F.col("flag"), "unmapped")).join(gene, "rname").select("qname", "mate", F.col("rname").alias("tx"), "gene", io.has_flag(F.col("flag"), "reverse").alias("rev"))
    return classify.tiered_pairs(mapped, "qname", "tx", "gene", "rev")


def discordant_clusters(discordant: DataFrame, unpaired: DataFrame, concordant: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clusters, members) of genome alignments: qname, rname, pos, end, xs, orient, cigar.

    A cluster's exons are the islands of its members' aligned blocks; it counts the concordant
    fragments past its boundary and lists the unpaired ones it overlaps.
    """
    keys = ["rname", "strand", "orient"]
    r = discordant.select("qname", "rname", F.col("pos").alias("s"), F.col("end").alias("e"), F.col("xs").alias("strand"), "orient", "pos", "cigar")
    labelled = intervals.label_islands(r, keys)
    spans = labelled.groupBy(*keys, "island_start", "island_end").agg(F.array_sort(F.collect_list("qname")).alias("qnames"))
    clusters = materialise(cluster.with_cluster_ids(spans, "rname", ["island_start", "strand", "orient"]).withColumn("cluster_id", F.col("cluster_id").cast("int")), "clusters")
    ids = clusters.select(*keys, "island_start", "cluster_id")
    members = labelled.join(ids, [*keys, "island_start"])
    parts = members.select("cluster_id", F.explode(cigar.blocks(F.col("pos"), F.col("cigar"))).alias("b")).select("cluster_id", F.col("b.start").alias("s"), F.col("b.end").alias("e"))
    exons = intervals.islands(parts, ["cluster_id"]).groupBy("cluster_id").agg(F.array_sort(F.collect_list(F.struct(F.col("island_start").cast("int").alias("start"), F.col("island_end").cast("int").alias("end")))).alias("exons"))
    c = clusters.select("cluster_id", *keys, F.col("island_start").alias("s"), F.col("island_end").alias("e"))
    frags = concordant.select("rname", F.col("pos").alias("s2"), F.col("end").alias("e2"), F.col("qname").alias("frag2"), "mate_pos")
    evidence = cluster.concordant_evidence(c, frags, ["rname"]).select("cluster_id", F.col("frags").cast("int").alias("concordant_frags"))
    lone = unpaired.select("rname", F.col("xs").alias("strand"), "orient", F.col("pos").alias("s2"), F.col("end").alias("e2"), F.col("qname").alias("u"))
    lonely = intervals.overlap_join(c, lone, keys).groupBy("cluster_id").agg(F.array_sort(F.collect_set("u")).alias("unpaired_qnames"))
    none = F.array().cast("array<string>")
    out = clusters.join(exons, "cluster_id").join(evidence, "cluster_id").join(lonely, "cluster_id", "left")
    return out.select("rname", F.col("island_start").cast("int").alias("start"), F.col("island_end").cast("int").alias("end"), "cluster_id", "strand", F.col("orient").cast("int").alias("orientation"), "exons", "concordant_frags", "qnames", F.coalesce("unpaired_qnames", none).alias("unpaired_qnames")), members.select("qname", "cluster_id", "orient")


def discover(discordant: DataFrame, unpaired: DataFrame, concordant: DataFrame, transcripts: DataFrame, config: RunConfig, split: DataFrame | Callable[[DataFrame, DataFrame], DataFrame] | None = None, *, stages: Stages | None = None, inputs: tuple[str, ...] = ()) -> DataFrame:
    """Chimera rows that pass the final filter, from genome alignments by kind and, if there are any, split alignments over pairs.

    ``split`` may be a function that makes them of the pairs and clusters. With ``stages`` the clusters, their members, the pairs and the chimeras are kept as its stages,
    which depend on ``inputs`` (paths and earlier stages) and the settings.
    """
    settings = {"config": config.to_xml()}

    def keep(name: str, build, *before: str) -> DataFrame:
        return stages.table(name, build, inputs=[*inputs, *before], settings=settings) if stages else build()

    made: list[tuple[DataFrame, DataFrame]] = []

    def both(part: int) -> DataFrame:
        if not made:
            made.append(discordant_clusters(discordant, unpaired, concordant))
        return made[0][part]

    clusters, members = keep("clusters", lambda: both(0)), keep("members", lambda: both(1))
    numbered = lambda: cluster.with_pair_ids(cluster.pair_clusters(members, "qname", "cluster_id", "orient")).withColumn("pair_id", F.col("pair_id").cast("int"))
    pairs = keep("pairs", numbered, "members")
    spot = lambda p: clusters.select(F.col("cluster_id").alias(f"id{p}"), F.col("rname").alias(f"rname{p}"), F.col("start").alias(f"start{p}"), F.col("end").alias(f"end{p}"))
    if callable(split):
        split = keep("split", lambda make=split: make(pairs, clusters), "clusters", "pairs")
    if split is not None:
        pairs = spanning.with_spanning(pairs, spanning.split_reads(split, pairs.join(spot("5p"), "id5p").join(spot("3p"), "id3p").drop("qnames", "id5p", "id3p"), anchor=config.anchor))
    else:
        pairs = pairs.withColumn("spanning_qnames", F.array().cast("array<string>"))
    chimeras = keep("chimeras", lambda: annotate.annotate(pairs, clusters, transcripts, source=config.source), "clusters", "pairs", *(["split"] if stages and "split" in stages.keys else []))
    return filters.final_filter(chimeras, min_frags=config.min_frags, min_fraction=config.min_fraction, mask_biotypes=config.mask_biotypes, mask_rnames=config.mask_rnames)


def breakpoint_reads(pairs: DataFrame, members: DataFrame, mates: DataFrame) -> DataFrame:
    """Reads to realign over each pair: its members and their clusters' unmapped mates, named pair:qname.

    members: qname, seq, qual. mates: qname, cluster_id, seq, qual.
    """
    read = ["qname", "seq", "qual"]
    of = pairs.select("pair_id", F.explode("qnames").alias("qname")).join(members, "qname").select("pair_id", *read)
    sides = pairs.select("pair_id", F.explode(F.array("id5p", "id3p")).alias("cluster_id")).distinct()
    # a mate of one cluster that is no member meets a pair once, so only the others' rows have to be made distinct
    places = mates.select(*read, "cluster_id").distinct().withColumn("_mate", F.lit(True))
    both = places.unionByName(members.select(*read).distinct().withColumn("_mate", F.lit(False)), allowMissingColumns=True)
    counted = both.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*read))).filter("_mate").drop("_mate")
    met = lambda some: sides.join(counted.filter(some).drop("_n"), "cluster_id").select("pair_id", *read)
    every = met("_n = 1").unionByName(of.unionByName(met("_n > 1")).distinct())
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    return every.select(F.concat(told("pair_id"), F.lit(":"), told("qname")).alias("qname"), "seq", "qual")


def rename_references(df: DataFrame, names: DataFrame, column: str) -> DataFrame:
    """Rows with their reference renamed; rows whose name isn't listed are left out. names: old, new."""
    return df.join(names, df[column] == names.old).withColumn(column, F.col("new")).drop("old", "new")


def discordance_rate(discordant: int, mapped: int, n: F.col) -> F.col:
    """Discordant reads to expect among n."""
    return n * (discordant / mapped)
