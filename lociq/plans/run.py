"""From read files to chimeras in one plan: alignment, routing, places on the genome, clusters, reads over breakpoints, report."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lociq.functions import cigar
from lociq.operators import align, annotate, classify, mates
from lociq.plans import discovery
from lociq.plans.config import RunConfig
from lociq.plans.storage import Stages, materialise, scratch_path
from lociq.sources import reads as io

#: Places of a read on transcripts that are looked at; isoforms are places of their own.
MOST_PLACES = 200
_OPS = "array<struct<op:int,len:int>>"


def align_reads(reads: DataFrame, sequences: DataFrame, *, max_mismatches: int = 2, segment: int | None = None) -> DataFrame:
    """Alignments of mates on transcripts, as rows that routing takes; a mate without any has an unmapped row.

    reads: qname, mate, seq, qual. sequences: tx_id, seq. Whole reads are aligned first; of those
    that lie nowhere the first ``segment`` bases are, and the rest becomes a soft clip. A mate keeps its
    places with the fewest mismatches. What is found is written to the shared folder. Columns: qname, mate, flag, rname (the transcript's id as
    text), pos, end, cigar, seq, qual, md (null), as_score (0 less mismatches), nh.
    """
    refs = sequences.select(F.col("tx_id").cast("string").alias("ref_id"), "seq")
    named = reads.select("qname", "mate", "seq", "qual").withColumn("read_id", F.concat_ws("/", "qname", "mate"))

    def placed(asked: DataFrame) -> DataFrame:
        hits = align.align(asked.select("read_id", "seq"), refs, max_mismatches=max_mismatches, max_hits=MOST_PLACES)
        best = classify.best_with_ties(hits, ["read_id"], F.col("mismatches"))
        met = best.join(asked, "read_id")
        back = F.col("strand") == "-"
        flag = F.when(F.col("mate") == 1, 65).otherwise(129) + F.when(back, 16).otherwise(0)
        turned = lambda c, f: F.when(back, f(F.col(c))).otherwise(F.col(c)).alias(c)
        return met.select(
            "qname", "mate", flag.alias("flag"), F.col("ref_id").alias("rname"), F.col("pos").cast("int").alias("pos"), F.array(F.struct(F.lit(0).alias("op"), F.length("seq").alias("len"))).cast(_OPS).alias("cigar"),
            turned("seq", lambda c: mates.reverse_complement(c)), turned("qual", F.reverse), F.lit(None).cast("string").alias("md"), (-F.col("mismatches")).alias("as_score"),
        )

    found = materialise(placed(named), "aligned")  # what follows asks three times what was found
    if segment:
        lost = named.join(found.select("qname", "mate").distinct(), ["qname", "mate"], "left_anti")
        short = lost.filter(F.length("seq") > segment).withColumns({c: F.substring(c, 1, segment) for c in ("seq", "qual")})
        found = found.unionByName(materialise(mates.restore_full_reads(placed(short), reads), "aligned"))
    whole = found.withColumn("end", cigar.reference_end(F.col("pos"), F.col("cigar")))
    nowhere = named.join(found.select("qname", "mate").distinct(), ["qname", "mate"], "left_anti")
    unmapped = nowhere.select("qname", "mate", F.when(F.col("mate") == 1, 69).otherwise(133).alias("flag"), F.lit(None).cast("string").alias("rname"), F.lit(-1).alias("pos"), F.array().cast(_OPS).alias("cigar"), "seq", "qual", F.lit(None).cast("string").alias("md"), F.lit(None).cast("int").alias("as_score"), F.lit(None).cast("int").alias("end"))
    return whole.unionByName(unmapped.select(*whole.columns))


def with_orientation(genomic: DataFrame, library: str) -> DataFrame:
    """Adds orient to rows of ``discovery.to_genome``: which side of a fusion a read lies on, from its strand against its transcript's."""
    against = F.col("reverse") != (F.col("xs") == "-")
    return genomic.withColumn("orient", classify.orientation(against, F.col("mate"), library))


def by_kind(alignments: DataFrame, transcripts: DataFrame, config: RunConfig) -> dict[str, DataFrame]:
    """Genome alignments of fragments by kind: discordant, unpaired and concordant, as ``discovery.discover`` takes them."""
    routes = discovery.routed(alignments, transcripts, config)
    genomic = with_orientation(discovery.to_genome(alignments.filter("rname is not null"), transcripts, config.library), config.library)
    of = lambda route: genomic.join(routes.filter(F.col("route") == route).select("qname"), "qname", "left_semi")
    paired = of("paired")
    other = paired.groupBy("qname", (3 - F.col("mate")).alias("mate"), "rname").agg(F.min("pos").alias("mate_pos"))
    return {"discordant": of("discordant"), "unpaired": of("unpaired"), "concordant": paired.join(other, ["qname", "mate", "rname"]).select("rname", "pos", "end", "qname", "mate_pos")}


def split_alignments(pairs: DataFrame, clusters: DataFrame, members: DataFrame, lone: DataFrame, transcripts: DataFrame, sequences: DataFrame, anchor: int) -> DataFrame:
    """Local alignments of a pair's reads on the transcripts of its two clusters, in genome places, as ``spanning.split_reads`` takes them.

    members: qname, seq, qual of discordant reads. lone: qname, cluster_id, seq, qual of unmapped mates of reads on a cluster.
    """
    asked = discovery.breakpoint_reads(pairs, members, lone).withColumn("read_id", F.col("qname"))
    tx = transcripts.select(F.col("chrom").alias("rname"), "strand", F.col("tx_start").alias("s2"), F.col("tx_end").alias("e2"), "tx_id")
    on = annotate.lookup_transcripts(clusters.select("cluster_id", "rname", "strand", F.col("start").alias("s"), F.col("end").alias("e")), tx).select("cluster_id", "tx_id")
    sides = pairs.select("pair_id", F.explode(F.array("id5p", "id3p")).alias("cluster_id")).join(on, "cluster_id").select("pair_id", F.col("tx_id").cast("string").alias("ref_id")).distinct()
    refs = sequences.select(F.col("tx_id").cast("string").alias("ref_id"), "seq").join(sides.select("ref_id").distinct(), "ref_id", "left_semi")
    hits = align.local_align(asked.select("read_id", "seq"), refs, anchor=anchor)
    hits = hits.withColumn("pair_id", F.split("read_id", ":", 2)[0].cast("int")).join(sides, ["pair_id", "ref_id"])
    at = transcripts.select(F.col("tx_id").cast("string").alias("ref_id"), F.col("chrom").alias("rname"), F.col("strand").alias("tx_strand"), "exons")
    met = hits.join(at, "ref_id").join(asked.select("read_id", F.length("seq").alias("n")).distinct(), "read_id")
    ops = F.filter(cigar.parse(F.col("cigar")), lambda x: x["op"] != 4)
    spots = met.withColumns({"g": cigar.genome_start(F.col("exons"), F.col("tx_strand"), F.col("ref_start"), ops), "ops": cigar.genome_ops(F.col("exons"), F.col("tx_strand"), F.col("ref_start"), ops)})
    back = F.col("strand") == "-"
    return spots.select(
        "pair_id", F.split("read_id", ":", 2)[1].alias("qname"), "rname", F.col("g").alias("s"), cigar.reference_end(F.col("g"), F.col("ops")).alias("e"),
        F.when(back, F.col("n") - F.col("read_end")).otherwise(F.col("read_start")).alias("q_start"), F.when(back, F.col("n") - F.col("read_start")).otherwise(F.col("read_end")).alias("q_end"), "score",
    ).distinct()


def run(spark: SparkSession, config: RunConfig, index: discovery.Index, *, folder: str | None = None, aligner: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Chimera rows of the pair of read files that the settings name.

    ``aligner`` takes reads (qname, mate, seq, qual) and gives rows as ``align_reads`` does, where an
    external program is to place them; the library's own aligner does so otherwise. Stages are kept
    in ``folder`` (a scratch folder by default) and taken up by the next run with it, as long as read files
    and settings are the same. A setting or file that is wrong is an error before any work.
    """
    if wrong := config.problems(spark=spark):
        raise ValueError("; ".join(wrong))
    stages = Stages(spark, folder or scratch_path(spark, "run"))
    files, settings = [config.reads1, config.reads2], {"config": config.to_xml()}
    keep = lambda name, build, *before: stages.table(name, build, inputs=[*(before or files)], settings=settings)
    read = lambda: io.read_pairs(spark, config.reads1, config.reads2, quality=None if config.quality == "sanger" else config.quality, trim5=config.trim5, trim3=config.trim3)
    reads = keep("reads", lambda: read().select(F.col("frag_id").cast("string").alias("qname"), "mate", "seq", "qual"))
    transcripts = keep("transcripts", lambda: index.transcripts, "reads")
    sequences = keep("sequences", lambda: index.sequences, "reads")
    segment = config.segment_length
    place = aligner or (lambda x: align_reads(x, sequences, segment=segment))
    alignments = keep("alignments", lambda: place(reads), "reads", "sequences")
    deepest = index.max_multihits.first()[0] or 0
    config = RunConfig(**(vars(config) | {"max_multihits": max(config.max_multihits, deepest)}))
    kinds: dict[str, DataFrame] = {}

    def kind(name: str) -> DataFrame:
        if not kinds:
            kinds.update(by_kind(alignments, transcripts, config))
        return kinds[name]

    discordant, unpaired, concordant = (keep(k, lambda k=k: kind(k), "alignments", "transcripts") for k in ("discordant", "unpaired", "concordant"))

    def split(pairs: DataFrame, clusters: DataFrame) -> DataFrame:
        seqs = discordant.select("qname", "mate").distinct().join(reads, ["qname", "mate"]).select("qname", "seq", "qual")
        alone = clusters.select("cluster_id", F.explode("unpaired_qnames").alias("qname")).join(unpaired.select("qname", (3 - F.col("mate")).alias("mate")).distinct(), "qname")
        return split_alignments(pairs, clusters, seqs, alone.join(reads, ["qname", "mate"]).select("qname", "cluster_id", "seq", "qual"), transcripts, sequences, config.anchor)

    return discovery.discover(discordant, unpaired, concordant, transcripts, config, split, stages=stages, inputs=("discordant", "unpaired", "concordant", "transcripts"))


def fraction_of_kinds(alignments: DataFrame, transcripts: DataFrame, config: RunConfig) -> DataFrame:
    """(route, n, share): how many fragments went which way."""
    counts = discovery.routed(alignments, transcripts, config).groupBy("route").agg(F.count(F.lit(1)).alias("n"))
    total: Column = F.sum("n")
    return counts.crossJoin(F.broadcast(counts.agg(total.alias("of")))).select("route", "n", (F.col("n") / F.col("of")).alias("share"))
