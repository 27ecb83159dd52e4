import itertools
import random

from pyspark.sql import functions as F

from lociq.functions.sequence import reverse_complement
from lociq.operators import align, classify, cluster, nominate, simulate, spanning
from lociq.plans import discovery, report
from lociq.plans.config import RunConfig
from lociq.sources.tables import TRANSCRIPTS
from lociq.streaming.sessions import stream_loci


def transcripts(spark):
    rows = [("chr1", 100, 300, 1, 0, "+", 2, [(100, 150), (250, 300)], "pc", ["T1"], ["A"], ["ensembl"]), ("chr1", 1000, 1200, 2, 1, "+", 1, [(1000, 1200)], "pc", ["T2"], ["B"], ["ensembl"]), ("chr1", 500, 600, 3, 2, "+", 1, [(500, 600)], "na", ["T3"], ["C"], ["other"]), ("chr2", 10, 90, 4, 3, "-", 1, [(10, 90)], "pc", ["T4"], ["D"], ["ensembl"])]
    return spark.createDataFrame(rows, TRANSCRIPTS)


def test_discovery_from_genome_alignments(spark):
    a = "qname string, rname string, pos int, end int, xs string, orient int, cigar array<struct<op:int,len:int>>"
    m = lambda n: [(0, n)]
    disc = spark.createDataFrame([(f"f{i}", "chr1", 260 + i, 290 + i, "+", 1, m(30)) for i in range(3)] + [(f"f{i}", "chr1", 1010 + i, 1040 + i, "+", 2, m(30)) for i in range(3)], a)
    un = spark.createDataFrame([("u", "chr1", 270, 300, "+", 1, m(30))], a)
    conc = spark.createDataFrame([("c", "chr1", 280, 310, 400)], "qname string, rname string, pos int, end int, mate_pos int")
    out = discovery.discover(disc, un, conc, transcripts(spark), RunConfig())
    r = out.first()
    assert out.count() == 1
    assert (r.rname5p, r.start5p, r.end5p, r.start3p, r.end3p, r.chimera_id, r.num_frags) == ("chr1", 260, 292, 1010, 1042, "CHIMERA0", 3)
    assert (r.chimera_type, r.distance, r.genes_5p, r.genes_3p, r.num_concordant_frags_5p) == ("Intrachromosomal", 1010 - 292, ["A"], ["B"], 1)
    page = "".join(report.lines(out))
    assert "CHIMERA0" in page
    assert discovery.discover(disc.filter("false"), un, conc, transcripts(spark), RunConfig()).count() == 0


def test_to_genome_and_dedupe(spark):
    ddl = "qname string, mate int, flag int, rname string, pos int, cigar array<struct<op:int,len:int>>, seq string, qual string, md string, as_score int"
    rows = [("q", 1, 0, "1", 40, [(0, 20)], "ACGTACGTACGTACGTACGT", "I" * 20, "20", 5), ("q", 2, 16, "4", 0, [(0, 5)], "AACCG", "abcde", "5", 5)]
    got = {r.mate: r for r in discovery.to_genome(spark.createDataFrame(rows, ddl), transcripts(spark)).collect()}
    assert (got[1].pos, [tuple(x) for x in got[1].cigar], got[1].end) == (140, [(0, 10), (3, 100), (0, 10)], 260)
    assert (got[2].pos, got[2].seq, got[2].qual, got[2].reverse, got[2].xs, got[2].nh) == (85, "CGGTT", "edcba", False, "-", 1)


def test_annotation_build(spark):
    ddl = "seqid string, source string, feature_type string, start int, end int, score double, strand string, phase string, attrs map<string,string>"
    row = lambda t, s, e, g="G": ("chr1", "x", "exon", s, e, 0.0, "+", ".", {"transcript_id": t, "gene_name": g})
    gtf = spark.createDataFrame([row("a", 0, 10), row("a", 20, 30), row("b", 5, 10), row("b", 20, 40), row("c", 100, 120), row("d", 35, 50)], ddl)
    out = discovery.build_annotation([(gtf, "ensembl")]).orderBy("tx_id").collect()
    assert [(r.tx_start, r.tx_end, sorted(r.tx_names)) for r in out] == [(0, 40, ["a", "b"]), (35, 50, ["d"]), (100, 120, ["c"])]
    assert out[0].cluster_id == out[1].cluster_id != out[2].cluster_id


def test_tiers_prefer_the_same_transcript(spark):
    rows = [("f", 1, "t1", "g1", False), ("f", 2, "t1", "g1", True), ("f", 2, "t2", "g1", True), ("h", 1, "t1", "g1", False), ("h", 2, "t9", "g9", True)]
    got = classify.tiered_pairs(spark.createDataFrame(rows, "frag string, mate int, tx string, gene string, rev boolean"), "frag", "tx", "gene", "rev").collect()
    assert sorted((r.frag, r.tx_2, r.tier) for r in got) == [("f", "t1", 0), ("h", "t9", 4)]


def test_spanning(spark):
    pairs = spark.createDataFrame([(0, "c1", 0, 50, "c2", 100, 150), (1, "c1", 0, 50, "c2", 500, 550)], "pair_id int, rname5p string, start5p int, end5p int, rname3p string, start3p int, end3p int")
    a = spark.createDataFrame([(0, "q", "c1", 10, 30, 0, 20, 20), (0, "q", "c2", 110, 130, 20, 40, 20), (0, "q", "c2", 120, 125, 0, 5, 5)], "pair_id int, qname string, rname string, s int, e int, q_start int, q_end int, score int")
    split = spanning.split_reads(a, pairs)
    assert [(r.qname, r.score) for r in split.collect()] == [("q", 40)]
    got = {r.pair_id: r.spanning_qnames for r in spanning.with_spanning(pairs.select("pair_id"), split).collect()}
    assert got == {0: ["q"], 1: []}


def test_aligner_finds_simulated_reads(spark):
    rng = random.Random(3)
    refs = spark.createDataFrame([(i, "".join(rng.choice("ACGT") for _ in range(400)), 500.0, 200) for i in range(4)], "tx_id long, seq string, fpkm double, breakpoint int")
    sim = simulate.simulate(refs, total=200_000, mean=150, sd=15, read_length=40).withColumn("read_id", F.col("name")).cache()
    assert sim.count() > 100
    assert {r[0] for r in sim.select(F.element_at(F.split("name", ":"), -1)).distinct().collect()} <= {"SPAN", "R1B", "R2B", "NONE"}
    hits = align.align(sim.select("read_id", F.col("seq1").alias("seq")), refs.select(F.col("tx_id").alias("ref_id"), "seq"), k=10)
    good = hits.join(sim, "read_id").filter(F.split("name", ":")[0].cast("long") == F.col("ref_id")).select("read_id").distinct().count()
    assert good == sim.count()
    assert sim.filter(F.length("seq2") != 40).count() == 0
    assert spark.range(1).select(reverse_complement(F.lit("AC"))).first()[0] == "GT"


def test_names_and_pair_ids(spark):
    df = spark.createDataFrame([("ACGT", 1), ("ACGT", 2), ("AAAA", 3)], "seq string, member int")
    assert [(r.name, r.members) for r in nominate.name_sequences(df, "seq").orderBy("name").collect()] == [("B0000000", [3]), ("B0000001", [1, 2])]
    pairs = spark.createDataFrame([(10, 1), (2, 1), (10, 0)], "id5p int, id3p int")
    assert [(r.id5p, r.id3p) for r in cluster.with_pair_ids(pairs).orderBy("pair_id").collect()] == [(10, 0), (10, 1), (2, 1)]


def test_session_loci(spark):
    df = spark.createDataFrame([("c", 0, 10), ("c", 10, 5), ("c", 40, 5)], "rname string, p int, length int").withColumn("at", F.timestamp_seconds("p"))
    got = stream_loci(df, keys=["rname"]).select(F.unix_timestamp("start").alias("s"), F.unix_timestamp("end").alias("e"), "reads").collect()
    assert sorted(map(tuple, got)) == [(0, 15, 2), (40, 45, 1)]


def test_ranking_by_an_interpolated_histogram(spark):
    import numpy as np

    from lociq.operators import legacy

    rng = random.Random(31)
    rows = [(i, float(rng.randrange(12)), rng.random() * 50, float(rng.randrange(3))) for i in range(300)]
    got = {r.i: r.prob for r in legacy.rank_by_histogram(spark.createDataFrame(rows, "i int, x double, y double, z double"), ("x", "y", "z"), 100, bins=9).collect()}
    data = np.array([r[1:] for r in rows])
    edges = [np.unique(np.percentile(data[:, 0], np.linspace(0, 100, 9))), np.unique(np.percentile(data[:, 1], np.linspace(0, 100, 9))), np.unique(data[:, 2])]
    for i, *v in rows:  # the cells below each corner around the candidate, weighed by how near it is
        share = 0.0
        at = [min(int(np.searchsorted(e, x)), len(e) - 1) for e, x in zip(edges, v, strict=True)]
        for corner in itertools.product((0, 1), repeat=3):
            weight, spot = 1.0, []
            for e, x, r, c in zip(edges, v, at, corner, strict=True):
                far = (e[r] - x) / (e[r] - e[r - 1]) if r else 0.0
                weight *= far if c else 1 - far
                spot.append(e[max(r - c, 0)])
            share += weight * np.mean((data <= np.array(spot)).all(axis=1))
        assert abs(got[i] - (1 - share)) < 1e-9
    moved = spark.createDataFrame([(i, x - 7, y + 100, z) for i, x, y, z in rows], "i int, x double, y double, z double")
    for r in legacy.rank_by_histogram(moved, ("x", "y", "z"), 100, bins=9).collect():  # figures count by their order and distances alone
        assert abs(r.prob - got[r.i]) < 1e-9
    best = legacy.rank_by_histogram(spark.createDataFrame(rows, "i int, x double, y double, z double"), ("x", "y", "z"), 10, bins=9).collect()
    assert {r.i for r in best} == {i for i, p in got.items() if p <= np.percentile(list(got.values()), 10) + 1e-12}
    assert legacy.rank_by_histogram(spark.createDataFrame([], "i int, x double, y double, z double"), ("x", "y", "z"), 10).count() == 0


def test_external_aligners_read_fastq_and_write_sam(spark):
    import sys

    script = "import sys\nrows = sys.stdin.read().split('\\n')\nprint('@HD\\tVN:1.6')\nfor i in range(0, len(rows) - 3, 4):\n    print(rows[i][1:], 0, 'c', i, 60, f'{len(rows[i + 1])}M', sep='\\t')"
    df = spark.createDataFrame([("a", "ACGT", "IIII"), ("b", "AC", "II"), ("c", "G", "I")], "qname string, seq string, qual string")
    got = align.pipe_aligner(df, [sys.executable, "-c", script], "qname string, flag string, rname string, pos string, mapq string, cigar string").collect()
    assert sorted((r.qname, r.cigar) for r in got) == [("a", "4M"), ("b", "2M"), ("c", "1M")]
    assert align.pipe_aligner(df.filter("false"), ["no-such-aligner"], "qname string").count() == 0
