"""From FASTQ to a fusion: a made genome, its transcripts, reads of a fused one, in one plan that resumes."""

import random

import pytest
from pyspark.sql import functions as F

from lociq.plans import discovery, run
from lociq.plans.config import RunConfig
from lociq.sources import reads as io
from lociq.sources.tables import TRANSCRIPTS


def turned(s):
    return s[::-1].translate(str.maketrans("ACGT", "TGCA"))


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("run")
    rnd = random.Random(12)
    genome = {c: "".join(rnd.choice("ACGT") for _ in range(9000)) for c in ("chr1", "chr2")}
    (at / "genome.fa").write_text("".join(f">{c}\n" + "\n".join(s[i : i + 60] for i in range(0, len(s), 60)) + "\n" for c, s in genome.items()))
    genes = [("chr1", "+", [(500, 800), (1000, 1250), (1500, 1900)]), ("chr1", "-", [(4000, 4300), (4600, 5000)]), ("chr2", "-", [(2000, 2350), (2600, 2900), (3200, 3500)]), ("chr2", "+", [(6000, 6700)])]
    rows, seqs = [], []
    for i, (c, strand, exons) in enumerate(genes):
        rows.append((c, exons[0][0], exons[-1][1], i + 1, i, strand, len(exons), exons, "pc", [f"T{i}"], [f"G{i}"], ["ensembl"]))
        s = "".join(genome[c][a:b] for a, b in exons)
        seqs.append(turned(s) if strand == "-" else s)
    # an isoform of gene 0
    rows.append(("chr1", 500, 1250, 9, 0, "+", 2, [(500, 800), (1000, 1250)], "pc", ["T0b"], ["G0"], ["ensembl"]))
    fused = seqs[0][:550] + seqs[2][300:]  # exons 1 and 2 of gene 0, exons 2 and 3 of gene 2, which lies on the minus strand
    first, second = [], []
    for name, s, n in [*((f"g{i}", s, 60) for i, s in enumerate(seqs)), ("fused", fused, 120)]:
        for k in range(n):
            size = rnd.randrange(140, 220)
            p = rnd.randrange(len(s) - size)
            pair = [s[p : p + 50], turned(s[p + size - 50 : p + size])]
            if rnd.random() < 0.5:
                pair.reverse()
            for out, m, seq in ((first, 1, pair[0]), (second, 2, pair[1])):
                seq = list(seq)
                if rnd.random() < 0.2:
                    seq[rnd.randrange(50)] = rnd.choice("ACGT")
                out.append(f"@{name}.{k}:{p}/{m}\n{''.join(seq)}\n+\n{'I' * 50}\n")
    (at / "r_1.fq").write_text("".join(first))
    (at / "r_2.fq").write_text("".join(second))
    transcripts = spark.createDataFrame(rows, TRANSCRIPTS)
    index = discovery.build_index(io.read_fasta(spark, str(at / "genome.fa")), transcripts)
    return at, index


def test_reads_of_a_fused_transcript_give_its_fusion(spark, made):
    at, index = made
    config = RunConfig(reads1=str(at / "r_1.fq"), reads2=str(at / "r_2.fq"), segment_length=25, min_frags=3)
    out = run.run(spark, config, index, folder=str(at / "stages"))
    found = out.collect()
    assert [(r.genes_5p, r.genes_3p, r.strand5p, r.strand3p) for r in found] == [(["G0"], ["G2"], "+", "-")]
    r = found[0]
    assert r.num_discordant_frags >= 10 and r.num_spanning_frags >= 3 and r.chimera_type == "Interchromosomal"
    # a read may go two bases past the break and still be placed on the next exon
    assert (r.rname5p, r.rname3p) == ("chr1", "chr2") and 500 <= r.start5p < r.end5p <= 1502 and 2000 <= r.start3p < r.end3p <= 2902
    # a second run reads what the first has written
    before = {p.name: sorted(x.name for x in p.iterdir()) for p in (at / "stages").iterdir()}
    assert run.run(spark, config, index, folder=str(at / "stages")).collect() == found
    assert {p.name: sorted(x.name for x in p.iterdir()) for p in (at / "stages").iterdir()} == before


def test_every_fragment_goes_one_way(spark, made):
    at, index = made
    config = RunConfig(reads1=str(at / "r_1.fq"), reads2=str(at / "r_2.fq"), max_multihits=2)
    reads = io.read_pairs(spark, config.reads1, config.reads2).select(F.col("frag_id").cast("string").alias("qname"), "mate", "seq", "qual")
    alignments = run.align_reads(reads, index.sequences, segment=25)
    told = {r.route: (r.n, r.share) for r in run.fraction_of_kinds(alignments, index.transcripts, config).collect()}
    assert sum(n for n, _ in told.values()) == 360 and abs(sum(s for _, s in told.values()) - 1) < 1e-9
    assert told["paired"][0] >= 240 and told["discordant"][0] >= 20


def test_wrong_settings_stop_a_run(spark, made, tmp_path):
    _, index = made
    with pytest.raises(ValueError, match="isn't there"):
        run.run(spark, RunConfig(reads1=str(tmp_path / "no_1.fq"), reads2=str(tmp_path / "no_2.fq")), index)
