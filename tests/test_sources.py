import gzip
import os

from pyspark.sql import functions as F

from lociq.plans.config import RunConfig
from lociq.sources import reads, tables


def text_of(path):
    return "".join(p.read_text() for p in sorted(path.glob("part-*"))).strip("\n")


def test_fastq_round_trip(spark, tmp_path):
    (tmp_path / "a_1.fq").write_text("@r1/1 x\nACGT\n+\nhhhh\n@r2/1\nAAAA\n+\nIIII\n@cut/1\nAC\n")
    with gzip.open(tmp_path / "a_2.fq.gz", "wt") as f:
        f.write("@r1 2:N:0\nTTTT\n+\nhhhh\n@r2 2:N:0\nGGGG\n+\nIIII\n")
    got = reads.read_pairs(spark, str(tmp_path / "a_1.fq"), str(tmp_path / "a_2.fq.gz"), quality="illumina", trim5=1).orderBy("frag_id", "mate").collect()
    assert [(r.frag_id, r.mate, r.qname, r.seq, r.qual) for r in got] == [(1, 1, "r1", "CGT", "III"), (1, 2, "r1", "TTT", "III"), (2, 1, "r2", "AAA", "***"), (2, 2, "r2", "GGG", "***")]
    df = reads.read_fastq(spark, str(tmp_path / "a_1.fq"))
    reads.write_fastq(df, str(tmp_path / "out"))
    assert text_of(tmp_path / "out").startswith("@1/1\nACGT\n+\nhhhh\n@2/1")
    assert reads.read_length(df) == 4
    assert [r.qname for r in reads.interleave(df, 2).collect()] == ["01", "02"]


def test_records_over_split_borders(spark, tmp_path):
    reads_ = [(f"r{i}", "ACGT" * (i % 7 + 1), "@" * (4 * (i % 7 + 1))) for i in range(400)]
    (tmp_path / "a.fq").write_text("".join(f"@{n}/1\n{s}\n+\n{q}\n" for n, s, q in reads_))
    genome = "".join("ACGT"[i * i % 4] + "N" for i in range(3000))
    (tmp_path / "g.fa").write_text(">a x\n" + "\n".join(genome[i : i + 60] for i in range(0, len(genome), 60)) + "\n>b\n\n>c\nAC\nGT\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        df = reads.read_fastq(spark, str(tmp_path / "a.fq"))
        assert df.rdd.getNumPartitions() > 3
        assert [(r.qname, r.seq, r.qual) for r in df.orderBy("frag_id").collect()] == reads_
        got = {(r.chrom, r.chunk): r.seq for r in reads.read_fasta(spark, str(tmp_path / "g.fa"), chunk=512).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])
    assert "".join(got["a", k] for k in range(12)) == genome and got["c", 0] == "ACGT" and got.get(("b", 0), "") == ""


def test_fasta_and_transcript_sequences(spark, tmp_path):
    (tmp_path / "g.fa").write_text(">chr1 words\nACGTACGTAC\nGGGGCCCC\n>chr2\nNNNNNNNNNN\n")
    genome = reads.read_fasta(spark, str(tmp_path / "g.fa"), chunk=4)
    assert sorted(map(tuple, reads.reference_lengths(genome).collect())) == [("chr1", 18), ("chr2", 10)]
    rows = [("chr1", 1, "+", [(0, 3), (9, 12)]), ("chr1", 2, "-", [(0, 3), (9, 12)]), ("chr1", 3, "+", [(15, 30)]), ("chr2", 4, "+", [(0, 5)])]
    t = spark.createDataFrame(rows, "chrom string, tx_id bigint, strand string, exons array<struct<start:int,end:int>>")
    got = {r.tx_id: r.seq for r in reads.transcript_sequences(t, genome, chunk=4).collect()}
    assert got == {1: "ACGCGG", 2: "CCGCGT"}


def test_sam(spark, tmp_path):
    (tmp_path / "a.sam").write_text("@HD\tVN:1\nq1\t99\tchr1\t11\t60\t3S5M\t=\t31\t25\tACGTACGT\tIIIIIIII\tNH:i:1\tMD:Z:5\nq2\t4\t*\t0\t0\t*\t*\t0\t0\tAC\tII\n")
    df = reads.read_sam(spark, str(tmp_path / "a.sam"))
    r = df.orderBy("qname").first()
    assert (r.pos, r.end, r.nh, r.md, r.rnext, r.mate) == (10, 15, 1, "5", "chr1", 1)
    reads.write_sam(df, str(tmp_path / "out"))
    again = reads.read_sam(spark, str(tmp_path / "out"))
    assert sorted(map(str, again.collect())) == sorted(map(str, df.collect()))


def test_gtf_to_transcripts(spark, tmp_path):
    line = 'chr1\tens\texon\t{}\t{}\t.\t+\t.\tgene_id "g"; transcript_id "{}"; gene_name "G"; gene_biotype "b";\n'
    (tmp_path / "a.gtf").write_text("#c\n\n" + line.format(11, 20, "t1") + line.format(31, 40, "t1") + line.format(5, 8, "t2"))
    gtf = reads.read_gtf(spark, str(tmp_path / "a.gtf"))
    t = reads.gtf_transcripts(gtf, "ensembl").orderBy("tx_start").collect()
    assert [(x.tx_start, x.tx_end, [tuple(e) for e in x.exons], x.tx_names, x.annotation_sources) for x in t] == [(4, 8, [(4, 8)], ["t2"], ["ensembl"]), (10, 40, [(10, 20), (30, 40)], ["t1"], ["ensembl"])]
    reads.write_gtf(gtf, str(tmp_path / "out"))
    assert reads.read_gtf(spark, str(tmp_path / "out")).count() == 3
    tables.write_transcripts(reads.gtf_transcripts(gtf), str(tmp_path / "tx"))
    assert "10,30,\t20,40,\t" in text_of(tmp_path / "tx")
    assert sorted(map(str, tables.read_transcripts(spark, str(tmp_path / "tx")).collect())) == sorted(map(str, reads.gtf_transcripts(gtf).collect()))


def test_bed_and_genepred(spark, tmp_path):
    (tmp_path / "a.bed").write_text("chr1\t100\t200\tn\t0\t-\t100\t200\t0\t2\t10,20,\t0,80,\n")
    b = tables.read_bed12(spark, str(tmp_path / "a.bed")).first()
    assert [tuple(e) for e in b.exons] == [(100, 110), (180, 200)] and b.tx_id == 1
    tables.write_genepred(tables.read_bed12(spark, str(tmp_path / "a.bed")), str(tmp_path / "gp"))
    g = tables.read_genepred(spark, str(tmp_path / "gp")).first()
    assert [tuple(e) for e in g.exons] == [(100, 110), (180, 200)] and g.tx_names == ["n"]


def test_pairs_chimeras_and_lists(spark, tmp_path):
    (tmp_path / "pairs").write_text("0\t1\t2\ta,b\n1\t3\t4\tc\td,e\n")
    p = tables.read_pairs(spark, str(tmp_path / "pairs"))
    assert [(r.qnames, r.spanning_qnames) for r in p.orderBy("pair_id").collect()] == [(["a", "b"], []), (["c"], ["d", "e"])]
    tables.write_pairs(p, str(tmp_path / "p2"))
    assert tables.read_pairs(spark, str(tmp_path / "p2")).count() == 2
    row = ["c1", "1", "2", "c2", "3", "4", "CHIMERA0", "5", "+", "-", "Read_Through", "-1", "1", "0", "1", "1", "2", "2", "na", "na", "A,B", "C", "t1", "t2"]
    (tmp_path / "c").write_text("#head\n" + "\t".join(row) + "\n")
    c = tables.read_chimeras(spark, str(tmp_path / "c"))
    assert c.first().genes_5p == ["A", "B"] and c.first().distance == -1
    tables.write_chimeras(c, str(tmp_path / "c2"))
    assert text_of(tmp_path / "c2") == "#" + "\t".join(c.columns) + "\n" + "\t".join(row)
    (tmp_path / "m").write_text("a\n\nb\na\n")
    assert sorted(r.value for r in tables.read_list(spark, str(tmp_path / "m")).collect()) == ["a", "b"]
    tables.write_insert_sizes(spark.createDataFrame([(2, 5), (1, 4)], "isize int, num_samples long"), str(tmp_path / "i"))
    assert text_of(tmp_path / "i") == "#insert_size\tnum_samples\n1\t4\n2\t5"


def test_clusters_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("c", 1, 9, 0, "+", 1, [(1, 4), (6, 9)], 3, ["a", "b"], [])], tables.CLUSTERS)
    tables.write_clusters(df, str(tmp_path / "c"))
    assert tables.read_clusters(spark, str(tmp_path / "c")).collect() == df.collect()


def test_config_round_trip():
    c = RunConfig(reads1="a", segment_length=None, mask_biotypes=["x", "y"])
    assert RunConfig.from_xml(c.to_xml()) == c
    assert RunConfig.from_args(["--trim5", "3", "--mask-rnames", "chrM"]).mask_rnames == ["chrM"]
    assert RunConfig().problems((50, 50)) == [] and RunConfig(anchor=3).problems((20, 30))
    assert RunConfig(max_isize_samples=5).problems() and RunConfig(reads1="x").problems() == ["reads of one mate only"]


def test_flags(spark):
    got = spark.range(1).select(reads.has_flag(F.lit(20), "reverse").alias("r"), reads.with_flags(F.lit(4), ["paired"], ["unmapped"]).alias("f")).first()
    assert got.r and got.f == 1


def test_part_files_are_numbered_on(spark, tmp_path):
    """Mates in folders of several files: every fragment has its own number and its own mate."""
    for m in (1, 2):
        folder = tmp_path / f"m{m}"
        folder.mkdir()
        for part, ids in (("part-0", (0, 1)), ("part-1", (2,)), ("part-2", ()), ("part-3", (3, 4))):
            (folder / part).write_text("".join(f"@r{i}/{m}\nACG{'AT'[m - 1]}\n+\nIIII\n" for i in ids))
    got = reads.read_pairs(spark, str(tmp_path / "m1"), str(tmp_path / "m2")).collect()
    assert sorted((r.frag_id, r.mate, r.qname, r.seq) for r in got) == sorted((i + 1, m, f"r{i}", "ACG" + "AT"[m - 1]) for i in range(5) for m in (1, 2))


def test_many_splits_are_joined_by_shuffle(spark, tmp_path, monkeypatch):
    path = tmp_path / "r.fq"
    path.write_text("".join(f"@r{i}/1\nACGT\n+\nIIII\n" for i in range(400)))
    monkeypatch.setattr(reads, "MOST_SPLITS", 0)
    spark.conf.set("spark.sql.files.maxPartitionBytes", 512)
    try:
        got = [r.qname for r in reads.read_fastq(spark, str(path)).orderBy("frag_id").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [f"r{i}" for i in range(400)]


def test_scratch_tables_go_and_results_stay(spark, tmp_path):
    from lociq.plans import storage

    kept = storage.scratch_path(spark, "kept")
    with storage.scratch_cleared(spark):
        once = storage.materialise(spark.range(5), "once")
        once.write.parquet(kept)
        folder = once.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert os.path.isdir(folder)
    assert not os.path.exists(folder) and spark.read.parquet(kept).count() == 5


def test_stages_are_done_once_and_paths_are_checked(spark, tmp_path):
    from lociq.plans import config, storage

    path, built = str(tmp_path / "stage"), []
    build = lambda: built.append(1) or spark.range(3)
    assert storage.once(spark, path, build).count() == storage.once(spark, path, build).count() == 3 and built == [1]
    os.remove(f"{path}/_SUCCESS")  # a job that was stopped
    assert storage.once(spark, path, build).count() == 3 and built == [1, 1]
    assert config.unreachable(spark, [path, path + "-none"]) == [path + "-none"]
    assert config.missing_binaries(["python", "no-such-aligner"]) == ["no-such-aligner"]
