"""BAM in and out, splits in all places, damaged files; range reads over the index."""

import gzip
import os
import random

import pytest
from pyspark.sql import functions as F

from lociq.functions import cigar
from lociq.operators import intervals
from lociq.sources import bam
from lociq.sources import reads as io

REFS = [("c1", 1_000_000), ("c2", 5_000), ("long_name.3", 100)]


def sam_lines(n, seed=1):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        size = rnd.choice([0, 1, 2, 35, 76, 400])
        seq = "".join(rnd.choice("ACGTN") for _ in range(size)) or "*"
        qual = "*" if not size or rnd.random() < 0.2 else "".join(chr(rnd.randrange(33, 74)) for _ in range(size))
        mapped = rnd.random() < 0.8
        ops = f"{size}M" if mapped and size < 3 and size else f"2S{size - 12}M100N5M3I2S" if mapped and size else "*"
        tags = [f"NH:i:{rnd.choice([1, -3, 200, 40000, -40000, 3000000000])}", f"MD:Z:{size}", "XA:A:+", "XF:f:0.5", "XB:B:s,-1,2,300", "XH:H:1AE3"]
        ref = rnd.choice(REFS)[0] if mapped else "*"
        cells = [f"r{i}/{rnd.randrange(9)}", rnd.randrange(4096), ref, rnd.randrange(1, 90) if mapped else 0, rnd.randrange(256), ops, rnd.choice(["*", "=", "c2"]) if mapped else "*", rnd.randrange(0, 90), rnd.randrange(-500, 500), seq, qual]
        out.append("\t".join(map(str, [*cells, *rnd.sample(tags, rnd.randrange(len(tags) + 1))])))
    return out


def rows_of(df):
    names = [f.name for f in bam._parse_ddl(bam.RECORDS)]
    return sorted(str(tuple(dict(sorted(x.items())) if isinstance(x, dict) else x for x in r)) for r in df.select(*names).collect())


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    """SAM text, its rows, and the same as BAM in three files."""
    at = tmp_path_factory.mktemp("bam")
    (at / "in.sam").write_text("\n".join(["@HD\tVN:1.6", *sam_lines(9000)]) + "\n")
    sam = io.read_sam(spark, str(at / "in.sam"), types=True)
    lengths = spark.createDataFrame(REFS, "chrom string, length int")
    bam.write_bam(sam.repartition(3), str(at / "out"), lengths)
    return at, sam, lengths


@pytest.mark.parametrize("split", ["128m", "64k", "9k"])
def test_bam_gives_back_what_sam_has(spark, made, split):
    """Whatever the size of splits, those below a block's too."""
    at, sam, _ = made
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        got = bam.read_bam(spark, str(at / "out"))
        assert rows_of(got) == rows_of(sam)
        parts = spark.read.option("encoding", "ISO-8859-1").option("lineSep", bam.MAGIC.decode("latin-1")).text(str(at / "out")).rdd.getNumPartitions()
        assert split == "128m" or parts > 4
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert {"nh", "mate", "end"} <= set(got.columns)


def test_sam_text_is_the_same_again(spark, made, tmp_path):
    at, sam, lengths = made
    io.write_sam(bam.read_bam(spark, str(at / "out")), str(tmp_path / "again"), lengths)
    again = [r.value for r in spark.read.text(str(tmp_path / "again")).filter("not startswith(value, '@')").collect()]
    first = (at / "in.sam").read_text().splitlines()[1:]
    bare = lambda line: tuple(line.split("\t")[:11]) + tuple(sorted(line.split("\t")[11:]))
    same = lambda c: tuple("=" if i == 6 and x == c[2] and x != "*" else x for i, x in enumerate(c))
    assert sorted(same(bare(x)) for x in again) == sorted(same(bare(x)) for x in first)


def test_files_are_gzip_with_an_end_mark(made):
    at, _, _ = made
    files = [at / "out" / f for f in os.listdir(at / "out") if f.startswith("part-")]
    assert len(files) == 3
    for f in files:
        raw = f.read_bytes()
        assert raw.endswith(bam.EOF_BLOCK)
        data = gzip.decompress(raw)  # any reader of gzip reads the blocks
        text, refs, start = bam.read_header(data)
        assert refs == REFS and text.startswith("@HD\tVN:1.6") and bam.read_header(data[: start - 1]) is None


def test_marks_inside_blocks_and_other_odd_things(spark, tmp_path):
    """Stored blocks that hold the four bytes themselves, long CIGARs, no rows, unknown references, cut files."""
    lengths = spark.createDataFrame(REFS, "chrom string, length int")
    text = "@HD\tVN:1.6\n"
    header = bam.BAM_MAGIC + len(text).to_bytes(4, "little") + text.encode() + (0).to_bytes(4, "little")
    row = {"qname": "q", "flag": 4, "rname": None, "pos": None, "mapq": 0, "cigar": [], "rnext": None, "pnext": None, "tlen": 0, "seq": "ACGT", "qual": "!!!!", "tags": {}}
    record = bam.pack_record(row | {"tags": {"ZZ": "a" + bam.MAGIC.decode("latin-1") + "b"}}, {})

    def stored(data):
        body = b"\x01" + len(data).to_bytes(2, "little") + (len(data) ^ 0xFFFF).to_bytes(2, "little") + data
        import zlib

        return bam.MAGIC + b"\0\0\0\0\0\xff\x06\0BC\x02\0" + (len(body) + 25).to_bytes(2, "little") + body + zlib.crc32(data).to_bytes(4, "little") + len(data).to_bytes(4, "little")

    (tmp_path / "marks.bam").write_bytes(stored(header) + stored(record * 5) + bam.EOF_BLOCK)
    assert [r.tags["ZZ"] for r in bam.read_bam(spark, str(tmp_path / "marks.bam")).collect()] == ["a\x1f\x8b\x08\x04b"] * 5
    (tmp_path / "cut.bam").write_bytes((stored(header) + stored(record * 5))[:-9])
    with pytest.raises(Exception, match="block ends in the middle|no records"):
        bam.read_bam(spark, str(tmp_path / "cut.bam")).count()
    (tmp_path / "lost.bam").write_bytes(stored(header) + stored((record * 5)[:-9]) + bam.EOF_BLOCK)
    with pytest.raises(Exception, match="no records"):
        bam.read_bam(spark, str(tmp_path / "lost.bam")).count()
    ops = [{"op": i % 2, "len": 1} for i in range(70_000)]
    many = spark.createDataFrame([("q", 0, "c1", 3, 1, ops, None, -1, 0, "A" * 70_000, "*", {"NH": "1"})], bam.RECORDS.replace(", tag_types map<string,string>", ""))
    bam.write_bam(many, str(tmp_path / "many"), lengths)
    got = bam.read_bam(spark, str(tmp_path / "many")).first()
    assert len(got.cigar) == 70_000 and got.tags == {"NH": "1"} and got.end == 3 + 35_000
    bam.write_bam(many.filter("false"), str(tmp_path / "none"), lengths)
    assert bam.read_bam(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(Exception, match="isn't in the header"):
        bam.write_bam(many.withColumn("rname", F.lit("c9")), str(tmp_path / "bad"), lengths)


def test_repeated_tags_in_sam_text(spark, tmp_path):
    (tmp_path / "x.sam").write_text("q\t0\tc1\t1\t3\t4M\t*\t0\t0\tACGT\tIIII\tNH:i:1\tXA:Z:a:b\tNH:i:7\n")
    got = io.read_sam(spark, str(tmp_path / "x.sam"), types=True).first()
    assert got.tags == {"NH": "7", "XA": "a:b"} and got.nh == 7 and got.tag_types == {"NH": "i", "XA": "Z"}


def test_bins_of_the_format():
    assert bam.region_bin(0, 1) == 4681 and bam.region_bin(16383, 16385) == 585 and bam.region_bin(0, 1 << 29) == 0 and bam.region_bin(1 << 14, (1 << 14) + 5) == 4682


def test_range_reads_open_the_files_they_need(spark, tmp_path):
    rnd = random.Random(2)
    rows = [(f"c{rnd.randrange(3)}", s, s + (rnd.randrange(200) if i % 50 else 90_000), i) for i in range(4000) for s in [rnd.randrange(500_000)]] + [(None, None, None, -1), ("c1", 5, None, -2)]
    table = spark.createDataFrame(rows, "rname string, pos int, end int, id int")
    bam.write_indexed(table, str(tmp_path / "t"), rows_per_file=200)
    assert spark.read.parquet(str(tmp_path / "t/data")).count() == len(rows)
    every = len(spark.read.parquet(str(tmp_path / "t/data")).inputFiles())
    for asked in ([("c1", 1000, 3000)], [("c0", 0, 10), ("c0", 5, 12), ("c2", 499_000, 500_000)], [("c9", 0, 10)], [(None, 0, 10)]):
        regions = spark.createDataFrame(asked, "rname string, s int, e int")
        got = bam.fetch(spark, str(tmp_path / "t"), regions)
        assert sorted(r.id for r in got.collect()) == sorted(i for k, s, e, i in rows if s is not None and e is not None and any(k == q and k is not None and e > a and s < b for q, a, b in asked))
        assert bam.files_of(spark, str(tmp_path / "t"), regions).count() < every / 2


def test_fetch_is_the_overlap_join_of_a_bam(spark, made, tmp_path):
    at, _, _ = made
    got = bam.read_bam(spark, str(at / "out"))
    bam.write_indexed(got, str(tmp_path / "t"), rows_per_file=100)
    regions = spark.createDataFrame([("c1", 10, 20), ("c2", 500, 800)], "rname string, s2 int, e2 int")
    a = bam.fetch(spark, str(tmp_path / "t"), regions, r=("s2", "e2")).select("qname", "pos").collect()
    b = intervals.overlap_join(got, regions, ["rname"], l=("pos", "end")).select("qname", "pos").collect()
    assert sorted(a) == sorted(b) and a
    assert cigar.render(F.col("cigar")) is not None
