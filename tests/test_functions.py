import math

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lociq.functions import cigar, prob, sequence


def one(spark, column, **values):
    kinds = {str: "string", int: "int", float: "double"}
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {kinds[type(v)]}" for k, v in values.items())) if values else spark.range(1)
    return df.select(column.alias("x")).first().x


def test_homology(spark):
    a = "AAAAGGGGTTTTCCCC"
    cases = [(a, a, 0, 16), (a, "AAAAGGGGTTTTCCCG", 0, 15), (a, "AAATTTGGTTTTCCCC", 0, 3), (a, "AAATTTGGTTTTCCCC", 1, 4), (a, "AAATTTGGTTTTCCCC", 2, 5), (a, "AAATTTGGTTTTCCCC", 3, 16), ("", "A", 0, 0)]
    for x, y, k, want in cases:
        assert one(spark, sequence.homology(F.col("a"), F.col("b"), k), a=x, b=y) == want


def test_strings(spark):
    assert one(spark, sequence.reverse_complement(F.col("a")), a="ACGTNacgtnRY") == "RYnacgtNACGT"
    assert one(spark, sequence.to_dna(sequence.to_rna(F.col("a"))), a="ACGT") == "ACGT"
    assert one(spark, sequence.wrap(F.col("a"), 3), a="abcdef") == "abc\ndef"
    assert one(spark, sequence.wrap(F.col("a"), 3), a="") == ""
    assert one(spark, sequence.trim(F.col("a"), 2, 3), a="abcdefgh") == "cde"
    assert one(spark, sequence.trim(F.col("a"), 2, 30), a="abcdefgh") == "c"
    assert one(spark, sequence.clean_name(F.col("a")), a="read7/1 extra/2") == "read7"
    assert one(spark, sequence.md_reverse_complement(F.col("a")), a="5A3^AC2") == "2^GT3T5"
    assert one(spark, sequence.md_mismatches(F.col("a")), a="5A3^AC2G1") == [5, 11]
    assert one(spark, sequence.convert_quality(F.col("a"), "illumina"), a="h@") == "I!"
    assert one(spark, sequence.convert_quality(F.col("a"), "sanger"), a="!Z") == "!I"
    assert sequence.segment_bounds(32, 10) == [(0, 11), (11, 22), (22, 32)] and sequence.segment_length(160, 50) == 50 and sequence.segment_length(30, 50) == 25


def test_cigar(spark):
    ops = cigar.parse(F.col("c"))
    assert one(spark, cigar.render(ops), c="3S10M2I5N7M") == "3S10M2I5N7M"
    assert one(spark, cigar.reference_end(F.lit(100), ops), c="3S10M2I5N7M") == 122
    assert [tuple(x) for x in one(spark, cigar.blocks(F.lit(100), ops), c="3S10M2I5N7M2D1M")] == [(100, 110), (115, 125)]
    assert tuple(one(spark, cigar.clipped_interval(F.lit(100), ops), c="3S10M4S")) == (97, 110)
    assert tuple(one(spark, cigar.clipped_interval(F.lit(100), ops), c="10M4S")) == (100, 114)
    assert tuple(one(spark, cigar.best_read_interval(ops), c="3S10M4S9M")) == (3, 13)
    assert one(spark, cigar.render(cigar.soft_pad(ops, F.lit(4), F.lit(True))), c="10M") == "4S10M"


def brute_position(exons, strand, p):
    places = [x for a, b in exons for x in range(a, b)]
    places = places[::-1] if strand == "-" else places
    return places[p] if 0 <= p < len(places) else None


def test_positions_and_genome_cigars(spark):
    exons = [(100, 120), (150, 160), (200, 240)]
    array = F.array(*[F.struct(F.lit(a).alias("start"), F.lit(b).alias("end")) for a, b in exons])
    rows = [(s, p, n) for s in "+-" for p in range(0, 72) for n in (1, 5, 25) if p + n <= 70]
    df = spark.createDataFrame(rows, "strand string, p int, n int").withColumn("ops", cigar.parse(F.concat(F.col("n").cast("string"), F.lit("M"))))
    got = df.select("strand", "p", "n", cigar.genome_position(array, F.col("strand"), F.col("p")).alias("g"), cigar.genome_start(array, F.col("strand"), F.col("p"), F.col("ops")).alias("s"), cigar.genome_ops(array, F.col("strand"), F.col("p"), F.col("ops")).alias("o")).collect()
    for r in got:
        places = sorted(brute_position(exons, r.strand, x) for x in range(r.p, r.p + r.n))
        assert r.g == brute_position(exons, r.strand, r.p) and r.s == places[0]
        at, seen = r.s, []
        for op, n in r.o:
            assert n > 0
            if op == 0:
                seen += range(at, at + n)
            at += n
        assert seen == places
    assert one(spark, cigar.genome_position(array, F.lit("+"), F.lit(70))) is None
    t = one(spark, cigar.transcript_interval(array, F.lit("-"), F.lit(110), F.lit(155)))
    assert [(x.start, x.end) for x in t] == [(45, 50), (50, 60)]
    assert [tuple(x) for x in one(spark, cigar.introns(array))] == [(120, 150), (160, 200)]


def test_probabilities(spark):
    assert one(spark, prob.comb(F.lit(10), F.lit(3))) == 120
    assert one(spark, prob.comb(F.lit(3), F.lit(5))) == 0
    assert abs(one(spark, prob.binomial_cdf(F.lit(4), F.lit(9), 0.3)) - sum(math.comb(9, i) * 0.3**i * 0.7 ** (9 - i) for i in range(5))) < 1e-12
    assert abs(one(spark, prob.poisson(F.lit(3), F.lit(2.0))) - math.exp(-2) * 8 / 6) < 1e-12


@given(st.text("ACGTN", max_size=30))
def test_quality_tables_are_total(s):
    for kind in ("sanger", "illumina", "solexa"):
        table = sequence.quality_table(kind)
        assert all(33 <= ord(v) <= 126 for v in table.values()) and len(table) == 94


def test_poisson_and_binomial_for_any_count(spark):
    ks = [-1, 0, 1, 5, 20, 21, 25, 60, 400]
    df = spark.createDataFrame([(k,) for k in ks], "k int")
    for rate in (0.0, 0.5, 25.0, 800.0):
        got = {r.k: r.p for r in df.select("k", prob.poisson(F.col("k"), F.lit(rate)).alias("p")).collect()}
        for k in ks:
            want = 0.0 if k < 0 else (1.0 if k == 0 else 0.0) if rate == 0 else math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
            assert abs(got[k] - want) <= 1e-9 * max(want, 1e-300) + 1e-300
    trials = [(-1, 9), (0, 9), (4, 9), (9, 9), (12, 9), (30, 99), (0, 0)]
    df = spark.createDataFrame(trials, "k int, n int")
    for p in (0.5, 0.3, 0.0, 1.0):
        got = [r.p for r in df.select(prob.binomial_cdf(F.col("k"), F.col("n"), p).alias("p")).collect()]
        want = [sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(min(k, n) + 1)) for k, n in trials]
        assert all(abs(a - b) < 1e-9 for a, b in zip(got, want, strict=True))
    assert spark.range(1).select(prob.binomial_cdf(F.lit(60), F.lit(120), 0.5)).first()[0] > 0.5
