"""Older designs against brute force: tilings, mate clusters, pairs with the genome, transcripts of blocks; stages that resume."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from lociq.operators import annotate, classify, legacy
from lociq.plans.storage import Stages, fingerprint


def all_tilings(candidates):
    """Of all sets of disjoint candidates, those whose sizes are the greatest."""
    every = sorted({tuple(sorted(set(c))) for c in candidates if c})
    sets = [s for n in range(len(every) + 1) for s in itertools.combinations(every, n) if len({i for c in s for i in c}) == sum(map(len, s))]
    sizes = lambda s: sorted(map(len, s), reverse=True)
    best = max(map(sizes, sets))
    return sorted(list(s) for s in sets if sizes(s) == best)


def test_tilings_are_the_best_of_all():
    rnd = random.Random(1)
    for _ in range(300):
        n = rnd.randrange(1, 7)
        found = [tuple(rnd.sample(range(n), rnd.randrange(1, n + 1))) for _ in range(rnd.randrange(7))]
        assert legacy.best_tilings(found) == all_tilings(found)
    # the longest alone would leave 4 alone; two of two beat it only by the second size
    assert legacy.best_tilings([(0, 1, 2), (1, 2, 3), (3, 4), (0,), (4,)]) == [[(0, 1, 2), (3, 4)]]
    assert legacy.filled_tiling([(1, 2)], 5) == [([0], False), ([1, 2], True), ([3, 4], False)]


def test_tilings_of_reads(spark):
    rows = [("a", "c1", 0), ("a", "c1", 1), ("a", "c1", 1), ("a", "c2", 1), ("a", "c2", 2), ("a", "c3", 3), ("a", None, 4), ("b", None, 0), ("b", None, 1), (None, "c1", 0), ("d", "c1", None)]
    got = {r.f: [[(list(p.segments), p.mapped) for p in t] for t in r.tilings] for r in legacy.segment_tilings(spark.createDataFrame(rows, "f string, c string, seg int"), "f", ["c"], "seg").collect()}
    assert got["a"] == [[([0, 1], True), ([2], False), ([3], True), ([4], False)], [([0], False), ([1, 2], True), ([3], True), ([4], False)]]
    assert got["b"] == [[([0, 1], False)]] and "d" not in got


def test_lists_with_gaps_fit_where_their_hulls_overlap(spark):
    rows = [("f", "x", i) for i in (0, 2, 4)] + [("f", "y", i) for i in (1, 3)] + [("f", "z", i) for i in (3, 4)] + [("f", "y2", i) for i in (1, 3, 3)] + [("g", "x", None)]
    got = legacy.merge_mate_clusters(spark.createDataFrame(rows, "f string, c string, s int"), "f", "c", "s").collect()
    assert [(r.f, [(p.segments, p.clusters) for p in r.picks]) for r in got] == [("f", [([0, 2, 4], ["x"]), ([1, 3], ["y", "y2"])])]


def test_pairs_with_the_genome(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice([*range(60), None]), rnd.choice([1, 2]), rnd.randrange(6), rnd.choice([None, 1, 2]), rnd.choice([None, 0, 1, 2])) for _ in range(260)]
    rows += rows[:40]
    want = set()
    for f in range(60):
        hits = {(m, p, g, o or 0) for fr, m, p, g, o in rows if fr == f}
        a, b = [h for h in hits if h[0] == 1], [h for h in hits if h[0] == 2]
        every = list(itertools.product(a, b))
        gene = {(f, "gene", x[1], y[1], x[3], y[3]) for x, y in every if x[2] is not None and y[2] is not None and {x[3], y[3]} == {1, 2}}
        genome = {(f, "genome", x[1], y[1], x[3], y[3]) for x, y in every if x[2] is None and y[2] is None}
        mixed = {(f, "mixed", x[1], y[1], x[3], y[3]) for x, y in every if (x[2] is None) != (y[2] is None) and (x[3] != y[3] or 0 in (x[3], y[3]))}
        want |= (gene | genome) or mixed
    df = spark.createDataFrame(rows, "f int, mate int, p int, gene int, orient int")
    got = classify.fallback_pairs(df, "f", ["p"], "gene", "orient").select("f", "tier", "p_1", "p_2", "orient_1", "orient_2").collect()
    assert set(map(tuple, got)) == want and {t for _, t, *_ in want} == {"gene", "genome", "mixed"}


def test_transcripts_of_spliced_blocks(spark):
    rnd = random.Random(6)
    op = {"M": 0, "N": 3, "D": 2}
    reads, exons = [], [("c", rnd.choice("+-."), s, s + rnd.randrange(1, 30), t) for t in range(25) for s in [rnd.randrange(200)]]
    for i in range(40):
        ops = [(rnd.choice("MD"), rnd.randrange(1, 9)) if k % 2 == 0 else ("N", rnd.randrange(1, 30)) for k in range(rnd.choice([1, 3, 5]))]
        reads.append((i, "c", rnd.choice(["+", "-", None]), rnd.randrange(200), [(op[o], n) for o, n in ops]))
    reads += [(None, "c", "+", 5, [(0, 4)]), (99, "c", "+", 5, [])]
    df = spark.createDataFrame(reads, "read_id int, rname string, strand string, pos int, cigar array<struct<op:int,len:int>>")
    blocks, whole = annotate.transcripts_of_reads(df, spark.createDataFrame(exons, "rname string, strand string, s2 int, e2 int, tx_id int"))
    got = {(r.read_id, r.start, r.end): r.transcripts for r in blocks.collect()}
    every = {r.read_id: (r.blocks, sorted(r.transcripts)) for r in whole.collect()}
    want = {}
    for i, _, strand, at, ops in reads:
        parts = []
        for o, n in ops:
            if o != 3:
                parts.append((at, at + n))
            at += n
        for a, b in parts:
            want[i, a, b] = sorted({t for _, s, x, y, t in exons if y > a and x < b and (s == "." or strand is None or s == strand)})
        if parts:
            lists = [set(want[i, a, b]) for a, b in parts]
            assert every[i] == (len(parts), sorted(set.intersection(*lists)))
    assert got == want and 99 not in every


# ---------------------------------------------------------------- stages


def test_a_killed_run_resumes_and_a_changed_input_runs_again(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "stages")
    spark.range(10).write.parquet(source)
    calls = []

    def run(bad=False, add=1):
        stages = Stages(spark, folder)
        calls.clear()

        def first():
            calls.append("first")
            return spark.read.parquet(source).selectExpr(f"id + {add} as x")

        def second():
            calls.append("second")
            df = one.selectExpr("x * 2 as y")
            return df.withColumn("y", F.expr("raise_error('killed')")) if bad else df

        one = stages.table("first", first, inputs=[source], settings={"add": add})
        two = stages.table("second", second, inputs=["first"])
        return stages, sorted(r.y for r in two.collect())

    with pytest.raises(Exception, match="killed"):
        run(bad=True)
    assert calls == ["first", "second"]
    stages, got = run()
    assert calls == ["second"] and got == [2 * (i + 1) for i in range(10)] and stages.built == ["second"]
    assert run()[1] == got and calls == []
    assert run(add=5)[1][0] == 10 and calls == ["first", "second"]
    before = fingerprint(spark, source)
    spark.range(10, 12).write.mode("append").parquet(source)
    assert fingerprint(spark, source) != before
    stages, got = run()
    assert calls == ["first", "second"] and len(got) == 12
    stages.clean()
    assert len(list((tmp_path / "stages" / "first").iterdir())) == 1 and run()[1] == got and calls == []
    assert fingerprint(spark, str(tmp_path / "nothing")) == fingerprint(spark, str(tmp_path / "nor*this"))


# ---------------------------------------------------------------- smaller ones


def test_capped_samples(spark):
    from lociq.operators.stats import cap_samples

    df = spark.createDataFrame([(i % 7, i % 100) for i in range(500)] + [(None, 1)] * 3, "a int, b int")
    for most in (0, 1, 37, 250, 502, 503, 900):
        got = cap_samples(df, most, ["a", "b"]).collect()
        assert len(got) == min(most, 503)
        assert sorted(map(str, got)) == sorted(map(str, cap_samples(df.repartition(3), most, ["a", "b"]).collect()))


def test_settings_name_what_isnt_there(spark, tmp_path):
    from lociq.plans.config import RunConfig

    (tmp_path / "r1.fq").write_text("")
    config = RunConfig(reads1=str(tmp_path / "r1.fq"), reads2=str(tmp_path / "r2.fq"), transcripts=str(tmp_path / "t"))
    assert config.problems(spark=spark, programs=["no-such-program", "ls"]) == [f"{tmp_path}/r2.fq isn't there", f"{tmp_path}/t isn't there", "program no-such-program isn't found or can't be run"]


def test_matches_with_mismatches_are_all_found(spark):
    from lociq.operators import mates

    rnd = random.Random(9)
    seqs = ["".join(rnd.choice("AC") for _ in range(24)) for _ in range(40)]
    tx = spark.createDataFrame(list(enumerate(seqs)), "tx_id int, seq string")
    chimeras = [(i, i, 2, 20, 39 - i, 0, 15) for i in range(40)]
    df = spark.createDataFrame(chimeras, "chimera_id int, tx5p int, start5p int, end5p int, tx3p int, start3p int, end3p int")
    for most in (0, 1, 2):
        want = set()
        for i, a, s5, e5, b, s3, e3 in chimeras:
            five, three = seqs[a][s5:e5], seqs[b][s3:e3]
            if any(sum(x != y for x, y in zip(five[j : j + 9], three[k : k + 9], strict=True)) <= most for j in range(len(five) - 9) for k in range(len(three) - 8)):
                want.add(i)
        assert {r.chimera_id for r in mates.homologous(df, tx, tile=9, mismatches=most).collect()} == want and (most or len(want) < 40)
