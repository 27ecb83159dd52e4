import random

import pytest
from pyspark.sql import functions as F

from lociq.operators import intervals
from lociq.operators.graph import connected_components


def frame(spark, rows, ddl="k int, s int, e int, id int"):
    return spark.createDataFrame(rows, ddl)


def test_islands_of_known_intervals(spark):
    df = frame(spark, [(1, 6, 7, 1), (1, 1, 2, 3), (1, 9, 10, 2), (1, 3, 4, 0), (1, 3, 8, 4)])
    got = intervals.label_islands(df, ["k"]).groupBy("island_start", "island_end").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    assert sorted((r.island_start, r.island_end, r.ids) for r in got.collect()) == [(1, 2, [3]), (3, 8, [0, 1, 4]), (9, 10, [2])]


def brute_islands(rows, gap):
    out = []
    for s, e in sorted(rows):
        if out and s <= out[-1][1] + gap:
            out[-1] = (out[-1][0], max(out[-1][1], e), out[-1][2] + 1)
        else:
            out.append((s, e, 1))
    return out


def test_islands_across_tiles(spark):
    rng = random.Random(1)
    rows = [(0, s, s + rng.randrange(40), i) for i in range(300) for s in [rng.randrange(3000)]]
    for gap in (0, 3):
        got = intervals.islands(frame(spark, rows), ["k"], max_gap=gap, tile=64).collect()
        assert sorted((r.island_start, r.island_end, r.members) for r in got) == brute_islands([r[1:3] for r in rows], gap)


def test_overlap_join_equals_all_pairs(spark):
    rng = random.Random(2)
    rows = lambda n: [(rng.randrange(2), s, s + rng.randrange(25), i) for i in range(n) for s in [rng.randrange(200)]]
    a, b = rows(120), rows(120)
    want = sorted((x[3], y[3]) for x in a for y in b if x[0] == y[0] and y[2] > x[1] and y[1] < x[2])
    right = frame(spark, b).toDF("k", "s2", "e2", "id2")
    for width in (7, 64):
        got = intervals.overlap_join(frame(spark, a), right, ["k"], width=width).select("id", "id2").collect()
        assert sorted(map(tuple, got)) == want


def test_nearest_examples(spark):
    iv = frame(spark, [(1, 0, 10, 0), (1, 3, 7, 1), (1, 3, 40, 2), (1, 13, 50, 3)])
    ask = lambda p, **how: [(r.s, r.e) for r in intervals.nearest(spark.createDataFrame([(1, p)], "k int, p int"), iv, ["k"], **how).orderBy("rank").collect()]
    assert ask(10, k=1) == [(3, 7)]
    assert ask(11, k=5) == [(0, 10), (3, 7)]
    assert ask(12, side="after") == [(13, 50)]
    assert ask(100, k=2, max_dist=10) == []
    q = spark.createDataFrame([(1, 11, "+"), (1, 12, "-")], "k int, p int, strand string")
    got = intervals.nearest_stranded(q, iv, ["k"]).select("p", "s", "e").collect()
    assert sorted(map(tuple, got)) == [(11, 0, 10), (12, 13, 50)]


def test_depth_runs_and_empty(spark):
    df = frame(spark, [(1, 0, 10, 0), (1, 10, 20, 1), (1, 5, 12, 2)])
    assert intervals.max_depth(df, ["k"]).first().depth == 2
    runs = spark.createDataFrame([(1, x) for x in (0, 2, 3, 5, 6)], "k int, x int")
    assert sorted((r.first, r.last) for r in intervals.contiguous_runs(runs, ["k"], "x").collect()) == [(0, 0), (2, 3), (5, 6)]
    empty = df.filter("false")
    assert intervals.islands(empty, ["k"]).count() == 0
    assert intervals.overlap_join(empty, df.toDF("k", "s2", "e2", "id2"), ["k"]).count() == 0
    assert intervals.max_depth(empty, ["k"]).count() == 0


def test_exists_and_anti(spark):
    a, b = frame(spark, [(1, 0, 5, 0), (1, 5, 9, 1), (2, 0, 5, 2)]), spark.createDataFrame([(1, 4, 5)], "k int, s2 int, e2 int")
    assert [r.id for r in intervals.overlap_exists(a, b, ["k"]).collect()] == [0]
    assert sorted(r.id for r in intervals.overlap_exists(a, b, ["k"], anti=True).collect()) == [1, 2]


def test_components_of_chain_star_and_loop(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 200), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[100 + i] == 100 for i in range(30)) and got[200] == 200
    assert connected_components(spark.createDataFrame([], "a int, b int")).count() == 0


def long_rows(spark, rows, columns):
    return spark.createDataFrame(rows, ", ".join(f"{c} {'string' if c in ('r', 'note') else 'bigint'}" for c in columns))


def test_repeated_and_null_rows_of_semi_and_anti(spark):
    left = long_rows(spark, [("c", 0, 10), ("c", 0, 10), ("c", 20, 30), ("c", 20, 30), ("c", None, 5), (None, 0, 10)], ["r", "s", "e"])
    right = long_rows(spark, [("c", 5, 8), ("c", 5, 8), ("c", None, 9)], ["r", "s2", "e2"])
    hit = intervals.overlap_exists(left, right, ["r"]).collect()
    rest = intervals.overlap_exists(left, right, ["r"], anti=True).collect()
    assert sorted(map(str, hit)) == sorted(map(str, left.filter("r = 'c' and s = 0").collect()))
    assert sorted(map(str, rest)) == sorted(map(str, left.filter("r is null or s is null or s = 20").collect()))


def test_islands_and_depth_pass_over_null_coordinates(spark):
    rows = long_rows(spark, [("c", None, 5), ("c", 1, 4), ("c", 3, None), (None, 1, 2), (None, 2, 3)], ["r", "s", "e"])
    assert sorted((str(r.r), r.island_start, r.island_end, r.members) for r in intervals.islands(rows, ["r"]).collect()) == [("None", 1, 3, 2), ("c", 1, 4, 1)]
    assert sorted((str(r.r), r.s, r.island_start) for r in intervals.label_islands(rows, ["r"]).collect()) == [("None", 1, 1), ("None", 2, 1), ("c", 1, 1)]
    assert sorted((str(r.r), r.depth) for r in intervals.max_depth(rows, ["r"]).collect()) == [("None", 1), ("c", 1)]
    assert intervals.islands(rows.filter("false"), ["r"]).count() == intervals.max_depth(rows.filter("false"), ["r"]).count() == 0


def test_columns_with_clashing_names(spark):
    left = spark.createDataFrame([("c", 0, 10, "l", 1, 2)], "r string, s int, e int, note string, _bin int, _tile int")
    right = spark.createDataFrame([("c", 5, 15, "x", 3)], "r string, s int, e int, note string, _bin int")
    got = intervals.overlap_join(left, right, ["r"], r=("s", "e")).first()
    assert (got.s, got.e, got.note, got._bin, got.s_right, got.e_right, got.note_right, got._bin_right) == (0, 10, "l", 1, 5, 15, "x", 3)
    assert intervals.label_islands(left, ["r"]).first()._tile == 2
    near = intervals.nearest(spark.createDataFrame([("c", 20, "q")], "r string, p int, note string"), right, ["r"]).first()
    assert (near.distance, near.note, near.note_right) == (4, "q", "x")


@pytest.mark.parametrize("width", [None, 64])
def test_lengths_of_all_sizes_meet_as_in_brute_force(spark, width):
    rng = random.Random(21)
    size = lambda: rng.choice([0, 1, 30, 64, 65, 900, 5000, 300_000])
    make = lambda n: [(rng.choice("ab"), s, s + size()) for s in (rng.randrange(-2000, 100_000) for _ in range(n))]
    a, b = make(120) + [("a", 0, 10**6)], make(120) + [("a", 999_999, 10**6 + 5)]
    want = sorted((r, s, e, s2, e2) for r, s, e in a for q, s2, e2 in b if r == q and e2 > s and s2 < e)
    met = intervals.overlap_join(long_rows(spark, a, ["r", "s", "e"]), long_rows(spark, b, ["r", "s2", "e2"]), ["r"], width=width)
    assert sorted((x.r, x.s, x.e, x.s2, x.e2) for x in met.collect()) == want


def test_depth_over_tiles_equals_brute_force(spark):
    rng = random.Random(22)
    rows = [("ab"[rng.randrange(2)], s, s + rng.randrange(1, 40)) for s in (rng.randrange(-60, 300) for _ in range(150))]
    want = {}
    for r, s, e in rows:
        for p in range(s, e):
            want[r, p] = want.get((r, p), 0) + 1
    got = {r.r: r.depth for r in intervals.max_depth(long_rows(spark, rows, ["r", "s", "e"]), ["r"], tile=16).collect()}
    assert got == {k: max(n for (r, _), n in want.items() if r == k) for k in "ab"}
    for r in intervals.depths(long_rows(spark, rows, ["r", "s", "e"]), ["r"], tile=16).collect():
        assert r.depth == want.get((r.r, r.at), 0)


def test_repeated_queries_each_get_every_rank(spark):
    """Equal queries, null keys and positions, equal intervals: against a loop."""
    rng = random.Random(3)
    key = lambda: rng.choice([0, 1, None])
    queries = [(key(), rng.choice([None, 10, 20, 30]), n) for n in [1, 1, 2, None] * 12]
    targets = [(key(), s, s + rng.randrange(3)) for s in [*range(0, 40, 3)] * 3] + [(0, None, 4), (0, 3, None)]
    for side in ("before", "after"):
        want = []
        for k, p, n in queries:
            gap = lambda t: (p - 1 - t[2]) if side == "before" else (t[1] - p - 1)  # noqa: E731, B023
            near = sorted((gap(t), t[1], t[2]) for t in targets if None not in (k, p, *t) and t[0] == k and 0 <= gap(t) < 9)
            want += [(k, p, n, s, e, d, i + 1) for i, (d, s, e) in enumerate(near[:2])]
        q, t = spark.createDataFrame(queries, "k int, p int, n int"), spark.createDataFrame(targets, "k int, s int, e int")
        got = intervals.nearest(q, t, ["k"], side=side, k=2, max_dist=9).select("k", "p", "n", "s", "e", "distance", "rank").collect()
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_islands_say_which_names_they_need(spark):
    import pytest

    with pytest.raises(ValueError, match="island_start"):
        intervals.label_islands(spark.createDataFrame([(1, 2, 3)], "s int, e int, island_start int"), [])


def test_numbers_without_gaps_over_null_keys(spark):
    from lociq.operators import cluster

    rows = [(None, 5), ("b", 1), (None, 2), ("a", 7), ("b", 0), ("b", 0)]
    got = cluster.with_cluster_ids(spark.createDataFrame(rows, "r string, s int"), "r", ["s"]).orderBy("cluster_id").collect()
    assert [tuple(x) for x in got] == [(None, 2, 0), (None, 5, 1), ("a", 7, 2), ("b", 0, 3), ("b", 0, 4), ("b", 1, 5)]
    pairs = cluster.with_pair_ids(spark.createDataFrame([(None, 1), (12, 3), (None, None), (2, 9)], "id5p int, id3p int")).orderBy("pair_id").collect()
    assert [tuple(x) for x in pairs] == [(None, None, 0), (None, 1, 1), (12, 3, 2), (2, 9, 3)]


def test_evidence_doesnt_depend_on_carried_columns(spark):
    from lociq.operators import cluster

    clusters = spark.createDataFrame([("c", 0, 10, "+", 1, None, "x"), ("c", 0, 10, "+", 1, 4, "x"), (None, 0, 10, "+", 1, 5, "y")], "rname string, s int, e int, strand string, orient int, note int, frags2 string")
    frags = spark.createDataFrame([("c", 5, 20, "f", 30), ("c", 5, 20, "f", 30), ("c", 7, 9, "g", 8), (None, 5, 20, "f", 30)], "rname string, s2 int, e2 int, frag2 string, mate_pos int")
    assert sorted(r.frags for r in cluster.concordant_evidence(clusters, frags, ["rname"]).collect()) == [0, 1, 1]
