"""Steps that have to grow no faster than their input: results against brute force, and what their plans may not hold."""

import random

from pyspark.sql import functions as F

from lociq.operators import align, cluster, filters, intervals, simulate
from lociq.operators.graph import connected_components
from lociq.sources import reads, tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def random_rows(n, seed, span=300, longest=12):
    draw = random.Random(seed)
    out = []
    for i in range(n):
        s = draw.randrange(span)
        out.append((draw.choice(["a", "b", None]), None if i % 29 == 0 else s, s + draw.randrange(-1, longest), i % 17, draw.randrange(40)))
    return out + out[: n // 4]


ROWS = "k string, s long, e long, f long, item long"


def runs(rows, gap=0):
    """Islands by brute force: (key, start, end, rows)."""
    out = []
    for key in {r[0] for r in rows}:
        held, reach = [], None
        for r in sorted((r for r in rows if r[0] == key and r[1] is not None), key=lambda r: r[1:3]):
            if reach is None or r[1] > reach + gap:
                held.append([])
                reach = None
            held[-1].append(r)
            reach = max(x[2] for g in held for x in g)
        out += [(key, min(r[1] for r in g), max(r[2] for r in g), g) for g in held]
    return out


def key(x):
    return tuple((v is not None, v) for v in x)


def test_islands_hold_no_aggregate(spark):
    rows = random_rows(160, 1)
    df = spark.createDataFrame(rows, ROWS)
    for gap in (0, 3):
        got = intervals.islands(df, ["k"], max_gap=gap, tile=16)
        assert "HashAggregate" not in plan(got) and "Join" not in plan(got)
        # a tile's reach is that of its own islands, so an end before its start counts by tile; such rows are left out here
        whole = [r for r in rows if r[1] is None or r[2] >= r[1]]
        found = intervals.islands(spark.createDataFrame(whole, ROWS), ["k"], max_gap=gap, tile=16).collect()
        assert sorted(map(tuple, found), key=key) == sorted(((k, s, e, len(g)) for k, s, e, g in runs(whole, gap)), key=key)


def test_listed_islands_join_nothing(spark):
    rows = [r for r in random_rows(160, 2) if r[1] is None or r[2] >= r[1]]
    got = intervals.list_islands(spark.createDataFrame(rows, ROWS), ["k"], "item")
    assert "Join" not in plan(got)
    want = [(k, s, e, sorted(r[4] for r in g)) for k, s, e, g in runs(rows)]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


def components_of(links):
    least = {x: x for ab in links for x in ab}
    moved = True
    while moved:
        moved = False
        for a, b in links:
            low = min(least[a], least[b])
            moved |= least[a] != low or least[b] != low
            least[a] = least[b] = low
    return least


def test_islands_link_their_members(spark):
    rows = [(*r[:4], None if i % 11 == 0 else r[4] + i % 7 * 100) for i, r in enumerate(random_rows(120, 3, span=900)) if r[1] is None or r[2] >= r[1]]
    df = spark.createDataFrame(rows, ROWS)
    want = []
    for _, _, _, g in runs(rows):
        items = [r[4] for r in g if r[4] is not None]
        want += [(i, items[0]) for i in items]
    links = intervals.island_links(df, ["k"], "item", tile=16)
    assert "Join" not in plan(links) and links.count() <= 2 * len(rows)
    assert components_of([tuple(r) for r in links.collect()]) == components_of(want)
    assert {r.item: r.component for r in cluster.transcript_clusters(df, ["k"], "item").collect()} == components_of(want)


def test_components_draw_graphs_together(spark, monkeypatch):
    from lociq.operators import graph

    draw = random.Random(4)
    links = [(draw.randrange(90), draw.randrange(90)) for _ in range(70)] + [(1000 + i, 1001 + i) for i in range(40)] + [(7, 7), (500, 500)]
    df = spark.createDataFrame([*links, (None, 3)], "a long, b long")
    assert {r.node: r.component for r in connected_components(df).collect()} == components_of(links)
    # stars and pairs are done when they are drawn together once: no label is passed along
    monkeypatch.setattr(graph, "_propagated", None)
    stars = [(i - i % 8, i) for i in range(64)]
    assert {r.node: r.component for r in connected_components(spark.createDataFrame(stars, "a long, b long")).collect()} == components_of(stars)


def test_crossing_fragments_make_no_pairs(spark):
    rows = [r for r in random_rows(160, 5) if r[1] is not None]
    df = spark.createDataFrame(rows, ROWS)
    at = df.select("k", (F.col("s") + 3).alias("at")).distinct()
    got = filters.crossing_fraction(df, at, ["k"], "f", tile=16)
    assert "Window" in plan(got)
    spans = {}
    for k, s, e, f, _ in rows:
        lo, hi = spans.get((k, f), (s, e))
        spans[k, f] = min(lo, s), max(hi, e)
    want = []
    for k, x in {(r[0], r[1] + 3) for r in rows if r[0]}:
        if n := sum(lo < x < hi for (kk, _), (lo, hi) in spans.items() if kk == k):
            want.append((k, x, n))
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_overlapping_fragments_are_counted_once(spark):
    draw = random.Random(6)
    spans = sorted({(draw.choice("ab"), s := draw.randrange(300), s + draw.randrange(1, 90)) for _ in range(60)})
    frags = [(draw.choice("ab"), s := draw.randrange(300), s + draw.randrange(1, 150), None if i % 23 == 0 else draw.randrange(120)) for i in range(150)]
    got = cluster.count_overlapping(spark.createDataFrame(spans, "k string, s long, e long"), spark.createDataFrame(frags, "k string, s2 long, e2 long, f long"), ["k"], "f", "n", where=F.col("e2") > F.col("e"), width=32)
    met = {x: {f for k, s2, e2, f in frags if k == x[0] and e2 > x[1] and s2 < x[2] and e2 > x[2]} for x in spans}
    assert sorted(map(tuple, got.collect())) == sorted((*x, len(fs - {None})) for x, fs in met.items() if fs)


def test_totals_of_copies_meet_once(spark):
    draw = random.Random(7)
    side = lambda n, longest: [(draw.choice("ab"), s := draw.randrange(40), s + draw.randrange(1, longest)) for _ in range(n)]
    a, b = side(90, 1000), side(90, 9)
    got = intervals.overlap_totals(spark.createDataFrame(a, "k string, s long, e long"), spark.createDataFrame(b, "k string, s2 long, e2 long"), ["k"])
    want = {}
    for k, s, e in a:
        for k2, s2, e2 in b:
            if k == k2 and e2 > s and s2 < e:
                n, bases = want.get(k, (0, 0))
                want[k] = n + 1, bases + min(e, e2) - max(s, s2)
    assert {r.k: (r.pairs, r.bases) for r in got.collect()} == want


def test_spanning_reads_are_marked_before_they_meet(spark):
    from lociq.operators import spanning

    draw = random.Random(8)
    chimeras = [(i % 25, i % 4, 8 + i % 9, i % 5, i % 4) for i in range(30)]
    hits = [(draw.randrange(4), draw.randrange(40), i % 2 + 1, draw.randrange(7), 18 + draw.randrange(11), [draw.randrange(5, 20)]) for i in range(120)]
    x = spark.createDataFrame(chimeras, "chimera_id long, junction long, breakpoint int, homology_left int, homology_right int")
    a = spark.createDataFrame(hits, "junction long, qname long, mate int, pos int, end int, mismatch_at array<int>")
    known = a.filter("qname % 4 = 1").select("junction", "qname")
    how = {"least": 3, "short": 9, "mismatches": 1}
    want = {}
    for cid, j, bp, hl, hr in chimeras:
        for jj, q, mate, pos, end, spots in hits:
            left, right = bp - pos, end - bp
            few = sum(p < bp for p in spots) if left <= right else sum(p >= bp for p in spots)
            if j == jj and left >= max(hl, 3) and right >= max(hr, 3) and (min(left, right) >= 9 or few <= 1):
                want[cid, q, mate] = max(want.get((cid, q, mate), (0,)), (min(left, right), left, right))
    by_junction = spanning.merge_spanning(x, a, known, **how).collect()
    assert len(by_junction) == len(want) and {(r.chimera_id, r.qname, r.mate): (min(r.left, r.right), r.left, r.right) for r in by_junction} == want
    assert all(r.encompassing == (r.qname % 4 == 1) for r in by_junction)
    by_chimera = spanning.merge_spanning(x, a, x.select("chimera_id", "junction").join(known, "junction").select("chimera_id", "qname"), **how)
    assert sorted(map(tuple, by_chimera.collect())) == sorted(map(tuple, by_junction))


def test_breakpoint_reads_of_one_cluster_are_not_made_distinct(spark):
    from lociq.plans import discovery

    pairs = spark.createDataFrame([(1, 5, 6, ["m", "n"]), (2, 6, 6, ["m"]), (2, 6, 6, ["m"])], "pair_id int, id5p long, id3p long, qnames array<string>")
    members = spark.createDataFrame([("m", "A", None), ("n", "C", "I"), ("n", "C", "I")], "qname string, seq string, qual string")
    mates = spark.createDataFrame([("u", 5, "G", "I"), ("u", 6, "G", "I"), ("v", 6, "T", "I"), ("v", 6, "T", "I"), ("m", 6, "A", None), ("w", 9, "T", "I")], "qname string, cluster_id long, seq string, qual string")
    got = discovery.breakpoint_reads(pairs, members, mates)
    assert sorted(r.qname for r in got.collect()) == ["1:m", "1:n", "1:u", "1:v", "2:m", "2:u", "2:v"]
    assert "Window" in plan(got)


def test_local_hits_are_ranked_where_they_are_met(spark, monkeypatch):
    """No join of pairs and no window; small bounds change nothing; an id's several sequences are not mixed."""
    draw = random.Random(5)
    refs = [(f"r{i}", "".join(draw.choices("ACGT", k=draw.randrange(30, 90)))) for i in range(30)]
    reads = [(f"q{i}", (s := draw.choice(refs)[1])[: draw.randrange(9, 30)] + s[-12:]) for i in range(80)]
    r, t = spark.createDataFrame(reads, "read_id string, seq string"), spark.createDataFrame(refs, "ref_id string, seq string")
    want = {tuple(x) for x in align.local_align(r, t, anchor=8, max_hits=5).collect()}
    for name, n in {"READS_TOGETHER": 10, "READS_LEAST": 1, "REFS_TOGETHER": 4, "SEEDS_TOGETHER": 20, "HITS_HELD": 30, "HITS_GIVEN": 7, "CELLS_TOGETHER": 1500}.items():
        monkeypatch.setattr(align, name, n)
    got = align.local_align(r, t, anchor=8, max_hits=5)
    assert "Join" not in plan(got) and "Window" not in plan(got)
    rows = [tuple(x) for x in got.collect()]
    assert set(rows) == want and len(rows) == len(want) > 100
    twice = t.unionByName(spark.createDataFrame([("r0", refs[1][1]), ("r0", refs[0][1])], t.schema))
    more = {tuple(x) for x in align.local_align(r, twice, anchor=8).collect()}
    whole = {tuple(x) for x in align.local_align(r, t, anchor=8).collect()}
    assert more == whole | {(q, "r0", *x) for q, ref, *x in whole if ref == "r1"}


def test_fusions_broadcast_no_transcripts(spark):
    tx = spark.createDataFrame([("a", "ACGTAC"), ("b", "GGTTCC"), ("c", "TT")], "tx_id string, seq string")
    spec = spark.createDataFrame([("a", 1, 4, "b", 0, 3, 2.0), ("b", 0, 2, "a", 4, 9, 1.0), ("a", 0, 1, "z", 0, 1, 1.0)], "tx5p string, start5p int, end5p int, tx3p string, start3p int, end3p int, fpkm double")
    got = simulate.fuse(tx, spec)
    rows = sorted(map(tuple, got.collect()))
    assert rows == [("a-b", "CGTGGT", 2.0, 3), ("b-a", "GGAC", 1.0, 2)]
    assert "Broadcast" not in plan(got)


def test_numbered_rows_move_once(spark):
    """By sorted joins the rows are dealt by their key once, for the join with the offsets and for the ranks."""
    rows = [(draw, i * 7 % 31) for i, draw in enumerate(random.Random(6).choices(["a", "b", "c", None], k=60))]
    df = spark.createDataFrame(rows, "k string, v long")
    want = sorted((i, *r) for i, r in enumerate(sorted(rows, key=key)))
    assert sorted((r.n, r.k, r.v) for r in cluster.numbered(df, "k", ["v"], "n").collect()) == want
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = cluster.numbered(df, "k", ["v"], "n")
        held = got._jdf.queryExecution().executedPlan().toString()
        # rows, counts of keys, all offsets in order, and offsets by key
        assert held.count("Exchange") == 4 and "SortMergeJoin" in held
        assert sorted((r.n, r.k, r.v) for r in got.collect()) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_compressed_gtf_and_transcripts_are_read_back(spark, tmp_path):
    lines = [f'c{i % 3}\tens\texon\t{i * 10 + 1}\t{i * 10 + 5}\t0.0\t+\t.\ttranscript_id "t{i // 2}";' for i in range(40)]
    (tmp_path / "in.gtf").write_text("\n".join(lines) + "\n")
    gtf = reads.read_gtf(spark, str(tmp_path / "in.gtf"))
    reads.write_gtf(gtf, str(tmp_path / "out"), "gzip")
    assert {f.suffix for f in (tmp_path / "out").glob("part-*")} == {".gz"}
    back = reads.read_gtf(spark, str(tmp_path / "out"))
    assert sorted(map(str, back.collect())) == sorted(map(str, gtf.collect())) and back.count() == 40
    t = reads.gtf_transcripts(back)
    tables.write_transcripts(t, str(tmp_path / "tx"), "gzip")
    assert {f.suffix for f in (tmp_path / "tx").glob("part-*")} == {".gz"}
    assert sorted(map(str, tables.read_transcripts(spark, str(tmp_path / "tx")).collect())) == sorted(map(str, t.collect()))


def test_evidence_of_repeated_fragments_moves_no_pairs(spark):
    draw = random.Random(11)
    key = lambda: draw.choice(["a", "b", None])
    spans = [(key(), s := draw.randrange(300), s + draw.randrange(0, 200), draw.choice("+-"), draw.randrange(1, 3), i % 7) for i in range(80)]
    spans += spans[:9] + [("a", None, 5, "+", 1, 0)]
    frags = [(key(), s := draw.randrange(300), s + draw.randrange(1, 150), draw.randrange(300), None if i % 23 == 0 else draw.randrange(40)) for i in range(240)]
    frags += frags[:30]
    c = spark.createDataFrame(spans, "k string, s long, e long, strand string, orient int, tx int")
    f = spark.createDataFrame(frags, "k string, s2 long, e2 long, mate_pos long, frag2 int")
    got = cluster.concordant_evidence(c, f, ["k"], width=16)
    assert plan(got).count("Exchange hashpartitioning") == 4  # clusters once, fragments twice, and the bins' counts
    want = []
    for k, s, e, strand, orient, tx in spans:
        past = (lambda s2, e2, mp: e2 > e or mp >= e) if (strand == "+") == (orient == 1) else (lambda s2, e2, mp: s2 < s or mp < s)  # noqa: B023
        met = {q for kk, s2, e2, mp, q in frags if k and kk == k and s is not None and e2 > s and s2 < e and past(s2, e2, mp)}
        want.append((k, s, e, strand, orient, tx, len(met - {None})))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_alignments_alike_are_judged_once(spark, monkeypatch):
    from lociq.operators import spanning

    monkeypatch.setattr(spanning, "IDS_TOGETHER", 3)
    monkeypatch.setattr(spanning, "LOTS_TOGETHER", 2)
    hits = [(i % 2 if i % 19 else None, None if i == 50 else i, i % 2 + 1, i % 3, 18 + i % 2, [9] if i % 5 else None) for i in range(120)]
    places = [(i, i % 2 if i % 13 else None, 8 + i % 3, 0, 1) for i in range(60)]
    a = spark.createDataFrame(hits, "junction long, qname long, mate int, pos int, end int, mismatch_at array<int>")
    x = spark.createDataFrame(places, "chimera_id long, junction long, breakpoint int, homology_left int, homology_right int")
    got = spanning.merge_spanning(x, a, a.filter("qname % 4 = 1").select("junction", "qname"), least=3, short=0, mismatches=0)
    assert "explode(_chimeras" in plan(got) and "explode(_reads" in plan(got)
    want = [(c, q, mate, bp - pos, end - bp, q is not None and q % 4 == 1) for c, j, bp, _, _ in places for jj, q, mate, pos, end, _ in hits if j is not None and j == jj and bp - pos >= 3 and end - bp >= 3]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_references_are_written_once_for_all_blocks(spark, monkeypatch):
    monkeypatch.setattr(align, "READS_TOGETHER", 10)
    draw = random.Random(12)
    refs = [(f"r{i}", "".join(draw.choices("ACGT", k=40))) for i in range(50)]
    r, t = spark.createDataFrame([(f"q{i}", s[5:30]) for i, (_, s) in enumerate(refs)], "read_id string, seq string"), spark.createDataFrame(refs, "ref_id string, seq string")
    hits = align.local_align(r, t, anchor=10)
    assert "CartesianProduct" in plan(hits) and "Generate explode" not in plan(hits)
    assert {(f"q{i}", f"r{i}", 50) for i in range(50)} <= {(x.read_id, x.ref_id, x.score) for x in hits.collect()}
    # many letters make as many blocks as many reads do
    monkeypatch.setattr(align, "READS_TOGETHER", 1000)
    monkeypatch.setattr(align, "LETTERS_TOGETHER", 50)
    assert sorted(map(tuple, align.local_align(r, t, anchor=10).collect())) == sorted(map(tuple, hits.collect()))
