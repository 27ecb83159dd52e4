"""Queries of the interval and read-pair operators on the star-schema tables, each with its SQL.

Views stand in for genomic inputs: lineitem rows are intervals in days on a supplier, documents
give 32-letter reads, orders give pairs of ids, events give fragments. Both sides state whole
numbers as BIGINT and round fractions to six places.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociq.functions import cigar, prob, sequence
from lociq.operators import align, annotate, classify, cluster, filters, intervals, legacy, nominate, spanning, stats
from lociq.operators.graph import connected_components
from lociq.plans.storage import scratch_path
from lociq.sources import reads as io
from lociq.sources import tables

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def days(c: str):
    return F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("long")


def big(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("long") for n in names})


def r6(c):
    return F.round(c, 6)


# ---------------------------------------------------------------- views

def iv(spark, d) -> DataFrame:
    s = days("l_shipdate")
    return table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("rname"), s.alias("s"), (s + F.col("l_quantity").cast("long")).alias("e"), F.when(F.col("l_linestatus") == "O", "+").otherwise("-").alias("strand"),
        F.when(F.col("l_returnflag") == "A", 1).otherwise(2).cast("long").alias("orient"), F.col("l_orderkey").alias("frag"), F.col("l_partkey").alias("tx"), F.col("l_linenumber").cast("long").alias("n"), F.col("l_returnflag").alias("flag"))


def rd(spark, d) -> DataFrame:
    acgt = lambda c: F.translate(c, "0123456789abcdef", "ACGTACGTACGTACGT")
    return table(spark, d, "documents").select("doc_id", acgt(F.md5("text")).alias("seq"), F.md5(F.concat("source", F.col("doc_id").cast("string"))).alias("qual"), acgt(F.md5(F.concat(F.lit("x"), "text"))).alias("other"))


def ev(spark, d) -> DataFrame:
    return table(spark, d, "events").select(F.col("user_id").alias("frag"), (F.col("event_id") % 2 + 1).alias("mate"), "event_id", F.col("event_type").alias("kind"), F.floor(F.abs(F.col("value"))).alias("size"), (F.col("event_id") % 97).alias("place"))


def pk(spark, d) -> DataFrame:
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("qname"), (F.col("o_custkey") % 211).alias("id5p"), (F.col("o_orderkey") % 97).alias("id3p"), F.col("o_orderstatus").alias("status"), F.floor("o_totalprice").alias("price"), F.col("o_orderpriority").alias("prio"))


DAY = "CAST(date_diff('day', DATE '1970-01-01', CAST({} AS DATE)) AS BIGINT)"
IV = f"""iv AS (SELECT l_suppkey AS rname, {DAY.format('l_shipdate')} AS s, {DAY.format('l_shipdate')} + CAST(l_quantity AS BIGINT) AS e, CASE
WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand,
  CAST(CASE WHEN l_returnflag = 'A' THEN 1
ELSE 2 END AS BIGINT) AS orient, l_orderkey AS frag, l_partkey AS tx, CAST(l_linenumber AS BIGINT) AS n, l_returnflag AS flag FROM lineitem)"""
RD = """rd AS (SELECT doc_id, translate(md5(text), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq, md5(source || CAST(doc_id AS VARCHAR)) AS qual, translate(md5('x' || text), '0123456789abcdef', 'ACGTACGTACGTACGT') AS other
FROM documents)"""
EV = "ev AS (SELECT user_id AS frag, event_id % 2 + 1 AS mate, event_id, event_type AS kind, CAST(floor(abs(value)) AS BIGINT) AS size, event_id % 97 AS place FROM events)"
PK = "pk AS (SELECT o_orderkey AS qname, o_custkey % 211 AS id5p, o_orderkey % 97 AS id3p, o_orderstatus AS status, CAST(floor(o_totalprice) AS BIGINT) AS price, o_orderpriority AS prio FROM orders)"


def island_sql(keys: str, gap: int = 0, source: str = "iv", columns: str = "") -> str:
    return f"""r1 AS (SELECT *, max(e) OVER (PARTITION BY {keys} ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM {source}),
r2 AS (SELECT *, sum(CASE WHEN pm IS NULL OR s > pm + {gap} THEN 1 ELSE 0 END) OVER (PARTITION BY {keys} ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS g FROM r1),
isl AS (SELECT {keys}, min(s) AS island_start, max(e) AS island_end, count(*) AS members{columns} FROM r2 GROUP BY {keys}, g)"""


# ---------------------------------------------------------------- islands, range joins, nearest

@query(f"WITH {IV}, {island_sql('rname')} SELECT rname, island_start, island_end, members FROM isl")
def islands(spark, d):
    return intervals.islands(iv(spark, d), ["rname"])


@query(f"WITH {IV}, {island_sql('rname, strand, orient, tx', 30)} SELECT rname, strand, orient, tx, island_start, island_end, members FROM isl")
def islands_maxgap(spark, d):
    return intervals.islands(iv(spark, d), ["rname", "strand", "orient", "tx"], max_gap=30)


@query(f"WITH {IV}, {island_sql('rname, tx')} SELECT rname, tx, island_start, island_end, members FROM isl WHERE members >= 2")
def islands_min_members(spark, d):
    return intervals.islands(iv(spark, d), ["rname", "tx"], min_members=2)


@query(f"""
WITH {IV}, {island_sql('rname, strand, orient')} SELECT rname, strand, orient, island_start, island_end, members, CAST(CASE
WHEN (strand = '+') = (orient = 1) THEN island_end ELSE island_start END AS BIGINT) AS boundary FROM isl""")
def strand_clusters(spark, d):
    found = cluster.stranded_clusters(iv(spark, d), ["rname", "strand", "orient"])
    return found.withColumn("boundary", cluster.boundary(F.col("island_start"), F.col("island_end"), F.col("strand"), F.col("orient")))


@query(f"""
WITH {IV}, {island_sql('rname, strand, orient')}
SELECT rname, strand, orient, island_start, island_end, members, CAST(row_number() OVER (ORDER BY rname, island_start, strand, orient) - 1 AS BIGINT) AS cluster_id
FROM isl""")
def cluster_ids(spark, d):
    found = cluster.stranded_clusters(iv(spark, d), ["rname", "strand", "orient"])
    return big(cluster.with_cluster_ids(found, "rname", ["island_start", "strand", "orient"]), "cluster_id")


def _sides(spark, d):
    a = iv(spark, d)
    return a.filter("flag = 'A'").select("rname", "s", "e", "frag", "tx"), a.filter("flag = 'R'").select("rname", F.col("s").alias("s2"), F.col("e").alias("e2"), F.col("frag").alias("frag2"))


SIDES = f"{IV}, a AS (SELECT rname, s, e, frag, tx FROM iv WHERE flag = 'A'), b AS (SELECT rname, s AS s2, e AS e2, frag AS frag2 FROM iv WHERE flag = 'R')"


@query(f"""
WITH {SIDES} SELECT a.rname, count(*) AS pairs, count(DISTINCT frag2) AS frags, CAST(sum(least(e, e2) - greatest(s, s2)) AS BIGINT) AS bases FROM a
JOIN b ON a.rname = b.rname AND e2 > s AND s2 < e GROUP BY a.rname""")
def overlap_join_count(spark, d):
    a, b = _sides(spark, d)
    return intervals.overlap_join(a, b, ["rname"], width=64).groupBy("rname").agg(F.count(F.lit(1)).alias("pairs"), F.count_distinct("frag2").alias("frags"), F.sum(F.least("e", "e2") - F.greatest("s", "s2")).alias("bases"))


@query(f"WITH {SIDES} SELECT DISTINCT a.* FROM a WHERE EXISTS (SELECT 1 FROM b WHERE a.rname = b.rname AND e2 > s AND s2 < e)")
def overlap_semi(spark, d):
    a, b = _sides(spark, d)
    return intervals.overlap_exists(a.distinct(), b, ["rname"], width=64)


@query(f"WITH {SIDES} SELECT DISTINCT a.* FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE a.rname = b.rname AND e2 > s AND s2 < e)")
def overlap_anti(spark, d):
    a, b = _sides(spark, d)
    return intervals.overlap_exists(a.distinct(), b, ["rname"], anti=True, width=64)


def _queries_and_targets(spark, d):
    a = iv(spark, d)
    q = a.filter("flag = 'A'").select("rname", F.col("s").alias("p"), "strand").distinct()
    return q, a.filter("flag <> 'A'").select("rname", "s", "e").distinct()


REPEATED = f"""{IV}, q AS (SELECT frag, CASE WHEN frag % 50 = 0 THEN NULL ELSE rname END AS rname, s AS p, strand FROM iv WHERE flag = 'A'),
t AS (SELECT tx, CASE WHEN frag % 70 = 0 THEN NULL ELSE rname END AS rname, s, e FROM iv WHERE flag <> 'A')"""


NEAR = f"{IV}, q AS (SELECT DISTINCT rname, s AS p, strand FROM iv WHERE flag = 'A'), t AS (SELECT DISTINCT rname, s, e FROM iv WHERE flag <> 'A')"


def near_sql(cond: str, gap: str, k: int, where: str = "TRUE", reach: int = 90) -> str:
    return f"SELECT * FROM (SELECT q.rname, p, strand, s, e, {gap} AS distance, CAST(row_number() OVER (PARTITION BY q.rname, p, strand ORDER BY {gap}, s, e) AS BIGINT) AS rank FROM q JOIN t ON q.rname = t.rname AND {gap} >= 0 AND {gap} < {reach} WHERE {where}) WHERE rank <= {k}"


@query(f"WITH {NEAR} {near_sql('', 'p - 1 - e', 1)}")
def nearest_before(spark, d):
    q, t = _queries_and_targets(spark, d)
    return big(intervals.nearest(q, t, ["rname"], max_dist=90), "rank")


@query(f"""
WITH {REPEATED}, one AS (SELECT DISTINCT rname, p FROM q),
near AS (SELECT one.rname, p, tx, s, e, p - 1 - e AS distance, row_number() OVER (PARTITION BY one.rname, p ORDER BY p - 1 - e, tx, s, e) AS rank FROM one JOIN t ON one.rname = t.rname AND p - 1 - e BETWEEN 0 AND 59)
SELECT q.rname, q.p, q.strand, tx, s, e, distance, CAST(rank AS BIGINT) AS rank, count(*) AS rows FROM q JOIN near ON q.rname = near.rname AND q.p = near.p WHERE rank <= 2 GROUP BY ALL""")
def nearest_repeated(spark, d):
    """J2, W8 over repeated queries, repeated intervals and null keys."""
    a, null = iv(spark, d), F.lit(None)
    q = a.filter("flag = 'A'").select(F.when(F.col("frag") % 50 == 0, null).otherwise(F.col("rname")).alias("rname"), F.col("s").alias("p"), "strand")
    t = a.filter("flag <> 'A'").select("tx", F.when(F.col("frag") % 70 == 0, null).otherwise(F.col("rname")).alias("rname"), "s", "e")
    near = intervals.nearest(q, t, ["rname"], k=2, max_dist=60, ties=["tx"])
    return big(near.groupBy("rname", "p", "strand", "tx", "s", "e", "distance", "rank").agg(F.count(F.lit(1)).alias("rows")), "rank")


@query(f"WITH {NEAR} {near_sql('', 's - p - 1', 1)}")
def nearest_after(spark, d):
    q, t = _queries_and_targets(spark, d)
    return big(intervals.nearest(q, t, ["rname"], side="after", max_dist=90), "rank")


@query(f"""
WITH {NEAR} {near_sql('', 'p - 1 - e', 3, chr(115) + 'trand = ' + chr(39) + '+' + chr(39))}
UNION ALL {near_sql('', 's - p - 1', 3, 'strand = ' + chr(39) + '-' + chr(39))}""")
def upstream_k(spark, d):
    q, t = _queries_and_targets(spark, d)
    return big(intervals.nearest_stranded(q, t, ["rname"], k=3, max_dist=90), "rank")


@query(f"""
WITH {NEAR} {near_sql('', 's - p - 1', 2, 'strand = ' + chr(39) + '+' + chr(39))}
UNION ALL {near_sql('', 'p - 1 - e', 2, 'strand = ' + chr(39) + '-' + chr(39))}""")
def downstream_k(spark, d):
    q, t = _queries_and_targets(spark, d)
    return big(intervals.nearest_stranded(q, t, ["rname"], direction="downstream", k=2, max_dist=90), "rank")


@query(f"""
WITH {IV} SELECT a.rname, a.s, a.e, count(DISTINCT b.tx) AS inside FROM (SELECT DISTINCT rname, s, e FROM iv WHERE flag = 'A') a
JOIN iv b ON a.rname = b.rname AND b.s > a.s AND b.e < a.e GROUP BY 1, 2, 3""")
def containment_between(spark, d):
    a = iv(spark, d)
    met = intervals.overlap_join(a.filter("flag = 'A'").select("rname", "s", "e").distinct(), a.select("rname", F.col("s").alias("s2"), F.col("e").alias("e2"), "tx"), ["rname"], width=64)
    return met.filter("s2 > s and e2 < e").groupBy("rname", "s", "e").agg(F.count_distinct("tx").alias("inside"))


@query(f"""
WITH {IV}, x AS (SELECT rname, s AS spot, 1 AS d FROM iv UNION ALL SELECT rname, e, -1 FROM iv), y AS (SELECT rname, spot, sum(d) AS d FROM x
GROUP BY 1, 2) SELECT rname, CAST(max(c) AS BIGINT) AS depth FROM (SELECT rname, sum(d) OVER (PARTITION BY rname
ORDER BY spot ROWS UNBOUNDED PRECEDING) AS c FROM y) GROUP BY rname""")
def overlap_depth_max(spark, d):
    return big(intervals.max_depth(iv(spark, d), ["rname"]), "depth")


@query(f"""
WITH {IV}, o AS (SELECT DISTINCT rname, tx, s, e, strand FROM iv) SELECT a.rname, a.tx, a.s, a.e, a.strand FROM o a WHERE a.e - a.s >= 20
AND NOT EXISTS (SELECT 1 FROM o b WHERE a.rname = b.rname AND a.tx = b.tx AND b.e > a.s AND b.s < a.e
AND (a.s <> b.s OR a.e <> b.e OR a.strand <> b.strand))""")
def unambiguous_intervals(spark, d):
    return intervals.unambiguous(iv(spark, d), ["rname", "tx"], shape=["strand"], min_length=20, width=64)


@query(f"""WITH {IV}, {island_sql('rname, strand, orient, tx')}, c AS (SELECT rname, strand, orient, tx, island_start AS s, island_end AS e FROM isl),
f AS (SELECT rname, s AS s2, e AS e2, frag AS frag2, s + 7 AS mp FROM iv)
SELECT c.rname, c.strand, c.orient, c.tx, c.s, c.e, count(DISTINCT frag2) AS frags FROM c LEFT JOIN f ON c.rname = f.rname AND e2 > s AND s2 < e
AND CASE WHEN (strand = '+') = (orient = 1) THEN e2 > e OR mp >= e ELSE s2 < s OR mp < s END GROUP BY ALL""")
def boundary_evidence(spark, d):
    a = iv(spark, d)
    c = intervals.islands(a, ["rname", "strand", "orient", "tx"]).select("rname", "strand", "orient", "tx", F.col("island_start").alias("s"), F.col("island_end").alias("e"))
    f = a.select("rname", F.col("s").alias("s2"), F.col("e").alias("e2"), F.col("frag").alias("frag2"), (F.col("s") + 7).alias("mate_pos"))
    return cluster.concordant_evidence(c, f, ["rname"], width=64)


@query(f"""
WITH {IV}, u AS (SELECT DISTINCT rname, strand, orient, s AS s2, e AS e2, frag FROM iv WHERE flag = 'N'), {island_sql('rname, strand, orient, tx')}
SELECT c.rname, c.strand, c.orient, c.tx, c.island_start AS s, c.island_end AS e, count(DISTINCT u.frag) AS unpaired FROM isl c
JOIN u ON c.rname = u.rname AND c.strand = u.strand AND c.orient = u.orient AND e2 > island_start AND s2 < island_end GROUP BY ALL""")
def unpaired_membership(spark, d):
    a = iv(spark, d)
    c = intervals.islands(a, ["rname", "strand", "orient", "tx"]).select("rname", "strand", "orient", "tx", F.col("island_start").alias("s"), F.col("island_end").alias("e"))
    u = a.filter("flag = 'N'").select("rname", "strand", "orient", F.col("s").alias("s2"), F.col("e").alias("e2"), F.col("frag").alias("f"))
    return cluster.count_overlapping(c, u, ["rname", "strand", "orient"], "f", "unpaired", width=64)


@query(f"""
WITH {EV}, o AS (SELECT DISTINCT frag, place FROM ev), g AS (SELECT frag, place, place - row_number() OVER (PARTITION BY frag ORDER BY place) AS k
FROM o) SELECT frag, min(place) AS first, max(place) AS last, count(*) AS n FROM g GROUP BY frag, k""")
def contiguous_runs(spark, d):
    return intervals.contiguous_runs(ev(spark, d), ["frag"], "place")


# ---------------------------------------------------------------- pairs, tiers, resolution

@query(f"""
WITH {IV} SELECT a.rname AS rname5p, b.rname AS rname3p, count(*) AS pairs FROM iv a JOIN iv b ON a.frag = b.frag AND a.orient = 1 AND b.orient = 2
GROUP BY 1, 2""")
def pair_combos(spark, d):
    return classify.combinations(iv(spark, d), "frag", "orient", ["rname"]).groupBy("rname5p", "rname3p").agg(F.count(F.lit(1)).alias("pairs"))


@query(f"WITH {PK} SELECT id5p, id3p, string_agg(qname, ',' ORDER BY qname) AS qnames, count(*) AS n FROM pk GROUP BY 1, 2")
def group_pairs(spark, d):
    return pk(spark, d).groupBy("id5p", "id3p").agg(F.array_join(F.array_sort(F.collect_list("qname")), ",").alias("qnames"), F.count(F.lit(1)).alias("n"))


@query(f"""
WITH {PK}, g AS (SELECT DISTINCT id5p, id3p FROM pk)
SELECT id5p, id3p, CAST(row_number() OVER (ORDER BY CAST(id5p AS VARCHAR), CAST(id3p AS VARCHAR)) - 1 AS BIGINT) AS pair_id FROM g""")
def pair_ids(spark, d):
    return big(cluster.with_pair_ids(pk(spark, d).select("id5p", "id3p").distinct()), "pair_id")


def _mates(spark, d):
    return ev(spark, d).select((F.col("frag") % 400).alias("frag"), "mate", (F.col("event_id") % 53).alias("tx"), (F.col("event_id") % 53 % 11).alias("gene"), (F.col("size") % 2 == 0).alias("rev"))


MATES = f"{EV}, m AS (SELECT DISTINCT frag % 400 AS frag, mate, event_id % 53 AS tx, event_id % 53 % 11 AS gene, size % 2 = 0 AS rev FROM ev)"


@query(f"""WITH {MATES}, p AS (SELECT a.frag, a.tx AS tx_1, b.tx AS tx_2, a.gene = b.gene AS g, a.tx = b.tx AS t, a.rev <> b.rev AS ok FROM m a
JOIN m b ON a.frag = b.frag AND a.mate = 1 AND b.mate = 2),
k AS (SELECT *, CASE WHEN t AND ok THEN 0 WHEN g AND ok THEN 1 WHEN t THEN 2 WHEN g THEN 3 WHEN ok THEN 4 END AS tier FROM p)
SELECT frag, CAST(tier AS BIGINT) AS tier, count(*) AS pairs, CAST(sum(tx_1 * 100 + tx_2) AS BIGINT) AS key
FROM (SELECT *, min(tier) OVER (PARTITION BY frag) AS low FROM k) WHERE tier = low GROUP BY 1, 2""")
def tier_fallback(spark, d):
    return classify.tiered_pairs(_mates(spark, d), "frag", "tx", "gene", "rev").groupBy("frag", F.col("tier").cast("long").alias("tier")).agg(F.count(F.lit(1)).alias("pairs"), F.sum(F.col("tx_1") * 100 + F.col("tx_2")).alias("key"))


@query(f"WITH {PK} SELECT id5p, qname, price FROM (SELECT *, rank() OVER (PARTITION BY id5p ORDER BY price // 10000 DESC) AS r FROM pk) WHERE r = 1")
def best_score_ties(spark, d):
    return classify.best_with_ties(pk(spark, d), ["id5p"], F.floor(F.col("price") / 10000).desc()).select("id5p", "qname", "price")


@query(f"WITH {PK} SELECT id3p, qname, price FROM (SELECT *, row_number() OVER (PARTITION BY id3p ORDER BY price DESC, qname) AS r FROM pk) WHERE r = 1")
def best_one(spark, d):
    return classify.first_of(pk(spark, d), ["id3p"], F.col("price").desc(), F.col("qname")).select("id3p", "qname", "price")


@query(f"""
WITH {PK} SELECT id5p, qname, status, prio, price FROM (SELECT *, rank() OVER (PARTITION BY id5p
ORDER BY (status = 'F') DESC, prio, price // 1000 DESC, id3p) AS r FROM pk) WHERE r = 1 AND price >= 1000""")
def lexi_best(spark, d):
    return classify.best_with_ties(pk(spark, d), ["id5p"], (F.col("status") == "F").desc(), F.col("prio"), F.floor(F.col("price") / 1000).desc(), F.col("id3p")).filter("price >= 1000").select("id5p", "qname", "status", "prio", "price")


@query(f"WITH {PK} SELECT id5p, qname, price FROM pk p WHERE price <= (SELECT min(price) FROM pk q WHERE q.id5p = p.id5p) + 5000")
def mismatch_strata(spark, d):
    return classify.best_with_ties(pk(spark, d), ["id5p"], tolerance_of="price", tolerance=5000).select("id5p", "qname", "price")


@query(f"""WITH {PK},
c AS (SELECT qname % 500 AS read, qname % 7 > 3 AS spanning, price % 2 = 0 AS unambiguous, id5p % 5 AS positions, price % 4 AS mismatches, id3p / 97.0 AS probability, qname
FROM pk)
SELECT read, qname FROM (SELECT *, rank() OVER (PARTITION BY read
ORDER BY spanning DESC, unambiguous DESC, positions DESC, mismatches, probability DESC) AS r FROM c) WHERE r = 1 AND probability >= 0.1""")
def resolve_reads(spark, d):
    c = pk(spark, d).select((F.col("qname") % 500).alias("read"), (F.col("qname") % 7 > 3).alias("spanning"), (F.col("price") % 2 == 0).alias("unambiguous"), (F.col("id5p") % 5).alias("positions"), (F.col("price") % 4).alias("mismatches"), (F.col("id3p") / 97.0).alias("probability"), "qname")
    return nominate.resolve(c, "read", min_probability=0.1).select("read", "qname")


HITS = f"{EV}, h AS (SELECT frag, mate, CASE WHEN bool_or(size % 23 = 0) THEN 0 ELSE count(DISTINCT place % 3) END AS hits FROM ev GROUP BY 1, 2), r AS (SELECT frag, max(hits) AS most, CASE WHEN count(*) < 2 THEN 0 ELSE min(hits) END AS least FROM h GROUP BY 1), t AS (SELECT frag, CASE WHEN most > 2 THEN 'multimap' WHEN most = 0 THEN 'unmapped' WHEN least = 0 THEN 'unpaired' ELSE 'mapped' END AS route FROM r)"


def _routes(spark, d):
    e = ev(spark, d).withColumn("third", F.col("place") % 3).withColumn("un", F.col("size") % 23 == 0)
    return classify.route(classify.distinct_hits(e, ["frag", "mate"], ["third"], "un"), "frag", max_hits=2)


@query(f"WITH {HITS} SELECT frag, route FROM t")
def multihit_route(spark, d):
    return _routes(spark, d)


@query(f"WITH {HITS} SELECT route, count(*) AS n FROM t GROUP BY 1")
def route_counts(spark, d):
    return _routes(spark, d).groupBy("route").agg(F.count(F.lit(1)).alias("n"))


@query(f"""
WITH {EV}, x AS (SELECT frag, place, kind, min(event_id) AS event_id FROM ev GROUP BY 1, 2, 3)
SELECT frag, place, kind, event_id, count(*) OVER (PARTITION BY frag) AS nh FROM x""")
def dedupe_nh(spark, d):
    return classify.dedupe_with_count(ev(spark, d), ["frag"], ["place", "kind"], F.col("event_id")).select("frag", "place", "kind", "event_id", "nh")


@query(f"""
WITH {EV}, a AS (SELECT frag, event_id AS e1, row_number() OVER (PARTITION BY frag ORDER BY event_id) AS n FROM ev WHERE mate = 1),
b AS (SELECT frag, event_id AS e2, row_number() OVER (PARTITION BY frag ORDER BY event_id) AS n FROM ev WHERE mate = 2) SELECT a.frag, e1, e2 FROM a
JOIN b USING (frag, n)""")
def fifo_match(spark, d):
    e = ev(spark, d)
    return classify.fifo_match(e.filter("mate = 1").select("frag", F.col("event_id").alias("e1")), e.filter("mate = 2").select("frag", F.col("event_id").alias("e2")), ["frag"], ["e1"], ["e2"])


@query(f"""
WITH {PK}, s AS (SELECT id5p, string_agg(DISTINCT CAST(qname AS VARCHAR), ',' ORDER BY CAST(qname AS VARCHAR)) AS spanning FROM pk WHERE status = 'F'
GROUP BY 1) SELECT DISTINCT pk.id5p, coalesce(spanning, '') AS spanning FROM pk LEFT JOIN s USING (id5p)""")
def left_merge(spark, d):
    p = pk(spark, d)
    pairs, split = p.select(F.col("id5p").alias("pair_id")).distinct(), p.filter("status = 'F'").select(F.col("id5p").alias("pair_id"), F.col("qname").cast("string").alias("qname"))
    return spanning.with_spanning(pairs, split).select(F.col("pair_id").alias("id5p"), F.array_join("spanning_qnames", ",").alias("spanning"))


@query(f"""WITH {IV}, c AS (SELECT DISTINCT a.frag, a.s % 40 AS s1, a.s % 40 + 10 + a.n AS e1, b.s % 45 AS s2, b.s % 45 + 12 + b.n AS e2 FROM iv a
JOIN iv b ON a.frag = b.frag AND a.flag = 'A' AND b.flag = 'R')
SELECT frag, s1, e1, s2, e2 FROM c WHERE NOT (e1 > s2 AND s1 < e2) OR (abs(s1 - s2) >= 8 AND abs(e1 - e2) >= 8)""")
def split_compatible(spark, d):
    a = iv(spark, d)
    x = a.filter("flag = 'A'").select("frag", (F.col("s") % 40).alias("s1"), (F.col("s") % 40 + 10 + F.col("n")).alias("e1"))
    y = a.filter("flag = 'R'").select("frag", (F.col("s") % 45).alias("s2"), (F.col("s") % 45 + 12 + F.col("n")).alias("e2"))
    return x.join(y, "frag").distinct().filter(spanning.intervals_compatible(F.col("s1"), F.col("e1"), F.col("s2"), F.col("e2"), 8))


# ---------------------------------------------------------------- histograms and statistics

def _hist(spark, d):
    return stats.histogram(ev(spark, d), "size", 0, 500)


HIST = f"{EV}, h AS (SELECT CAST(g.size AS BIGINT) AS size, count(ev.size) AS n FROM range(0, 501) g(size) LEFT JOIN ev ON ev.size = g.size GROUP BY 1), c AS (SELECT size, n, sum(n) OVER (ORDER BY size ROWS UNBOUNDED PRECEDING) AS cum, sum(n) OVER () AS total FROM h)"


@query(f"WITH {HIST} SELECT size, n FROM h")
def isize_hist(spark, d):
    return _hist(spark, d)


@query(f"""
WITH {HIST}, s AS (SELECT CAST(sum(n) AS BIGINT) AS n, sum(size * n) AS s1, sum(size * size * n) AS s2 FROM h) SELECT n, (SELECT size FROM h
ORDER BY h.n DESC, size LIMIT 1) AS mode, round(s1 / n, 6) AS mean, round(sqrt((s2 - CAST(s1 AS DOUBLE) * s1 / n) / (n - 1)), 6) AS sd FROM s""")
def isize_stats(spark, d):
    return stats.summary(_hist(spark, d), "size").select("n", "mode", r6(F.col("mean")).alias("mean"), r6(F.col("sd")).alias("sd"))


@query(f"""
WITH {HIST} SELECT p AS percent, min(size) AS size FROM c, (VALUES (1.0::DOUBLE), (5.0), (25.0), (50.0), (75.0), (95.0), (99.0)) v(p)
WHERE cum >= total * p / 100 GROUP BY 1""")
def isize_percentile(spark, d):
    return stats.value_at_percentile(_hist(spark, d), "size", [1, 5, 25, 50, 75, 95, 99])


@query(f"WITH {HIST} SELECT size, round(1 - 2 * abs(50.0 - 100.0 * cum / total) / 100, 6)::DOUBLE AS p FROM c")
def isize_prob(spark, d):
    return stats.percentile_of_value(_hist(spark, d), "size").select("size", r6(prob.insert_size_probability(F.col("percentile"))).alias("p"))


@query(f"""
WITH {EV} SELECT CAST(CASE WHEN size <= 10 THEN 0 WHEN size <= 25 THEN 1 WHEN size <= 50 THEN 2 WHEN size <= 100 THEN 3
ELSE 4 END AS BIGINT) AS bin, count(*) AS n FROM ev GROUP BY 1""")
def hist_bins(spark, d):
    return ev(spark, d).groupBy(stats.binned(F.col("size"), [10, 25, 50, 100, 200]).cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""
WITH {EV}, x AS (SELECT kind, place, count(*) AS w FROM ev GROUP BY 1, 2), t AS (SELECT kind, sum(w) AS t, count(*) AS n FROM x GROUP BY 1)
SELECT kind, round(sum(w / t * ln(w / t * n)), 6) AS kl FROM x JOIN t USING (kind) GROUP BY 1""")
def kl_div(spark, d):
    x = ev(spark, d).groupBy("kind", "place").agg(F.count(F.lit(1)).alias("w"))
    return stats.divergence_from_uniform(x, ["kind"], "w").select("kind", r6("kl").alias("kl"))


@query(f"""
WITH {EV}, p AS (SELECT place % 5 AS x, size % 7 AS y, event_id % 3 AS z, count(*) AS n FROM ev GROUP BY 1, 2, 3)
SELECT a.x, a.y, a.z, a.n, round(a.n / (SELECT sum(n) FROM p), 6) AS pmf, round(sum(b.n) / (SELECT sum(n) FROM p), 6) AS cdf FROM p a
JOIN p b ON b.x <= a.x AND b.y <= a.y AND b.z <= a.z GROUP BY 1, 2, 3, 4""")
def ecdf3(spark, d):
    e = ev(spark, d).select((F.col("place") % 5).alias("x"), (F.col("size") % 7).alias("y"), (F.col("event_id") % 3).alias("z"))
    return stats.joint_distribution(e, "x", "y", "z").select("x", "y", "z", "n", r6("pmf").alias("pmf"), r6("cdf").alias("cdf"))


@query(f"""
WITH {EV}
SELECT kind, round(quantile_cont(size, 0.25), 6) AS q25, round(quantile_cont(size, 0.5), 6) AS q50, round(avg(size), 6) AS mean, round(stddev_samp(size), 6) AS sd
FROM ev GROUP BY 1""")
def quantiles(spark, d):
    return ev(spark, d).groupBy("kind").agg(r6(stats.interpolated_quantile(F.col("size"), 0.25)).alias("q25"), r6(stats.interpolated_quantile(F.col("size"), 0.5)).alias("q50"), r6(F.avg("size")).alias("mean"), r6(F.stddev_samp("size")).alias("sd"))


@query(f"""WITH {EV}, x AS (SELECT frag, count(*) FILTER (WHERE mate = 1) AS k, count(*) AS n FROM ev GROUP BY 1)
SELECT frag, k, n, round((SELECT sum(CASE WHEN n < 100 THEN exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)) * pow(0.5, n)
ELSE exp(-pow((i - n * 0.5) / sqrt(n * 0.25), 2) / 2) / (sqrt(n * 0.25) * sqrt(2 * pi())) END) FROM range(0, k + 1) r(i)), 6)::DOUBLE AS p FROM x""")
def binom_balance(spark, d):
    x = ev(spark, d).groupBy("frag").agg(F.count(F.when(F.col("mate") == 1, 1)).alias("k"), F.count(F.lit(1)).alias("n"))
    return x.select("frag", "k", "n", r6(filters.balance_p_value(F.col("k"), F.col("n"))).alias("p"))


@query(f"""
WITH {EV}, x AS (SELECT DISTINCT place % 15 AS k, 0.5 + size % 9 AS rate FROM ev)
SELECT k, rate::DOUBLE AS rate, round(exp(-rate) * pow(rate, k) / factorial(CAST(k AS INTEGER)), 6)::DOUBLE AS poisson, round(exp(-pow((k - rate) / 2, 2) / 2) / (2 * sqrt(2 * pi())), 6)::DOUBLE AS normal
FROM x""")
def densities(spark, d):
    x = ev(spark, d).select((F.col("place") % 15).alias("k"), (F.lit(0.5) + F.col("size") % 9).alias("rate")).distinct()
    return x.select("k", "rate", r6(prob.poisson(F.col("k"), F.col("rate"))).alias("poisson"), r6(prob.normal_pdf(F.col("k"), F.col("rate"), F.lit(2.0))).alias("normal"))


# ---------------------------------------------------------------- sequences

COMP = "reverse(translate({}, 'ACGT', 'TGCA'))"


@query(f"WITH {RD} SELECT doc_id, {COMP.format('seq')} AS rc FROM rd")
def revcomp(spark, d):
    return rd(spark, d).select("doc_id", sequence.reverse_complement(F.col("seq")).alias("rc"))


_ILLUMINA = sequence.quality_table("illumina")


@query(f"""
WITH {RD}
SELECT doc_id, translate(upper(qual) || 'hgf', '0123456789ABCDEFhgf', '{''.join(_ILLUMINA[c] for c in '0123456789ABCDEFhgf').replace(chr(39), chr(39) * 2)}') AS q
FROM rd""")
def qual_convert(spark, d):
    return rd(spark, d).select("doc_id", sequence.convert_quality(F.concat(F.upper("qual"), F.lit("hgf")), "illumina").alias("q"))


@query(f"WITH {RD} SELECT doc_id, substr(seq, 4, 24) AS seq, substr(qual, 4, 24) AS qual FROM rd")
def trim_reads(spark, d):
    return rd(spark, d).select("doc_id", sequence.trim(F.col("seq"), 3, 5).alias("seq"), sequence.trim(F.col("qual"), 3, 5).alias("qual"))


@query(f"""
WITH {RD}, b(k, a, z) AS (VALUES (0, 0, 11), (1, 11, 22), (2, 22, 32)) SELECT doc_id, CAST(k AS BIGINT) AS segment, substr(seq, a + 1, z - a) AS seq
FROM rd, b""")
def segment_reads(spark, d):
    cuts = F.array(*[F.struct(F.lit(i).cast("long").alias("segment"), F.lit(a).alias("a"), F.lit(z).alias("z")) for i, (a, z) in enumerate(sequence.segment_bounds(32, 10))])
    return rd(spark, d).withColumn("x", F.explode(cuts)).select("doc_id", "x.segment", F.expr("substring(seq, x.a + 1, x.z - x.a)").alias("seq"))


@query(f"""
WITH {RD}, n AS (SELECT doc_id, 'r' || CAST(doc_id AS VARCHAR) || '/' || CAST(doc_id % 2 + 1 AS VARCHAR) || ' ' || qual AS name FROM rd)
SELECT doc_id, split_part(split_part(name, ' ', 1), '/', 1) AS name FROM n""")
def name_clean(spark, d):
    name = F.concat(F.lit("r"), F.col("doc_id").cast("string"), F.lit("/"), (F.col("doc_id") % 2 + 1).cast("string"), F.lit(" "), F.col("qual"))
    return rd(spark, d).select("doc_id", sequence.clean_name(name).alias("name"))


@query(f"WITH {RD} SELECT doc_id, rtrim(regexp_replace(seq || seq || other || seq, '(.{{50}})', '\\1' || chr(10), 'g'), chr(10)) AS fasta FROM rd")
def wrap50(spark, d):
    return rd(spark, d).select("doc_id", sequence.wrap(F.concat("seq", "seq", "other", "seq")).alias("fasta"))


@query(f"""
WITH {RD}, x AS (SELECT doc_id, [i FOR i IN range(1, 33) IF substr(seq, i, 1) <> substr(other, i, 1)] AS w FROM rd)
SELECT doc_id, CAST(coalesce(w[1] - 1, 32) AS BIGINT) AS h0, CAST(coalesce(w[3] - 1, 32) AS BIGINT) AS h2, CAST(len(w) AS BIGINT) AS mismatches FROM x""")
def homology_prefix(spark, d):
    a, b = F.col("seq"), F.col("other")
    return rd(spark, d).select("doc_id", sequence.homology(a, b).cast("long").alias("h0"), sequence.homology(a, b, 2).cast("long").alias("h2"), sequence.mismatches_between(a, b).cast("long").alias("mismatches"))


def _md(spark, d):
    return rd(spark, d).select("doc_id", F.concat((F.col("doc_id") % 17).cast("string"), F.substring("seq", 1, 1), (F.col("doc_id") % 5).cast("string"), F.lit("^"), F.substring("seq", 2, 2), F.lit("7"), F.substring("seq", 9, 1), F.lit("3")).alias("md"), "seq")


@query(f"""
WITH {RD}
SELECT doc_id, '3' || translate(substr(seq, 9, 1), 'ACGT', 'TGCA') || '7^' || {COMP.format('substr(seq, 2, 2)')} || CAST(doc_id % 5 AS VARCHAR) || translate(substr(seq, 1, 1), 'ACGT', 'TGCA') || CAST(doc_id % 17 AS VARCHAR) AS md
FROM rd""")
def md_revcomp(spark, d):
    return _md(spark, d).select("doc_id", sequence.md_reverse_complement(F.col("md")).alias("md"))


@query(f"WITH {RD} SELECT doc_id, CAST(doc_id % 17 AS VARCHAR) || ',' || CAST(doc_id % 17 + 1 + doc_id % 5 + 7 AS VARCHAR) AS at FROM rd")
def mismatch_positions(spark, d):
    return _md(spark, d).select("doc_id", F.array_join(sequence.md_mismatches(F.col("md")).cast("array<string>"), ",").alias("at"))


def _cigars(spark, d):
    n = lambda k: (F.col("doc_id") % k + 1).cast("string")
    c = F.when(F.col("doc_id") % 3 == 0, F.concat(n(7), F.lit("S"), n(11), F.lit("M"), n(13), F.lit("N"), n(5), F.lit("M"))).when(F.col("doc_id") % 3 == 1, F.concat(n(11), F.lit("M2I"), n(5), F.lit("M"), n(7), F.lit("S"))).otherwise(F.concat(n(11), F.lit("M3D"), n(5), F.lit("M")))
    return rd(spark, d).select("doc_id", (F.col("doc_id") * 3 + 100).cast("int").alias("pos"), cigar.parse(c).alias("ops"))


@query(f"""
WITH {RD}, x AS (SELECT doc_id, doc_id * 3 + 100 AS p, doc_id % 11 + 1 AS m, doc_id % 5 + 1 AS k, doc_id % 13 + 1 AS n FROM rd)
SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN p || '-' || (p + m) || ',' || (p + m + n) || '-' || (p + m + n + k) WHEN 1 THEN p || '-' || (p + m + k)
ELSE p || '-' || (p + m + 3 + k) END AS blocks FROM x""")
def cigar_blocks(spark, d):
    b = cigar.blocks(F.col("pos"), F.col("ops"))
    return _cigars(spark, d).select("doc_id", F.array_join(F.transform(b, lambda x: F.concat_ws("-", x["start"].cast("string"), x["end"].cast("string"))), ",").alias("blocks"))


@query(f"""
WITH {RD}, x AS (SELECT doc_id, doc_id * 3 + 100 AS p, doc_id % 11 + 1 AS m, doc_id % 5 + 1 AS k, doc_id % 13 + 1 AS n, doc_id % 7 + 1 AS c FROM rd)
SELECT doc_id, CAST(CASE doc_id % 3 WHEN 0 THEN p - c ELSE p END AS BIGINT) AS clip_start, CAST(CASE doc_id % 3 WHEN 0 THEN p + m + n + k
WHEN 1 THEN p + m + k + c ELSE p + m + 3 + k END AS BIGINT) AS clip_end, CAST(CASE doc_id % 3 WHEN 0 THEN c WHEN 1 THEN 0
ELSE 0 END AS BIGINT) AS best_start, CAST(CASE doc_id % 3 WHEN 0 THEN c + m + k WHEN 1 THEN m + 2 + k ELSE m + k END AS BIGINT) AS best_end FROM x""")
def clip_interval(spark, d):
    x = _cigars(spark, d).withColumn("c", cigar.clipped_interval(F.col("pos"), F.col("ops"))).withColumn("b", cigar.best_read_interval(F.col("ops")))
    return x.select("doc_id", F.col("c.start").cast("long").alias("clip_start"), F.col("c.end").cast("long").alias("clip_end"), F.col("b.start").cast("long").alias("best_start"), F.col("b.end").cast("long").alias("best_end"))


def _exons(spark, d):
    ex = F.array(*[F.struct((F.col("doc_id") * 10 + a).cast("int").alias("start"), (F.col("doc_id") * 10 + b).cast("int").alias("end")) for a, b in ((100, 120), (150, 160), (200, 240))])
    return rd(spark, d).select("doc_id", ex.alias("exons"), F.when(F.col("doc_id") % 2 == 0, "+").otherwise("-").alias("strand"), (F.col("doc_id") % 75).cast("int").alias("pos"))


@query(f"""WITH {RD}, x AS (SELECT doc_id, doc_id * 10 AS o, doc_id % 75 AS p, doc_id % 2 = 0 AS plus FROM rd)
SELECT doc_id, CAST(CASE WHEN plus THEN CASE WHEN p < 20 THEN o + 100 + p WHEN p < 30 THEN o + 150 + p - 20 WHEN p < 70 THEN o + 200 + p - 30
ELSE -1 END ELSE CASE WHEN p < 40 THEN o + 239 - p WHEN p < 50 THEN o + 159 - (p - 40) WHEN p < 70 THEN o + 119 - (p - 50)
ELSE -1 END END AS BIGINT) AS genome,
CAST(CASE WHEN p >= 70 THEN -1 WHEN plus THEN CASE WHEN p < 20 THEN 0 WHEN p < 30 THEN 1 ELSE 2 END ELSE CASE WHEN p < 40 THEN 0 WHEN p < 50 THEN 1
ELSE 2 END END AS BIGINT) AS exon FROM x""")
def to_genome(spark, d):
    x = _exons(spark, d)
    return x.select("doc_id", F.coalesce(cigar.genome_position(F.col("exons"), F.col("strand"), F.col("pos")), F.lit(-1)).cast("long").alias("genome"), F.coalesce(cigar.exon_of(F.col("exons"), F.col("strand"), F.col("pos"))["exon"], F.lit(-1)).cast("long").alias("exon"))


@query(f"""WITH {RD}, x AS (SELECT doc_id, doc_id * 10 AS o, doc_id % 45 AS p, doc_id % 2 = 0 AS plus FROM rd)
SELECT doc_id, CASE WHEN plus THEN CASE WHEN p < 20 AND p + 25 > 30 THEN (20 - p) || 'M30N10M40N' || (p + 25 - 30) || 'M' WHEN p < 20
AND p + 25 > 20 THEN (20 - p) || 'M30N' || (p + 5) || 'M' WHEN p < 20 THEN '25M' WHEN p < 30 THEN (30 - p) || 'M40N' || (p - 5) || 'M' ELSE '25M' END
ELSE CASE WHEN p + 25 <= 40 THEN '25M' WHEN p < 40 AND p + 25 <= 50 THEN (p - 15) || 'M40N' || (40 - p) || 'M'
WHEN p < 40 THEN (p + 25 - 50) || 'M30N10M40N' || (40 - p) || 'M' ELSE (p + 25 - 50) || 'M30N' || (50 - p) || 'M' END END AS cigar FROM x""")
def cigar_to_genome(spark, d):
    x = _exons(spark, d).withColumn("pos", (F.col("doc_id") % 45).cast("int")).withColumn("ops", cigar.parse(F.lit("25M")))
    return x.select("doc_id", cigar.render(cigar.genome_ops(F.col("exons"), F.col("strand"), F.col("pos"), F.col("ops"))).alias("cigar"))


@query(f"""
WITH {RD}, o AS (SELECT substr(seq, 1, 6) AS seq, list_sort(list(DISTINCT doc_id)) AS m FROM rd GROUP BY 1)
SELECT seq, 'B' || lpad(CAST(row_number() OVER (ORDER BY seq) - 1 AS VARCHAR), 7, '0') AS name, array_to_string(m, ',') AS members FROM o""")
def seq_dedupe_names(spark, d):
    x = rd(spark, d).select(F.substring("seq", 1, 6).alias("seq"), F.col("doc_id").alias("member"))
    return nominate.name_sequences(x, "seq").select("seq", "name", F.array_join(F.col("members").cast("array<string>"), ",").alias("members"))


@query(f"""
WITH {RD}, x AS (SELECT doc_id, doc_id % 30 + 4 AS l, (doc_id * 7) % 30 + 4 AS r, doc_id % 9 AS hl, doc_id % 6 AS hr, doc_id % 4 AS mm FROM rd)
SELECT doc_id, l >= greatest(hl, 6) AND r >= greatest(hr, 6) AND (least(l, r) >= 12 OR mm <= 1) AS ok FROM x""")
def anchor_test(spark, d):
    c = F.col("doc_id")
    return rd(spark, d).select("doc_id", filters.anchor_ok(c % 30 + 4, (c * 7) % 30 + 4, c % 9, c % 6, c % 4, least=6, short=12, mismatches=1).alias("ok"))


# ---------------------------------------------------------------- graphs, isoforms, types, filters

def _edges(spark, d):
    k = F.col("o_orderkey")
    return table(spark, d, "orders").select(k.alias("a"), (k - k % 8 + F.col("o_custkey") % 8).alias("b"))


@query("""
WITH RECURSIVE e AS (SELECT DISTINCT o_orderkey AS a, o_orderkey - o_orderkey % 8 + o_custkey % 8 AS b FROM orders), u AS (SELECT a, b FROM e UNION
SELECT b, a FROM e), w(node, root) AS (SELECT a, a FROM u UNION SELECT u.b, w.root FROM w JOIN u ON u.a = w.node) SELECT node, min(root) AS component
FROM w GROUP BY 1""")
def components(spark, d):
    return connected_components(_edges(spark, d))


def _tx(spark, d):
    return iv(spark, d).select("rname", "strand", "tx", "s", "e", F.col("frag").alias("tx_id"))


@query(f"""WITH RECURSIVE {IV}, x AS (SELECT rname, strand, tx, s, e, frag AS tx_id FROM iv),
r1 AS (SELECT *, max(e) OVER (PARTITION BY rname, strand, tx ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM x),
r2 AS (SELECT *, sum(CASE WHEN pm IS NULL OR s > pm THEN 1 ELSE 0 END) OVER (PARTITION BY rname, strand, tx
ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS g FROM r1),
m AS (SELECT DISTINCT tx_id, rname, strand, tx, g FROM r2), u AS (SELECT DISTINCT a.tx_id AS a, b.tx_id AS b FROM m a JOIN m b USING (rname, strand, tx, g)),
w(node, root) AS (SELECT a, a FROM u UNION SELECT u.b, w.root FROM w JOIN u ON u.a = w.node) SELECT node AS tx_id, min(root) AS component FROM w GROUP BY 1""")
def transcript_components(spark, d):
    return cluster.transcript_clusters(_tx(spark, d), ["rname", "strand", "tx"])


@query(f"""
WITH {PK} SELECT id5p, status, prio, min(price) AS tx_start, max(price) AS tx_end, string_agg(qname, ',' ORDER BY qname) AS names FROM pk
GROUP BY 1, 2, 3""")
def isoform_merge(spark, d):
    p = pk(spark, d)
    exons = F.array(F.struct(F.col("price").cast("int").alias("start"), (F.col("price") + 1).cast("int").alias("end")))
    t = p.select(F.concat_ws("|", F.col("id5p").cast("string"), "status", "prio").alias("chrom"), F.lit("+").alias("strand"), F.lit(0).alias("cluster_id"), F.col("price").alias("tx_start"), F.col("price").alias("tx_end"), F.lit("na").alias("gene_biotype"), F.col("qname").alias("tx_id"), exons.alias("exons"), *[F.array(F.col("qname")).alias(c) for c in ("tx_names", "gene_names", "annotation_sources")])
    k = F.split("chrom", r"\|")
    return cluster.merge_isoforms(t).select(k[0].cast("long").alias("id5p"), k[1].alias("status"), k[2].alias("prio"), "tx_start", "tx_end", F.array_join(F.col("tx_names").cast("array<string>"), ",").alias("names"))


def _typed(spark, d):
    p = pk(spark, d)
    c = F.col
    return p.select(c("qname").alias("pair_id"), (c("id5p") % 3).alias("rname5p"), (c("id3p") % 3).alias("rname3p"), (c("id5p") * 4).alias("start5p"), (c("id5p") * 4 + 60).alias("end5p"), (c("id3p") * 5).alias("start3p"), (c("id3p") * 5 + 40).alias("end3p"), F.when(c("price") % 2 == 0, "+").otherwise("-").alias("strand5p"), F.when(c("price") % 3 == 0, "+").otherwise("-").alias("strand3p"), (c("price") % 5 % 3).alias("between_same"), (c("price") % 5).alias("between_all"))


@query(f"""WITH {PK},
p AS (SELECT qname AS pair_id, id5p % 3 AS r5, id3p % 3 AS r3, id5p * 4 AS s5, id5p * 4 + 60 AS e5, id3p * 5 AS s3, id3p * 5 + 40 AS e3, price % 2 = 0 AS p5, price % 3 = 0 AS p3, price % 5 % 3 AS bs, price % 5 AS ba
FROM pk),
q AS (SELECT *, p5 = p3 AS same, CASE WHEN s5 <= s3 THEN p5 ELSE NOT p5 END AS ahead FROM p),
k AS (SELECT *, CASE WHEN same AND ahead THEN bs ELSE ba END > 0 AS btw FROM q)
SELECT pair_id, CASE WHEN r5 <> r3 THEN 'Interchromosomal'
WHEN e5 > s3 AND s5 < e3 THEN CASE WHEN same AND ahead THEN 'Overlapping_Same' WHEN same THEN 'Overlapping_Complex'
WHEN ahead THEN 'Overlapping_Converging' ELSE 'Overlapping_Diverging' END
WHEN btw THEN CASE WHEN same AND ahead THEN 'Intrachromosomal' WHEN same THEN 'Intrachromosomal_Complex' WHEN ahead THEN 'Intrachromosomal_Converging'
ELSE 'Intrachromsomal_Diverging' END
ELSE CASE WHEN same AND ahead THEN 'Read_Through' WHEN same THEN 'Adjacent_Complex' WHEN ahead THEN 'Adjacent_Converging'
ELSE 'Adjacent_Diverging' END END AS chimera_type,
CAST(CASE WHEN r5 <> r3 THEN -1 WHEN e5 > s3 AND s5 < e3 THEN 0 WHEN s5 <= s3 THEN s3 - e5 ELSE e3 - s5 END AS BIGINT) AS distance FROM k""")
def type_decision(spark, d):
    return annotate.type_and_distance(_typed(spark, d)).select("pair_id", "chimera_type", "distance")


CAND = f"{PK}, c AS (SELECT qname, price % 30 AS num_frags, price % 41 AS d5, price % 17 AS c5, price % 37 AS d3, price % 13 AS c3, id5p, id3p, prio, status FROM pk)"
FRACTION = "least(coalesce(num_frags / nullif(d5 + c5, 0), 0.0), coalesce(num_frags / nullif(d3 + c3, 0), 0.0))"


def _candidates(spark, d):
    c = F.col
    return pk(spark, d).select("qname", (c("price") % 30).alias("num_frags"), (c("price") % 41).alias("num_discordant_frags_5p"), (c("price") % 17).alias("num_concordant_frags_5p"), (c("price") % 37).alias("num_discordant_frags_3p"), (c("price") % 13).alias("num_concordant_frags_3p"), F.array("prio").alias("biotypes_5p"), F.array("status").alias("biotypes_3p"), c("id5p").alias("rname5p"), c("id3p").alias("rname3p"))


@query(f"WITH {CAND} SELECT qname, num_frags, round({FRACTION}, 6) AS fraction FROM c WHERE num_frags >= 3 AND {FRACTION} >= 0.25")
def allele_filter(spark, d):
    f = filters.allele_fraction(*[F.col(x) for x in ("num_frags", "num_discordant_frags_5p", "num_concordant_frags_5p", "num_discordant_frags_3p", "num_concordant_frags_3p")])
    return filters.final_filter(_candidates(spark, d), min_frags=3, min_fraction=0.25).select("qname", "num_frags", r6(f).alias("fraction"))


@query(f"""
WITH {CAND} SELECT qname, num_frags FROM c WHERE num_frags >= 2 AND prio NOT IN ('1-URGENT', 'O') AND status NOT IN ('1-URGENT', 'O')
AND id5p NOT IN (5, 7) AND id3p NOT IN (5, 7)""")
def mask_filter(spark, d):
    return filters.final_filter(_candidates(spark, d), mask_biotypes=["1-URGENT", "O"], mask_rnames=[5, 7]).select("qname", "num_frags")


@query(f"WITH {PK} SELECT qname, id5p, id3p FROM pk WHERE (id5p, id3p) NOT IN (SELECT id5p, id3p FROM pk WHERE status = 'P')")
def false_pos_anti(spark, d):
    p = pk(spark, d)
    return filters.without(p, p.filter("status = 'P'"), ["id5p", "id3p"]).select("qname", "id5p", "id3p")


@query(f"WITH {PK} SELECT id5p, id3p, count(DISTINCT prio) AS samples FROM pk GROUP BY 1, 2 HAVING count(DISTINCT prio) >= 2")
def recurrence(spark, d):
    return filters.recurrent(pk(spark, d), ["id5p", "id3p"], "prio", 2)


@query(f"""
WITH {PK}, x AS (SELECT qname, price % 20 + 1 AS n, price % 31 AS w5, price % 29 AS w3 FROM pk)
SELECT qname, round(least(n / (n + w5), n / (n + w3)), 6) AS fraction FROM x WHERE least(n / (n + w5), n / (n + w3)) >= 0.3""")
def isoform_fraction(spark, d):
    c = F.col("price")
    f = filters.isoform_fraction(c % 20 + 1, c % 31, c % 29)
    return pk(spark, d).withColumn("f", f).filter("f >= 0.3").select("qname", r6("f").alias("fraction"))


@query(f"""
WITH {IV}, b AS (SELECT DISTINCT rname, s + 3 AS spot FROM iv), f AS (SELECT rname, frag, min(s) AS lo, max(e) AS hi FROM iv GROUP BY 1, 2)
SELECT b.rname, spot AS \"at\", count(*) AS wild FROM b JOIN f ON b.rname = f.rname AND lo < spot AND spot < hi GROUP BY 1, 2""")
def crossing_fragments(spark, d):
    a = iv(spark, d)
    return filters.crossing_fraction(a, a.select("rname", (F.col("s") + 3).alias("at")).distinct(), ["rname"], "frag")


@query(f"""
WITH {PK}, m AS (SELECT id5p, id3p, max(price) AS most FROM pk GROUP BY 1, 2), t AS (SELECT id5p, sum(most) AS total FROM m GROUP BY 1)
SELECT id5p, id3p, round(most / total, 6) AS share FROM m JOIN t USING (id5p)""")
def promiscuity(spark, d):
    return filters.promiscuity(pk(spark, d), ["id5p", "id3p"], "id5p", "price").select("id5p", "id3p", r6("share").alias("share"))


@query(f"WITH {EV} SELECT kind, round(sum(1.0 / (place + 1)::DOUBLE), 6) AS weight FROM ev GROUP BY 1")
def weighted_cov(spark, d):
    return filters.weighted_coverage(ev(spark, d).withColumn("hits", F.col("place") + 1), ["kind"], "hits").select("kind", r6("weight").alias("weight"))


@query(f"WITH {IV} SELECT rname, round(quantile_cont(e, 0.95) - quantile_cont(s, 0.05), 6) AS spread FROM iv GROUP BY 1")
def p95_spread(spark, d):
    return filters.spread(iv(spark, d), ["rname"], "s", "e").select("rname", r6("spread").alias("spread"))


@query(f"""
WITH {IV}, p AS (SELECT a.frag, a.rname, greatest(a.e, b.e) - least(a.s, b.s) AS isize FROM iv a JOIN iv b ON a.frag = b.frag AND a.rname = b.rname
AND a.orient = 1 AND b.orient = 2 AND a.strand <> b.strand) SELECT frag, rname, isize, count(*) OVER (PARTITION BY frag) AS nh FROM p
WHERE isize BETWEEN 5 AND 400""")
def concordant_pairs(spark, d):
    a = iv(spark, d)
    one = a.filter("orient = 1").select("frag", "rname", "s", "e", (F.col("strand") == "-").alias("rev"))
    two = a.filter("orient = 2").select("frag", "rname", F.col("s").alias("s2"), F.col("e").alias("e2"), (F.col("strand") == "-").alias("rev2"))
    return filters.concordant_pairs(one.join(two, ["frag", "rname"]), lo=5, hi=400).select("frag", "rname", "isize", "nh")


@query("SELECT c_custkey, 'chr' || n_name AS chrom FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey <> 2")
def chrom_rename(spark, d):
    from lociq.plans.discovery import rename_references

    names = table(spark, d, "nation").filter("n_regionkey <> 2").select(F.col("n_nationkey").cast("string").alias("old"), F.concat(F.lit("chr"), "n_name").alias("new"))
    return rename_references(table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("chrom")), names, "chrom")


@query(f"""WITH {PK}, f AS (SELECT qname AS frag, id5p % 5 AS tx5, id3p % 5 AS tx3, price % 150 AS pos5, 50 + price % 130 AS pos3 FROM pk),
x5 AS (SELECT t AS tx5, k AS exon5, 40 + k * (30 + t) AS end5 FROM range(0, 5) a(t), range(0, 5) b(k)),
x3 AS (SELECT t AS tx3, k AS exon3, k * (25 + t) AS start3 FROM range(0, 5) a(t), range(0, 5) b(k)),
m AS (SELECT *, end5 - pos5 + pos3 - start3 AS isize FROM f JOIN x5 USING (tx5) JOIN x3 USING (tx3) WHERE end5 > pos5 AND start3 < pos3)
SELECT frag, exon5, exon3, isize FROM (SELECT *, rank() OVER (PARTITION BY frag ORDER BY abs(isize - 100)) AS r FROM m) WHERE r = 1""")
def exon_breakpoint_argmax(spark, d):
    c = F.col
    f = pk(spark, d).select(c("qname").alias("frag"), (c("id5p") % 5).alias("tx5"), (c("id3p") % 5).alias("tx3"), (c("price") % 150).alias("pos5"), (50 + c("price") % 130).alias("pos3"))
    g = spark.range(25).select((c("id") % 5).alias("t"), F.floor(c("id") / 5).alias("k"))
    x5, x3 = g.select(c("t").alias("tx5"), c("k").alias("exon5"), (40 + c("k") * (30 + c("t"))).alias("end5")), g.select(c("t").alias("tx3"), c("k").alias("exon3"), (c("k") * (25 + c("t"))).alias("start3"))
    return nominate.best_breakpoints(f, x5, x3, 100).select("frag", "exon5", "exon3", "isize")


@query(f"""
WITH {PK}
SELECT id5p, id3p, max(price) AS best, arg_max(qname, (price, qname)) AS best_id, count(DISTINCT status) AS txs, count(DISTINCT qname) AS ids FROM pk
GROUP BY 1, 2""")
def report_groups(spark, d):
    x = pk(spark, d).select("id5p", "id3p", F.col("status").alias("tx5"), F.col("status").alias("tx3"), F.col("price").alias("best"), F.col("qname").alias("chimera_id"))
    return nominate.group_report(x, ["id5p", "id3p"], "best").select("id5p", "id3p", "best", "best_id", F.size("txs5").cast("long").alias("txs"), F.size("chimera_ids").cast("long").alias("ids"))


# ---------------------------------------------------------------- annotation and orientation

@query(f"""
WITH {PK}, a AS (SELECT id5p, list_sort(list(DISTINCT CAST(qname AS VARCHAR))) AS d FROM pk WHERE status <> 'P' GROUP BY 1),
b AS (SELECT id5p, list_sort(list(DISTINCT CAST(qname - qname % 4 AS VARCHAR))) AS s FROM pk WHERE status = 'F' GROUP BY 1)
SELECT id5p, CAST(len(list_distinct(list_concat(d, coalesce(s, [])))) AS BIGINT) AS num_frags, CAST(len(coalesce(s, [])) AS BIGINT) AS num_spanning
FROM a LEFT JOIN b USING (id5p)""")
def fragment_totals(spark, d):
    p = pk(spark, d)
    a = p.filter("status <> 'P'").groupBy(F.col("id5p").alias("pair_id")).agg(F.collect_set(F.col("qname").cast("string")).alias("qnames"))
    split = p.filter("status = 'F'").select(F.col("id5p").alias("pair_id"), (F.col("qname") - F.col("qname") % 4).cast("string").alias("qname"))
    both = spanning.with_spanning(a, split)
    return both.select(F.col("pair_id").alias("id5p"), F.size(F.array_union("qnames", "spanning_qnames")).cast("long").alias("num_frags"), F.size("spanning_qnames").cast("long").alias("num_spanning"))


@query(f"""
WITH {PK}, x AS (SELECT id5p, string_agg(DISTINCT 'g' || id3p % 9, ','
ORDER BY 'g' || id3p % 9) FILTER (WHERE status <> 'O') AS genes, string_agg(DISTINCT prio, ',' ORDER BY prio) AS biotypes FROM pk GROUP BY 1)
SELECT id5p, coalesce(genes, 'na') AS genes, coalesce(biotypes, 'na') AS biotypes FROM x""")
def annotation_names(spark, d):
    t = pk(spark, d).select("id5p", F.array(F.concat(F.lit("g"), (F.col("id3p") % 9).cast("string"))).alias("gene_names"), F.array(F.col("qname").cast("string")).alias("tx_names"), F.col("prio").alias("gene_biotype"), F.array(F.when(F.col("status") == "O", "other").otherwise("ensembl")).alias("annotation_sources"))
    return annotate.names_of(t, ["id5p"], "ensembl").select("id5p", F.array_join("genes", ",").alias("genes"), F.array_join("biotypes", ",").alias("biotypes"))


@query(f"WITH {RD} SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '20-50,60-100' ELSE '' END AS introns FROM rd")
def exon_introns(spark, d):
    e = lambda *x: F.array(*[F.struct(F.lit(a).alias("start"), F.lit(b).alias("end")) for a, b in x])
    x = rd(spark, d).withColumn("exons", F.when(F.col("doc_id") % 2 == 0, e((0, 20), (50, 60), (100, 120))).otherwise(e((0, 20))))
    return x.select("doc_id", F.array_join(F.transform(cigar.introns(F.col("exons")), lambda i: F.concat_ws("-", i["start"].cast("string"), i["end"].cast("string"))), ",").alias("introns"))


@query(f"""WITH {RD},
x AS (SELECT doc_id, doc_id * 10 + 90 + doc_id % 130 AS a, doc_id * 10 + 95 + doc_id % 130 AS b, doc_id * 10 AS o, doc_id % 2 = 0 AS plus FROM rd),
e(k, p, q, up, dn) AS (VALUES (1, 100, 120, 0, 50), (2, 150, 160, 20, 40), (3, 200, 240, 30, 0)),
m AS (SELECT *, greatest(o + p, a) AS lo, least(o + q, b) AS hi FROM x, e WHERE o + q > a AND o + p < b)
SELECT doc_id, CAST(sum(CASE WHEN plus THEN up + lo - o - p ELSE dn + o + q - hi END) AS BIGINT) AS first, CAST(sum(CASE
WHEN plus THEN up + hi - o - p
ELSE dn + o + q - lo END) AS BIGINT) AS last, CAST(sum(greatest(0, o + p - a)) AS BIGINT) AS left_over, CAST(sum(greatest(0, b - o - q)) AS BIGINT) AS right_over
FROM m GROUP BY 1""")
def genome_to_transcript(spark, d):
    x = _exons(spark, d).withColumn("a", (F.col("doc_id") * 10 + 90 + F.col("doc_id") % 130).cast("int"))
    t = x.select("doc_id", F.explode(cigar.transcript_interval(F.col("exons"), F.col("strand"), F.col("a"), F.col("a") + 5)).alias("t"))
    return t.groupBy("doc_id").agg(F.sum("t.start").alias("first"), F.sum("t.end").alias("last"), F.sum("t.left_over").alias("left_over"), F.sum("t.right_over").alias("right_over"))


@query(f"""
WITH {EV}, x AS (SELECT event_id, mate, size % 2 = 0 AS rev FROM ev) SELECT event_id, CAST(CASE WHEN rev THEN 2
ELSE 1 END AS BIGINT) AS unstranded, CAST(CASE WHEN mate = 2 THEN 1 ELSE 2 END AS BIGINT) AS firststrand, CASE WHEN (mate = 1) <> rev THEN '+'
ELSE '-' END AS strand FROM x""")
def orientations(spark, d):
    e = ev(spark, d).withColumn("rev", F.col("size") % 2 == 0)
    return e.select("event_id", classify.orientation(F.col("rev"), F.col("mate")).cast("long").alias("unstranded"), classify.orientation(F.col("rev"), F.col("mate"), classify.FIRST_STRAND).cast("long").alias("firststrand"), classify.strand(F.col("rev"), F.col("mate"), F.lit("+"), classify.SECOND_STRAND).alias("strand"))


@query(f"""WITH {RD},
x AS (SELECT doc_id, substr(seq, 1, CAST(doc_id % 20 + 4 AS BIGINT)) AS a, substr(other, 1, CAST(doc_id % 15 + 3 AS BIGINT)) AS b, seq, other
FROM rd),
w AS (SELECT *, [i FOR i IN range(1, 33) IF substr(seq, i, 1) <> substr(b, i, 1)] AS m FROM x)
SELECT doc_id, lpad(right(a, 11), 11, 'N') || rpad(left(b, 11), 11, 'N') AS seq, CAST(coalesce(m[1] - 1, length(b)) AS BIGINT) AS hom FROM w""")
def breakpoint_sequence(spark, d):
    n = lambda c, k: F.substring(c, F.lit(1), k.cast("int"))
    x = rd(spark, d).select("doc_id", n(F.col("seq"), F.col("doc_id") % 20 + 4).alias("seq5"), n(F.col("other"), F.col("doc_id") % 15 + 3).alias("seq3"), F.col("seq").alias("after5"), F.col("other").alias("before3"))
    return nominate.breakpoint_sequences(x, 12).select("doc_id", "seq", F.col("hom_right").cast("long").alias("hom"))


@query(f"""
WITH {EV}
SELECT kind, round(avg(size) - 1.959963984540054 * stddev_samp(size) / sqrt(count(*)), 6) AS low, round(avg(size) + 1.959963984540054 * stddev_samp(size) / sqrt(count(*)), 6) AS high
FROM ev GROUP BY 1""")
def mean_intervals(spark, d):
    x = ev(spark, d).groupBy("kind").agg(stats.mean_interval(F.col("size")).alias("m"))
    return x.select("kind", r6("m.low").alias("low"), r6("m.high").alias("high"))


@query(f"""
WITH {IV} SELECT rname, tx, min(s) AS lo, max(e) AS hi, CAST(max(e) - min(s) AS BIGINT) AS span, count(*) FILTER (WHERE flag = 'N') AS fresh FROM iv
GROUP BY 1, 2 HAVING max(e) - min(s) <= 400""")
def span_filter(spark, d):
    x = iv(spark, d).groupBy("rname", "tx").agg(F.min("s").alias("lo"), F.max("e").alias("hi"), F.count(F.when(F.col("flag") == "N", 1)).alias("fresh"))
    return x.withColumn("span", F.col("hi") - F.col("lo")).filter(filters.insert_size_ok(F.col("span"), F.col("span"), 400, together=False))


# ---------------------------------------------------------------- legacy operators

@query(f"""
WITH {IV}, i AS (SELECT *, s - n AS cs, e + n AS ce, rname + s AS b FROM iv) SELECT rname, count(*) AS n FROM i WHERE cs < 9000 + n * 100
AND 9000 + n * 100 < ce GROUP BY 1""")
def boundary_spanning(spark, d):
    c = F.col
    return iv(spark, d).filter(legacy.spans_boundary(c("s") - c("n"), c("e") + c("n"), 9000 + c("n") * 100)).groupBy("rname").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {IV} SELECT rname, tx, count(DISTINCT s) AS positions FROM iv GROUP BY 1, 2 HAVING count(DISTINCT s) >= 2")
def unique_positions(spark, d):
    return legacy.enough_positions(iv(spark, d), ["rname", "tx"], "s", 2)


@query(f"""
WITH {PK} SELECT qname FROM pk WHERE id5p <= 90 AND id3p <= 90 AND id5p - id3p <> 0
AND (id5p + id3p <= 2 * 60 OR abs(id5p - id3p) <= 20 OR prio[1:1] = CAST(id3p % 5 + 1 AS VARCHAR))""")
def distance_filters(spark, d):
    c = F.col
    near = legacy.genomically_concordant(F.abs(c("id5p") - c("id3p")), 20, (F.array(F.substring("prio", 1, 1)), F.array((c("id3p") % 5 + 1).cast("string"))))
    return pk(spark, d).filter(legacy.inner_distance_ok(c("id5p"), c("id3p"), 90) & legacy.apart(c("id5p") - c("id3p")) & (filters.insert_size_ok(c("id5p"), c("id3p"), 60) | near)).select("qname")


@query(f"WITH {PK} SELECT qname, id5p % 7 AS r5, id3p % 7 AS r3 FROM pk WHERE id5p % 7 <> id3p % 7")
def inter_reference(spark, d):
    p = pk(spark, d).select("qname", (F.col("id5p") % 7).alias("r5"), (F.col("id3p") % 7).alias("r3"))
    return p.filter(legacy.between_references(F.col("r5"), F.col("r3")))


@query(f"""
WITH {RD} SELECT doc_id, CAST(doc_id % 7 AS VARCHAR) || 'A' || CAST(doc_id % 5 + doc_id % 11 AS VARCHAR) || 'C' || CAST(doc_id % 3 AS VARCHAR) AS md
FROM rd""")
def md_merge(spark, d):
    t = lambda k: (F.col("doc_id") % k).cast("string")
    return rd(spark, d).select("doc_id", legacy.md_merge(F.concat(t(7), F.lit("A"), t(5)), F.concat(t(11), F.lit("C"), t(3))).alias("md"))


@query(f"""
WITH {RD}, x AS (SELECT doc_id, [[doc_id % 3, 9], [doc_id % 3, doc_id % 2 + 20], [doc_id % 2 + 20, 30], [doc_id % 5 + 40]] AS ids FROM rd)
SELECT doc_id, CASE WHEN TRUE THEN '2,3' END AS cuts FROM x""")
def split_points(spark, d):
    c = F.col("doc_id")
    ids = F.array(F.array(c % 3, F.lit(9).cast("long")), F.array(c % 3, c % 2 + 20), F.array(c % 2 + 20, F.lit(30).cast("long")), F.array(c % 5 + 40))
    return rd(spark, d).select("doc_id", F.array_join(legacy.split_points(ids).cast("array<string>"), ",").alias("cuts"))


@query(f"""
WITH {EV}, h AS (SELECT frag, place % 7 AS r, min(size) AS lo, max(size) AS hi, count(DISTINCT mate) AS sides, count(*) AS n FROM ev GROUP BY 1, 2)
SELECT frag, r, CASE WHEN sides = 1 THEN (SELECT min(CAST(mate AS VARCHAR)) FROM ev WHERE ev.frag = h.frag AND place % 7 = r) ELSE '.' END AS strand
FROM h""")
def strand_prediction(spark, d):
    e = ev(spark, d).select(F.struct("frag", (F.col("place") % 7).alias("r")).alias("read"), F.col("mate").cast("string").alias("strand"))
    return legacy.predict_strand(e, "read", "strand").select("read.frag", "read.r", "strand")


@query(f"""
WITH {EV}, g AS (SELECT frag, count(*) AS ih, count(DISTINCT place) AS nh FROM ev GROUP BY 1)
SELECT e.frag, e.event_id, CAST(row_number() OVER (PARTITION BY e.frag ORDER BY e.event_id) - 1 AS BIGINT) AS hi, ih, nh FROM ev e JOIN g USING (frag)""")
def multihit_tags(spark, d):
    return big(legacy.annotate_multihits(ev(spark, d), ["frag"], ["place"], F.col("event_id")).select("frag", "event_id", "hi", "ih", "nh"), "hi")


@query(f"""
WITH {IV}, x AS (SELECT rname, s AS spot, 1 AS d FROM iv UNION ALL SELECT rname, e, -1 FROM iv), y AS (SELECT rname, spot, sum(d) AS d FROM x
GROUP BY 1, 2 HAVING sum(d) <> 0) SELECT rname, spot AS \"at\", CAST(sum(d) OVER (PARTITION BY rname
ORDER BY spot ROWS UNBOUNDED PRECEDING) AS BIGINT) AS depth FROM y""")
def pileup(spark, d):
    return big(legacy.pileup(iv(spark, d), ["rname"], "s", "e"), "depth")


@query(f"WITH {EV} SELECT frag, round(sum(1.0 / (place + 1)::DOUBLE), 6) AS score FROM ev WHERE size >= 10 GROUP BY 1")
def spanning_score(spark, d):
    return legacy.spanning_score(ev(spark, d).withColumn("m", F.col("place") + 1), ["frag"], "size", "m", 10).select("frag", r6("score").alias("score"))


@query(f"""
WITH {IV},
m AS (SELECT frag, count(*) FILTER (WHERE orient = 1) AS n1, count(*) FILTER (WHERE orient = 2) AS n2, count(DISTINCT rname % 5) AS refs, max(e) - min(s) AS isize
FROM iv GROUP BY 1) SELECT frag, isize FROM m WHERE n1 = 1 AND n2 = 1 AND refs = 1""")
def unique_isizes(spark, d):
    return legacy.unique_insert_sizes(iv(spark, d).withColumn("mate", F.col("orient")).withColumn("rname", F.col("rname") % 5), "frag")


@query(f"""WITH {PK}, p AS (SELECT qname, price % 6 AS x, id5p % 5 AS y, id3p % 4 AS z FROM pk), g AS (SELECT x, y, z, count(*) AS n FROM p
GROUP BY 1, 2, 3), c AS (SELECT a.x, a.y, a.z, sum(b.n) / (SELECT count(*) FROM p) AS prob FROM g a JOIN g b ON b.x <= a.x AND b.y <= a.y
AND b.z <= a.z GROUP BY 1, 2, 3),
s AS (SELECT p.*, prob FROM p JOIN c USING (x, y, z)) SELECT qname, round(prob, 6)::DOUBLE AS prob FROM s
WHERE prob >= (SELECT quantile_cont(prob, 0.9) FROM s) - 1e-12""")
def empirical_rank(spark, d):
    p = pk(spark, d).select("qname", (F.col("price") % 6).alias("x"), (F.col("id5p") % 5).alias("y"), (F.col("id3p") % 4).alias("z"))
    return legacy.rank_empirically(p, ("x", "y", "z"), 90).select("qname", r6("prob").alias("prob"))


@query(f"""WITH {PK}, p AS (SELECT qname, price % 6 - 3 AS x, id5p % 5 AS y, -(id3p % 4) AS z FROM pk), g AS (SELECT x, y, z, count(*) AS n FROM p GROUP BY 1, 2, 3),
c AS (SELECT a.x, a.y, a.z, 1 - sum(b.n) / (SELECT count(*) FROM p) AS prob FROM g a JOIN g b ON b.x <= a.x AND b.y <= a.y AND b.z <= a.z GROUP BY 1, 2, 3),
s AS (SELECT p.*, prob FROM p JOIN c USING (x, y, z)) SELECT qname, round(prob, 6)::DOUBLE AS prob FROM s WHERE prob <= (SELECT quantile_cont(prob, 0.1) FROM s) + 1e-12""")
def histogram_rank(spark, d):
    """The histogram's form, over figures below, at and above 0."""
    p = pk(spark, d).select("qname", (F.col("price") % 6 - 3).alias("x"), (F.col("id5p") % 5).alias("y"), (-(F.col("id3p") % 4)).alias("z"))
    return legacy.rank_by_histogram(p, ("x", "y", "z"), 10).select("qname", r6("prob").alias("prob"))


@query(f"""
WITH {IV}, x AS (SELECT DISTINCT rname AS chrom, frag AS tx_id, s, e, strand FROM iv), {island_sql('chrom', 0, 'x')},
k AS (SELECT DISTINCT x.chrom, i.island_start, x.strand FROM x JOIN isl i ON x.chrom = i.chrom AND x.s >= i.island_start AND x.s <= i.island_end),
o AS (SELECT *, CAST(row_number() OVER (ORDER BY chrom, island_start, strand) - 1 AS BIGINT) AS cluster FROM k)
SELECT x.chrom, x.tx_id, x.s AS tx_start, x.e AS tx_end, x.strand, o.cluster FROM x JOIN isl i ON x.chrom = i.chrom AND x.s >= i.island_start
AND x.s <= i.island_end JOIN o ON o.chrom = x.chrom AND o.island_start = i.island_start AND o.strand = x.strand""")
def span_clusters(spark, d):
    t = iv(spark, d).select(F.col("rname").alias("chrom"), F.col("frag").alias("tx_id"), F.col("s").alias("tx_start"), F.col("e").alias("tx_end"), "strand").distinct()
    return big(legacy.span_clusters(t), "cluster")


@query(f"""
WITH {EV}, t AS (SELECT frag, kind, list_sort(list(DISTINCT place % 9)) AS segs FROM ev WHERE event_id % 3 > 0 GROUP BY 1, 2), l AS (SELECT frag, segs, string_agg(kind, '+' ORDER BY kind) AS kinds FROM t GROUP BY 1, 2),
o AS (SELECT frag, list(segs ORDER BY len(segs) DESC, segs) AS items FROM l GROUP BY 1),
p AS (SELECT frag, list_reduce(items, lambda a, x: CASE WHEN list_has_any(a, x) THEN a ELSE list_concat(a, [-1], x) END, []::BIGINT[]) AS used FROM o)
SELECT frag, array_to_string(used, ',') AS picks FROM p""")
def mate_clusters(spark, d):
    """C11: lists of segments with their gaps, greedily."""
    e = ev(spark, d).filter("event_id % 3 > 0").withColumn("seg", F.col("place") % 9)
    picks = legacy.merge_mate_clusters(e, "frag", "kind", "seg")
    return picks.select("frag", F.array_join(F.flatten(F.transform("picks", lambda p: F.concat(F.array(F.lit(-1)), p["segments"]))).cast("array<string>"), ",").alias("picks"))


_TILED = "list_filter(c, lambda x, i: (m >> (i - 1)) & 1 = 1)"


@query(f"""
WITH {EV}, t AS (SELECT frag, kind, list_sort(list(DISTINCT place % 6)) AS segs FROM ev WHERE event_id % 4 = 0 AND kind IS NOT NULL GROUP BY 1, 2),
l AS (SELECT frag, list(DISTINCT segs) AS c FROM t GROUP BY 1), m AS (SELECT frag, c, unnest(range(1, 1 << len(c))) AS m FROM l), s AS (SELECT frag, {_TILED} AS tiling FROM m),
ok AS (SELECT frag, list_sort(tiling) AS tiling, list_reverse_sort(list_transform(tiling, lambda x: len(x))) AS sizes FROM s WHERE len(flatten(tiling)) = len(list_distinct(flatten(tiling)))),
best AS (SELECT *, rank() OVER (PARTITION BY frag ORDER BY sizes DESC) AS r FROM ok)
SELECT frag, string_agg(array_to_string(list_transform(tiling, lambda x: array_to_string(x, '.')), ' '), '|' ORDER BY tiling) AS tilings FROM best WHERE r = 1 GROUP BY 1""")
def segment_tilings(spark, d):
    """All best tilings, against all subsets of the candidates."""
    e = ev(spark, d).filter("event_id % 4 = 0").withColumn("seg", F.col("place") % 6)
    tiled = legacy.segment_tilings(e, "frag", ["kind"], "seg")
    one = lambda t: F.array_join(F.transform(F.filter(t, lambda p: p["mapped"]), lambda p: F.array_join(p["segments"].cast("array<string>"), ".")), " ")
    return tiled.filter(F.exists("tilings", lambda t: F.exists(t, lambda p: p["mapped"]))).select("frag", F.array_join(F.transform("tilings", one), "|").alias("tilings"))


@query("""
WITH x AS (SELECT DISTINCT p_size AS chrom, p_partkey % 10 * 100 AS a, p_partkey % 10 * 100 + p_size + 5 AS b FROM part)
SELECT CAST(chrom AS BIGINT) AS chrom, CAST(a + 4 AS BIGINT) AS start, CAST(b AS BIGINT) AS stop FROM x""")
def splice_junctions(spark, d):
    p, c = table(spark, d, "part"), F.col
    a, b = (c("p_partkey") % 10 * 100).cast("int"), (c("p_partkey") % 10 * 100 + c("p_size") + 5).cast("int")
    t = p.select(c("p_size").alias("chrom"), F.lit("+").alias("strand"), F.array(F.struct(a.alias("start"), (a + 5).alias("end")), F.struct(b.alias("start"), (b + 9).alias("end"))).alias("exons"))
    return big(legacy.splice_junctions(t).select("chrom", "start", F.col("end").alias("stop")), "chrom", "start", "stop")


# ---------------------------------------------------------------- files: written to the shared folder and read back

@query(f"WITH {RD} SELECT CAST(doc_id + 1 AS VARCHAR) AS qname, CAST(1 AS BIGINT) AS mate, seq, qual FROM rd")
def fastq_files(spark, d):
    r = rd(spark, d).select((F.col("doc_id") + 1).alias("frag_id"), F.lit(1).alias("mate"), "seq", "qual")
    io.write_fastq(r, path := scratch_path(spark, "fastq"))
    return big(io.read_fastq(spark, path).select("qname", "mate", "seq", "qual"), "mate")


@query(f"WITH {RD} SELECT doc_id, substr(seq, 6, 20) AS seq, CAST(32 AS BIGINT) AS length FROM rd")
def fasta_fetch(spark, d):
    r = rd(spark, d)
    io.write_fasta(r, path := scratch_path(spark, "fasta"), "doc_id", 10)
    genome = io.read_fasta(spark, path, chunk=8)
    spans = r.select(F.col("doc_id").cast("string").alias("chrom"), F.lit(5).alias("s"), F.lit(25).alias("e"))
    return io.fetch(genome, spans, ["chrom"], 8).join(io.reference_lengths(genome), "chrom").select(F.col("chrom").cast("long").alias("doc_id"), "seq", "length")


@query(f"""WITH {RD}, x AS (SELECT doc_id, doc_id * 3 + 100 AS p, doc_id % 11 + 1 AS m, doc_id % 5 + 1 AS k, doc_id % 13 + 1 AS n FROM rd)
SELECT 'q' || doc_id AS qname, CAST(CASE WHEN doc_id % 2 = 0 THEN 16 ELSE 0 END AS BIGINT) AS flag, p AS pos, CASE doc_id % 3
WHEN 0 THEN p + m + n + k WHEN 1 THEN p + m + k ELSE p + m + 3 + k END AS "end", doc_id % 4 AS nh, 'chr' || (doc_id % 5) AS rname FROM x""")
def sam_files(spark, d):
    c = F.col
    a = _cigars(spark, d).select(F.concat(F.lit("q"), c("doc_id").cast("string")).alias("qname"), F.when(c("doc_id") % 2 == 0, 16).otherwise(0).alias("flag"), F.concat(F.lit("chr"), (c("doc_id") % 5).cast("string")).alias("rname"), "pos", F.lit(60).alias("mapq"), c("ops").alias("cigar"),
        F.lit(None).cast("string").alias("rnext"), F.lit(-1).alias("pnext"), F.lit(0).alias("tlen"), F.lit("*").alias("seq"), F.lit("*").alias("qual"), F.create_map(F.lit("NH"), (c("doc_id") % 4).cast("string"), F.lit("MD"), F.lit("5A3")).alias("tags"))
    io.write_sam(a, path := scratch_path(spark, "sam"))
    return big(io.read_sam(spark, path).select("qname", "flag", "pos", "end", "nh", "rname"), "flag", "pos", "end", "nh")


@query(f"""
WITH {IV}, x AS (SELECT DISTINCT rname, frag, s, e, strand FROM iv WHERE e > s)
SELECT 'c' || rname AS chrom, 't' || frag AS tx, CAST(min(s) AS BIGINT) AS tx_start, max_by(e, (s, e)) AS tx_end, count(DISTINCT (s, e)) AS exon_count, min(strand) AS strand
FROM x GROUP BY rname, frag""")
def gtf_files(spark, d):
    c = F.col
    x = iv(spark, d).filter("e > s").select(F.concat(F.lit("c"), c("rname").cast("string")).alias("seqid"), F.lit("ens").alias("source"), F.lit("exon").alias("feature_type"), c("s").cast("int").alias("start"), c("e").cast("int").alias("end"), F.lit(0.0).alias("score"), "strand", F.lit(".").alias("phase"), F.create_map(F.lit("transcript_id"), F.concat(F.lit("t"), c("frag").cast("string"))).alias("attrs"))
    io.write_gtf(x, path := scratch_path(spark, "gtf"), "gzip")
    t = io.gtf_transcripts(io.read_gtf(spark, path))
    tables.write_transcripts(t, again := scratch_path(spark, "transcripts"), "gzip")
    return big(tables.read_transcripts(spark, again).select("chrom", F.get("tx_names", F.lit(0)).alias("tx"), "tx_start", "tx_end", "exon_count", "strand"), "tx_start", "tx_end", "exon_count")


@query(f"""
WITH {PK}, g AS (SELECT id5p, id3p, string_agg(qname, ',' ORDER BY qname) AS qnames FROM pk GROUP BY 1, 2)
SELECT CAST(row_number() OVER (ORDER BY CAST(id5p AS VARCHAR), CAST(id3p AS VARCHAR)) - 1 AS BIGINT) AS pair_id, id5p, id3p, qnames FROM g""")
def pair_files(spark, d):
    p = pk(spark, d).groupBy("id5p", "id3p").agg(F.array_sort(F.collect_list("qname")).cast("array<string>").alias("qnames"))
    tables.write_pairs(cluster.with_pair_ids(p), path := scratch_path(spark, "pairs"))
    return big(tables.read_pairs(spark, path).select("pair_id", "id5p", "id3p", F.array_join("qnames", ",").alias("qnames")), "pair_id", "id5p", "id3p")


@query(f"WITH {HIST} SELECT size AS isize, n AS num_samples FROM h")
def insert_size_files(spark, d):
    tables.write_insert_sizes(_hist(spark, d).select(F.col("size").alias("isize"), F.col("n").alias("num_samples")), path := scratch_path(spark, "isizes"))
    return big(tables.read_insert_sizes(spark, path), "isize")


@query(f"WITH {HITS} SELECT frag, route FROM t")
def route_files(spark, d):
    legacy.write_routes(_routes(spark, d), path := scratch_path(spark, "routes"))
    return spark.read.schema("frag bigint, route string").parquet(path)


# ---------------------------------------------------------------- own semantics

@query(f"""WITH {RD}, r AS (SELECT DISTINCT seq AS ref FROM rd), q AS (SELECT doc_id, substr(seq, 5, 24) AS query FROM rd)
SELECT doc_id, min(i - 1) AS pos, count(*) AS hits FROM q, r, range(1, 10) g(i) WHERE substr(ref, i, 24) = query GROUP BY 1""")
def kmer_align(spark, d):
    r = rd(spark, d)
    refs = r.select("seq").distinct().withColumn("ref_id", F.col("seq"))
    hits = align.align(r.select(F.col("doc_id").alias("read_id"), F.substring("seq", 5, 24).alias("seq")), refs, k=12, max_mismatches=0, max_hits=1000)
    return hits.filter("strand = '+'").groupBy(F.col("read_id").alias("doc_id")).agg(F.min("pos").cast("long").alias("pos"), F.count(F.lit(1)).alias("hits"))


@query("SELECT p_partkey AS tx_id, CAST(round(p_retailprice * 32 / 1000.0 * (100000 / 1e6)) AS BIGINT) AS frags FROM part")
def simulate_counts(spark, d):
    from lociq.operators.simulate import fragment_counts

    tx = table(spark, d, "part").select(F.col("p_partkey").alias("tx_id"), F.md5("p_name").alias("seq"), F.col("p_retailprice").alias("fpkm"))
    return fragment_counts(tx, 100_000).select("tx_id", "frags")


def queries() -> dict:
    from lociq import catalog_reads  # noqa: F401  registers its own

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    from lociq import catalog_reads  # noqa: F401

    return dict(_SQL)
