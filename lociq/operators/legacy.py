"""Operators of older designs that current plans don't need: segment joining, split points, ranking, pileups."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lociq.operators.intervals import depths
from lociq.operators.stats import joint_distribution

# ---------------------------------------------------------------- predicates


def spans_boundary(clip_start: Column, clip_end: Column, boundary: Column) -> Column:
    """The clipped interval strictly contains the boundary."""
    return (clip_start < boundary) & (boundary < clip_end)


def enough_positions(df: DataFrame, keys: list[str], position: str, least: int) -> DataFrame:
    """(keys, positions): candidates with enough distinct alignment positions."""
    return df.groupBy(*keys).agg(F.count_distinct(position).alias("positions")).filter(F.col("positions") >= least)


def inner_distance_ok(d5: Column, d3: Column, most: int) -> Column:
    return (d5 <= most) & (d3 <= most)


def apart(distance: Column) -> Column:
    """Drops overlapping partners."""
    return distance != 0


def between_references(rname: Column, rnext: Column) -> Column:
    return rname.isNotNull() & rnext.isNotNull() & (rname != rnext)


def genomically_concordant(distance: Column, most: int, *shared: tuple[Column, Column]) -> Column:
    """Near enough, or sharing an item of any pair of sets (transcripts, genes)."""
    ok = F.coalesce(distance <= most, F.lit(False))
    for a, b in shared:
        ok |= F.coalesce(F.arrays_overlap(a, b), F.lit(False))
    return ok


# ---------------------------------------------------------------- segments of a read


def md_merge(first: Column, second: Column) -> Column:
    """MD of two adjacent segments: the counts that meet are added."""
    tail, head = F.regexp_extract(first, "([0-9]+)$", 1), F.regexp_extract(second, "^([0-9]+)", 1)
    met = (tail != "") & (head != "")
    total = (F.nullif(tail, F.lit("")).cast("int") + F.nullif(head, F.lit("")).cast("int")).cast("string")
    return F.when(met, F.concat(F.regexp_replace(first, "[0-9]+$", ""), total, F.regexp_replace(second, "^[0-9]+", ""))).otherwise(F.concat(first, second))


def split_points(ids: Column) -> Column:
    """Where a read's segments (arrays of cluster ids, in order) fall apart: indices at which no id is shared with the run so far."""
    empty = F.array().cast("array<int>")
    return F.aggregate(
        F.slice(ids, 2, F.greatest(F.size(ids) - 1, F.lit(0))),
        F.struct(ids[0].alias("run"), F.lit(1).alias("at"), empty.alias("cuts")),
        lambda a, x: F.when(F.size(F.array_intersect(a["run"], x)) > 0, F.struct(F.array_intersect(a["run"], x).alias("run"), (a["at"] + 1).alias("at"), a["cuts"].alias("cuts"))).otherwise(F.struct(x.alias("run"), (a["at"] + 1).alias("at"), F.concat(a["cuts"], F.array(a["at"])).alias("cuts"))),
        lambda a: a["cuts"],
    )


def best_tilings(candidates: list[tuple[int, ...]]) -> list[list[tuple[int, ...]]]:
    """All sets of disjoint candidates whose sizes, largest first, are the greatest: the largest piece counts first, then the second, and so on.

    Sizes are chosen one after another. Of the sets that agree so far those go on that can take
    the greatest size that any can take, so what is left at the end has the best sizes.
    """
    every = [(len(c), frozenset(c), c) for c in dict.fromkeys(tuple(sorted(set(c))) for c in candidates) if c]
    front = {frozenset(): frozenset()}  # a set of candidates, and the segments that they take
    done = [()]
    while front:
        done = sorted(tuple(sorted(chosen)) for chosen in front)
        grown: dict[int, dict] = {}
        for chosen, used in front.items():
            for n, parts, c in every:
                if not used & parts:
                    grown.setdefault(n, {})[chosen | {c}] = used | parts
        front = grown[max(grown)] if grown else {}
    return [list(x) for x in done]


def filled_tiling(tiling: list[tuple[int, ...]], segments: int) -> list[tuple[list[int], bool]]:
    """(segments, mapped) of a tiling's pieces in the read's order, the runs of segments that none takes being unmapped pieces."""
    free = sorted(set(range(segments)) - {i for c in tiling for i in c})
    runs: list[list[int]] = []
    for i in free:
        if runs and runs[-1][-1] == i - 1:
            runs[-1].append(i)
        else:
            runs.append([i])
    return sorted([(list(c), True) for c in tiling] + [(r, False) for r in runs])


def segment_tilings(alignments: DataFrame, fragment: str, place: list[str], segment: str) -> DataFrame:
    """(fragment, tilings): the best ways to put a read together from alignments of its segments.

    alignments: the fragment, its segment's number from 0, and the columns ``place`` that alignments
    share which join up (null where the segment is unmapped). Segments joined at one place are a
    candidate. A tiling is a list of (segments, mapped); all that are best by ``best_tilings`` are
    given, in order. The last segment's number tells how many there are. Rows with a null segment are
    left out, repeated rows count once. A read has few segments, so its distinct candidates are few,
    however many places it has: they are counted out before they meet.
    """
    here = F.when(F.col(place[0]).isNotNull(), F.struct(*place)) if len(place) > 1 else F.col(place[0])
    rows = alignments.filter(F.col(segment).isNotNull()).select(fragment, here.alias("_place"), F.col(segment).cast("int").alias("_seg"))
    joined = rows.filter("_place is not null").groupBy(fragment, "_place").agg(F.sort_array(F.collect_set("_seg")).alias("_set"))
    sets = joined.select(fragment, "_set").distinct().groupBy(fragment).agg(F.collect_list("_set").alias("_sets"))
    sizes = rows.groupBy(fragment).agg((F.max("_seg") + 1).alias("_n"))

    @F.pandas_udf("array<array<struct<segments:array<int>,mapped:boolean>>>")
    def tile(found: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([[[{"segments": s, "mapped": m} for s, m in filled_tiling(t, int(k))] for t in best_tilings([tuple(map(int, c)) for c in (f if f is not None else [])])] for f, k in zip(found, n, strict=True)])

    return sizes.join(sets, fragment, "left").select(fragment, tile(F.coalesce("_sets", F.array().cast("array<array<int>>")), F.col("_n")).alias("tilings"))


def merge_mate_clusters(df: DataFrame, fragment: str, cluster: str, segment: str) -> DataFrame:
    """(fragment, picks): each fragment's clusters by the segments that they hold, those kept that share none.

    A cluster's segments are a list of numbers, with the gaps that it has. Lists are taken with the
    most segments first, then the least list, and left out where they share a segment with one
    taken before. picks are (segments, clusters) in that order, clusters being all with that
    list. Rows with a null segment are left out; repeated rows count once.
    """
    of = df.filter(F.col(segment).isNotNull()).groupBy(fragment, cluster).agg(F.sort_array(F.collect_set(F.col(segment).cast("int"))).alias("segments"))
    lists = of.groupBy(fragment, "segments").agg(F.sort_array(F.collect_list(cluster)).alias("clusters"))
    item = F.struct((-F.size("segments")).alias("less"), "segments", "clusters")
    ordered = lists.groupBy(fragment).agg(F.sort_array(F.collect_list(item)).alias("items"))
    none = F.filter("items", lambda x: F.lit(False))
    picked = F.aggregate("items", none, lambda a, x: F.when(F.exists(a, lambda p: F.arrays_overlap(p["segments"], x["segments"])), a).otherwise(F.concat(a, F.array(x))))
    return ordered.select(fragment, F.transform(picked, lambda p: F.struct(p["segments"].alias("segments"), p["clusters"].alias("clusters"))).alias("picks"))


#: The tags in which an alignment of a segmented read tells its partition, its split and its mapping, each counted from 0.
PART_TAG, SPLIT_TAG, HIT_TAG = "XP", "XK", "XI"


def segment_columns(alignments: DataFrame, *, part: str = PART_TAG, split: str = SPLIT_TAG, hit: str = HIT_TAG) -> DataFrame:
    """(qname, mate, part, split, hit, aln) of alignments as ``read_sam`` gives them, for ``segmented``: the numbers are read from their tags.

    aln has the alignment's own columns. An alignment without a tag counts as the first there.
    """
    number = lambda t: F.coalesce(F.col("tags")[t].try_cast("int"), F.lit(0))
    own = [c for c in ("flag", "rname", "pos", "end", "mapq", "cigar", "seq", "qual") if c in alignments.columns]
    return alignments.select("qname", "mate", number(part).alias("part"), number(split).alias("split"), number(hit).alias("hit"), F.struct(*own).alias("aln"))


def segmented(alignments: DataFrame) -> DataFrame:
    """(qname, mate, partitions): alignments nested by partition, then split, then mapping.

    Needs the columns part, split, hit and aln (the alignment's columns as a struct).
    """
    hits = alignments.groupBy("qname", "mate", "part", "split").agg(F.array_sort(F.collect_list(F.struct("hit", "aln"))).alias("hits"))
    splits = hits.groupBy("qname", "mate", "part").agg(F.array_sort(F.collect_list(F.struct("split", "hits"))).alias("splits"))
    return splits.groupBy("qname", "mate").agg(F.array_sort(F.collect_list(F.struct("part", "splits"))).alias("partitions"))


# ---------------------------------------------------------------- clusters and strands


def span_clusters(transcripts: DataFrame) -> DataFrame:
    """Adds cluster, from 0: transcripts whose spans overlap on a chromosome, split by strand."""
    from lociq.operators.cluster import with_cluster_ids
    from lociq.operators.intervals import label_islands

    t = label_islands(transcripts.withColumn("s", F.col("tx_start")).withColumn("e", F.col("tx_end")), ["chrom"]).drop("s", "e", "island_end")
    one = with_cluster_ids(t.select("chrom", "island_start", "strand").distinct(), "chrom", ["island_start", "strand"]).withColumnRenamed("cluster_id", "cluster")
    return t.join(one, ["chrom", "island_start", "strand"]).drop("island_start")


def predict_strand(overlaps: DataFrame, read: str, strand: str) -> DataFrame:
    """(read, strand): the strand of the genes a read overlaps if they agree, else a dot."""
    found = overlaps.groupBy(read).agg(F.min(strand).alias("_lo"), F.max(strand).alias("_hi"))
    return found.select(read, F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise(".").alias("strand"))


def annotate_multihits(df: DataFrame, keys: list[str], place: list[str], *order: Column) -> DataFrame:
    """Adds hi (index from 0), ih (rows) and nh (distinct places) of each read."""
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("ih"), F.count_distinct(F.struct(*place)).alias("nh"))
    return df.withColumn("hi", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1).join(n, keys)


# ---------------------------------------------------------------- coverage and ranking


def pileup(alignments: DataFrame, keys: list[str], s: str, e: str) -> DataFrame:
    """(keys, at, depth) at every position where the depth changes; sums of events, not one row a base."""
    return depths(alignments, keys, s=s, e=e).filter("changed").drop("changed")


def spanning_score(df: DataFrame, keys: list[str], anchor: str, mappings: str, least: int) -> DataFrame:
    """(keys, score): sum of 1 / mappings over reads with enough anchor."""
    return df.filter(F.col(anchor) >= least).groupBy(*keys).agg(F.sum(1.0 / F.col(mappings)).alias("score"))


def unique_insert_sizes(alignments: DataFrame, fragment: str) -> DataFrame:
    """(fragment, isize) of fragments with one hit a mate on one reference. Needs mate, rname, s, e."""
    mates = alignments.groupBy(fragment).agg(F.count(F.when(F.col("mate") == 1, 1)).alias("n1"), F.count(F.when(F.col("mate") == 2, 1)).alias("n2"), F.count_distinct("rname").alias("refs"), (F.max("e") - F.min("s")).alias("isize"))
    return mates.filter("n1 = 1 and n2 = 1 and refs = 1").select(fragment, "isize")


def rank_empirically(df: DataFrame, columns: tuple[str, str, str], percentile: float) -> DataFrame:
    """Candidates by the share of all that no figure of theirs exceeds; those at or above the percentile of it stay, with prob."""
    cdf = joint_distribution(df, *columns).select(*columns, F.col("cdf").alias("prob"))
    scored = df.join(cdf, list(columns))
    cut = scored.agg(F.percentile("prob", F.lit(percentile / 100)).alias("cut"))
    return scored.crossJoin(F.broadcast(cut)).filter("prob >= cut").drop("cut")


def bin_edges(df: DataFrame, column: str, bins: int) -> list[float]:
    """The distinct values if there are at most ``bins``, else as many quantiles, repeats once."""
    values = [float(r[0]) for r in df.select(column).filter(F.col(column).isNotNull()).distinct().limit(bins + 1).collect()]
    if len(values) > bins:
        values = df.select(F.percentile(column, F.array(*[F.lit(i / (bins - 1)) for i in range(bins)]))).first()[0]
    return sorted({float(v) for v in values})


def grid_share(grid: np.ndarray, edges: list[np.ndarray], points: np.ndarray) -> np.ndarray:
    """Values of a grid over the edges' corners at points (n, d) within them, linear in each coordinate between neighbouring edges."""
    out = np.zeros(len(points))
    upper, part = [], []
    for e, v in zip(edges, points.T, strict=True):
        r = np.minimum(np.searchsorted(e, v, side="left"), len(e) - 1)  # the first edge at or above
        width = e[r] - e[np.maximum(r - 1, 0)]
        upper.append(r)
        part.append(np.where(width > 0, (e[r] - v) / np.where(width > 0, width, 1), 0.0))  # how far below it
    for corner in np.ndindex(*(2,) * len(edges)):
        weight = np.prod([p if c else 1 - p for c, p in zip(corner, part, strict=True)], axis=0)
        out += weight * grid[tuple(np.maximum(r - c, 0) for c, r in zip(corner, upper, strict=True))]
    return out


def rank_by_histogram(df: DataFrame, columns: tuple[str, str, str], percentile: float, *, bins: int = 64) -> DataFrame:
    """Candidates by the share of all that exceed them in some of three figures; those within the percentile of the best stay, with prob.

    prob is 1 less the joint distribution: the share of rows that have no figure above the
    candidate's. It is exact where a figure has at most ``bins`` values. Otherwise it is summed
    for the quantile edges and linear in each figure between them. Rows with a null figure are
    left out. What comes to the driver and is broadcast is the histogram, bins^3 cells at most.
    """
    rows = df.filter(" and ".join(f"{x} is not null" for x in columns))
    edges = [np.array(bin_edges(rows, x, bins)) for x in columns]
    if not all(len(e) for e in edges):
        return rows.withColumn("prob", F.lit(None).cast("double"))
    below = lambda x, e: F.size(F.filter(F.array(*[F.lit(float(v)) for v in e]), lambda v: v < F.col(x).cast("double")))
    cell = [below(x, e).alias(f"i{d}") for d, (x, e) in enumerate(zip(columns, edges, strict=True))]
    grid = np.zeros([len(e) for e in edges])
    for r in rows.select(*cell).groupBy("i0", "i1", "i2").agg(F.count(F.lit(1)).alias("n")).collect():
        grid[r.i0, r.i1, r.i2] = r.n
    told = df.sparkSession.sparkContext.broadcast((edges, grid.cumsum(0).cumsum(1).cumsum(2) / grid.sum()))

    @F.pandas_udf("double")
    def prob(x: pd.Series, y: pd.Series, z: pd.Series) -> pd.Series:
        at, share = told.value
        return pd.Series(1 - grid_share(share, at, np.column_stack([x, y, z]).astype(float)))

    scored = rows.withColumn("prob", prob(*[F.col(x).cast("double") for x in columns]))
    cut = scored.agg(F.percentile("prob", F.lit(percentile / 100)).alias("cut"))
    return scored.crossJoin(F.broadcast(cut)).filter("prob <= cut").drop("cut")


# ---------------------------------------------------------------- sinks


def write_routes(df: DataFrame, path: str, route: str = "route") -> None:
    """One folder for each category, in a single pass."""
    df.write.partitionBy(route).option("compression", "zstd").parquet(path)


def splice_junctions(transcripts: DataFrame) -> DataFrame:
    """(chrom, start, end, strand): distinct introns, as lines of a junction file: the last base before and the first after."""
    from lociq.functions.cigar import introns

    j = transcripts.select("chrom", "strand", F.explode(introns(F.col("exons"))).alias("i"))
    return j.select("chrom", (F.col("i.start") - 1).alias("start"), F.col("i.end").alias("end"), "strand").distinct()


def discordant_bedpe(pairs: DataFrame) -> DataFrame:
    """(value): BEDPE lines of read pairs, ordered by both references and positions."""
    line = F.concat_ws("\t", *[F.col(c).cast("string") for c in ("rname5p", "s5p", "e5p", "rname3p", "s3p", "e3p", "qname", "score", "strand5p", "strand3p")])
    return pairs.orderBy("rname5p", "rname3p", "s5p", "s3p", "qname").select(line.alias("value"))


def read_discordant_bedpe(spark: SparkSession, path: str) -> DataFrame:
    """The rows of ``discordant_bedpe`` lines."""
    cells = F.split("value", "\t", -1)
    kinds = {"s5p": "long", "e5p": "long", "s3p": "long", "e3p": "long"}
    names = ("rname5p", "s5p", "e5p", "rname3p", "s3p", "e3p", "qname", "score", "strand5p", "strand3p")
    return spark.read.text(path).select(*[cells[i].cast(kinds.get(n, "string")).alias(n) for i, n in enumerate(names)])


def clustered_report(df: DataFrame) -> DataFrame:
    """Report rows by spanning, total and unique evidence, highest first."""
    return df.orderBy(F.desc("spanning"), F.desc("total"), F.desc("positions"), "best_id")


def write_clustered_report(df: DataFrame, path: str, columns: list[str]) -> None:
    """Tab-separated lines of the columns in the report's order over the files by name; the first has a commented header."""
    rows = clustered_report(df).select(F.concat_ws("\t", *[F.col(x).cast("string") for x in columns]).alias("value"))
    head = df.sparkSession.createDataFrame([("#" + "\t".join(columns),)], "value string").coalesce(1)
    head.unionAll(rows).write.text(path)


def sum_histograms(df: DataFrame, keys: list[str], hist: str) -> DataFrame:
    """(keys, hist): histograms added bin by bin; shorter ones end in zeros, a null one adds nothing."""
    bins = df.select(*keys, F.posexplode(hist).alias("_bin", "_n")).groupBy(*keys, "_bin").agg(F.sum("_n").alias("_n"))
    whole = bins.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_bin", "_n"))).alias("_h"))
    return whole.select(*keys, F.transform("_h", lambda x: x["_n"]).alias(hist))
