"""Discordant clusters: stranded islands, boundaries, evidence and pairs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lociq.operators.classify import combinations
from lociq.operators.graph import connected_components
from lociq.operators.intervals import _no_clash, bins, hidden, island_links, islands, join_same, overlap_join


def boundary(start: Column, end: Column, strand: Column, orientation: Column) -> Column:
    """The side of a cluster at which its breakpoint lies."""
    return F.when((strand == "+") == (orientation == 1), end).otherwise(start)


def stranded_clusters(reads: DataFrame, keys: list[str], **how) -> DataFrame:
    """Islands for each of ``keys`` (reference, strand, orientation)."""
    return islands(reads, keys, **how)


def offsets_of(counts: DataFrame, key: str, n: str, name: str) -> DataFrame:
    """(key, name): how many rows the lesser keys have, a null key before all others. ``counts`` has a row for each key."""
    before = F.sum(n).over(Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1))
    return counts.select(key, F.coalesce(before, F.lit(0)).alias(name))


def numbered(df: DataFrame, key: str, order: list, name: str) -> DataFrame:
    """Adds ``name``, from 0 without gaps in the order of ``key`` and ``order``, nulls first.

    Ids are an offset of the key plus a rank in it, so no task sorts all rows; a null key is a key.
    The key is joined and ranked as a struct, of which nulls are equal, so rows move once for both.
    """
    n, o, k = hidden("_n", df), hidden("_o", df), hidden("_k", df)
    offsets = offsets_of(df.groupBy(key).agg(F.count(F.lit(1)).alias(n)), key, n, o)
    rank = F.row_number().over(Window.partitionBy(k).orderBy(*order))
    return df.withColumn(k, F.struct(key)).join(offsets.select(F.struct(key).alias(k), o), k).withColumn(name, F.col(o) + rank - 1).drop(o, k)


def with_cluster_ids(clusters: DataFrame, reference: str, order: list[str]) -> DataFrame:
    """Adds cluster_id, from 0 in the order of reference and ``order``; a null reference comes first."""
    return numbered(clusters, reference, order, "cluster_id")


def past_boundary(strand: Column, orientation: Column, start: Column, end: Column, r_start: Column, r_end: Column, mate_pos: Column) -> Column:
    """Whether a concordant fragment reaches over the cluster's boundary."""
    right = (strand == "+") == (orientation == 1)
    return F.when(right, (r_end > end) | (mate_pos >= end)).otherwise((r_start < start) | (mate_pos < start))


#: Rows of one fragment that are told apart as they meet a span; only fragments with more are made distinct.
ROWS_TOLD = 4
#: Spans of one place that meet the fragments together.
SPANS_TOGETHER = 1024


def _told(fragments: DataFrame, keys: list[str], fragment: str, before: str, many: str) -> DataFrame:
    """Distinct rows, each with those of its fragment before it (``before``, null for the first), and whether the fragment has over ROWS_TOLD (``many``)."""
    again, row = hidden("_again", fragments), F.struct(*[c for c in fragments.columns if c not in (*keys, fragment)])
    own = Window.partitionBy(*keys, fragment)
    order = own.orderBy(*[c for c in fragments.columns if c not in (*keys, fragment)])
    rows = fragments.withColumn(again, F.lag(row).over(order).eqNullSafe(row)).filter(~F.col(again)).drop(again)
    earlier = F.when(F.row_number().over(order) > 1, F.collect_list(row).over(order.rowsBetween(1 - ROWS_TOLD, -1)))
    return rows.withColumns({before: earlier, many: F.count(F.lit(1)).over(own) > ROWS_TOLD})


def _counted(spans: DataFrame, spot: list[str], fragments: DataFrame, keys: list[str], fragment: str, name: str, where: Column, width: int, how: str) -> DataFrame:
    """Spans with ``name``, their distinct fragments; ``how`` is inner or left. The conditions see the columns ``spot`` of a span.

    Spans and fragments move to bins of four widths, in which the spans of one place meet the fragments once. A row counts
    unless one of its fragment's before it meets the span too, so no pair moves; the bins' counts are summed. Only the pairs of
    fragments with over ROWS_TOLD distinct rows under their keys move, to be made distinct.
    """
    fragments, (s2, e2) = _no_clash(spans, fragments, keys, ("s2", "e2"))
    bin_, a0, b0, before, many, seen, n, f, m, kept, part = (hidden(x, spans, fragments) for x in ("_bin", "_a0", "_b0", "_before", "_many", "_seen", "_n", "_f", "_m", "_kept", "_part"))
    theirs = {c: hidden(f"_k{i}", spans, fragments) for i, c in enumerate((*keys, bin_))}
    rest, more = [c for c in fragments.columns if c not in (*keys, fragment)], [c for c in spans.columns if c not in spot]
    size, tasks = 4 * width, 4 * int(spans.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # all steps lie in one stage, so its tasks are small
    held = spans.withColumns({a0: F.floor(F.col("s") / size), bin_: F.explode_outer(bins(F.col("s"), F.col("e"), size))}).repartition(tasks, *keys, bin_)
    held = held.groupBy(*spot, a0, bin_, *more).agg(F.count(F.lit(1)).alias(m))
    nth = F.row_number().over(Window.partitionBy(*keys, bin_, *[c for c in spot if c not in keys]).orderBy(m))
    held = held.withColumn(part, F.floor((nth - 1) / SPANS_TOGETHER)).groupBy(*spot, a0, bin_, part).agg(F.collect_list(F.struct(*more, m)).alias(kept))
    rows = _told(fragments, keys, fragment, before, many).withColumns({b0: F.floor(F.col(s2) / size), bin_: F.explode(bins(F.col(s2), F.col(e2), size))})
    rows = rows.repartition(tasks, *keys, bin_).withColumnsRenamed(theirs)
    crossed = (F.col(e2) > F.col("s")) & (F.col(s2) < F.col("e")) & where
    same = reduce(lambda x, y: x & y, [F.col(c) == F.col(k) for c, k in theirs.items()])
    met = held.join(rows, same & crossed & (F.greatest(a0, b0) == F.col(bin_)), how).withColumn(seen, F.lit(False))
    for i in range(ROWS_TOLD - 1):
        row = F.get(before, F.lit(i))
        met = met.withColumns({c: row[c] for c in rest}).withColumn(seen, F.col(seen) | F.coalesce(row.isNotNull() & crossed, F.lit(False)))
    local = met.groupBy(*spot, a0, bin_, part, kept, F.when(F.col(many), F.col(fragment)).alias(f)).agg(F.count(F.when(~F.col(many) & ~F.col(seen), F.col(fragment))).alias(n))
    each = local.select(*spot, n, f, F.explode(kept).alias(kept)).select(*spot, *[F.col(kept)[c].alias(c) for c in (*more, m)], n, f).repartition(*spans.columns)
    found = each.groupBy(*spans.columns, m).agg((F.sum(n) + F.count_distinct(f)).alias(name))
    return found.withColumn(m, F.explode(F.sequence(F.lit(1).cast("long"), F.col(m)))).select(*spans.columns, name)


def count_overlapping(spans: DataFrame, fragments: DataFrame, keys: list[str], fragment: str, name: str, *, where: Column | None = None, width: int | None = None) -> DataFrame:
    """(span columns, ``name``): the distinct fragments of fragments' [s2, e2) that overlap spans' [s, e) and meet ``where``; spans without one are left out.

    spans are distinct rows; one that only null fragments meet has 0. With ``width``, about the length of both sides, no pair moves but those of fragments with over ROWS_TOLD rows. Without it lengths
    may be any: a fragment that has one row under its keys meets a span once, so its pairs are counted as they are made and never move; only those of
    fragments with several rows are made distinct.
    """
    condition = F.lit(True) if where is None else where
    if width:
        return _counted(spans, spans.columns, fragments, keys, fragment, name, condition, width, "inner")
    several = hidden("_several", spans, fragments)
    rows = fragments.withColumn(several, F.count(F.lit(1)).over(Window.partitionBy(*keys, fragment)) > 1)
    met = lambda kind: overlap_join(spans, rows.filter(kind).drop(several), keys).filter(condition).select(*spans.columns, fragment)
    one, more = met(~F.col(several)).groupBy(*spans.columns).agg(F.count(fragment).alias(name)), met(F.col(several)).distinct().groupBy(*spans.columns).agg(F.count(fragment).alias(name))
    return one.unionByName(more).groupBy(*spans.columns).agg(F.sum(name).alias(name))


def concordant_evidence(clusters: DataFrame, fragments: DataFrame, keys: list[str], *, width: int | None = None) -> DataFrame:
    """(cluster columns, frags): distinct overlapping fragments that reach past the boundary; 0 where none does.

    Fragments are counted for distinct places, so further columns, null or not, and repeated clusters change nothing.
    """
    spot = list(dict.fromkeys([*keys, "s", "e", "strand", "orient"]))
    past = past_boundary(F.col("strand"), F.col("orient"), F.col("s"), F.col("e"), F.col("s2"), F.col("e2"), F.col("mate_pos"))
    fragments = fragments.select(*keys, "s2", "e2", "mate_pos", "frag2")
    if width:
        return _counted(clusters, spot, fragments, keys, "frag2", "frags", past, width, "left")
    counted = count_overlapping(clusters.select(*spot).distinct(), fragments, keys, "frag2", "frags", where=past)
    return join_same(clusters, counted, spot, "left").fillna(0, ["frags"])


def pair_clusters(members: DataFrame, fragment: str, cluster: str, side: str) -> DataFrame:
    """(id5p, id3p, qnames) of the clusters that fragments join; a fragment with several hits is listed for each."""
    pairs = combinations(members, fragment, side, [cluster])
    return pairs.groupBy(F.col(f"{cluster}5p").alias("id5p"), F.col(f"{cluster}3p").alias("id3p")).agg(F.array_sort(F.collect_list(fragment)).alias("qnames"))


def with_pair_ids(pairs: DataFrame) -> DataFrame:
    """Adds pair_id, from 0 in the order of the ids as text.

    Ids are an offset of the 5' id's first three characters, of which there are some thousand,
    plus a rank among the pairs that begin so; no task sorts all pairs. Null ids come first.
    """
    five, three = F.col("id5p").cast("string"), F.col("id3p").cast("string")
    head = hidden("_head", pairs)
    return numbered(pairs.withColumn(head, F.substring(five, 1, 3)), head, [five, three], "pair_id").drop(head)


def transcript_clusters(exons: DataFrame, keys: list[str], tx: str = "tx_id") -> DataFrame:
    """(tx, component): transcripts that share an exon island on the same chromosome and strand, transitively."""
    links = island_links(exons, keys, tx)
    return connected_components(links).select(F.col("node").alias(tx), "component")


def merge_isoforms(transcripts: DataFrame) -> DataFrame:
    """Transcripts with equal chromosome, introns and cluster become one.

    The span is the widest, the first exon's start and last exon's end follow it; names and
    sources are joined; the biotype is the last that is not ``na`` in the order of tx_id.
    """
    from lociq.functions.cigar import introns

    keyed = transcripts.withColumn("introns", introns(F.col("exons")))
    known = F.when(F.col("gene_biotype") != "na", F.col("gene_biotype"))
    merged = keyed.groupBy("chrom", "strand", "introns", "cluster_id").agg(
        F.min("tx_start").alias("tx_start"), F.max("tx_end").alias("tx_end"), F.coalesce(F.max_by(known, F.when(known.isNotNull(), F.col("tx_id"))), F.lit("na")).alias("gene_biotype"),
        *[F.array_sort(F.flatten(F.collect_list(c))).alias(c) for c in ("tx_names", "gene_names", "annotation_sources")])
    inner = F.col("introns")
    starts = F.concat(F.array("tx_start"), F.transform(inner, lambda i: i["end"]))
    ends = F.concat(F.transform(inner, lambda i: i["start"]), F.array("tx_end"))
    return merged.withColumn("exons", F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("start"), b.alias("end")))).withColumn("exon_count", F.size("exons")).drop("introns")
