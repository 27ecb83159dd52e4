"""Filters of chimera candidates, current and legacy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lociq.functions.prob import binomial_cdf
from lociq.operators.intervals import hidden


def allele_fraction(frags: Column, disc5: Column, conc5: Column, disc3: Column, conc3: Column) -> Column:
    """The lesser share of a side's fragments that support the candidate; a side without fragments counts 0."""
    share = lambda d, c: F.coalesce(frags.cast("double") / F.nullif(d + c, F.lit(0)), F.lit(0.0))
    return F.least(share(disc5, conc5), share(disc3, conc3))


def final_filter(chimeras: DataFrame, *, min_frags: int = 2, min_fraction: float = 0.0, mask_biotypes: list[str] = (), mask_rnames: list[str] = ()) -> DataFrame:
    """Enough fragments and allele fraction, and no masked biotype or reference on either side."""
    c = F.col
    fraction = allele_fraction(c("num_frags"), c("num_discordant_frags_5p"), c("num_concordant_frags_5p"), c("num_discordant_frags_3p"), c("num_concordant_frags_3p"))
    keep = (c("num_frags") >= min_frags) & (fraction >= min_fraction)
    if mask_biotypes:
        masked = F.array(*[F.lit(b) for b in mask_biotypes])
        keep &= ~F.arrays_overlap("biotypes_5p", masked) & ~F.arrays_overlap("biotypes_3p", masked)
    if mask_rnames:
        keep &= ~c("rname5p").isin(*mask_rnames) & ~c("rname3p").isin(*mask_rnames)
    return chimeras.filter(keep)


def without(df: DataFrame, listed: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not listed, such as known false positives or masks."""
    return df.join(listed.select(*keys), keys, "left_anti")


def recurrent(df: DataFrame, keys: list[str], sample: str, least: int) -> DataFrame:
    """(keys, samples): keys seen in ``least`` samples or more."""
    return df.groupBy(*keys).agg(F.count_distinct(sample).alias("samples")).filter(F.col("samples") >= least)


def isoform_fraction(n: Column, wild5: Column, wild3: Column) -> Column:
    share = lambda w: n.cast("double") / (n + w)
    return F.least(share(wild5), share(wild3))


def crossing_fraction(fragments: DataFrame, breakpoints: DataFrame, keys: list[str], fragment: str, *, tile: int = 4096) -> DataFrame:
    """(breakpoint columns, wild): fragments whose outermost interval crosses ``at``.

    No pairs are made: those that begin before a breakpoint less those that end by it, by running sums in tiles
    of positions and the tiles' own sums by key. Starts and ends of one position are summed first. ``at`` is a whole number.
    """
    at, way, d, tile_, ask, before = (hidden(n, fragments, breakpoints) for n in ("_at", "_way", "_d", "_tile", "_ask", "_before"))
    spans = fragments.groupBy(*keys, fragment).agg(F.min("s").alias("lo"), F.max("e").alias("hi")).filter("hi > lo")
    # at one position ends go first, then breakpoints, then starts
    edges = F.explode(F.array(F.struct(F.col("lo").alias("x"), F.lit(2).alias("way"), F.lit(1).cast("long").alias("d")), F.struct(F.col("hi").alias("x"), F.lit(0).alias("way"), F.lit(-1).cast("long").alias("d"))))
    changes = spans.select(*keys, edges.alias(d)).select(*keys, F.floor(F.col(d)["x"] / tile).alias(tile_), F.col(d)["x"].alias(at), F.col(d)["way"].alias(way), F.col(d)["d"].alias(d)).groupBy(*keys, tile_, at, way).agg(F.sum(d).alias(d))
    asked = breakpoints.filter(F.col("at").isNotNull()).select(*keys, F.floor(F.col("at") / tile).alias(tile_), F.col("at").alias(at), F.lit(1).alias(way), F.lit(0).cast("long").alias(d), F.struct(*breakpoints.columns).alias(ask))
    run = F.sum(d).over(Window.partitionBy(*keys, tile_).orderBy(at, way).rowsBetween(Window.unboundedPreceding, 0))
    inside = changes.unionByName(asked, allowMissingColumns=True).withColumn(d, run).filter(F.col(ask).isNotNull())
    sums = changes.groupBy(*keys, tile_).agg(F.sum(d).alias(d)).unionByName(asked.select(*keys, tile_, d).distinct()).groupBy(*keys, tile_).agg(F.sum(d).alias(d))
    carried = sums.select(*keys, tile_, F.coalesce(F.sum(d).over(Window.partitionBy(*keys).orderBy(tile_).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(before))
    wild = inside.join(carried, [*keys, tile_]).select(F.col(ask), (F.col(d) + F.col(before)).alias("wild")).filter("wild > 0")
    return wild.groupBy(*[F.col(ask)[c].alias(c) for c in breakpoints.columns]).agg(F.sum("wild").alias("wild"))


def balance_p_value(k: Column, n: Column) -> Column:
    """Chance of at most k of n at even odds."""
    return binomial_cdf(k, n, 0.5)


def promiscuity(df: DataFrame, pair: list[str], side: str, coverage: str) -> DataFrame:
    """(pair, share): a pair's greatest coverage as a share of the sum of its side's greatest coverages."""
    best = df.groupBy(*pair).agg(F.max(coverage).alias("most"))
    total = best.groupBy(side).agg(F.sum("most").alias("total"))
    return best.join(total, side).select(*pair, (F.col("most") / F.col("total")).alias("share"))


def weighted_coverage(df: DataFrame, keys: list[str], hits: str) -> DataFrame:
    """(keys, weight): sum of 1 / hits."""
    return df.groupBy(*keys).agg(F.sum(1.0 / F.col(hits)).alias("weight"))


def spread(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """(keys, spread): 95th percentile of ends less the 5th of starts, linear between ranks."""
    return df.groupBy(*keys).agg((F.percentile(end, F.lit(0.95)) - F.percentile(start, F.lit(0.05))).alias("spread"))


def multimap_ratio(hist: Column, weighted: Column, reads: Column, *, max_bin: int, min_ratio: float) -> Column:
    """First occupied bin of the multimap histogram low enough, and enough weighted coverage a read."""
    first = F.array_position(F.transform(hist, lambda x: x > 0), True) - 1
    return (first >= 0) & (first <= max_bin) & (weighted / reads >= min_ratio)


def insert_size_ok(size5: Column, size3: Column, most: int, *, together: bool = True) -> Column:
    return (size5 + size3 <= 2 * most) if together else ((size5 <= most) & (size3 <= most))


def anchor_ok(left: Column, right: Column, homology_left: Column, homology_right: Column, short_mismatches: Column, *, least: int, short: int, mismatches: int) -> Column:
    """Both anchors exceed the homology and ``least``; an anchor under ``short`` has few mismatches."""
    enough = (left >= F.greatest(homology_left, F.lit(least))) & (right >= F.greatest(homology_right, F.lit(least)))
    return enough & ((F.least(left, right) >= short) | (short_mismatches <= mismatches))


def concordant_pairs(pairs: DataFrame, *, lo: int, hi: int, library: str = "fr") -> DataFrame:
    """Pairs on one reference whose strands are the library's and whose outer distance lies in range; adds isize and nh, their number for a fragment.

    ``library`` tells how mates lie to each other: fr and rf on opposite strands, ff and rr on the same.
    """
    if library not in ("fr", "rf", "ff", "rr"):
        raise ValueError(f"unknown library {library}: fr, rf, ff or rr")
    size = F.greatest("e", "e2") - F.least("s", "s2")
    same = F.col("rev") == F.col("rev2")
    ok = pairs.withColumn("isize", size).filter((same if library[0] == library[1] else ~same) & F.col("isize").between(lo, hi))
    n = ok.groupBy("frag").agg(F.count(F.lit(1)).alias("nh"))
    return ok.join(n, "frag")


def unmapped_kind(mapped: Column, xm: Column, multihits: int) -> Column:
    """mapped, unmapped, or suppressed for too many hits."""
    return F.when(mapped, "mapped").when(xm < multihits, "unmapped").otherwise("overmapped")


def spanning_candidate(junctions: Column, start: Column, end: Column, pad: int = 0) -> Column:
    """Whether a junction lies strictly inside the padded interval."""
    return F.exists(junctions, lambda j: (start - pad < j) & (j < end + pad))
