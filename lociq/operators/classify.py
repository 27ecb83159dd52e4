"""Fragments: multimap counts, tiered pairing, routing, deduplication and resolution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Discordance codes and orientations.
CONCORDANT_TX, STRAND_TX, CONCORDANT_GENE, STRAND_GENE, DISCORDANT_GENE = 0, 1, 2, 3, 9
ORIENT_NONE, ORIENT_5P, ORIENT_3P = 0, 1, 2
UNSTRANDED, FIRST_STRAND, SECOND_STRAND = "fr-unstranded", "fr-firststrand", "fr-secondstrand"


def orientation(reverse: Column, mate: Column, library: str = UNSTRANDED) -> Column:
    """Whether a read lies on the 5' or the 3' side of what it spans."""
    if library == UNSTRANDED:
        five = ~reverse
    elif library == FIRST_STRAND:
        five = mate == 2
    else:
        five = mate == 1
    return F.when(five, ORIENT_5P).otherwise(ORIENT_3P)


def strand(reverse: Column, mate: Column, tx_strand: Column, library: str = UNSTRANDED) -> Column:
    """The strand a read was transcribed from; for unstranded libraries the transcript's."""
    if library == UNSTRANDED:
        return tx_strand
    same = (mate == 1) if library == SECOND_STRAND else (mate == 2)
    return F.when(same != reverse, "+").otherwise("-")


def distinct_hits(alignments: DataFrame, keys: list[str], place: list[str], unmapped: str | None = None) -> DataFrame:
    """(keys, hits): distinct places of a mate, 0 if any of its rows is unmapped."""
    hits = F.count_distinct(F.struct(*place))
    if unmapped:
        hits = F.when(F.bool_or(unmapped), F.lit(0)).otherwise(hits)
    return alignments.groupBy(*keys).agg(hits.alias("hits"))


def route(hits: DataFrame, fragment: str, *, max_hits: int = 1) -> DataFrame:
    """(fragment, route): multimap, unmapped, unpaired or mapped, by the mates' distinct hits.

    A fragment with a mate missing counts that mate as having none.
    """
    sides = hits.groupBy(fragment).agg(F.max("hits").alias("most"), F.when(F.count(F.lit(1)) < 2, F.lit(0)).otherwise(F.min("hits")).alias("least"))
    return sides.select(fragment, F.when(F.col("most") > max_hits, "multimap").when(F.col("most") == 0, "unmapped").when(F.col("least") == 0, "unpaired").otherwise("mapped").alias("route"))


def tiered_pairs(reads: DataFrame, fragment: str, tx: str, gene: str, reverse: str, *, same_strand: bool = False) -> DataFrame:
    """Mate pairs of the best tier a fragment reaches.

    Tiers: 0 same transcript, 1 same gene, 2 same transcript with wrong strands, 3 same gene
    with wrong strands, 4 a 5' and a 3' mate anywhere. Both mates are reduced to distinct
    hits first, and tiers 0 to 3 join on the gene too, so only unpaired fragments meet all hits.
    """
    one = reads.select(fragment, "mate", tx, gene, reverse).distinct()
    side = lambda m: one.filter(F.col("mate") == m).select(fragment, *[F.col(c).alias(f"{c}_{m}") for c in (tx, gene, reverse)])
    ok = (F.col(f"{reverse}_1") == F.col(f"{reverse}_2")) == F.lit(same_strand)
    same_tx = F.col(f"{tx}_1") == F.col(f"{tx}_2")
    a, b = side(1), side(2).withColumnRenamed(fragment, "_f")
    near = a.join(b, (F.col(fragment) == F.col("_f")) & (F.col(f"{gene}_1") == F.col(f"{gene}_2"))).drop("_f")
    near = near.withColumn("tier", F.when(same_tx & ok, 0).when(ok, 1).when(same_tx, 2).otherwise(3))
    far = side(1).join(near.select(fragment).distinct(), fragment, "left_anti").join(side(2), fragment).filter(~ok if same_strand else F.col(f"{reverse}_1") != F.col(f"{reverse}_2")).withColumn("tier", F.lit(4))
    every = near.unionByName(far)
    best = every.groupBy(fragment).agg(F.min("tier").alias("tier"))
    return every.join(best, [fragment, "tier"])


def fallback_pairs(reads: DataFrame, fragment: str, place: list[str], gene: str, orient: str) -> DataFrame:
    """Mate pairs of fragments that hit genes, the genome outside of them, or both.

    reads: the fragment, mate, the columns ``place`` of a hit, ``gene`` (null for a hit on the
    genome) and ``orient``. Tier gene: hits on genes of both mates, one 5' and one 3'. Tier genome:
    hits on the genome of both mates. A fragment without such pairs has those of tier mixed: a gene's hit
    with one on the genome whose orientation is another, or unknown on either side. Place columns get the
    suffixes _1 and _2. Equal hits count once; null fragments meet nothing.

    Which tiers a fragment reaches is counted first, from its hits alone, so only hits that are
    part of its pairs are multiplied.
    """
    o, m = F.coalesce(F.col(orient), F.lit(ORIENT_NONE)), F.col("mate")
    one = reads.filter(F.col(fragment).isNotNull()).select(fragment, "mate", *place, gene, o.alias(orient)).distinct()
    on_gene = F.col(gene).isNotNull()
    has = lambda mate, cond: F.coalesce(F.bool_or((m == mate) & cond), F.lit(False))
    five, three = on_gene & (o == ORIENT_5P), on_gene & (o == ORIENT_3P)
    sides = one.groupBy(fragment).agg((has(1, five) & has(2, three)).alias("_53"), (has(1, three) & has(2, five)).alias("_35"), (has(1, ~on_gene) & has(2, ~on_gene)).alias("_gg"), F.bool_or(on_gene).alias("_any"), F.bool_or(~on_gene).alias("_out"))
    near = F.col("_53") | F.col("_35") | F.col("_gg")
    sides = sides.withColumn("_mixed", ~near & F.col("_any") & F.col("_out")).filter(near | F.col("_mixed")).drop("_any", "_out")
    joined = one.join(sides, fragment)
    first_five, first_three = (m == 1) & five | (m == 2) & three, (m == 1) & three | (m == 2) & five
    kinds = F.array_compact(F.array(
        F.when(F.col("_53") & first_five, "53"), F.when(F.col("_35") & first_three, "35"), F.when(F.col("_gg") & ~on_gene, "genome"),
        F.when(F.col("_mixed") & ((m == 1) & on_gene | (m == 2) & ~on_gene), "mixed12"), F.when(F.col("_mixed") & ((m == 2) & on_gene | (m == 1) & ~on_gene), "mixed21"),
    ))
    spread = joined.select(fragment, "mate", *place, orient, F.explode(kinds).alias("_kind"))
    side = lambda n: spread.filter(m == n).select(fragment, "_kind", *[F.col(c).alias(f"{c}_{n}") for c in (*place, orient)])
    pairs = side(1).join(side(2), [fragment, "_kind"])
    a, b = F.col(f"{orient}_1"), F.col(f"{orient}_2")
    fits = (a != b) | (a == ORIENT_NONE) | (b == ORIENT_NONE)
    tier = F.when(F.col("_kind") == "genome", "genome").when(F.col("_kind").startswith("mixed"), "mixed").otherwise("gene")
    return pairs.filter(~F.col("_kind").startswith("mixed") | fits).withColumn("tier", tier).drop("_kind")


def best_with_ties(df: DataFrame, keys: list[str], *score: Column, tolerance_of: str | None = None, tolerance: float = 0) -> DataFrame:
    """Rows with a key's best score (the first of ``score`` first); all that tie stay."""
    if tolerance_of:
        low = df.groupBy(*keys).agg(F.min(tolerance_of).alias("_low"))
        return df.join(low, keys).filter(F.col(tolerance_of) <= F.col("_low") + tolerance).drop("_low")
    return df.withColumn("_r", F.rank().over(Window.partitionBy(*keys).orderBy(*score))).filter("_r = 1").drop("_r")


def first_of(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key under a total order."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_r = 1").drop("_r")


def dedupe_with_count(df: DataFrame, fragment: list[str], place: list[str], *order: Column) -> DataFrame:
    """The first row of each place of a fragment, and nh, how many places it has."""
    one = first_of(df, [*fragment, *place], *order)
    n = one.groupBy(*fragment).agg(F.count(F.lit(1)).alias("nh"))
    return one.join(n, fragment)


def fifo_match(left: DataFrame, right: DataFrame, keys: list[str], left_order: list[str], right_order: list[str]) -> DataFrame:
    """Multiset matching: the n-th left row of a key meets its n-th right row; others are dropped."""
    number = lambda df, order: df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return number(left, left_order).join(number(right, right_order), [*keys, "_n"]).drop("_n")


def combinations(reads: DataFrame, fragment: str, side: str, columns: list[str]) -> DataFrame:
    """All 5' rows of a fragment with all its 3' rows; columns get the suffixes 5p and 3p."""
    part = lambda v, p: reads.filter(F.col(side) == v).select(fragment, *[F.col(c).alias(f"{c}{p}") for c in columns])
    return part(ORIENT_5P, "5p").join(part(ORIENT_3P, "3p"), fragment)
