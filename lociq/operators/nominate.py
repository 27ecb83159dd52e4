"""Exon-junction nomination, breakpoint sequences and read resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lociq.functions.sequence import homology


def best_breakpoints(fragments: DataFrame, exons5: DataFrame, exons3: DataFrame, target: float) -> DataFrame:
    """The exon pairs whose implied insert size lies nearest ``target`` for each fragment; ties stay.

    fragments: frag, tx5, tx3, pos5 (5' read's start), pos3 (3' read's end), in transcript
    coordinates. exons5: tx5, exon5, end5; exons3: tx3, exon3, start3. A 5' exon must end past
    the 5' read's start and a 3' exon begin before the 3' read's end.
    """
    met = fragments.join(exons5, "tx5").filter("end5 > pos5").join(exons3, "tx3").filter("start3 < pos3")
    sized = met.withColumn("isize", F.col("end5") - F.col("pos5") + F.col("pos3") - F.col("start3")).withColumn("miss", F.abs(F.col("isize") - target))
    return sized.withColumn("_r", F.rank().over(Window.partitionBy("frag", "tx5", "tx3").orderBy("miss"))).filter("_r = 1").drop("_r")


def breakpoint_sequences(df: DataFrame, length: int, mismatches: int = 0) -> DataFrame:
    """Adds seq, hom_left and hom_right from seq5 (5' up to the break), seq3 (from it), after5 and before3 (what follows and precedes them unfused)."""
    n = length - 1
    left = F.lpad(F.substring("seq5", -n, n), n, "N")
    right = F.rpad(F.substring("seq3", 1, n), n, "N")
    return df.withColumn("seq", F.concat(left, right)).withColumn("hom_right", homology(F.col("after5"), F.col("seq3"), mismatches)).withColumn("hom_left", homology(F.reverse("before3"), F.reverse("seq5"), mismatches))


def name_sequences(df: DataFrame, seq: str) -> DataFrame:
    """(seq, name, members): equal sequences share a name B0000000, B0000001, ... in their order.

    Sequences are counted by a prefix first, so that the running offset sees one row a prefix.
    """
    one = df.groupBy(seq).agg(F.array_sort(F.collect_set("member")).alias("members")).withColumn("_p", F.substring(seq, 1, 4))
    counts = one.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_p", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_o"))
    k = F.row_number().over(Window.partitionBy("_p").orderBy(seq))
    return one.join(offsets, "_p").select(seq, F.format_string("B%07d", F.col("_o") + k - 1).alias("name"), "members")


def resolve(df: DataFrame, read: str, *, min_probability: float = 0.0) -> DataFrame:
    """Each read's best candidates by (spanning, unambiguous, positions, -mismatches, probability); ties stay, improbable ones go."""
    order = Window.partitionBy(read).orderBy(*[F.col(c).desc() for c in ("spanning", "unambiguous", "positions")], F.col("mismatches"), F.col("probability").desc())
    return df.withColumn("_r", F.rank().over(order)).filter((F.col("_r") == 1) & (F.col("probability") >= min_probability)).drop("_r")


def group_report(df: DataFrame, keys: list[str], best: str) -> DataFrame:
    """One row a cluster pair: sets of transcripts and genes, and the candidate with the most ``best``."""
    return df.groupBy(*keys).agg(
        F.array_sort(F.collect_set("tx5")).alias("txs5"), F.array_sort(F.collect_set("tx3")).alias("txs3"), F.max(best).alias(best), F.max_by("chimera_id", F.struct(F.col(best), F.col("chimera_id"))).alias("best_id"), F.array_sort(F.collect_set("chimera_id")).alias("chimera_ids"))
