"""Simulated reads with truth labels, from transcripts and their expression."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociq.functions.sequence import reverse_complement


def fragment_counts(transcripts: DataFrame, total: int) -> DataFrame:
    """Adds frags = round(fpkm * length / 1000 * total / 1e6)."""
    return transcripts.withColumn("frags", F.round(F.col("fpkm") * F.length("seq") / 1000.0 * (total / 1e6)).cast("long"))


def simulate(transcripts: DataFrame, *, total: int, mean: float, sd: float, read_length: int, seed: int = 1) -> DataFrame:
    """Read pairs (name, seq1, seq2) of transcripts (tx_id, seq, fpkm, and perhaps breakpoint).

    The second mate is reverse-complemented; either mate comes first by a coin. For a fused
    transcript the name says whether mate 1 or 2 reads over the breakpoint (R1B, R2B) or the
    fragment only spans it (SPAN); NONE otherwise.
    """
    if "breakpoint" not in transcripts.columns:
        transcripts = transcripts.withColumn("breakpoint", F.lit(None).cast("int"))
    each = fragment_counts(transcripts, total).filter("frags > 0").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("frags"))))
    sized = each.withColumn("size", F.round(F.randn(seed) * sd + mean).cast("int")).filter((F.col("size") >= read_length) & (F.col("size") <= F.length("seq")))
    placed = sized.withColumn("start", F.floor(F.rand(seed + 1) * (F.length("seq") - F.col("size") + 1)).cast("int")).withColumn("flip", F.rand(seed + 2) < 0.5)
    body = F.expr("substring(seq, start + 1, size)")
    left, right = F.substring(body, 1, read_length), reverse_complement(F.expr(f"substring(seq, start + size - {read_length} + 1, {read_length})"))
    over = lambda a, b: (F.col("breakpoint") > a) & (F.col("breakpoint") < b)
    first, last = F.col("start"), F.col("start") + F.col("size")
    label = F.when(over(first, first + read_length), F.when(F.col("flip"), "R2B").otherwise("R1B")).when(over(last - read_length, last), F.when(F.col("flip"), "R1B").otherwise("R2B")).when(over(first, last), "SPAN").otherwise("NONE")
    name = F.concat_ws(":", F.col("tx_id").cast("string"), F.col("k").cast("string"), F.col("start").cast("string"), F.col("size").cast("string"), label)
    return placed.select(name.alias("name"), F.when(F.col("flip"), right).otherwise(left).alias("seq1"), F.when(F.col("flip"), left).otherwise(right).alias("seq2"))


def random_sizes(spark, n: int, mean: float, sd: float, lo: int, hi: int, seed: int = 1) -> DataFrame:
    """(isize): normal insert sizes inside [lo, hi], a prior where too few were seen."""
    return spark.range(n).select(F.round(F.randn(seed) * sd + mean).cast("int").alias("isize")).filter(F.col("isize").between(lo, hi))


def fuse(transcripts: DataFrame, spec: DataFrame) -> DataFrame:
    """Fused transcripts (tx_id, seq, fpkm, breakpoint) of a fusion list: a slice of one transcript and one of another.

    spec: tx5p, start5p, end5p, tx3p, start3p, end3p, fpkm, in transcript coordinates from 0; tx_id of transcripts is text there.

    Both joins are sorted ones: transcripts have no bound, and a table that is small as a file can be large in a task.
    """
    t = transcripts.select(F.col("tx_id").cast("string").alias("id"), "seq")
    side = lambda p: t.select(F.col("id").alias(f"tx{p}"), F.col("seq").alias(f"seq{p}"))
    part = lambda p: F.expr(f"substring(seq{p}, start{p} + 1, end{p} - start{p})")
    both = spec.join(side("5p").hint("merge"), "tx5p").join(side("3p").hint("merge"), "tx3p")
    return both.select(F.concat_ws("-", "tx5p", "tx3p").alias("tx_id"), F.concat(part("5p"), part("3p")).alias("seq"), "fpkm", F.length(part("5p")).alias("breakpoint"))
