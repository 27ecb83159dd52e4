"""Histograms, percentiles and divergences. Histograms are pre-aggregated: what follows sees one row per value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def histogram(df: DataFrame, value: str, lo: int, hi: int) -> DataFrame:
    """(value, n) for every value from lo to hi, 0 where there is none."""
    every = df.sparkSession.range(lo, hi + 1).select(F.col("id").alias(value))
    found = df.filter(F.col(value).between(lo, hi)).groupBy(F.col(value).cast("long").alias(value)).agg(F.count(F.lit(1)).alias("n"))
    return every.join(found, value, "left").select(value, F.coalesce("n", F.lit(0)).alias("n"))


def cap_samples(df: DataFrame, most: int, identity: list[str]) -> DataFrame:
    """``most`` of the rows, chosen by a digest of ``identity`` as text: the same in every run, and no place or time is preferred.

    Rows are counted by the digest's first two bytes; those below the byte pair at which the cap
    falls are all kept, and only that one's rows, a 65536th or so, are put in order, by
    digest and then ``identity``. What comes to the driver are those counts.
    """
    digest = F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in identity]))
    keyed = df.withColumn("_digest", digest).withColumn("_head", F.substring("_digest", 1, 4))
    counts = sorted((r["_head"], r["n"]) for r in keyed.groupBy("_head").agg(F.count(F.lit(1)).alias("n")).collect())
    left = most
    for head, n in counts:
        if n > left:
            edge = keyed.filter(F.col("_head") == head).orderBy("_digest", *identity).limit(left)
            return keyed.filter(F.col("_head") < head).unionByName(edge).drop("_digest", "_head")
        left -= n
    return df


def cumulative(hist: DataFrame, value: str, n: str = "n") -> DataFrame:
    """Adds the running count. One row per distinct value, which the range of values bounds."""
    return hist.withColumn("cum", F.sum(n).over(Window.orderBy(value).rowsBetween(Window.unboundedPreceding, 0)))


def value_at_percentile(hist: DataFrame, value: str, percents: list[float]) -> DataFrame:
    """(percent, value): the first value whose running count reaches n * percent / 100."""
    run = cumulative(hist, value)
    total = hist.agg(F.sum("n").alias("total"))
    asked = F.explode(F.array(*[F.lit(float(p)) for p in percents])).alias("percent")
    return run.crossJoin(F.broadcast(total)).select("*", asked).filter("cum >= total * percent / 100").groupBy("percent").agg(F.min(value).alias(value))


def percentile_of_value(hist: DataFrame, value: str) -> DataFrame:
    """(value, percentile): 100 * share at or below it."""
    total = hist.agg(F.sum("n").alias("total"))
    return cumulative(hist, value).crossJoin(F.broadcast(total)).select(value, (100.0 * F.col("cum") / F.col("total")).alias("percentile"))


def summary(hist: DataFrame, value: str) -> DataFrame:
    """(n, mode, mean, sd): the mode is the least of the most frequent values; sd divides by n - 1."""
    v, n = F.col(value).cast("double"), F.col("n").cast("double")
    sums = hist.agg(F.sum("n").alias("n"), F.min_by(value, F.struct(-F.col("n"), F.col(value))).alias("mode"), F.sum(v * n).alias("s1"), F.sum(v * v * n).alias("s2"))
    return sums.select("n", "mode", (F.col("s1") / F.col("n")).alias("mean"), F.sqrt((F.col("s2") - F.col("s1") * F.col("s1") / F.col("n")) / (F.col("n") - 1)).alias("sd"))


def binned(value: Column, edges: list[float]) -> Column:
    """Index of the first edge at or above the value; values over all edges go to the last bin."""
    out = F.lit(len(edges) - 1)
    for i in range(len(edges) - 1, -1, -1):
        out = F.when(value <= edges[i], F.lit(i)).otherwise(out)
    return out


def divergence_from_uniform(df: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """(keys, kl): sum of p * ln(p * bins) over a key's rows with weight."""
    total = df.filter(F.col(weight) > 0).groupBy(*keys).agg(F.sum(weight).alias("_t"))
    bins = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    p = F.col(weight) / F.col("_t")
    return df.filter(F.col(weight) > 0).join(total, keys).join(bins, keys).groupBy(*keys).agg(F.sum(p * F.log(p * F.col("_n"))).alias("kl"))


def joint_distribution(df: DataFrame, x: str, y: str, z: str) -> DataFrame:
    """(x, y, z, n, pmf, cdf) of the distinct points; cdf is the share that no coordinate exceeds.

    The running counts are taken a dimension at a time over the grid of distinct values, so no
    pairs of points are formed. Coordinates are bins, whose number the caller bounds.
    """
    counts = df.groupBy(x, y, z).agg(F.count(F.lit(1)).alias("n"))
    grid = counts.select(x).distinct().crossJoin(counts.select(y).distinct()).crossJoin(counts.select(z).distinct())
    full = grid.join(counts, [x, y, z], "left").withColumn("cum", F.coalesce("n", F.lit(0)))
    for at in (x, y, z):
        rest = [c for c in (x, y, z) if c != at]
        full = full.withColumn("cum", F.sum("cum").over(Window.partitionBy(*rest).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)))
    total = counts.agg(F.sum("n").alias("total"))
    return full.filter("n is not null").crossJoin(F.broadcast(total)).select(x, y, z, "n", (F.col("n") / F.col("total")).alias("pmf"), (F.col("cum") / F.col("total")).alias("cdf"))


def interpolated_quantile(value: Column, p: float) -> Column:
    """Linear between the ranks around p * (n - 1)."""
    return F.percentile(value, F.lit(p))


def mean_interval(value: Column, z: float = 1.959963984540054) -> Column:
    """(low, high) around the mean by the normal approximation: z standard errors either way."""
    half = z * F.stddev_samp(value) / F.sqrt(F.count(value))
    return F.struct((F.avg(value) - half).alias("low"), (F.avg(value) + half).alias("high"))
