"""Closed-form probabilities as columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def comb(n: Column, k: Column) -> Column:
    """Binomial coefficient as a double; 0 outside 0 <= k <= n."""
    small = F.least(k, n - k)
    product = F.aggregate(F.when(small > 0, F.sequence(F.lit(1), small.cast("int"))).otherwise(F.array().cast("array<int>")), F.lit(1.0), lambda a, i: a * (n - small + i) / i)
    return F.when((k < 0) | (k > n), F.lit(0.0)).otherwise(F.round(product))


def normal_pdf(x: Column, mean: Column, sd: Column) -> Column:
    return F.exp(-F.pow((x - mean) / sd, F.lit(2.0)) / 2) / (sd * math.sqrt(2 * math.pi))


def binomial_pdf(k: Column, n: Column, p: float) -> Column:
    """Exact below 100 trials, else the normal density with the same mean and variance."""
    exact = comb(n, k) * F.pow(F.lit(p), k) * F.pow(F.lit(1 - p), n - k)
    return F.when(n < 100, exact).otherwise(normal_pdf(k, n * p, F.sqrt(n * p * (1 - p))))


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """Chance of at most k of n: 0 below 0, 1 from n on.

    Below 100 trials each term follows from the one before; else the normal densities of
    ``binomial_pdf`` are summed. Either way the cost is linear in k.
    """
    upto = F.least(k, n).cast("int")
    if 0 < p < 1:
        odds = p / (1 - p)
        exact = F.aggregate(
            F.sequence(F.lit(0), upto),
            F.struct(F.lit(0.0).alias("sum"), F.pow(F.lit(1 - p), n).alias("term")),
            lambda a, i: F.struct((a["sum"] + a["term"]).alias("sum"), (a["term"] * ((n - i) * odds / (i + 1))).alias("term")),
            lambda a: a["sum"],
        )
    else:
        exact = F.lit(1.0 if p <= 0 else 0.0)
    near = F.aggregate(F.sequence(F.lit(0), upto), F.lit(0.0), lambda a, i: a + normal_pdf(i, n * p, F.sqrt(n * p * (1 - p))))
    return F.when(k < 0, F.lit(0.0)).when((n < 100) & (k >= n), F.lit(1.0)).when(n < 100, exact).otherwise(near)


def log_factorial(k: Column) -> Column:
    """ln k! for whole k from 0: exact up to 20, then by Stirling's series, whose error is below 1e-12."""
    x = F.greatest(k, F.lit(1)).cast("double")
    series = x * F.log(x) - x + 0.5 * F.log(2 * math.pi * x) + 1 / (12 * x) - 1 / (360 * F.pow(x, F.lit(3.0))) + 1 / (1260 * F.pow(x, F.lit(5.0)))
    return F.when(k <= 20, F.log(F.factorial(k.cast("int")).cast("double"))).otherwise(series)


def poisson(k: Column, rate: Column) -> Column:
    """exp(-rate) * rate^k / k! for any whole k, by logarithms; 0 below 0."""
    some = F.exp(k * F.log(rate) - rate - log_factorial(k))
    return F.when(k < 0, F.lit(0.0)).when(rate == 0, F.when(k == 0, 1.0).otherwise(0.0)).otherwise(some)


def insert_size_probability(percentile: Column) -> Column:
    """1 at the median, 0 at either end."""
    return 1 - 2 * F.abs(F.lit(50.0) - percentile) / 100
