"""Statistics: summaries, weighted histograms, 2x2 tables, hypergeometric and normal tails."""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.functions.intervals import fraction, safe_divide
from strandloom.operators.rows import genome_class


def histogram_percentiles(df: DataFrame, by: list[str], value: str, count: str, shares: list[float]) -> DataFrame:
    """For each group the first value whose running count exceeds share * total (strictly), as p5, p25 ...

    Values are grouped first, so a group's window holds distinct values only.
    """
    h = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.sum(count).alias("_k"))
    order = Window.partitionBy(*by).orderBy(value)
    h = h.withColumn("_run", F.sum("_k").over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_all", F.sum("_k").over(Window.partitionBy(*by)))
    return h.groupBy(*by).agg(*(F.min(F.when(F.col("_run") > s * F.col("_all"), F.col(value))).alias(f"p{round(100 * s):d}") for s in shares))


def histogram_summary(df: DataFrame, by: list[str], value: str, count: str) -> DataFrame:
    """N, mean and population deviation of a histogram."""
    n = F.sum(count)
    mean = F.sum(F.col(value) * F.col(count)) / n
    return df.groupBy(*by).agg(n.alias("n"), mean.alias("mean"), F.sqrt(F.greatest(F.lit(0.0), F.sum(F.col(value) * F.col(value) * F.col(count)) / n - mean * mean)).alias("std"))


def summary(df: DataFrame) -> DataFrame:
    """Count, mean, deviation, smallest, median and largest length, sequences and features."""
    length = F.col("end") - F.col("start") + 1
    return df.agg(
        F.count("*").alias("n"), F.avg(length).alias("mean"), F.stddev_samp(length).alias("sd"), F.min(length).alias("min"),
        F.median(length).alias("median"), F.max(length).alias("max"), F.count_distinct("sequence").alias("sequences"), F.count_distinct("feature").alias("features"),
    )


def methylation_stats(df: DataFrame, context: str = "feature") -> DataFrame:
    """By context and genome class, for each context in all classes but unknown, and in all contexts: sites, c, t, fraction.

    Totals leave out the class unknown.
    """
    rows = df.withColumn("class", genome_class(F.col("sequence"))).groupBy(F.col(context).alias("context"), "class").agg(F.count("*").alias("sites"), F.sum("c").alias("c"), F.sum("t").alias("t"))
    known = rows.where("class <> 'unknown'")
    by_context = known.groupBy("context", F.lit("total").alias("class")).agg(*(F.sum(x).alias(x) for x in ("sites", "c", "t")))
    every = known.groupBy(F.lit("total").alias("context"), F.lit("total").alias("class")).agg(*(F.sum(x).alias(x) for x in ("sites", "c", "t")))
    return rows.unionByName(by_context).unionByName(every).withColumn("methylation", fraction(F.col("c"), F.col("t")))


def two_by_two(n11: Column, n12: Column, n21: Column, n22: Column) -> dict[str, Column]:
    """G1: measures of a 2x2 table that have a closed form, 0 or null where a margin is empty."""
    r1, r2, c1, c2 = n11 + n12, n21 + n22, n11 + n21, n12 + n22
    n = r1 + r2
    expected = lambda r, c: r * c / n
    term = lambda o, r, c: F.when(o > 0, o * F.ln(o / expected(r, c))).otherwise(0.0)
    cross = n11 * n22 - n12 * n21
    x2 = F.try_divide(n * cross * cross, r1 * r2 * c1 * c2)
    return {
        "x2": x2,
        "phi": F.try_divide(cross * cross, r1 * r2 * c1 * c2),
        "tscore": F.when(n11 > 0, (n11 - expected(r1, c1)) / F.sqrt(n11)),
        "dice": safe_divide(2 * n11, r1 + c1),
        "jaccard": safe_divide(n11, n11 + n12 + n21),
        "ll": 2 * (term(n11, r1, c1) + term(n12, r1, c2) + term(n21, r2, c1) + term(n22, r2, c2)),
        "pmi": F.when(n11 > 0, F.log2(n11 / expected(r1, c1))),
        "tmi": (term(n11, r1, c1) + term(n12, r1, c2) + term(n21, r2, c1) + term(n22, r2, c2)) / n / math.log(2),
        "ps": F.when(n11 > 0, n11 * (F.ln(n11 / expected(r1, c1)) - 1)),
    }


def log_factorials(spark, largest: int) -> DataFrame:
    """k, ln k! for 0 to largest (whose size the caller bounds), by running sums."""
    order = Window.orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    ln = F.when(F.col("id") > 0, F.ln("id")).otherwise(0.0)
    return spark.range(largest + 1).withColumn("ln_factorial", F.sum(ln).over(order)).withColumnRenamed("id", "k")


def ln_gamma(x: Column) -> Column:
    """ln of the gamma function for x >= 1, by Stirling's series after seven steps up."""
    y = x + 7
    step = F.lit(0.0)
    for i in range(7):
        step = step + F.ln(x + i)
    return (y - 0.5) * F.ln(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y) - step


def ln_choose(n: Column, k: Column) -> Column:
    return ln_gamma(n + 1) - ln_gamma(k + 1) - ln_gamma(n - k + 1)


def hypergeometric(n11: Column, n12: Column, n21: Column, n22: Column, least: float = -200.0) -> Column:
    """Ln of the chance of just this table given its margins; under ``least`` it counts as that."""
    n = n11 + n12 + n21 + n22
    return F.greatest(F.lit(least), ln_choose(n11 + n12, n11) + ln_choose(n21 + n22, n21) - ln_choose(n, n11 + n21))


def fisher(n11: Column, n12: Column, n21: Column, n22: Column) -> dict[str, Column]:
    """G1: left, right and two-tailed exact test, summing the chances of all tables with these margins.

    From the given table on, each chance is its neighbour's times a ratio of cells; nothing but the sums is kept.
    """
    r1, r2, c1 = n11 + n12, n21 + n22, n11 + n21
    low, high = F.greatest(F.lit(0), c1 - r2), F.least(r1, c1)
    own = hypergeometric(n11, n12, n21, n22, -1e9)

    def walk(count: Column, sign: int) -> Column:
        """Sums over the ``count`` tables on one side: of all chances, and of those that are no greater than the given one."""

        def add(s: Column, i: Column) -> Column:
            a, b, c, d = n11 + sign * (i - 1), n12 - sign * (i - 1), n21 - sign * (i - 1), n22 + sign * (i - 1)
            ratio = b * c / ((a + 1) * (d + 1)) if sign > 0 else a * d / ((b + 1) * (c + 1))
            ln = s["ln"] + F.ln(ratio)
            p = F.exp(ln)
            return F.struct(ln.alias("ln"), (s["all"] + p).alias("all"), (s["rare"] + F.when(ln <= own + 1e-7, p).otherwise(0.0)).alias("rare"))

        start = F.struct(own.alias("ln"), F.lit(0.0).alias("all"), F.lit(0.0).alias("rare"))
        steps = F.when(count > 0, F.sequence(F.lit(1), count.cast("int"))).otherwise(F.array().cast("array<int>"))
        return F.aggregate(steps, start, add)

    down, up, given = walk(n11 - low, -1), walk(high - n11, 1), F.exp(own)
    sums = {"left": given + down["all"], "right": given + up["all"], "two": given + down["rare"] + up["rare"]}
    return {c: F.least(F.lit(1.0), x) for c, x in sums.items()}


def without_zeros(df: DataFrame, value: str) -> DataFrame:
    """Zeros replaced by the normal quantile, in log space, at half the lower-tail chance of the smallest value."""
    row = df.where(F.col(value) > 0).select(F.avg(F.ln(value)), F.stddev_samp(F.ln(value)), F.min(F.ln(value))).first()
    if row[0] is None or not row[1]:
        return df
    normal = NormalDist(row[0], row[1])
    fill = math.exp(normal.inv_cdf(normal.cdf(row[2]) / 2))
    return df.withColumn(value, F.when(F.col(value) == 0, F.lit(fill)).otherwise(F.col(value)))


def robust_spread(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Median and 1.4826 times the median absolute deviation in each group."""
    middle = df.groupBy(*by).agg(F.median(value).alias("median"))
    return df.join(middle, by).groupBy(*by, "median").agg((F.median(F.abs(F.col(value) - F.col("median"))) * 1.4826).alias("mad"), F.count("*").alias("n"))


def entropy(counts: list[Column], pseudo: float = 1.0) -> Column:
    """Entropy in bits of counts with a pseudo-count each."""
    total = sum((c for c in counts), F.lit(0)) + pseudo * len(counts)
    return -sum(((c + pseudo) / total * F.log2((c + pseudo) / total) for c in counts), F.lit(0.0))
