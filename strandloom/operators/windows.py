"""Fixed, sliding and exploding windows over positions, and profiles around anchored ends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.functions.intervals import fraction, overlap_length
from strandloom.operators.rangejoin import merge_intervals, overlap_join


def window_end(position: Column, width: int) -> Column:
    """End of the tumbling window (1..width, width+1..2*width, ...) that holds a position."""
    return (F.ceil(position / width) * width).cast("bigint")


def scoring(name: str) -> dict[str, Column]:
    """Named aggregates of the rows of a window (score, c, t, overlap, length, and window, its length)."""
    weight = F.col("overlap") / F.col("length")
    c, t = F.sum("c"), F.sum("t")
    return {
        "sum": {"n": F.count("*"), "score": F.sum("score")},
        "meth": {"n": F.count("*"), "c": c, "t": t, "score": fraction(c, t)},
        "average": {"n": F.count("*"), "score": F.avg("score"), "std": F.coalesce(F.stddev_samp("score"), F.lit(0.0)), "var": F.coalesce(F.var_samp("score"), F.lit(0.0))},
        "weighed": {"n": F.count("*"), "score": F.sum(F.col("score") * F.col("overlap")) / F.sum("overlap")},
        "half_weighed": {"n": F.count("*"), "score": F.avg(F.col("score") * weight)},
        "diluted": {"n": F.count("*"), "score": F.avg(F.col("score") * weight * F.col("overlap") / F.col("window"))},
        "locus": {"n": F.count("*"), "score": F.array_join(F.array_sort(F.collect_set(F.col("id").cast("string"))), ",")},
    }[name]


def microarray(pairs: DataFrame) -> DataFrame:
    """Id, n, score of overlap_join pairs: score times overlap over the window's covered positions; one row: its score."""
    cut = pairs.select(F.col("r_id").alias("sequence"), F.greatest("start", "r_start").alias("start"), F.least("end", "r_end").alias("end"))
    covered = merge_intervals(cut).groupBy(F.col("sequence").alias("id")).agg(F.sum(F.col("end") - F.col("start") + 1).alias("covered"))
    sums = pairs.groupBy(F.col("r_id").alias("id")).agg(F.count("*").alias("n"), F.sum(F.col("score") * F.col("overlap")).alias("s"), F.max("score").alias("only"))
    return sums.join(covered, "id").select("id", "n", F.when(F.col("n") == 1, F.col("only")).otherwise(F.col("s") / F.col("covered")).alias("score"))


def merged_annotation_windows(features: DataFrame, parts: DataFrame, aggs: list[Column], parent: str = "parent") -> DataFrame:
    """Aggregates of features by the parent of the parts (exons of a gene) they overlap; equal parts count once."""
    unique = parts.select(F.col(parent).alias("id"), "sequence", "start", "end").distinct()
    return overlap_join(features, unique).groupBy(F.col("r_id").alias(parent)).agg(*aggs)


def fixed_windows(df: DataFrame, width: int, by: tuple[str, ...] = ("sequence", "feature"), lengths: DataFrame | None = None) -> DataFrame:
    """C, t, n and score c / (c + t) of points by tumbling window; only start decides.

    With lengths (sequence, length) also empty windows, with zeros, of sequences that occur; the last window is cut.
    """
    out = df.groupBy(*by, window_end(F.col("start"), width).alias("end")).agg(F.sum("c").cast("bigint").alias("c"), F.sum("t").cast("bigint").alias("t"), F.count("*").alias("n"))
    if lengths is not None:
        last = (F.ceil(F.col("length") / width) * width).cast("bigint")
        grid = out.select(*by).distinct().join(lengths, "sequence").withColumn("end", F.explode(F.sequence(F.lit(width).cast("bigint"), last, F.lit(width).cast("bigint"))))
        out = grid.join(out, [*by, "end"], "left").fillna(0, ["c", "t", "n"])
        out = out.withColumn("start", F.col("end") - width + 1).withColumn("end", F.least("end", F.col("length").cast("bigint"))).drop("length")
    else:
        out = out.withColumn("start", F.col("end") - width + 1)
    return out.withColumn("score", fraction(F.col("c"), F.col("t")))


def sliding_windows(df: DataFrame, width: int, step: int, aggs: dict[str, Column], by: tuple[str, ...] = ("sequence",)) -> DataFrame:
    """Aggregates over the windows k*step+1 .. k*step+width that a row shares a position with (overlap, length known)."""
    first = F.greatest(F.lit(0), F.ceil((F.col("start") - width) / step)).cast("int")
    rows = df.withColumn("_k", F.explode(F.sequence(first, F.floor((F.col("end") - 1) / step).cast("int"))))
    rows = rows.withColumn("_lo", F.col("_k") * step + 1).withColumn("overlap", overlap_length(F.col("start"), F.col("end"), F.col("_lo"), F.col("_lo") + width - 1))
    rows = rows.withColumn("length", F.col("end") - F.col("start") + 1).drop("start", "end")
    return rows.groupBy(*by, F.col("_lo").alias("start")).agg(*(v.alias(k) for k, v in aggs.items())).withColumn("end", F.col("start") + width - 1)


def exploded(df: DataFrame, width: int = 1, share_score: bool = False) -> DataFrame:
    """A row for each window of the grid that an interval touches, cut to it; share_score divides the score by them."""
    k = F.explode(F.sequence(F.floor((F.col("start") - 1) / width).cast("int"), F.floor((F.col("end") - 1) / width).cast("int"))).alias("_k")
    n = F.floor((F.col("end") - 1) / width) - F.floor((F.col("start") - 1) / width) + 1
    out = df.select("*", k, n.alias("_n"))
    out = out.withColumn("start", F.col("_k") * width + 1).withColumn("end", F.col("_k") * width + width)
    return (out.withColumn("score", F.col("score") / F.col("_n")) if share_score else out).drop("_k", "_n")


def neighborhood(annotation: DataFrame, distance: int, stop: int = 0, three_prime: bool = False) -> DataFrame:
    """Each locus' region around its 5' (or 3') end: anchor, low, high, flipped, overlapped.

    stop 0: distance on both sides. stop 2: up to neighbours' bounds outside the locus, to the locus' end inside it.
    stop 6: like 2, but inside at most half way to the other end. Loci that a neighbour's body holds the anchor of count
    as overlapped.
    """
    order = Window.partitionBy("sequence").orderBy("start", "end", "id")
    a = annotation.withColumn("_previous", F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    a = a.withColumn("_next", F.lead("start").over(order))
    minus = F.col("strand") == "-"
    at_start = ~minus if not three_prime else minus
    anchor = F.when(at_start, F.col("start")).otherwise(F.col("end"))
    a = a.withColumn("anchor", anchor).withColumn("flipped", minus)
    a = a.withColumn("overlapped", F.coalesce(F.when(at_start, F.col("_previous") >= F.col("start")).otherwise(F.col("_next") <= F.col("end")), F.lit(False)))
    low, high = F.col("anchor") - distance, F.col("anchor") + distance
    if stop:
        inside = F.col("end") - F.col("start") if stop == 2 else F.floor((F.col("end") - F.col("start")) / 2).cast("int")
        outer_low, outer_high = F.greatest(low, F.coalesce(F.col("_previous") + 1, low)), F.least(high, F.coalesce(F.col("_next") - 1, high))
        low, high = F.when(at_start, outer_low).otherwise(F.greatest(low, F.col("anchor") - inside)), F.when(at_start, F.least(high, F.col("anchor") + inside)).otherwise(outer_high)
    return a.withColumn("low", low).withColumn("high", high).drop("_previous", "_next")


def end_profile(points: DataFrame, annotation: DataFrame, width: int, distance: int, stop: int = 0, three_prime: bool = False, by: tuple[str, ...] = ()) -> DataFrame:
    """Id, bin, score, n: mean score of points by bin of each locus' neighbourhood.

    Bins number from -distance/width (furthest upstream) to distance/width - 1, in the locus' own direction; loci whose
    anchor a neighbour covers are left out. A row's score is weighed by the share of it in the bin. by: columns of points that
    tell contexts apart, of which each has profiles of its own.
    """
    near = neighborhood(annotation, distance, stop, three_prime).where("not overlapped")
    # a row meets a neighbourhood once; which bins it touches there is arithmetic
    most, least = distance // width - 1, -(distance // width)
    loci = near.select("id", "sequence", "anchor", "flipped", F.greatest("low", F.col("anchor") - distance).alias("start"), F.least("high", F.col("anchor") + distance).alias("end"))
    pairs = overlap_join(points.select("sequence", "start", "end", "score", *by), loci)
    low, high = F.greatest("start", "r_start"), F.least("end", "r_end")
    bin_of = lambda p: F.floor(F.when(F.col("r_flipped"), F.col("r_anchor") - p).otherwise(p - F.col("r_anchor")) / width)
    first, last = F.greatest(F.lit(least), F.least(bin_of(low), bin_of(high))), F.least(F.lit(most), F.greatest(bin_of(low), bin_of(high)))
    pairs = pairs.withColumn("bin", F.explode(F.when(first <= last, F.sequence(first, last)))).withColumn("bin", F.col("bin").cast("int"))
    begin = F.when(F.col("r_flipped"), F.col("r_anchor") - (F.col("bin") + 1) * width + 1).otherwise(F.col("r_anchor") + F.col("bin") * width)
    own = F.least(high, begin + width - 1) - F.greatest(low, begin) + 1
    share = own / (F.col("end") - F.col("start") + 1)
    return pairs.groupBy(F.col("r_id").alias("id"), "bin", *by).agg(F.avg(F.col("score") * share).alias("score"), F.count("*").alias("n"))


def batch_profiles(points: DataFrame, annotation: DataFrame, configurations: dict[str, dict], by: str) -> DataFrame:
    """Configuration, context, bin, loci, score: the profiles of each named configuration (options of end_profile) and
    of each context, a column of points, averaged over loci."""
    out = None
    for name, options in sorted(configurations.items()):
        p = end_profile(points, annotation, **options, by=(by,)).groupBy(F.col(by).alias("context"), "bin").agg(F.count("*").alias("loci"), F.avg("score").alias("score"))
        p = p.select(F.lit(name).alias("configuration"), "context", "bin", "loci", "score")
        out = p if out is None else out.unionByName(p)
    return out


def profile_summary(profile: DataFrame) -> DataFrame:
    """Bin, n, mean, std, var, ste, and quartiles by index (int(n/4), int(n/2), int(3n/4) of the sorted scores)."""
    order = Window.partitionBy("bin").orderBy("score")
    ranked = profile.where("score is not null").withColumn("_i", F.row_number().over(order) - 1).withColumn("_n", F.count("*").over(Window.partitionBy("bin")))
    at = lambda share: F.max(F.when(F.col("_i") == F.floor(F.col("_n") * share), F.col("score")))
    std = F.coalesce(F.stddev_samp("score"), F.lit(0.0))
    return ranked.groupBy("bin").agg(
        F.count("*").alias("n"), F.avg("score").alias("mean"), std.alias("std"), F.coalesce(F.var_samp("score"), F.lit(0.0)).alias("var"), (std / F.sqrt(F.count("*"))).alias("ste"),
        at(0.25).alias("q25"), at(0.5).alias("q50"), at(0.75).alias("q75"),
    )


def proximity(windows: DataFrame, elements: DataFrame, step: int = 50, drop: float = 0.2) -> DataFrame:
    """Windows with a score that is 1 inside an element and falls by ``drop`` for every ``step`` positions from it.

    The nearest element within reach counts; windows further off score 0.
    """
    reach = int(step / drop)
    pairs = overlap_join(windows, elements.select("sequence", "start", "end"), "left", extend=(reach, reach))
    far = F.greatest(F.lit(0), F.col("r_start") - F.col("end"), F.col("start") - F.col("r_end"))
    score = F.when(F.col("r_start").isNull(), 0.0).otherwise(F.greatest(F.lit(0.0), 1 - drop * F.ceil(far / step)))
    return pairs.groupBy(*windows.columns).agg(F.max(score).alias("proximity"))
