"""Order-dependent operators: islands, collapsing, smoothing, normalisation, neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def islands(df: DataFrame, threshold: float, gap: int, by: str = "sequence") -> DataFrame:
    """Runs of rows whose score reaches the threshold, with at most ``gap`` rows under it between them.

    start and end are those of the first and last row that reach it; n counts these rows, score is their mean.
    """
    order = Window.partitionBy(by).orderBy("start", "end")
    land = F.coalesce(F.col("score") >= threshold, F.lit(False))
    rows = df.withColumn("_row", F.row_number().over(order)).where(land)
    rows = rows.withColumn("_new", F.when(F.col("_row") - F.lag("_row").over(order) - 1 <= gap, 0).otherwise(1))
    rows = rows.withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(by, "_island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n"), F.avg("score").alias("score")).drop("_island")


def collapsed(df: DataFrame, distance: int, difference: float, by: str = "sequence") -> DataFrame:
    """Neighbouring rows joined while they lie within distance and their scores differ by at most difference."""
    order = Window.partitionBy(by).orderBy("start", "end", "score")
    near = (F.col("start") - F.lag("end").over(order) <= distance) & (F.abs(F.col("score") - F.lag("score").over(order)) <= difference)
    rows = df.withColumn("_new", F.when(F.coalesce(near, F.lit(False)), 0).otherwise(1))
    rows = rows.withColumn("_g", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(by, "_g").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n"), F.avg("score").alias("score")).drop("_g")


def merged_rows(df: DataFrame, distance: int, log_sum: bool = False, by: str = "sequence") -> DataFrame:
    """Rows at most ``distance`` apart joined, scores summed up (or the log2 of the sum of 2 ** score)."""
    order = Window.partitionBy(by).orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = df.withColumn("_new", F.when(F.col("start") - reach <= distance, 0).otherwise(1))
    rows = rows.withColumn("_g", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    score = F.log2(F.sum(F.pow(F.lit(2.0), "score"))) if log_sum else F.sum("score")
    return rows.groupBy(by, "_g").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n"), score.alias("score")).drop("_g")


def smoothed(df: DataFrame, kernel: list[float], order_by: tuple[str, ...] = ("start", "end"), by: str = "sequence") -> DataFrame:
    """Scores under a normalised kernel of odd length within each sequence; 0 where it doesn't fit."""
    if len(kernel) % 2 == 0:
        raise ValueError("a kernel has an odd number of weights")
    order, half, total = Window.partitionBy(by).orderBy(*order_by), len(kernel) // 2, float(sum(kernel))
    value = F.lit(0.0)
    for i, w in enumerate(kernel):
        value = value + F.lag("score", half - i).over(order) * F.lit(w / total)
    return df.withColumn("smoothed", F.coalesce(value, F.lit(0.0)))


def ranked(df: DataFrame, by: str, order: str, ties: tuple[str, ...] = (), splits: int = 200) -> DataFrame:
    """rank (ties share the lowest) and row number of rows in each group by a number, as _rank and _row; nulls come last.

    Groups may be large: rows are dealt by approximate quantiles of their group, each share is ranked by itself, and the
    shares' sizes, summed up, are added. Equal numbers fall into the same share. A number that many rows have is a cut, and
    a share of its own: all its rows have one rank, and without ties to order them they are numbered in parts.
    """
    steps = [i / splits for i in range(1, splits)]
    cuts = df.groupBy(by).agg(F.percentile_approx(order, steps, 10 * splits).alias("_cuts"))
    rows = df.join(F.broadcast(cuts), df[by].eqNullSafe(cuts[by])).drop(cuts[by])  # a row of fixed size for each group
    rows = rows.withColumn("_share", F.when(F.col(order).isNull(), 2 * splits + 2).otherwise(2 * F.size(F.filter("_cuts", lambda c: c < F.col(order))) + F.array_contains("_cuts", F.col(order)).cast("int"))).drop("_cuts")
    part = F.lit(0) if ties else F.when(F.col("_share") % 2 == 1, F.pmod(F.monotonically_increasing_id(), F.lit(64)).cast("int")).otherwise(0)
    rows = rows.withColumn("_part", part)
    rows = rows.withColumn("_only", F.col("_share") % 2 == 1)
    sizes = rows.groupBy(by, "_share", "_part").agg(F.count("*").alias("_size"))
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(Window.partitionBy(by).orderBy("_share", "_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    sizes = sizes.withColumn("_first", F.min("_before").over(Window.partitionBy(by, "_share")))
    sizes = sizes.select(F.col(by).alias("_by"), F.col("_share").alias("_s"), F.col("_part").alias("_q"), "_before", "_first")
    rows = rows.join(F.broadcast(sizes), rows[by].eqNullSafe(F.col("_by")) & (F.col("_share") == F.col("_s")) & (F.col("_part") == F.col("_q"))).drop("_by", "_s", "_q")
    own = Window.partitionBy(by, "_share", "_part")
    rows = rows.withColumn("_rank", F.when(F.col("_only"), F.col("_first") + 1).otherwise(F.rank().over(own.orderBy(order)) + F.col("_before")))
    return rows.withColumn("_row", F.row_number().over(own.orderBy(order, *ties)) + F.col("_before")).drop("_share", "_before", "_part", "_only", "_first")


def quantile_normalized(df: DataFrame, file: str = "file", score: str = "score") -> DataFrame:
    """Adds ``normalized``: the mean over files of the scores at the row's rank; ties share the lowest rank."""
    rows = ranked(df, file, score)
    mean = rows.groupBy(F.col("_row").alias("_r")).agg(F.avg(score).alias("normalized"))
    return rows.join(mean, F.col("_rank") == F.col("_r")).drop("_rank", "_row", "_r")


def z_scores(df: DataFrame, score: str = "score") -> DataFrame:
    """(score - mean) / sample deviation over all rows; null without spread."""
    stats = df.agg(F.avg(score).alias("_mean"), F.stddev_samp(score).alias("_std"))
    out = df.join(F.broadcast(stats))  # one row
    return out.withColumn("z", F.try_divide(F.col(score) - F.col("_mean"), F.col("_std"))).drop("_mean", "_std")


def partitions(df: DataFrame, n: int, score: str = "score", by: str = "feature", ties: tuple[str, ...] = ()) -> DataFrame:
    """Rows of each group in order of score in n parts of equal size (larger ones first), numbered from 1."""
    rows = ranked(df, by, score, ties)
    total = df.groupBy(F.col(by).alias("_by")).agg(F.count("*").alias("_total"))
    rows = rows.join(F.broadcast(total), rows[by].eqNullSafe(F.col("_by"))).drop("_by")
    size, more = F.floor(F.col("_total") / n), F.col("_total") % n
    at = F.col("_row") - 1
    head = more * (size + 1)  # rows in the parts that hold one more
    part = F.when(at < head, F.floor(at / (size + 1)) + 1).otherwise(more + F.floor((at - head) / F.greatest(size, F.lit(1))) + 1)
    return rows.withColumn("part", part.cast("int")).drop("_rank", "_row", "_total")


def strand_pairs(df: DataFrame) -> DataFrame:
    """Rows on + with the one on - that starts at the next position, side by side."""
    plus, minus = df.where("strand = '+'"), df.where("strand = '-'")
    minus = minus.select("sequence", (F.col("start") - 1).alias("start"), *(F.col(c).alias(f"{c}_minus") for c in ("c", "t")))
    return plus.select("sequence", "start", "c", "t").join(minus, ["sequence", "start"])


def introns(exons: DataFrame, by: str = "parent") -> DataFrame:
    """What lies between consecutive exons of a transcript (exons that touch or overlap leave nothing)."""
    order = Window.partitionBy(by).orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = exons.withColumn("_from", reach + 1)
    return rows.where(F.col("_from") <= F.col("start") - 1).select(by, "sequence", F.col("_from").alias("start"), (F.col("start") - 1).alias("end"))


def exon_places(exons: DataFrame, by: str = "parent") -> DataFrame:
    """Whether an exon is the first, a middle, the last or the only one in the transcript's direction."""
    up, down = Window.partitionBy(by).orderBy("start", "end", "id"), Window.partitionBy(by).orderBy(F.desc("start"), F.desc("end"), F.desc("id"))
    first, last = F.row_number().over(up) == 1, F.row_number().over(down) == 1
    minus = F.col("strand") == "-"
    place = F.when(first & last, "only").when((first & ~minus) | (last & minus), "first").when((last & ~minus) | (first & minus), "last").otherwise("middle")
    return exons.withColumn("place", place)


def pads(genes: DataFrame, size: int) -> DataFrame:
    """Up to ``size`` positions before and after each gene, cut half way to a neighbour's."""
    order = Window.partitionBy("sequence").orderBy("start", "end", "id")
    left = F.col("start") - F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)) - 1
    right = F.lead("start").over(order) - F.col("end") - 1
    fit = lambda room: F.greatest(F.lit(0), F.least(F.lit(size), F.coalesce(F.floor(room / 2).cast("int"), F.lit(size))))
    return genes.withColumn("pad_left", fit(left)).withColumn("pad_right", fit(right))


def running_offsets(df: DataFrame, gap: int) -> DataFrame:
    """Rows with an absolute coordinate across sequences in order, ``gap`` between them.

    Only one row for each sequence goes through the unpartitioned window.
    """
    span = df.groupBy("sequence").agg(F.max("end").alias("_span"))
    before = F.sum(F.col("_span") + gap).over(Window.orderBy("sequence").rowsBetween(Window.unboundedPreceding, -1))
    offset = span.withColumn("_offset", F.coalesce(before, F.lit(0))).drop("_span")
    return df.join(offset, "sequence").withColumn("absolute", F.col("start") + F.col("_offset")).drop("_offset")


def cumulative_offsets(parts: DataFrame, by: str, length: Column) -> DataFrame:
    """Each part's start and end in the scaffold of its group, parts in order of start."""
    order = Window.partitionBy(by).orderBy("start", "end", "id")
    done = F.coalesce(F.sum(length).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return parts.withColumn("scaffold_start", done + 1).withColumn("scaffold_end", done + length)


def run_lengths(df: DataFrame, step: int, by: str = "sequence") -> DataFrame:
    """Histogram (by, size, runs) of maximal runs of rows that lie at most ``step`` apart."""
    order = Window.partitionBy(by).orderBy("start")
    rows = df.withColumn("_new", F.when(F.col("start") - F.lag("start").over(order) <= step, 0).otherwise(1))
    rows = rows.withColumn("_g", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(by, "_g").agg(F.count("*").alias("size")).groupBy(by, "size").agg(F.count("*").alias("runs"))


def autocorrelation(df: DataFrame, lags: int, by: str = "id", order_by: str = "position", value: str = "value") -> DataFrame:
    """Lag and the mean over groups of the autocorrelation (biased, about the group's mean) at lags 0 to ``lags``.

    Lagged rows meet by (group, position + lag), so the work is lags times the rows.
    """
    group = Window.partitionBy(by)
    rows = df.withColumn("_i", F.row_number().over(group.orderBy(order_by))).withColumn("_d", F.col(value) - F.avg(value).over(group)).withColumn("_n", F.count("*").over(group))
    rows = rows.select(by, "_i", "_d", "_n")
    later = rows.select(by, "_d", F.explode(F.sequence(F.lit(0), F.lit(lags))).alias("lag"), "_i").select(by, (F.col("_i") - F.col("lag")).alias("_i"), F.col("_d").alias("_e"), "lag")
    products = rows.join(later, [by, "_i"]).groupBy(by, "lag").agg(F.sum(F.col("_d") * F.col("_e")).alias("s"))
    spread = rows.groupBy(by).agg(F.sum(F.col("_d") * F.col("_d")).alias("v")).where("v > 0")
    return products.join(spread, by).groupBy("lag").agg(F.avg(F.col("s") / F.col("v")).alias("acf"), F.count("*").alias("n"))
