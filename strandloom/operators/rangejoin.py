"""Interval joins (J1 and what builds on it) as binned equi-joins.

An interval goes to every bin it touches, both sides meet on (sequence, bin), and a pair is kept only in the bin of its
first shared position, so each pair appears once. Bins split a sequence with very many rows; adaptive execution splits bins.

Where some intervals are far longer than most, bins come in levels, each 16 times as wide as the one before. An interval
belongs to the level at which it touches a few bins, goes to the bins of that and all wider levels, and two intervals meet
at the wider one's level. So a chromosome-long interval takes a few rows, not a row for each bin below it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.functions.intervals import overlap_length


def bin_widths(left: DataFrame, right: DataFrame, least: int = 16, most_bins: int = 64, factor: int = 16) -> list[int]:
    """Widths of the levels: the first about the longest of nearly all of right's intervals, the last for the longest of all."""
    length = F.col("_high") - F.col("_low") + 1
    row = right.select(F.percentile_approx(length, 0.95, 1000), F.max(length)).first()
    longest = max(row[1] or 1, left.select(F.max(F.col("end") - F.col("start") + 1)).first()[0] or 1)
    widths = [max(least, int(row[0] or least))]
    while widths[-1] * most_bins < longest:
        widths.append(widths[-1] * factor)
    return widths


def _binned(df: DataFrame, low: str, high: str, widths: list[int], name: str) -> DataFrame:
    """A row for each bin: <name>bin (level and number) and <name>own, the row's own level."""
    length = F.col(high) - F.col(low) + 1
    own = F.lit(len(widths) - 1)
    for k in range(len(widths) - 2, -1, -1):
        own = F.when(length <= 4 * widths[k], k).otherwise(own)
    width = F.array(*(F.lit(w) for w in widths))

    def bins(k: Column) -> Column:
        w = F.get(width, k)
        return F.transform(F.sequence(F.floor(F.col(low) / w).cast("long"), F.floor(F.col(high) / w).cast("long")), lambda x: F.struct(k.alias("level"), x.alias("number")))

    levels = F.flatten(F.transform(F.sequence(own, F.lit(len(widths) - 1)), bins))
    return df.where(F.col(low) <= F.col(high)).withColumn(f"{name}own", own).withColumn(f"{name}bin", F.explode(levels))


def overlap_join(left: DataFrame, right: DataFrame, how: str = "inner", extend: tuple[int, int] = (0, 0), width: int | None = None) -> DataFrame:
    """Pairs of rows of left and right (sequence, start, end) that share a position, with ``overlap``.

    right's columns come with the prefix ``r_``. extend widens right's intervals below and above (by strand if right has
    one). how: inner, or left (left's rows without a pair once, with nulls). Rows with a null sequence or coordinate, or
    that end before they start, have no pair, and left leaves them out.
    """
    if how == "left":
        left = left.withColumn("_row", F.monotonically_increasing_id())
    right = right.select(*(F.col(c).alias(f"r_{c}") for c in right.columns))
    low, high = F.col("r_start"), F.col("r_end")
    if extend != (0, 0):
        up, down = (F.lit(x) for x in extend)
        if "r_strand" in right.columns:
            minus = F.col("r_strand") == "-"
            low, high = low - F.when(minus, down).otherwise(up), high + F.when(minus, up).otherwise(down)
        else:
            low, high = low - up, high + down
    right = right.withColumn("_low", low).withColumn("_high", high)
    widths = [width] if width else bin_widths(left, right)
    a, b = _binned(left, "start", "end", widths, "_a"), _binned(right, "_low", "_high", widths, "_b")
    level = F.col("_abin.level")
    at = F.floor(F.greatest(F.col("start"), F.col("_low")) / F.get(F.array(*(F.lit(w) for w in widths)), level)).cast("long")
    match = (F.col("sequence") == F.col("r_sequence")) & (F.col("_abin") == F.col("_bbin")) & (F.col("start") <= F.col("_high")) & (F.col("end") >= F.col("_low"))
    match &= (level == F.greatest("_aown", "_bown")) & (F.col("_abin.number") == at)
    inner = ("_low", "_high", "_abin", "_bbin", "_aown", "_bown")
    overlap = overlap_length(F.col("start"), F.col("end"), F.col("_low"), F.col("_high"))
    if how == "inner":
        return a.join(b, match).withColumn("overlap", overlap).drop(*inner)
    if how == "left":
        # one pass: a row without a pair keeps the first of its bins
        pairs = a.join(b, match, "left").withColumn("_hits", F.count("_low").over(Window.partitionBy("_row")))
        home = (level == F.col("_aown")) & (F.col("_abin.number") == F.floor(F.col("start") / F.get(F.array(*(F.lit(w) for w in widths)), level)))
        pairs = pairs.where(F.col("_low").isNotNull() | ((F.col("_hits") == 0) & home))
        return pairs.withColumn("overlap", F.when(F.col("_low").isNotNull(), overlap)).drop(*inner, "_row", "_hits")
    raise ValueError(f"how must be inner or left, not {how}")


def overlap_exists(left: DataFrame, right: DataFrame, flag: str = "hit", width: int | None = None) -> DataFrame:
    """left's rows with whether any row of right shares a position; no pairs are made of it.

    The union of right's intervals, made of merged islands, is looked up by bin, so a row meets few of them.
    """
    merged = merge_intervals(right.select("sequence", "start", "end")).select("sequence", "start", "end")
    pairs = overlap_join(left.withColumn("_id", F.monotonically_increasing_id()), merged, "left", width=width)
    first = pairs.groupBy("_id", *left.columns).agg(F.max(F.col("r_start").isNotNull()).alias(flag))
    return first.drop("_id")


def merge_intervals(df: DataFrame, gap: int = 0, by: tuple[str, ...] = ("sequence",), members: Column | None = None) -> DataFrame:
    """Unions of intervals that share a position (or lie at most ``gap`` apart), with how many they are.

    Touching intervals (29 and 30) are not merged at gap 0. members adds the sorted array of that column's values.
    """
    order = Window.partitionBy(*by).orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = df.withColumn("_new", F.when(F.col("start") > reach + gap, 1).otherwise(0))
    marked = marked.withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    aggs = [F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n")]
    if members is not None:
        aggs.append(F.array_sort(F.collect_set(members)).alias("members"))
    return marked.groupBy(*by, "_island").agg(*aggs).drop("_island")


def annotate(features: DataFrame, annotation: DataFrame, tag: str = "id", threshold: float = 0.0, extend: tuple[int, int] = (0, 0), keep: bool = False, one_each: bool = False) -> DataFrame:
    """Features with the tag of overlapping annotation that covers at least threshold of them.

    keep: features without one stay, with a null tag. one_each: the longest overlap only, ties to the smaller tag.
    """
    pairs = overlap_join(features.withColumn("_id", F.monotonically_increasing_id()), annotation, "left", extend)
    covers = F.coalesce(F.col("overlap") >= threshold * (F.col("end") - F.col("start") + 1), F.lit(False))
    pairs = pairs.withColumn("_ok", covers).withColumn(tag, F.when(F.col("_ok"), F.col(f"r_{tag}")))
    pairs = pairs.withColumn("overlap", F.when(F.col("_ok"), F.col("overlap")))
    place = F.row_number().over(Window.partitionBy("_id").orderBy(F.desc("_ok"), F.desc_nulls_last("overlap"), tag))
    pairs = pairs.withColumn("_n", place).where(F.col("_ok") if not keep else F.col("_ok") | (F.col("_n") == 1))
    if one_each:
        pairs = pairs.where("_n = 1")
    return pairs.select(*features.columns, *([] if tag in features.columns else [tag]), "overlap")


def without_overlap(features: DataFrame, annotation: DataFrame) -> DataFrame:
    """J2 inverted, T4: features that share no position with the annotation."""
    return overlap_exists(features, annotation, "_hit").where("not _hit").drop("_hit")


def nearest(features: DataFrame, annotation: DataFrame) -> DataFrame:
    """Each feature's nearest annotation end before its start, and start after its end (both strictly; null if none)."""
    # one sorted pass: positions of both tables in a union, the last one seen so far carried along
    f = features.withColumn("_id", F.monotonically_increasing_id())

    def carried(at: str, other: str, name: str, forward: bool) -> DataFrame:
        rows = f.select("sequence", F.col(at).alias("p"), "_id", F.lit(None).cast("long").alias("v"))
        rows = rows.unionByName(annotation.select("sequence", F.col(other).alias("p"), F.lit(None).cast("long").alias("_id"), F.col(other).cast("long").alias("v")))
        # both frames grow from the first row on, so each row is added once; for the next start, positions descend
        w = Window.partitionBy("sequence").orderBy("p" if forward else F.desc("p")).rangeBetween(Window.unboundedPreceding, -1)
        found = F.max("v").over(w) if forward else F.min("v").over(w)
        return rows.withColumn(name, found).where("_id is not null").select("_id", name)

    out = f.join(carried("start", "end", "previous_end", True), "_id").join(carried("end", "start", "next_start", False), "_id")
    return out.drop("_id")


def window_by_annotation(features: DataFrame, annotation: DataFrame, aggs: list[Column], tag: str = "id", keep: bool = False) -> DataFrame:
    """Aggregates of the features that overlap each annotation row, by its tag; keep: also those without any."""
    pairs = overlap_join(features, annotation)
    out = pairs.groupBy(F.col(f"r_{tag}").alias(tag)).agg(*aggs)
    return annotation.select(tag).distinct().join(out, tag, "left") if keep else out


def lifted(df: DataFrame, dictionary: DataFrame, columns: tuple[str, ...] = ("start", "end")) -> DataFrame:
    """Coordinates moved by a table of (sequence, from_start, from_end, to_start); unknown sequences keep theirs.

    A row of a known sequence of which a coordinate is in no segment is dropped.
    """
    known = dictionary.select("sequence").distinct().withColumn("_known", F.lit(True))
    segments = dictionary.select("sequence", F.col("from_start").alias("start"), F.col("from_end").alias("end"), "to_start")
    out = df.join(known, "sequence", "left")
    for c in columns:
        # a coordinate is an interval of one position, which meets one segment of its sequence at most
        points = out.select("sequence", F.col(c).alias("start"), F.col(c).alias("end"), F.struct(*(F.col(f"`{x}`") for x in out.columns)).alias("_in"))
        moved = F.when(F.col("_in._known"), F.col("start") - F.col("r_start") + F.col("r_to_start")).otherwise(F.col("start"))
        out = overlap_join(points, segments, "left").select("_in.*", moved.alias("_moved")).withColumn(c, F.col("_moved")).drop("_moved")
    return out.where(" and ".join(f"{c} is not null" for c in columns)).drop("_known")


def coverage(df: DataFrame, weight: Column | None = None) -> DataFrame:
    """Stretches of equal depth (sequence, start, end, depth) from +1 and -1 events, without exploding bases."""
    w = F.lit(1) if weight is None else weight
    events = df.select("sequence", F.explode(F.array(F.struct(F.col("start").alias("p"), w.alias("d")), F.struct((F.col("end") + 1).alias("p"), (-w).alias("d")))).alias("e"))
    steps = events.groupBy("sequence", F.col("e.p").alias("start")).agg(F.sum("e.d").alias("d"))
    order = Window.partitionBy("sequence").orderBy("start")
    steps = steps.withColumn("depth", F.sum("d").over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("end", F.lead("start").over(order) - 1)
    return steps.where("depth <> 0 and end is not null").select("sequence", "start", "end", "depth")


def deinterlaced(df: DataFrame) -> DataFrame:
    """Disjoint pieces (sequence, start, end, n) of an overlapping set, with how many intervals cover each.

    Cuts follow the rule that a piece shared by two intervals has both its end points: [0,4] and [2,6] give [0,1], [2,4], [5,6].
    """
    cuts = df.select("sequence", F.explode(F.array(F.col("start"), F.col("end") + 1)).alias("start")).distinct()
    order = Window.partitionBy("sequence").orderBy("start")
    pieces = cuts.withColumn("end", F.lead("start").over(order) - 1).where("end is not null")
    depth = coverage(df)
    # every cut is a step of the depth or lies inside a stretch of equal depth
    found = overlap_join(pieces, depth)
    return found.select("sequence", "start", "end", F.col("r_depth").alias("n"))


def inverted(df: DataFrame, lengths: DataFrame) -> DataFrame:
    """Gaps between merged intervals, from 1 to the sequence's length (both closed; the last base is kept)."""
    merged = merge_intervals(df, gap=1)
    order = Window.partitionBy("sequence").orderBy("start")
    gaps = merged.withColumn("gap_start", F.coalesce(F.lag("end").over(order) + 1, F.lit(1))).select("sequence", F.col("gap_start").alias("start"), (F.col("start") - 1).alias("end"))
    last = lengths.join(merged.groupBy("sequence").agg(F.max("end").alias("m")), "sequence", "left")
    last = last.select("sequence", (F.coalesce("m", F.lit(0)) + 1).alias("start"), F.col("length").alias("end"))
    return gaps.unionByName(last).where("start <= end")
