"""Row-wise operators on feature tables: filters, projections and flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_filter(df: DataFrame, score: tuple[float | None, float | None] = (None, None), length: tuple[int | None, int | None] = (None, None), pattern: str | None = None, include: bool = False, column: str = "attributes") -> DataFrame:
    """Rows within score bounds (a null score passes) and bounds of end - start.

    pattern: rows whose column matches it are deleted; with include only these stay.
    """
    for bound, keep in zip(score, (lambda b: F.col("score") >= b, lambda b: F.col("score") <= b), strict=True):
        if bound is not None:
            df = df.where(F.col("score").isNull() | keep(bound))
    span = F.col("end") - F.col("start")
    for bound, keep in zip(length, (lambda b: span >= b, lambda b: span <= b), strict=True):
        if bound is not None:
            df = df.where(keep(bound))
    if pattern is not None:
        match = F.coalesce(F.col(column).rlike(pattern), F.lit(False))
        df = df.where(match if include else ~match)
    return df


def by_list(df: DataFrame, ids: DataFrame, column: str = "id", keep: bool = True) -> DataFrame:
    """Rows whose id is on the list (keep; rows without an id stay too), or those whose id isn't."""
    listed = ids.select(F.col(ids.columns[0]).alias("_id")).distinct()
    if not keep:
        return df.join(listed, df[column] == F.col("_id"), "left_anti")
    return df.where(F.col(column).isNotNull()).join(listed, df[column] == F.col("_id"), "left_semi").unionByName(df.where(F.col(column).isNull()))


def random_rows(df: DataFrame, n: int, key: Column, seed: int = 0) -> DataFrame:
    """N rows by the smallest digests of seed and key: the same rows each time."""
    return df.withColumn("_h", F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")).cast("binary"))).orderBy("_h", key).limit(n).drop("_h")


def count_range(df: DataFrame, bounds: dict[str, tuple[int, int]]) -> DataFrame:
    """Rows whose c + t lies within the bounds of their genome class (-1: open); rows of other classes go.

    Classes: nuclear (a digit in the name), mit, chr.
    """
    total, ok = F.col("c") + F.col("t"), F.lit(False)
    for name, (low, high) in bounds.items():
        within = F.lit(True) if low < 0 else total >= low
        within &= F.lit(True) if high < 0 else total <= high
        ok = F.when(genome_class(F.col("sequence")) == name, within).otherwise(ok)
    return df.where(ok)


def genome_class(sequence: Column) -> Column:
    """Nuclear, chr, mit or unknown, tested in this order (a digit, then letters)."""
    name = F.lower(sequence)
    return F.when(name.rlike(r"\d"), "nuclear").when(name.rlike("chrc|chloro|pt"), "chr").when(name.rlike("chrm|mito|mt"), "mit").otherwise("unknown")


def repeats_counted(df: DataFrame) -> DataFrame:
    """One row for equal sequence, start, end and strand, its score the number of rows less one."""
    return df.groupBy("sequence", "start", "end", "strand").agg((F.count("*") - 1).cast("double").alias("score"))


def offset(df: DataFrame, scaffold: DataFrame, clamp: bool = True) -> DataFrame:
    """Coordinates moved by a table of (sequence, offset); unknown sequences stay, none goes under 0."""
    moved = df.join(scaffold.withColumnRenamed("offset", "_by"), "sequence", "left").withColumn("_by", F.coalesce("_by", F.lit(0)))
    cut = (lambda c: F.greatest(F.lit(0), c)) if clamp else (lambda c: c)
    return moved.withColumn("start", cut(F.col("start") + F.col("_by"))).withColumn("end", cut(F.col("end") + F.col("_by"))).drop("_by")


def flanked(df: DataFrame, upstream: int = 0, downstream: int = 0) -> DataFrame:
    """Intervals widened upstream and downstream, which the strand turns round; none goes under 0."""
    minus = F.col("strand") == "-"
    low = F.when(minus, F.col("start") - downstream).otherwise(F.col("start") - upstream)
    high = F.when(minus, F.col("end") + upstream).otherwise(F.col("end") + downstream)
    return df.withColumn("_low", F.greatest(F.lit(0), low)).withColumn("end", high).withColumn("start", F.col("_low")).drop("_low")


def sliced(df: DataFrame, first: int, last: int, three_prime: bool = False) -> DataFrame:
    """Positions first..last relative to the 5' (or 3') end in the row's direction; 0 is the end itself."""
    minus = F.col("strand") == "-"
    at_start = minus if three_prime else ~minus
    anchor = F.when(at_start, F.col("start")).otherwise(F.col("end"))
    low, high = F.when(minus, anchor - last).otherwise(anchor + first), F.when(minus, anchor - first).otherwise(anchor + last)
    return df.withColumn("_l", low).withColumn("_h", high).withColumn("start", F.col("_l")).withColumn("end", F.col("_h")).drop("_l", "_h")


def head_tail(df: DataFrame, n: int) -> DataFrame:
    """Two rows, the first n positions in the row's direction (head) and the rest (tail), where there is one."""
    minus = F.col("strand") == "-"
    low, high = F.col("start") + n - 1, F.col("end") - n + 1
    head = F.struct(F.lit("head").alias("part"), F.when(minus, F.greatest("start", high)).otherwise(F.col("start")).alias("s"), F.when(minus, F.col("end")).otherwise(F.least("end", low)).alias("e"))
    tail = F.struct(F.lit("tail").alias("part"), F.when(minus, F.col("start")).otherwise(low + 1).alias("s"), F.when(minus, high - 1).otherwise(F.col("end")).alias("e"))
    out = df.withColumn("_x", F.explode(F.array(head, tail))).withColumn("part", F.col("_x.part"))
    return out.withColumn("start", F.col("_x.s")).withColumn("end", F.col("_x.e")).drop("_x").where("start <= end")


def reversed_rows(df: DataFrame, lengths: DataFrame) -> DataFrame:
    """Coordinates counted from the sequence's other end."""
    out = df.join(lengths, "sequence").withColumn("_s", F.col("length") - F.col("end") + 1).withColumn("end", F.col("length") - F.col("start") + 1)
    return out.withColumn("start", F.col("_s")).drop("_s", "length")


def integrity(lines: DataFrame, columns: int = 9) -> DataFrame:
    """Lines (value) that end in CR, hold other than printable ASCII, or have another number of columns, and why."""
    v = F.col("value")
    found = F.array_compact(
        F.array(
            F.when(v.rlike("\r$"), "carriage return"),
            F.when(v.rlike(r"[^\t\x20-\x7e\r]"), "not ASCII"),
            F.when(~v.startswith("#") & (F.size(F.split(v, "\t")) != columns), "columns"),
        )
    )
    return lines.withColumn("problem", F.explode(found))


def complete_in_all(df: DataFrame, file: str, n_files: int, key: tuple[str, ...] = ("sequence", "start")) -> DataFrame:
    """P25: rows of keys that have a score in every one of n files."""
    whole = df.where("score is not null").groupBy(*key).agg(F.count_distinct(file).alias("_n")).where(F.col("_n") == n_files).drop("_n")
    return df.join(whole, list(key), "left_semi")


def all_present(df: DataFrame, ids: DataFrame, column: str = "id", fill: float = 0.0) -> DataFrame:
    """A row for each listed id, with ``fill`` for the score of those without one."""
    return ids.select(F.col(ids.columns[0]).alias(column)).distinct().join(df, column, "left").fillna(fill, ["score"])


def completed_sites(counts: DataFrame, sites: DataFrame) -> DataFrame:
    """All sites (sequence, start) and all counted rows, counts 0 where nothing was counted."""
    return sites.select("sequence", "start").distinct().join(counts, ["sequence", "start"], "full").fillna(0, ["c", "t"])

