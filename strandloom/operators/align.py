"""Alignment of several tables on keys: outer joins, arithmetic, set operations."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.functions.intervals import log2_ratio

KEY = ("sequence", "start")


def _pair(a: DataFrame, b: DataFrame, how: str, key: tuple[str, ...] = KEY) -> DataFrame:
    """Scores a and b by lower-case sequence and start; of rows that share a key the sum."""
    one = lambda df, name: df.groupBy(F.lower("sequence").alias("sequence"), *key[1:]).agg(F.sum("score").alias(name))
    return one(a, "a").join(one(b, "b"), list(key), how)


_WORDS = {"a", "b", "abs", "sqrt", "log2", "ln", "exp", "greatest", "least", "pow", "coalesce", "if", "methyl", "div"}


def expression(text: str) -> Column:
    """J7, 2.14: an arithmetic expression over scores a and b, from a fixed vocabulary.

    methyl(x, y) is x / (x + y), 0 without either; div(x, y) is x / y, null for y = 0; a plain slash isn't allowed.
    """
    words = set(re.findall(r"[A-Za-z_]\w*", text))
    if words - _WORDS or re.search(r"[^\w\s+\-*%().,<>=!]", text):
        raise ValueError(f"not allowed in an expression: {sorted(words - _WORDS) or text}")
    text = re.sub(r"\bmethyl\(([^(),]*),([^(),]*)\)", r"coalesce(try_divide(\1, (\1) + (\2)), 0D)", text)
    return F.expr(re.sub(r"\bdiv\(", "try_divide(", text))


def arithmetic(a: DataFrame, b: DataFrame, text: str, zero: bool = True) -> DataFrame:
    """An expression of both scores by (sequence, start); with zero a missing score is 0, else such rows are left out."""
    both = _pair(a, b, "full" if zero else "inner")
    return both.fillna(0.0, ["a", "b"]).withColumn("score", expression(text)).select(*KEY, "score")


def subtracted(a: DataFrame, b: DataFrame) -> DataFrame:
    """A - b by (sequence, start), a missing score being 0."""
    return arithmetic(a, b, "a - b")


def compared(a: DataFrame, b: DataFrame, how: str = "log2") -> DataFrame:
    """log2 ratio (NaN unless both are above 0), difference or product of scores that both tables have."""
    both = _pair(a, b, "inner")
    score = {"log2": log2_ratio(F.col("a"), F.col("b")), "difference": F.col("a") - F.col("b"), "product": F.col("a") * F.col("b")}[how]
    return both.select(*KEY, score.alias("score"))


def mashup(tables: dict[str, DataFrame], keys: list[str], values: list[str]) -> DataFrame:
    """One row for each key that any table holds, with the values of each as nick_value; missing ones are null.

    One shuffle for any number of tables: a tagged union, grouped by the key. Of rows that share a key the largest value
    of each column is taken.
    """
    tagged = None
    for nick, df in tables.items():
        part = df.select(*keys, *values, F.lit(nick).alias("_nick"))
        tagged = part if tagged is None else tagged.unionByName(part)
    return tagged.groupBy(*keys).agg(*(F.max(F.when(F.col("_nick") == n, F.col(v))).alias(f"{n}_{v}") for n in tables for v in values))


def unmashed(df: DataFrame, keys: list[str]) -> DataFrame:
    """A wide table back to (keys, variable, value) rows, without missing values."""
    rest = [c for c in df.columns if c not in keys]
    return df.unpivot(keys, rest, "variable", "value").where("value is not null")


def union_preferring_left(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """left's rows, and right's of keys that left doesn't have."""
    return left.unionByName(right.join(left.select(key).distinct(), key, "left_anti"))


def symmetric_difference(tables: dict[str, DataFrame], key: list[str]) -> DataFrame:
    """Keys that exactly one table holds, and which."""
    tagged = None
    for nick, df in tables.items():
        part = df.select(*key).distinct().withColumn("file", F.lit(nick))
        tagged = part if tagged is None else tagged.unionByName(part)
    return tagged.groupBy(*key).agg(F.count("*").alias("_n"), F.first("file").alias("file")).where("_n = 1").drop("_n")


def list_combinations(df: DataFrame, item: str, name: str) -> DataFrame:
    """For each combination of lists how many items are on just these."""
    lists = df.groupBy(item).agg(F.array_join(F.array_sort(F.collect_set(name)), ",").alias("lists"))
    return lists.groupBy("lists").agg(F.count("*").alias("n"))


def tables_equal(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """T5: for each key whether both tables have it with equal rows."""
    cells = [c for c in a.columns if c != key]
    x, y = a.select(key, F.struct(*cells).alias("_a")), b.select(key, F.struct(*cells).alias("_b"))
    return x.join(y, key, "full").select(key, F.col("_a").eqNullSafe(F.col("_b")).alias("equal"))
