"""Literals of the remaining functions and operators."""

import collections
import math
import random

import pytest
from pyspark.sql import functions as F

from strandloom.functions import attributes as at
from strandloom.functions import intervals as iv
from strandloom.operators import reads as rd
from strandloom.operators import rows as ro
from strandloom.operators import windows as wi
from strandloom.operators.rangejoin import overlap_join
from strandloom.plans import catalogue
from strandloom.sources import sinks as sk
from strandloom.sources import text as tx
from tests.conftest import rows


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_bounds_and_escapes(spark):
    assert [value(spark, iv.bound(F.lit(x))) for x in ("-Inf", "inf", "2.5", "x")] == [float("-inf"), float("inf"), 2.5, None]
    assert value(spark, at.escaped(F.lit("a b;c=d"))) == "a%20b%3Bc%3Dd"
    assert value(spark, iv.fraction(F.lit(0), F.lit(0))) == 0 and value(spark, iv.safe_divide(F.lit(1), F.lit(None))) == 0
    assert value(spark, iv.overlap_length(F.lit(3), F.lit(9), F.lit(4), F.lit(5))) == 2  # containment counts in full
    assert value(spark, sk.number(F.lit(2.0))) == "2" and value(spark, sk.number(F.lit(0.12345))) == "0.1235"


def test_column_or_attribute(spark):
    df = spark.createDataFrame([("AT1G1.2", {"k": "v.1"})], "locus string, attributes map<string,string>")
    names = ["locus", "*locus", "k", "*k", "absent"]
    assert tuple(df.select(*(at.column_or_attribute(df, n).alias(str(i)) for i, n in enumerate(names))).first()) == ("AT1G1.2", "AT1G1", "v.1", "v", None)


def test_placed_reads(spark):
    genome = spark.createDataFrame([("c", "ACGTACGTAC")], "seq_id string, sequence string")
    text = spark.createDataFrame([("chr\tstrand\tstart\tend\tseq",), ("c\t-\t2\t4\tCGT\r",), ("c\t*\t2\t4\tCGT",), ("c\t+\t1\t2\tAC",)], "value string")
    assert rows(tx.parse_placed_reads(text, genome).select("strand", "read", "target")) == [("+", "AC", "ACGTAC"), ("-", "TGC", "ACGTACG")]


def test_pairs_count_overlapping_positions_once(spark):
    genome = spark.createDataFrame([("c", "CCGG")], "seq_id string, sequence string")
    reads = spark.createDataFrame([("p", 1, "c", 1, "CTG"), ("p", 2, "c", 3, "AA")], "pair_id string, mate int, seq_id string, start int, sequence string")
    assert rows(rd.call_methylation_of_pairs(reads, genome)) == [("c", 1, "+", 1, 0), ("c", 2, "+", 0, 1), ("c", 4, "-", 0, 1)]


def test_microarray_windows(spark):
    f = spark.createDataFrame([("c", 1, 4, 2.0), ("c", 3, 6, 4.0), ("c", 50, 60, 9.0)], "sequence string, start int, end int, score double")
    w = spark.createDataFrame([("w", "c", 2, 10), ("v", "c", 55, 70)], "id string, sequence string, start int, end int")
    assert rows(wi.microarray(overlap_join(f, w))) == [("v", 1, 9.0), ("w", 2, pytest.approx((2 * 3 + 4 * 4) / 5))]


def test_list_filters_and_counts(spark):
    df = spark.createDataFrame([(1, 5), (2, 6), (None, 7)], "id int, x int")
    ids = spark.createDataFrame([(1,), (1,)], "id int")
    assert rows(ro.by_list(df, ids)) == [(1, 5), (None, 7)]
    assert rows(ro.by_list(df, ids, keep=False)) == [(2, 6), (None, 7)]
    assert rows(ro.random_rows(df.where("id is not null"), 1, F.col("id"))) == rows(ro.random_rows(df.where("id is not null"), 1, F.col("id")))
    bad = spark.createDataFrame([("a\tb",), ("a\tb\tc\r",), ("\u00e9\tb\tc",), ("# any",)], "value string")
    assert rows(ro.integrity(bad, 3).select("problem")) == [("carriage return",), ("columns",), ("not ASCII",)]


def test_store_is_bucketed(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 7)
    sk.save_store(df, "strandloom_store", 4, "k")
    try:
        plan = spark.table("strandloom_store").groupBy("k").count()._jdf.queryExecution().toString()
        assert spark.table("strandloom_store").count() == 100 and "Bucketed: true" in plan
    finally:
        spark.sql("drop table strandloom_store")


def test_numbered_rows(spark):
    df = spark.range(500).select((499 - F.col("id")).alias("v"))
    assert rows(tx.numbered(df, ["v"]).select("row", "v")) == [(i, i) for i in range(500)]


def test_queries_on_whole_sequences(spark, tmp_path):
    """Brute force of the queries that read sequences to their ends, well beyond the first 200 letters."""
    rng = random.Random(8)
    texts = {i: "".join(rng.choices("ACGT", k=n)) for i, n in enumerate((0, 1, 20, 127, 128, 253, 1000), 1)}
    made = [*texts.items(), (99, None)]
    spark.createDataFrame(made, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    run = lambda name: rows(catalogue.queries()[name](spark, str(tmp_path)))
    context = lambda x: "CG" if x[1:2] == "G" else "CHG" if x[1:2] and x[1] in "ACT" and x[2:3] == "G" else "CHH"
    called, pairs = collections.defaultdict(lambda: [0, 0]), collections.defaultdict(lambda: [0, 0])
    for i, t in texts.items():
        for k, at in enumerate(range(0, len(t), 7)):
            for p in range(at, min(at + 40, len(t))):
                if t[p] == "C":
                    called[i, p + 1][k % 2 == 0] += 1
        for at in range(0, len(t), 30):
            for p in range(at, min(at + 32, len(t))):
                first = p < at + 20
                if t[p] == ("C" if first else "G"):
                    pairs[i, p + 1, "+" if first else "-"][0] += 1
    sites = [(i, p, *n, context(texts[i][p - 1 : p + 2]), sum(n) > 5) for (i, p), n in sorted(called.items())]
    assert run("M1_methylation_caller") == sites
    assert run("M3_caller_of_pairs") == sorted((*k, *n) for k, n in pairs.items())
    windows, kinds = collections.defaultdict(lambda: [0, 0, 0]), collections.defaultdict(lambda: [0] * 5)
    for _, p, c, t, x, starred in sites:
        for total, more in ((windows[x, -(-p // 50) * 50], (c, t, 1)), (kinds[x], (c * (not starred), t * (not starred), c, t, 1))):
            total[:] = [a + b for a, b in zip(total, more, strict=True)]
    assert run("M4_context_windows") == sorted((*k, *n) for k, n in windows.items())
    assert [r[:-1] for r in run("M2_frequencies")] == sorted((k, *n) for k, n in kinds.items())
    letters = "".join(texts.values())
    n = sum(letters.count(x) for x in "CG")
    assert run("M8_confirmed_sites") == [(False, len(letters) - n), (True, n)]
    got = run("A26_base_entropy")
    assert len(got) == 1000
    for i, *n, entropy in got:
        assert n == [sum(t[i - 1 : i] == x for t in texts.values()) for x in "ACGT"]
        shares = [(x + 1) / (sum(n) + 4) for x in n]
        assert entropy == pytest.approx(-sum(x * math.log2(x) for x in shares), abs=2e-6)
