"""Literals of interval operators, and the binned join against a plain one on random intervals."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strandloom.operators import analytic as an
from strandloom.operators import rangejoin as rj
from strandloom.operators import rows as ro
from strandloom.operators import windows as wi
from tests.conftest import rows

FEATURE = "sequence string, start int, end int"


def frame(spark, items, more=""):
    return spark.createDataFrame(items, FEATURE + more)


def test_merge_does_not_join_touching_intervals(spark):
    df = frame(spark, [("c", 5, 15), ("c", 0, 10), ("c", 20, 29), ("c", 30, 40)])
    assert rows(rj.merge_intervals(df)) == [("c", 0, 15, 2), ("c", 20, 29, 1), ("c", 30, 40, 1)]


def test_deinterlace(spark):
    df = frame(spark, [("c", 0, 4), ("c", 2, 6)])
    assert [r[:3] for r in rows(rj.deinterlaced(df))] == [("c", 0, 1), ("c", 2, 4), ("c", 5, 6)]


def test_invert_keeps_the_last_base(spark):
    df = frame(spark, [("c", 5, 15), ("c", 20, 29), ("c", 30, 40)])
    lengths = spark.createDataFrame([("c", 50), ("d", 3)], "sequence string, length int")
    assert rows(rj.inverted(df, lengths)) == [("c", 1, 4), ("c", 16, 19), ("c", 41, 50), ("d", 1, 3)]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10**6))
def test_overlap_join_equals_the_plain_join(spark, seed):
    r = random.Random(seed)
    # some so long that bins come in levels
    side = lambda n: [(r.choice("ab"), s := r.randint(1, 300), s + r.choice([0, 1, 5, 90, 90, r.choice([3000, 10**6])])) for _ in range(n)]
    left, right = side(60), side(40)
    want = sorted((*x, *y[1:], min(x[2], y[2]) - max(x[1], y[1]) + 1) for x in left for y in right if x[0] == y[0] and x[1] <= y[2] and x[2] >= y[1])
    got = rj.overlap_join(frame(spark, left), frame(spark, right)).select("sequence", "start", "end", "r_start", "r_end", "overlap")
    assert rows(got) == want
    flags = rows(rj.overlap_exists(frame(spark, left), frame(spark, right)))
    kept = rj.overlap_join(frame(spark, left), frame(spark, right), "left")
    alone = sum(not any(x[0] == y[0] and x[1] <= y[2] and x[2] >= y[1] for y in right) for x in left)
    assert kept.count() == len(want) + alone and kept.where("r_start is null").count() == alone
    assert flags == sorted((*x, any(x[0] == y[0] and x[1] <= y[2] and x[2] >= y[1] for y in right)) for x in left)


def test_left_join_keeps_rows_without_a_pair_once(spark):
    left, right = frame(spark, [("a", 1, 500), ("a", 900, 999), ("b", 1, 2)]), frame(spark, [("a", 400, 450), ("a", 10, 20)])
    got = rj.overlap_join(left, right, "left", width=16).select("sequence", "start", "r_start")
    assert sorted(rows(got), key=str) == sorted([("a", 1, 10), ("a", 1, 400), ("a", 900, None), ("b", 1, None)], key=str)


def test_annotate_threshold_and_invert(spark):
    f = frame(spark, [("a", 1, 10), ("a", 50, 59)])
    a = spark.createDataFrame([("a", 6, 20, "x"), ("a", 9, 12, "y")], FEATURE + ", tag string")
    assert rows(rj.annotate(f, a, "tag", 0.5).select("start", "tag")) == [(1, "x")]
    assert sorted(rows(rj.annotate(f, a, "tag", 0.5, keep=True).select("start", "tag")), key=str) == [(1, "x"), (50, None)]
    assert rows(rj.without_overlap(f, a).select("start")) == [(50,)]


def test_coverage_and_empty_tables(spark):
    df = frame(spark, [("a", 1, 4), ("a", 3, 6)])
    assert rows(rj.coverage(df)) == [("a", 1, 2, 1), ("a", 3, 4, 2), ("a", 5, 6, 1)]
    none = frame(spark, [])
    for op in (rj.coverage, rj.merge_intervals, rj.deinterlaced):
        assert op(none).count() == 0
    assert rj.overlap_join(none, df).count() == rj.overlap_join(df, none).count() == 0
    assert rj.overlap_join(df, none, "left").count() == 2


def test_nearest_is_strict(spark):
    a = frame(spark, [("a", 10, 20), ("a", 30, 40)])
    f = frame(spark, [("a", 20, 30), ("a", 41, 50), ("b", 1, 2)])
    got = {r[0]: r[1:] for r in rj.nearest(f, a).select("start", "previous_end", "next_start").collect()}
    assert got == {20: (None, None), 41: (40, None), 1: (None, None)}


def test_islands_gap_counts_rows(spark):
    df = spark.createDataFrame([("a", i, i, s) for i, s in enumerate([1.0, 1.0, 0.0, 1.0, 0.0, 0.0, 1.0])], FEATURE + ", score double")
    assert [r[1:4] for r in rows(an.islands(df, 0.5, 1))] == [(0, 3, 3), (6, 6, 1)]


def test_quantile_normalization(spark):
    files = {"1": [5, 2, 3, 4], "2": [4, 1, 4, 2], "3": [3, 4, 6, 8]}
    df = spark.createDataFrame([(f, i + 1, float(x)) for f, xs in files.items() for i, x in enumerate(xs)], "file string, start int, score double")
    got = {(r.file, r.start): round(r.normalized, 4) for r in an.quantile_normalized(df).collect()}
    want = {"1": [5.6667, 2, 3, 4.6667], "2": [4.6667, 2, 4.6667, 3], "3": [2, 3, 4.6667, 5.6667]}
    assert got == {(f, i + 1): x for f, xs in want.items() for i, x in enumerate(xs)}


def test_smoothing_stays_within_a_sequence(spark):
    df = spark.createDataFrame([("a", 1, 1, 3.0), ("a", 2, 2, 6.0), ("a", 3, 3, 9.0), ("b", 1, 1, 5.0)], FEATURE + ", score double")
    got = {(r.sequence, r.start): r.smoothed for r in an.smoothed(df, [1, 1, 1]).collect()}
    assert got == pytest.approx({("a", 1): 0, ("a", 2): 6, ("a", 3): 0, ("b", 1): 0})
    with pytest.raises(ValueError):
        an.smoothed(df, [1, 1])


def test_windows_without_skipping(spark):
    df = spark.createDataFrame([("a", "x", 3, 1, 1), ("a", "x", 12, 3, 0)], "sequence string, feature string, start int, c int, t int")
    lengths = spark.createDataFrame([("a", 25), ("b", 99)], "sequence string, length int")
    got = sorted((r.start, r.end, r.n, r.score) for r in wi.fixed_windows(df, 10, lengths=lengths).collect())
    assert got == [(1, 10, 1, 0.5), (11, 20, 1, 1.0), (21, 25, 0, 0.0)]


def test_head_tail_and_slices_follow_the_strand(spark):
    df = spark.createDataFrame([("a", 1, 10, "+"), ("a", 1, 10, "-"), ("a", 1, 2, "+")], FEATURE + ", strand string")
    got = rows(ro.head_tail(df, 4).select("strand", "start", "end", "part"))
    assert got == [("+", 1, 2, "head"), ("+", 1, 4, "head"), ("+", 5, 10, "tail"), ("-", 1, 6, "tail"), ("-", 7, 10, "head")]
    assert rows(ro.sliced(df.limit(2), 0, 2).select("strand", "start", "end")) == [("+", 1, 3), ("-", 8, 10)]


def test_pads_share_the_room(spark):
    df = spark.createDataFrame([(1, "a", 100, 110), (2, "a", 121, 130), (3, "a", 900, 910)], "id int, sequence string, start int, end int")
    assert rows(an.pads(df, 50).select("id", "pad_left", "pad_right")) == [(1, 50, 5), (2, 5, 50), (3, 50, 50)]


def test_proximity_and_profiles(spark):
    w = frame(spark, [("a", 1, 10), ("a", 61, 70), ("a", 5000, 5010)])
    got = {r.start: r.proximity for r in wi.proximity(w, frame(spark, [("a", 5, 20)])).collect()}
    assert got == pytest.approx({1: 1.0, 61: 0.8, 5000: 0.0})
    points = spark.createDataFrame([("a", i, i, 1.0) for i in range(1, 400)], FEATURE + ", score double")
    loci = spark.createDataFrame([(1, "a", 200, 250, "+"), (2, "a", 300, 350, "-")], "id int, sequence string, start int, end int, strand string")
    p = wi.end_profile(points, loci, 10, 40)
    assert p.where(F.abs(F.col("score") - 1) > 1e-9).count() == 0
    assert p.where("id = 1").count() == 8 and p.where("n <> 10").count() == 0


def test_rows_with_nulls(spark):
    df = spark.createDataFrame([("a", 1, 5, None), (None, 1, 5, 1.0), ("a", None, 5, 0.1)], FEATURE + ", score double")
    assert ro.row_filter(df, (0.5, None)).count() == 2
    assert rj.overlap_join(df, frame(spark, [("a", 1, 9)])).count() == 1
