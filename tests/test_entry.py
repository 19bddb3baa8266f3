"""The driver's contract: every query with an oracle gives what DuckDB gives; streams give what batches give."""

import decimal
import math
import time

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from strandloom.plans import catalogue
from strandloom.plans.base import features
from strandloom.streaming import events as ev

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def cells(columns, items):
    """Rows as (everything but floats as text, floats), columns by name, in an order that rounding doesn't change."""

    def parts(r):
        values = [r[i] for i in sorted(range(len(columns)), key=lambda i: columns[i])]
        values = [None if isinstance(x, float) and math.isnan(x) else x for x in values]
        floats = [float(x) for x in values if isinstance(x, float | decimal.Decimal)]
        return tuple("float" if isinstance(x, float | decimal.Decimal) else str(x) for x in values), floats

    return sorted(map(parts, items), key=lambda x: (x[0], [round(y, 4) for y in x[1]]))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{DIR}/{t}.parquet')")
    return c


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_names():
    assert set(catalogue.oracle_sql()) <= set(catalogue.queries())
    assert len(catalogue.queries()) > 200


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_oracle(spark, duck, name):
    got = catalogue.queries()[name](spark, DIR)
    want = duck.execute(catalogue.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    a, b = cells(got.columns, [tuple(r) for r in got.collect()]), cells(columns, want.fetchall())
    assert len(a) == len(b)
    assert [x for x, _ in a] == [x for x, _ in b]
    assert all(x == pytest.approx(y, rel=1e-5, abs=2e-6) for (_, x), (_, y) in zip(a, b, strict=True))


@pytest.mark.parametrize("name", sorted(set(catalogue.queries()) - set(catalogue.oracle_sql())))
def test_query_without_oracle_runs(spark, name):
    assert catalogue.queries()[name](spark, DIR).count() > 0


def _stream(spark, df, path, name, build, mode):
    df.repartition(3).write.parquet(path)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)
    q = build(stream).writeStream.outputMode(mode).format("memory").queryName(name).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return spark.sql(f"select * from {name}")


def test_streams_equal_batches(spark, tmp_path):
    e = spark.read.parquet(f"{DIR}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    build = lambda x: ev.windowed(x, "1 hour", late="60 days").drop("total")
    got = _stream(spark, e, str(tmp_path / "e"), "windows_out", build, "complete")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, build(e).collect()))
    f = features(spark, DIR)
    pool = _stream(spark, f, str(tmp_path / "f"), "pool_out", lambda x: ev.fixed_windows_stream(x, 200), "complete")
    assert sorted(map(tuple, pool.collect())) == sorted(map(tuple, ev.fixed_windows_stream(f, 200).collect()))


def test_stateful_runs(spark, tmp_path):
    path = str(tmp_path / "r")
    for i, part in enumerate(([1, 2, 3], [10, 11], [50])):
        spark.createDataFrame([("a", x) for x in part], "sequence string, start long").coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)  # files are read in order of their time
    stream = spark.readStream.schema("sequence string, start long").option("maxFilesPerTrigger", 1).parquet(path)
    q = ev.runs_stream(stream, 2).writeStream.outputMode("append").format("memory").queryName("runs_out").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert sorted(map(tuple, spark.sql("select * from runs_out").collect())) == [("a", 2), ("a", 3)]
