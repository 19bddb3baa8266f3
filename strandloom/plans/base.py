"""The driver's tables as features, annotation and sequences; the same in SQL for the oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _day(column: str):
    return (F.datediff(column, F.lit("1992-01-01").cast("date")) + 1).cast("int")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as intervals with counts: id, sequence, source, feature, start, end, score, strand, c, t, part."""
    x = table(spark, sf_dir, "lineitem")
    return x.select(
        F.col("l_orderkey").alias("id"), F.concat(F.lit("s"), "l_suppkey").alias("sequence"), F.col("l_linestatus").alias("source"), F.col("l_returnflag").alias("feature"),
        _day("l_shipdate").alias("start"), (_day("l_shipdate") + F.col("l_quantity").cast("int") - 1).alias("end"), F.col("l_discount").alias("score"),
        F.when(F.col("l_partkey") % 2 == 0, "+").otherwise("-").alias("strand"), F.col("l_quantity").cast("int").alias("c"), F.col("l_linenumber").alias("t"), F.col("l_partkey").alias("part"),
    )


FEATURES = """f as (select l_orderkey as id, 's' || l_suppkey as sequence, l_linestatus as source, l_returnflag as feature,
  (date_diff('day', date '1992-01-01', l_shipdate::date) + 1)::int as start, (date_diff('day', date '1992-01-01', l_shipdate::date) + cast(l_quantity as int))::int as "end",
  l_discount as score, case when l_partkey % 2 = 0 then '+' else '-' end as strand, cast(l_quantity as int) as c, l_linenumber as t, l_partkey as part from lineitem)"""


def short_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """features with t positions each, so that gaps are left between them."""
    return features(spark, sf_dir).withColumn("end", F.col("start") + F.col("t") - 1)


SHORT = FEATURES + """, g as (select id, sequence, source, feature, start, start + t - 1 as "end", score, strand, c, t, part from f)"""


def annotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as intervals: id, sequence, feature, start, end, strand, score."""
    x = table(spark, sf_dir, "orders")
    return x.select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("s"), F.col("o_custkey") % 1000).alias("sequence"), F.col("o_orderstatus").alias("feature"),
        _day("o_orderdate").alias("start"), (_day("o_orderdate") + (F.col("o_custkey") % 30).cast("int")).alias("end"),
        F.when(F.col("o_orderkey") % 2 == 0, "+").otherwise("-").alias("strand"), F.col("o_totalprice").alias("score"),
    )


ANNOTATION = """a as (select o_orderkey as id, 's' || (o_custkey % 1000) as sequence, o_orderstatus as feature,
  (date_diff('day', date '1992-01-01', o_orderdate::date) + 1)::int as start, (date_diff('day', date '1992-01-01', o_orderdate::date) + 1 + o_custkey % 30)::int as "end",
  case when o_orderkey % 2 = 0 then '+' else '-' end as strand, o_totalprice as score from orders)"""


def lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length of each sequence: 4000 for all suppliers."""
    return table(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("sequence"), F.lit(4000).alias("length"))


LENGTHS = "n as (select 's' || s_suppkey as sequence, 4000 as length from supplier)"


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as nucleotide strings: seq_id, sequence (letters other than ACGT left out), length."""
    x = table(spark, sf_dir, "documents")
    seq = F.regexp_replace(F.upper(F.coalesce("text", F.lit(""))), "[^ACGT]", "")
    return x.select(F.col("doc_id").alias("seq_id"), seq.alias("sequence")).withColumn("length", F.length("sequence"))


SEQUENCES = "s as (select doc_id as seq_id, regexp_replace(upper(coalesce(text, '')), '[^ACGT]', '', 'g') as sequence, length(regexp_replace(upper(coalesce(text, '')), '[^ACGT]', '', 'g')) as length from documents)"


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events by user in order of time: sequence, pos (minutes), event_id, score."""
    x = table(spark, sf_dir, "events")
    return x.select(F.concat(F.lit("u"), "user_id").alias("sequence"), F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 60_000_000).cast("long").alias("pos"), "event_id", F.col("value").alias("score"))


POSITIONS = "p as (select 'u' || user_id as sequence, (epoch_us(ts) // 60000000)::bigint as pos, event_id, value as score from events)"
