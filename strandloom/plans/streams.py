"""Queries: event-time windows and sessions, in the batch form that equals the finished stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.plans.base import FEATURES, features, table
from strandloom.plans.catalogue import query
from strandloom.streaming import events as ev


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _plain(df: DataFrame) -> DataFrame:
    """Times as text, so that no session's time zone plays a part."""
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return df.select(*(text(c) if c in ("start", "end") else F.round(c, 2).alias(c) if c == "total" else F.col(c) for c in df.columns))


@query(
    "ST_tumbling_windows",
    "select strftime(time_bucket(interval 1 hour, ts), '%Y-%m-%d %H:%M:%S') as start, strftime(time_bucket(interval 1 hour, ts) + interval 1 hour, '%Y-%m-%d %H:%M:%S') as \"end\", event_type, count(*) as n, round(sum(value), 2) as total from events group by all",
)
def tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(ev.windowed(_events(spark, sf_dir), "1 hour"))


@query(
    "ST_sliding_windows",
    "with x as (select *, unnest([0, 1, 2]) as k from events), y as (select *, time_bucket(interval 20 minute, ts) - k * interval 20 minute as s from x) select strftime(s, '%Y-%m-%d %H:%M:%S') as start, strftime(s + interval 1 hour, '%Y-%m-%d %H:%M:%S') as \"end\", event_type, count(*) as n, round(sum(value), 2) as total from y group by all",
)
def sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(ev.windowed(_events(spark, sf_dir), "1 hour", "20 minutes"))


@query(
    "ST_sessions",
    """with l as (select *, ts - lag(ts) over (partition by user_id order by ts) as gap from events), i as (select *, sum(case when gap < interval 30 minute then 0 else 1 end) over (partition by user_id order by ts rows unbounded preceding) as g from l)
select strftime(min(ts), '%Y-%m-%d %H:%M:%S') as start, strftime(max(ts) + interval 30 minute, '%Y-%m-%d %H:%M:%S') as "end", user_id, count(*) as n, round(sum(value), 2) as total from i group by user_id, g""",
)
def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(ev.sessions(_events(spark, sf_dir), "30 minutes"))


@query("W5_window_pool", f"""with {FEATURES} select sequence, (ceil(start / 200.0) * 200)::bigint as "end", sum(c)::bigint as c, sum(t)::bigint as t, count(*) as n from f group by 1, 2""")
def window_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.fixed_windows_stream(features(spark, sf_dir), 200)
