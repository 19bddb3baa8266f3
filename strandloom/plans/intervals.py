"""Queries: interval joins, coverage, merges and other operators on intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions.intervals import overlap_ratio, safe_divide
from strandloom.operators import rangejoin as rj
from strandloom.plans.base import ANNOTATION, FEATURES, LENGTHS, SHORT, annotation, features, lengths, short_features
from strandloom.plans.catalogue import query

PAIRS = f"""{FEATURES}, {ANNOTATION}, j as (select f.*, a.id as a_id, a.start as a_start, a."end" as a_end, a.strand as a_strand, a.score as a_score,
  least(f."end", a."end") - greatest(f.start, a.start) + 1 as overlap from f join a on f.sequence = a.sequence and f.start <= a."end" and f."end" >= a.start)"""


@query("J1_overlap_join", f"with {PAIRS} select sequence, count(*) as pairs, sum(overlap)::bigint as positions, sum(id * 31 + a_id)::bigint as checksum from j group by 1")
def overlap_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = rj.overlap_join(features(spark, sf_dir), annotation(spark, sf_dir))
    return j.groupBy("sequence").agg(F.count("*").alias("pairs"), F.sum("overlap").alias("positions"), F.sum(F.col("id") * 31 + F.col("r_id")).alias("checksum"))


@query(
    "J2_annotate_one_each",
    f"""with {PAIRS}, k as (select row_number() over () as r, * from f), x as (select k.r, k.sequence, a.id as a_id,
  least(k."end", a."end") - greatest(k.start, a.start) + 1 as overlap, k."end" - k.start + 1 as n
  from k join a on k.sequence = a.sequence and k.start <= a."end" and k."end" >= a.start),
o as (select *, row_number() over (partition by r order by overlap desc, a_id) as m from x where overlap >= 0.5 * n)
select sequence, a_id as tag, count(*) as n, sum(overlap)::bigint as overlap from o where m = 1 group by all""",
)
def annotate_one_each(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = annotation(spark, sf_dir).withColumnRenamed("id", "tag")
    out = rj.annotate(features(spark, sf_dir), a, "tag", 0.5, one_each=True)
    return out.groupBy("sequence", "tag").agg(F.count("*").alias("n"), F.sum("overlap").alias("overlap"))


@query(
    "J2_annotate_extended_keep",
    f"""with {FEATURES}, {ANNOTATION}, w as (select *, start - (case when strand = '-' then 3 else 10 end) as lo, "end" + (case when strand = '-' then 10 else 3 end) as hi from a),
k as (select row_number() over () as r, * from f), x as (select k.r, k.sequence, w.id as tag from k left join w on k.sequence = w.sequence and k.start <= w.hi and k."end" >= w.lo)
select sequence, count(tag) as tagged, count(*) filter (tag is null) as untagged from x group by 1""",
)
def annotate_extended_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = annotation(spark, sf_dir).withColumnRenamed("id", "tag")
    out = rj.annotate(features(spark, sf_dir), a, "tag", extend=(10, 3), keep=True)
    return out.groupBy("sequence").agg(F.count("tag").alias("tagged"), F.count_if(F.col("tag").isNull()).alias("untagged"))


@query(
    "J3_window_by_annotation",
    f"with {PAIRS} select a.id, count(j.id) as n, coalesce(sum(c), 0)::bigint as c, coalesce(sum(t), 0)::bigint as t, round(coalesce(sum(c) * 1.0 / nullif(sum(c) + sum(t), 0), 0), 6) as score from (select distinct id from a) a left join j on a.id = j.a_id group by a.id",
)
def window_by_annotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    aggs = [F.count("*").alias("n"), F.sum("c").alias("c"), F.sum("t").alias("t")]
    out = rj.window_by_annotation(features(spark, sf_dir), annotation(spark, sf_dir), aggs, keep=True).fillna(0, ["n", "c", "t"])
    return out.withColumn("score", F.round(safe_divide(F.col("c"), F.col("c") + F.col("t")), 6))


@query(
    "J4_window_by_annotation_rpkm",
    f"""with {PAIRS} select a_id as id, count(*) as n, round(count(*) / ((max(a_end) - max(a_start) + 1) / 1000.0) / ((select count(*) from f) / 1000000.0), 4) as rpkm from j group by 1""",
)
def window_by_annotation_rpkm(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = features(spark, sf_dir)
    out = rj.overlap_join(f, annotation(spark, sf_dir)).groupBy(F.col("r_id").alias("id")).agg(F.count("*").alias("n"), (F.max("r_end") - F.max("r_start") + 1).alias("_len"))
    out = out.join(F.broadcast(f.agg(F.count("*").alias("_all"))))  # one row
    return out.select("id", "n", F.round(F.col("n") / (F.col("_len") / 1000) / (F.col("_all") / 1000000), 4).alias("rpkm"))


@query(
    "J5_best_locus",
    f"""with {FEATURES}, {ANNOTATION}, k as (select row_number() over () as r, * from f), x as (select k.*, a.id as locus, a.strand as a_strand,
  abs((k.start + k."end") / 2.0 - (a.start + a."end") / 2.0) as distance from k join a on k.sequence = a.sequence and k.start - 20 <= a."end" and k."end" + 20 >= a.start),
o as (select *, row_number() over (partition by r order by distance, locus) as m from x)
select sequence, locus, count(*) as probes, round(sum(distance), 2) as distance from o where m = 1 group by all""",
)
def best_locus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each probe's locus with the nearest centre among those within 20 positions."""
    f = features(spark, sf_dir).withColumn("_id", F.monotonically_increasing_id())
    near = rj.overlap_join(f, annotation(spark, sf_dir).drop("strand"), extend=(20, 20))
    distance = F.abs((F.col("start") + F.col("end")) / 2 - (F.col("r_start") + F.col("r_end")) / 2)
    best = near.groupBy("_id", "sequence").agg(F.min(F.struct(distance.alias("distance"), F.col("r_id").alias("locus"))).alias("b"))
    return best.groupBy("sequence", F.col("b.locus").alias("locus")).agg(F.count("*").alias("probes"), F.round(F.sum("b.distance"), 2).alias("distance"))


@query(
    "J6_nearest",
    f"""with {ANNOTATION} select x.id, (select max(y."end") from a y where y.sequence = x.sequence and y."end" < x.start) as previous_end,
  (select min(y.start) from a y where y.sequence = x.sequence and y.start > x."end") as next_start from a x""",
)
def nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = annotation(spark, sf_dir)
    return rj.nearest(a, a).select("id", "previous_end", "next_start")


@query(
    "J20_point_in_ranges",
    f"""with {FEATURES}, {ANNOTATION} select a.id, count(f.id) as points from a left join f on f.sequence = a.sequence and f.start between a.start and a."end" group by a.id""",
)
def point_in_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = features(spark, sf_dir).withColumn("end", F.col("start"))
    hit = rj.overlap_join(points, annotation(spark, sf_dir)).groupBy(F.col("r_id").alias("id")).agg(F.count("*").alias("points"))
    return annotation(spark, sf_dir).groupBy("id").agg(F.count("*").alias("_n")).join(hit, "id", "left").select("id", F.coalesce("points", F.lit(0)).alias("points"))


@query("J21_overlappers", f"""with {FEATURES} select sequence, feature, count(*) as n, sum(id)::bigint as ids from f where feature = 'R' and start <= 2000 and "end" >= 1800 group by all""")
def overlappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one feature that share a position with a range."""
    f = features(spark, sf_dir).where((F.col("feature") == "R") & (F.col("start") <= 2000) & (F.col("end") >= 1800))
    return f.groupBy("sequence", "feature").agg(F.count("*").alias("n"), F.sum("id").alias("ids"))


@query(
    "P3_range_filter",
    f"""with {FEATURES}, x as (select *, (least("end", 2000) - greatest(start, 1000) + 1) * 100.0 / ("end" - start + 1) as pct from f where start <= 2000 and "end" >= 1000)
select sequence, count(*) as n, sum(c)::bigint as c from x where pct >= 70 group by 1""",
)
def range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of which a range covers at least 70 %."""
    share = overlap_ratio(F.col("start"), F.col("end"), F.lit(1000), F.lit(2000)) * 100
    return features(spark, sf_dir).where(share >= 70).groupBy("sequence").agg(F.count("*").alias("n"), F.sum("c").alias("c"))


@query(
    "P7_overlap_flag",
    f"""with {FEATURES}, {ANNOTATION}, x as (select *, exists (select 1 from a where a.sequence = f.sequence and f.start <= a."end" and f."end" >= a.start) as hit from f)
select sequence, hit, count(*) as n, sum(id)::bigint as ids from x group by all""",
)
def overlap_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rj.overlap_exists(features(spark, sf_dir), annotation(spark, sf_dir))
    return out.groupBy("sequence", "hit").agg(F.count("*").alias("n"), F.sum("id").alias("ids"))


@query(
    "T4_anti_overlap",
    f"""with {FEATURES}, {ANNOTATION} select sequence, count(*) as n from f where not exists (select 1 from a where a.sequence = f.sequence and f.start <= a."end" and f."end" >= a.start) group by 1""",
)
def anti_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rj.without_overlap(features(spark, sf_dir), annotation(spark, sf_dir)).groupBy("sequence").agg(F.count("*").alias("n"))


@query(
    "P8_reads_by_coordinate",
    f"""with {PAIRS} select sequence, feature, count(*) as n from j where overlap * 10 >= 7 * ("end" - start + 1) and c > t group by all""",
)
def reads_by_coordinate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of which a locus covers 70 %, with more of one count than of the other."""
    j = rj.overlap_join(features(spark, sf_dir), annotation(spark, sf_dir))
    return j.where((F.col("overlap") * 10 >= 7 * (F.col("end") - F.col("start") + 1)) & (F.col("c") > F.col("t"))).groupBy("sequence", "feature").agg(F.count("*").alias("n"))


@query(
    "P19_liftover",
    f"""with {FEATURES}, {LENGTHS}, d as (select sequence, k * 400 + 1 as from_start, k * 400 + 350 as from_end, k * 500 + 10 as to_start from n, (select unnest(range(0, 10)) as k) where sequence <> 's1'),
x as (select f.*, d1.to_start + f.start - d1.from_start as s2, d2.to_start + f."end" - d2.from_start as e2, f.sequence in (select sequence from d) as known
  from f left join d d1 on f.sequence = d1.sequence and f.start between d1.from_start and d1.from_end left join d d2 on f.sequence = d2.sequence and f."end" between d2.from_start and d2.from_end)
select sequence, case when known then s2 else start end as start, case when known then e2 else "end" end as "end", count(*) as n from x where not known or (s2 is not null and e2 is not null) group by all""",
)
def liftover(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.explode(F.sequence(F.lit(0), F.lit(9))).alias("k")
    d = lengths(spark, sf_dir).where("sequence <> 's1'").select("sequence", k)
    d = d.select("sequence", (F.col("k") * 400 + 1).alias("from_start"), (F.col("k") * 400 + 350).alias("from_end"), (F.col("k") * 500 + 10).alias("to_start"))
    return rj.lifted(features(spark, sf_dir), d).groupBy("sequence", "start", "end").agg(F.count("*").alias("n"))


@query(
    "A30_coverage",
    f"""with {SHORT}, b as (select sequence, unnest(range(start, "end" + 1)) as p from g), d as (select sequence, p, count(*) as depth from b group by all)
select sequence, depth::bigint as depth, count(*) as positions from d group by all""",
)
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rj.coverage(short_features(spark, sf_dir))
    return out.groupBy("sequence", "depth").agg(F.sum(F.col("end") - F.col("start") + 1).cast("bigint").alias("positions"))


@query(
    "N1_merge_intervals",
    f"""with {SHORT}, m as (select *, max("end") over (partition by sequence order by start, "end" rows between unbounded preceding and 1 preceding) as reach from g),
i as (select *, sum(case when start > reach then 1 else 0 end) over (partition by sequence order by start, "end" rows unbounded preceding) as island from m)
select sequence, min(start) as start, max("end") as "end", count(*) as n from i group by sequence, island""",
)
def merge_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rj.merge_intervals(short_features(spark, sf_dir))


@query(
    "N2_merge_annotation",
    f"""with {SHORT}, m as (select *, max("end") over (partition by sequence order by start, "end" rows between unbounded preceding and 1 preceding) as reach from g),
i as (select *, sum(case when start > reach then 1 else 0 end) over (partition by sequence order by start, "end" rows unbounded preceding) as island from m)
select sequence, min(start) as start, max("end") as "end", case when count(distinct feature) > 1 then 'mixed' else min(feature) end as feature, list_aggregate(list_sort(list_distinct(list(feature))), 'string_agg', ',') as members
from i group by sequence, island""",
)
def merge_annotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rj.merge_intervals(short_features(spark, sf_dir), members=F.col("feature"))
    return out.select("sequence", "start", "end", F.when(F.size("members") > 1, "mixed").otherwise(F.col("members")[0]).alias("feature"), F.array_join("members", ",").alias("members"))


@query(
    "N3_deinterlace",
    f"""with {SHORT}, c as (select distinct sequence, unnest([start, "end" + 1]) as start from g), p as (select sequence, start, lead(start) over (partition by sequence order by start) - 1 as "end" from c),
q as (select p.*, (select count(*) from g where g.sequence = p.sequence and g.start <= p.start and g."end" >= p."end") as n from p where "end" is not null)
select sequence, start, "end", n from q where n > 0""",
)
def deinterlace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rj.deinterlaced(short_features(spark, sf_dir))


@query(
    "N4_invert",
    f"""with {SHORT}, {LENGTHS}, b as (select distinct sequence, unnest(range(start, "end" + 1)) as p from g), u as (select n.sequence, x as p from n, (select unnest(range(1, 4001)) as x)
  where not exists (select 1 from b where b.sequence = n.sequence and b.p = x)), k as (select *, p - row_number() over (partition by sequence order by p) as grp from u)
select sequence, min(p)::int as start, max(p)::int as "end" from k group by sequence, grp""",
)
def invert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rj.inverted(short_features(spark, sf_dir), lengths(spark, sf_dir))


@query(
    "G4_best_window_in_peak",
    f"""with {PAIRS}, o as (select *, row_number() over (partition by a_id order by score desc, start, "end") as m from j) select a_id as peak, a_start as start, a_end as "end", start as maxstart, "end" as maxend, score as maxwin from o where m = 1""",
)
def best_window_in_peak(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best-scoring window that overlaps each peak, ties to the first."""
    j = rj.overlap_join(features(spark, sf_dir), annotation(spark, sf_dir))
    best = F.max(F.struct(F.col("score"), (-F.col("start")).alias("s"), (-F.col("end")).alias("e"))).alias("b")
    out = j.groupBy(F.col("r_id").alias("peak"), F.col("r_start").alias("start"), F.col("r_end").alias("end")).agg(best)
    return out.select("peak", "start", "end", (-F.col("b.s")).alias("maxstart"), (-F.col("b.e")).alias("maxend"), F.col("b.score").alias("maxwin"))
