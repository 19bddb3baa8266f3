"""Queries: windows, profiles, islands and other operators that depend on order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.operators import analytic as an
from strandloom.operators import windows as wi
from strandloom.operators.rangejoin import overlap_join
from strandloom.plans.base import ANNOTATION, FEATURES, LENGTHS, POSITIONS, SHORT, annotation, features, lengths, positions, short_features, table
from strandloom.plans.catalogue import query


@query(
    "W1_fixed_window_fraction",
    """
with x as (select l_returnflag as sequence, date_diff('day', date '1992-01-01', l_shipdate::date) + 1 as pos,
  cast(l_quantity as int) as c, l_linenumber as t from lineitem)
select sequence, cast(ceil(pos / 50.0) * 50 as bigint) as win_end, cast(sum(c) as bigint) as c, cast(sum(t) as bigint) as t,
  count(*) as n, round(coalesce(sum(c) * 1.0 / nullif(sum(c) + sum(t), 0), 0), 6) as score from x group by 1, 2
""",
)
def fixed_window_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = features(spark, sf_dir).select(F.col("feature").alias("sequence"), "start", "c", "t")
    out = wi.fixed_windows(x, 50, ("sequence",)).withColumnRenamed("end", "win_end").drop("start")
    return out.withColumn("score", F.round("score", 6))


@query(
    "W2_fixed_windows_no_skip",
    f"""with {FEATURES}, {LENGTHS}, w as (select sequence, feature, (ceil(start / 50.0) * 50)::bigint as e, sum(c)::bigint as c, sum(t)::bigint as t, count(*) as n from f group by all),
grid as (select k.sequence, k.feature, unnest(range(50, 4001, 50)) as e from (select distinct sequence, feature from w) k)
select grid.sequence, grid.feature, grid.e - 49 as start, grid.e as "end", coalesce(c, 0) as c, coalesce(t, 0) as t, coalesce(n, 0) as n, round(coalesce(c * 1.0 / nullif(c + t, 0), 0), 6) as score
from grid left join w on grid.sequence = w.sequence and grid.feature = w.feature and grid.e = w.e""",
)
def fixed_windows_no_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = wi.fixed_windows(features(spark, sf_dir), 50, lengths=lengths(spark, sf_dir))
    return out.withColumn("score", F.round("score", 6))


@query(
    "W3_sliding_windows",
    f"""with {FEATURES}, x as (select *, unnest(range(greatest(0, ceil((start - 100) / 25.0))::bigint, floor(("end" - 1) / 25.0)::bigint + 1)) as k from f),
y as (select *, least("end", k * 25 + 100) - greatest(start, k * 25 + 1) + 1 as overlap from x)
select sequence, k * 25 + 1 as start, k * 25 + 100 as "end", count(*) as n, sum(overlap)::bigint as positions, round(sum(score * overlap) / sum(overlap), 6) as score from y group by sequence, k""",
)
def sliding_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    aggs = {"n": F.count("*"), "positions": F.sum("overlap"), "score": F.round(F.sum(F.col("score") * F.col("overlap")) / F.sum("overlap"), 6)}
    return wi.sliding_windows(features(spark, sf_dir), 100, 25, aggs)


def _scored(op_id: str, name: str, sql: str):
    @query(
        f"{op_id}_window_{name}",
        f"""with {FEATURES}, {ANNOTATION}, j as (select f.*, f."end" - f.start + 1 as length, a.id as locus, a."end" - a.start + 1 as win, least(f."end", a."end") - greatest(f.start, a.start) + 1 as overlap
  from f join a on f.sequence = a.sequence and f.start <= a."end" and f."end" >= a.start) select locus, {sql} from j group by locus""",
    )
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        j = overlap_join(features(spark, sf_dir), annotation(spark, sf_dir)).withColumn("length", F.col("end") - F.col("start") + 1)
        j = j.withColumn("window", F.col("r_end") - F.col("r_start") + 1)
        out = j.groupBy(F.col("r_id").alias("locus")).agg(*(v.alias(k) for k, v in wi.scoring(name).items()))
        digits = {"average": 10, "diluted": 8}.get(name, 6)
        return out.select(*(F.round(c, digits).alias(c) if k == "double" else F.col(c) for c, k in out.dtypes))

    return run


_scored("A1", "sum", "count(*) as n, round(sum(score), 6) as score")
_scored("A2", "meth", "count(*) as n, sum(c)::bigint as c, sum(t)::bigint as t, round(sum(c) * 1.0 / (sum(c) + sum(t)), 6) as score")
_scored("A3", "average", "count(*) as n, round(avg(score), 10) as score, round(coalesce(stddev_samp(score), 0), 10) as std, round(coalesce(var_samp(score), 0), 10) as var")
_scored("A6", "weighed", "count(*) as n, round(sum(score * overlap) / sum(overlap), 6) as score")
_scored("A6", "half_weighed", "count(*) as n, round(avg(score * overlap / length), 6) as score")
_scored("A4", "diluted", "count(*) as n, round(avg(score * overlap / length * overlap / win), 8) as score")
_scored("A5", "locus", "count(*) as n, list_aggregate(list_sort(list_distinct(list(id::varchar))), 'string_agg', ',') as score")


@query("W6_explode_windows", f"""with {FEATURES}, x as (select *, unnest(range((start - 1) // 10, ("end" - 1) // 10 + 1)) as k, ("end" - 1) // 10 - (start - 1) // 10 + 1 as m from f)
select sequence, k * 10 + 1 as start, k * 10 + 10 as "end", count(*) as n, round(sum(score / m), 6) as score from x group by sequence, k""")
def explode_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = wi.exploded(features(spark, sf_dir), 10, share_score=True)
    return out.groupBy("sequence", "start", "end").agg(F.count("*").alias("n"), F.round(F.sum("score"), 6).alias("score"))


@query("W6_explode_bases", f"""with {SHORT}, x as (select sequence, unnest(range(start, "end" + 1)) as p, c from g) select sequence, p as position, count(*) as n, sum(c)::bigint as c from x group by all""")
def explode_bases(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = wi.exploded(short_features(spark, sf_dir))
    return out.groupBy("sequence", F.col("start").cast("bigint").alias("position")).agg(F.count("*").alias("n"), F.sum("c").alias("c"))


@query(
    "W7_proximity",
    f"""with {FEATURES}, {ANNOTATION}, {LENGTHS}, w as (select sequence, k * 100 + 1 as start, k * 100 + 100 as "end" from n, (select unnest(range(0, 40)) as k)),
x as (select w.*, max(case when a.start is null then 0.0::double else greatest(0.0::double, 1 - 0.2::double * ceil(greatest(0, a.start - w."end", w.start - a."end") / 50.0)) end) as s from w left join a on w.sequence = a.sequence and a.start - 250 <= w."end" and a."end" + 250 >= w.start group by all)
select sequence, start, "end", round(coalesce(s, 0)::double, 6) as proximity from x""",
)
def proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = lengths(spark, sf_dir).select("sequence", F.explode(F.sequence(F.lit(0), F.lit(39))).alias("k")).select("sequence", (F.col("k") * 100 + 1).alias("start"), (F.col("k") * 100 + 100).alias("end"))
    return wi.proximity(w, annotation(spark, sf_dir)).withColumn("proximity", F.round("proximity", 6))


@query(
    "W8_rpkm_windows",
    f"""with {FEATURES} select sequence, (ceil(start / 500.0) * 500)::bigint as "end", count(*) as n, round(count(*) / 0.5 / ((select count(*) from f) / 1000000.0), 4) as rpkm from f group by 1, 2""",
)
def rpkm_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = features(spark, sf_dir)
    out = f.groupBy("sequence", wi.window_end(F.col("start"), 500).alias("end")).agg(F.count("*").alias("n"))
    return out.join(F.broadcast(f.agg(F.count("*").alias("_all")))).select("sequence", "end", "n", F.round(F.col("n") / 0.5 / (F.col("_all") / 1000000), 4).alias("rpkm"))


NEAR = f"""{ANNOTATION}, b as (select *, max("end") over (partition by sequence order by start, "end", id rows between unbounded preceding and 1 preceding) as prev,
  lead(start) over (partition by sequence order by start, "end", id) as nxt, case when strand = '-' then "end" else start end as anchor from a),
h as (select *, case when strand = '-' then coalesce(nxt <= "end", false) else coalesce(prev >= start, false) end as overlapped from b)"""


@query(
    "N18_neighborhood",
    f"""with {NEAR} select id, anchor, case when strand = '-' then greatest(anchor - 100, anchor - ("end" - start)) else greatest(anchor - 100, coalesce(prev + 1, anchor - 100)) end as low,
  case when strand = '-' then least(anchor + 100, coalesce(nxt - 1, anchor + 100)) else least(anchor + 100, anchor + ("end" - start)) end as high, strand = '-' as flipped, overlapped from h""",
)
def neighborhood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wi.neighborhood(annotation(spark, sf_dir), 100, 2).select("id", "anchor", "low", "high", "flipped", "overlapped")


ENDS = f"""{FEATURES}, {NEAR}, k as (select id, sequence, bin, case when strand = '-' then anchor - (bin + 1) * 20 + 1 else anchor + bin * 20 end as start from h, (select unnest(range(-5, 5)) as bin) where not overlapped),
q as (select k.id, k.bin, avg(f.score * (least(f."end", k.start + 19) - greatest(f.start, k.start) + 1) / (f."end" - f.start + 1)) as score, count(*) as n
  from k join f on f.sequence = k.sequence and f.start <= least(k.start + 19, 999999) and f."end" >= k.start group by all)"""


@query("W9_end_profile", f"with {ENDS} select id, bin, round(score, 6) as score, n from q")
def end_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wi.end_profile(features(spark, sf_dir), annotation(spark, sf_dir), 20, 100).select("id", "bin", F.round("score", 6).alias("score"), "n")


@query(
    "W10_profile_by_stop",
    f"""with {FEATURES}, {NEAR}, m as (select *, case when strand = '-' then greatest(anchor - 100, anchor - ("end" - start) // 2) else greatest(anchor - 100, coalesce(prev + 1, anchor - 100)) end as low,
  case when strand = '-' then least(anchor + 100, coalesce(nxt - 1, anchor + 100)) else least(anchor + 100, anchor + ("end" - start) // 2) end as high from h where not overlapped),
k as (select *, case when strand = '-' then anchor - (bin + 1) * 20 + 1 else anchor + bin * 20 end as s from m, (select unnest(range(-5, 5)) as bin)),
z as (select id, sequence, bin, greatest(s, low) as s, least(s + 19, high) as e from k where greatest(s, low) <= least(s + 19, high))
select bin, count(*) as n, round(avg(f.score * (least(f."end", z.e) - greatest(f.start, z.s) + 1) / (f."end" - f.start + 1)), 6) as score
from z join f on f.sequence = z.sequence and f.start <= z.e and f."end" >= z.s group by bin""",
)
def profile_by_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One profile over all loci, neighbours and half way inside as stops."""
    p = wi.end_profile(features(spark, sf_dir), annotation(spark, sf_dir), 20, 100, 6)
    return p.groupBy("bin").agg(F.sum("n").alias("n"), F.round(F.sum(F.col("score") * F.col("n")) / F.sum("n"), 6).alias("score"))


SHARE = 'f.score * (least(f."end", z.e) - greatest(f.start, z.s) + 1) / (f."end" - f.start + 1)'


@query(
    "W11_batch_profiles",
    f"""with {FEATURES}, {NEAR}, m as (select *, 'half' as cfg, case when strand = '-' then greatest(anchor - 100, anchor - ("end" - start) // 2) else greatest(anchor - 100, coalesce(prev + 1, anchor - 100)) end as low,
  case when strand = '-' then least(anchor + 100, coalesce(nxt - 1, anchor + 100)) else least(anchor + 100, anchor + ("end" - start) // 2) end as high, 20 as w from h where not overlapped
  union all select *, 'whole', anchor - 100, anchor + 100, 50 from h where not overlapped),
k as (select *, case when strand = '-' then anchor - (bin + 1) * w + 1 else anchor + bin * w end as s from m, (select unnest(range(-5, 5)) as bin) where bin between -(100 // w) and 100 // w - 1),
z as (select cfg, id, sequence, bin, greatest(s, low) as s, least(s + w - 1, high) as e from k where greatest(s, low) <= least(s + w - 1, high)),
q as (select cfg, z.id, bin, feature, avg({SHARE}) as score from z join f on f.sequence = z.sequence and f.start <= z.e and f."end" >= z.s group by all)
select cfg as configuration, feature as context, bin, count(*) as loci, round(avg(score), 6) as score from q group by all""",
)
def batch_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two configurations, of other widths and stops, by the rows' kind."""
    configurations = {"half": {"width": 20, "distance": 100, "stop": 6}, "whole": {"width": 50, "distance": 100}}
    p = wi.batch_profiles(features(spark, sf_dir), annotation(spark, sf_dir), configurations, "feature")
    return p.withColumn("score", F.round("score", 6))


@query(
    "W12_profile_summary",
    f"""with {ENDS}, r as (select bin, score, row_number() over (partition by bin order by score) - 1 as i, count(*) over (partition by bin) as m from q)
select bin, count(*) as n, round(avg(score), 6) as mean, round(coalesce(stddev_samp(score), 0), 6) as std, round(coalesce(var_samp(score), 0), 6) as var, round(coalesce(stddev_samp(score), 0) / sqrt(count(*)), 6) as ste,
  round(max(score) filter (i = floor(m * 0.25)), 6) as q25, round(max(score) filter (i = floor(m * 0.5)), 6) as q50, round(max(score) filter (i = floor(m * 0.75)), 6) as q75 from r group by bin""",
)
def profile_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = wi.profile_summary(wi.end_profile(features(spark, sf_dir), annotation(spark, sf_dir), 20, 100))
    return out.select("bin", "n", *(F.round(c, 6).alias(c) for c in ("mean", "std", "var", "ste", "q25", "q50", "q75")))


@query(
    "W13_bins_in_exons",
    f"""with {ENDS}, x as (select k.id, k.bin, k.sequence, k.start, k.start + 19 as e from k), e as (select sequence, start, "end" from a where feature = 'F'),
m as (select x.id, x.bin, max(least(e."end", x.e) - greatest(e.start, x.start) + 1) as overlap from x join e on e.sequence = x.sequence and e.start <= x.e and e."end" >= x.start group by all)
select q.id, q.bin, round(q.score, 6) as score from q join m on m.id = q.id and m.bin = q.bin where m.overlap >= 10""",
)
def bins_in_exons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins of which an exon covers at least half."""
    a = annotation(spark, sf_dir)
    near = wi.neighborhood(a, 100).where("not overlapped").select("id", "sequence", "anchor", "flipped", F.explode(F.sequence(F.lit(-5), F.lit(4))).alias("bin"))
    bins = near.withColumn("start", F.when(F.col("flipped"), F.col("anchor") - (F.col("bin") + 1) * 20 + 1).otherwise(F.col("anchor") + F.col("bin") * 20)).withColumn("end", F.col("start") + 19)
    kept = overlap_join(bins.select("id", "bin", "sequence", "start", "end"), a.where("feature = 'F'").select("sequence", "start", "end")).where("overlap >= 10").select("id", "bin").distinct()
    return wi.end_profile(features(spark, sf_dir), a, 20, 100).join(kept, ["id", "bin"]).select("id", "bin", F.round("score", 6).alias("score"))


VECTORS = """v as (select l_suppkey as id, date_diff('day', date '1992-01-01', l_shipdate::date) // 30 as position, sum(l_quantity) as value from lineitem group by all)"""


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("id"), F.floor(F.datediff("l_shipdate", F.lit("1992-01-01")) / 30).alias("position"), "l_quantity")
    return x.groupBy("id", "position").agg(F.sum("l_quantity").alias("value"))


@query(
    "W14_autocorrelation",
    f"""with {VECTORS}, d as (select id, row_number() over (partition by id order by position) as i, value - avg(value) over (partition by id) as d from v),
s as (select id, sum(d * d) as v from d group by id having sum(d * d) > 0), l as (select unnest(range(0, 11)) as lag),
p as (select x.id, lag, sum(x.d * y.d) as s from l, d x join d y on x.id = y.id and y.i = x.i + lag group by all)
select lag::int as lag, round(avg(p.s / s.v), 6) as acf, count(*) as n from p join s using (id) group by lag""",
)
def autocorrelation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.autocorrelation(_vectors(spark, sf_dir), 10).withColumn("acf", F.round("acf", 6))


ORDERED = """o as (select 'u' || user_id as sequence, event_id as start, event_id as "end", value as score, event_id as id from events)"""


def _ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.concat(F.lit("u"), "user_id").alias("sequence"), F.col("event_id").alias("start"), F.col("event_id").alias("end"), F.col("value").alias("score"), F.col("event_id").alias("id"))


@query(
    "N5_islands",
    f"""with {ORDERED}, r as (select *, row_number() over (partition by sequence order by start) as row from o), l as (select *, row - lag(row) over (partition by sequence order by start) - 1 as skipped from r where score >= 20),
i as (select *, sum(case when skipped <= 2 then 0 else 1 end) over (partition by sequence order by start rows unbounded preceding) as island from l)
select sequence, min(start) as start, max("end") as "end", count(*) as n, round(avg(score), 6) as score from i group by sequence, island""",
)
def islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.islands(_ordered(spark, sf_dir), 20, 2).withColumn("score", F.round("score", 6))


@query(
    "N6_collapse",
    f"""with {ORDERED}, l as (select *, lag("end") over w as e, lag(score) over w as s from o window w as (partition by sequence order by start)),
i as (select *, sum(case when start - e <= 200 and abs(score - s) <= 15 then 0 else 1 end) over (partition by sequence order by start rows unbounded preceding) as g from l)
select sequence, min(start) as start, max("end") as "end", count(*) as n, round(avg(score), 6) as score from i group by sequence, g""",
)
def collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.collapsed(_ordered(spark, sf_dir), 200, 15).withColumn("score", F.round("score", 6))


@query(
    "N7_merge_rows",
    f"""with {ORDERED}, l as (select *, lag("end") over (partition by sequence order by start) as e from o),
i as (select *, sum(case when start - e <= 60 then 0 else 1 end) over (partition by sequence order by start rows unbounded preceding) as g from l)
select sequence, min(start) as start, max("end") as "end", count(*) as n, round(sum(score), 4) as score from i group by sequence, g""",
)
def merge_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.merged_rows(_ordered(spark, sf_dir), 60).withColumn("score", F.round("score", 4))


@query(
    "N8_smooth",
    f"""with {ORDERED} select id, round(coalesce((lag(score, 2) over w + 2 * lag(score) over w + 3 * score + 2 * lead(score) over w + lead(score, 2) over w) / 9.0, 0), 6) as smoothed from o window w as (partition by sequence order by start)""",
)
def smooth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.smoothed(_ordered(spark, sf_dir), [1, 2, 3, 2, 1]).select("id", F.round("smoothed", 6).alias("smoothed"))


@query(
    "N9_quantile_normalization",
    """with x as (select event_type as file, event_id as id, value as score from events), r as (select *, rank() over (partition by file order by score) as rk, row_number() over (partition by file order by score) as rn from x),
m as (select rn, avg(score) as normalized from r group by rn) select file, id, round(normalized, 6) as normalized from r join m on r.rk = m.rn""",
)
def quantile_normalization(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "events").select(F.col("event_type").alias("file"), F.col("event_id").alias("id"), F.col("value").alias("score"))
    return an.quantile_normalized(x).select("file", "id", F.round("normalized", 6).alias("normalized"))


@query("N10_z_score", "select event_id as id, round((value - (select avg(value) from events)) / (select stddev_samp(value) from events), 6) as z from events")
def z_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("value").alias("score"))
    return an.z_scores(x).select("id", F.round("z", 6).alias("z"))


@query("N11_partitions", "select event_type as file, event_id as id, ntile(7) over (partition by event_type order by value, event_id)::int as part from events")
def partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "events").select(F.col("event_type").alias("file"), F.col("event_id").alias("id"), F.col("value").alias("score"))
    return an.partitions(x, 7, by="file", ties=("id",)).select("file", "id", "part")


STRANDED = f"""{FEATURES}, d as (select sequence, start, strand, sum(c)::bigint as c, sum(t)::bigint as t from f group by all)"""


@query("N12_strand_pairs", f"with {STRANDED} select p.sequence, p.start, p.c, p.t, m.c as c_minus, m.t as t_minus from d p join d m on p.sequence = m.sequence and m.start = p.start + 1 where p.strand = '+' and m.strand = '-'")
def strand_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = features(spark, sf_dir).groupBy("sequence", "start", "strand").agg(F.sum("c").alias("c"), F.sum("t").alias("t"))
    return an.strand_pairs(d)


@query(
    "N13_absolute_coordinates",
    f"""with {SHORT}, s as (select sequence, max("end") as span from g group by 1), o as (select sequence, coalesce(sum(span + 5000) over (order by sequence rows between unbounded preceding and 1 preceding), 0) as off from s)
select g.sequence, count(*) as n, min(start + off)::bigint as first, max(start + off)::bigint as last from g join o using (sequence) group by 1""",
)
def absolute_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.running_offsets(short_features(spark, sf_dir), 5000).groupBy("sequence").agg(F.count("*").alias("n"), F.min("absolute").alias("first"), F.max("absolute").alias("last"))


@query(
    "N14_introns",
    f"""with {SHORT}, r as (select *, max("end") over (partition by id order by start, "end" rows between unbounded preceding and 1 preceding) as reach from g)
select id as parent, reach + 1 as start, start - 1 as "end", count(*) as n from r where reach + 1 <= start - 1 group by all""",
)
def introns(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = an.introns(short_features(spark, sf_dir).withColumnRenamed("id", "parent"))
    return out.groupBy("parent", "start", "end").agg(F.count("*").alias("n"))


@query(
    "N15_exon_places",
    f"""with {ANNOTATION}, r as (select *, row_number() over (partition by sequence order by start, "end", id) as up, row_number() over (partition by sequence order by start desc, "end" desc, id desc) as down from a)
select id, case when up = 1 and down = 1 then 'only' when (up = 1 and strand = '+') or (down = 1 and strand = '-') then 'first' when (down = 1 and strand = '+') or (up = 1 and strand = '-') then 'last' else 'middle' end as place from r""",
)
def exon_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.exon_places(annotation(spark, sf_dir), "sequence").select("id", "place")


@query(
    "N16_pads",
    f"""with {ANNOTATION}, r as (select *, start - max("end") over (partition by sequence order by start, "end", id rows between unbounded preceding and 1 preceding) - 1 as l, lead(start) over (partition by sequence order by start, "end", id) - "end" - 1 as r from a)
select id, greatest(0, least(40, coalesce(floor(l / 2.0), 40)))::int as pad_left, greatest(0, least(40, coalesce(floor(r / 2.0), 40)))::int as pad_right from r""",
)
def pads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.pads(annotation(spark, sf_dir), 40).select("id", "pad_left", "pad_right")


@query(
    "N17_scaffold_offsets",
    f"""with {ANNOTATION}, r as (select *, coalesce(sum("end" - start + 1) over (partition by sequence order by start, "end", id rows between unbounded preceding and 1 preceding), 0) as done from a)
select id, (done + 1)::bigint as scaffold_start, (done + "end" - start + 1)::bigint as scaffold_end from r""",
)
def scaffold_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = an.cumulative_offsets(annotation(spark, sf_dir), "sequence", F.col("end") - F.col("start") + 1)
    return out.select("id", F.col("scaffold_start").cast("bigint").alias("scaffold_start"), F.col("scaffold_end").cast("bigint").alias("scaffold_end"))


@query(
    "A25_run_lengths",
    f"""with {POSITIONS}, d as (select distinct sequence, pos from p), l as (select *, pos - lag(pos) over (partition by sequence order by pos) as step from d),
i as (select *, sum(case when step <= 400 then 0 else 1 end) over (partition by sequence order by pos rows unbounded preceding) as g from l), z as (select sequence, g, count(*) as size from i group by all)
select sequence, size, count(*) as runs from z group by all""",
)
def run_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = positions(spark, sf_dir).select("sequence", F.col("pos").alias("start")).distinct()
    return an.run_lengths(d, 400)
