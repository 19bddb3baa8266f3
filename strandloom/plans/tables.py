"""Queries: filters, projections, outer alignment and set operations on feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandloom.functions import attributes as at
from strandloom.functions.intervals import same
from strandloom.operators import align as al
from strandloom.operators import rows as ro
from strandloom.plans.base import ANNOTATION, FEATURES, LENGTHS, annotation, features, lengths, table
from strandloom.plans.catalogue import query

SUMS = "count(*) as n, sum(start)::bigint as starts, sum(\"end\")::bigint as ends"


def _sums(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.sum("start").cast("bigint").alias("starts"), F.sum("end").cast("bigint").alias("ends"))


@query("P1_row_filter", f"""with {FEATURES} select sequence, {SUMS} from f where (score is null or score >= 0.02) and (score is null or score <= 0.08) and "end" - start >= 10 and "end" - start <= 40 and feature not like 'A%' group by 1""")
def row_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sums(ro.row_filter(features(spark, sf_dir), (0.02, 0.08), (10, 40), "^A", column="feature"), "sequence")


@query("P1_row_filter_include", f"with {FEATURES} select sequence, {SUMS} from f where feature like 'A%' group by 1")
def row_filter_include(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sums(ro.row_filter(features(spark, sf_dir), pattern="^A", include=True, column="feature"), "sequence")


@query("P2_by_list_keep", f"with {FEATURES} select sequence, {SUMS} from f where id in (select o_orderkey from orders where o_orderstatus = 'F') group by 1")
def by_list_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select("o_orderkey")
    return _sums(ro.by_list(features(spark, sf_dir), ids), "sequence")


@query("P2_by_list_delete", f"with {FEATURES} select sequence, {SUMS} from f where id not in (select o_orderkey from orders where o_orderstatus = 'F') group by 1")
def by_list_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select("o_orderkey")
    return _sums(ro.by_list(features(spark, sf_dir), ids, keep=False), "sequence")


@query("P4_count_range", f"with {FEATURES} select sequence, {SUMS} from f where c + t >= 10 and c + t <= 30 group by 1")
def count_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sums(ro.count_range(features(spark, sf_dir), {"nuclear": (10, 30), "chr": (-1, -1)}), "sequence")


@query(
    "P5_list_filter_with_missing",
    f"""with {ANNOTATION}, l as (select p_partkey as id, p_size as pos from part), k as (select a.id, a.score from a where score between 50000 and 400000)
select l.id, l.pos::bigint as pos, round(k.score, 2) as score, k.id is null as missing from l left join k on l.id = k.id""",
)
def list_filter_with_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: rows on a list within score bounds, in the list's order, and what the list names in vain."""
    rows = annotation(spark, sf_dir).where(F.col("score").between(50000, 400000)).select("id", "score")
    ids = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").cast("bigint").alias("pos"))
    return ids.join(rows, "id", "left").select("id", "pos", F.round("score", 2).alias("score"), F.col("score").isNull().alias("missing"))


@query("P6_repeats_counted", f"""with {FEATURES} select sequence, start, "end", strand, (count(*) - 1)::double as score from f group by all""")
def repeats_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ro.repeats_counted(features(spark, sf_dir))


@query("P9_extract_unique", f"with {FEATURES} select distinct sequence, feature from f")
def extract_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(spark, sf_dir).select("sequence", "feature").distinct().orderBy("sequence", "feature")


@query("P10_swap_score_with_n", f"with {FEATURES} select id, t::double as score, score as n, count(*) as rows from f group by all")
def swap_score_with_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = features(spark, sf_dir).withColumn("attribute_string", F.concat(F.lit("ID=x;n="), "t"))
    x = x.select("id", at.attribute(F.col("attribute_string"), "n").cast("double").alias("score"), F.col("score").alias("n"))
    return x.groupBy("id", "score", "n").agg(F.count("*").alias("rows"))


@query("P11_sum_counts", f"with {FEATURES} select sequence, c + t as frame, count(*) as n from f group by all")
def sum_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(spark, sf_dir).groupBy("sequence", (F.col("c") + F.col("t")).alias("frame")).agg(F.count("*").alias("n"))


@query("P12_score_per_base", f"""with {FEATURES} select sequence, round(sum(score / ("end" - start + 1)), 8) as score from f group by 1""")
def score_per_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(spark, sf_dir).groupBy("sequence").agg(F.round(F.sum(F.col("score") / (F.col("end") - F.col("start") + 1)), 8).alias("score"))


@query("P13_rename_feature", f"with {FEATURES} select feature || '_lineitem' as feature, count(*) as n from f group by 1")
def rename_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The name of the file (without extension) appended to the feature."""
    x = table(spark, sf_dir, "lineitem").select("l_returnflag", F.element_at(F.split(F.regexp_replace(F.input_file_name(), r"(/part-[^/]*|)$", ""), "/"), -1).alias("file"))
    name = F.concat_ws("_", "l_returnflag", F.regexp_replace("file", r"\.[^.]*$", ""))
    return x.groupBy(name.alias("feature")).agg(F.count("*").alias("n"))


@query("P14_strand_from_annotation", f"with {FEATURES}, {ANNOTATION} select coalesce(a.strand, '.') as strand, count(*) as n, sum(f.id)::bigint as ids from f left join a on f.id = a.id group by 1")
def strand_from_annotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = annotation(spark, sf_dir).select("id", F.col("strand").alias("_s"))
    return features(spark, sf_dir).join(a, "id", "left").groupBy(F.coalesce("_s", F.lit(".")).alias("strand")).agg(F.count("*").alias("n"), F.sum("id").alias("ids"))


@query("P15_offset", f"""with {FEATURES}, x as (select sequence, greatest(0, start + coalesce(o.off, 0)) as start, greatest(0, "end" + coalesce(o.off, 0)) as "end" from f left join (select 's' || s_suppkey as q, (s_suppkey * 10 - 1500)::int as off from supplier where s_suppkey % 2 = 0) o on o.q = f.sequence) select sequence, {SUMS} from x group by 1""")
def offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").where("s_suppkey % 2 = 0").select(F.concat(F.lit("s"), "s_suppkey").alias("sequence"), (F.col("s_suppkey") * 10 - 1500).cast("int").alias("offset"))
    return _sums(ro.offset(features(spark, sf_dir), s), "sequence")


@query("P15_flank", f"""with {FEATURES}, x as (select sequence, greatest(0, case when strand = '-' then start - 5 else start - 1200 end) as start, case when strand = '-' then "end" + 1200 else "end" + 5 end as "end" from f) select sequence, {SUMS} from x group by 1""")
def flank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sums(ro.flanked(features(spark, sf_dir), 1200, 5), "sequence")


@query("P16_slice", f"""with {FEATURES}, x as (select sequence, case when strand = '-' then "end" - 20 else start - 10 end as start, case when strand = '-' then "end" + 10 else start + 20 end as "end" from f) select sequence, {SUMS} from x group by 1""")
def slice_(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sums(ro.sliced(features(spark, sf_dir), -10, 20), "sequence")


@query(
    "P17_head_tail",
    f"""with {FEATURES}, x as (select sequence, 'head' as part, case when strand = '-' then greatest(start, "end" - 9) else start end as start, case when strand = '-' then "end" else least("end", start + 9) end as "end" from f
union all select sequence, 'tail', case when strand = '-' then start else start + 10 end, case when strand = '-' then "end" - 10 else "end" end from f) select sequence, part, {SUMS} from x where start <= "end" group by all""",
)
def head_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sums(ro.head_tail(features(spark, sf_dir), 10), "sequence", "part")


@query("P18_reverse_coordinates", f"""with {FEATURES}, x as (select sequence, 4000 - "end" + 1 as start, 4000 - start + 1 as "end" from f) select sequence, {SUMS} from x group by 1""")
def reverse_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sums(ro.reversed_rows(features(spark, sf_dir), lengths(spark, sf_dir)), "sequence")


@query(
    "P21_integrity",
    r"""with x as (select l_orderkey || chr(9) || case l_linenumber when 1 then 'a' || chr(9) || 'b' when 2 then 'é' || chr(9) || 'b' when 3 then 'a' || chr(9) || 'b' || chr(13) else 'a' end as v, l_linenumber as k from lineitem)
select case when k = 2 then 'not ASCII' when k = 3 then 'carriage return' else 'columns' end as problem, count(*) as n from x where k <> 1 group by 1""",
)
def integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    body = F.when(F.col("l_linenumber") == 1, "a\tb").when(F.col("l_linenumber") == 2, "é\tb").when(F.col("l_linenumber") == 3, "a\tb\r").otherwise("a")
    lines = table(spark, sf_dir, "lineitem").select(F.concat_ws("\t", F.col("l_orderkey").cast("string"), body).alias("value"))
    return ro.integrity(lines, 3).groupBy("problem").agg(F.count("*").alias("n"))


@query(
    "P24_stratified_counts",
    f"""with {FEATURES}, k as (select * from (values (5, 0.3), (10, 0.5), (20, 0.7)) v(cut, share)) select cut, share::double as share, count(*) as n from f, k where c >= cut and c * 1.0 / (c + t) >= share group by all""",
)
def stratified_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that pass each of a few pairs of cut-offs, which are columns of one aggregation, not a join."""
    cuts = [(5, 0.3), (10, 0.5), (20, 0.7)]
    share = F.col("c") / (F.col("c") + F.col("t"))
    one = features(spark, sf_dir).agg(*(F.count_if((F.col("c") >= c) & (share >= s)).alias(f"n{i}") for i, (c, s) in enumerate(cuts)))
    rows = F.explode(F.array(*(F.struct(F.lit(c).alias("cut"), F.lit(s).alias("share"), F.col(f"n{i}").alias("n")) for i, (c, s) in enumerate(cuts)))).alias("x")
    return one.select(rows).select("x.*")


BY_STATUS = f"{FEATURES}, m as (select source as file, sequence, start, sum(score) as score, sum(c)::bigint as c from f group by all)"


def _by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = features(spark, sf_dir)
    return f.groupBy(F.col("source").alias("file"), "sequence", "start").agg(F.sum("score").alias("score"), F.sum("c").alias("c"))


@query("P25_complete_in_all", f"with {BY_STATUS} select file, count(*) as n, round(sum(score), 4) as score from m where (sequence, start) in (select (sequence, start) from m group by sequence, start having count(distinct file) = 2) group by 1")
def complete_in_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ro.complete_in_all(_by_status(spark, sf_dir), "file", 2).groupBy("file").agg(F.count("*").alias("n"), F.round(F.sum("score"), 4).alias("score"))


@query("P26_all_present", "select p_partkey as id, round(coalesce(s, 0), 4) as score from part left join (select l_partkey, sum(l_tax) as s from lineitem where l_returnflag = 'R' group by 1) on l_partkey = p_partkey")
def all_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").groupBy(F.col("l_partkey").alias("id")).agg(F.sum("l_tax").alias("score"))
    return ro.all_present(s, table(spark, sf_dir, "part").select("p_partkey")).withColumn("score", F.round("score", 4))


@query(
    "P27_completed_sites",
    f"""with {FEATURES}, {LENGTHS}, d as (select sequence, start, sum(c)::bigint as c, sum(t)::bigint as t from f group by all), k as (select sequence, unnest(range(5, 4001, 5))::int as start from n)
select coalesce(d.sequence, k.sequence) as sequence, coalesce(d.start, k.start) as start, coalesce(c, 0) as c, coalesce(t, 0) as t from d full join k on d.sequence = k.sequence and d.start = k.start""",
)
def completed_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = features(spark, sf_dir).groupBy("sequence", "start").agg(F.sum("c").alias("c"), F.sum("t").alias("t"))
    sites = lengths(spark, sf_dir).select("sequence", F.explode(F.sequence(F.lit(5), F.lit(4000), F.lit(5))).alias("start"))
    return ro.completed_sites(d, sites)


@query("P29_same_rows", "select count(*) as pairs from (select lower(n_name) as k, count(*) as n from nation group by 1) a join (select upper(n_name) as k, count(*) as n from nation group by 1) b on lower(a.k) is not distinct from lower(b.k)")
def same_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    a, b = n.groupBy(F.lower("n_name").alias("k")).agg(F.count("*").alias("n")), n.groupBy(F.upper("n_name").alias("l")).agg(F.count("*").alias("m"))
    return a.join(b, same(F.col("k"), F.col("l"))).agg(F.count("*").alias("pairs"))


def _two(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    f = features(spark, sf_dir)
    return f.where("source = 'F'"), f.where("source = 'O'")


TWO = f"""{FEATURES}, x as (select sequence, start, sum(score) as a from f where source = 'F' group by all), y as (select sequence, start, sum(score) as b from f where source = 'O' group by all),
z as (select coalesce(x.sequence, y.sequence) as sequence, coalesce(x.start, y.start) as start, a, b from x full join y on x.sequence = y.sequence and x.start = y.start)"""


@query("J7_arithmetic", f"with {TWO} select sequence, start, round(coalesce(a, 0) * 2 + coalesce(b, 0) * coalesce(b, 0), 6) as score from z")
def arithmetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return al.arithmetic(*_two(spark, sf_dir), "a * 2 + b * b").withColumn("score", F.round("score", 6))


@query("J7_arithmetic_methyl", f"with {TWO} select sequence, start, round(coalesce(coalesce(a, 0) / nullif(coalesce(a, 0) + coalesce(b, 0), 0), 0), 6) as score from z")
def arithmetic_methyl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return al.arithmetic(*_two(spark, sf_dir), "methyl(a, b)").withColumn("score", F.round("score", 6))


@query("J8_subtract", f"with {TWO} select sequence, start, round(coalesce(a, 0) - coalesce(b, 0), 6) + 0.0::double as score from z")
def subtract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return al.subtracted(*_two(spark, sf_dir)).withColumn("score", F.round("score", 6) + F.lit(0.0))


@query("J9_pairwise_statistic", f"with {TWO} select sequence, count(*) as n, round(sum(abs(a - b)), 6) as distance from z where a is not null and b is not null group by 1")
def pairwise_statistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that both tables have, compared on equal coordinates."""
    out = al.arithmetic(*_two(spark, sf_dir), "abs(a - b)", zero=False)
    return out.groupBy("sequence").agg(F.count("*").alias("n"), F.round(F.sum("score"), 6).alias("distance"))


@query("J10_log2_ratio", f"with {TWO} select sequence, start, round(log2(a / b), 6) + 0.0::double as score from z where a > 0 and b > 0")
def log2_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return al.compared(*_two(spark, sf_dir)).where(~F.isnan("score")).withColumn("score", F.round("score", 6) + F.lit(0.0))


def _three(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    f = features(spark, sf_dir)
    out = f.groupBy("feature", "sequence", "start").agg(F.sum("c").alias("c"), F.max("t").alias("t"))
    return {n.lower(): out.where(F.col("feature") == n) for n in ("A", "N", "R")}


@query(
    "J11_mashup",
    f"""with {FEATURES}, m as (select feature, sequence, start, sum(c)::bigint as c, max(t) as t from f group by all)
select sequence, start, max(c) filter (feature = 'A') as a_c, max(t) filter (feature = 'A') as a_t, max(c) filter (feature = 'N') as n_c, max(t) filter (feature = 'N') as n_t, max(c) filter (feature = 'R') as r_c, max(t) filter (feature = 'R') as r_t from m group by all""",
)
def mashup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return al.mashup(_three(spark, sf_dir), ["sequence", "start"], ["c", "t"])


@query(
    "J12_feature_mashup",
    f"""with {FEATURES}, m as (select feature, lower(sequence) as sequence, start, round(sum(c) * 1.0 / (sum(c) + sum(t)), 6) as methyl, (sum(c) + sum(t))::bigint as ct from f group by all)
select sequence, start, max(methyl) filter (feature = 'A') as a_methyl, max(ct) filter (feature = 'A') as a_ct, max(methyl) filter (feature = 'N') as n_methyl, max(ct) filter (feature = 'N') as n_ct from m where feature in ('A', 'N') group by all""",
)
def feature_mashup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With computed columns c + t and c / (c + t)."""
    f = features(spark, sf_dir).groupBy("feature", F.lower("sequence").alias("sequence"), "start").agg(F.sum("c").alias("c"), F.sum("t").alias("t"))
    f = f.withColumn("ct", F.col("c") + F.col("t")).withColumn("methyl", F.round(F.col("c") / F.col("ct"), 6))
    return al.mashup({n.lower(): f.where(F.col("feature") == n) for n in ("A", "N")}, ["sequence", "start"], ["methyl", "ct"])


@query(
    "J13_frame_alignment",
    f"""with {FEATURES} select sequence, start, "end", max(id) filter (source = 'F') as f_id, max(id) filter (source = 'O') as o_id from f group by all""",
)
def frame_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _two(spark, sf_dir)
    return al.mashup({"f": a, "o": b}, ["sequence", "start", "end"], ["id"])


@query("J14_union_preferring_left", f"with {FEATURES} select source, count(*) as n from f where source = 'F' or id not in (select id from f where source = 'F') group by 1")
def union_preferring_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return al.union_preferring_left(*_two(spark, sf_dir), "id").groupBy("source").agg(F.count("*").alias("n"))


@query("J22_select_aggregate", f"""with {FEATURES} select id, count(*) as n, min(start) as start, max("end") as "end", list_aggregate(list_sort(list(t)), 'string_agg', ',') as parts from f group by id""")
def select_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(spark, sf_dir).groupBy("id").agg(F.count("*").alias("n"), F.min("start").alias("start"), F.max("end").alias("end"), F.array_join(F.array_sort(F.collect_list("t")), ",").alias("parts"))


@query("J23_list_combinations", "with x as (select l_partkey, list_aggregate(list_sort(list_distinct(list(l_returnflag))), 'string_agg', ',') as lists from lineitem group by 1) select lists, count(*) as n from x group by 1")
def list_combinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return al.list_combinations(table(spark, sf_dir, "lineitem"), "l_partkey", "l_returnflag")


@query(
    "J24_gene_table",
    """select p_partkey as id, round(coalesce(sum(l_tax) filter (l_returnflag = 'A'), 0), 4) as a, round(coalesce(sum(l_tax) filter (l_returnflag = 'N'), 0), 4) as n, round(coalesce(sum(l_tax) filter (l_returnflag = 'R'), 0), 4) as r
from part left join lineitem on p_partkey = l_partkey group by 1""",
)
def gene_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All loci with the sum of each file's scores, 0 for none."""
    sums = table(spark, sf_dir, "lineitem").groupBy("l_partkey").pivot("l_returnflag", ["A", "N", "R"]).agg(F.sum("l_tax"))
    out = table(spark, sf_dir, "part").select("p_partkey").distinct().join(sums, F.col("p_partkey") == F.col("l_partkey"), "left").fillna(0.0)
    return out.select(F.col("p_partkey").alias("id"), *(F.round(c, 4).alias(c.lower()) for c in ("A", "N", "R")))


@query("J25_combined_profiles", f"with {FEATURES} select start // 100 as bin, round(avg(score) filter (source = 'F'), 6) as f, round(avg(score) filter (source = 'O'), 6) as o from f group by 1")
def combined_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = features(spark, sf_dir).withColumn("bin", F.floor(F.col("start") / 100))
    a, b = (f.where(F.col("source") == s).groupBy("bin").agg(F.round(F.avg("score"), 6).alias(s.lower())) for s in ("F", "O"))
    return a.join(b, "bin", "full")


@query("T1_symmetric_difference", f"""with {FEATURES}, k as (select distinct source as file, sequence, start, "end" from f) select sequence, start, "end", max(file) as file from k group by all having count(*) = 1""".replace("group by all having", 'group by sequence, start, "end" having'))
def symmetric_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _two(spark, sf_dir)
    return al.symmetric_difference({"F": a, "O": b}, ["sequence", "start", "end"])


@query("T2_intersection", f"with {FEATURES} select sequence, start from f where source = 'F' intersect select sequence, start from f where source = 'O'")
def intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _two(spark, sf_dir)
    return a.select("sequence", "start").intersect(b.select("sequence", "start"))


@query("T3_union", f"with {FEATURES}, {ANNOTATION} select sequence, count(*) as n from (select sequence, start, \"end\" from f union all select sequence, start, \"end\" from a) group by 1")
def union(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ("sequence", "start", "end")
    return features(spark, sf_dir).select(*cols).unionByName(annotation(spark, sf_dir).select(*cols)).groupBy("sequence").agg(F.count("*").alias("n"))


@query("T4_except", f"with {FEATURES} select sequence, start from f where source = 'F' except select sequence, start from f where source = 'O'")
def except_(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _two(spark, sf_dir)
    return a.select("sequence", "start").subtract(b.select("sequence", "start"))


@query("T5_tables_equal", "select a.p_partkey as id, a.p_name is not distinct from b.p_name and a.p_size is not distinct from b.p_size as equal from part a full join (select p_partkey, p_name, case when p_partkey % 3 = 0 then p_size + 1 else p_size end as p_size from part) b using (p_partkey)")
def tables_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), "p_name", "p_size")
    return al.tables_equal(a, a.withColumn("p_size", F.when(F.col("id") % 3 == 0, F.col("p_size") + 1).otherwise(F.col("p_size"))), "id")


@query("T6_unmashup", f"with {FEATURES}, m as (select feature, sequence, start, sum(c)::bigint as c, max(t)::bigint as t from f where feature in ('A', 'N', 'R') group by all) select lower(feature) || '_c' as variable, count(*) as n, sum(c)::bigint as value from m group by 1 union all select lower(feature) || '_t', count(*), sum(t)::bigint from m group by 1")
def unmashup(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = mashup(spark, sf_dir)
    wide = wide.select("sequence", "start", *(F.col(c).cast("bigint").alias(c) for c in wide.columns[2:]))
    return al.unmashed(wide, ["sequence", "start"]).groupBy("variable").agg(F.count("*").alias("n"), F.sum("value").alias("value"))


@query("O1_sorted", f"with {FEATURES}, r as (select sequence, start, row_number() over (order by sequence, start) as place from f) select sequence, start, min(place) as place from r group by all")
def sorted_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1, O3: a global sort by several keys; the first place of each key comes from a range sort's partitions."""
    counts = features(spark, sf_dir).groupBy("sequence", "start").agg(F.count("*").alias("n"))
    by = counts.groupBy("sequence").agg(F.sum("n").alias("all"))
    before = F.coalesce(F.sum("all").over(Window.orderBy("sequence").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row for each sequence
    own = F.coalesce(F.sum("n").over(Window.partitionBy("sequence").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = counts.join(by.withColumn("before", before).drop("all"), "sequence").select("sequence", "start", (F.col("before") + own + 1).alias("place"))
    return out.orderBy("sequence", "start")


@query("O2_is_sorted", f"with p as (select user_id, event_id, ts, lag(ts) over (partition by user_id order by event_id) as before from events) select user_id, coalesce(bool_and(ts >= before), true) as is_sorted from p group by 1")
def is_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "events").withColumn("before", F.lag("ts").over(Window.partitionBy("user_id").orderBy("event_id")))
    return x.groupBy("user_id").agg(F.coalesce(F.bool_and(F.col("ts") >= F.col("before")), F.lit(True)).alias("is_sorted"))


@query("O5_top_k", "select l_partkey, count(*) as n from lineitem group by 1 order by n desc, l_partkey limit 25")
def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "l_partkey").limit(25)


@query("O6_random_rows", "select o_orderkey from orders order by md5('0:' || o_orderkey), o_orderkey limit 100")
def random_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sampling operator: 100 rows, the same each time."""
    return ro.random_rows(table(spark, sf_dir, "orders").select("o_orderkey"), 100, F.col("o_orderkey"))


@query(
    "O7_density_histogram",
    "with m as (select min(value) as lo, max(value) as hi from events), b as (select floor((value - lo) / (hi - lo) * 50)::int as bucket from events, m where value < hi) select bucket, count(*) as n, round(count(*) / (select (hi - lo) / 50 from m) / (select count(*) from events), 8) as density from b group by 1",
)
def density_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """50 buckets as a density; the largest value itself is left out."""
    x = table(spark, sf_dir, "events").select("value")
    m = x.agg(F.min("value").alias("lo"), F.max("value").alias("hi"), F.count("*").alias("all"))
    b = x.join(F.broadcast(m)).where("value < hi").withColumn("bucket", F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * 50).cast("int"))
    return b.groupBy("bucket", "lo", "hi", "all").agg(F.count("*").alias("n")).select("bucket", "n", F.round(F.col("n") / ((F.col("hi") - F.col("lo")) / 50) / F.col("all"), 8).alias("density"))
