"""Queries: aggregations and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandloom.functions import sequence as sq
from strandloom.functions.intervals import fraction, overlap_length
from strandloom.operators import reads as rd
from strandloom.operators import stats as st
from strandloom.plans.base import ANNOTATION, FEATURES, LENGTHS, SEQUENCES, annotation, features, lengths, sequences, table
from strandloom.plans.catalogue import query


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*(F.round(c, digits).alias(c) if k == "double" else F.col(c) for c, k in df.dtypes))


@query("A1_sum_score", f"with {FEATURES} select sequence, feature, count(*) as n, round(sum(score), 6) as score from f group by all")
def sum_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(spark, sf_dir).groupBy("sequence", "feature").agg(F.count("*").alias("n"), F.round(F.sum("score"), 6).alias("score"))


@query("A3_mean_score", f"with {FEATURES} select sequence, round(avg(score), 8) as mean, round(stddev_samp(score), 8) as std, round(var_samp(score), 8) as var from f group by 1")
def mean_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(spark, sf_dir).groupBy("sequence").agg(F.round(F.avg("score"), 8).alias("mean"), F.round(F.stddev_samp("score"), 8).alias("std"), F.round(F.var_samp("score"), 8).alias("var"))


@query("A7_exon_count", f"""with {FEATURES} select id, min(start) as start, max("end") as "end", count(*) as exons from f group by id""")
def exon_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(spark, sf_dir).groupBy("id").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("exons"))


@query(
    "A8_base_composition",
    f"""with {SEQUENCES}, w as (select seq_id, unnest(range(0, greatest(1, ceil(length / 500.0))::bigint)) as k, sequence from s), x as (select seq_id, k, substr(sequence, k * 500 + 1, 500) as b from w)
select seq_id, k::int as k, len(b) - len(replace(b, 'A', '')) as a, len(b) - len(replace(b, 'C', '')) as c, len(b) - len(replace(b, 'G', '')) as g, len(b) - len(replace(b, 'T', '')) as t from x""",
)
def base_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = sequences(spark, sf_dir).select("seq_id", F.posexplode_outer(F.regexp_extract_all("sequence", F.lit("(?s).{1,500}"), 0)).alias("k", "b"))
    w = w.select("seq_id", F.coalesce("k", F.lit(0)).alias("k"), F.coalesce("b", F.lit("")).alias("b"))
    return w.select("seq_id", "k", *(rd.matched_letters(F.col("b"), x).cast("bigint").alias(x.lower()) for x in "ACGT"))


KMERS = f"{SEQUENCES}, k as (select substr(sequence, i, 2) as word from (select sequence, unnest(range(1, length)) as i from s where length >= 2)), c as (select word, count(*) as n from k group by 1)"


@query("A9_kmer_counts", f"with {KMERS} select word, n from c")
def kmer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rd.kmers(sequences(spark, sf_dir), 2)


@query("A9_observed_expected", f"with {KMERS}, o as (select x as letter, count(*) * 1.0 / sum(count(*)) over () as p from (select unnest(string_split(sequence, '')) as x from s where length > 0) group by 1) select word, n, round(n * 1.0 / (select sum(n) from c) / (x.p * y.p), 6) as ratio from c join o x on x.letter = substr(word, 1, 1) join o y on y.letter = substr(word, 2, 1)")
def observed_expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rd.observed_expected(sequences(spark, sf_dir), 2).withColumn("ratio", F.round("ratio", 6))


@query("A10_composition_difference", f"with {SEQUENCES}, k as (select seq_id % 2 as half, substr(sequence, i, 3) as word from (select seq_id, sequence, unnest(range(1, length - 1)) as i from s where length >= 3)) select word, count(*) as both, count(*) filter (half = 0) as part, count(*) filter (half = 1) as rest from k group by 1")
def composition_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: counts of all less those of a part, which leaves the rest's."""
    s = sequences(spark, sf_dir)
    both, part = rd.kmers(s, 3).withColumnRenamed("n", "both"), rd.kmers(s.where("seq_id % 2 = 0"), 3).withColumnRenamed("n", "part")
    return both.join(part, "word", "left").fillna(0).withColumn("rest", F.col("both") - F.col("part"))


@query("A11_motif_counts", f"with {SEQUENCES} select seq_id, len(regexp_extract_all(sequence, 'A[CG]T'))::int as n from s")
def motif_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences(spark, sf_dir).select("seq_id", F.regexp_count("sequence", F.lit("A[CG]T")).alias("n"))


@query("A12_exact_matches", f"with {SEQUENCES}, x as (select seq_id, sequence, unnest(range(1, greatest(length - 2, 1))) as i from s) select seq_id, i::int as start, (i + 3)::int as \"end\", case when substr(sequence, i, 4) = 'GATC' then '+' else '-' end as strand from x where substr(sequence, i, 4) in ('GATC') union all select seq_id, i::int, (i + 3)::int, '-' from x where substr(sequence, i, 4) = 'GATC'")
def exact_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rd.match_positions(sequences(spark, sf_dir), "GATC")


@query("A13_adapters", f"with {SEQUENCES}, k as (select seq_id, substr(sequence, i, 6) as word from (select seq_id, sequence, unnest(range(1, length - 4)) as i from s where length >= 6)), e as (select seq_id, word, count(*) as n from k group by all) select word, sum(n)::bigint as n, count(*) as reads from e group by 1 order by reads desc, n desc, word limit 20")
def adapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rd.adapters(sequences(spark, sf_dir), 6, 20)


ALIGNED = "h as (select l_partkey as read_id, count(*) as hits, min(l_linenumber) as mismatches, sum(l_quantity)::bigint as bases from lineitem group by 1)"


def _aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("read_id"))
    return x.agg(F.count("*").alias("hits"), F.min("l_linenumber").alias("mismatches"), F.sum("l_quantity").cast("bigint").alias("bases"))


@query("A14_alignment_statistics", f"with {ALIGNED} select case when hits is null then 'NM' when hits = 1 then 'U' || least(mismatches, 2) when hits <= 25 then 'R' else 'RT' end as kind, count(*) as n from part left join h on p_partkey = read_id group by 1 union all select 'ALL', count(*) from part")
def alignment_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "part").join(_aligned(spark, sf_dir), F.col("p_partkey") == F.col("read_id"), "left")
    kind = F.when(F.col("hits").isNull(), "NM").when(F.col("hits") == 1, F.concat(F.lit("U"), F.least("mismatches", F.lit(2)))).when(F.col("hits") <= 25, "R").otherwise("RT")
    by = x.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))
    return by.unionByName(x.agg(F.count("*").alias("n")).select(F.lit("ALL").alias("kind"), "n"))


@query("A15_sam_statistics", f"with {ALIGNED} select count(*) as reads, count(*) filter (hits >= 1) as mapped, count(*) filter (hits > 30) as multiple, sum(bases)::bigint as bases from h")
def sam_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _aligned(spark, sf_dir).agg(F.count("*").alias("reads"), F.count_if(F.col("hits") >= 1).alias("mapped"), F.count_if(F.col("hits") > 30).alias("multiple"), F.sum("bases").alias("bases"))


@query("A16_reads_per_scaffold", f"with {FEATURES}, {LENGTHS} select n.sequence, n.length, count(f.id) as reads, coalesce(sum(\"end\" - start + 1), 0)::bigint as bases from n left join f on n.sequence = f.sequence and f.strand = '+' group by all")
def reads_per_scaffold(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = features(spark, sf_dir).where("strand = '+'").groupBy("sequence").agg(F.count("*").alias("reads"), F.sum(F.col("end") - F.col("start") + 1).alias("bases"))
    return lengths(spark, sf_dir).join(f, "sequence", "left").fillna(0, ["reads", "bases"])


@query("A17_ratio_table", f"with {FEATURES} select coalesce(sequence, 'all') as sequence, coalesce(t, -1) as mismatches, count(*) filter (source = 'F') as a, count(*) filter (source = 'O') as b, round(count(*) filter (source = 'F') * 1.0 / nullif(count(*) filter (source = 'O'), 0), 6) as ratio from f group by rollup (sequence, t)")
def ratio_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources' counts by sequence and mismatches with subtotals; the ratio is null over nothing."""
    a, b = F.count_if(F.col("source") == "F"), F.count_if(F.col("source") == "O")
    out = features(spark, sf_dir).rollup("sequence", "t").agg(a.alias("a"), b.alias("b"))
    return out.select(F.coalesce("sequence", F.lit("all")).alias("sequence"), F.coalesce("t", F.lit(-1)).alias("mismatches"), "a", "b", F.round(F.try_divide("a", "b"), 6).alias("ratio"))


@query("A18_summary", f"""with {FEATURES}, x as (select *, "end" - start + 1 as l from f) select count(*) as n, round(avg(l), 6) as mean, round(stddev_samp(l), 6) as sd, min(l) as min, median(l) as median, max(l) as max, count(distinct sequence) as sequences, count(distinct feature) as features from x""")
def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.summary(features(spark, sf_dir)).withColumn("mean", F.round("mean", 6)).withColumn("sd", F.round("sd", 6))


CLASSED = f"""{FEATURES}, g as (select *, case when regexp_matches(sequence, '[0-9]') and id % 10 < 7 then 'nuclear' when id % 10 = 7 then 'chr' when id % 10 = 8 then 'mit' else 'unknown' end as class from f),
r as (select feature as context, class, count(*) as sites, sum(c)::bigint as c, sum(t)::bigint as t from g group by all)"""


@query(
    "A19_methylation_stats",
    f"""with {CLASSED}, z as (select * from r union all select context, 'total', sum(sites)::bigint, sum(c)::bigint, sum(t)::bigint from r where class <> 'unknown' group by 1
union all select 'total', 'total', sum(sites)::bigint, sum(c)::bigint, sum(t)::bigint from r where class <> 'unknown') select *, round(c * 1.0 / (c + t), 6) as methylation from z""",
)
def methylation_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    f, k = features(spark, sf_dir), F.col("id") % 10
    f = f.withColumn("sequence", F.when(k < 7, F.col("sequence")).when(k == 7, "chrC").when(k == 8, "chrM").otherwise("other"))
    return st.methylation_stats(f).withColumn("methylation", F.round("methylation", 6))


@query(
    "A19_percentiles",
    f"""with {FEATURES}, h as (select feature, c + t as v, count(*) as k from f group by all), r as (select *, sum(k) over (partition by feature order by v) as run, sum(k) over (partition by feature) as tot from h)
select feature, min(v) filter (run > 0.05 * tot) as p5, min(v) filter (run > 0.25 * tot) as p25, min(v) filter (run > 0.5 * tot) as p50, min(v) filter (run > 0.75 * tot) as p75, min(v) filter (run > 0.95 * tot) as p95 from r group by 1""",
)
def percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = features(spark, sf_dir).withColumn("v", F.col("c") + F.col("t")).withColumn("one", F.lit(1))
    return st.histogram_percentiles(x, ["feature"], "v", "one", [0.05, 0.25, 0.5, 0.75, 0.95])


@query("A20_histogram_summary", f"with {FEATURES} select feature, count(*) as n, round(avg(c + t), 6) as mean, round(stddev_pop(c + t), 6) as std from f group by 1")
def histogram_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = features(spark, sf_dir).groupBy("feature", (F.col("c") + F.col("t")).alias("v")).agg(F.count("*").alias("k"))
    return _rounded(st.histogram_summary(h, ["feature"], "v", "k"))


@query("A21_coverage_mean_median", f"with {FEATURES}, r as (select source, c + t as v, row_number() over (partition by source order by c + t) - 1 as i, count(*) over (partition by source) as n from f) select source, round(avg(v), 6) as mean, max(v) filter (i = n // 2) as median from r group by 1")
def coverage_mean_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The median is element int(n/2) of the sorted values, the first value whose running count exceeds half."""
    x = features(spark, sf_dir).withColumn("v", F.col("c") + F.col("t")).withColumn("one", F.lit(1))
    m = st.histogram_percentiles(x, ["source"], "v", "one", [0.5]).withColumnRenamed("p50", "median")
    return x.groupBy("source").agg(F.round(F.avg("v"), 6).alias("mean")).join(m, "source")


@query(
    "A22_coverage_histogram",
    f"with {FEATURES}, d as (select sequence, start, sum(c + t)::bigint as depth from f group by all), n as (select count(*) * 4000 as sites from supplier) select depth, count(*) as n from d group by 1 union all select 0, (select sites from n) - count(*) from d",
)
def coverage_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites by depth; those without a count are all sites less the counted ones."""
    d = features(spark, sf_dir).groupBy("sequence", "start").agg(F.sum(F.col("c") + F.col("t")).alias("depth"))
    h = d.groupBy("depth").agg(F.count("*").alias("n"))
    sites = lengths(spark, sf_dir).agg(F.sum("length").alias("all"))
    rest = h.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("seen")).join(F.broadcast(sites)).select(F.lit(0).cast("bigint").alias("depth"), (F.col("all") - F.col("seen")).alias("n"))
    return h.unionByName(rest)


@query("A23_category_percent", "select event_type, count(*) as n, round(count(*) * 100.0 / (select count(*) from events), 6) as percent from events group by 1")
def category_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    return n.withColumn("percent", F.round(F.col("n") * 100 / F.sum("n").over(Window.partitionBy()), 6))  # a row for each category


SITES = f"""{SEQUENCES}, i as (select seq_id, sequence, unnest(range(1, length + 1)) as pos from s), b as (select *, substr(sequence, pos, 1) as base from i),
y as (select seq_id, pos::int as pos, '+' as strand, substr(sequence, pos, 3) as tri from b where base = 'C' union all
  select seq_id, pos::int, '-', reverse(translate(substr(sequence, greatest(pos - 2, 1), least(pos, 3)), 'ACGT', 'TGCA')) from b where base = 'G'),
z as (select *, case when tri like 'CG%' then 'CG' when regexp_matches(tri, '^C[ACT]G') then 'CHG' else 'CHH' end as context from y)"""


@query("A24_context_counts", f"with {SITES} select context, strand, count(*) as n from z group by all")
def context_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rd.cytosines(sequences(spark, sf_dir)).groupBy("context", "strand").agg(F.count("*").alias("n"))


@query(
    "A26_base_entropy",
    f"with {SEQUENCES}, x as (select i, b from (select unnest(l) as b, generate_subscripts(l, 1) as i from (select string_split(sequence, '') as l from s)) where b <> ''), n as (select i::bigint as i, count(*) filter (b = 'A') as a, count(*) filter (b = 'C') as c, count(*) filter (b = 'G') as g, count(*) filter (b = 'T') as t from x group by 1) select i, a, c, g, t, round(-((a + 1) / (a + c + g + t + 4.0) * log2((a + 1) / (a + c + g + t + 4.0)) + (c + 1) / (a + c + g + t + 4.0) * log2((c + 1) / (a + c + g + t + 4.0)) + (g + 1) / (a + c + g + t + 4.0) * log2((g + 1) / (a + c + g + t + 4.0)) + (t + 1) / (a + c + g + t + 4.0) * log2((t + 1) / (a + c + g + t + 4.0))), 6) as entropy from n",
)
def base_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of bases at a position of all sequences, and their entropy, up to the longest sequence's end."""
    x = rd.pieces(sequences(spark, sf_dir)).select("offset", F.posexplode(F.split("piece", "")).alias("j", "b")).where("b <> ''")
    n = x.groupBy((F.col("offset") + F.col("j") + 1).alias("i")).agg(*(F.count_if(F.col("b") == y).alias(y.lower()) for y in "ACGT"))
    return n.withColumn("entropy", F.round(st.entropy([F.col(y) for y in "acgt"]), 6))


@query("A27_robust_spread", "with x as (select l_suppkey as k, l_quantity as v from lineitem), m as (select k, median(v) as median from x group by 1) select x.k, m.median, round(median(abs(v - m.median)) * 1.4826, 6) as mad, count(*) as n from x join m on x.k = m.k group by all")
def robust_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("k"), F.col("l_quantity").alias("v"))
    return st.robust_spread(x, ["k"], "v").withColumn("mad", F.round("mad", 6))


@query("A28_partition_means", f"with {FEATURES}, l as (select p_partkey, p_size // 10 as list from part) select list, count(*) as n, round(avg(score), 8) as score, round(sum(c) * 1.0 / (sum(c) + sum(t)), 8) as methylation from f join l on part = p_partkey group by 1")
def partition_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = table(spark, sf_dir, "part").select("p_partkey", F.floor(F.col("p_size") / 10).alias("list"))
    j = features(spark, sf_dir).join(lists, F.col("part") == F.col("p_partkey"))
    return j.groupBy("list").agg(F.count("*").alias("n"), F.round(F.avg("score"), 8).alias("score"), F.round(F.sum("c") / (F.sum("c") + F.sum("t")), 8).alias("methylation"))


@query("A29_weighted_vectors", f"with {FEATURES}, v as (select feature, c as w, string_split(t || ',' || c || ',' || start, ',') as x from f), e as (select feature, w, generate_subscripts(x, 1) as i, unnest(x)::double as y from v) select feature, i::int as i, round(sum(w * y) / sum(w), 6) as mean from e group by all")
def weighted_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comma lists averaged by place with weights."""
    v = features(spark, sf_dir).select("feature", F.col("c").alias("w"), F.posexplode(F.split(F.concat_ws(",", "t", "c", "start"), ",")).alias("i", "y"))
    return v.groupBy("feature", (F.col("i") + 1).alias("i")).agg(F.round(F.sum(F.col("w") * F.col("y").cast("double")) / F.sum("w"), 6).alias("mean"))


@query("A31_introns_from_counts", f"""with {FEATURES}, {ANNOTATION}, e as (select id, sum(c)::bigint as exon from f group by 1) select a.id, (a."end" - a.start + 1)::bigint as gene, coalesce(exon, 0) as exon, (a."end" - a.start + 1 - coalesce(exon, 0))::bigint as intron from a left join e using (id)""")
def introns_from_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    exon = features(spark, sf_dir).groupBy("id").agg(F.sum("c").alias("exon"))
    gene = annotation(spark, sf_dir).select("id", (F.col("end") - F.col("start") + 1).cast("bigint").alias("gene"))
    return gene.join(exon, "id", "left").fillna(0, ["exon"]).withColumn("intron", F.col("gene") - F.col("exon"))


@query("A32_array_aggregate", "select n_regionkey, list_aggregate(list_sort(list(n_name)), 'string_agg', '|') as names, count(*) as n from nation group by 1")
def array_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.array_join(F.array_sort(F.collect_list("n_name")), "|").alias("names"), F.count("*").alias("n"))


@query("A33_running_mean", "select event_id, round(avg(value) over (partition by user_id order by event_id rows unbounded preceding), 9) as mean from events")
def running_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("event_id").rowsBetween(Window.unboundedPreceding, 0)
    return table(spark, sf_dir, "events").select("event_id", F.round(F.avg("value").over(w), 9).alias("mean"))


@query("A34_simulated_and_detected", f"with {FEATURES}, x as (select distinct sequence, start from f where t < 4), y as (select distinct sequence, start from f where t > 2), z as (select x.start is not null as s, y.start is not null as d from x full join y on x.sequence = y.sequence and x.start = y.start) select count(*) filter (s and d) as both, count(*) filter (s and not d) as missed, count(*) filter (d and not s) as extra from z")
def simulated_and_detected(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = features(spark, sf_dir)
    x = f.where("t < 4").select("sequence", "start").distinct().withColumn("s", F.lit(True))
    y = f.where("t > 2").select("sequence", "start").distinct().withColumn("d", F.lit(True))
    z = x.join(y, ["sequence", "start"], "full").fillna(False, ["s", "d"])
    return z.agg(F.count_if(F.col("s") & F.col("d")).alias("both"), F.count_if(F.col("s") & ~F.col("d")).alias("missed"), F.count_if(F.col("d") & ~F.col("s")).alias("extra"))


QUADS = """q as (select l_suppkey as k, count(*) filter (l_returnflag = 'R' and l_linestatus = 'F')::double as a, count(*) filter (l_returnflag = 'R' and l_linestatus = 'O')::double as b,
  count(*) filter (l_returnflag <> 'R' and l_linestatus = 'F')::double as c, count(*) filter (l_returnflag <> 'R' and l_linestatus = 'O')::double as d from lineitem group by 1)"""


def _quads(spark: SparkSession, sf_dir: str) -> DataFrame:
    r, f = F.col("l_returnflag") == "R", F.col("l_linestatus") == "F"
    cells = {"a": r & f, "b": r & ~f, "c": ~r & f, "d": ~r & ~f}
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("k")).agg(*(F.count_if(v).cast("double").alias(n) for n, v in cells.items()))


@query(
    "G1_two_by_two",
    f"""with {QUADS}, m as (select *, a + b as r1, c + d as r2, a + c as c1, b + d as c2, a + b + c + d as n from q)
select k, round(n * (a * d - b * c) * (a * d - b * c) / nullif(r1 * r2 * c1 * c2, 0), 6) as x2, round((a * d - b * c) * (a * d - b * c) / nullif(r1 * r2 * c1 * c2, 0), 8) as phi, round((a - r1 * c1 / n) / sqrt(a), 6) as tscore, round(2 * a / (r1 + c1), 6) as dice,
  round(a / (a + b + c), 6) as jaccard, round(2 * (a * ln(a / (r1 * c1 / n)) + b * ln(b / (r1 * c2 / n)) + c * ln(c / (r2 * c1 / n)) + d * ln(d / (r2 * c2 / n))), 6) as ll, round(log2(a / (r1 * c1 / n)), 6) as pmi from m where a > 0 and b > 0 and c > 0 and d > 0""",
)
def two_by_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = _quads(spark, sf_dir).where("a > 0 and b > 0 and c > 0 and d > 0")
    m = st.two_by_two(*(F.col(x) for x in "abcd"))
    return q.select("k", *(F.round(m[x], 8 if x == "phi" else 6).alias(x) for x in ("x2", "phi", "tscore", "dice", "jaccard", "ll", "pmi")))


FISHER = f"""{QUADS}, e as (select k, a, unnest(range(greatest(0, a + c - (c + d))::bigint, least(a + b, a + c)::bigint + 1))::double as x, a + b as r1, c + d as r2, a + c as c1, a + b + c + d as n from q),
p as (select *, exp(lgamma(r1 + 1) - lgamma(x + 1) - lgamma(r1 - x + 1) + lgamma(r2 + 1) - lgamma(c1 - x + 1) - lgamma(r2 - c1 + x + 1) - lgamma(n + 1) + lgamma(c1 + 1) + lgamma(n - c1 + 1)) as p from e)"""


@query("G1_fisher", f"with {FISHER} select p.k, round(least(1, sum(p) filter (x <= p.a)), 6) as left_tail, round(least(1, sum(p) filter (x >= p.a)), 6) as right_tail from p group by p.k")
def fisher(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = st.fisher(*(F.col(x) for x in "abcd"))
    return _quads(spark, sf_dir).select("k", F.round(t["left"], 6).alias("left_tail"), F.round(t["right"], 6).alias("right_tail"))


@query("G2_site_filters", f"with {FEATURES}, x as (select sequence, (ceil(start / 50.0) * 50)::bigint as win, sum(c) filter (source = 'F')::double as a, sum(t) filter (source = 'F')::double as b, sum(c) filter (source = 'O')::double as c, sum(t) filter (source = 'O')::double as d from f group by all) select sequence, win, round(a / (a + b) - c / (c + d), 6) as difference from x where a + b >= 20 and c + d >= 20 and greatest(a / (a + b), c / (c + d)) >= 0.5 and abs(a / (a + b) - c / (c + d)) >= 0.05")
def site_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows with enough counts on both sides, methylation and difference."""
    win = (F.ceil(F.col("start") / 50) * 50).cast("bigint").alias("win")
    part = lambda x, s: F.sum(F.when(F.col("source") == s, F.col(x))).cast("double")
    x = features(spark, sf_dir).groupBy("sequence", win).agg(part("c", "F").alias("a"), part("t", "F").alias("b"), part("c", "O").alias("c"), part("t", "O").alias("d"))
    x = x.where("a + b >= 20 and c + d >= 20").withColumn("p", F.col("a") / (F.col("a") + F.col("b"))).withColumn("q", F.col("c") / (F.col("c") + F.col("d")))
    x = x.where((F.greatest("p", "q") >= 0.5) & (F.abs(F.col("p") - F.col("q")) >= 0.05))
    return x.select("sequence", "win", F.round(F.col("p") - F.col("q"), 6).alias("difference"))


@query("G3_hypergeometric", f"with {QUADS}, m as (select *, a + b + c + d as n from q) select k, round(greatest(-200, lgamma(a + b + 1) - lgamma(a + 1) - lgamma(b + 1) + lgamma(c + d + 1) - lgamma(c + 1) - lgamma(d + 1) - lgamma(n + 1) + lgamma(a + c + 1) + lgamma(b + d + 1)), 6) as ln_p from m")
def hypergeometric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quads(spark, sf_dir).select("k", F.round(st.hypergeometric(*(F.col(x) for x in "abcd")), 6).alias("ln_p"))


@query("G5_without_zeros")
def without_zeros(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No oracle, as SQL has no normal quantile; tests hold it against the standard library."""
    x = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 17 == 0, 0.0).otherwise(F.col("value")).alias("value"))
    return st.without_zeros(x, "value").withColumn("value", F.round("value", 6))


@query("F14_log_factorials", "select k::bigint as k, round(lgamma(k + 1), 4) as ln_factorial from (select unnest(range(0, 1001)) as k)")
def log_factorials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.log_factorials(spark, 1000).withColumn("ln_factorial", F.round("ln_factorial", 4))


@query("F4_overlap_lengths", f"""with {FEATURES} select sequence, sum(greatest(0, least("end", 1500) - greatest(start, 1200) + 1))::bigint as shared from f group by 1""")
def overlap_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(spark, sf_dir).groupBy("sequence").agg(F.sum(overlap_length(F.col("start"), F.col("end"), F.lit(1200), F.lit(1500))).alias("shared"))


@query("F5_safe_fraction", f"with {FEATURES} select sequence, round(sum(coalesce((c - 1) * 1.0 / nullif(c - 1 + t - 1, 0), 0)), 6) as s from f group by 1")
def safe_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(spark, sf_dir).groupBy("sequence").agg(F.round(F.sum(fraction(F.col("c") - 1, F.col("t") - 1)), 6).alias("s"))


@query("F8_gc_content", f"with {SEQUENCES} select seq_id, round(coalesce((length - len(replace(replace(sequence, 'G', ''), 'C', ''))) * 1.0 / nullif(length, 0), 0), 6) as gc from s")
def gc_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences(spark, sf_dir).select("seq_id", F.round(sq.gc_content(F.col("sequence")), 6).alias("gc"))
