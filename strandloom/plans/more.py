"""Queries: round trips through files, and the remaining sources, functions and operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions import attributes as at
from strandloom.functions import intervals as iv
from strandloom.functions import sequence as sq
from strandloom.operators import analytic as an
from strandloom.operators import reads as rd
from strandloom.operators import windows as wi
from strandloom.operators.rangejoin import overlap_join
from strandloom.plans.base import ANNOTATION, FEATURES, SEQUENCES, SHORT, annotation, features, sequences, short_features, table
from strandloom.plans.catalogue import query
from strandloom.plans.intervals import PAIRS
from strandloom.plans.reads import READS, SITES, _reads, _sam
from strandloom.session import work_folder
from strandloom.sources import sinks as sk
from strandloom.sources import text as tx
from strandloom.streaming import events as ev


@query("S9_fasta_slurp", f"with {SEQUENCES} select 'seq' || seq_id as seq_id, length::int as length from s")
def fasta_slurp(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sequences(spark, sf_dir).select(F.concat(F.lit("SEQ"), "seq_id").alias("seq_id"), "sequence")
    return tx.parse_fasta(sk.fasta_lines(s)).select(F.lower("seq_id").alias("seq_id"), "length")


@query("S12_pushed_lines", f"with {READS}, x as (select *, (read_id % 5) * 4 as flag from r) select case when read_id % 2 = 0 then 's1' else 's2' end as seqid, count(*) as n from x where flag & 4 = 0 group by 1")
def pushed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parser of streams, on a batch."""
    return ev.sam_stream(_sam(spark, sf_dir)).groupBy("seqid").agg(F.count("*").alias("n"))


@query(
    "S22_placed_reads",
    f"""with {SEQUENCES}, x as (select seq_id, sequence, case when seq_id % 3 = 0 then '-' else '+' end as strand, substr(sequence, 3, 20) as read, substr(sequence, 3, 24) as part from s where length >= 30)
select seq_id::varchar as seq_id, strand, case when strand = '-' then reverse(read) else read end as read, case when strand = '-' then reverse(translate(part, 'ACGT', 'TGCA')) else part end as target from x""",
)
def placed_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sequences(spark, sf_dir).where("length >= 30").withColumn("seq_id", F.col("seq_id").cast("string"))
    text = s.select(F.concat_ws("\t", "seq_id", F.when(F.col("seq_id") % 3 == 0, "-").otherwise("+"), F.lit("3"), F.lit("22"), F.expr("substring(sequence, 3, 20)")).alias("value"))
    return tx.parse_placed_reads(text, s).select("seq_id", "strand", "read", "target")


@query("S25_compressed_lines", f"with {FEATURES} select upper(sequence) as sequence, count(*) as n, sum(start)::bigint as starts from f group by 1")
def compressed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features written as compressed text, found again below a folder by a pattern, and parsed."""
    folder = work_folder(spark)
    sk.feature_lines(features(spark, sf_dir)).write.option("compression", "gzip").text(f"{folder}/some/where")
    f = tx.parse_features(tx.lines(spark, folder, "*.txt.gz"))
    return f.groupBy("sequence").agg(F.count("*").alias("n"), F.sum("start").alias("starts"))


@query("S29_line_count", "select count(*) as n from lineitem")
def line_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sk.feature_lines(features(spark, sf_dir)).agg(F.count("*").alias("n"))


@query("K3_split_by_sequence", f"with {FEATURES} select sequence, count(*) as n, sum(id)::bigint as ids from f group by 1")
def split_by_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: a folder for each sequence, read back with its name as a column."""
    folder = f"{work_folder(spark)}/split"
    sk.write_split_many(features(spark, sf_dir), folder)
    return spark.read.parquet(folder).groupBy("sequence").agg(F.count("*").alias("n"), F.sum("id").alias("ids"))


@query("K4_split_by_strand", f"with {FEATURES} select strand, count(*) as n, sum(id)::bigint as ids from f group by 1")
def split_by_strand(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{work_folder(spark)}/split"
    sk.write_split(features(spark, sf_dir), folder, "strand", 10_000)
    return spark.read.parquet(folder).groupBy("strand").agg(F.count("*").alias("n"), F.sum("id").alias("ids"))


@query("K11_fastq_to_fasta", f"with {READS} select '>' || read_id || chr(10) || sequence as value from r")
def fastq_to_fasta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sk.fasta_lines(tx.parse_fastq(sk.fastq_lines(_reads(spark, sf_dir))).withColumnRenamed("read_id", "seq_id"))


@query("K13_histogram_table", f"with {FEATURES} select source, c + t as depth, count(*) as n from f group by all")
def histogram_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table that a plot would show."""
    return features(spark, sf_dir).groupBy("source", (F.col("c") + F.col("t")).alias("depth")).agg(F.count("*").alias("n"))


@query("K6_bucketed_store", f"with {FEATURES} select sequence, count(*) as n, sum(id)::bigint as ids from f group by 1")
def bucketed_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: features in a table bucketed and sorted by sequence, which is then grouped by it without a shuffle."""
    name = f"strandloom_store_{uuid.uuid4().hex}"
    sk.save_store(features(spark, sf_dir), name, 8, "sequence")
    return spark.table(name).groupBy("sequence").agg(F.count("*").alias("n"), F.sum("id").alias("ids"))


@query("S27_discovered_files", f"with {FEATURES} select feature, count(*) as n, sum(start)::bigint as starts from f group by 1")
def discovered_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of several folders found by a pattern of their names; others beside them are left alone."""
    folder = work_folder(spark)
    for kind in ("one", "two"):
        own = features(spark, sf_dir).where("id % 2 = 0" if kind == "one" else "id % 2 <> 0")
        sk.feature_lines(own).write.text(f"{folder}/{kind}/deep")
    sk.feature_lines(features(spark, sf_dir)).write.option("compression", "gzip").text(f"{folder}/other")
    found = tx.parse_features(tx.lines(spark, folder, "part-*.txt"))
    return found.groupBy("feature").agg(F.count("*").alias("n"), F.sum("start").alias("starts"))


@query("K14_written_once", f"with {FEATURES} select count(*) as n from f")
def written_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second write to the same place is skipped."""
    folder = f"{work_folder(spark)}/once"
    for df in (features(spark, sf_dir), features(spark, sf_dir).limit(0)):
        sk.write_features(df, folder, "ignore")
    return tx.lines(spark, folder).agg(F.count("*").alias("n"))


@query("P20_absolute_bins", f"""with {SHORT}, s as (select sequence, max("end") as span from g group by 1), o as (select sequence, coalesce(sum(span + 5000) over (order by sequence rows between unbounded preceding and 1 preceding), 0) as off from s)
select ((start + off) // 1000)::bigint as bin, count(*) as n from g join o using (sequence) group by 1""")
def absolute_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = an.running_offsets(short_features(spark, sf_dir), 5000)
    return x.groupBy(F.floor(F.col("absolute") / 1000).alias("bin")).agg(F.count("*").alias("n"))


@query("P28_range_predicates", f"""with {FEATURES} select sequence, count(*) filter ("end" < 1200) as before, count(*) filter (start > 1500) as after, count(*) filter (start <= 1500 and "end" >= 1200) as overlapping, count(*) filter ((least("end", 1500) - greatest(start, 1200) + 1) * 2 >= "end" - start + 1) as half from f group by 1""")
def range_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, e, lo, hi = F.col("start"), F.col("end"), F.lit(1200), F.lit(1500)
    return features(spark, sf_dir).groupBy("sequence").agg(
        F.count_if(iv.before(e, lo)).alias("before"), F.count_if(iv.after(s, hi)).alias("after"), F.count_if(iv.overlaps(s, e, lo, hi)).alias("overlapping"), F.count_if(iv.overlap_ratio(s, e, lo, hi) >= 0.5).alias("half")
    )


@query(
    "A6_window_microarray",
    f"""with {PAIRS}, c as (select a_id, greatest(start, a_start) as s, least("end", a_end) as e from j), p as (select a_id, count(distinct x) as covered from (select a_id, unnest(range(s, e + 1)) as x from c) group by 1)
select j.a_id as id, count(*) as n, round(case when count(*) = 1 then max(score) else sum(score * overlap) / max(covered) end, 6) as score from j join p on p.a_id = j.a_id group by 1""",
)
def window_microarray(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wi.microarray(overlap_join(features(spark, sf_dir), annotation(spark, sf_dir))).withColumn("score", F.round("score", 6))


@query("W4_merged_annotation_windows", f"""with {FEATURES}, {ANNOTATION}, u as (select distinct feature as parent, sequence, start, "end" from a) select parent, count(*) as n, sum(c)::bigint as c, sum(t)::bigint as t from f join u on f.sequence = u.sequence and f.start <= u."end" and f."end" >= u.start group by 1""")
def merged_annotation_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = annotation(spark, sf_dir).withColumnRenamed("feature", "parent")
    return wi.merged_annotation_windows(features(spark, sf_dir), parts, [F.count("*").alias("n"), F.sum("c").alias("c"), F.sum("t").alias("t")])


@query("O3_multi_key_sort", "select row_number() over (order by o_orderstatus, o_custkey, o_orderkey) - 1 as row, o_orderkey from orders")
def multi_key_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "orders").select("o_orderstatus", "o_custkey", "o_orderkey")
    return tx.numbered(x, ["o_orderstatus", "o_custkey", "o_orderkey"]).select("row", "o_orderkey")


@query("F2_complement", f"with {READS} select read_id, translate(sequence, 'ACGT', 'TGCA') as complement from r")
def complement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reads(spark, sf_dir).select("read_id", sq.complement(F.col("sequence")).alias("complement"))


@query("F9_reversed_coordinates", f"with {FEATURES} select sequence, sum(4000 - start + 1)::bigint as starts from f group by 1")
def reversed_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(spark, sf_dir).groupBy("sequence").agg(F.sum(iv.reversed_coordinate(F.col("start"), F.lit(4000))).alias("starts"))


@query("F13_log2_ratio", f"with {FEATURES} select c, t, round(log2(c * 1.0 / t), 6) + 0.0::double as ratio, count(*) as n from f where t > 1 group by all")
def log2_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = features(spark, sf_dir).withColumn("ratio", F.round(iv.log2_ratio(F.col("c"), F.when(F.col("t") > 1, F.col("t")).otherwise(0)), 6) + F.lit(0.0))
    return x.where(~F.isnan("ratio")).groupBy("c", "t", "ratio").agg(F.count("*").alias("n"))


@query("F15_escaped_values", "select n_nationkey, url_encode(n_name || ' a;b=' || n_nationkey || '%') as value from nation")
def escaped_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat("n_name", F.lit(" a;b="), "n_nationkey", F.lit("%"))
    return table(spark, sf_dir, "nation").select("n_nationkey", at.escaped(text).alias("value"))


@query("F17_open_bounds", f"with {FEATURES} select sequence, count(*) filter (start >= 1000) as above, count(*) as within from f group by 1")
def open_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    low, high = iv.bound(F.lit("-inf")), iv.bound(F.lit("Inf"))
    s = F.col("start")
    return features(spark, sf_dir).groupBy("sequence").agg(F.count_if((s >= iv.bound(F.lit("1000"))) & (s <= high)).alias("above"), F.count_if((s > low) & (s < high)).alias("within"))


@query("F18_formatted_numbers", f"with {FEATURES} select score, case when score = 0 then '0' else printf('%.4f', score) end as text, count(*) as n from f group by all")
def formatted_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(spark, sf_dir).groupBy("score", sk.number(F.col("score")).alias("text")).agg(F.count("*").alias("n"))


@query(
    "M3_caller_of_pairs",
    f"""with {SITES}, m as (select seq_id, k, mate, 1 + k * 30 + (mate - 1) * 12 as start, substr(sequence, 1 + k * 30 + (mate - 1) * 12, 20) as read from s, (select unnest(range(0, (select max(length) // 30 + 1 from s))) as k), (select unnest([1, 2]) as mate) where length >= 1 + k * 30),
l as (select seq_id, k, mate, start + i as pos, substr(read, i + 1, 1) as letter from (select *, unnest(range(0, length(read))) as i from m)), o as (select *, row_number() over (partition by seq_id, k, pos order by mate) as n from l),
g as (select seq_id, pos, case when mate = 1 then '+' else '-' end as strand, count(*) filter (letter = case when mate = 1 then 'C' else 'G' end) as c, count(*) filter (letter = case when mate = 1 then 'T' else 'A' end) as t from o where n = 1 group by all)
select g.seq_id, g.pos::int as pos, g.strand, g.c, g.t from g join z on z.seq_id = g.seq_id and z.pos = g.pos and z.strand = g.strand where c + t > 0""",
)
def caller_of_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: pairs of 20 letters, 12 apart, at every thirtieth place over each sequence's whole length."""
    s = sequences(spark, sf_dir)
    m = rd.tiled(s, 30, 32).withColumn("mate", F.explode(F.array(F.lit(1), F.lit(2))))
    reads = m.select(F.concat_ws("-", "seq_id", "k").alias("pair_id"), "mate", "seq_id", (F.col("start") + (F.col("mate") - 1) * 12).alias("start"), F.expr("substring(sequence, 1 + (mate - 1) * 12, 20)").alias("sequence"))
    return rd.call_methylation_of_pairs(reads, s).select("seq_id", F.col("pos").cast("int").alias("pos"), "strand", "c", "t")


@query("M6_cytosine_index", f"with {SITES} select seq_id, pos from z where strand = '+' and context = 'CG'")
def cytosine_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6: the index as a table, written and read by one context."""
    folder = f"{work_folder(spark)}/index"
    sk.write_split(rd.cytosines(sequences(spark, sf_dir)), folder, "context")
    return spark.read.parquet(folder).where("context = 'CG' and strand = '+'").select("seq_id", "pos")
