"""Queries: sources, sinks, scalar functions, sequences and reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandloom.functions import attributes as at
from strandloom.functions import sequence as sq
from strandloom.operators import reads as rd
from strandloom.operators.windows import window_end
from strandloom.plans.base import ANNOTATION, FEATURES, LENGTHS, SEQUENCES, annotation, features, lengths, sequences, table
from strandloom.plans.catalogue import query
from strandloom.plans.statistics import SITES
from strandloom.sources import sinks as sk
from strandloom.sources import text as tx


def feature_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """features as nine-column lines, every seventh order a comment or a line that is too short."""
    f = features(spark, sf_dir)
    attrs = F.concat(F.lit("ID="), "id", F.lit(";c="), "c", F.lit(";t="), "t", F.lit("; free text*"))
    row = F.concat_ws("\t", "sequence", "source", "feature", F.col("start").cast("string"), F.col("end").cast("string"), F.when(F.col("score") == 0, ".").otherwise(F.col("score").cast("string")), "strand", F.lit("."), attrs)
    return f.select(F.when(F.col("id") % 7 == 0, F.concat(F.lit("# "), row)).when(F.col("id") % 7 == 1, F.substring_index(row, "\t", 5)).otherwise(row).alias("value"), "id")


@query("S1_feature_scan", f"""with {FEATURES} select upper(sequence) as sequence, feature, count(*) as n, sum(start)::bigint as starts, sum("end")::bigint as ends, round(sum(nullif(score, 0)), 4) as score, count(*) filter (score = 0) as unscored from f where id % 7 > 1 group by all""")
def feature_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = tx.parse_features(feature_text(spark, sf_dir))
    return f.groupBy("sequence", "feature").agg(F.count("*").alias("n"), F.sum("start").alias("starts"), F.sum("end").alias("ends"), F.round(F.sum("score"), 4).alias("score"), F.count_if(F.col("score").isNull()).alias("unscored"))


@query("S1_rejected_lines", f"with {FEATURES} select count(*) as n from f where id % 7 = 1")
def rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tx.rejected_features(feature_text(spark, sf_dir)).agg(F.count("*").alias("n"))


@query("S2_laundered_scan", f"""with {FEATURES} select sequence, count(*) as n from f where id % 7 > 1 and start <= "end" and id % 5 > 0 group by 1""")
def laundered_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = F.regexp_replace("value", r"^(([^\t]*\t){3})\d+", "$1x")
    lines = feature_text(spark, sf_dir).select(F.when(F.col("id") % 5 == 0, bad).otherwise(F.col("value")).alias("value"))
    return tx.parse_features(lines, "keep", launder=True).groupBy("sequence").agg(F.count("*").alias("n"))


@query("S3_spliced_scan", f"with {FEATURES} select feature, c::varchar as c, count(*) as n from f where id % 7 > 1 group by all")
def spliced_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = feature_text(spark, sf_dir).where("id % 7 > 1")
    return tx.spliced(lines, ["feature", "c"]).groupBy("feature", "c").agg(F.count("*").alias("n"))


@query("D2_attribute_map", f"with {FEATURES} select c::varchar as c, 'free text' as note, true as asterisk, count(*) as n from f where id % 7 > 1 group by 1")
def attribute_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = tx.with_attributes(tx.parse_features(feature_text(spark, sf_dir)))
    return f.groupBy(F.col("attributes")["c"].alias("c"), F.col("attributes")["Note"].alias("note"), "asterisk").agg(F.count("*").alias("n"))


def _correlated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of correlated reads: each part's name as bases, its target the same with two bases more on each side."""
    p = table(spark, sf_dir, "part")
    read = F.translate(F.substring(F.md5(F.col("p_partkey").cast("string").cast("binary")), 1, 20), "0123456789abcdef", "ACGTACGTACGTACGT")
    target = F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit("A"), read)).when(F.col("p_partkey") % 4 == 1, F.concat(F.lit("AA"), F.translate(read, "T", "C"), F.lit("GG"))).otherwise(F.concat(F.lit("AA"), F.reverse(read), F.lit("GG")))
    return p.select(F.concat_ws("\t", F.lit("chr1"), F.lit("U/NM"), F.concat(F.lit("r"), "p_partkey", F.lit(":"), read), F.col("p_size").cast("string"), (F.col("p_size") + 19).cast("string"), F.lit("1"), F.when(F.col("p_partkey") % 2 == 0, "+").otherwise("-"), F.lit("0"), F.concat(F.lit("target="), target)).alias("value"))


@query(
    "S4_correlated_scan",
    """with r as (select p_partkey as k, p_size, translate(substr(md5(p_partkey::varchar), 1, 20), '0123456789abcdef', 'ACGTACGTACGTACGT') as read from part),
x as (select *, case when k % 4 = 1 then translate(read, 'T', 'C') else reverse(read) end as inside from r where k % 4 <> 0),
m as (select k, p_size, (select count(*) from (select unnest(range(1, 21)) as i) where not (substr(read, i, 1) = substr(inside, i, 1) or (substr(read, i, 1) = 'T' and substr(inside, i, 1) = 'C'))) as other from x)
select 'r' || k as read_id, p_size::bigint as start, k % 2 = 1 as reverse from m where other * 4 < 20""",
)
def correlated_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tx.parse_correlated(_correlated(spark, sf_dir), conversion_only=True).select("read_id", "start", "reverse")


@query("S5_slurped_index", f"with {FEATURES} select sequence, count(*) as n, min(start) as first, max(start) as last from f group by 1")
def slurped_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = tx.slurped(features(spark, sf_dir).select("sequence", "start", "id"), "sequence")
    return s.select("sequence", F.size("rows").cast("bigint").alias("n"), F.get("rows", F.lit(0))["start"].alias("first"), F.element_at("rows", -1)["start"].alias("last"))


@query("S6_row_access", "with x as (select row_number() over (order by o_orderkey) - 1 as row, o_orderkey from orders) select row, o_orderkey from x where row % 1000 = 7")
def row_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by number: here every thousandth, which is what is asked for."""
    return tx.numbered(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"]).where("row % 1000 = 7").select("row", "o_orderkey")


@query("S7_point_lookup", f"with {FEATURES} select sequence, start, count(*) as n, min(id) as first from f where sequence = 's1' and start between 2000 and 2100 group by all")
def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = features(spark, sf_dir).where((F.col("sequence") == "s1") & F.col("start").between(2000, 2100))
    return f.groupBy("sequence", "start").agg(F.count("*").alias("n"), F.min("id").alias("first"))


@query("S8_fasta_scan", f"with {SEQUENCES} select 'SEQ' || seq_id as seq_id, 'seq' || seq_id || ' a record' as original_name, length::int as length, md5(sequence) as digest from s")
def fasta_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sequences(spark, sf_dir).select(F.concat(F.lit("seq"), "seq_id", F.lit(" a record")).alias("seq_id"), "sequence")
    f = tx.parse_fasta(sk.fasta_lines(s))
    return f.select("seq_id", "original_name", "length", F.md5(F.col("sequence").cast("binary")).alias("digest"))


def _reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = F.translate(F.concat(*(F.md5(F.concat(F.col("p_partkey").cast("string"), F.lit(x)).cast("binary")) for x in "ab")), "0123456789abcdef", "ACGTACGTACGTACGT")
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("read_id"), F.substring(b, F.lit(1), 30 + F.col("p_size") % 20).alias("sequence"))


READS = "r as (select p_partkey as read_id, substr(translate(md5(p_partkey || 'a') || md5(p_partkey || 'b'), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 30 + p_size % 20) as sequence from part)"


@query("S10_fastq_scan", f"with {READS} select read_id::varchar as read_id, sequence, repeat('I', length(sequence)) as quality from r")
def fastq_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tx.parse_fastq(sk.fastq_lines(_reads(spark, sf_dir)))


@query("S10_fastq_lines", f"with {READS} select read_id::varchar as read_id, sequence, repeat('I', length(sequence)) as quality from r")
def fastq_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sk.fastq_lines(_reads(spark, sf_dir)).select(F.posexplode(F.split("value", "\n")).alias("i", "value"), F.regexp_extract("value", r"^@(\d+)", 1).cast("bigint").alias("k"))
    return tx.fastq_from_lines(rows.select("value", (F.col("k") * 4 + F.col("i")).alias("line"))).drop("record")


def _sam(spark: SparkSession, sf_dir: str) -> DataFrame:
    r, k = _reads(spark, sf_dir), F.col("read_id")
    n = F.length("sequence")
    cigar = F.when(k % 3 == 0, F.concat(F.lit("5M2D"), n - 5, F.lit("M"))).when(k % 3 == 1, F.concat(F.lit("4S6M1I"), n - 11, F.lit("M"))).otherwise(F.concat(n, F.lit("M")))
    return r.select(F.concat_ws("\t", k.cast("string"), ((k % 5) * 4).cast("string"), F.when(k % 2 == 0, F.lit("RC_s1")).otherwise("s2"), (k + 1).cast("string"), (k % 40).cast("string"), cigar, F.lit("*"), F.lit("0"), F.lit("0"), "sequence", F.repeat(F.lit("I"), n), F.concat(F.lit("NM:i:"), k % 4), F.lit("MD:Z:3A4^CG2T1")).alias("value"))


@query(
    "S11_sam_scan",
    f"""with {READS}, x as (select *, length(sequence) as n, (read_id % 5) * 4 as flag from r)
select read_id::varchar as read_id, case when read_id % 2 = 0 then 's1' else 's2' end as seqid, (read_id + 1)::bigint as pos, (read_id + 1 + case when read_id % 3 = 0 then n + 2 when read_id % 3 = 1 then n - 5 else n end - 1)::bigint as rightmost, (flag & 16 <> 0) <> (read_id % 2 = 0) as reverse, (read_id % 4)::int as nm from x where flag & 4 = 0""",
)
def sam_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tx.parse_sam(_sam(spark, sf_dir)).select("read_id", "seqid", "pos", "rightmost", "reverse", "nm")


@query(
    "S11_sam_forward",
    f"""with {READS}, x as (select *, length(sequence) as n, (read_id % 5) * 4 as flag from r), y as (select *, read_id + 1 + case when read_id % 3 = 0 then n + 2 when read_id % 3 = 1 then n - 5 else n end - 1 as rightmost from x where flag & 4 = 0)
select read_id::varchar as read_id, (case when read_id % 2 = 0 then 4000 - rightmost + 1 else read_id + 1 end)::bigint as pos, case when read_id % 2 = 0 then reverse(translate(sequence, 'ACGT', 'TGCA')) else sequence end as sequence from y""",
)
def sam_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tx.sam_forward(tx.parse_sam(_sam(spark, sf_dir)), lengths(spark, sf_dir)).select("read_id", "pos", "sequence")


@query("S11_sam_header", "select 'SQ' as kind, 's' || s_suppkey as name, '4000' as length from supplier")
def sam_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = lengths(spark, sf_dir).select(F.concat_ws("\t", F.lit("@SQ"), F.concat(F.lit("SN:"), "sequence"), F.concat(F.lit("LN:"), "length")).alias("value"))
    return tx.sam_header(text).select("kind", F.col("tags")["SN"].alias("name"), F.col("tags")["LN"].alias("length"))


@query("S13_bowtie_scan", f"with {READS} select read_id::varchar as read_id, case when read_id % 2 = 0 then '+' else '-' end as strand, 's1' as seqid, (read_id + 1)::bigint as start, 2 as mismatches, ((read_id % 9) + 12)::int as offsets from r")
def bowtie_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("read_id")
    text = _reads(spark, sf_dir).select(F.concat_ws("\t", k.cast("string"), F.when(k % 2 == 0, "+").otherwise("-"), F.lit("s1"), k.cast("string"), "sequence", F.lit("I"), F.lit("0"), F.concat((k % 9).cast("string"), F.lit(":A>G,12:C>T"))).alias("value"))
    b = tx.parse_bowtie(text)
    return b.select("read_id", "strand", "seqid", "start", F.size("mismatches").alias("mismatches"), F.aggregate("mismatches", F.lit(0), lambda n, x: n + x["offset"]).alias("offsets"))


def _eland(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("read_id")
    hit = F.concat(F.lit("s1:"), k + 5, F.lit("F0"))
    two = F.concat(hit, F.lit(",RC_s2:"), k + 9, F.lit("F1"))
    counts, hits = F.when(k % 3 == 0, "NM").when(k % 3 == 1, "1:0:0:0").otherwise("1:1:0:0"), F.when(k % 3 == 0, "").when(k % 3 == 1, hit).otherwise(two)
    return _reads(spark, sf_dir).select(F.concat_ws("\t", k.cast("string"), "sequence", counts, hits).alias("value"))


@query("S14_eland_scan", f"with {READS} select read_id::varchar as read_id, case when read_id % 3 = 0 then 0 when read_id % 3 = 1 then 1 else 2 end::int as hits, case when read_id % 3 > 0 then read_id % 3 end::int as total from r")
def eland_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = tx.parse_eland(_eland(spark, sf_dir))
    return e.select("read_id", F.size("matches").alias("hits"), F.aggregate("counts", F.lit(0), lambda n, x: n + x).alias("total"))


@query("S20_eland_features", f"""with {READS}, x as (select 's1' as sequence, read_id + 5 as start, '+' as strand, length(sequence) as n from r where read_id % 3 > 0 union all select 's2', read_id + 9, '-', length(sequence) from r where read_id % 3 = 2) select sequence, start::bigint as start, (start + n - 1)::bigint as "end", strand, count(*) as n from x group by all""")
def eland_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tx.eland_features(tx.parse_eland(_eland(spark, sf_dir))).groupBy("sequence", "start", "end", "strand").agg(F.count("*").alias("n"))


@query("S15_agp_scan", "select 's' || s_suppkey as object, 1 as part, case when s_suppkey % 2 = 0 then 'W' else 'N' end as type, case when s_suppkey % 2 = 0 then 'c' || s_suppkey end as component, case when s_suppkey % 2 = 1 then 100::bigint end as gap from supplier")
def agp_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    tail = F.when(k % 2 == 0, F.concat_ws("\t", F.lit("W"), F.concat(F.lit("c"), k), F.lit("1"), F.lit("100"), F.lit("+"))).otherwise(F.concat_ws("\t", F.lit("N"), F.lit("100"), F.lit("scaffold"), F.lit("yes"), F.lit("")))
    text = table(spark, sf_dir, "supplier").select(F.concat_ws("\t", F.concat(F.lit("s"), k), F.lit("1"), F.lit("100"), F.lit("1"), tail).alias("value"))
    return tx.parse_agp(text).select("object", "part", "type", "component", "gap")


@query("S16_wiggle_scan", f"""with {FEATURES}, d as (select sequence, start, sum(c)::double as score from f group by all) select sequence, start::bigint as start, (start + 9)::bigint as "end", score from d""")
def wiggle_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = features(spark, sf_dir).groupBy("sequence", "start").agg(F.sum("c").alias("score"))
    rows = d.select("sequence", F.col("start").cast("bigint").alias("line"), F.concat_ws(" ", F.col("start").cast("string"), F.col("score").cast("string")).alias("value"))
    heads = d.select("sequence").distinct().select("sequence", F.lit(0).cast("bigint").alias("line"), F.concat(F.lit("variableStep chrom="), "sequence", F.lit(" span=10")).alias("value"))
    return tx.parse_wiggle(heads.unionByName(rows).withColumnRenamed("sequence", "file"), file="file")


@query("S17_junction_scan", "with j as (select l_suppkey, l_orderkey, l_linenumber as n, (l_quantity)::bigint as q from lineitem) select feature, count(*) as n, sum(s)::bigint as starts, sum(e)::bigint as ends from (select 'junction' as feature, 101 as s, 100 + q * 10 as e from j union all select 'block', 101, 100 + n from j union all select 'block', 100 + q * 10 - n + 1, 100 + q * 10 from j) group by 1")
def junction_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, q = F.col("l_linenumber").cast("string"), F.col("l_quantity").cast("bigint")
    sizes = F.concat(n, F.lit(","), n)
    text = table(spark, sf_dir, "lineitem").select(F.concat_ws("\t", F.concat(F.lit("s"), "l_suppkey"), F.lit("100"), (100 + q * 10).cast("string"), F.lit("J"), F.lit("5"), F.lit("+"), F.lit("0"), F.lit("0"), F.lit("0"), F.lit("2"), sizes, F.lit("0,0")).alias("value"))
    return tx.parse_junctions(text).groupBy("feature").agg(F.count("*").alias("n"), F.sum("start").alias("starts"), F.sum("end").alias("ends"))


@query("S18_gtf_attributes", "select n_nationkey, 'gene_id=' || n_name || ';nation=' || n_nationkey as attribute_string from nation")
def gtf_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit('gene_id "'), "n_name", F.lit('"; nation "'), "n_nationkey", F.lit('";'))
    return table(spark, sf_dir, "nation").select("n_nationkey", tx.gtf_attributes(text).alias("attribute_string"))


@query("S19_table_features", """select 's' || l_suppkey as sequence, feature, count(*) as n, round(sum(score), 2) as score, max(start + 49)::bigint as "end" from (select l_suppkey, l_orderkey as start, 'l_quantity' as feature, l_quantity as score from lineitem union all select l_suppkey, l_orderkey, 'l_tax', l_tax from lineitem) group by all""")
def table_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "lineitem").withColumn("s", F.concat(F.lit("s"), "l_suppkey"))
    out = tx.table_features(x, "s", "l_orderkey", 50, ["l_quantity", "l_tax"])
    return out.groupBy("sequence", "feature").agg(F.count("*").alias("n"), F.round(F.sum("score"), 2).alias("score"), F.max("end").alias("end"))


@query("S21_bowtie_concise", "with h as (select l_partkey, count(*) as n, list_aggregate(list_sort(list('s' || l_suppkey || ':' || l_orderkey || case when l_linenumber % 2 = 0 then '+' else '-' end)), 'string_agg', ',') as m from lineitem where l_returnflag = 'R' and l_linestatus = 'F' and l_tax < 0.01 group by 1) select p_partkey as read_id, coalesce(n, 0) as n, coalesce(m, 'NM') as matches from part left join h on l_partkey = p_partkey")
def bowtie_concise(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R' and l_linestatus = 'F' and l_tax < 0.01")
    h = h.select(F.col("l_partkey").alias("read_id"), F.concat(F.lit("s"), "l_suppkey").alias("seqid"), F.col("l_orderkey").alias("start"), F.when(F.col("l_linenumber") % 2 == 0, "+").otherwise("-").alias("strand"))
    return tx.bowtie_concise(h, table(spark, sf_dir, "part").select(F.col("p_partkey").alias("read_id")))


@query("S23_qseq_to_fastq", f"with {READS} select 'M:1:2:3:' || read_id || '#0/1' as read_id, replace(replace(sequence, 'A', 'N'), '.', 'N') as sequence from r where read_id % 2 = 1")
def qseq_to_fastq(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("read_id").cast("string")
    text = _reads(spark, sf_dir).select(F.concat_ws("\t", F.lit("M"), F.lit("r"), F.lit("1"), F.lit("2"), F.lit("3"), k, F.lit("0"), F.lit("1"), F.translate("sequence", "A", "."), F.lit("I"), (F.col("read_id") % 2).cast("string")).alias("value"))
    return tx.qseq_to_fastq(text, passed_only=True).select("read_id", "sequence")


@query("S24_quality_variants", "select p_partkey as read_id, chr((p_size % 40 + 33)::int) || 'I' as integers, chr((p_size % 40 + 33 + 1)::int) as shifted from part")
def quality_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("p_size") % 40
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("read_id"), tx.integer_qualities(F.concat_ws(" ", q.cast("string"), F.lit("40"))).alias("integers"), sq.phred_shift(F.char(q + 33), 1).alias("shifted"))


@query("S28_window_width", "select 50 as width")
def window_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = features(spark, sf_dir).select("sequence", (F.floor((F.col("start") - 1) / 50) * 50 + 1).cast("int").alias("start")).distinct()
    return tx.window_width(w.withColumn("end", (F.col("start") + 49).cast("int")))


@query("K1_feature_lines", f"""with {FEATURES} select md5(sequence || chr(9) || source || chr(9) || feature || chr(9) || start || chr(9) || "end" || chr(9) || case when score = 0 then '0' else printf('%.4f', score) end || chr(9) || strand || chr(9) || '.' || chr(9) || '.') as digest, count(*) as n from f group by 1""")
def feature_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sk.feature_lines(features(spark, sf_dir)).groupBy(F.md5(F.col("value").cast("binary")).alias("digest")).agg(F.count("*").alias("n"))


@query("K2_attribute_table", f"""with {FEATURES} select id, t::varchar as t, case when c > 25 then c::varchar end as c, count(*) as n from f group by all""")
def attribute_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("t="), "t", F.when(F.col("c") > 25, F.concat(F.lit(";c="), "c")).otherwise(""))
    rows = features(spark, sf_dir).select("id", at.attribute_map(text).alias("attributes"))
    return sk.attribute_table(rows).groupBy("id", "t", "c").agg(F.count("*").alias("n"))


@query("K5_wiggle_lines", f"with {FEATURES}, d as (select sequence, start, sum(c) as c, sum(t) as t from f group by all) select sequence, start::bigint as line, start || ' ' || printf('%.4f', round(c * 1.0 / (c + t), 4)) as value from d union all select distinct sequence, 0, 'variableStep chrom=' || sequence from d")
def wiggle_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = features(spark, sf_dir).groupBy("sequence", "start").agg(F.sum("c").alias("c"), F.sum("t").alias("t"))
    return sk.wiggle_lines(d, F.col("c") / (F.col("c") + F.col("t")))


@query("K7_fasta_lines", f"with {SEQUENCES} select '>' || seq_id || chr(10) || regexp_replace(regexp_replace(sequence, '(.{{80}})', '\\1' || chr(10), 'g'), chr(10) || '$', '') as value from s")
def fasta_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sk.fasta_lines(sequences(spark, sf_dir))


@query("K8_soft_table", f"""with {ANNOTATION} select sequence, row_number() over (partition by sequence order by start, "end", score)::int as number, start, "end", score from a""")
def soft_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sk.soft_lines(annotation(spark, sf_dir))


@query("K9_sam_lines", f"with {READS} select read_id::varchar as read_id, length(sequence) || 'M' as cigar, 'MD:Z:' || case when substr(sequence, 11, 1) = 'A' then length(sequence)::varchar else '10' || 'A' || (length(sequence) - 11) end as md from r")
def sam_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = F.concat(F.expr("substring(sequence, 1, 10)"), F.lit("A"), F.expr("substring(sequence, 12)"))
    rows = _reads(spark, sf_dir).select(F.col("read_id").cast("string").alias("read_id"), F.lit("+").alias("strand"), F.lit("s1").alias("seqid"), F.lit(1).alias("start"), target.alias("target"), F.repeat(F.lit("I"), F.length("sequence")).alias("quality"), F.col("sequence").alias("read"))
    p = F.split("value", "\t")
    return sk.sam_lines(rows).select(F.get(p, F.lit(0)).alias("read_id"), F.get(p, F.lit(5)).alias("cigar"), F.get(p, F.lit(11)).alias("md"))


@query("K10_eland_lines", "with x as (select l_partkey as k, 's' || l_suppkey || ':' || l_orderkey || 'F' || (l_linenumber % 4) as hit, l_linenumber % 4 as m from lineitem) select k || chr(9) || 'ACGT' || chr(9) || count(*) filter (m = 0) || ':' || count(*) filter (m = 1) || ':' || count(*) filter (m = 2) || ':' || count(*) filter (m = 3) || chr(9) || list_aggregate(list_sort(list(hit)), 'string_agg', ',') as value from x group by k")
def eland_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").cast("string").alias("read_id"), F.lit("ACGT").alias("read"), F.concat(F.lit("s"), "l_suppkey").alias("sequence"), F.col("l_orderkey").alias("start"), F.lit("+").alias("strand"), (F.col("l_linenumber") % 4).alias("mismatches"))
    return sk.eland_lines(x)


@query("K12_report", f"with {FEATURES} select sequence, '{{\"n\":' || count(*) || ',\"c\":' || sum(c) || '}}' as report from f group by 1")
def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sk.report_json(features(spark, sf_dir).groupBy("sequence").agg(F.count("*").alias("n"), F.sum("c").alias("c")), "sequence")


@query("K15_staged", f"""with {FEATURES} select lower(sequence) as sequence, 'own' as source, sum(start - 1)::bigint as starts from f group by 1""")
def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sk.staged(features(spark, sf_dir), "own").groupBy("sequence", "source").agg(F.sum("start").alias("starts"))


@query("F1_reverse_complement", f"with {READS} select read_id, reverse(translate(sequence, 'ACGT', 'TGCA')) as rc, replace(sequence, 'C', 'T') as c2t, replace(sequence, 'G', 'A') as g2a, replace(reverse(translate(sequence, 'ACGT', 'TGCA')), 'C', 'T') as rc_c2t from r")
def reverse_complement(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("sequence")
    return _reads(spark, sf_dir).select("read_id", sq.reverse_complement(s).alias("rc"), sq.c_to_t(s).alias("c2t"), sq.g_to_a(s).alias("g2a"), sq.rc_c_to_t(s).alias("rc_c2t"))


@query("F3_hamming", f"with {READS} select read_id, hamming(sequence, reverse(sequence))::int as distance from r")
def hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reads(spark, sf_dir).select("read_id", sq.hamming(F.col("sequence"), F.reverse("sequence")).alias("distance"))


@query("F6_common_prefix", f"with {READS}, x as (select read_id, sequence, substr(sequence, 1, 3) || 'A' || substr(sequence, 5) as other from r) select read_id, case when sequence = other then length(sequence) else 3 end::int as shared from x")
def common_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    other = F.concat(F.expr("substring(sequence, 1, 3)"), F.lit("A"), F.expr("substring(sequence, 5)"))
    return _reads(spark, sf_dir).select("read_id", sq.common_prefix_length(F.col("sequence"), other).alias("shared"))


@query("F7_contexts", f"with {READS}, x as (select read_id, substr(sequence, 5, 3) as tri from r) select read_id, tri, case when tri like 'CG%' then 'CG' when regexp_matches(tri, '^C[ACT]G') then 'CHG' when tri like 'C%' then 'CHH' end as context, case when tri like 'C%' then substr(tri, 1, 2) end as dinucleotide from x")
def contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tri = sq.triplet(F.col("sequence"), F.lit(5))
    return _reads(spark, sf_dir).select("read_id", tri.alias("tri"), sq.context(tri).alias("context"), sq.dinucleotide(tri).alias("dinucleotide"))


@query("F8_subsequences", f"with {READS} select read_id, substr(sequence, 3, 10) as inside, 'NN' || substr(sequence, 1, 5) as padded, length(sequence) + 3 as whole from r")
def subsequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("sequence")
    whole = F.length(sq.padded_subsequence(s, F.lit(1), F.length(s) + 3)).cast("bigint")
    return _reads(spark, sf_dir).select("read_id", sq.subsequence(s, F.lit(3), F.lit(12)).alias("inside"), sq.padded_subsequence(s, F.lit(-1), F.lit(5)).alias("padded"), whole.alias("whole"))


@query("F10_cigar", f"with {READS}, x as (select read_id, length(sequence) as n from r) select read_id, case when read_id % 3 = 0 then n + 2 when read_id % 3 = 1 then n - 5 else n end::int as span, n::int as length, case when read_id % 3 = 2 then 1 else 2 end::int as chunks from x")
def cigar(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = tx.parse_sam(_sam(spark, sf_dir), skip_unmapped=False)
    c = F.col("cigar")
    return s.select(F.col("read_id").cast("bigint").alias("read_id"), sq.cigar_span(c).alias("span"), sq.read_length(c).alias("length"), F.size(sq.matched_chunks(c, F.col("pos"))).alias("chunks"))


@query("F11_md_mismatches", f"with {READS} select read_id, '3A,12T' as mismatches from r")
def md_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = tx.parse_sam(_sam(spark, sf_dir), skip_unmapped=False)
    text = F.array_join(F.transform(sq.md_mismatches(F.col("md")), lambda x: F.concat(x["offset"].cast("string"), x["base"])), ",")
    return s.select(F.col("read_id").cast("bigint").alias("read_id"), text.alias("mismatches"))


@query("F12_read_names", "select p_partkey as k, 'r' || p_partkey as name from part")
def read_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), sq.read_name(F.concat(F.lit("@r"), "p_partkey", F.lit("/1 a comment"))).alias("name"))


@query("F16_checksums", "select doc_id, md5(coalesce(text, '')) as digest from documents")
def checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("digest"))


CALLED = f"""{SITES}, m as (select seq_id, 1 + k * 7 as start, translate(substr(sequence, 1 + k * 7, 40), case when k % 2 = 0 then 'C' else 'X' end, case when k % 2 = 0 then 'T' else 'X' end) as read
  from s, (select unnest(range(0, (select max(length) // 7 + 1 from s))) as k) where length >= 1 + k * 7), l as (select seq_id, start + i as pos, substr(read, i + 1, 1) as letter from (select *, unnest(range(0, length(read))) as i from m)),
called as (select l.seq_id, l.pos, count(*) filter (letter = 'C') as c, count(*) filter (letter = 'T') as t, any_value(z.context) as context from l join z on z.seq_id = l.seq_id and z.pos = l.pos and z.strand = '+' where letter in ('C', 'T') group by all)"""


def _called(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads of 40 letters at every seventh place over each sequence's whole length."""
    s = sequences(spark, sf_dir).where("length > 0")
    m = rd.tiled(s, 7, 40)
    return rd.call_methylation(m.withColumn("sequence", F.when(F.col("k") % 2 == 0, sq.c_to_t(F.col("sequence"))).otherwise(F.col("sequence"))), s, many=5)


@query("M1_methylation_caller", f"with {CALLED} select seq_id, pos::int as pos, c, t, context, c + t > 5 as starred from called")
def methylation_caller(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _called(spark, sf_dir).select("seq_id", F.col("pos").cast("int").alias("pos"), "c", "t", "context", "starred")


@query("M2_frequencies", f"with {CALLED} select context, coalesce(sum(c) filter (c + t <= 5), 0)::bigint as unflagged_c, coalesce(sum(t) filter (c + t <= 5), 0)::bigint as unflagged_t, sum(c)::bigint as c, sum(t)::bigint as t, count(*) as sites, round(sum(c) * 1.0 / (sum(c) + sum(t)), 6) as share from called group by 1")
def frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rd.frequencies(_called(spark, sf_dir))


@query("M4_context_windows", f"with {CALLED} select context, (ceil(pos / 50.0) * 50)::bigint as \"end\", sum(c)::bigint as c, sum(t)::bigint as t, count(*) as n from called group by 1, 2")
def context_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _called(spark, sf_dir).groupBy("context", window_end(F.col("pos"), 50).alias("end")).agg(F.sum("c").alias("c"), F.sum("t").alias("t"), F.count("*").alias("n"))


@query("M5_cytosine_sites", f"with {SITES} select seq_id, strand, context, count(*) as n, sum(pos)::bigint as positions from z group by all")
def cytosine_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rd.cytosines(sequences(spark, sf_dir)).groupBy("seq_id", "strand", "context").agg(F.count("*").alias("n"), F.sum("pos").alias("positions"))


@query("M7_triplet_counts", f"with {SITES} select tri as triplet, count(*) as n from z group by 1")
def triplet_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rd.cytosines(sequences(spark, sf_dir)).groupBy("triplet").agg(F.count("*").alias("n"))


@query("M8_confirmed_sites", f"with {SEQUENCES}, n as (select sum(length) as n, sum(length - length(translate(sequence, 'CG', ''))) as k from s) select is_site, (case when is_site then k else n - k end)::bigint as n from n, (select unnest([true, false]) as is_site)")
def confirmed_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8: every position of each sequence claimed, and checked against the bases."""
    s = sequences(spark, sf_dir)
    claims = s.where("length > 0").select("seq_id", F.explode(F.sequence(F.lit(1), F.col("length"))).alias("pos"))
    sites = rd.cytosines(s).select("seq_id", "pos").withColumn("hit", F.lit(True))
    return claims.join(sites, ["seq_id", "pos"], "left").groupBy(F.coalesce("hit", F.lit(False)).alias("is_site")).agg(F.count("*").alias("n"))


H = lambda salt: f"(('0x' || substr(md5('0:{salt}:' || o_orderkey), 1, 13))::bigint / 4503599627370496.0::double)"


@query(
    "M9_simulated_reads",
    f"""with {LENGTHS}, l as (select list(struct_pack(sequence, length) order by sequence, length) as s from n), r as (select o_orderkey, s[cast(floor({H(1)} * len(s)) as bigint) + 1] as x from orders, l)
select o_orderkey as read_id, x.sequence as sequence, cast(floor({H(2)} * (x.length - 99)) as int) + 1 as start, cast(floor({H(2)} * (x.length - 99)) as int) + 100 as "end", {H(3)} < 0.2::double as converted from r""",
)
def simulated_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9: a read for each order."""
    return rd.simulated_reads(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id")), lengths(spark, sf_dir), 100, 0.2)


@query("M10_is_bisulfite", f"with {READS} select sum(length(sequence) - length(replace(sequence, 'C', ''))) * 1.0 / sum(length(sequence)) < 0.125 as bisulfite from (select * from r order by read_id limit 10000)")
def is_bisulfite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rd.looks_bisulfite(_reads(spark, sf_dir).withColumnRenamed("read_id", "seq_id"))


@query("M11_trimmed_reads", f"with {READS} select read_id, case when position('GAT' in sequence) > 0 then substr(sequence, 1, position('GAT' in sequence) - 1) else sequence end as sequence from r")
def trimmed_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rd.trimmed(_reads(spark, sf_dir), "GAT")


@query("M11_missing_mates", f"with {READS} select read_id, case when read_id % 3 = 0 then 'a' else 'b' end as missing_in from r where (read_id % 3 = 0) <> (read_id % 4 = 0)")
def missing_mates(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _reads(spark, sf_dir)
    return rd.mates_agree(r.where("read_id % 3 <> 0"), r.where("read_id % 4 <> 0"))


@query("M12_fasta_tools", f"with {SEQUENCES} select seq_id, length::int as length, md5(reverse(translate(sequence, 'ACGT', 'TGCA'))) as rc, md5(replace(sequence, 'C', 'T')) as bs from s")
def fasta_tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, c = sequences(spark, sf_dir), F.col("sequence")
    return s.select("seq_id", "length", F.md5(sq.reverse_complement(c).cast("binary")).alias("rc"), F.md5(sq.c_to_t(c).cast("binary")).alias("bs"))


@query("M13_assembled_scaffolds", f"with {SEQUENCES}, p as (select seq_id // 4 as object, seq_id % 4 as part, case when seq_id % 2 = 0 then substr(sequence, 1, 50) else reverse(translate(substr(sequence, 1, 50), 'ACGT', 'TGCA')) end as x from s) select object::bigint as object, string_agg(x, 'NNN' order by part) as sequence from p group by 1")
def assembled_scaffolds(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sequences(spark, sf_dir)
    parts = s.select("seq_id", F.floor(F.col("seq_id") / 4).alias("object"), (F.col("seq_id") % 4).alias("part"), F.lit(1).alias("start"), F.lit(50).alias("end"), F.when(F.col("seq_id") % 2 == 0, "+").otherwise("-").alias("strand"))
    return rd.assembled(parts, s.select("seq_id", "sequence"), 3)


@query("M14_extracted_sequences", f"with {SEQUENCES} select seq_id * 2 + k as id, case when k = 0 then substr(sequence, 8, 25) else reverse(translate(substr(sequence, 8, 25), 'ACGT', 'TGCA')) end as bases from s, (select unnest([0, 1]) as k)")
def extracted_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sequences(spark, sf_dir)
    f = s.select("seq_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("k")).select("seq_id", (F.col("seq_id") * 2 + F.col("k")).alias("id"), F.lit(10).alias("start"), F.lit(30).alias("end"), F.when(F.col("k") == 0, "+").otherwise("-").alias("strand"))
    return rd.extracted(s, f, 2)


@query("M15_genome_diff", f"with {SEQUENCES}, x as (select seq_id, unnest([5, 17, 40]) as pos, sequence from s) select seq_id, pos::int as pos, substr(sequence, pos, 1) as ref, 'A' as alt from x where substr(sequence, pos, 1) not in ('', 'A')")
def genome_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A genome patched at three places, and the differences found again."""
    s = sequences(spark, sf_dir).select("seq_id", "sequence")
    snps = s.select("seq_id", F.explode(F.array(*(F.lit(i) for i in (5, 17, 40)))).alias("pos")).withColumn("alt", F.lit("A"))
    return rd.genome_diff(s, rd.patched(s, snps))


@query("M16_dictionary_coverage", f"with {LENGTHS}, d as (select sequence, length, k * 400 + 1 as lo, k * 400 + 350 as hi from n, (select unnest(range(0, 10)) as k)) select sequence, round(sum(hi - lo + 1) * 1.0 / max(length), 6) as covered from d group by 1")
def dictionary_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = lengths(spark, sf_dir).withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(9)))).select("sequence", "length", (F.col("k") * 400 + 1).alias("lo"), (F.col("k") * 400 + 350).alias("hi"))
    return d.groupBy("sequence").agg(F.round(F.sum(F.col("hi") - F.col("lo") + 1) / F.max("length"), 6).alias("covered"))


HITS = "a as (select l_partkey as read_id, min(l_linenumber) as m, max(l_suppkey) as q from lineitem where l_returnflag = 'A' group by 1), b as (select l_partkey as read_id, min(l_linenumber) as m, max(l_suppkey) as q from lineitem where l_returnflag = 'R' group by 1)"


def _hits(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    x = table(spark, sf_dir, "lineitem")
    one = lambda c: x.where(c).groupBy(F.col("l_partkey").alias("read_id")).agg(F.min("l_linenumber").alias("mismatches"), F.max("l_suppkey").alias("mapq"))
    return one("l_returnflag = 'A'"), one("l_returnflag = 'R'")


@query("J15_competition", f"with {HITS} select coalesce(a.read_id, b.read_id) as read_id, case when b.m is null or a.m < b.m then 'a' when a.m is null or b.m < a.m then 'b' else 'tie' end as winner from a full join b on a.read_id = b.read_id")
def competition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rd.competition(*_hits(spark, sf_dir))


@query("J16_sam_competition", f"with {HITS} select a.read_id, case when a.m < b.m then 'a' when a.m > b.m then 'b' when a.q > b.q then 'a' when a.q < b.q then 'b' when a.read_id % 2 = 0 then 'same' else 'differ' end as winner from a join b on a.read_id = b.read_id")
def sam_competition(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _hits(spark, sf_dir)
    other = F.when(F.col("read_id") % 2 == 0, "5A").otherwise("6A")
    return rd.sam_competition(a.withColumn("snps", F.array(F.lit("5A"), F.lit("7C"))), b.withColumn("snps", F.array(F.lit("7C"), other)))


#: Each order as a read pair, whose lines are matches: the first end's those that were returned for A, and odd ones of N.
MATES = """e as (select l_orderkey as read_id, case when l_returnflag = 'A' or (l_returnflag = 'N' and l_linenumber % 2 = 1) then 1 else 2 end as mate, 'c' || (l_suppkey % 3) as seqid,
  2600 as length, l_linenumber % 2 = 0 as reverse, (date_diff('day', date '1992-01-01', l_shipdate::date) + 1)::bigint as position, l_partkey % 4 as mismatches, l_linenumber, l_extendedprice from lineitem),
h as (select *, row_number() over (partition by read_id, mate order by seqid, reverse, position, mismatches) - 1 as i from e),
k as (select o_orderkey as read_id, count(*) filter (mate = 1) as n, count(*) filter (mate = 2) as m from orders left join e on o_orderkey = read_id group by 1)"""


def _mates(spark: SparkSession, sf_dir: str, mate: int) -> DataFrame:
    x = table(spark, sf_dir, "lineitem")
    first = (F.col("l_returnflag") == "A") | ((F.col("l_returnflag") == "N") & (F.col("l_linenumber") % 2 == 1))
    cells = F.struct(
        F.concat(F.lit("c"), F.col("l_suppkey") % 3).alias("seqid"), (F.col("l_linenumber") % 2 == 0).alias("reverse"),
        (F.datediff("l_shipdate", F.lit("1992-01-01")) + 1).cast("bigint").alias("position"), (F.col("l_partkey") % 4).alias("mismatches"), F.lit(2600).alias("length"),
    )
    found = x.where(first if mate == 1 else ~first).groupBy(F.col("l_orderkey").alias("read_id")).agg(F.array_sort(F.collect_list(cells)).alias("matches"))
    ids = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("read_id"))
    none = F.array().cast("array<struct<seqid:string,reverse:boolean,position:bigint,mismatches:bigint,length:int>>")
    return ids.join(found, "read_id", "left").select("read_id", F.lit(36).alias("size"), F.coalesce("matches", none).alias("matches"))


def _pick(count: str, mate: int) -> str:
    return f"('0x' || substr(md5('0:{mate}:' || k.read_id), 1, 8))::bigint % greatest({count}, 1)"


@query(
    "J17_paired_reads",
    f"""with {MATES},
p as (select l.read_id, abs(l.length - l.position + 1 - r.position) as gap, l.i as i, r.i as j from h l join h r on l.read_id = r.read_id and l.mate = 1 and r.mate = 2 and l.seqid = r.seqid and l.reverse <> r.reverse),
b as (select * from (select *, row_number() over (partition by read_id order by gap, i, j) as o from p where gap <= 2000) where o = 1),
c as (select k.*, i, j, coalesce(gap >= 100 or (n = 1 and m = 1 and gap is not null), false) as fit from k left join b using (read_id)),
w as (select read_id, 1 as mate, n, m, case when n = 0 then null when fit then i when n = 1 then 0 else {_pick('n', 1).replace('k.', '')} end as at, n > 1 and not fit as star from c
  union all select read_id, 2, n, m, case when m = 0 then null when fit then j when n = 0 and m = 1 then 0 when (m > 1 or n > 1) then {_pick('m', 2).replace('k.', '')} end, not fit and (m > 1 or (n > 1 and m = 1)) from c)
select w.read_id, w.mate::int as mate, case when n = 0 then 'NM' when n = 1 then 'U' else 'R' end || '/' || case when m = 0 then 'NM' when m = 1 then 'U' else 'R' end || case when star then '*' else '' end as class,
  h.seqid, h.position as start, (h.position + 35)::bigint as "end", case when h.reverse then '-' when not h.reverse then '+' end as strand, h.mismatches, (h.position is not null)::int as score
from w left join h on h.read_id = w.read_id and h.mate = w.mate and h.i = w.at""",
)
def paired_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rd.paired(_mates(spark, sf_dir, 1), _mates(spark, sf_dir, 2), 100, 1900, at_random=True, trust_second=True)


@query("J18_single_reads", f"with {MATES}, x as (select k.read_id, n, min(position) as p from k left join h on h.read_id = k.read_id and mate = 1 group by all) select read_id, case when n = 0 then 'NM' when n = 1 then 'U' else 'R' end as kind, case when n = 1 then p end as position from x")
def single_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rd.resolved(_mates(spark, sf_dir, 1), 3, at_random=False).select("read_id", "kind", "position")


@query("J19_read_lookup", f"with {READS} select read_id, sequence from r where read_id in (select l_partkey from lineitem where l_returnflag = 'R' and l_tax = 0)")
def read_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R' and l_tax = 0").select(F.concat(F.lit("@"), "l_partkey", F.lit("/1")).alias("h"))
    return _reads(spark, sf_dir).join(ids.select(sq.read_name(F.col("h")).cast("bigint").alias("read_id")).distinct(), "read_id", "left_semi")


@query("O4_reads_in_order", "select p_brand as read_id, min(p_partkey) as first from part group by 1")
def reads_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rd.ordered_reads(table(spark, sf_dir, "part").select(F.col("p_brand").alias("read_id"), F.col("p_partkey").alias("first")))


@query("P22_sam_filter", f"with {READS}, x as (select *, length(sequence) as n, (read_id % 5) * 4 as flag from r) select (read_id + 1)::bigint as start, count(*) as n from x where flag & 4 = 0 and read_id % 40 >= 20 and read_id % 2 = 1 group by 1")
def sam_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = tx.parse_sam(_sam(spark, sf_dir)).where("mapq >= 20 and seqid = 's2'")
    return s.groupBy(F.col("pos").alias("start")).agg(F.count("*").alias("n"))


@query("P23_reads_in_region", f"with {READS} select read_id, (read_id % 9 + read_id - 100)::bigint as position from r where read_id between 100 and 400")
def reads_in_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mismatch positions of the reads of a region, counted from its start."""
    k = F.col("read_id")
    text = _reads(spark, sf_dir).select(F.concat_ws("\t", k.cast("string"), F.lit("+"), F.lit("s1"), (k - 1).cast("string"), "sequence", F.lit("I"), F.lit("0"), F.concat((k % 9).cast("string"), F.lit(":A>G"))).alias("value"))
    b = tx.parse_bowtie(text).where(F.col("start").between(100, 400))
    return b.select(F.col("read_id").cast("bigint").alias("read_id"), (F.explode(F.transform("mismatches", lambda m: m["offset"] + F.col("start") - 100))).alias("position"))
