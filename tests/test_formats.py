"""Literals of parsers, writers and functions on sequences."""

import math
import random
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from strandloom.functions import attributes as at
from strandloom.functions import sequence as sq
from strandloom.operators import align as al
from strandloom.operators import rangejoin as rj
from strandloom.operators import reads as rd
from strandloom.operators import stats as st
from strandloom.sources import sinks as sk
from strandloom.sources import text as tx
from tests.conftest import rows


def lines(spark, *items):
    return spark.createDataFrame([(x,) for x in items], "value string")


def one(df, column):
    return df.select(column.alias("x")).first().x


def test_feature_lines(spark):
    text = lines(spark, "##gff", "", "# c", "chr1\ts\texon\t1\t9\t.\t+\t.\tID=a;b;b=2;c=\"q\"*", "chr1\tshort", ".\ts\texon\t9\t1\t0.5\t.\t.\t.")
    f = tx.with_attributes(tx.parse_features(text)).orderBy("score").collect()
    assert [(r.sequence, r.start, r.end, r.score, r.strand) for r in f] == [("CHR1", 1, 9, None, "+"), (None, 9, 1, 0.5, None)]
    assert f[0].attributes == {"ID": "a", "Note": "b", "b": "2", "c": "q"} and f[0].asterisk and f[1].attributes is None
    assert tx.parse_features(text, launder=True).count() == 1
    assert tx.rejected_features(text).count() == 1
    assert rows(tx.spliced(text, ["feature", "ID"]).where("ID is not null")) == [("exon", "a")]
    back = sk.feature_lines(tx.parse_features(text, "keep").where("score = 0.5")).first().value
    assert back == ".\ts\texon\t9\t1\t0.5000\t.\t.\t."


def test_last_attribute_wins_and_order(spark):
    df = lines(spark, "k=1; k=2;z=9")
    assert one(df, at.attribute_map(F.col("value"))) == {"k": "2", "z": "9"}
    assert one(df, at.attribute_string(at.attribute_map(F.col("value")))) == "k=2;z=9"
    assert one(df, at.attribute(F.col("value"), "absent")) is None


def test_fasta_round_trip(spark, tmp_path):
    path = str(tmp_path / "x.fa")
    with open(path, "w") as f:
        f.write(">chr1 first\nACGT\nACG\n>chr2\nGG\n")
    assert rows(tx.read_fasta(spark, path)) == [("CHR1", "chr1 first", "ACGTACG", 7), ("CHR2", "chr2", "GG", 2)]
    df = spark.createDataFrame([("a", "ACGTAC")], "seq_id string, sequence string")
    assert sk.fasta_lines(df, 4).first().value == ">a\nACGT\nAC"


def test_features_written_and_read(spark, tmp_path):
    df = spark.createDataFrame([("CHR1", 1, 5, 0.25)], "sequence string, start long, end long, score double")
    sk.write_features(df, str(tmp_path / "f"))
    got = tx.parse_features(tx.lines(spark, str(tmp_path / "f")))
    assert rows(got.select("sequence", "start", "end", "score")) == [("CHR1", 1, 5, 0.25)]
    sk.write_split(df, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s" / "sequence=CHR1")).count() == 1


def test_sam(spark):
    text = lines(spark, "@SQ\tSN:c\tLN:9", "r/1\t16\tRC_c\t2\t30\t2M1I3M\t*\t0\t0\tACGTAC\tIIIIIJ\tNM:i:1\tMD:Z:5", "u\t4\t*\t0\t0\t*\t*\t0\t0\tA\tI")
    s = tx.parse_sam(text)
    r = s.first()
    assert (s.count(), r.seqid, r.pos, r.rightmost, r.reverse, r.nm, r.md, r.xm) == (1, "c", 2, 6, False, 1, "5", None)
    f = tx.sam_forward(s, spark.createDataFrame([("c", 9)], "sequence string, length int")).first()
    assert (f.pos, f.rightmost, f.sequence, f.quality) == (4, 8, "GTACGT", "JIIIII")
    assert tx.sam_header(text).first().tags == {"SN": "c", "LN": "9"}


def test_cigar_and_md(spark):
    df = lines(spark, "3S4M2D1I5M")
    chunks = one(df, sq.matched_chunks(F.col("value"), F.lit(10)))
    assert [tuple(c) for c in chunks] == [(4, 10, 4), (9, 16, 5)]
    assert one(df, sq.cigar_span(F.col("value"))) == 11 and one(df, sq.read_length(F.col("value"))) == 13
    assert [tuple(x) for x in one(lines(spark, "3A0T2^GG1C"), sq.md_mismatches(F.col("value")))] == [(3, "A"), (4, "T"), (10, "C")]
    assert one(lines(spark, "x"), sk.md_tag(F.lit("ACGT"), F.lit("ATGT"))) == "1T2"


def test_sequence_functions(spark):
    df = lines(spark, "ACGTNR")
    assert one(df, sq.reverse_complement(F.col("value"))) == "YNACGT"
    assert one(df, sq.padded_subsequence(F.col("value"), F.lit(-1), F.lit(2))) == "NNAC"
    assert one(df, sq.padded_subsequence(F.col("value"), F.lit(5), F.lit(8))) == "NRNN"
    assert one(df, sq.subsequence(F.col("value"), F.lit(9), F.lit(12))) == ""
    assert one(df, sq.hamming(F.col("value"), F.lit("ACGA"))) == 3
    assert one(df, sq.common_prefix_length(F.col("value"), F.lit("ACCC"))) == 2
    for tri, want in (("CGA", "CG"), ("CAG", "CHG"), ("CAT", "CHH"), ("C", "CHH"), ("GAT", None)):
        assert one(df, sq.context(F.lit(tri))) == want
    assert one(df, sq.read_name(F.lit("@r1/2 x"))) == "r1"


def test_other_formats(spark):
    e = tx.parse_eland(lines(spark, "r1\tACGT\t1:0:1\tc:5F0,RC_d:7F2", "r2\tAC\tNM\t")).orderBy("read_id").collect()
    assert [(m.seqid, m.position, m.reverse, m.mismatches) for m in e[0].matches] == [("c", 5, False, 0), ("d", 7, True, 2)] and e[0].counts == [1, 0, 1] and e[1].matches == []
    b = tx.parse_bowtie(lines(spark, "r\t-\tc\t4\tACGT\tIIII\t0\t2:A>G")).first()
    assert (b.start, b.mismatches[0].offset, b.mismatches[0].alt) == (5, 2, "G")
    j = tx.parse_junctions(lines(spark, "c\t10\t100\tj\t5\t+\t0\t0\t0\t2\t7,9\t0,81"))
    assert rows(j.select("feature", "start", "end")) == [("block", 11, 17), ("block", 92, 100), ("junction", 11, 100)]
    w = spark.createDataFrame([("variableStep chrom=c span=5", 0), ("3 1.5", 1), ("variableStep chrom=d", 2), ("9 2", 3)], "value string, line int")
    assert rows(tx.parse_wiggle(w)) == [("c", 3, 7, 1.5), ("d", 9, 9, 2.0)]
    assert one(lines(spark, 'gene_id "a b"; n "2";'), tx.gtf_attributes(F.col("value"))) == "gene_id=a b;n=2"
    assert one(lines(spark, "0 40 2"), tx.integer_qualities(F.col("value"))) == "!I#"
    assert one(lines(spark, "h@;"), tx.solexa_to_phred(F.col("value"))) == chr(73) + chr(36) + chr(34)
    q = tx.qseq_to_fastq(lines(spark, "M\tr\t1\t2\t3\t4\t0\t1\tA.G\tIII\t0")).first()
    assert (q.read_id, q.sequence) == ("M:1:2:3:4#0/1", "ANG")
    c = tx.parse_correlated(lines(spark, "c\tU/NM\tr:ACT\t5\t7\t1\t+\t0\ttarget=AAACCGG", "c\tU\tr:ACT\t5\t7\t1\t+\t0\ttarget=AC"), True)
    assert rows(c.select("read_id", "read", "target")) == [("r", "ACT", "AAACCGG")]


def test_caller_against_simulated_reads(spark):
    genome = spark.createDataFrame([("c", "ACGTCCGATTCAGCATCGGA" * 6)], "seq_id string, sequence string")
    sim = rd.simulated_reads(spark.range(400), spark.createDataFrame([("c", 120)], "sequence string, length int"), 30, 0.3)
    assert rows(sim) == rows(rd.simulated_reads(spark.range(400), spark.createDataFrame([("c", 120)], "sequence string, length int"), 30, 0.3))
    whole = sim.join(genome.select(F.col("sequence").alias("g")), F.lit(True))
    part = F.expr("substring(g, start, 30)")
    reads = whole.select(F.lit("c").alias("seq_id"), "start", F.when(F.col("converted"), sq.c_to_t(part)).otherwise(part).alias("sequence"))
    called, text = rd.call_methylation(reads, genome).collect(), "ACGTCCGATTCAGCATCGGA" * 6
    truth = {}
    for r in sim.collect():
        assert 1 <= r.start <= 91
        for p in range(r.start, r.start + 30):
            if text[p - 1] == "C":
                truth.setdefault(p, [0, 0])[r.converted] += 1
    assert {r.pos: [r.c, r.t] for r in called} == truth


def test_pairs_and_competition(spark):
    kind = "read_id string, matches array<struct<seqid:string,position:long>>"
    left = spark.createDataFrame([("a", [("c", 10), ("c", 90)]), ("b", [("c", 5)]), ("d", [])], kind)
    assert {r.read_id: r.kind for r in rd.resolved(left, 2).collect()} == {"a": "R", "b": "U", "d": "NM"}


def test_pairs_of_reads(spark):
    """The nine cases: a sequence of 1000 bases, reads of 10; /2 lies on the other strand, so its place is mirrored."""
    kind = "read_id string, size int, matches array<struct<seqid:string,length:int,reverse:boolean,position:long,mismatches:int>>"
    at = lambda position, reverse=False, mm=0, seqid="c": (seqid, 1000, reverse, position, mm)
    cases = {  # read: matches of /1, matches of /2
        "none": ([], []),
        "fit": ([at(101)], [at(850, True, 2)]),  # 1000 - 101 + 1 = 900, 50 apart
        "near": ([at(101)], [at(899, True)]),  # under the offset, which counts for several matches only
        "far": ([at(101)], [at(100, True, 1)]),
        "same": ([at(101)], [at(850)]),  # the same strand
        "first": ([at(7, True, 3)], []),
        "second": ([], [at(8)]),
        "several first": ([at(1), at(2)], []),
        "several second": ([], [at(1), at(2), at(3)]),
        "one several": ([at(101)], [at(500, True), at(870, True), at(860, True), at(870, True, 9)]),
        "one none of several": ([at(101)], [at(1), at(2)]),
        "several one": ([at(900), at(101, False, 1)], [at(850, True)]),
        "several none of one": ([at(900), at(901)], [at(850, True, seqid="d")]),
        "several several": ([at(500), at(101)], [at(20, True), at(850, True), at(470, True)]),
        "too near": ([at(101), at(700)], [at(899, True), at(850, True)]),
    }
    left, right = (spark.createDataFrame([(k, 10, v[i]) for k, v in cases.items()], kind) for i in (0, 1))
    cells = lambda r: None if r.start is None else (r.start, r.end, r.strand, r.mismatches)

    def run(**options):
        out = {k: [None, None] for k in cases}
        for r in rd.paired(left, right, 20, 80, **options).collect():
            out[r.read_id][r.mate - 1] = (r["class"], cells(r), r.score)
        return out

    plus, minus = lambda p, mm=0: (p, p + 9, "+", mm), lambda p, mm=0: (p, p + 9, "-", mm)
    got = run()
    assert got == {
        "none": [("NM/NM", None, 0)] * 2,
        "fit": [("U/U", plus(101), 1), ("U/U", minus(850, 2), 1)],
        "near": [("U/U", plus(101), 1), ("U/U", minus(899), 1)],
        "far": [("U/U", plus(101), 1), ("U/U", None, 0)],
        "same": [("U/U", plus(101), 1), ("U/U", None, 0)],
        "first": [("U/NM", minus(7, 3), 1), ("U/NM", None, 0)],
        "second": [("NM/U", None, 0), ("NM/U", None, 0)],
        "several first": [("R/NM", None, 2), ("R/NM", None, 0)],
        "several second": [("NM/R", None, 0), ("NM/R", None, 3)],
        "one several": [("U/R", plus(101), 1), ("U/R", minus(870), 1)],
        "one none of several": [("U/R", plus(101), 1), ("U/R", None, 0)],
        "several one": [("R/U", plus(101, 1), 1), ("R/U", minus(850), 1)],
        "several none of one": [("R/U", None, 0), ("R/U", None, 0)],
        "several several": [("R/R", plus(500), 1), ("R/R", minus(470), 1)],
        "too near": [("R/R", None, 0), ("R/R", None, 0)],
    }
    trusting = run(trust_second=True)
    assert trusting.pop("second") == [("NM/U", None, 0), ("NM/U", plus(8), 1)]
    assert all(trusting[k] == got[k] for k in trusting)
    drawn = run(at_random=True, trust_second=True, seed=3)
    assert drawn == run(at_random=True, trust_second=True, seed=3)
    assert drawn["several first"][0][0] == "R/NM*" and drawn["several first"][0][1] in (plus(1), plus(2))
    assert drawn["several second"][1][0] == "NM/R*" and drawn["several second"][1][1] in (plus(1), plus(2), plus(3))
    assert drawn["one none of several"][0] == ("U/R", plus(101), 1) and drawn["one none of several"][1][0] == "U/R*"
    assert [x[0] for x in drawn["several none of one"]] == ["R/U*"] * 2 and drawn["several none of one"][1][1] == minus(850)
    assert [x[0] for x in drawn["too near"]] == ["R/R*"] * 2 and all(x[1] for x in drawn["too near"])
    same = {r.read_id for r in rd.paired(left, right, 0, 800, single_ends=True).where("mate = 2 and start is not null").collect()}
    assert same == {"same", "one none of several"}
    g = spark.createDataFrame([("c", "ACGTTGCAAC" * 100)], "seq_id string, sequence string")
    t = {(r.read_id, r.mate): r.target for r in rd.targets(rd.paired(left, right, 20, 80), g).collect()}
    text = "ACGTTGCAAC" * 100
    other = text.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    assert t["fit", 1] == text[98:112] and t["fit", 2] == other[847:861] and ("second", 2) not in t


def test_lookups_by_place(spark):
    """Features of any place of a long sequence, patches and differences, against plain slices."""
    rng = random.Random(3)
    text = {i: "".join(rng.choices("ACGT", k=n)) for i, n in enumerate((1000, 128, 129, 1, 0))}
    g = spark.createDataFrame(list(text.items()), "seq_id long, sequence string")
    f = [(k, rng.randrange(6), (s := rng.randrange(-5, 1100)), s + rng.choice([0, 5, 130, 400, -1]), rng.choice("+-")) for k in range(200)]
    got = {r.id: r.bases for r in rd.extracted(g, spark.createDataFrame(f, "id long, seq_id long, start long, end long, strand string"), 2).collect()}
    turned = lambda x: x.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    want = {k: (turned if d == "-" else str)(text[i][max(0, s - 3) : max(0, e + 2)]) for k, i, s, e, d in f if i in text}
    assert got == want
    snps = [(rng.randrange(5), rng.randrange(1, 1100), rng.choice("ACGT")) for _ in range(80)]
    snps = list({(i, p): (i, p, a) for i, p, a in snps}.values())
    p = rd.patched(g, spark.createDataFrame(snps, "seq_id long, pos int, alt string"))
    new = {i: list(t) for i, t in text.items()}
    for i, at, alt in snps:
        if at <= len(new[i]):
            new[i][at - 1] = alt
    assert rows(p) == sorted((i, "".join(t)) for i, t in new.items())
    assert rows(rd.genome_diff(g, p)) == sorted((i, at, text[i][at - 1], alt) for i, at, alt in snps if at <= len(text[i]) and text[i][at - 1] != alt)


def test_liftover_and_nearest_plans(spark):
    d = spark.createDataFrame([("c", 1, 100, 501), ("c", 150, 200, 1)], "sequence string, from_start int, from_end int, to_start int")
    df = spark.createDataFrame([(1, "c", 10, 20), (2, "c", 90, 160), (3, "c", 10, 120), (4, "x", 5, 6), (5, None, 7, 8), (6, "c", None, 5)], "id int, sequence string, start int, end int")
    out = rj.lifted(df, d)
    assert sorted((r.id, r.start, r.end) for r in out.collect()) == [(1, 510, 520), (2, 590, 11), (4, 5, 6), (5, 7, 8)]
    plan = out._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and plan.count("_abin") > 0
    assert "unboundedfollowing" not in rj.nearest(df, df)._jdf.queryExecution().toString().lower()


def test_alignment_of_tables(spark):
    kind = "sequence string, start int, score double"
    a, b = spark.createDataFrame([("C", 1, 4.0), ("c", 2, 0.0)], kind), spark.createDataFrame([("c", 1, 2.0), ("c", 9, 3.0)], kind)
    assert rows(al.subtracted(a, b)) == [("c", 1, 2.0), ("c", 2, 0.0), ("c", 9, -3.0)]
    assert rows(al.arithmetic(a, b, "methyl(a, b)", zero=False).select("start", F.round("score", 4))) == [(1, 0.6667)]
    assert rows(al.arithmetic(a, b, "div(a, b)").where("start = 2").select("score")) == [(None,)]
    for bad in ("a; drop", "system(a)", "a / b"):
        with pytest.raises(ValueError):
            al.expression(bad)
    wide = al.mashup({"x": a.select(F.lower("sequence").alias("sequence"), "start", "score"), "y": b}, ["sequence", "start"], ["score"])
    assert sorted(rows(wide), key=str) == sorted([("c", 1, 4.0, 2.0), ("c", 2, 0.0, None), ("c", 9, None, 3.0)], key=str)
    assert al.unmashed(wide, ["sequence", "start"]).count() == 4


def test_statistics(spark):
    df = spark.createDataFrame([(3.0, 1.0, 1.0, 3.0)], "a double, b double, c double, d double")
    f = {k: one(df, v) for k, v in st.fisher(*(F.col(x) for x in "abcd")).items()}
    assert f == pytest.approx({"left": 69 / 70, "right": 17 / 70, "two": 34 / 70})
    assert one(df, st.two_by_two(*(F.col(x) for x in "abcd"))["x2"]) == pytest.approx(2.0)
    x = spark.createDataFrame([(0.0,), (1.0,), (math.e,), (math.e**2,)], "v double")
    n = NormalDist(1, 1)
    assert min(r.v for r in st.without_zeros(x, "v").collect()) == pytest.approx(math.exp(n.inv_cdf(n.cdf(0) / 2)))
    h = spark.createDataFrame([("g", v, k) for v, k in ((1, 5), (2, 4), (3, 1))], "g string, v int, k int")
    assert rows(st.histogram_percentiles(h, ["g"], "v", "k", [0.25, 0.5, 0.95])) == [("g", 1, 2, 3)]
    assert one(df, st.ln_gamma(F.lit(171.0))) == pytest.approx(math.lgamma(171))


def test_genome_patch_and_diff(spark):
    g = spark.createDataFrame([("c", "ACGT"), ("d", "")], "seq_id string, sequence string")
    snps = spark.createDataFrame([("c", 2, "T"), ("c", 99, "A")], "seq_id string, pos int, alt string")
    p = rd.patched(g, snps)
    assert rows(p) == [("c", "ATGT"), ("d", "")]
    assert rows(rd.genome_diff(g, p)) == [("c", 2, "C", "T")]
    assert rows(rd.match_positions(g, "AC")) == [("c", 1, 2, "+"), ("c", 3, 4, "-")]


def test_split_of_many_values_writes_a_file_each(spark, tmp_path):
    df = spark.range(0, 400, 1, 8).select("id", F.concat(F.lit("s"), F.col("id") % 50).alias("sequence"))
    odd = F.element_at(F.array(*map(F.lit, ["a/b=c", "100%", "é {x}", "[q]^?"])), (F.col("id") / 3).cast("int") + 1)
    df = df.withColumn("sequence", F.when(F.col("id") >= 20, F.col("sequence")).when(F.col("id") < 12, odd))  # and nulls
    sk.write_split_many(df, str(tmp_path / "s"))
    folders = [x for x in (tmp_path / "s").iterdir() if x.is_dir()]
    assert len(folders) == 55 and all(len(list(x.glob("*.parquet"))) == 1 for x in folders)
    assert rows(spark.read.parquet(str(tmp_path / "s")).select(*df.columns)) == rows(df)


def test_values_of_many_rows_are_dealt_to_several_tasks(spark):
    df = spark.range(0, 4000, 1, 8).select("id", F.when(F.col("id") % 4 > 0, "s").alias("sequence"))
    out = sk.together(df, "sequence", 300)
    assert rows(out) == rows(df)
    parts = out.select("sequence", F.spark_partition_id().alias("p")).distinct().groupBy("sequence").count().collect()
    assert len(parts) == 2 and all(r["count"] > 1 for r in parts)
