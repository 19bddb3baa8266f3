"""Readers of line formats: every parser takes lines (a column ``value``) and gives typed rows.

``lines(spark, path)`` reads any Hadoop path, compressed by extension too (S25), also whole folders (S27).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandloom.functions import attributes as at
from strandloom.functions import sequence as sq

FEATURE_COLUMNS = ("sequence", "source", "feature", "start", "end", "score", "strand", "frame", "attribute_string")


def lines(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> DataFrame:
    """Lines of files; with a pattern, of all files below the path whose names fit it."""
    reader = spark.read
    if pattern is not None:
        reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    return reader.text(path)


def _cells(text: Column) -> Column:
    """D3: array of tab-separated cells, '.' and the empty string being null."""
    return F.transform(F.split(text, "\t"), lambda x: F.when(~x.isin(".", ""), x))


def _is_row(value: Column) -> Column:
    return ~value.startswith("#") & (F.trim(value) != "")


def parse_features(df: DataFrame, case: str = "upper", launder: bool = False) -> DataFrame:
    """The nine columns; comments, blank lines and lines with other than nine columns are left out.

    case: upper, lower or keep for sequence names. launder keeps only rows with numbers start <= end.
    """
    rows = df.where(_is_row(F.col("value"))).select(_cells(F.regexp_replace("value", "\r$", "")).alias("p")).where(F.size("p") == 9)
    cells = dict(zip(FEATURE_COLUMNS, (F.get("p", F.lit(i)) for i in range(9)), strict=True))
    cells["sequence"] = {"upper": F.upper, "lower": F.lower, "keep": lambda c: c}[case](cells["sequence"])
    cells["start"], cells["end"], cells["score"] = cells["start"].try_cast("bigint"), cells["end"].try_cast("bigint"), cells["score"].try_cast("double")
    out = rows.select(*(c.alias(n) for n, c in cells.items()))
    return out.where("start <= end") if launder else out


def rejected_features(df: DataFrame) -> DataFrame:
    """Lines that are rows but have other than nine columns."""
    return df.where(_is_row(F.col("value")) & (F.size(F.split("value", "\t")) != 9))


def with_attributes(df: DataFrame) -> DataFrame:
    """Adds the map ``attributes`` and ``asterisk``."""
    return df.withColumn("attributes", at.attribute_map(F.col("attribute_string"))).withColumn("asterisk", at.asterisk(F.col("attribute_string")))


def spliced(df: DataFrame, columns: list[str]) -> DataFrame:
    """S3: only the named columns; names that are none of the nine are attributes, found by pattern."""
    parts = _cells(F.col("value"))
    cell = lambda c: F.get(parts, F.lit(FEATURE_COLUMNS.index(c))) if c in FEATURE_COLUMNS else at.attribute(F.get(parts, F.lit(8)), c)
    return df.where(_is_row(F.col("value"))).select(*(cell(c).alias(c) for c in columns))


def parse_correlated(df: DataFrame, conversion_only: bool = False) -> DataFrame:
    """read_id, sequence, start, end, reverse, read, target of matched rows whose target has two bases more on each side.

    conversion_only: under a quarter of a read's bases may differ from the target otherwise than C read as T.
    """
    f = parse_features(df, "keep").where("sequence is not null")
    read = F.regexp_extract("feature", r":([A-Za-z]+)$", 1)
    out = f.select(F.regexp_extract("feature", r"^(.*):[A-Za-z]+$", 1).alias("read_id"), "sequence", "start", "end", (F.col("strand") == "-").alias("reverse"), F.upper(read).alias("read"), F.upper(at.attribute(F.col("attribute_string"), "target")).alias("target"))
    out = out.where(F.length("target") == F.length("read") + 4)
    if conversion_only:
        inner = F.split(F.substring("target", F.lit(3), F.length("read")), "")
        other = F.zip_with(F.split("read", ""), inner, lambda r, t: F.when((r == t) | ((r == "T") & (t == "C")), 0).otherwise(1))
        out = out.where(F.aggregate(other, F.lit(0), lambda n, x: n + x) * 4 < F.length("read"))
    return out


def slurped(df: DataFrame, column: str) -> DataFrame:
    """Rows of each value of a column in one array, in order of start."""
    rest = [c for c in df.columns if c != column]
    return df.groupBy(column).agg(F.array_sort(F.collect_list(F.struct("start", *(c for c in rest if c != "start")))).alias("rows"))


def numbered(df: DataFrame, order: list[str]) -> DataFrame:
    """Rows with a number from 0 in a total order, dealt by ranges so that no task orders all."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id())
    sizes = ranged.groupBy("_p").agg(F.count("*").alias("n"), F.min("_i").alias("low"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("_p", (before - F.col("low")).alias("_by"))
    return ranged.join(F.broadcast(sizes), "_p").withColumn("row", F.col("_i") + F.col("_by")).drop("_p", "_i", "_by")


def records(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """Records between separators (``lineSep``) as ``value``."""
    return spark.read.option("lineSep", separator).text(path)


def parse_fasta(df: DataFrame) -> DataFrame:
    """seq_id (upper case), original_name, sequence, length from records that were split at a line's '>'."""
    value = F.regexp_replace("value", "^>", "")
    head, body = F.regexp_extract(value, r"^([^\n\r]*)", 1), F.regexp_replace(F.regexp_replace(value, r"^[^\n\r]*", ""), r"\s", "")
    out = df.where(F.trim("value") != "").select(F.upper(F.regexp_extract(head, r"^(\S*)", 1)).alias("seq_id"), F.trim(head).alias("original_name"), body.alias("sequence"))
    return out.withColumn("length", F.length("sequence"))


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    return parse_fasta(records(spark, path, "\n>"))


def parse_fastq(df: DataFrame) -> DataFrame:
    """read_id, sequence, quality from records of four lines that start with '@' and were split at '\\n@'.

    A quality line may start with '@' too: such a piece has no three lines after it, and is joined to the one before.
    """
    p = F.split(F.regexp_replace(F.regexp_replace("value", "^@", ""), "\r", ""), "\n")
    rows = df.where(F.trim("value") != "").select(p.alias("p"))
    return rows.where(F.size("p") >= 3).select(sq.read_name(F.get("p", F.lit(0))).alias("read_id"), F.get("p", F.lit(1)).alias("sequence"), F.get("p", F.lit(3)).alias("quality"))


def fastq_from_lines(df: DataFrame, line: str = "line") -> DataFrame:
    """The same from numbered lines (value, line from 0): four lines a record, whatever they start with."""
    k, i = F.floor(F.col(line) / 4), F.col(line) % 4
    cells = [F.max(F.when(i == j, F.col("value"))).alias(n) for j, n in ((0, "header"), (1, "sequence"), (3, "quality"))]
    return df.groupBy(k.alias("record")).agg(*cells).withColumn("read_id", sq.read_name(F.col("header"))).drop("header")


def parse_sam(df: DataFrame, skip_unmapped: bool = True) -> DataFrame:
    """The eleven columns and MD, NM, XM; leftmost and rightmost; contigs RC_* mapped to the forward strand's name.

    Works on a stream of lines as well.
    """
    p = F.split("value", "\t")
    tag = lambda t: F.nullif(F.regexp_extract("value", rf"\t{t}:[AifZH]:([^\t]*)", 1), F.lit(""))
    names = ("read_id", "flag", "seqid", "pos", "mapq", "cigar", "next_seqid", "next_pos", "tlen", "sequence", "quality")
    kinds = {"flag": "int", "pos": "bigint", "mapq": "int", "next_pos": "bigint", "tlen": "bigint"}
    cells = [(F.get(p, F.lit(i)).try_cast(kinds[n]) if n in kinds else F.get(p, F.lit(i))).alias(n) for i, n in enumerate(names)]
    out = df.where(~F.col("value").startswith("@") & (F.size(p) >= 11)).select(*cells, tag("MD").alias("md"), tag("NM").cast("int").alias("nm"), tag("XM").cast("int").alias("xm"))
    if skip_unmapped:
        out = out.where(F.col("flag").bitwiseAND(F.lit(4)) == 0)
    out = out.withColumn("on_rc", F.col("seqid").startswith("RC_")).withColumn("seqid", F.regexp_replace("seqid", "^RC_", ""))
    out = out.withColumn("reverse", (F.col("flag").bitwiseAND(F.lit(16)) != 0) != F.col("on_rc"))
    return out.withColumn("rightmost", F.col("pos") + sq.cigar_span(F.col("cigar")) - 1)


def sam_forward(df: DataFrame, lengths: DataFrame) -> DataFrame:
    """Rows of RC_* contigs with coordinates on the forward strand, bases reversed and complemented, qualities reversed."""
    out = df.join(lengths.select(F.col("sequence").alias("seqid"), F.col("length").alias("_n")), "seqid", "left")
    flip, n = F.col("on_rc"), F.col("_n")
    pos, right = F.when(flip, n - F.col("rightmost") + 1).otherwise(F.col("pos")), F.when(flip, n - F.col("pos") + 1).otherwise(F.col("rightmost"))
    out = out.withColumns({"pos": pos, "rightmost": right})
    return out.withColumn("sequence", F.when(flip, sq.reverse_complement(F.col("sequence"))).otherwise(F.col("sequence"))).withColumn("quality", F.when(flip, F.reverse("quality")).otherwise(F.col("quality"))).drop("_n")


def sam_header(df: DataFrame) -> DataFrame:
    """Kind (HD, SQ, PG) and map of tags of header lines."""
    v = F.col("value")
    tags = F.filter(F.transform(F.split(v, "\t"), lambda t: F.struct(F.substring(t, 1, 2).alias("k"), F.substring(t, 4, 1 << 20).alias("v"))), lambda x: ~x["k"].startswith("@"))
    return df.where(v.rlike("^@[A-Z]{2}\t")).select(F.substring(v, 2, 2).alias("kind"), F.map_from_entries(tags).alias("tags"))


def parse_bowtie(df: DataFrame, base: int = 1) -> DataFrame:
    """read_id, strand, seqid, start (rebased), read, quality, count, mismatches (offset, ref, alt)."""
    p = F.split("value", "\t")
    cell = lambda i: F.get(p, F.lit(i))
    part = F.regexp_extract_all(F.coalesce(cell(7), F.lit("")), F.lit(r"(\d+:[A-Z]>[A-Z])"), 1)
    mm = F.transform(part, lambda x: F.struct(F.regexp_extract(x, r"^(\d+)", 1).cast("int").alias("offset"), F.regexp_extract(x, ":(.)>", 1).alias("ref"), F.regexp_extract(x, ">(.)", 1).alias("alt")))
    return df.where(F.size(p) >= 7).select(cell(0).alias("read_id"), cell(1).alias("strand"), cell(2).alias("seqid"), (cell(3).cast("bigint") + base).alias("start"), cell(4).alias("read"), cell(5).alias("quality"), cell(6).cast("int").alias("count"), mm.alias("mismatches"))


def parse_eland(df: DataFrame) -> DataFrame:
    """read_id, sequence, counts (array; null for NM), matches (seqid, position, reverse, mismatches)."""
    p = F.split("value", "\t")
    cell = lambda i: F.coalesce(F.get(p, F.lit(i)), F.lit(""))
    counts = F.when(cell(2).rlike(r"^\d+(:\d+)*$"), F.transform(F.split(cell(2), ":"), lambda x: x.cast("int")))
    hits = F.filter(F.split(cell(3), ","), lambda x: x.rlike(r":\d+[FR]"))
    m = F.transform(hits, lambda x: F.struct(F.regexp_extract(x, r"^(?:RC_)?(.*):\d+[FR]", 1).alias("seqid"), F.regexp_extract(x, r":(\d+)[FR]", 1).cast("bigint").alias("position"), (x.startswith("RC_") != F.regexp_extract(x, r":\d+([FR])", 1).eqNullSafe(F.lit("R"))).alias("reverse"), F.regexp_extract(x, r"[FR](\d+)$", 1).try_cast("int").alias("mismatches")))
    return df.where(F.size(p) >= 3).select(cell(0).alias("read_id"), cell(1).alias("sequence"), counts.alias("counts"), m.alias("matches"))


def eland_features(df: DataFrame) -> DataFrame:
    """A feature row for each match of parsed Eland rows (end = start + length - 1)."""
    rows = df.select("read_id", "sequence", F.explode("matches").alias("m"))
    return rows.select(F.col("m.seqid").alias("sequence"), F.concat_ws(":", "read_id", "sequence").alias("feature"), F.col("m.position").alias("start"), (F.col("m.position") + F.length("sequence") - 1).alias("end"), F.when(F.col("m.reverse"), "-").otherwise("+").alias("strand"))


def parse_agp(df: DataFrame) -> DataFrame:
    """Object, object_start, object_end, part, type, then the component (or gap) and its range."""
    p = F.split("value", "\t")
    cell = lambda i: F.get(p, F.lit(i))
    gap = cell(4).isin("N", "U")
    return df.where(_is_row(F.col("value")) & (F.size(p) >= 5)).select(
        cell(0).alias("object"), cell(1).cast("bigint").alias("object_start"), cell(2).cast("bigint").alias("object_end"), cell(3).cast("int").alias("part"), cell(4).alias("type"),
        F.when(~gap, cell(5)).alias("component"), F.when(~gap, cell(6).try_cast("bigint")).alias("start"), F.when(~gap, cell(7).try_cast("bigint")).alias("end"), F.when(~gap, cell(8)).alias("strand"), F.when(gap, cell(5).try_cast("bigint")).alias("gap"),
    )


def parse_wiggle(df: DataFrame, order: str = "line", file: str | None = None) -> DataFrame:
    """Sequence, start, end, score from variableStep lines, numbered in order; the last declaration holds for each file."""
    v = F.col("value")
    w = Window.partitionBy(*([file] if file else [])).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    chrom, span = (F.last(F.when(v.startswith("variableStep"), F.regexp_extract(v, p, 1)), ignorenulls=True).over(w) for p in (r"chrom=(\S+)", r"span=(\d+)"))
    out = df.withColumn("sequence", chrom).withColumn("_span", F.coalesce(F.nullif(span, F.lit("")).cast("bigint"), F.lit(1))).where(v.rlike(r"^\d+\s"))
    start = F.regexp_extract(v, r"^(\d+)", 1).cast("bigint")
    return out.select("sequence", start.alias("start"), (start + F.col("_span") - 1).alias("end"), F.regexp_extract(v, r"\s(\S+)", 1).try_cast("double").alias("score"))


def parse_junctions(df: DataFrame) -> DataFrame:
    """Of each BED junction a row for the junction and one for each of its two blocks (1-based, closed)."""
    p = F.split("value", "\t")
    cell = lambda i: F.get(p, F.lit(i))
    start, end = cell(1).cast("bigint") + 1, cell(2).cast("bigint")
    sizes = F.transform(F.filter(F.split(cell(10), ","), lambda x: x != ""), lambda x: x.cast("bigint"))
    rows = F.array(
        F.struct(F.lit("junction").alias("feature"), start.alias("start"), end.alias("end")),
        F.struct(F.lit("block").alias("feature"), start.alias("start"), (start + F.get(sizes, F.lit(0)) - 1).alias("end")),
        F.struct(F.lit("block").alias("feature"), (end - F.element_at(sizes, -1) + 1).alias("start"), end.alias("end")),
    )
    out = df.where(F.size(p) >= 12).select(cell(0).alias("sequence"), cell(3).alias("id"), cell(4).try_cast("double").alias("score"), cell(5).alias("strand"), F.explode(rows).alias("r"))
    return out.select("sequence", "r.feature", "r.start", "r.end", "score", "strand", "id")


def gtf_attributes(text: Column) -> Column:
    """Key "value"; pairs as key=value;..."""
    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(r'(\w+ "[^"]*")'), 1), lambda x: F.regexp_replace(x, r'^(\w+) "(.*)"$', "$1=$2")), ";")


def table_features(df: DataFrame, sequence: str, start: str, width: int, values: list[str]) -> DataFrame:
    """A feature row for each value column of a table that has a value there (end = start + width - 1)."""
    out = df.select(F.col(sequence).alias("sequence"), F.col(start).cast("bigint").alias("start"), *(F.col(v).cast("double").alias(v) for v in values)).unpivot(["sequence", "start"], values, "feature", "score")
    return out.where("score is not null").withColumn("end", F.col("start") + width - 1)


def bowtie_concise(hits: DataFrame, reads: DataFrame) -> DataFrame:
    """read_id, n and matches (seqid:start+strand, in order) of all reads; unmatched ones have NM."""
    text = F.concat(F.col("seqid"), F.lit(":"), F.col("start"), F.col("strand"))
    g = hits.groupBy("read_id").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list(text)), ",").alias("matches"))
    return reads.select("read_id").distinct().join(g, "read_id", "left").select("read_id", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("matches", F.lit("NM")).alias("matches"))


def qseq_to_fastq(df: DataFrame, passed_only: bool = False) -> DataFrame:
    """read_id, sequence (N for '.'), quality from qseq lines."""
    p = F.split("value", "\t")
    cell = lambda i: F.get(p, F.lit(i))
    rows = df.where(F.size(p) >= 11)
    rows = rows.where(cell(10) == "1") if passed_only else rows
    return rows.select(F.concat(F.concat_ws(":", cell(0), cell(2), cell(3), cell(4), cell(5)), F.lit("#"), cell(6), F.lit("/"), cell(7)).alias("read_id"), F.translate(cell(8), ".", "N").alias("sequence"), cell(9).alias("quality"))


def scarf_to_fastq(df: DataFrame) -> DataFrame:
    """Machine:..:sequence:quality lines."""
    return df.select(F.regexp_extract("value", r"^(.*):([A-Za-z.]+):(.*)$", 1).alias("read_id"), F.regexp_extract("value", r"^(.*):([A-Za-z.]+):(.*)$", 2).alias("sequence"), F.regexp_extract("value", r"^(.*):([A-Za-z.]+):(.*)$", 3).alias("quality"))


def integer_qualities(text: Column) -> Column:
    """Blank-separated numbers as a quality string (offset 33)."""
    return F.array_join(F.transform(F.split(F.trim(text), r"\s+"), lambda q: F.char(q.cast("int") + 33)), "")


def solexa_to_phred(quality: Column) -> Column:
    """Solexa's odds-based codes (offset 64) as Phred codes (offset 33)."""
    to = lambda q: F.round(10 * F.log10(1 + F.pow(F.lit(10.0), (F.ascii(q) - 64) / 10))).cast("int") + 33
    return F.array_join(F.transform(F.split(quality, ""), lambda q: F.char(to(q))), "")


def parse_placed_reads(df: DataFrame, genome: DataFrame) -> DataFrame:
    """Chromosome, strand, start, end, sequence lines of an external aligner as correlated reads with their target.

    genome: seq_id, sequence. Rows without a strand and the header line, which has no number, are left out. Reads on - are reversed and their target is reversed and complemented.
    """
    p = F.split(F.regexp_replace("value", "[\r\n]", ""), "\t")
    cell = lambda i: F.get(p, F.lit(i))
    rows = df.where((F.size(p) >= 5) & cell(2).rlike(r"^\d+$") & cell(1).isin("+", "-"))
    rows = rows.select(cell(0).alias("seq_id"), cell(1).alias("strand"), cell(2).cast("bigint").alias("start"), cell(3).cast("bigint").alias("end"), cell(4).alias("read"))
    minus, n = F.col("strand") == "-", F.length("read")
    part = sq.subsequence(F.col("sequence"), F.col("start"), F.col("start") + n + 3)
    out = rows.join(genome.select("seq_id", "sequence"), "seq_id")
    return out.select("seq_id", "start", "end", "strand", F.when(minus, F.reverse("read")).otherwise(F.col("read")).alias("read"), F.when(minus, sq.reverse_complement(part)).otherwise(part).alias("target"))


def window_width(df: DataFrame, rows: int = 100) -> DataFrame:
    """The width that the first rows share, but for the last of them; null if they don't."""
    first = df.orderBy("sequence", "start").limit(rows + 1).withColumn("_w", F.col("end") - F.col("start") + 1)
    ordered = first.withColumn("_last", F.lead("start").over(Window.orderBy("sequence", "start")).isNull()).where("not _last")
    return ordered.agg(F.when(F.min("_w") == F.max("_w"), F.min("_w")).alias("width"))
