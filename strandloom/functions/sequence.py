"""Column functions on nucleotide strings, qualities, CIGAR and MD strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: IUPAC codes and their complements.
IUPAC, COMPLEMENT = "ACGTRYKMBDHVacgtrykmbdhv", "TGCAYRMKVHDBtgcayrmkvhdb"


def complement(seq: Column) -> Column:
    """each base's complement, other letters as they are."""
    return F.translate(seq, IUPAC, COMPLEMENT)


def reverse_complement(seq: Column) -> Column:
    """F1."""
    return F.reverse(complement(seq))


def c_to_t(seq: Column) -> Column:
    """what bisulfite treatment leaves of a strand."""
    return F.translate(seq, "Cc", "Tt")


def g_to_a(seq: Column) -> Column:
    """the same, seen from the other strand."""
    return F.translate(seq, "Gg", "Aa")


def rc_c_to_t(seq: Column) -> Column:
    return c_to_t(reverse_complement(seq))


def rc_g_to_a(seq: Column) -> Column:
    return g_to_a(reverse_complement(seq))


def hamming(a: Column, b: Column) -> Column:
    """positions at which two strings differ, the longer one's rest included."""
    pairs = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.when(x.eqNullSafe(y), 0).otherwise(1))
    return F.aggregate(pairs, F.lit(0), lambda n, x: n + x)


def difference(a: Column, b: Column) -> Column:
    """a marked copy: the letter where both agree, '-' where they don't."""
    return F.array_join(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.when(x.eqNullSafe(y), x).otherwise("-")), "")


def common_prefix_length(a: Column, b: Column) -> Column:
    """letters that both strings start with."""
    pairs = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x.eqNullSafe(y))
    at = F.array_position(pairs, F.lit(False))
    return F.when(at == 0, F.size(pairs)).otherwise(at - 1).cast("int")


def triplet(seq: Column, position: Column) -> Column:
    """the three bases from a 1-based position, shorter at the end."""
    return F.substring(seq, position.cast("int"), F.lit(3))


def context(tri: Column) -> Column:
    """CG, CHG or CHH of a triplet that starts with C; a cut one that isn't CG counts as CHH; else null."""
    return F.when(tri.rlike("^CG"), "CG").when(tri.rlike("^C[ACT]G"), "CHG").when(tri.rlike("^C"), "CHH")


def dinucleotide(tri: Column) -> Column:
    """CA, CC, CG or CT; CH for a cut or unclear one."""
    return F.when(tri.rlike("^C[ACGT]"), F.substring(tri, 1, 2)).when(tri.rlike("^C"), "CH")


def subsequence(seq: Column, start: Column, end: Column, rc: Column | None = None) -> Column:
    """F8: bases from start to end (1-based, closed, cut to the sequence), reversed and complemented where rc holds."""
    lo, hi = F.greatest(F.lit(1), start), F.least(F.length(seq), end)
    out = F.when(lo <= hi, F.substring(seq, lo.cast("int"), (hi - lo + 1).cast("int"))).otherwise("")
    return out if rc is None else F.when(rc, reverse_complement(out)).otherwise(out)


def padded_subsequence(seq: Column, start: Column, end: Column) -> Column:
    """F8: bases from start to end, with N for positions outside the sequence."""
    left = F.greatest(F.lit(0), F.least(end, F.lit(0)) - start + 1)
    right = F.greatest(F.lit(0), end - F.greatest(start, F.length(seq) + 1) + 1)
    return F.concat(F.repeat(F.lit("N"), left.cast("int")), subsequence(seq, start, end), F.repeat(F.lit("N"), right.cast("int")))


def _cigar(cigar: Column) -> Column:
    return F.transform(F.regexp_extract_all(cigar, F.lit(r"(\d+[MIDNSHP=X])"), 1), lambda x: F.struct(F.regexp_extract(x, r"(\d+)", 1).cast("int").alias("n"), F.substring(x, -1, 1).alias("op")))


def cigar_length(cigar: Column, operations: str) -> Column:
    """sum of counts of the given operations; MD=XN spans the reference, MI=XS the read."""
    return F.aggregate(_cigar(cigar), F.lit(0), lambda n, x: n + F.when(x["op"].isin(*operations), x["n"]).otherwise(0))


def cigar_span(cigar: Column) -> Column:
    return cigar_length(cigar, "MD=XN")


def read_length(cigar: Column) -> Column:
    return cigar_length(cigar, "MI=XS")


def matched_chunks(cigar: Column, leftmost: Column) -> Column:
    """array of (read_start, ref_start, length) of aligned stretches; insertions move in the read only."""
    step = F.aggregate(
        _cigar(cigar),
        F.struct(F.lit(1).alias("q"), leftmost.cast("int").alias("r"), F.array().cast("array<struct<read_start:int,ref_start:int,length:int>>").alias("out")),
        lambda s, x: F.struct(
            (s["q"] + F.when(x["op"].isin("M", "I", "S", "=", "X"), x["n"]).otherwise(0)).alias("q"),
            (s["r"] + F.when(x["op"].isin("M", "D", "N", "=", "X"), x["n"]).otherwise(0)).alias("r"),
            F.when(x["op"].isin("M", "=", "X"), F.concat(s["out"], F.array(F.struct(s["q"].alias("read_start"), s["r"].alias("ref_start"), x["n"].alias("length"))))).otherwise(s["out"]).alias("out"),
        ),
    )
    return step["out"]


def md_mismatches(md: Column) -> Column:
    """array of (offset from 0 on the reference, reference base) of an MD string's mismatches."""
    tokens = F.regexp_extract_all(md, F.lit(r"(\d+|\^[A-Z]+|[A-Z])"), 1)
    step = F.aggregate(
        tokens,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<offset:int,base:string>>").alias("out")),
        lambda s, x: F.struct(
            (s["at"] + F.when(x.rlike(r"^\d"), x.try_cast("int")).when(x.rlike(r"^\^"), F.length(x) - 1).otherwise(1)).alias("at"),
            F.when(x.rlike("^[A-Z]$"), F.concat(s["out"], F.array(F.struct(s["at"].alias("offset"), x.alias("base"))))).otherwise(s["out"]).alias("out"),
        ),
    )
    return step["out"]


def read_name(header: Column) -> Column:
    """a read's id without '@', comment and mate suffix."""
    return F.regexp_replace(F.regexp_extract(header, r"^@?(\S*)", 1), r"(/[12]|#0/[12])$", "")


def gc_content(seq: Column) -> Column:
    """Share of G and C."""
    return F.coalesce(F.try_divide(F.length(seq) - F.length(F.translate(seq, "GCgc", "")), F.length(seq)), F.lit(0.0))


def wrapped(seq: Column, width: int = 80) -> Column:
    """K7: lines of a fixed width."""
    return F.regexp_replace(F.regexp_replace(seq, f"(.{{{width}}})", "$1\n"), "\n$", "")


def phred_shift(quality: Column, by: int) -> Column:
    """Every quality code moved by a number."""
    return F.array_join(F.transform(F.split(quality, ""), lambda q: F.char(F.ascii(q) + by)), "")
