"""Line dedup by site-relative frequency, with DataFrame functions only.

A line's frequency on a site is the number of the site's pages that hold it over the site's pages. Lines above a ratio are
boilerplate and go, wherever on the site they stand. A site has at most (mean lines a page) / ratio such lines, so they
fit in one row for each site, dealt into slots by their hashes, of which a line is looked up in one; texts are never shuffled
as long as the table of these rows is small enough to send.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.llm.common import SENT_BYTES, bounded, packed, written

BLANKS = " \t\n\x0b\x0c\r"
#: Slots of a site's boilerplate lines.
SLOTS = 128


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _key(line: Column) -> Column:
    """64 bits that stand for a line without the white space around it; a number, so that arrays of them are hashed, not searched."""
    return F.xxhash64(F.trim(line, F.lit(BLANKS)))


def _blank(line: Column) -> Column:
    return F.trim(line, F.lit(BLANKS)) == ""


def _slot(key: Column) -> Column:
    return F.pmod(key, F.lit(SLOTS)).cast("int")


def boilerplate(docs: DataFrame, site: str = "source", ratio: float = 0.1) -> DataFrame:
    """_site, _slots: by slot the keys of the lines that more than ratio of the site's pages, and two at least, hold."""
    pages = docs.select(F.col(site).alias("_site"), F.array_distinct(F.transform(F.filter(_lines(F.col("text")), lambda x: ~_blank(x)), _key)).alias("_k"))
    held = pages.select("_site", F.explode("_k").alias("_k")).groupBy("_site", "_k").agg(F.count("*").alias("n")).where("n > 1")
    total = docs.groupBy(F.col(site).alias("_site")).agg(F.count("*").alias("pages")).where("pages > 1")
    often = held.alias("h").join(total.alias("t"), F.col("h._site").eqNullSafe(F.col("t._site"))).where(F.col("n") > ratio * F.col("pages"))
    slots = often.groupBy("h._site", _slot(F.col("_k")).alias("_slot")).agg(F.collect_list("_k").alias("_a"))
    by_slot = F.map_from_entries(F.collect_list(F.struct("_slot", "_a")))
    return slots.groupBy("_site").agg(by_slot.alias("_m")).select("_site", F.transform(F.sequence(F.lit(0), F.lit(SLOTS - 1)), lambda i: F.element_at("_m", i)).alias("_slots"))


def judged_lines(docs: DataFrame, site: str = "source", ratio: float = 0.1, max_sites_sent: int = 10_000) -> DataFrame:
    """_in (the row of docs, boilerplate lines taken out of its text), _n_lines and _n_dropped (lines that are not blank).

    A line is boilerplate if more than ratio of its site's pages hold it, and more than one does, as a line of one page
    repeats nothing. Null texts stay null with 0 lines; blank lines stay; a text that loses all lines becomes empty, its row
    stays. Rows without a site (null) are a site of their own. Each row is a page: repeated rows count as often as they
    occur. An empty table gives an empty table. The boilerplate table is sent to all executors only if it proves to have at
    most max_sites_sent sites and few enough bytes; beyond that it is joined by site, and skewed sites are split by adaptive
    execution.
    """
    found = written(boilerplate(docs, site, ratio))
    keys = found.select(F.coalesce(F.sum(F.aggregate("_slots", F.lit(0), lambda n, x: n + F.greatest(F.size(x), F.lit(0)))), F.lit(0))).first()[0]
    if 8 * keys <= SENT_BYTES:
        found = bounded(found, max_sites_sent)
    df = packed(docs, "text", F.col(site).alias("_of"))
    df = df.join(found, df["_of"].eqNullSafe(found["_site"]), "left")
    df = df.withColumn("_l", _lines(F.col("text")))

    def goes(line: Column) -> Column:
        key = _key(line)
        return ~_blank(line) & F.coalesce(F.array_contains(F.get("_slots", _slot(key)), key), F.lit(False))

    df = df.withColumn("_s", F.when(F.col("_slots").isNull(), F.col("_l")).otherwise(F.filter("_l", lambda x: ~goes(x))))
    df = df.withColumn("_n_lines", F.size(F.filter("_l", lambda x: ~_blank(x))).cast("long"))
    df = df.withColumn("_n_dropped", (F.size("_l") - F.size("_s")).cast("long"))
    text = F.when(F.col("_n_dropped") == 0, F.col("text")).otherwise(F.array_join("_s", "\n"))
    return df.select(F.col("_in").withField("text", text).alias("_in"), "_n_lines", "_n_dropped")


def drop_boilerplate(docs: DataFrame, **options) -> DataFrame:
    """docs without its sites' boilerplate lines; see judged_lines."""
    return judged_lines(docs, **options).select("_in.*")


def line_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, text_sha256 (lower-case hex of what is left; null: empty) of every row."""
    out = judged_lines(docs.select("doc_id", "source", "text"))
    sha = F.sha2(F.encode(F.coalesce("_in.text", F.lit("")), "UTF-8"), 256).alias("text_sha256")
    return out.select("_in.doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), sha)


ORACLE = r"""
with base as (select row_number() over () as r, doc_id, source, coalesce(text, '') as text from documents),
lines as (select r, doc_id, source, generate_subscripts(ls, 1) as i, unnest(ls) as l from (select *, string_split(text, chr(10)) as ls from base)),
keyed as (select *, trim(l, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as k from lines),
held as (select source, k, count(distinct r) as n from keyed where k <> '' group by all),
total as (select source, count(*) as pages from base group by all),
often as (select held.source, held.k from held join total on held.source is not distinct from total.source
  where n > 1 and n > 0.1::double * pages),
judged as (select keyed.*, often.k is not null as dropped from keyed left join often on keyed.source is not distinct from often.source and keyed.k = often.k)
select any_value(doc_id) as doc_id, count(*) filter (k <> '') as n_lines, count(*) filter (dropped) as n_dropped,
  sha256(coalesce(string_agg(l, chr(10) order by i) filter (not dropped), '')) as text_sha256
from judged group by r
"""
