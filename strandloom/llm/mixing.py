"""Mixing sources to target weights by Poisson replication.

Each source's mean repetition rate is what brings its share of bytes to its target weight. A document's number of copies
inverts the Poisson distribution of that mean at a number in [0, 1) hashed from the seed and the document's id; a mean too
large for that is split into equal parts, whose independently hashed counts add up to a count of the whole mean. Rows are
exploded by it and shuffled globally by a hash of seed, id and copy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandloom.llm.common import bounded, packed, written

#: The largest mean rate of one part, beyond which exp(-rate) comes near the smallest double; also the most epochs.
MAX_RATE = 500.0
#: So many copies are made from one array.
RUN = 1 << 16


def _number(what: Column, digits: int) -> Column:
    """The first hex digits (15 at most) of a digest as a number."""
    return F.conv(F.substring(F.md5(F.encode(what, "UTF-8")), 1, digits), 16, 10).cast("long")


def rates(docs: DataFrame, source: str = "source", weights: dict[str, float] | None = None, power: float = 0.5, epochs: float = 1.0) -> DataFrame:
    """_source, rate, parts and cdf of each source: a count of mean rate is the sum of parts counts with that cdf.

    weights: target share of bytes by source, which need not sum to 1; a source that isn't named has weight 0. Without
    them, weights are proportional to the source's bytes raised to power. The result is about epochs times the input's
    bytes. A source without any bytes has rate epochs. A source's rate may be any; epochs above MAX_RATE raise an error.
    """
    if epochs > MAX_RATE:
        raise ValueError(f"{epochs} epochs are too high")
    size = docs.groupBy(F.col(source).alias("_source")).agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).cast("double").alias("size"))
    if weights is None:
        weight = F.pow("size", F.lit(power))
    else:
        weight = F.lit(0.0)
        for name, w in sorted(weights.items()):
            weight = F.when(F.col("_source") == name, F.lit(float(w))).otherwise(weight)
    size = size.withColumn("weight", weight)
    total = size.agg(F.sum("size").alias("all_size"), F.sum("weight").alias("all_weight"))
    rate = F.coalesce(F.try_divide(F.lit(epochs) * F.col("weight") / F.col("all_weight") * F.col("all_size"), F.col("size")), F.lit(epochs))
    df = size.join(F.broadcast(total)).withColumn("rate", rate)  # total has one row
    df = df.withColumn("parts", F.greatest(F.lit(1).cast("long"), F.ceil(F.col("rate") / MAX_RATE))).withColumn("part", F.col("rate") / F.col("parts"))
    # chances of 0, 1, 2 ... copies, summed up; further than any number below 1 - 2**-52 reaches
    cdf = F.expr(
        "aggregate(sequence(1, cast(ceil(part + 12 * sqrt(part)) as int) + 30), named_struct('p', exp(-part), 'c', array(exp(-part))), "
        "(s, k) -> named_struct('p', s.p * part / k, 'c', concat(s.c, array(element_at(s.c, -1) + s.p * part / k)))).c"
    )
    return df.select("_source", "rate", "parts", cdf.alias("cdf"))


def replicated(docs: DataFrame, source: str = "source", weights: dict[str, float] | None = None, power: float = 0.5, epochs: float = 1.0, seed: int = 20, max_sources_sent: int = 10_000) -> DataFrame:
    """_in (the row of docs), _copies, _copy (from 1) and _order, a row for each copy; not shuffled yet.

    Documents with 0 copies are left out: that is what a rate below 1 means. A null doc_id is replaced by a digest of the text, a null
    source is a source of its own, null texts have no bytes. Rows that share an id get equally many copies each.
    """
    found = bounded(written(rates(docs, source, weights, power, epochs)), max_sources_sent)
    unnamed = F.concat(F.lit("null:"), F.md5(F.encode(F.coalesce("text", F.lit("")), "UTF-8")))
    df = packed(docs, F.col(source).alias("_of"), F.coalesce(F.col("doc_id").cast("string"), unnamed).alias("_name"))
    df = df.join(found, df["_of"].eqNullSafe(found["_source"]), "left")
    u = lambda head: _number(F.concat(head, F.col("_name")), 13) / F.lit(float(1 << 52))
    count = lambda x: F.size(F.filter("cdf", lambda c: x >= c)).cast("long")
    more = F.transform(F.sequence(F.lit(2).cast("long"), F.col("parts")), lambda i: u(F.concat(F.lit(f"{seed}:count"), i.cast("string"), F.lit(":"))))
    df = df.withColumn("_u", u(F.lit(f"{seed}:count:"))).withColumn("_more", F.when(F.col("parts") > 1, more))
    rest = F.when(F.col("parts") > 1, F.aggregate("_more", F.lit(0).cast("long"), lambda n, x: n + count(x))).otherwise(0)
    df = df.withColumn("_copies", count(F.col("_u")) + rest)
    df = df.where("_copies > 0").withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_copies - 1) div {RUN}"))))
    df = df.withColumn("_copy", F.explode(F.sequence(F.col("_run") * RUN + 1, F.least("_copies", (F.col("_run") + 1) * RUN))))
    order = _number(F.concat(F.lit(f"{seed}:order:"), "_name", F.lit(":"), F.col("_copy").cast("string")), 15)
    return df.select("_in", "_copies", "_copy", order.alias("_order"))


def _shuffled(copies: DataFrame) -> DataFrame:
    """Copies dealt out evenly by _order and sorted by it within partitions."""
    return copies.repartition("_order").sortWithinPartitions("_order")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """All copies, with docs' columns, in a global shuffle; see replicated."""
    return _shuffled(replicated(docs, **options)).select("_in.*")


def mixture(docs: DataFrame) -> DataFrame:
    """doc_id, source, n_copies, copy, shuffle_key of every copy."""
    out = _shuffled(replicated(docs.select("doc_id", "source", "text")).select("_in.doc_id", "_in.source", "_copies", "_copy", "_order"))
    return out.select("doc_id", "source", F.col("_copies").alias("n_copies"), F.col("_copy").alias("copy"), F.col("_order").alias("shuffle_key"))


ORACLE = """
with size as (select source, sum(strlen(coalesce(text, '')))::double as size from documents group by 1),
w as (select *, pow(size, 0.5) as weight from size),
rate as (select source, coalesce(weight / (select sum(weight) from w) * (select sum(size) from w) / nullif(size, 0), 1.0) as rate from w),
steps as (select source, rate, unnest(range(0, cast(ceil(rate + 12 * sqrt(rate)) as bigint) + 31)) as k from rate),
chance as (select source, k, exp(-rate) * coalesce(product(rate / nullif(k2, 0)), 1) as p
  from (select s.*, unnest(range(0, s.k + 1)) as k2 from steps s) group by source, rate, k),
cdf as (select source, k, sum(p) over (partition by source order by k) as c from chance),
u as (select doc_id, source, row_number() over () as r, coalesce(doc_id::varchar, 'null:' || md5(coalesce(text, ''))) as name,
  ('0x' || substr(md5('20:count:' || coalesce(doc_id::varchar, 'null:' || md5(coalesce(text, '')))), 1, 13))::bigint / 4503599627370496.0::double as u from documents),
n as (select r, any_value(u.doc_id) as doc_id, any_value(u.source) as source, any_value(name) as name, count(*) as n_copies
  from u join cdf on u.source is not distinct from cdf.source and u.u >= cdf.c group by r)
select doc_id, source, n_copies, copy, ('0x' || substr(md5('20:order:' || name || ':' || copy::varchar), 1, 15))::bigint as shuffle_key
from (select *, unnest(range(1, n_copies + 1)) as copy from n)
"""
