"""Writers: rows as lines of the text formats, and tables split by key."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyarrow import parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.functions import attributes as at
from strandloom.functions import sequence as sq
from strandloom.session import _path
from strandloom.sources.text import FEATURE_COLUMNS


def number(c: Column) -> Column:
    """a number with up to four decimals, whole ones without."""
    return F.when(c == F.floor(c), F.format_string("%d", F.floor(c))).otherwise(F.format_string("%.4f", c))


def feature_lines(df: DataFrame) -> DataFrame:
    """K1: nine-column lines (value); nulls and missing columns are '.'."""
    kinds = dict(df.dtypes)
    cell = lambda c: F.lit(".") if c not in kinds else F.coalesce(number(F.col(c)) if kinds[c] in ("double", "float") else F.col(c).cast("string"), F.lit("."))
    return df.select(F.concat_ws("\t", *(cell(c) for c in FEATURE_COLUMNS)).alias("value"))


def write_features(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Lines as text files; Spark's committer makes them appear as a whole. mode ignore skips what is there."""
    feature_lines(df).write.mode(mode).text(path)


def attribute_table(df: DataFrame, max_keys: int = 10_000) -> DataFrame:
    """K2: a column for every attribute key of any row; the keys, max_keys at most, are collected first. More raise an error."""
    keys = [r.k for r in df.select(F.explode(F.map_keys("attributes")).alias("k")).distinct().orderBy("k").limit(max_keys + 1).collect()]
    if len(keys) > max_keys:
        raise ValueError(f"over {max_keys} attribute keys do not make columns of a table")
    return df.select(*(c for c in df.columns if c != "attributes"), *(F.col("attributes")[k].alias(k) for k in keys))


def together(df: DataFrame, by: str, part_rows: int = 1_000_000) -> DataFrame:
    """df dealt so that the rows of a value meet in one task; those of a value with over part_rows rows in several.

    Such values are counted first; they are fewer than 10,000, as part_rows grows with the table.
    """
    counts = df.groupBy(F.col(by).alias("_key")).count()
    most = max(part_rows, df.count() // 10_000)
    large = counts.where(F.col("count") > most).select("_key", F.ceil(F.col("count") / most).alias("_parts"))
    dealt = df.join(F.broadcast(large), F.col(by).eqNullSafe(F.col("_key")), "left").withColumn("_part", F.spark_partition_id() % F.coalesce("_parts", F.lit(1)))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(n, by, "_part").select(*df.columns)


def write_split(df: DataFrame, path: str, by: str = "sequence", rows: int = 0) -> None:
    """K3, K4: a folder for each value of a column (strand, feature, sequence), files of at most ``rows`` rows."""
    writer = df.write.option("maxRecordsPerFile", rows) if rows else df.write
    writer.partitionBy(by).parquet(path)


def _folder(by: str, value: str | None) -> str:
    """The name that Spark gives to a value's folder, from which it reads the value."""
    return f"{by}=" + (re.sub(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""", lambda m: f"%{ord(m[0]):02X}", value) if value else "__HIVE_DEFAULT_PARTITION__")


def write_split_many(df: DataFrame, path: str, by: str = "sequence") -> None:
    """K3: write_split for a column of very many values: a file each (of values with very many rows: several).

    Rows of a value meet first, as else every task writes a file for each of its values, and Arrow writes the files: Spark's
    writer runs several shell commands for each file on a local disk. A task gives the same names when it is repeated, and
    its files get them when they are whole; the folder appears as a whole by a last renaming.
    """
    spark = df.sparkSession
    place, system = _path(spark, path)
    if system.exists(place):
        raise ValueError(f"{path} is there already")
    whole = re.sub("^file:/+", "file:///", system.makeQualified(place).toString())
    staged = f"{whole}-{uuid.uuid4().hex}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(staged)
        task = TaskContext.get()
        name, made, now, out = f"part-{task.partitionId():05d}.parquet", 0, None, None

        def closed() -> None:
            out.close()
            own, last = f"{root}/{now}/_{task.taskAttemptId()}-{name}", f"{root}/{now}/{name}"
            if store.get_file_info(last).is_file:  # of an attempt before, whole and with the same rows
                store.delete_file(own)
            else:
                store.move(own, last)

        for batch in batches:
            value, rest = batch.column("_value"), batch.drop_columns(["_value"])
            codes = value.dictionary_encode(null_encoding="encode")
            at = codes.indices.to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else []
            for s, e in zip(starts, [*starts[1:], len(at)], strict=True):
                own = _folder(by, value[int(s)].as_py())
                if own != now:
                    if out:
                        closed()
                    now, made = own, made + 1
                    store.create_dir(f"{root}/{now}")
                    out = pq.ParquetWriter(f"{root}/{now}/_{task.taskAttemptId()}-{name}", rest.schema, filesystem=store, compression="snappy")
                out.write_batch(rest.slice(s, e - s))
        if out:
            closed()
        yield pa.RecordBatch.from_arrays([pa.array([made], pa.int64())], ["files"])

    # by the folder's value, so that null and the empty text, which share a folder, follow each other
    dealt = together(df.withColumn("_value", F.nullif(F.col(by).cast("string"), F.lit(""))).drop(by), "_value").sortWithinPartitions("_value")
    system.mkdirs(_path(spark, staged)[0])
    dealt.mapInArrow(write, "files long").agg(F.sum("files")).collect()
    if not system.rename(_path(spark, staged)[0], place):
        raise OSError(f"{staged} could not be renamed")


def wiggle_lines(df: DataFrame, value: Column) -> DataFrame:
    """K5: variableStep lines (sequence, line, value) of each sequence in order, its declaration first."""
    rows = df.select("sequence", F.col("start").cast("bigint").alias("line"), F.concat_ws(" ", F.col("start").cast("string"), F.format_string("%.4f", value)).alias("value"))
    heads = df.select("sequence").distinct().select("sequence", F.lit(0).cast("bigint").alias("line"), F.concat(F.lit("variableStep chrom="), "sequence").alias("value"))
    return heads.unionByName(rows).orderBy("sequence", "line")


def save_store(df: DataFrame, name: str, buckets: int, by: str) -> None:
    """K6: a managed table bucketed and sorted by a key, so that joins on it need no shuffle."""
    df.write.bucketBy(buckets, by).sortBy(by).mode("overwrite").saveAsTable(name)


def fasta_lines(df: DataFrame, width: int = 80) -> DataFrame:
    """K7: one value for each record: header and wrapped sequence."""
    return df.select(F.concat(F.lit(">"), F.col("seq_id").cast("string"), F.lit("\n"), sq.wrapped(F.col("sequence"), width)).alias("value"))


def soft_lines(df: DataFrame) -> DataFrame:
    """K8: number (in order of sequence and start, within a sequence), sequence, start, end, score."""
    return df.withColumn("number", F.row_number().over(Window.partitionBy("sequence").orderBy("start", "end", "score"))).select("sequence", "number", "start", "end", "score")


def md_tag(read: Column, target: Column) -> Column:
    """K9: the MD string of a read against its reference of the same length."""
    step = F.aggregate(
        F.zip_with(F.split(read, ""), F.split(target, ""), lambda r, t: F.struct(r.alias("r"), t.alias("t"))),
        F.struct(F.lit(0).alias("n"), F.lit("").alias("s")),
        lambda a, x: F.struct(F.when(x["r"] == x["t"], a["n"] + 1).otherwise(0).alias("n"), F.when(x["r"] == x["t"], a["s"]).otherwise(F.concat(a["s"], a["n"].cast("string"), x["t"])).alias("s")),
    )
    return F.concat(step["s"], step["n"].cast("string"))


def sam_lines(df: DataFrame) -> DataFrame:
    """K9: SAM lines of bowtie rows (read_id, strand, seqid, start, read, quality, target), without a header."""
    flag = F.when(F.col("strand") == "-", "16").otherwise("0")
    cells = ["read_id", flag, "seqid", F.col("start").cast("string"), F.lit("255"), F.concat(F.length("read").cast("string"), F.lit("M")), F.lit("*"), F.lit("0"), F.lit("0"), "read", "quality", F.concat(F.lit("MD:Z:"), md_tag(F.col("read"), F.col("target")))]
    return df.select(F.concat_ws("\t", *cells).alias("value"))


def eland_lines(df: DataFrame) -> DataFrame:
    """Read id, sequence, counts by mismatches and matches of feature rows grouped by read."""
    hit = F.concat(F.col("sequence"), F.lit(":"), F.col("start").cast("string"), F.when(F.col("strand") == "-", "R").otherwise("F"), F.col("mismatches").cast("string"))
    counts = F.concat_ws(":", *(F.count_if(F.col("mismatches") == k).cast("string") for k in range(4)))
    rows = df.groupBy("read_id", "read").agg(counts.alias("counts"), F.array_join(F.array_sort(F.collect_list(hit)), ",").alias("matches"))
    return rows.select(F.concat_ws("\t", "read_id", "read", "counts", "matches").alias("value"))


def fastq_lines(df: DataFrame) -> DataFrame:
    """Records of four lines, quality I where there is none."""
    quality = F.coalesce(F.col("quality"), F.repeat(F.lit("I"), F.length("sequence"))) if "quality" in df.columns else F.repeat(F.lit("I"), F.length("sequence"))
    return df.select(F.concat(F.lit("@"), F.col("read_id").cast("string"), F.lit("\n"), F.col("sequence"), F.lit("\n+\n"), quality).alias("value"))


def report_json(df: DataFrame, key: str) -> DataFrame:
    """One JSON object for each row, by key."""
    return df.select(key, F.to_json(F.struct(*(c for c in df.columns if c != key))).alias("report"))


def staged(df: DataFrame, source: str) -> DataFrame:
    """Lower-case names, starts from 0, one source."""
    return df.withColumn("sequence", F.lower("sequence")).withColumn("start", F.col("start") - 1).withColumn("source", F.lit(source))


def with_attribute_string(df: DataFrame) -> DataFrame:
    """K1: the ninth column made of the attribute map."""
    return df.withColumn("attribute_string", at.attribute_string(F.col("attributes")))
