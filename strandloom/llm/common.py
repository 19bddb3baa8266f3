"""What the operators of this subpackage share: table access, the shared work folder, tokens and hashes."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StringType, StructType

from strandloom.session import delete, work_folder

#: The white space of every contract of this package: 0x20 and 0x09 to 0x0D, no other.
SPACE = r"\x20\x09-\x0D"
#: The most bytes of a table that is sent to all executors, and the settings of Arrow batches.
SENT_BYTES = 64 << 20
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(df: DataFrame, *names: str) -> DataFrame:
    """df's rows as one struct, _in, beside copies of the named columns, so that no other column's name can clash."""
    return df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("_in"), *names)


def written(df: DataFrame, *partition_by: str, row_group: int | None = None) -> DataFrame:
    """Cuts lineage: df as a Parquet table in the shared folder, read back; discard or session.clean delete it.

    Shuffle files of what was written before are not read again; Spark deletes them once the driver has collected its garbage.
    With partition_by, tasks write to as many files at once and don't sort. row_group: about the bytes of large rows that readers hold at once.
    """
    spark, path = df.sparkSession, work_folder(df.sparkSession)
    spark._jvm.System.gc()
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "8")
    write = df.write.partitionBy(*partition_by).option("compression", "zstd")
    (write.option("parquet.block.size", str(row_group)) if row_group else write).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._work_path = path
    return out


def discard(table: DataFrame) -> None:
    """Deletes a written table that nothing reads any more."""
    delete(table.sparkSession, table._work_path)


def _row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row as it is sent: strings and arrays by their lengths."""
    total = F.lit(16)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, StringType | BinaryType):
            total = total + 16 + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, ArrayType):
            each = 32 if isinstance(f.dataType.elementType, StructType) else 8
            total = total + 16 + F.greatest(F.size(c), F.lit(0)) * each
        else:
            total = total + 8
    return total


def bounded(df: DataFrame, max_rows: int, max_bytes: int = SENT_BYTES) -> DataFrame:
    """A broadcast hint only if df, which should be a written table, proves to have at most max_rows rows of max_bytes in all."""
    rows, size = df.limit(max_rows + 1).agg(F.count("*"), F.coalesce(F.sum(_row_bytes(df)), F.lit(0))).first()
    return F.broadcast(df) if rows <= max_rows and size <= max_bytes else df


def in_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """df.mapInArrow(run, schema) with batches small enough for two workers beside an executor's heap.

    All operators of this package use the same two settings, so it does not matter when a plan that is built here runs.
    """
    conf = df.sparkSession.conf
    for key, value in BATCHES.items():
        if conf.get(key, None) != value:
            conf.set(key, value)

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        released()

    return df.mapInArrow(tidy, schema)


def released() -> None:
    """Gives freed memory back to the system, as a worker lives on beside the next stages' workers and the JVM."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The column's strings; null is the empty text."""
    return [x or "" for x in batch.column(column).to_pylist()]


def columns_of(batches: Iterable[pa.RecordBatch], max_bytes: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches of at most max_bytes each (but a row at least), without copying."""
    for batch in batches:
        step = max(1, int(batch.num_rows * max_bytes / max(batch.nbytes, 1)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on unsigned 64-bit integers (the public splitmix64 one)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: Odd factors of the hashes below.
BASE = 0x9E3779B97F4A7C15
_WORD, _PAIR = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
#: Words of more bytes are hashed one by one, by a cryptographic hash.
_LONG = 256
#: What keeps the first 0 to 8 bytes of a little-endian number.
_FIRST = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)


class Words:
    """Words (runs of bytes outside SPACE) of many texts at once.

    ``start`` and ``end`` are byte offsets into ``data``, ``doc`` is the text's index and ``hash`` a 64-bit hash of the
    word's bytes. Bytes enter eight at a time, each time through a bijective finaliser, so words of one length up to eight
    bytes never share a hash, and no algebraic structure of longer words (as with polynomials modulo 2**64) makes them
    collide; words over 256 bytes are hashed by blake2b.
    """

    def __init__(self, items: list[bytes], lower: bool) -> None:
        self.data = b"\n".join(items) + b"\n"
        if lower:
            self.data = self.data.lower()  # bytes.lower() changes A-Z only
        raw = np.frombuffer(self.data, np.uint8)
        blank = np.empty(len(raw) + 1, bool)
        blank[0] = True
        np.less_equal(raw - np.uint8(9), 4, out=blank[1:])
        blank[1:] |= raw == 32
        edge = np.flatnonzero(blank[1:] != blank[:-1])
        self.start, self.end = edge[::2], edge[1::2]
        lengths = np.fromiter(map(len, items), np.int64, len(items)) + 1
        self.doc = np.searchsorted(np.cumsum(lengths), self.start, side="right")
        self.first = np.searchsorted(self.doc, np.arange(len(items) + 1))  # of each text's words
        self.hash = self._hash()

    def _hash(self) -> np.ndarray:
        held = self.data + bytes(8)
        eight = np.ndarray(len(held) - 7, "<u8", held, strides=(1,))  # the eight bytes from each byte on
        size = self.end - self.start
        with np.errstate(over="ignore"):
            out = mix64(size.astype(np.uint64) * _WORD)
            some, at = np.flatnonzero(size <= _LONG), 0
            while len(some):
                left = size[some] - at
                out[some] = mix64((out[some] ^ (eight[self.start[some] + at] & _FIRST[np.minimum(left, 8)])) * _WORD)
                at += 8
                some = some[left > 8]
        for i in np.flatnonzero(size > _LONG):
            out[i] = int.from_bytes(hashlib.blake2b(self.data[self.start[i] : self.end[i]], digest_size=8).digest(), "little")
        return out

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the k words from each start, and the starts (word indexes) that have k words in their text.

        Hashes of 1, 2, 4 ... words are joined to that of k, each time through the finaliser.
        """
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.doc[:n] == self.doc[k - 1 :])
        out, done, power, size = None, 0, self.hash, 1
        while True:
            if k & size:
                out = power if out is None else joined_hash(out[: len(power) - done], power[done:])
                done += size
            if done == k:
                return out[at], at
            power = joined_hash(power[:-size], power[size:])
            size *= 2


def joined_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of the pair of two hashes, in this order."""
    with np.errstate(over="ignore"):
        return mix64((a * _PAIR) ^ (b + _WORD))
