"""Exact top-k inner products by norm-bucketed retrieval.

1. A bounded number of vectors (seeds), sent to all executors, gives each query a floor: a score that k vectors reach. A
   query of length m needs vectors of length floor / m at least, by Cauchy and Schwarz.
2. Queries are dealt into blocks by the length they need. A vector goes only to the blocks that need lengths up to its
   own, so the blocks of demanding queries meet the longest vectors only; blocks and slices of vectors meet by an equi-join.
3. In a task a block's vectors, sorted by length, are cut into buckets of similar lengths, longest first. For a query with
   k-th best score t so far, a bucket whose longest vector has length m is left out if |q| * m < t. Else its local cosine
   threshold t / (|q| * m) chooses the pruning: a high one restricts a few coordinates of the unit vectors (coordinate
   pruning), a low one cuts the bucket at the shortest length that can reach t (length pruning). What is left is verified
   by integer products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandloom.llm.common import columns_of, in_arrow, written

#: From this local cosine threshold on coordinates are used; so many of them, the query's largest.
COORDINATE_FROM, FOCUS = 0.6, 3
#: Rows of a bucket, and queries that one product takes.
BUCKET, BLOCK = 2048, 512
#: Bytes of the components of a block of queries, of a slice of vectors, and of the seeds.
QUERY_BYTES, SLICE_BYTES, SEED_BYTES = 8 << 20, 32 << 20, 4 << 20
#: Relative slack of bounds in floating point, so that rounding never prunes a result.
SLACK = 1e-9
LONG = (1 << 63) - 1


def integer_vectors(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """vec_id, v (array of long: floor(scale * x)), norm. Null vectors or ids, null or non-finite components: left out.

    Components beyond the range of a long are clamped to it. Rows that share a vec_id all stay.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in columns_of(batches):
            ids, out, norms = [], [], []
            for i, x in zip(batch.column("vec_id").to_pylist(), batch.column("embedding"), strict=True):
                if i is None or x.as_py() is None or x.values.null_count:
                    continue
                with np.errstate(over="ignore"):
                    values = np.floor(scale * x.values.to_numpy(zero_copy_only=False).astype(np.float64))
                if not np.isfinite(x.values.to_numpy(zero_copy_only=False)).all():
                    continue
                own = [min(max(int(y), -LONG), LONG) if np.isfinite(y) else int(np.sign(y)) * LONG for y in values] if (np.abs(values) > 1 << 52).any() else values.astype(np.int64)
                ids.append(i)
                out.append(own)
                norms.append(float(np.sqrt(np.square(np.asarray(own, np.float64)).sum())))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.list_(pa.int64())), pa.array(norms, pa.float64())], ["vec_id", "v", "norm"])

    return in_arrow(vectors.select("vec_id", "embedding"), run, "vec_id long, v array<long>, norm double")


def _matrix(rows: list, width: int) -> np.ndarray:
    """Rows as one matrix, shorter ones filled with zeros; floats hold all values used in products exactly, or else objects."""
    flat = np.zeros((len(rows), width), object if any(abs(int(m)) > 1 << 31 for r in rows if len(r) for m in (max(r), min(r))) else np.float64)
    for i, r in enumerate(rows):
        flat[i, : len(r)] = r
    return flat


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if a.dtype != object and b.dtype != object and float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1) < 1 << 53:
        return a @ b.T
    whole = lambda m: np.array([[int(x) for x in r] for r in m], object).reshape(m.shape)
    return np.clip(whole(a) @ whole(b).T, -LONG, LONG)


class Best:
    """The k best scores of each query so far, ties to smaller ids. rows tell a query apart from rows that share its id."""

    def __init__(self, rows: np.ndarray, matrix: np.ndarray, floor: np.ndarray, k: int) -> None:
        self.rows, self.matrix, self.k = rows, matrix, k
        self.floor = floor.astype(object if floor.dtype == object else np.float64)  # known to be reached by k vectors
        self.norm = np.sqrt(np.square(matrix.astype(np.float64)).sum(1))
        unit = matrix.astype(np.float64) / np.maximum(self.norm, 1e-300)[:, None]
        self.focus = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :FOCUS]
        self.angle = np.arccos(np.clip(np.take_along_axis(unit, self.focus, 1), -1, 1))
        self.found: list[list[tuple]] = [[] for _ in rows]

    def add(self, query: int, scores: np.ndarray, rows: np.ndarray, ids: np.ndarray) -> None:
        keep = (scores >= self.floor[query]) & (rows != self.rows[query])
        if keep.any():
            own = self.found[query] + [(-int(s), int(i)) for s, i in zip(scores[keep], ids[keep], strict=True)]
            if len(own) >= self.k:
                own = sorted(own)[: self.k]
                self.floor[query] = max(self.floor[query], -own[-1][0])
            self.found[query] = own

    def bucket(self, rows: np.ndarray, ids: np.ndarray, matrix: np.ndarray, norm: np.ndarray) -> None:
        """rows (numbers), ids, matrix and norm of a bucket's vectors, in any order."""
        if (np.diff(norm) < 0).any():
            order = np.argsort(norm, kind="stable")
            rows, ids, matrix, norm = rows[order], ids[order], matrix[order], norm[order]
        longest = norm[-1]
        threshold = self.floor.astype(np.float64)
        reach = self.norm * longest
        live = np.flatnonzero((reach * (1 + SLACK) + 1e-6 >= threshold))
        cosine = np.divide(threshold, reach, out=np.full(len(reach), -1.0), where=reach > 0)
        by_coordinate = live[cosine[live] >= COORDINATE_FROM]
        if len(by_coordinate):
            unit = matrix.astype(np.float64) / np.maximum(norm, 1e-300)[:, None]
            wide = np.arccos(np.clip(cosine * (1 - SLACK) - SLACK, -1, 1)) + 1e-7
            for q in by_coordinate:
                stay = np.ones(len(ids), bool)
                for f, angle in zip(self.focus[q], self.angle[q], strict=True):
                    stay &= (unit[:, f] >= np.cos(min(np.pi, angle + wide[q])) - SLACK) & (unit[:, f] <= np.cos(max(0.0, angle - wide[q])) + SLACK)
                if stay.any():
                    self.add(q, _products(self.matrix[q : q + 1], matrix[stay])[0], rows[stay], ids[stay])
        by_length = live[cosine[live] < COORDINATE_FROM]
        for at in range(0, len(by_length), BLOCK):
            some = by_length[at : at + BLOCK]
            least = np.min(np.divide(threshold[some], self.norm[some], out=np.full(len(some), -np.inf), where=self.norm[some] > 0) * (1 - SLACK) - 1e-6)
            cut = int(np.searchsorted(norm, least)) if least > 0 else 0
            scores = _products(self.matrix[some], matrix[cut:])
            for i in np.flatnonzero((scores >= self.floor[some][:, None]).any(1)):
                self.add(some[i], scores[i], rows[cut:], ids[cut:])


def _components(v: pa.ListArray, width: int) -> np.ndarray:
    """Vectors as a matrix of that width."""
    flat, offsets = v.flatten().to_numpy(), v.offsets.to_numpy()
    offsets = offsets - offsets[0]
    if len(flat) == width * len(v) and (not len(flat) or (flat.max() <= 1 << 31 and flat.min() >= -(1 << 31))):
        return flat.reshape(len(v), width).astype(np.float64)
    return _matrix([flat[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)], width)


def _one(table: pa.Table, column: str) -> pa.Array:
    out = table.column(column).combine_chunks()
    return out.chunk(0) if isinstance(out, pa.ChunkedArray) else out


def floors(queries: DataFrame, seeds: list, width: int, k: int) -> DataFrame:
    """Adds floor and need (the least length of a vector that reaches it) to queries (row, vec_id, v, norm).

    floor: rounded down, a score that k of the seeds (row, v), the query's own not among them, reach; null if there are fewer.
    """
    rows, matrix = np.array([r.row for r in seeds], np.int64), _matrix([r.v for r in seeds], width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in columns_of(batches, 1 << 20):
            own = batch.column("row").to_numpy()
            scores = _products(_components(batch.column("v"), width), matrix).astype(np.float64)
            scores = np.where(own[:, None] == rows[None], -np.inf, scores)
            floor = np.full(len(own), -np.inf)
            if scores.shape[1] >= k:  # never above an exact score
                floor = np.nextafter(np.partition(scores, -k, axis=1)[:, -k], -np.inf)
            norm = batch.column("norm").to_numpy()
            need = np.divide(floor, norm, out=np.full(len(own), -np.inf), where=norm > 0) * (1 - SLACK) - 1e-6
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("row", "vec_id", "v", "norm")), pa.array(floor), pa.array(np.maximum(need, 0.0))], ["row", "vec_id", "v", "norm", "floor", "need"])

    return in_arrow(queries.select("row", "vec_id", "v", "norm"), run, "row long, vec_id long, v array<long>, norm double, floor double, need double")


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, seeds: int = 2048, query_bytes: int = QUERY_BYTES, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (long) of the k highest integer products of each query with all other rows.

    is_query: a condition on vec_id. Ties go to the smaller vec_id; if there are fewer than k other vectors, all are
    given. Rows that share a vec_id are rows of their own: each is a candidate for all others, also for those of its id, and
    each is a query if its id is one (so a query_id has k results for each of its rows). Vectors of different lengths are
    compared as if filled with zeros; empty ones score 0. Scores beyond a long are clamped. See integer_vectors for nulls
    and non-finite components. An empty table gives no rows. The driver holds at most ``seeds`` vectors of SEED_BYTES.
    """
    spark = vectors.sparkSession
    table = written(integer_vectors(vectors, scale).withColumn("row", F.monotonically_increasing_id()))
    width, n_rows, n_queries = table.agg(F.max(F.size("v")), F.count("*"), F.count_if(is_query)).first()
    if not n_queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    row_bytes = 8 * max(width, 1)
    n_seeds = max(k + 1, min(seeds, SEED_BYTES // row_bytes))
    sample = table.select("row", "v").orderBy(F.xxhash64("vec_id", "v"), "row").limit(n_seeds).collect()
    queries = written(floors(table.where(is_query), sample, width, k))
    n_blocks, n_slices = -(-n_queries * row_bytes // query_bytes), -(-n_rows * row_bytes // slice_bytes)
    # blocks of about equally many queries by need; a hash splits queries of equal need
    cuts = [0.0]
    if n_blocks > 1:
        cuts += sorted({x for x in queries.agg(F.percentile_approx("need", [i / n_blocks for i in range(1, n_blocks)], 10 * n_blocks)).first()[0] if x > 0})
    needs = F.array(*(F.lit(float(x)) for x in cuts))
    reached = lambda length: F.size(F.filter(needs, lambda x: x <= length))  # noqa: E731  how many blocks need at most this length
    sizes = queries.groupBy((reached(F.col("need")) - 1).alias("block")).agg(F.ceil(F.count("*") * row_bytes / query_bytes).cast("int").alias("parts"))
    parts = {r.block: r.parts for r in sizes.collect()}  # a row for each block
    n_parts = F.array(*(F.lit(parts.get(b, 0)) for b in range(len(cuts))))
    part = lambda b: F.get(n_parts, b)
    slices = F.explode(F.sequence(F.lit(0), F.lit(n_slices - 1)))
    block = reached(F.col("need")) - 1
    left = queries.withColumn("block", block).withColumn("part", F.pmod(F.xxhash64("row"), part(F.col("block"))).cast("int")).withColumn("slice", slices)
    right = table.withColumn("block", F.explode(F.sequence(F.lit(0), reached(F.col("norm")) - 1))).where(part(F.col("block")) > 0)
    right = right.withColumn("part", F.explode(F.sequence(F.lit(0), part(F.col("block")) - 1))).withColumn("slice", F.pmod(F.xxhash64("row", F.lit(5)), F.lit(n_slices)).cast("int"))

    def run(own: pa.Table, other: pa.Table) -> pa.Table:
        names = ["query", "query_id", "vec_id", "score"]
        if not len(own) or not len(other):
            return pa.table({c: pa.array([], pa.int64()) for c in names})
        floor = own.column("floor").to_numpy().copy()
        best = Best(own.column("row").to_numpy(), _components(_one(own, "v"), width), floor, k)
        other = other.sort_by([("norm", "descending"), ("row", "ascending")])
        for at in range(0, len(other), BUCKET):  # longest first
            some = other.slice(at, BUCKET)
            best.bucket(some.column("row").to_numpy(), some.column("vec_id").to_numpy(), _components(_one(some, "v"), width), some.column("norm").to_numpy())
        rows = [(int(q), int(i), v, -s) for q, i, found in zip(own.column("row").to_numpy(), own.column("vec_id").to_numpy(), best.found, strict=True) for s, v in sorted(found)[:k]]
        return pa.table({c: pa.array([r[j] for r in rows], pa.int64()) for j, c in enumerate(names)})

    key = ("block", "part", "slice")
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(run, "query long, query_id long, vec_id long, score long")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
