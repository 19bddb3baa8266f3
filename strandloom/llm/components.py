"""Connected components of link tables by alternating large-star and small-star steps, all distributed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm.common import discard, in_arrow, written


def forest(a: np.ndarray, b: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
    """Indexes of links that connect what no link before them connects; with weights, heavier links come first."""
    ids, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = list(range(len(ids)))
    left, right = index[: len(a)].tolist(), index[len(a) :].tolist()
    order = range(len(a)) if weight is None else np.argsort(-weight, kind="stable").tolist()
    out = []
    for i in order:
        x, y = left[i], right[i]
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        while parent[y] != y:
            parent[y] = y = parent[parent[y]]
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append(i)
    return np.array(out, np.int64)


def _thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = forest(batch.column("a").to_numpy(), batch.column("b").to_numpy())
        yield batch.take(pa.array(keep))


def components(links: DataFrame, most_rounds: int = 40) -> DataFrame:
    """node, component (its smallest node) of every node in links (a, b: long, not null); a written table.

    Minima are partial sums before each shuffle and are joined back, so that a hub with very many links is split by
    adaptive execution. Every round ends in a written table. Self links and repeated links are harmless.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b")
    edges = written(in_arrow(edges, _thin, "a long, b long"))
    state = None
    for _ in range(most_rounds):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        before, edges = edges, written(small.union(low.select("a", F.col("m").alias("b"))).distinct())
        discard(before)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    nodes = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    return nodes.union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
