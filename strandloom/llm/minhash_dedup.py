"""Near-duplicate groups: banded MinHash, candidates verified by odd sketches, links confirmed on full shingle sets.

1. A pass over the texts gives each document its set's size and digest, keys of bands of MinHash samples, and an odd
   sketch: a bitmap in which every sample flips one bit. Differing samples are what is left in the XOR of two bitmaps, so
   its population count estimates high similarities precisely.
2. Documents with equal sets become one class; only one of each goes on.
3. Classes that share a band are compared by their sketches, in blocks, and links that the estimate allows are thinned to
   a forest, whose components are candidate clusters: every true link is inside one.
4. Within clusters the full sets are compared, in blocks too; confirmed links make the components. A cluster of several
   blocks is compared within blocks first, and across them only where its members are not connected yet.
No step returns all pairs of a group: from each block only links that connect something are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm.common import Words, bounded, columns_of, in_arrow, joined_hash, mix64, texts, written
from strandloom.llm.components import components, forest

#: Samples, of which BANDS * ROWS make the bands, and bits of a sketch.
SAMPLES, BANDS, ROWS, BITS = 256, 20, 4, 1024
#: Standard deviations of the estimate below the threshold down to which a candidate goes on.
SIGMAS = 4.5
#: Members of a block: of a band's bucket, and of a cluster; and shingles of a cluster's block.
BUCKET_BLOCK, CLUSTER_BLOCK, BLOCK_SHINGLES = 2048, 1024, 4 << 20
_rng = np.random.default_rng(20)
_SALT = _rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint32)
_FACTOR = _rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint32) | np.uint32(1)


def shingle_sets(items: list[str], k: int = 5) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text, A-Z in lower case."""
    words = Words([x.encode("utf-8", "replace") for x in items], lower=True)
    grams, at = words.grams(k)
    cut = np.searchsorted(at, words.first)
    out = []
    for i in range(len(items)):
        own = grams[cut[i] : cut[i + 1]]
        if not len(own) and words.first[i] < words.first[i + 1]:  # too few words: the sequence as a whole
            own = words.hash[words.first[i] : words.first[i] + 1]
            for j in range(words.first[i] + 1, words.first[i + 1]):
                own = joined_hash(own, words.hash[j : j + 1])
        out.append(np.unique(own))
    return out


def samples(sets: list[np.ndarray], block: int = 1 << 13) -> np.ndarray:
    """MinHash samples (row by set; empty sets have the largest numbers)."""
    out = np.full((len(sets), SAMPLES), 0xFFFFFFFF, np.uint32)
    at = 0
    while at < len(sets):
        hi, n = at, 0
        while hi < len(sets) and (hi == at or n + len(sets[hi]) <= block):
            n += len(sets[hi])
            hi += 1
        own = [i for i in range(at, hi) if len(sets[i])]
        if len(own) == 1 and n > block:  # a long text in parts
            for lo in range(0, n, block):
                part = sets[own[0]][lo : lo + block].astype(np.uint32)
                np.minimum(out[own[0]], ((part[None] ^ _SALT[:, None]) * _FACTOR[:, None]).min(1), out=out[own[0]])
        elif own:
            x = np.concatenate([sets[i] for i in own]).astype(np.uint32)
            start = np.cumsum([0, *(len(sets[i]) for i in own[:-1])])
            out[own] = np.minimum.reduceat((x[None] ^ _SALT[:, None]) * _FACTOR[:, None], start, axis=1).T
        at = hi
    return out


def band_keys(minima: np.ndarray) -> np.ndarray:
    """A key of each band (column), the band's number mixed in."""
    keys = np.empty((len(minima), BANDS), np.uint64)
    with np.errstate(over="ignore"):
        for b in range(BANDS):
            h = np.full(len(minima), b + 1, np.uint64)
            for r in range(ROWS):
                h = mix64(h ^ minima[:, b * ROWS + r].astype(np.uint64)) + np.uint64(b)
            keys[:, b] = h
    return keys.view(np.int64)


def odd_sketches(minima: np.ndarray) -> np.ndarray:
    """Bitmaps (rows of 64-bit words) in which each sample, with its number, flips a bit."""
    with np.errstate(over="ignore"):
        bit = mix64(minima.astype(np.uint64) + (np.arange(SAMPLES, dtype=np.uint64) << np.uint64(32))[None]) % np.uint64(BITS)
    flat = np.arange(len(minima))[:, None] * BITS + bit.astype(np.int64)
    odd = (np.bincount(flat.ravel(), minlength=len(minima) * BITS) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(len(minima), BITS), axis=1, bitorder="little").view(np.uint64)


def most_differing_bits(threshold: float) -> float:
    """The XOR's population count beyond which the estimate is SIGMAS deviations under the threshold."""
    least = max(0.0, threshold - SIGMAS * float(np.sqrt(threshold * (1 - threshold) / SAMPLES)))
    mean = BITS * (1 - np.exp(-4 * SAMPLES * (1 - least) / BITS)) / 2
    return float(mean + SIGMAS * np.sqrt(mean) / 2)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, digest (of the set; null if empty), keys, sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in columns_of(batches, 2 << 20):
            sets = shingle_sets(texts(batch))
            minima = samples(sets)
            keys, sketches = band_keys(minima), odd_sketches(minima)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(np.arange(0, keys.size + 1, BANDS, dtype=np.int32), pa.array(keys.ravel())),
                    pa.array([s.tobytes() for s in sketches], pa.binary()),
                ],
                ["doc_id", "n_shingles", "digest", "keys", "sketch"],
            )

    return in_arrow(docs.select("doc_id", "text"), run, "doc_id long, n_shingles long, digest binary, keys array<long>, sketch binary")


def _whole_groups(batches: Iterator[pa.RecordBatch], by: list[str], most: int = 1 << 15) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by the columns ``by``; a group is as large as a block pair at most."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < most:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        change = np.zeros(len(table), bool)
        for c in by:
            x = table.column(c).to_numpy()
            change[1:] |= x[1:] != x[:-1]
        cut = int(np.flatnonzero(change)[-1]) if change.any() else 0
        if cut:
            yield table.slice(0, cut)
            held = table.slice(cut).to_batches()
            rows = len(table) - cut
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _starts(table: pa.Table, by: list[str]) -> np.ndarray:
    change = np.ones(len(table), bool)
    change[1:] = False
    for c in by:
        x = table.column(c).to_numpy()
        change[1:] |= x[1:] != x[:-1]
    return np.append(np.flatnonzero(change), len(table))


def _pairs_of_small(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of all pairs within many small groups."""
    lefts, rights = [], []
    for s in np.unique(size):
        at = start[size == s]
        i, j = np.triu_indices(s, 1)
        lefts.append((at[:, None] + i[None]).ravel())
        rights.append((at[:, None] + j[None]).ravel())
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *lefts]), np.concatenate([none, *rights])


def _in_blocks(df: DataFrame, key: str, count: str, member: str, block: int) -> DataFrame:
    """A row for each pair of blocks that a member takes part in: lo, hi and its own block; small groups have one pair."""
    m = F.ceil(F.col(count) / block)
    df = df.withColumn("own", F.pmod(F.xxhash64(member, F.lit(7)), m).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), (m - 1).cast("int"))))
    df = df.withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other")).drop("other", count)
    return df.repartition(key, "lo", "hi").sortWithinPartitions(key, "lo", "hi")


def sketch_links(reps: DataFrame, threshold: float) -> DataFrame:
    """a, b: a forest of candidate links between classes (rep, n_shingles, keys, sketch) that share a band."""
    keyed = reps.select("rep", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    rows = keyed.join(shared, "key").join(reps.select("rep", "n_shingles", "sketch"), "rep")
    rows = _in_blocks(rows, "key", "members", "rep", BUCKET_BLOCK)
    most, by = most_differing_bits(threshold), ["key", "lo", "hi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, by):
            ids, n = table.column("rep").to_numpy(), table.column("n_shingles").to_numpy()
            own, lo, hi = (table.column(c).to_numpy() for c in ("own", "lo", "hi"))
            sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint64).reshape(len(table), -1)
            cuts = _starts(table, by)
            start, size = cuts[:-1], np.diff(cuts)
            lefts, rights, bits = [], [], []

            def compare(i: np.ndarray, j: np.ndarray) -> None:
                ok = (np.minimum(n[i], n[j]) >= threshold * np.maximum(n[i], n[j])) & (ids[i] != ids[j])
                i, j = i[ok], j[ok]
                count = np.bitwise_count(sketch[i] ^ sketch[j]).sum(1)
                ok = count <= most
                if ok.sum() > 4096:  # keeps what is held small
                    keep = np.flatnonzero(ok)[forest(ids[i[ok]], ids[j[ok]], -count[ok].astype(np.int64))]
                else:
                    keep = np.flatnonzero(ok)
                lefts.append(ids[i[keep]])
                rights.append(ids[j[keep]])
                bits.append(count[keep].astype(np.int64))

            few = (size > 1) & (size <= 64) & (lo[start] == hi[start])
            i, j = _pairs_of_small(start[few], size[few])
            for at in range(0, len(i), 1 << 17):
                compare(i[at : at + (1 << 17)], j[at : at + (1 << 17)])
            for s, e in zip(start[(size > 1) & ~few], (start + size)[(size > 1) & ~few], strict=True):
                mine = np.arange(s, e)
                if lo[s] == hi[s]:
                    for x in range(0, len(mine), 64):
                        i, j = np.meshgrid(mine[x : x + 64], mine[x:], indexing="ij")
                        up = i < j
                        compare(i[up], j[up])
                else:
                    first, second = mine[own[s:e] == lo[s]], mine[own[s:e] == hi[s]]
                    for x in range(0, len(first), 64):
                        i, j = np.meshgrid(first[x : x + 64], second, indexing="ij")
                        compare(i.ravel(), j.ravel())
            if lefts:
                a, b, w = np.concatenate(lefts), np.concatenate(rights), -np.concatenate(bits)
                keep = forest(a, b, w)
                yield pa.RecordBatch.from_arrays([pa.array(a[keep], pa.int64()), pa.array(b[keep], pa.int64())], ["a", "b"])

    return in_arrow(rows.select("key", "lo", "hi", "own", "rep", "n_shingles", "sketch"), run, "a long, b long")


def exact_links(sets: list[np.ndarray], percent: int, other: list[np.ndarray] | None = None, width: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of pairs with 100 * intersection >= percent * union; within sets, or between sets and other."""
    both = sets + (other or [])
    size = np.array([len(s) for s in both])
    n = len(sets)
    token, inverse, count = np.unique(np.concatenate(both), return_inverse=True, return_counts=True)
    rank = np.cumsum(count > 1) - 1  # only what at least two sets hold can be shared
    row = np.repeat(np.arange(len(both)), size)
    stay = (count > 1)[inverse]
    row, column = row[stay], rank[inverse[stay]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    shared = np.zeros((n, len(both) - n if other is not None else n), np.float32)  # counts under 2**24 are exact
    total = int(column[-1]) + 1 if len(column) else 0
    for lo in range(0, total, width):
        part = slice(*np.searchsorted(column, [lo, lo + width]))
        held = np.zeros((len(both), min(width, total - lo)), np.float32)
        held[row[part], column[part] - lo] = 1
        shared += held[:n] @ (held[n:] if other is not None else held).T
    shared = shared.astype(np.int64)
    union = size[:n, None] + (size[n:] if other is not None else size)[None] - shared
    linked = 100 * shared >= percent * union
    if other is None:
        linked = np.triu(linked, 1)
    return np.nonzero(linked)


def member_sets(docs: DataFrame, clusters: DataFrame, max_ids_sent: int = 2_000_000) -> DataFrame:
    """node, shingles of the documents in clusters (node, component)."""
    members = docs.select("doc_id", "text").join(bounded(clusters.select(F.col("node").alias("doc_id")), max_ids_sent), "doc_id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in columns_of(batches, 2 << 20):
            sets = [s.view(np.int64) for s in shingle_sets(texts(batch))]
            ends = np.cumsum([0, *map(len, sets)], dtype=np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.ListArray.from_arrays(ends, pa.array(np.concatenate(sets)))], ["node", "shingles"])

    return in_arrow(members, run, "node long, shingles array<long>")


def links_of_blocks(rows: DataFrame, percent: int) -> DataFrame:
    """a, b: a forest of the links within each block (component, lo, hi) of node, shingles, side.

    Rows of side 0 are compared with each other if there are no others, else with those of side 1.
    """
    by = ["component", "lo", "hi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, by, 4096):
            ids, side = table.column("node").to_numpy(), table.column("side").to_numpy()
            cells = table.column("shingles").combine_chunks()
            flat, ends = cells.values.to_numpy(), cells.offsets.to_numpy()
            sets = [flat[x:y] for x, y in zip(ends, ends[1:], strict=False)]
            cuts, lefts, rights = _starts(table, by), [], []
            for s, e in zip(cuts, cuts[1:], strict=False):
                mine = np.arange(s, e)
                first, second = mine[side[s:e] == 0], mine[side[s:e] == 1]
                if not len(first) or e - s < 2:
                    continue
                i, j = exact_links([sets[x] for x in first], percent, [sets[x] for x in second] if len(second) else None)
                if len(i):
                    a, b = ids[first[i]], ids[(second if len(second) else first)[j]]
                    keep = forest(a, b)
                    lefts.append(a[keep])
                    rights.append(b[keep])
            if lefts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in (lefts, rights)], ["a", "b"])

    rows = rows.repartition(*by).sortWithinPartitions(*by).select(*by, "side", "node", "shingles")
    return in_arrow(rows, run, "a long, b long")


def confirmed_links(docs: DataFrame, clusters: DataFrame, percent: int) -> DataFrame:
    """a, b: links confirmed on full sets that connect all that links within clusters (node, component, n_shingles) connect.

    A block has about CLUSTER_BLOCK members, or fewer, so that their sets hold about BLOCK_SHINGLES shingles.

    A cluster of one block is compared as a whole. A larger one is first dealt into blocks by two different hashes and
    compared within these, which gathers a tight cluster's members in one component; then only the members outside its
    cluster's largest component are compared with all members, in pairs of blocks.
    """
    per_block = F.least(F.lit(float(CLUSTER_BLOCK)), BLOCK_SHINGLES / F.avg("n_shingles"))
    sizes = clusters.groupBy("component").agg(F.ceil(F.count("*") / per_block).cast("int").alias("blocks"), per_block.alias("per_block"))
    rows = member_sets(docs, clusters).join(clusters.select("node", "component").join(sizes, "component"), "node")
    many = sizes.where("blocks > 1").limit(1).count() > 0
    rows = written(rows) if many else rows
    blocks = F.col("blocks")
    dealt = lambda df, turn, n: F.pmod(F.xxhash64("node", F.lit(turn)), n).cast("int")
    whole = lambda df, turn: df.withColumns({"lo": dealt(df, turn, blocks), "hi": F.lit(turn), "side": F.lit(0)})
    links = links_of_blocks(whole(rows, 0), percent)
    if not many:
        return links
    large = rows.where("blocks > 1")
    links = written(links.union(links_of_blocks(whole(large, 1), percent)))
    found = components(links)
    label = F.coalesce("label", "node")
    at = large.select("node", "component", "per_block").distinct().join(found.select("node", F.col("component").alias("label")), "node", "left").withColumn("label", label)
    parts = at.groupBy("component", "label").agg(F.count("*").alias("n"))
    main = parts.groupBy("component").agg(F.max_by("label", F.struct("n", "label")).alias("main"), (F.sum("n") - F.max("n")).alias("outside")).where("outside > 0")
    at = written(at.join(main, "component").select("node", "label", "main", F.ceil(F.col("outside") / F.col("per_block")).alias("others")))
    large = large.join(at, "node")
    others = F.col("others")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), (n - 1).cast("int")))
    outside = large.where("label <> main").withColumns({"lo": dealt(large, 2, others), "side": F.lit(0)}).withColumn("hi", all_of(blocks))
    every = large.withColumns({"hi": dealt(large, 3, blocks), "side": F.lit(1)}).withColumn("lo", all_of(others))
    cells = ("component", "lo", "hi", "side", "node", "shingles")
    return links.union(links_of_blocks(outside.select(*cells).union(every.select(*cells)), percent))


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row; links have 100 * intersection >= percent * union.

    Null and empty texts and texts without words have no shingles and are linked with nothing; under five words, the
    sequence is one shingle. component_id is the smallest doc_id reachable by links, kept is doc_id = component_id. Rows
    that share a doc_id are one node: what links one of them links all. Rows with a null doc_id have a null component_id
    and are kept. An empty table gives an empty table. Other columns are ignored. A text of any length is one set.
    """
    own = docs.select("doc_id", "text")
    sig = written(signatures(own))
    full = sig.where("doc_id is not null and digest is not null")
    reps = written(full.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch")))
    # one doc_id with several texts stands for each of them
    also = full.join(reps.select("digest", "rep"), "digest").where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    many = full.groupBy("doc_id").agg(F.count_distinct("digest").alias("n")).where("n > 1").select(F.col("doc_id").alias("a"))
    candidates = written(sketch_links(reps, percent / 100).distinct())
    clusters = written(components(candidates).join(reps.select(F.col("rep").alias("node"), "n_shingles"), "node").groupBy("node", "component").agg(F.max("n_shingles").alias("n_shingles")))
    links = confirmed_links(own.where("doc_id is not null"), clusters, percent)
    groups = written(components(links.union(also.join(many, "a", "left_semi"))))
    out = sig.join(reps.select("digest", "rep"), "digest", "left").withColumn("rep", F.coalesce("rep", "doc_id"))
    out = out.join(groups.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component_id", F.coalesce("component", "rep"))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, percent: int = 80) -> DataFrame:
    """Rows of docs whose doc_id is kept, with docs' columns; of rows that repeat a kept doc_id all stay.

    The dropped ids are sent to all executors only if there prove to be few enough; else the join moves rows by doc_id.
    """
    gone = near_duplicates(docs, percent).where("not kept").select(F.col("doc_id").alias("_gone"))
    gone = bounded(written(gone), 2_000_000)
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti").select(*docs.columns)
