"""Removal of long passages that an earlier document holds too, by De Bruijn compaction of sampled token k-mers.

1. Of the k-mers of each window of ``length`` words the one with the smallest hash is sampled, so equal windows sample the
   same k-mer. Consecutive samples of a document are joined by an edge, labelled with a hash of the words they span.
2. Samples that occur in several documents are the graph's nodes. A join tells every occurrence its node's smallest
   document and whether all occurrences of the node have the same edge before and after them. Runs of edges that do not
   branch compact to paths: whoever holds one node of a path holds all its words, so windows inside a path are repeated in
   exactly the documents of their sampled node.
3. Windows that reach beyond a path or over a branch are compared by a 128-bit digest of the words at their coordinates.
4. Source coordinates of repeated windows are merged to spans, and their words are removed.

Edges' labels and windows' digests are cryptographic (blake2b) and taken from the words themselves at their coordinates, so
no text can be built that makes unequal passages pass for equal ones. Samples' own hashes decide only what is compared: two
k-mers that shared one would have edges with other labels, a branch, and their windows would be compared by digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm.common import Words, bounded, columns_of, in_arrow, texts, written

LENGTH, K = 50, 16
#: Bits of a sample's rank that hold its place in a slice of texts, which decides between equal hashes.
PLACE = 28


def _sampled(words: Words, length: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of windows (word indexes), and the word index of each window's sampled k-mer."""
    n = len(words.hash) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams, at = words.grams(k)
    rank = np.full(len(words.hash), np.iinfo(np.uint64).max, np.uint64)
    low = np.uint64((1 << PLACE) - 1)
    rank[at] = (grams & ~low) | at.astype(np.uint64)
    width, least = length - k + 1, rank
    span = 1
    while 2 * span <= width:  # minima of spans of 1, 2, 4 ... k-mers, then of two that overlap
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if width > span:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    start = np.flatnonzero(words.doc[:n] == words.doc[length - 1 :])
    return start, (least[start] & low).astype(np.int64)


def _digests(words: Words, start: np.ndarray, end: np.ndarray, size: int) -> np.ndarray:
    """Digests of the words from start up to end (word indexes), as rows of 64-bit integers, of ``size`` bytes in all."""
    if not len(start):
        return np.zeros((0, size // 8), np.int64)
    if not hasattr(words, "joined"):  # all words with one space between, once for a slice of texts
        words.joined = b" ".join(words.data.split())
        words.place = np.concatenate([[0], np.cumsum(words.end - words.start + 1)])
    data, hashed = words.joined, hashlib.blake2b
    ends = words.place[end] - 1
    out = [hashed(data[s:e], digest_size=size).digest() for s, e in zip(words.place[start].tolist(), ends.tolist(), strict=True)]
    return np.frombuffer(b"".join(out), np.int64).reshape(len(out), size // 8)


def sampled_kmers(docs: DataFrame, length: int = LENGTH, k: int = K) -> DataFrame:
    """doc_id, row (hash of the text), n_words, sha (of all words), and arrays node, at, edge (to the next; 0: none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in columns_of(batches, 4 << 20):
            words = Words([t.encode("utf-8", "replace") for t in texts(batch)], lower=False)
            _, chosen = _sampled(words, length, k)
            chosen = np.unique(chosen)
            grams, at = words.grams(k)
            node = grams[np.searchsorted(at, chosen)]
            edge = np.zeros(len(chosen), np.int64)
            follows = words.doc[chosen[1:]] == words.doc[chosen[:-1]]
            edge[:-1][follows] = _digests(words, chosen[:-1][follows], chosen[1:][follows] + k, 8)[:, 0] | 1
            ends = np.searchsorted(words.doc[chosen], np.arange(batch.num_rows + 1)).astype(np.int32)
            place = (chosen - words.first[words.doc[chosen]]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (node.view(np.int64), place, edge)]
            sha = [hashlib.sha256(b" ".join(words.data[s:e] for s, e in zip(words.start[a:b].tolist(), words.end[a:b].tolist(), strict=True))).hexdigest() for a, b in zip(words.first, words.first[1:], strict=False)]
            head = [batch.column("doc_id").cast(pa.int64()), batch.column("row"), pa.array(np.diff(words.first), pa.int64()), pa.array(sha)]
            yield pa.RecordBatch.from_arrays(head + lists, ["doc_id", "row", "n_words", "sha", "node", "at", "edge"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), "text")
    return in_arrow(rows, run, "doc_id long, row long, n_words long, sha string, node array<long>, at array<int>, edge array<long>")


def located(sampled: DataFrame) -> DataFrame:
    """doc_id, row and arrays at, first, next, before: samples of documents that hold a repeated one.

    first: the smallest document with that node (null if there is one document only); next and before: whether all
    occurrences of the node have the same edge after it and before it.
    """
    cells = F.arrays_zip("at", "node", "edge", F.expr("transform(edge, (x, i) -> if(i = 0, 0L, edge[greatest(i - 1, 0)]))").alias("back"))
    each = sampled.where("doc_id is not null").select("doc_id", "row", F.explode(cells).alias("c")).select("doc_id", "row", "c.at", "c.node", "c.edge", "c.back")
    degree = lambda c: (F.min(c) == F.max(c)) & (F.min(c) != 0)
    nodes = each.groupBy("node").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), degree("edge").alias("next"), degree("back").alias("before")).where("first < last")
    nodes = written(nodes)  # a join of two exchanges, which adaptive execution can split where a node is very common
    found = each.select("doc_id", "row", "at", "node").join(nodes.drop("last"), "node")
    return found.groupBy("doc_id", "row").agg(F.array_sort(F.collect_set(F.struct("at", "first", "next", "before"))).alias("samples"))


def _windows(batch: pa.RecordBatch, length: int, k: int) -> Iterator[tuple]:
    """For each text: its words, the windows sampled at a repeated node, their nodes' first document, and which are settled.

    A window is settled if it lies inside a compacted path.
    """
    all_words = Words([t.encode("utf-8", "replace") for t in texts(batch)], lower=False)
    starts, chosen = _sampled(all_words, length, k)
    for i, samples in enumerate(batch.column("samples").to_pylist()):
        base = all_words.first[i]
        a, b = np.searchsorted(starts, [base, all_words.first[i + 1]])
        own, picked = starts[a:b] - base, chosen[a:b] - base
        every = np.unique(picked)  # all sampled places of the text
        at = np.array([s["at"] for s in samples], np.int64)
        where = np.searchsorted(every, at)
        first, after, before = np.full(len(every), -1, np.int64), np.zeros(len(every), bool), np.zeros(len(every), bool)
        known = np.zeros(len(every), bool)
        known[where] = True
        first[where] = [s["first"] for s in samples]
        after[where], before[where] = [s["next"] for s in samples], [s["before"] for s in samples]
        link = after[:-1] & before[1:] & known[:-1] & known[1:]  # from each sample to the next: no branch on either side
        breaks = np.concatenate([[0], np.cumsum(~link)])  # equal for two samples: the same path
        index = np.searchsorted(every, picked)
        ok = known[index] if len(every) else np.zeros(0, bool)
        own, index = own[ok], index[ok]
        left = np.searchsorted(every, own, side="right") - 1  # the last sample at or before the window
        right = np.searchsorted(every + k, own + length)  # the first that ends with it or after
        settled = (left >= 0) & (right < len(every))
        settled[settled] = breaks[left[settled]] == breaks[right[settled]]
        yield all_words, i, own, first[index], settled


def open_windows(held: DataFrame, length: int = LENGTH, k: int = K) -> DataFrame:
    """doc_id, row, at, h1, h2 of the windows at repeated nodes that no path settles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in columns_of(batches, 4 << 20):
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            docs, rows = batch.column("doc_id").to_numpy(), batch.column("row").to_numpy()
            for words, i, own, _, settled in _windows(batch, length, k):
                own = own[~settled]
                if not len(own):
                    continue
                start = own + words.first[i]
                both = _digests(words, start, start + length, 16)
                for x, y in zip(out, (np.full(len(own), docs[i]), np.full(len(own), rows[i]), own.astype(np.int32), both[:, 0], both[:, 1]), strict=True):
                    x.append(y)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], ["doc_id", "row", "at", "h1", "h2"])

    return in_arrow(held, run, "doc_id long, row long, at int, h1 long, h2 long")


def removed(held: DataFrame, length: int = LENGTH, k: int = K, with_text: bool = False) -> DataFrame:
    """doc_id, row, n_removed, kept_sha256 of documents with text, samples and repeated (starts of open windows)."""
    schema = "doc_id long, row long, n_removed long, kept_sha256 string" + ", kept string" * with_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in columns_of(batches, 4 << 20):
            out = []
            docs, rows, repeated = batch.column("doc_id").to_pylist(), batch.column("row").to_pylist(), batch.column("repeated").to_pylist()
            for words, i, own, first, settled in _windows(batch, length, k):
                a, b = words.first[i], words.first[i + 1]
                starts = np.concatenate([own[settled & (first < docs[i])], np.array(repeated[i] or [], np.int64)])
                change = np.zeros(b - a + 1, np.int64)
                np.add.at(change, starts, 1)
                np.add.at(change, starts + length, -1)
                stay = np.flatnonzero(np.cumsum(change)[:-1] == 0) + a
                kept = b" ".join(words.data[s:e] for s, e in zip(words.start[stay].tolist(), words.end[stay].tolist(), strict=True))
                row = (docs[i], rows[i], int(b - a - len(stay)), hashlib.sha256(kept).hexdigest())
                out.append((*row, kept.decode("utf-8", "replace")) if with_text else row)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], [c.split()[0] for c in schema.split(", ")])

    return in_arrow(held, run, schema)


def without_repeats(docs: DataFrame, length: int = LENGTH, k: int = K, with_text: bool = False, max_rows_sent: int = 1_000_000) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row (and kept, the words left, joined by a space; null: all).

    A word goes if a window of ``length`` consecutive words covers it whose words also stand together in a document with
    a smaller doc_id; windows are judged on the input. Null and empty texts have no words; texts under ``length`` words
    lose nothing. Rows with a null doc_id lose nothing and are not looked at by others. Rows that share a doc_id are not
    earlier than each other. Repeats within one document stay. An empty table gives an empty table; other columns are
    ignored. ``max_rows_sent`` bounds what is broadcast to pick the texts that hold a repeated sample.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("row", F.xxhash64("text"))
    sampled = written(sampled_kmers(own, length, k))
    places = written(located(sampled))
    some = own.join(bounded(places.select("doc_id", "row"), max_rows_sent), ["doc_id", "row"], "left_semi").distinct()
    held = written(some.join(places, ["doc_id", "row"]))
    open_ = written(open_windows(held, length, k))
    firsts = open_.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    firsts = written(firsts)  # so that the join below can split very common windows
    later = open_.join(firsts, ["h1", "h2"]).where("first < doc_id").groupBy("doc_id", "row").agg(F.collect_list("at").alias("repeated"))
    done = removed(held.join(later, ["doc_id", "row"], "left"), length, k, with_text)
    out = sampled.select("doc_id", "row", "n_words", "sha").join(done, ["doc_id", "row"], "left")
    named = [F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("kept_sha256", "sha").alias("kept_sha256")]
    return out.select("doc_id", "n_words", *named, *(["kept"] if with_text else []))
