"""Language-model scores by logistic context mixing, bit by bit, learnt from all training documents.

A text is read as its words (A-Z in lower case), each closed by a space, and one end. A word is coded in two steps.

1. A bit says whether it is the word that most often followed the word before it in the training documents. What predicts
   the bit are three contexts: how often that word and others came, how many such bits in a row were true just before, and
   the share of true ones among the last 32. Their learnt chances are mixed in the logistic domain by weights that the length
   of the run gates. Along a document the mixed chance is refined by what came true there in the same cell of contexts.
2. Unless that bit is true, the word is spelt. Every bit of its bytes is predicted by several predictors, each with bit
   counts of its own context: hashed tables for the last one to four bytes of the word so far, and exact counts for all of
   it. Their predictions are mixed in the logistic domain by weights that a gate picks (the bit's place, and how often the
   longest contexts have been seen), and a table of what came true at such a mixed prediction refines it. Two such models
   are mixed by what they foretold before. One has weights and a table that move along the document after every bit. The
   other's stay as learnt, and its chance is adapted by how much more often the word came in training documents of the
   same kind (documents with the same most frequent word, which is told first). Along the document the words that came
   before count as well (its words are draws from an urn that starts as ALPHA balls of the model).

Spelling as learnt depends on the word alone, so it is computed once for each distinct word, on tries of sorted words, and
so is what predicts the bits of a block's words. All else is computed for every word of every document in its place. Counts come from all training documents: bits' counts, counts of
words, of pairs of neighbours, and of the cells of step 1. Weights are the result of Newton's method on sums over all of
them, so that neither the order of rows nor their partitions change a score. While learning, an occurrence is taken out
of the counts that predict it; for step 1 also when a training document is scored, so that all documents are scored alike.

The hashed tables and the cells have a fixed size; counts of words and of their followers grow with the corpus and stay
distributed. Documents are looked up by blocks of texts, so that what is shuffled is a block's distinct words and pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandloom.llm import moving
from strandloom.llm.common import BASE, Words, columns_of, discard, in_arrow, mix64, released, texts, written
from strandloom.session import delete

#: Bytes of history of each hashed predictor, and the bits of its table's size. The last predictor counts the whole word.
ORDERS, SIZES = (1, 2, 3, 4), (16, 19, 21, 21)
#: Slots of a chunk of a table; pseudo-count of a bit; bytes of text in a block; words of a trie.
CHUNK, PRIOR, BLOCK_BYTES, TRIE_WORDS = 1 << 18, 0.2, 32 << 20, 1 << 17
#: Edges of a trie that are computed at once; words of a block that are packed together; bytes of a group of packed rows.
PART_EDGES, SLICE, ROW_GROUP = 1 << 14, 1 << 15, 16 << 20
#: The longest beginning of a word that the last predictor counts for all words that share it; beyond, a word's own counts.
SHARED = 64
#: Words of a trie are cut only where this many first bytes differ, so that from there on counts are whole.
WHOLE = max(ORDERS)
#: The most words of a trie; a larger group of words that share WHOLE bytes is counted in parts.
MOST_WORDS = 16 * TRIE_WORDS
ALPHA = 1000.0
#: Kinds of documents that are told apart, those with the most words, beside all others; what a word's share counts as.
KINDS, KIND_PRIOR = 7, 1.0
#: The end's bytes: no word holds them.
END = b"\n"
GATES, INPUTS = 8 * 6 * 4, len(ORDERS) + 2
#: Cells of the refinement: partial byte by mixed prediction.
STEPS = 33
#: Parts of 1 to which predictions and errors are rounded in sums for the weights, which are thereby exact; their prior.
PARTS, PART_X, RIDGE = 4096, 16, 10.0
#: Bounds of the buckets of a context of step 1, and their numbers: the likely follower's count, others' counts, run, share.
LIKELY, OTHERS, RUNS, RECENT = (2, 3, 5, 9), (1, 2, 4, 9, 33, 257), (1, 2, 3, 5, 9, 17), 7
SHAPE = (len(LIKELY) + 1, len(OTHERS) + 1, len(RUNS) + 1, RECENT)
CELLS = int(np.prod(SHAPE))
#: Bits of history that the share of true ones looks at, and what the learnt chance counts as along a document.
HISTORY, HELD = 32, 20.0
#: Parts that the followers of a very frequent word are dealt into, the share of all words that makes a word one, and words
#: of the training texts for a bucket of pairs.
DEALT, FREQUENT, BUCKET_WORDS = 64, 1000, 4 << 20
#: Weights before the step of Newton's method: mostly the longest contexts.
START = np.array([0.0, 0.1, 0.1, 0.2, 0.6, 0.0])
_LOGS = np.log(np.arange(1 << 16) + PRIOR)
#: Buckets of how often the longest context and the longest hashed one were seen, by that number, which the last entry bounds.
_LONGEST, _OTHER = np.digitize(np.arange(129), (1, 2, 4, 16, 128)), np.digitize(np.arange(65), (1, 8, 64))


def stretch(p: np.ndarray) -> np.ndarray:
    return np.log(p / (1 - p))


def squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.minimum(np.maximum(x, -20), 20)))


def hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word, or of the end."""
    out, own = np.full(len(words), 1, np.int64), np.array([w != END for w in words], bool)
    if own.any():
        out[own] = Words([b" ".join(w for w in words if w != END)], lower=False).hash.view(np.int64)
    return out


class Trie:
    """Edges (a byte after a history) of sorted distinct words: their contexts, and which edge each word has at each depth."""

    def __init__(self, words: list[bytes]) -> None:
        closed = [w if w == END else w + b" " for w in words]
        self.flat = np.frombuffer(b"".join(closed), np.uint8)
        self.length = np.fromiter(map(len, closed), np.int64, len(closed))
        self.start = np.concatenate([[0], np.cumsum(self.length)[:-1]]).astype(np.int64)
        n = len(words)
        common, alive = np.zeros(n, np.int64), np.arange(1, n)
        for d in range(SHARED):
            alive = alive[(self.length[alive] > d) & (self.length[alive - 1] > d)]
            alive = alive[self.flat[self.start[alive] + d] == self.flat[self.start[alive - 1] + d]]
            if not len(alive):
                break
            common[alive] = d + 1
        self.common = common
        # edges in order of (word, depth), depths from what the word shares with the one before it
        own = self.length - common
        self.word = np.repeat(np.arange(n), own)
        self.first = np.concatenate([[0], np.cumsum(own)])
        self.depth = np.arange(len(self.word)) - self.first[self.word] + common[self.word]
        self.byte = self.flat[self.start[self.word] + self.depth]

    def weights(self, count: np.ndarray) -> np.ndarray:
        """Occurrences of each edge."""
        out = count[self.word].astype(np.float64)
        for d in range(int(min(self.length.max(initial=0), SHARED))):
            starts = np.flatnonzero(self.common <= d)
            has = starts[self.length[starts] > d]
            total = np.add.reduceat(count.astype(np.float64), starts)
            out[self.first[has] + d - self.common[has]] = total[self.length[starts] > d]
        return out

    def sums(self, value: np.ndarray) -> np.ndarray:
        """For each word the sum of its edges' values."""
        total = np.concatenate([[0.0], np.cumsum(value)])
        out = total[self.first[1:]] - total[self.first[:-1]]  # edges of its own
        place = np.arange(len(self.length))
        for d in range(int(min(self.length.max(initial=0), SHARED))):
            shared = np.flatnonzero(self.common > d)
            if not len(shared):
                break
            holder = np.maximum.accumulate(np.where(self.common <= d, place, 0))[shared]
            out[shared] += value[self.first[holder] + d - self.common[holder]]
        return out

    def parents(self) -> np.ndarray:
        """For each edge the edge before it, by number; -1 for edges at depth 0."""
        out = np.arange(len(self.word)) - 1
        out[self.depth == 0] = -1
        place = np.arange(len(self.length))
        for d in range(1, int(min(self.length.max(initial=0), SHARED)) + 1):
            begins = np.flatnonzero((self.common == d) & (self.length > d))  # their first edge hangs on another word's
            holder = np.maximum.accumulate(np.where(self.common < d, place, 0))[begins]
            out[self.first[begins]] = self.first[holder] + d - 1 - self.common[holder]
        return out

    def siblings(self, weight: np.ndarray) -> Callable[[int], tuple[np.ndarray, np.ndarray]]:
        """A function of j: for each edge, of all edges after its history that share its byte's first j bits, how often a 0 and a 1 came next."""
        key = (self.parents() + 1) << 8 | self.byte
        order = np.argsort(key, kind="stable")
        key, weight, place = key[order], weight[order], np.empty(len(key), np.int64)
        place[order] = np.arange(len(key))
        total = np.concatenate([[0.0], np.cumsum(weight)])

        def counts(j: int) -> tuple[np.ndarray, np.ndarray]:
            begins = np.concatenate([[True], key[1:] >> (8 - j) != key[:-1] >> (8 - j)])
            starts = np.append(np.flatnonzero(begins), len(key))
            one = np.concatenate([[0.0], np.cumsum(weight * ((key >> (7 - j)) & 1))])
            of, one, both = (np.cumsum(begins) - 1).take(place), np.diff(one[starts]), np.diff(total[starts])
            return (both - one).take(of), one.take(of)

        return counts

    def paths(self) -> np.ndarray:
        """The edges of each word, one word after the other."""
        out = np.empty(len(self.flat), np.int64)
        out[self.start[self.word] + self.depth] = np.arange(len(self.word))
        place = np.arange(len(self.length))
        for d in range(int(min(self.length.max(initial=0), SHARED))):
            shared = np.flatnonzero(self.common > d)
            if not len(shared):
                break
            holder = np.maximum.accumulate(np.where(self.common <= d, place, 0))[shared]
            out[self.start[shared] + d] = self.first[holder] + d - self.common[holder]
        return out

    def turns(self, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each word how many turns it has, and all words' turns: where words that began alike leave it, and how often they came.

        With a word's own count that is all of siblings() for its bytes after the first WHOLE. A turn's upper 16 bits are 9 times
        the depth, and 1 more than the bit; 0 more if they leave between two bytes (beyond SHARED). The lower 48 are the occurrences.
        """
        edges, places, left = [], [], []
        counts, deep, parent = self.siblings(weight), self.depth >= WHOLE, self.parents()
        for j in range(8):
            zero, one = counts(j)
            bit = (self.byte >> (7 - j)) & 1
            if j == 0:
                whole = zero + one
            lost = np.where(bit == 1, zero, one)
            some = np.flatnonzero(deep & (lost > 0))
            edges.append(some)
            places.append(self.depth[some] * 9 + 1 + j)
            left.append(lost[some])
        lost = np.where(parent >= 0, np.where(bit == 1, one, zero)[parent] - whole, 0)
        some = np.flatnonzero(deep & (self.depth > WHOLE) & (lost > 0))
        edge, place, n = (np.concatenate(x).astype(np.int64) for x in ([*edges, some], [*places, self.depth[some] * 9], [*left, lost[some]]))
        order = np.lexsort((place, edge))
        value, path = (place << 48 | n)[order], self.paths()
        of = np.bincount(edge, minlength=len(self.word))
        begin, of = (np.cumsum(of) - of)[path], of[path]
        ends = np.cumsum(of)
        at = np.repeat(begin - (ends - of), of) + np.arange(int(of.sum()))
        return np.diff(np.concatenate([[0], ends])[np.append(self.start, len(self.flat))]), value[at]

    def turned(self, count: np.ndarray, of: np.ndarray, turns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each edge and bit how often a 0 and a 1 came next, from its word's own count and turns; 0 before WHOLE bytes."""
        word, place = np.repeat(np.arange(len(of)), of), turns >> 48
        own = place // 9 >= self.common[word]  # others belong to edges of a word before
        word, place, n = word[own], place[own], turns[own] & ((1 << 48) - 1)
        lost = np.zeros((len(self.word), 9), np.int64)
        lost[self.first[word] + place // 9 - self.common[word], place % 9] = n
        after = np.append(np.cumsum(lost.ravel()[::-1])[::-1], 0)
        both = after[:-1].reshape(-1, 9) - (after[self.first[1:] * 9] - count)[self.word][:, None]
        lost, same = lost[:, 1:], both[:, 1:] - lost[:, 1:]
        bit, deep = np.unpackbits(self.byte[:, None], axis=1) == 1, (self.depth >= WHOLE)[:, None]
        return np.where(deep, np.where(bit, lost, same), 0), np.where(deep, np.where(bit, same, lost), 0)

    def contexts(self) -> np.ndarray:
        """A hash of each hashed predictor's context for every edge (row by predictor)."""
        at = self.start[self.word] + self.depth  # of the byte to predict
        out = np.zeros((len(ORDERS), len(at)), np.uint64)
        h = np.full(len(at), 1, np.uint64)
        with np.errstate(over="ignore"):
            for i in range(max(ORDERS)):
                byte = self.flat[np.maximum(at - i - 1, 0)].astype(np.uint64) + np.uint64(1)
                h = np.where(i < self.depth, h * np.uint64(BASE) + byte, h)
                if i + 1 in ORDERS:
                    out[ORDERS.index(i + 1)] = mix64(h + np.uint64(i))
        return out


def _slots(context: np.ndarray, partial: np.ndarray, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (((context + partial.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) * np.uint64(BASE)) >> np.uint64(64 - bits)).astype(np.int64)


def shortened(of: np.ndarray, turns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words' turns as bytes, and how many each word has: the step from the turn before and the occurrences, 7 bits a byte."""
    place, n, begin = turns >> 48, turns & ((1 << 48) - 1), (np.cumsum(of) - of)[of > 0]
    step = np.diff(place, prepend=0)
    step[begin] = place[begin] - 9 * WHOLE
    values = np.stack([step, n], 1).ravel()
    size = 1 + sum((values >> 7 * k > 0).astype(np.int64) for k in range(1, 7))
    ends = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(ends[-1], np.uint8)
    for k in range(7):
        some = np.flatnonzero(size > k)
        out[ends[some] + k] = (values[some] >> 7 * k) & 127 | (size[some] > k + 1) << 7
    return np.diff(ends[2 * np.concatenate([[0], np.cumsum(of)])]), out


def lengthened(size: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many turns each word has, and the turns, from what shortened made of them."""
    last = np.flatnonzero(data < 128)
    begin = np.concatenate([[0], last[:-1] + 1])[: len(last)]
    at = np.arange(len(data)) - np.repeat(begin, last + 1 - begin)
    values = np.add.reduceat((data & 127).astype(np.int64) << 7 * at, begin) if len(data) else np.zeros(0, np.int64)
    of = np.diff(np.searchsorted(last, np.concatenate([[0], np.cumsum(size)]))) // 2
    step, n, word = values[::2], values[1::2], np.repeat(np.arange(len(of)), of)
    place = np.cumsum(step)
    before = np.append(0, place)[np.cumsum(of) - of]
    return of, (place - before[word] + 9 * WHOLE) << 48 | n


def _flat(x: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Of binary cells, none null: their lengths, and their bytes."""
    ends = np.frombuffer(x.buffers()[1], np.int32, len(x) + 1, 4 * x.offset)
    return np.diff(ends), np.frombuffer(x.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]


def _binary(size: np.ndarray, data: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])


def _tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """About TRIE_WORDS rows at a time, from batches sorted by token."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= TRIE_WORDS:
            table = pa.Table.from_batches(held)
            begin = [t[:WHOLE] for t in table.column("token").to_pylist()]
            cut = next((i for i in range(len(begin) - 1, 0, -1) if begin[i] != begin[i - 1]), 0)
            if cut or len(begin) > MOST_WORDS:
                cut = cut or len(begin)
                yield table.slice(0, cut)
                held = table.slice(cut).to_batches()
                rows = len(table) - cut
    if rows:
        yield pa.Table.from_batches(held)


def _columns(table: pa.Table) -> tuple[list[bytes], np.ndarray]:
    return table.column("token").to_pylist(), table.column("c").to_numpy()


def counted(vocabulary: DataFrame) -> list[np.ndarray]:
    """The predictors' tables: for each slot how often a 0 and a 1 came, scaled to 16 bits; learnt from token, c."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [np.zeros((1 << s, 2)) for s in SIZES]
        for words, c in map(_columns, _tries(batches)):
            trie = Trie(words)
            weight, contexts = trie.weights(c), trie.contexts()
            partial = np.ones(len(trie.byte), np.int64)
            for j in range(8):
                bit = (trie.byte >> (7 - j)) & 1
                for i, size in enumerate(SIZES):
                    np.add.at(tables[i].reshape(-1), 2 * _slots(contexts[i], partial, size) + bit, weight)
                partial = 2 * partial + bit
        pack = zstandard.ZstdCompressor(level=1)
        for i, t in enumerate(tables):
            for lo in range(0, len(t), CHUNK):
                part = t[lo : lo + CHUNK]
                if part.any():
                    yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([lo // CHUNK], pa.int32()), pa.array([pack.compress(part.tobytes())])], ["i", "chunk", "data"])

    def add(batches: Iterator[pa.RecordBatch], last: bool) -> Iterator[pa.RecordBatch]:
        total, key = None, None
        unpack, pack = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)

        def done() -> pa.RecordBatch:
            out = total
            if last:  # each slot has a scale of its own, as only the ratio of its two counts matters
                scale = np.maximum(1, total.max(axis=1, keepdims=True) / 65535)
                out = np.minimum(np.ceil(total / scale), 65535).astype(np.uint16)
            return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([pack.compress(out.tobytes())])], ["i", "chunk", "data"])

        for batch in batches:
            for i, chunk, data in zip(*(batch.column(c).to_pylist() for c in ("i", "chunk", "data")), strict=True):
                part = np.frombuffer(unpack.decompress(data), np.float64).reshape(-1, 2)
                if (i, chunk) != key:
                    if key:
                        yield done()
                    total, key = np.zeros(part.shape), (i, chunk)
                total += part
        if key:
            yield done()

    schema = "i int, chunk int, data binary"
    # two levels, so that no task gathers what many partitions made of one chunk
    parts = in_arrow(vocabulary, count, schema).withColumn("salt", F.spark_partition_id() % 64)
    parts = parts.repartition("i", "chunk", "salt").sortWithinPartitions("i", "chunk", "salt").select("i", "chunk", "data")
    parts = in_arrow(parts, lambda batches: add(batches, False), schema)
    parts = in_arrow(parts.repartition("i", "chunk").sortWithinPartitions("i", "chunk"), lambda batches: add(batches, True), schema)
    tables = [np.zeros((1 << s, 2), np.uint16) for s in SIZES]
    for row in parts.toLocalIterator():  # at most the tables' fixed size
        data = np.frombuffer(zstandard.ZstdDecompressor().decompress(row.data), np.uint16).reshape(-1, 2)
        tables[row.i][row.chunk * CHUNK : row.chunk * CHUNK + len(data)] = data
    return tables


class Mixer:
    """Weights by gate, and the refinement."""

    def __init__(self, tables: list[np.ndarray], weights: np.ndarray | None = None, seen: np.ndarray | None = None) -> None:
        self.tables = [t[:, 0] | t[:, 1].astype(np.uint32) << 16 for t in tables]  # a slot's two counts as one number
        self.weights = np.tile(START, (GATES, 1)) if weights is None else weights
        self.by_input = np.ascontiguousarray(self.weights.T)
        # (came true, came at all) of each cell, started as if the mixed prediction were right
        middle = squash((np.arange(STEPS) - STEPS // 2) / 2.0)
        total = np.stack([np.broadcast_to(middle, (256, STEPS)), np.ones((256, STEPS))], -1) * 20.0
        if seen is not None:
            total = total + seen
        self.refine = total[..., 0] / total[..., 1]

    def inputs(self, contexts: np.ndarray, whole: tuple[np.ndarray, np.ndarray], deep: np.ndarray, partial: np.ndarray, j: int, bit: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Stretched predictions (row by predictor) and gates; with bit, one occurrence of it is taken out first.

        deep: whether WHOLE bytes or more came before. For the first bytes the longest hashed context is the whole word, of
        which a trie may hold a part.
        """
        x = np.empty((INPUTS, len(partial)))
        x[-1] = 0.3
        for i, size in enumerate(SIZES):
            n = self.tables[i].take(_slots(contexts[i], partial, size))
            zero, one = (n & 0xFFFF).astype(np.int64), (n >> 16).astype(np.int64)
            if bit is not None:
                zero -= (zero > 0) & (bit == 0)
                one -= (one > 0) & (bit == 1)
            np.subtract(_LOGS.take(one), _LOGS.take(zero), out=x[i])
        total, (zero, one) = zero + one, whole
        if bit is not None:
            zero, one = zero - ((zero > 0) & (bit == 0)), one - ((one > 0) & (bit == 1))
        x[-2] = np.where(deep, np.log((one + PRIOR) / (zero + PRIOR)), x[-3])
        longest = _LONGEST.take(np.minimum(np.where(deep, zero + one, total), 128).astype(np.int64))
        return x, (j * 6 + longest) * 4 + _OTHER.take(np.minimum(total, 64))

    def mixed(self, x: np.ndarray, gate: np.ndarray) -> np.ndarray:
        out = self.by_input[0].take(gate) * x[0]
        for i in range(1, INPUTS):
            out += self.by_input[i].take(gate) * x[i]
        return out

    def cell(self, mixed: np.ndarray) -> np.ndarray:
        return np.minimum(np.maximum(np.rint(mixed * 2) + STEPS // 2, 0), STEPS - 1).astype(np.int64)

    def bits(self, trie: Trie, weight: np.ndarray, without: bool) -> Iterator[tuple]:
        """For each bit and parts of the edges: the part, the partial byte, the bit, inputs and gates."""
        contexts, counts, deep, byte = trie.contexts(), trie.siblings(weight), trie.depth >= WHOLE, trie.byte.astype(np.int64)
        for j in range(8):
            zero, one = counts(j)
            for at in range(0, len(byte), PART_EDGES):
                part = slice(at, at + PART_EDGES)
                partial, bit = (byte[part] | 256) >> (8 - j), (byte[part] >> (7 - j)) & 1
                yield part, partial, bit, *self.inputs(contexts[:, part], (zero[part], one[part]), deep[part], partial, j, bit if without else None)

    def spelling(self, tokens: pa.Array, count: np.ndarray, turns: pa.Array) -> moving.Spelling:
        """What the bits of these words are predicted by, from their own counts and turns; SLICE words in a trie, as counts are whole."""
        words, n = tokens.to_pylist(), 0
        order = np.array(sorted(range(len(words)), key=words.__getitem__))
        parts: list[tuple[np.ndarray, ...]] = []
        for lo in range(0, len(order), SLICE):
            some = order[lo : lo + SLICE]
            trie = Trie([words[i] for i in some])
            zero, one = trie.turned(count[some], *lengthened(*_flat(turns.take(pa.array(some)))))
            contexts, deep, byte = trie.contexts(), trie.depth >= WHOLE, trie.byte.astype(np.int64)
            x, gates = np.empty((len(byte), 8, INPUTS - 1), np.int8), np.empty((len(byte), 8), np.uint8)
            for at in range(0, len(byte), PART_EDGES):
                part = slice(at, at + PART_EDGES)
                for j in range(8):
                    own, gates[part, j] = self.inputs(contexts[:, part], (zero[part, j], one[part, j]), deep[part], (byte[part] | 256) >> (8 - j), j, None)
                    x[part, j] = np.rint(np.clip(own[:-1] * moving.PARTS, -127, 127)).T
            parts.append((trie.length, (trie.paths() + n).astype(np.int32), trie.byte, x, gates))
            n += len(byte)
        held = [list(p) for p in zip(*parts, strict=True)]
        parts.clear()
        length, path, byte, gates, x = (np.concatenate(held.pop(k)) for k in (0, 0, 0, 1, 0))  # whose parts are freed one after the other
        place = np.empty(len(words), np.int64)
        place[order] = np.arange(len(words))
        begin, length = (np.cumsum(length) - length)[place], length[place]
        first = np.concatenate([[0], np.cumsum(length)])
        path = path[np.repeat(begin - first[:-1], length) + np.arange(len(path))]
        return moving.Spelling(first, path, byte, x, gates)

    def slopes(self, trie: Trie, weight: np.ndarray) -> np.ndarray:
        """By gate the gradient and the upper half of the curvature of the log likelihood, in whole numbers of units."""
        out = np.zeros((GATES, INPUTS + len(_UPPER)))
        for part, _, bit, x, gate in self.bits(trie, weight, True):
            p, c = squash(self.mixed(x, gate)), weight[part]
            order = np.argsort(gate.astype(np.uint8), kind="stable")  # by gate, of which there are under 256
            gate = gate[order]
            starts = np.flatnonzero(np.concatenate([[True], gate[1:] != gate[:-1]]))
            x = np.rint(x * PART_X).take(order, axis=1)
            error, bend = ((c * y).take(order) for y in (np.rint((bit - p) * PARTS), np.ceil(p * (1 - p) * PARTS)))
            values = np.empty((INPUTS + len(_UPPER), len(gate)))
            np.multiply(x, error, out=values[:INPUTS])
            for a in range(INPUTS):
                lo = INPUTS + _UPPER.index((a, a))
                np.multiply(x[a:], bend * x[a], out=values[lo : lo + INPUTS - a])
            out[gate[starts]] += np.add.reduceat(values, starts, axis=1).T
        return out

    def came(self, trie: Trie, weight: np.ndarray) -> np.ndarray:
        """Of each cell of the refinement how often a 1 came, and how often any."""
        out = np.zeros((256 * STEPS, 2))
        for part, partial, bit, x, gate in self.bits(trie, weight, True):
            cell, c = partial * STEPS + self.cell(self.mixed(x, gate)), weight[part]
            out[:, 0] += np.bincount(cell, c * bit, 256 * STEPS)
            out[:, 1] += np.bincount(cell, c, 256 * STEPS)
        return out

    def log10(self, trie: Trie, weight: np.ndarray) -> np.ndarray:
        """log10 of each edge's probability."""
        out = np.ones(len(trie.byte))
        for part, partial, bit, x, gate in self.bits(trie, weight, False):
            mixed = self.mixed(x, gate)
            p = np.minimum(np.maximum((squash(mixed) + self.refine.take(partial * STEPS + self.cell(mixed))) / 2, 1e-6), 1 - 1e-6)
            out[part] *= np.where(bit == 1, p, 1 - p)
        return np.log10(out)


_UPPER = [(a, b) for a in range(INPUTS) for b in range(a, INPUTS)]


def newton(start: np.ndarray, slope: np.ndarray, bend: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Weights after a step of Newton's method by gate, which no weight leaves by more than 1."""
    out = start.copy()
    for g in range(len(start)):
        out[g] += np.clip(np.linalg.solve(bend[g] + ridge * np.eye(len(slope[g])), slope[g]), -1, 1)
    return out


def _packed(tables: list[np.ndarray]) -> list[bytes]:
    return [zstandard.ZstdCompressor(level=3).compress(t.tobytes()) for t in tables]


def _unpacked(packed: list[bytes]) -> list[np.ndarray]:
    return [np.frombuffer(zstandard.ZstdDecompressor().decompress(p), np.uint16).reshape(-1, 2) for p in packed]


def _summed(vocabulary: DataFrame, size: int, run) -> np.ndarray:
    """The sum of run(words, counts), an array of that size, over all tries: size rows come to the driver."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, step = np.zeros(size), run()
        for words, c in map(_columns, _tries(batches)):
            total += step(words, c).ravel()
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["i", "x"])

    out = np.zeros(size)
    for r in in_arrow(vocabulary, each, "i long, x double").groupBy("i").agg(F.sum("x").alias("x")).collect():
        out[r.i] = r.x
    return out


def fitted(vocabulary: DataFrame) -> tuple[Broadcast, np.ndarray, np.ndarray]:
    """Tables (packed and sent to the executors), weights and the refinement's counts from all of token, c, sorted within partitions."""
    sent = vocabulary.sparkSession.sparkContext.broadcast(_packed(counted(vocabulary)))  # of at most the tables' fixed size

    def step(method: str, weights: np.ndarray | None):
        def make():
            mixer = Mixer(_unpacked(sent.value), weights)

            def one(words: list[bytes], c: np.ndarray) -> np.ndarray:
                trie = Trie(words)
                return getattr(mixer, method)(trie, trie.weights(c))

            return one

        return make

    start = np.tile(START, (GATES, 1))
    sums = _summed(vocabulary, GATES * (INPUTS + len(_UPPER)), step("slopes", start)).reshape(GATES, -1)
    bend = np.zeros((GATES, INPUTS, INPUTS))
    for i, (a, b) in enumerate(_UPPER):
        bend[:, a, b] = bend[:, b, a] = sums[:, INPUTS + i] / (PARTS * PART_X**2)
    weights = newton(start, sums[:, :INPUTS] / (PARTS * PART_X), bend)
    return sent, weights, _summed(vocabulary, 256 * STEPS * 2, step("came", weights)).reshape(256, STEPS, 2)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln of the gamma function for x > 0, by Stirling's series after eight steps up."""
    step = np.ones_like(x)
    for i in range(8):
        step = step * (x + i)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - np.log(step)


class _Numbers(dict):
    """Word -> its number in order of first use; tokens has them in this order."""

    def __init__(self, tokens: list[bytes]) -> None:
        super().__init__((t, i) for i, t in enumerate(tokens))
        self.tokens = tokens

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        self.tokens.append(word)
        return n


class _Block:
    """Words of a run of texts, numbered in order of first use; the end is number 0."""

    def __init__(self, name: int) -> None:
        self.name, self.numbers, self.size = name, _Numbers([END]), 0
        self.learnt: list[np.ndarray] = []  # training texts
        self.kinds: list[int] = []  # and their most frequent words

    def add(self, text: str, out: bool) -> tuple[np.ndarray, int]:
        """The text's words as numbers, and the number of its most frequent one, ties to the smaller; an empty text's end."""
        words = text.encode("utf-8", "replace").lower().split()  # white space of bytes is the contract's
        self.size += len(text) + 1
        own = np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words))
        kind = 0
        if len(own):
            some, n = np.unique(own, return_counts=True)
            kind = min(some[n == n.max()].tolist(), key=self.numbers.tokens.__getitem__)
        own = np.append(own, np.int32(0))
        if not out:
            self.learnt.append(own)
            self.kinds.append(kind)
        return own, kind

    def words(self) -> Iterator[dict]:
        """The block's words, SLICE at a time: their hashes, their occurrences in training texts by kind and the words (1), and their followers (2)."""
        tokens, pack = self.numbers.tokens, zstandard.ZstdCompressor(level=3)
        n = len(tokens)
        flat = np.concatenate([np.zeros(1, np.int32), *self.learnt]).astype(np.int64)  # a text's first word follows an end
        pair, times = np.unique(flat[:-1] * n + flat[1:], return_counts=True)
        ends = np.searchsorted(pair, np.arange(n + 1) * n)
        h = hashes(tokens)
        follower, times = h.astype(np.int32)[pair % n], times.astype(np.int32)
        kind = np.repeat(np.array(self.kinds, np.int64), [len(x) for x in self.learnt])
        kind, of = np.unique(flat[1:] * n + kind, return_counts=True)
        kind_ends = np.searchsorted(kind, np.arange(n + 1) * n)
        kind, of = h[kind % n], of.astype(np.int32)
        for lo in range(0, n, SLICE):
            hi = min(n, lo + SLICE)
            own, its = slice(ends[lo], ends[hi]), slice(kind_ends[lo], kind_ends[hi])
            length = np.fromiter(map(len, tokens[lo:hi]), np.int32, hi - lo)
            parts = [h[lo:hi], np.diff(kind_ends[lo : hi + 1]).astype(np.int32), kind[its], of[its], length]
            yield {"kind": [1], "block": [self.name], "id": [lo], "data": [pack.compress(b"".join([np.int32([hi - lo]).tobytes(), *(x.tobytes() for x in parts), *tokens[lo:hi]]))]}
            parts = [h[lo:hi], np.diff(ends[lo : hi + 1]).astype(np.int32), follower[own], times[own]]
            yield {"kind": [2], "data": [pack.compress(b"".join([np.int32([hi - lo]).tobytes(), *(x.tobytes() for x in parts)]))]}


def _hashed(data: bytes) -> tuple[bytes, int, np.ndarray, np.ndarray, int]:
    """Of packed words: what is unpacked, how many words, their hashes, the lengths of their lists, and where these begin."""
    x = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(x, np.int32, 1)[0])
    return x, n, np.frombuffer(x, np.int64, n, 4), np.frombuffer(x, np.int32, n, 4 + 8 * n), 4 + 12 * n


def counts_by_kind(words: DataFrame, named: list[int]) -> DataFrame:
    """token, c, k0, k1, ...: occurrences in training texts, and of those in texts of the named kinds, of each block's words."""
    order = np.argsort(np.array(named, np.int64))
    known = np.array(named, np.int64)[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("data").to_pylist():
                x, n, _, size, at = _hashed(data)
                m = int(size.sum())
                kind, of, length = np.frombuffer(x, np.int64, m, at), np.frombuffer(x, np.int32, m, at + 8 * m), np.frombuffer(x, np.int32, n, at + 12 * m)
                word = np.repeat(np.arange(n), size)
                found = np.full(m, KINDS)
                if len(known):
                    near = np.minimum(np.searchsorted(known, kind), len(known) - 1)
                    found = np.where(known[near] == kind, order[near], KINDS)
                count = np.bincount(found * n + word, of, (KINDS + 1) * n).astype(np.int64).reshape(-1, n)
                ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                tokens = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(x[at + 12 * m + 4 * n :])])
                yield pa.RecordBatch.from_arrays([tokens, pa.array(count.sum(0)), *map(pa.array, count[:KINDS])], ["token", "c", *(f"k{k}" for k in range(KINDS))])

    return in_arrow(words.select("data"), run, "token binary, c long" + "".join(f", k{k} long" for k in range(KINDS)))


def places(words: DataFrame) -> DataFrame:
    """of, id, h: each block's words by number and hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for of, first, data in zip(*(batch.column(c).to_pylist() for c in ("block", "id", "data")), strict=True):
                _, n, h, *_ = _hashed(data)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, of)), pa.array(np.arange(first, first + n, dtype=np.int32)), pa.array(h)], ["of", "id", "h"])

    return in_arrow(words.select("block", "id", "data"), run, "of long, id int, h long")


BLOCKS = "kind int, block long, docs array<long>, outs array<boolean>, sizes array<int>, bytes array<long>, texts binary, kinds array<long>, id int, data binary"
_TYPES = {"long": pa.int64(), "boolean": pa.bool_(), "int": pa.int32(), "binary": pa.binary()}


def _arrow(kind: str) -> pa.DataType:
    return pa.list_(_TYPES[kind[6:-1]]) if kind.startswith("array") else _TYPES[kind]


def blocks(docs: DataFrame) -> DataFrame:
    """Runs of texts as numbers of their block's words, in order and packed (kind 0), the blocks' words (kind 1) and their followers (kind 2)."""
    fields = [tuple(x.split(" ")) for x in BLOCKS.split(", ")]

    def batch(have: dict, n: int = 1) -> pa.RecordBatch:
        cells = [pa.array(have[f], _arrow(t)) if f in have else pa.nulls(n, _arrow(t)) for f, t in fields]
        return pa.RecordBatch.from_arrays(cells, [f for f, _ in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 24  # a task that is repeated gives its blocks the same numbers
        block, pack = _Block(first), zstandard.ZstdCompressor(level=3)

        def closed() -> Iterator[pa.RecordBatch]:
            for own in block.words():
                yield batch(own)

        for b in columns_of(batches, 4 << 20):
            if block.size >= BLOCK_BYTES:
                yield from closed()
                block = _Block(block.name + 1)
            held_out, items = b.column("held_out").to_pylist(), texts(b)
            own, kinds = zip(*(block.add(t, out) for t, out in zip(items, held_out, strict=True)), strict=True)
            kinds = hashes([block.numbers.tokens[k] for k in kinds])
            sizes = [len(t.encode("utf-8", "replace")) for t in items]
            packed = pack.compress(np.concatenate(own).view(np.uint8).reshape(-1, 4).T.tobytes())  # low bytes first, the mostly empty high ones last
            yield batch({"kind": [0], "block": [block.name], "docs": [b.column("doc_id").to_pylist()], "outs": [held_out], "sizes": [list(map(len, own))], "bytes": [sizes], "texts": [packed], "kinds": [kinds]})
        if block.size:
            yield from closed()

    return in_arrow(docs.select("doc_id", "text", "held_out"), run, BLOCKS)


def likeliest(words: DataFrame, frequent: list[int], buckets: int) -> DataFrame:
    """h, follower (32 bits of its hash), ctop, ctot: of each word's followers the most frequent one, its count, and all counts.

    words: h, followers, times by block, or data that packs them. Words are dealt into buckets, those of the few frequent ones with their followers.
    What is shuffled are the packed arrays of a bucket's words and followers, a few bytes for each pair.
    """
    often = np.array(sorted(frequent), np.int64)
    packed = "data" in words.columns

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        for batch in batches:
            if not packed:
                own = batch.column("followers"), batch.column("times")
                yield batch.column("h").to_numpy(), np.diff(own[0].offsets.to_numpy()), own[0].flatten().to_numpy(), own[1].flatten().to_numpy()
                continue
            for data in batch.column("data").to_pylist():
                x, _, h, n, at = _hashed(data)
                yield h, n, *np.frombuffer(x, np.int32, offset=at).reshape(2, -1)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, held, size = zstandard.ZstdCompressor(level=1), [], 0

        def dealt() -> pa.RecordBatch:
            h, follower, times = (np.concatenate(x) for x in zip(*held, strict=True))
            dealt = np.where(np.isin(h, often), follower.astype(np.int64) % DEALT, 0)
            with np.errstate(over="ignore"):
                bucket = (mix64(h.view(np.uint64) + dealt.astype(np.uint64) * np.uint64(BASE)) % np.uint64(buckets)).astype(np.int64)
            order = np.lexsort((h, bucket))
            bucket, h, follower, times = bucket[order], h[order], follower[order], times[order]
            starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            rows = []
            for s, e in zip(starts, np.append(starts[1:], len(h)), strict=True):
                first = np.flatnonzero(np.concatenate([[True], h[s + 1 : e] != h[s : e - 1]]))
                own = [np.array([len(first)], np.int32), h[s:e][first], np.diff(np.append(first, e - s)).astype(np.int32), follower[s:e], times[s:e]]
                rows.append(pack.compress(b"".join(x.tobytes() for x in own)))
            return pa.RecordBatch.from_arrays([pa.array(bucket[starts]), pa.array(rows, pa.binary())], ["bucket", "data"])

        for h, n, follower, times in unpacked(batches):
            held.append((np.repeat(h, n), follower, times))
            size += len(follower)
            if size > 1 << 21:
                yield dealt()
                held, size = [], 0
        if size:
            yield dealt()

    def top(data: list[bytes]) -> pa.RecordBatch:
        hs, followers, counts = [], [], []
        for x in data:
            x, _, h, size, at = _hashed(x)
            rest = np.frombuffer(x, np.int32, offset=at).reshape(2, -1)
            hs.append(np.repeat(h, size))
            followers.append(rest[0])
            counts.append(rest[1])
        h, follower, times = np.concatenate(hs), np.concatenate(followers).view(np.uint32), np.concatenate(counts)
        order = np.lexsort((follower, h))
        h, follower, times = h[order], follower[order].astype(np.int64), times[order].astype(np.int64)
        pair = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (follower[1:] != follower[:-1])]))
        count, h, follower = np.add.reduceat(times, pair), h[pair], follower[pair]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        # of equal counts the smaller hash
        best = np.maximum.reduceat(np.minimum(count, (1 << 31) - 1) << 32 | (0xFFFFFFFF - follower), first)
        return pa.RecordBatch.from_arrays([pa.array(h[first]), pa.array(best), pa.array(np.add.reduceat(count, first))], ["h", "best", "ctot"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for bucket, data in zip(batch.column("bucket").to_pylist(), batch.column("data").to_pylist(), strict=True):
                if bucket != now and held:
                    yield top(held)
                    held = []
                now = bucket
                held.append(data)
        if held:
            yield top(held)

    some = words.select("data") if packed else words.where("size(followers) > 0").select("h", "followers", "times")
    rows = in_arrow(some, deal, "bucket long, data binary")
    rows = in_arrow(rows.repartition("bucket").sortWithinPartitions("bucket"), run, "h long, best long, ctot long")
    rows = rows.groupBy("h").agg(F.max("best").alias("best"), F.sum("ctot").alias("ctot"))
    low = F.lit(0xFFFFFFFF) - F.col("best").bitwiseAND(F.lit(0xFFFFFFFF))
    return rows.select("h", low.alias("follower"), F.shiftright("best", 32).alias("ctop"), "ctot")


#: What is known of a block's words: the type of each column.
KNOWN = {"id": np.int32, "c": np.int64, "score": np.float32, "own": np.uint32, "follower": np.uint32, "ctop": np.int64, "ctot": np.int64} | {f"k{k}": np.int64 for k in range(KINDS)}
#: And each word's bytes and turns.
LISTS = ("token", "turns")


def bundled(looked: DataFrame, most: int = 1 << 19) -> DataFrame:
    """of, data: KNOWN's columns, tokens and turns of the words of each block, packed for many words at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, held, rows = zstandard.ZstdCompressor(level=1), [], 0

        def done() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            of = table.column("of").to_numpy()
            tokens = table.column("token").to_pylist()
            order = np.array(sorted(range(len(tokens)), key=tokens.__getitem__))
            order = order[np.argsort(of[order], kind="stable")]  # by token within a block, so that words share beginnings with those before
            of = of[order]
            columns = {c: table.column(c).fill_null(0).to_numpy().astype(t)[order] for c, t in KNOWN.items()}
            lists = [table.column(c).combine_chunks().take(pa.array(order)) for c in LISTS]
            starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
            data = []
            for s, e in zip(starts, np.append(starts[1:], len(of)), strict=True):
                cells = [part.tobytes() for x in lists for part in _flat(x.slice(s, e - s))]
                data.append(pack.compress(b"".join([np.int32([e - s]).tobytes(), *(x[s:e].tobytes() for x in columns.values()), *cells])))
            return pa.RecordBatch.from_arrays([pa.array(of[starts]), pa.array(data, pa.binary())], ["of", "data"])

        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= most:
                yield done()
                held, rows = [], 0
        if rows:
            yield done()

    return in_arrow(looked.select("of", *KNOWN, *LISTS), run, "of long, data binary")


def unbundled(data: list[bytes]) -> dict[str, np.ndarray | pa.Array]:
    """KNOWN's columns of all of a block's words, in order of their numbers, and LISTS as binary cells."""
    parts: dict[str, list] = {c: [] for c in [*KNOWN, *LISTS]}
    for x in data:
        x = zstandard.ZstdDecompressor().decompress(x)
        n, at = int(np.frombuffer(x, np.int32, 1)[0]), 4
        for c, t in KNOWN.items():
            parts[c].append(np.frombuffer(x, t, n, at))
            at += n * np.dtype(t).itemsize
        for c in LISTS:
            size = np.frombuffer(x, np.int32, n, at)
            m = int(size.sum())
            parts[c].append(_binary(size, np.frombuffer(x, np.uint8, m, at + 4 * n)))
            at += 4 * n + m
    order = np.argsort(np.concatenate(parts["id"]))
    return {c: pa.concat_arrays(v).take(pa.array(order)) if c in LISTS else np.concatenate(v)[order] for c, v in parts.items()}


class Chances:
    """Learnt chances of step 1's bit, by cell, from how often it was true and false in each cell."""

    def __init__(self, true: np.ndarray, false: np.ndarray, rounds: int = 20) -> None:
        at = np.array(np.unravel_index(np.arange(CELLS), SHAPE))
        likely, others, run, recent = at
        sure = (likely > others).astype(np.int64)
        inputs = []
        for context in (likely * SHAPE[1] + others, run * 2 + sure, recent * SHAPE[1] + others):
            t, f = np.bincount(context, true), np.bincount(context, false)
            inputs.append(np.log((t + 0.4) / (f + 0.4))[context])
        x = np.stack([*inputs, np.full(CELLS, 0.3)], 1)
        n, weights = true + false, np.full((SHAPE[2], x.shape[1]), 0.3)
        for _ in range(rounds):
            p = squash((x * weights[run]).sum(1))
            slope, bend = np.zeros(weights.shape), np.zeros((*weights.shape, x.shape[1]))
            np.add.at(slope, run, ((true - n * p))[:, None] * x)
            np.add.at(bend, run, (n * p * (1 - p))[:, None, None] * x[:, :, None] * x[:, None, :])
            weights = newton(weights, slope - 0.1 * (weights - 0.3), bend, 0.1)
        p = squash((x * weights[run]).sum(1))
        self.p = np.clip((true + HELD * p) / (n + HELD), 1e-6, 1 - 1e-6)

    def log10(self, cell: np.ndarray, true: np.ndarray, false: np.ndarray) -> np.ndarray:
        """log10 of the probability of that many true and false bits of a cell in a document, refined by those before."""
        a, b = HELD * self.p[cell], HELD * (1 - self.p[cell])
        rise = lambda x, n: log_gamma(x + n) - log_gamma(x)
        return (rise(a, true) + rise(b, false) - rise(a + b, true + false)) / np.log(10)


def _cells(hit: np.ndarray, valid: np.ndarray, likely: np.ndarray, others: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The cell of each word's bit; start: of its document, by word."""
    at = np.arange(len(hit))
    last = np.maximum.accumulate(np.where(hit, -1, at))  # the last word that was not foretold
    run = at - np.maximum(last, start - 1)  # foretold ones in a row, this one included
    before = np.where(at > start, np.concatenate([[0], run[:-1]]), 0)
    low = np.maximum(start, at - HISTORY)
    true, all_ = (np.concatenate([[0], np.cumsum(x)]) for x in (hit, valid))
    true, all_ = true[at] - true[low], all_[at] - all_[low]
    recent = np.where(all_ > 0, 1 + np.minimum(RECENT - 2, (RECENT - 1) * true // np.maximum(all_, 1)), 0)
    return np.ravel_multi_index((np.digitize(likely, LIKELY), np.digitize(others, OTHERS), np.digitize(before, RUNS), recent), SHAPE)


def read_texts(ids: np.ndarray, sizes: np.ndarray, held_out: np.ndarray, kind: np.ndarray, know: dict[str, np.ndarray], shares: np.ndarray, sums: np.ndarray, spelling: moving.Spelling | None = None) -> tuple:
    """For each of some texts (words' numbers, one text after the other): log10 of the spelt words, and its cells.

    kind: of each text. know, by number: c, score (log10 of the spelling), own (32 bits of the hash), follower, ctop, ctot,
    and kinds (row by kind: its share of c); shares: the kinds' shares of all words; sums: over all words of the chances
    adapted to a kind. With spelling, columns for moving.spelt take the place of the first result. Cells: the text's index, the cell, and how often the bit was true and false.
    """
    start = np.cumsum(sizes) - sizes
    text, first = np.repeat(np.arange(len(sizes)), sizes), np.repeat(start, sizes)
    at = np.arange(len(ids))
    prev = np.concatenate([[0], ids[:-1]])
    prev[start] = 0  # an end
    learnt = np.repeat(~held_out, sizes).astype(np.int64)
    all_, top = know["ctot"][prev], know["ctop"][prev]
    hit = (all_ > 0) & (know["follower"][prev] == know["own"][ids])
    top, all_ = top - hit * learnt, all_ - learnt
    valid = top > 0
    hit &= valid
    cell = _cells(hit, valid, top, all_ - top, first)
    code, n = np.unique((text * CELLS + cell)[valid] * 2 + hit[valid], return_counts=True)
    # how often each word came in its text before
    order = np.argsort(text * (int(ids.max()) + 1) + ids, kind="stable")
    begins = np.concatenate([[True], (ids[order[1:]] != ids[order[:-1]]) | (text[order[1:]] != text[order[:-1]])])
    came = np.empty(len(ids), np.int64)
    came[order] = at - np.maximum.accumulate(np.where(begins, at, 0))
    own = np.repeat(kind, sizes)
    of, c = np.maximum(know["kinds"][own, ids] - learnt, 0), np.maximum(know["c"][ids] - learnt, 0)
    s = know["score"][ids] + np.log10((of + KIND_PRIOR * shares[own]) / (c + KIND_PRIOR) / shares[own] / sums[own])
    rest = code // 2 // CELLS, code // 2 % CELLS, np.where(code % 2 == 1, n, 0), np.where(code % 2 == 0, n, 0)
    if spelling is not None:
        return spelling.columns(ids, sizes, ~hit, s, came), *rest
    # the logarithm is at hand even where the chance is too small for a number
    spelt = np.where(came == 0, s + np.log10(ALPHA), np.log10(ALPHA * 10.0**s + np.maximum(came, 1e-300))) - np.log10(ALPHA + at - first)
    return np.add.reduceat(np.where(hit, 0.0, spelt), start), *rest


def scored(docs: DataFrame, modulus: int = 7, held: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte of every row.

    Held out, and not learnt from, are rows whose crc32 of the doc_id as text leaves ``held`` modulo ``modulus``; a null
    doc_id counts as the empty string. Null and empty texts are one end. score: log10 of the model's probability of the
    words and the end, in their order, where a training document's own pairs of neighbours are taken out of the counts;
    base_score: add-one counts of single tokens; bits_per_byte: over the bytes of the whole text in UTF-8 (one at least).
    Repeated rows are all learnt from and scored. Without any training row the counts are all 0. An empty table gives an
    empty table. Other columns are ignored. A word's and a text's length are not limited. Counts, weights and refinement
    come from all training documents, whole ones; the order of rows and their partitions change no score.
    """
    spark = docs.sparkSession
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (F.crc32(F.encode(name, "UTF-8")) % modulus == held).alias("held_out"))
    made = written(blocks(rows), "kind", row_group=ROW_GROUP)
    words = made.where("kind = 1")
    kinds = made.where("kind = 0").select(F.explode(F.arrays_zip("kinds", "outs", "sizes")).alias("x")).where("not x.outs")
    kinds = kinds.groupBy(F.col("x.kinds").alias("h")).agg(F.sum("x.sizes").alias("words"), F.count("*").alias("texts"))
    named = kinds.orderBy(F.desc("words"), "h").limit(KINDS).collect()
    rest = kinds.agg(F.sum("words"), F.sum("texts")).first()
    # of words and of documents: each kind's share, the last one's is what is left
    size = np.array([[r.words, r.texts] for r in named] + [[0, 0]] * (KINDS + 1 - len(named)), np.float64)
    size[KINDS] = np.array([x or 0 for x in rest]) - size.sum(0)
    shares, texts_of = ((size + 1) / (size + 1).sum(0)).T
    # words without training text have no kind but are scored all the same
    cells = counts_by_kind(words, [r.h for r in named])
    totals = cells.groupBy("token").agg(*(F.sum(c).alias(c) for c in cells.columns[1:]))
    n_parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    totals = written(totals)
    vocabulary = written(totals.repartitionByRange(n_parts, F.expr(f"substring(token, 1, {WHOLE})")).sortWithinPartitions("token"))
    discard(totals)
    n, v = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    sent, weights, seen = fitted(vocabulary.select("token", "c").where("c > 0"))
    of = [f"k{k}" for k in range(KINDS)]

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer = Mixer(_unpacked(sent.value), weights, seen)
        for table in _tries(batches):
            tokens, c = _columns(table)
            trie = Trie(tokens)
            weight = trie.weights(c)
            turns = _binary(*shortened(*trie.turns(weight)))
            cells = [pa.array(hashes(tokens)), pa.array(c), pa.array(trie.sums(mixer.log10(trie, weight))), table.column("token").combine_chunks(), turns]
            cells += [table.column(k).combine_chunks() for k in of]
            yield from pa.Table.from_arrays(cells, ["h", "c", "score", *LISTS, *of]).to_batches(SLICE)

    each = written(in_arrow(vocabulary, spell, "h long, c long, score double, token binary, turns binary" + "".join(f", {k} long" for k in of)))
    last = F.col("c") - sum((F.col(k) for k in of), F.lit(0))
    chance = F.pow(F.lit(10.0), "score")
    adapted = [chance * (x + KIND_PRIOR * p) / (F.col("c") + KIND_PRIOR) / p for x, p in zip([*map(F.col, of), last], shares.tolist(), strict=True)]
    one, *sums = each.agg(F.sum(chance), *map(F.sum, adapted)).first()
    sums = np.array([1.0 if x is None else 1 - one + x for x in sums])
    discard(vocabulary)
    frequent = [r.h for r in each.where(F.col("c") * FREQUENT > n).select("h").collect()]  # fewer than FREQUENT rows
    tops = written(likeliest(made.where("kind = 2"), frequent, max(n_parts, n // BUCKET_WORDS)))  # which frees what it has shuffled
    delete(spark, f"{made._work_path}/kind=2")
    placed = written(places(words))
    delete(spark, f"{made._work_path}/kind=1")
    both = each.join(tops, "h", "left")
    # by the hash of 64 bits: words that shared one would be looked up as one another
    looked = placed.join(both, "h").select("of", "id", "c", "score", *LISTS, *of, F.col("h").bitwiseAND(F.lit(0xFFFFFFFF)).alias("own"), "follower", "ctop", "ctot")
    facts = written(bundled(looked))  # before the texts are shuffled, so that less lies on disk at once
    discard(each)
    discard(tops)
    discard(placed)

    def read(own: pa.Table, looked: pa.Table) -> pa.Table:
        know = unbundled(looked.column("data").to_pylist())
        know["score"] = know["score"].astype(np.float64)
        kinds = [know[c] for c in of]
        know["kinds"] = np.stack([*kinds, know["c"] - np.sum(kinds, axis=0)])
        know["base"] = np.log10((know["c"] + 1) / (n + 1 * (v + 1)))
        spelling = Mixer(_unpacked(sent.value), weights, seen).spelling(know.pop("token"), know["c"], know.pop("turns"))
        released()
        out = []
        for i in range(len(own)):
            doc, held_out, sizes, size, kind = (own.column(c)[i].values for c in ("docs", "outs", "sizes", "bytes", "kinds"))
            kind = np.array([at_kind.get(h, KINDS) for h in kind.to_pylist()], np.int64)
            ids = np.frombuffer(zstandard.ZstdDecompressor().decompress(own.column("texts")[i].as_py()), np.uint8).reshape(4, -1).T.copy().view(np.int32).ravel().astype(np.int64)
            sizes = sizes.to_numpy().astype(np.int64)
            start = np.cumsum(sizes) - sizes
            columns, text, cell, true, false = read_texts(ids, sizes, held_out.to_numpy(zero_copy_only=False).astype(bool), kind, know, shares, sums, spelling)
            cuts = pa.array(np.searchsorted(text, np.arange(len(sizes) + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(cuts, pa.array(x.astype(np.int32))) for x in (cell, true, false)]
            known, base = np.add.reduceat((know["c"][ids] > 0).astype(np.int64), start), np.add.reduceat(know["base"][ids], start)
            cells = [doc, held_out, size, pa.array(sizes), pa.array(known), pa.array(base), pa.array(np.log10(texts_of[kind])), *lists]
            cells = [pa.ListArray.from_arrays(pa.array([0, len(sizes)], pa.int32()), x) for x in cells] + [pa.array([x], pa.binary()) for x in columns.values()]
            out.append(pa.RecordBatch.from_arrays(cells, [*names, *columns]))
        return pa.Table.from_batches(out)

    at_kind = {r.h: k for k, r in enumerate(named)}
    types = {"doc_id": "long", "held_out": "boolean", "n_bytes": "long", "n_tokens": "long", "n_known": "long", "base_score": "double", "told": "double"}
    types |= {c: "array<int>" for c in ("cells", "true", "false")}
    names = list(types)
    schema = ", ".join([f"{c} array<{t}>" for c, t in types.items()] + [f"{c} binary" for c in moving.COLUMNS])
    documents = made.where("kind = 0").select("block", "docs", "outs", "sizes", "bytes", "kinds", "texts")
    found = documents.groupBy("block").cogroup(facts.groupBy("of")).applyInArrow(read, schema)
    found = found.select(*names, moving.spelt(spark, weights, Mixer([], weights, seen).refine, ALPHA).alias("spelt"))
    found = written(found.select(F.inline(F.arrays_zip(*names, "spelt"))).withColumn("spelt", F.col("spelt") + F.col("told")).drop("told"))

    true, false = np.zeros(CELLS), np.zeros(CELLS)
    discard(facts)
    discard(made)
    cells = found.where("not held_out").select(F.explode(F.arrays_zip("cells", "true", "false")).alias("x"))
    for r in cells.groupBy(F.col("x.cells").alias("cell")).agg(F.sum("x.true").alias("t"), F.sum("x.false").alias("f")).collect():  # CELLS rows at most
        true[r.cell], false[r.cell] = r.t, r.f
    chances = Chances(true, false)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in columns_of(batches):
            cell, t, f = (batch.column(c).flatten().to_numpy() for c in ("cells", "true", "false"))
            ends = batch.column("cells").offsets.to_numpy()
            total = np.concatenate([[0.0], np.cumsum(chances.log10(cell, t, f))])
            out = batch.column("spelt").to_numpy() + total[ends[1:] - ends[0]] - total[ends[:-1] - ends[0]]
            bits = -out / np.log10(2) / np.maximum(batch.column("n_bytes").to_numpy(), 1)
            same = [batch.column(c) for c in ("doc_id", "held_out", "n_tokens", "n_known")]
            rest = [pa.array(np.full(batch.num_rows, n, np.int64)), batch.column("base_score"), pa.array(out), pa.array(bits)]
            yield pa.RecordBatch.from_arrays(same + rest, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"])

    return in_arrow(found, score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double")
