"""Byte-level BPE encoding and decoding by monoid tree reduction.

Encoding a piece splits its bytes in halves recursively, down to one or two bytes. Two encoded neighbours are joined by
re-encoding a window of tokens around the seam, which grows until both pairs of tokens at the window's edges are stable. A
pair is stable if the encoding of its joined bytes is the pair itself; a sequence in which all neighbours are stable is the
encoding of its bytes, so tokens outside such a window cannot change. Decoding concatenates tokens' byte strings pairwise up
a tree.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import operator
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame

from strandloom.llm.common import columns_of, in_arrow, texts
from strandloom.llm.pretoken import pretokens

#: Bytes of a leaf of the tree, and of a window that is re-encoded by merging; a longer one is halved again.
LEAF, WINDOW = 2, 96
#: Pieces in each of a worker's two generations, the longest piece that goes there, and what is known of pairs and windows.
CACHE_ENTRIES, CACHE_PIECE, STABLE_ENTRIES = 300_000, 48, 200_000


class _Known(dict):
    """What a function gave for a key; starts afresh beyond STABLE_ENTRIES."""

    def __init__(self, of: Callable) -> None:
        super().__init__()
        self.of = of

    def __missing__(self, key: bytes | tuple[int, int]) -> list[int] | None:
        if len(self) >= STABLE_ENTRIES:
            self.clear()
        self[key] = out = self.of(key)
        return out


class TreeCodec(dict):
    """ranks: bytes of each token -> id. As a dict: piece -> its ids, little-endian unsigned 32-bit, filled on demand."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        super().__init__()
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.older: dict[str, bytes] = {}  # pieces of the generation before
        self.leaves, self.windows, self.pairs = _Known(self._leaf), _Known(self.merged), _Known(self._pair)
        self.joins = 0  # of two halves of a piece

    def __missing__(self, piece: str) -> bytes:
        if (out := self.older.get(piece)) is None:
            ids = self.encode(piece.encode("utf-8", "replace"))
            out = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= CACHE_PIECE:
            if len(self) >= CACHE_ENTRIES:  # pieces that are still in use come back from the older ones
                self.older = dict(self)
                self.clear()
            self[piece] = out
        return out

    def merged(self, data: bytes) -> list[int]:
        """What a short run of bytes is encoded to: neighbours of the lowest rank are joined, leftmost first, until none can be."""
        if (whole := self.ranks.get(data)) is not None:
            return [whole]
        get, none = self.ranks.get, 1 << 62
        parts = [data[i : i + 1] for i in range(len(data))]
        ranks = [get(data[i : i + 2], none) for i in range(len(data) - 1)]
        while ranks and (low := min(ranks)) != none:
            i = ranks.index(low)
            parts[i : i + 2] = [joined := parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = get(parts[i - 1] + joined, none)
            if i < len(ranks):
                ranks[i] = get(joined + parts[i + 1], none)
        return [self.ranks[p] for p in parts]

    def _leaf(self, data: bytes) -> list[int]:
        if (whole := self.ranks.get(data)) is not None:
            return [whole]
        return [self.ranks[data[i : i + 1]] for i in range(len(data))]

    def _pair(self, pair: tuple[int, int]) -> list[int] | None:
        """The encoding of two tokens' bytes, None if it is the two: the pair is stable."""
        out = self.merged(self.bytes_of[pair[0]] + self.bytes_of[pair[1]])
        return None if out == [*pair] else out

    def window(self, data: bytes) -> list[int]:
        """The encoding of a boundary window's bytes."""
        return self._halves(data) if len(data) > WINDOW else self.windows[data]

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two neighbours' bytes from their encodings."""
        if not left or not right:
            return left + right
        pairs, i, j = self.pairs, 1, 1
        if (inner := pairs[left[-1], right[0]]) is None:
            return left + right
        while True:
            left_ok = i >= len(left) or pairs[left[-i - 1], inner[0]] is None
            right_ok = j >= len(right) or pairs[inner[-1], right[j]] is None
            if left_ok and right_ok:
                return left[: len(left) - i] + inner + right[j:]
            i, j = (i if left_ok else min(len(left), 2 * i)), (j if right_ok else min(len(right), 2 * j))
            inner = self.window(b"".join(map(self.bytes_of.__getitem__, left[-i:] + right[:j])))

    def _halves(self, data: bytes) -> list[int]:
        half = len(data) // 2
        self.joins += 1
        left = self.leaves[data[:half]] if half <= LEAF else self._halves(data[:half])
        right = self.leaves[data[half:]] if len(data) - half <= LEAF else self._halves(data[half:])
        return self.join(left, right)

    def encode(self, data: bytes) -> list[int]:
        """The ids of a piece's bytes."""
        return self._halves(data) if len(data) > LEAF else self._leaf(data)

    def encode_text(self, text: str) -> bytes:
        """Ids of a text, little-endian unsigned 32-bit."""
        return b"".join(map(self.__getitem__, pretokens(text)))

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of ids: those of each token, joined pairwise up the tree."""
        level = list(map(self.bytes_of.__getitem__, ids)) or [b""]
        while len(level) > 1:
            odd = level[-1:] if len(level) % 2 else []
            level = [*map(operator.add, level[::2], level[1::2]), *odd]
        return level[0]


@functools.lru_cache(2)
def codec(path: str) -> TreeCodec:
    with open(path, "rb") as f:
        return TreeCodec({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})


def encode_decode(docs: DataFrame, vocabulary: str = "byte_bpe_multi_50k.tiktoken", with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text; with_ids adds ids (array of int) and decoded (binary).

    Null texts are empty texts: no tokens, the digests of no bytes. Repeated rows and doc_ids (also null ones) give a
    row each. Other columns of docs are ignored. Memory of a task: one slice of texts and a cache of bounded size; a
    text is encoded whole. Special tokens are ordinary text.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded binary" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = codec(public_tokenizers.path(vocabulary))
        for batch in columns_of(batches, 4 << 20):
            rows = []
            for text in texts(batch):
                packed = tree.encode_text(text)
                ids = np.frombuffer(packed, "<u4")
                decoded = tree.decode(ids.tolist())
                row = (len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded).hexdigest())
                rows.append((*row, ids.astype(np.int32), decoded) if with_ids else row)
            n, ids_sha, decoded_sha, *more = zip(*rows, strict=True)
            out = [batch.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(decoded_sha)]
            if more:
                out += [pa.array(more[0], pa.list_(pa.int32())), pa.array(more[1], pa.binary())]
            yield pa.RecordBatch.from_arrays(out, [c.split()[0] for c in schema.split(", ")])

    return in_arrow(docs.select("doc_id", "text"), run, schema)
