"""Token counts by rank-synchronous array merging.

Pre-tokens of a batch are held as one ragged array: symbols laid end to end, with the index of the sequence that owns
each. In a round every sequence joins all pairs of its own lowest rank at once; sequences without a known pair leave.
A merge's rank is higher than those that made its parts (checked on load), so all occurrences can be joined together.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from strandloom.llm.common import columns_of, in_arrow, texts
from strandloom.llm.pretoken import pretokens

#: Pre-tokens whose counts a worker keeps before it starts afresh, and the longest one kept.
CACHE_ENTRIES, CACHE_PIECE = 300_000, 48
NONE = np.int32(1 << 30)


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class RankTable:
    """Ranks of pairs of symbols and what they become, from a byte-level BPE vocabulary in JSON."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.of_byte = np.array([vocab[s] for s in _byte_symbols()], np.int64)
        left, right = (np.array([vocab[m[i]] for m in merges], np.int64) for i in (0, 1))
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        rank = np.arange(len(merges))
        first = {int(m): int(r) for r, m in zip(rank[::-1], made[::-1], strict=True)}
        if any(max(first.get(int(a), -1), first.get(int(b), -1)) >= r for r, a, b in zip(rank, left, right, strict=True)):
            raise ValueError("a merge comes before one that makes its parts")
        key = left << 32 | right
        order = np.argsort(key, kind="stable")
        self.key, self.rank, self.made = key[order], rank[order].astype(np.int32), made[order]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        hit = self.key[at] == key
        return np.where(hit, self.rank[at], NONE), self.made[at]


def merged_counts(table: RankTable, pieces: list[bytes]) -> np.ndarray:
    """Symbols that survive in each piece."""
    count = np.fromiter(map(len, pieces), np.int64, len(pieces))
    symbol = table.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
    owner = np.repeat(np.arange(len(pieces)), count)
    rank, made = table.ranks(symbol[:-1], symbol[1:]) if len(symbol) > 1 else (np.zeros(0, np.int32), np.zeros(0, np.int64))
    # rank[i], made[i]: of the pair that starts at symbol i; a sequence's last symbol has none
    rank, made = np.append(rank, NONE), np.append(made, 0)
    if len(symbol):
        rank[np.append(owner[1:] != owner[:-1], True)] = NONE
    while len(symbol):
        start = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        size = np.diff(np.append(start, len(symbol)))
        low = np.minimum.reduceat(rank, start)
        done = low == NONE
        if done.any():
            count[owner[start[done]]] = size[done]
            stay = np.repeat(~done, size)
            symbol, owner, rank, made = symbol[stay], owner[stay], rank[stay], made[stay]
            low, size = low[~done], size[~done]
            if not len(symbol):
                break
        at = np.flatnonzero(rank == np.repeat(low, size))
        # of overlapping pairs (a a a) every other one, from the left
        run = np.append(True, np.diff(at) != 1)
        offset = np.arange(len(at)) - np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
        at = at[offset % 2 == 0]
        symbol[at] = made[at]
        stay = np.ones(len(symbol), bool)
        stay[at + 1] = False
        new_at = at - np.arange(len(at))
        rank[at] = rank[at + 1]  # says whether a pair follows at all
        last = np.append(owner[1:] != owner[:-1], True)
        ends = last[at + 1]
        symbol, owner, rank, made = symbol[stay], owner[stay], rank[stay], made[stay]
        # pairs to look up again: the new symbol with its right neighbour, and its left neighbour with it
        right = new_at[~ends]
        rank[new_at[ends]] = NONE
        left = new_at[(new_at > 0) & (owner[np.maximum(new_at - 1, 0)] == owner[new_at])] - 1
        both = np.concatenate([right, left])
        rank[both], made[both] = table.ranks(symbol[both], symbol[both + 1])
    return count


class CountCache(dict):
    """Pre-token -> surviving symbols, for as many as fit."""

    def __init__(self, table: RankTable) -> None:
        super().__init__()
        self.table = table

    def totals(self, batch: list[list[str]]) -> list[int]:
        missing = list({p for pieces in batch for p in pieces if p not in self})
        if len(self) + len(missing) > CACHE_ENTRIES:
            self.clear()
            missing = list({p for pieces in batch for p in pieces})
        counts = merged_counts(self.table, [p.encode("utf-8", "replace") for p in missing]).tolist()
        self.update(zip(missing, counts, strict=True))
        out = [sum(map(self.__getitem__, pieces)) for pieces in batch]
        for p in missing:
            if len(p) > CACHE_PIECE:
                del self[p]
        return out


@functools.lru_cache(2)
def cache(path: str) -> CountCache:
    return CountCache(RankTable(path))


def split_specials(text: str, specials: list[str]) -> tuple[list[str], int]:
    """The parts between special strings and how many of these there are."""
    parts, n = [text], 0
    for s in specials:
        if s in text:
            parts = [y for x in parts for y in x.split(s)]
            n = text.count(s) + n
    return parts, n


def token_counts(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) of every whole text.

    Null texts are empty: 0 bytes, 0 tokens. Repeated rows and null doc_ids give a row each; other columns are ignored.
    A text of any length is counted whole; an empty table gives an empty table.
    A special string of the vocabulary inside a text counts as one token, which is the library's default.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = cache(public_tokenizers.path(vocabulary))
        for batch in columns_of(batches, 4 << 20):
            rows = texts(batch)
            parts = [split_specials(t, counts.table.specials) for t in rows]
            pieces = [[p for part in own for p in pretokens(part)] for own, _ in parts]
            n = [a + b for a, (_, b) in zip(counts.totals(pieces), parts, strict=True)]
            size = [len(t.encode("utf-8", "replace")) for t in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array(size, pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n])],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return in_arrow(docs.select("doc_id", "text"), run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
