"""Byte-level BPE encoding and decoding over length-bucketed numpy matrices.

The pattern cuts a text into pieces; a piece that is a vocabulary entry is one id, any other piece starts as one symbol
per byte. Pieces of similar length are the rows of a padded matrix. In each round every row merges its leftmost pair of
minimum rank: the pair ranks of a row are kept beside its symbols, the merged column is cut out by compaction, and only
the two pairs that touch the merge are looked up again in an open-addressing hash table. Rows without a mergeable pair
leave the matrix. Very long pieces (``LONG`` bytes and more) are merged by a heap over a linked list, the same merges in
the same order, because a matrix would cost the square of their length.

Null and empty texts give no ids. Equal rows give equal results; the table may be empty; other columns are kept as they are.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from latewatch.llm.common import groups, text_batches

LONG = 512
# Encoded pieces that a worker keeps; it starts afresh when the store is full.
CACHE_PIECES = 100_000
_NONE = np.int64(1) << 40
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Hash table from a pair of ids to the id of their concatenation; linear probing, at most half full."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(2 * len(keys) + 2))))
        size = 1 << self.bits
        self.keys = np.full(size, -1, np.int64)
        self.values = np.full(size, _NONE, np.int64)
        at, left = self._home(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[at[left]] == -1
            self.keys[at[left[free]]] = keys[left[free]]  # of several with one slot the last one stays
            placed = self.keys[at[left]] == keys[left]
            self.values[at[left[placed]]] = values[left[placed]]
            left = left[~placed]
            at[left] = (at[left] + 1) & (size - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MULTIPLIER) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged ids, ``_NONE`` where the pair (or padding, -1) has none."""
        keys = (left << 32) | right
        keys[(left < 0) | (right < 0)] = -2
        at = self._home(keys)
        seen = self.keys[at]
        out = np.where(seen == keys, self.values[at], _NONE)
        open_ = np.flatnonzero((seen != keys) & (seen != -1) & (keys >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self.keys) - 1)
            seen = self.keys[at[open_]]
            hit = seen == keys[open_]
            out[open_[hit]] = self.values[at[open_[hit]]]
            open_ = open_[~hit & (seen != -1)]
        return out


class ByteBpe:
    def __init__(self, rank_file: bytes, pattern: str):
        import regex

        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines()) if a}
        self.pieces = regex.compile(pattern).findall
        self.tokens = {i: w for w, i in self.ranks.items()}
        top = max(self.tokens) + 1
        words = [self.tokens.get(i, b"") for i in range(top)]
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.flat = np.frombuffer(b"".join(words), np.uint8)
        pairs = {
            (self.ranks[w[:k]] << 32) | self.ranks[w[k:]]: i
            for w, i in self.ranks.items() for k in range(1, len(w)) if w[:k] in self.ranks and w[k:] in self.ranks
        }
        self.table = PairTable(np.fromiter(pairs, np.int64, len(pairs)), np.fromiter(pairs.values(), np.int64, len(pairs)))
        self.first = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.cache: dict[str, bytes] = {}

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of byte strings, by merges alone."""
        out: list[np.ndarray | None] = [None] * len(words)
        size = np.array([len(w) for w in words], np.int64)
        bucket = np.ceil(np.log2(np.maximum(size, 1))).astype(int)
        for b in np.unique(bucket):
            rows = np.flatnonzero(bucket == b)
            if size[rows].max() >= LONG:
                for r in rows:
                    out[r] = self._merge_long(words[r])
                continue
            self._merge_matrix(words, rows, size[rows], out)
        return out

    def _merge_matrix(self, words, rows, size, out) -> None:
        width = int(size.max())
        mat = np.full((len(rows), width), -1, np.int64)
        inside = np.arange(width) < size[:, None]
        mat[inside] = self.first[np.frombuffer(b"".join(words[r] for r in rows), np.uint8)]
        rank = self.table.find(mat[:, :-1].ravel(), mat[:, 1:].ravel()).reshape(len(rows), width - 1)
        while True:
            done = rank.min(axis=1, initial=_NONE) == _NONE
            for k in np.flatnonzero(done):
                out[rows[k]] = mat[k, : size[k]].astype("<u4")
            live = ~done
            if not live.any():
                return
            mat, rank, rows, size = mat[live], rank[live], rows[live], size[live] - 1
            n, every = len(rows), np.arange(len(rows))
            j = rank.argmin(axis=1)
            mat[every, j] = rank[every, j]
            columns = np.arange(mat.shape[1])
            mat = mat[columns != (j + 1)[:, None]].reshape(n, -1)
            rank = rank[columns[:-1] != j[:, None]].reshape(n, -1)
            for k in (j - 1, j):
                ok = np.flatnonzero((k >= 0) & (k < rank.shape[1]))
                rank[ok, k[ok]] = self.table.find(mat[ok, k[ok]], mat[ok, k[ok] + 1])

    def _merge_long(self, word: bytes) -> np.ndarray:
        ids = self.first[np.frombuffer(word, np.uint8)]
        n = len(ids)
        found = self.table.find(ids[:-1].copy(), ids[1:].copy())
        heap = [(int(r), int(k)) for k, r in zip(np.flatnonzero(found < _NONE), found[found < _NONE], strict=True)]
        heapq.heapify(heap)
        ids, after, before = ids.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        pair = lambda a, b: self.ranks.get(self.tokens[a] + self.tokens[b])
        while heap:
            r, k = heapq.heappop(heap)
            m = after[k]
            if ids[k] < 0 or m >= n or pair(ids[k], ids[m]) != r:
                continue
            ids[k], ids[m] = r, -1
            after[k] = after[m]
            if after[k] < n:
                before[after[k]] = k
                if (x := pair(r, ids[after[k]])) is not None:
                    heapq.heappush(heap, (x, k))
            if before[k] >= 0 and (x := pair(ids[before[k]], r)) is not None:
                heapq.heappush(heap, (x, before[k]))
        return np.array([i for i in ids if i >= 0], "<u4")

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as packed little-endian unsigned 32-bit integers."""
        cut = [self.pieces(t) for t in texts]
        new = {p for pieces in cut for p in pieces if p not in self.cache}
        if len(self.cache) + len(new) > CACHE_PIECES:
            self.cache, new = {}, {p for pieces in cut for p in pieces}
        hard = []
        for p in new:
            w = p.encode("utf-8", "surrogatepass")
            if (i := self.ranks.get(w)) is not None:
                self.cache[p] = i.to_bytes(4, "little")
            else:
                hard.append((p, w))
        for (p, _), ids in zip(hard, self.merge([w for _, w in hard]), strict=True):
            self.cache[p] = ids.tobytes()
        get = self.cache.__getitem__
        return [b"".join(map(get, pieces)) for pieces in cut]

    def decode(self, packed: bytes) -> bytes:
        ids = np.frombuffer(packed, "<u4").astype(np.int64)
        size = self.lengths[ids]
        ends = np.cumsum(size)
        if not len(ids):
            return b""
        return self.flat[np.repeat(self.starts[ids] - ends + size, size) + np.arange(ends[-1])].tobytes()


_MADE: dict[tuple, ByteBpe] = {}


def _bpe(rank_file: bytes, pattern: str) -> ByteBpe:
    key = (hash(rank_file), pattern)
    if key not in _MADE:
        _MADE[key] = ByteBpe(rank_file, pattern)
    return _MADE[key]


def round_trip(df: DataFrame, rank_path: str, pattern: str, text: str = "text") -> DataFrame:
    """``df`` with ``bpe``: struct of ``n_tokens`` (long), ``ids`` (packed little-endian u32) and ``decoded`` (the bytes
    that the ids stand for).

    The rank file is read once on the driver and broadcast; its size is that of a vocabulary, not of the corpus.
    """
    with open(rank_path, "rb") as f:
        ranks = df.sparkSession.sparkContext.broadcast(f.read())

    @F.pandas_udf("n_tokens long, ids binary, decoded binary")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = _bpe(ranks.value, pattern)
        for texts in parts:
            ids = [x for group in groups(texts.tolist()) for x in bpe.encode(group)]
            yield pd.DataFrame({"n_tokens": [len(x) // 4 for x in ids], "ids": ids, "decoded": [bpe.decode(x) for x in ids]})

    text_batches(df.sparkSession)
    return df.withColumn("bpe", run(F.col(text)))
