"""Byte-level BPE encoding of a whole corpus by speculation and verification.

Texts are split into words by the vocabulary's pattern. For each word not seen before, greedy
longest match proposes tokens. A token sequence is what BPE gives if and only if every adjacent
pair is compatible, that is, if BPE keeps the two tokens apart when it gets just their bytes; all
new pairs of a batch are tested at once with arrays. Only words with a failing pair are merged
exactly, with a heap, so that a word of a million bytes is no trouble either.

The vocabulary, its split table and its pair table are built on the driver and broadcast; their
size is that of the vocabulary file. Texts stay where they are read: no shuffle.

Defined results: empty text and null text give an empty list; special tokens' strings are ordinary
text; a repeated row gives a repeated row; an empty table gives an empty table; columns other than
the two named are not read, so their names cannot clash.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: fixed value: the split pattern of the byte-level vocabularies
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
CACHE_WORDS = 400_000


class Vocabulary:
    """Ranks of byte strings; ids are ranks, and a token's parts have lower ranks than itself."""

    def __init__(self, data: bytes, pattern: str = PATTERN):
        import regex

        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}
        self.split = regex.compile(pattern).findall
        self.longest = max(map(len, self.ranks))
        n = max(self.ranks.values()) + 1
        self.left, self.right = np.arange(n), np.arange(n)
        by_rank = sorted(self.ranks.items(), key=lambda x: x[1])
        pairs: dict[tuple[int, int], int] = {}
        for token, rank in by_rank:
            if len(token) > 1:
                a, b = self.merge(token, below=rank)
                self.left[rank], self.right[rank] = a, b
                pairs[a, b] = rank
        self.n = n
        keys = np.array([a * n + b for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], np.array(list(pairs.values()), dtype=np.int64)[order]
        self.cache: dict[str, tuple[int, ...]] = {}
        self.merged_words = self.new_words = 0

    def __getstate__(self):
        state = self.__dict__ | {"cache": {}}
        state.pop("split")
        return state | {"pattern_": self.split.__self__.pattern}

    def __setstate__(self, state):
        import regex

        self.split = regex.compile(state.pop("pattern_")).findall
        self.__dict__.update(state)

    def merge(self, word: bytes, below: int | None = None) -> tuple[int, ...]:
        """Exact BPE: always the lowest rank, leftmost first; ranks from below on are not used."""
        ranks, n = self.ranks, len(word)
        limit = below if below is not None else 1 << 60
        end = list(range(1, n + 1))  # end of the part that starts here
        before = list(range(-1, n - 1))
        alive = [True] * n
        heap = []

        def offer(i: int) -> None:
            j = end[i]
            if j < n:
                r = ranks.get(word[i : end[j]])
                if r is not None and r < limit:
                    heapq.heappush(heap, (r, i, end[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or end[i] >= n or end[i] == stop or end[end[i]] != stop:
                continue
            j = end[i]
            alive[j] = False
            end[i] = stop
            if stop < n:
                before[stop] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        out, i = [], 0
        while i < n:
            out.append(ranks[word[i : end[i]]])
            i = end[i]
        return tuple(out)

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match from the left."""
        ranks, out, i, n = self.ranks, [], 0, len(word)
        while i < n:
            stop = min(n, i + self.longest)
            while word[i:stop] not in ranks:
                stop -= 1
            out.append(ranks[word[i:stop]])
            i = stop
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair: BPE never merges across the border between the two tokens.

        Undoes the two tokens' merges from the latest one back. At each step the pair that touches
        the border must not be a merge that would have come before the merge undone last.
        """
        a, b = a.astype(np.int64).copy(), b.astype(np.int64).copy()
        limit = np.full(len(a), 1 << 60, dtype=np.int64)
        good = np.zeros(len(a), dtype=bool)
        at = np.arange(len(a))
        while len(at):
            x, y = a[at], b[at]
            keys = x * self.n + y
            pos = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
            merged = np.where(self.pair_keys[pos] == keys, self.pair_ranks[pos], 1 << 60)
            fine = merged >= limit[at]
            at, x, y = at[fine], x[fine], y[fine]
            undo_left = x > y
            left_leaf, right_leaf = self.right[x] == x, self.left[y] == y
            undo_left = (undo_left & ~left_leaf) | (~undo_left & right_leaf & ~left_leaf)
            undo_right = ~undo_left & ~right_leaf
            done = ~undo_left & ~undo_right
            good[at[done]] = True
            go = at[undo_left]
            limit[go] = x[undo_left]
            a[go] = self.right[x[undo_left]]
            go = at[undo_right]
            limit[go] = y[undo_right] + 1
            b[go] = self.left[y[undo_right]]
            at = at[~done]
        return good

    def learn(self, words: list[str]) -> None:
        """Put new words into the cache."""
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        raw = [w.encode("utf-8", "replace") for w in words]
        tokens = [self.propose(w) for w in raw]
        sizes = np.array([len(t) for t in tokens])
        flat = np.fromiter((x for t in tokens for x in t), dtype=np.int64, count=int(sizes.sum()))
        owner = np.repeat(np.arange(len(words)), sizes)
        inner = np.flatnonzero(owner[:-1] == owner[1:])
        keys, back = np.unique(flat[inner] * self.n + flat[inner + 1], return_inverse=True)
        ok = self.compatible(keys // self.n, keys % self.n)
        failing = set(owner[inner[~ok[back]]].tolist())
        self.new_words += len(words)
        self.merged_words += len(failing)
        for i, w in enumerate(words):
            self.cache[w] = self.merge(raw[i]) if i in failing else tuple(tokens[i])

    def encode_batch(self, texts: list[str | None]) -> list[list[int]]:
        split = [self.split(t) if t else [] for t in texts]
        new = list({w for ws in split for w in ws} - self.cache.keys())
        if len(self.cache) + len(new) > CACHE_WORDS:
            self.cache.clear()
            new = list({w for ws in split for w in ws})
        if new:
            self.learn(new)
        get, out = self.cache.__getitem__, []
        for ws in split:
            ids: list[int] = []
            for t in map(get, ws):
                ids += t
            out.append(ids)
        return out


def load_vocabulary(path: str = VOCABULARY) -> Vocabulary:
    with open(path, "rb") as f:
        return Vocabulary(f.read())


def _run(df: DataFrame, id_col: str, text_col: str, path: str, schema: str, make) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(load_vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for b in batches:
            for start in range(0, b.num_rows, 500):
                part = b.slice(start, 500)
                yield pa.RecordBatch.from_arrays([part.column(0), make(vocabulary.encode_batch(part.column(1).to_pylist()))], names=["doc_id", "out"])

    return df.selectExpr(f"cast(`{id_col}` as bigint) doc_id", f"`{text_col}` text").mapInArrow(run, f"doc_id bigint, out {schema}")


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = VOCABULARY) -> DataFrame:
    """doc_id, ids."""
    return _run(df, id_col, text_col, path, "array<int>", lambda ids: pa.array(ids, pa.list_(pa.int32()))).withColumnRenamed("out", "ids")


def count(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens."""
    return _run(df, id_col, text_col, path, "bigint", lambda ids: pa.array([len(x) for x in ids], pa.int64())).withColumnRenamed("out", "n_tokens")
