"""Problem 8: the corpus as token ids of a public byte-level BPE vocabulary.

A text is cut by the vocabulary's pattern; each distinct bit is merged once per worker: merge ranks
wait in a priority queue over a doubly linked list of symbols, and entries that name a symbol
that has changed since are skipped. Decoding joins the vocabulary's byte strings.

The vocabulary is a file of fixed size, read on the driver and broadcast (under 1 MB).
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
#: Fixed value: the public pattern that cuts a text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bits remembered per worker; beyond that the memory starts anew (results don't depend on it).
REMEMBERED = 400_000


class Bpe(dict):
    """Maps a bit of text to its ids; computes what it doesn't know yet."""

    def __init__(self, vocabulary: bytes):
        super().__init__()
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines()) if token}
        self.find = regex.compile(PATTERN).findall

    def __missing__(self, bit: str) -> tuple[int, ...]:
        if len(self) >= REMEMBERED:
            self.clear()
        ids = self[bit] = self.merge(bit.encode("utf-8", "surrogatepass"))
        return ids

    def merge(self, raw: bytes) -> tuple[int, ...]:
        ranks, n = self.ranks, len(raw)
        if n == 1:
            return (ranks[raw],)
        symbols: list[bytes | None] = [raw[i : i + 1] for i in range(n)]
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        queue: list[tuple[int, int, bytes]] = []

        def offer(i: int) -> None:
            j = right[i]
            if j < n and (rank := ranks.get(both := symbols[i] + symbols[j])) is not None:
                queue.append((rank, i, both)) if not started else heapq.heappush(queue, (rank, i, both))

        started = False
        for i in range(n - 1):
            offer(i)
        heapq.heapify(queue)
        started = True
        while queue:
            _, i, both = heapq.heappop(queue)
            if symbols[i] is None or (j := right[i]) >= n or len(symbols[i]) + len(symbols[j]) != len(both) or symbols[i] + symbols[j] != both:
                continue  # stale
            symbols[i], symbols[j] = both, None
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
            offer(i)
            if left[i] >= 0:
                offer(left[i])
        return tuple(ranks[s] for s in symbols if s is not None)

    def encode(self, text: str | None) -> list[int]:
        """NULL and empty text give no ids; a special token's spelling is ordinary text."""
        return list(chain.from_iterable(map(self.__getitem__, self.find(text)))) if text else []

    def decoder(self) -> list[bytes]:
        out = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            out[rank] = token
        return out


def decode(ids: Iterable[int], vocabulary: list[bytes]) -> str:
    return b"".join(map(vocabulary.__getitem__, ids)).decode("utf-8", "surrogatepass")


_loaded: dict[int, Bpe] = {}


def _bpe(vocabulary) -> Bpe:
    """One per worker process and broadcast, so that what it remembers outlives a task."""
    if vocabulary.value and (key := hash(vocabulary.value)) not in _loaded:
        _loaded.clear()
        _loaded[key] = Bpe(vocabulary.value)
    return _loaded[key]


def vocabulary_of(df: DataFrame, folder: str = TOKENIZERS, name: str = VOCABULARY):
    with open(f"{folder}/{name}", "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def token_ids(df: DataFrame, key: str, text: str, folder: str = TOKENIZERS, name: str = VOCABULARY) -> DataFrame:
    """key, ids (array<int>): one row per row of ``df``, without special tokens."""
    vocabulary = vocabulary_of(df, folder, name)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(vocabulary)
        for b in batches:
            ids = [bpe.encode(t) for t in b.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            flat = np.fromiter(chain.from_iterable(ids), np.int32, int(ends[-1]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=[key, "ids"])

    return df.select(key, text).mapInArrow(run, f"`{key}` {dict(df.dtypes)[key]}, ids array<int>")


def token_counts(df: DataFrame, keys: list[str], text: str, folder: str = TOKENIZERS, name: str = VOCABULARY) -> DataFrame:
    """``keys`` and n_tokens of each row."""
    vocabulary = vocabulary_of(df, folder, name)
    kinds = dict(df.dtypes)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(vocabulary)
        for b in batches:
            n = [len(bpe.encode(t)) for t in b.column(len(keys)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keys))), pa.array(n, pa.int32())], names=[*keys, "n_tokens"])

    return df.select(*keys, text).mapInArrow(run, ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", n_tokens int")


def decoded(ids: DataFrame, key: str, folder: str = TOKENIZERS, name: str = VOCABULARY) -> DataFrame:
    """key, text of the rows key, ids. No ids give the empty text."""
    vocabulary = vocabulary_of(ids, folder, name)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings = _bpe(vocabulary).decoder()
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([decode(x or (), strings) for x in b.column(1).to_pylist()], pa.string())], names=[key, "text"])

    return ids.select(key, F.col("ids")).mapInArrow(run, f"`{key}` {dict(ids.dtypes)[key]}, text string")
