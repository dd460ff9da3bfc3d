"""The first pass over texts: their classes, and how rare each shingle is.

Texts with the same word sequence are one class. Shingles are counted over all classes in a table
of hash cells, a table per side. The counts order the shingles and tell which ones are hot;
a collision makes a shingle seem more frequent, which costs time and never a pair. The table has
about a cell for every second shingle of the data, at most 2**MOST_BITS: beyond that it still sets frequent
shingles apart from others, but rare ones no longer from each other.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from figloom.llm import shingles as S

LEAST_BITS, MOST_BITS = 16, 25
#: A merged cell holds 0, 1, or for larger counts 2 and STEPS for each doubling of the count.
STEPS = 12
BLOCK_BITS = 16
#: Characters per cell by which the table's size is told from the length of all texts.
CHARS = 14
SCAN = ["space", "key", "tid", "cls", "n_words", "size", "sig", "block", "cells"]
_KINDS = "space int, key string, tid long, cls long, n_words int, size int, sig array<long>, block int, cells binary"


def table_bits(rows: DataFrame) -> int:
    """The table's size for ``rows`` (text), from the number of their characters."""
    n = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return min(MOST_BITS, max(LEAST_BITS, int(n // CHARS).bit_length()))


def int64(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64))


def fresh_texts(cls: np.ndarray, n_words: np.ndarray, seen: set[int]) -> np.ndarray:
    """Which texts are the task's first of their class and long enough; adds them to ``seen``."""
    fresh = np.zeros(len(cls), bool)
    for i in np.flatnonzero(n_words >= S.LEAST_WORDS):
        if (c := int(cls[i])) not in seen:
            seen.add(c)
            fresh[i] = True
    return fresh


def _packed(cells: np.ndarray) -> bytes:
    """The counts that aren't 0, with their distances."""
    at = np.flatnonzero(cells)
    head = np.array([len(at)], np.uint32).tobytes()
    return zlib.compress(head + np.diff(at, prepend=0).astype(np.uint16).tobytes() + np.minimum(cells[at], 65535).astype(np.uint16).tobytes(), 1)


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zlib.decompress(data)
    n = int(np.frombuffer(raw[:4], np.uint32)[0])
    both = np.frombuffer(raw[4:], np.uint16)
    return np.cumsum(both[:n], dtype=np.int64), both[n:]


def scan(rows: DataFrame, bits: int, n_sides: int = 1) -> DataFrame:
    """The first pass over ``rows`` (space int, key string, text string).

    Member rows: space, key, tid (the text's hash), cls, n_words, of texts with at least 30 words, and
    on the class's first row in the task its size and parity signature. Rarity rows: block and cells (the
    task's counts of one block of a table, each class of the task counted once). With two sides a class
    counts in the table of its space (0 or 1), with one all count in the same.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, seen = np.zeros((n_sides, 1 << bits), np.uint32), set()
        for b in batches:
            space, texts = b.column(0).to_numpy(zero_copy_only=False).astype(np.int32), b.column(3).to_pylist()
            for at, part in S.chunks(texts):
                doc, h, n_words, cls = S.shingles(part)
                own = space[at : at + len(part)]
                cls = cls + own.astype(np.uint64)
                fresh = fresh_texts(cls, n_words, seen)
                keep = fresh[doc]
                doc, h, _ = S.ordered(doc[keep], h[keep], np.zeros(int(keep.sum()), np.uint8))
                cell = (h & np.uint64((1 << bits) - 1)).astype(np.int64)
                for side in range(n_sides):
                    np.add.at(tables[side], cell[own[doc] == side] if n_sides > 1 else cell, 1)
                kept = np.flatnonzero(n_words >= S.LEAST_WORDS)
                size = np.bincount(doc, minlength=len(part))[kept].astype(np.int32)
                sig = S.signatures(doc, h, len(part))[kept][fresh[kept]].view(np.int64).reshape(-1)
                ends = np.cumsum([0, *np.where(fresh[kept], S.SIGNATURE_LANES, 0)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends, mask=np.append(~fresh[kept], False)), pa.array(sig))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(space[at + kept]), *(b.column(c).take(pa.array(at + kept)) for c in (1, 2)), int64(cls[kept]), pa.array(n_words[kept].astype(np.int32)), pa.array(size, mask=~fresh[kept]), lists, pa.nulls(len(kept), pa.int32()), pa.nulls(len(kept), pa.binary())],
                    names=SCAN,
                )
        if seen:
            for k, block in enumerate(tables.reshape(-1, 1 << min(bits, BLOCK_BITS))):
                if block.any():
                    yield pa.RecordBatch.from_arrays([*(pa.nulls(1, kind) for kind in (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()))), pa.array([k], pa.int32()), pa.array([_packed(block)], pa.binary())], names=SCAN)

    return rows.select("space", "key", F.xxhash64("text"), "text").mapInArrow(run, _KINDS)


def rarity(scanned: DataFrame, bits: int, n_sides: int = 1) -> np.ndarray:
    """uint8 per side and cell: 0 and 1 as counted, above that a logarithm of the count.

    Merged by block, streaming, over as many tasks as a shuffle has; the result is n_sides * 2**bits bytes.
    """
    size = 1 << min(bits, BLOCK_BITS)

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for k, packed in zip(b.column(0).to_pylist(), b.column(1)):
                at, n = _unpacked(packed.as_py())
                if k not in total:
                    total[k] = np.zeros(size, np.int64)
                total[k][at] += n
        for k, n in total.items():
            rank = np.where(n < 2, n, np.minimum(255, 2 + np.rint(STEPS * np.log2(np.maximum(n, 2) / 2)))).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([zlib.compress(rank.tobytes(), 1)], pa.binary())], names=["block", "cells"])

    blocks = scanned.where("block IS NOT NULL").select("block", "cells").repartition("block").mapInArrow(merge, "block int, cells binary")
    out = np.zeros((n_sides << bits) // size * size, np.uint8).reshape(-1, size)
    for row in blocks.collect():  # n_sides * 2**bits bytes in all, at most 2**(MOST_BITS + 1)
        out[row.block] = np.frombuffer(zlib.decompress(row.cells), np.uint8)
    return out.reshape(n_sides, -1)


def counted(rank: np.ndarray) -> np.ndarray:
    """About the counts that ``rank`` stands for."""
    return np.where(rank < 2, rank, 2.0 ** ((rank.astype(np.float64) - 2) / STEPS + 1))


def packed_table(table: np.ndarray) -> tuple[tuple[int, ...], bytes]:
    """A table as it is broadcast: every executor keeps a broadcast value as a file, and most cells are 0."""
    return table.shape, zlib.compress(table.tobytes(), 1)


_open: dict[int, np.ndarray] = {}


def opened(packed: tuple[tuple[int, ...], bytes]) -> np.ndarray:
    """The table; one is held open per process."""
    shape, data = packed
    if (key := hash(data)) not in _open:
        _open.clear()
        _open[key] = np.frombuffer(zlib.decompress(data), np.uint8).reshape(shape)
    return _open[key]
