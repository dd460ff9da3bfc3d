"""Where two similar texts must meet: bounds on common shingles, and the pairs they leave.

Every class sends some of its shingles as entries. Entries of one key form a run, and the pairs of a
run that pass the bounds on size and place are counted. A key that many classes send is split: by
groups of classes, each pair of groups a key of its own, so that no run is long and each pair of
classes still meets once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from figloom.llm import shingles as S
from figloom.llm.rarity import counted, int64
from figloom.shared import written

THRESHOLD = 0.6
#: Shingles that a pair must have in common where it meets: more of them cost a little more join and spare many candidates.
MEETINGS = 3
#: Classes of a run from which its key is split.
HOT = 4096
#: Pairs that are looked at together, rows that are gathered before.
AT_ONCE = 1 << 21
ROWS = 1 << 18
#: Key tables up to this size are broadcast, larger ones are joined by shuffle.
BROADCAST_BYTES = 32 << 20
#: Keys are cut to 40 bits: two that agree by chance make a run longer, and fewer bytes move.
KEY_SHIFT = 24
#: ``meta`` packs the size (28 bits), the place among the ordered shingles (28), and from below: in_index, home, side, group (2).
_SIZE, _PLACE = 34, 6
ENTRY = "k long, cls long, meta long, far float"


def by_keys(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` joined with ``keys`` (a written table, unique on ``on``): broadcast only after its bytes were summed."""
    def width(c: str, kind: str):
        if kind == "string":
            return F.coalesce(F.octet_length(c), F.lit(0)) + 24
        return 8 * F.coalesce(F.size(c), F.lit(0)) + 32 if kind.startswith("array") else F.lit(16)

    row = sum((width(c, kind) for c, kind in keys.dtypes), F.lit(16))
    small = int(keys.agg(F.sum(row.cast("long"))).first()[0] or 0) <= BROADCAST_BYTES
    return rows.join(F.broadcast(keys) if small else keys, on)


def prefixes(size: np.ndarray, t: float) -> tuple[np.ndarray, np.ndarray]:
    """How many of its first ordered shingles a text sends, and how many of these it needs to be found by a larger one.

    Similarity t leaves the larger text y at least ceil(t|y|) common shingles and the smaller x at least
    ceil(2t/(1+t)|x|); what remains, and MEETINGS more, holds MEETINGS common ones on both sides.
    """
    probe = size - np.ceil(t * size - 1e-9).astype(np.int64) + MEETINGS
    index = size - np.ceil(2 * t / (1 + t) * size - 1e-9).astype(np.int64) + MEETINGS
    return probe, index


def hot_from(rank: np.ndarray) -> float:
    """Counts above this make a key hot: above HOT, and well above what an average cell of the table has."""
    some = rank[rank > 0]
    return max(HOT, 8 * float(counted(some).mean())) if len(some) else HOT


def split_hot(h: np.ndarray, cls: np.ndarray, count: np.ndarray, side: np.ndarray | None = None, other: np.ndarray | None = None, hot: float = HOT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entry, key, group) of the entries with the shingles ``h``, which ``count`` classes have.

    A hot one comes out once for each pair of groups that its class is in. One space: groups (i, j), i <= j;
    ``group`` tells on which side of a pair of different groups it is (1, 2), 0 for i = j. Two sides
    (``side``, and ``other``: how many classes of the other side have it): a grid, a side's groups by the other's.
    """
    n = np.where(count > hot, np.ceil(count / HOT), 1).astype(np.int64)
    mixed = S.mixed(cls ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(20)
    mine = (mixed % n.astype(np.uint64)).astype(np.int64)
    if side is None:
        copies = n
        entry = np.repeat(np.arange(len(h)), copies)
        j = np.arange(len(entry)) - np.repeat(np.cumsum(copies) - copies, copies)
        i = mine[entry]
        low, high = np.minimum(i, j), np.maximum(i, j)
        group = np.where(low == high, 0, np.where(i == low, 1, 2))
    else:
        m = np.where(other > hot, np.ceil(other / HOT), 1).astype(np.int64)
        entry = np.repeat(np.arange(len(h)), m)
        j = np.arange(len(entry)) - np.repeat(np.cumsum(m) - m, m)
        first = side[entry] == 0
        low, high = np.where(first, mine[entry], j), np.where(first, j, mine[entry])
        group = np.zeros(len(entry), np.int64)
    salt = (low.astype(np.uint64) << np.uint64(20)) | high.astype(np.uint64)
    return entry, np.where(salt == 0, h[entry], S.mixed(h[entry] + S.mixed(salt))), group


def batch_of(k: np.ndarray, cls: np.ndarray, size: np.ndarray, place: np.ndarray, in_index: np.ndarray, home: np.ndarray, side: np.ndarray, group: np.ndarray, far: np.ndarray) -> pa.RecordBatch:
    meta = (size.astype(np.int64) << _SIZE) | (place.astype(np.int64) << _PLACE) | (group.astype(np.int64) << 3) | (side.astype(np.int64) << 2) | (home.astype(np.int64) << 1) | in_index.astype(np.int64)
    return pa.RecordBatch.from_arrays([int64(k >> np.uint64(KEY_SHIFT)), int64(cls), pa.array(meta), pa.array(far.astype(np.float32))], names=["k", "cls", "meta", "far"])


def _ranges(key: np.ndarray, side: np.ndarray, size: np.ndarray, cross: bool, t: float) -> tuple[np.ndarray, np.ndarray]:
    """For each row, the rows [low, high) of its run that its size may pair with. Rows are in order of run, side and size.

    One space: later rows of the run up to size / t. Two sides: rows of side 1 for each row of side 0, others none.
    """
    run = np.cumsum(np.append(True, key[1:] != key[:-1])) - 1
    width = int(size.max()) + 2
    composite = (run * 2 + side) * width + size
    high_size = np.minimum(np.floor(size / t + 1e-9).astype(np.int64), width - 1)
    if not cross:
        return np.arange(1, len(key) + 1), np.searchsorted(composite, (run * 2 + side) * width + high_size, side="right")
    base = (run * 2 + 1) * width
    low = np.searchsorted(composite, base + np.ceil(size * t - 1e-9).astype(np.int64), side="left")
    return low, np.where(side == 0, np.searchsorted(composite, base + high_size, side="right"), low)


def met(k: np.ndarray, cls: np.ndarray, meta: np.ndarray, far: np.ndarray, cross: bool, t: float) -> Iterator[pa.RecordBatch]:
    """x, y, room, need of the pairs of whole runs that pass the bounds; once per common key. x: the smaller, or with ``cross`` that of side 0."""
    size, side = meta >> _SIZE, (meta >> 2) & 1
    order = np.lexsort((cls, size, side, k))
    k, cls, meta, far = k[order], cls[order], meta[order], far[order]
    new = np.append(True, (k[1:] != k[:-1]) | (cls[1:] != cls[:-1]))
    k, cls, meta, far = k[new], cls[new], meta[new], far[new]
    size, place, side, group = meta >> _SIZE, (meta >> _PLACE) & ((1 << 28) - 1), (meta >> 2) & 1, (meta >> 3) & 3
    index, home = (meta & 1) == 1, ((meta >> 1) & 1) == 1
    low, high = _ranges(k, side, size, cross, t)
    n = np.maximum(high - low, 0)
    if not cross:
        n[~index] = 0
    upto = np.cumsum(n)
    start = 0
    while start < len(n):
        stop = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + AT_ONCE, side="right")))
        own = n[start:stop]
        a = np.repeat(np.arange(start, stop), own)
        b = np.arange(len(a)) - np.repeat(np.cumsum(own) - own, own) + np.repeat(low[start:stop], own)
        start = stop
        small = np.where((size[a] > size[b]) | ((size[a] == size[b]) & (cls[a] > cls[b])), b, a) if cross else a
        room = np.minimum(size[a] - place[a], size[b] - place[b])
        need = np.ceil(t / (1 + t) * (size[a] + size[b]) - 1e-9).astype(np.int64)
        good = index[small] & (room >= need - (MEETINGS - 1)) & (home[a] | home[b]) & (np.abs(far[a] - far[b]) <= 1 - t + 1e-5) & ((group[a] == 0) | (group[a] != group[b]))
        a, b, room, need = a[good], b[good], room[good], need[good]
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(cls[a]), pa.array(cls[b]), pa.array(room.astype(np.int32)), pa.array(need.astype(np.int32))], names=["x", "y", "room", "need"])


def candidates(entries: DataFrame, t: float = THRESHOLD, cross: bool = False) -> DataFrame:
    """x, y (as ``met`` has them) of the class pairs that pass the bounds where they meet.

    One exchange by key, sorted; the runs are read once, in order. A match at places (i, j) leaves at most
    min(|x|-i, |y|-j) common shingles from there on, and a pair's matches come before all its others.
    ``cross``: only pairs of side 0 with side 1.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        rows = 0
        for b in batches:
            held.append(tuple(b.column(i).to_numpy(zero_copy_only=False) for i in range(4)))
            rows += b.num_rows
            if rows >= ROWS and held[-1][0][-1] != held[0][0][0]:
                whole = tuple(np.concatenate(c) for c in zip(*held))
                cut = int(np.flatnonzero(whole[0] != whole[0][-1])[-1]) + 1
                yield from met(*(c[:cut] for c in whole), cross, t)
                held, rows = [tuple(c[cut:] for c in whole)], len(whole[0]) - cut
        if rows:
            yield from met(*(np.concatenate(c) for c in zip(*held)), cross, t)

    found = entries.repartition("k").sortWithinPartitions("k").mapInArrow(run, "x long, y long, room int, need int")
    each = found.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"), F.min("room").alias("room"), F.first("need").alias("need"))
    return each.where((F.col("n") >= F.least(F.lit(MEETINGS), F.col("need"))) & (F.col("n") - 1 + F.col("room") >= F.col("need"))).select("x", "y")


def named_classes(pairs: DataFrame) -> DataFrame:
    """cls of every class that ``pairs`` (x, y) names, written."""
    return written(pairs.select(F.col("x").alias("cls")).unionAll(pairs.select("y")).distinct(), "named")


def by_signature(pairs: DataFrame, scanned: DataFrame, t: float = THRESHOLD) -> DataFrame:
    """Of written ``pairs`` those whose overlap can still reach the threshold by their parity signatures. Only named classes' signatures move."""
    lanes = S.SIGNATURE_LANES
    held = by_keys(scanned.where("sig IS NOT NULL"), named_classes(pairs), ["cls"])
    sigs = held.select("cls", "size", *[F.col("sig")[k].alias(f"s{k}") for k in range(lanes)]).dropDuplicates(["cls"])
    a, b = (sigs.select(F.col("cls").alias(c), F.col("size").alias(f"n{c}"), *[F.col(f"s{k}").alias(f"s{c}{k}") for k in range(lanes)]) for c in "xy")
    both = pairs.join(a, "x").join(b, "y")
    differ = sum((F.bit_count(F.col(f"sx{k}").bitwiseXOR(F.col(f"sy{k}"))) for k in range(lanes)), F.lit(0))
    return both.where((F.col("nx") + F.col("ny") - differ) / 2 >= F.lit(t / (1 + t)) * (F.col("nx") + F.col("ny")) - 1e-9).select("x", "y")


def texts_of(pairs: DataFrame, members: DataFrame, rows: DataFrame) -> DataFrame:
    """cls, text of every class that ``pairs`` (x, y) names: the text of its first member."""
    picks = written(by_keys(members, named_classes(pairs), ["cls"]).groupBy("space", "cls").agg(F.min(F.struct("key", "tid")).alias("k")).select("space", "cls", "k.key", "k.tid"), "picks")
    return by_keys(rows.withColumn("tid", F.xxhash64("text")), picks, ["space", "key", "tid"]).groupBy("cls").agg(F.first("text", ignorenulls=True).alias("text"))
