"""Problem 5: groups of near-duplicates, by a metric-space join on Jaccard distance.

Jaccard distance is a metric, so a pivot p orders the space: d(x, y) <= r implies
|d(x, p) - d(y, p)| <= r. The join works on classes (texts with the same word sequence):

1. A first pass (``rarity``) names each row's class and counts the shingles.
2. Pivots are taken from a bounded sample, the densest first, and each pivot's neighbours leave
   the sample before the next is taken. A class belongs to the Voronoi cell of
   the nearest pivot within ``RADIUS``, or to the outer cell. A cell's pairs are those with its
   lowest-numbered end in it, so a class within ``RADIUS`` + r of an earlier cell's pivot is copied
   there as a boundary member: the triangle inequality shows that nothing else can reach
   into the cell. Every close pair meets in exactly one cell.
3. Inside a cell, also the outer one, distances this small force common rare shingles, by which
   the pairs meet (``meetings``), with the bounds on size, place, and distance to the pivot; pairs
   are counted, bounded by their parity signatures, and last by the exact similarity of the
   texts. Each bound is necessary, so no pair is lost, whatever the sample.

Random texts have a distance near 1 to every pivot, so only dense groups make cells: the
outer cell holds most texts, and its part of the join is that on rare shingles (README).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from figloom.llm import meetings as M, shingles as S
from figloom.llm.rarity import counted, fresh_texts, opened, packed_table, rarity, scan, table_bits
from figloom.shared import drop, written

THRESHOLD = M.THRESHOLD
RADIUS = 0.3
#: Classes sampled for pivots (smallest class ids of each space), longest sampled text, most pivots of a space.
SAMPLE = 256
SAMPLE_WORDS = 5000
PIVOTS = 24
OUTER = 1 << 24
#: A cell's number is the pivot's times this plus the space.
SPACES = 16


def overlaps(sets: list[np.ndarray], doc: np.ndarray, h: np.ndarray, n_texts: int) -> np.ndarray:
    """Common elements of each text (distinct shingles as doc, h) with each set; sets have at most SAMPLE_WORDS elements."""
    out = np.zeros((n_texts, len(sets)), np.int16)
    if sets and len(h):
        known, place = np.unique(np.concatenate(sets), return_inverse=True)
        has = np.zeros((len(known), len(sets)), np.int16)
        has[place, np.repeat(np.arange(len(sets)), [len(s) for s in sets])] = 1
        at = np.minimum(np.searchsorted(known, h), len(known) - 1)
        hit = np.flatnonzero(known[at] == h)
        if len(hit):
            first = np.flatnonzero(np.diff(doc[hit], prepend=-1))
            out[doc[hit][first]] = np.add.reduceat(has[at[hit]], first, axis=0, dtype=np.int16)
    return out


def pick_pivots(texts: list[str], most: int = PIVOTS) -> list[np.ndarray]:
    """The pivots' shingles: repeatedly the sampled text with most others within RADIUS, whose ball then leaves the sample.

    Texts without neighbours in the sample make no useful cell; at most one of them is taken, so
    that there is a cell at all.
    """
    sets = []
    for _, part in S.chunks(texts):
        doc, h, *_ = S.shingles(part)
        doc, h, _ = S.ordered(doc, h, np.zeros(len(doc), np.uint8))
        sets += [h[doc == i] for i in range(len(part))]
    sets = [s for s in sets if len(s)]
    if not sets:
        return []
    doc, h = np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.concatenate(sets)
    common = overlaps(sets, doc, h, len(sets))
    size = np.array([len(s) for s in sets])
    close = 1 - common / (size[:, None] + size[None, :] - common) <= RADIUS
    left, out = np.ones(len(sets), bool), []
    while left.any() and len(out) < most:
        dense = (close & left[None, :]).sum(1) * left
        p = int(dense.argmax())
        if dense[p] < 2 and out:
            break
        out.append(sets[p])
        left &= ~close[p]
    return out


def cell_entries(rows: DataFrame, rank, pivots, bits: int, t: float = THRESHOLD) -> DataFrame:
    """The second pass. ``rank``, ``pivots`` (by space): broadcast variables.

    Entries (``meetings.ENTRY``) of each class's shingles that may meet, in each cell that the class is a member of. A
    key stands for the cell (with the space) and the shingle. A class is emitted once per task.
    """
    hot = M.hot_from(opened(rank.value))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = opened(rank.value), set()
        for b in batches:
            spaces, texts = b.column(0).to_numpy(zero_copy_only=False).astype(np.int32), b.column(1).to_pylist()
            for at, part in S.chunks(texts):
                space = spaces[at : at + len(part)]
                doc, h, n_words, cls = S.shingles(part)
                cls = cls + space.astype(np.uint64)
                keep = fresh_texts(cls, n_words, seen)[doc]
                doc, h = doc[keep], h[keep]
                if not len(doc):
                    continue
                doc, h, r = S.ordered(doc, h, table[(h & np.uint64((1 << bits) - 1)).astype(np.int64)])
                size = np.bincount(doc, minlength=len(part))
                place = np.arange(len(doc)) - (np.cumsum(size) - size)[doc]
                probe, index = M.prefixes(size, t)
                able = np.bincount(doc[r > 1], minlength=len(part)) >= size - probe + M.MEETINGS  # a partner shares at least t of them
                emit = np.flatnonzero((place < probe[doc]) & (r > 1) & able[doc])
                cells: list[tuple[np.ndarray, ...]] = []  # (entry, cell, home, distance)
                own = np.full(len(part), OUTER, np.int64)
                for s in np.unique(space):
                    sets = pivots.value.get(int(s), [])
                    mine = space[doc] == s
                    c = overlaps(sets, doc[mine], h[mine], len(part))
                    if not sets:
                        continue
                    d = 1 - c / (size[:, None] + np.array([len(p) for p in sets])[None, :] - c)
                    near = np.where(space == s, d.argmin(1), 0)
                    inside = (space == s) & (d.min(1) <= RADIUS)
                    own[inside] = near[inside]
                    for p in range(len(sets)):
                        member = (space == s) & ((own == p) | ((own > p) & (d[:, p] <= RADIUS + 1 - t + 1e-9)))
                        if member.any():
                            e = emit[member[doc[emit]]]
                            cells.append((e, np.full(len(e), p), own[doc[e]] == p, d[doc[e], p]))
                e = emit[own[doc[emit]] == OUTER]
                cells.append((e, np.full(len(e), OUTER), np.ones(len(e), bool), np.zeros(len(e))))
                e, cell, home, far = (np.concatenate(x) for x in zip(*cells))
                if len(e):
                    key = S.mixed(h[e] ^ S.mixed((cell * SPACES + space[doc[e]]).astype(np.uint64)))
                    i, key, group = M.split_hot(key, cls[doc[e]], counted(r[e]), hot=hot)
                    e, home, far = e[i], home[i], far[i]
                    d = doc[e]
                    yield M.batch_of(key, cls[d], size[d], place[e], place[e] < index[d], home, np.zeros(len(e), np.int64), group, far)

    return rows.select("space", "text").mapInArrow(run, M.ENTRY)


def verified(pairs: DataFrame, texts: DataFrame, t: float = THRESHOLD) -> DataFrame:
    """x, y, similarity of the pairs (x, y) whose texts (cls, text) are at least as similar as ``t``; exact."""
    x, y = (texts.select(F.col("cls").alias(c), F.col("text").alias(f"t{c}")) for c in "xy")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            common, either = S.jaccard(b.column(2).to_pylist(), b.column(3).to_pylist())
            good = np.flatnonzero(common * 1_000_000 >= np.rint(t * 1_000_000) * np.maximum(either, 1))
            yield pa.RecordBatch.from_arrays([*(b.column(i).take(pa.array(good)) for i in range(2)), pa.array(common[good] / np.maximum(either[good], 1))], names=["x", "y", "similarity"])

    return pairs.join(x, "x").join(y, "y").select("x", "y", "tx", "ty").mapInArrow(run, "x long, y long, similarity double")


def pivots_of(rows: DataFrame, members: DataFrame) -> dict[int, list[np.ndarray]]:
    """The pivots of each space, from bounded samples."""
    sets = {}
    for s in [r.space for r in members.select("space").distinct().collect()]:  # a handful by definition
        sample = [r.key for r in members.where((F.col("space") == s) & (F.col("n_words") <= SAMPLE_WORDS)).orderBy("cls", "key").select("key").limit(SAMPLE).collect()]
        sets[s] = pick_pivots([r.text for r in rows.where(F.col("space") == s).where(F.col("key").isin(sample)).orderBy("key").limit(SAMPLE).select("text").collect()])
    return sets


def near_duplicates(rows: DataFrame, t: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(members, links) of ``rows`` (space int, key string, text string); only rows of one space are compared.

    Members: space, key, cls, of every text with at least 30 words, where equal word sequences share
    cls. Links: x, y, similarity of different classes with similarity at least ``t``, each once.
    NULL, empty and short texts are in neither, repeated rows are repeated members. Class ids are
    64-bit hashes, good for some 10**9 different texts.
    """
    spark, rows = rows.sparkSession, rows.select("space", "key", "text")
    bits = table_bits(rows)
    scanned = written(scan(rows, bits), "scan")
    rank = spark.sparkContext.broadcast(packed_table(rarity(scanned, bits).reshape(-1)))
    members = scanned.where("cls IS NOT NULL").select("space", "key", "tid", "cls", "n_words")
    pivots = spark.sparkContext.broadcast(pivots_of(rows, members))
    pairs = written(M.candidates(cell_entries(rows, rank, pivots, bits, t), t), "candidates")
    pairs = written(M.by_signature(pairs, scanned, t), "pairs")
    links = written(verified(pairs, M.texts_of(pairs, members, rows), t), "links")
    drop(pairs)
    return members, links
