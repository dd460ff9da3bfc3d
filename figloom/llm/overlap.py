"""Problem 3: records of evaluation splits that also occur, exactly or almost, in the training split.

Two records of similarity t share most of their three-word runs, so they lie together in intervals
that a suffix array of all texts has at depth three. ``meeting_suffixes`` sends of each record the
rarest of those suffixes whose first three words both sides have, as many as a pair must share
some of; sorted by prefix, each interval gives the cross-split pairs whose sizes and places
allow the similarity. This net is complete: it depends on no span being long.

The pairs cut the texts into partitions, an evaluation text with the training texts it may
overlap. Of each, ``compared`` makes the suffix array of the concatenated texts: adjacent suffixes of
different splits have the longest common prefixes, which are the shared spans, merged into the
record's coverage; and the intervals of depth three, counted, are the exact similarity.

``spans`` does the same without a threshold, over all suffixes of all texts: it sorts the suffixes of an
interval by the words that follow and takes common prefixes of cross-split neighbours.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from figloom.llm import meetings as M, shingles as S
from figloom.llm.rarity import STEPS, counted, fresh_texts, int64 as _int64, opened, packed_table, rarity, scan, table_bits
from figloom.llm.suffixes import SuffixArray, merged
from figloom.shared import drop, written
from figloom.sources.tables import table

TRAIN, EVAL = 0, 1
#: Shorter spans count as none.
LEAST_SPAN = S.SHINGLE_WORDS
#: Words by which suffixes are sorted at first, and how many times as far each next round looks.
KEY_WORDS = 12
FURTHER = 4
#: Training texts of a partition, and words of the partitions that are sorted together.
PART_TEXTS = 64
PART_WORDS = 400_000
WORD = re.compile("[a-z0-9]+")


def sides(train: DataFrame) -> DataFrame:
    """``train`` with ``space``: 0 in split train, 1 in validation or test; rows of no or another split are left out."""
    space = F.when(F.col("split") == "train", TRAIN).when(F.col("split").isin("validation", "test"), EVAL)
    return train.withColumn("space", space).where("space IS NOT NULL")


def both_sides(tables: np.ndarray) -> np.ndarray:
    """Ranks from the ranks of either side: 0 where a side has none, else at least 2."""
    total = np.rint(STEPS * np.log2(counted(tables[0]) + counted(tables[1]) + 1e-9) - STEPS) + 2
    return np.where((tables[0] > 0) & (tables[1] > 0), np.clip(total, 2, 255), 0).astype(np.uint8)


def meeting_suffixes(rows: DataFrame, tables: np.ndarray, bits: int, t: float = M.THRESHOLD) -> DataFrame:
    """The suffixes (by their first three words, ``meetings.ENTRY``) in which the texts (space, text) must meet a partner.

    ``tables``: ranks by side. A record too few of whose suffixes are on both sides has no partner and sends
    none; nor does it send those that are on its own side only. Equal texts of a side are one class, once per task.
    """
    packed = rows.sparkSession.sparkContext.broadcast(packed_table(tables))
    hot = max(M.hot_from(tables[0]), M.hot_from(tables[1]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held = opened(packed.value)
        for b in batches:
            space, texts = b.column(0).to_numpy(zero_copy_only=False).astype(np.int32), b.column(1).to_pylist()
            for first, part in S.chunks(texts):
                side = space[first : first + len(part)]
                doc, h, n_words, cls = S.shingles(part)
                cls = cls + side.astype(np.uint64)
                keep = fresh_texts(cls, n_words, seen)[doc]
                doc, h = doc[keep], h[keep]
                if not len(doc):
                    continue
                cell = (h & np.uint64((1 << bits) - 1)).astype(np.int64)
                doc, h, r = S.ordered(doc, h, both_sides(held[:, cell]))
                size = np.bincount(doc, minlength=len(part))
                place = np.arange(len(doc)) - (np.cumsum(size) - size)[doc]
                probe, index = M.prefixes(size, t)
                able = np.bincount(doc[r > 0], minlength=len(part)) >= np.ceil(t * size - 1e-9)
                e = np.flatnonzero((place < probe[doc]) & (r > 0) & able[doc])
                if not len(e):
                    continue
                cell = (h[e] & np.uint64((1 << bits) - 1)).astype(np.int64)
                n = counted(held[:, cell])
                mine = side[doc[e]]
                i, key, group = M.split_hot(h[e], cls[doc[e]], np.where(mine == TRAIN, n[0], n[1]), mine, np.where(mine == TRAIN, n[1], n[0]), hot)
                e = e[i]
                d = doc[e]
                yield M.batch_of(key, cls[d], size[d], place[e], place[e] < index[d], np.ones(len(e), bool), side[d], group, np.zeros(len(e)))

    return rows.select("space", "text").mapInArrow(run, M.ENTRY)


def partitions(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """part, chunk, space, cls, text: every evaluation text y of ``pairs`` with the training texts x it was paired with.

    One with very many of them has several chunks, each with its own copy of it.
    """
    degree = pairs.groupBy("y").agg(F.ceil(F.count(F.lit(1)) / PART_TEXTS).alias("n"))
    placed = pairs.join(degree, "y").select("x", F.col("y").alias("part"), F.pmod(F.xxhash64("x"), "n").cast("int").alias("chunk"))
    of_train = placed.select("part", "chunk", F.lit(TRAIN).alias("space"), F.col("x").alias("cls"))
    of_eval = placed.select("part", "chunk").distinct().select("part", "chunk", F.lit(EVAL).alias("space"), F.col("part").alias("cls"))
    return of_train.unionAll(of_eval).join(texts, "cls").select("part", "chunk", "space", "cls", "text")


_COMPARED = "x long, y long, common int, either int, spans array<int>"


def compare(part: np.ndarray, space: np.ndarray, cls: np.ndarray, texts: list[str]) -> pa.RecordBatch:
    """What the suffix array of whole partitions says; a partition has one text of space 1.

    A row per training text: its common three-word runs with the evaluation text, and those of either. A row
    without x: the stretches of the evaluation text (start and end by turns) that its spans cover, then the longest span.
    """
    doc, word = S.words(texts)
    array = SuffixArray(doc, word, part)
    interval, text = array.intervals(S.SHINGLE_WORDS)
    evals = np.flatnonzero(space == EVAL)
    of_part = np.zeros(int(part.max()) + 1, np.int64)
    of_part[part[evals]] = evals
    size = np.bincount(text, minlength=len(texts))
    held = np.zeros(int(interval.max(initial=0)) + 1, bool)
    held[interval[space[text] == EVAL]] = True
    common = np.bincount(text[held[interval]], minlength=len(texts))
    trains = np.flatnonzero(space == TRAIN)
    partner = of_part[part[trains]]
    either = size[trains] + size[partner] - common[trains]
    best = array.cross(space)
    n_words = np.bincount(doc, minlength=len(texts))
    first = np.cumsum(n_words) - n_words
    spans = []
    for i in evals:
        own = best[first[i] : first[i] + n_words[i]]
        at = np.flatnonzero(own >= LEAST_SPAN)
        start, end = merged(at, own[at], int(n_words[i]))
        spans.append([*np.column_stack([start, end]).reshape(-1).tolist(), int(own.max(initial=0))])
    n, m = len(trains), len(evals)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.append(cls[trains], np.zeros(m, np.int64)), mask=np.append(np.zeros(n, bool), np.ones(m, bool))), pa.array(np.append(cls[partner], cls[evals])),
            pa.array(np.append(common[trains], np.zeros(m, np.int64)).astype(np.int32)), pa.array(np.append(either, np.zeros(m, np.int64)).astype(np.int32)), pa.array([None] * n + spans, pa.list_(pa.int32())),
        ],
        names=["x", "y", "common", "either", "spans"],
    )


def compared(parted: DataFrame) -> DataFrame:
    """``compare`` of all partitions (``partitions``), read in order, several at once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def solved(rows: list[tuple]) -> pa.RecordBatch:
            keys = [(p, c) for p, c, *_ in rows]
            number = np.cumsum([1] + [a != b for a, b in zip(keys[1:], keys)]) - 1
            return compare(number, np.array([r[2] for r in rows]), np.array([r[3] for r in rows], np.int64), [r[4] for r in rows])

        words = 0
        for b in batches:
            for row in zip(*(b.column(i).to_pylist() for i in range(5))):
                if held and row[:2] != held[-1][:2]:
                    if words > PART_WORDS:
                        yield solved(held)
                        held, words = [], 0
                held.append(row)
                words += len(row[4]) // 5
        if held:
            yield solved(held)

    return parted.repartition("part", "chunk").sortWithinPartitions("part", "chunk").mapInArrow(run, _COMPARED)


def overlaps(rows: DataFrame, t: float = M.THRESHOLD) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members, links, spans) of ``rows``: space, key, text.

    Members: space, key, tid, cls, n_words, of the texts with 30 words or more. Links: x (of space 0), y (of space 1),
    similarity, of classes at least as similar as ``t``. A text on both sides is a class of either, and the two are
    linked. spans: y, spans, of the evaluation texts that a partition was made for.
    """
    rows = rows.select("space", "key", "text")
    bits = table_bits(rows)
    scanned = written(scan(rows, bits, 2), "scan")
    members = scanned.where("cls IS NOT NULL").select("space", "key", "tid", "cls", "n_words")
    pairs = written(M.candidates(meeting_suffixes(rows, rarity(scanned, bits, 2), bits, t), t, cross=True), "candidates")
    pairs = written(M.by_signature(pairs, scanned, t), "pairs")
    found = written(compared(partitions(pairs, M.texts_of(pairs, members, rows))), "compared")
    drop(pairs)
    good = F.col("common") * 1_000_000 >= F.lit(round(t * 1_000_000)) * F.greatest("either", F.lit(1))
    links = found.where(F.col("x").isNotNull() & good).select("x", "y", (F.col("common") / F.col("either")).alias("similarity"))
    return members, links, found.where("x IS NULL").select("y", "spans")


def classes(rows: DataFrame) -> DataFrame:
    """space, cls, n_words, text of the texts with 30 words or more, once per task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            space, texts = b.column(0).to_numpy(zero_copy_only=False).astype(np.int32), b.column(1)
            for first, part in S.chunks(texts.to_pylist()):
                _, _, n_words, cls = S.shingles(part)
                cls = cls + space[first : first + len(part)].astype(np.uint64)
                at = np.flatnonzero(fresh_texts(cls, n_words, seen))
                yield pa.RecordBatch.from_arrays([pa.array(space[first + at]), _int64(cls[at]), pa.array(n_words[at].astype(np.int32)), texts.take(pa.array(first + at))], names=["space", "cls", "n_words", "text"])

    return rows.select("space", "text").mapInArrow(run, "space int, cls long, n_words int, text string")


_SUFFIX = "space int, cls long, at int, g long, words string"


def _suffix_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.string()))], names=["space", "cls", "at", "g", "words"])


def _cut(text: str, ats: Iterable[int], low: int, high: int) -> Iterator[str]:
    """Words ``low`` to ``high`` of the text's suffixes at ``ats``."""
    words = WORD.findall(text.lower())
    ends = np.cumsum([0, *(len(x) + 1 for x in words)]).tolist()
    joined, last = " ".join(words), len(words)
    for at in ats:
        yield joined[ends[min(at + low, last)] : max(ends[min(at + high, last)] - 1, 0)]


def first_suffixes(texts: DataFrame, tables: np.ndarray, bits: int, high: int) -> DataFrame:
    """The suffixes of ``classes`` with their first ``high`` words, but for those whose shingle certainly isn't on the other side. g: the shingle's hash."""
    both = texts.sparkSession.sparkContext.broadcast((tables[0] > 0) & (tables[1] > 0))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for space, cls, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                _, h, _, _ = S.shingles([text])
                ats = np.flatnonzero(both.value[(h & np.uint64((1 << bits) - 1)).astype(np.int64)])
                own = zip(ats.tolist(), h[ats].view(np.int64).tolist(), _cut(text, ats.tolist(), 0, high))
                if rows := [(space, cls, at, g, words) for at, g, words in own]:
                    yield _suffix_batch(rows)

    return texts.select("space", "cls", "text").mapInArrow(run, _SUFFIX)


def further_suffixes(texts: DataFrame, tied: DataFrame, low: int, high: int) -> DataFrame:
    """The ``tied`` suffixes (cls, at, g) with their words from ``low`` to ``high``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for space, cls, text, own in zip(*(b.column(i).to_pylist() for i in range(4))):
                ats = [x["at"] for x in own]
                yield _suffix_batch([(space, cls, x["at"], x["g"], words) for x, words in zip(own, _cut(text, ats, low, high))])

    own = tied.groupBy("cls").agg(F.collect_set(F.struct("at", "g")).alias("own"))
    return texts.select("space", "cls", "text").join(own, "cls").select("space", "cls", "text", "own").mapInArrow(run, _SUFFIX)


def neighbours(suffix: DataFrame, low: int, high: int) -> DataFrame:
    """space, cls, at, lcp, tied, g of suffixes that share words with the nearest suffix of the other side before or after them.

    ``suffix``: as ``first_suffixes``; those of equal ``g`` share their first ``low`` words. They are sorted by g
    and words and read once. ``lcp``: the shared words from the suffix's start, ``tied`` if all up to
    ``high`` are shared; ``g`` then stands for all of them. Of space 0 only tied ones come out.
    """
    width = high - low
    step = max(64, (1 << 20) // width)

    def solved(space: np.ndarray, g: np.ndarray, m: np.ndarray) -> np.ndarray:
        n, place = len(space), np.arange(len(space))
        best = np.full(n, -1, np.int64)
        for turn in (slice(None), slice(None, None, -1)):
            s, gg, mm = space[turn], g[turn], m[turn]
            # of each side, the last place so far
            last = [np.maximum.accumulate(np.where(s == side, place, -1)) for side in (TRAIN, EVAL)]
            other = np.where(s == TRAIN, last[EVAL], last[TRAIN])
            met = np.flatnonzero((other >= 0) & (gg[other] == gg))
            same = (mm[met] == mm[other[met]]) & (mm[met] != 0)
            got = np.full(n, -1, np.int64)
            got[met] = np.logical_and.accumulate(same, axis=1).sum(axis=1)
            best = np.maximum(best, got[turn])
        return best

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[np.ndarray, ...] | None = None  # rows whose next neighbour is still to come, after one context row
        context = 0

        def out(rows: tuple[np.ndarray, ...], lcp: np.ndarray, first: int, last: int) -> pa.RecordBatch:
            space, cls, at, g, m = (x[first:last] for x in rows)
            lcp = lcp[first:last]
            tied = lcp == width
            keep = np.flatnonzero(tied | ((space == EVAL) & (lcp >= 0)))
            new = g[keep].view(np.uint64)
            for k in range(width if len(keep) else 0):
                new = S.mixed(new + m[keep, k])
            return pa.RecordBatch.from_arrays(
                [pa.array(space[keep]), pa.array(cls[keep]), pa.array(at[keep]), pa.array((lcp[keep] + low).astype(np.int32)), pa.array(tied[keep]), _int64(new)], names=["space", "cls", "at", "lcp", "tied", "g"]
            )

        for whole in batches:
            for start in range(0, whole.num_rows, step):
                b = whole.slice(start, step)
                doc, h = S.words(b.column(4).to_pylist())
                n = np.bincount(doc, minlength=b.num_rows)
                m = np.zeros((b.num_rows, width), np.uint64)
                m[doc, np.arange(len(doc)) - (np.cumsum(n) - n)[doc]] = h | np.uint64(1)  # 0: no word
                rows = (*(b.column(i).to_numpy(zero_copy_only=False) for i in range(4)), m)
                if held is not None:
                    rows = tuple(np.concatenate(x) for x in zip(held, rows))
                lcp = solved(rows[0], rows[3], rows[4])
                open_ = (rows[0] == rows[0][-1]) & (rows[3] == rows[3][-1])
                first = int(np.flatnonzero(~open_)[-1]) + 1 if not open_.all() else 0
                first = max(first, context)
                yield out(rows, lcp, context, first)
                context = int(first > 0)
                held = tuple(x[first - context :] for x in rows)
        if held is not None:
            yield out(held, solved(held[0], held[3], held[4]), context, len(held[0]))

    ordered = suffix.repartition("g").sortWithinPartitions("g", "words")
    return ordered.mapInArrow(run, "space int, cls long, at int, lcp int, tied boolean, g long")


def spans(rows: DataFrame, tables: np.ndarray, bits: int) -> DataFrame:
    """cls, covered, longest of the texts of space 1 that share ``LEAST_SPAN`` words or more with a text of space 0.

    A span starts at a word and is as long as the common prefix of the suffix there with its nearest
    neighbour of the other side, so one text of space 0 has all of it. ``covered`` is the share of words in
    any span, ``longest`` the longest span's words. Suffixes that agree in all words looked at are
    sorted again by the words that follow, ``FURTHER`` times as far, until none is left.
    """
    texts = written(classes(rows), "texts")
    low, high = 0, KEY_WORDS
    found = [written(neighbours(first_suffixes(texts, tables, bits, high), low, high), "neighbours")]
    while not (tied := found[-1].where("tied")).isEmpty():
        low, high = high, high * FURTHER
        found.append(written(neighbours(further_suffixes(texts, tied, low, high), low, high), "neighbours"))
    ends = None
    for part in found:
        part = part.where((F.col("space") == EVAL) & (F.col("lcp") >= LEAST_SPAN)).select("cls", "at", "lcp")
        ends = part if ends is None else ends.unionAll(part)
    ends = ends.groupBy("cls", "at").agg(F.max("lcp").alias("lcp"))
    zero = F.struct(F.lit(0).alias("total"), F.lit(0).alias("end"))

    def step(acc: Column, x: Column) -> Column:
        end = x["at"] + x["lcp"]
        return F.struct((acc["total"] + F.greatest(end - F.greatest(acc["end"], x["at"]), F.lit(0))).alias("total"), F.greatest(acc["end"], end).alias("end"))

    own = ends.groupBy("cls").agg(F.sort_array(F.collect_list(F.struct("at", "lcp"))).alias("s"), F.max("lcp").alias("longest"))
    sizes = texts.where(F.col("space") == EVAL).select("cls", "n_words").distinct()
    return own.join(sizes, "cls").select("cls", F.round(F.aggregate("s", zero, step)["total"] / F.col("n_words"), 4).alias("covered"), "longest")


def _rows(spark: SparkSession, folder: str) -> DataFrame:
    return sides(table(spark, folder, "train")).select("space", F.col("id").alias("key"), F.col("prompt").alias("text")).where("key IS NOT NULL AND text IS NOT NULL")


def _linked(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(space, key, cls of the records of linked classes; the links)."""
    members, links, _ = overlaps(_rows(spark, folder))
    return M.by_keys(members.select("space", "key", "cls"), M.named_classes(links), ["cls"]).distinct(), links


def _hashed(spark: SparkSession, folder: str) -> DataFrame:
    """space, id, sha256 of the rows whose hash occurs on both sides. Only the hashes move to find them."""
    hashed = sides(table(spark, folder, "train")).where("sha256 IS NOT NULL AND id IS NOT NULL").select("sha256", "id", "space")
    two = hashed.groupBy("sha256").agg(F.min("space").alias("low"), F.max("space").alias("high")).where("low < high").select("sha256")
    return M.by_keys(hashed, written(two, "two_sided"), ["sha256"]).distinct()


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Cross-split pairs with the same image or nearly the same prompt."""
    own, links = _linked(spark, folder)
    a, b = (own.where(F.col("space") == s).select(F.col("cls").alias(c), F.col("key").alias(k)) for s, c, k in ((TRAIN, "x", "a"), (EVAL, "y", "b")))
    text = links.select("x", "y").join(a, "x").join(b, "y").select("a", "b")
    hashed = _hashed(spark, folder)
    a, b = (hashed.where(F.col("space") == s).select("sha256", F.col("id").alias(k)) for s, k in ((TRAIN, "a"), (EVAL, "b")))
    pairs = text.unionAll(a.join(b, "sha256").select("a", "b")).where("a != b")
    return pairs.select(F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b")).distinct()


def _others(rows: DataFrame, keys: list[str], key: str) -> DataFrame:
    """Per ``keys`` the smallest and greatest ``key``: some row has another one than k if either differs from k."""
    return rows.groupBy(*keys).agg(F.min(key).alias("low"), F.max(key).alias("high"))


def p3_report(spark: SparkSession, folder: str) -> DataFrame:
    """Per evaluation split and source (NULL is a source of its own): rows, and rows that overlap train by hash, by text, or either.

    No pair of rows is made: of the training side only the smallest and greatest id per hash or class count.
    """
    own, links = _linked(spark, folder)
    hashed = _hashed(spark, folder)
    other = (F.col("low") != F.col("id")) | (F.col("high") != F.col("id"))
    evals = hashed.where(F.col("space") == EVAL).select("sha256", "id")
    by_hash = evals.join(_others(hashed.where(F.col("space") == TRAIN), ["sha256"], "id"), "sha256").where(other).select("id", F.lit("hash").alias("why"))
    train = _others(own.where(F.col("space") == TRAIN).select(F.col("cls").alias("x"), "key"), ["x"], "key")
    partners = links.join(train, "x").groupBy("y").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    by_text = own.where(F.col("space") == EVAL).select(F.col("cls").alias("y"), F.col("key").alias("id")).join(partners, "y").where(other).select("id", F.lit("text").alias("why"))
    hit = by_hash.unionAll(by_text).groupBy("id").agg(F.max(F.col("why") == "hash").alias("by_hash"), F.max(F.col("why") == "text").alias("by_text"))
    rows = sides(table(spark, folder, "train")).where(F.col("space") == EVAL).select("id", "split", "source").join(hit, "id", "left")
    one = {c: F.coalesce(F.col(c), F.lit(False)) for c in ("by_hash", "by_text")}
    return rows.groupBy("split", "source").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(one["by_hash"]).alias("n_hash"), F.count_if(one["by_text"]).alias("n_text"), F.count_if(one["by_hash"] | one["by_text"]).alias("n_either"))


def p3_classes(spark: SparkSession, folder: str) -> DataFrame:
    """The form without pairs: every prompt of 30 words or more with its side, its class of equal texts (the smallest id), and the number of classes of the other side at 0.6 or more."""
    members, links, _ = overlaps(_rows(spark, folder))
    own = members.select("space", "key", "cls").distinct()
    first = own.groupBy("cls").agg(F.min("key").alias("class_id"))
    degree = links.select(F.col("x").alias("cls")).unionAll(links.select("y")).groupBy("cls").agg(F.count(F.lit(1)).alias("n_links"))
    told = first.join(degree, "cls", "left")
    return own.join(told, "cls").select(F.col("key").alias("id"), F.when(F.col("space") == TRAIN, "train").otherwise("evaluation").alias("side"), "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def p3_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """Per evaluation prompt of 30 words or more: the share of it in spans of three words or more that some training prompt of 30 words or more has too, and the longest such span."""
    rows = _rows(spark, folder)
    bits = table_bits(rows)
    scanned = written(scan(rows, bits, 2), "scan")
    evals = scanned.where(F.col("space") == EVAL)
    found = spans(rows, rarity(scanned, bits, 2), bits)
    return evals.select(F.col("key").alias("id"), "cls").distinct().join(found, "cls", "left").select("id", F.coalesce("covered", F.lit(0.0)).alias("covered"), F.coalesce("longest", F.lit(0)).alias("longest"))


QUERIES = {f.__name__: f for f in (p3_found, p3_report, p3_classes, p3_coverage)}
