"""Problem 9: texts placed in as few containers of fixed capacity as can be, with a steady mixture.

Mixture-controlled packing. Every source is a queue, and a window of containers gives each queue
a quantum of tokens in the target proportion; what a queue got too much or too little is carried
to the next window, on whatever partition that is. An item's window is therefore fixed by the
tokens before it in its queue: ``floor(before / quantum)``, a running total over all partitions.
Windows are then packed side by side, best fit with the largest first. Containers that stay
under ``FULL`` are opened again and their items carried into the next round's windows (of the same target
proportions), until one window holds all that is left.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from figloom.operators.running import running_total
from figloom.shared import written

#: Containers of a window; a window's items are one task's group, bounded by this times the capacity.
WINDOW = 512
#: Share of the capacity from which a container counts as full.
FULL = 0.98


def best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The container of each item: largest first, each where the least room remains that fits."""
    out = np.zeros(len(sizes), np.int64)
    open_: list[tuple[int, int]] = []  # (room, container), by room
    n = 0
    for i in np.argsort(-sizes, kind="stable"):
        size = int(sizes[i])
        at = bisect_left(open_, (size, -1))
        if at == len(open_):
            room, box, n = capacity, n, n + 1
        else:
            room, box = open_.pop(at)
        out[i] = box
        if room > size:
            insort(open_, (room - size, box))
    return out


def split_items(items: DataFrame, capacity: int) -> DataFrame:
    """Items (doc_id, source, n_tokens > 0) as parts: part_no, start, size. Only an item over the capacity has several, all but the last full."""
    last = F.floor((F.col("n_tokens") - 1) / F.lit(capacity)).cast("int")
    return items.select("doc_id", "source", "n_tokens", F.explode(F.sequence(F.lit(0), last)).alias("part_no")).select(
        "doc_id", "source", "part_no", (F.col("part_no") * capacity).alias("start"), F.least(F.lit(capacity), F.col("n_tokens") - F.col("part_no") * capacity).cast("int").alias("size")
    )


def windows(parts: DataFrame, capacity: int, window: int = WINDOW, shares: DataFrame | None = None) -> DataFrame:
    """Adds ``window_no``. ``shares`` (source, share): the target mixture, by default that of the parts themselves.

    A source without a share keeps its own. What a window gave a queue more or less than its quantum is carried to
    the next: the running total isn't started anew. A queue whose target is below its part of the corpus is
    served on in windows where the others have run out: nothing is left out.
    """
    sums = parts.groupBy("source").agg(F.sum("size").alias("_of_source"))
    total = sums.agg(F.sum("_of_source")).first()[0] or 0
    n = max(1, -(-int(total) // (window * capacity)))
    if shares is not None:
        known = shares.select(F.col("source").alias("_s"), F.col("share").cast("double").alias("_share"))
        sums = sums.join(known, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
        quantum = F.when(F.col("_share") > 0, F.col("_share") * float(window * capacity)).otherwise(F.col("_of_source") / n)
    else:
        quantum = F.col("_of_source") / n
    sums = sums.select(F.col("source").alias("_src"), quantum.alias("_quantum"))
    queued = running_total(parts.withColumn("_turn", F.xxhash64("doc_id", "part_no")), ["source"], ["_turn", "doc_id", "part_no"], "size").drop("_turn")
    return queued.join(sums, F.col("source").eqNullSafe(F.col("_src"))).withColumn("window_no", F.floor(F.col("before") / F.col("_quantum")).cast("long")).drop("_src", "_quantum", "before")


def mixture(parts: DataFrame, capacity: int, shares: DataFrame, window: int = WINDOW) -> DataFrame:
    """window_no, source, target, n_tokens, reached, carried, all_left of the windows of ``parts``.

    target: the share wanted (scaled to 1 over the sources there are), reached: that of the window's tokens. carried: tokens
    by which the queue is behind (or, below 0, ahead of) its target after the window. all_left: no queue has
    run out before the window's end; where one has, the others fill the room and the target can't be reached.
    """
    known = parts.select("source").distinct().join(shares.select(F.col("source").alias("_s"), F.col("share").cast("double").alias("_share")), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    whole = Window.partitionBy(F.lit(1))  # a row per source
    known = known.withColumn("target", F.col("_share") / F.sum("_share").over(whole)).select(F.col("source").alias("_src"), "target")
    scaled = known.select(F.col("_src").alias("source"), F.col("target").alias("share"))
    placed = windows(parts, capacity, window, scaled).groupBy("window_no", "source").agg(F.sum("size").alias("n_tokens"))
    last = placed.groupBy("source").agg(F.max("window_no").alias("_last")).agg(F.min("_last").alias("_first_end"))
    so_far = Window.partitionBy("source").orderBy("window_no")
    total = Window.partitionBy("window_no")
    found = placed.join(known, F.col("source").eqNullSafe(F.col("_src"))).drop("_src").withColumn("carried", F.col("target") * float(window * capacity) * (F.col("window_no") + 1) - F.sum("n_tokens").over(so_far))
    found = found.withColumn("reached", F.col("n_tokens") / F.sum("n_tokens").over(total)).crossJoin(F.broadcast(last))  # one row
    return found.select("window_no", "source", F.round("target", 6).alias("target"), "n_tokens", F.round("reached", 6).alias("reached"), F.round("carried").cast("long").alias("carried"), (F.col("window_no") < F.col("_first_end")).alias("all_left"))


def pack(items: DataFrame, capacity: int, window: int = WINDOW, shares: DataFrame | None = None) -> DataFrame:
    """doc_id, source, part_no, start, size, container_id, place (first token's place in the container).

    ``items``: doc_id (unique), source (may be NULL, a source of its own), n_tokens. Items without
    tokens need no room: one part of size 0 with a NULL container. An empty table gives no rows.
    """
    kind = dict(items.dtypes)["doc_id"]
    items = written(items.select("doc_id", "source", "n_tokens"), "items")  # counted once, read by every pass

    def fill(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["size", "doc_id", "part_no"], ascending=[False, True, True])
        box = best_fit(frame["size"].to_numpy(), capacity)
        frame = frame.assign(container_no=box).sort_values("container_no", kind="stable")
        frame["place"] = (frame.groupby("container_no")["size"].cumsum() - frame["size"]).astype("int32")
        frame["used"] = frame.groupby("container_no")["size"].transform("sum").astype("int32")
        return frame

    schema = f"doc_id {kind}, source string, part_no int, start int, size int, window_no long, container_no long, place int, used int"
    first = items.where("n_tokens > 0").withColumn("source", F.col("source").cast("string"))
    left, done, round_no = split_items(first, capacity), [], 0
    while True:
        placed = windows(left, capacity, window, shares)
        packed = written(placed.groupBy("window_no").applyInPandas(fill, schema), "packed").withColumn("round_no", F.lit(round_no))
        several = packed.select("window_no").distinct().limit(2).count() > 1
        if not several:
            done.append(packed)
            break
        full = F.col("used") >= FULL * capacity
        done.append(packed.where(full))
        left = packed.where(~full).select("doc_id", "source", "part_no", "start", "size")
        if round_no and not packed.where(full).limit(1).count():
            done.append(packed.where(~full))
            break
        round_no += 1
    every = done[0]
    for more in done[1:]:
        every = every.unionByName(more)
    number = F.col("round_no").cast("long") * (1 << 56) + F.col("window_no") * (1 << 20) + F.col("container_no")
    rows = every.select("doc_id", "source", "part_no", "start", "size", number.alias("container_id"), "place")
    empty = items.where("n_tokens IS NULL OR n_tokens <= 0").select(
        "doc_id", F.col("source").cast("string").alias("source"), F.lit(0).alias("part_no"), F.lit(0).alias("start"), F.lit(0).alias("size"), F.lit(None).cast("long").alias("container_id"), F.lit(None).cast("int").alias("place")
    )
    return rows.unionByName(empty)
