"""Problem 1: millions of tiny files become few well-sized ones, each record kept exactly once.

The engine's own split packing does the reading: while a job runs, the maximum partition bytes
are set to what one task shall read and the cost of opening a file to what opening really costs
here, so that one split combines many files. Output partitions are merged by ``coalesce`` (no
shuffle). Output goes to a staging folder, is read back and compared with the input, and only
then gets its final name.
"""

from __future__ import annotations

import contextlib
import math
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from figloom.functions.names import PROJECT_ROOT, canonical_path
from figloom.operators.running import running_total
from figloom.shared import file_system, written

MIB = 1 << 20


@dataclass(frozen=True)
class Packing:
    """What the scan is tuned to: bytes of a combined split and the bytes that opening a file counts as."""

    max_partition_bytes: int
    open_cost_bytes: int
    n_files: int
    total_bytes: int


def plan_packing(spark: SparkSession, path: str, target_bytes: int = 128 * MIB) -> Packing:
    """Combined splits near ``target_bytes``, fewer bytes only where the cluster's slots would idle.

    Uses the folder's file count and length only (no listing reaches the driver). Opening counts
    as the mean file size, between 4 KiB and 4 MiB: with the engine's default of 4 MiB a split of
    tiny files would hold 32 of them however small they are.
    """
    fs, at = file_system(spark, path)
    told = fs.getContentSummary(at)
    n_files, total = max(1, int(told.getFileCount())), int(told.getLength())
    slots = max(1, spark.sparkContext.defaultParallelism)
    cost = min(4 * MIB, max(4096, total // n_files))
    return Packing(min(target_bytes, max(MIB, math.ceil(total / slots) + cost)), cost, n_files, total)


@contextlib.contextmanager
def split_packing(spark: SparkSession, packing: Packing) -> Iterator[None]:
    """Scans planned inside use ``packing``; the session's own values come back after."""
    names = {"spark.sql.files.maxPartitionBytes": packing.max_partition_bytes, "spark.sql.files.openCostInBytes": packing.open_cost_bytes}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, str(v))
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _publish(spark: SparkSession, staging: str, final: str) -> None:
    fs, source = file_system(spark, staging)
    _, target = file_system(spark, final)
    if fs.exists(target):
        raise FileExistsError(final)
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise OSError(f"could not rename {staging} to {final}")


def fingerprint(df: DataFrame, *columns: Column) -> tuple[int, int]:
    """Row count and an order-free sum of row hashes: equal multisets of rows give equal values."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("h")).first()
    return int(row.n), int(row.h or 0)


def compact_files(spark: SparkSession, source: str, final: str, target_bytes: int = 128 * MIB) -> Packing:
    """Rewrites the Parquet folder ``source`` as files near ``target_bytes`` under ``final``.

    One stage, no shuffle: a combined split is read by one task and written as one file. Rows,
    repeats included, stay as they are; row count and checksum of the staged copy must equal the
    source's, or nothing is published. An empty table gives an empty table. Maps can't be hashed:
    cast them to JSON first.
    """
    packing = plan_packing(spark, source, target_bytes)
    staging = f"{final}.staging-{uuid.uuid4().hex}"
    with split_packing(spark, packing):
        rows = spark.read.parquet(source)
        rows.coalesce(max(1, math.ceil(packing.total_bytes / target_bytes))).write.parquet(staging)
        copy = spark.read.schema(rows.schema).parquet(staging)
        want, got = (fingerprint(x, *[x[f"`{c}`"] for c in x.columns]) for x in (rows, copy))
    if want != got:
        raise RuntimeError(f"staged copy of {source} differs: {want} and {got}; it stays in {staging}")
    _publish(spark, staging, final)
    return packing


def latest_writes(files: DataFrame, root: str = PROJECT_ROOT) -> DataFrame:
    """One row per path: the write with the greatest (``written_at``, ``file_id``); NULL times come first.

    A maximum with map-side combining, so a path with a third of all rows moves few of them. A row
    without a path (NULL or empty) is a file of its own: it can't be another's later write. Removal
    plays no role. ``own`` is the hash of the payload as the source has it, where ``files`` has payloads.
    """
    key = F.coalesce(canonical_path(F.col("path"), root), F.concat(F.lit("?"), F.col("file_id").cast("string")))
    own = _payload_hash(F.col("payload")) if "payload" in files.columns else F.lit(None).cast("long")
    last = F.max(F.struct("written_at", "file_id", "applicant_id", F.greatest(F.coalesce("n_bytes", F.lit(0)), F.lit(0)).cast("long").alias("n_bytes"), own.alias("own")))
    return files.groupBy(key.alias("key")).agg(last.alias("w")).select("w.file_id", "w.applicant_id", "w.n_bytes", "w.own")


def _payload_hash(payload: Column) -> Column:
    return F.xxhash64(payload, payload.isNull())


def assign_bundles(winners: DataFrame, bundle_bytes: int) -> DataFrame:
    """Adds ``bundle_no`` per applicant: ``floor(bytes before / bundle_bytes)`` in order of ``file_id``.

    That is at most ceil(applicant's bytes / bundle_bytes) bundles, each over the target by less than its
    last file. Empty files count as one byte, so that a bundle's row count
    is bounded too. A NULL owner is an owner of its own.
    """
    sized = winners.withColumn("_size", F.greatest("n_bytes", F.lit(1)))
    return running_total(sized, ["applicant_id"], ["file_id"], "_size").select(
        "file_id", "applicant_id", F.floor(F.col("before") / F.lit(bundle_bytes)).cast("int").alias("bundle_no"), "_size", "own"
    )


def slots_of(placed: DataFrame, file_bytes: int) -> DataFrame:
    """applicant_id, first_id, slot: where the store's files begin, in order of (applicant, file_id).

    A file is a stretch of whole bundles of about ``file_bytes``, and at least one; a file begins only where a bundle
    does. That is a row per file of the store and per applicant, whatever the number of records.
    """
    bundles = placed.groupBy("applicant_id", "bundle_no").agg(F.min("file_id").alias("first_id"), F.sum("_size").alias("_bytes"))
    summed = running_total(bundles.withColumn("_one", F.lit(0)).withColumn("_owner", F.coalesce("applicant_id", F.lit(""))).withColumn("_null", F.col("applicant_id").isNull()), ["_one"], ["_owner", "_null", "bundle_no"], "_bytes")
    slot = F.floor(F.col("before") / F.lit(file_bytes)).cast("int")
    return summed.groupBy("applicant_id", slot.alias("slot")).agg(F.min("first_id").alias("first_id"))


def _in_slots(slots: list) -> Callable[[Column, Column], Column]:
    """A column function (applicant_id, file_id) -> slot, for the collected rows of ``slots_of``; -1 where none begins before."""
    starts: dict[str | None, tuple] = {}
    for r in sorted(slots, key=lambda r: r.first_id):
        starts.setdefault(r.applicant_id, ([], []))
        starts[r.applicant_id][0].append(r.first_id)
        starts[r.applicant_id][1].append(r.slot)
    starts = {k: (np.array(a, np.int64), np.array([-1, *b], np.int32)) for k, (a, b) in starts.items()}

    @F.pandas_udf("int")
    def slot(owner: pd.Series, file_id: pd.Series) -> pd.Series:
        out = np.full(len(owner), -1, np.int32)
        codes, names = pd.factorize(owner, use_na_sentinel=False)
        for code, name in enumerate(names):
            first, number = starts.get(None if pd.isna(name) else name, (np.zeros(0, np.int64), np.array([-1], np.int32)))
            at = np.flatnonzero(codes == code)
            out[at] = number[np.searchsorted(first, file_id.to_numpy()[at], side="right")]
        return pd.Series(out)

    return slot


def consolidate(spark: SparkSession, source: str, final: str, bundle_bytes: int, root: str = PROJECT_ROOT, file_bytes: int = 128 * MIB) -> DataFrame:
    """Writes the consolidated store of the rows of ``source`` (like ``page_files``) to ``final``.

    The store has one row per bundle: ``applicant_id, bundle_no, n_files, n_bytes`` and ``members``,
    an array of (file_id, path, kind, n_bytes, sha256, written_at, removed_at, payload) in order of
    file_id. The hash is computed from the payload, so null and wrong hashes don't get in. Bundles
    are rows and not files, because at 256 KiB a file each would be the small-files problem again;
    the store's files are near ``file_bytes``.

    The payload moves once. The winners are found without it; where the store's files begin among them is a short
    list, one row per file, which tells each record its file. There the records meet their winners' rows
    (bundle number and the source's hash of the payload); those without one are dropped. The number of files follows
    from the kept bytes alone.

    Before the rename the staged store is read again: its file ids must be exactly the winners',
    each once, and every member's payload must have the hash that the source's payload of that id has.
    """
    packing = plan_packing(spark, source, file_bytes)
    staging = f"{final}.staging-{uuid.uuid4().hex}"
    with split_packing(spark, packing):
        files = spark.read.parquet(source)
        winners = latest_writes(files.select("file_id", "path", "applicant_id", "n_bytes", "written_at", "payload"), root)
        placed = written(assign_bundles(winners, bundle_bytes), "placed")
        slots = slots_of(placed, file_bytes).collect()  # a row per file of the store and applicant
        n_slots = len({r.slot for r in slots})
        slot = _in_slots(slots)(F.col("applicant_id"), F.col("file_id")).alias("slot")
        records = files.select(slot, "file_id", "applicant_id", canonical_path(F.col("path"), root).alias("path"), "kind", "payload", "written_at", "removed_at", F.lit(None).cast("int").alias("bundle_no"))
        marks = placed.select(slot, "file_id", "applicant_id", *[F.lit(None).cast(t).alias(c) for c, t in records.dtypes if c not in ("slot", "file_id", "applicant_id", "bundle_no")], "bundle_no")
        together = records.unionByName(marks.select(*records.columns)).where("slot >= 0").repartition(max(1, n_slots), "slot")
        record = F.struct("path", "kind", "payload", "written_at", "removed_at")
        met = together.groupBy("slot", "applicant_id", "file_id").agg(F.max("bundle_no").alias("bundle_no"), F.first(F.when(F.col("bundle_no").isNull(), record), ignorenulls=True).alias("r")).where("bundle_no IS NOT NULL AND r IS NOT NULL")
        bundles = met.groupBy("slot", "applicant_id", "bundle_no").agg(F.sort_array(F.collect_list(F.struct("file_id", "r"))).alias("m"))
        hashed = F.transform("m", lambda m: F.struct(
            m.file_id.alias("file_id"), m.r.path.alias("path"), m.r.kind.alias("kind"), F.coalesce(F.octet_length(m.r.payload), F.lit(0)).alias("n_bytes"),
            F.sha2(m.r.payload, 256).alias("sha256"), m.r.written_at.alias("written_at"), m.r.removed_at.alias("removed_at"), m.r.payload.alias("payload"),
        ))
        rows = bundles.withColumn("members", hashed).select(
            "applicant_id", "bundle_no", F.size("members").alias("n_files"),
            F.aggregate("members", F.lit(0).cast("long"), lambda s, m: s + m.n_bytes).alias("n_bytes"), "members",
        )
        rows.write.parquet(staging)
        store = spark.read.schema(rows.schema).parquet(staging)
        kept = store.select(F.explode("members").alias("m"))
        bad = kept.where(~F.sha2("m.payload", 256).eqNullSafe(F.col("m.sha256"))).limit(1).count()
        want, got = fingerprint(placed, F.col("file_id"), F.col("own")), fingerprint(kept, F.col("m.file_id"), _payload_hash(F.col("m.payload")))
    if bad or want != got:
        raise RuntimeError(f"the staged store differs from its input ({want} and {got}, bad payload: {bool(bad)}); it stays in {staging}")
    _publish(spark, staging, final)
    return spark.read.schema(rows.schema).parquet(final)


def store_members(store: DataFrame) -> DataFrame:
    """The store as flat rows, one per kept file."""
    return store.select("applicant_id", "bundle_no", F.inline("members"))
