"""Tables with keys on a file system: versioned upsert, delete with cascade, truncation, compaction.

A table is a folder of version folders and a pointer file, which names the version of each bucket. A write
makes a new version of some buckets and then replaces the pointer in one step, so a reader that starts sees the old
or the new state whole. Versions that neither the last nor the present state names are deleted. One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from figloom.shared import delete, drop, file_system, replace_file, written

SCHEMAS = {
    "docs": "doc_id string, xml string, tiffs array<string>",
    "figures": "id string, doc_id string, tiff_path string, fig_label string, bbox_x1 int, bbox_y1 int, bbox_x2 int, bbox_y2 int",
    "text_fts": "doc_id string, section string, content string",
}
KEYS = {"docs": ["doc_id"], "figures": ["id"], "text_fts": ["doc_id", "section"]}
#: A table's rows lie in so many buckets by the hash of their key; an upsert rewrites those it touches.
BUCKETS = 64
#: Child table -> its key in docs; deletes and truncation go along it.
CHILDREN = {"figures": "doc_id", "text_fts": "doc_id"}


def _split_schema(schema: str) -> list[str]:
    return [c.strip() for c in schema.split(", ")]


def _bucket(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")


def latest(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the one with the greatest ``order`` (NULLs lowest); a NULL key is a key.

    Ties go to the greatest values of the other columns. A maximum with map-side combining: a hot
    key isn't collected. Columns must be orderable (no maps).
    """
    rest = [c for c in rows.columns if c not in keys]
    ranked = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], *[F.col(f"`{c}`") for c in rest])
    return rows.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.max(ranked).alias("_m")).select(*[F.col(f"`{c}`") if c in keys else F.col(f"_m.`{c}`") for c in rows.columns])


def merged(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` with ``new``'s rows in place of those with the same key. Applying the same batch twice changes nothing."""
    both = old.withColumn("_batch", F.lit(0)).unionByName(new.select(*old.columns).withColumn("_batch", F.lit(1)))
    return latest(both, keys, [F.col("_batch")]).drop("_batch")


class Store:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def versions(self, name: str) -> dict[str, str]:
        """Bucket -> the version folder that holds it; empty for a table that doesn't exist."""
        fs, at = file_system(self.spark, f"{self.folder}/{name}/CURRENT")
        if not fs.exists(at):
            return {}
        return json.loads(self.spark.read.text(f"{self.folder}/{name}/CURRENT", wholetext=True).first()[0])

    def create(self) -> None:
        """Empty tables for those that don't exist yet. Idempotent."""
        for name, schema in SCHEMAS.items():
            if not self.versions(name):
                self.write(name, self.spark.createDataFrame([], schema))

    def read(self, name: str) -> DataFrame:
        return self._buckets(name, self.versions(name))

    def _buckets(self, name: str, versions: dict[str, str]) -> DataFrame:
        there = [f"{self.folder}/{name}/{version}/_bucket={k}" for k, version in versions.items() if version]
        if not there:
            return self.spark.createDataFrame([], SCHEMAS[name])
        return self.spark.read.schema(SCHEMAS[name]).parquet(*there)

    def write(self, name: str, rows: DataFrame, buckets: set[str] | None = None) -> None:
        """Replaces the contents at once, of ``buckets`` or of all; ``rows`` are those of these buckets."""
        before, version = self.versions(name), f"v-{uuid.uuid4().hex}"
        placed = rows.withColumn("_bucket", _bucket(KEYS[name]))
        placed.repartition("_bucket").write.partitionBy("_bucket").parquet(f"{self.folder}/{name}/{version}")
        now = {str(k): before.get(str(k), "") for k in range(BUCKETS)}
        fs, at = file_system(self.spark, f"{self.folder}/{name}/{version}")
        made = {e.getPath().getName().removeprefix("_bucket=") for e in fs.listStatus(at) if e.isDirectory()}
        for k in now:
            if buckets is None or k in buckets:
                now[k] = version if k in made else ""
        replace_file(self.spark, f"{self.folder}/{name}/CURRENT", json.dumps(now))
        if before:
            self._forget(name, {*before.values(), *now.values()})

    def _forget(self, name: str, keep: set[str]) -> None:
        """Deletes all versions but ``keep``: those of the last state stay for readers that have begun with it."""
        fs, at = file_system(self.spark, f"{self.folder}/{name}")
        for entry in fs.listStatus(at):
            found = entry.getPath().getName()
            if found.startswith("v-") and found not in keep:
                delete(self.spark, f"{self.folder}/{name}/{found}")

    def upsert(self, name: str, rows: DataFrame) -> None:
        """Takes ``rows`` in. Reads and rewrites only the buckets that their keys fall in."""
        rows = written(rows.select(*[f.split()[0] for f in _split_schema(SCHEMAS[name])]), "batch")
        touched = {str(r._bucket) for r in rows.select(_bucket(KEYS[name]).alias("_bucket")).distinct().collect()}  # at most BUCKETS
        if touched:
            held = {k: v for k, v in self.versions(name).items() if k in touched}
            self.write(name, merged(self._buckets(name, held), rows, KEYS[name]), touched)
        drop(rows)

    def delete_documents(self, ids: DataFrame) -> None:
        """Removes documents (doc_id) and, first, all their figures and sections."""
        gone = ids.select("doc_id").distinct()
        for name in (*CHILDREN, "docs"):
            self.write(name, self.read(name).join(gone, "doc_id", "left_anti"))

    def clear(self) -> None:
        """Empties all tables, children first."""
        for name in (*CHILDREN, "docs"):
            self.write(name, self.read(name).limit(0))

    def vacuum(self) -> DataFrame:
        """Rewrites every table as one file per bucket, and returns its ``statistics``."""
        for name in SCHEMAS:
            self.write(name, self.read(name))
        return self.statistics()

    def statistics(self) -> DataFrame:
        """relname, n_rows, n_files, n_bytes of each table's files as they stand."""
        told = []
        for name in sorted(SCHEMAS):
            n_files = n_bytes = 0
            for k, version in self.versions(name).items():
                if version:
                    fs, at = file_system(self.spark, f"{self.folder}/{name}/{version}/_bucket={k}")
                    summary = fs.getContentSummary(at)
                    n_files, n_bytes = n_files + int(summary.getFileCount()), n_bytes + int(summary.getLength())
            told.append((name, n_files, n_bytes))
        return self.counts().join(self.spark.createDataFrame(told, "relname string, n_files long, n_bytes long"), "relname")

    def counts(self) -> DataFrame:
        return table_counts({name: self.read(name) for name in SCHEMAS})

    def integrity(self) -> DataFrame:
        return integrity({name: self.read(name) for name in SCHEMAS})

    def overview(self) -> DataFrame:
        """The documents with their number of pages; also the temporary view ``doc_overview``."""
        view = doc_overview(self.read("docs"))
        view.createOrReplaceTempView("doc_overview")
        return view


def doc_overview(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "xml", F.coalesce(F.when(F.size("tiffs") >= 0, F.size("tiffs")), F.lit(0)).alias("tiff_count"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, (t.groupBy().agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("relname"), "n_rows") for n, t in sorted(tables.items())))


def integrity(tables: dict[str, DataFrame]) -> DataFrame:
    """Per table: rows, and rows whose doc_id is in no document (0 for docs)."""
    known = tables["docs"].select("doc_id").distinct()

    def one(name: str) -> DataFrame:
        rows = tables[name]
        lost = rows.join(known, "doc_id", "left_anti") if name in CHILDREN else rows.limit(0)
        n = lost.groupBy().agg(F.count(F.lit(1)).alias("n_orphans")).withColumn("relname", F.lit(name))
        return table_counts({name: rows}).join(n, "relname")

    return reduce(DataFrame.unionAll, map(one, sorted(tables)))


def session_info(spark: SparkSession) -> DataFrame:
    return spark.sql("SELECT current_database() AS db, current_user() AS db_user, version() AS version, current_timezone() AS timezone")
