"""ZIP bundles: one XML and at least one TIFF, without chemistry members."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from figloom.functions.names import document_key, stem
from figloom.session import prepare

REJECTED = (".cdx", ".mol")
MEMBERS = "array<struct<member:string,n_bytes:long>>"
_FILE = pa.struct([("kind", pa.string()), ("name", pa.string()), ("content", pa.binary())])


def scan_bundles(spark: SparkSession, folder: str) -> DataFrame:
    """path, modificationTime, length, content of all ``*.zip`` and ``*.ZIP`` below ``folder``."""
    return prepare(spark).read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{zip,ZIP}").load(folder)


def _open(content: bytes | None) -> zipfile.ZipFile | None:
    try:
        return zipfile.ZipFile(io.BytesIO(content or b""))
    except (zipfile.BadZipFile, OSError, ValueError):
        return None


def _kind(name: str) -> str:
    low = name.lower()
    return "xml" if low.endswith(".xml") else "tiff" if low.endswith((".tif", ".tiff")) else "rejected" if low.endswith(REJECTED) else "other"


def is_bundle(members: Column) -> Column:
    """Exactly one XML, no chemistry member. ``members``: array of names; NULL (a broken archive) is no bundle."""
    low = F.transform(members, F.lower)
    ok = (F.size(F.filter(low, lambda n: n.endswith(".xml"))) == 1) & ~F.exists(low, lambda n: n.endswith(".cdx") | n.endswith(".mol"))
    return F.coalesce(ok, F.lit(False))


def members(bundles: DataFrame) -> DataFrame:
    """path, doc_id, names: the member names of each archive, NULL for one that can't be read."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = [z.namelist() if (z := _open(c)) else None for c in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names, pa.list_(pa.string()))], names=["path", "names"])

    return bundles.select("path", "content").mapInArrow(run, "path string, names array<string>").select("path", document_key(stem(F.col("path"))).alias("doc_id"), "names")


def extract(bundles: DataFrame) -> DataFrame:
    """path, doc_id, kind (xml, tiff), name (base name), content: the members of valid bundles as rows.

    Member bytes stay in columns: tasks write no files. Bundles without a TIFF, with two XMLs, with
    chemistry members or that can't be read give no rows. Base names that occur twice stay twice.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                z = _open(content)
                kinds = [(_kind(n), n) for n in z.namelist()] if z else []
                if sum(k == "xml" for k, _ in kinds) != 1 or not any(k == "tiff" for k, _ in kinds) or any(k == "rejected" for k, _ in kinds):
                    continue
                try:
                    rows = [{"kind": k, "name": n.rsplit("/", 1)[-1], "content": z.read(n)} for k, n in kinds if k in ("xml", "tiff")]
                except (zipfile.BadZipFile, OSError, RuntimeError, NotImplementedError):
                    continue
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([rows], pa.list_(_FILE))], names=["path", "files"])

    rows = bundles.select("path", "content").mapInArrow(run, "path string, files array<struct<kind:string,name:string,content:binary>>")
    return rows.select("path", document_key(stem(F.col("path"))).alias("doc_id"), F.inline("files"))


def index_bundles(bundles: DataFrame, known: DataFrame | None = None, force: bool = False, work: str = "data/work/extracted") -> DataFrame:
    """doc_id, xml, tiffs of new bundles (all with ``force``), one row per document.

    A document in several archives: the smallest path wins, with ``force`` the largest, so the
    result doesn't depend on listing order. ``known``: a table with the doc_id already indexed.
    """
    todo = bundles.withColumn("_id", document_key(stem(F.col("path"))))
    if known is not None and not force:
        todo = todo.join(known.select(F.col("doc_id").alias("_id")).distinct(), "_id", "left_anti")
    files = extract(todo.select("path", "content")).drop("content")
    at = F.concat(F.lit(work + "/"), F.col("doc_id"), F.lit("/"), F.col("name"))
    one = files.groupBy("path", "doc_id").agg(
        F.max(F.when(F.col("kind") == "xml", at)).alias("xml"), F.array_sort(F.collect_list(F.when(F.col("kind") == "tiff", at))).alias("tiffs")
    )
    pick = F.max_by if force else F.min_by
    return one.groupBy("doc_id").agg(pick(F.struct("xml", "tiffs"), "path").alias("d")).select("doc_id", "d.xml", "d.tiffs")
