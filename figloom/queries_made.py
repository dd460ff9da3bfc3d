"""Queries of sources, sinks, store and pages, over bundles, images and stores made from the test tables."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from figloom.functions import images as I, phrases as P, text as X
from figloom.functions.names import canonical_path, document_key
from figloom.operators import metadata, store
from figloom.plans import pipeline
from figloom.shared import new_path, written
from figloom.sources import bundles as B, pages, sinks
from figloom.sources.tables import table

QUERIES: dict = {}
#: Documents whose key's hash is below this are indexed first, the others by the incremental run.
FIRST = "8"
#: Rows before this time are a store's first batch.
BATCH = "2023-01-01"
#: Made pages are that much smaller than the figures' boxes.
SHRUNK = 50


def query(f):
    QUERIES[f.__name__] = f
    return f


# bundles


def _members(spark: SparkSession, d: str) -> DataFrame:
    """doc_key, name, content: each document's last body and the last writes of the pages in its folder."""
    folder = F.regexp_extract("path", "([^/]+)/[^/]+$", 1)
    name = F.regexp_extract("path", "([^/]+)$", 1)
    xml = store.latest(table(spark, d, "xml_files"), ["xml_path"], [F.col("extracted_at")]).select(canonical_path(F.col("xml_path")).alias("path"), F.encode(F.coalesce("body", F.lit("")), "utf-8").alias("content"))
    files = table(spark, d, "page_files").where("kind = 'tiff'").select(canonical_path(F.col("path")).alias("path"), "written_at", "file_id", "payload").where("path IS NOT NULL")
    tiffs = files.groupBy("path").agg(F.max_by("payload", F.struct("written_at", "file_id")).alias("content"))
    every = xml.unionByName(tiffs.select("path", F.coalesce("content", F.lit(b"")).alias("content")))
    return every.select(document_key(folder).alias("doc_key"), name.alias("name"), "content").where(F.lower(name).rlike(r"\.(xml|tiff?)$"))


def _raw(spark: SparkSession, d: str) -> str:
    """A folder with a ZIP per document that has a body; a group is one document's members."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, made = [], []
            for key, members in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                out = io.BytesIO()
                with zipfile.ZipFile(out, "w") as z:
                    for m in members:
                        z.writestr(zipfile.ZipInfo(f"{key}/{m['name']}"), m["content"])
                names.append(f"{key}.zip")
                made.append(out.getvalue())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(made, pa.binary())], names=["name", "content"])

    grouped = _members(spark, d).groupBy("doc_key").agg(F.sort_array(F.collect_list(F.struct("name", "content"))).alias("m")).where(F.exists("m", lambda m: F.lower(m["name"]).endswith(".xml")))
    folder = new_path(spark, "raw")
    sinks.export_files(grouped.mapInArrow(run, "name string, content binary"), "name", "content", folder.removeprefix("file://"))
    return folder


@query
def bundle_scan(spark, d):
    return B.scan_bundles(spark, _raw(spark, d)).select(document_key(F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1)).alias("doc_key"))


@query
def bundle_members(spark, d):
    """Members of each archive and whether it is a bundle."""
    found = B.members(B.scan_bundles(spark, _raw(spark, d)))
    of = lambda rx: F.size(F.filter("names", lambda n: F.lower(n).rlike(rx))).alias("n")
    return found.select("doc_id", of(r"\.xml$").alias("n_xml"), of(r"\.tiff?$").alias("n_tiffs"), B.is_bundle(F.col("names")).alias("is_bundle"))


@query
def bundle_extract(spark, d):
    """The members of valid bundles, with the hash of their bytes."""
    return B.extract(B.scan_bundles(spark, _raw(spark, d))).select("doc_id", "kind", "name", F.md5("content").alias("hash"))


@query
def bundle_index(spark, d):
    """docs as a first run fills them."""
    return B.index_bundles(B.scan_bundles(spark, _raw(spark, d))).select("doc_id", "xml", F.array_join("tiffs", "|").alias("tiffs"))


@query
def bundle_incremental(spark, d):
    """What a run adds when about half of the documents are indexed already."""
    scanned = B.scan_bundles(spark, _raw(spark, d))
    known = B.index_bundles(scanned).where(F.md5("doc_id") < FIRST)
    return B.index_bundles(scanned, written(known, "known")).select("doc_id", F.size("tiffs").alias("n_tiffs"))


# store


def _filled(spark: SparkSession, d: str) -> store.Store:
    """A store that got docs and figures in two batches, and the sections twice."""
    s = store.Store(spark, new_path(spark, "store"))
    s.create()
    for name, at in (("docs", "indexed_at"), ("figures", "recorded_at")):
        rows = table(spark, d, name)
        late = F.coalesce(F.col(at) >= F.lit(BATCH).cast("timestamp"), F.lit(True))
        for part in (rows.where(~late), rows.where(late)):
            s.upsert(name, part)
    for _ in range(2):
        s.upsert("text_fts", table(spark, d, "text_fts"))
    s.create()
    return s


@query
def store_integrity(spark, d):
    """Rows and orphans per table after the upserts."""
    return _filled(spark, d).integrity()


@query
def store_figures(spark, d):
    """The figures that the store holds after both batches."""
    return _filled(spark, d).read("figures")


@query
def store_deleted(spark, d):
    """Rows and orphans after removed documents were deleted with all that hangs on them, and the tables compacted."""
    s = _filled(spark, d)
    s.delete_documents(table(spark, d, "docs").where("removed_at IS NOT NULL AND doc_id IS NOT NULL").select("doc_id"))
    s.vacuum()
    return s.integrity()


@query
def store_cleared(spark, d):
    s = _filled(spark, d)
    s.clear()
    s.create()
    return s.counts()


# sinks and paths


@query
def json_rows(spark, d):
    """train written as JSON lines and read again."""
    out = new_path(spark, "rows")
    sinks.write_rows(table(spark, d, "train").select("id", "image_path", "control_path", "prompt", "source_xml", "doc_id", "sha256", "bbox", "bbox_initial", "original_size", "resize_meta", "fig_label", "tiff_source", "label_in_xml"), out)
    back = sinks.read_rows(spark, out)
    return back.select("id", "image_path", "control_path", "prompt", "source_xml", "doc_id", "sha256", F.array_join(F.transform("bbox", lambda x: x.cast("string")), ",").alias("bbox"), F.round("resize_meta.scale", 9).alias("scale"), "fig_label", "label_in_xml")


@query
def resolved_paths(spark, d):
    """train.image_path below the first of two folders in which page_files has it."""
    rows = table(spark, d, "train").where("image_path IS NOT NULL").select("image_path").distinct()
    there = table(spark, d, "page_files").where("kind = 'image'").select(canonical_path(F.col("path")).alias("path"))
    return sinks.resolve_paths(rows, "image_path", ["/srv/elsewhere", "/srv/drawings"], there).select("image_path", "resolved")


# pages


def _pages(spark: SparkSession, d: str) -> DataFrame:
    """page_id, content: a TIFF per figure with a box, its size a part of the box's, ink in the upper left quarter."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = []
            for w, h in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                page = np.full((h, w), 255, np.uint8)
                page[: h // 2, : w // 2] = 20
                made.append(I.write_tiff(page))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made, pa.binary())], names=["page_id", "content"])

    sized = store.latest(table(spark, d, "figures"), ["id"], [F.col("recorded_at")]).where("id IS NOT NULL AND bbox_x2 IS NOT NULL AND bbox_y2 IS NOT NULL")
    return sized.select(F.col("id").alias("page_id"), (F.greatest("bbox_x2", F.lit(0)) / SHRUNK).cast("int").alias("w"), (F.greatest("bbox_y2", F.lit(0)) / SHRUNK).cast("int").alias("h")).mapInArrow(run, "page_id string, content binary")


@query
def page_images(spark, d):
    """Pages through decoding, binarizing, the canvas and PNG: size, and ink on the canvas. Empty pages have NULLs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ink = [None if x is None else int((I.read_png(x) == 0).sum()) for x in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(3)), pa.array(ink, pa.int32())], names=["page_id", "width", "height", "n_ink"])

    seen = pages.process_pages(_pages(spark, d), canvas=128)
    return seen.select("page_id", "width", "height", "png").mapInArrow(run, "page_id string, width int, height int, n_ink int")


@query
def page_export(spark, d):
    """Files of a page-by-page export; the words of each page come from a table."""
    seen = pages.process_pages(_pages(spark, d), canvas=128, deskew=True)
    newest = store.latest(table(spark, d, "figures"), ["id"], [F.col("recorded_at")])
    number = newest.select(F.col("id").alias("page_id"), X.label_number(F.col("fig_label")).alias("num")).where("num IS NOT NULL")
    word = lambda i, text: F.struct(F.lit(i).alias("no"), text.alias("text"), F.lit(10 + 40 * i).alias("x"), F.lit(5).alias("y"), F.lit(35).alias("w"), F.lit(12).alias("h"))
    words = number.select("page_id", F.inline(F.array(word(0, F.lit("Fig.")), word(1, F.col("num")), word(2, F.lit(" ")), word(3, F.lit("lid")))))
    return pages.exported(pages.with_words(seen, words)).select("page_id", "name", F.length("png").alias("n")).select("page_id", "name", (F.col("n") > 0).alias("written"))


@query
def page_labels(spark, d):
    """Labels found in the words of a page, two words per figure on a line of its own: which pages are kept, and their label."""
    f = table(spark, d, "figures").where("tiff_path IS NOT NULL").select("tiff_path", X.label_number(F.col("fig_label")).alias("num")).distinct()
    listed = f.groupBy("tiff_path").agg(F.sort_array(F.collect_set("num")).alias("nums"))
    at = lambda text, x, y: F.struct(text.alias("text"), F.lit(x).alias("x"), y.alias("y"), F.lit(40).alias("w"), F.lit(20).alias("h"), F.lit(x + 20).alias("cx"), (y + 10).alias("cy"))
    words = F.flatten(F.transform("nums", lambda n, i: F.array(at(F.lit("FIG."), 100, (i * 200).cast("int")), at(n, 160, (i * 200).cast("int")), at(F.lit("pump"), 400, (i * 200).cast("int")))))
    found = listed.select("tiff_path", pages.single_figure(P.labels_of_page(words)).alias("f"))
    return found.select("tiff_path", F.col("f.kept").alias("kept"), F.col("f.label").alias("label"))


@query
def dataset_rows(spark, d):
    """Dataset rows: figures whose number the XML of their document names."""
    files = store.latest(table(spark, d, "xml_files"), ["xml_path"], [F.col("extracted_at")])
    key = document_key(F.regexp_extract("xml_path", "([^/]+)/[^/]+$", 1))
    meta = metadata.with_metadata(files, "xml_path", "body").withColumn("doc_id", key).withColumnRenamed("xml_path", "source_xml")
    figures = store.latest(table(spark, d, "figures"), ["id"], [F.col("recorded_at")]).where("tiff_path IS NOT NULL")
    sized = figures.select(document_key(F.col("doc_id")).alias("doc_id"), "tiff_path", "fig_label", (F.col("bbox_x2") - F.col("bbox_x1")).alias("width"), (F.col("bbox_y2") - F.col("bbox_y1")).alias("height"), F.lit(None).cast("string").alias("sha256"))
    rows = pipeline.figure_rows(sized, meta)
    return rows.select("id", "image_path", "control_path", "source_xml", "doc_id", "fig_label", "tiff_source", "label_in_xml")
