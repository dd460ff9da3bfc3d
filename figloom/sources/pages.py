"""Page images: decoding, OCR words through a pluggable reader, canvases and edge maps as columns."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from figloom.functions import images as I, text as X
from figloom.functions.names import stem
from figloom.functions.phrases import LABEL, WORD, labels_of_page
from figloom.session import prepare

#: Pages that go to Python at once; a page of 2048 x 2048 is 4 MiB.
BATCH_PAGES = 16


def read_images(spark: SparkSession, folder: str) -> DataFrame:
    """The engine's own image source; broken files are left out."""
    return prepare(spark).read.format("image").option("dropInvalid", "true").option("recursiveFileLookup", "true").load(folder)


def _decoded(data: bytes | None) -> np.ndarray | None:
    try:
        page = I.read_tiff(data or b"")
    except ValueError:
        return None
    return page if page.size else None


def process_pages(pages: DataFrame, canvas: int = 2048, deskew: bool = False, ocr: Callable[[np.ndarray], list[dict]] | None = None) -> DataFrame:
    """page_id, width, height, words, png, control of the pages (page_id string, content: a TIFF's bytes).

    ``png`` is the binarized page on its canvas, ``control`` its edge map. ``ocr`` gets the page dark
    on light and returns its words (text, x, y, w, h, cx, cy); blank words are dropped. A page that
    can't be decoded is kept with NULLs.
    """
    word = pa.struct([("text", pa.string()), *((c, pa.int32()) for c in ("x", "y", "w", "h", "cx", "cy"))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_PAGES):
                b = batch.slice(at, BATCH_PAGES)
                rows = []
                for data in b.column(1).to_pylist():
                    page = _decoded(data)
                    if page is None:
                        rows.append((None, None, None, None, None))
                        continue
                    flat = I.binarized(I.deskewed(page) if deskew else page)
                    words = [w for w in (ocr(I.dark_on_light(flat)) if ocr else []) if (w["text"] or "").strip()]
                    made = I.padded(flat, canvas)
                    rows.append((page.shape[1], page.shape[0], words, I.write_png(made), I.write_png(I.edges(made))))
                kinds = (pa.int32(), pa.int32(), pa.list_(word), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))], names=["page_id", "width", "height", "words", "png", "control"])

    return pages.select(F.col("page_id").cast("string").alias("page_id"), "content").mapInArrow(run, f"page_id string, width int, height int, words array<{WORD}>, png binary, control binary")


def single_figure(labels: Column) -> Column:
    """Of a page's labels: a struct (kept, label). No number: kept without label; one: kept; several: dropped."""
    numbers = F.array_sort(F.array_distinct(F.transform(labels, lambda x: x.num)))
    n = F.size(F.coalesce(numbers, F.array().cast("array<string>")))
    return F.struct((n <= 1).alias("kept"), F.when(n == 1, F.concat(F.lit("FIG. "), numbers[0])).alias("label"))


def with_words(pages: DataFrame, words: DataFrame) -> DataFrame:
    """``pages`` with the words of a table (page_id, no, text, x, y, w, h) in place of their own, in order of ``no``.

    Centres are whole pixels; blank words are dropped. A page without words gets the empty list.
    """
    one = F.struct("no", F.struct("text", "x", "y", "w", "h", (F.col("x") + F.col("w") / 2).cast("int").alias("cx"), (F.col("y") + F.col("h") / 2).cast("int").alias("cy")).alias("word"))
    told = words.where("trim(text) != ''").groupBy("page_id").agg(F.transform(F.sort_array(F.collect_list(one)), lambda x: x.word).alias("_words"))
    return pages.drop("words").join(told, "page_id", "left").withColumn("words", F.coalesce("_words", F.array().cast(f"array<{WORD}>"))).drop("_words")


def exported(pages: DataFrame) -> DataFrame:
    """page_id, name, png of the pages (``process_pages``) with one figure at most: the files that a page-by-page export writes.

    The name is the page's without its extension and the figure's label in upper case, dots dropped and blanks as
    ``_``; a page without a label has FIG_1. Pages of several figures and pages that can't be decoded have no file.
    """
    told = pages.where("png IS NOT NULL").withColumn("_f", single_figure(labels_of_page(F.col("words")))).where("_f.kept")
    label = F.replace(F.replace(F.upper(F.coalesce("_f.label", F.lit("FIG_1"))), F.lit("."), F.lit("")), F.lit(" "), F.lit("_"))
    return told.select("page_id", F.concat(stem(F.col("page_id")), F.lit("_"), label, F.lit(".png")).alias("name"), "png")


def labelled(pages: DataFrame, canvas: int = 2048) -> DataFrame:
    """Pages with ``words``, ``width`` and ``height`` as figures: fig_label, bbox, original_size, resize_meta; pages of several figures are dropped."""
    box = F.array(F.lit(0), F.lit(0), F.col("width"), F.col("height"))
    told = pages.where("width > 0 AND height > 0").withColumn("_f", single_figure(labels_of_page(F.col("words")))).where("_f.kept")
    return told.select("*", F.col("_f.label").alias("fig_label"), box.alias("bbox"), box.alias("bbox_initial"), F.array("width", "height").alias("original_size"), X.letterbox(F.col("width"), F.col("height"), canvas).alias("resize_meta")).drop("_f")


__all__ = ["LABEL", "WORD", "exported", "labelled", "process_pages", "read_images", "single_figure", "with_words"]
