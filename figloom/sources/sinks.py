"""Where results go: JSON lines, image files, captions beside images."""

from __future__ import annotations

import hashlib
import os
import shutil
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from figloom.shared import written

ROW = """id string, image_path string, control_path string, prompt string, source_xml string, doc_id string, sha256 string, bbox array<int>,
bbox_initial array<int>, original_size array<int>, resize_meta struct<orig_width:int,orig_height:int,resized_width:int,resized_height:int,
offset_x:int,offset_y:int,scale:double,canvas_size:int>, fig_label string, tiff_source string, label_in_xml boolean"""


def write_rows(rows: DataFrame, path: str) -> None:
    """JSON lines, replaced as a whole, UTF-8, NULL fields kept."""
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_rows(spark: SparkSession, path: str, schema: str | StructType = ROW) -> DataFrame:
    return spark.read.schema(schema).json(path)


def resolve_paths(rows: DataFrame, path: str, bases: Sequence[str], there: DataFrame, out: str = "resolved") -> DataFrame:
    """``rows`` with ``out``: an absolute path as it is, else below the first base where ``there`` (path) has it, else below the first base.

    ``there`` are absolute paths; no disk is touched. Every base is an option of a row, and the options are
    joined with the paths there are, so neither side is collected. A NULL path stays NULL.
    """
    options = F.array(*[F.struct(F.lit(i).alias("_i"), F.concat(F.lit(b.rstrip("/") + "/"), F.col("_asked")).alias("_option")) for i, b in enumerate(bases)])
    asked = rows.select(F.col(path).alias("_asked")).where(F.col("_asked").isNotNull() & ~F.col("_asked").startswith("/")).distinct()
    listed = asked.select("_asked", F.inline(options))
    known = listed.join(there.select(F.col("path").alias("_option")).distinct(), "_option", "left_semi").groupBy("_asked").agg(F.min_by("_option", "_i").alias("_found"))
    met = rows.join(known, F.col(path) == F.col("_asked"), "left")
    return met.withColumn(out, F.when(F.col(path).startswith("/"), F.col(path)).otherwise(F.coalesce("_found", F.concat(F.lit(bases[0].rstrip("/") + "/"), F.col(path))))).drop("_asked", "_found")


def caption_pairs(rows: DataFrame) -> DataFrame:
    """image_path, caption_path, caption of the rows with both; the caption's file has the image's stem. Repeated rows count once."""
    kept = rows.where("trim(image_path) != '' AND trim(prompt) != ''")
    name = F.regexp_extract("image_path", r"([^/]*)$", 1)
    return kept.select("image_path", F.concat(F.regexp_replace(name, r"(?<=.)\.[^.]*$", ""), F.lit(".txt")).alias("caption_path"), F.col("prompt").alias("caption")).distinct()


def export_captions(pairs: DataFrame, bases: Sequence[str], out: str) -> DataFrame:
    """Copies each image that exists below ``bases`` to ``out`` and writes its caption beside it. One row: written, missing.

    Runs on the executors; ``out`` must be a folder that all of them see. Lists the first five missing paths. Images of
    one name in several folders get a hash of their path before it. A file takes its name when it is
    whole, so a task that runs twice does no harm.
    """

    def run(batches):
        import pandas as pd

        os.makedirs(out, exist_ok=True)
        for frame in batches:
            rows = []
            for image, caption_path, caption, twice in zip(frame["image_path"], frame["caption_path"], frame["caption"], frame["twice"]):
                options = [image] if os.path.isabs(image) else [os.path.join(b, image) for b in bases]
                found = next((o for o in options if os.path.exists(o)), None)
                if found:
                    name, stem = os.path.basename(found), caption_path
                    if twice:  # another image has the same name
                        own = hashlib.md5(image.encode()).hexdigest()[:8]
                        name, stem = f"{own}_{name}", f"{own}_{stem}"
                    part = os.path.join(out, f".{uuid.uuid4().hex}")
                    shutil.copyfile(found, part)
                    os.replace(part, os.path.join(out, name))
                    with open(part, "w", encoding="utf-8") as f:
                        f.write(caption)
                    os.replace(part, os.path.join(out, stem))
                rows.append((image, found is not None))
            yield pd.DataFrame(rows, columns=["image_path", "ok"])

    several = pairs.groupBy("caption_path").agg((F.min("image_path") != F.max("image_path")).alias("twice"))
    done = written(pairs.join(several, "caption_path").select("image_path", "caption_path", "caption", "twice").mapInPandas(run, "image_path string, ok boolean"), "exported")
    first = done.where("NOT ok").select("image_path").distinct().orderBy("image_path").limit(5).agg(F.array_sort(F.collect_list("image_path")).alias("first_missing"))
    return done.agg(F.count_if("ok").alias("written"), F.count_if(~F.col("ok")).alias("missing")).crossJoin(first)  # a row each


def export_files(rows: DataFrame, name: str, content: str, out: str) -> int:
    """Writes the bytes of column ``content`` as files ``out/name``, on the executors; returns how many."""

    def run(batches):
        import pandas as pd

        os.makedirs(out, exist_ok=True)
        for frame in batches:
            for file, data in zip(frame[name], frame[content]):
                with open(os.path.join(out, os.path.basename(file)), "wb") as f:
                    f.write(data)
            yield pd.DataFrame({"n": [len(frame)]})

    return int(rows.where(F.col(content).isNotNull() & F.col(name).isNotNull()).select(name, content).mapInPandas(run, "n long").agg(F.sum("n")).first()[0] or 0)


def tab_lines(df: DataFrame) -> DataFrame:
    """Rows as one column of tab-separated text, NULL as nothing."""
    return df.select(F.array_join(F.array(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns]), "\t").alias("line"))
