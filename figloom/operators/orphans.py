"""Problem 4: references to records that are missing, deleted, or arrive later.

A reference is checked against the moment its row was recorded. Orphans found that way are
direct; records that hang on an orphan inherit the state, step by step, until a step finds
nothing new (``cascade``).
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from figloom.functions.names import canonical_path, document_key
from figloom.shared import drop, written
from figloom.sources.tables import table


@dataclass(frozen=True)
class Reference:
    """``rows``: ref_key, key, at of every row whose reference isn't NULL; ``targets``: key, live_from, live_to.

    A ``key`` that is NULL on either side matches nothing. A target without ``live_from`` is never
    live; one without ``live_to`` stays. A row without ``at`` sees no live target: it is an orphan.
    """

    ref_table: str
    ref_field: str
    rows: DataFrame
    targets: DataFrame


def _judged(ref: Reference) -> DataFrame:
    """The rows with ``why``: NULL if a live target exists, else missing, late or removed.

    Targets are reduced to one row per key before the join (map-side combining: a hot key is
    one row), which settles all rows but those that only a target removed later can save. These
    meet the distinct closed intervals in an anti-join, which keeps nothing per key.
    """
    targets = ref.targets.where("key IS NOT NULL AND live_from IS NOT NULL")
    span = targets.groupBy("key").agg(
        F.min("live_from").alias("first_from"),
        F.min(F.when(F.col("live_to").isNull(), F.col("live_from"))).alias("open_from"),
        F.max("live_to").alias("last_to"),
    )
    met = ref.rows.join(span, "key", "left")
    safe = F.coalesce(F.col("open_from") <= F.col("at"), F.lit(False))
    unsure = ~safe & F.coalesce((F.col("first_from") <= F.col("at")) & (F.col("at") < F.col("last_to")), F.lit(False))
    closed = targets.where("live_to IS NOT NULL AND live_from < live_to").select(F.col("key").alias("k"), "live_from", "live_to").distinct()
    lost = met.where(unsure).join(closed, (F.col("key") == F.col("k")) & (F.col("live_from") <= F.col("at")) & (F.col("at") < F.col("live_to")), "left_anti")
    sure = met.where(~safe & ~unsure).unionByName(lost)
    why = F.when(F.col("first_from").isNull(), "missing").when(F.coalesce(F.col("first_from") > F.col("at"), F.lit(False)), "late").otherwise("removed")
    return sure.select(F.lit(ref.ref_table).alias("ref_table"), F.lit(ref.ref_field).alias("ref_field"), "ref_key", "at", why.alias("why"))


def direct_orphans(references: Iterable[Reference]) -> DataFrame:
    """ref_table, ref_field, ref_key, at, why of every row (repeats included) whose target wasn't live."""
    return reduce(DataFrame.unionByName, map(_judged, references))


def report(references: Iterable[Reference], orphans: DataFrame) -> DataFrame:
    """Per table, field and month of ``at`` (NULL: rows without a time): references, and the direct ones of ``orphans`` (see ``cascade``) by kind."""
    month = F.date_format("at", "yyyy-MM").alias("month")
    every = reduce(DataFrame.unionByName, (r.rows.select(F.lit(r.ref_table).alias("ref_table"), F.lit(r.ref_field).alias("ref_field"), month) for r in references))
    seen = every.groupBy("ref_table", "ref_field", "month").agg(F.count(F.lit(1)).alias("n_refs"))
    lost = orphans.where("step = 0").groupBy(F.col("tab").alias("ref_table"), "ref_field", "month").agg(
        F.sum("n_rows").alias("n"), *[F.coalesce(F.sum(F.when(F.col("why") == w, F.col("n_rows"))), F.lit(0)).alias(f"n_{w}") for w in ("missing", "late", "removed")]
    )
    same = [seen[c].eqNullSafe(lost[c]) for c in ("ref_table", "ref_field", "month")]
    zero = [F.coalesce(lost[c], F.lit(0)).alias(a) for c, a in (("n", "n_orphans"), ("n_missing", "n_missing"), ("n_late", "n_late"), ("n_removed", "n_removed"))]
    return seen.join(lost, same, "left").select(seen.ref_table, seen.ref_field, seen.month, "n_refs", *zero)


def drawing_references(spark: SparkSession, folder: str) -> list[Reference]:
    """figures.doc_id, figures.tiff_path and train.image_path at the rows' ``recorded_at``."""
    docs, figures = table(spark, folder, "docs"), table(spark, folder, "figures")
    train, files = table(spark, folder, "train"), table(spark, folder, "page_files")
    live = [F.col("indexed_at").alias("live_from"), F.col("removed_at").alias("live_to")]
    doc = document_key(F.col("doc_id"))
    page = F.concat(doc, F.lit("|"), canonical_path(F.col("tiff_path")))
    return [
        Reference("figures", "doc_id", figures.where("doc_id IS NOT NULL").select(F.col("id").alias("ref_key"), doc.alias("key"), F.col("recorded_at").alias("at")), docs.select(doc.alias("key"), *live)),
        Reference(
            "figures", "tiff_path",
            figures.where("tiff_path IS NOT NULL").select(F.col("id").alias("ref_key"), page.alias("key"), F.col("recorded_at").alias("at")),
            docs.select("doc_id", F.explode("tiffs").alias("tiff_path"), *live).select(page.alias("key"), "live_from", "live_to"),
        ),
        Reference(
            "train", "image_path",
            train.where("image_path IS NOT NULL").select(F.col("id").alias("ref_key"), canonical_path(F.col("image_path")).alias("key"), F.col("recorded_at").alias("at")),
            files.where("kind = 'image'").select(canonical_path(F.col("path")).alias("key"), F.col("written_at").alias("live_from"), F.col("removed_at").alias("live_to")),
        ),
    ]


@dataclass(frozen=True)
class Graph:
    """``direct``: tab, key, ref_field, ref_key, month, why, n_rows of direct orphans; ``links``: tab, key, ref_field, month, parent_tab, parent_key. Keys are strings."""

    direct: DataFrame
    links: DataFrame


def _grouped(found: DataFrame, key: Column) -> DataFrame:
    return found.groupBy(F.col("ref_table").alias("tab"), key.alias("key"), "ref_field", "ref_key", F.date_format("at", "yyyy-MM").alias("month"), "why").agg(F.count(F.lit(1)).alias("n_rows"))


def drawing_graph(spark: SparkSession, folder: str) -> Graph:
    """xml_files <- docs <- figures <- train, and docs <- train, docs <- text_fts.

    Documents are known by their key, figures and train rows by the key of their id, sections by
    ``document:section``. A record is an orphan if any of its rows is. Rows without a key or
    without a reference are no link; a direct orphan without a key is one that nothing hangs on.
    """
    docs, figures, train = (table(spark, folder, t) for t in ("docs", "figures", "train"))
    doc, own = document_key(F.col("doc_id")), document_key(F.col("id"))
    files = Reference(
        "docs", "xml",
        docs.where("xml IS NOT NULL").select(doc.alias("ref_key"), canonical_path(F.col("xml")).alias("key"), F.col("indexed_at").alias("at")),
        table(spark, folder, "xml_files").select(canonical_path(F.col("xml_path")).alias("key"), F.col("extracted_at").alias("live_from"), F.lit(None).cast("timestamp").alias("live_to")),
    )
    found = _grouped(direct_orphans([files]), F.col("ref_key")).unionByName(_grouped(direct_orphans(drawing_references(spark, folder)), document_key(F.col("ref_key"))))

    def link(rows: DataFrame, tab: str, key: Column, field: str, at: Column, parent: str, parent_key: Column) -> DataFrame:
        return rows.select(F.lit(tab).alias("tab"), key.alias("key"), F.lit(field).alias("ref_field"), F.date_format(at, "yyyy-MM").alias("month"), F.lit(parent).alias("parent_tab"), parent_key.alias("parent_key"))

    at = F.col("recorded_at")
    links = [
        link(figures, "figures", own, "doc_id", at, "docs", doc),
        link(train, "train", own, "doc_id", at, "docs", doc),
        link(train, "train", own, "id", at, "figures", own),
        link(table(spark, folder, "text_fts"), "text_fts", F.concat_ws(":", doc, "section"), "doc_id", F.lit(None).cast("timestamp"), "docs", doc),
    ]
    every = reduce(DataFrame.unionByName, links).where("key IS NOT NULL AND parent_key IS NOT NULL").distinct()
    return Graph(found, every)


def cascade(graph: Graph) -> DataFrame:
    """tab, key, ref_field, ref_key, month, why, n_rows, step of every orphan: step 0 is direct, step n hangs on an orphan of step n-1.

    Each step is a semi-join of the links with the newest orphans and an anti-join with all
    known ones; it ends at the first empty step, at the latest after the longest path. Cycles
    end too, since nothing is found twice. Each step is a written table. An inherited orphan has a
    row per field and month of its links, ``why`` inherited and no ref_key.
    """
    links = written(graph.links, "links")
    first = written(graph.direct.withColumn("step", F.lit(0)), "orphans")
    newest = first.where("key IS NOT NULL").select("tab", "key").distinct()
    rows, known, step = first, newest, 0
    while not newest.isEmpty():
        step += 1
        parents = newest.select(F.col("tab").alias("parent_tab"), F.col("key").alias("parent_key"))
        children = links.join(parents, ["parent_tab", "parent_key"], "left_semi").join(known, ["tab", "key"], "left_anti")
        found = children.groupBy("tab", "key", "ref_field", "month").agg(F.count(F.lit(1)).alias("n_rows"))
        found = written(found.select("tab", "key", "ref_field", F.lit(None).cast("string").alias("ref_key"), "month", F.lit("inherited").alias("why"), "n_rows", F.lit(step).alias("step")), "orphans")
        newest = found.select("tab", "key").distinct()
        rows, known = rows.unionByName(found), known.unionByName(newest)
    drop(links)
    return rows


def cascade_report(orphans: DataFrame) -> DataFrame:
    """Per table, month and step: distinct orphans (a direct one without a key counts by its ref_key)."""
    one = F.coalesce(F.col("key"), F.concat(F.lit("?"), "ref_key"))
    return orphans.groupBy("tab", "month", "step").agg(F.count_distinct(one).alias("n_records")).select(
        "tab", "month", "step", F.when(F.col("step") == 0, "direct").otherwise("inherited").alias("orphan_kind"), "n_records"
    )
