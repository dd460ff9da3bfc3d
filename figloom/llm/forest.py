"""Problem 2: splits that keep related records together.

``spanning_forest`` contracts a graph in Borůvka's manner: every component takes its lightest edge,
the chains of these are folded onto one root, the other edges move to the roots. Weights are
hashes of the edges, hence distinct, so the chosen edges form trees. All tables are written to the
shared folder, the forest too; no link and no component reaches the driver. ``deal`` gives the roots to splits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from figloom.functions.names import document_key, family_key
from figloom.operators.running import running_total
from figloom.shared import drop, written
from figloom.sources.tables import table

#: Link kinds that make documents related.
KINDS = ("continuation", "division", "priority", "reissue")


def spanning_forest(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes: node, root; forest: a, b) of the undirected ``edges`` (a, b, of one type).

    Self-links, NULL ends, repeats and both directions of a link do no harm; a node of which every
    edge is a self-link isn't in the result. Minima and duplicate removal combine on the map side,
    so a node with a third of all edges is no hot task; its row of the parent table meets its edges
    in a join that AQE splits. Rounds: at most log2 of the longest chain of components.
    """
    a, b = F.least("a", "b"), F.greatest("a", "b")
    graph = edges.where("a IS NOT NULL AND b IS NOT NULL AND a != b").select(a.alias("a"), b.alias("b")).distinct()
    live = written(graph.select(F.col("a").alias("u"), F.col("b").alias("v"), F.xxhash64("a", "b").alias("w"), "a", "b"), "edges")
    nodes = live.select(F.col("u").alias("node")).unionAll(live.select("v")).distinct().withColumn("root", F.col("node"))
    chosen: list[DataFrame] = []
    while not live.isEmpty():
        both = live.unionAll(live.select(F.col("v").alias("u"), F.col("u").alias("v"), "w", "a", "b"))
        best = written(both.groupBy("u").agg(F.min(F.struct("w", "a", "b", "v")).alias("m")).select("u", "m.v", "m.w", "m.a", "m.b"), "best")
        chosen.append(best.select("a", "b"))
        other = best.select(F.col("u").alias("v"), F.col("v").alias("back"))
        mutual = (F.col("back") == F.col("u")) & (F.col("u") < F.col("v"))
        parent = written(best.join(other, "v").select("u", F.when(mutual, F.col("u")).otherwise(F.col("v")).alias("p")), "parents")
        while True:
            up = parent.select(F.col("u").alias("p"), F.col("p").alias("g"))
            jumped = written(parent.join(up, "p").select("u", F.col("g").alias("p"), (F.col("g") != F.col("p")).alias("moved")), "parents")
            drop(parent)
            parent, moved = jumped.drop("moved"), jumped.where("moved")
            parent._figloom_path = jumped._figloom_path
            if moved.isEmpty():
                break
        new = parent.select(F.col("u").alias("root"), F.col("p"))
        nodes = written(nodes.join(new, "root", "left").select("node", F.coalesce("p", "root").alias("root")), "nodes")
        u, v = (parent.select(F.col("u").alias(c), F.col("p").alias(f"p{c}")) for c in "uv")
        moved = live.join(u, "u").join(v, "v").where("pu != pv").select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v"), "w", "a", "b")
        after = written(moved.groupBy("u", "v").agg(F.min(F.struct("w", "a", "b")).alias("m")).select("u", "v", "m.w", "m.a", "m.b"), "edges")
        drop(live)
        live = after
    forest = reduce(DataFrame.unionAll, chosen).distinct() if chosen else graph.select("a", "b").limit(0)
    return nodes, written(forest, "forest")


def related(docs: DataFrame, links: DataFrame) -> DataFrame:
    """Edges between documents (``D`` and key) and families (``F`` and number): a family is a node, so it needs no pairs.

    Ids without letters and digits and values that name no family give no edge.
    """
    doc, family = document_key(F.col("doc_id")), family_key(F.col("family_id"))
    of_family = docs.select(F.concat(F.lit("D"), doc).alias("a"), F.concat(F.lit("F"), family).alias("b")).where(F.length("a") > 1)
    of_link = links.where(F.col("link_kind").isin(*KINDS)).select(
        F.concat(F.lit("D"), document_key(F.col("doc_id"))).alias("a"), F.concat(F.lit("D"), document_key(F.col("related_doc_id"))).alias("b")
    )
    return of_family.unionAll(of_link.where((F.length("a") > 1) & (F.length("b") > 1))).where("b IS NOT NULL")


def document_groups(docs: DataFrame, links: DataFrame, more: DataFrame | None = None) -> DataFrame:
    """doc_id, doc_key, root of every distinct doc_id of ``docs`` (and of ``more``, a table with doc_id).

    A document without relatives is its own root. NULL ids are left out; so are ids without any letter or digit.
    """
    nodes, _ = spanning_forest(related(docs, links))
    ids = docs.select("doc_id", F.lit(True).alias("indexed"))
    ids = ids.unionAll(more.select("doc_id", F.lit(False))) if more is not None else ids
    ids = ids.groupBy("doc_id").agg(F.max("indexed").alias("indexed"), F.count(F.lit(1)).alias("n_rows"))
    ids = ids.withColumn("doc_key", document_key(F.col("doc_id"))).where(F.length("doc_key") > 0)
    found = nodes.where("node LIKE 'D%'").select(F.substring("node", 2, 1 << 30).alias("doc_key"), "root")
    return ids.join(found, "doc_key", "left").withColumn("root", F.coalesce("root", F.concat(F.lit("D"), "doc_key")))


def deal(groups: DataFrame, plan: DataFrame) -> DataFrame:
    """root, split for every group (root, n_rows), near the shares of ``plan`` (split, share).

    One rule for all sizes. Groups are stratified by size band (powers of two), the largest first. In a band they
    stand in hashed order, and the band's rows are cut into stretches in proportion to what each split still
    lacks, the one that lacks most first; a group goes where its first row falls. What a band gave too much or
    too little the next one makes good, so that in the end a split is off by a group of the smallest band,
    or by what the large groups left no room to mend. A job per band, at most 63. Shares are scaled to 1; NULL and
    negative ones count as 0.
    """
    shares = sorted((r.split, max(0.0, float(r.share or 0))) for r in plan.select("split", "share").collect())  # one row per split
    whole = sum(s for _, s in shares)
    if not whole:
        raise ValueError("the plan has no share above 0")
    band = F.floor(F.log2(F.greatest("n_rows", F.lit(1)))).cast("int")
    queued = running_total(groups.withColumn("band", band).withColumn("_turn", F.md5(F.col("root").cast("string"))), ["band"], ["_turn", "root"], "n_rows")
    queued = written(queued.select("root", "n_rows", "band", "before"), "queued")
    bands = {r.band: int(r.n or 0) for r in queued.groupBy("band").agg(F.sum("n_rows").alias("n")).collect()}  # a row per band
    total = sum(bands.values())
    lack = {split: share / whole * total for split, share in shares}
    choice = F
    for k in sorted(bands, reverse=True):
        wanted = sorted(((max(0.0, x), split) for split, x in lack.items()), key=lambda x: (-x[0], x[1]))
        room, upto, split = sum(x for x, _ in wanted) or 1.0, 0.0, F
        for x, name in wanted[:-1]:
            upto += x / room * bands[k]
            split = split.when(F.col("before") < F.lit(round(upto, 6)), name)
        split = split.otherwise(wanted[-1][1]) if len(wanted) > 1 else F.lit(wanted[-1][1])
        choice = choice.when(F.col("band") == k, split)
        for r in queued.where(F.col("band") == k).groupBy(split.alias("split")).agg(F.sum("n_rows").alias("n")).collect():  # a row per split
            lack[r.split] -= int(r.n or 0)
    return queued.select("root", (choice if bands else F.lit(None).cast("string")).alias("split"))


def p2_groups(spark: SparkSession, folder: str, with_train: bool = False) -> DataFrame:
    more = table(spark, folder, "train").select("doc_id") if with_train else None
    return document_groups(table(spark, folder, "docs"), table(spark, folder, "doc_links"), more)


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of docs whose group has two or more, with the group's smallest doc_id."""
    groups = p2_groups(spark, folder)
    size = groups.groupBy("root", "doc_key").agg(F.min("doc_id").alias("first")).groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.min("first").alias("group_doc_id"))
    return groups.join(size.where("n > 1"), "root").select("doc_id", "group_doc_id").distinct()


def p2_trees(spark: SparkSession, folder: str) -> DataFrame:
    """The persisted forest by group of documents: nodes (documents, families, also such as are in no docs row) and edges; a tree has one edge less than nodes."""
    docs = table(spark, folder, "docs")
    nodes, forest = spanning_forest(related(docs, table(spark, folder, "doc_links")))
    n_edges = forest.join(nodes.select(F.col("node").alias("a"), "root"), "a").groupBy("root").agg(F.count(F.lit(1)).alias("n_edges"))
    known = docs.select(F.concat(F.lit("D"), document_key(F.col("doc_id"))).alias("node"), "doc_id").distinct()
    sizes = nodes.join(known, "node", "left").groupBy("root").agg(F.count_distinct("node").alias("n_nodes"), F.min("doc_id").alias("first_doc_id"), F.min("node").alias("first_node"))
    return sizes.join(n_edges, "root").select("first_node", "first_doc_id", "n_nodes", "n_edges")


def p2_together(spark: SparkSession, folder: str) -> DataFrame:
    """Per group with a row of docs: its documents in docs, its rows of docs and train, and over how many splits these lie."""
    found = _split(spark, folder).where("group_doc_id IS NOT NULL")
    return found.groupBy("group_doc_id").agg(F.count_distinct(F.when(F.col("indexed"), F.col("doc_key"))).alias("n_docs"), F.sum("n_rows").alias("n_rows"), F.count_distinct("split").alias("n_splits"))


def _split(spark: SparkSession, folder: str) -> DataFrame:
    groups = p2_groups(spark, folder, with_train=True)
    named = groups.groupBy("root").agg(F.min("doc_key").alias("first_key"))  # a name that doesn't hang on the forest's hashes
    groups = written(groups.join(named, "root").drop("root").withColumnRenamed("first_key", "root"), "ids")
    size = groups.groupBy("root").agg(F.sum("n_rows").alias("n_rows"), F.min(F.when(F.col("indexed"), F.col("doc_id"))).alias("group_doc_id"))
    size = written(size, "sizes")
    return groups.join(size.drop("n_rows"), "root").join(deal(size.select("root", "n_rows"), table(spark, folder, "split_plan")), "root")


def p2_splits(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of docs with its group (smallest doc_id) and its split."""
    return _split(spark, folder).where("indexed").select("doc_id", "group_doc_id", "split")


def p2_train_splits(spark: SparkSession, folder: str) -> DataFrame:
    """Every row of train with a document id, and the split its document's group got."""
    own = _split(spark, folder).select("doc_id", "split")
    return table(spark, folder, "train").select("id", "doc_id").join(own, "doc_id")


def p2_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of docs and train per split, their share and the one wanted."""
    rows = _split(spark, folder).groupBy("split").agg(F.sum("n_rows").alias("n_rows"))
    plan = table(spark, folder, "split_plan").withColumnRenamed("share", "wanted").join(rows, "split", "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))
    total = F.sum("n_rows").over(Window.partitionBy(F.lit(1)))  # over the plan's few rows
    return plan.select("split", "n_rows", F.round(F.col("n_rows") / total, 4).alias("share"), "wanted")


QUERIES = {f.__name__: f for f in (p2_found, p2_trees, p2_together, p2_splits, p2_train_splits, p2_shares)}
