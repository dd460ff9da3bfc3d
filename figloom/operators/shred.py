"""Problem 6: nested documents as flat tables, by columnar shredding.

``shred`` turns a body into columns, one per leaf path, each a sequence of (repetition level,
definition level, value) as in the record-shredding of columnar stores. Elements go by local
name. The repeated nodes and their levels:

    figure (1), paragraph (1), claim (1), claim-text within a claim (2, nested ones 3, 4, ...)

A repetition level says at which node the entry repeats (0: a new body), a definition level how
many of the path's nodes are there, plus 1 if the value is. The recursive claim-text has a column
per depth, written ``claim/claim-text^k``. The tables are rebuilt from the level sequences alone.

These five tables hold fixed leaves. ``leaves`` has every element and attribute of a body under the path it was met at.

NULL, empty and not well-formed bodies have ``error`` set and no columns.
"""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from figloom.functions.names import canonical_path
from figloom.shared import written
from figloom.sources.tables import table

PARAGRAPHS = ("p", "paragraph", "text")
CAPTIONS = ("figcaption", "caption", "p")
#: Leaves of the body itself: the name and where its text stands.
SINGLE = {"title": "invention-title", "country": "country", "doc_number": "doc-number", "kind": "kind"}
#: A batch of rows that goes to Python at once holds so many bodies at most.
BATCH_ROWS = 200

_LEVELS = pa.struct([("leaf", pa.string()), ("rep", pa.list_(pa.int32())), ("def", pa.list_(pa.int32())), ("value", pa.list_(pa.string()))])
_SCHEMA = "error string, columns array<struct<leaf:string,rep:array<int>,def:array<int>,value:array<string>>>"


def squeezed(parts: Sequence[str]) -> str:
    """Text nodes, each without outer blanks, blank ones dropped, joined by a space."""
    return " ".join(s for s in (p.strip() for p in parts) if s)


class _Walk:
    """Parser target. Lists the repeated nodes of a body in document order, as [level, values]."""

    def __init__(self, texts: bool):
        self.stack: list[str] = []
        self.claims: list[list] = []
        self.figures: list[list] = []
        self.paragraphs: list[list] = []
        self.single: dict[str, str] = {}
        self.open: list[tuple[int, list[str]]] = []  # texts being gathered, with the depth they end at
        self.nesting: list[int] = []  # 1 for an open claim, then the levels of its open claim-texts
        self.texts = texts
        self.in_figure = 0
        self.pending: list[str] = []  # pieces of the current text node: the parser cuts it at references
        if texts:
            self.data = self._data

    def _gather(self) -> list[str]:
        parts: list[str] = []
        self.open.append((len(self.stack), parts))
        return parts

    def start(self, tag: str, attrs: dict) -> None:
        self._flush()
        name = tag[tag.rfind("}") + 1 :]
        self.stack.append(name)
        if name == "claim":
            self.nesting.append(1)
            self.claims.append([1, attrs.get("id"), attrs.get("claim-type"), self._gather() if self.texts else ()])
        elif name == "claim-text" and self.nesting:
            self.nesting.append(self.nesting[-1] + 1)
            self.claims.append([self.nesting[-1], attrs.get("id"), None, self._gather() if self.texts else ()])
        if not self.texts:
            return
        if len(self.stack) == 1:
            self.single.update({k: attrs[k] for k in ("lang", "file") if k in attrs} | {"root": name})
        if name == "figure":
            self.in_figure = len(self.stack)
            self.figures.append([1, attrs.get("num"), None, None])
        elif name == "img" and self.in_figure and self.figures[-1][2] is None:
            self.figures[-1][2] = attrs.get("file")
        elif name in CAPTIONS and self.in_figure and self.figures[-1][3] is None:
            self.figures[-1][3] = self._gather()
        elif name in PARAGRAPHS and "description" in self.stack:
            self.paragraphs.append([1, attrs.get("id"), attrs.get("num"), self._gather()])
        for leaf, element in SINGLE.items():
            if name == element and leaf not in self.single and (leaf == "title" or "document-id" in self.stack):
                self.single[leaf] = self._gather()

    def end(self, tag: str) -> None:
        self._flush()
        name = self.stack[-1]
        if self.nesting and (name == "claim" or name == "claim-text"):
            self.nesting.pop()
        while self.open and self.open[-1][0] == len(self.stack):
            self.open.pop()
        if self.in_figure == len(self.stack):
            self.in_figure = 0
        self.stack.pop()

    def _data(self, text: str) -> None:
        self.pending.append(text)

    def _flush(self) -> None:
        if self.pending:
            node = "".join(self.pending)
            self.pending.clear()
            for _, parts in self.open:
                parts.append(node)

    def close(self) -> _Walk:
        return self


def _walk(body: str | None, texts: bool) -> _Walk | None:
    if not body:
        return None
    parser = ET.XMLParser(target=_Walk(texts))
    try:
        parser.feed(body)
        return parser.close()
    except (ET.ParseError, ValueError):
        return None


def levels(nodes: Iterable[tuple[int, object]], depth: int) -> tuple[list[int], list[int], list]:
    """The column of the values at level ``depth``, from all nodes as (level, value) in document order.

    Nodes deeper than ``depth`` are not on this path. A chain of nodes, each one level below
    the last, is one entry: it repeats where the chain starts and is defined to where it ends.
    """
    rep: list[int] = []
    defined: list[int] = []
    values: list = []
    last = 0
    for level, value in nodes:
        if level > depth:
            continue
        if rep and last and level == last + 1:
            defined[-1] = level
        else:
            rep.append(level if rep else 0)
            defined.append(level)
            values.append(None)
        if level == depth and value is not None:
            defined[-1] += 1
            values[-1] = value
        last = level
    return (rep, defined, values) if rep else ([0], [0], [None])


def nodes(rep: Sequence[int], defined: Sequence[int], depth: int) -> list[int]:
    """The levels of all nodes in document order, from the levels of the deepest path's column."""
    out: list[int] = []
    for r, d in zip(rep, defined):
        out.extend(range(max(r, 1), min(d, depth) + 1))
    return out


def shred_body(body: str | None, texts: bool = True) -> list[dict] | None:
    """The columns of one body; without ``texts`` only the claims' structure (no values)."""
    walk = _walk(body, texts)
    if walk is None:
        return None
    columns = []

    def add(leaf: str, entries: tuple[list[int], list[int], list]) -> None:
        columns.append(dict(zip(("leaf", "rep", "def", "value"), (leaf, *entries))))

    deepest = max((n[0] for n in walk.claims), default=1)
    for k in range(1, deepest):
        if texts or k == deepest - 1:
            add(f"claim/claim-text^{k}", levels(((n[0], squeezed(n[3]) if texts else None) for n in walk.claims), k + 1))
            if texts:
                add(f"claim/claim-text^{k}/@id", levels(((n[0], n[1]) for n in walk.claims), k + 1))
    if texts:
        for leaf, value in walk.single.items():
            add(leaf, ([0], [1], [value if isinstance(value, str) else squeezed(value)]))
        for leaf, i, of in (("claim/@id", 1, walk.claims), ("claim/@type", 2, walk.claims), ("figure/@num", 1, walk.figures), ("figure/img", 2, walk.figures), ("paragraph/@id", 1, walk.paragraphs), ("paragraph/@num", 2, walk.paragraphs)):
            add(leaf, levels(((n[0], n[i]) for n in of), 1))
        for leaf, of in (("claim", walk.claims), ("figure/caption", walk.figures), ("paragraph", walk.paragraphs)):
            add(leaf, levels(((n[0], None if n[3] is None else squeezed(n[3])) for n in of), 1))
    return columns


def _batched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(at, BATCH_ROWS)


def shred(df: DataFrame, key: str, body: str, texts: bool = False) -> DataFrame:
    """key, error, columns: one row per row of ``df``. ``texts``: with all leaves, else only the claims' levels."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _batched(batches):
            done = [shred_body(x, texts) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([None if d is not None else "not well-formed" for d in done], pa.string()), pa.array(done, pa.list_(_LEVELS))], names=[key, "error", "columns"]
            )

    return df.select(F.col(key).cast("string").alias(key), F.col(body).cast("string").alias(body)).mapInArrow(run, f"`{key}` string, {_SCHEMA}")


def claim_tree(columns: list[dict]) -> list[tuple[int, int, int, int, int]]:
    """(claim_no, node_no, parent_no, level, nth node of its level) of every claim-text, from the level sequences."""
    paths = {c["leaf"]: c for c in columns}
    deepest = max((int(leaf.rpartition("^")[2]) for leaf in paths if leaf.startswith("claim/claim-text^") and not leaf.endswith("@id")), default=0)
    if not deepest:
        return []
    column = paths[f"claim/claim-text^{deepest}"]
    out, last, seen, claim, node = [], {}, {}, 0, 0
    for level in nodes(column["rep"], column["def"], deepest + 1):
        if level == 1:
            claim, node, last = claim + 1, 0, {}
            continue
        node += 1
        last[level] = node
        seen[level] = seen.get(level, 0) + 1
        out.append((claim, node, last.get(level - 1, 0), level, seen[level]))
    return out


def claim_nodes(shredded: DataFrame, key: str = "xml_path") -> DataFrame:
    """key, claim_no, node_no, parent_no of every claim-text, from the output of ``shred``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, rows = [], []
            for k, columns in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                tree = claim_tree(columns)
                keys.extend([k] * len(tree))
                rows.extend(r[:3] for r in tree)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *(pa.array([r[i] for r in rows], pa.int32()) for i in range(3))], names=[key, "claim_no", "node_no", "parent_no"])

    return shredded.where("error IS NULL").select(key, "columns").mapInArrow(run, f"`{key}` string, claim_no int, node_no int, parent_no int")


#: Table -> its columns after xml_path.
TABLES = {
    "documents": "error string, root string, lang string, file string, title string, country string, doc_number string, kind string",
    "figures": "figure_no int, num string, img string, caption string",
    "paragraphs": "paragraph_no int, id string, num string, content string",
    "claims": "claim_no int, id string, claim_type string, content string",
    "claim_parts": "claim_no int, node_no int, parent_no int, id string, content string",
}


def _entries(column: dict | None, level: int) -> list[str | None]:
    """The values of the nodes at ``level``, one per node; a value is there if the entry is defined beyond it."""
    if column is None:
        return []
    return [v if d > level else None for d, v in zip(column["def"], column["value"]) if d >= level]


def assemble(columns: list[dict], name: str) -> list[tuple]:
    """The rows of one flat table of one body, from its columns."""
    paths = {c["leaf"]: c for c in columns}
    if name == "documents":
        return [(None, *((_entries(paths.get(leaf), 0) or [None])[0] for leaf in ("root", "lang", "file", *SINGLE)))]
    if name == "claim_parts":
        tree = claim_tree(columns)
        depth = {level for *_, level, _ in tree}
        ids = {level: _entries(paths.get(f"claim/claim-text^{level - 1}/@id"), level) for level in depth}
        texts = {level: _entries(paths.get(f"claim/claim-text^{level - 1}"), level) for level in depth}
        return [(c, n, p, ids[level][i - 1], texts[level][i - 1]) for c, n, p, level, i in tree]
    leaves = {"figures": ("figure/@num", "figure/img", "figure/caption"), "paragraphs": ("paragraph/@id", "paragraph/@num", "paragraph"), "claims": ("claim/@id", "claim/@type", "claim")}[name]
    return [(i, *row) for i, row in enumerate(zip(*(_entries(paths.get(leaf), 1) for leaf in leaves)), 1)]


def assembled(shredded: DataFrame, name: str, key: str = "xml_path") -> DataFrame:
    """One flat table of all bodies. The parent of a row is its body (key), of a claim part also claim_no and parent_no (0: the claim itself)."""
    kinds = [x.rsplit(" ", 1) for x in TABLES[name].split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, rows = [], []
            for k, error, columns in zip(*(b.column(i).to_pylist() for i in range(3))):
                new = assemble(columns, name) if columns is not None else [(error, *[None] * (len(kinds) - 1))] if name == "documents" else []
                keys.extend([k] * len(new))
                rows.extend(new)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), *(pa.array([r[i] for r in rows], pa.int32() if kind == "int" else pa.string()) for i, (_, kind) in enumerate(kinds))], names=[key, *(n for n, _ in kinds)]
            )

    return shredded.select(key, "error", "columns").mapInArrow(run, f"`{key}` string, {TABLES[name]}")


_LEAF = "element_no int, parent_no int, figure_no int, paragraph_no int, claim_no int, node_no int, path string, rep int, def int, value string"


class _Leaves(_Walk):
    """Lists every element, then its attributes, in document order, as rows of ``_LEAF``."""

    def __init__(self) -> None:
        super().__init__(texts=True)
        self.rows: list[list] = []
        self.elements: list[tuple[int, list[int | None], list[str]]] = []  # open ones: number, owners, own text nodes
        self.n_elements = self.claim_no = self.node_no = 0
        self.last: dict[str, list[int]] = {}  # of each path, the elements on it at its last entry

    def _entry(self, name: str, value: str | None) -> list:
        chain = [number for number, *_ in self.elements]
        path = "/".join([*self.stack, name] if name else self.stack)
        before = self.last.get(path)
        rep = 0 if before is None else next((i for i, (x, y) in enumerate(zip(before, chain)) if x != y), len(chain))
        self.last[path] = chain
        row = [chain[-1], chain[-2] if len(chain) > 1 else 0, *self.elements[-1][1], path, rep, len(chain) + (value is not None), value]
        self.rows.append(row)
        return row

    def start(self, tag: str, attrs: dict) -> None:
        before = len(self.figures), len(self.paragraphs), len(self.claims)
        super().start(tag, attrs)
        owners = list(self.elements[-1][1]) if self.elements else [None] * 4
        if len(self.figures) > before[0]:
            owners[0] = len(self.figures)
        if len(self.paragraphs) > before[1]:
            owners[1] = len(self.paragraphs)
        if len(self.claims) > before[2]:
            first = self.claims[-1][0] == 1
            self.claim_no, self.node_no = self.claim_no + first, 0 if first else self.node_no + 1
            owners[2:] = self.claim_no, self.node_no
        self.n_elements += 1
        texts: list[str] = []
        self.elements.append((self.n_elements, owners, texts))
        self._entry("", None).append(texts)
        for name, value in attrs.items():
            self._entry("@" + name[name.rfind("}") + 1 :], value)

    def end(self, tag: str) -> None:
        super().end(tag)
        self.elements.pop()

    def _flush(self) -> None:
        if self.pending and self.elements:
            self.elements[-1][2].append("".join(self.pending))
        super()._flush()

    def close(self) -> _Leaves:
        for row in self.rows:
            if isinstance(row[-1], list):
                if texts := squeezed(row.pop()):
                    row[-2:] = row[-2] + 1, texts
        return self


def leaves_body(body: str | None) -> list[list]:
    """Every element and attribute of a body: none if it is NULL, empty or not well-formed.

    ``rep`` is the level of the path at which an entry repeats the path's entry before it (0: the first;
    every element counts as repeatable), ``def`` the path's elements, plus 1 if the value is there. The value
    is an attribute's, or the text nodes of the element itself. Numbers of the figure, paragraph, claim and
    claim part that an entry is in are those of the flat tables (node_no 0: the claim itself).
    """
    if not body:
        return []
    parser = ET.XMLParser(target=_Leaves())
    try:
        parser.feed(body)
        return parser.close().rows
    except (ET.ParseError, ValueError):
        return []


def leaves(df: DataFrame, key: str, body: str) -> DataFrame:
    """key and the columns of ``_LEAF``: the rows of ``leaves_body`` for all rows of ``df``."""
    kinds = [x.rsplit(" ", 1) for x in _LEAF.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _batched(batches):
            keys, rows = [], []
            for k, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                new = leaves_body(x)
                keys.extend([k] * len(new))
                rows.extend(new)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *(pa.array([r[i] for r in rows], pa.int32() if kind == "int" else pa.string()) for i, (_, kind) in enumerate(kinds))], names=[key, *(n for n, _ in kinds)])

    return df.select(F.col(key).cast("string").alias(key), F.col(body).cast("string").alias(body)).mapInArrow(run, f"`{key}` string, {_LEAF}")


def named_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """xml_path, body: those that docs.xml or train.source_xml name, the latest extraction of each path."""
    named = table(spark, folder, "docs").select("xml").unionAll(table(spark, folder, "train").select("source_xml"))
    wanted = named.select(canonical_path(F.col("xml")).alias("path")).where("path IS NOT NULL").distinct()
    files = table(spark, folder, "xml_files").withColumn("path", canonical_path(F.col("xml_path"))).join(wanted, "path", "left_semi")
    latest = files.groupBy("path").agg(F.max_by(F.struct("xml_path", "body"), F.struct("extracted_at", F.xxhash64("body"))).alias("f")).select("f.xml_path", "f.body")
    return latest


def flat_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All five flat tables of ``named_bodies``: the bodies are parsed once, and the written levels read by each."""
    levels = written(shred(named_bodies(spark, folder), "xml_path", "body", texts=True), "levels")
    return {name: assembled(levels, name) for name in TABLES}


def flat_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The flat table ``name`` of ``named_bodies``."""
    return assembled(shred(named_bodies(spark, folder), "xml_path", "body", texts=True), name)
