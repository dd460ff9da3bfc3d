"""Keys that are written in several ways: paths, document ids, family ids."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

PROJECT_ROOT = "/srv/drawings"


def canonical_path(path: Column, root: str = PROJECT_ROOT) -> Column:
    """The absolute path a relative, absolute or ``file:`` spelling resolves to, without touching a disk.

    Repeated slashes and ``.`` are dropped, ``..`` removes the part before it (never above
    ``/``), percent escapes are decoded in URIs only, case is kept. NULL and ``''`` give NULL.
    The fold over the parts runs only for the rows that need it.
    """
    bare = F.regexp_replace(path, r"(?i)^file:(//[^/]*)?(?=/)", "")
    plain = F.when(
        path.rlike("(?i)^file:"),
        F.when(bare.contains("%"), F.coalesce(F.try_url_decode(F.replace(bare, F.lit("+"), F.lit("%2B"))), bare)).otherwise(bare),
    ).otherwise(path)
    full = F.when(plain.startswith("/"), plain).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), plain))
    parts = F.aggregate(
        F.split(full, "/"),
        F.array().cast("array<string>"),
        lambda done, part: F.when(part.isin("", "."), done)
        .when(part == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.array_append(done, part)),
    )
    folded = F.when(full.rlike(r"//|/\.{1,2}(/|$)|/$"), F.concat(F.lit("/"), F.array_join(parts, "/"))).otherwise(full)
    return F.when(F.length(path) > 0, folded)


def document_key(doc_id: Column) -> Column:
    """Upper case with everything but A-Z and 0-9 dropped; NULL stays NULL."""
    return F.regexp_replace(F.upper(doc_id), "[^A-Z0-9]", "")


def family_key(family_id: Column) -> Column:
    """``F`` and digits, ignoring case, blanks and punctuation; any other value names no family: NULL."""
    bare = F.upper(F.regexp_replace(family_id, r"[^\p{L}\p{N}]", ""))
    return F.when(bare.rlike("^F[0-9]+$"), bare)


def stem(path: Column) -> Column:
    """File name without folders and without its last extension."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")
