"""Text functions as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from figloom.functions import vocabulary as V


def clean(s: Column) -> Column:
    """Trimmed, runs of whitespace as one space; NULL becomes the empty text."""
    return F.trim(F.regexp_replace(F.coalesce(s, F.lit("")), V.BLANK + "+", " "))


def plain_dashes(s: Column) -> Column:
    """All kinds of dashes as the ASCII hyphen."""
    return F.translate(s, V.DASHES, "-" * len(V.DASHES))


def file_token(s: Column) -> Column:
    """Letters and digits kept, blank, dot, hyphen and slash as ``_``, all else dropped, no outer ``_``; nothing left: UNLABELED."""
    kept = F.regexp_replace(F.coalesce(s, F.lit("")), r"[^\p{L}\p{N} .\-/]", "")
    bare = F.regexp_replace(F.translate(kept, " .-/", "____"), "^_+|_+$", "")
    return F.when(bare == "", "UNLABELED").otherwise(bare)


def figure_number(s: Column) -> Column:
    """Canonical figure number: upper case, no blanks, no leading zeros, at most one hyphen; '' if it is none (also NULL).

    ASCII digits and letters only.
    """
    raw = F.replace(F.upper(F.trim(F.coalesce(s, F.lit("")))), F.lit(" "), F.lit(""))
    ok = raw.rlike("^0*[0-9]{1,4}[A-Z]{0,2}(-0*[0-9]{1,4}[A-Z]{0,2})?$")
    return F.when(ok, F.regexp_replace(raw, "(^|-)0+(?=[0-9])", "$1")).otherwise("")


def label_number(label: Column) -> Column:
    """The figure number in a label such as ``FIG. 3A``; NULL if there is none."""
    upper = F.upper(label)
    rest = F.when(upper.contains("FIGURE"), F.regexp_extract(upper, r"(?s)FIGURE(.*)$", 1)).when(upper.contains("FIG"), F.regexp_extract(upper, r"(?s)FIG(.*)$", 1))
    bare = F.regexp_replace(F.translate(rest, ".:/", "   "), r"^[ .:_-]+|[ .:_-]+$", "")
    return F.nullif(figure_number(bare), F.lit(""))


def figure_numbers(texts: Column) -> Column:
    """Upper-cased figure numbers of an array of texts, distinct, in the order of strings."""
    found = F.flatten(F.transform(F.filter(texts, lambda t: t.isNotNull()), lambda t: F.regexp_extract_all(t, F.lit("(?i)" + V.FIGURE), 1)))
    return F.array_sort(F.array_distinct(F.transform(found, F.upper)))


def diagram_class(text: Column) -> Column:
    """The first class with a signal word; ``line art`` if there is none."""
    t = F.lower(clean(text))
    out = F
    for name, words in V.CLASSES:
        out = out.when(t.rlike(rf"\b(?:{words})\b"), name)
    return out.otherwise(V.OTHER_CLASS)


def view_cue(text: Column) -> Column:
    """The leftmost view cue, lower-cased; ``unspecified`` if there is none."""
    return F.coalesce(F.nullif(F.lower(F.regexp_extract(clean(text), rf"(?i)\b(?:{V.VIEWS})\b", 0)), F.lit("")), F.lit(V.UNKNOWN))


def words(text: Column) -> Column:
    """ASCII words: a letter, then letters and hyphens."""
    return F.regexp_extract_all(clean(text), F.lit(r"[A-Za-z][A-Za-z\-]+"), 0)


def is_keyword(word: Column) -> Column:
    """Not a stop word, longer than two, without an excluded beginning, not ending in -ing. For lower-cased words."""
    return ~word.isin(*V.KEYWORD_STOPS) & (F.length(word) > 2) & ~word.rlike("^(?:" + "|".join(V.KEYWORD_STARTS) + ")") & ~word.endswith("ing")


def sentences(text: Column) -> Column:
    """Cut at whitespace after ``.``, ``;`` or ``:`` and at line breaks; blank ones dropped."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"(?<=[.;:])\s+|\n+"), lambda s: F.trim(s)), lambda s: s != "")


def figure_prefixes(label: Column, text: Column) -> Column:
    """Alternatives of a pattern for reference numerals: the first figure's digits, with its letter first; NULL without one."""
    of = F.when(F.length(label) > 0, label).otherwise(text)
    rx = r"(?i)\bfig(?:\.|ure)?\s*(\d+)([A-Za-z]?)\b"
    digits, letter = F.regexp_extract(of, rx, 1), F.upper(F.regexp_extract(of, rx, 2))
    return F.when(digits == "", None).when(letter == "", digits).otherwise(F.concat(digits, letter, F.lit("|"), digits))


def bare_labels(text: Column, prefixes: Column) -> Column:
    """Reference numerals that start with a prefix, upper-cased, ordinals left out, distinct in order of occurrence."""
    rx = F.concat(F.lit(r"(?i)\b(?:"), prefixes, F.lit(r")(?:\d+[A-Za-z]*|[A-Za-z]+\d+)(?:[-/][0-9A-Za-z]+)*(?:['′](?=\w))?\b"))
    found = F.transform(F.regexp_extract_all(text, rx, 0), F.upper)
    return F.array_distinct(F.filter(found, lambda x: ~x.rlike("(?:ST|ND|RD|TH)$")))


def figure_display(label: Column) -> Column:
    """A label as prompts show it."""
    return F.trim(F.replace(F.replace(F.coalesce(label, F.lit("{unknown}")), F.lit("FIGURE"), F.lit("FIG.")), F.lit("FIG "), F.lit("FIG. ")))


def claims_source(kind: Column, method: Column, first: Column, all_claims: Column) -> Column:
    """The method claim of a flowchart if there is one, else the first claim, else all."""
    one = [F.nullif(c, F.lit("")) for c in (method, first, all_claims)]
    return F.coalesce(F.when(kind == "flowchart", one[0]), one[1], one[2], F.lit(""))


def string_list(json: Column) -> Column:
    """A JSON list of strings; NULL and bad JSON give the empty list."""
    return F.coalesce(F.from_json(json, "array<string>"), F.array().cast("array<string>"))


def shortened(s: Column, most: int = 360) -> Column:
    """Cleaned, at most ``most`` characters, the last an ellipsis if something was cut."""
    c = clean(s)
    return F.when(F.length(c) > most, F.concat(F.left(c, F.lit(most - 1)), F.lit("…"))).otherwise(c)


def is_cover_sheet(path: Column) -> Column:
    return F.coalesce(F.upper(path).rlike(r"D00000\.TIFF?$"), F.lit(False))


def letterbox(width: Column, height: Column, canvas: int = 2048) -> Column:
    """How a page is fitted on a square canvas: scaled down only, half-even rounding, at least 1 pixel, centred. NULL for an empty page."""
    scale = F.least(F.lit(1.0), F.lit(float(canvas)) / F.greatest(width, height))
    w, h = (F.greatest(F.lit(1), F.rint(x * scale).cast("int")) for x in (width, height))
    made = F.struct(
        width.cast("int").alias("orig_width"), height.cast("int").alias("orig_height"), w.alias("resized_width"), h.alias("resized_height"),
        F.floor((canvas - w) / 2).cast("int").alias("offset_x"), F.floor((canvas - h) / 2).cast("int").alias("offset_y"), scale.alias("scale"), F.lit(canvas).alias("canvas_size"),
    )
    return F.when((width > 0) & (height > 0), made)


def figure_refs(texts: Column) -> Column:
    """Of each text the canonical figure numbers it names."""
    return F.transform(texts, lambda t: F.filter(F.transform(F.regexp_extract_all(t, F.lit("(?i)" + V.FIGURE), 1), figure_number), lambda x: x != ""))


def figure_start(paragraphs: Column, refs: Column, number: Column) -> Column:
    """The place (from 1) of the first paragraph on the figure: that refers to it, else that spells FIG and the number somewhere; NULL if there is none."""
    flat = F.replace(number, F.lit("-"), F.lit(""))
    squeezed = F.transform(paragraphs, lambda p: F.regexp_replace(F.upper(p), r"[ .,\-]", ""))
    named = F.array_position(F.transform(refs, lambda r: F.array_contains(r, number)), F.lit(True))
    spelled = F.array_position(F.transform(squeezed, lambda p: p.contains("FIG") & p.contains(flat)), F.lit(True))
    return F.when(F.length(number) > 0, F.coalesce(F.nullif(named, F.lit(0)), F.nullif(spelled, F.lit(0)))).cast("int")


def with_figure_text(df: DataFrame, paragraphs: str, refs: str, captions: str, number: str, out: str = "fig_text") -> DataFrame:
    """Adds the paragraphs on one figure: from the first that refers to it to the next that refers to others only, two at least.

    ``refs``: ``figure_refs`` of the paragraphs. Neither list is NULL or has blank items. Without any mention: the first two
    paragraphs; without paragraphs the first two captions. In steps, so that no place is looked for again per paragraph.
    """
    p, r, start = F.col(paragraphs), F.col(refs), F.col("_start")
    other = F.transform(r, lambda x, i: (i >= start) & (F.size(x) > 0) & ~F.array_contains(x, F.col(number)))
    stop = F.nullif(F.array_position(other, F.lit(True)), F.lit(0)).cast("int")
    staged = df.withColumn("_start", figure_start(p, r, F.col(number))).withColumn("_n", F.coalesce(stop, F.size(p) + 1) - start)
    two = (F.col("_n") == 1) & (start < F.size(p)) & (F.get(p, start) != F.get(p, start - 1))
    chosen = F.slice(p, start, F.when(two, F.lit(2)).otherwise(F.col("_n")))
    first_two = lambda x: F.array_join(F.slice(x, 1, 2), " ")
    text = F.when(F.size(p) == 0, first_two(F.col(captions))).when(start > 0, F.array_join(chosen, " ")).otherwise(first_two(p))
    return staged.withColumn(out, text).drop("_start", "_n")
