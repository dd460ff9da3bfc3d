"""Queries of this subpackage as SQL, where whole tables are small enough for it."""

from __future__ import annotations

import unicodedata

from figloom.llm import lookalike as L
from figloom.llm.forest import KINDS

_KEY = "regexp_replace(upper({}), '[^A-Z0-9]', '', 'g')"
_KINDS = ", ".join(f"'{k}'" for k in KINDS)
_BARE = r"upper(regexp_replace(family_id, '[^\p{L}\p{N}]', '', 'g'))"
_SHINGLES = "list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))"


def _similar(rows: str, pair: str) -> str:
    """Common table expressions that end in ``sim`` (a, b: row numbers of ``r``); ``rows``: SQL with columns space, key, text, ...; ``pair``: a condition on x and y."""
    return f"""
r AS MATERIALIZED (SELECT *, row_number() OVER () AS n FROM ({rows})),
w AS (SELECT n, space, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM r),
s AS MATERIALIZED (SELECT n, space, {_SHINGLES} AS s FROM w WHERE len(w) >= 30),
e AS MATERIALIZED (SELECT n, space, unnest(s) AS g FROM s),
c AS (SELECT x.n AS a, y.n AS b, count(*) AS c FROM e x JOIN e y ON x.g = y.g AND {pair} GROUP BY 1, 2),
sim AS (SELECT a, b FROM c JOIN s x ON x.n = a JOIN s y ON y.n = b WHERE c >= 0.6 * (len(x.s) + len(y.s) - c))"""


#: Prompts by side, and the texts of problem 5 by space.
_ROWS = "SELECT DISTINCT id AS key, prompt AS text, CASE WHEN split = 'train' THEN 0 ELSE 1 END AS space FROM train WHERE split IN ('train', 'validation', 'test') AND id IS NOT NULL"
_PROMPTS = _similar(_ROWS, "x.space = 0 AND y.space = 1")
_EDITED = "SELECT DISTINCT id AS key, prompt AS text, 'prompt' AS space FROM train WHERE id IS NOT NULL UNION SELECT doc_id || ':' || section, content, section FROM text_fts WHERE section IN ('paragraph', 'claim') AND doc_id IS NOT NULL"

_GRAPH = f"""
WITH RECURSIVE e0 AS (
  SELECT 'D' || {_KEY.format('doc_id')} AS a, 'F' || {_BARE} AS b FROM docs WHERE regexp_full_match({_BARE}, 'F[0-9]+')
  UNION SELECT 'D' || {_KEY.format('doc_id')}, 'D' || {_KEY.format('related_doc_id')} FROM doc_links WHERE link_kind IN ({_KINDS})),
e AS (SELECT a, b FROM e0 WHERE a <> b AND a IS NOT NULL AND b IS NOT NULL UNION SELECT b, a FROM e0 WHERE a <> b AND a IS NOT NULL AND b IS NOT NULL),
t AS (SELECT a AS x, a AS y FROM e UNION SELECT t.x, e.b FROM t JOIN e ON t.y = e.a),
c AS (SELECT x, min(y) AS c FROM t GROUP BY 1),"""



def _looks() -> dict[int, str]:
    """Code point -> what it looks like, for those that change. A rule over the Unicode data."""
    out = {}
    for c in range(0x9, 0x30000):
        ch = chr(c)
        kind = unicodedata.category(ch)
        if kind in ("Cs", "Co", "Cn"):
            continue
        if ch in L._BREAKS:
            to = "\n"
        elif kind == "Zs" or ch == "\t":
            to = " "
        elif kind in ("Cc", "Cf") or any(a <= c <= b for a, b in L._IGNORABLE):
            to = ""
        else:
            tag = unicodedata.decomposition(ch).partition(" ")[0]
            joined = tag in L._SAME_LOOK and not any(a <= c <= b for a, b in L._OWN_LOOK) and not unicodedata.decomposition(ch).startswith(tag + " 0020")
            to = "".join(out.get(ord(x), x) for x in unicodedata.normalize("NFKD" if joined else "NFD", ch))
            to = unicodedata.normalize("NFC", "".join(L._LETTERS.get(x, x) for x in to))
        if to != ch and to != unicodedata.normalize("NFC", ch):
            out[c] = to
    return out


_MAP = ", ".join(f"({c}, {' || '.join(f'chr({ord(x)})' for x in to) or chr(39) * 2})" for c, to in _looks().items())
_PICTURE = r"'^[\p{So}\x{1F000}-\x{1FAFF}]$'"
_JOINING = "'^[" + "".join(rf"\p{{{x}}}" for x in "Arabic Syriac Mongolian Devanagari Bengali Gurmukhi Gujarati Oriya Tamil Telugu Kannada Malayalam Sinhala Khmer".split()) + "]$'"
#: Joiners and variation selectors that show, by the characters beside them.
_KEPT = rf"""(ch = chr(8205) AND regexp_matches(after, {_PICTURE}) AND (regexp_matches(one, {_PICTURE}) OR regexp_matches(one, '^[\x{{FE0F}}\x{{1F3FB}}-\x{{1F3FF}}]$') AND regexp_matches(two, {_PICTURE}))
  OR ch IN (chr(65038), chr(65039)) AND regexp_matches(one, {_PICTURE}) OR ch IN (chr(8204), chr(8205)) AND regexp_matches(one, {_JOINING}) AND regexp_matches(after, '^\p{{L}}$'))"""
_FORMS = f"""
looks(c, shown) AS (VALUES {_MAP}),
chars_ AS (SELECT doc_id, unnest(l) AS ch, generate_subscripts(l, 1) AS i FROM (SELECT doc_id, regexp_extract_all(replace(text, chr(13) || chr(10), chr(10)), '(?s).') AS l FROM documents WHERE text IS NOT NULL)),
chars AS (SELECT *, lag(ch) OVER w AS one, lag(ch, 2) OVER w AS two, lead(ch) OVER w AS after FROM chars_ WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
shown AS (SELECT doc_id, nfc_normalize(string_agg(CASE WHEN {_KEPT} THEN ch ELSE coalesce(shown, ch) END, '' ORDER BY i)) AS form FROM chars LEFT JOIN looks ON c = unicode(ch) GROUP BY 1),
forms AS MATERIALIZED (SELECT d.doc_id, text, CASE WHEN text IS NOT NULL THEN coalesce(form, '') END AS form FROM documents d LEFT JOIN shown USING (doc_id))"""

#: The deal, band by band: ``q`` (root, n_rows, band, before), ``cuts`` (k, split, low, high) of each band.
_DEAL = _GRAPH + f"""
k AS (SELECT doc_id, {_KEY.format('doc_id')} AS key, true AS indexed FROM docs UNION ALL SELECT doc_id, {_KEY.format('doc_id')}, false FROM train),
r AS MATERIALIZED (SELECT k.*, coalesce(c.c, 'D' || key) AS root FROM k LEFT JOIN c ON c.x = 'D' || key WHERE key <> ''),
s AS MATERIALIZED (SELECT root, min(key) AS first_key, min(doc_id) FILTER (indexed) AS group_doc_id, count(*) AS n_rows, floor(log2(count(*)))::INT AS band FROM r GROUP BY 1),
q AS MATERIALIZED (SELECT *, sum(n_rows) OVER (PARTITION BY band ORDER BY md5(first_key), first_key) - n_rows AS before, dense_rank() OVER (ORDER BY band DESC) AS k FROM s),
bands AS MATERIALIZED (SELECT k, sum(n_rows) AS n FROM q GROUP BY 1),
lack AS (
  SELECT 0::BIGINT AS k, split, share / (SELECT sum(share) FROM split_plan) * (SELECT sum(n_rows) FROM q)::DOUBLE AS lack FROM split_plan
  UNION ALL
  SELECT k, split, lack - coalesce((SELECT sum(q.n_rows) FROM q WHERE q.k = x.k AND q.before >= x.low AND (q.before < x.high OR x.pos = x.n_splits)), 0)::DOUBLE FROM (
    SELECT b.k, t.split, t.lack, row_number() OVER o AS pos, count(*) OVER () AS n_splits, round(sum(greatest(t.lack, 0)) OVER o / sum(greatest(t.lack, 0)) OVER () * b.n, 6) AS high,
      round((sum(greatest(t.lack, 0)) OVER o - greatest(t.lack, 0)) / sum(greatest(t.lack, 0)) OVER () * b.n, 6) AS low
    FROM lack t JOIN bands b ON b.k = t.k + 1 WINDOW o AS (ORDER BY greatest(t.lack, 0) DESC, t.split)) x),
cuts AS (
  SELECT b.k, split, row_number() OVER o AS pos, count(*) OVER (PARTITION BY b.k) AS n_splits, round(sum(greatest(lack, 0)) OVER o / sum(greatest(lack, 0)) OVER (PARTITION BY b.k) * b.n, 6) AS high,
    round((sum(greatest(lack, 0)) OVER o - greatest(lack, 0)) / sum(greatest(lack, 0)) OVER (PARTITION BY b.k) * b.n, 6) AS low
  FROM lack t JOIN bands b ON b.k = t.k + 1 WINDOW o AS (PARTITION BY b.k ORDER BY greatest(lack, 0) DESC, split)),
dealt AS MATERIALIZED (SELECT q.root, q.group_doc_id, q.n_rows, split FROM q JOIN cuts c ON c.k = q.k AND q.before >= c.low AND (q.before < c.high OR c.pos = c.n_splits))"""

SQL = {
    "p2_splits": _DEAL + " SELECT DISTINCT doc_id, group_doc_id, split FROM r JOIN dealt USING (root) WHERE indexed",
    "p2_train_splits": _DEAL + f" SELECT t.id, t.doc_id, dealt.split FROM train t JOIN (SELECT DISTINCT key, root FROM r) x ON x.key = {_KEY.format('t.doc_id')} JOIN dealt USING (root)",
    "p2_shares": _DEAL + " SELECT p.split, coalesce(n, 0)::BIGINT AS n_rows, round(coalesce(n, 0) / sum(n) OVER (), 4) AS share, p.share AS wanted FROM split_plan p LEFT JOIN (SELECT split, sum(n_rows) AS n FROM dealt GROUP BY 1) USING (split)",
    "p2_found": _GRAPH + f"""
d AS (SELECT DISTINCT doc_id, coalesce(c.c, 'D' || {_KEY.format('doc_id')}) AS c FROM docs LEFT JOIN c ON c.x = 'D' || {_KEY.format('doc_id')} WHERE {_KEY.format('doc_id')} <> ''),
g AS (SELECT c, min(doc_id) AS group_doc_id FROM d GROUP BY 1 HAVING count(DISTINCT {_KEY.format('doc_id')}) > 1)
SELECT DISTINCT d.doc_id, g.group_doc_id FROM d JOIN g USING (c)""",
    "p2_trees": _GRAPH + f"""
k AS (SELECT 'D' || {_KEY.format('doc_id')} AS node, min(doc_id) AS doc_id FROM docs GROUP BY 1)
SELECT min(x) AS first_node, min(k.doc_id) AS first_doc_id, count(*) AS n_nodes, count(*) - 1 AS n_edges FROM c LEFT JOIN k ON k.node = c.x GROUP BY c.c""",
    "p2_together": _GRAPH + f"""
k AS (SELECT doc_id, 'D' || {_KEY.format('doc_id')} AS node, true AS indexed FROM docs UNION ALL SELECT doc_id, 'D' || {_KEY.format('doc_id')}, false FROM train),
g AS (SELECT k.*, coalesce(c.c, k.node) AS root FROM k LEFT JOIN c ON c.x = k.node WHERE k.node <> 'D')
SELECT min(doc_id) FILTER (indexed) AS group_doc_id, count(DISTINCT node) FILTER (indexed) AS n_docs, count(*) AS n_rows, 1::BIGINT AS n_splits FROM g GROUP BY root HAVING bool_or(indexed)""",
    "p3_found": f"""
WITH {_PROMPTS},
h AS (SELECT DISTINCT id, sha256, split = 'train' AS t FROM train WHERE split IN ('train', 'validation', 'test') AND sha256 IS NOT NULL AND id IS NOT NULL),
p AS (SELECT x.key AS a, y.key AS b FROM sim JOIN r x ON x.n = a JOIN r y ON y.n = b UNION SELECT x.id, y.id FROM h x JOIN h y ON x.sha256 = y.sha256 AND x.t AND NOT y.t)
SELECT DISTINCT least(a, b) AS id_a, greatest(a, b) AS id_b FROM p WHERE a <> b""",
    "p5_found": f"""
WITH {_similar(_EDITED, "x.space = y.space AND x.n < y.n")}
SELECT DISTINCT CASE WHEN x.space = 'prompt' THEN 'prompt' ELSE 'content' END AS field, least(x.key, y.key) AS key_a, greatest(x.key, y.key) AS key_b
FROM sim JOIN r x ON x.n = a JOIN r y ON y.n = b WHERE x.key <> y.key""",
    "p3_report": f"""
WITH {_PROMPTS},
t AS (SELECT DISTINCT id, split, space FROM (SELECT id, split, CASE WHEN split = 'train' THEN 0 ELSE 1 END AS space FROM train WHERE split IN ('train', 'validation', 'test'))),
h AS (SELECT DISTINCT y.id FROM train x JOIN train y ON x.sha256 = y.sha256 AND x.split = 'train' AND y.split IN ('validation', 'test') AND x.id <> y.id),
p AS (SELECT DISTINCT y.key AS id FROM sim JOIN r x ON x.n = a JOIN r y ON y.n = b WHERE x.key <> y.key)
SELECT split, source, count(*) AS n_rows, count(*) FILTER (id IN (FROM h)) AS n_hash, count(*) FILTER (id IN (FROM p)) AS n_text, count(*) FILTER (id IN (FROM h) OR id IN (FROM p)) AS n_either
FROM train WHERE split IN ('validation', 'test') GROUP BY 1, 2""",
    "p3_classes": f"""
WITH {_PROMPTS},
cl AS MATERIALIZED (SELECT n, r.space, key, array_to_string(w.w, ' ') AS c FROM r JOIN w USING (n) WHERE len(w.w) >= 30),
g AS (SELECT space, c, min(key) AS class_id FROM cl GROUP BY 1, 2),
l AS (SELECT space, c, count(DISTINCT o) AS n_links FROM (SELECT x.space, x.c, y.c AS o FROM sim JOIN cl x ON x.n = a JOIN cl y ON y.n = b UNION ALL SELECT y.space, y.c, x.c FROM sim JOIN cl x ON x.n = a JOIN cl y ON y.n = b) GROUP BY 1, 2)
SELECT DISTINCT key AS id, CASE WHEN cl.space = 0 THEN 'train' ELSE 'evaluation' END AS side, class_id, coalesce(n_links, 0) AS n_links FROM cl JOIN g USING (space, c) LEFT JOIN l USING (space, c)""",
    "p3_coverage": f"""
WITH r AS MATERIALIZED (SELECT *, row_number() OVER () AS n FROM ({_ROWS})),
w AS MATERIALIZED (SELECT n, space, key, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM r),
g AS MATERIALIZED (SELECT n, space, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g, unnest(range(1, len(w) - 1)) AS p FROM w WHERE len(w) >= 30),
runs AS (SELECT n, o, p, d, row_number() OVER (PARTITION BY n, o, d ORDER BY p) AS rn FROM (SELECT x.n, y.n AS o, x.p, x.p - y.p AS d FROM g x JOIN g y ON x.g = y.g AND x.space = 1 AND y.space = 0)),
spans AS (SELECT n, min(p) AS a, max(p) + 2 AS b FROM runs GROUP BY n, o, d, p - rn),
best AS (SELECT n, max(b - a + 1)::INT AS longest FROM spans GROUP BY 1),
places AS (SELECT DISTINCT n, unnest(range(a, b + 1)) AS k FROM spans),
cov AS (SELECT n, count(*) AS k FROM places GROUP BY 1)
SELECT DISTINCT w.key AS id, coalesce(round(cov.k / len(w.w), 4), 0.0)::DOUBLE AS covered, coalesce(longest, 0) AS longest FROM w LEFT JOIN best USING (n) LEFT JOIN cov USING (n) WHERE space = 1 AND len(w.w) >= 30""",
    "p5_groups": f"""
WITH RECURSIVE {_similar(_EDITED, "x.space = y.space AND x.n < y.n")},
cl AS MATERIALIZED (SELECT n, r.space, key, array_to_string(w.w, ' ') AS c FROM r JOIN w USING (n) WHERE len(w.w) >= 30),
lk AS MATERIALIZED (SELECT DISTINCT x.space, x.c AS a, y.c AS b FROM sim JOIN cl x ON x.n = a JOIN cl y ON y.n = b WHERE x.c <> y.c UNION SELECT DISTINCT x.space, y.c, x.c FROM sim JOIN cl x ON x.n = a JOIN cl y ON y.n = b WHERE x.c <> y.c),
k AS MATERIALIZED (SELECT space, c, min(key) AS class_key FROM cl GROUP BY 1, 2),
t AS (SELECT space, a AS x, a AS y FROM lk UNION SELECT t.space, t.x, lk.b FROM t JOIN lk ON t.space = lk.space AND t.y = lk.a),
g AS (SELECT t.space, x, min(k.class_key) AS group_key FROM t JOIN k ON k.space = t.space AND k.c = t.y GROUP BY 1, 2),
l AS (SELECT space, a, count(*) AS n_links FROM lk GROUP BY 1, 2)
SELECT DISTINCT cl.space AS field, key, class_key, coalesce(group_key, class_key) AS group_key, coalesce(n_links, 0) AS n_links
FROM cl JOIN k ON k.space = cl.space AND k.c = cl.c LEFT JOIN g ON g.space = cl.space AND g.x = cl.c LEFT JOIN l ON l.space = cl.space AND l.a = cl.c""",
    "p7_found": """
SELECT DISTINCT 'content' AS item_field, doc_id || ':' || section AS item_key FROM text_fts
WHERE length(content) > (SELECT amount FROM size_limits WHERE setting = 'content_chars') AND doc_id || ':' || section IS NOT NULL
UNION SELECT DISTINCT 'prompt', id FROM train WHERE length(prompt) > (SELECT amount FROM size_limits WHERE setting = 'prompt_chars') AND id IS NOT NULL""",
    "p7_rejoined": """
SELECT DISTINCT 'content' AS item_field, doc_id || ':' || section AS item_key, md5(content) AS rejoined, length(content)::INT AS n_chars FROM text_fts
WHERE length(content) > (SELECT amount FROM size_limits WHERE setting = 'content_chars') AND doc_id || ':' || section IS NOT NULL
UNION SELECT DISTINCT 'prompt', id, md5(prompt), length(prompt)::INT FROM train WHERE length(prompt) > (SELECT amount FROM size_limits WHERE setting = 'prompt_chars') AND id IS NOT NULL""",
    "p8_round_trip": "SELECT doc_id, md5(coalesce(text, '')) AS decoded, strlen(coalesce(text, ''))::INT AS n_bytes FROM documents",
    "p9_broken": "SELECT 'document' AS kind, doc_id AS number FROM documents WHERE false",
    "p10_forms": f"WITH {_FORMS} SELECT doc_id, form FROM forms",
    "p10_found": f"""WITH {_FORMS},
s AS (SELECT * FROM forms WHERE trim(form, ' ' || chr(10)) <> '')
SELECT DISTINCT x.doc_id AS doc_id_a, y.doc_id AS doc_id_b FROM s x JOIN s y ON x.form = y.form AND x.text <> y.text AND x.doc_id < y.doc_id""",
    "p10_classes": f"""WITH {_FORMS},
s AS (SELECT * FROM forms WHERE trim(form, ' ' || chr(10)) <> '')
SELECT doc_id, class_doc_id, n_links FROM s JOIN (SELECT form, min(doc_id) AS class_doc_id, count(DISTINCT text) - 1 AS n_links FROM s GROUP BY 1) USING (form)""",
}
