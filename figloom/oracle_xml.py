"""The queries over XML bodies as SQL: tags and texts by a pattern, elements by the depth of their tags.

A body is well-formed if its tokens cover it, every tag closes with its own name, there is one root and
nothing but blanks outside. Entities aren't decoded: the test tables have none.
"""

from __future__ import annotations

from figloom.oracle import _NUMS, _class, path

_TOKEN = r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>|<![A-Z][^>]*>|<[^>!?][^>]*>|[^<]+"
_BARE = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
_PARAGRAPH = "e.name IN ('p', 'paragraph', 'text') AND contains(e.above, '/description/')"
_CAPTION = """(e.name = 'p' AND (contains(e.above, '/drawings/') OR regexp_matches(e.above, '/figures/(.*/)?figure/') OR regexp_matches(e.above, '/description/(.*/)?brief-description-of-drawings/(.*/)?description-of-drawings/'))
  OR e.name = 'figcaption' AND regexp_matches(e.above, '/drawings/(.*/)?figure/') OR e.name = 'caption' AND regexp_matches(e.above, '/figures/(.*/)?figure/'))"""
_LATEST = "SELECT xml_path AS k, body FROM (SELECT *, row_number() OVER (PARTITION BY xml_path ORDER BY extracted_at DESC NULLS LAST, body DESC NULLS LAST) AS rn FROM xml_files) WHERE rn = 1"
_NAMED = f"""SELECT xml_path AS k, body FROM (SELECT *, row_number() OVER (PARTITION BY {path('xml_path')} ORDER BY extracted_at DESC NULLS LAST) AS rn FROM xml_files
  WHERE {path('xml_path')} IN (SELECT {path('xml')} FROM docs WHERE xml <> '' UNION SELECT {path('source_xml')} FROM train WHERE source_xml <> '')) WHERE rn = 1"""


def attribute(name: str, of: str = "e.tok") -> str:
    found = rf"""regexp_extract({of}, '\s(?:[a-z]+:)?{name}\s*=\s*("[^"]*"|''[^'']*'')', 1)"""
    return f"CASE WHEN {found} <> '' THEN substring({found}, 2, length({found}) - 2) END"


def elements(bodies: str) -> str:
    """Common table expressions for the ``bodies`` (SQL: k, body): ``good`` (k, body, ok), ``el`` (k, i, upto, name, tok, above, no) of well-formed ones, ``said`` (k, i, said): the text of each element."""
    return f"""
b AS MATERIALIZED ({bodies}),
raw AS (SELECT k, body, regexp_extract_all(body, '{_TOKEN}') AS toks FROM b WHERE body <> ''),
one AS (SELECT k, length(body) AS n_body, unnest(toks) AS tok, generate_subscripts(toks, 1) AS i FROM raw),
tok AS MATERIALIZED (
  SELECT *, CASE WHEN tok LIKE '<![CDATA[%' THEN 'd' WHEN tok LIKE '<!%' OR tok LIKE '<?%' THEN 'x' WHEN tok LIKE '</%' THEN 'e' WHEN tok LIKE '<%/>' THEN 's' WHEN tok LIKE '<%' THEN 'o' ELSE 't' END AS kind,
    regexp_extract(tok, '^</?([^\\s/>]+)', 1) AS qname FROM one),
deep AS MATERIALIZED (
  SELECT *, sum(CASE kind WHEN 'o' THEN 1 WHEN 'e' THEN -1 ELSE 0 END) OVER w + (kind IN ('e', 's'))::INT AS d, sum((kind IN ('o', 'e', 's'))::INT) OVER w AS node
  FROM tok WINDOW w AS (PARTITION BY k ORDER BY i)),
tags AS MATERIALIZED (
  SELECT k, i, kind, qname, d, tok, CASE kind WHEN 's' THEN i ELSE lead(i) OVER w END AS upto, CASE kind WHEN 's' THEN 'e' ELSE lead(kind) OVER w END AS closed, CASE kind WHEN 's' THEN qname ELSE lead(qname) OVER w END AS closer
  FROM deep WHERE kind IN ('o', 'e', 's') WINDOW w AS (PARTITION BY k, d, kind = 's' ORDER BY i)),
fine AS (
  SELECT k FROM (SELECT k, bool_and(kind = 'e' OR coalesce(closed = 'e' AND closer = qname, false)) AND count(*) FILTER (kind <> 'e' AND d = 1) = 1 AND min(d) >= 1 AS ok FROM tags GROUP BY k) JOIN (
    SELECT k, sum(length(tok)) = any_value(n_body) AND bool_and(kind <> 't' OR d > 0 OR trim(tok, chr(10) || chr(13) || chr(9) || ' ') = '') AS whole FROM deep GROUP BY k) USING (k) WHERE ok AND whole),
good AS MATERIALIZED (SELECT b.k, b.body, f.k IS NOT NULL AS ok FROM b LEFT JOIN fine f ON b.k = f.k),
open AS MATERIALIZED (SELECT t.k, i, upto, regexp_extract(qname, '([^:]+)$', 1) AS name, tok, d FROM tags t JOIN fine USING (k) WHERE kind <> 'e'),
el AS MATERIALIZED (
  SELECT e.*, '/' || coalesce((SELECT string_agg(a.name, '/' ORDER BY a.i) || '/' FROM open a WHERE a.k = e.k AND a.i < e.i AND a.upto > e.upto), '') AS above, row_number() OVER (PARTITION BY k ORDER BY i) AS no FROM open e),
texts AS (SELECT k, node, min(i) AS i, {_BARE.format("string_agg(CASE kind WHEN 'd' THEN substring(tok, 10, length(tok) - 12) ELSE tok END, '' ORDER BY i)")} AS txt FROM deep WHERE kind IN ('t', 'd') GROUP BY 1, 2),
said AS MATERIALIZED (SELECT e.k, e.i, coalesce(string_agg(txt, ' ' ORDER BY t.i) FILTER (txt <> ''), '') AS said FROM el e LEFT JOIN texts t ON t.k = e.k AND t.i > e.i AND t.i < e.upto GROUP BY 1, 2)"""


def with_claims(bodies: str) -> str:
    """Adds ``claim`` (k, i, upto, tok, claim_no) and ``part`` (k, i, claim_no, node_no, parent_no, tok): the claim-texts in claims."""
    return elements(bodies) + """,
claim AS MATERIALIZED (SELECT k, i, upto, tok, row_number() OVER (PARTITION BY k ORDER BY i) AS claim_no FROM el WHERE name = 'claim'),
inner_ AS MATERIALIZED (
  SELECT e.k, e.i, e.upto, e.tok, c.claim_no, row_number() OVER (PARTITION BY e.k, c.claim_no ORDER BY e.i) AS node_no FROM el e JOIN claim c ON c.k = e.k AND c.i < e.i AND c.upto > e.upto WHERE e.name = 'claim-text'),
part AS MATERIALIZED (
  SELECT x.k, x.i, x.tok, x.claim_no, x.node_no, coalesce(max(y.node_no), 0) AS parent_no FROM inner_ x LEFT JOIN inner_ y ON y.k = x.k AND y.claim_no = x.claim_no AND y.i < x.i AND y.upto > x.upto GROUP BY ALL)"""


_META = f"""WITH {elements(_LATEST)},
par AS (SELECT k, list(said ORDER BY e.i) AS paragraphs FROM el e JOIN said s USING (k, i) WHERE {_PARAGRAPH} GROUP BY 1),
cap AS (SELECT k, list(said ORDER BY e.i) AS titles FROM el e JOIN said s USING (k, i) WHERE {_CAPTION} AND said <> '' GROUP BY 1),
leads AS (SELECT e.k, e.i, arg_min(s.said, x.i) AS lead FROM el e JOIN el x ON x.k = e.k AND x.i > e.i AND x.upto < e.upto AND x.name = 'claim-text' JOIN said s ON s.k = x.k AND s.i = x.i WHERE e.name = 'claim' GROUP BY 1, 2),
claims AS MATERIALIZED (
  SELECT e.k, e.i, s.said, l.lead, coalesce(lower(trim({attribute('claim-type')})), 'independent') = 'independent' AND coalesce({attribute('claim-ref')}, '') = ''
    AND NOT EXISTS (FROM el r WHERE r.k = e.k AND r.i > e.i AND r.upto < e.upto AND r.name IN ('claim-ref', 'claim-reference')) AS independent
  FROM el e JOIN said s USING (k, i) LEFT JOIN leads l USING (k, i) WHERE e.name = 'claim' AND contains(e.above, '/claims/')),
cl AS (
  SELECT k, coalesce(string_agg(said, ' ' ORDER BY i) FILTER (said <> ''), '') AS claims, arg_min(said, i) AS first_claim, arg_min(said, i) FILTER (said <> '' AND regexp_matches(lead, '(?i)\\bmethod\\b')) AS method_claim, count(*) AS n_claims, count(*) FILTER (independent) AS n_independent
  FROM claims GROUP BY 1),
m AS MATERIALIZED (
  SELECT g.k AS xml_path, g.ok, coalesce(paragraphs, []) AS paragraphs, coalesce(titles, []) AS titles, coalesce(claims, '') AS claims, coalesce(first_claim, '') AS first_claim, method_claim, coalesce(n_claims, 0)::INT AS n_claims, coalesce(n_independent, 0)::INT AS n_independent
  FROM good g LEFT JOIN par USING (k) LEFT JOIN cap USING (k) LEFT JOIN cl USING (k))"""
_FLOW = _class("array_to_string(titles, ' ')")

SQL = {
    "xml_metadata": f"""{_META}
SELECT xml_path, ok AS well_formed, len(paragraphs)::INT AS n_paragraphs, len(titles)::INT AS n_titles,
  array_to_string(list_sort(list_distinct(flatten(list_transform(list_concat(titles, paragraphs), lambda t: {_NUMS.format('t')})))), ',') AS figure_nums FROM m""",
    "claims_first": f"{_META} SELECT xml_path, first_claim, length(claims)::INT AS claims_chars FROM m",
    "claims_method": f"{_META} SELECT xml_path, method_claim FROM m",
    "claims_independent": f"{_META} SELECT xml_path, n_claims, n_independent FROM m",
    "claims_source": f"{_META} SELECT xml_path, coalesce(CASE WHEN {_FLOW} = 'flowchart' THEN nullif(method_claim, '') END, nullif(first_claim, ''), nullif(claims, ''), '') AS claims_subset FROM m",
    "text_sections": f"""{_META} SELECT xml_path, 'caption' AS section, array_to_string(titles, chr(10)) AS content FROM m
UNION ALL SELECT xml_path, 'paragraph', array_to_string(paragraphs, chr(10)) FROM m UNION ALL SELECT xml_path, 'claim', claims FROM m""",
    "p6_found": f"WITH {with_claims('SELECT DISTINCT xml_path AS k, body FROM xml_files')} SELECT k AS xml_path, claim_no::INT AS claim_no, node_no::INT AS node_no, parent_no::INT AS parent_no FROM part",
    "p6_documents": f"""WITH {elements(_NAMED)},
one_ AS (SELECT k, {", ".join(f"arg_min(said, e.i) FILTER (e.name = '{n}'{w}) AS {c}" for c, n, w in (("title", "invention-title", ""), *((c, n, " AND contains(e.above, '/document-id/')") for c, n in (("country", "country"), ("doc_number", "doc-number"), ("kind", "kind")))))} FROM el e JOIN said USING (k, i) GROUP BY 1),
root AS (SELECT k, name AS root, {attribute('lang')} AS lang, {attribute('file')} AS file FROM el e WHERE d = 1)
SELECT g.k AS xml_path, CASE WHEN NOT ok THEN 'not well-formed' END AS error, root, lang, file, title, country, doc_number, kind FROM good g LEFT JOIN root USING (k) LEFT JOIN one_ USING (k)""",
    "p6_figures": f"""WITH {elements(_NAMED)},
f AS (SELECT k, i, upto, tok, row_number() OVER (PARTITION BY k ORDER BY i) AS figure_no FROM el WHERE name = 'figure')
SELECT f.k AS xml_path, figure_no::INT AS figure_no, {attribute('num', 'f.tok')} AS num,
  (SELECT arg_min({attribute('file')}, e.i) FROM el e WHERE e.k = f.k AND e.i > f.i AND e.upto < f.upto AND e.name = 'img' AND {attribute('file')} IS NOT NULL) AS img,
  (SELECT arg_min(said, e.i) FROM el e JOIN said s ON s.k = e.k AND s.i = e.i WHERE e.k = f.k AND e.i > f.i AND e.upto < f.upto AND e.name IN ('figcaption', 'caption', 'p')) AS caption FROM f""",
    "p6_paragraphs": f"""WITH {elements(_NAMED)}
SELECT k AS xml_path, (row_number() OVER (PARTITION BY k ORDER BY e.i))::INT AS paragraph_no, {attribute('id')} AS id, {attribute('num')} AS num, said AS content FROM el e JOIN said USING (k, i) WHERE {_PARAGRAPH}""",
    "p6_claims": f"WITH {with_claims(_NAMED)} SELECT k AS xml_path, claim_no::INT AS claim_no, {attribute('id', 'c.tok')} AS id, {attribute('claim-type', 'c.tok')} AS claim_type, said AS content FROM claim c JOIN said USING (k, i)",
    "p6_claim_parts": f"WITH {with_claims(_NAMED)} SELECT k AS xml_path, claim_no::INT AS claim_no, node_no::INT AS node_no, parent_no::INT AS parent_no, {attribute('id', 'p.tok')} AS id, said AS content FROM part p JOIN said USING (k, i)",
    "p6_tables": f"""WITH {with_claims(_NAMED)}
SELECT 'documents' AS name, count(*) AS n_rows FROM good UNION ALL SELECT 'figures', count(*) FROM el WHERE name = 'figure' UNION ALL SELECT 'paragraphs', count(*) FROM el e WHERE {_PARAGRAPH}
UNION ALL SELECT 'claims', count(*) FROM claim UNION ALL SELECT 'claim_parts', count(*) FROM part""",
}
