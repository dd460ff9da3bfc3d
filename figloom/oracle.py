"""The core queries as SQL that DuckDB runs on the same tables."""

from __future__ import annotations

from figloom.functions import vocabulary as V

#: A word boundary where the pattern's end is a word character, with Unicode letters, for RE2.
_LEFT, _RIGHT = r"(?:^|[^\p{L}\p{N}\p{M}_])", r"(?:$|[^\p{L}\p{N}\p{M}_])"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


class _T(str):
    """SQL with ``@`` where an expression goes."""

    def format(self, expression: str) -> str:
        return str(self).replace("@", expression)


_KEY = _T("regexp_replace(upper(@), '[^A-Z0-9]', '', 'g')")
_BLANKS = _q(V.BLANK + "+")
_CLEAN = _T(f"trim(regexp_replace(coalesce(@, ''), {_BLANKS}, ' ', 'g'), ' ')")
_STEM = _T(r"regexp_replace(regexp_extract(@, '([^/]*)$', 1), '^(.+)\.[^.]*$', '\1')")


def _canonical(raw: str) -> str:
    return rf"CASE WHEN regexp_full_match({raw}, '0*[0-9]{{1,4}}[A-Z]{{0,2}}(-0*[0-9]{{1,4}}[A-Z]{{0,2}})?') THEN regexp_replace(regexp_replace({raw}, '^0+([0-9])', '\1'), '-0+([0-9])', '-\1') ELSE '' END"


def _label(c: str) -> str:
    rest = f"CASE WHEN contains(upper({c}), 'FIGURE') THEN regexp_extract(upper({c}), '(?s)FIGURE(.*)$', 1) WHEN contains(upper({c}), 'FIG') THEN regexp_extract(upper({c}), '(?s)FIG(.*)$', 1) END"
    bare = f"regexp_replace(translate({rest}, '.:/', '   '), '^[ .:_-]+|[ .:_-]+$', '', 'g')"
    return f"nullif({_canonical(f"replace(upper(trim({bare}, ' ')), ' ', '')")}, '')"


def _class(c: str) -> str:
    text = f"lower({_CLEAN.format(c)})"
    cases = " ".join(f"WHEN regexp_matches({text}, {_q(_LEFT + '(?:' + words.replace('vs' + chr(92) + '.', 'vs' + chr(92) + '.' + '[a-z0-9_]') + ')' + _RIGHT)}) THEN '{name}'" for name, words in V.CLASSES)
    return f"CASE {cases} ELSE '{V.OTHER_CLASS}' END"


_VIEW = _T(f"coalesce(nullif(lower(regexp_extract({_CLEAN.format('@')}, {_q('(?i)' + _LEFT + '(' + V.VIEWS + ')' + _RIGHT)}, 1)), ''), '{V.UNKNOWN}')")
_TOKEN = r"regexp_replace(translate(regexp_replace(coalesce(@, ''), '[^\p{L}\p{N} .\-/]', '', 'g'), ' .-/', '____'), '^_+|_+$', '', 'g')"
_FILE_TOKEN = _T("CASE WHEN " + _TOKEN + " = '' THEN 'UNLABELED' ELSE " + _TOKEN + " END")
_NUMS = _T("list_distinct(list_transform(regexp_extract_all(@, '(?i)" + _LEFT + r"FIG(?:\.|URE)?\s*\.?[-\s]*([0-9]{1,3}[A-Za-z]?)\b', 1), lambda x: upper(x)))")
_KEYWORD = (
    "w NOT IN (" + ", ".join(map(_q, V.KEYWORD_STOPS)) + ") AND length(w) > 2 AND NOT regexp_matches(w, " + _q("^(?:" + "|".join(V.KEYWORD_STARTS) + ")") + ") AND NOT ends_with(w, 'ing')"
)
_LATEST = "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM {table}) WHERE rn = 1"
_ABSOLUTE = (
    r"CASE WHEN starts_with(lower({c}), 'file:') THEN regexp_replace({c}, '(?i)^file:(//[^/]*)?/', '/') WHEN starts_with({c}, '/') THEN {c} ELSE '/srv/drawings/' || {c} END"
)


def path(c: str) -> str:
    """The canonical path: a fold over the parts."""
    parts = f"list_reduce(string_split({_ABSOLUTE.format(c=c)}, '/'), lambda a, p: CASE WHEN p IN ('', '.') THEN a WHEN p = '..' THEN regexp_replace(a, '/[^/]*$', '') ELSE a || '/' || p END, '')"
    return f"CASE WHEN {c} <> '' THEN {parts} END"


_FAMILY = "CASE WHEN regexp_full_match(upper(regexp_replace(family_id, '[^\\p{L}\\p{N}]', '', 'g')), 'F[0-9]+') THEN upper(regexp_replace(family_id, '[^\\p{L}\\p{N}]', '', 'g')) END"

SQL = {
    "document_profile": f"""
WITH k AS (
  SELECT doc_id, w, count(*) AS n, min(p) AS f FROM (
    SELECT doc_id, lower(unnest(l)) AS w, generate_subscripts(l, 1) AS p FROM (SELECT doc_id, regexp_extract_all({_CLEAN.format('text')}, '[A-Za-z][A-Za-z\\-]+') AS l FROM documents))
  WHERE {_KEYWORD} GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, f) AS rn FROM k),
t AS (SELECT doc_id, string_agg(w, ', ' ORDER BY rn) AS keywords FROM r WHERE rn <= 14 GROUP BY 1)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN '' ELSE array_to_string(list_sort({_NUMS.format('d.text')}), ',') END AS figure_nums, {_class('d.text')} AS diagram_class, {_VIEW.format('d.text')} AS view, t.keywords
FROM documents d LEFT JOIN t USING (doc_id)""",
    "doc_id_norm": f"SELECT xml, {_KEY.format(_STEM.format('xml'))} AS doc_key FROM docs",
    "filename_token": f"SELECT id, {_FILE_TOKEN.format('fig_label')} AS token FROM figures",
    "canonical_fig": f"SELECT id, fig_label, {_label('fig_label')} AS fig_num FROM figures",
    "clean_ws": f"SELECT doc_id, {_CLEAN.format('text')} AS cleaned FROM documents",
    "plain_dashes": f"SELECT id, translate(fig_label, {_q(V.DASHES)}, '{'-' * len(V.DASHES)}') AS label FROM figures",
    "fig_numbers": f"SELECT doc_id, section, array_to_string(list_sort(list_distinct(flatten(list_transform(string_split(coalesce(content, ''), chr(10)), lambda t: {_NUMS.format('t')})))), ',') AS nums FROM (SELECT DISTINCT * FROM text_fts)",
    "diagram_class": f"SELECT doc_id, section, {_class('content')} AS diagram_class FROM text_fts",
    "class_counts": f"SELECT section, {_class('content')} AS diagram_class, count(*) AS n FROM text_fts GROUP BY 1, 2",
    "view_cue": f"SELECT doc_id, section, {_VIEW.format('content')} AS view FROM text_fts",
    "keywords_topk": f"""
WITH k AS (
  SELECT doc_id, w, count(*) AS n, min(p) AS f FROM (
    SELECT doc_id, lower(unnest(l)) AS w, generate_subscripts(l, 1) AS p FROM (SELECT doc_id, regexp_extract_all({_CLEAN.format('text')}, '[A-Za-z][A-Za-z\\-]+') AS l FROM documents))
  WHERE {_KEYWORD} GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, f) AS rn FROM k)
SELECT doc_id, string_agg(w, ', ' ORDER BY rn) AS keywords FROM r WHERE rn <= 14 GROUP BY 1""",
    "sentences": r"""
SELECT doc_id, section, (row_number() OVER (PARTITION BY doc_id, section, content ORDER BY i) - 1)::INT AS no, sentence FROM (
  SELECT doc_id, section, content, i, trim(s[i], ' ') AS sentence FROM (
    SELECT *, unnest(generate_series(1, len(s))) AS i FROM (
      SELECT *, string_split(regexp_replace(regexp_replace(content, '([.;:])[ \t\n\x0b\f\r]+', '\1' || chr(1), 'g'), '\n+', chr(1), 'g'), chr(1)) AS s FROM (SELECT DISTINCT * FROM text_fts) WHERE content IS NOT NULL)))
WHERE sentence <> ''""",
    "figure_display": "SELECT id, trim(replace(replace(coalesce(fig_label, '{unknown}'), 'FIGURE', 'FIG.'), 'FIG ', 'FIG. '), ' ') AS shown FROM figures",
    "shortened": f"SELECT doc_id, CASE WHEN length({_CLEAN.format('text')}) > 360 THEN left({_CLEAN.format('text')}, 359) || '…' ELSE {_CLEAN.format('text')} END AS short FROM documents",
    "figures_upsert": _LATEST.format(
        table="figures", keys="id",
        order=", ".join(f"{c} DESC NULLS LAST" for c in ("recorded_at", "doc_id", "tiff_path", "fig_label", "bbox_x1", "bbox_y1", "bbox_x2", "bbox_y2")),
    ),
    "docs_incremental": f"SELECT DISTINCT {_KEY.format('doc_id')} AS doc_key FROM figures WHERE doc_id IS NOT NULL AND {_KEY.format('doc_id')} NOT IN (SELECT {_KEY.format('doc_id')} FROM docs WHERE doc_id IS NOT NULL)",
    "cascade_delete": f"SELECT doc_id, section, length(content)::INT AS n_chars FROM text_fts WHERE coalesce({_KEY.format('doc_id')}, '-') NOT IN (SELECT {_KEY.format('doc_id')} FROM docs WHERE doc_id IS NOT NULL GROUP BY 1 HAVING bool_and(removed_at IS NOT NULL))",
    "doc_pages": r"SELECT doc_id, page_no, tiff FROM (SELECT doc_id, (generate_subscripts(tiffs, 1) - 1)::INT AS page_no, unnest(tiffs) AS tiff FROM docs) WHERE tiff IS NOT NULL AND NOT regexp_matches(upper(tiff), 'D00000\.TIFF?$')",
    "doc_page_match": f"""
SELECT f.id, f.doc_key, f.fig_num FROM (SELECT id, {_KEY.format('doc_id')} AS doc_key, {_label('fig_label')} AS fig_num FROM figures) f
WHERE (f.doc_key, f.fig_num) IN (SELECT ({_KEY.format('doc_id')}, unnest({_NUMS.format('content')})) FROM text_fts WHERE section = 'caption' AND content IS NOT NULL)""",
    "doc_overview": "SELECT doc_id, xml, coalesce(len(tiffs), 0)::INT AS tiff_count FROM docs",
    "top_documents": f"SELECT {_KEY.format('doc_id')} AS doc_key, count(*) AS n_figures FROM figures GROUP BY 1 ORDER BY n_figures DESC, doc_key NULLS LAST LIMIT 10",
    "table_counts": " UNION ALL ".join(f"SELECT '{t}' AS relname, count(*) AS n_rows FROM {t}" for t in ("docs", "figures", "text_fts")),
    "integrity": "SELECT 'docs' AS relname, count(*) AS n_rows, 0::BIGINT AS n_orphans FROM docs"
    + "".join(f" UNION ALL SELECT '{t}', count(*), count(*) FILTER (d.doc_id IS NULL) FROM {t} c LEFT JOIN (SELECT DISTINCT {_KEY.format('doc_id')} AS doc_id FROM docs) d ON {_KEY.format('c.doc_id')} = d.doc_id" for t in ("figures", "text_fts")),
    "letterbox_meta": """
SELECT id, CASE WHEN ok THEN w END AS orig_width, CASE WHEN ok THEN h END AS orig_height, CASE WHEN ok THEN nw END AS resized_width, CASE WHEN ok THEN nh END AS resized_height,
  CASE WHEN ok THEN floor((2048 - nw) / 2)::INT END AS offset_x, CASE WHEN ok THEN floor((2048 - nh) / 2)::INT END AS offset_y, CASE WHEN ok THEN round(s, 9) END AS scale
FROM (SELECT *, greatest(1, round_even(w * s, 0)::INT) AS nw, greatest(1, round_even(h * s, 0)::INT) AS nh, w > 0 AND h > 0 AS ok
  FROM (SELECT id, w, h, least(1.0::DOUBLE, 2048::DOUBLE / greatest(w, h)) AS s FROM (SELECT id, original_size[1] AS w, original_size[2] AS h FROM train)))""",
    "bbox_union": f"SELECT {_KEY.format('doc_id')} AS doc_key, min(bbox_x1) AS x1, min(bbox_y1) AS y1, max(bbox_x2) AS x2, max(bbox_y2) AS y2 FROM figures GROUP BY 1",
    "page_label_filter": f"SELECT tiff_path, 'FIG. ' || min(n) AS fig_label FROM (SELECT tiff_path, {_label('fig_label')} AS n FROM figures WHERE tiff_path IS NOT NULL) GROUP BY 1 HAVING count(DISTINCT n) <= 1",
    "content_hash": "SELECT file_id, sha256(payload) AS computed FROM page_files",
    "family_label": f"""
SELECT DISTINCT doc_id, CASE WHEN t < 8 THEN 'train' WHEN t = 8 THEN 'validation' ELSE 'test' END AS split
FROM (SELECT doc_id, ('0x' || left(sha256(coalesce({_FAMILY}, {_KEY.format('doc_id')})), 8))::BIGINT % 10 AS t FROM docs)""",
    "fts_index": f"""
SELECT w AS term, doc_id, section, count(*) AS n, (min(p) - 1)::INT AS first_position FROM (
  SELECT doc_id, section, unnest(l) AS w, generate_subscripts(l, 1) AS p FROM (SELECT doc_id, section, regexp_extract_all(lower(content), '[\\p{{L}}\\p{{N}}]+') AS l FROM (SELECT DISTINCT * FROM text_fts) WHERE content IS NOT NULL))
WHERE w NOT IN ({', '.join(map(_q, V.INDEX_STOPS))}) GROUP BY 1, 2, 3""",
    "fts_search": r"""
SELECT doc_id, section, count(*) AS score FROM (
  SELECT doc_id, section, unnest(regexp_extract_all(lower(content), '[\p{L}\p{N}]+')) AS w FROM (SELECT DISTINCT * FROM text_fts) WHERE content IS NOT NULL)
WHERE w IN ('gear', 'valve') GROUP BY 1, 2 HAVING count(DISTINCT w) = 2""",
    "json_lists": "SELECT doc_id, indexed_at, coalesce(array_to_string(list_filter(tiffs, lambda x: x IS NOT NULL), '|'), '') AS pages FROM docs",
    "caption_pairs": r"SELECT DISTINCT image_path, regexp_replace(regexp_extract(image_path, '([^/]*)$', 1), '^(.+)\.[^.]*$', '\1') || '.txt' AS caption_path, prompt AS caption FROM train WHERE trim(image_path, ' ') <> '' AND trim(prompt, ' ') <> ''",
    "tab_lines": "SELECT coalesce(applicant_id, '') || chr(9) || coalesce(applicant_name, '') || chr(9) || coalesce(country, '') AS line FROM applicants",
    "run_summary": "SELECT (SELECT count(DISTINCT doc_id) FROM docs) AS n_docs, (SELECT coalesce(sum(len(tiffs)), 0)::BIGINT FROM docs) AS n_pages, (SELECT count(*) FROM figures) AS n_figures",
    "row_paths": f"""
SELECT k || ':' || name || '.png' AS row_id, 'data/work/control/' || name || '_canny.png' AS control_path
FROM (SELECT {_KEY.format('doc_id')} AS k, {_KEY.format('doc_id')} || '_' || {_STEM.format('tiff_path')} || '_' || {_FILE_TOKEN.format('fig_label')} AS name FROM figures WHERE tiff_path IS NOT NULL AND doc_id IS NOT NULL)""",
    "p1_found": f"""
SELECT file_id FROM (SELECT file_id, row_number() OVER (PARTITION BY {path('path')} ORDER BY written_at DESC NULLS LAST, file_id DESC) AS rn FROM page_files WHERE path <> '') WHERE rn > 1""",
    "p1_compacted": "SELECT file_id, path, kind, applicant_id, n_bytes, sha256, sha256(payload) AS computed, written_at, removed_at FROM page_files",
    "p1_named": f"""
WITH n AS (SELECT DISTINCT field, {path('p')} AS path FROM (
  SELECT 'train.image_path' AS field, image_path AS p FROM train UNION ALL SELECT 'train.control_path', control_path FROM train UNION ALL SELECT 'docs.tiffs', unnest(tiffs) FROM docs) WHERE p <> ''),
h AS (SELECT DISTINCT {path('path')} AS path FROM page_files WHERE path <> '')
SELECT field, count(*) AS n_paths, count(h.path) AS n_here FROM n LEFT JOIN h ON n.path = h.path GROUP BY 1""",
    "p4_found": f"""
WITH f AS (SELECT id, {_KEY.format('doc_id')} AS k, doc_id, tiff_path, {path('tiff_path')} AS p, recorded_at AS at FROM figures),
d AS (SELECT {_KEY.format('doc_id')} AS k, indexed_at AS a, removed_at AS b, tiffs FROM docs),
t AS (SELECT k, a, b, {path('p')} AS p FROM (SELECT k, a, b, unnest(tiffs) AS p FROM d) WHERE p <> ''),
i AS (SELECT {path('path')} AS p, written_at AS a, removed_at AS b FROM page_files WHERE kind = 'image' AND path <> '')
SELECT DISTINCT 'figures' AS ref_table, 'doc_id' AS ref_field, id AS ref_key FROM f WHERE doc_id IS NOT NULL AND NOT EXISTS (FROM d WHERE d.k = f.k AND d.a <= f.at AND (d.b IS NULL OR f.at < d.b))
UNION SELECT DISTINCT 'figures', 'tiff_path', id FROM f WHERE tiff_path IS NOT NULL AND NOT EXISTS (FROM t WHERE t.k = f.k AND t.p = f.p AND t.a <= f.at AND (t.b IS NULL OR f.at < t.b))
UNION SELECT DISTINCT 'train', 'image_path', id FROM (SELECT id, {path('image_path')} AS p, recorded_at AS at FROM train WHERE image_path IS NOT NULL) r WHERE NOT EXISTS (FROM i WHERE i.p = r.p AND i.a <= r.at AND (i.b IS NULL OR r.at < i.b))""",
    "p1_bundles": f"""
WITH w AS (SELECT *, row_number() OVER (PARTITION BY coalesce({path('path')}, '?' || file_id) ORDER BY written_at DESC NULLS LAST, file_id DESC) AS rn FROM page_files),
k AS (SELECT applicant_id, file_id, octet_length(payload) AS n, greatest(coalesce(n_bytes, 0), 1) AS size FROM w WHERE rn = 1),
b AS (SELECT *, floor((sum(size) OVER (PARTITION BY applicant_id ORDER BY file_id) - size) / (SELECT amount FROM size_limits WHERE setting = 'bundle_bytes'))::INT AS bundle_no FROM k)
SELECT applicant_id, bundle_no, count(*)::INT AS n_files, sum(coalesce(n, 0))::BIGINT AS n_bytes FROM b GROUP BY 1, 2""",
    "p4_report": f"""
WITH f AS (SELECT id, {_KEY.format('doc_id')} AS k, doc_id, tiff_path, {_KEY.format('doc_id')} || '|' || {path('tiff_path')} AS p, recorded_at AS moment FROM figures),
d AS (SELECT {_KEY.format('doc_id')} AS key, indexed_at AS a, removed_at AS b, tiffs FROM docs),
refs AS (
  SELECT 'figures' AS ref_table, 'doc_id' AS ref_field, row_number() OVER () AS n, k AS key, moment FROM f WHERE doc_id IS NOT NULL
  UNION ALL SELECT 'figures', 'tiff_path', row_number() OVER (), p, moment FROM f WHERE tiff_path IS NOT NULL
  UNION ALL SELECT 'train', 'image_path', row_number() OVER (), {path('image_path')}, recorded_at FROM train WHERE image_path IS NOT NULL),
targets AS (
  SELECT 'doc_id' AS ref_field, key, a, b FROM d
  UNION ALL SELECT 'tiff_path', key || '|' || {path('p')}, a, b FROM (SELECT key, a, b, unnest(tiffs) AS p FROM d)
  UNION ALL SELECT 'image_path', {path('path')}, written_at, removed_at FROM page_files WHERE kind = 'image'),
j AS (
  SELECT ref_table, r.ref_field, n, any_value(r.moment) AS moment, min(t.a) AS first_from, bool_or(t.a <= r.moment AND (t.b IS NULL OR r.moment < t.b)) AS live
  FROM refs r LEFT JOIN targets t ON r.ref_field = t.ref_field AND r.key = t.key AND t.a IS NOT NULL GROUP BY 1, 2, 3),
w AS (SELECT *, CASE WHEN coalesce(live, false) THEN NULL WHEN first_from IS NULL THEN 'missing' WHEN first_from > moment THEN 'late' ELSE 'removed' END AS why FROM j)
SELECT ref_table, ref_field, strftime(moment, '%Y-%m') AS month, count(*) AS n_refs, count(why) AS n_orphans, count(*) FILTER (why = 'missing') AS n_missing, count(*) FILTER (why = 'late') AS n_late, count(*) FILTER (why = 'removed') AS n_removed
FROM w GROUP BY 1, 2, 3""",
    "p4_cascade": f"""
WITH RECURSIVE f AS MATERIALIZED (SELECT {_KEY.format('id')} AS key, {_KEY.format('doc_id')} AS k, doc_id, tiff_path, {path('tiff_path')} AS p, recorded_at AS moment FROM figures),
t AS MATERIALIZED (SELECT {_KEY.format('id')} AS key, {_KEY.format('doc_id')} AS k, image_path, {path('image_path')} AS p, recorded_at AS moment FROM train),
d AS MATERIALIZED (SELECT {_KEY.format('doc_id')} AS key, xml, {path('xml')} AS p, indexed_at AS a, removed_at AS b, tiffs FROM docs),
pages AS MATERIALIZED (SELECT key, a, b, {path('p')} AS p FROM (SELECT key, a, b, unnest(tiffs) AS p FROM d) WHERE p <> ''),
x AS MATERIALIZED (SELECT {path('xml_path')} AS p, extracted_at AS a FROM xml_files),
i AS MATERIALIZED (SELECT {path('path')} AS p, written_at AS a, removed_at AS b FROM page_files WHERE kind = 'image'),
direct AS MATERIALIZED (
  SELECT 'docs' AS tab, key, a AS moment FROM d WHERE xml IS NOT NULL AND NOT EXISTS (FROM x WHERE x.p = d.p AND x.a <= d.a)
  UNION ALL SELECT 'figures', key, moment FROM f WHERE doc_id IS NOT NULL AND NOT EXISTS (FROM d WHERE d.key = f.k AND d.a <= f.moment AND (d.b IS NULL OR f.moment < d.b))
  UNION ALL SELECT 'figures', key, moment FROM f WHERE tiff_path IS NOT NULL AND NOT EXISTS (FROM pages g WHERE g.key = f.k AND g.p = f.p AND g.a <= f.moment AND (g.b IS NULL OR f.moment < g.b))
  UNION ALL SELECT 'train', key, moment FROM t WHERE image_path IS NOT NULL AND NOT EXISTS (FROM i WHERE i.p = t.p AND i.a <= t.moment AND (i.b IS NULL OR t.moment < i.b))),
links AS MATERIALIZED (
  SELECT DISTINCT * FROM (
    SELECT 'figures' AS tab, key, moment, 'docs' AS parent_tab, k AS parent_key FROM f
    UNION ALL SELECT 'train', key, moment, 'docs', k FROM t
    UNION ALL SELECT 'train', key, moment, 'figures', key FROM t
    UNION ALL SELECT 'text_fts', {_KEY.format('doc_id')} || ':' || coalesce(section, ''), NULL, 'docs', {_KEY.format('doc_id')} FROM text_fts) WHERE key IS NOT NULL AND parent_key IS NOT NULL),
o AS (SELECT DISTINCT tab, key, 0 AS step FROM direct WHERE key IS NOT NULL UNION SELECT l.tab, l.key, o.step + 1 FROM o JOIN links l ON l.parent_tab = o.tab AND l.parent_key = o.key WHERE o.step < 9),
s AS MATERIALIZED (SELECT tab, key, min(step) AS step FROM o GROUP BY 1, 2),
rows AS (
  SELECT tab, strftime(moment, '%Y-%m') AS month, 0 AS step, key FROM direct
  UNION ALL SELECT l.tab, strftime(l.moment, '%Y-%m'), c.step, l.key FROM links l JOIN s c ON c.tab = l.tab AND c.key = l.key JOIN s p ON p.tab = l.parent_tab AND p.key = l.parent_key WHERE c.step > 0 AND p.step = c.step - 1)
SELECT tab, month, step, CASE WHEN step = 0 THEN 'direct' ELSE 'inherited' END AS orphan_kind, count(DISTINCT key) AS n_records FROM rows GROUP BY 1, 2, 3""",
}
