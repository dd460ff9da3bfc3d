"""The queries over made bundles, stores and pages as SQL: what goes in must come out."""

from __future__ import annotations

from figloom.oracle import _FILE_TOKEN, _KEY, _NUMS, _STEM, _label, path
from figloom.oracle_xml import _META
from figloom.queries_made import BATCH, FIRST, SHRUNK

_MEMBERS = rf"""
x AS (SELECT {path('xml_path')} AS p, md5(coalesce(body, '')) AS hash FROM (SELECT *, row_number() OVER (PARTITION BY xml_path ORDER BY extracted_at DESC NULLS LAST, body DESC NULLS LAST) AS rn FROM xml_files) WHERE rn = 1),
t AS (SELECT p, hash FROM (SELECT {path('path')} AS p, md5(coalesce(payload, ''::BLOB)) AS hash, row_number() OVER (PARTITION BY {path('path')} ORDER BY written_at DESC NULLS LAST, file_id DESC) AS rn FROM page_files WHERE kind = 'tiff' AND path <> '') WHERE rn = 1),
m AS MATERIALIZED (
  SELECT {_KEY.format("regexp_extract(p, '([^/]+)/[^/]+$', 1)")} AS k, regexp_extract(p, '([^/]+)$', 1) AS name, hash, regexp_matches(lower(p), '\.xml$') AS is_xml FROM (FROM x UNION ALL FROM t) WHERE regexp_matches(lower(p), '\.(xml|tiff?)$')),
d AS MATERIALIZED (SELECT k, count(*) FILTER (is_xml) AS n_xml, count(*) FILTER (NOT is_xml) AS n_tiffs FROM m GROUP BY 1 HAVING bool_or(is_xml)),
good AS (SELECT k FROM d WHERE n_xml = 1 AND n_tiffs > 0)"""
_AT = "'data/work/extracted/' || k || '/' || name"


def _last(table: str, keys: str, at: str, order: str) -> str:
    late = f"coalesce({at} >= TIMESTAMP '{BATCH}', true)"
    return f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {late} DESC, {order}) AS rn FROM {table}) WHERE rn = 1"


_FIGURES = ", ".join(f"{c} DESC NULLS LAST" for c in ("doc_id", "tiff_path", "fig_label", "bbox_x1", "bbox_y1", "bbox_x2", "bbox_y2"))
_NEWEST = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY recorded_at DESC NULLS LAST, {_FIGURES}) AS rn FROM figures) WHERE rn = 1"


def _integrity(where: str) -> str:
    return f"""
WITH gone AS (SELECT DISTINCT doc_id FROM docs WHERE removed_at IS NOT NULL AND doc_id IS NOT NULL),
d AS (SELECT DISTINCT doc_id FROM docs WHERE {where}), f AS (SELECT DISTINCT id FROM figures), l AS ({_last('figures', 'id', 'recorded_at', _FIGURES)}), t AS (SELECT DISTINCT doc_id, section FROM text_fts WHERE {where})
SELECT 'docs' AS relname, count(*) AS n_rows, 0::BIGINT AS n_orphans FROM d
UNION ALL SELECT 'figures', count(*), count(*) FILTER (doc_id IS NULL OR doc_id NOT IN (FROM (SELECT doc_id FROM d WHERE doc_id IS NOT NULL))) FROM l WHERE {where}
UNION ALL SELECT 'text_fts', count(*), count(*) FILTER (doc_id IS NULL OR doc_id NOT IN (FROM (SELECT doc_id FROM d WHERE doc_id IS NOT NULL))) FROM t"""


SQL = {
    "bundle_scan": f"WITH {_MEMBERS} SELECT k AS doc_key FROM d",
    "bundle_members": f"WITH {_MEMBERS} SELECT k AS doc_id, n_xml::INT AS n_xml, n_tiffs::INT AS n_tiffs, n_xml = 1 AS is_bundle FROM d",
    "bundle_extract": f"WITH {_MEMBERS} SELECT k AS doc_id, CASE WHEN is_xml THEN 'xml' ELSE 'tiff' END AS kind, name, hash FROM m JOIN good USING (k)",
    "bundle_index": f"WITH {_MEMBERS} SELECT k AS doc_id, max({_AT}) FILTER (is_xml) AS xml, string_agg({_AT}, '|' ORDER BY {_AT}) FILTER (NOT is_xml) AS tiffs FROM m JOIN good USING (k) GROUP BY 1",
    "bundle_incremental": f"WITH {_MEMBERS} SELECT k AS doc_id, n_tiffs::INT AS n_tiffs FROM d JOIN good USING (k) WHERE NOT md5(k) < '{FIRST}'",
    "store_integrity": _integrity("true"),
    "store_deleted": _integrity("coalesce(doc_id NOT IN (FROM gone), true)").replace("FROM d WHERE doc_id", "FROM d WHERE doc_id"),
    "store_figures": f"SELECT id, doc_id, tiff_path, fig_label, bbox_x1, bbox_y1, bbox_x2, bbox_y2 FROM ({_last('figures', 'id', 'recorded_at', _FIGURES)})",
    "store_cleared": "SELECT unnest(['docs', 'figures', 'text_fts']) AS relname, 0::BIGINT AS n_rows",
    "json_rows": "SELECT id, image_path, control_path, prompt, source_xml, doc_id, sha256, array_to_string(bbox, ',') AS bbox, round(resize_meta.scale, 9) AS scale, fig_label, label_in_xml FROM train",
    "resolved_paths": f"""
WITH there AS (SELECT DISTINCT {path('path')} AS p FROM page_files WHERE kind = 'image' AND path <> ''), r AS (SELECT DISTINCT image_path AS i FROM train WHERE image_path IS NOT NULL)
SELECT i AS image_path, CASE WHEN starts_with(i, '/') THEN i WHEN '/srv/elsewhere/' || i IN (FROM there) THEN '/srv/elsewhere/' || i WHEN '/srv/drawings/' || i IN (FROM there) THEN '/srv/drawings/' || i ELSE '/srv/elsewhere/' || i END AS resolved FROM r""",
    "page_images": f"""
SELECT id AS page_id, CASE WHEN w * h > 0 THEN w END AS width, CASE WHEN w * h > 0 THEN h END AS height, CASE WHEN w * h > 0 THEN ((w // 2) * (h // 2))::INT END AS n_ink
FROM (SELECT id, (greatest(bbox_x2, 0) // {SHRUNK})::INT AS w, (greatest(bbox_y2, 0) // {SHRUNK})::INT AS h FROM ({_NEWEST}) WHERE id IS NOT NULL AND bbox_x2 IS NOT NULL AND bbox_y2 IS NOT NULL)""",
    "page_export": f"""
SELECT id AS page_id, {_STEM.format('id')} || '_FIG_' || coalesce({_label('fig_label')}, '1') || '.png' AS name, true AS written FROM ({_NEWEST})
WHERE id IS NOT NULL AND greatest(bbox_x2, 0) // {SHRUNK} > 0 AND greatest(bbox_y2, 0) // {SHRUNK} > 0""",
    "page_labels": f"""
SELECT tiff_path, count(DISTINCT num) <= 1 AS kept, CASE WHEN count(DISTINCT num) = 1 THEN 'FIG. ' || min(num) END AS label
FROM (SELECT tiff_path, {_label('fig_label')} AS num FROM figures WHERE tiff_path IS NOT NULL) GROUP BY 1""",
    "dataset_rows": f"""{_META},
n AS (SELECT xml_path, {_KEY.format("regexp_extract(xml_path, '([^/]+)/[^/]+$', 1)")} AS k, list_distinct(flatten(list_transform(list_concat(titles, paragraphs), lambda t: {_NUMS.format('t')}))) AS nums FROM m),
f AS (SELECT {_KEY.format('doc_id')} AS k, tiff_path, fig_label, {_label('fig_label')} AS num FROM ({_NEWEST}) WHERE tiff_path IS NOT NULL AND NOT regexp_matches(upper(tiff_path), 'D00000\\.TIFF?$')),
r AS (SELECT f.*, xml_path, f.k || '_' || {_STEM.format('tiff_path')} || '_' || {_FILE_TOKEN.format('fig_label')} AS name FROM f JOIN n USING (k) WHERE num IS NOT NULL AND list_contains(nums, num))
SELECT k || ':' || name || '.png' AS id, 'data/work/images/' || name || '.png' AS image_path, 'data/work/control/' || name || '_canny.png' AS control_path, xml_path AS source_xml, k AS doc_id, fig_label, tiff_path AS tiff_source, true AS label_in_xml FROM r""",
}
