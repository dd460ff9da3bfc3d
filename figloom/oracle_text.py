"""The text analysis as SQL: figure texts, relations, reference numerals and prompts, by tokens and their places."""

from __future__ import annotations

from figloom.functions import vocabulary as V
from figloom.oracle import _CLEAN, _KEY, _KEYWORD, _T as _T_, _VIEW, _canonical, _class, _label, _q
from figloom.plans.pipeline import KEYWORDS, TEMPLATE

_REF = r"(?i)\bFIG(?:\.|URE)?\s*\.?[-\s]*([0-9]{1,3}[A-Za-z]?)\b"


def _in(words) -> str:
    return "(" + ", ".join(map(_q, sorted(words))) + ")"


def _lead(words: str, stops) -> str:
    """The list without the words of ``stops`` at its beginning."""
    return f"list_slice({words}, coalesce(nullif(list_position(list_transform({words}, lambda z: lower(z) IN {_in(stops)}), false), 0), len({words}) + 1), len({words}))"


def _tail(words: str, stops) -> str:
    return f"list_reverse({_lead(f'list_reverse({words})', stops)})"


def _distinct(words: str) -> str:
    """Distinct, in order of first occurrence."""
    return f"list_filter({words}, lambda x_, i_: list_position({words}, x_) = i_)"


def _tokens(name: str, of: str, text: str, rx: str) -> str:
    """A table ``name`` (id, j, word, s, e) of the tokens of ``of`` (id, text), with 0-based places; ``rx``: SQL."""
    return f"""
{name}_ AS (SELECT id, unnest(list_concat(regexp_extract_all({text}, {rx}), [''])) AS word, unnest(string_split_regex({text}, {rx})) AS gap, generate_subscripts(string_split_regex({text}, {rx}), 1) AS j FROM {of}),
{name} AS MATERIALIZED (SELECT id, j, word, (sum(length(gap)) OVER w + coalesce(sum(length(word)) OVER v, 0))::INT AS s, (sum(length(gap)) OVER w + sum(length(word)) OVER w)::INT AS e FROM {name}_
  WINDOW w AS (PARTITION BY id ORDER BY j), v AS (PARTITION BY id ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) QUALIFY word <> '')"""


def _side(name: str, left: bool, hit: str, near: str, gap: str, stop: str, skip, most: int) -> str:
    """A table ``name`` (h, words): up to ``most`` tokens beside each row h of ``hit`` (h, id, s, e), outwards, until one is broken by ``stop``."""
    rank = "t.j DESC" if left else "t.j"
    return f"""
{name}_c AS (SELECT h, t.j, t.word, row_number() OVER (PARTITION BY h ORDER BY {rank}) AS r, {gap} AS gap FROM {hit} m JOIN {near} t ON t.id = m.id AND {'t.e <= m.s' if left else 't.s >= m.e'} WINDOW g AS (PARTITION BY h ORDER BY t.j)),
{name}_k AS (SELECT h, j, word, row_number() OVER (PARTITION BY h ORDER BY r) AS q FROM (SELECT *, min(CASE WHEN {stop} THEN r END) OVER (PARTITION BY h) AS broken FROM {name}_c) WHERE r < coalesce(broken, r + 1) AND lower(word) NOT IN {_in(skip)}),
{name} AS (SELECT h, list(word ORDER BY j) AS words FROM {name}_k WHERE q <= {most} GROUP BY 1)"""


_GAP_LEFT = "substring(m.text, t.e + 1, coalesce(lead(t.s) OVER g, m.s) - t.e)"
_GAP_RIGHT = "substring(m.text, coalesce(lag(t.e) OVER g, m.e) + 1, t.s - coalesce(lag(t.e) OVER g, m.e))"


def _relations(of: str) -> str:
    """A table ``related`` (n, relations) for ``of`` (n, t): t is cleaned text."""
    stop = f"lower(word) IN {_in(V.CLAUSE_BREAKS | V.RELATION_BOUNDS)} OR regexp_matches(gap, '[.;:?!\\n()\\[\\]]')"
    kinds = ", ".join(f"({i}, {_q(label)}, {_q(stem)}, {_q('(?i)' + rx)})" for i, (label, stem, rx) in enumerate(V.RELATIONS))
    inner = _tail(_lead("string_split(p, ' ')", V.LEADING_FILLERS), V.TRAILING_FILLERS)

    def things(phrase: str) -> str:
        parts = rf"list_filter(list_transform(string_split_regex({phrase}, '\b(?:and|or)\b'), lambda p: trim(p, ' ,')), lambda p: p <> '')"
        bare = f"list_filter(list_transform({parts}, lambda p: array_to_string({inner}, ' ')), lambda p: p <> '')"
        return f"CASE WHEN len(string_split({phrase}, ' ')) > 2 AND len({parts}) IN (2, 3) AND regexp_matches({phrase}, '[0-9]') AND len({bare}) > 0 THEN {bare} ELSE [{phrase}] END"

    def stripped(side: str) -> str:
        one = _tail(_lead(f"coalesce({side}.words, [])", V.LEADING_FILLERS), V.TRAILING_FILLERS)
        return one

    phrases = "(?i)" + "|".join(rf"\b{p}\b" for p in V.RELATION_PHRASES)
    found = f"list_transform(regexp_extract_all(t, {_q(phrases)}), lambda x: lower(x))"
    return f"""
cut AS (SELECT n, unnest(string_split_regex(regexp_replace(t, '([.;:])\\s+', '\\1' || chr(1), 'g'), chr(1))) AS text, generate_subscripts(string_split_regex(regexp_replace(t, '([.;:])\\s+', '\\1' || chr(1), 'g'), chr(1)), 1) AS s_no FROM {of}),
sent AS MATERIALIZED (SELECT row_number() OVER () AS id, n, s_no, trim(text) AS text FROM cut WHERE trim(text) <> ''),
kinds(k, label, stem, rx) AS (VALUES {kinds}),
hits_ AS (SELECT id, n, s_no, text, k, label, unnest(regexp_extract_all(text, rx)) AS m, unnest(string_split_regex(text, rx)[1:-2]) AS gap, generate_subscripts(regexp_extract_all(text, rx), 1) AS i FROM sent JOIN kinds ON contains(lower(text), stem)),
hits AS MATERIALIZED (SELECT row_number() OVER () AS h, * EXCLUDE (gap), (sum(length(gap)) OVER w + sum(length(m)) OVER w - length(m))::INT AS s, (sum(length(gap)) OVER w + sum(length(m)) OVER w)::INT AS e FROM hits_ WINDOW w AS (PARTITION BY id, k ORDER BY i)),
told AS (SELECT * FROM sent WHERE id IN (SELECT id FROM hits)),{_tokens("toks", "told", "text", "'[A-Za-z0-9]+(?:[-/][A-Za-z0-9]+)*'")},{_side("lefts", True, "hits", "toks", _GAP_LEFT, stop, V.AUXILIARIES, 8)},{_side("rights", False, "hits", "toks", _GAP_RIGHT, stop, V.AUXILIARIES, 8)},
bare_sides AS (SELECT m.*, {stripped('a')} AS l1, {stripped('b')} AS r1 FROM hits m LEFT JOIN lefts a USING (h) LEFT JOIN rights b USING (h)),
sides AS (SELECT *, array_to_string({_tail(_lead('l1', V.RELATION_STOPS), V.RELATION_STOPS)}, ' ') AS lp, array_to_string({_tail(_lead('r1', V.RELATION_STOPS), V.RELATION_STOPS)}, ' ') AS rp FROM bare_sides),
parts AS (SELECT *, {things('lp')} AS ls, {things('rp')} AS rs FROM sides WHERE lp <> '' OR rp <> ''),
pairs AS (SELECT *, unnest(rs) AS b, generate_subscripts(rs, 1) AS bi FROM (SELECT *, unnest(ls) AS a, generate_subscripts(ls, 1) AS ai FROM parts)),
said AS (SELECT n, row_number() OVER (PARTITION BY n ORDER BY s_no, k, i, ai, bi) AS o, CASE WHEN a = '' THEN '' ELSE a || ' ' END || label || CASE WHEN b = '' THEN '' ELSE ' ' || b END AS snippet FROM pairs),
once AS (SELECT n, arg_min(snippet, o) AS snippet, min(o) AS o FROM said GROUP BY n, lower(snippet)),
four AS (SELECT n, string_agg(snippet, ', ' ORDER BY o) AS relations FROM (SELECT *, row_number() OVER (PARTITION BY n ORDER BY o) AS rn FROM once) WHERE rn <= 4 GROUP BY 1),
phrased AS (SELECT n, {found} AS f FROM {of}),
related AS MATERIALIZED (SELECT p.n, coalesce(four.relations, nullif(array_to_string(list_slice({_distinct('f')}, 1, 4), ', '), ''), '{V.UNKNOWN}') AS relations FROM phrased p LEFT JOIN four ON four.n = p.n)"""


def _prefix(of: str) -> str:
    rx = r"'(?i)\bfig(?:\.|ure)?\s*([0-9]+)([A-Za-z]?)\b'"
    digits, letter = f"regexp_extract({of}, {rx}, 1)", f"upper(regexp_extract({of}, {rx}, 2))"
    return f"CASE WHEN {digits} = '' THEN NULL WHEN {letter} = '' THEN {digits} ELSE {digits} || {letter} || '|' || {digits} END"


def _label_rx(prefixes: str) -> str:
    return rf"'(?i)\b(?:' || {prefixes} || ')(?:[0-9]+[A-Za-z]*|[A-Za-z]+[0-9]+)(?:[-/][0-9A-Za-z]+)*[''′]?\b'"


def _bare(text: str, prefixes: str) -> str:
    found = f"list_filter(list_transform(regexp_extract_all({text}, {_label_rx(prefixes)}), lambda x: upper(x)), lambda x: NOT regexp_matches(x, '(?:ST|ND|RD|TH)[''′]?$'))"
    return f"list_slice({_distinct(found)}, 1, 100)"


def _labels(of: str) -> str:
    """A table ``labelled`` (n, labels) for ``of`` (n, t, label): t is cleaned text, label may be NULL."""
    stop = f"regexp_matches(gap, '[.;:?!\\n]') OR lower(word) IN {_in(V.LABEL_BREAKS | V.RELATION_BOUNDS)}"
    rx = _label_rx("p")
    return f"""
pre AS (SELECT n, t, p, CASE WHEN p IS NULL OR t = '' THEN [] ELSE {_bare('t', 'p')} END AS bare, p IS NOT NULL AND regexp_matches(t, '(?i)\\bfig(?:\\.|ure)?\\s*(?:' || p || ')\\b') AS named FROM (SELECT n, t, {_prefix("coalesce(nullif(label, ''), t)")} AS p FROM {of})),
need AS MATERIALIZED (SELECT n AS id, t AS text, p, bare FROM pre WHERE len(bare) > 0 AND NOT named),{_tokens("ltok", "need", "text", r"'\b[0-9A-Za-z]+[''′]?\b'")},
lhit_ AS (SELECT id, text, unnest(regexp_extract_all(text, {rx})) AS m, unnest(string_split_regex(text, {rx})[1:-2]) AS gap, generate_subscripts(regexp_extract_all(text, {rx}), 1) AS i FROM need),
lhit AS MATERIALIZED (
  SELECT l.id * 1000000 + l.i AS h, l.id, l.text, l.i, upper(l.m) AS m, l.s, coalesce((SELECT max(t.e) FROM ltok t WHERE t.id = l.id AND t.s >= l.s AND t.s < l.s + length(l.m)), l.s) AS e
  FROM (SELECT *, (sum(length(gap)) OVER w + sum(length(m)) OVER w - length(m))::INT AS s FROM lhit_ WINDOW w AS (PARTITION BY id ORDER BY i)) l
  WHERE NOT regexp_matches(l.m, '(?i)(?:st|nd|rd|th)[''′]?$') AND EXISTS (FROM ltok t WHERE t.id = l.id AND t.s = l.s)),{_side("before_", True, "lhit", "ltok", _GAP_LEFT, stop, V.LABEL_SKIPS, 4)},{_side("after_", False, "lhit", "ltok", _GAP_RIGHT, stop, V.LABEL_SKIPS, 4)},
context AS (SELECT id, i, CASE WHEN len(a.words) > 0 THEN array_to_string(a.words, ' ') || ' ' || m ELSE m || CASE WHEN len(b.words) > 0 THEN ' ' || array_to_string(b.words, ' ') ELSE '' END END AS snippet FROM lhit LEFT JOIN before_ a USING (h) LEFT JOIN after_ b USING (h)),
conce AS (SELECT id, arg_min(snippet, i) AS snippet, min(i) AS i FROM context GROUP BY id, lower(snippet)),
clist AS (SELECT id, list(snippet ORDER BY i) AS found FROM conce GROUP BY 1),
labelled AS MATERIALIZED (
  SELECT n, coalesce(nullif(array_to_string(list_slice(CASE WHEN named OR len(bare) = 0 THEN bare ELSE list_concat(coalesce(found, []), CASE WHEN found IS NULL THEN [] ELSE list_filter(bare, lambda b: NOT list_contains(list_transform(found, lambda c: starts_with(lower(c), lower(b)) OR ends_with(lower(c), lower(b))), true)) END) END, 1, 100), ', '), ''), '{V.NO_LABELS}') AS labels
  FROM pre LEFT JOIN clist ON clist.id = pre.n)"""


#: Cleaned text with every letter, digit and mark outside ASCII as an underscore, so that ASCII word boundaries are where Unicode ones are.
_PLAIN = _T_("regexp_replace(regexp_replace(regexp_replace(" + str(_CLEAN) + r", '[^\x00-\x7F\P{L}]', '_', 'g'), '[^\x00-\x7F\P{N}]', '_', 'g'), '[^\x00-\x7F\P{M}]', '_', 'g')")
_ALL = f"SELECT row_number() OVER () AS n, doc_id, section, {_PLAIN.format('content')} AS t, NULL::VARCHAR AS label FROM (SELECT DISTINCT * FROM text_fts)"
_LINES = "list_filter(string_split(coalesce(content, ''), chr(10)), lambda s: trim(s, ' ') <> '')"
_FLAT = "replace(num, '-', '')"
#: Figures by document and number, with the lines of the document's paragraphs and captions and its claims.
_CHOSEN = f"""
f AS MATERIALIZED (
  SELECT id, k, fig_label, {_label('fig_label')} AS num FROM (SELECT id, {_KEY.format('doc_id')} AS k, fig_label, row_number() OVER (PARTITION BY id ORDER BY {", ".join(f"{c} DESC NULLS LAST" for c in ("recorded_at", "doc_id", "tiff_path", "fig_label", "bbox_x1", "bbox_y1", "bbox_x2", "bbox_y2"))}) AS rn FROM figures) WHERE rn = 1),
s AS (SELECT DISTINCT {_KEY.format('doc_id')} AS k, section, content FROM text_fts WHERE doc_id IS NOT NULL AND content IS NOT NULL),
x AS (SELECT k, coalesce(flatten(list({_LINES} ORDER BY content) FILTER (section = 'paragraph')), []) AS paras, coalesce(flatten(list({_LINES} ORDER BY content) FILTER (section = 'caption')), []) AS caps, string_agg(content, ' ' ORDER BY content) FILTER (section = 'claim' AND trim(content, ' ') <> '') AS claims FROM s GROUP BY 1),
w AS MATERIALIZED (SELECT k, paras, caps, claims, list_transform(paras, lambda q: list_filter(list_transform(list_transform(regexp_extract_all(q, '{_REF}', 1), lambda z: upper(z)), lambda z: {_canonical('z')}), lambda z: z <> '')) AS refs FROM x),
a AS (SELECT *, list_position(list_transform(refs, lambda r: list_contains(r, num)), true) AS s1, list_position(list_transform(paras, lambda q: contains(regexp_replace(upper(q), '[ .,\\-]', '', 'g'), 'FIG') AND contains(regexp_replace(upper(q), '[ .,\\-]', '', 'g'), {_FLAT})), true) AS s2
  FROM (SELECT DISTINCT k, num FROM f WHERE num IS NOT NULL) LEFT JOIN w USING (k)),
b AS (SELECT *, coalesce(nullif(s1, 0), nullif(s2, 0)) AS start FROM a),
c AS (SELECT *, coalesce((SELECT min(i) FROM range(start + 1, len(paras) + 1) r(i) WHERE len(refs[i]) > 0 AND NOT list_contains(refs[i], num)), len(paras) + 1) AS stop FROM b),
chosen AS MATERIALIZED (
  SELECT k, num, claims, CASE WHEN coalesce(len(paras), 0) = 0 THEN coalesce(array_to_string(caps[1:2], ' '), '') WHEN start IS NULL THEN array_to_string(paras[1:2], ' ')
    WHEN stop = start + 1 AND start < len(paras) AND paras[start + 1] <> paras[start] THEN array_to_string(paras[start:start + 1], ' ') ELSE array_to_string(paras[start:stop - 1], ' ') END AS fig_text FROM c)"""
_SHOWN = "trim(replace(replace(coalesce(fig_label, '{unknown}'), 'FIGURE', 'FIG.'), 'FIG ', 'FIG. '), ' ')"
_T = [_q(t) for t in TEMPLATE]

SQL = {
    "relations": f"WITH src AS MATERIALIZED ({_ALL}),{_relations('src')} SELECT doc_id, section, relations FROM src JOIN related USING (n)",
    "ref_labels": f"SELECT doc_id, section, coalesce(nullif(array_to_string(CASE WHEN p IS NULL THEN [] ELSE {_bare('t', 'p')} END, ', '), ''), '{V.NO_LABELS}') AS labels FROM (SELECT *, {_prefix('t')} AS p FROM ({_ALL}))",
    "context_labels": f"WITH src AS MATERIALIZED ({_ALL}),{_labels('src')} SELECT doc_id, section, labels FROM src JOIN labelled USING (n)",
    "figure_text": f"WITH {_CHOSEN} SELECT id, num AS fig_num, fig_text FROM f JOIN chosen USING (k, num)",
    "prompt_row": f"""WITH {_CHOSEN},
src AS MATERIALIZED (SELECT row_number() OVER () AS n, *, {_PLAIN.format('fig_text')} AS t, fig_label AS label FROM (SELECT DISTINCT k, num, fig_label FROM f) JOIN chosen USING (k, num)),{_relations('src')},{_labels('src')},
kw AS (SELECT n, w, count(*) AS c, min(p) AS o FROM (SELECT n, lower(unnest(l)) AS w, generate_subscripts(l, 1) AS p FROM (SELECT n, regexp_extract_all(t, '[A-Za-z][A-Za-z\\-]+') AS l FROM src)) WHERE {_KEYWORD} GROUP BY 1, 2),
top AS (SELECT n, string_agg(w, ', ' ORDER BY rn) AS keywords FROM (SELECT *, row_number() OVER (PARTITION BY n ORDER BY c DESC, o) AS rn FROM kw) WHERE rn <= {KEYWORDS} GROUP BY 1),
made AS (
  SELECT k, num, fig_label, {_T[0]} || {_SHOWN} || {_T[1]} || {_class('t')} || {_T[2]} || {_VIEW.format('t')} || {_T[3]} || coalesce(keywords, '{{unspecified}}') || {_T[4]} || relations || {_T[5]} || labels || {_T[6]} || CASE WHEN claims <> '' THEN ' Constraints: ' || claims || '.' ELSE '' END AS prompt
  FROM src JOIN related USING (n) JOIN labelled USING (n) LEFT JOIN top USING (n))
SELECT id, prompt FROM f JOIN made ON made.k = f.k AND made.num = f.num AND made.fig_label = f.fig_label""",
}
