"""DuckDB statements for the queries that SQL can express.

They state the answer by definition (joins on whole runs, windows and
strings), with the operators' own parameters and patterns.
"""

from __future__ import annotations

from monthwise.llm import decontaminate as dc
from monthwise.llm import licenses as lc
from monthwise.llm import line_dedup
from monthwise.llm import secrets_scan as sc


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _form(text: str, names: str | None, values: bool) -> str:
    """Words of a column in one form.  ``names``: what stands for a name (its
    word is group 2), or None to leave names as words.  Without look-behind,
    patterns take the character before along, so the point pattern runs twice."""
    number = f"{dc.NUMBER}\\0" if values else dc.NUMBER
    unit = f"\\1 {dc.UNIT}\\2\\3" if values else f"\\1 {dc.UNIT}\\3"
    point, t = dc._POINT, text
    for _ in range(2):
        t = f"regexp_replace({t}, '([0-9])[.,]([0-9])', '\\1{point}\\2', 'g')"
    if names is not None:
        t = f"regexp_replace({t}, '(^|[^\\p{{L}}\\p{{M}}\\p{{N}}])(\\p{{Lu}}\\p{{Ll}}+)', '\\1{names}', 'g')"
    t = f"regexp_replace(lower({t}), '[0-9][0-9{point}]*', ' {number} ', 'g')"
    t = f"regexp_replace({t}, '({dc.NUMBER}[0-9{point}]*) +({dc.UNITS})([^\\p{{L}}\\p{{N}}]|$)', '{unit}', 'g')"
    marks = dc.NAME + dc.NUMBER + dc.UNIT
    return f"list_filter(string_split_regex({t}, '[^\\p{{L}}\\p{{M}}\\p{{N}}{marks}]+'), lambda w: w <> '')"


_NAMED, _FOLDED, _VALUED = _form("t", dc.NAME, False), _form("t", None, False), _form("t", None, True)
_SLOTS = _form("t", f"{dc.NAME}\\2", True)
_MARKS = f"('{dc.NAME}', '{dc.NUMBER}', '{dc.UNIT}')"
_BANDS = f"unnest([CAST(floor(shift / {dc.REACH}.0) AS BIGINT) - 1, CAST(floor(shift / {dc.REACH}.0) AS BIGINT)])"

DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, t, {_NAMED} AS n, CASE WHEN regexp_matches(t, '[0-9]') THEN {_VALUED} END AS v, {_SLOTS} AS s
           FROM (SELECT DISTINCT doc_id, coalesce(text, '') AS t FROM documents)),
b AS (
    SELECT *, least(len(f), {dc.WINDOW}) AS width
    FROM (SELECT item_id, t, {_FOLDED} AS f, {_NAMED} AS n, {_VALUED} AS v, {_SLOTS} AS s
          FROM (SELECT DISTINCT item_id, coalesce(text, '') AS t FROM benchmark WHERE item_id IS NOT NULL))
    WHERE len(f) >= {dc.MIN_WORDS}
),
bp AS (SELECT item_id, t, width, i, f[i + 1:i + width] AS f, n[i + 1:i + width] AS n, v[i + 1:i + width] AS v
       FROM (SELECT *, unnest(range(0, len(f) - width + 1)) AS i FROM b)),
bw AS (
    SELECT DISTINCT item_id, t, width, n_windows, j,
           unnest(CASE WHEN len(list_filter(f, lambda w: left(w, 1) NOT IN {_MARKS})) < {dc.LITERALS} THEN [v]
                       WHEN len(list_filter(n, lambda w: left(w, 1) NOT IN {_MARKS})) < {dc.LITERALS} THEN [f] ELSE [f, n] END) AS win
    FROM (SELECT *, min(i) OVER (PARTITION BY item_id, t, v) AS j, count(DISTINCT v) OVER (PARTITION BY item_id, t) AS n_windows FROM bp)
),
df AS (SELECT doc_id, t, n AS w FROM d UNION ALL SELECT doc_id, t, v FROM d WHERE v IS NOT NULL),
dw AS (SELECT doc_id, t, width, i, w[i + 1:i + width] AS win
       FROM (SELECT df.*, x.width, unnest(range(0, greatest(0, len(w) - x.width + 1))) AS i FROM df CROSS JOIN (SELECT DISTINCT width FROM b) x)),
hits AS (
    SELECT DISTINCT dw.doc_id, dw.t, bw.item_id, bw.t AS bt, n_windows, bw.width, i - j AS shift, j
    FROM dw JOIN bw ON dw.width = bw.width AND dw.win = bw.win
),
bands AS (
    SELECT doc_id, t, item_id, bt, band FROM (SELECT *, {_BANDS} AS band FROM hits)
    GROUP BY ALL HAVING count(DISTINCT j) >= least({dc.COVERAGE} * min(n_windows), {dc.ENOUGH})
),
aligned AS (
    SELECT DISTINCT h.doc_id, h.t, h.item_id, h.bt, n_windows, width, shift, j
    FROM (SELECT *, {_BANDS} AS band FROM hits) h JOIN bands x
      ON h.doc_id IS NOT DISTINCT FROM x.doc_id AND h.t = x.t AND h.item_id = x.item_id AND h.bt = x.bt AND h.band = x.band
),
met AS (
    SELECT DISTINCT doc_id, t, item_id, bt, shift, a, x
    FROM (SELECT p.*, b.s[place + 1] AS a, d.s[place + shift + 1] AS x
          FROM (SELECT DISTINCT doc_id, t, item_id, bt, shift, unnest(range(j, j + width)) AS place FROM aligned) p
          JOIN d ON p.doc_id IS NOT DISTINCT FROM d.doc_id AND p.t = d.t JOIN b ON p.item_id = b.item_id AND p.bt = b.t)
    WHERE left(a, 1) IN {_MARKS} AND left(a, 1) = left(x, 1)
),
unlike AS (SELECT DISTINCT doc_id, t, item_id, bt, shift FROM (SELECT doc_id, t, item_id, bt, shift, a FROM met GROUP BY ALL HAVING count(*) > 1)),
held AS (SELECT * FROM aligned h WHERE NOT EXISTS (
    SELECT 1 FROM unlike u WHERE h.doc_id IS NOT DISTINCT FROM u.doc_id AND h.t = u.t AND h.item_id = u.item_id AND h.bt = u.bt AND h.shift = u.shift)),
kept AS (SELECT * FROM met h WHERE NOT EXISTS (
    SELECT 1 FROM unlike u WHERE h.doc_id IS NOT DISTINCT FROM u.doc_id AND h.t = u.t AND h.item_id = u.item_id AND h.bt = u.bt AND h.shift = u.shift)),
counted AS (
    SELECT doc_id, t, item_id, bt, n_windows, band, count(DISTINCT j) AS hit, min(shift) AS first
    FROM (SELECT *, {_BANDS} AS band FROM held)
    GROUP BY ALL HAVING count(DISTINCT j) >= least({dc.COVERAGE} * min(n_windows), {dc.ENOUGH})
),
slots AS (
    SELECT doc_id, t, item_id, bt, band, count(DISTINCT (a, x)) AS n_slots, bool_or(a <> x) AS changed
    FROM (SELECT *, {_BANDS} AS band FROM kept) GROUP BY ALL
),
be AS (
    SELECT c.doc_id, c.t, c.item_id,
           arg_max({{'hit': hit, 'n': n_windows, 'first': first, 'n_slots': coalesce(n_slots, 0), 'changed': coalesce(changed, false)}}, (hit, -c.band)) AS x
    FROM counted c LEFT JOIN slots s
      ON c.doc_id IS NOT DISTINCT FROM s.doc_id AND c.t = s.t AND c.item_id = s.item_id AND c.bt = s.bt AND c.band = s.band
    GROUP BY c.doc_id, c.t, c.item_id
)
SELECT doc_id, item_id, x.hit AS n_windows, x.hit / x.n AS coverage, CAST(greatest(x.first, 0) AS INTEGER) AS start,
       CAST(x.n_slots AS INTEGER) AS n_slots, x.changed AS reparameterised
FROM be
"""

LINE_DEDUP = f"""
WITH l AS (
    SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) AS n
    FROM (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL)
),
k AS (  -- non-blank lines, and the characters up to the end of each
    SELECT *, row_number() OVER d AS pos, sum(length(line)) OVER d AS upto
    FROM l WHERE trim(line) <> '' WINDOW d AS (PARTITION BY doc_id, text ORDER BY n)
),
p AS (  -- every stretch of enough characters of few lines
    SELECT a.doc_id, a.text, a.pos AS s, b.pos AS e
    FROM k a JOIN k b ON a.doc_id IS NOT DISTINCT FROM b.doc_id AND a.text = b.text AND b.pos BETWEEN a.pos AND a.pos + {line_dedup.MIN_CHARS - 1}
    WHERE b.upto - a.upto + length(a.line) >= {line_dedup.MIN_CHARS}
),
t AS (  -- the shortest forwards from each line, and back from each line
    SELECT doc_id, text, s, min(e) AS e FROM p GROUP BY doc_id, text, s
    UNION SELECT doc_id, text, max(s) AS s, e FROM p GROUP BY doc_id, text, e
),
r AS (
    SELECT t.doc_id, t.text, t.s, t.e, list(k.line ORDER BY k.pos) AS run
    FROM t JOIN k ON t.doc_id IS NOT DISTINCT FROM k.doc_id AND t.text = k.text AND k.pos BETWEEN t.s AND t.e
    GROUP BY t.doc_id, t.text, t.s, t.e
),
c AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id NULLS FIRST, text, s) AS nth FROM r),
g AS (
    SELECT DISTINCT k.doc_id, k.text, k.n
    FROM c JOIN k ON c.doc_id IS NOT DISTINCT FROM k.doc_id AND c.text = k.text AND k.pos BETWEEN c.s AND c.e WHERE c.nth > 1
),
x AS (
    SELECT l.doc_id, l.text, count(g.n) AS n_deleted,
           coalesce(bool_or(trim(l.line) <> '') FILTER (WHERE g.n IS NULL), false) AS some,
           string_agg(l.line, chr(10) ORDER BY l.n) FILTER (WHERE g.n IS NULL) AS kept
    FROM l LEFT JOIN g ON l.doc_id IS NOT DISTINCT FROM g.doc_id AND l.text = g.text AND l.n = g.n
    GROUP BY l.doc_id, l.text
)
SELECT d.doc_id, CASE WHEN coalesce(x.n_deleted, 0) = 0 THEN d.text WHEN x.some THEN x.kept ELSE '' END AS text,
       CAST(coalesce(x.n_deleted, 0) AS INTEGER) AS n_deleted
FROM documents d LEFT JOIN x ON d.doc_id IS NOT DISTINCT FROM x.doc_id AND d.text = x.text
"""


def _matches(kind: str, pattern: str, group: int = 0) -> str:
    """All matches of a pattern with their places: lengths of the pieces
    between matches and of the matches, summed up."""
    p = _text(pattern)
    return f"""
    SELECT u, '{kind}' AS kind, {sc.KINDS.index(kind)} AS k, sum(gap + len) OVER d - len AS start, sum(gap + len) OVER d AS "end", x, v
    FROM (SELECT u, unnest(list_transform(string_split_regex(t, {p}), lambda y: length(y))[1:len(regexp_extract_all(t, {p}))]) AS gap,
                 unnest(list_transform(regexp_extract_all(t, {p}), lambda y: length(y))) AS len,
                 unnest(regexp_extract_all(t, {p})) AS x, unnest(regexp_extract_all(t, {p}, {group})) AS v,
                 generate_subscripts(regexp_extract_all(t, {p}), 1) AS i
          FROM d WHERE regexp_matches(t, {p}))
    WINDOW d AS (PARTITION BY u ORDER BY i)"""


def _allowed() -> str:
    # the one pattern with a back-reference, a single character repeated, is said in the statement
    path = f"NOT (regexp_matches(x, {_text(sc.PATH)}) AND NOT regexp_matches(x, {_text(sc.DOUBLE_SEPARATOR)}))"
    return " AND ".join([path, *[f"NOT regexp_matches(x, {_text(a)})" for a in sc.ALLOWED if "\\1" not in a]])


#: Leftmost matches begin where the run begins.
_RUN = _text(f"[A-Za-z0-9]*{sc.ALLOWED_WORDS}[A-Za-z0-9]*")


SECRETS = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS u FROM documents),
m AS ({_matches('assign', sc.ASSIGN, 2)}
    UNION ALL {_matches('access', sc.ACCESS)}
    UNION ALL {_matches('hex', sc.HEX)}),
b AS (SELECT u, kind, k, start, "end" FROM m WHERE kind <> 'assign' OR length(v) >= {sc.MIN_VALUE}),
cut AS (SELECT u, start, string_split_regex(x, {_RUN}) AS gaps, regexp_extract_all(x, {_RUN}) AS runs FROM ({_matches('entropy', sc.CANDIDATE)})),
pc AS (
    SELECT u, start + coalesce(list_sum(list_transform(gaps[1:i - 1], lambda y: length(y))), 0) + coalesce(list_sum(list_transform(runs[1:i - 1], lambda y: length(y))), 0) AS start, x
    FROM (SELECT u, start, gaps, runs, unnest(gaps) AS x, generate_subscripts(gaps, 1) AS i FROM cut)
),
a AS (SELECT * FROM pc WHERE length(x) >= {sc.WINDOW} AND {_allowed()} AND x <> repeat(left(x, 1), length(x))),
w AS (  -- every window of every distinct candidate
    SELECT x, p, substr(x, p + 1, {sc.WINDOW}) AS win
    FROM (SELECT x, unnest(range(0, length(x) - {sc.WINDOW - 1})) AS p FROM (SELECT DISTINCT x FROM a))
),
c AS (SELECT x, p, ch, count(*) AS n FROM (SELECT x, p, unnest(string_split(win, '')) AS ch FROM w) GROUP BY ALL),
h AS (SELECT x, p, log2({sc.WINDOW}) - sum(n * log2(n)) / {sc.WINDOW} AS bits FROM c GROUP BY ALL),
hw AS (
    SELECT x, p, lag(p) OVER (PARTITION BY x ORDER BY p) AS prev FROM h
    WHERE bits >= CASE WHEN regexp_matches(x, '^([0-9a-f]+|[0-9A-F]+)$') THEN {sc.THRESHOLDS['hex']}
                       WHEN regexp_matches(x, '^[A-Za-z0-9]+$') THEN {sc.THRESHOLDS['alnum']} ELSE {sc.THRESHOLDS['base64']} END - 1e-9
),
hg AS (SELECT x, p, sum(CASE WHEN p <= prev + {sc.WINDOW} THEN 0 ELSE 1 END) OVER (PARTITION BY x ORDER BY p) AS stretch FROM hw),
f AS (SELECT x, min(p) AS lo, max(p) + {sc.WINDOW} AS hi FROM hg GROUP BY x, stretch),
s AS (
    SELECT u, kind, k, start, "end" FROM b
    UNION ALL SELECT a.u, 'entropy', 3, a.start + f.lo, a.start + f.hi FROM a JOIN f ON a.x = f.x
),
g AS (
    SELECT u, count(*) FILTER (WHERE k = 0) AS n_assign, count(*) FILTER (WHERE k = 1) AS n_access, count(*) FILTER (WHERE k = 2) AS n_hex,
           string_agg(kind || ':' || CAST(start AS VARCHAR) || ':' || CAST("end" AS VARCHAR), ',' ORDER BY start, k, "end") FILTER (WHERE k < 3) AS base,
           string_agg(kind || ':' || CAST(start AS VARCHAR) || ':' || CAST("end" AS VARCHAR), ',' ORDER BY start, k, "end") AS spans
    FROM s GROUP BY u
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g ON d.u = g.u
"""


def _templates() -> str:
    return ",\n       ".join(f"({i}, {_text(name)}, {_text(body)})" for i, (name, body) in enumerate(lc.TEMPLATES))


LICENSES = f"""
WITH tp(t, license, body) AS (VALUES {_templates()}),
tt AS (SELECT t, license, term, count(*) AS n FROM (SELECT t, license, unnest(regexp_extract_all(lower(body), {_text(f'({lc._WORD})')}, 1)) AS term FROM tp) GROUP BY ALL),
d AS (
    SELECT row_number() OVER () AS u, doc_id, concat_ws('/', source, CAST(doc_id AS VARCHAR)) AS path, coalesce(text, '') AS text FROM documents
),
n AS (SELECT count(*) AS total FROM d),
f AS (
    SELECT term, count(*) AS df FROM (SELECT unnest(list_distinct(regexp_extract_all(lower(text), {_text(f'({lc._WORD})')}, 1))) AS term FROM d)
    WHERE term IN (SELECT term FROM tt) GROUP BY term
),
i AS (SELECT DISTINCT tt.term, ln((n.total + 1.0) / (coalesce(f.df, 0) + 1.0)) + 1 AS idf FROM tt CROSS JOIN n LEFT JOIN f ON f.term = tt.term),
tw AS (SELECT t, license, tt.term, n * idf AS w FROM tt JOIN i ON i.term = tt.term),
tn AS (SELECT t, sqrt(sum(w * w)) AS norm FROM tw GROUP BY t),
l AS (SELECT u, line FROM (SELECT u, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(lower(line), {_text(lc.MARKS)})),
lt AS (SELECT line, term, count(*) AS c FROM (SELECT line, unnest(regexp_extract_all(lower(line), {_text(f'({lc._WORD})')}, 1)) AS term FROM (SELECT DISTINCT line FROM l)) GROUP BY ALL),
lw AS (SELECT line, lt.term, c * coalesce(i.idf, ln((n.total + 1.0) / 1.0) + 1) AS w FROM lt CROSS JOIN n LEFT JOIN i ON i.term = lt.term),
ln AS (SELECT line, sqrt(sum(w * w)) AS norm FROM lw GROUP BY line),
cs AS (
    SELECT lw.line, tw.license, round(sum(lw.w * tw.w) / (tn.norm * ln.norm), 9) AS score
    FROM lw JOIN tw ON tw.term = lw.term JOIN tn ON tn.t = tw.t JOIN ln ON ln.line = lw.line
    GROUP BY lw.line, tw.t, tw.license, tn.norm, ln.norm
),
b AS (SELECT line, arg_min(license, (-score, license)) AS license, max(score) AS score FROM cs WHERE score >= {lc.THRESHOLD} GROUP BY line),
o AS (
    SELECT l.u, arg_min(b.license, (-b.score, b.license)) AS license, max(b.score) AS score, count(*) AS n_headers, sum(length(l.line)) AS chars
    FROM l JOIN b ON b.line = l.line GROUP BY l.u
),
j AS (
    SELECT d.u, d.doc_id, d.path, o.license, o.score, coalesce(o.n_headers, 0) AS n_headers,
           o.license IS NOT NULL AND (o.chars >= {lc.FILE_SHARE} * length(d.text) OR regexp_matches(d.path, {_text(lc.LICENSE_FILES)})) AS is_file,
           array_to_string(string_split(d.path, '/')[1:len(string_split(d.path, '/')) - 1], '/') AS folder
    FROM d LEFT JOIN o ON o.u = d.u
),
fo AS (SELECT folder AS above, arg_min(license, (-score, license)) AS license, max(score) AS score FROM j WHERE is_file GROUP BY folder),
an AS (SELECT folder, k, array_to_string(string_split(folder, '/')[1:k], '/') AS above
       FROM (SELECT folder, unnest(range(0, len(string_split(folder, '/')) + 1)) AS k FROM (SELECT DISTINCT folder FROM j WHERE license IS NULL))),
ne AS (SELECT an.folder, arg_max(fo.above, k) AS above, arg_max(fo.license, k) AS license, arg_max(fo.score, k) AS score
       FROM an JOIN fo ON fo.above = an.above GROUP BY an.folder)
SELECT j.doc_id, j.path, coalesce(j.license, ne.license) AS license, coalesce(j.score, ne.score) AS score,
       CAST(j.n_headers AS INTEGER) AS n_headers, j.is_file AS is_license_file,
       CASE WHEN j.license IS NULL THEN ne.above END AS inherited_from
FROM j LEFT JOIN ne ON ne.folder = j.folder
"""

TOP_K = """
WITH v AS (
    SELECT vec_id, row_number() OVER () AS uid,
           list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
    SELECT q.vec_id AS query_id, q.uid AS q, v.vec_id AS vec_id,
           CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(v.e AS DOUBLE[])) AS BIGINT) AS score
    FROM v AS q JOIN v ON q.uid <> v.uid
    WHERE q.vec_id % 100 = 0
),
r AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def _score(a: str, left: str, right: str) -> str:
    return f"CAST((1000000::HUGEINT * {a} * {a}) // ({left}::HUGEINT * {right}) AS BIGINT)"


COLLOCATIONS = f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
),
ws AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM ws),
grams AS (SELECT lang, w[i] AS x, CASE WHEN i + 1 <= len(w) THEN w[i + 1] END AS y, CASE WHEN i + 2 <= len(w) THEN w[i + 2] END AS z FROM places),
f1 AS (SELECT lang, x, CAST(count(*) AS BIGINT) AS f FROM grams GROUP BY ALL),
f2 AS (SELECT lang, x, y, CAST(count(*) AS BIGINT) AS f FROM grams WHERE y IS NOT NULL GROUP BY ALL),
f3 AS (SELECT lang, x, y, z, CAST(count(*) AS BIGINT) AS f FROM grams WHERE z IS NOT NULL GROUP BY ALL),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f1 GROUP BY lang),
c3 AS (SELECT * FROM f3 WHERE f >= 10),
longer AS (SELECT lang, x, y, max(f) AS f FROM (SELECT lang, x, y, f FROM c3 UNION ALL SELECT lang, y, z, f FROM c3) GROUP BY ALL),
two AS (
    SELECT p.lang, p.x || ' ' || p.y AS phrase, p.f AS a, a.f AS l, b.f AS r, {_score('p.f', 'a.f', 'b.f')} AS score
    FROM f2 p JOIN f1 a ON a.lang = p.lang AND a.x = p.x JOIN f1 b ON b.lang = p.lang AND b.x = p.y
    LEFT JOIN longer m ON m.lang = p.lang AND m.x = p.x AND m.y = p.y
    WHERE p.f >= 10 AND (m.f IS NULL OR 100 * m.f < 50 * p.f)
),
cuts AS (
    SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z AS phrase, t.f AS a, 1 AS k, a.f AS l, yz.f AS r
    FROM c3 t JOIN f1 a ON a.lang = t.lang AND a.x = t.x JOIN f2 yz ON yz.lang = t.lang AND yz.x = t.y AND yz.y = t.z
    UNION ALL
    SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, t.f, 2, xy.f, c.f
    FROM c3 t JOIN f2 xy ON xy.lang = t.lang AND xy.x = t.x AND xy.y = t.y JOIN f1 c ON c.lang = t.lang AND c.x = t.z
),
three AS (
    SELECT lang, phrase, a, l, r, score FROM (
        SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS first
        FROM (SELECT *, {_score('a', 'l', 'r')} AS score FROM cuts)
    ) WHERE first = 1
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
    FROM (SELECT * FROM two UNION ALL SELECT * FROM three)
)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""
