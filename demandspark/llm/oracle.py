"""DuckDB SQL for the queries, written from what they must return and not from how Spark gets there."""

from __future__ import annotations

from .secrets import RULES

SPACE = r"\x20\x09-\x0D"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_KINDS = "\nUNION ALL\n".join(
    f"""SELECT doc_id, {place} AS place, '{rule.kind}' AS kind, {rule.group} AS grp, {rule.least} AS least,
  regexp_extract_all(t, {_quoted(rule.pattern)}) AS hits,
  regexp_extract_all(t, {_quoted(rule.pattern)}, {rule.group}) AS vals,
  string_split_regex(t, {_quoted(rule.pattern)}) AS gaps
FROM d WHERE regexp_matches(t, {_quoted(rule.pattern)})"""
    for place, rule in enumerate(RULES, 1)
)

SECRETS = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
k AS ({_KINDS}),
p AS (SELECT doc_id, place, kind, least, unnest(hits) AS hit, unnest(vals) AS val, unnest(gaps[:len(hits)]) AS gap,
  unnest(range(len(hits))) AS i FROM k),
s AS (SELECT doc_id, place, kind, least, length(val) AS n, length(hit) AS len,
  sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, place ORDER BY i) AS stop FROM p),
f AS (SELECT doc_id, place, kind, CAST(stop - len AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop FROM s WHERE n >= least),
a AS (SELECT doc_id,
  count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) FILTER (place <= 3) AS base,
  string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) AS spans FROM f GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (doc_id)
"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, {_WORD}) AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, {_WORD}) AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i + 1 : i + least(len(w), 10)], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
pos AS (SELECT doc_id, n, i, array_to_string(w[i + 1 : i + n], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, pos.n, i, item_id FROM pos JOIN win ON win.s = pos.s AND win.n = pos.n),
covered AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

QUALITY = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^{SPACE}]+') AS w FROM d),
g AS (SELECT doc_id, i, array_to_string(w[i + 1 : i + 8], ' ') AS s FROM (SELECT doc_id, w, unnest(range(len(w) - 7)) AS i FROM w WHERE len(w) >= 8)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM g) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT j) AS n_repeat_words FROM (SELECT doc_id, unnest(range(i, i + 8)) AS j FROM twice) GROUP BY doc_id),
ln AS (SELECT doc_id, source, i, line, lower(trim(regexp_replace(line, '[{SPACE}]+', ' ', 'g'))) AS norm, len(regexp_extract_all(line, '[^{SPACE}]+')) AS words
  FROM (SELECT doc_id, source, unnest(string_split(t, chr(10))) AS line, unnest(range(len(string_split(t, chr(10))))) AS i FROM d)
  WHERE regexp_matches(line, '[^{SPACE}]')),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM ln GROUP BY doc_id),
total AS (SELECT source, count(*) AS total FROM documents GROUP BY source),
common AS (SELECT source, norm FROM (SELECT ln.source, norm, count(DISTINCT t) AS n_docs, any_value(total) AS total FROM ln JOIN d USING (doc_id)
  JOIN total ON ln.source IS NOT DISTINCT FROM total.source GROUP BY ln.source, norm) WHERE n_docs > 10 AND n_docs > 0.005 * total),
held AS (SELECT doc_id, ln.source, norm, words FROM ln JOIN common USING (norm) WHERE ln.source IS NOT DISTINCT FROM common.source),
own AS (SELECT doc_id FROM (SELECT doc_id, sum(words) AS lost FROM held GROUP BY doc_id) JOIN w USING (doc_id) WHERE 100 * (len(w.w) - lost) >= 20 * len(w.w)),
shared AS (SELECT source, norm FROM (SELECT held.source, norm, count(DISTINCT t) AS n_own, any_value(total) AS total FROM held JOIN own USING (doc_id) JOIN d USING (doc_id)
  JOIN total ON held.source IS NOT DISTINCT FROM total.source GROUP BY held.source, norm) WHERE n_own > 10 AND n_own > 0.005 * total),
lost AS (SELECT doc_id, CAST(sum(words) AS BIGINT) AS n_boilerplate_words FROM ln JOIN shared ON ln.norm = shared.norm AND ln.source IS NOT DISTINCT FROM shared.source GROUP BY doc_id),
s AS (SELECT doc_id, len(w) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
  coalesce(n_boilerplate_words, 0) AS n_boilerplate_words
  FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN lost USING (doc_id)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100 * (n_words - n_boilerplate_words) >= 20 * n_words AS kept, n_boilerplate_words FROM f
"""

URLS = """
WITH rules(rule, host, path, verdict) AS (VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
  ('www.example.com/en/', 'www.example.com', '/en/', 'allow'), ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')),
a AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
m AS (SELECT page_id, r.rule, r.verdict FROM p JOIN rules r
  ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(r.rule) DESC) = 1)
SELECT p.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN m USING (page_id)
"""

SUFFIXES = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
p AS (SELECT doc_id, i, md5(substring(x, CAST(2 * i + 1 AS BIGINT), 200)) AS s FROM (SELECT doc_id, x, unnest(range(length(x) // 2 - 99)) AS i FROM d WHERE length(x) >= 200)),
r AS (SELECT doc_id, i FROM p QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1),
g AS (SELECT doc_id, i, i - coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -1000) > 100 AS new FROM r),
n AS (SELECT doc_id, i, sum(CAST(new AS INT)) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM g),
s AS (SELECT doc_id, run, min(i) AS a, max(i) + 100 AS b FROM n GROUP BY doc_id, run),
k AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM s),
c AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS upto,
  string_agg(substring(x, CAST(2 * before + 1 AS BIGINT), CAST(2 * (a - before) AS BIGINT)), '' ORDER BY a) AS kept
  FROM k JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, length(x) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN c.doc_id IS NULL THEN x ELSE kept || substring(x, CAST(2 * upto + 1 AS BIGINT)) END)) AS kept_sha256
FROM d LEFT JOIN c USING (doc_id)
"""

WORD_WINDOWS = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^{SPACE}]+') AS w FROM documents),
p AS (SELECT doc_id, i, array_to_string(w[i + 1 : i + 50], ' ') AS s FROM (SELECT doc_id, w, unnest(range(len(w) - 49)) AS i FROM d WHERE len(w) >= 50)),
r AS (SELECT doc_id, i FROM p QUALIFY doc_id > min(doc_id) OVER (PARTITION BY s)),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM r),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS j FROM d),
k AS (SELECT words.doc_id, count(*) FILTER (gone.j IS NOT NULL) AS n_removed, string_agg(word, ' ' ORDER BY words.j) FILTER (gone.j IS NULL) AS kept
  FROM words LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.j = words.j GROUP BY words.doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""

JACCARD = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^{SPACE}]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i + 1 : i + 3], ' ') AS s FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 2, 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 90 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, to_id) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.to_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(to_id) AS component_id FROM r GROUP BY doc_id) m USING (doc_id)
"""

_RUNS = r"""SELECT {id}, w, len(w) AS n_words,
  list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f
  FROM (SELECT {id}, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM {table})"""

# the CRC's table follows from its polynomial; a string's CRC is a fold over its bytes
RESAMPLE = f"""
WITH crc AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c FROM (SELECT unnest(range(256)) AS i))),
d AS ({_RUNS.format(id="doc_id", table="documents")}),
b AS ({_RUNS.format(id="item_id", table="benchmark")}),
words AS (SELECT DISTINCT unnest(f) AS s FROM (SELECT f FROM d UNION ALL SELECT f FROM b)),
hexed AS (SELECT s, hex(encode(s)) AS x FROM words),
bytes AS (SELECT s, list_transform(range(length(x) // 2), lambda i: CAST(16 * (strpos('0123456789ABCDEF', x[2 * i + 1]) - 1) + strpos('0123456789ABCDEF', x[2 * i + 2]) - 1 AS BIGINT)) AS y FROM hexed),
hashed AS (SELECT s, xor(list_reduce(list_prepend(4294967295, y), lambda c, v: xor(c // 256, t[xor(c % 256, v) + 1])), 4294967295) % 10000 AS bucket FROM bytes, crc),
runs AS (SELECT doc_id, bucket FROM (SELECT doc_id, unnest(f) AS s FROM d) JOIN hashed USING (s)),
source AS (SELECT bucket, count(*) AS s FROM runs GROUP BY bucket),
target AS (SELECT bucket, count(*) AS t FROM (SELECT unnest(f) AS s FROM b) JOIN hashed USING (s) GROUP BY bucket),
sums AS (SELECT (SELECT coalesce(sum(s), 0) FROM source) AS ss, (SELECT coalesce(sum(t), 0) FROM target) AS tt),
gain AS (SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1) * (ss + 10000)::DOUBLE / ((s + 1) * (tt + 10000)::DOUBLE))) AS BIGINT) AS gain FROM source LEFT JOIN target USING (bucket), sums),
weights AS (SELECT doc_id, CAST(floor(sum(gain)::DOUBLE / count(*)) AS BIGINT) AS weight FROM runs JOIN gain USING (bucket) GROUP BY doc_id),
scored AS (SELECT doc_id, n_words, CAST(len(f) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substring(sha256('7:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM d LEFT JOIN weights USING (doc_id)),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 25 * n // 100 THEN rank END AS rank FROM scored LEFT JOIN ranked USING (doc_id)
"""

SEARCH = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, {_WORD}) AS w FROM documents),
b AS (SELECT item_id, unnest(list_distinct(regexp_extract_all({_LOWER.format("coalesce(text, '')")}, {_WORD}))) AS term FROM benchmark),
len AS (SELECT doc_id, len(w) AS n FROM d WHERE len(w) > 0),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM len),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM d) GROUP BY doc_id, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w FROM df, total),
m AS (SELECT doc_id, 100 - 50 + (50 * n * docs) // terms AS m FROM len, total),
s AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM b JOIN tf USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score FROM s WHERE score > 0
QUALIFY rank <= 50
"""
