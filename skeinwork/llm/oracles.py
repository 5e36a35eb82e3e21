"""DuckDB equivalents of the queries that SQL can express on whole tables."""

from __future__ import annotations

from .license_scan import TEMPLATES

WORDS = r"""list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"""

OP1 = f"""
WITH items AS (SELECT item_id, {WORDS} AS ws FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS k, array_to_string(ws[i + 1:i + 10], ' ') AS pattern
  FROM (SELECT item_id, ws, unnest(range(greatest(len(ws) - 9, 1))) AS i FROM items WHERE len(ws) > 0)
),
docs AS (SELECT doc_id, {WORDS} AS ws FROM documents),
grams AS (
  SELECT doc_id, i, k, array_to_string(ws[i + 1:i + k], ' ') AS pattern
  FROM (SELECT doc_id, ws, k, unnest(range(greatest(len(ws) - k + 1, 0))) AS i
        FROM docs CROSS JOIN (SELECT DISTINCT k FROM windows) AS ks)
),
hits AS (SELECT g.doc_id, g.i, g.k, w.item_id FROM grams g JOIN windows w ON g.pattern = w.pattern AND g.k = w.k),
words_hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
listed AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(l.n_items, 0) AS BIGINT) AS n_items, coalesce(l.items_sha256, sha256('')) AS items_sha256,
  coalesce(h.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN words_hit h ON d.doc_id = h.doc_id LEFT JOIN listed l ON d.doc_id = l.doc_id
"""

ORACLES: dict[str, str] = {"op1_decontaminate": OP1}

OP4 = r"""
WITH docs AS (
  SELECT doc_id, text, regexp_extract(text, '^[ \t\n\x0b\x0c\r]*') AS head,
    regexp_extract_all(text, '(?:[\x{0E00}-\x{0E7F}\x{3000}-\x{9FFF}\x{F900}-\x{FAFF}]|[^ \t\n\x0b\x0c\r\x{0E00}-\x{0E7F}\x{3000}-\x{9FFF}\x{F900}-\x{FAFF}]+)[ \t\n\x0b\x0c\r]*') AS toks
  FROM documents
),
toks AS (SELECT doc_id, len(toks) AS n, unnest(toks) AS tok, generate_subscripts(toks, 1) AS p, head FROM docs),
words AS (
  SELECT doc_id, n, p, CASE WHEN p = 1 THEN head || tok ELSE tok END AS piece, strpos(tok, chr(10)) > 0 AS breaks,
    translate(regexp_extract(tok, '^[^ \t\n\x0b\x0c\r]+'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM toks
),
closed AS (SELECT *, coalesce(lag(breaks OR regexp_matches(w, '[.!?]["'')\]]?$') OR w IN ('。', '！', '？')) OVER (PARTITION BY doc_id ORDER BY p), true) AS first FROM words),
least AS (
  SELECT doc_id, n, p, min({'w': w, 'p': p}) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS m,
    count(*) FILTER (first) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) AS near
  FROM closed
),
places AS (SELECT DISTINCT doc_id, m.p AS p FROM least WHERE p + 9 <= n),
starting AS (
  SELECT c.doc_id, c.n, c.p, c.piece, c.w, c.first OR (a.p IS NOT NULL AND l.near = 0) AS first
  FROM closed c JOIN least l ON c.doc_id = l.doc_id AND c.p = l.p LEFT JOIN places a ON c.doc_id = a.doc_id AND c.p = a.p
),
numbered AS (SELECT *, count(*) FILTER (first) OVER (PARTITION BY doc_id ORDER BY p) AS u FROM starting),
lists AS (SELECT doc_id, any_value(n) AS n, max(u) AS n_units, list(w ORDER BY p) AS ws FROM numbered GROUP BY doc_id),
units AS (SELECT doc_id, u, min(p) AS p FROM numbered GROUP BY doc_id, u),
reach AS (
  SELECT s.doc_id, s.u, s.p, l.n, l.n_units, l.ws,
    greatest(s.u + 2, CASE WHEN s.p + 40 = l.n + 1 THEN l.n_units + 1 WHEN e.first THEN e.u ELSE e.u + 1 END) AS e
  FROM units s JOIN lists l ON s.doc_id = l.doc_id LEFT JOIN numbered e ON e.doc_id = s.doc_id AND e.p = s.p + 40
  WHERE s.p + 40 <= l.n + 1
),
runs AS (
  SELECT r.doc_id, r.u, r.e, array_to_string(r.ws[r.p:coalesce(x.p - 1, r.n)], ' ') AS run
  FROM reach r LEFT JOIN units x ON x.doc_id = r.doc_id AND x.u = r.e WHERE r.e <= r.n_units + 1
),
ranked AS (SELECT doc_id, u, e, row_number() OVER (PARTITION BY run ORDER BY doc_id, u) AS k FROM runs),
gone AS (SELECT DISTINCT doc_id, unnest(range(u, e)) AS u FROM ranked WHERE k > 1),
counted AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id),
left_over AS (
  SELECT c.doc_id, string_agg(s.piece, '' ORDER BY s.p) AS text
  FROM counted c JOIN numbered s ON s.doc_id = c.doc_id ANTI JOIN gone g ON g.doc_id = s.doc_id AND g.u = s.u GROUP BY c.doc_id
)
SELECT d.doc_id, CAST(coalesce(c.n_removed, 0) AS BIGINT) AS n_removed, CASE WHEN c.doc_id IS NULL THEN d.text ELSE coalesce(o.text, '') END AS text
FROM docs d LEFT JOIN counted c ON d.doc_id = c.doc_id LEFT JOIN left_over o ON d.doc_id = o.doc_id
"""

OP6 = r"""
WITH rests AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests
),
rules AS (SELECT * FROM (VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('block', 'net', '/de/'),
  ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')) AS r(verdict, rule_host, rule_path)),
fits AS (
  SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(verdict, length(rule_host || rule_path)) AS verdict
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY page_id
),
queries AS (SELECT page_id, array_to_string(list_filter(string_split(regexp_extract(rest, '^[^#?]*\?([^#]*)', 1), '&'),
  lambda q: q <> '' AND NOT regexp_matches(q, '^(?:utm_[^=]*|ref)(?:=|$)')), '&') AS told FROM rests),
keys AS (SELECT p.page_id, CASE WHEN host <> '' THEN regexp_replace(host, '^(?:www|m)\.', '') || regexp_replace(path, '/+$', '')
  || CASE WHEN told <> '' THEN '?' || told ELSE '' END END AS key FROM parts p JOIN queries q ON p.page_id = q.page_id),
listed AS (SELECT DISTINCT key FROM keys WHERE key IS NOT NULL AND page_id % 50 = 0)
SELECT p.page_id, p.host, p.path, f.rule,
  CASE WHEN f.rule IS NOT NULL THEN f.verdict WHEN l.key IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM parts p JOIN keys k ON p.page_id = k.page_id LEFT JOIN fits f ON p.page_id = f.page_id LEFT JOIN listed l ON k.key = l.key
"""

OP3 = r"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, lang, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
grams AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS gram FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)),
repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 8)) AS p FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS k FROM grams) WHERE k > 1)
  GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
counts AS (
  SELECT w.doc_id, w.lang, w.t, w.ws, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(l.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN lines l ON w.doc_id = l.doc_id LEFT JOIN repeated r ON w.doc_id = r.doc_id),
classes AS (
  SELECT doc_id, unnest(range(20)) AS place, unnest([lower, upper, digit, space, newline, point,
    total - list_sum([lower, upper, digit, space, newline, point, symbol]) - list_sum(scripts), symbol] || scripts) / total AS p
  FROM (
    SELECT doc_id, length(t)::DOUBLE AS total,
      length(t) - length(regexp_replace(t, '[a-z]', '', 'g')) AS lower, length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS upper,
      length(t) - length(regexp_replace(t, '[0-9]', '', 'g')) AS digit, length(t) - length(regexp_replace(t, '[ \t\r\x0b\x0c]', '', 'g')) AS space,
      length(t) - length(regexp_replace(t, '\n', '', 'g')) AS newline, length(t) - length(regexp_replace(t, '[.,;:!?''"()-]', '', 'g')) AS point, n_symbols AS symbol,
      list_transform(['[\x{80}-\x{2FF}]', '[\x{300}-\x{3FF}]', '[\x{400}-\x{53F}]', '[\x{540}-\x{5FF}]', '[\x{600}-\x{7FF}]', '[\x{800}-\x{FFF}]',
        '[\x{1000}-\x{1FFF}]', '[\x{2000}-\x{2FFF}]', '[\x{3000}-\x{9FFF}]', '[\x{A000}-\x{DFFF}]', '[\x{E000}-\x{FFFF}]', '[\x{10000}-\x{10FFFF}]'],
        lambda c: length(t) - length(regexp_replace(t, c, '', 'g'))) AS scripts
    FROM counts WHERE strlen(t) >= 200)),
words AS (SELECT doc_id, lang, trim(translate(unnest(ws), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '.,;:!?''"()-') AS word FROM w),
sizes AS (SELECT lang, count(*) AS n_docs FROM d WHERE lang IS NOT NULL GROUP BY lang),
common AS (
  SELECT lang, word, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS place
  FROM (SELECT lang, word, count(DISTINCT doc_id) AS n FROM words WHERE word <> '' AND lang IS NOT NULL GROUP BY lang, word) JOIN sizes USING (lang)
  WHERE n >= 0.1::DOUBLE * n_docs QUALIFY place <= 64),
judged AS (SELECT doc_id, lang, n_words FROM counts WHERE strlen(t) >= 200 AND n_words >= 100),
slots AS (SELECT lang, place FROM common UNION ALL SELECT lang, 65 FROM sizes),
tallies AS (
  SELECT j.doc_id, l.lang, coalesce(c.place, 65) AS place, count(*) AS n
  FROM judged j JOIN words x ON x.doc_id = j.doc_id JOIN sizes l ON true LEFT JOIN common c ON c.lang = l.lang AND c.word = x.word
  GROUP BY j.doc_id, l.lang, coalesce(c.place, 65)),
numbers AS (SELECT lang, count(*) AS n FROM judged WHERE lang IS NOT NULL GROUP BY lang HAVING count(*) >= 20),
word_refs AS (SELECT s.lang, s.place, coalesce(sum(t.n / j.n_words::DOUBLE), 0) / any_value(m.n) AS q
  FROM slots s JOIN numbers m ON s.lang = m.lang JOIN judged j ON j.lang = s.lang
  LEFT JOIN tallies t ON t.doc_id = j.doc_id AND t.lang = s.lang AND t.place = s.place GROUP BY s.lang, s.place),
char_refs AS (SELECT j.lang, c.place, sum(c.p) / any_value(m.n) AS q FROM judged j JOIN numbers m ON j.lang = m.lang JOIN classes c ON c.doc_id = j.doc_id GROUP BY j.lang, c.place),
held AS (
  SELECT d.doc_id, m.lang FROM d JOIN numbers m ON m.lang = d.lang
  UNION ALL
  SELECT d.doc_id, m.lang FROM d JOIN (SELECT lang FROM numbers ORDER BY n DESC, lang LIMIT 20) m ON true WHERE d.lang IS NULL OR d.lang NOT IN (SELECT lang FROM numbers)),
pairs AS (
  SELECT 'char' AS kind, h.doc_id, h.lang, c.p, q.q FROM held h JOIN classes c ON c.doc_id = h.doc_id JOIN char_refs q ON q.lang = h.lang AND q.place = c.place
  UNION ALL
  SELECT 'word', h.doc_id, h.lang, coalesce(t.n, 0) / c.n_words::DOUBLE, q.q
  FROM held h JOIN counts c ON c.doc_id = h.doc_id JOIN word_refs q ON q.lang = h.lang LEFT JOIN tallies t ON t.doc_id = h.doc_id AND t.lang = h.lang AND t.place = q.place
  WHERE c.n_words >= 100 AND strlen(c.t) >= 200),
gaps AS (
  SELECT kind, doc_id, lang, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2)) AS gap
  FROM pairs GROUP BY kind, doc_id, lang),
far AS (SELECT doc_id FROM (SELECT kind, doc_id, min(gap) AS gap FROM gaps GROUP BY kind, doc_id) WHERE gap > CASE kind WHEN 'char' THEN 0.34 ELSE 0.40 END GROUP BY doc_id),
failed AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counts)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND far.doc_id IS NULL AS kept
FROM failed f LEFT JOIN far ON far.doc_id = f.doc_id
"""

ORACLES |= {"op3_quality_rules": OP3, "op4_substring_dedup": OP4, "op6_url_filter": OP6}

TEMPLATE_ROWS = ", ".join(f"('{label}', '{body}')" for label, body in TEMPLATES)

OP9 = f"""
WITH docs AS (SELECT doc_id, {WORDS} AS ws FROM documents),
phrases AS (SELECT label, string_split(phrase, ' ') AS ps FROM (VALUES ('under the mit license', 'mit'),
  ('apache license version 2', 'apache-2'), ('cc by nc', 'cc-by-nc')) AS p(phrase, label)),
places AS (
  SELECT doc_id, label, i FROM (
    SELECT doc_id, ws, label, ps, unnest(range(greatest(len(ws) - len(ps) + 1, 0))) AS i FROM docs CROSS JOIN phrases)
  WHERE ws[i + 1:i + len(ps)] = ps
),
base AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word FROM places GROUP BY doc_id),
templates AS (SELECT row_number() OVER () AS template, label, {WORDS.replace("text", "body")} AS ts
  FROM (VALUES {TEMPLATE_ROWS}) AS t(label, body)),
twords AS (SELECT template, label, n_template, t, ts[t + 1] AS w FROM (SELECT template, label, ts, len(ts) AS n_template, unnest(range(len(ts))) AS t FROM templates)),
dwords AS (SELECT doc_id, i, ws[i + 1] AS w FROM (SELECT doc_id, ws, unnest(range(len(ws))) AS i FROM docs)),
equal AS (SELECT doc_id, template, label, n_template, i - t AS diagonal, t FROM dwords JOIN twords USING (w)),
runs AS (
  SELECT doc_id, template, label, n_template, diagonal, min(t) AS t0, max(t) AS t1
  FROM (SELECT *, t - row_number() OVER (PARTITION BY doc_id, template, diagonal ORDER BY t) AS run FROM equal)
  GROUP BY doc_id, template, label, n_template, diagonal, run HAVING count(*) >= 4
),
own AS (
  SELECT doc_id, template, label, n_template, diagonal, diagonal + min(t0) AS first, diagonal + max(t1) AS last, min(t0) AS t_first, max(t1) - 3 AS t_last,
    flatten(list(range(t0, t1 + 1))) AS covers
  FROM runs GROUP BY doc_id, template, label, n_template, diagonal
),
banded AS (
  SELECT *, sum(starts) OVER (PARTITION BY doc_id, template ORDER BY diagonal ROWS UNBOUNDED PRECEDING) AS band
  FROM (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) <= 4 THEN 0 ELSE 1 END AS starts FROM own)
),
outermost AS (
  SELECT * FROM (SELECT *, max(last) OVER (PARTITION BY doc_id, template, band ORDER BY first, last DESC, diagonal ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM banded)
  WHERE reached IS NULL OR last > reached
),
stepped AS (
  SELECT *, CASE WHEN first - lag(last) OVER w <= 20 AND t_first > lag(t_first) OVER w AND t_last > lag(t_last) OVER w THEN 0 ELSE 1 END AS begins
  FROM outermost WINDOW w AS (PARTITION BY doc_id, template, band ORDER BY first, last DESC, diagonal)
),
covers AS (
  SELECT doc_id, template, label, n_template, min(first) AS first, max(last) AS last, flatten(list(covers)) AS covers
  FROM (SELECT *, sum(begins) OVER (PARTITION BY doc_id, template, band ORDER BY first, last DESC, diagonal ROWS UNBOUNDED PRECEDING) AS alignment FROM stepped)
  GROUP BY doc_id, template, label, n_template, band, alignment
  UNION ALL SELECT doc_id, template, label, n_template, first, last, covers FROM own
),
fitting AS (
  SELECT doc_id, label, covered, max(covered) OVER (PARTITION BY doc_id, first) AS best_first, max(covered) OVER (PARTITION BY doc_id, last) AS best_last FROM (
    SELECT *, len(list_distinct(covers)) / n_template AS covered FROM covers)
  WHERE covered >= 0.6 AND last - first + 1 <= 2 * n_template),
verified AS (SELECT doc_id, label, covered FROM fitting WHERE greatest(best_first, best_last) <= covered),
named AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS labels
  FROM (SELECT doc_id, label FROM places UNION SELECT doc_id, label FROM verified) GROUP BY doc_id),
base_named AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS labels FROM (SELECT DISTINCT doc_id, label FROM places) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, CAST(coalesce(b.n_base, 0) AS BIGINT) AS n_base,
  CAST(b.first_word AS BIGINT) AS first_word, CAST(b.last_word AS BIGINT) AS last_word,
  coalesce(bn.labels, '') AS base_labels, coalesce(n.labels, '') AS labels,
  CASE WHEN b.n_base > 0 THEN 1.0::DOUBLE ELSE coalesce((SELECT max(covered) FROM verified v WHERE v.doc_id = d.doc_id), 0)::DOUBLE END AS score
FROM docs d LEFT JOIN base b ON d.doc_id = b.doc_id LEFT JOIN named n ON d.doc_id = n.doc_id LEFT JOIN base_named bn ON d.doc_id = bn.doc_id
"""

ORACLES |= {"op9_license_scan": OP9}


def _valued(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"coalesce(CAST(octet_length(encode({text})) AS VARCHAR) || ':' || {text}, '-')"


def _tree_levels(name: str, levels: int) -> str:
    """CTEs ``name``1 ... of the nodes (tree, i, h, cnt) of each level over ``name``0, and their siblings."""
    made = []
    for k in range(levels):
        run = "PARTITION BY tree, i // 8 ORDER BY i ROWS BETWEEN"
        made.append(f"""
{name}_s{k} AS (
  SELECT tree, i, cnt, coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name}{k} WHERE cnt > 1
),
{name}{k + 1} AS (
  SELECT tree, i // 8 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h, (any_value(cnt) + 7) // 8 AS cnt FROM {name}{k} WHERE cnt > 1 GROUP BY tree, i // 8
  UNION ALL SELECT tree, i, h, cnt FROM {name}{k} WHERE cnt = 1
)""")
    return ",".join(made)


def _merkle(levels: int = 8, top_levels: int = 3) -> str:
    """Levels: of a language's tree (8 to this power leaves) and of the languages' own."""
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    leaf = "sha256(" + " || ".join(_valued(c) for c in ("doc_id", "source", "lang", "n_chars", "text")) + ")"
    now = "sha256(" + " || ".join(_valued(c) for c in ("doc_id", "source", "lang", "n_chars", lowered)) + ")"
    digits = "list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT))"
    bits = "list_prepend(xor(a, b), [1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[])"
    crc = f"xor(list_reduce({digits}, lambda a, b: list_reduce({bits}, lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"
    joins, path = [], []
    for name, at, n in (("t", "d.i", levels), ("u", "d.place", top_levels)):
        for k in range(n):
            s = f"{name}_s{k}"
            tree = "d.tree" if name == "t" else "'top'"
            joins.append(f"LEFT JOIN {s} ON {s}.tree = {tree} AND {s}.i = {at} // {8**k}")
            path.append(f"coalesce({s}.l || {s}.r, '')")
    names = [f"t_s{k}" for k in range(levels)] + [f"u_s{k}" for k in range(top_levels)]
    folds = []
    for k, s in enumerate(names):
        folds.append(f"f{k + 1} AS (SELECT * EXCLUDE (f), CASE WHEN s{k}.l IS NULL THEN f ELSE sha256(s{k}.l || f || s{k}.r) END AS f FROM f{k})")
    steps = ", ".join(f"struct_pack(l := {s}.l, r := {s}.r) AS s{k}" for k, s in enumerate(names))
    return f"""
WITH hashed AS (SELECT doc_id, lang, {leaf} AS leaf, CASE WHEN {crc} % 3 = 0 THEN {now} ELSE {leaf} END AS leaf_now FROM documents),
d AS (
  SELECT *, coalesce('=' || lang, '') AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    dense_rank() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS place, count(*) OVER (PARTITION BY lang) AS cnt FROM hashed
),
t0 AS (SELECT tree, i, leaf AS h, cnt FROM d),{_tree_levels("t", levels)},
subroots AS (SELECT DISTINCT d.tree, d.place, t{levels}.h AS subroot FROM d JOIN t{levels} ON t{levels}.tree = d.tree),
u0 AS (SELECT 'top' AS tree, place AS i, subroot AS h, count(*) OVER () AS cnt FROM subroots),{_tree_levels("u", top_levels)},
f0 AS (
  SELECT d.doc_id, d.leaf, s.subroot, u{top_levels}.h AS root, sha256({" || ".join(path)}) AS proof_sha256, d.leaf_now AS f, {steps}
  FROM d JOIN subroots s ON s.tree = d.tree CROSS JOIN u{top_levels} {" ".join(joins)}
),
{", ".join(folds)}
SELECT doc_id, leaf, subroot, root, proof_sha256, f AS folded_root, f = root AS verified FROM f{len(names)}
"""


ORACLES["op11_merkle_manifest"] = _merkle()


def _clusters(clusters: int = 16, rounds: int = 3, dim: int = 64) -> str:
    finite = "list_bool_and(list_transform(embedding, lambda v: v IS NOT NULL AND isfinite(v)))"
    made = []
    for k in range(rounds + 1):
        made.append(f"""
a{k} AS (
  SELECT pid, c, distance FROM (
    SELECT pid, c, distance, row_number() OVER (PARTITION BY pid ORDER BY distance, c) AS r
    FROM (SELECT x.pid, m.c, sum((x.v - m.v) * (x.v - m.v)) AS distance FROM x JOIN m{k} m ON x.d = m.d GROUP BY x.pid, m.c)
  ) WHERE r = 1
)""")
        if k < rounds:
            made.append(f"""
m{k + 1} AS (
  SELECT c, d, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS v
  FROM (SELECT a.c, x.d, sum(x.v) AS s, count(*) AS n FROM x JOIN a{k} a ON a.pid = x.pid GROUP BY a.c, x.d)
  UNION ALL SELECT c, d, v FROM m{k} WHERE c NOT IN (SELECT c FROM a{k})
)""")
    return f"""
WITH kept AS (
  SELECT row_number() OVER () AS pid, vec_id, embedding, row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR))) - 1 AS place
  FROM embeddings WHERE len(embedding) = {dim} AND {finite}
),
x AS (SELECT pid, place, d, CAST(floor(64 * CAST(embedding[d] AS DOUBLE)) AS BIGINT) AS v FROM (SELECT *, unnest(range(1, {dim + 1})) AS d FROM kept)),
m0 AS (SELECT place AS c, d, v FROM x WHERE place < {clusters}),{",".join(made)},
named AS (SELECT c, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM m{rounds} GROUP BY c)
SELECT k.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.distance AS BIGINT) AS distance,
  CAST(sum(a.distance) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.distance) OVER () AS BIGINT) AS inertia, n.centroid_sha256
FROM a{rounds} a JOIN kept k ON k.pid = a.pid JOIN named n ON n.c = a.c
"""


ORACLES["op12_centroids"] = _clusters()

#: Every pair of a label is compared; components by reachability.
OP13 = """
WITH RECURSIVE v AS (SELECT row_number() OVER () AS pid, vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
good AS (
  SELECT pid, vec_id, label, e FROM v
  WHERE label IS NOT NULL AND len(e) > 0 AND list_bool_and(list_transform(e, lambda x: x IS NOT NULL AND isfinite(x))) AND list_bool_or(list_transform(e, lambda x: x <> 0))
),
links AS (
  SELECT a.pid AS p, b.pid AS q FROM good a JOIN good b ON a.label = b.label AND len(a.e) = len(b.e) AND a.pid <> b.pid
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
),
reached AS (SELECT pid AS p, pid AS q FROM v UNION SELECT r.p, l.q FROM reached r JOIN links l ON l.p = r.q),
named AS (SELECT r.p, min(v.vec_id) AS component_id FROM reached r JOIN v ON v.pid = r.q GROUP BY r.p),
counted AS (SELECT p, count(*) AS n FROM links GROUP BY p)
SELECT v.vec_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_links, n.component_id, v.vec_id = n.component_id AS kept
FROM v JOIN named n ON n.p = v.pid LEFT JOIN counted c ON c.p = v.pid
"""
ORACLES["op13_embedding_dedup"] = OP13
