"""DuckDB SQL for the queries that SQL can express.

The others need what SQL lacks: the hash of SimHash fingerprints, spans of parsers, alignment,
retrieval with a fitted index, a fitted model, Newton steps, a tokeniser. Tests hold them against
brute force, held-out rows or an exact round trip.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op1_preference"] = """
WITH turns AS (
  SELECT conv_id, coalesce(role, 'user') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id
                            ORDER BY turn NULLS FIRST, coalesce(role, 'user'), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
talks AS (SELECT conv_id, max(pos) FILTER (WHERE role = 'assistant') AS at FROM turns GROUP BY conv_id),
answers AS (
  SELECT xor(t.conv_id, 1) AS conv_id, u.role, u.text
  FROM talks t JOIN turns u ON u.conv_id = t.conv_id AND u.pos = t.at),
rejected AS (
  SELECT u.* FROM turns u JOIN talks t USING (conv_id) WHERE t.at IS NULL OR u.pos < t.at
  UNION ALL
  SELECT t.conv_id, a.role, a.text, t.at FROM talks t JOIN answers a USING (conv_id) WHERE t.at IS NOT NULL),
apart AS (
  SELECT coalesce(c.conv_id, r.conv_id) AS conv_id,
         min(coalesce(c.pos, r.pos)) FILTER (
           WHERE c.role IS DISTINCT FROM r.role OR c.text IS DISTINCT FROM r.text) AS pos
  FROM turns c FULL JOIN rejected r ON c.conv_id = r.conv_id AND c.pos = r.pos GROUP BY 1),
common AS (
  SELECT t.conv_id, CAST(coalesce(a.pos - 1, (SELECT count(*) FROM turns u WHERE u.conv_id = t.conv_id)) AS INTEGER) AS n
  FROM talks t JOIN apart a USING (conv_id)),
sides AS (SELECT 'c' AS side, * FROM turns UNION ALL SELECT 'r', * FROM rejected),
parts AS (
  SELECT s.side, s.conv_id, s.pos, s.role, s.pos <= m.n AS shared,
         '<|im_start|>' || replace(s.role, '<|', '< |') || chr(10) AS head,
         replace(s.text, '<|', '< |') || '<|im_end|>' AS body
  FROM sides s JOIN common m USING (conv_id)),
placed AS (
  SELECT *, sum(length(head) + length(body) + 1) OVER (PARTITION BY side, conv_id, shared ORDER BY pos) AS upto
  FROM parts),
written AS (
  SELECT side, conv_id, shared, string_agg(head || body || chr(10), '' ORDER BY pos) AS text,
         coalesce(string_agg(CAST(upto - 1 - length(body) AS BIGINT) || ':' || CAST(upto - 1 AS BIGINT), ',' ORDER BY pos)
                  FILTER (WHERE role = 'assistant'), '') AS mask
  FROM placed GROUP BY 1, 2, 3)
SELECT m.conv_id, coalesce(p.text, '') AS prompt, m.n AS prompt_turns,
       coalesce(c.text, '') AS chosen_completion, coalesce(r.text, '') AS rejected_completion,
       coalesce(c.mask, '') AS chosen_mask, coalesce(r.mask, '') AS rejected_mask,
       coalesce(c.mask, '') <> '' AND coalesce(r.mask, '') <> '' AS usable
FROM common m
LEFT JOIN written p ON p.conv_id = m.conv_id AND p.side = 'c' AND p.shared
LEFT JOIN written c ON c.conv_id = m.conv_id AND c.side = 'c' AND NOT c.shared
LEFT JOIN written r ON r.conv_id = m.conv_id AND r.side = 'r' AND NOT r.shared
"""

ORACLES["op5_line_dedup"] = """
WITH raw AS (
  SELECT doc_id, len(string_split(text, chr(10))) AS total, unnest(string_split(text, chr(10))) AS raw,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line
  FROM documents WHERE text IS NOT NULL),
bare AS (
  SELECT *, trim(raw, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS bare FROM raw),
ended AS (
  SELECT doc_id, line, bare, CAST(length(bare) AS BIGINT) AS chars,
         CAST(sum(length(bare)) OVER (PARTITION BY doc_id ORDER BY line) AS BIGINT) AS upto,
         coalesce(lead(line) OVER (PARTITION BY doc_id ORDER BY line), total) - 1 AS until
  FROM bare WHERE bare <> ''),
placed AS (SELECT *, upto - chars AS begun FROM ended),
windows AS (
  SELECT doc_id, min(line) OVER o AS first, max(until) OVER o AS last,
         max(upto) OVER o - min(begun) OVER o AS size, list(bare) OVER o AS whole
  FROM placed WINDOW o AS (PARTITION BY doc_id ORDER BY begun RANGE BETWEEN CURRENT ROW AND 199 FOLLOWING)
  UNION
  SELECT doc_id, min(line) OVER b, max(until) OVER b, max(upto) OVER b - min(begun) OVER b, list(bare) OVER b
  FROM placed WINDOW b AS (PARTITION BY doc_id ORDER BY upto RANGE BETWEEN 199 PRECEDING AND CURRENT ROW)),
seen AS (
  SELECT doc_id, first, last, row_number() OVER (PARTITION BY whole ORDER BY doc_id, first) AS n
  FROM windows WHERE size >= 200),
gone AS (SELECT DISTINCT doc_id, unnest(range(first, last + 1)) AS line FROM seen WHERE n > 1),
kept AS (
  SELECT r.doc_id, string_agg(r.raw, chr(10) ORDER BY r.line) FILTER (WHERE g.line IS NULL) AS text,
         CAST(count(g.line) AS INTEGER) AS removed_lines
  FROM raw r LEFT JOIN gone g ON g.doc_id = r.doc_id AND g.line = r.line GROUP BY r.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       coalesce(k.removed_lines, 0) AS removed_lines
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

ORACLES["op7_vafile"] = """
WITH whole AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score
  FROM scores)
SELECT * FROM ranked WHERE rank <= 10
"""


ORACLES["op11_line_frequency"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
worded AS (
  SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM docs),
raw AS (
  SELECT r, source, text, generate_subscripts(string_split(text, chr(10)), 1) AS line, unnest(string_split(text, chr(10))) AS raw
  FROM docs),
plain AS (
  SELECT *, regexp_replace(regexp_replace(trim(regexp_replace(
           translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g'), ' '),
           '[0-9]+', '0', 'g'), '^$', '') AS plain
  FROM raw),
lines AS (SELECT * FROM plain WHERE plain <> ''),
hosts AS (SELECT source, count(DISTINCT text) AS held FROM lines GROUP BY source),
above AS (
  SELECT l.source, l.plain FROM lines l JOIN hosts h ON h.source IS NOT DISTINCT FROM l.source
  GROUP BY l.source, l.plain, h.held HAVING count(DISTINCT l.text) > 6 AND count(DISTINCT l.text) > h.held * 0.001),
lost AS (
  SELECT l.r, count(*) AS n_removed_lines, CAST(sum(len(string_split(l.plain, ' '))) AS BIGINT) AS n_gone
  FROM lines l JOIN above a ON a.source IS NOT DISTINCT FROM l.source AND a.plain = l.plain GROUP BY l.r),
doubled AS (SELECT r, count(*) - count(DISTINCT raw) AS n_dup_lines FROM lines GROUP BY r),
windows AS (
  SELECT r, unnest(range(1, len(words) - 6)) AS pos, words FROM worded WHERE len(words) >= 8),
shown AS (SELECT r, pos, array_to_string(words[pos:pos + 7], ' ') AS shown FROM windows),
twice AS (SELECT r, pos, count(*) OVER (PARTITION BY r, shown) AS n FROM shown),
covered AS (
  SELECT r, least(8, coalesce(lead(pos) OVER (PARTITION BY r ORDER BY pos) - pos, 8)) AS step FROM twice WHERE n > 1),
repeats AS (SELECT r, CAST(sum(step) AS BIGINT) AS n_repeat_words FROM covered GROUP BY r),
facts AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(n_removed_lines, 0) AS n_removed_lines, len(words) - coalesce(n_gone, 0) AS n_left
  FROM worded w LEFT JOIN doubled USING (r) LEFT JOIN repeats USING (r) LEFT JOIN lost USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND n_left >= 20 AND n_left >= n_words * 0.2 AS kept,
       n_removed_lines, n_left
FROM facts
"""

ORACLES["op12_collocations"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents WHERE text IS NOT NULL),
pieces AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs),
split AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM pieces),
spans AS (
  SELECT lang, words, unnest(range(1, len(words) + 1)) AS pos FROM split WHERE len(words) > 0),
entries AS (SELECT lang, words[pos] AS w1, words[pos + 1] AS w2, words[pos + 2] AS w3 FROM spans),
totals AS (SELECT lang, count(*) AS n FROM entries GROUP BY lang),
ones AS (SELECT lang, w1, count(*) AS f FROM entries GROUP BY ALL),
twos AS (SELECT lang, w1, w2, count(*) AS f FROM entries WHERE w2 IS NOT NULL GROUP BY ALL),
threes AS (SELECT lang, w1, w2, w3, count(*) AS f FROM entries WHERE w3 IS NOT NULL GROUP BY ALL),
cuts AS (
  SELECT t.lang, t.w1, t.w2, NULL AS w3, t.f AS a, 1 AS k, l.f AS l, r.f AS r
  FROM twos t JOIN ones l ON l.lang = t.lang AND l.w1 = t.w1 JOIN ones r ON r.lang = t.lang AND r.w1 = t.w2 WHERE t.f >= 10
  UNION ALL
  SELECT t.lang, t.w1, t.w2, t.w3, t.f, 1, l.f, r.f
  FROM threes t JOIN ones l ON l.lang = t.lang AND l.w1 = t.w1
  JOIN twos r ON r.lang = t.lang AND r.w1 = t.w2 AND r.w2 = t.w3 WHERE t.f >= 10
  UNION ALL
  SELECT t.lang, t.w1, t.w2, t.w3, t.f, 2, l.f, r.f
  FROM threes t JOIN twos l ON l.lang = t.lang AND l.w1 = t.w1 AND l.w2 = t.w2
  JOIN ones r ON r.lang = t.lang AND r.w1 = t.w3 WHERE t.f >= 10),
valued AS (
  SELECT *, CAST((1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts),
lowest AS (
  SELECT * FROM valued QUALIFY row_number() OVER (PARTITION BY lang, w1, w2, w3 ORDER BY score, k) = 1),
inside AS (
  SELECT lang, u, v, max(a) AS a FROM (
    SELECT lang, w1 AS u, w2 AS v, a FROM lowest WHERE w3 IS NOT NULL
    UNION ALL SELECT lang, w2, w3, a FROM lowest WHERE w3 IS NOT NULL) GROUP BY lang, u, v),
alone AS (
  SELECT c.* FROM lowest c LEFT JOIN inside i ON c.w3 IS NULL AND i.lang = c.lang AND i.u = c.w1 AND i.v = c.w2
  WHERE i.a IS NULL OR 100 * i.a < 50 * c.a),
ranked AS (
  SELECT lang, concat_ws(' ', w1, w2, w3) AS phrase, a, l, r, score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, concat_ws(' ', w1, w2, w3)) AS rank
  FROM alone)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


# crc32 bit by bit: a byte of the decimal doc_id is mixed in, then eight steps (-1) follow.
ORACLES["op13_periodic"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS own
  FROM documents),
coded AS (
  SELECT r, doc_id, own, len(own) AS n,
         xor(4294967295, list_reduce(
           flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                                  lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
           lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END,
           4294967295)) AS h
  FROM docs),
placed AS (
  SELECT *, (h // 10) % n AS a, 1 + (n - (h // 10) % n) // (3 + (h // 10) % 8) AS p, h % 10 = 0 AND n > 0 AS changed FROM coded),
words AS (
  SELECT r, n, i, CASE WHEN changed AND i >= a THEN own[a + (i - a) % p + 1] ELSE own[i + 1] END AS w
  FROM (SELECT *, unnest(range(0, n)) AS i FROM placed)),
same AS (
  SELECT y.r, y.i, y.i - x.i AS q FROM words x JOIN words y
  ON x.r = y.r AND x.w = y.w AND y.i > x.i AND 4 * (y.i - x.i) <= y.n),
numbered AS (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS stretch FROM same),
stretches AS (
  SELECT r, q, min(i) - q AS s, count(*) + q AS len FROM numbered GROUP BY r, q, stretch
  HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (
  SELECT * FROM stretches x WHERE NOT EXISTS (
    SELECT 1 FROM stretches y WHERE y.r = x.r AND y.q < x.q AND y.s <= x.s AND y.s + y.len >= x.s + x.len)),
listed AS (
  SELECT r, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS listed,
         arg_min({'s': s, 'len': len, 'q': q}, (-len, s, q)) AS best
  FROM runs GROUP BY r),
gone AS (SELECT DISTINCT r, unnest(range(s + q, s + len)) AS i FROM runs),
kept AS (
  SELECT w.r, string_agg(w.w, ' ' ORDER BY w.i) AS kept FROM words w LEFT JOIN gone g ON g.r = w.r AND g.i = w.i
  WHERE g.i IS NULL GROUP BY w.r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, CAST(best.s AS BIGINT) AS start, CAST(best.len AS BIGINT) AS length,
       CAST(best.q AS BIGINT) AS period, CAST(1000 * best.len // best.q AS BIGINT) AS exponent_milli,
       sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM docs LEFT JOIN listed USING (r) LEFT JOIN kept USING (r)
"""


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
