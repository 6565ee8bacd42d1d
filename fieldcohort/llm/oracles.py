"""Reference SQL (DuckDB) of the queries that SQL can express, by other means than theirs."""

from __future__ import annotations

import re

from . import chat_format as c
from . import decontaminate as d
from . import line_quality as q
from . import phrases as p


def _seed(alias: str, place: str, mask: str) -> str:
    return " || ' ' || ".join(f"{alias}[{place} + {i + 1}]" for i, bit in enumerate(mask) if bit == "1")


_MASKED = "\n".join(
    f"  UNION ALL SELECT {{keys}}, p AS place, {n} AS mask, {_seed('w', 'p', mask)} AS seed FROM {{source}}, range(0, greatest(len(w) - {d.SPAN - 1}, 0)) AS r(p)" for n, mask in enumerate(d.MASKS)
).replace("  UNION ALL ", "  ", 1)

OP1 = f"""
WITH words_of AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\s[:punct:]]+'), lambda x: x <> '') AS w FROM documents),
items AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\s[:punct:]]+'), lambda x: x <> '') AS w FROM benchmark),
theirs AS (
{_MASKED.format(keys="doc_id", source="words_of")}),
ours AS (
{_MASKED.format(keys="item_id", source="items")}),
hits AS (
  SELECT DISTINCT t.doc_id, o.item_id, t.place - o.place AS shift, o.place AS spot
  FROM theirs t JOIN ours o ON t.mask = o.mask AND t.seed = o.seed),
spans AS (
  SELECT h.*, greatest(spot - {d.MARGIN}, 0, -shift) AS low,
         least(spot + {d.SPAN + d.MARGIN}, len(i.w), len(x.w) - shift) - 1 AS high, i.w AS iw, x.w AS dw
  FROM hits h JOIN items i USING (item_id) JOIN words_of x USING (doc_id)),
counted AS (
  SELECT doc_id, item_id, high - low + 1 AS size,
         len(list_filter(range(low, high + 1), lambda k: iw[k + 1] = dw[k + shift + 1])) AS same
  FROM spans)
SELECT doc_id, item_id, max(same)::BIGINT AS n_equal FROM counted
WHERE same >= {d.MIN_EQUAL} AND 100 * same >= {d.MIN_SHARE_PCT} * size GROUP BY doc_id, item_id
"""

OP3 = f"""
WITH docs AS (
  SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS t FROM docs, range(1, greatest(len(w) - 1, 1)) AS r(p)),
found_twice AS (
  SELECT doc_id, p FROM windows JOIN (SELECT doc_id, t FROM windows GROUP BY doc_id, t HAVING count(*) > 1) USING (doc_id, t)),
repeats AS (
  SELECT doc_id, count(DISTINCT p + k) AS n FROM found_twice, range(0, 3) AS r(k) GROUP BY doc_id),
lines AS (
  SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM docs),
dup AS (
  SELECT doc_id, sum(n - 1) AS n FROM (SELECT doc_id, line, count(*) AS n FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id, line) GROUP BY doc_id),
keyed AS (
  SELECT *, trim(regexp_replace(regexp_replace(lower(line), '[0-9]', '0', 'g'), '[ \\t\\r]+', ' ', 'g')) AS key FROM lines WHERE trim(line, ' ' || chr(9) || chr(13)) <> ''),
sizes AS (SELECT source, count(DISTINCT text) AS size FROM docs GROUP BY source),
frequent AS (
  SELECT k.source, k.key FROM keyed k JOIN sizes s ON k.source = s.source GROUP BY k.source, k.key, s.size
  HAVING count(DISTINCT k.text) >= {q.LEAST_DOCUMENTS} AND 100 * count(DISTINCT k.text) >= {q.LEAST_SHARE_PCT} * s.size),
gone AS (
  SELECT doc_id, count(*) AS n, sum(len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+'))) AS lost FROM keyed JOIN frequent USING (source, key) GROUP BY doc_id),
base AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_dup_lines,
         coalesce(r.n, 0)::BIGINT AS n_repeat_words, coalesce(g.n, 0)::BIGINT AS n_removed, (len(w) - coalesce(g.lost, 0))::BIGINT AS n_left
  FROM docs d LEFT JOIN dup USING (doc_id) LEFT JOIN repeats r USING (doc_id) LEFT JOIN gone g USING (doc_id)),
judged AS (SELECT *, n_words < {q.FEWEST_WORDS} OR 100 * n_repeat_words > {q.REPEATED_PCT} * n_words AS base_failed FROM base)
SELECT *, NOT base_failed AND 100 * n_left >= {q.REMAINING_PCT} * n_words AS kept FROM judged
"""

OP5 = """
WITH RECURSIVE words_of AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS s FROM words_of, range(1, greatest(len(w) - 3, 2)) AS r(p) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT x, y FROM pairs JOIN sizes sx ON x = sx.doc_id JOIN sizes sy ON y = sy.doc_id WHERE 100 * shared >= 75 * (sx.n + sy.n - shared)),
sides AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (
  SELECT x AS doc_id, x AS other FROM sides
  UNION SELECT r.doc_id, s.y FROM reach r JOIN sides s ON r.other = s.x),
low AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component_id, d.doc_id) AS component_id, coalesce(component_id, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN low USING (doc_id)
"""

OP8 = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
bits AS (
  SELECT page_id, html, array_to_string(list_transform(string_split(sha1(html), ''), lambda h: lpad(bin(position(h IN '0123456789abcdef') - 1), 4, '0')), '') AS b FROM payloads),
digests AS (
  SELECT page_id, html, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (16 * substr(b, (5 * i + 1)::BIGINT, 1)::INT + 8 * substr(b, (5 * i + 2)::BIGINT, 1)::INT + 4 * substr(b, (5 * i + 3)::BIGINT, 1)::INT
     + 2 * substr(b, (5 * i + 4)::BIGINT, 1)::INT + substr(b, (5 * i + 5)::BIGINT, 1)::INT + 1)::BIGINT, 1)), '') AS payload_digest FROM bits),
last AS (SELECT html, max(page_id) AS page FROM payloads GROUP BY html)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, payload_digest, CASE WHEN page_id = page THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> page THEN page END AS refers_to
FROM digests JOIN last USING (html)
"""

_GRAMS = " UNION ALL ".join(f"SELECT lang, {k} AS k, array_to_string(w[i:i + {k - 1}], ' ') AS phrase FROM words_of, range(1, greatest(len(w) - {k - 2}, 1)) AS r(i)" for k in (1, 2, 3))

OP12 = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
words_of AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
counted AS (
  SELECT lang, k, phrase, count(*)::HUGEINT AS f FROM ({_GRAMS}) GROUP BY lang, k, phrase),
sizes AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE k = 1 GROUP BY lang),
candidates AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE k > 1 AND f >= {p.LEAST}),
cuts AS (
  SELECT c.lang, c.k, c.phrase, c.a, r.i, x.f AS l, y.f AS r, (1000000 * c.a * c.a) // (x.f * y.f) AS score
  FROM candidates c, range(1, 3) AS r(i)
  JOIN counted x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:r.i], ' ')
  JOIN counted y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[r.i + 1:c.k], ' ')
  WHERE r.i < c.k),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1),
covered AS (
  SELECT lang, array_to_string(w[s:s + 1], ' ') AS phrase, max(a) AS longer FROM candidates, range(1, 3) AS t(s) WHERE k = 3 GROUP BY 1, 2),
left_over AS (
  SELECT x.* FROM lowest x LEFT JOIN covered v ON x.k = 2 AND v.lang = x.lang AND v.phrase = x.phrase
  WHERE v.longer IS NULL OR 100 * v.longer < {p.COVERED_PCT} * x.a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM left_over)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN sizes USING (lang) WHERE rank <= {p.TOP}
"""

_CONTROL = "|".join(f"{re.escape(f)}\\\\*(?:{'|'.join(re.escape(x[1:]) for x in c.CONTROLS if x[0] == f)})" for f in sorted({x[0] for x in c.CONTROLS}))

OP13 = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, i, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(i, r)),
ordered AS (
  SELECT *, row_number() OVER w AS place, lag(role) OVER w AS before,
         length(text) + len(regexp_extract_all(text, '{_CONTROL}')) AS size, length(role) + len(regexp_extract_all(role, '{_CONTROL}')) AS head
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
said AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY place) AS spoken,
         coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '') AS learnt,
         sum(size + CASE WHEN before = role THEN {len(c.NEXT)} ELSE head + {len(c.OPEN) + len(c.BODY) + len(c.CLOSE)} END) AS chars
  FROM ordered GROUP BY conv_id)
SELECT conv_id::BIGINT AS conv_id, n_turns, sha256(spoken) AS turns_sha256, length(learnt)::BIGINT AS loss_chars,
       sha256(learnt) AS loss_sha256, chars::BIGINT AS formatted_chars FROM said
"""
