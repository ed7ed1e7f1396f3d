"""DuckDB SQL for the operators that SQL can express."""
from __future__ import annotations

_ABC = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP12 = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM docs),
keyed AS (SELECT *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))), {_ABC}) AS key FROM lines),
common AS (SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40 AND doc_id IS NOT NULL
           GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (SELECT k.*, c.key IS NOT NULL AND k.doc_id IS DISTINCT FROM c.keeper AS gone FROM keyed k LEFT JOIN common c USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY r, doc_id
"""

OP13 = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), {_ABC}), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
occurring AS (SELECT lang, unnest(list_transform(range(1, least(3, len(w) - i + 1) + 1), lambda m: w[i:i + m - 1])) AS g FROM starts),
grams AS (SELECT lang, len(g) AS size, array_to_string(g, ' ') AS phrase, count(*) AS f FROM occurring GROUP BY ALL),
words AS (SELECT lang, sum(f) AS n FROM grams WHERE size = 1 GROUP BY lang),
cand AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE size > 1 AND f >= 10),
cuts AS (SELECT *, unnest(range(1, size)) AS k FROM cand),
scored AS (
  SELECT c.lang, c.size, c.phrase, c.a, c.w, c.k, x.f AS l, y.f AS r,
         (1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN grams x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
              JOIN grams y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:c.size], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, part, max(a) AS a FROM (
    SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS part FROM cand WHERE size = 3)
  GROUP BY lang, part),
kept AS (SELECT b.* FROM best b LEFT JOIN longer o ON o.lang = b.lang AND o.part = b.phrase
         WHERE b.size = 3 OR o.a IS NULL OR 100 * o.a < 50 * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked JOIN words USING (lang) WHERE rank <= 2000
"""

ORACLES: dict[str, str] = {"op12_line_dedup": OP12, "op13_collocations": OP13}
