"""SQL that must give the same rows as the queries, where SQL can say it."""

from __future__ import annotations

from billtide.llm.mixing import MOST_MEAN

OP1 = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
keyed AS MATERIALIZED (
  SELECT doc_id, i, md5_number(substr(h, 2 * i + 1, 200)) AS m
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS i FROM d)),
firsts AS (
  SELECT m, min(doc_id * 1000000000 + i) AS place FROM keyed GROUP BY m HAVING count(*) > 1),
earlier AS (SELECT doc_id, i FROM keyed JOIN firsts USING (m) WHERE doc_id * 1000000000 + i > place),
spans AS (
  SELECT doc_id, i, i + 100 AS e, max(i + 100) OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM earlier),
numbered AS (
  SELECT *, sum(CASE WHEN before IS NULL OR i > before THEN 1 ELSE 0 END) OVER (
    PARTITION BY doc_id ORDER BY i) AS run
  FROM spans),
runs AS (SELECT doc_id, run, min(i) AS a, max(e) AS b FROM numbered GROUP BY doc_id, run),
edges AS (
  SELECT d.doc_id, h, coalesce(list(a ORDER BY a) FILTER (a IS NOT NULL), []) AS begins,
         coalesce(list(b ORDER BY a) FILTER (a IS NOT NULL), []) AS ends
  FROM d LEFT JOIN runs USING (doc_id) GROUP BY d.doc_id, h)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes,
  CAST(coalesce(list_sum(ends), 0) - coalesce(list_sum(begins), 0) AS BIGINT) AS n_removed,
  CAST(len(begins) AS BIGINT) AS n_spans,
  sha256(unhex(array_to_string(list_transform(range(1, len(begins) + 2), lambda j: substr(h,
    2 * (CASE WHEN j = 1 THEN 0 ELSE ends[j - 1] END) + 1,
    2 * (CASE WHEN j > len(begins) THEN length(h) // 2 ELSE begins[j] END)
      - 2 * (CASE WHEN j = 1 THEN 0 ELSE ends[j - 1] END))), ''))) AS kept_sha256
FROM edges
"""

OP5 = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT vec_id, (SELECT count(*) FROM links WHERE x = vec_id) AS n_links,
  least(vec_id, coalesce(y, vec_id)) AS component_id, vec_id <= coalesce(y, vec_id) AS kept
FROM embeddings LEFT JOIN least ON x = vec_id
"""

OP7 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS n
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d)),
covered AS (
  SELECT doc_id, count(DISTINCT k) AS n
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS k FROM windows WHERE n > 1) GROUP BY doc_id),
lines AS (
  SELECT doc_id, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS ws
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)),
judged AS (
  SELECT doc_id, line, len(ws) AS n, list_sum(list_transform(ws, lambda w: length(w))) AS chars,
    len(list_filter(ws, lambda w: w IN ('|', '»', '›', '·', '•'))) AS bars,
    len(list_filter(ws, lambda w: regexp_matches(w, '([#*$%&<>]|!!|\?\?|!\?)$'))) AS marked,
    ws[1] = '|' AND ws[len(ws)] = '|' AND len(ws) > 2 AS in_table,
    regexp_matches(lower(line), '\b(?:(?:accept|allow|manage|reject|use|uses) (?:all )?cookies|cookie (?:policy|settings|notice|consent)|(?:enable|requires?) javascript|javascript is (?:disabled|required)|privacy policy|terms of (?:use|service)|subscribe (?:to|now|today)|our newsletter|click here|read more|share this|all rights reserved|skip to content)\b') AS furniture,
    regexp_matches(lower(line), '\b(?:cookies|javascript|sign in|log ?in|subscribe|newsletter)\b') AS button
  FROM lines WHERE len(ws) > 0),
failing AS (
  SELECT *, (bars >= 2 AND bars >= 0.15::DOUBLE * n AND NOT in_table) OR (n >= 5 AND marked > 0.3::DOUBLE * n)
    OR (n <= 15 AND furniture) OR (n <= 3 AND button) AS failed FROM judged),
per_doc AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines, count(*) FILTER (failed) AS n_failed_lines,
    coalesce(sum(chars) FILTER (failed), 0) AS lost FROM failing GROUP BY doc_id),
counted AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
    coalesce(n_failed_lines, 0) AS n_failed_lines, CAST(coalesce(lost, 0) AS DOUBLE) AS lost
  FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN per_doc USING (doc_id)),
shares AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    CASE WHEN word_chars > 0 THEN lost / word_chars ELSE 0.0::DOUBLE END AS lost_share FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND lost_share <= 0.3::DOUBLE AS kept, n_failed_lines, lost_share FROM shares
"""

OP11 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS ws FROM documents),
places AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM pieces),
grams AS (SELECT lang, ws, i, unnest(range(1, 6)) AS m FROM places),
counted AS MATERIALIZED (
  SELECT lang, m, array_to_string(ws[i : i + m - 1], ' ') AS phrase, count(*) AS f
  FROM grams WHERE i + m - 1 <= len(ws) GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counted WHERE m = 1 GROUP BY lang),
candidates AS MATERIALIZED (
  SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS ws FROM counted WHERE m > 1 AND f >= 100),
cuts AS (SELECT *, unnest(range(1, m)) AS k FROM candidates),
scores AS (
  SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r, n,
    (1000::HUGEINT * c.a * n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN totals USING (lang)
  JOIN counted x ON x.lang = c.lang AND x.phrase = array_to_string(ws[1 : k], ' ')
  JOIN counted y ON y.lang = c.lang AND y.phrase = array_to_string(ws[k + 1 :], ' ')),
weakest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_parts AS (
  SELECT lang, a, m AS longer, ws, unnest(range(1, m + 1)) AS i FROM candidates),
parts AS (SELECT lang, a, longer, ws, i, unnest(range(2, longer)) AS m FROM inner_parts),
inside AS (
  SELECT DISTINCT p.lang, c.phrase FROM parts p JOIN candidates c
    ON c.lang = p.lang AND i + p.m - 1 <= longer AND c.phrase = array_to_string(p.ws[i : i + p.m - 1], ' ')
  WHERE 100 * p.a >= 100 * c.a),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
    phrase, a, l, r, n, CAST(score AS BIGINT) AS score
  FROM weakest ANTI JOIN inside USING (lang, phrase))
SELECT * FROM ranked WHERE rank <= 2000
"""

OP13 = r"""
WITH RECURSIVE crc_table AS MATERIALIZED (
  SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, i:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, n)) AS steps),
d AS (
  SELECT *, list_transform([CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR), text],
    lambda v: coalesce(octet_length(encode(v)) || ':' || v, '-')) AS fields,
    xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT),
      lambda c, x: xor(c >> 8, steps[(xor(c, x) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) AS crc
  FROM documents, crc_table),
leaves AS MATERIALIZED (
  SELECT doc_id, lang, sha256(array_to_string(fields, '')) AS leaf,
    sha256(array_to_string(list_transform(fields, lambda v, i: CASE WHEN i = 4 AND crc % 7 = 0 AND n_chars IS NOT NULL
      THEN octet_length(encode(CAST(n_chars + 1 AS VARCHAR))) || ':' || (n_chars + 1) ELSE v END), '')) AS shown
  FROM d),
ranked AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves),
levels(lang, level, nodes) AS (
  SELECT lang, 0, list(leaf ORDER BY place) FROM ranked GROUP BY lang
  UNION ALL
  SELECT lang, level + 1, list_transform(range((len(nodes) + 1) // 2),
    lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], ''))) FROM levels WHERE len(nodes) > 1),
subroots AS MATERIALIZED (
  SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS top_place
  FROM levels WHERE len(nodes) = 1),
tops(level, nodes) AS (
  SELECT 0, list(subroot ORDER BY top_place) FROM subroots
  UNION ALL
  SELECT level + 1, list_transform(range((len(nodes) + 1) // 2),
    lambda i: sha256(nodes[2 * i + 1] || coalesce(nodes[2 * i + 2], ''))) FROM tops WHERE len(nodes) > 1),
steps AS (
  SELECT ranked.lang, place, level, CASE WHEN (place >> level) % 2 = 1 THEN 'L' || nodes[(place >> level)]
      ELSE 'R' || coalesce(nodes[(place >> level) + 2], '') END AS step
  FROM ranked JOIN levels ON levels.lang IS NOT DISTINCT FROM ranked.lang WHERE len(nodes) > 1
  UNION ALL
  SELECT ranked.lang, place, 1000 + level, CASE WHEN (top_place >> level) % 2 = 1 THEN 'L' || nodes[(top_place >> level)]
      ELSE 'R' || coalesce(nodes[(top_place >> level) + 2], '') END AS step
  FROM ranked JOIN subroots ON subroots.lang IS NOT DISTINCT FROM ranked.lang, tops WHERE len(nodes) > 1),
ways AS (SELECT lang, place, list(step ORDER BY level) AS way FROM steps GROUP BY lang, place),
folded AS (
  SELECT doc_id, leaf, subroot, (SELECT nodes[1] FROM tops WHERE len(nodes) = 1) AS root,
    sha256(coalesce(array_to_string(list_transform(way, lambda s: substr(s, 2)), ''), '')) AS proof_sha256,
    list_reduce(coalesce(way, []), lambda a, s: CASE WHEN substr(s, 1, 1) = 'L'
      THEN sha256(substr(s, 2) || a) ELSE sha256(a || substr(s, 2)) END, shown) AS folded_root
  FROM ranked JOIN subroots ON subroots.lang IS NOT DISTINCT FROM ranked.lang
  LEFT JOIN ways ON ways.lang IS NOT DISTINCT FROM ranked.lang AND ways.place = ranked.place)
SELECT *, folded_root = root AS verified FROM folded
"""


def op9(weights: dict[str, float], other: float, seed: str = "mix") -> str:
    named = ", ".join(f"('{part}', {weight}::DOUBLE)" for part, weight in weights.items())
    sources = ", ".join(f"'{part}'" for part in weights)
    unit = "CAST(('0x' || substr(md5({}), 1, 13)) AS BIGINT) / 4503599627370496::DOUBLE"
    draw = unit.format(f"'{seed}:' || name || ':' || CAST(j AS VARCHAR)")
    place = unit.format(f"'{seed}:place:' || name || ':' || CAST(copy AS VARCHAR)")
    return rf"""
WITH RECURSIVE wanted(part, weight) AS (VALUES {named}, (NULL, {other}::DOUBLE)),
d AS (
  SELECT *, CASE WHEN source IN ({sources}) THEN source END AS p,
    coalesce(CAST(doc_id AS VARCHAR), 'null:' || md5(coalesce(text, ''))) AS name FROM documents),
sizes AS (SELECT p, sum(coalesce(octet_length(encode(text)), 0)) AS n FROM d GROUP BY p),
known AS (
  SELECT part, weight, coalesce(n, 0) AS n FROM wanted LEFT JOIN sizes ON p IS NOT DISTINCT FROM part),
totals AS (SELECT sum(weight) FILTER (n > 0) AS present, (SELECT sum(n) FROM sizes) AS total FROM known),
means AS (
  SELECT part, CASE WHEN n > 0 AND present > 0 THEN weight / present * total * 1.0::DOUBLE / n ELSE 0 END
    AS mean FROM known, totals),
draws AS (SELECT part, greatest(1, CAST(ceil(mean / {MOST_MEAN}::DOUBLE) AS INT)) AS draws, mean FROM means),
steps(part, draws, mean, k, p, total) AS (
  SELECT part, draws, mean / draws, 0, exp(-(mean / draws)), exp(-(mean / draws)) FROM draws
  UNION ALL
  SELECT part, draws, mean, k + 1, p * (mean / (k + 1)), total + p * (mean / (k + 1)) FROM steps
  WHERE k + 1 <= mean OR p * (mean / (k + 1)) > 1e-18::DOUBLE),
tables AS (SELECT part, draws, list(total ORDER BY k) AS steps FROM steps GROUP BY part, draws),
counted AS (
  SELECT doc_id, source, text, name, list_sum(list_transform(range(1, draws + 1), lambda j:
    len(list_filter(steps, lambda s: s <= {draw})))) AS n
  FROM d JOIN tables ON p IS NOT DISTINCT FROM part),
copies AS (SELECT *, CAST(unnest(range(1, CAST(n AS BIGINT) + 1)) AS INT) AS copy FROM counted)
SELECT doc_id, source, copy, {place} AS place, text FROM copies
"""
