"""SQL for a second engine, with the results of those queries that SQL can express."""

from __future__ import annotations

from regiobank.llm.licenses import NOTICES

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

DECONTAMINATION = f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, list_slice(w, p, p + least(13, len(w)) - 1) AS x
  FROM items, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS t(p) WHERE len(w) > 0),
places AS (
  SELECT doc_id, n, p, list_slice(w, p, p + n - 1) AS x
  FROM docs, (SELECT DISTINCT n FROM windows), unnest(generate_series(1, len(w) - n + 1)) AS t(p)),
found AS (SELECT doc_id, p, n, item_id FROM places JOIN windows USING (n, x)),
hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (
  SELECT doc_id, unnest(generate_series(p, p + n - 1)) AS q FROM (SELECT DISTINCT doc_id, p, n FROM found)) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS list
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN ids USING (doc_id)
"""

TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, r.vec_id, CAST(list_sum(list_transform(list_zip(q.v, r.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v AS q, v AS r WHERE q.vec_id % 50 = 0 AND q.vec_id <> r.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 5
"""

SUBSTRINGS = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, p, list_slice(w, p, p + 19) AS x FROM docs, unnest(generate_series(1, len(w) - 19)) AS t(p)),
later AS (SELECT doc_id, p FROM (
  SELECT doc_id, p, row_number() OVER (PARTITION BY x ORDER BY doc_id, p) AS nth FROM windows) WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(p, p + 19)) AS q FROM later),
words AS (SELECT doc_id, q, w[q] AS word FROM docs, unnest(generate_series(1, len(w))) AS t(q)),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY q) AS text FROM words ANTI JOIN gone USING (doc_id, q)
  GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""


_NOTICES = ", ".join("('{}', '{}', '{}')".format(*(part.replace("'", "''") for part in notice)) for notice in NOTICES)
_SET = r"list_distinct(regexp_extract_all(lower({}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'))"

LICENSES = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
phrases AS (SELECT string_split(p, ' ') AS p, label
  FROM (VALUES ('mit license', 'mit'), ('apache license', 'apache'), ('general public license', 'gpl')) AS t(p, label)),
places AS (
  SELECT doc_id, i, label FROM docs, phrases, unnest(generate_series(0, len(w) - len(p))) AS t(i)
  WHERE list_slice(w, i + 1, i + len(p)) = p),
base AS (SELECT doc_id, count(*) AS n, min(i) AS a, max(i) AS b FROM places GROUP BY doc_id),
notices AS (
  SELECT label, {_SET.format("text")} AS s, {_SET.format("naming")} AS naming,
    CASE WHEN len({_SET.format("text").replace("list_distinct", "")}) <= 8 THEN 8
      WHEN len({_SET.format("text").replace("list_distinct", "")}) <= 16 THEN 16 ELSE 32 END AS width
  FROM (VALUES {_NOTICES}) AS t(label, text, naming)),
blocks AS (
  SELECT doc_id, width, block, list_distinct(list_slice(w, block * width + 1, block * width + 2 * width)) AS s
  FROM docs, (VALUES (8), (16), (32)) AS v(width), unnest(generate_series(0, (len(w) - 1) // width)) AS t(block)),
held AS (
  SELECT doc_id, width, block, label, n.s, len(list_intersect(l.s, n.s)) / len(n.s) AS c FROM blocks AS l JOIN notices AS n USING (width)
  WHERE len(list_intersect(l.s, n.s)) >= ceil(round(len(n.s) * 0.8, 9)) AND list_has_all(l.s, n.naming)),
best AS (
  SELECT * FROM held AS x WHERE NOT EXISTS (
    SELECT 1 FROM held AS y WHERE y.doc_id = x.doc_id AND y.width = x.width AND y.block = x.block AND (
      (len(y.s) > len(x.s) AND len(list_intersect(x.s, y.s)) = len(x.s) AND y.c >= x.c)
      OR (len(y.s) < len(x.s) AND len(list_intersect(x.s, y.s)) = len(y.s) AND y.c > x.c)))),
base_labels AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS l FROM (SELECT DISTINCT doc_id, label FROM places) GROUP BY doc_id),
all_labels AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS l FROM (
  SELECT doc_id, label FROM places UNION SELECT doc_id, label FROM best) GROUP BY doc_id),
most AS (SELECT doc_id, max(c) AS c FROM best GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base, a AS first_word, b AS last_word,
  coalesce(bl.l, '') AS base_labels, coalesce(al.l, '') AS labels,
  CASE WHEN n > 0 THEN 1.0 ELSE coalesce(c, 0.0) END::DOUBLE AS score
FROM docs LEFT JOIN base USING (doc_id) LEFT JOIN base_labels AS bl USING (doc_id) LEFT JOIN all_labels AS al USING (doc_id)
LEFT JOIN most USING (doc_id)
"""


COLLOCATIONS = r"""
WITH pieces AS (SELECT doc_id, coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
f AS (
  SELECT lang, list_slice(w, p, p + k - 1) AS x, CAST(count(*) AS BIGINT) AS n
  FROM words, (VALUES (1), (2), (3)) AS s(k), unnest(generate_series(1, len(w) - k + 1)) AS t(p) GROUP BY ALL),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
chosen AS (SELECT lang, x, n AS a FROM f WHERE len(x) > 1 AND n >= 10),
cuts AS (
  SELECT c.lang, c.x, c.a, k, l.n AS l, r.n AS r, (1000000 * c.a::HUGEINT * c.a::HUGEINT) // (l.n::HUGEINT * r.n::HUGEINT) AS score
  FROM chosen AS c, unnest(generate_series(1, len(c.x) - 1)) AS t(k), f AS l, f AS r
  WHERE l.lang = c.lang AND r.lang = c.lang AND l.x = list_slice(c.x, 1, k) AND r.x = list_slice(c.x, k + 1, len(c.x))),
weakest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, x ORDER BY score, k) AS nth FROM cuts) WHERE nth = 1),
held AS (
  SELECT lang, x, max(longer) AS longer FROM (
    SELECT lang, unnest([list_slice(x, 1, 2), list_slice(x, 2, 3)]) AS x, a AS longer FROM chosen WHERE len(x) = 3) GROUP BY ALL),
kept AS (
  SELECT w.*, array_to_string(w.x, ' ') AS phrase FROM weakest AS w LEFT JOIN held AS h ON h.lang = w.lang AND h.x = w.x
  WHERE h.longer IS NULL OR 100 * h.longer < 50 * w.a)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
JOIN totals USING (lang) WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_decontamination": DECONTAMINATION, "op4_top_k": TOP_K, "op8_license_scan": LICENSES, "op10_substring_dedup": SUBSTRINGS, "op11_collocations": COLLOCATIONS}
