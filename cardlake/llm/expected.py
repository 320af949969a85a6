r"""Rows of exact operators as DuckDB SQL over ``documents``, one row for each doc_id.

Plain restatements of what is asked for: every window or shingle of every whole text is compared, without
sketches, segments or transforms. Windows are compared by MD5, which keeps memory in bounds.
"""

#: Words of a text, and (below) its lower-cased ones.
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SUBSTRINGS_SQL = f"""
WITH texts AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
windows AS (
  SELECT doc_id, s, md5_number(array_to_string(w[s : s + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS s FROM texts WHERE len(w) >= 50)),
repeated AS (
  SELECT doc_id, s AS p FROM (SELECT *, min(doc_id) OVER (PARTITION BY h) AS first_id FROM windows)
  WHERE doc_id > first_id),
words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM texts),
judged AS (
  SELECT doc_id, p, word, max(repeated.p IS NOT NULL) OVER (
    PARTITION BY doc_id ORDER BY p ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
  FROM words LEFT JOIN repeated USING (doc_id, p)),
texts_left AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
    string_agg(word, ' ' ORDER BY p) FILTER (WHERE NOT gone) AS kept
  FROM judged GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN texts_left USING (doc_id)
"""

BYTES_SQL = """
WITH texts AS (SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
windows AS (
  SELECT doc_id, s, md5_number(hex(array_slice(b, s, s + 99))) AS h
  FROM (SELECT doc_id, b, unnest(range(1, n - 98)) AS s FROM texts WHERE n >= 100)),
starts AS (
  SELECT doc_id, s FROM (
    SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id, s) AS place FROM windows) WHERE place > 1),
-- windows that touch or overlap make one removed run
runs AS (
  SELECT doc_id, min(s) AS a, max(s) + 99 AS z FROM (
    SELECT doc_id, s, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM (
      SELECT doc_id, s, (s - lag(s, 1, -1000) OVER (PARTITION BY doc_id ORDER BY s) > 100)::INT AS new FROM starts))
  GROUP BY doc_id, run),
pieces AS (
  SELECT doc_id, a, z, lag(z, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) + 1 AS kept_from FROM runs),
before AS (
  SELECT doc_id, count(*) AS n_spans, sum(z - a + 1) AS n_removed, max(z) AS last,
    string_agg(hex(array_slice(b, kept_from, a - 1)), '' ORDER BY a) AS kept
  FROM pieces JOIN texts USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept, '') || hex(array_slice(b, coalesce(last, 0) + 1, n)))) AS kept_sha256
FROM texts LEFT JOIN before USING (doc_id)
"""

NEAR_DUPLICATES_SQL = f"""
WITH RECURSIVE texts AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, md5_number(array_to_string(w[s : s + 4], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS s FROM texts WHERE len(w) > 0)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
both_ AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
  FROM shingles a JOIN shingles b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS MATERIALIZED (
  SELECT x, y FROM both_ JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * both_.n >= 85 * (a.n + b.n - both_.n)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT reach.doc_id, links.y FROM reach JOIN links ON links.x = reach.other)
SELECT r.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id,
  min(other) = r.doc_id AS kept
FROM reach r LEFT JOIN sizes ON sizes.doc_id = r.doc_id GROUP BY r.doc_id
"""
