"""DuckDB SQL of the spelling variants and the importance resampling.

The unsigned crc32 of a string is put together from its bytes: it is linear, so each byte adds
a value that depends on the byte and on how many bytes follow it."""

from __future__ import annotations

#: ``crc_bytes(k, x)``: what byte value b adds, at x[b + 1], with k bytes behind it; ``crc_start(k, v)``:
#: what the start value adds to a string of k bytes. For strings of the table ``texts(s)``; ``crcs(s, crc)``.
CRC = """
bit AS (SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS t FROM (SELECT unnest(range(256)) AS b)),
t0 AS (SELECT list(t ORDER BY b) AS t FROM bit),
hexed AS (SELECT s, hex(encode(s)) AS x FROM texts),
longest AS (SELECT coalesce(max(len(x) // 2), 0) AS n FROM hexed),
crc_bytes(k, x) AS (SELECT 0, t FROM t0 UNION ALL SELECT k + 1, list_transform(x, lambda v: xor(v >> 8, t[(v & 255) + 1])) FROM crc_bytes, t0, longest WHERE k < n),
crc_start(k, v) AS (SELECT 0, 4294967295::BIGINT FROM t0 UNION ALL SELECT k + 1, xor(v >> 8, t[(v & 255) + 1]) FROM crc_start, t0, longest WHERE k < n),
spread AS (SELECT s, len(x) // 2 AS n, unnest(range(len(x) // 2)) AS i, x FROM hexed),
added AS (SELECT s, n, n - 1 - i AS k, (instr('0123456789ABCDEF', substr(x, (2 * i + 1)::BIGINT, 1)) - 1) * 16 + instr('0123456789ABCDEF', substr(x, (2 * i + 2)::BIGINT, 1)) AS b FROM spread),
summed AS (SELECT s, n, bit_xor(c.x[b]) AS part FROM added JOIN crc_bytes c USING (k) GROUP BY s, n),
crcs AS (SELECT s, xor(xor(part, v), 4294967295) AS crc FROM summed JOIN crc_start ON k = n)"""

LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

#: Words that are one edit apart have a place where both, or the longer one, lack a letter and
#: agree in the rest; chains of forms are followed step by step.
SPELLING_VARIANTS = rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(run, {LOWER}) AS run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents) WHERE length(run) >= 6 GROUP BY ALL),
texts AS (SELECT DISTINCT coalesce(doc_id::VARCHAR, '') || ':' || run AS s FROM runs),{CRC},
marked AS (SELECT run, times, crc FROM runs JOIN crcs ON s = coalesce(doc_id::VARCHAR, '') || ':' || run),
words AS (
  SELECT CASE WHEN crc % 199 = 0 THEN left(run, crc % length(run)) || substr(run, crc % length(run) + 2) ELSE run END AS word, sum(times)::BIGINT AS n
  FROM marked GROUP BY 1 HAVING length(word) >= 6 AND sum(times) >= 5),
places AS (SELECT word, n, unnest(range(length(word) + 1)) AS i FROM words),
lacking AS (SELECT word, n, left(word, i) AS a, substr(word, i + 2) AS b FROM places WHERE i < length(word)),
whole AS (SELECT word, n, left(word, i) AS a, substr(word, i + 1) AS b FROM places),
pairs AS (
  SELECT DISTINCT x.word, y.word AS other, y.n FROM lacking x JOIN lacking y USING (a, b) WHERE x.word != y.word
  UNION SELECT x.word, y.word, y.n FROM lacking x JOIN whole y USING (a, b)
  UNION SELECT y.word, x.word, x.n FROM lacking x JOIN whole y USING (a, b)),
near AS (SELECT word, count(*) AS n_near, min((-n, other)) AS best FROM pairs GROUP BY word),
formed AS (SELECT word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best[1] >= 5 * words.n THEN best[2] END AS form, CASE WHEN -best[1] >= 5 * words.n THEN -best[1] END AS form_n FROM words LEFT JOIN near USING (word)),
chain(word, root, step) AS (
  SELECT word, word, 0 FROM formed
  UNION ALL SELECT chain.word, form, step + 1 FROM chain JOIN formed ON formed.word = root WHERE form IS NOT NULL)
SELECT word, form, arg_max(root, step) AS root, any_value(n)::BIGINT AS n, any_value(n_near)::BIGINT AS n_near, any_value(form_n)::BIGINT AS form_n
FROM chain JOIN formed USING (word) GROUP BY word, form"""

#: Features of whole texts, without cutting them into lines.
IMPORTANCE_RESAMPLING = rf"""
WITH RECURSIVE told AS (
  SELECT 'd' AS side, row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), {LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), NULL, regexp_extract_all(translate(coalesce(text, ''), {LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
features AS (
  SELECT side, r, s, count(*) AS n FROM (
    SELECT side, r, unnest(w) AS s FROM told
    UNION ALL SELECT side, r, w[i] || ' ' || w[i + 1] FROM (SELECT side, r, w, unnest(range(1, len(w))) AS i FROM told)) GROUP BY ALL),
texts AS (SELECT DISTINCT s FROM features),{CRC},
hashed AS (SELECT side, r, crc % 10000 AS bucket, sum(n) AS n FROM features JOIN crcs USING (s) GROUP BY ALL),
buckets AS (SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0) AS s, coalesce(sum(n) FILTER (side = 'b'), 0) AS t FROM hashed GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1) * ((SELECT sum(s) FROM buckets) + 10000))::DOUBLE / ((s + 1) * ((SELECT sum(t) FROM buckets) + 10000))::DOUBLE))::BIGINT AS gain FROM buckets),
sums AS (SELECT r, sum(n * gain) AS gain, sum(n) AS n FROM hashed JOIN gains USING (bucket) WHERE side = 'd' GROUP BY r),
weighed AS (
  SELECT r, doc_id, len(w) AS words, coalesce(n, 0)::BIGINT AS n_features,
    CASE WHEN n IS NULL THEN 0 ELSE floor(gain / n) END::BIGINT AS weight, ('0x' || left(sha256('7:' || doc_id), 8))::BIGINT AS h
  FROM told LEFT JOIN sums USING (r) WHERE side = 'd'),
scored AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM weighed),
ranked AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 25 * n // 100 THEN rank END::BIGINT AS rank FROM scored LEFT JOIN ranked USING (r)"""
