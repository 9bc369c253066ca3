"""DuckDB SQL of the text queries that SQL can express."""

from __future__ import annotations

WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
o AS (SELECT payload_digest, max(page_id) AS original FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN original IS NULL OR page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> original THEN original END AS refers_to
FROM p LEFT JOIN o USING (payload_digest)
"""

#: White space between words, as in the contract of the words.
_SPACE = r"\x20\x09-\x0D"

LINE_QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS i
  FROM (SELECT r, regexp_extract_all(text, '[^{_SPACE}]+') AS ws FROM d)),
g AS (
  SELECT r, i, [word, lead(word) OVER x, lead(word, 2) OVER x, lead(word, 3) OVER x, lead(word, 4) OVER x] AS win,
         lead(word, 4) OVER x IS NOT NULL AS whole
  FROM w WINDOW x AS (PARTITION BY r ORDER BY i)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS c FROM g WHERE whole) WHERE c > 1),
rep AS (
  SELECT r, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2, 3, 4]) AS k) GROUP BY r),
stat AS (
  SELECT r, count(*) AS n_words, sum(length(word)) AS word_chars,
         sum(length(regexp_replace(word, '[^#*$%&|<>]', '', 'g'))) AS n_symbols
  FROM w GROUP BY r),
l AS (
  SELECT r, source, text, line, len(regexp_extract_all(line, '[^{_SPACE}]+')) AS words,
         regexp_replace(regexp_replace(lower(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))),
                                       '[{_SPACE}]+', ' ', 'g'), '[0-9]', '0', 'g') AS norm
  FROM (SELECT r, source, text, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^{_SPACE}]')),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM l GROUP BY r),
often AS (SELECT source, norm FROM l GROUP BY source, norm HAVING count(DISTINCT r) > 20),
gone AS (
  SELECT r, sum(words) AS n FROM l JOIN often ON l.norm = often.norm AND l.source IS NOT DISTINCT FROM often.source
  GROUP BY r),
o AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
         coalesce(n_symbols, 0) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
         coalesce(rep.n, 0) AS n_repeat_words, coalesce(gone.n, 0) AS n_removed_words
  FROM d LEFT JOIN stat USING (r) LEFT JOIN dup USING (r) LEFT JOIN rep USING (r) LEFT JOIN gone USING (r))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, n_removed_words::BIGINT AS n_removed_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
         AND NOT (n_removed_words > 0 AND (n_words - n_removed_words < 10 OR n_words - n_removed_words < 0.3::DOUBLE * n_words)) AS kept
FROM o
"""

#: The checksum byte by byte: its table of 256 remainders is made by rule.
SPELLING = r"""
WITH RECURSIVE
shifted AS (
  SELECT i, 0 AS k, i::UBIGINT AS c FROM range(256) AS r(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END FROM shifted WHERE k < 8),
remainders AS (SELECT list(c ORDER BY i) AS t FROM shifted WHERE k = 8),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS d,
         translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]{7,}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents),
seen AS (SELECT d, run, count(*) AS times FROM runs GROUP BY ALL),
summed AS (
  SELECT run, times, xor(list_reduce(
           list_prepend(4294967295::UBIGINT, list_transform(range(1, len(h) // 2 + 1), lambda i: ('0x' || h[2 * i - 1:2 * i])::UBIGINT)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) % 256)::INT + 1])), 4294967295::UBIGINT) AS crc
  FROM (SELECT run, times, hex(encode(d || ':' || run)) AS h FROM seen), remainders),
spoilt AS (
  SELECT CASE WHEN crc % 31 = 0 THEN run[1:(crc % length(run))::INT] || run[(crc % length(run))::INT + 2:] ELSE run END AS word, times
  FROM summed),
words AS (SELECT word, sum(times)::BIGINT AS n FROM spoilt WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
less AS (SELECT word, n, i, word[1:i - 1] || word[i + 1:] AS rest FROM words, range(1, length(word) + 1) AS r(i)),
near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n AS m FROM less AS a JOIN less AS b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less AS a JOIN words AS b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less AS a JOIN words AS b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-m, encode(other))) AS other, max(m) AS m FROM near GROUP BY word),
formed AS (
  SELECT w.word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN m >= 10 * n THEN other END AS form, CASE WHEN m >= 10 * n THEN m END AS form_n
  FROM words AS w LEFT JOIN best AS b ON w.word = b.word),
steps AS (
  SELECT word, word AS at FROM formed
  UNION ALL
  SELECT s.word, f.form FROM steps AS s JOIN formed AS f ON s.at = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, s.at AS root, f.n, f.n_near, f.form_n
FROM formed AS f JOIN steps AS s ON f.word = s.word JOIN formed AS e ON s.at = e.word AND e.form IS NULL
"""

ORACLE: dict[str, str] = {"op3_warc": WARC, "op5_line_quality": LINE_QUALITY, "op12_spelling": SPELLING}
