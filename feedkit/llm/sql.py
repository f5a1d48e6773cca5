"""SQL for the operators' queries, for an engine other than Spark. Window sizes and limits are those of the queries."""

MIX = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, 'null')) AS mark
  FROM documents),
sharded AS (
  SELECT *, ('0x' || substr(mark, 1, 8))::BIGINT % greatest(1, ceil((SELECT count(*) FROM docs) / 4096)::BIGINT) AS shard FROM docs),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
  FROM docs GROUP BY source),
weighted AS (SELECT *, [5.0, 2.0, 1.0][(rank % 3 + 1)::INT]::DOUBLE AS weight FROM sources),
-- sources by the level at which they reach their cap; those before the first that stays free are capped
levels AS (
  SELECT *, 2.0::DOUBLE * source_size AS most, 1.5::DOUBLE * sum(source_size) OVER ()
         - 2.0::DOUBLE * coalesce(sum(source_size) OVER (ORDER BY source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(weight) OVER (ORDER BY source_size / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free
  FROM weighted),
level AS (
  SELECT rest, free FROM levels WHERE weight * rest / free <= most ORDER BY source_size / weight, rank LIMIT 1),
targets AS (
  SELECT w.source, w.source_size, w.rank,
         CASE WHEN w.weight * l.rest / l.free > 2.0::DOUBLE * w.source_size THEN 2.0::DOUBLE * w.source_size ELSE w.weight * l.rest / l.free END AS target
  FROM weighted w, level l),
cells AS (
  SELECT s.shard, t.rank, t.target, t.source_size, sum(s.size)::BIGINT AS cell_size
  FROM sharded s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source GROUP BY ALL),
votes AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target * cell_size::DOUBLE / source_size::DOUBLE * 1000.0::DOUBLE + 0.5::DOUBLE)::BIGINT ELSE 0 END AS votes FROM cells),
shards AS (SELECT shard, floor(sum(votes)::DOUBLE / 16000.0::DOUBLE + 0.5::DOUBLE)::BIGINT AS blocks FROM votes GROUP BY shard),
quotients AS (
  SELECT v.shard, v.rank, row_number() OVER (PARTITION BY v.shard ORDER BY v.votes::DOUBLE / (2.0::DOUBLE * k.k + 1.0::DOUBLE) DESC, v.rank, k.k) AS place
  FROM votes v, unnest(range(0, (v.votes / 16000)::BIGINT + 20)) AS k(k) WHERE v.votes > 0),
seats AS (
  SELECT q.shard, q.rank, count(*) AS seats FROM quotients q JOIN shards s USING (shard) WHERE q.place <= s.blocks GROUP BY ALL),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, v.cell_size, coalesce(e.seats, 0) * 16 AS room,
         coalesce(sum(s.size) OVER (PARTITION BY t.rank, s.shard ORDER BY s.mark, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sharded s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
  JOIN votes v ON v.shard = s.shard AND v.rank = t.rank
  LEFT JOIN seats e ON e.shard = s.shard AND e.rank = t.rank)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(size, room - before)) + greatest(0, least(size, room - cell_size - before)))::BIGINT AS taken
FROM placed
"""

EXACT = r"""
WITH docs AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text) AS keep_id, count(*) OVER (PARTITION BY text) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY text) AS kept, sha256(text) AS text_sha256
FROM docs
"""

# A run of n words occurs again exactly where one of its n-word windows does.
QUALITY = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM docs),
windows AS (
  SELECT doc_id, i, len(w) AS n, w[i] || ' ' || w[i+1] || ' ' || w[i+2] AS three, array_to_string(w[i:i+9], ' ') AS ten
  FROM places),
twice AS (
  SELECT doc_id, i, i + 2 <= n AND count(*) OVER (PARTITION BY doc_id, three, i + 2 <= n) > 1 AS three,
         i + 9 <= n AND count(*) OVER (PARTITION BY doc_id, ten, i + 9 <= n) > 1 AS ten
  FROM windows),
near AS (
  SELECT doc_id, bool_or(three) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS three,
         bool_or(ten) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS ten
  FROM twice),
-- a run of 101 words that occurs again begins with ten that do
overs AS (
  SELECT doc_id FROM twice JOIN docs USING (doc_id) WHERE ten AND i + 100 <= len(w) GROUP BY doc_id, array_to_string(w[i:i+100], ' ') HAVING count(*) > 1),
counts AS (
  SELECT doc_id, count(*) FILTER (three) AS n_repeat_words, count(*) FILTER (ten) AS covered_words FROM near GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
base AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         coalesce(covered_words, 0)::BIGINT AS covered_words, d.doc_id IN (SELECT doc_id FROM overs) AS over
  FROM docs d LEFT JOIN counts USING (doc_id) LEFT JOIN dups USING (doc_id)),
failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, covered_words, base_failed,
       NOT base_failed AND covered_words <= 0.3::DOUBLE * n_words AND NOT over AS kept
FROM failed
"""


def _crc32(text: str) -> str:
    """crc32 of a text's UTF-8 bytes: each byte is taken in, then eight bits shifted out."""
    byte = f"('0x' || substr(hex(encode({text})), 2 * k + 1, 2))::BIGINT"
    steps = f"flatten(list_transform(range(0, strlen({text})), lambda k: [{byte}, -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}), lambda c, x: {step}), 4294967295)"


# Turn by turn, for each role that the repaired turns so far can end with ('' none, s, u, a): least cost, then least audit.
# Before each turn and at the end up to two turns are inserted; a third would lead back to where one does.
REPAIR = rf"""
WITH RECURSIVE marked AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
harmed AS (SELECT *, {_crc32("key")} % 20 AS harm FROM marked),
damaged AS (
  SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN harm = 1 THEN '' WHEN harm = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(0, CASE WHEN harm = 3 THEN 2 ELSE 1 END)) AS copy
  FROM harmed WHERE harm <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS repeated,
         rtrim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS said FROM damaged),
rows AS (
  SELECT conv_id, turn, i, role, text, substr(role, 1, 1) AS initial,
         CASE WHEN said = '' THEN 'blank' WHEN repeated THEN 'duplicate' WHEN said[-1] IN ('.', '!', '?') THEN 'none' ELSE 'truncated' END AS fault,
         lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM placed),
counts AS (
  SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows GROUP BY conv_id),
inserts(start, audit, ending, made) AS (VALUES
  ('', '', '', []::VARCHAR[]), ('s', '', 's', []), ('u', '', 'u', []), ('a', '', 'a', []),
  ('', 'I', 'u', ['user:']), ('s', 'I', 'u', ['user:']), ('u', 'I', 'a', ['assistant:']), ('a', 'I', 'u', ['user:']),
  ('', 'II', 'a', ['user:', 'assistant:']), ('s', 'II', 'a', ['user:', 'assistant:']), ('u', 'II', 'u', ['assistant:', 'user:']),
  ('a', 'II', 'a', ['user:', 'assistant:'])),
walk AS (
  SELECT conv_id, 0::BIGINT AS i, '' AS ending, {{'cost': 0::BIGINT, 'audit': '', 'made': []::VARCHAR[]}} AS best FROM counts
  UNION ALL
  SELECT w.conv_id, w.i + 1, e.ending,
         min({{'cost': w.best.cost + 5 * length(s.audit) + e.cost, 'audit': w.best.audit || s.audit || e.edit, 'made': w.best.made || s.made || e.made}})
  FROM walk w JOIN inserts s ON s.start = w.ending JOIN rows r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1,
  LATERAL (
    SELECT s.ending AS ending, 'D' AS edit, 2 AS cost, []::VARCHAR[] AS made
    UNION ALL SELECT t.sign, CASE WHEN r.initial = t.sign THEN 'K' ELSE 'R' END,
                     CASE WHEN r.initial = t.sign THEN 0 ELSE 1 END + CASE WHEN r.fault = 'truncated' THEN 5 ELSE 0 END,
                     [CASE WHEN r.initial = t.sign THEN r.role WHEN t.sign = 'u' THEN 'user' ELSE 'assistant' END || ':' || r.text]
              FROM (VALUES (CASE WHEN s.ending = 'u' THEN 'a' ELSE 'u' END)) AS t(sign) WHERE r.fault NOT IN ('blank', 'duplicate')
    UNION ALL SELECT 's', 'K', CASE WHEN r.fault = 'truncated' THEN 5 ELSE 0 END, [r.role || ':' || r.text]
              WHERE s.ending = '' AND r.initial = 's' AND r.fault NOT IN ('blank', 'duplicate')) e
  GROUP BY w.conv_id, w.i, e.ending),
finished AS (
  SELECT w.conv_id, min({{'cost': w.best.cost + 5 * length(s.audit), 'audit': w.best.audit || s.audit, 'made': w.best.made || s.made}}) AS best
  FROM walk w JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.i JOIN inserts s ON s.start = w.ending
  WHERE s.ending IN ('', 'a') GROUP BY w.conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(f.best.cost, 0) AS cost, coalesce(f.best.audit, '') AS audit,
       sha256(coalesce(array_to_string(f.best.made, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN finished f ON f.conv_id IS NOT DISTINCT FROM o.conv_id
"""

# Two words are near if one without a letter is the other, or both without the letter at one place are equal.
SPELLING = rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS times, coalesce(doc_id::VARCHAR, '') || ':' || run AS key FROM runs WHERE length(run) >= 7 GROUP BY doc_id, run),
marked AS (SELECT run, times, {_crc32("key")} AS mark FROM counted),
harmed AS (
  SELECT CASE WHEN mark % 31 = 0 THEN substr(run, 1, mark % length(run)) || substr(run, mark % length(run) + 2) ELSE run END AS word, times FROM marked),
words AS (SELECT word, sum(times)::BIGINT AS n FROM harmed WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
without AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM places),
pairs AS (
  SELECT a.word, b.word AS other, b.n FROM without a JOIN words b ON a.rest = b.word
  UNION SELECT a.word, b.word, b.n FROM words a JOIN without b ON b.rest = a.word
  UNION SELECT a.word, b.word, b.n FROM without a JOIN without b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word),
best AS (SELECT word, count(*) AS n_near, min({{'n': -n, 'word': other}}) AS best FROM pairs GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN -b.best.n >= 10 * w.n THEN b.best.word END AS form, CASE WHEN -b.best.n >= 10 * w.n THEN -b.best.n END AS form_n
  FROM words w LEFT JOIN best b USING (word)),
chain AS (
  SELECT word, word AS root FROM formed
  UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL),
roots AS (SELECT c.word, c.root FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NULL)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM formed f JOIN roots r USING (word)
"""
