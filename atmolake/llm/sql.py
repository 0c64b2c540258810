"""DuckDB SQL of the queries that SQL can express."""

#: Words, lines and 3-word windows of each row; rows are numbered, as documents may repeat.
QUALITY_CTES = r"""
docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, coalesce(source, '') AS host FROM documents),
words AS (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM docs),
word_rows AS (SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM words),
windows AS (
  SELECT a.rid, a.i, count(*) OVER (PARTITION BY a.rid, a.w, b.w, c.w) AS n
  FROM word_rows a JOIN word_rows b ON b.rid = a.rid AND b.i = a.i + 1 JOIN word_rows c ON c.rid = a.rid AND c.i = a.i + 2),
repeated AS (
  SELECT rid, count(DISTINCT i + d) AS n_repeat FROM windows, (VALUES (0), (1), (2)) AS t(d) WHERE n > 1 GROUP BY rid),
lines AS (
  SELECT rid, doc_id, host, text, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS line_words,
    trim(regexp_replace(lower(regexp_replace(line, '[0-9]', '0', 'g')), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS plain
  FROM (SELECT rid, doc_id, host, text, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
duplicated AS (
  SELECT rid, sum(n - 1) AS n_dup FROM (SELECT rid, line, count(*) AS n FROM lines GROUP BY rid, line) GROUP BY rid),
hosts AS (SELECT host, count(DISTINCT text) AS host_docs FROM docs GROUP BY host),
frequent AS (
  SELECT host, plain, min(doc_id) AS owner FROM lines JOIN hosts USING (host) GROUP BY host, plain, host_docs
  HAVING count(DISTINCT text) > 20 AND count(DISTINCT text) > host_docs * 0.05::DOUBLE),
removed AS (
  SELECT l.rid, count(*) AS n_lines, sum(line_words) AS n_words FROM lines l JOIN frequent f ON f.host = l.host AND f.plain = l.plain
  WHERE f.owner IS NOT NULL AND f.owner IS DISTINCT FROM l.doc_id GROUP BY l.rid),
counts AS (
  SELECT docs.rid, doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_dup, 0)::BIGINT AS n_dup_lines,
    coalesce(n_repeat, 0)::BIGINT AS n_repeat_words, coalesce(r.n_lines, 0)::BIGINT AS n_removed_lines, coalesce(r.n_words, 0)::BIGINT AS n_removed_words
  FROM docs JOIN words USING (rid) LEFT JOIN repeated p ON p.rid = docs.rid LEFT JOIN duplicated d ON d.rid = docs.rid
  LEFT JOIN removed r ON r.rid = docs.rid)
"""

QUALITY_SQL = f"""
WITH {QUALITY_CTES},
failed AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT 100 * n_removed_words > 50 * n_words AS kept, n_removed_lines, n_removed_words
FROM failed
"""

SHARDING_SQL = r"""
WITH docs AS (
  SELECT doc_id, strlen(coalesce(text, ''))::BIGINT AS doc_bytes,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || chr(10) || coalesce(text, '')), 1, 15))::BIGINT AS h FROM documents),
prefixes AS (
  SELECT depth, h >> (60 - depth) AS p, sum(doc_bytes)::BIGINT AS shard_bytes, count(*) AS shard_docs, count(DISTINCT h) AS hashes
  FROM docs, generate_series(0, 60) AS t(depth) GROUP BY ALL),
fits AS (SELECT * FROM prefixes WHERE shard_bytes <= 1048576 OR hashes = 1),
shards AS (SELECT * FROM fits f WHERE NOT EXISTS (SELECT 1 FROM fits u WHERE u.depth = f.depth - 1 AND u.p = f.p >> 1))
SELECT doc_id, right(lpad(bin(p), 64, '0'), depth::INTEGER) AS shard, depth::INTEGER AS shard_depth, shard_bytes, shard_docs, doc_bytes
FROM docs JOIN shards ON h >> (60 - depth) = p
"""


def _word_rows(table: str, key: str) -> str:
    """Words of a table's texts, one a row, numbered from 0; A-Z in lower case."""
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
  SELECT rid, {key}, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS i, len(ws) AS n FROM (
    SELECT row_number() OVER () AS rid, {key}, regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM {table})"""


def _windows(words: str, key: str, where: str = "true") -> str:
    """All stretches of 1 to 10 consecutive words that `where` asks for."""
    return " UNION ALL ".join(
        f"""
  SELECT * FROM (
    SELECT rid, {key}, i, n, {m} AS length, string_agg(w, ' ') OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN CURRENT ROW AND {m - 1} FOLLOWING) AS passage
    FROM {words} WHERE {where.format(m=m)}) WHERE i + {m} <= n"""
        for m in range(1, 11)
    )


DECONTAMINATION_SQL = f"""
WITH item_words AS ({_word_rows("benchmark", "item_id")}),
doc_words AS ({_word_rows("documents", "doc_id")}),
item_windows AS (SELECT DISTINCT item_id, length, passage FROM ({_windows("item_words", "item_id", "least(n, 10) = {m}")})),
doc_windows AS ({_windows("doc_words", "doc_id", "{m} IN (SELECT length FROM item_windows)")}),
hits AS (SELECT rid, item_id, i, d.length FROM doc_windows d JOIN item_windows USING (length, passage)),
hit_words AS (SELECT rid, count(DISTINCT i + step) AS n_hit FROM hits, generate_series(0, 9) AS t(step) WHERE step < length GROUP BY rid),
hit_items AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT rid, coalesce(item_id::VARCHAR, '') AS item FROM hits) GROUP BY rid),
docs AS (
  SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
counts AS (SELECT rid, count(*) AS n_words FROM doc_words GROUP BY rid)
SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN counts USING (rid) LEFT JOIN hit_words USING (rid) LEFT JOIN hit_items USING (rid)
"""


def license_sql() -> str:
    from atmolake.llm.licenses import FILE_PERCENT, TEMPLATES, THRESHOLD

    templates = ", ".join(f"('{name}', '{text}')" for name, text in TEMPLATES)
    return rf"""
WITH templates(template, notice) AS (VALUES {templates}),
entries AS (SELECT template, w, count(*) AS n FROM (SELECT template, unnest(regexp_extract_all(lower(notice), '[a-z0-9]+')) AS w FROM templates) GROUP BY ALL),
files AS (
  SELECT doc_id AS id, coalesce(text, '') AS text, coalesce(source, '') || '/' || coalesce(lang, '') AS folder FROM documents),
lines AS (
  SELECT * FROM (
    SELECT id, i - 1 AS line, regexp_extract_all(lower(ls[i]), '[a-z0-9]+') AS ws
    FROM (SELECT id, ls, unnest(generate_series(1, len(ls))) AS i FROM (SELECT id, string_split(text, chr(10)) AS ls FROM files)))
  WHERE len(ws) > 0),
n_lines AS (SELECT count(*) AS n FROM lines),
tf AS (SELECT id, line, w, count(*) AS times FROM (SELECT id, line, unnest(ws) AS w FROM lines) GROUP BY ALL),
weights AS (
  SELECT v.w, ln((1 + any_value(n))::DOUBLE / (1 + count(tf.w))) + 1 AS weight
  FROM (SELECT DISTINCT w FROM entries) v LEFT JOIN tf ON tf.w = v.w, n_lines GROUP BY v.w),
vectors AS (SELECT template, w, n * weight / sqrt(sum(n * weight * n * weight) OVER (PARTITION BY template)) AS y FROM entries JOIN weights USING (w)),
x AS (SELECT id, line, w, times * coalesce(weight, ln(1 + n) + 1) AS x FROM tf LEFT JOIN weights USING (w), n_lines),
norms AS (SELECT id, line, sqrt(sum(x * x)) AS norm FROM x GROUP BY ALL),
dots AS (SELECT id, line, template, sum(x * y) AS dot FROM x JOIN vectors USING (w) GROUP BY ALL),
scores AS (SELECT id, line, template, round(dot / norm, 6) AS score FROM dots JOIN norms USING (id, line)),
notices AS (
  SELECT s.id, s.line, template, score, len(ws) AS n_words FROM scores s JOIN lines l ON l.id = s.id AND l.line = s.line WHERE score >= {THRESHOLD}
  QUALIFY row_number() OVER (PARTITION BY s.id, s.line ORDER BY score DESC, template) = 1),
own AS (
  SELECT id, template, score, line, sum(n_words) OVER (PARTITION BY id) AS notice_words FROM notices
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, line, template) = 1),
given AS (
  SELECT folder, template FROM own JOIN files USING (id)
  WHERE 100 * notice_words >= {FILE_PERCENT} * len(regexp_extract_all(lower(text), '[a-z0-9]+'))
  GROUP BY folder, template QUALIFY row_number() OVER (PARTITION BY folder ORDER BY count(*) DESC, template) = 1)
SELECT id AS doc_id, f.folder || '/' || id AS path, own.template AS own_license, score, line::INTEGER AS notice_line,
  coalesce(own.template, given.template) AS license,
  CASE WHEN own.template IS NULL AND given.template IS NOT NULL THEN f.folder END AS inherited_from
FROM files f LEFT JOIN own USING (id) LEFT JOIN given ON given.folder = f.folder
"""
