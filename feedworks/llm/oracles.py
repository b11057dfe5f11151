"""The queries' results as DuckDB SQL, where SQL can express them."""

from feedworks.llm.rows import LOWER, UPPER
from feedworks.llm.sharding import SHARDS, TABLE_SIZE, fill_table

_NORMAL = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
_WORDS = r"'[^\x20\x09-\x0D]+'"

OP1 = f"""
WITH docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {_WORDS})) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '-') || '|' || md5(coalesce(text, ''))) AS key
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS number
  FROM docs GROUP BY source),
weighed AS (
  SELECT *, [5, 2, 1][CAST(number % 3 + 1 AS INTEGER)] AS weight, 3 * source_size AS cap,
         sum(source_size) OVER () AS total FROM sources),
levels AS (
  SELECT *, CAST(total - coalesce(sum(cap) OVER (ORDER BY cap / weight, number
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
            / sum(weight) OVER (ORDER BY cap / weight, number
                   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_over FROM weighed),
targets AS (SELECT *, least(CAST(cap AS DOUBLE), max(left_over) OVER () * weight) AS target FROM levels),
quotas AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS quota FROM targets),
placed AS (
  SELECT doc_id, size, source_size, target, quota,
         sum(size) OVER (PARTITION BY docs.source ORDER BY key, size ROWS UNBOUNDED PRECEDING) - size AS start
  FROM docs JOIN quotas ON docs.source IS NOT DISTINCT FROM quotas.source)
SELECT doc_id, size, source_size, target,
       CAST(coalesce((SELECT sum(greatest(0, least(start + size, quota - k * source_size) - start))
                      FROM range(3) AS rounds(k)), 0) AS BIGINT) AS taken
FROM placed
"""

OP3 = f"""
WITH texts AS (SELECT doc_id, {_NORMAL} AS normal FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(normal) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY normal)
"""

OP5 = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_NORMAL}, {_WORDS}) AS w FROM documents),
shingled AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s FROM words),
sizes AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM shingled),
single AS (SELECT doc_id, unnest(s) AS shingle FROM shingled),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
  FROM single x JOIN single y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * shared >= 75 * (p.n + q.n - shared)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT a AS doc_id, b AS other FROM both_ways
  UNION SELECT reached.doc_id, both_ways.b FROM reached JOIN both_ways ON reached.other = both_ways.a),
components AS (
  SELECT sizes.doc_id, n, least(sizes.doc_id, coalesce(min(other), sizes.doc_id)) AS component_id
  FROM sizes LEFT JOIN reached USING (doc_id) GROUP BY sizes.doc_id, n)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM components
"""

_TABLES = [",".join(map(str, fill_table(shards))) for shards in (SHARDS, SHARDS[:-1])]

OP9 = f"""
WITH keyed AS (
  SELECT doc_id, CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'text:' || md5(coalesce(text, '')))), 1, 15))
                      AS BIGINT) % {TABLE_SIZE} AS slot FROM documents),
tables AS (SELECT string_split('{_TABLES[0]}', ',') AS every, string_split('{_TABLES[1]}', ',') AS fewer),
slots AS (SELECT unnest(range(len(every))) AS slot, unnest(every) AS shard, unnest(fewer) AS shard_without_last FROM tables)
SELECT doc_id, CAST(slot AS INTEGER) AS slot, CAST(shard AS INTEGER) AS shard,
       CAST(shard_without_last AS INTEGER) AS shard_without_last
FROM keyed JOIN slots USING (slot)
"""

# The checksum's table, from its polynomial 0xEDB88320, and a run's UTF-8 bytes: letters are a to z or U+00C0 to U+00FF.
_CRC_TABLE = """list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"""
_BYTES = """flatten(list_transform(string_split(key, ''), lambda c:
  CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [CAST(195 AS BIGINT), CAST(unicode(c) - 64 AS BIGINT)] END))"""

OP13 = f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all({_NORMAL}, '[a-zÀ-ÿ]+')) AS run FROM documents),
kinds AS (SELECT id || ':' || run AS key, run, count(*) AS times FROM runs WHERE length(run) >= 5 GROUP BY ALL),
crc AS (SELECT {_CRC_TABLE} AS entry),
checked AS (
  SELECT run, times, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {_BYTES}),
    lambda c, b: xor(c >> 8, entry[(xor(c, b) & 255) + 1])), 4294967295) AS h FROM kinds, crc),
altered AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2)
              ELSE run END AS word, times FROM checked),
words AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM altered WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
gaps AS (
  SELECT word, i, left(word, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS near FROM gaps a JOIN gaps b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT gaps.word, words.word FROM gaps JOIN words ON gaps.rest = words.word
  UNION SELECT words.word, gaps.word FROM gaps JOIN words ON gaps.rest = words.word),
ranked AS (
  SELECT pairs.word, near, n, count(*) OVER (PARTITION BY pairs.word) AS n_near,
         row_number() OVER (PARTITION BY pairs.word ORDER BY n DESC, encode(near)) AS rank
  FROM pairs JOIN words ON words.word = near),
known AS (
  SELECT words.word, CASE WHEN ranked.n >= 2 * words.n THEN near END AS form, words.n,
         coalesce(n_near, 0) AS n_near, CASE WHEN ranked.n >= 2 * words.n THEN ranked.n END AS form_n
  FROM words LEFT JOIN ranked ON ranked.word = words.word AND rank = 1),
led AS (
  SELECT word, word AS at, form AS next FROM known
  UNION ALL SELECT led.word, known.word, known.form FROM led JOIN known ON known.word = led.next)
SELECT known.word, known.form, led.at AS root, n, n_near, form_n
FROM known JOIN led ON led.word = known.word AND led.next IS NULL
"""

ORACLE_SQL = {"op1_source_mixing": OP1, "op3_exact_dedup": OP3, "op5_near_duplicates": OP5,
              "op9_sharding": OP9, "op13_spelling_variants": OP13}
