"""SQL that the queries of this package must agree with, for DuckDB.

Differencing, hashes, compression, signatures, boundaries and strings of bytes are
no SQL, or far too slow in it: op3, op5 to op10 and op12 are tested in ``tests/llm``.
"""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

SUBSTRINGS = f"""
WITH docs AS (SELECT doc_id, {WORDS} AS words FROM documents),
starts AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS place
  FROM (
    SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS w
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM docs)
  )
),
gone AS (
  SELECT DISTINCT doc_id, i + k AS i
  FROM (SELECT doc_id, i, unnest(range(0, 20)) AS k FROM starts WHERE place > 1)
),
kept AS (
  SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.i) AS text, count(*) AS n
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM docs) w
  ANTI JOIN gone ON gone.doc_id = w.doc_id AND gone.i = w.i
  GROUP BY w.doc_id
)
SELECT docs.doc_id, CAST(len(words) AS BIGINT) AS n_words,
       CAST(len(words) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept ON docs.doc_id = kept.doc_id
"""

MIXING = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size,
         md5('mix-7' || coalesce(CAST(doc_id AS VARCHAR), '')) AS draw
  FROM documents
),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sources
),
capped AS (SELECT *, 3 * source_size AS cap, CAST(3 * source_size AS DOUBLE) / weight AS ratio FROM weighed),
levels AS (
  SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER earlier, 0) AS DOUBLE) / sum(weight) OVER onward AS level
  FROM capped
  WINDOW earlier AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         onward AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
),
targets AS (SELECT source, source_size, least(CAST(cap AS DOUBLE), max(level) OVER () * weight) AS target FROM levels),
split AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM targets
),
placed AS (
  SELECT sized.*, t.source_size, t.target, t.whole, CAST(floor(t.target) AS BIGINT) - t.whole * t.source_size AS rest,
         sum(size) OVER (PARTITION BY sized.source ORDER BY draw, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before
  FROM sized JOIN split t ON sized.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(whole * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken
FROM placed
"""


def _quartiles(keys: str, name: str) -> str:
    listed = keys + ", " if keys else ""
    return f"""
{name}_cells AS (SELECT {listed}measure, cell, sum(n) AS n FROM cells GROUP BY {listed}measure, cell),
{name}_ran AS (
  SELECT {listed}measure, coalesce(pow(CAST(1.005 AS DOUBLE), cell), 0.0) AS value,
         sum(n) OVER (PARTITION BY {listed}measure ORDER BY cell NULLS FIRST ROWS UNBOUNDED PRECEDING) AS up_to,
         sum(n) OVER (PARTITION BY {listed}measure) AS total
  FROM {name}_cells
),
{name} AS (
  SELECT {listed}measure, max(total) AS n, min(value) FILTER (4 * up_to >= total) AS q1,
         min(value) FILTER (4 * up_to >= 2 * total) AS q2, min(value) FILTER (4 * up_to >= 3 * total) AS q3
  FROM {name}_ran GROUP BY {listed}measure
)"""


QUALITY = f"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text, {WORDS} AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents
),
windows AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, w) AS times
  FROM (
    SELECT r, i, array_to_string(words[i:i + 4], ' ') AS w
    FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM texts)
  )
),
repeated AS (
  SELECT r, count(DISTINCT i + k) AS n
  FROM (SELECT r, i, unnest(range(0, 5)) AS k FROM windows WHERE times > 1) GROUP BY r
),
counted AS (
  SELECT texts.r, doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(repeated.n, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines, len(list_distinct(words)) AS n_distinct
  FROM texts LEFT JOIN repeated ON texts.r = repeated.r
),
judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         CAST(word_chars AS DOUBLE) / greatest(n_words, 1) AS word_length,
         CAST(n_symbols + 1 AS DOUBLE) / (n_words + 50) AS symbols,
         CAST(n_dup_lines + 1 AS DOUBLE) / (n_lines + 5) AS dup_lines,
         1 - ln(greatest(n_distinct, 1)) / ln(greatest(n_words, 1) + 1) AS sameness
  FROM counted
),
measured AS (
  SELECT lang, source, unnest(['word_length', 'symbols', 'dup_lines', 'sameness']) AS measure,
         unnest([word_length, symbols, dup_lines, sameness]) AS value
  FROM judged WHERE NOT base_failed
),
cells AS (
  SELECT lang, source, measure, CASE WHEN value >= 0.001 THEN floor(ln(value) / ln(CAST(1.005 AS DOUBLE))) END AS cell, count(*) AS n
  FROM measured GROUP BY ALL
),
{_quartiles("lang, source", "own")},
{_quartiles("lang", "of_lang")},
{_quartiles("", "overall")},
language AS (
  SELECT of_lang.lang, of_lang.measure,
         (of_lang.n * of_lang.q1 + 200 * overall.q1) / (of_lang.n + 200) AS q1,
         (of_lang.n * of_lang.q2 + 200 * overall.q2) / (of_lang.n + 200) AS q2,
         (of_lang.n * of_lang.q3 + 200 * overall.q3) / (of_lang.n + 200) AS q3
  FROM of_lang JOIN overall ON of_lang.measure = overall.measure
),
blended AS (
  SELECT own.lang, own.source, own.measure,
         (own.n * own.q1 + 200 * w.q1) / (own.n + 200) AS q1,
         (own.n * own.q2 + 200 * w.q2) / (own.n + 200) AS q2,
         (own.n * own.q3 + 200 * w.q3) / (own.n + 200) AS q3,
         w.q2 AS wide, greatest(w.q2 - w.q1, 0.01 * w.q2) AS up, greatest(w.q3 - w.q2, 0.01 * w.q2) AS down
  FROM own JOIN language w ON own.lang IS NOT DISTINCT FROM w.lang AND own.measure = w.measure
),
fenced AS (
  SELECT lang, source, measure, least(greatest(q2, wide - 6 * down), wide + 6 * up) AS middle,
         12 * least(greatest(q2 - q1, 0.01 * q2), 2 * up) AS above, 12 * least(greatest(q3 - q2, 0.01 * q2), 2 * down) AS below
  FROM blended
),
limits AS (
  SELECT lang, source,
         max(middle + above) FILTER (measure = 'word_length') AS long,
         max(middle - below) FILTER (measure = 'word_length') AS short,
         max(middle + above) FILTER (measure = 'symbols') AS symbols_limit,
         max(middle + above) FILTER (measure = 'dup_lines') AS dup_limit,
         max(middle + above) FILTER (measure = 'sameness') AS same_limit
  FROM fenced GROUP BY lang, source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(word_length BETWEEN short AND long AND symbols <= symbols_limit
         AND dup_lines <= dup_limit AND sameness <= same_limit, false) AS kept
FROM judged
LEFT JOIN limits ON judged.lang IS NOT DISTINCT FROM limits.lang AND judged.source IS NOT DISTINCT FROM limits.source
"""

TRIE = r"""
WITH own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
),
codes AS (
  SELECT conv_id, list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))) AS codes
  FROM (SELECT DISTINCT conv_id FROM own)
),
heads AS (
  SELECT conv_id, xor(list_reduce(codes, lambda crc, code: list_reduce(
           list_prepend(xor(crc, code), [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]),
           lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)), 4294967295) % 4 AS h
  FROM codes
),
turns AS (
  SELECT heads.conv_id, 0 AS part, pos, role, text FROM heads JOIN own ON own.conv_id = heads.conv_id - heads.conv_id % 20 AND pos <= h
  UNION ALL
  SELECT conv_id, 1, pos, role, text FROM own JOIN heads USING (conv_id) WHERE pos > h
),
rebuilt AS (
  SELECT heads.conv_id, coalesce(t.path, []) AS path
  FROM heads LEFT JOIN (
    SELECT conv_id, list({'role': role, 'text': text} ORDER BY part, pos) AS path FROM turns GROUP BY conv_id
  ) t ON t.conv_id = heads.conv_id
),
members AS (SELECT conv_id, len(path) AS length, d, path[1:d] AS path FROM (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT d, path, min(conv_id) AS conv_id, count(*) AS n_convs,
         string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (length = d) AS ends
  FROM members GROUP BY d, path
),
families AS (
  SELECT nodes.*, parents.conv_id AS parent_conv_id
  FROM nodes LEFT JOIN nodes parents ON parents.d = nodes.d - 1 AND parents.path = nodes.path[1:nodes.d - 1]
),
children AS (SELECT parent_conv_id AS conv_id, d - 1 AS d, count(*) AS n FROM families WHERE d > 0 GROUP BY ALL),
tops AS (
  SELECT families.*, coalesce(children.n, 0) AS n_children,
         CASE WHEN families.d > 0 THEN (n_convs - 1) * len(regexp_extract_all(path[families.d].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS saved
  FROM families LEFT JOIN children ON children.conv_id = families.conv_id AND children.d = families.d
),
below AS (
  SELECT up, path[1:up] AS path, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM (SELECT *, unnest(range(0, d + 1)) AS up FROM tops) GROUP BY up, path[1:up]
)
SELECT conv_id, d AS depth, parent_conv_id, n_convs, n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens,
       sha256(coalesce(ends, '')) AS ends_sha256
FROM tops JOIN below ON below.up = tops.d AND below.path = tops.path
"""

TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {TERMS} AS words FROM documents),
items AS (SELECT item_id, {TERMS} AS words FROM benchmark),
phrases AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS n, array_to_string(words[i:i + 9], ' ') AS phrase
  FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM items WHERE len(words) > 0)
),
windows AS (
  SELECT r, n, i, array_to_string(words[i:i + n - 1], ' ') AS phrase
  FROM (SELECT r, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM phrases))
),
found AS (SELECT r, i, phrases.n, item_id FROM windows JOIN phrases ON windows.phrase = phrases.phrase AND windows.n = phrases.n),
hit AS (SELECT r, count(DISTINCT i + k) AS n FROM (SELECT r, i, unnest(range(0, n)) AS k FROM found) GROUP BY r),
named AS (
  SELECT r, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS listed
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item_id FROM found WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(named.n, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit ON hit.r = docs.r LEFT JOIN named ON named.r = docs.r
"""

ORACLE: dict[str, str] = {
    "op1_substrings": SUBSTRINGS,
    "op2_mixing": MIXING,
    "op4_quality": QUALITY,
    "op11_prefix_trie": TRIE,
    "op13_decontamination": DECONTAMINATION,
}
