"""SQL of the queries that SQL can express."""

from tallyline.llm import line_dedup, mixing, prefix_trie, sharding, spelling

LINE_DEDUP = f"""
WITH t AS (SELECT doc_id, text, lpad(doc_id::VARCHAR, 20, '0') || substr(md5(text), 1, 8) AS k FROM documents),
e AS (SELECT k, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM (SELECT DISTINCT k, text FROM t WHERE k IS NOT NULL)),
w AS (SELECT k, pos, substr(md5(trim(line)), 1, 16) AS h, len(regexp_extract_all(line, '\\S+')) AS words FROM e),
l AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY pos) AS n, sum(words) OVER (PARTITION BY k ORDER BY pos ROWS UNBOUNDED PRECEDING) - words AS begins FROM w WHERE words > 0),
g AS (SELECT k, n, CASE WHEN sum(words) OVER r >= {line_dedup.MIN_WORDS} THEN md5(array_to_string(list(h) OVER r, '')) END AS gram FROM l
    WINDOW r AS (PARTITION BY k ORDER BY begins RANGE BETWEEN CURRENT ROW AND {line_dedup.MIN_WORDS - 1} FOLLOWING)),
p AS (SELECT k, min(gram || lpad((1000000000 - n)::VARCHAR, 10, '0')) OVER (PARTITION BY k ORDER BY n ROWS BETWEEN CURRENT ROW AND {line_dedup.WINDOW - 1} FOLLOWING) AS least FROM g WHERE gram IS NOT NULL),
f AS (SELECT DISTINCT k, 1000000000 - substr(least, 33)::BIGINT AS n, substr(least, 1, 32) AS gram FROM p),
o AS (SELECT k, n, min(k || lpad(n::VARCHAR, 10, '0')) OVER (PARTITION BY gram) AS first FROM f),
mt AS (SELECT k, n AS mn, substr(first, 1, 28) AS fk, substr(first, 29)::BIGINT AS fn FROM o WHERE first <> k || lpad(n::VARCHAR, 10, '0')),
hr AS (SELECT l.k, l.n, l.pos, l.h, mt.mn, mt.fk, mt.fn FROM l LEFT JOIN mt ON l.k = mt.k AND l.n = mt.mn WHERE l.k IN (SELECT k FROM mt)),
sd AS (SELECT k, n, pos, h, last_value(mn IGNORE NULLS) OVER a AS lm, last_value(fk IGNORE NULLS) OVER a AS lk, last_value(fn IGNORE NULLS) OVER a AS lf,
    last_value(mn IGNORE NULLS) OVER b AS rm, last_value(fk IGNORE NULLS) OVER b AS rk, last_value(fn IGNORE NULLS) OVER b AS rf FROM hr
    WINDOW a AS (PARTITION BY k ORDER BY n ROWS UNBOUNDED PRECEDING), b AS (PARTITION BY k ORDER BY n DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
tr AS (SELECT k, n, pos, h, lm AS mn, lk AS fk, lf + n - lm AS place FROM sd WHERE lm IS NOT NULL UNION ALL SELECT k, n, pos, h, rm, rk, rf + n - rm FROM sd WHERE rm IS NOT NULL),
sm AS (SELECT tr.k, tr.n, tr.pos, tr.mn FROM tr JOIN l ON l.k = tr.fk AND l.n = tr.place AND l.h = tr.h),
cv AS (SELECT DISTINCT k, pos FROM (SELECT k, pos, row_number() OVER (PARTITION BY k, mn, n >= mn ORDER BY abs(n - mn)) AS turn, abs(n - mn) + (n >= mn)::INT AS away FROM sm) WHERE turn = away),
gn AS (SELECT k, list(pos ORDER BY pos) AS gone FROM cv GROUP BY k)
SELECT t.doc_id, CASE WHEN gone IS NULL THEN text ELSE array_to_string(list_filter(string_split(text, chr(10)), lambda x, i: NOT list_contains(gone, i - 1)), chr(10)) END AS text,
    coalesce(len(string_split(text, chr(10))), 0)::BIGINT AS n_lines, coalesce(len(gone), 0)::BIGINT AS n_removed FROM t LEFT JOIN gn ON t.k = gn.k"""

MIDDLE = "b.low + b.width / 2"
MIXING = f"""
WITH RECURSIVE t AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '\\S+')) AS n_tokens, md5('{mixing.SEED}' || coalesce(doc_id::VARCHAR, '')) AS key FROM documents),
s AS (SELECT source, sum(n_tokens)::BIGINT AS t FROM t GROUP BY 1 HAVING sum(n_tokens) > 0),
p AS (SELECT source, t, t / (SELECT sum(t) FROM s)::DOUBLE AS p FROM s),
b AS (SELECT 0 AS step, 0e0 AS low, 1e0 AS width UNION ALL
    SELECT step + 1, CASE WHEN (SELECT ln(sum(pow(p, {MIDDLE}))) - ({MIDDLE}) * sum(pow(p, {MIDDLE}) * ln(p)) / sum(pow(p, {MIDDLE})) FROM p)
        >= ({mixing.NEAR_EVEN} - 1e-12) * (SELECT ln(count(*)) FROM p) THEN {MIDDLE} ELSE b.low END, b.width / 2 FROM b WHERE step < {mixing.LEVELS}),
ent AS (SELECT CASE WHEN count(*) < 2 THEN 0e0 WHEN -sum(p * ln(p)) >= ({mixing.NEAR_EVEN} - 1e-12) * ln(count(*)) THEN 1e0 ELSE (SELECT low FROM b WHERE step = {mixing.LEVELS}) END AS a FROM p),
c AS (SELECT 0 AS step, 0e0 AS low, 1e0 AS width UNION ALL
    SELECT step + 1, CASE WHEN (SELECT pow(min(p), c.low + c.width / 2 - 1) / sum(pow(p, c.low + c.width / 2)) FROM p) > {mixing.REPEATS} THEN c.low + c.width / 2 ELSE c.low END, c.width / 2 FROM c WHERE step < {mixing.LEVELS}),
x AS (SELECT CASE WHEN (SELECT 1 / (min(p) * count(*)) > {mixing.REPEATS} FROM p) THEN greatest(a, least(1e0, (SELECT low FROM c WHERE step = {mixing.LEVELS}) + pow(0.5e0, {mixing.LEVELS}))) ELSE a END AS a FROM ent),
z AS (SELECT sum(pow(p, a)) AS z, max(pow(p, 1 - a)) AS stretch, sum(t) AS everything FROM p, x),
plan AS (SELECT source, t, pow(p, a) / z AS w, greatest(t, floor(pow(p, a) / z * (everything::DOUBLE * stretch * z) + 1e-6)::BIGINT) AS given, least({mixing.MOST_BLOCKS}, ceil(t / {mixing.BLOCK_TOKENS}e0))::BIGINT AS n_blocks FROM p, x, z),
o AS (SELECT t.doc_id, t.source, n_tokens, w, given, plan.t, sum(n_tokens) OVER (PARTITION BY t.source ORDER BY ('0x' || substr(key, 1, 8))::BIGINT % n_blocks, key, n_tokens ROWS UNBOUNDED PRECEDING) AS used
    FROM t LEFT JOIN plan ON t.source IS NOT DISTINCT FROM plan.source)
SELECT doc_id, source, n_tokens::BIGINT AS n_tokens, (round(coalesce(w, 0e0), 9) + 0e0) AS weight, coalesce(given // t + (used <= given % t)::BIGINT, 1)::BIGINT AS copies FROM o"""

#: Steps of the checksum with the polynomial 0xEDB88320: one table entry for each byte.
CRC_TABLE = """(SELECT list(v ORDER BY i) FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) r(i)))"""


def crc32(text: str, steps: str) -> str:
    """SQL for the checksum of a text's UTF-8 bytes; steps: a column that holds CRC_TABLE."""
    read = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295, {read}), lambda a, x: xor(a >> 8, {steps}[(xor(a, x) & 255) + 1])), 4294967295)"


SHARDING = f"""
WITH c AS (SELECT {CRC_TABLE} AS steps),
t AS (SELECT doc_id, strlen(coalesce(text, ''))::BIGINT + 1 AS size, {crc32("coalesce(text, '')", "steps")}::BIGINT AS text_crc32, row_number() OVER () AS spot FROM documents, c),
d AS (SELECT spot, s, -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || s), 1, {sharding.DIGITS}))::BIGINT + 0.5e0) / pow(16e0, {sharding.DIGITS})) AS draw FROM t, range({sharding.SHARDS + 1}) r(s)),
w AS (SELECT spot, arg_min(s, draw) FILTER (WHERE s < {sharding.SHARDS}) AS shard, arg_min(s, draw) AS grown_shard FROM d GROUP BY spot)
SELECT doc_id, size, text_crc32, '{sharding.LAW}' AS law, shard::INT AS shard, row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard::INT AS grown_shard
FROM t JOIN w USING (spot)"""

SPELLING = f"""
WITH RECURSIVE c AS (SELECT {CRC_TABLE} AS steps),
r AS (SELECT coalesce(doc_id::VARCHAR, '') AS d, run, count(*) AS times FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{spelling.UPPER}', '{spelling.LOWER}') AS run FROM documents) GROUP BY ALL),
h AS (SELECT run, times, {crc32("d || ':' || run", "steps")} AS h FROM r, c WHERE length(run) >= {spelling.LEAST_LENGTH}),
s AS (SELECT CASE WHEN h % {spelling.SLIP} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, times FROM h),
v AS (SELECT word, sum(times)::BIGINT AS n FROM s WHERE length(word) >= {spelling.LEAST_LENGTH} GROUP BY word HAVING sum(times) >= {spelling.LEAST_COUNT}),
x AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS less FROM (SELECT word, n, unnest(range(length(word))) AS i FROM v)),
p AS (SELECT a.word AS a, b.word AS b FROM x a JOIN x b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
    UNION SELECT x.word, v.word FROM x JOIN v ON x.less = v.word UNION SELECT v.word, x.word FROM x JOIN v ON x.less = v.word),
q AS (SELECT a AS word, count(*)::BIGINT AS n_near, first(b ORDER BY v.n DESC, encode(b)) AS best, max(v.n) AS best_n FROM p JOIN v ON v.word = b GROUP BY a),
f AS (SELECT v.word, CASE WHEN best_n >= {spelling.FACTOR} * n THEN best END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= {spelling.FACTOR} * n THEN best_n END AS form_n FROM v LEFT JOIN q USING (word)),
g AS (SELECT word, word AS top, 0 AS step FROM f UNION ALL SELECT g.word, f.form, step + 1 FROM g JOIN f ON f.word = g.top WHERE f.form IS NOT NULL),
e AS (SELECT word, arg_max(top, step) AS root FROM g GROUP BY word)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN e USING (word)"""

PREFIX_TRIE = f"""
WITH c AS (SELECT {CRC_TABLE} AS steps),
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT conv_id, turn, role, substr(sha256(length(role) || ':' || role || text), 1, {2 * prefix_trie.WIDTH}) AS key, length(text) AS chars FROM t),
o AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, key) - 1 AS i, key, chars FROM k),
ids AS (SELECT conv_id, {crc32("conv_id::VARCHAR", "steps")} % {prefix_trie.MOST} AS h, conv_id - conv_id % {prefix_trie.GROUP} AS base FROM (SELECT DISTINCT conv_id FROM o), c),
r AS (SELECT ids.conv_id, i, key, chars FROM ids JOIN o ON o.conv_id = base AND i < h UNION ALL SELECT conv_id, i + {prefix_trie.MOST}, key, chars FROM ids JOIN o USING (conv_id) WHERE i >= h),
s AS (SELECT conv_id, row_number() OVER w AS d, chars, sha256(string_agg(key, '') OVER w) AS node FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY i)),
n AS (SELECT conv_id, d, chars, node, lag(node, 1, '') OVER (PARTITION BY conv_id ORDER BY d) AS above FROM s UNION ALL SELECT conv_id, 0, 0, '', NULL FROM ids),
g AS (SELECT node, any_value(above) AS above, min(conv_id) AS conv_id, any_value(d) AS depth, any_value(chars) AS chars, count(*) AS n_convs FROM n GROUP BY node),
m AS (SELECT above AS node, count(*) AS n_children FROM g WHERE above IS NOT NULL GROUP BY above),
x AS (SELECT DISTINCT a.node AS top, b.node FROM n a JOIN n b ON a.conv_id = b.conv_id AND b.d >= a.d),
u AS (SELECT top AS node, count(*) FILTER (WHERE m.node IS NULL) AS n_leaves, sum((n_convs - 1) * chars) AS saved FROM x JOIN g USING (node) LEFT JOIN m USING (node) GROUP BY top),
e AS (SELECT node, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS hash FROM (SELECT conv_id, arg_max(node, d) AS node FROM n GROUP BY conv_id) GROUP BY node)
SELECT g.conv_id, g.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, g.n_convs, coalesce(n_children, 0)::BIGINT AS n_children, n_leaves, saved::BIGINT AS saved_tokens,
    coalesce(hash, '{prefix_trie.EMPTY}') AS ends_sha256
FROM g LEFT JOIN g p ON p.node = g.above LEFT JOIN m ON m.node = g.node JOIN u ON u.node = g.node LEFT JOIN e ON e.node = g.node"""
