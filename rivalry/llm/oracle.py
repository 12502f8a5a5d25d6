"""DuckDB SQL for the queries that SQL can express."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP2 = rf"""
WITH judged AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), '{UPPER}', '{LOWER}') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
named AS (
  SELECT *, regexp_replace(host, ':\d*$', '') AS bare,
         nullif(regexp_extract(path, '/([0-9]{{1,18}})', 1), '') AS article FROM judged),
split AS (
  SELECT *, string_split(bare, '.') AS part,
         regexp_matches(bare, '^[0-9.]+$') AS numeric_host FROM named),
parts AS (
  SELECT *, array_to_string(part[greatest(len(part) - 1, 1):], '.') AS two,
         array_to_string(part[greatest(len(part) - 2, 1):], '.') AS three FROM split),
levels AS (
  SELECT page_id, host, path, CAST(article AS BIGINT) AS article,
         CASE WHEN numeric_host THEN bare WHEN listed THEN three ELSE two END AS domain,
         CASE WHEN numeric_host THEN bare WHEN listed THEN two ELSE part[-1] END AS suffix
  FROM (SELECT *, two IN ('co.uk','org.uk','ac.uk','com.au','co.jp','co.nz','com.br','co.in') AS listed FROM parts)),
worst AS (
  SELECT doc_id AS article, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 WHEN quality IS NOT NULL AND toxic IS NOT NULL THEN 0 END) AS bad
  FROM labels WHERE doc_id IS NOT NULL GROUP BY 1 HAVING bad IS NOT NULL),
h AS (SELECT host, domain, suffix, count(*)::DOUBLE AS n, sum(bad)::DOUBLE AS k
      FROM levels JOIN worst USING (article) GROUP BY 1, 2, 3),
d AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM h GROUP BY 1, 2),
s AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM d GROUP BY 1),
kids AS (SELECT 'h' AS level, domain AS p, n, k FROM h UNION ALL
         SELECT 'd', suffix, n, k FROM d UNION ALL SELECT 's', '', n, k FROM s),
per AS (SELECT level, p, sum(n) AS n, sum(k) AS k, count(*) AS i, sum(k * k / n) AS q, sum(n * n) AS n2 FROM kids GROUP BY 1, 2),
tot AS (SELECT level, sum(n) AS n, sum(k) AS k, sum(i - 1) AS df, sum(q - k * k / n) AS s, sum(n2 / n) AS m FROM per GROUP BY 1),
rho AS (SELECT level, CASE WHEN n = 0 OR df = 0 OR k = 0 OR k = n OR n - m - df <= 0 THEN 0.0
                           ELSE (s / ((k / n) * (1 - k / n)) - df) / (n - m - df) END AS rho FROM tot),
strength AS (SELECT level, CASE WHEN rho <= 0 THEN 1000.0 ELSE least(1000.0, greatest(1.0, (1 - rho) / rho)) END AS w FROM rho),
ms AS (SELECT suffix, (g.mean * w + k) / (w + n) AS m FROM s, strength,
              (SELECT (sum(k) + 0.5) / (sum(n) + 1.0) AS mean FROM s) g WHERE level = 's'),
md AS (SELECT d.domain, d.suffix, (ms.m * w + d.k) / (w + d.n) AS m FROM d JOIN ms USING (suffix), strength WHERE level = 'd'),
w AS (SELECT coalesce(max(w) FILTER (level = 'h'), 1000.0) AS h, coalesce(max(w) FILTER (level = 'd'), 1000.0) AS d,
             coalesce(max(w) FILTER (level = 's'), 1000.0) AS s FROM strength),
-- What is left of a prior's strength through two and three levels.
far AS (SELECT *, h / (h + 1) * d / (d + 1) AS hd, h / (h + 1) * d / (d + 1) * s / (s + 1) AS hds FROM w),
prior AS (
  SELECT l.host, coalesce(h.n, 0.0) AS n, coalesce(h.k, 0.0) AS k, coalesce(md.m, ms.m, g.mean) AS m,
         CASE WHEN md.m IS NOT NULL THEN far.h WHEN ms.m IS NOT NULL THEN hd / (1 - hd) ELSE hds / (1 - hds) END AS w
  FROM (SELECT DISTINCT host, domain, suffix FROM levels) l
  LEFT JOIN h ON l.host = h.host LEFT JOIN md ON l.domain = md.domain AND l.suffix = md.suffix LEFT JOIN ms ON l.suffix = ms.suffix,
  far, (SELECT (coalesce(sum(k), 0) + 0.5) / (coalesce(sum(n), 0) + 1.0) AS mean FROM s) g),
ab AS (SELECT host, n, m * w + k AS a, (1 - m) * w + n - k AS b FROM prior),
known AS (SELECT host, n, a / (a + b) - 1.645 * (sqrt(a * b / (a + b + 1)) / (a + b)) AS lower_bound FROM ab),
rules(what, rule, rule_host, rule_path) AS (VALUES ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
  ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')),
hosts AS (SELECT DISTINCT host FROM levels),
pairs AS (SELECT host, what, rule, rule_path FROM hosts JOIN rules ON host = rule_host OR ends_with(host, '.' || rule_host)),
ruled AS (
  SELECT page_id, levels.host, path, arg_max(what, length(rule)) AS what, arg_max(rule, length(rule)) AS rule
  FROM levels JOIN pairs ON levels.host = pairs.host AND starts_with(path, rule_path) GROUP BY ALL)
SELECT l.page_id, l.host, l.path, r.rule,
       coalesce(r.what, CASE WHEN k.lower_bound > 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
       coalesce(k.n, 0)::BIGINT AS n_labelled
FROM levels l LEFT JOIN known k USING (host)
LEFT JOIN ruled r ON r.page_id = l.page_id AND r.host = l.host AND r.path = l.path
"""

OP1 = rf"""
WITH words AS (
  SELECT row_number() OVER () AS rid, doc_id,
         coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+'), []::VARCHAR[]) AS w
  FROM documents),
item AS (
  SELECT item_id::VARCHAR AS item_id, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i + 1:i + least(10, len(w))], ' ') AS s
  FROM item, unnest(range(0, len(w) - least(10, len(w)) + 1)) t(i) WHERE len(w) > 0),
lengths AS (SELECT DISTINCT n FROM win),
runs AS (
  SELECT rid, n, i AS start, array_to_string(w[i + 1:i + n], ' ') AS s
  FROM (SELECT rid, w, n, unnest(range(0, len(w) - n + 1)) AS i FROM words, lengths WHERE len(w) >= n)),
hits AS (SELECT rid, start, n, item_id FROM runs JOIN win USING (n, s)),
places AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(start, start + n)) AS p FROM hits) GROUP BY 1),
named AS (SELECT rid, list_sort(list(DISTINCT item_id)) AS items FROM hits GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN places USING (rid) LEFT JOIN named USING (rid)
"""

OP3 = rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
each AS (SELECT rid, i, lines[i] AS line FROM (SELECT rid, lines, unnest(range(1, len(lines) + 1)) AS i FROM docs)),
keyed AS (SELECT rid, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key
          FROM each),
gone AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT rid) >= 10),
kept AS (SELECT rid, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS text FROM keyed ANTI JOIN gone USING (key) GROUP BY rid)
SELECT doc_id, len(lines)::BIGINT AS n_lines, (len(lines) - coalesce(n, 0))::BIGINT AS n_dropped,
       sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (rid)
"""



def lloyd_round(i: int) -> str:
    """The nearest centroid of c{i} for every vector, and the centroids after it."""
    return rf"""
a{i} AS MATERIALIZED (
  SELECT rid, any_value(vec_id) AS vec_id, any_value(v) AS v, min({{'d': d, 'c': c}}) AS best
  FROM (SELECT rid, vec_id, v.v, c, list_inner_product(v.v, v.v) + list_inner_product(x, x) - 2 * list_inner_product(v.v, x) AS d
        FROM v, c{i}) GROUP BY rid),
c{i + 1} AS MATERIALIZED (
  SELECT c, coalesce(m.x, c{i}.x) AS x FROM c{i} LEFT JOIN (
    SELECT c, list(m ORDER BY k) AS x FROM (
      SELECT c, k, floor(sum(x) / count(*)) AS m
      FROM (SELECT best.c AS c, unnest(v) AS x, generate_subscripts(v, 1) AS k FROM a{i}) GROUP BY c, k) GROUP BY c) m USING (c))"""


OP12 = rf"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS c, v AS x FROM v QUALIFY c < 40),
{",".join(map(lloyd_round, range(6)))},
t AS (SELECT best.c AS c, sum(best.d)::BIGINT AS cluster_inertia FROM a5 GROUP BY 1)
SELECT vec_id, best.c::INTEGER AS cluster, best.d::BIGINT AS distance, cluster_inertia,
       (SELECT sum(cluster_inertia) FROM t)::BIGINT AS inertia,
       sha256(array_to_string(list_transform(c5.x, lambda y: y::BIGINT::VARCHAR), ',')) AS centroid_sha256
FROM a5 JOIN t ON best.c = t.c JOIN c5 ON best.c = c5.c
"""



def crc_step(x: int) -> int:
    """Four bits on, of the reflected CRC-32 polynomial."""
    for _ in range(4):
        x = x >> 1 ^ (0xEDB88320 if x & 1 else 0)
    return x


# By half-bytes: the lower one of each byte first.
CRC = f"""xor(list_reduce(list_transform(range(length(hex(f))), lambda i: (
    instr('0123456789ABCDEF', hex(f)[i - i % 2 + 2 - i % 2]) - 1)::BIGINT),
  lambda x, y: xor(x >> 4, ({[crc_step(x) for x in range(16)]}::BIGINT[])[(xor(x, y) & 15) + 1]), 4294967295::BIGINT), 4294967295::BIGINT)"""
WORDS_OF = rf"coalesce(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+'), []::VARCHAR[])"
FEATURES = "list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"

OP11 = rf"""
WITH docs AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, {WORDS_OF} AS w FROM documents),
d AS MATERIALIZED (SELECT rid, f, count(*) AS n FROM (SELECT rid, unnest({FEATURES}) AS f FROM docs) GROUP BY ALL),
b AS MATERIALIZED (SELECT f, count(*) AS n FROM (SELECT unnest({FEATURES}) AS f FROM (SELECT {WORDS_OF} AS w FROM benchmark)) GROUP BY ALL),
place AS MATERIALIZED (SELECT f, {CRC} % 10000 AS bucket FROM (SELECT f FROM d UNION SELECT f FROM b)),
s AS (SELECT bucket, sum(n)::DOUBLE AS s FROM d JOIN place USING (f) GROUP BY 1),
t AS (SELECT bucket, sum(n)::DOUBLE AS t FROM b JOIN place USING (f) GROUP BY 1),
gain AS MATERIALIZED (
  SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1) * ((SELECT coalesce(sum(s), 0) FROM s) + 10000))
                                 / ((coalesce(s, 0) + 1) * ((SELECT coalesce(sum(t), 0) FROM t) + 10000))))::BIGINT AS gain
  FROM s FULL JOIN t USING (bucket)),
weight AS (SELECT rid, sum(n)::BIGINT AS n_features, floor(sum(n * gain)::DOUBLE / sum(n))::BIGINT AS weight
           FROM d JOIN place USING (f) JOIN gain USING (bucket) GROUP BY 1),
scored AS (
  SELECT rid, doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('7:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE)
                                                  / 4294967296)))::BIGINT AS score
  FROM docs LEFT JOIN weight USING (rid)),
drawn AS (SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE n_words >= 20
          QUALIFY 100 * rank <= 25 * count(*) OVER () - (25 * count(*) OVER ()) % 100)
SELECT doc_id, n_words::BIGINT AS n_words, n_features::BIGINT AS n_features, weight, score, rank
FROM scored LEFT JOIN drawn USING (rid)
"""

SQL = {"op11_importance": OP11, "op1_decontaminate": OP1, "op2_url_reputation": OP2, "op3_line_dedup": OP3, "op12_centroids": OP12}
