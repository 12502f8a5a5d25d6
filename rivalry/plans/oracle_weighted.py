"""DuckDB SQL of the weighted scorer: every string pair whose common subsequence is needed, as rows of one table.

Each pair's longest common subsequence is a fold over the characters of one
string.  The fold's value is a column of the dynamic programme, a bit per
character of the other string: set where the length does not grow.
"""

from __future__ import annotations


def norm(dist: str, total: str) -> str:
    return f"(CASE WHEN {total} > 0 THEN 100.0::DOUBLE - 100.0::DOUBLE * ({dist}) / ({total}) ELSE 100.0::DOUBLE END)"


def ratio(x: str, y: str, lcs: str) -> str:
    total = f"(length({x}) + length({y}))"
    return norm(f"({total} - 2 * {lcs})", total)


def join(tokens: str) -> str:
    return f"array_to_string({tokens}, ' ')"


def best_ctes(inputs: str, dim: str) -> dict[str, str]:
    """CTEs that end in ``best`` (q, canonical, score): top-1 of ``dim`` (alias, canonical, ord) for each of ``inputs`` (q)."""
    return {
        "w_text": f"""
SELECT s, t, {join('list_sort(t)')} AS sorted, list_sort(list_distinct(t)) AS own, {join('list_sort(list_distinct(t))')} AS once
FROM (SELECT s, list_filter(string_split(s, ' '), lambda x: x <> '') AS t
      FROM (SELECT q AS s FROM {inputs} WHERE q IS NOT NULL UNION SELECT alias FROM {dim} WHERE alias IS NOT NULL))""",
        "w_pair": f"""
SELECT *, greatest(length(q), length(a))::DOUBLE / least(length(q), length(a)) AS longer,
       list_filter(qw, lambda x: list_contains(aw, x)) AS common,
       {join('list_filter(qw, lambda x: NOT list_contains(aw, x))')} AS q_rest,
       {join('list_filter(aw, lambda x: NOT list_contains(qw, x))')} AS a_rest
FROM (SELECT i.s AS q, d.s AS a, i.t AS q_tok, d.t AS a_tok, i.own AS qw, d.own AS aw, i.sorted AS qs, d.sorted AS as_, i.once AS qo, d.once AS ao
      FROM w_text i, w_text d WHERE i.s IN (SELECT q FROM {inputs}) AND d.s IN (SELECT alias FROM {dim}) AND i.s <> '' AND d.s <> '')""",
        # Pairs that partial scores compare: whole texts, sorted tokens, sorted distinct tokens.
        "w_partial": """
SELECT q AS x, a AS y FROM w_pair WHERE longer >= 1.5
UNION SELECT qs, as_ FROM w_pair WHERE longer >= 1.5 AND len(common) = 0
UNION SELECT qo, ao FROM w_pair WHERE longer >= 1.5 AND len(common) = 0 AND (len(qw) < len(q_tok) OR len(aw) < len(a_tok))""",
        "w_sides": """
SELECT x, y, x AS short, y AS long FROM w_partial WHERE length(x) <= length(y)
UNION SELECT x, y, y, x FROM w_partial WHERE length(y) <= length(x)""",
        "w_window": """
SELECT x, y, short, unnest(list_concat(
  list_transform(range(1, length(short)), lambda i: long[1:i]),
  list_transform(range(0, length(long) - length(short)), lambda i: long[i + 1:i + length(short)]),
  list_transform(range(length(long) - length(short), length(long)), lambda i: long[i + 1:]))) AS win
FROM w_sides WHERE short <> '' AND long <> ''""",
        "w_needed": """
SELECT q AS x, a AS y FROM w_pair UNION SELECT qs, as_ FROM w_pair WHERE longer < 1.5
UNION SELECT q_rest, a_rest FROM w_pair WHERE longer < 1.5 UNION SELECT short, win FROM w_window""",
        "w_mask": """
SELECT x, map(list(c), list(m)) AS masks FROM (
  SELECT x, c, sum(1::HUGEINT << (i - 1)::INTEGER)::HUGEINT AS m
  FROM (SELECT x, unnest(string_split(x, '')) AS c, generate_subscripts(string_split(x, ''), 1) AS i
        FROM (SELECT DISTINCT x FROM w_needed WHERE x <> '')) GROUP BY x, c) GROUP BY x""",
        "w_lcs": """
SELECT x, y, CASE WHEN x = '' OR y = '' THEN 0 ELSE length(x) - bit_count(list_reduce(
    list_transform(string_split(y, ''), lambda c: coalesce(masks[c], 0::HUGEINT)),
    lambda v, m: ((v + (v & m)) | (v & ~m)) & ((1::HUGEINT << length(x)::INTEGER) - 1),
    (1::HUGEINT << length(x)::INTEGER) - 1)) END AS n
FROM w_needed LEFT JOIN w_mask USING (x)""",
        "w_best_window": f"""
SELECT p.x, p.y, CASE WHEN p.x = '' AND p.y = '' THEN 100.0 WHEN p.x = '' OR p.y = '' THEN 0.0
                      ELSE coalesce(max({ratio('w.short', 'w.win', 'l.n')}), 0.0) END AS score
FROM w_partial p LEFT JOIN w_window w ON p.x = w.x AND p.y = w.y LEFT JOIN w_lcs l ON l.x = w.short AND l.y = w.win
GROUP BY p.x, p.y""",
        "w_parts": f"""
SELECT p.*, {ratio('p.q', 'p.a', 'l.n')} AS plain, {ratio('qs', 'as_', 's.n')} AS by_sort,
       length(array_to_string(common, ' ')) AS shared, r.n AS rest_n, w.score AS part, ws.score AS part_sorted, wo.score AS part_once
FROM w_pair p JOIN w_lcs l ON l.x = p.q AND l.y = p.a
LEFT JOIN w_lcs s ON s.x = qs AND s.y = as_ LEFT JOIN w_lcs r ON r.x = q_rest AND r.y = a_rest
LEFT JOIN w_best_window w ON w.x = p.q AND w.y = p.a LEFT JOIN w_best_window ws ON ws.x = qs AND ws.y = as_
LEFT JOIN w_best_window wo ON wo.x = qo AND wo.y = ao""",
        "w_tokens": f"""
SELECT *, shared + (shared > 0)::INTEGER + length(q_rest) AS q_all, shared + (shared > 0)::INTEGER + length(a_rest) AS a_all,
       CASE WHEN longer <= 8.0 THEN 0.9::DOUBLE ELSE 0.6::DOUBLE END AS scale
FROM w_parts""",
        "w_scored": f"""
SELECT q, a, CASE WHEN longer < 1.5 THEN greatest(plain, 0.95::DOUBLE * CASE
         WHEN len(q_tok) = 0 OR len(a_tok) = 0 THEN 0.0
         WHEN len(common) > 0 AND (q_rest = '' OR a_rest = '') THEN 100.0
         ELSE greatest(by_sort, {norm('length(q_rest) + length(a_rest) - 2 * rest_n', '(q_all + a_all)')},
                       CASE WHEN shared > 0 THEN {norm('1 + length(q_rest)', '(shared + q_all)')} ELSE 0.0 END,
                       CASE WHEN shared > 0 THEN {norm('1 + length(a_rest)', '(shared + a_all)')} ELSE 0.0 END) END)
       ELSE greatest(plain, part * scale, CASE
         WHEN len(q_tok) = 0 OR len(a_tok) = 0 THEN 0.0 WHEN len(common) > 0 THEN 100.0
         WHEN len(qw) < len(q_tok) OR len(aw) < len(a_tok) THEN greatest(part_sorted, part_once)
         ELSE part_sorted END * 0.95::DOUBLE * scale) END AS score
FROM w_tokens""",
        "best": f"""
SELECT q, CASE WHEN score > 70 THEN canonical END AS canonical, score FROM (
  SELECT i.q, d.canonical, coalesce(s.score, 0.0) AS score,
         row_number() OVER (PARTITION BY i.q ORDER BY coalesce(s.score, 0.0) DESC, d.ord NULLS FIRST, d.alias) AS rn
  FROM {inputs} i CROSS JOIN {dim} d LEFT JOIN w_scored s ON s.q = i.q AND s.a = d.alias) WHERE rn = 1""",
    }
