"""A greedy regression tree in SQL, level by level, as the check of a forest without bagging.

Sums of the target are kept in whole units of 1e-15, so that two cuts which part
a node's rows alike have equal gains, and the first of them is taken.
"""

from __future__ import annotations

from collections.abc import Sequence


def tree(numeric: Sequence[str], categorical: Sequence[str], depth: int) -> str:
    """Common table expressions over `split` (id, part, price, columns).

    They end in `cuts` (a row per cut of the tree), `predicted` (id, part,
    actual_price, predicted_price) and `importances` (original_feature, importance).
    """
    steps = [f"""
logged AS (SELECT *, ln(1 + CAST(price AS DOUBLE)) AS y FROM split),
train AS (SELECT * FROM logged WHERE part = 'train'),
medians AS ({_each(numeric, "SELECT '{c}' AS feature, quantile_cont(CAST({c} AS DOUBLE), CAST(0.5 AS DOUBLE)) AS fill FROM train")}),
kinds AS ({_each(categorical, "SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, COUNT(*) AS n FROM train WHERE {c} IS NOT NULL GROUP BY {c}")}),
slots AS (SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) AS number FROM kinds),
numbers AS ({_each(numeric, "SELECT id, '{c}' AS feature, coalesce(CAST({c} AS DOUBLE), (SELECT fill FROM medians WHERE feature = '{c}')) AS x FROM logged")}),
texts AS ({_each(categorical, "SELECT id, '{c}' AS feature, coalesce(CAST({c} AS VARCHAR), (SELECT value FROM slots WHERE feature = '{c}' AND number = 1)) AS value FROM logged")}),
facts AS MATERIALIZED (
  SELECT id, feature, 0 AS number, x FROM numbers
  UNION ALL
  SELECT id, s.feature, s.number, CASE WHEN s.value = t.value THEN 1.0 ELSE 0.0 END AS x FROM texts t JOIN slots s ON s.feature = t.feature
),
places AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{c}')" for i, c in enumerate([*numeric, *categorical]))}) t(place, feature)),
known_points AS (SELECT DISTINCT feature, number, x FROM facts JOIN train USING (id)),
thresholds AS (
  SELECT place, feature, number, (x + next) / 2 AS threshold
  FROM (SELECT *, lead(x) OVER (PARTITION BY feature, number ORDER BY x) AS next FROM known_points) JOIN places USING (feature)
  WHERE next IS NOT NULL
),
node0 AS MATERIALIZED (SELECT id, 1 AS node FROM logged)"""]
    for level in range(depth):
        steps.append(f"""
sums{level} AS (
  SELECT node, COUNT(*) AS n, {_sums()} FROM node{level} JOIN train USING (id) GROUP BY node
),
left{level} AS (
  SELECT node, place, feature, number, threshold, COUNT(*) AS n, {_sums()}
  FROM node{level} JOIN train USING (id) JOIN facts USING (id) JOIN thresholds USING (feature, number)
  WHERE x <= threshold GROUP BY node, place, feature, number, threshold
),
gains{level} AS (
  SELECT l.node, l.place, l.feature, l.number, l.threshold, s.n,
    {_impurity("s.n", "s.s", "s.q")}
    - CAST(l.n AS DOUBLE) / s.n * ({_impurity("l.n", "l.s", "l.q")})
    - CAST(s.n - l.n AS DOUBLE) / s.n * ({_impurity("(s.n - l.n)", "(s.s - l.s)", "(s.q - l.q)")}) AS gain
  FROM left{level} l JOIN sums{level} s ON s.node = l.node WHERE l.n < s.n
),
cut{level} AS MATERIALIZED (
  SELECT * FROM gains{level} WHERE gain > 0
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, place, number, threshold) = 1
),
node{level + 1} AS MATERIALIZED (
  SELECT n.id, CASE WHEN c.node IS NULL THEN n.node WHEN f.x <= c.threshold THEN 2 * n.node ELSE 2 * n.node + 1 END AS node
  FROM node{level} n LEFT JOIN cut{level} c ON c.node = n.node
  LEFT JOIN facts f ON f.id = n.id AND f.feature = c.feature AND f.number = c.number
)""")
    cuts = " UNION ALL ".join(f"SELECT CAST(node AS BIGINT) AS node, feature, gain * n AS weight FROM cut{level}" for level in range(depth))
    steps.append(f"""
cuts AS ({cuts}),
leaves AS (SELECT node, AVG(y) AS mean FROM node{depth} JOIN train USING (id) GROUP BY node),
predicted AS (
  SELECT id, part, price AS actual_price, exp(mean) - 1 AS predicted_price
  FROM logged JOIN node{depth} USING (id) JOIN leaves USING (node) WHERE part <> 'train'
),
importances AS (
  SELECT p.feature AS original_feature, coalesce(SUM(weight), 0) / (SELECT SUM(weight) FROM cuts) AS importance
  FROM places p LEFT JOIN cuts USING (feature) GROUP BY p.feature
)""")
    return ",".join(step.strip() for step in steps)


def _each(columns: Sequence[str], select: str) -> str:
    return " UNION ALL ".join(select.replace("{c}", c) for c in columns)


def _sums() -> str:
    return "SUM(CAST(round(y * 1e15) AS HUGEINT)) AS s, SUM(CAST(round(y * y * 1e15) AS HUGEINT)) AS q"


def _impurity(n: str, s: str, q: str) -> str:
    """Variance from a count, a sum and a sum of squares."""
    mean = f"(CAST({s} AS DOUBLE) / 1e15 / {n})"
    return f"(CAST({q} AS DOUBLE) / 1e15 / {n} - {mean} * {mean})"
