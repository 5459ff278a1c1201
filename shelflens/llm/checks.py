"""SQL that the queries are checked with, where SQL can express them."""

from __future__ import annotations

TOPK = """
WITH v AS (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
    WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM pairs
QUALIFY rank <= 20
"""

def repetition(ngrams: dict[int, float], line_share: float) -> str:
    """Counts and shares of words and lines; one pair of steps per n-gram length."""
    steps = []
    for n in ngrams:
        gram = " || ' ' || ".join(["w", *[f"lead(w, {i}) OVER seq" for i in range(1, n)]])
        inside = " OR ".join(["coalesce(twice, false)", *[f"coalesce(lag(twice, {i}) OVER seq, false)" for i in range(1, n)]])
        steps.append(f"""
grams{n} AS (SELECT doc_id, pos, size, {gram} AS gram FROM words WINDOW seq AS (PARTITION BY doc_id ORDER BY pos)),
twice{n} AS (SELECT doc_id, pos, size, gram IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, gram) > 1 AS twice FROM grams{n}),
inside{n} AS (SELECT doc_id, size, {inside} AS dup FROM twice{n} WINDOW seq AS (PARTITION BY doc_id ORDER BY pos)),
sum{n} AS (SELECT doc_id, count(*) FILTER (dup) AS n, coalesce(sum(size) FILTER (dup), 0) AS chars FROM inside{n} GROUP BY doc_id),""")
    shares = "".join(f", coalesce(sum{n}.chars, 0) / greatest(w.word_chars, 1) AS dup_{n}gram_share" for n in ngrams)
    joins = "".join(f" LEFT JOIN sum{n} USING (doc_id)" for n in ngrams)
    fine = "".join(f" AND dup_{n}gram_share <= {most}" for n, most in ngrams.items())
    return rf"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
words AS (
    SELECT doc_id, w, length(w) AS size, pos
    FROM (SELECT doc_id, unnest(l) AS w, generate_subscripts(l, 1) AS pos
          FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS l FROM texts))
),
lines AS (
    SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) > 1 AS dup
    FROM (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos
          FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM texts))
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
),
dups AS (
    SELECT doc_id, count(*) AS n, sum(length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g'))) AS chars
    FROM lines WHERE dup GROUP BY doc_id
),{"".join(steps)}
w AS (
    SELECT t.doc_id, count(w) AS n_words, CAST(coalesce(sum(size), 0) AS BIGINT) AS word_chars
    FROM texts t LEFT JOIN words USING (doc_id) GROUP BY t.doc_id
),
measured AS (
    SELECT doc_id, w.n_words, w.word_chars, CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           coalesce(dups.n, 0) AS n_dup_lines, coalesce(sum5.n, 0) AS n_repeat_words,
           coalesce(dups.chars, 0) / greatest(w.word_chars, 1) AS dup_line_share{shares},
           w.n_words < 10 OR 100 * coalesce(sum5.n, 0) > 20 * w.n_words AS base_failed
    FROM texts JOIN w USING (doc_id) LEFT JOIN dups USING (doc_id){joins}
)
SELECT *, NOT base_failed AND dup_line_share <= {line_share}{fine} AS kept FROM measured
"""


CHATS = """
WITH turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
chats AS (
    SELECT conv_id, list(struct_pack(role := role, text := text) ORDER BY turn) AS turns,
           string_agg('<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || chr(10), '' ORDER BY turn) AS rendered
    FROM turns GROUP BY conv_id
),
different AS (
    SELECT turns, min(conv_id) AS conv_id, count(*) AS n_copies, any_value(rendered) AS rendered FROM chats GROUP BY turns
),
prefixes AS (
    SELECT DISTINCT list_slice(turns, 1, n) AS turns FROM (SELECT turns, unnest(range(1, len(turns))) AS n FROM chats)
)
SELECT conv_id, CAST(len(turns) AS BIGINT) AS n_turns, n_copies, rendered
FROM different ANTI JOIN prefixes USING (turns)
"""


def urls(rules: tuple[tuple[str, str, str], ...]) -> str:
    """Own rules, and blocks that come over aliases: the closure of canonical and refresh edges."""
    listed = ", ".join(f"('{h}', '{p}', '{h + p}', '{a}')" for h, p, a in rules)
    node = r"""'://' || translate(regexp_extract({0}, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
        || regexp_extract({0}, '://[^/?#]*([^#]*)', 1)"""
    parts = r"""translate(regexp_extract({0}, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract({0}, '://[^/?#]*([^?#]*)', 1) AS path"""
    fits = "(host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)"
    return rf"""
WITH RECURSIVE rules(rule_host, rule_path, rule, action) AS (VALUES {listed}),
bare AS (SELECT url, regexp_replace(html, '(?s)<!--.*?-->', ' ', 'g') AS html FROM pages),
tags AS (
    SELECT url, unnest(regexp_extract_all(html, '(?is)<link\b[^>]*\brel\s*=\s*(?:"(?:[^">]*\s)?canonical(?:\s[^">]*)?"|''(?:[^''>]*\s)?canonical(?:\s[^''>]*)?''|canonical\b)[^>]*>')) AS tag, '\bhref' AS name
    FROM bare WHERE contains(url, '://')
    UNION ALL
    SELECT url, unnest(regexp_extract_all(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?\s*refresh\b[^>]*>')), '\burl'
    FROM bare WHERE contains(url, '://')
),
links AS (SELECT url, trim(regexp_extract(tag, '(?is)' || name || '\s*=\s*["'']?([^"''>\s]+)', 1)) AS link FROM tags),
targets AS (
    SELECT url, CASE WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN link
                     WHEN starts_with(link, '//') THEN 'x:' || link
                     WHEN starts_with(link, '/') THEN 'x://' || regexp_extract(url, '://([^/?#]*)', 1) || link
                     ELSE 'x://' || regexp_extract(url, '://([^/?#]*)', 1)
                          || coalesce(nullif(regexp_extract(url, '://[^/?#]*(/[^?#]*/|/)', 1), ''), '/') || link END AS target
    FROM (SELECT url, regexp_replace(link, '(?i)&(?:amp|#38|#x26);', '&', 'g') AS link FROM links) WHERE link <> ''
),
edges AS (SELECT DISTINCT {node.format("url")} AS a, {node.format("target")} AS b FROM targets),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach(node, alias) AS (
    SELECT a, a FROM both_ways
    UNION
    SELECT r.node, e.b FROM reach r JOIN both_ways e ON e.a = r.alias
),
alias_rules AS (
    SELECT node, alias, arg_max(action, length(rule)) AS action
    FROM (SELECT node, alias, {parts.format("alias")} FROM reach) JOIN rules ON {fits}
    GROUP BY node, alias
),
blocked AS (SELECT node FROM alias_rules GROUP BY node HAVING bool_or(action = 'block') AND NOT bool_or(action = 'allow')),
urls AS (SELECT page_id, coalesce(url, '') AS url, {parts.format("coalesce(url, '')")} FROM pages),
own AS (
    SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(action, length(rule)) AS action
    FROM (SELECT DISTINCT host, path FROM urls) JOIN rules ON {fits} GROUP BY host, path
)
SELECT page_id, host, path, rule, coalesce(action, CASE WHEN b.node IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
       action IS NULL AND b.node IS NOT NULL AS by_alias
FROM urls LEFT JOIN own USING (host, path) LEFT JOIN blocked b ON b.node = {node.format("url")}
"""


def clusters(k: int = 16, rounds: int = 3, dim: int = 64, scale: int = 64, seed: str = "1") -> str:
    """Assignment and update, unrolled round by round."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
near{i} AS (
    SELECT r, min(struct_pack(distance := CAST(list_sum(list_transform(list_zip(v.e, c.e), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT),
                              cluster := c.cluster)) AS best
    FROM v CROSS JOIN c{i} c GROUP BY r
)""")
        if i < rounds:
            steps.append(f"""
sums{i} AS (
    SELECT cluster, pos, CAST(sum(x) AS HUGEINT) AS s, count(*) AS n
    FROM (SELECT best.cluster AS cluster, unnest(e) AS x, generate_subscripts(e, 1) AS pos FROM v JOIN near{i} USING (r))
    GROUP BY cluster, pos
),
moved{i} AS (
    SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY pos) AS e FROM sums{i} GROUP BY cluster
),
c{i + 1} AS (SELECT cluster, coalesce(m.e, c.e) AS e FROM c{i} c LEFT JOIN moved{i} m USING (cluster))""")
    return f"""
WITH v AS (
    SELECT row_number() OVER () AS r, vec_id, e FROM (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS e
        FROM embeddings
        WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    )
),
c0 AS (
    SELECT CAST(row_number() OVER (ORDER BY sha256('{seed}:' || vec_id) NULLS LAST, e) - 1 AS INTEGER) AS cluster, e
    FROM v QUALIFY cluster < {k}
),{",".join(steps)},
found AS (SELECT vec_id, best.cluster AS cluster, best.distance AS distance FROM v JOIN near{rounds} USING (r))
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(list_aggregate(c.e, 'string_agg', ',')) AS centroid_sha256
FROM found JOIN c{rounds} c USING (cluster)
"""
