"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

from .mixing import MAX_REPEATS, SEED

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACE = r"[^\x20\x09-\x0D]+"

OP1 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWER}, '{ALNUM}') AS w FROM documents),
b AS (SELECT cast(item_id AS VARCHAR) AS item, regexp_extract_all({LOWER}, '{ALNUM}') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, w[i:i + 9] AS win FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0)),
ls AS (SELECT DISTINCT len(win) AS n FROM bw),
dw AS (SELECT r, i, n, w[i:i + n - 1] AS win FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, ls WHERE len(w) >= n)),
hits AS (SELECT r, i, n, item FROM dw JOIN bw USING (win)),
words AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS q FROM hits) GROUP BY r),
items AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM hits GROUP BY r)
SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

# A row per match: the text is cut at the matches, so running lengths are the positions.
_KINDS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
    ("ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "list_max(list_transform(string_split(m, '.'), lambda x: cast(x AS HUGEINT))) <= 255"),
    ("card", r"[0-9](?:[\x20-]?[0-9])+", "len(g) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, len(g) + 1), lambda i: "
     "CASE WHEN (len(g) - i) % 2 = 1 THEN cast(g[i] AS INT) * 2 - CASE WHEN cast(g[i] AS INT) > 4 THEN 9 ELSE 0 END ELSE cast(g[i] AS INT) END)) % 10 = 0"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "len(g) BETWEEN 9 AND 15"),
]


def _matches(order: int, kind: str, pattern: str, valid: str) -> str:
    return f"""
SELECT r, {order} AS o, '{kind}' AS kind, pos AS s, pos + len(m) AS e FROM (
  SELECT r, m, regexp_replace(m, '[^0-9]', '', 'g') AS g, pos FROM (
    SELECT r, unnest(ms) AS m, unnest(list_transform(range(1, len(ms) + 1), lambda i:
      cast(list_sum(list_transform(gaps[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: len(x))), 0) AS BIGINT))) AS pos
    FROM (SELECT r, regexp_extract_all(t, '{pattern}') AS ms, string_split_regex(t, '{pattern}') AS gaps FROM d) WHERE len(ms) > 0))
WHERE {valid}"""


#: The base kinds. The spans that the method adds need a look behind, which this SQL lacks, so the
#: query's column ``spans`` is compared by the tests instead.
OP6_BASE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(_matches(i, *k) for i, k in enumerate(_KINDS))}),
per AS (SELECT r, {", ".join(f"count(*) FILTER (kind = '{k[0]}') AS n_{k[0]}" for k in _KINDS)},
  string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) AS names FROM found GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{k[0]}, 0) AS n_{k[0]}" for k in _KINDS)}, sha256(coalesce(names, '')) AS base_sha256
FROM d LEFT JOIN per USING (r)
"""

OP10 = f"""
WITH d AS (SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '{SPACE}')) AS size,
  md5(coalesce(cast(doc_id AS VARCHAR), '')) AS ord FROM documents),
s AS (SELECT source, cast(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, {MAX_REPEATS} * source_size AS cap FROM s),
l AS (SELECT *, row_number() OVER o AS place,
  cast(sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
  / (sum(weight) OVER () - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM w WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)),
f AS (SELECT min(place) AS first_open FROM l WHERE cap >= weight * level),
v AS (SELECT level FROM l, f WHERE place = first_open),
t AS (SELECT source, source_size, CASE WHEN place >= first_open THEN weight * v.level ELSE cap END AS target,
  cast('0x' || substr(md5('{SEED}' || coalesce('s' || source, 'n')), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u FROM l, f, v),
k AS (SELECT d.*, t.source_size, t.target, t.u, CASE WHEN t.source_size = 0 THEN 0 ELSE t.target / t.source_size END AS rate,
  row_number() OVER (PARTITION BY d.source ORDER BY lpad(len(bin(size))::VARCHAR, 2, '0') || rpad(substr(bin(size), 2, 3), 3, '0'), ord, doc_id, size) AS k
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, cast(size AS BIGINT) AS size, source_size, cast(target AS DOUBLE) AS target,
  cast((floor(k * rate + u) - floor((k - 1) * rate + u)) * size AS BIGINT) AS taken FROM k
"""

OP7 = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER}, '{SPACE}') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
r AS (SELECT doc_id, doc_id AS c FROM d UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.c),
m AS (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM d LEFT JOIN n USING (doc_id) JOIN m USING (doc_id)
"""

# A score's bound needs no place in SQL: every pair is scored.
OP4 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, cast(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 20 = 0),
k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, cast(rank AS INT) AS rank, vec_id, score FROM k WHERE rank <= 20
"""

OP5 = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
e AS (SELECT *, len(role || text) + len(regexp_replace(role || text, '[^\\<>]', '', 'g')) + 15 AS n FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  cast(coalesce(sum(len(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  cast(sum(n) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

# Every document is scored; items with equal terms of one id are one item.
OP11 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({LOWER}, '{ALNUM}') AS w FROM documents),
s AS (SELECT count(*) AS docs, cast(sum(len(w)) AS BIGINT) AS words FROM d WHERE len(w) > 0),
i AS (SELECT row_number() OVER () AS q, item_id, w FROM (SELECT DISTINCT item_id, regexp_extract_all({LOWER}, '{ALNUM}') AS w FROM benchmark)),
it AS (SELECT q, t, count(*) AS times FROM (SELECT q, unnest(w) AS t FROM i) GROUP BY ALL),
dt AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM it) GROUP BY ALL),
wt AS (SELECT t, cast(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM dt, s GROUP BY t, docs),
m AS (SELECT r, doc_id, 100 - 75 + ((75 * len(w) * docs) // words) AS m FROM d, s WHERE len(w) > 0),
sc AS (SELECT q, r, cast(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM it JOIN wt USING (t) JOIN dt USING (t) JOIN m USING (r) GROUP BY q, r),
k AS (SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM sc JOIN m USING (r) WHERE score > 0)
SELECT item_id, cast(rank AS INT) AS rank, doc_id, score FROM k JOIN i USING (q) WHERE rank <= 10
"""

ORACLES = {"op1_decontamination": OP1, "op4_topk": OP4, "op5_chat_format": OP5, "op7_jaccard_join": OP7, "op10_mixing": OP10, "op11_lexical_search": OP11}
