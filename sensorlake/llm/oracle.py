"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from sensorlake.llm import codes, mixing, search, secrets, suffix

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"""

OP3 = f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT r, array_to_string(w[i:i + 4], ' ') AS sh
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT r, count(*) AS n FROM s GROUP BY r),
common AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.r < b.r GROUP BY 1, 2),
links AS MATERIALIZED (SELECT a, b FROM common JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
both_ways AS MATERIALIZED (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a AS k, b AS r FROM both_ways UNION SELECT k, b FROM reach JOIN both_ways ON a = reach.r),
least_ AS (SELECT k, min(doc_id) AS m FROM reach JOIN d USING (r) GROUP BY k),
c AS (SELECT d.r, doc_id, coalesce(least(doc_id, m), doc_id, m) AS component_id FROM d LEFT JOIN least_ ON k = d.r)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id, coalesce(doc_id = component_id, component_id IS NULL) AS kept FROM c LEFT JOIN n USING (r)
"""

_TRIALS = ", ".join(str(i) for i in range(mixing.TRIALS))
OP4 = rf"""
WITH d AS MATERIALIZED (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
  md5(coalesce(doc_id::VARCHAR, 'null')) AS o, (source IS NOT NULL)::INT AS has, coalesce(source, '') AS name FROM documents),
per AS (SELECT has, name, sum(size)::BIGINT AS source_size FROM d GROUP BY 1, 2),
weighed AS (SELECT *, ([5.0, 2.0, 1.0])[((row_number() OVER (ORDER BY has DESC, name)) - 1) % 3 + 1]::DOUBLE AS weight, 2.0::DOUBLE * source_size AS cap FROM per),
rated AS (SELECT *, cap / weight AS ratio, 1.5::DOUBLE * sum(source_size) OVER () AS total FROM weighed),
reached AS (SELECT *, (total - coalesce(sum(cap) OVER before, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) >= ratio AS is_full
  FROM rated WINDOW before AS (ORDER BY ratio, has DESC, name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT *, CASE WHEN is_full THEN cap ELSE (total - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ()) * weight
  / sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER () END AS target FROM reached),
goal AS (SELECT has, name, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS each_ FROM t),
ranked AS MATERIALIZED (SELECT d.*, source_size, target, each_, row_number() OVER (PARTITION BY has, name ORDER BY size, o) - 1 AS before_ FROM d JOIN goal USING (has, name)),
trials AS (SELECT has, name, i, ('0x' || substr(md5('mix' || i || '|' || has || name), 1, 8))::BIGINT::DOUBLE / 4294967296.0::DOUBLE AS u FROM goal, (SELECT unnest([{_TRIALS}]) AS i)),
tried AS (SELECT has, name, i, u, abs(sum(size * least(floor((before_ + 1) * each_ + u) - floor(before_ * each_ + u), ceil(each_))) - any_value(target)) AS off_
  FROM ranked JOIN trials USING (has, name) GROUP BY ALL),
best AS (SELECT has, name, arg_min(u, (off_, i)) AS u FROM tried GROUP BY 1, 2)
SELECT doc_id, size, source_size, target, (size * least(floor((before_ + 1) * each_ + u) - floor(before_ * each_ + u), ceil(each_)))::BIGINT AS taken, source
FROM ranked JOIN best USING (has, name)
"""


def _spans(place: int, rule: secrets.Rule) -> str:
    pattern = rule.pattern.replace("'", "''")
    return f"""
SELECT doc_id, {place} AS place, '{rule.kind}' AS kind,
  (list_sum(list_transform(p[1:j], lambda x: len(x))) + coalesce(list_sum(list_transform(m[1:j - 1], lambda x: len(x))), 0))::BIGINT AS b, len(m[j]) AS n
FROM (SELECT *, unnest(range(1, len(m) + 1)) AS j FROM (SELECT doc_id, string_split_regex(t, '{pattern}') AS p,
  regexp_extract_all(t, '{pattern}') AS m, regexp_extract_all(t, '{pattern}', {rule.group}) AS g FROM d WHERE regexp_matches(t, '{pattern}')))
WHERE len(g[j]) >= {rule.least}"""


_BASE = ", ".join(f"'{r.kind}'" for r in secrets.BASE)
OP7 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
s AS ({" UNION ALL ".join(_spans(i, r) for i, r in enumerate(secrets.BASE + secrets.MORE))}),
per AS (SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in secrets.BASE)},
  string_agg(kind || ':' || b || ':' || (b + n), ',' ORDER BY b, place, b + n) FILTER (kind IN ({_BASE})) AS base,
  string_agg(kind || ':' || b || ':' || (b + n), ',' ORDER BY b, place, b + n) AS spans FROM s GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in secrets.BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per USING (doc_id)
"""

OP9 = f"""
WITH t AS MATERIALIZED (SELECT doc_id, w, count(*) AS tf FROM (SELECT doc_id, unnest({_WORDS}) AS w FROM documents) GROUP BY 1, 2),
l AS (SELECT doc_id, sum(tf) AS n FROM t GROUP BY 1),
c AS (SELECT count(*)::DOUBLE AS n, (SELECT sum(tf) FROM t)::DOUBLE / count(*) AS mean FROM documents),
f AS (SELECT w, count(*)::DOUBLE AS df FROM t GROUP BY 1),
hits AS (SELECT q.doc_id AS query_id, t.doc_id, sum(ln(1 + (c.n - df + 0.5) / (df + 0.5)) * tf_ * {search.K1 + 1} / (tf_ + {search.K1} * (1 - {search.B} + {search.B} * l.n / c.mean))) AS s
  FROM t q JOIN (SELECT doc_id, w, tf::DOUBLE AS tf_ FROM t) t ON t.w = q.w AND t.doc_id <> q.doc_id JOIN f ON f.w = q.w JOIN l ON l.doc_id = t.doc_id, c
  WHERE q.doc_id % 100 = 0 GROUP BY 1, 2),
r AS (SELECT query_id, doc_id, round(s, {search.DIGITS}) AS score, row_number() OVER (PARTITION BY query_id ORDER BY round(s, {search.DIGITS}) DESC, doc_id) AS rank FROM hits)
SELECT query_id, rank::INT AS rank, doc_id, score FROM r WHERE rank <= 10
"""

#: Bytes as two hexadecimal digits each: byte p of a text begins at digit 2 * p + 1.
OP10 = f"""
WITH d AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, '')))::BIGINT AS n FROM documents),
w AS MATERIALIZED (SELECT doc_id, p, md5(substr(h, 2 * p + 1, {2 * suffix.LENGTH})) AS m FROM (SELECT doc_id, h, unnest(range(0, n - {suffix.LENGTH - 1})) AS p FROM d)),
s AS (SELECT doc_id, p FROM w WHERE m IN (SELECT m FROM w GROUP BY m HAVING count(*) > 1)),
edges AS (SELECT doc_id, p, coalesce(p > lag(p) OVER o + {suffix.LENGTH}, true) AS first_ FROM s WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
islands AS (SELECT doc_id, p, sum(first_::INT) OVER (PARTITION BY doc_id ORDER BY p) AS i FROM edges),
spans AS (SELECT doc_id, i, min(p) AS a, max(p) + {suffix.LENGTH} AS b FROM islands GROUP BY 1, 2),
gaps AS (SELECT doc_id, i, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY i), 0) AS x, a AS y FROM spans
  UNION ALL SELECT d.doc_id, 1000000000, coalesce(max(b), 0), any_value(n) FROM d LEFT JOIN spans USING (doc_id) GROUP BY d.doc_id),
kept AS (SELECT doc_id, coalesce(string_agg(substr(h, 2 * x + 1, 2 * (y - x)), '' ORDER BY i), '') AS k FROM gaps JOIN d USING (doc_id) GROUP BY doc_id),
cut AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN cut USING (doc_id)
"""


def _round(k: int) -> str:
    """The assignment to codebook ``k``, and the codebook that follows from it."""
    return f"""
a{k} AS MATERIALIZED (SELECT r, part, min(d * {codes.ENTRIES} + entry) % {codes.ENTRIES} AS entry, min(d * {codes.ENTRIES} + entry) // {codes.ENTRIES} AS d
  FROM (SELECT r, part, entry, CAST(list_sum(list_transform(list_zip(xs, es), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d FROM p JOIN c{k} USING (part)) GROUP BY r, part),
m{k} AS (SELECT part, entry, list(m ORDER BY i) AS es FROM (SELECT part, entry, i, CAST(floor(sum(xs[i]) / count(*)) AS BIGINT) AS m
  FROM (SELECT part, entry, xs, unnest(range(1, len(xs) + 1)) AS i FROM a{k} JOIN p USING (r, part)) GROUP BY ALL) GROUP BY ALL),
c{k + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m{k}.es, c{k}.es) AS es FROM c{k} LEFT JOIN m{k} USING (part, entry))"""


OP12 = f"""
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(x::DOUBLE * {codes.SCALE}) AS BIGINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
n AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, x) - 1 AS r, len(x) // {codes.PARTS} AS w FROM v),
p AS MATERIALIZED (SELECT r, part, x[part * w + 1:(part + 1) * w] AS xs FROM n, (SELECT unnest(range(0, {codes.PARTS})) AS part)),
c0 AS MATERIALIZED (SELECT part, r AS entry, xs AS es FROM p WHERE r < {codes.ENTRIES}),{",".join(_round(k) for k in range(codes.ROUNDS + 1))},
found AS (SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{codes.ROUNDS} GROUP BY r),
books AS (SELECT sha256(string_agg(array_to_string(es, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c{codes.ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM n JOIN found USING (r), books
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_near_duplicates": OP3, "op4_mixing": OP4, "op7_secrets": OP7, "op9_search": OP9, "op10_repeats": OP10, "op12_codes": OP12}
