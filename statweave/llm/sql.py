"""SQL of the corpus queries that SQL can express on whole tables."""

from __future__ import annotations

from . import secrets as s


def _places(kind: str, pattern: str, group: int, least: int) -> str:
    pattern = pattern.replace("'", "''")
    number = s.KINDS.index(kind)
    return f"""list_filter(list_transform(range(len(h_{kind})), lambda i: {{
        'at': list_sum(list_transform(g_{kind}[1:i + 1], lambda x: length(x)))::INT + coalesce(list_sum(list_transform(h_{kind}[1:i], lambda x: length(x))), 0)::INT,
        'kind': {number},
        'fin': list_sum(list_transform(g_{kind}[1:i + 1], lambda x: length(x)))::INT + list_sum(list_transform(h_{kind}[1:i + 1], lambda x: length(x)))::INT,
        'ok': length(z_{kind}[i + 1]) >= {least}}}), lambda x: x.ok)"""


def _hits(kind: str, pattern: str, group: int) -> str:
    quoted = pattern.replace("'", "''")
    return (f"regexp_extract_all(t, '{quoted}', 0) AS h_{kind}, regexp_extract_all(t, '{quoted}', {group}) AS z_{kind}, "
            f"string_split_regex(t, '{quoted}') AS g_{kind}")


_PATTERNS = [*s.BASE, *((kind, pattern, 0, 0) for kind, pattern in s.WEAK)]
_NAMES = "[" + ", ".join(f"'{k}'" for k in s.KINDS) + "]"
_TEXT = f"array_to_string(list_transform(list_sort({{}}), lambda x: {_NAMES}[x.kind + 1] || ':' || x.at || ':' || x.fin), ',')"
_NEAR = f"greatest(o.at, w.at) - least(o.fin, w.fin) <= {s.SCOPE}"

SECRETS = f"""
WITH hits AS (SELECT doc_id, coalesce(text, '') AS t, {', '.join(_hits(k, p, g) for k, p, g, _ in _PATTERNS)} FROM documents),
found AS (SELECT doc_id, t, {', '.join(f'{_places(*x)} AS s_{x[0]}' for x in _PATTERNS)} FROM hits),
split AS (SELECT doc_id, t, s_assign, s_access, s_hex, list_concat(list_concat(s_assign, s_access), s_hex) AS base,
    list_concat(list_concat(list_filter(s_id, lambda w: regexp_matches(t[w.at + 1:w.fin], '[0-9]') AND regexp_matches(t[w.at + 1:w.fin], '[A-Za-z]')),
        list_filter(s_key, lambda w: regexp_matches(t[w.at + 1:w.fin], '[0-9]') AND regexp_matches(t[w.at + 1:w.fin], '[A-Za-z]'))), s_endpoint) AS loose
    FROM found),
parted AS (SELECT *, list_filter(loose, lambda w: len(list_filter(base, lambda b: b.at < w.fin AND w.at < b.fin)) = 0) AS weak FROM split),
linked AS (SELECT *, list_concat(base, weak) AS o_all FROM parted),
judged AS (SELECT *, list_filter(weak, lambda w: CASE w.kind
    WHEN 3 THEN len(list_filter(o_all, lambda o: o.kind IN (0, 2, 4) AND {_NEAR})) > 0
    WHEN 4 THEN len(list_filter(o_all, lambda o: o.kind IN (1, 3, 5) AND {_NEAR})) > 0
    ELSE len(list_filter(o_all, lambda o: o.kind <> 5 AND {_NEAR})) > 0 END) AS sure
    FROM linked)
SELECT doc_id, len(s_assign)::BIGINT AS n_assign, len(s_access)::BIGINT AS n_access, len(s_hex)::BIGINT AS n_hex,
    sha256({_TEXT.format('base')}) AS base_sha256, {_TEXT.format('list_concat(base, sure)')} AS spans
FROM judged
"""

HAMMING = """
WITH codes AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: x > 0) AS code FROM embeddings WHERE embedding IS NOT NULL),
pairs AS (SELECT q.vec_id AS query_id, v.vec_id AS neighbor_id,
    len(list_filter(list_zip(q.code, v.code), lambda z: z[1] <> z[2]))::INT AS distance
    FROM codes q JOIN codes v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id)::INT AS rank, neighbor_id, distance
FROM pairs QUALIFY rank <= 10
"""


def _lloyd(turn: int) -> str:
    """Assign all parts to the codebook of the last turn, then move its entries."""
    return f"""a{turn} AS (SELECT p, x, arg_min(e, d * 64 + e) AS e FROM (SELECT vec_id, label, p, x, e,
        list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::HUGEINT AS d FROM parts JOIN b{turn - 1} USING (p))
    GROUP BY vec_id, label, p, x),
m{turn} AS (SELECT p, e, list(m ORDER BY k) AS c FROM (SELECT p, e, k, ((sum(x[k]) - ((sum(x[k]) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS m
    FROM a{turn}, range(1, (SELECT s + 1 FROM cut)) r(k) GROUP BY p, e, k) GROUP BY p, e),
b{turn} AS (SELECT p, e, coalesce(m{turn}.c, b{turn - 1}.c) AS c FROM b{turn - 1} LEFT JOIN m{turn} USING (p, e))"""


CODES = f"""
WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cut AS (SELECT len(v) // 16 AS s FROM kept ORDER BY vec_id LIMIT 1),
parts AS (SELECT vec_id, label, p, list_slice(v, p * s + 1, p * s + s) AS x FROM kept, cut, range(16) r(p)),
b0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c FROM parts
    WHERE vec_id IN (SELECT DISTINCT vec_id FROM kept ORDER BY vec_id LIMIT 64)),
{_lloyd(1)},
{_lloyd(2)},
fin AS (SELECT vec_id, label, p, arg_min(e, d * 64 + e) AS e, min(d) AS d FROM (SELECT vec_id, label, p, e,
    list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::HUGEINT AS d FROM parts JOIN b2 USING (p)) GROUP BY vec_id, label, p),
coded AS (SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM fin GROUP BY vec_id, label),
told AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b2)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded, told
"""
