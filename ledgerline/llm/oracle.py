"""SQL that gives the same rows as some of the queries, for DuckDB over the same tables."""

from __future__ import annotations

from .secret_scan import BASE, MORE

JACCARD = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i : i + 3], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT r.a AS doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r.b) AS component_id FROM r LEFT JOIN n ON n.doc_id = r.a GROUP BY r.a
"""

PRODUCTS = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""

PASSAGES = """
WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, strlen(coalesce(text, '')) AS n FROM documents),
b AS (SELECT doc_id, n, unnest(range(0, n)) AS p, x FROM h WHERE n > 0),
k AS (SELECT doc_id, p, substr(x, 2 * p + 1, 2) AS c, CASE WHEN p + 100 <= n THEN md5(substr(x, 2 * p + 1, 200)) END AS g FROM b),
f AS (SELECT doc_id, p, c, g IS NOT NULL AND row_number() OVER (PARTITION BY g ORDER BY doc_id, p) > 1 AS again FROM k),
m AS (SELECT doc_id, p, c, max(CASE WHEN again THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS gone FROM f),
o AS (SELECT *, gone = 1 AND coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY p), 0) = 0 AS opens FROM m),
a AS (SELECT doc_id, CAST(sum(gone) AS BIGINT) AS n_removed, CAST(count(*) FILTER (WHERE opens) AS BIGINT) AS n_spans, coalesce(string_agg(c, '' ORDER BY p) FILTER (WHERE gone = 0), '') AS kept FROM o GROUP BY 1)
SELECT h.doc_id, CAST(h.n AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256 FROM h LEFT JOIN a ON a.doc_id = h.doc_id
"""


def secrets() -> str:
    """Matches are found by their texts and the pieces between them, as positions aren't given."""
    parts = []
    for order, rule in enumerate(BASE + MORE):
        p = rule.pattern.replace("'", "''")
        parts.append(
            f"""SELECT doc_id, {order} AS ord, '{rule.kind}' AS kind, len(h) AS size, g, start FROM (SELECT doc_id, unnest(hits) AS h, unnest(groups) AS g,
unnest(list_transform(range(1, len(hits) + 1), lambda k: list_sum(list_transform(pieces[1 : k], lambda x: len(x))) + coalesce(list_sum(list_transform(hits[1 : k - 1], lambda x: len(x))), 0))) AS start
FROM (SELECT doc_id, regexp_extract_all(text, '{p}', 0) AS hits, regexp_extract_all(text, '{p}', {rule.group}) AS groups, regexp_split_to_array(text, '{p}') AS pieces FROM documents WHERE regexp_matches(text, '{p}'))) WHERE len(g) >= {rule.least}"""
        )
    told = "string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(start + size AS BIGINT), ',' ORDER BY start, ord)"
    counts = ", ".join(f"CAST(count(*) FILTER (WHERE s.kind = '{r.kind}') AS BIGINT) AS n_{r.kind}" for r in BASE)
    return f"""WITH s AS ({" UNION ALL ".join(parts)}) SELECT d.doc_id, {counts}, sha256(coalesce({told} FILTER (WHERE ord < {len(BASE)}), '')) AS base_sha256, coalesce({told} FILTER (WHERE s.doc_id IS NOT NULL), '') AS spans
FROM documents d LEFT JOIN s ON s.doc_id = d.doc_id GROUP BY d.doc_id"""


def merkle(deep: int = 8, deep_sources: int = 4) -> str:
    """Levels and foldings written out, for up to 16**deep rows a source and 16**deep_sources sources."""
    run = "string_agg(h, '') OVER (PARTITION BY key, idx // 16 ORDER BY idx ROWS BETWEEN"

    def tree(name: str, levels: int) -> list[str]:
        out = []
        for k in range(levels):
            out.append(f"{name}s{k} AS (SELECT key, idx, coalesce({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, coalesce({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k} WHERE n > 1)")
            out.append(f"{name}{k + 1} AS (SELECT key, idx // 16 AS idx, any_value((n + 15) // 16) AS n, sha256(string_agg(h, '' ORDER BY idx)) AS h FROM {name}{k} WHERE n > 1 GROUP BY key, idx // 16)")
        return out

    def tops(name: str, levels: int) -> str:
        return " UNION ALL ".join(f"SELECT key, h FROM {name}{k} WHERE n = 1" for k in range(levels + 1))

    def folds(name: str, levels: int, key: str, idx: str, before: str) -> list[str]:
        out = []
        for k in range(levels):
            own = f"f{name}{k}"
            out.append(f"{own} AS (SELECT f.* EXCLUDE (fold, proof), CASE WHEN s.key IS NULL THEN fold ELSE sha256(s.l || fold || s.r) END AS fold, proof || coalesce(s.l || s.r, '') AS proof FROM {before} f LEFT JOIN {name}s{k} s ON s.key = f.{key} AND s.idx = f.{idx} // {16**k})")
            before = own
        return out

    def part(column: str) -> str:
        return f"coalesce(CAST(strlen(CAST({column} AS VARCHAR)) AS VARCHAR) || ':' || CAST({column} AS VARCHAR), '-')"

    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    head = " || ".join(part(c) for c in ("doc_id", "source", "lang", "n_chars"))
    crc = "xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(w) + 1), lambda i: CAST(ascii(substr(w, i, 1)) AS BIGINT))), lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295)"
    table = "list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"
    parts = [
        f"d AS (SELECT *, CAST(doc_id AS VARCHAR) AS w, {table} AS steps FROM documents)",
        f"e AS (SELECT doc_id, coalesce('=' || source, '') AS key, sha256({head} || {part('text')}) AS h, CASE WHEN {crc} % 5 = 0 THEN sha256({head} || {part(low)}) END AS altered FROM d)",
        "a0 AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, h) - 1 AS idx, count(*) OVER (PARTITION BY key) AS n FROM e)",
        *tree("a", deep),
        f"subs AS ({tops('a', deep)})",
        "b0 AS (SELECT '' AS key, key AS source, h, row_number() OVER (ORDER BY key) - 1 AS idx, count(*) OVER () AS n FROM subs)",
        *tree("b", deep_sources),
        f"root AS ({tops('b', deep_sources)})",
        "start AS (SELECT a0.doc_id, a0.key, a0.idx, a0.h AS leaf, b0.h AS subroot, b0.idx AS at, '' AS over, coalesce(a0.altered, a0.h) AS fold, '' AS proof FROM a0 JOIN b0 ON b0.source = a0.key)",
        *folds("a", deep, "key", "idx", "start"),
        *folds("b", deep_sources, "over", "at", f"fa{deep - 1}"),
    ]
    return f"WITH {', '.join(parts)} SELECT doc_id, leaf, subroot, (SELECT h FROM root) AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = (SELECT h FROM root) AS verified FROM fb{deep_sources - 1}"
