"""The queries of this package, and the SQL for those that SQL can express."""

from __future__ import annotations

from importlib import import_module

_WHERE = {
    "op1_jaccard_join": "jaccard",
    "op2_latent_decontamination": "decontaminate",
    "op3_hmm_score": "hmm",
    "op4_subword_quality": "quality",
    "op5_line_dedup": "lines",
    "op6_cross_polytope": "embedding",
    "op7_suffix_dedup": "suffixes",
    "op8_secret_scan": "secrets",
    "op9_pivotal_mixing": "mixing",
    "op10_chained_passages": "chains",
    "op11_sort_means": "centroids",
    "op12_word_table_bpe": "tokens",
    "op13_ball_tree_negatives": "negatives",
}


def queries() -> dict:
    return {name: getattr(import_module(f"{__package__}.{module}"), name) for name, module in _WHERE.items()}


_LOW = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WHOLE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _sort_means(rounds: int = 10) -> str:
    """Lloyd's rounds, one after the other; centroids are floors of means."""
    apart = "list_sum(list_transform(list_zip(v.e, c.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    near = "SELECT v.vec_id, v.e, c.c, CAST({d} AS BIGINT) AS d FROM v, c{r} c QUALIFY row_number() OVER (PARTITION BY v.vec_id ORDER BY d, c.c) = 1"
    parts = [
        f"v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings WHERE len(embedding) = 64 AND {_WHOLE})",
        "c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS INTEGER) AS c, e FROM v ORDER BY sha256('3:' || vec_id) LIMIT 8)",
    ]
    for r in range(rounds + 1):
        parts.append(f"a{r} AS MATERIALIZED ({near.format(d=apart, r=r)})")
        if r < rounds:
            parts.append(f"s{r} AS MATERIALIZED (SELECT c, j, CAST(SUM(e[j]) AS BIGINT) AS s, COUNT(*) AS n FROM a{r}, range(1, 65) t(j) GROUP BY c, j)")
            parts.append(f"c{r + 1} AS MATERIALIZED (SELECT o.c, COALESCE(k.e, o.e) AS e FROM c{r} o LEFT JOIN (SELECT c, list((s - (s % n + n) % n) // n ORDER BY j) AS e FROM s{r} GROUP BY c) k ON k.c = o.c)")
    return f"""WITH {", ".join(parts)}
SELECT vec_id, c AS cluster, d AS distance, CAST(SUM(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(SUM(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(o.e, ',')) AS centroid_sha256 FROM a{rounds} a JOIN c{rounds} o USING (c)"""


SQL = {
    "op1_jaccard_join": f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOW}, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, UNNEST(CASE WHEN len(ws) >= 4 THEN list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i : i + 3], ' ')) WHEN len(ws) > 0 THEN ['= ' || array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS id, doc_id AS root FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id)
SELECT d.doc_id, COALESCE(n.n, 0) AS n_shingles, c.component_id FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT id, MIN(root) AS component_id FROM r GROUP BY id) c ON c.id = d.doc_id""",
    "op5_line_dedup": """WITH x AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents), l AS (SELECT doc_id, UNNEST(ls) AS line, UNNEST(range(len(ls))) AS no FROM x),
f AS (SELECT line, strlen(line) AS n, MIN(doc_id * 1000000 + no) AS place FROM l WHERE strlen(line) >= 30 GROUP BY line),
late AS (SELECT DISTINCT b.line FROM f a JOIN f b ON a.place < b.place AND a.n BETWEEN b.n - 2 AND b.n + 2 WHERE levenshtein(a.line, b.line) <= 2),
k AS (SELECT l.*, strlen(l.line) < 30 OR (late.line IS NULL AND f.place = l.doc_id * 1000000 + l.no) AS keep FROM l LEFT JOIN f ON f.line = l.line LEFT JOIN late ON late.line = l.line)
SELECT doc_id, COUNT(*) AS n_lines, COUNT(*) FILTER (NOT keep) AS n_removed, sha256(COALESCE(string_agg(line, chr(10) ORDER BY no) FILTER (keep), '')) AS kept_sha256 FROM k GROUP BY doc_id""",
    "op6_cross_polytope": """WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings), l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id < b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l), r AS (SELECT vec_id AS id, vec_id AS root FROM embeddings UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id),
c AS (SELECT id, MIN(root) AS component_id FROM r GROUP BY id), k AS (SELECT a, COUNT(*) AS n FROM e GROUP BY a)
SELECT vec_id, COALESCE(k.n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM embeddings JOIN c ON c.id = vec_id LEFT JOIN k ON k.a = vec_id""",
    "op7_suffix_dedup": """WITH h AS (SELECT doc_id, strlen(text) AS n, hex(encode(text)) AS h FROM documents),
w AS (SELECT doc_id, p, substr(h, 2 * p + 1, 200) AS s FROM (SELECT doc_id, h, UNNEST(range(greatest(n - 99, 0))) AS p FROM h)),
f AS (SELECT s, MIN(doc_id * 100000000 + p) AS m FROM w GROUP BY s HAVING COUNT(*) > 1),
late AS (SELECT doc_id, p FROM w JOIN f USING (s) WHERE doc_id * 100000000 + p <> m),
o AS (SELECT *, CASE WHEN p > COALESCE(LAG(p) OVER (PARTITION BY doc_id ORDER BY p), -200) + 100 THEN 1 ELSE 0 END AS o FROM late),
g AS (SELECT *, SUM(o) OVER (PARTITION BY doc_id ORDER BY p) AS g FROM o),
sp AS (SELECT doc_id, MIN(p) AS lo, MAX(p) + 100 AS hi FROM g GROUP BY doc_id, g),
c AS (SELECT doc_id, lo, hi, LEAD(lo) OVER (PARTITION BY doc_id ORDER BY lo) AS nx, ROW_NUMBER() OVER (PARTITION BY doc_id ORDER BY lo) AS r FROM sp),
k AS (SELECT c.doc_id, COUNT(*) AS n_spans, CAST(SUM(hi - lo) AS BIGINT) AS n_removed, string_agg(CASE WHEN r = 1 THEN substr(h, 1, 2 * lo) ELSE '' END || substr(h, 2 * hi + 1, 2 * (COALESCE(nx, n) - hi)), '' ORDER BY lo) AS rest FROM c JOIN h USING (doc_id) GROUP BY c.doc_id)
SELECT h.doc_id, n AS n_bytes, COALESCE(n_removed, 0) AS n_removed, COALESCE(n_spans, 0) AS n_spans, sha256(unhex(COALESCE(rest, h))) AS kept_sha256 FROM h LEFT JOIN k ON k.doc_id = h.doc_id""",
    "op11_sort_means": _sort_means(),
    "op13_ball_tree_negatives": f"""WITH v AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings WHERE label IS NOT NULL AND {_WHOLE}),
s AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_sum(list_transform(list_zip(a.e, b.e), lambda z: z[1] * z[2])) AS BIGINT) AS s FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT a, b, s FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5),
n AS (SELECT p.a, p.b, p.s, n.b AS nb, n.s AS ns, CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.s DESC, n.b) AS INTEGER) AS r FROM p JOIN s n ON n.a = p.a AND NOT n.same AND 30 * p.s <= 100 * n.s AND 100 * n.s <= 90 * p.s)
SELECT a AS anchor_id, b AS positive_id, r AS rank, nb AS negative_id, s AS positive_score, ns AS negative_score FROM n WHERE r <= 10""",
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
