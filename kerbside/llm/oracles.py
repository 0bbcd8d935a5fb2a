"""DuckDB SQL of the queries that SQL can express."""

ORACLES = {}

ORACLES["op10_embedding_neighbours"] = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS e, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS norm
    FROM embeddings WHERE embedding IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), link AS (
    SELECT a.vec_id AS a, b.vec_id AS b
    FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE a.norm > 0 AND b.norm > 0 AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93
), reach(a, b) AS (
    SELECT vec_id, vec_id FROM embeddings
    UNION
    SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
), component AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT e.vec_id, coalesce(d.n, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN component c ON e.vec_id = c.a LEFT JOIN degree d ON e.vec_id = d.a
"""

ORACLES["op5_ngram_jaccard"] = r"""
WITH RECURSIVE word AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingle AS (
    SELECT DISTINCT doc_id, list_slice(w, i, least(i + 4, len(w))) AS s
    FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, least(len(w), 1)))) AS i FROM word)
), size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
link AS (
    SELECT a, b FROM (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
        FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL)
    JOIN size m ON m.doc_id = a JOIN size n ON n.doc_id = b
    WHERE 100 * common >= 75 * (m.n + n.n - common)
), reach(a, b) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
)
SELECT d.doc_id, coalesce(max(s.n), 0) AS n_shingles, min(r.b) AS component_id
FROM documents d JOIN reach r ON r.a = d.doc_id LEFT JOIN size s ON s.doc_id = d.doc_id
GROUP BY d.doc_id
"""


def _codes(rounds):
    """Codebooks and codes, one pair of steps per round."""
    whole = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
    steps = [f"""WITH kept AS MATERIALIZED (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE {whole}),
dim AS (SELECT (max(len(e)) + 3) // 4 AS w FROM kept),
part AS MATERIALIZED (
    SELECT vec_id, label, p, list_transform(list_resize(e, 4 * w, 0.0)[p * w + 1:(p + 1) * w], lambda x: floor(1024 * x)) AS x
    FROM kept, dim, range(4) AS r(p)
), b0 AS MATERIALIZED (
    SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c
    FROM part WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 256)
)"""]
    for k in range(rounds + 1):
        steps.append(f"""a{k} AS MATERIALIZED (
    SELECT vec_id, p, any_value(label) AS label, any_value(x) AS x,
           min((list_dot_product(x, x) - 2 * list_dot_product(x, c) + list_dot_product(c, c))::BIGINT * 256 + e) AS m
    FROM part JOIN b{k} USING (p) GROUP BY vec_id, p
)""")
        if k < rounds:
            steps.append(f"""b{k + 1} AS MATERIALIZED (
    WITH moved AS (
        SELECT p, m % 256 AS e, i, floor(sum(x[i]) / count(*)) AS v FROM a{k}, dim, range(1, w + 1) AS r(i) GROUP BY p, m % 256, i
    ), joined AS (SELECT p, e, list(v ORDER BY i) AS c FROM moved GROUP BY p, e)
    SELECT p, e, coalesce(j.c, b.c) AS c FROM b{k} b LEFT JOIN joined j USING (p, e)
)""")
    return ",\n".join(steps) + f""",
coded AS (
    SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', (m % 256)::INTEGER), '' ORDER BY p) AS code, sum(m // 256)::BIGINT AS error
    FROM a{rounds} GROUP BY vec_id
), books AS (
    SELECT sha256(string_agg(c[i]::BIGINT::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256 FROM b{rounds}, dim, range(1, w + 1) AS r(i)
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded, books"""


ORACLES["op11_vector_codes"] = _codes(4)

ORACLES["op12_source_mix"] = """
WITH doc AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
           md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS place FROM documents
), per_source AS (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS k FROM doc GROUP BY source
), weighed AS (
    SELECT *, (1 + k % 3)::DOUBLE AS w, (1 + k % 3) * CASE WHEN k % 2 = 0 THEN 1.5::DOUBLE ELSE 0.5::DOUBLE END AS w0,
           (1 + k % 3) * CASE WHEN k % 2 = 0 THEN 0.5::DOUBLE ELSE 1.5::DOUBLE END AS w1, sum(source_size) OVER () AS total FROM per_source
), stops AS (
    -- In the order in which sources stop as all shares rise: what is left, and by what weight, when this one's turn has come.
    SELECT *, total - coalesce(sum(3 * source_size) OVER up, 0) AS rest, sum(w) OVER () - coalesce(sum(w) OVER up, 0) AS weights
    FROM weighed WINDOW up AS (ORDER BY 3 * source_size / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
    SELECT rest::DOUBLE AS rest, weights FROM stops WHERE 3 * source_size > rest * w / weights ORDER BY 3 * source_size / w, k LIMIT 1
), target AS (
    SELECT s.*, coalesce(least(3.0::DOUBLE * source_size, (SELECT rest FROM level) * w / (SELECT weights FROM level)), 3.0::DOUBLE * source_size) AS target
    FROM weighed s
), laid AS (
    SELECT d.*, t.* EXCLUDE (source), floor(target + 0.5)::BIGINT AS budget,
           coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY place, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
    FROM doc d JOIN target t ON d.source IS NOT DISTINCT FROM t.source
), due AS (
    SELECT *, start / budget::DOUBLE * w AS demand,
           (SELECT sum(greatest(0, least(size, budget - (e * source_size + start)))) FROM range(3) AS r(e)) AS taken FROM laid
)
SELECT doc_id, size, source_size, target, taken::BIGINT AS taken,
       CASE WHEN taken > 0 THEN CASE WHEN demand > 0 THEN 2 * demand / (w0 + sqrt(greatest(0, w0 * w0 + 2 * (w1 - w0) * demand))) ELSE 0::DOUBLE END END AS first_position
FROM due
"""

ORACLES["op13_filter_audit"] = """
WITH word AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), first_of AS (SELECT t, min(doc_id) AS first FROM word GROUP BY t),
doc AS (
    SELECT part, (CASE WHEN len(w) < 50 THEN 'A' ELSE '' END)
        || (CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END)
        || (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 5 * length(t) THEN 'C' ELSE '' END)
        || (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END)
        || (CASE WHEN doc_id > first THEN 'E' ELSE '' END) AS fails,
        doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good, doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS toxic
    FROM word JOIN first_of USING (t)
), class AS (
    SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM doc GROUP BY part, fails
), letter(f) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
    SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letter a, letter b, letter c, letter d, letter e
    WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), step AS (
    SELECT filter_order, s::INTEGER AS step, filter_order[s] AS f, filter_order[:s - 1] AS earlier, replace('ABCDE', filter_order[s], '') AS others
    FROM orders, range(1, 6) AS r(s)
), counted AS (
    SELECT part, filter_order, step, f,
        sum(CASE WHEN length(translate(fails, earlier || f, '')) = length(fails) THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN contains(fails, f) AND length(translate(fails, earlier, '')) = length(fails) THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN contains(fails, f) AND length(translate(fails, earlier, '')) < length(fails) THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN fails = f THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN contains(fails, f) AND length(translate(fails, earlier, '')) = length(fails) THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN contains(fails, f) AND length(translate(fails, earlier, '')) = length(fails) THEN toxic ELSE 0 END) AS toxic_lost
    FROM class, step GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
       good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM counted
"""
