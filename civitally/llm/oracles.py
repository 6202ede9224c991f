"""The queries of this package that DuckDB can express, over the same tables."""

TERMS = """
    SELECT {key}, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
    FROM {table} WHERE text IS NOT NULL"""

RANKED = f"""
WITH words AS ({TERMS.format(key="doc_id", table="documents")}),
asked AS (SELECT item_id, term, count(*) AS times FROM ({TERMS.format(key="item_id", table="benchmark")}) GROUP BY ALL),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
total AS (SELECT count(*) AS n, CAST(sum(n) AS BIGINT) AS l FROM lengths),
postings AS (SELECT doc_id, term, count(*) AS tf FROM words SEMI JOIN asked USING (term) GROUP BY ALL),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * total.n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM postings, total GROUP BY term, total.n),
impacts AS (
    SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * lengths.n * total.n) // total.l))) AS worth
    FROM postings JOIN lengths USING (doc_id) JOIN weights USING (term), total),
scored AS (
    SELECT item_id, doc_id, CAST(sum(times * worth) AS BIGINT) AS score
    FROM asked JOIN impacts USING (term) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER best AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0
WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id)
QUALIFY rank <= 20
"""

NEAREST = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score
FROM scored
WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY rank <= 5
"""

ORACLES = {"op11_ranked": RANKED, "op12_nearest": NEAREST}
