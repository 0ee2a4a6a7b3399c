"""The SQL that queries of this package are compared with, where SQL can express them."""



def _clusters(k: int = 16, rounds: int = 3, scale: int = 64, seed: int = 1) -> str:
    """Rounds of assigning and averaging as tables, each worked out once."""
    def placed(r: int) -> str:
        return f"""p{r} AS MATERIALIZED (
            SELECT v.vec_id, v.e, c.k, CAST(list_sum(list_transform(list_zip(v.e, c.e), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS BIGINT) AS d
            FROM v CROSS JOIN c{r} c QUALIFY row_number() OVER (PARTITION BY v.vec_id ORDER BY d, k) = 1)"""

    def moved(r: int) -> str:
        return f"""s{r} AS (SELECT k, j, sum(e[j]) AS s, count(*) AS n FROM p{r - 1} CROSS JOIN range(1, 65) t(j) GROUP BY k, j),
          m{r} AS (SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS e FROM s{r} GROUP BY k),
          c{r} AS MATERIALIZED (SELECT c.k, coalesce(m.e, c.e) AS e FROM c{r - 1} c LEFT JOIN m{r} m ON c.k = m.k)"""

    steps = ", ".join([placed(0), *(f"{moved(r)}, {placed(r)}" for r in range(1, rounds + 1))])
    return f"""
        WITH v AS MATERIALIZED (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * x::DOUBLE) AS BIGINT)) AS e
            FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
        c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY h) - 1 AS k, e
            FROM (SELECT e, sha256('{seed}:' || vec_id) AS h FROM v ORDER BY h LIMIT {k})),
        {steps}
        SELECT vec_id, CAST(p.k AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY p.k) AS BIGINT) AS cluster_inertia,
            CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.e, ',')) AS centroid_sha256
        FROM p{rounds} p JOIN c{rounds} c ON p.k = c.k"""


ORACLE_SQL = {
    "op13_bitplane_clusters": _clusters(),
    "op3_exact_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
        s AS (
            SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0)
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
               vec_id, score
        FROM s QUALIFY rank <= 5""",
}
