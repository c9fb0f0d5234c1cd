"""DuckDB SQL for the queries that SQL can express; the others are held against brute force in the tests."""

ORACLES = {
    "op2_line_dedup": """
        WITH rows AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
        lines AS (SELECT r, doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM rows),
        keyed AS (
            SELECT *, translate(
                trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM lines
        ),
        shared AS (
            SELECT key, min(doc_id) AS home FROM keyed WHERE length(key) >= 10
            GROUP BY key HAVING count(DISTINCT doc_id) >= 2
        ),
        marked AS (
            SELECT k.*, s.home IS NOT NULL AND k.doc_id <> s.home AS gone FROM keyed k LEFT JOIN shared s ON k.key = s.key
        )
        SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY r
    """,
    "op11_hard_negatives": """
        WITH rows AS (
          SELECT row_number() OVER () AS uid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
          FROM embeddings
          WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        scored AS (
          SELECT a.uid AS auid, a.vec_id AS anchor_id, r.uid AS ruid, r.vec_id AS vec_id, a.label = r.label AS same,
            CAST(list_sum(list_transform(list_zip(a.v, r.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
          FROM rows a JOIN rows r ON a.uid <> r.uid AND len(a.v) = len(r.v) WHERE a.vec_id % 100 = 0
        ),
        positives AS (
          SELECT * FROM scored WHERE same
          QUALIFY row_number() OVER (PARTITION BY auid ORDER BY score DESC, vec_id) <= 5
        )
        SELECT p.anchor_id, p.vec_id AS positive_id,
          CAST(row_number() OVER (PARTITION BY p.auid, p.ruid ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
          n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
        FROM positives p JOIN scored n ON n.auid = p.auid AND NOT n.same
          AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
        QUALIFY row_number() OVER (PARTITION BY p.auid, p.ruid ORDER BY n.score DESC, n.vec_id) <= 5
    """,
}
