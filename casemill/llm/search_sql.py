"""SQL that checks the searches, written from the definitions: every pair is scored."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _terms(table: str, key: str) -> str:
    found = f"regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
    return f"SELECT {key}, unnest({found}) AS term FROM {table}"


LEXICAL = f"""
WITH words AS ({_terms('documents', 'doc_id')}),
counted AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY ALL),
whole AS (SELECT count(*) AS n_documents, sum(n)::BIGINT AS length FROM sizes),
held AS (SELECT term, count(*) AS df FROM counted GROUP BY ALL),
weighted AS (SELECT term, floor(1000 * ln((2 * n_documents + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM held, whole),
norms AS (SELECT doc_id, 100 - 75 + (75 * n * n_documents) // length AS m FROM sizes, whole),
asked AS ({_terms('benchmark', 'item_id')}),
scored AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM asked JOIN weighted USING (term) JOIN counted USING (term) JOIN norms USING (doc_id)
    GROUP BY ALL
),
placed AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM placed WHERE rank <= 10
"""

_WHOLE = "SELECT vec_id, label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings"

NEAREST = f"""
WITH whole AS ({_WHOLE}),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
    FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
),
placed AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM placed WHERE rank <= 5
"""

NEGATIVES = f"""
WITH whole AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, v FROM ({_WHOLE})),
scored AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_dot_product(a.v, c.v)::BIGINT AS score
    FROM whole a JOIN whole c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id
),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
),
placed AS (
    SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
    FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
        AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM placed WHERE rank <= 5
"""
