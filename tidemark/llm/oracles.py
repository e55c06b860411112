"""DuckDB SQL for the queries of this folder that SQL can express."""

from __future__ import annotations

from tidemark.llm.quality import STOP_WORDS

_QUALITY = r"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
    FROM documents
), windows AS (
    SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS w
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM texts)
), repeated AS (
    SELECT a.doc_id, a.i FROM windows a
    JOIN (SELECT doc_id, w FROM windows GROUP BY doc_id, w HAVING count(*) > 1) b ON a.doc_id = b.doc_id AND a.w = b.w
), covered AS (
    SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM repeated) GROUP BY doc_id
), counted AS (
    SELECT texts.doc_id, len(ws)::BIGINT AS n_words, list_sum(list_transform(ws, lambda x: length(x)))::BIGINT AS chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
        len(ls)::BIGINT AS n_lines, len(list_filter(ws, lambda x: lower(x) IN ({stop})))::BIGINT AS n_stop_words,
        len(list_filter(ws, lambda x: regexp_matches(x, '\p{L}')))::BIGINT AS n_letter_words,
        len(list_filter(ls, lambda x: regexp_matches(x, '^[\x20\x09]*[-*•‣◦]')))::BIGINT AS n_bullet_lines,
        len(list_filter(ls, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09\x0D]*$')))::BIGINT AS n_ellipsis_lines
    FROM texts LEFT JOIN covered ON texts.doc_id = covered.doc_id
), judged AS (
    SELECT *, coalesce(chars, 0)::BIGINT AS word_chars,
        n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
    FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND coalesce(word_chars BETWEEN 2 * n_words AND 15 * n_words AND 10 * n_symbols <= n_words
        AND n_stop_words >= 2 AND 10 * n_letter_words >= 7 * n_words AND 2 * n_dup_lines <= n_lines
        AND 10 * n_bullet_lines <= 9 * n_lines AND 10 * n_ellipsis_lines <= 3 * n_lines, false) AS kept
FROM judged
""".replace("{stop}", ", ".join(f"'{w}'" for w in STOP_WORDS))

_TOKEN_COUNTS = r"""
WITH counted AS (
    SELECT source, lang, doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS copy,
        len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS words,
        len(regexp_extract_all(coalesce(text, ''), '\p{L}+|\p{N}|[^\x20\x09-\x0D\p{L}\p{N}]'))::BIGINT AS pieces
    FROM documents
)
SELECT source, lang, CASE WHEN words = pieces THEN 'words-1' ELSE 'pieces-1' END AS tokenizer,
    count(*)::BIGINT AS n_docs, sum(pieces)::BIGINT AS n_tokens
FROM counted WHERE NOT copy GROUP BY ALL
"""


_EMBEDDINGS = """
WITH RECURSIVE links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.93
), reached AS (
    SELECT vec_id AS v, vec_id AS c FROM embeddings
    UNION SELECT links.b, reached.c FROM reached JOIN links ON links.a = reached.v
)
SELECT v AS vec_id, (SELECT count(*) FROM links WHERE a = v)::BIGINT AS n_links, min(c) AS component_id, v = min(c) AS kept
FROM reached GROUP BY v
"""

_DIVERGENCE = r"""
WITH d AS (
    SELECT row_number() OVER () AS n, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
), met AS (
    SELECT lang, source, n, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS (
    SELECT lang, term, count(*) AS c FROM met GROUP BY lang, term HAVING count(DISTINCT n) >= 30
), whole AS (
    SELECT *, 1 + 1000000000::HUGEINT * (c + 5) // (sum(c) OVER (PARTITION BY lang) + 5 * count(*) OVER (PARTITION BY lang)) AS q
    FROM kept
), cells AS (
    SELECT g.lang, g.source, whole.term, whole.q, count(met.n) AS c
    FROM (SELECT DISTINCT lang, source FROM d) g JOIN whole ON whole.lang = g.lang
    LEFT JOIN met ON met.lang = g.lang AND met.source = g.source AND met.term = whole.term
    GROUP BY ALL
), shares AS (
    SELECT *, 1 + 1000000000::HUGEINT * (c + 5) // (sum(c) OVER g + 5 * count(*) OVER g) AS p
    FROM cells WINDOW g AS (PARTITION BY lang, source)
), found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
        coalesce((SELECT sum(abs(x.p - y.p)) FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term
                  WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0)::BIGINT AS value
    FROM (SELECT DISTINCT lang, source FROM d) a JOIN (SELECT DISTINCT lang, source FROM d) b
        ON a.lang = b.lang AND a.source <> b.source
    UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares WHERE c > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM found
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_embeddings": _EMBEDDINGS, "op3_quality": _QUALITY, "op4_token_counts": _TOKEN_COUNTS,
            "op12_divergence": _DIVERGENCE}
