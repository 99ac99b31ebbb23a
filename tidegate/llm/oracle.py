"""DuckDB SQL for the queries that SQL expresses, over the same tables."""

from __future__ import annotations

from tidegate.llm import licenses
from tidegate.llm.url_filter import RULES

_RULE_ROWS = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in RULES)
_SENTENCE_ROWS = ", ".join(f"('{name}', '{text}')" for name, text in licenses.SENTENCES)
_LICENCE_ROWS = ", ".join(
    f"('{licence}', '{ids[0]}', {repr(ids[1]) if len(ids) > 1 else 'NULL'})" for licence, ids in licenses.RULES
)

ORACLE = {
    "op1_top_k_search": """
        WITH parts AS (
            SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings
        ), terms AS (
            SELECT vec_id, i, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS q FROM parts
        ), scores AS (
            SELECT a.vec_id AS query_id, b.vec_id, CAST(sum(a.q * b.q) AS BIGINT) AS score
            FROM terms a JOIN terms b ON a.i = b.i AND a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0 GROUP BY 1, 2
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM scores
        )
        SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM ranked WHERE n <= 5
    """,
    # Rules of one or two sentences, none of whose licences depends on a longer rule around it.
    "op10_license_scans": rf"""
        WITH cut AS (
            SELECT doc_id, unnest(parts) AS sentence, generate_subscripts(parts, 1) AS pos FROM (
                SELECT doc_id, string_split(regexp_replace(coalesce(text, ''), '([.!?])\s+', '\1' || chr(10), 'g'), chr(10)) AS parts
                FROM documents) d
        ), spoken AS (
            SELECT doc_id, pos, trim(regexp_replace(lower(sentence), '[^\p{{L}}\p{{N}}]+', ' ', 'g')) AS words FROM cut
        ), known AS (
            SELECT name, trim(regexp_replace(lower(text), '[^\p{{L}}\p{{N}}]+', ' ', 'g')) AS words
            FROM (VALUES {_SENTENCE_ROWS}) k(name, text)
        ), seen AS (
            SELECT doc_id, name, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS n FROM spoken JOIN known USING (words)
        ), held AS (
            SELECT DISTINCT a.doc_id, r.licence FROM seen a JOIN (VALUES {_LICENCE_ROWS}) r(licence, one, two) ON a.name = r.one
            LEFT JOIN seen b ON a.doc_id = b.doc_id AND b.n = a.n + 1 AND b.name = r.two
            WHERE r.two IS NULL OR b.name IS NOT NULL
        ), found AS (
            SELECT doc_id, count(*) AS n_sentences, string_agg(name, ',' ORDER BY n) AS sentence_ids FROM seen GROUP BY doc_id
        ), named AS (
            SELECT doc_id, string_agg(licence, ',' ORDER BY licence) AS licences FROM held GROUP BY doc_id
        )
        SELECT d.doc_id, CAST(coalesce(n_sentences, 0) AS BIGINT) AS n_sentences,
               coalesce(sentence_ids, '') AS sentence_ids, coalesce(licences, '') AS licences
        FROM documents d LEFT JOIN found USING (doc_id) LEFT JOIN named USING (doc_id)
    """,
    "op2_decontamination": r"""
        WITH text_words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
        ), item_words AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
        ), windows AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(list_slice(w, pos, pos + 9), ' ') AS words
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS pos FROM item_words WHERE len(w) > 0) s
        ), places AS (
            SELECT doc_id, pos, size, array_to_string(list_slice(w, pos, pos + size - 1), ' ') AS words
            FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS pos
                  FROM text_words, (SELECT DISTINCT size FROM windows) z WHERE len(w) >= size) s
        ), found AS (
            SELECT p.doc_id, p.pos, p.size, v.item_id FROM places p JOIN windows v ON p.size = v.size AND p.words = v.words
        ), hits AS (
            SELECT doc_id, count(*) AS n_hit FROM (
                SELECT DISTINCT doc_id, unnest(range(pos, pos + size)) AS k FROM (SELECT DISTINCT doc_id, pos, size FROM found) f
            ) h GROUP BY doc_id
        ), items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) f GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM text_words LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
    "op5_url_filters": rf"""
        WITH parts AS (
            SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0
                THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
        ), parsed AS (
            SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts
        ), rules(h, p, v) AS (VALUES {_RULE_ROWS}),
        ranked AS (
            SELECT page_id, host, path, h || p AS rule, v AS verdict, row_number() OVER (
                PARTITION BY page_id ORDER BY length(h || p) DESC, length(h) DESC, v DESC) AS n
            FROM parsed JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
        )
        SELECT q.page_id, q.host, q.path, r.rule, coalesce(r.verdict, 'allow') AS verdict
        FROM parsed q LEFT JOIN ranked r ON q.page_id = r.page_id AND r.n = 1
    """,
    "op11_warc": """
        WITH sized AS (
            SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n FROM pages
        ), hashed AS (
            SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM sized
        ), firsts AS (
            SELECT payload_digest, min(page_id) AS first FROM hashed WHERE payload_bytes >= 100 GROUP BY payload_digest
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN first <> page_id THEN first END AS refers_to
        FROM hashed LEFT JOIN firsts USING (payload_digest)
    """,
    "op12_ranked_search": r"""
        WITH doc_terms AS (
            SELECT nr AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
            FROM (SELECT *, row_number() OVER () AS nr FROM documents) s
        ), item_terms AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark WHERE item_id IS NOT NULL
        ), totals AS (
            SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM doc_terms WHERE len(w) > 0
        ), counts AS (
            SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM doc_terms) s
            WHERE term IN (SELECT term FROM item_terms) GROUP BY ALL
        ), weights AS (
            SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM counts, totals GROUP BY term
        ), measured AS (
            SELECT r, doc_id, 100 - 50 + ((50 * len(w) * n_docs) // n_terms) AS m FROM doc_terms, totals WHERE len(w) > 0
        ), scored AS (
            SELECT i.item_id, d.doc_id, d.r, CAST(sum(v.w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
            FROM counts c JOIN weights v USING (term) JOIN item_terms i USING (term) JOIN measured d USING (r)
            GROUP BY ALL
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS n FROM scored WHERE score > 0
        )
        SELECT item_id, CAST(n AS INTEGER) AS rank, doc_id, score FROM ranked WHERE n <= 50
    """,
}
