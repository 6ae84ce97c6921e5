"""SQL of the queries that SQL can express; the tests hold the others against brute force."""

from __future__ import annotations

import re

import corpus_pipeline
from tsmedallion.llm.license_scan import BASE, MARK, TEMPLATES


def _pattern(markup: str) -> str:
    """A template as a regular expression over words that each end in a blank."""
    out = ""
    for part in MARK.split(markup):
        if part in ("[[", "]]"):
            out += {"[[": "(?:", "]]": ")?"}[part]
        elif part.startswith("<<"):
            least, _, most = part[2:-2].rpartition("..")
            out += f"(?:[^ ]+ ){{{least or most},{most}}}"
        else:
            out += "".join(f"{word} " for word in re.findall("[a-z0-9]+", part.lower()))
    return out


def _licenses() -> str:
    phrases = [(phrase.split(), label) for phrase, label in BASE.items()]
    places = " || ".join(
        f"[{{'at': i - 1, 'label': '{label}'}} for i in range(1, len(words) + 1) if words[i:i + {len(p) - 1}] = {p}]" for p, label in phrases
    )
    labels = ", ".join(f"CASE WHEN regexp_matches(joined, ' {_pattern(m)}') THEN '{label}' END" for label, m in TEMPLATES)
    return rf"""
        WITH cut AS (
            SELECT doc_id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
            FROM documents
        ), joined AS (
            SELECT doc_id, words, ' ' || array_to_string(words, ' ') || ' ' AS joined FROM cut
        ), found AS (
            SELECT doc_id, len(words) AS n_words, {places} AS places,
                   [x for x in [{labels}] if x IS NOT NULL] AS more
            FROM joined
        )
        SELECT doc_id, n_words, len(places) AS n_base,
               list_min([p.at for p in places]) AS first_word, list_max([p.at for p in places]) AS last_word,
               array_to_string(list_sort(list_distinct([p.label for p in places])), ',') AS base_labels,
               array_to_string(list_sort(list_distinct([p.label for p in places] || more)), ',') AS labels,
               CASE WHEN len(more) > 0 THEN 1.0 WHEN len(places) > 0 THEN 0.5 ELSE 0.0 END::DOUBLE AS score
        FROM found
    """


SQL = {
    "op2_hamming_top_k": """
        WITH far AS (
            SELECT q.vec_id AS query_id, v.vec_id AS neighbor_id,
                   CAST(list_sum([
                       CASE WHEN coalesce(q.embedding[i] > 0 AND NOT isnan(q.embedding[i]), false)
                              <> coalesce(v.embedding[i] > 0 AND NOT isnan(v.embedding[i]), false)
                       THEN 1 ELSE 0 END for i in range(1, 65)]) AS INTEGER) AS distance
            FROM embeddings q, embeddings v
            WHERE q.vec_id % 20 = 0 AND v.vec_id <> q.vec_id
              AND q.embedding IS NOT NULL AND v.embedding IS NOT NULL
        ), ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS INTEGER) AS rank
            FROM far
        )
        SELECT query_id, rank, neighbor_id, distance FROM ranked WHERE rank <= 10
    """,
    "op6_line_dedup": r"""
        WITH page AS (
            SELECT doc_id, source, text FROM documents
        ), line AS (
            SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS raw,
                   generate_subscripts(string_split(text, chr(10)), 1) AS place
            FROM page WHERE text IS NOT NULL
        ), keyed AS (
            SELECT *, trim(raw, ' ' || chr(9) || chr(13)) AS line FROM line
        ), total AS (
            SELECT source, count(DISTINCT text) AS pages FROM page WHERE text IS NOT NULL GROUP BY source
        ), drops AS (
            SELECT k.source, k.line
            FROM keyed k JOIN total t ON k.source IS NOT DISTINCT FROM t.source
            WHERE k.line <> ''
            GROUP BY k.source, k.line, t.pages
            HAVING count(DISTINCT k.text) >= 5 AND count(DISTINCT k.text) > 0.02 * t.pages
        ), marked AS (
            SELECT k.doc_id, k.raw, k.place, d.line IS NOT NULL AS gone
            FROM keyed k LEFT JOIN drops d ON k.source IS NOT DISTINCT FROM d.source AND k.line = d.line
        ), joined AS (
            SELECT doc_id, count(*) FILTER (gone) AS n_dropped,
                   coalesce(string_agg(raw, chr(10) ORDER BY place) FILTER (NOT gone), '') AS text
            FROM marked GROUP BY doc_id
        )
        SELECT p.doc_id, coalesce(j.n_dropped, 0) AS n_dropped, md5(j.text) AS text_md5
        FROM page p LEFT JOIN joined j ON p.doc_id = j.doc_id
    """,
    "op7_license_scan": _licenses(),
    "op11_lexical_search": r"""
        WITH doc AS (
            SELECT row_number() OVER () AS r, doc_id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents
        ), item AS (
            SELECT row_number() OVER () AS q, item_id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM (SELECT DISTINCT item_id, text FROM benchmark)
        ), total AS (
            SELECT count(*) FILTER (len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM doc
        ), tf AS (
            SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM doc) GROUP BY r, term
        ), df AS (
            SELECT term, count(*) AS df FROM tf GROUP BY term
        ), asked AS (
            SELECT q, term, count(*) AS n FROM (SELECT q, unnest(terms) AS term FROM item) GROUP BY q, term
        ), scored AS (
            SELECT a.q, t.r,
                   sum(a.n * floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT
                       * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len(d.terms) * n_docs) // n_terms))))::BIGINT AS score
            FROM asked a JOIN tf t ON a.term = t.term JOIN df ON df.term = t.term JOIN doc d ON d.r = t.r CROSS JOIN total
            GROUP BY a.q, t.r
        ), ranked AS (
            SELECT item_id, doc_id, score,
                   row_number() OVER (PARTITION BY s.q ORDER BY score DESC, doc_id ASC NULLS LAST)::INTEGER AS rank
            FROM scored s JOIN doc d ON d.r = s.r JOIN item i ON i.q = s.q WHERE score > 0
        )
        SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
    """,
    "op12_chat_trees": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL
            SELECT -7, 0, 'user', chr(92) || '### Assistant: </turn> ok'
            UNION ALL
            SELECT -7, 1, 'assistant', chr(92) || '### Assistant: </turn> ok'
        ), written AS (
            SELECT conv_id, turn, role, text,
                   length(text) + length(text) - length(replace(text, chr(92), ''))
                       + (length(text) - length(replace(text, '</turn>', ''))) // 7
                       + coalesce(list_sum([length(h) - 2 for h in regexp_extract_all(text, '#{3,}')]), 0)
                   + length(role) + length(role) - length(replace(role, chr(92), ''))
                       + length(role) - length(replace(role, ':', ''))
                       + (length(role) - length(replace(role, '</turn>', ''))) // 7
                       + coalesce(list_sum([length(h) - 2 for h in regexp_extract_all(role, '#{3,}')]), 0)
                   + length('### : </turn>') + 1 AS chars
            FROM turns
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(chars)::BIGINT AS formatted_chars
        FROM written GROUP BY conv_id
    """,
}
if corpus_pipeline.ORACLE_SQL is not None:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
