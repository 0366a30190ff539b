"""DuckDB SQL for the queries that SQL can express."""

from itertools import permutations

from .licenses import LEAST_SCORE, TEMPLATES

# Lower-cases A-Z only: ASCII runs are lowered, the rest is left.
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

WORDS = f"regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

NOTICES = ", ".join(
    f"({i}, '{t.label}', {len(t.words)}, {t.phrase[0]}, {t.phrase[1]}, {t.base}, {at}, '{word}')"
    for i, t in enumerate(TEMPLATES)
    for at, word in enumerate(t.words)
)

COUNTERS = {
    "space-1": r"[^\x20\x09-\x0D]+",
    "alnum-1": r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+",
    "alnum-2": r"[0-9]|[^\x00-\x40\x5B-\x60\x7B-\x7F]+",
}


def _tokens(text: str, tokenizer: str) -> str:
    return f"len(regexp_extract_all(coalesce({text}, ''), '{COUNTERS[tokenizer]}'))"


CLEANED = "regexp_replace(text, '[0-9]+', '', 'g')"

FILTER_ORDERS = ", ".join(
    f"('{''.join(order)}', {step + 1}, {'ABCDE'.index(name)}, {sum(1 << 'ABCDE'.index(earlier) for earlier in order[:step])})"
    for order in permutations("ABCDE")
    for step, name in enumerate(order)
)

SQL = {
    "op1_token_counts": f"""
        WITH mark AS (SELECT doc_id, max(toxic) AS toxic, min(quality) AS quality FROM labels GROUP BY doc_id),
        doc AS (SELECT documents.*, coalesce(quality = 0, false) AS poor FROM documents LEFT JOIN mark USING (doc_id)
                WHERE coalesce(toxic, 0) <> 1),
        counted AS (
            SELECT source, lang, 'space-1' AS tokenizer,
                   if(poor, {_tokens(CLEANED, "space-1")}, {_tokens("text", "space-1")}) AS n FROM doc
            UNION ALL SELECT source, lang, 'alnum-1', {_tokens("text", "alnum-1")} FROM doc WHERE NOT poor
            UNION ALL SELECT source, lang, 'alnum-2', {_tokens(CLEANED, "alnum-2")} FROM doc WHERE poor)
        SELECT source, lang, tokenizer, count(*) AS n_docs, sum(n)::BIGINT AS n_tokens
        FROM counted GROUP BY source, lang, tokenizer
    """,
    "op3_exact_dedup": f"""
        WITH named AS (SELECT doc_id, {LOWER} AS body FROM documents)
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(body) AS text_sha256
        FROM named WINDOW same AS (PARTITION BY body)
    """,
    "op8_decontaminate": f"""
        WITH item AS (SELECT item_id, {WORDS} AS words FROM benchmark),
        size AS (SELECT item_id, words, least(13, len(words)) AS n FROM item WHERE len(words) > 0),
        gram AS (SELECT DISTINCT item_id, n, array_to_string(words[i : i + n - 1], ' ') AS gram
                 FROM (SELECT *, unnest(range(1, len(words) - n + 2)) AS i FROM size)),
        doc AS (SELECT doc_id, {WORDS} AS words FROM documents),
        spot AS (SELECT doc_id, n, i, array_to_string(words[i : i + n - 1], ' ') AS gram
                 FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i
                       FROM doc, (SELECT DISTINCT n FROM gram) WHERE len(words) >= n)),
        found AS (SELECT doc_id, item_id, spot.n, i FROM spot JOIN gram USING (gram) WHERE spot.n = gram.n),
        hit AS (SELECT doc_id, count(DISTINCT place) AS n_hit
                FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM found) GROUP BY doc_id),
        item_list AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS listed
                      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM found) GROUP BY doc_id)
        SELECT doc.doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(listed, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
        FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN item_list USING (doc_id)
    """,
    "op9_chat_format": r"""
        WITH talk AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, t, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(t, r)),
        counted AS (SELECT *, length(role) + length(text) + 20
                    + length(regexp_replace(role || text, '[^\\<]', '', 'g')) AS marked FROM talk)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(marked)::BIGINT AS formatted_chars
        FROM counted GROUP BY conv_id
    """,
    "op4_licenses": f"""
        WITH template(t, label, size, phrase_at, phrase_size, base, nr, word) AS (VALUES {NOTICES}),
        file AS (SELECT row_number() OVER () AS doc, doc_id, {WORDS} AS words FROM documents),
        spot AS (SELECT doc, unnest(words) AS word, unnest(range(len(words))) AS pos FROM file),
        known AS (SELECT spot.* FROM spot SEMI JOIN template USING (word)),
        aligned AS (SELECT doc, t, pos - nr AS place FROM known JOIN template USING (word) WHERE nr = phrase_at),
        checked AS (SELECT aligned.doc, t, label, base, aligned.place + phrase_at AS place, count(known.word) / size AS share,
                           count(known.word) FILTER (nr BETWEEN phrase_at AND phrase_at + phrase_size - 1) AS phrase_words, phrase_size
                    FROM aligned JOIN template USING (t)
                    LEFT JOIN known ON known.doc = aligned.doc AND known.pos = place + nr AND known.word = template.word
                    GROUP BY aligned.doc, t, label, base, place, phrase_at, phrase_size, size),
        find AS (SELECT * FROM checked WHERE phrase_words = phrase_size AND share >= {LEAST_SCORE})
        SELECT doc_id, len(words) AS n_words, count(*) FILTER (base) AS n_base, min(place) FILTER (base) AS first_word,
               max(place) FILTER (base) AS last_word,
               coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels,
               coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, coalesce(max(share), 0.0) AS score
        FROM file LEFT JOIN find USING (doc) GROUP BY doc, doc_id, words
    """,
    "op13_filter_audit": f"""
        WITH item AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
                             regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
        mark AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
                 FROM labels GROUP BY doc_id),
        judged AS (
            SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                   (len(words) < 50)::INT + 2 * (100 * len(list_distinct(words)) < 65 * len(words))::INT
                   + 4 * (100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text))::INT
                   + 8 * regexp_matches(text, '[#$%&*|]')::INT
                   + 16 * coalesce(item.doc_id > min(item.doc_id) OVER (PARTITION BY text), false)::INT AS failed
            FROM item LEFT JOIN mark ON mark.doc_id = item.doc_id),
        counted AS (SELECT part, failed, good, toxic, count(*) AS n FROM judged GROUP BY ALL),
        orders(filter_order, step, bit, before) AS (VALUES {FILTER_ORDERS}),
        summed AS (
            SELECT part, filter_order, step, bit,
                   coalesce(sum(n) FILTER (failed & (before | (1 << bit)) = 0), 0)::BIGINT AS kept,
                   coalesce(sum(n) FILTER (failed >> bit & 1 = 1 AND failed & before = 0), 0)::BIGINT AS removed,
                   coalesce(sum(n) FILTER (failed >> bit & 1 = 1 AND failed & before <> 0), 0)::BIGINT AS redundant,
                   coalesce(sum(n) FILTER (failed = 1 << bit), 0)::BIGINT AS unique_fails,
                   coalesce(sum(n) FILTER (failed >> bit & 1 = 1 AND failed & before = 0 AND good), 0)::BIGINT AS good_lost,
                   coalesce(sum(n) FILTER (failed >> bit & 1 = 1 AND failed & before = 0 AND toxic), 0)::BIGINT AS toxic_lost
            FROM counted CROSS JOIN orders GROUP BY part, filter_order, step, bit)
        SELECT * EXCLUDE (bit), sum(removed) OVER (PARTITION BY part, bit)::BIGINT AS shapley FROM summed
    """,
}
