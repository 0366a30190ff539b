"""SQL for DuckDB that gives what each registered query has to give, straight from the tables.

The SQL is written on its own: it knows nothing of JSON messages and finds chunk borders by a recursion over sentences.
"""

from __future__ import annotations

from quillstream.operators.search import B, K1, LSH_BITS, LSH_TABLES, PLACES, RRF_RANK
from quillstream.plans.derived import REQUEST_TIME, START, STEP, YEAR
from quillstream.schemas import SYSTEM_TOPICS

from .queries import DIM, K, SMALL, FULL

TOPIC = """CASE lang WHEN 'en' THEN concat('user_', source, '_topic') WHEN 'fr' THEN 'system_topic_1'
  WHEN 'de' THEN 'system_topic_2' ELSE 'systemes_archive' END"""


def with_(*ctes: str, select: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + select


def ts(offset: str, years: int) -> str:
    return f"({START + years * YEAR} + ({offset}) * {STEP})"


def arr(offset: str, years: int, rank: int, partition: int) -> str:
    return f"[{ts(offset, years)}, {rank}, {partition}, {offset}]::BIGINT[]"


# Messages

LABELLED = f"""labelled AS (
  SELECT d.*, l.quality, l.toxic, {TOPIC} AS topic FROM documents d LEFT JOIN labels l USING (doc_id))"""

_DOC = """CAST(doc_id AS VARCHAR) AS doc_id, CASE WHEN lang = 'en' THEN source END AS user_id, topic AS index_name,
  CASE WHEN quality = 0 THEN 'plain_text' WHEN lang = 'fr' THEN 'docx' WHEN lang = 'de' THEN 'pptx' ELSE 'pdf' END AS source_type,
  concat(source, '/', doc_id) AS document_url,
  CASE WHEN quality IS NULL THEN 'unknown' ELSE concat('2025-10-22T', lpad(CAST(n_chars % 24 AS VARCHAR), 2, '0'),
    CASE WHEN lang = 'en' THEN ':30:00Z' ELSE ':30:00+03:00' END) END AS upload_time,
  CASE WHEN quality IS NOT NULL THEN epoch_us(TIMESTAMP '2025-10-22 00:30:00') + (n_chars % 24 - CASE WHEN lang = 'en' THEN 0 ELSE 3 END) * 3600000000 END AS time_us,
  text, CASE WHEN quality = 0 THEN ['source_type:literal'] ELSE []::VARCHAR[] END AS errors"""

MESSAGES = f"""messages AS (
  SELECT 0 AS "partition", doc_id AS "offset", {arr("doc_id", 0, 1, 0)} AS arrival, {_DOC} FROM labelled
  UNION ALL
  SELECT 3, doc_id, {arr("doc_id", 20, 1, 3)}, {_DOC} FROM labelled WHERE toxic = 1 AND quality = 1
  UNION ALL
  SELECT 1, page_id, {arr("page_id", 0, 1, 1)}, concat('page-', page_id), NULL, 'web_pages', 'html', url, NULL, NULL, html,
    ['topic_name:prefix', 'source_type:literal', 'upload_time:missing'] FROM pages
  UNION ALL
  SELECT 2, conv_id * 1000 + turn, {arr("conv_id * 1000 + turn", 0, 1, 2)}, concat('conv-', conv_id), role,
    'user_chat_topic', 'docx', concat('chat/', turn), '{REQUEST_TIME}',
    epoch_us(TIMESTAMP '2025-10-22 12:00:00'), text, [] FROM conversations)"""

DELETIONS = f"""deletions AS (
  SELECT 0 AS "partition", doc_id AS "offset", {arr("doc_id", 10, 2, 0)} AS arrival, CAST(doc_id AS VARCHAR) AS doc_id,
    topic AS index_name, []::VARCHAR[] AS errors FROM labelled WHERE toxic = 1
  UNION ALL
  SELECT 1, item_id, {arr("item_id", 10, 2, 1)}, concat('item-', item_id), 'system_topic_1', [] FROM benchmark
  UNION ALL
  SELECT 2, page_id, {arr("page_id", 10, 2, 2)}, concat('page-', page_id), 'web_pages', [] FROM pages
  UNION ALL
  SELECT 3, conv_id * 1000 + turn, {arr("conv_id * 1000 + turn", 10, 2, 3)}, '', 'user_chat_topic', ['doc_id:blank']
    FROM conversations WHERE role = 'system'
  UNION ALL
  SELECT 4, doc_id, {arr("doc_id", 30, 2, 4)}, CAST(doc_id AS VARCHAR), topic, []
    FROM labelled WHERE toxic = 1 AND quality = 1 AND lang = 'en'
  UNION ALL
  SELECT 5, doc_id, {arr("doc_id", -1, 2, 5)}, CAST(doc_id AS VARCHAR), topic, [] FROM labelled WHERE quality = 1 AND lang = 'fr')"""

CREATIONS = f"""creations AS (
  SELECT 0 AS "partition", doc_id AS "offset", {arr("doc_id", 0, 0, 0)} AS arrival, topic AS index_name,
    []::VARCHAR[] AS errors FROM labelled WHERE quality IS NOT NULL AND lang IN ('en', 'es')
  UNION ALL
  SELECT 1, conv_id * 1000 + turn, {arr("conv_id * 1000 + turn", 0, 0, 1)}, 'user_chat_topic', []
    FROM conversations WHERE role = 'system'
  UNION ALL
  SELECT 2, item_id, {arr("item_id", 0, 0, 2)}, concat('bench_', item_id), [] FROM benchmark
  UNION ALL
  SELECT 3, page_id, {arr("page_id", 0, 0, 3)}, '', ['topic_name:blank'] FROM pages)"""

REGISTRY = f"""seeds AS (SELECT 'system_' || unnest(string_split('{SYSTEM_TOPICS}', ',')) AS index_name),
registry AS (
  SELECT index_name, CASE WHEN starts_with(index_name, 'system_') THEN 'system' ELSE 'user' END AS kind, created FROM (
    SELECT index_name, [0, 0, -1, -1]::BIGINT[] AS created FROM seeds
    UNION ALL
    SELECT index_name, min(arrival) FROM creations
    WHERE len(errors) = 0 AND index_name NOT IN (SELECT index_name FROM seeds) GROUP BY index_name))"""

ROUTED = """valid AS (SELECT * FROM messages WHERE len(errors) = 0),
routed AS (SELECT v.* FROM valid v JOIN registry r ON v.index_name = r.index_name AND r.created < v.arrival),
missing AS (SELECT v.* FROM valid v LEFT JOIN registry r ON v.index_name = r.index_name AND r.created < v.arrival
  WHERE r.index_name IS NULL)"""

STATE = [LABELLED, MESSAGES, DELETIONS, CREATIONS, REGISTRY, ROUTED]


# Chunks


def words_of(text: str) -> str:
    return rf"list_filter(regexp_split_to_array({text}, '\s+'), lambda w: w <> '')"


def chunks(source: str, size: int, overlap: int) -> str:
    """Chunks of `source(key, text)`: every sentence either fits, closes a chunk, or is cut into windows."""
    step = size - overlap
    return f"""worded AS MATERIALIZED (SELECT key, {words_of("text")} AS words FROM {source}),
stops AS (
  SELECT key, pos FROM (SELECT key, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos, len(words) AS total FROM worded)
  WHERE pos = total OR right(word, 1) IN ('.', '!', '?')),
lengths AS MATERIALIZED (
  SELECT key, row_number() OVER w AS i, pos - coalesce(lag(pos) OVER w, 0) AS n FROM stops WINDOW w AS (PARTITION BY key ORDER BY pos)),
fold AS MATERIALIZED (
  SELECT key, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS cs, CAST(0 AS BIGINT) AS ce,
    CAST(0 AS BIGINT) AS es, CAST(0 AS BIGINT) AS ee, false AS long FROM worded
  UNION ALL
  SELECT f.key, l.i,
    CASE WHEN l.n > {size} THEN f.ce + l.n WHEN f.ce - f.cs + l.n > {size} THEN greatest(f.cs, f.ce - {overlap}) ELSE f.cs END,
    f.ce + l.n,
    CASE WHEN f.ce - f.cs + l.n > {size} THEN f.cs ELSE f.ce END, f.ce, l.n > {size}
  FROM fold f JOIN lengths l ON l.key = f.key AND l.i = f.i + 1),
spans AS (
  SELECT key, i, CAST(-1 AS BIGINT) AS part, es AS s, ee AS e FROM fold WHERE ee > es
  UNION ALL
  SELECT key, i, k, ee + k, least(ee + k + {size}, ce) FROM (SELECT *, unnest(range(0, ce - ee, {step})) AS k FROM fold WHERE long)
  UNION ALL
  SELECT key, i + 1, -1, cs, ce FROM fold WHERE ce > cs
    AND (key, i) IN (SELECT (key, max(i)) FROM fold GROUP BY key)),
chunks AS (
  SELECT sp.key, row_number() OVER (PARTITION BY sp.key ORDER BY i, part) - 1 AS chunk_id, e - s AS n_words,
    array_to_string(words[s + 1 : e], ' ') AS text
  FROM spans sp JOIN worded USING (key))"""


DOC_SOURCE = "source_texts AS (SELECT doc_id AS key, text FROM documents)"


def doc_chunks(settings) -> list[str]:
    return [DOC_SOURCE, chunks("source_texts", settings.size, settings.overlap)]


def log(settings) -> list[str]:
    """The change log of the routed messages."""
    return [
        *STATE,
        """keyed AS (SELECT *, "partition" || ':' || "offset" AS key FROM routed)""",
        chunks("keyed", settings.size, settings.overlap),
        """written AS (
  SELECT k.index_name, k.doc_id || '_' || c.chunk_id AS row_id, k.doc_id, c.chunk_id, c.n_words, md5(c.text) AS text_md5,
    k.source_type, k.document_url, k.upload_time, k.time_us, k.arrival, k."partition", k."offset",
    CASE WHEN NOT starts_with(k.index_name, 'system_') THEN k.user_id END AS user_id,
    CASE WHEN starts_with(k.index_name, 'system_') THEN k.time_us END AS upload_time_us,
    CASE WHEN NOT starts_with(k.index_name, 'system_') THEN k.time_us END AS user_upload_time_us
  FROM chunks c JOIN keyed k USING (key))""",
        """latest AS (
  SELECT * FROM written QUALIFY row_number() OVER (PARTITION BY index_name, row_id ORDER BY arrival DESC) = 1),
last_deletes AS (SELECT index_name, doc_id, max(arrival) AS deleted FROM deletions WHERE len(errors) = 0 GROUP BY ALL),
live AS (
  SELECT l.* FROM latest l LEFT JOIN last_deletes d USING (index_name, doc_id) WHERE d.deleted IS NULL OR l.arrival > d.deleted),
last_writes AS (SELECT index_name, doc_id, max(arrival) AS last_written FROM written GROUP BY ALL)""",
    ]


VIEW = """index_name, row_id, doc_id, CAST(chunk_id AS INTEGER) AS chunk_id, CAST(n_words AS INTEGER) AS n_words, text_md5,
  source_type, document_url, user_id, upload_time_us, user_upload_time_us, upload_time AS upload_time_raw,
  0 AS n_metadata, "offset\""""


def view(source: str, settings=SMALL) -> str:
    return with_(*log(settings), select=f"SELECT {VIEW} FROM {source}")


# Outcomes

# each write is seen through to the deletion that ends it, if its index was there when the deletion came
DELETED = """judged AS (SELECT d.*, coalesce(r.created < d.arrival, false) AS known
  FROM deletions d LEFT JOIN registry r ON d.index_name = r.index_name WHERE len(errors) = 0),
ended AS (SELECT w.index_name, w.doc_id, w.row_id, min(d.arrival) AS arrival FROM written w
  JOIN judged d ON d.known AND d.index_name = w.index_name AND d.doc_id = w.doc_id AND d.arrival > w.arrival
  GROUP BY w.index_name, w.doc_id, w.row_id, w.arrival),
taken AS (SELECT index_name, doc_id, arrival, count(DISTINCT row_id) AS n FROM ended GROUP BY ALL)"""

OUTCOMES = DELETED + """,
counts AS (SELECT "partition", "offset", count(*) AS n FROM written GROUP BY ALL),
outcomes AS (
  SELECT 'documents' AS topic, "partition", "offset", doc_id, index_name, 'rejected' AS status, errors AS reason, 0 AS n_chunks
    FROM messages WHERE len(errors) > 0
  UNION ALL
  SELECT 'documents', "partition", "offset", doc_id, index_name, 'missing_index', [], 0 FROM missing
  UNION ALL
  SELECT 'documents', r."partition", r."offset", doc_id, index_name, CASE WHEN n IS NULL THEN 'no_chunks' ELSE 'indexed' END,
    CASE WHEN n IS NULL THEN ['no_chunks'] ELSE [] END, coalesce(n, 0)
    FROM routed r LEFT JOIN counts c ON r."partition" = c."partition" AND r."offset" = c."offset"
  UNION ALL
  SELECT 'document_deletions', "partition", "offset", doc_id, index_name, 'rejected', errors, 0 FROM deletions WHERE len(errors) > 0
  UNION ALL
  SELECT 'document_deletions', "partition", "offset", doc_id, index_name,
    CASE WHEN NOT known THEN 'missing_index' WHEN n > 0 THEN 'deleted' ELSE 'nothing_found' END, [], coalesce(n, 0)
    FROM judged LEFT JOIN taken USING (index_name, doc_id, arrival)
  UNION ALL
  SELECT 'index_creations', "partition", "offset", NULL, c.index_name,
    CASE WHEN len(errors) > 0 THEN 'rejected' WHEN c.arrival = r.created THEN 'created' ELSE 'exists' END, errors, 0
    FROM creations c LEFT JOIN registry r ON c.index_name = r.index_name)"""

SUMMARY = """SELECT topic, status, reason, count(*) AS n_messages, CAST(sum(n_chunks) AS BIGINT) AS n_chunks
FROM (SELECT topic, status, unnest(CASE WHEN len(reason) = 0 THEN [NULL] ELSE reason END) AS reason, n_chunks FROM outcomes)
GROUP BY ALL"""


# Vectors and search


def tokens_of(text: str) -> str:
    return rf"regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}]+')"


def cells(name: str, source: str, keys: str) -> str:
    """Cells of hash vectors of `source(keys, text)` that are not 0, as 4-byte floats."""
    return f"""{name}_sums AS (
  SELECT {keys}, CAST(concat('0x', left(h, 8)) AS BIGINT) % {DIM} AS place,
    sum(CASE WHEN h[9] IN ('0', '1', '2', '3', '4', '5', '6', '7') THEN 1 ELSE -1 END) AS c
  FROM (SELECT {keys}, md5(unnest({tokens_of("text")})) AS h FROM {source}) GROUP BY ALL),
{name} AS (
  SELECT {keys}, place, CAST(c / sqrt(sum(c * c) OVER (PARTITION BY {keys})) AS FLOAT) AS x FROM {name}_sums WHERE c <> 0)"""


BENCH = "queries AS (SELECT item_id AS query_id, text FROM benchmark)"

INDEX = [
    *doc_chunks(FULL),
    f"""idx AS (SELECT {TOPIC} AS index_name, concat(c.key, '_', c.chunk_id) AS row_id, c.text, c.chunk_id, d.lang
  FROM chunks c JOIN documents d ON d.doc_id = c.key)""",
]


def ranked(source: str, k: int) -> str:
    return f"""SELECT query_id, index_name, row_id, score,
  CAST(row_number() OVER (PARTITION BY query_id, index_name ORDER BY score DESC, row_id) AS INTEGER) AS rank
  FROM {source} QUALIFY rank <= {k}"""


def bm25(source: str, k: int) -> list[str]:
    return [
        f"""analyzed AS (SELECT index_name, row_id, {tokens_of("text")} AS tokens FROM {source}),
terms AS (SELECT index_name, row_id, len(tokens) AS n_terms, unnest(tokens) AS term FROM analyzed),
posting AS (SELECT index_name, row_id, n_terms, term, count(*) AS tf FROM terms GROUP BY ALL),
stats AS (SELECT index_name, count(*) AS n_rows, avg(len(tokens)) AS mean_terms FROM analyzed WHERE len(tokens) > 0 GROUP BY ALL),
dfs AS (SELECT index_name, term, count(*) AS df FROM posting GROUP BY ALL),
query_terms AS (SELECT query_id, term, count(*) AS qtf FROM (SELECT query_id, unnest({tokens_of("text")}) AS term FROM queries) GROUP BY ALL),
text_scores AS (
  SELECT query_id, p.index_name, row_id, round(sum(qtf * ln(1 + (n_rows - df + 0.5) / (df + 0.5)) * tf * {K1 + 1}
    / (tf + {K1} * (1 - {B} + {B} * n_terms / mean_terms))), {PLACES}) AS score
  FROM posting p JOIN query_terms q USING (term) JOIN dfs f ON f.index_name = p.index_name AND f.term = p.term
    JOIN stats s ON s.index_name = p.index_name
  GROUP BY ALL),
text_hits AS ({ranked("text_scores", k)})"""
    ]


def hash_knn(k: int) -> list[str]:
    """Nearest chunks by the cosine of sparse hash vectors; a pair that shares no place scores 0."""
    return [
        cells("row_cells", "idx", "index_name, row_id"),
        cells("query_cells", "queries", "query_id"),
        f"""row_norms AS (SELECT index_name, row_id, sqrt(sum(x::DOUBLE * x)) AS norm FROM row_cells GROUP BY ALL),
query_norms AS (SELECT query_id, sqrt(sum(x::DOUBLE * x)) AS norm FROM query_cells GROUP BY ALL),
dots AS (
  SELECT query_id, index_name, row_id, sum(q.x::DOUBLE * r.x) AS dot FROM row_cells r JOIN query_cells q USING (place) GROUP BY ALL),
vector_scores AS (
  SELECT q.query_id, r.index_name, r.row_id, round(coalesce(dot, 0) / (q.norm * r.norm), {PLACES}) + 0.0 AS score
  FROM row_norms r CROSS JOIN query_norms q LEFT JOIN dots d
    ON d.query_id = q.query_id AND d.index_name = r.index_name AND d.row_id = r.row_id),
vector_hits AS ({ranked("vector_scores", k)})""",
    ]


def fused(score: str, k: int) -> str:
    return f"""fused AS (
  SELECT coalesce(t.query_id, v.query_id) AS query_id, coalesce(t.index_name, v.index_name) AS index_name,
    coalesce(t.row_id, v.row_id) AS row_id, round({score}, {PLACES}) AS score
  FROM text_part t FULL JOIN vector_part v ON t.query_id = v.query_id AND t.index_name = v.index_name AND t.row_id = v.row_id)
{ranked("fused", k)}"""


def min_max(name: str, hits: str) -> str:
    w = "OVER (PARTITION BY query_id, index_name)"
    return f"""{name} AS (SELECT query_id, index_name, row_id, CASE WHEN max(score) {w} = min(score) {w} THEN 1.0
  ELSE (score - min(score) {w}) / (max(score) {w} - min(score) {w}) END AS s FROM {hits})"""


ROW_QUERIES = """vec AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
centroid AS (SELECT vec_id AS query_id, v AS q FROM vec WHERE vec_id % 20 = 0)"""

EXACT = f"""pairs AS (SELECT query_id, 'vectors' AS index_name, vec_id AS row_id, q, v,
  round(list_cosine_similarity(q, v), {PLACES}) AS score FROM centroid CROSS JOIN vec),
exact AS ({ranked("pairs", K)})"""

LSH = f"""planes AS (
  SELECT t, b, list(CASE WHEN md5(concat(t, ':', b, ':', p))[1] IN ('0', '1', '2', '3', '4', '5', '6', '7') THEN 1.0::DOUBLE ELSE -1.0 END ORDER BY p) AS plane
  FROM range(0, {LSH_TABLES}) a(t), range(0, {LSH_BITS}) c(b), range(0, {DIM}) d(p) GROUP BY ALL),
row_buckets AS (
  SELECT vec_id, t, sum(CASE WHEN list_inner_product(v, plane) >= 0 THEN 1 << b ELSE 0 END) AS bucket FROM vec, planes GROUP BY ALL),
query_buckets AS (
  SELECT query_id, t, sum(CASE WHEN list_inner_product(q, plane) >= 0 THEN 1 << b ELSE 0 END) AS bucket FROM centroid, planes GROUP BY ALL),
candidates AS (SELECT DISTINCT query_id, vec_id FROM row_buckets JOIN query_buckets USING (t, bucket)),
near AS (SELECT p.* FROM pairs p JOIN candidates c ON p.query_id = c.query_id AND p.row_id = c.vec_id),
approximate AS ({ranked("near", K)})"""

HITS = "SELECT query_id, index_name, row_id, score, rank FROM "


def src(source: str, field: str, value: str, topic: str) -> str:
    return with_(
        *STATE,
        select=f"""SELECT '{topic}' AS topic, "partition", "offset", arrival[1] AS timestamp_us, {value} AS {field} FROM {source}""",
    )


SQL = {
    "src_documents": src("messages", "doc_id", "doc_id", "documents"),
    "src_deletions": src(
        "deletions",
        "doc_id",
        r"""CASE "partition" WHEN 0 THEN concat(' ', doc_id, chr(10)) WHEN 3 THEN concat(' ', chr(9), ' ') ELSE doc_id END""",
        "document_deletions",
    ),
    "src_index_creations": src(
        "creations",
        "topic_name",
        """CASE "partition" WHEN 1 THEN index_name || ' ' WHEN 3 THEN ' ' ELSE index_name END""",
        "index_creations",
    ),
    "decode_messages": with_(
        LABELLED,
        MESSAGES,
        select="""SELECT "partition", "offset",
  CASE "partition" WHEN 2 THEN 'bad_json' WHEN 1 THEN 'not_object' ELSE 'ok' END AS json_status,
  CASE WHEN "partition" IN (0, 3) THEN doc_id END AS doc_id,
  CASE WHEN "partition" IN (1, 2) OR user_id IS NULL THEN 'missing' ELSE 'string' END AS user_id_kind,
  CASE WHEN "partition" IN (0, 3) THEN CASE WHEN index_name = 'system_topic_2' THEN concat('  ', index_name, chr(9)) ELSE index_name END END AS topic_name,
  CASE WHEN "partition" IN (0, 3) THEN md5(text) END AS text_md5 FROM messages""",
    ),
    "validate_documents": with_(
        LABELLED,
        MESSAGES,
        select="""SELECT "partition", "offset", doc_id, user_id, index_name, source_type, upload_time, length(text) AS n_chars,
  array_to_string(errors, '|') AS errors FROM messages""",
    ),
    "validate_user_scope": with_(
        LABELLED,
        select="""SELECT 0 AS "partition", doc_id AS "offset", CAST(doc_id AS VARCHAR) AS doc_id,
  CASE WHEN coalesce(toxic, 0) = 0 THEN source END AS user_id, topic AS index_name,
  array_to_string(list_filter([
    CASE WHEN lang = 'en' AND toxic = 1 THEN 'user_id:required' WHEN lang <> 'en' AND coalesce(toxic, 0) = 0 THEN 'user_id:forbidden' END,
    CASE WHEN quality = 0 THEN 'source_type:literal' END], lambda e: e IS NOT NULL), '|') AS errors
  FROM labelled""",
    ),
    "validate_deletions": with_(
        LABELLED,
        DELETIONS,
        select=f"""SELECT "partition", "offset", doc_id, index_name, '{REQUEST_TIME}' AS request_time,
  array_to_string(errors, '|') AS errors FROM deletions""",
    ),
    "validate_index_creations": with_(
        LABELLED,
        CREATIONS,
        select=f"""SELECT "partition", "offset", index_name, '{REQUEST_TIME}' AS request_time,
  array_to_string(errors, '|') AS errors FROM creations""",
    ),
    "topic_type": with_(
        LABELLED,
        select="""SELECT doc_id, topic AS topic_name, CASE WHEN lang = 'en' THEN 'user' ELSE 'system' END AS topic_type,
  CASE WHEN lang IN ('fr', 'de') THEN 'system' ELSE 'user' END AS index_kind FROM labelled""",
    ),
    "parse_upload_time": """SELECT event_id, CASE event_type WHEN 'error' THEN epoch_us(ts)
  WHEN 'click' THEN epoch_us(date_trunc('second', ts)) - 10800000000
  WHEN 'view' THEN epoch_us(date_trunc('second', ts)) WHEN 'purchase' THEN epoch_us(date_trunc('day', ts)::TIMESTAMP) END AS time_us
  FROM events""",
    "create_indices": with_(
        LABELLED,
        CREATIONS,
        REGISTRY,
        select=f"SELECT index_name, kind, {DIM} AS dim, created[1] AS created_us FROM registry",
    ),
    "system_indices": with_(
        LABELLED,
        MESSAGES,
        CREATIONS,
        REGISTRY,
        select=f"""SELECT s.index_name, 'system' AS kind, {DIM} AS dim, count(m.doc_id) AS n_messages
  FROM seeds s LEFT JOIN (SELECT * FROM messages WHERE len(errors) = 0) m USING (index_name) GROUP BY s.index_name""",
    ),
    "system_indices_ready": with_(
        *STATE,
        select="""SELECT bool_and(u.index_name IS NOT NULL) AS all_ready, count(u.index_name) AS n_ready, count(*) AS n_wanted
  FROM seeds s LEFT JOIN (SELECT DISTINCT index_name FROM routed) u ON s.index_name = u.index_name""",
    ),
    "route_existing": with_(*STATE, select='SELECT "partition", "offset", doc_id, index_name FROM routed'),
    "route_missing": with_(*STATE, select='SELECT "partition", "offset", doc_id, index_name FROM missing'),
    **{
        name: with_(
            *doc_chunks(settings),
            select="""SELECT key AS doc_id, CAST(chunk_id AS INTEGER) AS chunk_id, CAST(n_words AS INTEGER) AS n_words,
  md5(text) AS text_md5 FROM chunks""",
        )
        for name, settings in (("chunk_documents", FULL), ("chunk_documents_small", SMALL))
    },
    "split_sentences": rf"""SELECT doc_id, CAST(i - 1 AS INTEGER) AS sentence_no, sentence, CAST(len({words_of("sentence")}) AS INTEGER) AS n_words
FROM (SELECT doc_id, unnest(s) AS sentence, unnest(range(1, len(s) + 1)) AS i FROM (
  SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)),
    lambda p: regexp_replace(p, '^\s+|\s+$', '', 'g')), lambda p: p <> '') AS s FROM documents))""",
    "word_counts": with_(
        *doc_chunks(FULL)[:1],
        chunks("source_texts", FULL.size, FULL.overlap).split("fold AS MATERIALIZED")[0].rstrip().rstrip(","),
        select="""SELECT key AS doc_id, CAST(sum(n) AS INTEGER) AS n_words, CAST(count(*) AS INTEGER) AS n_sentences,
  CAST(max(n) AS INTEGER) AS longest_sentence FROM lengths GROUP BY key""",
    ),
    "long_sentence_windows": with_(
        *doc_chunks(FULL)[:1],
        chunks("source_texts", FULL.size, FULL.overlap).split("fold AS MATERIALIZED")[0].rstrip().rstrip(","),
        select=f"""SELECT key AS doc_id, CAST(i - 1 AS INTEGER) AS sentence_no, CAST(n AS INTEGER) AS n_words,
  CAST(start // {SMALL.size - SMALL.overlap} AS INTEGER) AS window_no, CAST(start AS INTEGER) AS start,
  CAST(least({SMALL.size}, n - start) AS INTEGER) AS length
  FROM (SELECT *, unnest(range(0, n, {SMALL.size - SMALL.overlap})) AS start FROM lengths WHERE n > {SMALL.size})""",
    ),
    "chunk_overlap_check": with_(
        *doc_chunks(SMALL),
        select=f"""SELECT c.key AS doc_id, CAST(sum(n_words) - any_value(len(words)) AS BIGINT) AS repeated_words,
  CAST(max(n_words) AS INTEGER) AS longest_chunk, max(n_words) <= {SMALL.size + SMALL.overlap} AS within_bound
  FROM chunks c JOIN worded w ON w.key = c.key GROUP BY c.key""",
    ),
    "chunks_per_document": with_(
        *doc_chunks(FULL), select="SELECT key AS doc_id, count(*) AS n_chunks FROM chunks GROUP BY key"
    ),
    "empty_documents": "SELECT doc_id, 'no_chunks' AS error FROM documents JOIN labels USING (doc_id) WHERE quality = 0",
    "chunk_embeddings": with_(
        *doc_chunks(FULL),
        cells("cell", "chunks", "key, chunk_id"),
        select="""SELECT key AS doc_id, CAST(chunk_id AS INTEGER) AS chunk_id, CAST(count(place) AS INTEGER) AS n_places,
  round(coalesce(sum(x::DOUBLE * (place + 1)), 0), 4) AS weighed FROM chunks LEFT JOIN cell USING (key, chunk_id) GROUP BY ALL""",
    ),
    "hash_embed": with_(
        cells("cell", "documents", "doc_id"),
        select="SELECT doc_id, CAST(place AS INTEGER) AS place, round(x::DOUBLE, 5) AS x FROM cell",
    ),
    "embedding_batches": with_(
        *doc_chunks(SMALL),
        select="""SELECT key AS doc_id, CAST(chunk_id // 10 AS INTEGER) AS batch_no, count(*) AS n_texts,
  CAST(min(chunk_id) AS INTEGER) AS first_chunk, CAST(max(chunk_id) AS INTEGER) AS last_chunk FROM chunks
  GROUP BY key, chunk_id // 10""",
    ),
    "order_by_index": """SELECT vec_id // 10 AS call,
  CAST(row_number() OVER (PARTITION BY vec_id // 10 ORDER BY vec_id) - 1 AS INTEGER) AS position,
  round(embedding[1]::DOUBLE, 5) AS first_value FROM embeddings""",
    "embedding_dim_check": with_(
        *doc_chunks(SMALL),
        select=f"""SELECT key AS doc_id, CAST(chunk_id AS INTEGER) AS chunk_id, 'dimension:{DIM // 2}' AS error FROM chunks
  WHERE n_words > {SMALL.size}""",
    ),
    "index_outcomes": with_(
        *doc_chunks(SMALL),
        select=f"""SELECT key AS doc_id, count(*) FILTER (n_words <= {SMALL.size}) AS n_ok,
  count(*) FILTER (n_words > {SMALL.size}) AS n_failed, bool_or(n_words <= {SMALL.size}) AS success FROM chunks GROUP BY key""",
    ),
    "dim_report": with_(
        *log(FULL),
        select=f"""SELECT index_name, {DIM} AS dim, count(*) AS n_rows,
  CASE WHEN starts_with(index_name, 'system_') THEN {DIM // 2} ELSE {DIM} END AS index_dim,
  NOT starts_with(index_name, 'system_') AS matches FROM written GROUP BY index_name""",
    ),
    "index_rows": view("written", FULL),
    "upsert_latest": view("latest"),
    "delete_by_doc_id": view("live"),
    "replace_document": view("live JOIN last_writes USING (index_name, doc_id) WHERE arrival = last_written"),
    "stale_chunks": view("live JOIN last_writes USING (index_name, doc_id) WHERE arrival < last_written"),
    "deletion_outcomes": with_(
        *log(SMALL),
        DELETED,
        select="""SELECT "partition", "offset", doc_id, index_name,
  CASE WHEN NOT known THEN 'missing_index' WHEN n > 0 THEN 'deleted' ELSE 'nothing_found' END AS status,
  coalesce(n, 0) AS n_deleted, known AS success
  FROM judged LEFT JOIN taken USING (index_name, doc_id, arrival)""",
    ),
    "message_outcomes": with_(
        *log(SMALL),
        OUTCOMES,
        select="""SELECT topic, "partition", "offset", doc_id, index_name, status, array_to_string(reason, '|') AS reason,
  CAST(n_chunks AS BIGINT) AS n_chunks FROM outcomes""",
    ),
    "outcome_summary": with_(*log(SMALL), OUTCOMES, select=SUMMARY),
    "index_stats": with_(
        *log(SMALL),
        select="""SELECT r.index_name, kind, count(row_id) AS n_rows, count(DISTINCT doc_id) AS n_docs
  FROM registry r LEFT JOIN live l USING (index_name) GROUP BY ALL""",
    ),
    "stream_backfill": view("live"),
    "redelivered_index": view("live"),
    "stream_outcomes": with_(*log(SMALL), OUTCOMES, select=SUMMARY),
    "compacted_index": view("live"),
    "analyze_tokens": f"""SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens, CAST(len(list_distinct(t)) AS INTEGER) AS n_terms,
  md5(array_to_string(t, ' ')) AS tokens_md5 FROM (SELECT doc_id, {tokens_of("text")} AS t FROM documents)""",
    "bm25_search": with_(*INDEX, BENCH, *bm25("idx", K), select=HITS + "text_hits"),
    "knn_search_rows": with_(ROW_QUERIES, EXACT, select=HITS + "exact"),
    "knn_lsh_rows": with_(ROW_QUERIES, EXACT, LSH, select=HITS + "approximate"),
    "knn_lsh_rows_recall": with_(
        ROW_QUERIES,
        EXACT,
        LSH,
        select="""SELECT e.query_id, count(*) AS n_exact, count(a.row_id) AS n_found, round(count(a.row_id) / count(*), 6) AS recall
  FROM exact e LEFT JOIN approximate a ON a.query_id = e.query_id AND a.row_id = e.row_id GROUP BY e.query_id""",
    ),
    "hybrid_search": with_(
        *INDEX,
        BENCH,
        *bm25("idx", K),
        *hash_knn(K),
        min_max("text_part", "text_hits"),
        min_max("vector_part", "vector_hits"),
        select="",
    ).rstrip()
    + ",\n"
    + fused("0.5 * coalesce(t.s, 0) + 0.5 * coalesce(v.s, 0)", K),
    "hybrid_search_rrf": with_(
        *INDEX,
        BENCH,
        *bm25("idx", 2 * K),
        *hash_knn(2 * K),
        f"text_part AS (SELECT query_id, index_name, row_id, 1 / ({RRF_RANK} + rank) AS s FROM text_hits)",
        f"vector_part AS (SELECT query_id, index_name, row_id, 1 / ({RRF_RANK} + rank) AS s FROM vector_hits)",
        select="",
    ).rstrip()
    + ",\n"
    + fused("coalesce(t.s, 0) + coalesce(v.s, 0)", K),
    "filtered_search": with_(
        *INDEX,
        "chosen AS (SELECT * FROM idx WHERE lang IN ('fr', 'de', 'es') AND chunk_id <= 0)",
        BENCH,
        *bm25("chosen", K),
        select=HITS + "text_hits",
    ),
    "lookup_doc": with_(
        *log(SMALL),
        select="""SELECT index_name, row_id, CAST(n_words AS INTEGER) AS n_words, text_md5 FROM latest
  WHERE (index_name, doc_id) IN (SELECT (index_name, doc_id) FROM deletions WHERE len(errors) = 0)""",
    ),
    "lookup_one_doc": with_(
        *log(SMALL),
        select="""SELECT index_name, row_id, CAST(n_words AS INTEGER) AS n_words, text_md5 FROM latest
  WHERE index_name = 'user_chat_topic' AND doc_id = concat('conv-', (SELECT max(conv_id) FROM conversations))""",
    ),
    "point_read": with_(
        *log(SMALL),
        select="""SELECT index_name, row_id, CAST(n_words AS INTEGER) AS n_words, text_md5 FROM live
  WHERE index_name = 'user_chat_topic' AND doc_id = concat('conv-', (SELECT max(conv_id) FROM conversations))""",
    ),
    "index_head_of_one": with_(
        *INDEX,
        select=f"""SELECT index_name, row_id, md5(text) AS text_md5 FROM idx
  WHERE index_name = (SELECT min(index_name) FROM idx) ORDER BY row_id LIMIT {K}""",
    ),
    "index_head": with_(
        *INDEX,
        select=f"""SELECT index_name, row_id, md5(text) AS text_md5,
  CAST(row_number() OVER (PARTITION BY index_name ORDER BY row_id) AS INTEGER) AS position FROM idx QUALIFY position <= {K}""",
    ),
}
SQL["bm25_inverted"] = SQL["bm25_search"]
# the same searches by their earlier names
SQL |= {name: SQL[f"{name.removesuffix('_recall')}_rows{'_recall' if name.endswith('_recall') else ''}"] for name in ("knn_search", "knn_lsh", "knn_lsh_recall")}
# Trained centres are beyond SQL; tests/test_cells.py holds these searches against brute force.
WITHOUT_SQL = {"knn_cells", "knn_cells_recall"}
