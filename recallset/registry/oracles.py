"""The same results as plain SQL over the given tables."""

from __future__ import annotations

from . import fixtures as fx

KEY = fx.SPEC.key_prefix
TYPE = fx.SPEC.document_type

STORE = f"""
store AS (
  SELECT '{KEY}' || vec_id AS doc_key, '{TYPE}' AS document_type, 1 AS schema_version,
         CAST(vec_id AS VARCHAR) AS id, CAST(embedding AS DOUBLE[]) AS vector,
         d.source AS user_id, d.lang AS conversation_id, CAST(e.label AS DOUBLE) AS label,
         'Doc ' || d.doc_id AS title,
         CASE WHEN d.lang <> 'de' THEN d.text END AS meta_content,
         CASE WHEN d.lang = 'en' THEN d.text END AS content,
         '2026-01-01 00:00:00' AS created_at, '2026-01-01 00:00:00' AS updated_at
  FROM embeddings e LEFT JOIN documents d ON e.vec_id = d.doc_id
)"""

SHARED = f"""{STORE},
shared AS (
  SELECT * FROM store
  UNION ALL BY NAME
  SELECT '{KEY}s-' || s_suppkey AS doc_key, 'invoice' AS document_type, 1 AS schema_version,
         's-' || s_suppkey AS id FROM supplier
  UNION ALL BY NAME
  SELECT 'orders::r-' || r_regionkey AS doc_key, 'invoice' AS document_type, 1 AS schema_version,
         'r-' || r_regionkey AS id FROM region
)"""

ITEMS = """
labelled AS (SELECT * FROM embeddings JOIN labels ON vec_id = doc_id),
items AS (
  SELECT 'new-' || vec_id AS id, embedding AS vector, NULL AS content, 'fresh' AS user_id, 0 AS ord
  FROM embeddings
  UNION ALL
  SELECT CAST(vec_id AS VARCHAR), list_reverse(embedding), CASE WHEN toxic = 0 THEN 'first' END, 'once', 1
  FROM labelled
  UNION ALL
  SELECT CAST(vec_id AS VARCHAR), embedding, CASE WHEN toxic = 1 THEN 'second' END, 'twice', 2
  FROM labelled WHERE quality = 1
)"""

LATEST = f"""
latest AS (
  SELECT '{KEY}' || id AS doc_key, * FROM items
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY ord DESC) = 1
)"""


def _after(content: str, created: str = "'2026-02-01 00:00:00'", updated: str = "'2026-02-01 00:00:00'") -> str:
    """Stored rows once the latest items are in."""
    return f"""
SELECT coalesce(l.doc_key, s.doc_key) AS doc_key,
       CASE WHEN l.id IS NOT NULL THEN '{TYPE}' ELSE s.document_type END AS document_type,
       coalesce(l.id, s.id) AS id,
       round(CAST(CASE WHEN l.id IS NOT NULL THEN l.vector[1] ELSE s.vector[1] END AS DOUBLE), 6) AS v1,
       CASE WHEN l.id IS NOT NULL THEN l.user_id ELSE s.user_id END AS user_id,
       CASE WHEN l.id IS NOT NULL THEN {content} ELSE s.content END AS content,
       CASE WHEN s.id IS NOT NULL THEN s.created_at ELSE {created} END AS created_at,
       CASE WHEN l.id IS NOT NULL THEN {updated} ELSE s.updated_at END AS updated_at
FROM shared s FULL OUTER JOIN latest l ON s.doc_key = l.doc_key"""


MEANS = """
means AS (
  SELECT label, list(m ORDER BY i) AS mean
  FROM (
    SELECT label, i, avg(x) AS m
    FROM (SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS x, generate_subscripts(embedding, 1) AS i
          FROM embeddings)
    GROUP BY label, i)
  GROUP BY label
)"""

DISTANCE = "1 - list_cosine_similarity({a}, {b})"
SCORE = "least(1.0, greatest(0.0, 1 - distance / 2))"

SCOPED = """
queries AS (
  SELECT vec_id AS q_id, CAST(embedding AS DOUBLE[]) AS qv, label + 1 AS k, label / 20.0::DOUBLE AS threshold,
         CASE WHEN label >= 3 THEN source END AS q_user,
         CASE WHEN label <= 6 THEN lang END AS q_conversation
  FROM embeddings LEFT JOIN documents ON vec_id = doc_id
)"""

SCOPED_PAIRS = f"""
pairs AS (
  SELECT q_id, k, threshold, s.*, {DISTANCE.format(a="s.vector", b="qv")} AS distance
  FROM queries JOIN store s
    ON (q_user IS NULL OR q_user = s.user_id)
   AND (q_conversation IS NULL OR q_conversation = s.conversation_id)
)"""

SCOPED_TOP5 = f"""
WITH {STORE}, {SCOPED}, {SCOPED_PAIRS},
ranked AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY distance, id) AS rank FROM pairs)
SELECT q_id, rank, id, round(distance, 6) AS distance FROM ranked WHERE rank <= 5"""

TOPK = f"""
WITH pairs AS (
  SELECT q.vec_id AS q_id, CAST(c.vec_id AS VARCHAR) AS id,
         {DISTANCE.format(a="CAST(c.embedding AS DOUBLE[])", b="CAST(q.embedding AS DOUBLE[])")} AS distance
  FROM embeddings q CROSS JOIN embeddings c),
ranked AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY distance, id) AS rank FROM pairs)
SELECT q_id, rank, id, round(distance, 6) AS distance FROM ranked WHERE rank <= 10"""

TOPK_SINGLE = f"""
WITH {STORE}, overall AS (
  SELECT list(m ORDER BY i) AS mean FROM (
    SELECT i, avg(x) AS m
    FROM (SELECT unnest(CAST(embedding AS DOUBLE[])) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)
    GROUP BY i)),
top AS (
  SELECT id, {DISTANCE.format(a="vector", b="mean")} AS distance FROM store, overall
  ORDER BY distance, id LIMIT 10)
SELECT id, round(distance, 6) AS distance, round({SCORE}, 6) AS score FROM top"""

# The index: unit vectors, ranges per dimension, codes, decoded vectors, nearest label mean per vector.
INDEXED = f"""
unit AS (
  SELECT vec_id, vector, list_transform(vector, lambda x: x / norm) AS u
  FROM (SELECT vec_id, vector, sqrt(list_inner_product(vector, vector)) AS norm
        FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS vector FROM embeddings))),
cells AS (SELECT vec_id, unnest(u) AS x, generate_subscripts(u, 1) AS i FROM unit),
ranges AS (SELECT i, min(x) AS low, max(x) AS high FROM cells GROUP BY i),
codes AS (
  SELECT vec_id, i, low, high,
         coalesce(floor((x - low) / nullif(high - low, 0) * 255 + 0.5), 0) AS value
  FROM cells JOIN ranges USING (i)),
decoded AS (
  SELECT vec_id, list(low + value * (high - low) / 255 ORDER BY i) AS approx
  FROM codes GROUP BY vec_id),
{MEANS},
near_lists AS (
  SELECT vec_id, label AS centroid_id,
         row_number() OVER (PARTITION BY vec_id
           ORDER BY {DISTANCE.format(a="vector", b="mean")}, label) AS place
  FROM unit CROSS JOIN means),
assigned AS (SELECT vec_id, centroid_id FROM near_lists WHERE place = 1),
entries AS (
  SELECT CAST(u.vec_id AS VARCHAR) AS id, a.centroid_id, u.vector, d.approx
  FROM unit u JOIN assigned a USING (vec_id) JOIN decoded d USING (vec_id))"""


def _probed(n_probes: int, k: int, rerank: bool, top_n_scan: int) -> str:
    exact = DISTANCE.format(a="vector", b="qv")
    return f"""
WITH {INDEXED},
candidates AS (
  SELECT q.vec_id AS q_id, q.vector AS qv, e.id, e.vector,
         {DISTANCE.format(a="e.approx", b="q.vector")} AS near
  FROM unit q JOIN near_lists p ON p.vec_id = q.vec_id AND p.place <= {n_probes}
  JOIN entries e ON e.centroid_id = p.centroid_id),
scanned AS (
  SELECT * FROM candidates
  QUALIFY row_number() OVER (PARTITION BY q_id ORDER BY near, id) <= {top_n_scan}),
measured AS (SELECT q_id, id, {exact if rerank else "near"} AS distance FROM scanned),
ranked AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY distance, id) AS rank FROM measured)
SELECT q_id, rank, id, round(distance, 6) AS distance FROM ranked WHERE rank <= {k}"""


IVF_FILTERED = f"""
WITH {STORE}, {SCOPED}, {INDEXED},
candidates AS (
  SELECT q.q_id, q.qv, e.id, e.vector, {DISTANCE.format(a="e.approx", b="q.qv")} AS near
  FROM queries q JOIN near_lists p ON p.vec_id = q.q_id AND p.place <= 4
  JOIN entries e ON e.centroid_id = p.centroid_id
  JOIN store s ON s.id = e.id
   AND (q.q_user IS NULL OR q.q_user = s.user_id)
   AND (q.q_conversation IS NULL OR q.q_conversation = s.conversation_id)),
scanned AS (
  SELECT *, {DISTANCE.format(a="vector", b="qv")} AS distance FROM candidates
  QUALIFY row_number() OVER (PARTITION BY q_id ORDER BY near, id) <= 20),
ranked AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY distance, id) AS rank FROM scanned)
SELECT q_id, rank, id, round(distance, 6) AS distance FROM ranked WHERE rank <= 5"""


AFTER_WRITES = f"""
WITH {SHARED}, {ITEMS}, {LATEST},
written AS (
  SELECT coalesce(l.id, s.id) AS id, CAST(CASE WHEN l.id IS NOT NULL THEN l.vector ELSE s.vector END AS DOUBLE[]) AS vector
  FROM shared s FULL OUTER JOIN latest l ON s.doc_key = l.doc_key
  WHERE s.document_type IS NULL OR s.document_type = '{TYPE}'),
now AS (SELECT * FROM written WHERE id NOT IN (SELECT CAST(vec_id AS VARCHAR) FROM embeddings WHERE label = 0)),
pairs AS (
  SELECT q.vec_id AS q_id, id, {DISTANCE.format(a="vector", b="CAST(q.embedding AS DOUBLE[])")} AS distance
  FROM embeddings q CROSS JOIN now),
ranked AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY distance, id) AS rank FROM pairs)
SELECT q_id, rank, id, round(distance, 6) AS distance FROM ranked WHERE rank <= 10"""

FILTERED_FULL = f"""
WITH {STORE}, {SCOPED},
matching AS (
  SELECT q_id, count(s.id) AS n FROM queries q LEFT JOIN store s
    ON (q_user IS NULL OR q_user = s.user_id) AND (q_conversation IS NULL OR q_conversation = s.conversation_id)
  GROUP BY q_id)
SELECT q_id, least(n, 5) AS n_hits, least(n, 5) AS last_rank FROM matching"""


def _counts(column: str) -> str:
    groups = [
        " + ".join(f"CAST(contains(lower({column}), '{t}') AS DOUBLE)" for t in terms) for terms in fx.GROUPS
    ]
    return f"[{', '.join(groups)}]"


def _flags(column: str) -> str:
    groups = [
        "CASE WHEN " + " OR ".join(f"contains(lower({column}), '{t}')" for t in terms) + " THEN 1.0::DOUBLE ELSE 0.1::DOUBLE END"
        for terms in fx.GROUPS
    ]
    return f"[{', '.join(groups)}]"


def _normalized(v: str) -> str:
    return f"list_transform({v}, lambda x: x / sqrt(list_inner_product({v}, {v})))"


def _embedded(table: str, column: str = "text") -> str:
    """Rows of a table with their keyword-count embedding ``v``."""
    uniform = f"[{', '.join(['1.0::DOUBLE'] * len(fx.GROUPS))}]"
    return f"""
(SELECT * EXCLUDE (c), CASE WHEN list_sum(c) > 0 THEN {_normalized("c")} ELSE {_normalized(uniform)} END AS v
 FROM (SELECT *, {_counts(column)} AS c FROM {table}))"""


LAST = "last AS (SELECT conv_id AS q_id, arg_max(text, turn) AS text FROM conversations GROUP BY conv_id)"

RETRIEVED = f"""
{LAST},
asked AS (SELECT *, 'src' || right(CAST(length(text) AS VARCHAR), 1) AS q_user FROM {_embedded("last")}),
corpus AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, source AS user_id, v,
         CASE WHEN lang = 'en' THEN 'Doc ' || doc_id END AS title,
         CASE WHEN lang <> 'es' THEN text END AS content
  FROM {_embedded("documents")}),
pairs AS (
  SELECT q_id, c.*, round({DISTANCE.format(a="c.v", b="a.v")}, 9) AS distance
  FROM asked a JOIN corpus c ON a.q_user = c.user_id),
ranked AS (
  SELECT *, {SCORE} AS score, row_number() OVER (PARTITION BY q_id ORDER BY distance, id) AS rank FROM pairs
  QUALIFY rank <= 3),
hits AS (SELECT * FROM ranked WHERE score >= 0.9)"""


def _contexts(hits: str) -> str:
    return f"""
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY rank) AS n FROM {hits} WHERE length(content) > 0),
contexts AS (
  SELECT q_id, string_agg(
    printf('Document %d (ID: %s, Score: %.4f):', n, id, score) || chr(10) || content,
    chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY n) AS context
  FROM numbered GROUP BY q_id)"""


ORACLES: dict[str, str] = {
    "store_scan": f"""
WITH {SHARED} SELECT doc_key, id, len(vector) AS n_values, user_id, content FROM shared
WHERE document_type = '{TYPE}'""",
    "prefix_scan": f"WITH {SHARED} SELECT doc_key, document_type FROM shared WHERE starts_with(doc_key, '{KEY}')",
    "make_documents": f"""
WITH {ITEMS} SELECT '{KEY}' || id || '@' || ord AS doc_key, '{TYPE}' AS document_type, id,
  round(CAST(vector[1] AS DOUBLE), 6) AS v1, user_id, content,
  '2026-01-01 00:00:00' AS created_at, '2026-02-01 00:00:00' AS updated_at FROM items""",
    "document_key": f"SELECT doc_id, '{KEY}' || doc_id AS doc_key FROM documents",
    "validate_vectors": """
SELECT vec_id, CASE label
  WHEN 1 THEN 'dimension mismatch: the vector has ' || (len(embedding) - 1) || ' values, the store 64'
  WHEN 2 THEN 'every value of a vector must be a finite number'
  WHEN 3 THEN 'every value of a vector must be a finite number'
  WHEN 4 THEN 'the id must not be empty'
  ELSE 'ok' END AS reason FROM embeddings""",
    "validate_ids": """
SELECT doc_id, CASE WHEN lang = 'de' OR length(source) = 0 THEN 'the id must not be empty' ELSE 'ok' END AS reason
FROM documents""",
    "owned_rows": f"""
WITH {SHARED} SELECT doc_key, coalesce(document_type = '{TYPE}' AND schema_version = 1
  AND id IS NOT NULL AND vector IS NOT NULL, false) AS owned FROM shared""",
    "count_owned": f"""
WITH {SHARED} SELECT count(*) AS n FROM shared WHERE starts_with(doc_key, '{KEY}')
  AND document_type = '{TYPE}' AND schema_version = 1 AND id IS NOT NULL AND vector IS NOT NULL""",
    "upsert_batch": f"WITH {SHARED}, {ITEMS}, {LATEST} {_after('l.content')}",
    "upsert_content_mirror": f"WITH {SHARED}, {ITEMS}, {LATEST} " + _after("'text of ' || l.id"),
    "upsert_collisions": f"SELECT '{KEY}s-' || s_suppkey AS doc_key FROM supplier JOIN embeddings ON vec_id = s_suppkey",
    "get_batch": f"""
WITH {SHARED},
ids AS (SELECT CAST(doc_id AS VARCHAR) AS id FROM documents UNION ALL SELECT 's-' || s_suppkey FROM supplier)
SELECT i.id, len(vector) AS n_values, title, content, coalesce(document_type = '{TYPE}', false) AS found,
  coalesce(document_type <> '{TYPE}', false) AS collision
FROM ids i LEFT JOIN shared s ON s.doc_key = '{KEY}' || i.id""",
    "delete_batch": f"""
WITH {SHARED} SELECT doc_key, document_type FROM shared
WHERE NOT (document_type = '{TYPE}' AND id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels WHERE toxic = 1))""",
    "clear_owned": f"""
WITH {SHARED} SELECT doc_key, document_type FROM shared
WHERE NOT (starts_with(doc_key, '{KEY}') AND document_type = '{TYPE}')""",
    "filter_equality": f"WITH {STORE} SELECT doc_key, user_id FROM store WHERE conversation_id = 'en' AND label = 3",
    "filter_per_query": SCOPED_TOP5,
    "filter_per_query_shuffled": SCOPED_TOP5,
    "cosine_distances": f"""
WITH {MEANS} SELECT vec_id, round({DISTANCE.format(a="CAST(embedding AS DOUBLE[])", b="mean")}, 6) AS distance
FROM embeddings JOIN means USING (label)""",
    "distance_scores": """
SELECT event_id, round(least(1.0, greatest(0.0, 1 - (value / 10 - 1) / 2)), 6) AS score FROM events""",
    "topk_single": TOPK_SINGLE,
    "topk_single_builtin": TOPK_SINGLE,
    "topk_batch": TOPK,
    "topk_batch_shuffled": TOPK,
    "search_bounds": """
SELECT event_id, CASE WHEN floor(value) - 5 <= 0 THEN 'limit must be a positive integer'
  WHEN value / 20 - 0.5 < 0 OR value / 20 - 0.5 > 1 THEN 'threshold must be between 0 and 1'
  ELSE 'ok' END AS reason FROM events""",
    "search_threshold": f"""
WITH {STORE}, {MEANS},
pairs AS (
  SELECT CAST(m.label AS BIGINT) AS q_id, id, {DISTANCE.format(a="vector", b="mean")} AS distance
  FROM means m CROSS JOIN store),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY distance, id) AS rank FROM pairs QUALIFY rank <= 20)
SELECT q_id, rank, id, round({SCORE}, 6) AS score FROM ranked WHERE {SCORE} >= 0.6""",
    "search_full": f"""
WITH {STORE}, {SCOPED}, {SCOPED_PAIRS},
ranked AS (
  SELECT *, {SCORE} AS score, row_number() OVER (PARTITION BY q_id ORDER BY distance, id) AS rank FROM pairs)
SELECT q_id, rank, doc_key, id, len(vector) AS n_values, title, coalesce(content, meta_content) AS content,
  round(distance, 6) AS distance, round(score, 6) AS score
FROM ranked WHERE rank <= k AND score >= threshold""",
    "ivf_assign": f"""
WITH {INDEXED} SELECT CAST(vec_id AS VARCHAR) AS id, CAST(centroid_id AS BIGINT) AS centroid_id FROM assigned""",
    "sq8_ranges": f"WITH {INDEXED} SELECT i - 1 AS i, round(low, 6) AS low, round(high, 6) AS high FROM ranges",
    "sq8_encode": f"""
WITH {INDEXED} SELECT CAST(vec_id AS VARCHAR) AS id, i - 1 AS i, CAST(value AS BIGINT) AS value FROM codes""",
    "ivf_full_probe": TOPK,
    "ivf_probe": _probed(3, 10, False, 10),
    "ivf_rerank": _probed(3, 10, True, 30),
    "ivf_capped": _probed(2, 10, False, 7),
    "ivf_filtered": IVF_FILTERED,
    "ivf_after_writes": AFTER_WRITES,
    "ivf_written": _probed(3, 10, True, 30),
    "ivf_refreshed": AFTER_WRITES,
    "ivf_filtered_full": FILTERED_FULL,
    "index_stats": f"""
SELECT '{fx.SPEC.index_name}' AS index_name, CAST(16 AS BIGINT) AS lists, count(*) AS indexed_rows,
  count(*) AS store_rows, CAST(0 AS BIGINT) AS missing_rows, CAST(0 AS BIGINT) AS removed_rows,
  CAST(0 AS BIGINT) AS changed_rows FROM embeddings""",
    "extract_last_message": """
SELECT conv_id, coalesce(arg_max(text, turn), '') AS text FROM conversations GROUP BY conv_id""",
    "extract_parts": "SELECT conv_id, turn, concat_ws(' ', text, role) AS text FROM conversations",
    "extract_json": """
SELECT conv_id, turn, CASE role WHEN 'user' THEN concat_ws(' ', text, role) WHEN 'assistant' THEN text ELSE '' END AS text
FROM conversations""",
    "embed_keyword_count": f"""
SELECT doc_id, unnest(range(len(v))) AS i, round(unnest(v), 6) AS x FROM {_embedded("documents")}""",
    "embed_keyword_flag": f"""
SELECT doc_id, unnest(range(len(v))) AS i, round(unnest(v), 6) AS x
FROM (SELECT doc_id, {_normalized("f")} AS v FROM (SELECT doc_id, {_flags("text")} AS f FROM documents))""",
    "embed_udf": """
SELECT doc_id, unnest([0, 1, 2]) AS i, CAST(unnest([
  length(text), length(text) - length(replace(text, 'e', '')), length(text) - length(replace(text, 'n', ''))
]) AS DOUBLE) AS x FROM documents""",
    "references": f"""
WITH {RETRIEVED} SELECT q_id, rank, id, coalesce(title, 'Document ' || rank) AS title,
  'Knowledge base' AS source, round(score, 6) AS score, user_id FROM hits""",
    "retrieve": f"""
WITH {RETRIEVED}, {_contexts("hits")}
SELECT l.q_id, coalesce(context, 'No relevant documents found in the knowledge base.') AS context
FROM last l LEFT JOIN contexts c USING (q_id)""",
    "context": f"""
WITH {STORE}, {MEANS},
pairs AS (
  SELECT CAST(m.label AS BIGINT) AS q_id, id, coalesce(content, meta_content) AS content,
    {DISTANCE.format(a="vector", b="mean")} AS distance
  FROM means m CROSS JOIN store),
hits AS (
  SELECT *, {SCORE} AS score, row_number() OVER (PARTITION BY q_id ORDER BY distance, id) AS rank FROM pairs
  QUALIFY rank <= 5 AND score >= 0.6),
{_contexts("hits")}
SELECT q_id, context FROM contexts""",
    "memory_recall": f"""
WITH m AS (SELECT conv_id, turn, v FROM {_embedded("conversations")}),
pairs AS (
  SELECT n.conv_id, n.turn, e.turn AS recalled_turn, round({DISTANCE.format(a="e.v", b="n.v")}, 9) AS distance
  FROM m n JOIN m e ON e.conv_id = n.conv_id AND e.turn < n.turn),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY distance, recalled_turn) AS rank FROM pairs)
SELECT conv_id, turn, rank, recalled_turn, round({SCORE}, 6) AS score FROM ranked WHERE rank <= 3""",
    "change_log": f"""
WITH {SHARED}, {ITEMS}, {LATEST}, after AS ({_after("l.content", updated="'2026-02-03 00:00:00'")}),
toxic AS (SELECT CAST(doc_id AS VARCHAR) AS id FROM labels WHERE toxic = 1)
SELECT a.* REPLACE (CASE
  WHEN t.id IS NOT NULL AND a.document_type = '{TYPE}' AND a.updated_at = '2026-02-03 00:00:00'
  THEN '2026-02-02 00:00:00' ELSE created_at END AS created_at)
FROM after a LEFT JOIN toxic t ON t.id = a.id
WHERE NOT (t.id IS NOT NULL AND a.updated_at <> '2026-02-03 00:00:00')""",
    "stream_ingest": f"""
WITH {SHARED}
SELECT doc_key, document_type, shared.id,
  round(CAST(CASE WHEN vec_id IS NOT NULL THEN embedding[len(embedding)] ELSE vector[1] END AS DOUBLE), 6) AS v1,
  CASE WHEN vec_id IS NULL THEN user_id END AS user_id,
  CASE WHEN vec_id IS NOT NULL THEN 'label ' || e.label END AS content,
  created_at, CASE WHEN vec_id IS NOT NULL THEN '2026-02-01 00:00:00' ELSE updated_at END AS updated_at
FROM shared LEFT JOIN embeddings e ON shared.id = CAST(vec_id AS VARCHAR)""",
}
