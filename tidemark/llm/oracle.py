"""DuckDB SQL of the dealt operators that SQL can express on whole tables."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

OP4 = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
  SELECT *, length(regexp_replace(role, '([\\#<:])', '\\\1', 'g')) + length(regexp_replace(text, '([\\#<])', '\\\1', 'g'))
            + length('### ' || ': ' || ' </turn>' || chr(10)) AS chars
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

OP5 = """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
), parts AS (
  SELECT vec_id, unnest(e) AS x, generate_subscripts(e, 1) AS i FROM v
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM parts q JOIN parts c ON q.i = c.i AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0 GROUP BY 1, 2
)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 5
"""

OP8 = r"""
WITH d AS (
  SELECT doc_id, [x FOR x IN string_split_regex(lower(text), '[^\p{L}\p{N}]+') IF x <> ''] AS w FROM documents
), i AS (
  SELECT item_id, [x FOR x IN string_split_regex(lower(text), '[^\p{L}\p{N}]+') IF x <> ''] AS w FROM benchmark
), ds AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS p FROM d)
), bs AS (
  SELECT DISTINCT item_id, array_to_string(w[p:p + 4], ' ') AS s FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS p FROM i)
), sizes AS (SELECT item_id, count(*) AS size FROM bs GROUP BY item_id)
SELECT ds.doc_id, bs.item_id, count(*) AS shared, any_value(size) AS size
FROM bs JOIN ds USING (s) JOIN sizes ON sizes.item_id = bs.item_id
GROUP BY ds.doc_id, bs.item_id HAVING count(*) * 100 >= any_value(size) * 80
"""

ORACLE: dict[str, str] = {
    "op4_chat_formatting": OP4,
    "op5_top_k_search": OP5,
    "op8_benchmark_decontamination": OP8,
}

OP2 = r"""
WITH d AS (
  SELECT doc_id, [x FOR x IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS w FROM documents
), wins AS (
  SELECT doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM d)
), firsts AS (SELECT s, min(doc_id) AS first FROM wins GROUP BY s),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS i FROM wins JOIN firsts USING (s) WHERE first < doc_id
), words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
  FROM words WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.doc_id = words.doc_id AND gone.i = words.i) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
ORACLE["op2_substring_dedup"] = OP2

OP6 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF x <> ''] AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[p:p + 3], ' ')) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 2)) AS p FROM d WHERE len(w) >= 4)
  UNION ALL SELECT doc_id, 'all ' || array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 3
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reach.b) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN reach ON reach.a = d.doc_id GROUP BY d.doc_id
"""
ORACLE["op6_jaccard_join"] = OP6
