"""The queries of this subpackage and the SQL that states their results, where SQL can."""

from __future__ import annotations

from .chat import CONTROL, MARKS, op5_chat_format
from .decontaminate import op1_decontaminate
from .jaccard import op6_jaccard_join
from .language import op4_language_mixture
from .media import op2_media_chunks
from .pack import op7_best_fit_pack
from .quality import op10_quality_classifier
from .secrets import op9_secret_scan
from .shard import op3_rendezvous_shards
from .suffix import op8_suffix_dedup

QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_media_chunks": op2_media_chunks,
    "op3_rendezvous_shards": op3_rendezvous_shards,
    "op4_language_mixture": op4_language_mixture,
    "op5_chat_format": op5_chat_format,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_best_fit_pack": op7_best_fit_pack,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_secret_scan": op9_secret_scan,
    "op10_quality_classifier": op10_quality_classifier,
}

#: Words lie between blanks; A-Z become small. Windows are words joined by blanks, matched at their own length.
DECONTAMINATE = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM benchmark WHERE item_id IS NOT NULL),
windows AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS words
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0) x),
starts AS (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, (SELECT DISTINCT n FROM windows) s WHERE len(w) >= n),
hits AS (SELECT doc_id, i, starts.n, item_id FROM starts JOIN windows ON windows.n = starts.n AND words = array_to_string(w[i:i + starts.n - 1], ' ')),
words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS k FROM hits) x GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hits) x GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items, sha256(COALESCE(ids, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""

#: Escaping adds a character for each backslash and for each occurrence of a control string.
_ADDED = " + ".join([r"length({0}) - length(replace({0}, '\', ''))", *(f"(length({{0}}) - length(replace({{0}}, '{c}', ''))) / {len(c)}" for c in CONTROL)])
CHAT = rf"""
WITH t AS (SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(COALESCE(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum({sum(map(len, MARKS))} + length(role) + {_ADDED.format("role")} + length(text) + {_ADDED.format("text")}) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id"""

JACCARD = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS shingle FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM w WHERE len(w) > 0) x),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
e AS MATERIALIZED (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * common >= 80 * (a.n + b.n - common)),
edges AS MATERIALIZED (SELECT x, y FROM e UNION SELECT y, x FROM e),
reach AS (SELECT DISTINCT x AS doc_id, x AS other FROM edges UNION SELECT r.doc_id, edges.y FROM reach r JOIN edges ON edges.x = r.other),
c AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT w.doc_id, COALESCE(n.n, 0) AS n_shingles, COALESCE(c.component_id, w.doc_id) AS component_id FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN c ON c.doc_id = w.doc_id"""

ORACLES: dict[str, str] = {"op1_decontaminate": DECONTAMINATE, "op5_chat_format": CHAT, "op6_jaccard_join": JACCARD}
