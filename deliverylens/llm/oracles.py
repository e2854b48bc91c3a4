"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

# either case of ASCII letters only, as the contract has it
_ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    "|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"
)
# kind, pattern, group whose length counts, least length
_RULES = (
    ("assign", _ASSIGN, 2, 8),
    ("access", "AKIA[A-Z0-9]+", 0, 16),
    ("hex", "[0-9a-f]+", 0, 32),
    ("pem", "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 1),
    ("hosted", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    ("chat", "xox[abprs]-[A-Za-z0-9-]{10,}", 0, 1),
    ("jwt", "eyJ[A-Za-z0-9_-]{8,}\\.eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}", 0, 1),
)

SECRETS = (
    "WITH texts AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents),\nmatches AS (\n"
    + "\nUNION ALL\n".join(
        f"""SELECT row_id, {place} AS place, '{kind}' AS kind, {least} AS least,
       unnest(list_transform(string_split_regex(text, '{pattern}'), lambda x: length(x))[:-2]) AS before,
       unnest(list_transform(regexp_extract_all(text, '{pattern}'), lambda x: length(x))) AS size,
       unnest(list_transform(regexp_extract_all(text, '{pattern}', {group}), lambda x: length(x))) AS value_size,
       generate_subscripts(regexp_extract_all(text, '{pattern}'), 1) AS number
FROM texts"""
        for place, (kind, pattern, group, least) in enumerate(_RULES)
    )
    + """
), placed AS (
  SELECT *, sum(before + size) OVER (PARTITION BY row_id, place ORDER BY number) AS stop FROM matches
), spans AS (
  SELECT row_id, place, kind, (stop - size)::BIGINT AS start, stop::BIGINT AS stop FROM placed WHERE value_size >= least
), joined AS (
  SELECT row_id,
         count(*) FILTER (WHERE kind = 'assign') AS n_assign,
         count(*) FILTER (WHERE kind = 'access') AS n_access,
         count(*) FILTER (WHERE kind = 'hex') AS n_hex,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) FILTER (WHERE place < 3) AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) AS spans
  FROM spans GROUP BY row_id
)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN joined USING (row_id)"""
)

TOOL_CALLS = """WITH RECURSIVE calls AS (
  SELECT conv_id, 'call-' || conv_id || '-' || turn AS call_id, turn, text, length(text) AS n,
         CASE WHEN turn % 4 < 2 THEN 'ask' ELSE 'look_up' END AS tool,
         'call-' || conv_id || '-' || (turn - 2) AS need
  FROM conversations WHERE role = 'user'
), results AS (
  SELECT conv_id, 'call-' || conv_id || '-' || (turn - 1) AS call_id, min(turn) AS result_turn,
         arg_min(text, turn) AS content, count(*) AS n_results
  FROM conversations WHERE role = 'assistant' GROUP BY ALL
), levels AS (
  SELECT conv_id, call_id, 0::BIGINT AS level FROM calls c
  WHERE NOT EXISTS (SELECT 1 FROM calls d WHERE d.conv_id = c.conv_id AND d.call_id = c.need)
  UNION ALL
  SELECT c.conv_id, c.call_id, l.level + 1 FROM calls c JOIN levels l ON l.conv_id = c.conv_id AND l.call_id = c.need
), linked AS (
  SELECT *, CASE
    WHEN tool = 'ask' THEN concat_ws('; ', CASE WHEN n < 1 THEN 'limit: below 1' END,
      CASE WHEN n > 300 THEN 'limit: above 300' END, CASE WHEN n < 1 THEN 'query: below 1' END)
    ELSE concat_ws('; ', CASE WHEN n < 20 THEN 'limit: below 20' END, CASE WHEN n < 1 THEN 'query: below 1' END,
      CASE WHEN n > 200 THEN 'query: above 200' END) END AS errors
  FROM calls LEFT JOIN levels USING (conv_id, call_id) LEFT JOIN results USING (conv_id, call_id)
)
SELECT conv_id, call_id, turn::BIGINT AS turn, tool, level, result_turn::BIGINT AS result_turn,
       coalesce(n_results, 0)::BIGINT AS n_results,
       CASE WHEN errors <> '' THEN 'invalid' WHEN n_results IS NULL THEN 'unanswered' ELSE 'ok' END AS status, errors,
       '{"arguments":{"limit":' || n || ',"query":' || to_json(text) || '},"call_id":' || to_json(call_id)
         || ',"name":"' || tool || '"' || coalesce(',"result":' || to_json(content), '') || '}' AS json
FROM linked
UNION ALL
SELECT conv_id, call_id, NULL, NULL, NULL, result_turn::BIGINT, n_results::BIGINT, 'orphan', '',
       '{"call_id":' || to_json(call_id) || ',"result":' || to_json(content) || '}'
FROM results r WHERE NOT EXISTS (SELECT 1 FROM calls c WHERE c.conv_id = r.conv_id AND c.call_id = r.call_id)
UNION ALL
SELECT conv_id, NULL, turn::BIGINT, NULL, NULL, NULL, 0, 'message', '',
       '{' || concat_ws(',', '"content":' || to_json(text), '"role":' || to_json(role)) || '}'
FROM conversations WHERE role IS NULL OR role NOT IN ('user', 'assistant')"""

NEAR_VECTORS = """WITH RECURSIVE unit AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v)) >= 0.93
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM unit
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
), component AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
counted AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM component LEFT JOIN counted USING (vec_id)"""

# CRC-32 bit by bit, and half a byte at a time with its sixteen remainders
_POLYNOMIAL = 0xEDB88320


def _remainder(n: int, bits: int) -> int:
    for _ in range(bits):
        n = n >> 1 ^ (_POLYNOMIAL if n & 1 else 0)
    return n


_CRC_OF_DIGITS = f"""xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(
    string_split(doc_id::VARCHAR, ''), lambda c: list_transform(range(8), lambda k: (ascii(c) >> k) & 1)))),
    lambda c, b: xor(xor(c, b) >> 1, (xor(c, b) & 1) * {_POLYNOMIAL})))"""
_CRC_OF_HEX = f"""xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(range(length(h) // 2),
    lambda k: [instr('0123456789ABCDEF', h[2 * k + 2]) - 1, instr('0123456789ABCDEF', h[2 * k + 1]) - 1]))),
    lambda c, n: xor(c >> 4, {[_remainder(n, 4) for n in range(16)]}[(xor(c, n) & 15) + 1])))"""


def _framed(field: str) -> str:
    return f"coalesce(strlen({field}::VARCHAR)::VARCHAR || ':' || {field}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_framed, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


def _levels(rows: str) -> str:
    """All levels of trees whose leaves are ``rows`` (tree, level, i, hash)."""
    return f"""{rows}
  UNION ALL
  SELECT tree, level + 1, i // 3, sha256(string_agg(hash, '' ORDER BY i))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM self) WHERE n > 1 GROUP BY tree, level, i // 3"""


def _steps(name: str) -> str:
    """What stands before and after each node in its run, below the top of its tree."""
    run = "OVER (PARTITION BY tree, level, i // 3 ORDER BY i ROWS BETWEEN"
    return f"""SELECT tree, level, i,
         coalesce(string_agg(hash, '') {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(hash, '') {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM (SELECT *, count(*) OVER (PARTITION BY tree, level) AS n FROM {name}) WHERE n > 1"""


def _walk(start: str, steps: str) -> str:
    return f"""{start}
  UNION ALL
  SELECT w.row_id, w.tree, w.level + 1, w.i // 3, sha256(before || cur || after), proof || before || after
  FROM self w JOIN {steps} s ON s.tree = w.tree AND s.level = w.level AND s.i = w.i"""


MERKLE = f"""WITH RECURSIVE given AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce('s' || source, '') AS tree, {_leaf("text")} AS leaf,
         CASE WHEN {_CRC_OF_DIGITS} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS claimed
  FROM documents
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM given
), source_nodes AS (
  {_levels("SELECT tree, 0::BIGINT AS level, i, leaf AS hash FROM leaves").replace("self", "source_nodes")}
), subroots AS (
  SELECT tree, hash AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place
  FROM (SELECT tree, arg_max(hash, level) AS hash FROM source_nodes GROUP BY tree)
), top_nodes AS (
  {_levels("SELECT 'top' AS tree, 0::BIGINT AS level, place AS i, subroot AS hash FROM subroots").replace("self", "top_nodes")}
), source_steps AS (
  {_steps("source_nodes")}
), top_steps AS (
  {_steps("top_nodes")}
), up AS (
  {_walk("SELECT row_id, tree, 0::BIGINT AS level, i, claimed AS cur, '' AS proof FROM leaves", "source_steps").replace("self", "up")}
), reached AS (
  SELECT row_id, tree, arg_max(cur, level) AS cur, arg_max(proof, level) AS proof FROM up GROUP BY row_id, tree
), over AS (
  {_walk("SELECT row_id, 'top' AS tree, 0::BIGINT AS level, place AS i, cur, proof FROM reached JOIN subroots USING (tree)", "top_steps").replace("self", "over")}
), ended AS (
  SELECT row_id, arg_max(cur, level) AS folded_root, arg_max(proof, level) AS proof FROM over GROUP BY row_id
), top AS (SELECT arg_max(hash, level) AS root FROM top_nodes)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified
FROM leaves JOIN subroots USING (tree) JOIN ended USING (row_id), top"""

_WORDS = "'[^\\x20\\x09-\\x0D]+'"
RULES = f"""WITH texts AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents
), cut AS (
  SELECT *, regexp_extract_all(text, {_WORDS}) AS w, regexp_extract_all(lower(text), {_WORDS}) AS lw FROM texts
), grams AS (
  SELECT row_id, doc_id,
         unnest(list_concat(lw, list_transform(range(len(lw) - 1), lambda i: lw[i + 1] || ' ' || lw[i + 2]))) AS gram
  FROM cut
), hashed AS (
  SELECT gram, {_CRC_OF_HEX} % 65536 AS bucket FROM (SELECT DISTINCT gram, hex(gram) AS h FROM grams)
), trusted AS (
  SELECT doc_id, 1 AS good FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1
), counts AS (
  SELECT bucket, count(*) AS raw, count(good) AS target
  FROM grams JOIN hashed USING (gram) LEFT JOIN trusted USING (doc_id) GROUP BY bucket
), weights AS (
  SELECT bucket, floor(ln((target + 8.0::DOUBLE) / (raw * share + 8.0::DOUBLE)) * 1000000 + 0.5::DOUBLE)::BIGINT AS weight
  FROM counts, (SELECT coalesce(sum(target)::DOUBLE / sum(raw), 0) AS share FROM counts)
), scored AS (
  SELECT row_id, count(*) AS n_grams, sum(weight)::BIGINT AS ratio_sum
  FROM grams JOIN hashed USING (gram) JOIN weights USING (bucket) GROUP BY row_id
), windows AS (
  SELECT row_id, unnest(list_transform(range(len(w) - 2), lambda i: [w[i + 1], w[i + 2], w[i + 3]])) AS win,
         unnest(range(len(w) - 2)) AS i
  FROM cut
), again AS (
  SELECT row_id, i FROM (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, win) AS n FROM windows) WHERE n > 1
), repeated AS (
  SELECT row_id, count(DISTINCT i + d) AS n_repeat_words FROM again, range(3) x(d) GROUP BY row_id
), counted AS (
  SELECT row_id, doc_id, len(w) AS n_words, length(list_aggregate(list_concat([''], w), 'string_agg', '')) AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_grams, 0) AS n_grams, coalesce(ratio_sum, 0) AS ratio_sum
  FROM cut LEFT JOIN repeated USING (row_id) LEFT JOIN scored USING (row_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND ratio_sum >= -100000 * n_grams AS kept, n_grams, ratio_sum
FROM counted"""

ORACLES = {
    "op2_secret_scan": SECRETS,
    "op8_tool_calls": TOOL_CALLS,
    "op9_near_vectors": NEAR_VECTORS,
    "op11_merkle_manifest": MERKLE,
    "op13_quality_rules": RULES,
}
