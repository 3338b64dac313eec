"""DuckDB SQL for the training-data queries that SQL can express."""

from __future__ import annotations

from docweave.llm import decontaminate, secrets

SQL = {}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          f"'abcdefghijklmnopqrstuvwxyz'), {_quoted(decontaminate.WORD)})")

SQL["op4_decontaminate"] = f"""
WITH items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(13, len(w)) AS size, list_slice(w, pos, pos + least(13, len(w)) - 1) AS held
    FROM items, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS u(pos) WHERE len(w) > 0),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
sizes AS (SELECT DISTINCT size FROM windows),
runs AS (
    SELECT r, pos, size, list_slice(w, pos, pos + size - 1) AS held
    FROM docs, sizes, unnest(range(1, len(w) - size + 2)) AS u(pos)),
found AS (SELECT r, pos, runs.size, item_id FROM runs JOIN windows ON runs.held = windows.held),
hits AS (
    SELECT r, count(DISTINCT pos + k) AS n_hit FROM found, unnest(range(0, size)) AS u(k) GROUP BY r),
ids AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM found) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
    coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN ids USING (r)
"""

_CANDIDATE = f"{secrets.RUN}{{20,}}"
_SHAPES = ((secrets.ASSIGN, 0), (secrets.ACCESS, 1), (secrets.HEX, 2), (_CANDIDATE, 3))
_FOUND = " UNION ALL ".join(
    f"SELECT r, {order} AS o, string_split_regex(t, {_quoted(shape)}) AS gaps, "
    f"regexp_extract_all(t, {_quoted(shape)}, 0) AS held, "
    f"{f'regexp_extract_all(t, {_quoted(shape)}, 1)' if order == 0 else 'NULL'} AS named FROM docs"
    for shape, order in _SHAPES)
_ALLOWED = " OR ".join(f"regexp_matches(held, {_quoted(secrets.ALLOWED[i])})" for i in (0, 1, 3))
_LIMIT = " ".join(f"WHEN regexp_matches(held, {_quoted(shape)}) THEN {least}" for shape, least in secrets.LIMITS)
_IS_WORDS = (f"len(list_filter(string_split_regex(held, '[-_/=+]+'), lambda p: p <> '' "
             f"AND NOT regexp_full_match(p, {_quoted(secrets.PART)}))) = 0")

SQL["op8_secret_scan"] = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({_FOUND}),
each AS (
    SELECT r, o, i, held[i] AS held, named[i] AS named, length(gaps[i]) + length(held[i]) AS moved
    FROM found, unnest(range(1, len(held) + 1)) AS u(i)),
placed AS (
    SELECT row_number() OVER () AS m, r, o, held, named, sum(moved) OVER (PARTITION BY r, o ORDER BY i) AS e
    FROM each),
runs AS (
    SELECT m, held, regexp_matches(held, '^[0-9A-Fa-f]+$') AS is_hex, {_IS_WORDS} AS is_words FROM placed WHERE o = 3),
candidates AS (
    SELECT m, CASE WHEN is_hex THEN lower(held) ELSE held END AS run,
        CASE WHEN is_hex THEN {secrets.HEX_LEAST} WHEN is_words THEN {secrets.BASE64_LIMIT} {_LIMIT}
            ELSE {secrets.REST_LEAST} END AS least
    FROM runs WHERE NOT (is_words AND NOT regexp_matches(held, {_quoted(secrets.DIGITS_INSIDE)})) AND NOT ({_ALLOWED})),
windows AS (
    SELECT m, least, pos, substr(run, pos, {secrets.WINDOW}) AS w
    FROM candidates, unnest(range(1, length(run) - {secrets.WINDOW} + 2)) AS u(pos)),
counts AS (
    SELECT m, least, pos, c, count(*) AS n
    FROM (SELECT m, least, pos, unnest(string_split(w, '')) AS c FROM windows) GROUP BY ALL),
entropies AS (
    SELECT m, least, pos, log2({secrets.WINDOW}) - sum(n * log2(n)) / {secrets.WINDOW} AS h
    FROM counts GROUP BY m, least, pos),
high AS (SELECT m FROM entropies GROUP BY m, least HAVING max(h) >= least),
spans AS (
    SELECT r, o, e::BIGINT AS e, (e - length(held))::BIGINT AS s, ['assign', 'access', 'hex', 'entropy'][o + 1] AS kind
    FROM placed
    WHERE o IN (1, 2) OR o = 0 AND length(named) >= {secrets.ASSIGN_LEAST} OR o = 3 AND m IN (SELECT m FROM high)),
joined AS (
    SELECT r, count(*) FILTER (o = 0) AS n_assign, count(*) FILTER (o = 1) AS n_access,
        count(*) FILTER (o = 2) AS n_hex,
        string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) FILTER (o < 3) AS base,
        string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) AS spans
    FROM spans GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
    coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN joined USING (r)
"""

SQL["op1_near_join"] = f"""
WITH RECURSIVE docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
runs AS (
    SELECT DISTINCT doc_id, list_slice(w, pos, pos + 4) AS run
    FROM docs, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS u(pos) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM runs GROUP BY doc_id),
common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
    FROM runs x JOIN runs y ON x.run = y.run AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
    SELECT a, b FROM common JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
    WHERE 5 * common.n >= 4 * (s.n + t.n - common.n)),
reached AS (SELECT doc_id AS a, doc_id AS b FROM docs
            UNION SELECT reached.a, links.b FROM reached JOIN links ON links.a = reached.b)
SELECT doc_id, min(b) AS class_id, (SELECT count(*) FROM links WHERE links.a = docs.doc_id)::BIGINT AS n_links
FROM docs JOIN reached ON reached.a = docs.doc_id GROUP BY doc_id
"""

SQL["op6_chat_format"] = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
said AS (
    SELECT conv_id, coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '') AS loss,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS whole, count(*) AS n,
        sum(length('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10))
            + len(regexp_extract_all(text, '<\\*\|'))) AS formatted
    FROM turns GROUP BY conv_id)
SELECT conv_id, n::BIGINT AS n_turns, sha256(whole) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
    sha256(loss) AS loss_sha256, formatted::BIGINT AS formatted_chars
FROM said
"""

_CRC32 = ("xor(list_reduce(list_transform(range(1, length({0}) + 1), lambda i: ascii(({0})[i])::BIGINT), "
          "lambda a, b: list_reduce(range(8), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)), xor(a, b)), "
          "4294967295), 4294967295)")

SQL["op13_conversation_trie"] = rf"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    WHERE conv_id IS NOT NULL),
own AS (
    SELECT conv_id, {_CRC32.format('conv_id::VARCHAR')} % 4 AS h,
        list(struct_pack(role := role, text := text)
             ORDER BY turn NULLS FIRST, md5(strlen(role) || ':' || role || text)) AS w
    FROM said GROUP BY conv_id),
rebuilt AS (
    SELECT own.conv_id, list_concat(list_slice(coalesce(base.w, []), 1, own.h), list_slice(own.w, own.h + 1, len(own.w))) AS w
    FROM own LEFT JOIN own base ON base.conv_id = own.conv_id - own.conv_id % 20),
prefixes AS (
    SELECT conv_id, d, list_slice(w, 1, d) AS p, d = len(w) AS is_end FROM rebuilt, unnest(range(0, len(w) + 1)) AS u(d)),
nodes AS (
    SELECT p, min(d) AS d, min(conv_id) AS conv_id, count(*) AS n, (count(*) - 1) * (
            CASE WHEN min(d) = 0 THEN 0 ELSE len(regexp_extract_all(p[-1].text, '[^\x20\x09-\x0D]+')) END) AS saved,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (is_end), '')) AS ends
    FROM prefixes GROUP BY p),
children AS (SELECT list_slice(p, 1, d - 1) AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
sums AS (
    SELECT list_slice(v.p, 1, k) AS p, count(*) FILTER (c.n IS NULL) AS leaves, sum(saved) AS saved
    FROM nodes v LEFT JOIN children c ON c.p = v.p, unnest(range(0, v.d + 1)) AS u(k) GROUP BY ALL)
SELECT v.conv_id, v.d AS depth, up.conv_id AS parent_conv_id, v.n AS n_convs, coalesce(c.n, 0)::BIGINT AS n_children,
    s.leaves AS n_leaves, s.saved::BIGINT AS saved_tokens, v.ends AS ends_sha256
FROM nodes v JOIN sums s ON s.p = v.p LEFT JOIN children c ON c.p = v.p
LEFT JOIN nodes up ON v.d > 0 AND up.p = list_slice(v.p, 1, v.d - 1)
"""
