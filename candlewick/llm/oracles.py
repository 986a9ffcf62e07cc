"""SQL of near-duplicates and of the conversation and vector operators."""

from __future__ import annotations

#: Unsigned crc32 of an ASCII string, by its definition: eight steps a byte.
_CRC32 = """xor(4294967295, list_reduce(list_transform(range(1, length({0}) + 1), lambda i: ascii(substr({0}, i, 1))::BIGINT),
    lambda c, b: list_reduce(range(8), lambda v, i: xor(v >> 1, 3988292384 * (v & 1)), xor(c, b)), 4294967295::BIGINT))"""


def _edit(way: str, cost: str, letter: str, line: str) -> str:
    """SQL of a way with one edit more; null where there is no way."""
    return (
        f"CASE WHEN ({way}).k IS NOT NULL THEN {{'k': lpad((left(({way}).k, 8)::INT + {cost})::VARCHAR, 8, '0') || substr(({way}).k, 9)"
        f" || '{letter}', 'r': ({way}).r || {line}}} END"
    )


def _taken(way: str, letter: str, line: str, when: str = "true") -> str:
    cost = "more" if letter == "K" else "1 + more"
    return f"CASE WHEN whole AND {when} THEN {_edit(way, cost, letter, line)} END"


def _inserted(way: str, role: str) -> str:
    return _edit(way, "5", "I", f"chr(10) || '{role}:'")


def _least(*ways: str) -> str:
    return f"least({', '.join(ways)})"


_NONE = "NULL::STRUCT(k VARCHAR, r VARCHAR)"
_DELETED = [_edit(f"w{i}", "2", "D", "''") for i in range(4)]
PREFIX_TRIE = f"""
        WITH turns AS (
            SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS place,
                sha256(sha256(coalesce(role, '')) || sha256(coalesce(text, ''))) AS step, length(coalesce(text, '')) AS chars
            FROM conversations WHERE conv_id IS NOT NULL),
        convs AS (SELECT conv_id, {_CRC32.format("conv_id::VARCHAR")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM turns)),
        joined AS (
            SELECT c.conv_id, place, step, chars FROM convs c JOIN turns t ON t.conv_id = c.conv_id - c.conv_id % 100 AND place <= h
            UNION ALL SELECT c.conv_id, place, step, chars FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND place > h),
        paths AS (
            SELECT conv_id, list(step ORDER BY place) AS steps, list(chars ORDER BY place) AS chars FROM joined GROUP BY conv_id
            UNION ALL SELECT conv_id, [], [] FROM convs WHERE conv_id NOT IN (SELECT conv_id FROM joined)),
        prefixes AS (
            SELECT conv_id, d, array_to_string(steps[1:d], '') AS node, CASE WHEN d > 0 THEN array_to_string(steps[1:greatest(d - 1, 0)], '') END AS parent,
                CASE WHEN d = 0 THEN 0 ELSE chars[d] END AS chars, d = len(steps) AS ends
            FROM (SELECT *, unnest(range(0, len(steps) + 1)) AS d FROM paths)),
        nodes AS (
            SELECT node, d, parent, chars, count(*) AS n, min(conv_id) AS least,
                coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '') AS ended
            FROM prefixes GROUP BY node, d, parent, chars),
        below AS (SELECT parent, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY parent),
        full_nodes AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN below b ON b.parent = n.node),
        subtrees AS (
            SELECT substr(node, 1, 64 * up) AS top, count(*) FILTER (n_children = 0) AS n_leaves, sum((n - 1) * chars) AS saved
            FROM (SELECT *, unnest(range(0, d + 1)) AS up FROM full_nodes) GROUP BY 1)
        SELECT n.least AS conv_id, n.d AS depth, p.least AS parent_conv_id, n.n AS n_convs, n.n_children, n_leaves,
            CAST(saved AS BIGINT) AS saved_tokens, sha256(n.ended) AS ends_sha256
        FROM full_nodes n JOIN subtrees ON top = n.node LEFT JOIN nodes p ON p.node = n.parent AND n.d > 0"""

REPAIR = f"""
        WITH RECURSIVE r0 AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS tie, coalesce(text, ' ') AS said, md5(coalesce(text, ' ')) AS mark,
                coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
        r1 AS (SELECT *, {_CRC32.format("name")} % 20 AS kind FROM r0),
        damaged AS (
            SELECT conv_id, turn, tie, mark, copy, CASE WHEN kind = 4 THEN 'user' ELSE tie END AS role,
                CASE kind WHEN 1 THEN '' WHEN 2 THEN replace(replace(replace(said, '.', ''), '!', ''), '?', '') ELSE said END AS text
            FROM (SELECT *, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM r1)),
        placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, tie, mark, copy) AS place FROM damaged),
        stripped AS (
            SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare,
                row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) AS seen,
                lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY place) AS prior FROM placed),
        judged AS (
            SELECT *, substr(role, 1, 1) AS initial, CASE WHEN bare = '' THEN 'b' WHEN seen > 1 THEN 'd'
                WHEN right(bare, 1) IN ('.', '!', '?') THEN '' ELSE 't' END AS fault FROM stripped),
        counts AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
                count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
                count(*) FILTER (prior IS NOT NULL AND prior || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
            FROM judged GROUP BY conv_id),
        -- Cheapest way to each state (0 start, 1 system, 2 user, 3 assistant): cost and audit as one text, and what was repaired.
        steps AS (
            SELECT conv_id, 0::BIGINT AS taken, {{'k': '00000000', 'r': ''}} AS w0, {_NONE} AS w1,
                {{'k': '00000005I', 'r': chr(10) || 'user:'}} AS w2, {{'k': '00000010II', 'r': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS w3
            FROM counts
            UNION ALL
            SELECT conv_id, taken, m0, m1, u AS w2, {_least("m3", _inserted("u", "assistant"))} AS w3
            FROM (SELECT *, {_least("m2", _inserted("m0", "user"), _inserted("m1", "user"), _inserted("m3", "user"))} AS u FROM (
                SELECT s.conv_id, j.place AS taken, {_DELETED[0]} AS m0,
                    {_least(_DELETED[1], _taken("w0", "K", "line", "initial = 's'"))} AS m1,
                    {_least(_DELETED[2], *[_taken(w, "R", "as_user") for w in ("w0", "w1", "w3")], *[_taken(w, "K", "line", "initial = 'u'") for w in ("w0", "w1", "w3")])} AS m2,
                    {_least(_DELETED[3], _taken("w2", "R", "as_assistant"), _taken("w2", "K", "line", "initial = 'a'"))} AS m3
                FROM steps s JOIN (
                    SELECT *, fault IN ('', 't') AS whole, CASE fault WHEN 't' THEN 5 ELSE 0 END AS more, chr(10) || role || ':' || text AS line,
                        chr(10) || 'user:' || text AS as_user, chr(10) || 'assistant:' || text AS as_assistant FROM judged
                ) j ON j.conv_id IS NOT DISTINCT FROM s.conv_id AND j.place = s.taken + 1))),
        ends AS (
            SELECT c.*, least(w0, w3) AS way FROM counts c JOIN steps s ON s.conv_id IS NOT DISTINCT FROM c.conv_id AND s.taken = c.n)
        SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
            coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(CAST(left(way.k, 8) AS BIGINT), 0) AS cost,
            coalesce(substr(way.k, 9), '') AS audit, sha256(coalesce(substr(way.r, 2), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM o.conv_id"""

SEARCH = """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, x.vec_id, CAST(list_inner_product(q.v, x.v) AS BIGINT) AS score
            FROM v q JOIN v x ON q.vec_id % 20 = 0 AND x.vec_id <> q.vec_id)
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20"""

NEAR_DUPLICATES = r"""
        WITH RECURSIVE split AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
            FROM documents),
        sets AS (
            SELECT DISTINCT doc_id, array_to_string(words[s:s + 2], ' ') AS shingle
            FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 1) + 1)) AS s FROM split WHERE len(words) > 0)),
        sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY 1),
        common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        links AS (
            SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * c.n >= 85 * (x.n + y.n - c.n)),
        reached AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b),
        least AS (SELECT a, min(b) AS component_id FROM reached GROUP BY a)
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
        FROM documents d JOIN least ON a = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id"""
