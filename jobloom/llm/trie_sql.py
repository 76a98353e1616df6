"""The prefix trie of the rebuilt conversations as SQL: paths joined with their ancestors, for small tables."""

SQL = """
WITH RECURSIVE turns AS (
    SELECT conv_id, md5(coalesce(role, '')) || md5(coalesce(text, '')) AS said, strlen(coalesce(text, '')) AS bytes,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place
    FROM conversations WHERE conv_id IS NOT NULL
),
-- The usual CRC-32 of the decimal digits, bit by bit.
crc AS (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS digits, 0 AS done, 4294967295::BIGINT AS value FROM conversations WHERE conv_id IS NOT NULL
    UNION ALL
    SELECT conv_id, digits, done + 1,
        list_reduce([xor(value, ascii(digits[done + 1])::BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
            lambda x, y: xor(x >> 1, 3988292384::BIGINT * (x & 1))) AS value
    FROM crc WHERE done < length(digits)
),
convs AS (
    SELECT conv_id, conv_id - conv_id % 5 AS base, xor(value, 4294967295::BIGINT) % 9 AS h FROM crc WHERE done = length(digits)
),
begun AS (
    SELECT c.conv_id, t.place AS depth, t.said, t.bytes FROM convs c JOIN turns t ON t.conv_id = c.base AND t.place <= c.h
),
taken AS (SELECT c.conv_id, c.h, count(b.depth) AS n FROM convs c LEFT JOIN begun b USING (conv_id) GROUP BY ALL),
rebuilt AS (
    FROM begun
    UNION ALL
    SELECT t.conv_id, k.n + t.place - k.h, t.said, t.bytes FROM turns t JOIN taken k ON t.conv_id = k.conv_id AND t.place > k.h
    UNION ALL
    SELECT conv_id, 0, '', 0 FROM convs
),
paths AS (
    SELECT conv_id, depth, bytes, md5(string_agg(said, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS node,
        max(depth) OVER (PARTITION BY conv_id) AS size
    FROM rebuilt
),
linked AS (SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY depth) AS parent FROM paths),
nodes AS (
    SELECT depth, node, any_value(parent) AS parent, any_value(bytes) AS bytes, count(*) AS n_convs, min(conv_id) AS conv_id,
        coalesce(string_agg(CASE WHEN size = depth THEN conv_id END, ',' ORDER BY conv_id), '') AS ends
    FROM linked GROUP BY depth, node
),
children AS (SELECT depth - 1 AS depth, parent AS node, count(*) AS n_children FROM nodes GROUP BY ALL),
counted AS (SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM nodes n LEFT JOIN children c USING (depth, node)),
below AS (  -- each node beside all on the path of one of its members down to it
    SELECT a.depth, a.node, count(*) FILTER (c.n_children = 0) AS n_leaves, sum((c.n_convs - 1) * c.bytes)::BIGINT AS saved_tokens
    FROM counted c JOIN paths a ON a.conv_id = c.conv_id AND a.depth <= c.depth GROUP BY ALL
)
SELECT c.conv_id, c.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, b.n_leaves, b.saved_tokens, sha256(c.ends) AS ends_sha256
FROM counted c JOIN below b USING (depth, node) LEFT JOIN nodes p ON p.depth = c.depth - 1 AND p.node = c.parent
"""
