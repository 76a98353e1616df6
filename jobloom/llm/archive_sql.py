"""What the archives of all pages hold, as SQL: digests, and which record has the payload."""

SQL = """
WITH hashed AS (
    SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages
),
-- Five hexadecimal digits are twenty bits, which are four characters of base 32.
digested AS (
    SELECT page_id, strlen(payload) AS payload_bytes, list_aggregate(list_transform(range(8), lambda i:
        list_aggregate(list_transform([32768, 1024, 32, 1], lambda d: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            ((('0x' || substr(hex, i * 5 + 1, 5))::INTEGER // d) % 32 + 1)::INTEGER, 1)), 'string_agg', '')), 'string_agg', '') AS payload_digest
    FROM hashed
),
first AS (SELECT payload_digest, min(page_id) AS original FROM digested GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> original THEN original END AS refers_to
FROM digested JOIN first USING (payload_digest)
"""
