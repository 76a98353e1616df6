"""The quality query in the SQL of DuckDB, with its own patterns and its own words."""

# Fixed values, as in the operator: frequent words of English, German, French and Spanish.
COMMON = """the of and to in a is that for it as was with be by on not he his are
der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch
de la le et les du une un est que dans qui par pour au sur pas plus avec ce
el y los se del las por con para su al lo como más pero sus no una o este"""
_WORDS = ", ".join(f"'{w}'" for w in COMMON.split())
_KINDS = ("[^a-z]", "[^A-Z]", r"[a-zA-Z]|\P{L}", "[^0-9]", r"[^\x20\t\n\x0b\x0c\r]", "[^-.,;:!?''" + '"()]', "[^#*$%&|<>]")
_COUNTS = ", ".join(f"length(regexp_replace(t, '{k}', '', 'g'))" for k in _KINDS)
_PART = "(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2"

SQL = f"""WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(lang, chr(0)) AS lang, coalesce(text, '') AS t FROM documents),
words AS (SELECT r, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM (
    SELECT r, list_filter(string_split_regex(t, '[\\x20\\t\\n\\x0b\\x0c\\r]+'), lambda x: x <> '') AS ws FROM docs)),
windows AS (SELECT r, i, w, lead(w) OVER o AS w1, lead(w, 2) OVER o AS w2 FROM words WINDOW o AS (PARTITION BY r ORDER BY i)),
again AS (SELECT r, i FROM windows WHERE w2 IS NOT NULL QUALIFY count(*) OVER (PARTITION BY r, w, w1, w2) > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM again, (VALUES (0), (1), (2)) v(k) GROUP BY r),
lines AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM docs)
    WHERE regexp_matches(line, '[^\\x20\\t\\n\\x0b\\x0c\\r]') GROUP BY r),
sizes AS (SELECT r, count(*) AS n, sum(length(w)) AS chars FROM words GROUP BY r),
base AS (SELECT d.r, doc_id, lang, t, coalesce(s.n, 0) AS n_words, coalesce(s.chars, 0) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(l.n, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
    FROM docs d LEFT JOIN sizes s USING (r) LEFT JOIN lines l USING (r) LEFT JOIN covered c USING (r)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base),
counted AS (SELECT r, lang, base_failed, length(t) AS n, [{_COUNTS}] AS kinds FROM judged WHERE t <> ''),
classes AS (SELECT r, lang, base_failed, unnest(list_append(kinds, greatest(n - list_sum(kinds), 0))) / n AS p,
    unnest(range(len(kinds) + 1)) AS k FROM counted),
class_means AS (SELECT lang, k, avg(p) AS q FROM classes WHERE NOT base_failed GROUP BY lang, k),
class_far AS (SELECT r, sqrt(greatest(sum({_PART}), 0)) AS far FROM classes JOIN class_means USING (lang, k) GROUP BY r),
plain AS (SELECT r, lang, base_failed, lower(unnest(regexp_extract_all(t, '\\p{{L}}+'))) AS w FROM judged),
bins AS (SELECT r, lang, base_failed, CASE WHEN w IN ({_WORDS}) THEN w ELSE '' END AS w, count(*) AS n FROM plain GROUP BY ALL),
shares AS (SELECT r, lang, base_failed, w, n / sum(n) OVER (PARTITION BY r) AS p FROM bins),
speaking AS (SELECT lang, count(DISTINCT r) AS n FROM plain WHERE NOT base_failed GROUP BY lang),
word_means AS (SELECT lang, w, sum(p) / any_value(speaking.n) AS q FROM shares JOIN speaking USING (lang) WHERE NOT base_failed GROUP BY lang, w),
spoken AS (SELECT DISTINCT r, lang FROM plain),
both_sides AS (SELECT spoken.r, coalesce(shares.p, 0) AS p, word_means.q FROM spoken JOIN word_means USING (lang)
    LEFT JOIN shares ON shares.r = spoken.r AND shares.w = word_means.w
    UNION ALL SELECT shares.r, shares.p, 0 FROM shares JOIN speaking USING (lang) LEFT JOIN word_means USING (lang, w) WHERE word_means.q IS NULL),
word_far AS (SELECT r, sqrt(greatest(sum({_PART}), 0)) AS far FROM both_sides GROUP BY r),
stepped AS (SELECT r, floor(far * 1000) AS steps FROM word_far),
sized AS (SELECT *, list_count(list_filter([75, 100, 150, 250, 500, 1000], lambda x: n_words >= x)) AS size FROM judged LEFT JOIN stepped USING (r)),
spread AS (SELECT lang, size, steps, sum(count(*)) OVER (PARTITION BY lang, size ORDER BY steps) AS up_to,
    sum(count(*)) OVER (PARTITION BY lang, size) AS n FROM sized WHERE NOT base_failed AND steps IS NOT NULL GROUP BY lang, size, steps),
limits AS (SELECT lang, size, 4 * min(steps) FILTER (up_to * 2 >= n) - 3 * min(steps) FILTER (up_to * 10 >= n) + 10 AS most FROM spread GROUP BY lang, size)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
    CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
    NOT base_failed AND (n_words < 50 OR coalesce(class_far.far <= 0.30, true)) AND (n_words < 50 OR coalesce(steps <= most, true)) AS kept
FROM sized LEFT JOIN class_far USING (r) LEFT JOIN limits USING (lang, size)"""
