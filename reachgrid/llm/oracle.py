"""SQL for the results that SQL can express."""

PREFIX_TRIE = r"""
WITH own AS (
    SELECT conv_id,
           list(md5(length(role) || ':' || role || ':' || text) ORDER BY turn NULLS FIRST, role, md5(text)) AS ids,
           list(length(text) ORDER BY turn NULLS FIRST, role, md5(text)) AS chars
    FROM (SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations)
    WHERE conv_id IS NOT NULL
    GROUP BY conv_id
),
-- CRC-32 of the decimal digits, bit by bit; -1 stands for a shift
hashed AS (
    SELECT *, xor(4294967295, list_reduce(
        list_prepend(4294967295, flatten(list_transform(
            string_split(CAST(conv_id AS VARCHAR), ''),
            lambda c: list_concat([CAST(ascii(c) AS BIGINT)], list_resize(CAST([] AS BIGINT[]), 8, -1))))),
        lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, (c & 1) * 3988292384) END)) % 6 AS h
    FROM own
),
rebuilt AS (
    SELECT c.conv_id,
           list_concat(COALESCE(b.ids[1:c.h], []), c.ids[c.h + 1:]) AS ids,
           list_concat(COALESCE(b.chars[1:c.h], []), c.chars[c.h + 1:]) AS chars
    FROM hashed c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100
),
prefixes AS (
    SELECT conv_id, d, array_to_string(ids[1:d], '') AS node,
           CASE WHEN d > 0 THEN array_to_string(ids[1:d - 1], '') END AS parent,
           CASE WHEN d > 0 THEN chars[d] ELSE 0 END AS chars, len(ids) = d AS ends
    FROM rebuilt, unnest(range(0, len(ids) + 1)) AS u(d)
),
nodes AS (
    SELECT node, MIN(d) AS depth, ANY_VALUE(parent) AS parent, MIN(conv_id) AS conv_id,
           COUNT(*) AS n_convs, ANY_VALUE(chars) AS chars,
           string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends) AS ends
    FROM prefixes GROUP BY node
),
children AS (SELECT parent AS node, COUNT(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY parent),
counted AS (
    SELECT n.*, COALESCE(c.n_children, 0) AS n_children FROM nodes n LEFT JOIN children c USING (node)
),
subtrees AS (
    SELECT substr(node, 1, 32 * up) AS node, SUM(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
           SUM((n_convs - 1) * chars) AS saved_tokens
    FROM counted, unnest(range(0, depth + 1)) AS u(up) GROUP BY 1
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children,
       CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens,
       sha256(COALESCE(n.ends, '')) AS ends_sha256
FROM counted n JOIN subtrees s USING (node) LEFT JOIN nodes p ON p.node = n.parent
"""

SOURCE_MIX = r"""
WITH docs AS (
    SELECT doc_id, source, md5(COALESCE(CAST(doc_id AS VARCHAR), '')) AS place,
           COALESCE(len(list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '')), 0) AS size
    FROM documents
),
sources AS (
    SELECT source, CAST(SUM(size) AS BIGINT) AS source_size,
           [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
    FROM docs GROUP BY source
),
levels AS (
    SELECT s.*, 1.5::DOUBLE * (SELECT SUM(source_size) FROM sources) AS budget,
           (SELECT SUM(LEAST(2.0::DOUBLE * o.source_size, o.weight * (2.0::DOUBLE * s.source_size / s.weight)))
            FROM sources o) <= 1.5::DOUBLE * (SELECT SUM(source_size) FROM sources) AS used_up
    FROM sources s
),
goals AS (
    SELECT source, source_size, weight, CASE WHEN used_up THEN CAST(2 * source_size AS DOUBLE) ELSE
        weight * CAST(budget - COALESCE((SELECT SUM(2 * source_size) FROM levels WHERE used_up), 0) AS DOUBLE)
            / CAST((SELECT SUM(weight) FROM levels WHERE NOT used_up) AS DOUBLE) END AS target
    FROM levels
),
queued AS (
    SELECT d.doc_id, d.source, d.place, d.size, g.source_size, g.weight, g.target, pass,
           pass * g.source_size + SUM(d.size) OVER (
               PARTITION BY d.source, pass ORDER BY d.place, d.doc_id, d.size
               ROWS UNBOUNDED PRECEDING) - d.size AS before
    FROM docs d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source, unnest([0, 1]) AS u(pass)
),
timed AS (
    SELECT *, (before + size) / weight AS finish,
           CAST(GREATEST(0, LEAST(size, floor(target) - before)) AS BIGINT) AS taken
    FROM queued
),
placed AS (
    SELECT *, SUM(taken) OVER (
        ORDER BY finish, source NULLS LAST, pass, place, doc_id, size ROWS UNBOUNDED PRECEDING) - taken AS position
    FROM timed
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(SUM(taken) AS BIGINT) AS taken,
       CAST(MIN(position) FILTER (WHERE taken > 0) AS BIGINT) AS position
FROM placed GROUP BY doc_id, source, size, source_size, target
"""

WARC = r"""
WITH payloads AS (
    SELECT page_id, COALESCE(html, '') AS payload FROM pages
),
hashed AS (
    SELECT page_id, payload, octet_length(encode(payload)) AS payload_bytes,
           array_to_string(list_transform(string_split(sha1(payload), ''),
               lambda h: substr('0000000100100011010001010110011110001001101010111100110111101111',
                           4 * instr('0123456789abcdef', h) - 3, 4)), '') AS bits
    FROM payloads
),
spelled AS (
    SELECT *, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               1 + list_reduce(list_transform(range(1, 6), lambda k: CAST(substr(bits, CAST(5 * i + k AS INT), 1) AS INT)),
                               lambda a, b: 2 * a + b), 1)), '') AS payload_digest,
           MIN(page_id) OVER (PARTITION BY payload) AS first
    FROM hashed
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM spelled
"""

QUALITY_RULES = r"""
WITH docs AS (
    SELECT doc_id, source, COALESCE(text, '') AS text,
           list_filter(regexp_split_to_array(COALESCE(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
           list_filter(string_split(COALESCE(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS full_lines
    FROM documents
),
windows AS (
    SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS win
    FROM docs, unnest(range(1, len(words) - 6)) AS u(i)
),
again AS (SELECT doc_id, i FROM windows QUALIFY COUNT(*) OVER (PARTITION BY doc_id, win) > 1),
repeats AS (
    SELECT doc_id, COUNT(DISTINCT place) AS n_repeat_words
    FROM again, unnest(range(i, i + 8)) AS u(place) GROUP BY doc_id
),
measured AS (
    SELECT doc_id, source, text, CAST(len(words) AS BIGINT) AS n_words,
           CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
           CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(len(full_lines) - len(list_distinct(full_lines)) AS BIGINT) AS n_dup_lines,
           COALESCE(n_repeat_words, 0) AS n_repeat_words
    FROM docs LEFT JOIN repeats USING (doc_id)
),
line_words AS (
    SELECT doc_id, source, list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
    FROM docs, unnest(string_split(lower(text), chr(10))) AS u(line)
),
lines AS (SELECT doc_id, source, array_to_string(words, ' ') AS line, len(words) AS n FROM line_words WHERE len(words) > 0),
contents AS (
    SELECT d.doc_id, d.source, COALESCE(l.content, []) AS content FROM docs d LEFT JOIN
        (SELECT doc_id, list_sort(list_distinct(list(line))) AS content FROM lines GROUP BY doc_id) l USING (doc_id)
),
distinct_contents AS (SELECT DISTINCT source, content FROM contents),
pieces AS (SELECT source, content, line FROM distinct_contents, unnest(content) AS u(line)),
often AS (SELECT source, line FROM pieces GROUP BY source, line HAVING COUNT(*) > 10),
told AS (
    SELECT p.source, p.content, list_sort(COALESCE(list(p.line) FILTER (WHERE o.line IS NULL), [])) AS document
    FROM pieces p LEFT JOIN often o ON o.source IS NOT DISTINCT FROM p.source AND o.line = p.line
    GROUP BY p.source, p.content
    UNION ALL SELECT source, content, content FROM distinct_contents WHERE len(content) = 0
),
sizes AS (SELECT source, COUNT(DISTINCT document) AS n_docs FROM told GROUP BY source),
held AS (SELECT source, line, COUNT(DISTINCT document) AS n FROM told, unnest(content) AS u(line) GROUP BY source, line),
gone AS (
    SELECT h.source, h.line FROM held h JOIN sizes s ON h.source IS NOT DISTINCT FROM s.source
    WHERE h.n > 10 AND h.n > 0.05 * s.n_docs
),
lost AS (
    SELECT l.doc_id, SUM(l.n) AS lost FROM lines l JOIN gone g
        ON l.source IS NOT DISTINCT FROM g.source AND l.line = g.line GROUP BY l.doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
           AND n_words - COALESCE(lost, 0) >= 20 AND n_words - COALESCE(lost, 0) >= 0.5 * n_words AS kept
FROM measured LEFT JOIN lost USING (doc_id)
"""

ORACLE: dict[str, str] = {
    "op6_warc": WARC,
    "op9_quality_rules": QUALITY_RULES,
    "op12_prefix_trie": PREFIX_TRIE,
    "op13_source_mix": SOURCE_MIX,
}
