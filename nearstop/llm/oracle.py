"""DuckDB SQL for the queries of this folder that SQL can express."""

from __future__ import annotations

OP4 = """
WITH page AS (
    SELECT page_id, url, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages
), best AS (
    SELECT payload, max(page_id) AS best_id FROM page GROUP BY payload
)
SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i: substr(
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST(
               '0x' || substr(hex, CAST(i // 8 * 10 + 1 AS INTEGER), 10) AS BIGINT
           ) >> CAST(35 - 5 * (i % 8) AS INTEGER)) & 31 AS INTEGER), 1)), 'string_agg', '')
       AS payload_digest,
       CASE WHEN page_id = best_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> best_id THEN best_id END AS refers_to, url
FROM page JOIN best USING (payload)
"""

OP11 = r"""
WITH piece AS (
    SELECT lang, list_filter(regexp_split_to_array(part, '[\x20\x09]+'), lambda w: w <> '') AS words
    FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(
            coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'
        ), '[.,;:!?\x0A-\x0D]')) AS part FROM documents
    )
), start AS (
    SELECT lang, words, unnest(range(1, len(words) + 1)) AS pos FROM piece
), found AS (
    SELECT lang, array_to_string(words[pos:pos + size - 1], ' ') AS phrase, size, count(*) AS f
    FROM start, range(1, 6) AS sizes(size) WHERE pos + size - 1 <= len(words) GROUP BY ALL
), total AS (
    SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM found WHERE size = 1 GROUP BY lang
), often AS (
    SELECT lang, phrase, size, f, string_split(phrase, ' ') AS words FROM found WHERE f >= 100
), covered AS (
    SELECT DISTINCT long.lang, array_to_string(long.words[pos:pos + part - 1], ' ') AS phrase, f
    FROM often AS long, range(2, 5) AS parts(part), range(1, 5) AS places(pos)
    WHERE part < size AND pos + part - 1 <= size
), cut AS (
    SELECT c.lang, c.phrase, c.f AS a, k, l.f AS l, r.f AS r, n,
           CAST(1000::HUGEINT * c.f * n // (l.f::HUGEINT * r.f) AS BIGINT) AS score
    FROM often AS c, range(1, 5) AS cuts(k), often AS l, often AS r, total AS t
    WHERE k < c.size AND t.lang = c.lang
      AND l.lang = c.lang AND l.phrase = array_to_string(c.words[1:k], ' ')
      AND r.lang = c.lang AND r.phrase = array_to_string(c.words[k + 1:], ' ')
      AND NOT EXISTS (SELECT 1 FROM covered AS v
                      WHERE v.lang = c.lang AND v.phrase = c.phrase AND v.f >= c.f)
), worst AS (
    SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM worst QUALIFY rank <= 2000
"""

OP12 = r"""
WITH doc AS (
    SELECT doc_id, length(coalesce(text, '')) AS chars,
           regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
    FROM documents
)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY body)
       AS group_size, row_number() OVER best = 1 AS kept, sha256(body) AS text_sha256
FROM doc WINDOW best AS (PARTITION BY body ORDER BY chars DESC, doc_id NULLS LAST)
"""

OP13 = """
WITH turn AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
    FROM conversations WHERE conv_id IS NOT NULL
), conv AS (
    SELECT conv_id, conv_id - conv_id % 100 AS donor, xor(4294967295, list_reduce(list_prepend(
        4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: ascii(c))
    ), lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
        lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) % 6 AS lead
    FROM (SELECT DISTINCT conv_id FROM turn)
), rebuilt AS (
    SELECT c.conv_id, 1 AS part, place, role, text
    FROM conv AS c JOIN turn AS t ON t.conv_id = c.conv_id WHERE place > lead
    UNION ALL
    SELECT c.conv_id, 0 AS part, place, role, text
    FROM conv AS c JOIN turn AS t ON t.conv_id = c.donor WHERE place <= lead
), path AS (
    SELECT conv_id, coalesce(turns, []) AS turns FROM conv LEFT JOIN (
        SELECT conv_id, list({'role': role, 'text': text} ORDER BY part, place) AS turns
        FROM rebuilt GROUP BY conv_id
    ) USING (conv_id)
), prefix AS (
    SELECT conv_id, len(turns) AS size, depth, list_slice(turns, 1, depth) AS key
    FROM path, range(0, (SELECT max(len(turns)) FROM path) + 1) AS depths(depth)
    WHERE depth <= len(turns)
), node AS (
    SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
                           FILTER (WHERE size = depth), '')) AS ends_sha256
    FROM prefix GROUP BY key, depth
), child AS (
    SELECT list_slice(key, 1, depth - 1) AS key, count(*) AS n_children
    FROM node WHERE depth > 0 GROUP BY ALL
), counted AS (
    SELECT n.*, coalesce(n_children, 0) AS n_children,
           (n_convs - 1) * coalesce(length(n.key[depth].text), 0) AS saved
    FROM node AS n LEFT JOIN child USING (key)
), total AS (
    SELECT list_slice(key, 1, above) AS key, count_if(n_children = 0) AS n_leaves,
           sum(saved) AS saved_tokens
    FROM counted, range(0, (SELECT max(depth) FROM node) + 1) AS depths(above)
    WHERE above <= depth GROUP BY ALL
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens,
       n.ends_sha256
FROM counted AS n JOIN total USING (key)
LEFT JOIN node AS p ON n.depth > 0 AND p.key = list_slice(n.key, 1, n.depth - 1)
"""

ORACLE = {
    "op4_warc_archive": OP4, "op11_collocations": OP11, "op12_exact_dedup": OP12,
    "op13_prefix_trie": OP13,
}
