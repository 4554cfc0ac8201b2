"""DuckDB SQL of the queries whose whole result SQL can express: by joins of all windows,
by window functions over whole payloads, and by all ancestors of all nodes, where the operators
use automata, archives and tree contraction."""

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP7 = """
WITH payloads AS (
    SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS hex FROM pages
),
ranked AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS original FROM payloads)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((CAST('0x' || substr(hex, CAST(1 + 5 * (i // 4) AS INTEGER), 5) AS INTEGER)
                 >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31), 1) FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> original THEN original END AS refers_to
FROM ranked"""

OP8 = f"""
WITH items AS (SELECT DISTINCT item_id, {_WORDS.format('text')} AS ws FROM benchmark WHERE text IS NOT NULL),
windows AS (
    SELECT DISTINCT item_id, least(len(ws), 10) AS n,
           array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS w
    FROM (SELECT *, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM items WHERE len(ws) > 0)
),
sizes AS (SELECT DISTINCT n FROM windows),
docs AS (
    SELECT row_number() OVER () AS r, doc_id, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents
),
places AS (
    SELECT r, n, i, array_to_string(ws[i:i + n - 1], ' ') AS w
    FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM docs, sizes WHERE len(ws) >= n)
),
hits AS (SELECT r, p.n, i, item_id FROM places p JOIN windows v ON p.w = v.w AND p.n = v.n),
words AS (
    SELECT r, count(DISTINCT spot) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS spot FROM hits) GROUP BY r
),
found AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN found USING (r)"""

# crc32 bit by bit, of a text of ASCII characters.
_CRC32 = """xor(4294967295, list_reduce(
    [4294967295::BIGINT] || list_transform(string_split({0}, ''), lambda x: ascii(x)::BIGINT),
    lambda a, b: list_reduce([xor(a, b)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0],
                             lambda y, z: xor(y >> 1, (y & 1) * 3988292384))))"""

OP11 = f"""
WITH said AS (
    SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS x
    FROM conversations WHERE conv_id IS NOT NULL
),
turns AS (
    SELECT c, r, x, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, sha256(strlen(r) || ':' || r || x)) - 1 AS pos
    FROM said
),
convs AS (SELECT DISTINCT c, {_CRC32.format("CAST(c AS VARCHAR)")} % 4 AS h FROM turns),
joined AS (
    SELECT v.c, 0 AS part, pos, r, x FROM convs v JOIN turns t ON t.c = v.c - v.c % 20 AND pos < h
    UNION ALL SELECT v.c, 1, pos, r, x FROM convs v JOIN turns t ON t.c = v.c AND pos >= h
),
steps AS (
    SELECT c, row_number() OVER w AS d, len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+')) AS words,
           string_agg(strlen(r) || ':' || strlen(x) || ':' || r || x, '') OVER w AS k
    FROM joined WINDOW w AS (PARTITION BY c ORDER BY part, pos)
    UNION ALL SELECT c, 0, 0, '' FROM convs
),
lengths AS (SELECT c, max(d) AS n FROM steps GROUP BY c),
nodes AS (
    SELECT d, k, min(c) AS conv_id, count(*) AS n_convs, min(words) AS words,
           string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE d = n) AS ends
    FROM steps JOIN lengths USING (c) GROUP BY d, k
),
ups AS (
    SELECT v.*, s.conv_id AS parent_conv_id
    FROM nodes v LEFT JOIN steps p ON p.c = v.conv_id AND p.d = v.d - 1 LEFT JOIN nodes s ON s.d = p.d AND s.k = p.k
),
kids AS (SELECT parent_conv_id AS conv_id, d - 1 AS d, count(*) AS n_children FROM ups WHERE d > 0 GROUP BY ALL),
full_ AS (SELECT u.*, coalesce(n_children, 0) AS n_children FROM ups u LEFT JOIN kids USING (conv_id, d)),
totals AS (
    SELECT a.d, a.k, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * f.words) AS saved
    FROM full_ f JOIN steps a ON a.c = f.conv_id AND a.d <= f.d GROUP BY a.d, a.k
)
SELECT conv_id, CAST(d AS BIGINT) AS depth, parent_conv_id, CAST(n_convs AS BIGINT) AS n_convs,
       CAST(n_children AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
FROM full_ JOIN totals USING (d, k)"""

# The given pages mark their articles and hold no other content.
OP12 = r"""
WITH marked AS (
    SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*?)(</article>|$)', 1, 's') AS inside FROM pages
),
plain AS (
    SELECT page_id, url, replace(regexp_replace(replace(
        regexp_replace(regexp_replace(inside, '</?b>', '', 'g'), '<[^>]*>', ' ', 'g'), '&quot;', '"'),
        '&amp;?', '&', 'g'), chr(160), ' ') AS t FROM marked
),
trimmed AS (SELECT page_id, url, trim(regexp_replace(t, '\s+', ' ', 'g')) AS text FROM plain)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM trimmed"""

ORACLE = {"op7_warc": OP7, "op8_decontaminate": OP8, "op11_prefix_trie": OP11, "op12_html_extract": OP12}
