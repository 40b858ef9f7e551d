"""SQL twins of the queries that SQL can express."""

from __future__ import annotations

SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINE_DEDUP = f"""
WITH split AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents
),
keyed AS (
    SELECT doc_id, pos, line,
           translate(trim(line, {SPACE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz') AS key
    FROM split
),
repeated AS (
    SELECT key, max(doc_id) AS keeper
    FROM keyed WHERE length(key) >= 40
    GROUP BY key HAVING count(DISTINCT doc_id) >= 5
),
marked AS (
    SELECT k.doc_id, k.pos, k.line, r.key IS NOT NULL AND k.doc_id < r.keeper AS gone
    FROM keyed k LEFT JOIN repeated r USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), ''))
           AS kept_sha256
FROM marked GROUP BY doc_id
"""

QUALITY_RULES = f"""
WITH base AS (
    SELECT doc_id, source, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
    FROM documents
),
windows AS (
    SELECT doc_id, i, words[i:i + 7] AS w
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM base
          WHERE len(words) >= 8)
),
repeats AS (
    SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS following
    FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows)
    WHERE n > 1
),
covered AS (
    SELECT doc_id, sum(least(8, coalesce(following - i, 8))) AS n FROM repeats GROUP BY doc_id
),
lines AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS n
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM base)
    WHERE trim(line, {SPACE}) <> '' GROUP BY doc_id
),
measures AS (
    SELECT b.doc_id, b.source, len(b.words) AS n_words,
           length(array_to_string(b.words, '')) AS word_chars,
           length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols,
           coalesce(l.n, 0) AS n_dup_lines,
           CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
    FROM base b LEFT JOIN covered c USING (doc_id) LEFT JOIN lines l USING (doc_id)
),
judged AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measures
),
hosts AS (
    SELECT source, count(*) AS n, count(*) FILTER (WHERE base_failed) AS failed,
           count(*) FILTER (WHERE base_failed) / count(*) AS rate
    FROM judged WHERE source IS NOT NULL GROUP BY source
),
moments AS (
    SELECT avg(rate) AS mean, coalesce(var_samp(rate), 0) AS variance, avg(1 / n) AS noise
    FROM hosts
),
prior AS (
    SELECT mean, CASE WHEN noise < 1
                      THEN (variance - mean * (1 - mean) * noise) / (1 - noise) ELSE 0 END AS between_hosts
    FROM moments
),
posterior AS (
    SELECT source, n, mean, strength, (failed + mean * strength) / (n + strength) AS rate
    FROM hosts,
         (SELECT mean, greatest(mean * (1 - mean) / between_hosts - 1, 0) AS strength
          FROM prior WHERE between_hosts > 1e-12)
),
rejected AS (
    SELECT source FROM posterior
    WHERE rate - 3 * sqrt(rate * (1 - rate) / (n + strength + 1)) > greatest(0.5, mean)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND r.source IS NULL AS kept
FROM judged j LEFT JOIN rejected r ON j.source = r.source
"""

CHAT_FORMATTING = r"""
WITH rows AS (
    SELECT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role,
           coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
escaped AS (
    SELECT *,
           replace(replace(replace(replace(text, '\', '\\'), '[INST', '\[INST'),
                   '[/INST', '\[/INST'), '</s>', '\</s>') AS plain,
           replace(replace(replace(replace(replace(role, '\', '\\'), '[INST', '\[INST'),
                   '[/INST', '\[/INST'), '</s>', '\</s>'), ']', '\]') AS named
    FROM rows
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT)
           AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), ''))
           AS loss_sha256,
       CAST(sum(length('[INST ' || named || ']' || plain || '</s>')) AS BIGINT)
           AS formatted_chars
FROM escaped GROUP BY conv_id
"""

WARC = """
WITH sized AS (
    SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages
),
judged AS (
    SELECT page_id, n, sha1(html) AS digest,
           CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY html) END AS newest
    FROM sized
)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id < newest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < newest THEN newest END AS refers_to
FROM judged
"""

def _crc32(text: str) -> str:
    """SQL for the unsigned crc32 of an ASCII or Latin-1 supplement text, bit by bit.

    3988292384 is the reflected polynomial. Every byte is a list of its value and seven zeros.
    """
    points = f"list_transform(string_split({text}, ''), lambda c: unicode(c))"
    octets = (
        f"flatten(list_transform({points}, lambda u: CASE WHEN u < 128 THEN [u] "
        "ELSE [192 + (u >> 6), 128 + (u & 63)] END))"
    )
    bits = f"flatten(list_transform({octets}, lambda b: [b::BIGINT, 0, 0, 0, 0, 0, 0, 0]))"
    step = "lambda a, x: xor(xor(a, x) >> 1, (xor(a, x) & 1) * 3988292384)"
    return f"xor(list_reduce({bits}, {step}, 4294967295::BIGINT), 4294967295)"


PREFIX_TRIE = f"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos
    FROM conversations
),
convs AS (
    SELECT conv_id, conv_id - conv_id % 5 AS first, {_crc32("conv_id::VARCHAR")} % 9 AS h
    FROM (SELECT DISTINCT conv_id FROM conversations)
),
rebuilt AS (
    SELECT c.conv_id, 0 AS part, t.pos, t.role, t.text
    FROM convs c JOIN turns t ON t.conv_id = c.first AND t.pos < c.h
    UNION ALL
    SELECT c.conv_id, 1, t.pos, t.role, t.text
    FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos >= c.h
),
prefixes AS (
    SELECT conv_id, strlen(text) AS size,
           list({{'role': role, 'text': text}}) OVER (
               PARTITION BY conv_id ORDER BY part, pos
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS path
    FROM rebuilt
    UNION ALL
    SELECT conv_id, 0, [] FROM convs
),
ending AS (
    SELECT conv_id, max(len(path)) AS depth FROM prefixes GROUP BY conv_id
),
nodes AS (
    SELECT path, len(path) AS depth, min(p.conv_id) AS conv_id, count(*) AS n_convs,
           (count(*) - 1) * max(size) AS gain,
           string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id)
               FILTER (WHERE e.depth = len(path)) AS ends
    FROM prefixes p JOIN ending e ON p.conv_id = e.conv_id
    GROUP BY path
),
children AS (
    SELECT path[:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1
),
above AS (
    SELECT n.path[:k] AS path, n.gain, c.n IS NULL AS is_leaf
    FROM nodes n LEFT JOIN children c ON n.path = c.path, unnest(range(0, n.depth + 1)) AS u(k)
),
below AS (
    SELECT path, count(*) FILTER (WHERE is_leaf) AS n_leaves, sum(gain) AS saved_tokens
    FROM above GROUP BY path
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs,
       coalesce(c.n, 0)::BIGINT AS n_children, b.n_leaves, b.saved_tokens::BIGINT AS saved_tokens,
       sha256(coalesce(n.ends, '')) AS ends_sha256
FROM nodes n JOIN below b ON n.path = b.path
LEFT JOIN children c ON n.path = c.path
LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[:n.depth - 1]
"""

SPELLING = f"""
WITH RECURSIVE runs AS (
    SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run
    FROM documents
),
lowered AS (
    SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w,
           count(*) AS n
    FROM runs GROUP BY ALL
),
marked AS (
    SELECT w, n, {_crc32("concat(doc_id, ':', w)")} AS h FROM lowered WHERE length(w) >= 5
),
spelled AS (
    SELECT CASE WHEN h % 97 = 0
                THEN left(w, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2)
                ELSE w END AS word, n
    FROM marked
),
words AS MATERIALIZED (
    SELECT word, sum(n)::BIGINT AS n FROM spelled
    WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
),
places AS MATERIALIZED (
    SELECT word, n, left(word, i - 1) AS head, substr(word, i + 1) AS tail
    FROM words, unnest(range(1, length(word) + 1)) AS u(i)
),
replaced AS (
    SELECT a.word, b.word AS other, b.n
    FROM places a JOIN places b ON a.head = b.head AND a.tail = b.tail AND a.word <> b.word
),
shorter AS (
    SELECT DISTINCT p.word, p.n, w.word AS other, w.n AS other_n
    FROM places p JOIN words w ON w.word = p.head || p.tail
),
near AS (
    SELECT word, other, n FROM replaced
    UNION SELECT word, other, other_n FROM shorter
    UNION SELECT other, word, n FROM shorter
),
best AS (
    SELECT word, count(*) AS n_near, min({{'minus': -n, 'other': other}}) AS top
    FROM near GROUP BY word
),
formed AS MATERIALIZED (
    SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
           CASE WHEN -b.top.minus >= 2 * w.n THEN b.top.other END AS form,
           CASE WHEN -b.top.minus >= 2 * w.n THEN -b.top.minus END AS form_n
    FROM words w LEFT JOIN best b USING (word)
),
chain AS (
    SELECT word, word AS root FROM formed
    UNION
    SELECT c.word, f.form FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL
),
ends AS (
    SELECT c.word, c.root FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)
"""

ORACLE = {
    "op1_line_dedup": LINE_DEDUP,
    "op4_chat_formatting": CHAT_FORMATTING,
    "op6_warc": WARC,
    "op10_quality_rules": QUALITY_RULES,
    "op12_prefix_trie": PREFIX_TRIE,
    "op13_spelling_variants": SPELLING,
}
