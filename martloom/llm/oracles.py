"""SQL that must give the same rows as the registered text queries."""

from __future__ import annotations

_NORMAL = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"

EXACT_DEDUP = f"""
SELECT doc_id,
       first_value(doc_id) OVER own AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER own = 1 AS kept,
       sha256(norm) AS text_sha256
FROM (SELECT doc_id, {_NORMAL} AS norm FROM documents)
WINDOW own AS (PARTITION BY norm ORDER BY doc_id NULLS LAST)
"""


_WORDS = (
    r"[x for x in string_split_regex(translate(coalesce(text, ''),"
    r" 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') if x <> '']"
)

DECONTAMINATION = f"""
WITH items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
phrases AS (
    SELECT DISTINCT item_id, p, len(p) AS n FROM (
        SELECT item_id, w[i:i + 9] AS p
        FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i
              FROM items WHERE len(w) > 0))),
docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
lengths AS (SELECT DISTINCT n FROM phrases),
places AS (
    SELECT doc_id, n, i, w[i:i + n - 1] AS p
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lengths)),
found AS (
    SELECT doc_id, item_id, i, places.n
    FROM places JOIN phrases ON places.n = phrases.n AND places.p = phrases.p),
covered AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM found) GROUP BY doc_id),
listed AS (
    SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT doc_id, coalesce(item_id::VARCHAR, '') AS id FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
"""


NGRAM_JACCARD = """
WITH RECURSIVE words AS (
    SELECT doc_id, [x for x in string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\\x20\\x09-\\x0D]+') if x <> ''] AS w
    FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, hash(w[i:i + 4]) AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i
          FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
    SELECT a, b FROM (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
        FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id
        GROUP BY x.doc_id, y.doc_id)
    JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
    WHERE 10 * common >= 8 * (p.n + q.n - common)),
reached AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a),
classes AS (SELECT a AS doc_id, min(b) AS class_id FROM reached GROUP BY a),
counts AS (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY a)
SELECT doc_id, class_id, coalesce(n_links, 0)::BIGINT AS n_links, doc_id = class_id AS kept
FROM classes LEFT JOIN counts USING (doc_id)
"""

_CONTROL = (
    r"(\\*)(\[INST\]|\[/INST\]|<s>|</s>|<<SYS>>|<</SYS>>|\[ROLE\]|\[TEXT\]|\[/ROLE\])"
)
_SHOWN = "length({0}) + len(regexp_extract_all({0}, '" + _CONTROL + "'))"

CHAT_FORMAT = f"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
           AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
           FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum({_SHOWN.format("text")} + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 9
           WHEN 'system' THEN 17 ELSE 23 + {_SHOWN.format("role")} END)::BIGINT AS formatted_chars
FROM said GROUP BY conv_id
"""

WARC_AUDIT = """
WITH records AS (
    SELECT coalesce(page_id // 1024, -1) AS file_no, page_id,
           'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
           || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
           || 'WARC-Date: 1970-01-01T00:00:00Z' || chr(13) || chr(10)
           || 'WARC-Record-ID: <urn:page:' || coalesce(page_id::VARCHAR, '') || '>'
           || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10)
           || 'Content-Length: ' || strlen(coalesce(html, ''))
           || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '')
           || chr(13) || chr(10) || chr(13) || chr(10) AS record
    FROM pages),
placed AS (
    SELECT file_no, page_id, strlen(record)::BIGINT AS length, sha256(record) AS sha256, record,
           coalesce(sum(strlen(record)) OVER (PARTITION BY file_no ORDER BY page_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
    FROM records)
SELECT file_no, start, length, page_id, sha256,
       CASE sha256[1:2] WHEN '00' THEN length WHEN '02' THEN length - 10 END AS found_length,
       CASE sha256[1:2] WHEN '00' THEN sha256(left(record, -1) || '?')
           WHEN '02' THEN sha256(CASE WHEN right(record, 4) = chr(13) || chr(10) || chr(13) || chr(10)
               THEN left(record, -10) END) END AS found_sha256,
       CASE sha256[1:2] WHEN '01' THEN 'missing' ELSE 'altered' END AS status
FROM placed WHERE sha256[1:2] IN ('00', '01', '02')
"""


PREFIX_TRIE = """
WITH RECURSIVE said AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
               sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')))
               AS place
    FROM conversations WHERE conv_id IS NOT NULL),
bits AS (SELECT n AS byte, n::UINTEGER AS crc, 0 AS step FROM range(256) AS t(n)
    UNION ALL SELECT byte, CASE WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384::UINTEGER)
        ELSE crc >> 1 END, step + 1 FROM bits WHERE step < 8),
crcs AS MATERIALIZED (SELECT list(crc::BIGINT ORDER BY byte) AS t FROM bits WHERE step = 8),
convs AS (
    SELECT conv_id, conv_id - conv_id % 100 AS base, xor(list_reduce(
        list_prepend(4294967295, [ord(x)::BIGINT for x in string_split(conv_id::VARCHAR, '')]),
        lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 6 AS h
    FROM (SELECT DISTINCT conv_id FROM said), crcs),
taken AS (
    SELECT convs.conv_id, place, role, text FROM convs JOIN said ON said.conv_id = base AND place <= h
    UNION ALL
    SELECT convs.conv_id, place, role, text FROM convs JOIN said ON said.conv_id = convs.conv_id AND place > h),
rebuilt AS (
    SELECT convs.conv_id, coalesce(list({'r': role, 't': text} ORDER BY place)
        FILTER (place IS NOT NULL), []) AS turns
    FROM convs LEFT JOIN taken USING (conv_id) GROUP BY convs.conv_id),
members AS MATERIALIZED (
    SELECT conv_id, depth, turns[1:depth] AS prefix, len(turns) = depth AS ends
    FROM (SELECT *, unnest(range(len(turns) + 1)) AS depth FROM rebuilt)),
nodes AS MATERIALIZED (
    SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), ''))
               AS ends_sha256
    FROM members GROUP BY depth, prefix),
kids AS MATERIALIZED (
    SELECT depth - 1 AS depth, prefix[1:depth - 1] AS prefix, count(*) AS n FROM nodes WHERE depth > 0
    GROUP BY ALL),
full_nodes AS MATERIALIZED (
    SELECT nodes.*, coalesce(kids.n, 0) AS n_children,
           (n_convs - 1) * CASE depth WHEN 0 THEN 0 ELSE length(prefix[depth].t) END AS saved
    FROM nodes LEFT JOIN kids USING (depth, prefix)),
totals AS (
    SELECT up AS depth, prefix[1:up] AS prefix, count(*) FILTER (n_children = 0) AS n_leaves,
           sum(saved) AS saved_tokens
    FROM (SELECT *, unnest(range(depth + 1)) AS up FROM full_nodes) GROUP BY ALL)
SELECT own.conv_id, own.depth, up.conv_id AS parent_conv_id, own.n_convs, own.n_children, n_leaves,
       saved_tokens::BIGINT AS saved_tokens, own.ends_sha256
FROM full_nodes AS own JOIN totals USING (depth, prefix)
LEFT JOIN nodes AS up ON up.depth = own.depth - 1 AND up.prefix = own.prefix[1:own.depth - 1]
"""


def _vector_codes() -> str:
    """Two rounds of moving the codebooks, written out one after another."""

    def nearest(book: str) -> str:
        gap = "own.x[i] - book.x[i]"
        return f"""
        SELECT own.vec_id, own.label, own.part, own.x,
               min({{'d': list_sum([({gap}) * ({gap}) for i in range(1, len(own.x) + 1)])::BIGINT,
                     'e': book.entry}}) AS best
        FROM cut AS own JOIN {book} AS book ON own.part = book.part
        GROUP BY own.vec_id, own.label, own.part, own.x"""

    def moved(coded: str, book: str) -> str:
        return f"""
        SELECT book.part, book.entry, coalesce(mean.x, book.x) AS x FROM {book} AS book LEFT JOIN (
            SELECT part, entry, list(floor(total / n)::BIGINT ORDER BY i) AS x FROM (
                SELECT part, best.e AS entry, i, sum(x[i])::BIGINT AS total, count(*) AS n
                FROM (SELECT *, unnest(range(1, len(x) + 1)) AS i FROM {coded})
                GROUP BY part, best.e, i) GROUP BY part, entry) AS mean
        ON book.part = mean.part AND book.entry = mean.entry"""

    return f"""
WITH whole AS (
    SELECT vec_id, label, [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len([1 for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
cut AS (
    SELECT vec_id, label, part, v[part * (len(v) // 16) + 1:(part + 1) * (len(v) // 16)] AS x
    FROM (SELECT *, unnest(range(16)) AS part FROM whole)),
book0 AS (
    SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x FROM cut
    QUALIFY entry < 64),
coded0 AS MATERIALIZED ({nearest("book0")}),
book1 AS MATERIALIZED ({moved("coded0", "book0")}),
coded1 AS MATERIALIZED ({nearest("book1")}),
book2 AS MATERIALIZED ({moved("coded1", "book1")}),
coded2 AS MATERIALIZED ({nearest("book2")}),
found AS (
    SELECT vec_id, label, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code,
           sum(best.d)::BIGINT AS error
    FROM coded2 GROUP BY vec_id, label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) FROM book2)
           AS codebooks_sha256
FROM found
"""


def statements() -> dict[str, str]:
    return {
        "op3_exact_dedup": EXACT_DEDUP,
        "op5_ngram_jaccard": NGRAM_JACCARD,
        "op6_chat_format": CHAT_FORMAT,
        "op8_warc_audit": WARC_AUDIT,
        "op9_decontamination": DECONTAMINATION,
        "op11_prefix_trie": PREFIX_TRIE,
        "op13_vector_codes": _vector_codes(),
    }
