"""SQL counterparts of the queries that SQL can express."""

_WORD = r"'[^\x20\x09-\x0D]+'"

_MIXING = rf"""
WITH RECURSIVE sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {_WORD}))::BIGINT AS size FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place
    FROM sized GROUP BY source
), weighed AS (
    SELECT *, CASE (place - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM sources
), rounds AS (
    -- Each round caps the sources whose share of what is left is above three times their size.
    SELECT 0 AS step, place, source_size, weight, FALSE AS capped FROM weighed
    UNION ALL
    SELECT step + 1, place, source_size, weight,
        capped OR weight * (sum(source_size) OVER () - coalesce(sum(3 * source_size) FILTER (capped) OVER (), 0))
            > 3 * source_size * sum(weight) FILTER (NOT capped) OVER ()
    FROM rounds WHERE step < 40
), last AS (
    SELECT * FROM rounds WHERE step = 40
), totals AS (
    SELECT sum(source_size) - coalesce(sum(3 * source_size) FILTER (capped), 0) AS rest, sum(weight) FILTER (NOT capped) AS open
    FROM last
), aimed AS (
    SELECT w.source, w.source_size,
        CASE WHEN l.capped THEN 3.0::DOUBLE * w.source_size ELSE l.weight::DOUBLE * rest::DOUBLE / open::DOUBLE END AS target
    FROM last l JOIN weighed w USING (place) CROSS JOIN totals
), rated AS (
    SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM aimed
)
SELECT doc_id, size, source_size, target,
    size * (floor(rate)::BIGINT + CASE
        WHEN ('0x' || substr(md5('7:' || doc_id), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE < rate - floor(rate) THEN 1
        ELSE 0 END) AS taken
FROM sized JOIN rated ON sized.source IS NOT DISTINCT FROM rated.source
"""

_WARC = """
WITH hashed AS (
    SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM hashed
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM firsts
"""

ORACLES = {"op9_warc": _WARC, "op7_source_mixing": _MIXING}

# Marks take 3 + 4 characters a conversation, 8 + 8 + 7 a block and 8 between the turns of a block; each control string, and
# each look-alike with backslashes, is escaped by one character.
_CHAT = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
    SELECT *,
        length(text) + len(regexp_extract_all(text, '<\\*(/?s>|\|(role|text|turn|end)\|>)|\[\\*/?INST\]')) AS text_chars,
        length(role) + len(regexp_extract_all(role, '<\\*(/?s>|\|(role|text|turn|end)\|>)|\[\\*/?INST\]')) AS role_chars,
        coalesce(role <> lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text), TRUE) AS opens
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    (7 + sum(text_chars + CASE WHEN opens THEN 23 + role_chars ELSE 8 END))::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

ORACLES["op3_chat_formatting"] = _CHAT

# crc32 of the decimal id, bit by bit: 3988292384 is the reversed polynomial.
_MERKLE = """
WITH RECURSIVE framed AS (
    SELECT doc_id, lang, text,
        coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
            || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS front,
        list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
            lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                lambda x, zero: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS crc
    FROM documents
), hashed AS (
    SELECT doc_id, lang, sha256(front || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
        CASE WHEN xor(crc, 4294967295) % 3 = 0
            THEN sha256(front || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS tampered
    FROM framed
), leaves AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM hashed
), nodes AS (
    -- tree 0 holds the leaves of every group
    SELECT lang, 0 AS level, place, leaf AS node, count(*) OVER (PARTITION BY lang) AS many FROM leaves
    UNION ALL
    SELECT lang, level + 1, place // 8, sha256(string_agg(node, '' ORDER BY place)), ((any_value(many) + 7) // 8)
    FROM nodes WHERE many > 1 GROUP BY lang, level, place // 8
), subroots AS (
    SELECT lang, node AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM nodes WHERE many = 1
), tops AS (
    SELECT 0 AS level, place, subroot AS node, count(*) OVER () AS many FROM subroots
    UNION ALL
    SELECT level + 1, place // 8, sha256(string_agg(node, '' ORDER BY place)), ((any_value(many) + 7) // 8)
    FROM tops WHERE many > 1 GROUP BY level, place // 8
), lower_steps AS (
    SELECT a.lang, a.level, a.place, coalesce(string_agg(b.node, '' ORDER BY b.place) FILTER (b.place < a.place), '') AS before,
        coalesce(string_agg(b.node, '' ORDER BY b.place) FILTER (b.place > a.place), '') AS behind
    FROM nodes a JOIN nodes b ON a.lang IS NOT DISTINCT FROM b.lang AND a.level = b.level AND a.place // 8 = b.place // 8
    WHERE a.many > 1 GROUP BY a.lang, a.level, a.place
), upper_steps AS (
    SELECT a.level, a.place, coalesce(string_agg(b.node, '' ORDER BY b.place) FILTER (b.place < a.place), '') AS before,
        coalesce(string_agg(b.node, '' ORDER BY b.place) FILTER (b.place > a.place), '') AS behind
    FROM tops a JOIN tops b ON a.level = b.level AND a.place // 8 = b.place // 8
    WHERE a.many > 1 GROUP BY a.level, a.place
), steps AS (
    SELECT l.doc_id, l.leaf, l.lang, s.level, before, behind
    FROM leaves l JOIN lower_steps s ON l.lang IS NOT DISTINCT FROM s.lang AND l.place // (8 ** s.level)::BIGINT = s.place
    UNION ALL
    SELECT l.doc_id, l.leaf, l.lang, 100 + s.level, before, behind
    FROM leaves l JOIN subroots g ON l.lang IS NOT DISTINCT FROM g.lang JOIN upper_steps s ON g.place // (8 ** s.level)::BIGINT = s.place
), paths AS (
    SELECT doc_id, leaf, list({'before': before, 'behind': behind} ORDER BY level) AS path FROM steps GROUP BY doc_id, leaf
), folded AS (
    SELECT l.doc_id, l.leaf, 0 AS step, coalesce(l.tampered, l.leaf) AS node, coalesce(p.path, []) AS path
    FROM leaves l LEFT JOIN paths p ON l.doc_id IS NOT DISTINCT FROM p.doc_id AND l.leaf = p.leaf
    UNION ALL
    SELECT doc_id, leaf, step + 1, sha256(path[step + 1].before || node || path[step + 1].behind), path FROM folded WHERE step < len(path)
), ended AS (
    SELECT doc_id, leaf, node AS folded_root,
        sha256(coalesce(array_to_string(list_transform(path, lambda p: p.before || p.behind), ''), '')) AS proof_sha256
    FROM folded WHERE step = len(path)
)
SELECT l.doc_id, l.leaf, s.subroot, t.node AS root, e.proof_sha256, e.folded_root, e.folded_root = t.node AS verified
FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang
JOIN ended e ON l.doc_id IS NOT DISTINCT FROM e.doc_id AND l.leaf = e.leaf
CROSS JOIN (SELECT node FROM tops WHERE many = 1) t
"""

ORACLES["op11_merkle"] = _MERKLE

_PHRASES = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\x0C\r]')) AS piece
    FROM documents
), worded AS (
    SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w FROM pieces
), totals AS (
    SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang
), grams AS (
    SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
    FROM worded, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE len(w) >= size
), counts AS (
    SELECT lang, size, phrase, count(*)::BIGINT AS f FROM grams GROUP BY ALL HAVING count(*) >= 30
), candidates AS (
    SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE size >= 2
), cuts AS (
    SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS one, array_to_string(w[k + 1:], ' ') AS two
    FROM candidates, (SELECT unnest([1, 2, 3]) AS k) WHERE k < size
), scored AS (
    SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * a // (x.f + y.f))::BIGINT AS score
    FROM cuts c JOIN counts x ON c.lang = x.lang AND c.one = x.phrase JOIN counts y ON c.lang = y.lang AND c.two = y.phrase
), best AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), kept AS (
    SELECT * FROM best b WHERE NOT EXISTS (
        SELECT 1 FROM candidates c WHERE c.lang = b.lang AND c.size > len(string_split(b.phrase, ' '))
            AND contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' ') AND 100::HUGEINT * c.a >= 80::HUGEINT * b.a)
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLES["op13_phrases"] = _PHRASES
