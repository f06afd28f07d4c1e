"""DuckDB SQL for the corpus queries that SQL expresses. Operators 1, 5, 7, 8, 9
and 10 are tested against brute force instead."""

_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"'[^\x20\x09-\x0D]+'"

OP2 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
                  coalesce(source, '<none>') AS host FROM documents),
w AS (SELECT rid, regexp_extract_all(text, {_WORDS}) AS w FROM d),
i AS (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM w),
g AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, w[i] || ' ' || w[i+1] || ' ' || w[i+2]) AS c FROM i),
r AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest([i, i+1, i+2]) AS j FROM g WHERE c > 1)
      GROUP BY rid),
l AS (SELECT rid, host, text, unnest(string_split(text, chr(10))) AS line FROM d),
k AS (SELECT * FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
u AS (SELECT rid, count(*) - count(DISTINCT line) AS n FROM k GROUP BY rid),
m AS (SELECT rid, host, text, len(regexp_extract_all(line, {_WORDS})) AS n,
             array_to_string(regexp_extract_all({_FOLD.format('line')}, {_WORDS}), ' ') AS line FROM k),
h AS (SELECT host, count(DISTINCT text) AS docs FROM d GROUP BY host),
f AS (SELECT m.host, line FROM m JOIN h USING (host) GROUP BY m.host, line, h.docs
      HAVING count(DISTINCT text) > 30 AND count(DISTINCT text) > 0.002 * h.docs),
x AS (SELECT rid, sum(n) AS n FROM m JOIN f USING (host, line) GROUP BY rid),
s AS (SELECT d.doc_id, len(w.w) AS n_words, length(array_to_string(w.w, '')) AS word_chars,
             length(regexp_replace(d.text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             coalesce(u.n, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
             coalesce(x.n, 0)::BIGINT AS n_removed_words
      FROM d JOIN w USING (rid) LEFT JOIN u USING (rid) LEFT JOIN r USING (rid) LEFT JOIN x USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * n_removed_words <= 50 * n_words AS kept, n_removed_words FROM b
"""

_ALNUM = r"'[0-9a-z\x{80}-\x{10FFFF}]+'"

OP3 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
                  regexp_extract_all({_FOLD.format("coalesce(text, '')")}, {_ALNUM}) AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_FOLD.format('text')}, {_ALNUM}) AS w FROM benchmark
      WHERE item_id IS NOT NULL AND text IS NOT NULL),
p AS (SELECT DISTINCT item_id, least(len(w), 13) AS n,
             array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS key
      FROM (SELECT *, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
z AS (SELECT DISTINCT n FROM p),
o AS (SELECT rid, z.n, w, unnest(range(1, len(w) - z.n + 2)) AS i FROM d, z WHERE len(w) >= z.n),
f AS (SELECT o.rid, o.i, o.n, p.item_id
      FROM (SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS key FROM o) o JOIN p USING (n, key)),
t AS (SELECT rid, count(DISTINCT j) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS j FROM f) GROUP BY rid),
m AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM f) GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN t USING (rid) LEFT JOIN m USING (rid)
"""

OP4 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_FOLD.format("coalesce(text, '')")}, {_WORDS}) AS w
                     FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS shingle
      FROM (SELECT *, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b USING (shingle)
      JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
      WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, x.n, y.n
      HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))),
r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.low AS component_id, d.doc_id = c.low AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS low FROM r GROUP BY a) c USING (doc_id)
"""

OP6 = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
           UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
l AS (SELECT *, 16 + 2 * length(role) - length(regexp_replace(role, '[\\<>]', '', 'g'))
             + 2 * length(text) - length(regexp_replace(text, '[\\<]', '', 'g')) AS n FROM t),
w AS (SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS upto,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) AS back FROM l)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), ''))
           AS loss_sha256,
       sum(CASE WHEN role = 'assistant' OR back = 1 THEN upto ELSE 0 END)::BIGINT AS formatted_chars
FROM w GROUP BY conv_id
"""

# CRC-32 of ASCII text: table of 256 entries made by eight shifts each.
_CRC = """SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z:
                    CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
           FROM (SELECT unnest(range(256))::BIGINT AS i)"""


def _crc32(text: str) -> str:
    """DuckDB expression over column t of _CRC: unsigned CRC-32 of ASCII text."""
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    step = "xor(c >> 8, t[((xor(c, b)) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {step}), 4294967295)"


def _field(value: str) -> str:
    return f"coalesce(strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR, '-')"


def _leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', n_chars, 'text')))})"


_MORE = f"CASE WHEN {_crc32('doc_id::VARCHAR')} % 7 = 0 THEN n_chars + 1 ELSE n_chars END"

OP11 = rf"""
WITH RECURSIVE crc AS MATERIALIZED ({_CRC}),
d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || lang, '-') AS tree,
       {_leaf('n_chars')} AS leaf, {_leaf(_MORE)} AS changed FROM documents, crc),
l AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS i FROM d),
n AS (SELECT tree, 0 AS level, i, leaf AS h, count(*) OVER (PARTITION BY tree) AS size FROM l
      UNION ALL
      SELECT tree, level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), any_value((size + 1) // 2)
      FROM n WHERE size > 1 GROUP BY tree, level, i // 2),
s AS MATERIALIZED (SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS i,
                          count(*) OVER () AS size FROM n WHERE size = 1),
u AS (SELECT 0 AS level, i, subroot AS h, size FROM s
      UNION ALL
      SELECT level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), any_value((size + 1) // 2)
      FROM u WHERE size > 1 GROUP BY level, i // 2),
p AS (SELECT rid, tree, 0 AS level, i, changed AS own, '' AS proof, count(*) OVER (PARTITION BY tree) AS size FROM l
      UNION ALL
      SELECT p.rid, p.tree, p.level + 1, p.i // 2, sha256(CASE WHEN n.h IS NULL THEN own WHEN p.i % 2 = 1 THEN n.h || own
             ELSE own || n.h END), proof || coalesce(n.h, ''), (p.size + 1) // 2
      FROM p LEFT JOIN n ON n.tree = p.tree AND n.level = p.level AND n.i = xor(p.i, 1) WHERE p.size > 1),
v AS (SELECT p.rid, 0 AS level, s.i, p.own, p.proof, s.size, s.subroot FROM p JOIN s USING (tree) WHERE p.size = 1
      UNION ALL
      SELECT v.rid, v.level + 1, v.i // 2, sha256(CASE WHEN u.h IS NULL THEN own WHEN v.i % 2 = 1 THEN u.h || own
             ELSE own || u.h END), proof || coalesce(u.h, ''), (v.size + 1) // 2, v.subroot
      FROM v LEFT JOIN u ON u.level = v.level AND u.i = xor(v.i, 1) WHERE v.size > 1)
SELECT l.doc_id, l.leaf, v.subroot, u.h AS root, sha256(v.proof) AS proof_sha256, v.own AS folded_root,
       v.own = u.h AS verified
FROM l JOIN v ON v.rid = l.rid AND v.size = 1 JOIN u ON u.size = 1
"""

OP12 = r"""
WITH n AS (SELECT doc_id, row_number() OVER () AS rid,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t ORDER BY doc_id NULLS LAST, rid)
"""

OP13 = rf"""
WITH crc AS MATERIALIZED ({_CRC}),
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      WHERE conv_id IS NOT NULL),
c AS MATERIALIZED (SELECT conv_id, list({{'k': length(role) || ':' || role || text, 'n': length(text)}}
        ORDER BY turn NULLS FIRST, left(sha256(length(role) || ':' || role || text), 32)) AS s FROM t GROUP BY conv_id),
h AS (SELECT conv_id, s, conv_id - conv_id % 100 AS family, {_crc32('conv_id::VARCHAR')} % 6 AS h FROM c, crc),
r AS MATERIALIZED (SELECT h.conv_id, coalesce(c.s, [])[1:h.h] || h.s[h.h + 1:] AS s
                   FROM h LEFT JOIN c ON c.conv_id = h.family),
m AS MATERIALIZED (SELECT conv_id, len(s) AS size, d, CASE WHEN d = 0 THEN [] ELSE list_transform(s[1:d], lambda x: x.k) END AS path,
        CASE WHEN d = 0 THEN 0 ELSE s[d].n END AS n FROM (SELECT *, unnest(range(0, len(s) + 1)) AS d FROM r)),
g AS MATERIALIZED (SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(n) AS n,
        coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE size = d), '') AS ends
      FROM m GROUP BY path, d),
k AS (SELECT path[:d - 1] AS path, count(*) AS n_children FROM g WHERE d > 0 GROUP BY ALL),
w AS MATERIALIZED (SELECT g.*, coalesce(n_children, 0) AS n_children FROM g LEFT JOIN k USING (path)),
x AS (SELECT CASE WHEN e = 0 THEN [] ELSE path[:e] END AS path, sum((n_convs - 1) * n)::BIGINT AS saved_tokens,
             count(*) FILTER (WHERE n_children = 0) AS n_leaves
      FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM w) GROUP BY ALL)
SELECT w.conv_id, w.d AS depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, x.n_leaves, x.saved_tokens,
       sha256(w.ends) AS ends_sha256
FROM w JOIN x USING (path) LEFT JOIN w p ON w.d > 0 AND p.d = w.d - 1 AND p.path = w.path[:w.d - 1]
"""
