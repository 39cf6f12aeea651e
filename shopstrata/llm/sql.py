"""DuckDB SQL for the queries of this subpackage that SQL can express.

Not expressed: nearest neighbours with calibration (op2), byte-pair ids (op5), the discriminant (op6), flow
and block choice (op7), XXH64 (op9) and alignment (op10); their tests hold them against plain versions.
"""

from __future__ import annotations

from shopstrata.llm.mixture import BLOCKS, BUCKET_ROWS, LEAST_BUCKETS, SEED
from shopstrata.llm.ppm import DIGITS, MODULUS, ORDER, REMAINDER, SYMBOLS
from shopstrata.llm.spotsigs import ANCHORS

_ANCHORS = ", ".join(f"'{w}'" for w in sorted(ANCHORS))



def _crc32(id_text: str) -> str:
    """CRC-32 of an ASCII text by its definition: bytes are added, 256 stands for one shift of the register."""
    steps = (
        f"flatten(list_transform(range(1, len({id_text}) + 1), "
        f"lambda i: [ascii(substr({id_text}, i, 1))::BIGINT] || list_resize([]::BIGINT[], 8, 256)))"
    )
    register = (
        f"list_reduce([4294967295::BIGINT] || {steps}, lambda a, x: "
        "CASE WHEN x < 256 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END)"
    )
    return f"xor({register}, 4294967295)"


# Text 0 is the document, text 1 its edited form. Words, then content words by number, then chains.
SPOTSIGS = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
o AS (
  SELECT doc_id, text,
         coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id)) AS nxt,
         coalesce(lead(doc_id) OVER (ORDER BY doc_id), first_value(doc_id) OVER (ORDER BY doc_id)) AS next_id
  FROM d),
t AS (
  SELECT 0 AS kind, doc_id, text AS body FROM d UNION ALL
  SELECT 1, doc_id, left(text, length(text) - length(text) // 2) || left(nxt, length(text) // 2) FROM o),
w AS (
  SELECT kind, doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS i
  FROM (SELECT kind, doc_id, regexp_extract_all(lower(body), '[\\p{{L}}\\p{{N}}_]+') AS ws FROM t)),
c AS (
  SELECT *, sum(CASE WHEN anchor THEN 0 ELSE 1 END) OVER (PARTITION BY kind, doc_id ORDER BY i) AS no
  FROM (SELECT *, word IN ({_ANCHORS}) AS anchor FROM w)),
s AS (
  SELECT a.kind, a.doc_id, a.word || ' ' || x.word || ' ' || y.word AS sig, a.i
  FROM c a
  JOIN c x ON x.kind = a.kind AND x.doc_id = a.doc_id AND NOT x.anchor AND x.no = a.no + 1
  JOIN c y ON y.kind = a.kind AND y.doc_id = a.doc_id AND NOT y.anchor AND y.no = a.no + 2
  WHERE a.anchor),
k AS (
  SELECT kind, doc_id, sig || CASE WHEN n > 1 THEN ' ' || (n - 1) ELSE '' END AS sig
  FROM (SELECT *, row_number() OVER (PARTITION BY kind, doc_id, sig ORDER BY i) AS n FROM s)),
f AS (
  SELECT t.kind, t.doc_id,
         CASE WHEN k.sigs IS NOT NULL THEN k.sigs WHEN body = '' THEN []::VARCHAR[] ELSE [chr(10) || body] END AS sigs
  FROM t LEFT JOIN (SELECT kind, doc_id, list_sort(list(sig)) AS sigs FROM k GROUP BY kind, doc_id) k
    ON k.kind = t.kind AND k.doc_id = t.doc_id),
p AS (
  SELECT o.doc_id, length(o.text) AS n_chars, sha256(e.body) AS edited_sha256, a.sigs AS a, b.sigs AS b, n.sigs AS c,
         len(list_intersect(a.sigs, b.sigs)) AS ab, len(list_intersect(a.sigs, n.sigs)) AS ac
  FROM o JOIN t e ON e.kind = 1 AND e.doc_id = o.doc_id
  JOIN f a ON a.kind = 0 AND a.doc_id = o.doc_id
  JOIN f b ON b.kind = 1 AND b.doc_id = o.doc_id
  JOIN f n ON n.kind = 0 AND n.doc_id = o.next_id)
SELECT doc_id, n_chars, edited_sha256,
       printf('%08x', len(a)) || md5(array_to_string(a, chr(10))) AS fingerprint,
       printf('%08x', len(b)) || md5(array_to_string(b, chr(10))) AS edited_fingerprint,
       CASE WHEN len(a) + len(b) = 0 THEN 1.0 ELSE ab::DOUBLE / (len(a) + len(b) - ab) END::DOUBLE AS near_edited,
       CASE WHEN len(a) + len(c) = 0 THEN 1.0 ELSE ac::DOUBLE / (len(a) + len(c) - ac) END::DOUBLE AS near_next
FROM p"""

# The level of weight at which shares stop is found over sources sorted by the level at which each is full.
MIXING = f"""
WITH d AS (
  SELECT doc_id, source, coalesce('=' || source, '~') AS key,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'x' || md5(coalesce(text, '')))), 1, 15))::BIGINT AS place
  FROM documents),
z AS (SELECT sum(size)::BIGINT AS total, greatest({LEAST_BUCKETS}, count(*) // {BUCKET_ROWS}) AS buckets FROM d),
s AS (
  SELECT key, size, i, CASE (i - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM (SELECT key, sum(size)::BIGINT AS size, row_number() OVER (ORDER BY key = '~', key) AS i FROM d GROUP BY key)),
l AS (
  SELECT *, coalesce(sum(2 * size) OVER (ORDER BY 2.0 * size / weight, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS capped,
         sum(weight) OVER (ORDER BY 2.0 * size / weight, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS open,
         row_number() OVER (ORDER BY 2.0 * size / weight, i) AS rank
  FROM s),
v AS (
  SELECT capped, open, rank FROM l, z
  WHERE (3 * total - 2 * capped) * weight <= 2 * open * 2 * size ORDER BY rank LIMIT 1),
g AS (
  SELECT l.key, l.size, l.i,
         CASE WHEN l.rank < v.rank THEN 2.0 * l.size
              ELSE ((3 * total - 2 * v.capped) * l.weight)::DOUBLE / (2 * v.open)::DOUBLE END AS target,
         greatest(1, (3 * total // 2 + {BLOCKS - 1}) // {BLOCKS}) AS length, total
  FROM l, v, z),
n AS (SELECT *, (size + length - 1) // length AS blocks FROM g),
q AS (
  SELECT key, i, target / (2 * k + 1) AS quotient
  FROM (SELECT key, i, target, unnest(range(0, 2 * blocks)) AS k FROM n WHERE target > 0)),
r AS (SELECT key, row_number() OVER (ORDER BY quotient DESC, i) AS seat FROM q),
m AS (
  SELECT n.*, coalesce(c.quota, 0) AS quota,
         CASE WHEN blocks = 0 THEN 0
              ELSE ('0x' || substr(md5('{SEED}:' || n.key), 1, 15))::BIGINT % blocks END AS start
  FROM n LEFT JOIN (
    SELECT key, count(*) AS quota FROM r
    WHERE seat <= (SELECT any_value(round_even(1.5 * total / length, 0)) FROM n) GROUP BY key) c ON c.key = n.key),
x AS (
  SELECT d.doc_id, d.source, d.size, m.size AS source_size, m.target, m.quota, m.blocks, m.start, m.length,
         sum(d.size) OVER (PARTITION BY d.key ORDER BY d.place % buckets, d.place, d.doc_id, d.size
                           ROWS UNBOUNDED PRECEDING)::BIGINT - d.size AS a
  FROM d JOIN m ON m.key = d.key, z),
y AS (
  SELECT *, CASE WHEN blocks = 0 THEN 0 ELSE quota // blocks END AS whole,
         start * length AS p, CASE WHEN blocks = 0 THEN 0 ELSE least(start + quota % blocks, blocks) * length END AS e,
         CASE WHEN blocks = 0 THEN 0 ELSE greatest(0, start + quota % blocks - blocks) * length END AS h
  FROM x)
SELECT doc_id, size, source_size, target::DOUBLE AS target,
       (whole * size + greatest(0, least(a + size, e) - greatest(a, p)) + greatest(0, least(a + size, h) - a))::BIGINT AS taken,
       source
FROM y"""

# DuckDB has SHA-1 in hex; base32 takes its bits by fives.
WARC = """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        d AS (SELECT *, unhex(sha1(html))::BIT AS bits, max(page_id) OVER (PARTITION BY html) AS newest FROM p)
        SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
               list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + 16 * get_bit(bits, (5 * i)::INT) + 8 * get_bit(bits, (5 * i + 1)::INT)
                     + 4 * get_bit(bits, (5 * i + 2)::INT) + 2 * get_bit(bits, (5 * i + 3)::INT)
                     + get_bit(bits, (5 * i + 4)::INT), 1)), 'string_agg', '') AS payload_digest,
               CASE WHEN page_id = newest OR newest IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> newest OR page_id IS NULL THEN newest END AS refers_to
        FROM d"""

# Every string of 100 bytes by its digest, then islands of repeated ones.
SUFFIXES = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, ''))::BIGINT AS n
  FROM documents),
w AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY m ORDER BY doc_id, i) AS k
  FROM (SELECT doc_id, unnest(range(0, n - 99)) AS i,
               unnest(list_transform(range(0, n - 99), lambda j: md5_number(substr(h, 2 * j + 1, 200)))) AS m
        FROM d WHERE n >= 100)),
r AS (
  SELECT doc_id, i, CASE WHEN i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100
                          OR lag(i) OVER (PARTITION BY doc_id ORDER BY i) IS NULL THEN 1 ELSE 0 END AS fresh
  FROM w WHERE k > 1),
s AS (
  SELECT doc_id, span, min(i) AS a, max(i) + 100 AS b
  FROM (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM r) GROUP BY doc_id, span),
e AS (
  SELECT doc_id, span, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY span), 0) AS before FROM s),
g AS (
  SELECT e.doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, max(b) AS last,
         string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY span) AS kept
  FROM e JOIN d ON d.doc_id = e.doc_id GROUP BY e.doc_id)
SELECT d.doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN g.doc_id IS NULL THEN h ELSE kept || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN g ON g.doc_id = d.doc_id"""

# Every distinct prefix by the digests of its turns, then sums over all nodes below each.
PREFIX_TRIE = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
o AS (
  SELECT conv_id, length(text) AS size, sha256(strlen(role) || ':' || role || text) AS digest,
         row_number() OVER (PARTITION BY conv_id
                            ORDER BY turn NULLS FIRST, substr(sha256(strlen(role) || ':' || role || text), 1, 32)) AS place
  FROM t),
c AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
         {_crc32("conv_id::VARCHAR")} % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
b AS (
  SELECT c.conv_id, 0 AS own, o.place, o.size, o.digest FROM c JOIN o ON o.conv_id = c.base AND o.place <= c.h
  UNION ALL
  SELECT c.conv_id, 1, o.place, o.size, o.digest FROM c JOIN o ON o.conv_id = c.conv_id AND o.place > c.h),
s AS (
  SELECT c.conv_id, coalesce(list(b.digest ORDER BY own, place) FILTER (b.digest IS NOT NULL), []) AS path,
         coalesce(list(b.size ORDER BY own, place) FILTER (b.digest IS NOT NULL), []) AS sizes
  FROM c LEFT JOIN b ON b.conv_id = c.conv_id GROUP BY c.conv_id),
p AS (
  SELECT conv_id, d, path[1:d] AS path, CASE WHEN d = 0 THEN 0 ELSE sizes[d] END AS size, d = len(path) AS ends
  FROM (SELECT *, unnest(range(0, len(path) + 1)) AS d FROM s)),
n AS (
  SELECT path, d, any_value(size) AS size, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM p GROUP BY path, d),
k AS (SELECT path[1:d - 1] AS path, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
u AS (
  SELECT n.path[1:a] AS path, sum(CASE WHEN k.path IS NULL THEN 1 ELSE 0 END)::BIGINT AS n_leaves,
         sum((n.n_convs - 1) * n.size)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM n) n LEFT JOIN k ON k.path = n.path GROUP BY 1)
SELECT n.conv_id, n.d AS depth, f.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children,
       u.n_leaves, u.saved_tokens, n.ends_sha256
FROM n JOIN u ON u.path = n.path LEFT JOIN k ON k.path = n.path
LEFT JOIN n f ON n.d > 0 AND f.path = n.path[1:n.d - 1]"""

# Grams are hex. t: the trie's counts at depth k; c: n and q of its contexts; e: what a context excludes one level below.
PPM = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce({_crc32("doc_id::VARCHAR")} % {MODULUS} = {REMAINDER}, false) AS held_out,
         coalesce(text, '') AS text
  FROM documents),
h AS (SELECT r, held_out, strlen(text) AS n, repeat('FF', {ORDER}) || hex(encode(text)) || 'FF' AS h FROM d),
p AS (
  SELECT r, gram, count(*) AS times, any_value(held_out) AS held_out
  FROM (SELECT r, held_out, substr(h, 2 * i + 1, {2 * ORDER + 2}) AS gram FROM (SELECT *, unnest(range(0, n + 1)) AS i FROM h))
  GROUP BY r, gram),
g AS (SELECT gram, coalesce(sum(times) FILTER (NOT held_out), 0) AS n FROM p GROUP BY gram),
l AS (SELECT gram, n, unnest(range(0, {ORDER + 1})) AS k FROM g),
t AS (SELECT k, right(gram, 2 * k + 2) AS gram, sum(n) AS n FROM l WHERE n > 0 GROUP BY ALL),
c AS (SELECT k, left(gram, 2 * k) AS context, sum(n) AS n, count(*) AS q FROM t GROUP BY ALL),
e AS (
  SELECT t.k, left(t.gram, 2 * t.k) AS context, sum(b.n) AS n
  FROM t JOIN t b ON b.k = t.k - 1 AND b.gram = right(t.gram, 2 * t.k) GROUP BY ALL),
j AS (
  SELECT l.gram, l.k, t.n AS seen, c.q - coalesce(a.q, 0) AS q, c.n - coalesce(e.n, 0) + c.q - coalesce(a.q, 0) AS whole,
         max(CASE WHEN t.n IS NULL THEN -1 ELSE l.k END) OVER (PARTITION BY l.gram) AS top
  FROM l
  LEFT JOIN t ON t.k = l.k AND t.gram = right(l.gram, 2 * l.k + 2)
  LEFT JOIN c ON c.k = l.k AND c.context = substr(l.gram, 1 + 2 * ({ORDER} - l.k), 2 * l.k)
  LEFT JOIN c a ON a.k = l.k + 1 AND a.context = substr(l.gram, 1 + 2 * ({ORDER} - 1 - l.k), 2 * l.k + 2) AND l.k < {ORDER}
  LEFT JOIN e ON e.k = l.k + 1 AND e.context = a.context),
x AS (
  SELECT gram,
         sum(CASE WHEN k = top THEN log10(seen / whole) WHEN k > top AND q > 0 THEN log10(q / whole) ELSE 0 END)
         - CASE WHEN any_value(top) >= 0 THEN 0
                ELSE log10({SYMBOLS} - (SELECT coalesce(sum(q), 0) FROM c WHERE k = 0)) END AS cost
  FROM j GROUP BY gram),
y AS (SELECT p.r, fsum(p.times * x.cost) AS score FROM p JOIN x ON x.gram = p.gram GROUP BY p.r),
m AS (
  SELECT r, held_out, unnest(regexp_extract_all(translate(text, '{"".join(map(chr, range(65, 91)))}',
                             '{"".join(map(chr, range(97, 123)))}'), '[^\\x20\\x09-\\x0D]+') || [NULL]) AS token
  FROM d),
o AS (SELECT token, count(*) FILTER (NOT held_out) AS c FROM m GROUP BY token),
z AS (SELECT sum(c)::BIGINT AS total, count(*) FILTER (c > 0) AS kinds FROM o),
b AS (
  SELECT m.r, count(*) AS n_tokens, count(*) FILTER (o.c > 0) AS n_known,
         fsum(log10((o.c + 0.1::DOUBLE) / (z.total + 0.1::DOUBLE * (z.kinds + 1)))) AS base_score
  FROM m JOIN o ON o.token IS NOT DISTINCT FROM m.token, z GROUP BY m.r)
SELECT d.doc_id, d.held_out, b.n_tokens, b.n_known, z.total AS train_tokens, round(b.base_score, {DIGITS}) AS base_score,
       round(y.score, {DIGITS}) AS score
FROM d JOIN b ON b.r = d.r JOIN y ON y.r = d.r, z"""

_LEAF = "sha256(concat({}))".format(", ".join(
    f"coalesce(strlen({c}) || ':' || {c}, '-')"
    for c in ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", "{text}")
))

# A node is (tree, level, place); a leaf climbs one level at a time, with what it has seen and what it folds to.
MERKLE = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('s' || source, '-') AS tree, {_LEAF.format(text="text")} AS leaf,
         CASE WHEN {_crc32("doc_id::VARCHAR")} % 2 = 0 THEN {_LEAF.format(text="replace(text, chr(10), '')")}
              ELSE {_LEAF.format(text="text")} END AS shown
  FROM documents),
l AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         count(*) OVER (PARTITION BY tree) AS n FROM d),
v AS (
  SELECT tree, 0 AS level, place, n, leaf AS hash FROM l
  UNION ALL
  SELECT tree, level + 1, place // 3, (n + 2) // 3, sha256(string_agg(hash, '' ORDER BY place))
  FROM v WHERE n > 1 GROUP BY tree, level, place // 3, n),
s AS (SELECT tree AS name, hash, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n FROM v WHERE n = 1),
w AS (
  SELECT 0 AS level, place, n, hash FROM s
  UNION ALL
  SELECT level + 1, place // 3, (n + 2) // 3, sha256(string_agg(hash, '' ORDER BY place))
  FROM w WHERE n > 1 GROUP BY level, place // 3, n),
x AS (SELECT tree, level, place, n, hash FROM v UNION ALL SELECT 't', level, place, n, hash FROM w),
r AS (
  SELECT a.tree, a.level, a.place, a.tree AS up_tree, a.level + 1 AS up_level, a.place // 3 AS up_place, (a.n + 2) // 3 AS up_n,
         coalesce(string_agg(b.hash, '' ORDER BY b.place) FILTER (b.place < a.place), '') AS before,
         coalesce(string_agg(b.hash, '' ORDER BY b.place) FILTER (b.place > a.place), '') AS after
  FROM x a JOIN x b ON b.tree = a.tree AND b.level = a.level AND b.place // 3 = a.place // 3 AND a.n > 1
  GROUP BY ALL
  UNION ALL
  SELECT v.tree, v.level, v.place, 't', 0, s.place, s.n, NULL, NULL FROM v JOIN s ON s.name = v.tree AND v.n = 1),
c AS (
  SELECT tree AS own, place AS leaf_place, tree, 0 AS level, place, n, shown AS folded, '' AS seen FROM l
  UNION ALL
  SELECT c.own, c.leaf_place, r.up_tree, r.up_level, r.up_place, r.up_n,
         CASE WHEN r.before IS NULL THEN c.folded ELSE sha256(r.before || c.folded || r.after) END,
         CASE WHEN r.before IS NULL THEN c.seen ELSE c.seen || r.before || r.after END
  FROM c JOIN r ON r.tree = c.tree AND r.level = c.level AND r.place = c.place)
SELECT l.doc_id, l.leaf, s.hash AS subroot, o.hash AS root, sha256(c.seen) AS proof_sha256, c.folded AS folded_root,
       c.folded = o.hash AS verified
FROM l JOIN s ON s.name = l.tree JOIN w o ON o.n = 1
JOIN c ON c.own = l.tree AND c.leaf_place = l.place AND c.tree = 't' AND c.n = 1"""

SQL = {
    "op1_spotsigs": SPOTSIGS,
    "op3_mixing": MIXING,
    "op4_warc": WARC,
    "op8_suffix_dedup": SUFFIXES,
    "op11_ppm": PPM,
    "op12_merkle": MERKLE,
    "op13_prefix_trie": PREFIX_TRIE,
}
