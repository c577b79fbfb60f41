"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

_WORDS = r"""list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"""

SQL: dict[str, str] = {}

SQL["op2_exact_dedup"] = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""

SQL["op4_quality_cascade"] = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
l AS (SELECT doc_id, t, w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
      FROM d),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS gram
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
        SELECT doc_id, unnest([i, i + 1, i + 2]) AS p
        FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM g) WHERE c > 1) GROUP BY doc_id),
m AS (SELECT l.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
             coalesce(r.n, 0) AS n_repeat_words, length(regexp_replace(t, '[^\p{{L}}]+', '', 'g')) AS letters
      FROM l LEFT JOIN r ON l.doc_id = r.doc_id),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR n_symbols * 4 > n_words OR word_chars < n_words * 2 OR word_chars > n_words * 20
            OR n_dup_lines * 2 > n_lines OR letters * 2 < word_chars) AS kept
FROM b
"""

SQL["op6_warc_revisit"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (SELECT page_id, strlen(body) AS payload_bytes, sha1(body) AS hex FROM p),
e AS (SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda k:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               1 + ((('0x' || substr(hex, CAST(5 * (k // 4) + 1 AS INT), 5))::INT >> CAST(15 - 5 * (k % 4) AS INT)) & 31),
               1)), '') AS payload_digest FROM h)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = max(page_id) OVER g THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = max(page_id) OVER g THEN NULL ELSE max(page_id) OVER g END AS refers_to
FROM e WINDOW g AS (PARTITION BY payload_digest)
"""

SQL["op9_mix_sources"] = rf"""
WITH d AS (SELECT doc_id, source, len({_WORDS})::BIGINT AS size,
                  md5(coalesce(doc_id::VARCHAR, 'null')) AS place FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
n AS (SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::BIGINT AS weight,
             (sum(source_size) OVER ())::BIGINT AS total FROM s),
c AS (SELECT *, coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT
               AS cap_before,
             (sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS weight_rest
      FROM n WINDOW o AS (ORDER BY source_size / weight, source NULLS LAST)),
f AS (SELECT *, 3 * source_size * weight_rest <= (total - cap_before) * weight AS is_full FROM c),
q AS (SELECT *, total - coalesce(sum(3 * source_size) FILTER (WHERE is_full) OVER (), 0)::BIGINT AS rest,
             (sum(weight) FILTER (WHERE NOT is_full) OVER ())::BIGINT AS open_weight FROM f),
t AS (SELECT source, source_size, total,
             CASE WHEN is_full THEN (3 * source_size)::DOUBLE ELSE (rest * weight) / open_weight END AS target FROM q),
k AS (SELECT *, round(target)::BIGINT AS word_limit FROM t),
a AS (SELECT *, (sum(size) OVER (PARTITION BY source ORDER BY place, doc_id, size
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT - size AS pos FROM d)
SELECT a.doc_id, a.size, k.source_size, k.target,
       (least(greatest(k.word_limit - a.pos, 0), a.size)
        + least(greatest(k.word_limit - k.source_size - a.pos, 0), a.size)
        + least(greatest(k.word_limit - 2 * k.source_size - a.pos, 0), a.size))::BIGINT AS taken
FROM a JOIN k ON a.source IS NOT DISTINCT FROM k.source
"""

SQL["op3_minhash_join"] = rf"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(w) = 1 THEN w
             ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END) AS g FROM w),
c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
k AS (SELECT doc_id, sha256(string_agg(g, chr(10) ORDER BY g)) AS d FROM s GROUP BY doc_id),
r AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY d) AS rep FROM k),
u AS (SELECT s.doc_id, g FROM s JOIN r ON s.doc_id = r.doc_id AND r.doc_id = r.rep),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
      FROM u x JOIN u y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN c x ON x.doc_id = a JOIN c y ON y.doc_id = b
      WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
t AS (SELECT a AS id, a AS root FROM e UNION SELECT e.b, t.root FROM t JOIN e ON e.a = t.id),
m AS (SELECT id, min(root) AS root FROM t GROUP BY id)
SELECT w.doc_id, coalesce(c.n, 0) AS n_shingles, coalesce(m.root, r.rep, w.doc_id) AS component_id,
       w.doc_id = coalesce(m.root, r.rep, w.doc_id) AS kept
FROM w LEFT JOIN c ON c.doc_id = w.doc_id LEFT JOIN r ON r.doc_id = w.doc_id LEFT JOIN m ON m.id = r.rep
"""

#: CRC-32 of a short text, bit by bit.
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                             lambda x, z: xor(x >> 1, (x & 1) * 3988292384))), 4294967295::BIGINT)"""

SQL["op12_periodic_runs"] = rf"""
WITH d AS (SELECT doc_id, {_CRC} AS h, {_WORDS} AS w FROM documents),
a AS (SELECT doc_id, h, w, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d),
p AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM a),
t AS (SELECT doc_id, n, CASE WHEN a IS NULL THEN w
             ELSE list_transform(range(0, n), lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) END AS w
      FROM p),
u AS (SELECT doc_id, unnest(w) AS word, unnest(range(0, n)) AS i FROM t),
g AS (SELECT doc_id, i, word, concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o,
                                       lead(word, 4) OVER o) AS gram, lead(word, 4) OVER o IS NOT NULL AS full_gram
      FROM u WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
e AS (SELECT doc_id, i, word, full_gram AND count(*) OVER (PARTITION BY doc_id, gram) > 1 AS again FROM g),
c AS (SELECT doc_id, i, word, max(again::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS 4 PRECEDING) AS near FROM e),
s AS (SELECT doc_id, i, word, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS stretch FROM c WHERE near = 1),
z AS (SELECT doc_id, stretch, min(i) AS first, list(word ORDER BY i) AS w FROM s GROUP BY 1, 2),
q AS (SELECT doc_id, first, w, unnest(range(1, len(w) // 4 + 1)) AS q FROM z),
m AS (SELECT doc_id, first, q, unnest(list_filter(range(1, len(w) - q + 1), lambda k: w[k] = w[k + q])) AS k FROM q),
l AS (SELECT doc_id, first, q, k, k - row_number() OVER (PARTITION BY doc_id, first, q ORDER BY k) AS island FROM m),
f AS (SELECT doc_id, first + min(k) - 1 AS start, count(*) + q AS length, q FROM l GROUP BY doc_id, first, q, island
      HAVING count(*) + q >= greatest(6, 4 * q)),
r AS (SELECT doc_id, start, length, min(q) AS period FROM f GROUP BY doc_id, start, length),
b AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), ''
                                                    ORDER BY start, period) AS lines FROM r GROUP BY doc_id),
x AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length / period DESC, start, period) AS place FROM r),
v AS (SELECT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
k AS (SELECT u.doc_id, string_agg(word, ' ' ORDER BY u.i) AS kept FROM u ANTI JOIN v ON u.doc_id = v.doc_id AND u.i = v.i
      GROUP BY u.doc_id)
SELECT t.doc_id, coalesce(b.n_runs, 0) AS n_runs, x.start, x.length, x.period,
       1000 * x.length // x.period AS exponent_milli, sha256(coalesce(b.lines, '')) AS runs_sha256,
       sha256(coalesce(k.kept, '')) AS collapsed_sha256
FROM t LEFT JOIN b ON t.doc_id = b.doc_id LEFT JOIN x ON t.doc_id = x.doc_id AND x.place = 1
LEFT JOIN k ON t.doc_id = k.doc_id
"""


def _codes(book: str) -> str:
    """Every part with its nearest entry of ``book``; of equal distances the lowest entry."""
    return f"""SELECT vec_id, part, v, arg_min(entry, (dist, entry)) AS entry, min(dist) AS dist FROM (
    SELECT p.vec_id, p.part, p.v, b.entry, list_sum(list_transform(list_zip(p.v, b.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT
           AS dist FROM p JOIN {book} b ON p.part = b.part) GROUP BY ALL"""


def _book(codes: str, book: str) -> str:
    """``book`` with every used entry replaced by the floored mean of its parts."""
    return f"""SELECT b.part, b.entry, coalesce(m.e, b.e) AS e FROM {book} b LEFT JOIN (
    SELECT part, entry, list(c ORDER BY i) AS e FROM (
        SELECT part, entry, i, floor(sum(x) / count(*))::BIGINT AS c
        FROM (SELECT part, entry, unnest(v) AS x, unnest(range(len(v))) AS i FROM {codes}) GROUP BY 1, 2, 3)
    GROUP BY 1, 2) m ON b.part = m.part AND b.entry = m.entry"""


SQL["op13_orchard_codes"] = f"""
WITH k AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x,
                  row_number() OVER (ORDER BY vec_id) - 1 AS place FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
j AS (SELECT vec_id, place, x, unnest(range(16)) AS part FROM k),
p AS MATERIALIZED (SELECT vec_id, place, part, x[part * len(x) // 16 + 1:(part + 1) * len(x) // 16] AS v FROM j),
b0 AS (SELECT part, place AS entry, v AS e FROM p WHERE place < 64),
c0 AS MATERIALIZED ({_codes("b0")}),
b1 AS MATERIALIZED ({_book("c0", "b0")}),
c1 AS MATERIALIZED ({_codes("b1")}),
b2 AS MATERIALIZED ({_book("c1", "b1")}),
c2 AS MATERIALIZED ({_codes("b2")}),
r AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(dist)::BIGINT AS error
      FROM c2 GROUP BY vec_id),
s AS (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b2)
SELECT r.vec_id, r.code, r.error, (sum(r.error) OVER (PARTITION BY k.label))::BIGINT AS label_error, s.codebooks_sha256
FROM r JOIN k ON r.vec_id = k.vec_id CROSS JOIN s
"""
