"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

#: Lines and their keys; the document's id, the line's number from 0.
LINES = r"""
lines AS (
    SELECT doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line,
                 generate_subscripts(string_split(t, chr(10)), 1) AS i
          FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))
)"""

#: All pairs by brute force; components by closing the links.
OP7 = r"""
WITH RECURSIVE
vectors AS (
    SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
units AS (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS norm FROM vectors WHERE list_dot_product(v, v) > 0),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM units a, units b
    WHERE a.vec_id <> b.vec_id
      AND CASE WHEN len(a.v) = len(b.v) THEN list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.95 ELSE false END),
reached AS (
    SELECT vec_id AS a, vec_id AS b FROM embeddings
    UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
components AS (SELECT a, min(b) AS component_id FROM reached GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN components ON vec_id = components.a
"""

#: Each word with the window that starts at it; a word goes if one of the 50 windows that end at it or after starts in a smaller document.
OP9 = r"""
WITH split AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents),
words AS (
    SELECT doc_id, i, w[i] AS word, CASE WHEN i + 49 <= len(w) THEN md5(array_to_string(w[i:i + 49], ' ')) END AS passage
    FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM split)),
starts AS (
    SELECT doc_id, i, word, passage IS NOT NULL AND doc_id > min(doc_id) OVER (PARTITION BY passage) AS lost FROM words),
marked AS (
    SELECT doc_id, i, word, bool_or(lost) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
    FROM starts),
left_over AS (
    SELECT doc_id, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept
    FROM marked GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM split LEFT JOIN left_over USING (doc_id)
"""

OP10 = rf"""
WITH {LINES},
hot AS (SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT l.*, h.key IS NOT NULL AS gone FROM lines l LEFT JOIN hot h ON l.key = h.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


#: The CRC of a byte on its own by the reversed polynomial; the CRC of a string folds its bytes through that table.
OP12 = r"""
WITH RECURSIVE
folded AS (
    SELECT 0 AS step, range AS byte, range AS crc FROM range(256)
    UNION ALL
    SELECT step + 1, byte, CASE WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END FROM folded WHERE step < 8),
crcs AS (SELECT list(crc ORDER BY byte) AS crcs FROM folded WHERE step = 8),
texts AS (
    SELECT 'd' AS side, doc_id AS id, text FROM documents
    UNION ALL SELECT 't', item_id, text FROM benchmark),
words AS (
    SELECT side, id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
    FROM texts),
features AS (
    SELECT side, id, unnest(list_concat(w, list_concat(
        list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1]),
        list_transform(range(1, greatest(len(w) - 1, 1)), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])))) AS f
    FROM words),
bytes AS (
    SELECT f, hex(encode(f)) AS x FROM (SELECT DISTINCT f FROM features)),
crc AS (
    SELECT f, xor(list_reduce(list_transform(range(0, len(x) // 2),
        lambda i: ('0x' || x[2 * i + 1:2 * i + 2])::BIGINT),
        lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
    FROM bytes, crcs),
placed AS (SELECT side, id, bucket FROM features JOIN crc USING (f)),
counts AS (
    SELECT b.range AS bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 't') AS t
    FROM range(10000) b LEFT JOIN placed ON bucket = b.range GROUP BY 1),
gains AS (
    SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((sum(s) OVER ()) + 10000)::DOUBLE
        / ((s + 1)::DOUBLE * ((sum(t) OVER ()) + 10000)::DOUBLE)))::BIGINT AS gain
    FROM counts),
weights AS (
    SELECT id, count(*) AS n_features, sum(gain)::BIGINT AS weight
    FROM placed JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id),
scored AS (
    SELECT w.id AS doc_id, len(w.w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
           coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || left(sha256('42:' || w.id), 8))::BIGINT + 0.5)
               / 4294967296.0::DOUBLE)))::BIGINT AS score
    FROM words w LEFT JOIN weights g ON w.id = g.id WHERE w.side = 'd'),
ranked AS (
    SELECT *, CASE WHEN n_words >= 20 THEN row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) END AS place,
           5 * count(*) FILTER (n_words >= 20) OVER () // 100 AS drawn
    FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank FROM ranked
"""

OP13 = r"""
WITH words AS (
    SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents),
failed AS (
    SELECT doc_id, part, [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
        100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t), regexp_matches(t, '[#$%&*|]'),
        doc_id > min(doc_id) OVER (PARTITION BY t)] AS fails
    FROM words),
docs AS (
    SELECT part, fails, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic
    FROM failed LEFT JOIN labels USING (doc_id)),
cells AS (
    SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM docs GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
    SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (
    SELECT filter_order, step::INTEGER AS step, filter_order[step] AS f, position(filter_order[step] IN 'ABCDE') AS own,
           list_transform(range(1, step), lambda i: position(filter_order[i] IN 'ABCDE')) AS before
    FROM orders, range(1, 6) r(step)),
marked AS (
    SELECT part, filter_order, step, f, n, good, toxic, fails[own] AS own_fails,
           coalesce(list_bool_or(list_transform(before, lambda i: fails[i])), false) AS earlier,
           len(list_filter(fails, lambda x: x)) = 1 AND fails[own] AS alone
    FROM cells, steps),
summed AS (
    SELECT part, filter_order, step, f,
           coalesce(sum(n) FILTER (NOT earlier AND NOT own_fails), 0)::BIGINT AS kept,
           coalesce(sum(n) FILTER (NOT earlier AND own_fails), 0)::BIGINT AS removed,
           coalesce(sum(n) FILTER (earlier AND own_fails), 0)::BIGINT AS redundant,
           coalesce(sum(n) FILTER (alone), 0)::BIGINT AS unique_fails,
           coalesce(sum(good) FILTER (NOT earlier AND own_fails), 0)::BIGINT AS good_lost,
           coalesce(sum(toxic) FILTER (NOT earlier AND own_fails), 0)::BIGINT AS toxic_lost
    FROM marked GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM summed
"""


def oracle_sql() -> dict[str, str]:
    return {"op7_embedding_dedup": OP7, "op9_substring_dedup": OP9, "op10_line_dedup": OP10, "op12_importance_resampling": OP12,
            "op13_filter_audit": OP13}
