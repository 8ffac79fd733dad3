"""SQL twins of the corpus queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from . import decontaminate, hash_ring, host_quality, jaccard, repeats

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = f"translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}')"
LOWER_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"
FORM_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_Q = host_quality


def _soft(scale: str) -> str:
    return (
        f"(100 * n_symbols > {scale} * {_Q.SYMBOLS} * n_words OR 100 * n_shouts > {scale} * {_Q.SHOUTS} * n_words OR"
        f" 100 * n_dup_lines > {scale} * {_Q.DUP_LINES} * n_lines OR 100 * word_chars > {_Q.MEAN_WORD} * n_words)"
    )


OP1 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source AS host, coalesce(text, '') AS text, {WORDS} AS words FROM documents),
l AS (SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
w AS (SELECT rid, i, array_to_string(words[i:i + {_Q.WINDOW - 1}], ' ') AS k FROM d, unnest(range(1, len(words) - {_Q.WINDOW - 2})) AS t(i)),
twice AS (SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, k) AS n FROM w) WHERE n > 1),
hit AS (SELECT rid, count(DISTINCT j) AS n FROM (SELECT rid, unnest(range(i, i + {_Q.WINDOW})) AS j FROM twice) GROUP BY rid),
c AS (
  SELECT doc_id, host, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars, len(lines) AS n_lines,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, length(regexp_replace(text, '[^!]', '', 'g')) AS n_shouts,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(hit.n, 0) AS n_repeat_words
  FROM l LEFT JOIN hit USING (rid)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM c),
h AS (SELECT host, count(*) AS n, count(*) FILTER (base_failed OR {_soft('1.0')}) AS f FROM b GROUP BY host),
p AS (SELECT sum(f) / sum(n) AS m, var_pop(f / n) AS v FROM h),
q AS (SELECT m, CASE WHEN v > 0 THEN greatest({_Q.LEAST_WEIGHT}, least({_Q.MOST_WEIGHT}, m * (1 - m) / v - 1)) ELSE {_Q.MOST_WEIGHT} END AS weight FROM p),
j AS (SELECT host, CASE WHEN 100 * (f + m * weight) / (n + weight) < {_Q.TRUSTED} THEN 'trusted'
                       WHEN 100 * (f + m * weight) / (n + weight) > {_Q.STRICT} THEN 'strict' ELSE 'usual' END AS host_verdict FROM h, q)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND NOT {_soft(f"CASE host_verdict WHEN 'trusted' THEN {_Q.STRETCH} WHEN 'strict' THEN {_Q.TIGHTEN} ELSE 1.0 END")} AS kept,
       host_verdict
FROM b JOIN j ON b.host IS NOT DISTINCT FROM j.host"""

_S = repeats.WINDOW
OP6 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {WORDS} AS words FROM documents),
w AS (SELECT rid, doc_id, i, array_to_string(words[i:i + {_S - 1}], ' ') AS k FROM d, unnest(range(1, len(words) - {_S - 2})) AS t(i)),
late AS (SELECT rid, i FROM (SELECT rid, i, doc_id > min(doc_id) OVER (PARTITION BY k) AS again FROM w) WHERE again),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + {_S})) AS j FROM late),
one AS (SELECT rid, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS j FROM d),
kept AS (SELECT rid, count(gone.j) AS n_removed, string_agg(word, ' ' ORDER BY one.j) FILTER (gone.j IS NULL) AS t
         FROM one LEFT JOIN gone USING (rid, j) GROUP BY rid)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)"""

_N = decontaminate.WINDOW
OP9 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {FORM_WORDS} AS words FROM documents),
b AS (SELECT item_id, {FORM_WORDS} AS words FROM benchmark WHERE item_id IS NOT NULL),
p AS (SELECT DISTINCT item_id, least(len(words), {_N}) AS n, array_to_string(words[i:i + {_N - 1}], ' ') AS k
      FROM b, unnest(range(1, greatest(len(words) - {_N - 1}, 1) + 1)) AS t(i) WHERE len(words) > 0),
w AS (SELECT rid, i, n, array_to_string(words[i:i + n - 1], ' ') AS k
      FROM d, (SELECT DISTINCT n FROM p) AS sizes, unnest(range(1, len(words) - n + 2)) AS t(i)),
m AS (SELECT rid, i, n, item_id FROM w JOIN p USING (n, k)),
hit AS (SELECT rid, count(DISTINCT j) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS j FROM m) GROUP BY rid),
ids AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s
        FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY rid)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN ids USING (rid)"""

_K = jaccard.SIZE
OP10 = rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, {LOWER_WORDS} AS words FROM documents),
s AS (SELECT DISTINCT rid, array_to_string(words[i:i + {_K - 1}], ' ') AS k
      FROM d, unnest(range(1, greatest(len(words) - {_K - 1}, 1) + 1)) AS t(i) WHERE len(words) > 0),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
shared AS (SELECT a.rid AS a, b.rid AS b, count(*) AS common FROM s a JOIN s b ON a.k = b.k AND a.rid <> b.rid GROUP BY 1, 2),
link AS (SELECT a, b FROM shared JOIN n x ON x.rid = a JOIN n y ON y.rid = b WHERE 100 * common >= {jaccard.PERCENT} * (x.n + y.n - common)),
reach(a, b) AS (SELECT rid, rid FROM d UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least.component_id
FROM d LEFT JOIN n USING (rid)
JOIN (SELECT reach.a AS rid, min(o.doc_id) AS component_id FROM reach JOIN d o ON o.rid = reach.b GROUP BY 1) AS least USING (rid)"""

_R = hash_ring
# The table of the reflected polynomial 0xEDB88320 for four bits.
_CRC = (
    "[0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948, 3988292384, 4027552580,"
    " 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]"
)
_BITS = r"string_split(regexp_replace(hex(encode(text)), '(.)(.)', '\2\1', 'g'), '')"
# Checksum of the bytes by halves, the lower half of each first.
_CRC32 = (
    f"CASE WHEN text = '' THEN 0 ELSE xor(list_reduce([4294967295] || list_transform({_BITS}, lambda x: instr('0123456789ABCDEF', x) - 1),"
    f" lambda c, b: xor(c >> 4, {_CRC}[(xor(c, b) & 15) + 1])), 4294967295) END"
)


def _place(name: str) -> str:
    return f"CAST('0x' || substr(md5({name}), 1, 8) AS BIGINT)"


# Row by row along the ring, where the operator cuts whole arcs.
OP12 = rf"""
WITH RECURSIVE t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
d AS MATERIALIZED (SELECT doc_id, CAST(strlen(text) + {_R.ROW_BYTES} AS BIGINT) AS size, CAST({_CRC32} AS BIGINT) AS text_crc32,
      {_place("coalesce(CAST(doc_id AS VARCHAR), '')")} AS place FROM t),
node AS MATERIALIZED (SELECT row_number() OVER (ORDER BY cell, s) - 1 AS i, s, cell FROM (SELECT s, {_place("s || '#' || v")} >> {32 - _R.CELL_BITS} AS cell
      FROM range({_R.SHARDS}) AS a(s), range({_R.VNODES}) AS b(v))),
walk AS MATERIALIZED (SELECT i, list(s ORDER BY away) AS walk FROM (SELECT a.i, b.s, min((b.i - a.i + {_R.SHARDS * _R.VNODES}) % {_R.SHARDS * _R.VNODES}) AS away
      FROM node a, node b GROUP BY 1, 2) GROUP BY i),
n AS MATERIALIZED (SELECT row_number() OVER (ORDER BY place, doc_id NULLS FIRST, text_crc32, size) AS k, *,
      (SELECT count(*) FROM node WHERE cell < place >> {32 - _R.CELL_BITS}) % {_R.SHARDS * _R.VNODES} AS i FROM d),
keys AS MATERIALIZED (SELECT k, walk FROM n JOIN walk USING (i)),
gone AS (
  SELECT CAST(0 AS BIGINT) AS k, list_transform(range({_R.SHARDS}), lambda s: rows // {_R.SHARDS} + CAST(s < rows % {_R.SHARDS} AS BIGINT)) AS rooms,
         CAST(NULL AS BIGINT) AS shard FROM (SELECT count(*) AS rows FROM d)
  UNION ALL
  SELECT k, list_transform(range({_R.SHARDS}), lambda s: rooms[s + 1] - CAST(s = shard AS BIGINT)), shard
  FROM (SELECT keys.k, rooms, list_filter(walk, lambda s: rooms[s + 1] > 0)[1] AS shard FROM gone JOIN keys ON keys.k = gone.k + 1))
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(shard AS INTEGER) AS shard, row_number() OVER (PARTITION BY shard ORDER BY k) - 1 AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM n JOIN gone USING (k)"""
