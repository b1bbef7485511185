"""DuckDB SQL of the queries that SQL can express."""

WORD = r"[^\x20\x09-\x0D]+"

QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT k, doc_id, t, regexp_extract_all(t, '{WORD}') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls FROM d),
g AS (SELECT k, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) > 3),
h AS (SELECT k, i, count(*) OVER (PARTITION BY k, ws[i], ws[i + 1], ws[i + 2]) AS n FROM g),
r AS (SELECT k, sum(least(3, nxt - i)) AS repeats FROM (SELECT k, i, coalesce(lead(i) OVER (PARTITION BY k ORDER BY i), i + 3) AS nxt FROM h WHERE n > 1) GROUP BY k),
l AS (SELECT k, unnest(list_distinct(ls)) AS line FROM w),
m AS (
  SELECT k, length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g')) AS chars, line, len(regexp_extract_all(line, '{WORD}')) AS n,
    len(regexp_extract_all(line, '[^\x20\x09-\x0D#*$%&|<>]*[#*$%&|<>][^\x20\x09-\x0D]*')) AS marked,
    len(list_filter(regexp_extract_all(line, '{WORD}'), lambda x: contains(x, '!!'))) AS shouted
  FROM l),
p AS (
  SELECT k, sum(chars) AS chars FROM m
  WHERE NOT (100 * marked >= 30 * n OR 100 * shouted >= 50 * n OR (n >= 8 AND NOT regexp_matches(line, '[.!?…。！？｡।॥؟۔։።፧។။]'))
    OR (n <= 30 AND regexp_matches(lower(line), 'cookie|javascript|all rights reserved|click here|subscribe|terms of (use|service)|privacy policy|lorem ipsum')))
  GROUP BY k),
f AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(r.repeats, 0)::BIGINT AS n_repeat_words, coalesce(p.chars, 0) AS kept_chars
  FROM w LEFT JOIN r USING (k) LEFT JOIN p USING (k))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * (word_chars - kept_chars) <= 30 * word_chars AS kept
FROM f
"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha1(html) AS hex FROM p),
b AS (SELECT *, array_to_string(list_transform(range(8), lambda k: list_transform(range(4), lambda j:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, 5 * k + 1, 5))::BIGINT >> (15 - 5 * j)) & 31)::INT, 1)).list_aggregate('string_agg', '')), '') AS payload_digest FROM d),
g AS (SELECT *, count(*) OVER (PARTITION BY payload_digest) AS copies, max(page_id) OVER (PARTITION BY payload_digest) AS first FROM b)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN copies > 1 AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN copies > 1 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM g
"""


#: Every place of a key phrase, searched word by word without an index.
LICENSES = r"""
WITH t0(t, label, template, key) AS (VALUES
  (1, 'agpl', 'under the terms of the gnu affero general public license', 'affero general public license'),
  (2, 'apache-2.0', 'licensed under the apache license version 2 0', 'apache license'),
  (3, 'bsd', 'redistribution and use in source and binary forms with or without modification are permitted', 'source and binary forms'),
  (4, 'cc-by-nc', 'licensed under cc by nc 4 0', 'cc by nc'),
  (5, 'cc-by-nd', 'licensed under cc by nd 4 0', 'cc by nd'),
  (6, 'cc-by-sa', 'licensed under cc by sa 4 0', 'cc by sa'),
  (7, 'cc-by', 'licensed under the creative commons attribution 4 0 international license', 'creative commons attribution'),
  (8, 'cc0', 'creative commons cc0 1 0 universal public domain dedication', 'cc0 1 0 universal'),
  (9, 'gpl', 'under the terms of the gnu general public license as published by the free software foundation', 'gnu general public license'),
  (10, 'isc', 'permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted', 'permission to use copy modify'),
  (11, 'lgpl', 'under the terms of the gnu lesser general public license', 'lesser general public license'),
  (12, 'mit', 'permission is hereby granted free of charge to any person obtaining a copy of this software', 'permission is hereby granted free of charge'),
  (13, 'mpl-2.0', 'this source code form is subject to the terms of the mozilla public license v 2 0', 'mozilla public license'),
  (14, 'reserved', 'copyright all rights reserved', 'all rights reserved'),
  (15, 'unlicense', 'this is free and unencumbered software released into the public domain', 'free and unencumbered software'),
  (16, 'bsd', 'released under the bsd license', 'bsd license'),
  (17, 'bsd', 'released under the bsd 2 clause license', 'bsd 2 clause'),
  (18, 'bsd', 'released under the bsd 3 clause license', 'bsd 3 clause'),
  (19, 'isc', 'released under the isc license', 'isc license'),
  (20, 'mit', 'released under the mit license', 'mit license'),
  (21, 'mpl-2.0', 'released under the mozilla public license version 2 0', 'mozilla public license'),
  (22, 'mpl-2.0', 'released under the mpl 2 0', 'released under the mpl'),
  (23, 'mpl-2.0', 'licensed under the mpl 2 0', 'licensed under the mpl'),
  (24, 'unlicense', 'released under the unlicense', 'released under the unlicense'),
  (25, 'unlicense', 'licensed under the unlicense', 'licensed under the unlicense')),
t AS (SELECT t, label, string_split(template, ' ') AS words, string_split(key, ' ') AS key,
    len(string_split(trim(split_part(' ' || template || ' ', ' ' || key || ' ', 1)), ' ')) * (NOT starts_with(template, key))::INT AS ahead FROM t0),
q(label, phrase) AS (VALUES ('cc-by', 'cc by'), ('gpl', 'general public license'), ('reserved', 'all rights reserved')),
d AS (SELECT row_number() OVER () AS k, doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
n AS (SELECT k, ws, unnest(range(1, len(ws) + 1)) AS i FROM d),
f AS (SELECT k, label, (SELECT avg(CASE WHEN i - ahead + p >= 1 AND ws[i - ahead + p] = words[p + 1] THEN 1.0 ELSE 0.0 END) FROM (SELECT unnest(range(len(words))) AS p)) AS score
  FROM n JOIN t ON ws[i] = t.key[1] AND ws[i:i + len(t.key) - 1] = t.key),
b AS (SELECT k, label, i FROM n JOIN q ON ws[i] = split_part(phrase, ' ', 1) AND ws[i:i + len(string_split(phrase, ' ')) - 1] = string_split(phrase, ' ')),
bb AS (SELECT k, count(*) AS n_base, min(i) - 1 AS first_word, max(i) - 1 AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM b GROUP BY k),
s AS (SELECT k, max(score) AS score FROM f GROUP BY k),
l AS (SELECT k, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT k, label FROM b UNION ALL SELECT k, label FROM f) GROUP BY k)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(s.score, 0.0) END::DOUBLE AS score
FROM d LEFT JOIN bb USING (k) LEFT JOIN s USING (k) LEFT JOIN l USING (k)
"""


#: Sources as lines of words in hash order, cut into blocks, blocks in hash order; the shards don't change what is taken.
MIX = rf"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, source, coalesce('s' || source, 'n') AS sk, coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size,
    md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS h FROM documents),
s0 AS (SELECT sk, any_value(source) AS source, sum(size)::BIGINT AS source_size FROM d GROUP BY sk),
s1 AS (SELECT *, [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w, source_size * 2.0::DOUBLE AS cap FROM s0),
s2 AS (SELECT *, row_number() OVER fill AS place,
    (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER (fill ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
      / sum(w) OVER (fill ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM s1 WINDOW fill AS (ORDER BY cap / w, source NULLS LAST)),
s3 AS (SELECT *, min(CASE WHEN level * w <= cap THEN place END) OVER () AS first FROM s2),
s4 AS (SELECT *, CASE WHEN first IS NULL OR place < first THEN cap ELSE max(CASE WHEN place = first THEN level END) OVER () * w END AS target FROM s3),
s AS (SELECT sk, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS passes,
    greatest(ceil(source_size / 256.0), 1)::BIGINT AS block FROM s4),
b0 AS (SELECT sk, block, source_size, round(target - passes * source_size)::BIGINT AS rest,
    unnest(range(0, ceil(source_size / block::DOUBLE)::BIGINT)) AS b FROM s),
b1 AS (SELECT *, least(block, source_size - b * block) AS len, md5('mix:' || sk || ':' || b) AS key FROM b0),
b AS (SELECT sk, b * block AS lo, b * block + greatest(0, least(len, rest - sum(len) OVER (PARTITION BY sk ORDER BY key, b) + len)) AS hi FROM b1),
p AS (SELECT d.*, s.source_size, s.target, s.passes,
    sum(size) OVER (PARTITION BY sk ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS start FROM d JOIN s USING (sk)),
o AS (SELECT k, sum(least(p.start + p.size, b.hi) - greatest(p.start, b.lo)) AS part FROM p JOIN b ON p.sk = b.sk AND b.hi > p.start AND b.lo < p.start + p.size AND b.hi > b.lo GROUP BY k)
SELECT doc_id, size, source_size, target::DOUBLE AS target, (passes * size + coalesce(part, 0))::BIGINT AS taken FROM p LEFT JOIN o USING (k)
"""

#: All pairs with a common shingle: exact, for tables as small as the correctness check's.
NEAR_DUPLICATES = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS ws FROM documents),
sh AS (SELECT DISTINCT k, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s FROM d),
n AS (SELECT k, count(*) AS n FROM sh GROUP BY k),
p AS (SELECT a.k AS x, b.k AS y, count(*) AS c FROM sh a JOIN sh b USING (s) WHERE a.k <> b.k GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n nx ON nx.k = x JOIN n ny ON ny.k = y WHERE 100 * c >= 75 * (nx.n + ny.n - c)),
r(k, other) AS (SELECT k, k FROM d UNION SELECT r.k, e.y FROM r JOIN e ON e.x = r.other),
m AS (SELECT r.k, min(o.doc_id) AS component_id FROM r JOIN d o ON o.k = r.other GROUP BY r.k)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM d JOIN m USING (k) LEFT JOIN n USING (k)
"""

#: Shingles by position, hashes as hexadecimal text; the next document by a plain window.
FINGERPRINTS = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n_chars FROM documents),
n AS (SELECT *, coalesce(lead(t) OVER (ORDER BY doc_id), first(t) OVER (ORDER BY doc_id)) AS nxt FROM d),
e AS (SELECT doc_id, n_chars, t, nxt, substr(t, 1, n_chars - n_chars // 4) || substr(nxt, 1, n_chars // 4) AS ed FROM n),
x AS (SELECT doc_id, unnest([0, 1, 2]) AS kind, unnest([t, ed, nxt]) AS t FROM e),
w AS (SELECT doc_id, kind, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda v: v <> '') AS ws FROM x),
h AS (SELECT doc_id, kind, CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: md5(array_to_string(ws[i:i + 4], ' '))[1:8])
    WHEN len(ws) > 0 THEN [md5(array_to_string(ws, ' '))[1:8]] ELSE [] END AS hs FROM w),
k AS (SELECT *, list_sort(list_distinct(list_filter(hs, lambda v: v < '40000000'))) AS low FROM h),
s AS (SELECT doc_id, kind, CASE WHEN len(low) > 0 THEN low WHEN len(hs) > 0 THEN [list_min(hs)] ELSE [] END AS sk FROM k),
f AS (SELECT a.doc_id, a.sk AS sa, b.sk AS sb, c.sk AS sc FROM s a JOIN s b ON a.doc_id = b.doc_id AND b.kind = 1 JOIN s c ON a.doc_id = c.doc_id AND c.kind = 2 WHERE a.kind = 0)
SELECT doc_id, n_chars, sha256(ed) AS edited_sha256, array_to_string(sa, '') AS fingerprint, array_to_string(sb, '') AS edited_fingerprint,
  (CASE WHEN sa = sb THEN 1.0 WHEN least(len(sa), len(sb)) = 0 THEN 0.0 ELSE len(list_intersect(sa, sb))::DOUBLE / least(len(sa), len(sb)) END)::DOUBLE AS near_edited,
  (CASE WHEN sa = sc THEN 1.0 WHEN least(len(sa), len(sc)) = 0 THEN 0.0 ELSE len(list_intersect(sa, sc))::DOUBLE / least(len(sa), len(sc)) END)::DOUBLE AS near_next
FROM f JOIN e USING (doc_id)
"""

#: Every document scored for every item.
RANKED = r"""
WITH tok AS (SELECT row_number() OVER () AS k, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents),
tf AS (SELECT k, doc_id, t, count(*) AS tf FROM tok GROUP BY ALL),
n AS (SELECT k, sum(tf)::BIGINT AS n FROM tf GROUP BY k),
s AS (SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS l FROM n),
df AS (SELECT t, count(*)::BIGINT AS df FROM tf GROUP BY t),
q AS (SELECT DISTINCT j, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM (SELECT row_number() OVER () AS j, * FROM benchmark)),
w AS (SELECT j, item_id, t, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM q JOIN df USING (t), s),
c AS (SELECT j, item_id, k, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * nd) // l))))::BIGINT AS score
  FROM w JOIN tf USING (t) JOIN n USING (k), s GROUP BY ALL),
r AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY j ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM c WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM r WHERE rank <= 50
"""

ORACLE = {
    "op3_near_duplicates": NEAR_DUPLICATES,
    "op7_warc": WARC,
    "op8_licenses": LICENSES,
    "op9_mix_sources": MIX,
    "op4_quality_rules": QUALITY,
    "op12_fingerprints": FINGERPRINTS,
    "op13_ranked_search": RANKED,
}
