"""DuckDB SQL equivalents of the registered queries (same column names).

Tables ``documents``, ``events``, ``labels`` … are views over the same parquet files.
``U(x)`` in the comments is the 5-second bucket
``time_bucket(INTERVAL '5 seconds', x, TIMESTAMP '1970-01-01')``.
"""

from __future__ import annotations

WORD_RE = "'[A-Za-z'']+'"
TAG_RE = "'[#@]+[A-Za-z'']+'"
U = "time_bucket(INTERVAL '5 seconds', ts, TIMESTAMP '1970-01-01')"

_LINES = "SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents"
_LINES_POS = f"""
    SELECT doc_id, unnest(parts) AS line, unnest(generate_series(0, len(parts) - 1)) AS line_no
    FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)"""
_STRIP = r"regexp_replace(line, '^\s+|\s+$', '', 'g')"


def _first_seen(pattern: str, name: str) -> str:
    return f"""
    WITH toks AS (
        SELECT doc_id, unnest(arr) AS {name}, unnest(generate_series(0, len(arr) - 1)) AS pos
        FROM (SELECT doc_id, regexp_extract_all(text, {pattern}) AS arr FROM documents)
        WHERE len(arr) > 0),
    firsts AS (SELECT {name}, min(doc_id) AS d FROM toks GROUP BY 1),
    firstpos AS (
        SELECT t.{name}, t.doc_id AS d, min(t.pos) AS p
        FROM toks t JOIN firsts f ON t.{name} = f.{name} AND t.doc_id = f.d GROUP BY 1, 2)
    SELECT {name}, (row_number() OVER (ORDER BY d, p, {name}) - 1)::BIGINT AS idx FROM firstpos"""


_LEXICON = ", ".join(
    f"('{w}', '{c}')"
    for w, c in [
        ("best", "positive"),
        ("good", "positive"),
        ("great", "positive"),
        ("love", "positive"),
        ("excellent", "positive"),
        ("worthless", "negative"),
        ("bad", "negative"),
        ("hate", "negative"),
        ("poor", "negative"),
        ("terrible", "negative"),
    ]
)

def _track_many() -> str:
    from brook.plans.queries import TOPICS_MANY

    ors = " OR ".join(f"contains(lower(text), '{t}')" for t in TOPICS_MANY)
    return f"SELECT doc_id FROM documents WHERE lang IN ('en') AND ({ors})"


_LEXICON_SQL = f"""
        WITH lex(w, cls) AS (VALUES {_LEXICON}),
        toks AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), {WORD_RE})) AS w FROM documents),
        hits AS (
            SELECT doc_id, count(*) AS nt,
                   count(*) FILTER (WHERE lex.cls = 'positive') AS p,
                   count(*) FILTER (WHERE lex.cls = 'negative') AS ng
            FROM toks LEFT JOIN lex USING (w) GROUP BY 1)
        SELECT d.doc_id, coalesce(nt, 0) AS n_tokens, coalesce(p, 0) AS pos_hits, coalesce(ng, 0) AS neg_hits,
               CASE WHEN coalesce(nt, 0) = 0 THEN 0.0 ELSE p / nt END AS positive,
               CASE WHEN coalesce(nt, 0) = 0 THEN 1.0 ELSE (nt - p - ng) / nt END AS neutral,
               CASE WHEN coalesce(nt, 0) = 0 THEN 0.0 ELSE ng / nt END AS negative
        FROM documents d LEFT JOIN hits USING (doc_id)"""

# naive Bayes by counts; weights in whole millionths
_MODEL_SQL = f"""
        WITH lab AS (SELECT doc_id, CASE WHEN toxic = 1 THEN 2 WHEN quality = 1 THEN 0 ELSE 1 END AS c FROM labels),
        tr AS (SELECT c, unnest(regexp_extract_all(lower(text), {WORD_RE})) AS w FROM documents JOIN lab USING (doc_id)),
        cnt AS (SELECT w, count(*) FILTER (c = 0) AS c0, count(*) FILTER (c = 1) AS c1, count(*) FILTER (c = 2) AS c2 FROM tr GROUP BY w),
        n AS (SELECT count(*) AS v, sum(c0) AS n0, sum(c1) AS n1, sum(c2) AS n2 FROM cnt),
        p AS (SELECT count(*) AS d, count(*) FILTER (c = 0) AS d0, count(*) FILTER (c = 1) AS d1, count(*) FILTER (c = 2) AS d2
              FROM documents JOIN lab USING (doc_id)),
        wt AS (SELECT w, round(ln((c0 + 1.0::DOUBLE) / (n0 + v)::DOUBLE) * 1000000)::BIGINT AS w0,
                      round(ln((c1 + 1.0::DOUBLE) / (n1 + v)::DOUBLE) * 1000000)::BIGINT AS w1,
                      round(ln((c2 + 1.0::DOUBLE) / (n2 + v)::DOUBLE) * 1000000)::BIGINT AS w2 FROM cnt, n),
        tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), {WORD_RE})) AS w FROM documents),
        s AS (SELECT doc_id, sum(w0) AS s0, sum(w1) AS s1, sum(w2) AS s2 FROM tok JOIN wt USING (w) GROUP BY doc_id),
        t AS (SELECT documents.doc_id, (coalesce(s0, 0) + round(ln(d0::DOUBLE / d) * 1000000))::BIGINT AS s0,
                     (coalesce(s1, 0) + round(ln(d1::DOUBLE / d) * 1000000))::BIGINT AS s1,
                     (coalesce(s2, 0) + round(ln(d2::DOUBLE / d) * 1000000))::BIGINT AS s2
              FROM documents LEFT JOIN s USING (doc_id), p),
        e AS (SELECT doc_id, exp((s0 - greatest(s0, s1, s2)) / 1000000.0::DOUBLE) AS e0, exp((s1 - greatest(s0, s1, s2)) / 1000000.0::DOUBLE) AS e1,
                     exp((s2 - greatest(s0, s1, s2)) / 1000000.0::DOUBLE) AS e2 FROM t)
        SELECT doc_id, round(e0 / (e0 + e1 + e2), 6) AS positive, round(e1 / (e0 + e1 + e2), 6) AS neutral,
               round(e2 / (e0 + e1 + e2), 6) AS negative FROM e"""

_SLIDING = f"""
    SELECT {U} - to_seconds(5 * r.i) AS ws, event_type, ts
    FROM events, (SELECT unnest(range(12)) AS i) r"""

def _tag_lists(closed: str) -> str:
    """Ranked tag lists per window; a post of an event has the tags #type, @user and #types."""
    return f"""
        WITH t AS (
            SELECT event_id, {U} AS ws, unnest(['#' || event_type, '@user', '#' || event_type || 's']) AS whole, unnest([0, 1, 2]) AS pos FROM events),
        k AS (SELECT event_id, ws, regexp_extract(whole, '[#@]+[A-Za-z'']+') AS token, pos FROM t WHERE regexp_matches(whole, '[#@]+[A-Za-z'']+')),
        idx AS (SELECT token, row_number() OVER (ORDER BY min((event_id, pos)), token) - 1 AS idx FROM k GROUP BY token),
        c AS (SELECT ws, token || '_' || idx AS token_idx, count(*) AS n FROM k JOIN idx USING (token) GROUP BY ALL)
        SELECT ws, string_agg(token_idx || ':' || n, ',' ORDER BY n DESC, token_idx) AS ranked FROM c WHERE {closed} GROUP BY ws"""


def _pages(closed: str) -> str:
    return f"""
        WITH c AS (SELECT time_bucket(INTERVAL '1 day', ts, TIMESTAMP '1970-01-01') AS ws, concat_ws('_', event_type, user_id) AS token, count(*) AS n
            FROM events GROUP BY ALL),
        r AS (SELECT *, row_number() OVER (PARTITION BY ws ORDER BY n DESC, token) - 1 AS r FROM c WHERE {closed})
        SELECT ws, (r // 100)::BIGINT AS page, string_agg(token || ':' || n, ',' ORDER BY r) AS ranked FROM r GROUP BY ALL"""


_LOG_SQL = """
        SELECT [props || chr(10) || event_type, props || chr(13) || chr(10), '', NULL, props][event_id % 5 + 1] AS value, ts, event_type AS kind,
            CASE WHEN event_id % 3 > 0 THEN user_id::VARCHAR END AS user, CASE WHEN event_id % 3 > 0 THEN 2 ELSE 1 END::INT AS n_headers FROM events"""

_MIXED_SQL = """
        SELECT event_id, coalesce(['{"j": 1}', '{"j": {"k": 1}}', '{"k": null}', '{}', NULL][event_id % 5 + 1], props) AS props FROM events"""

# arrival in four parts; a part's watermark is the largest time of the parts before less 10 seconds
_MARKED_SQL = f"""
        WITH a AS (SELECT *, epoch_us(ts) + CASE WHEN event_id % 10 = 0 THEN 12 * 86400000000 ELSE 0 END AS arrival FROM events),
        b AS (SELECT min(arrival) AS lo, max(arrival) - min(arrival) + 1 AS w FROM a),
        p AS (SELECT a.*, (arrival >= lo + w * 1 // 4)::INT + (arrival >= lo + w * 2 // 4)::INT + (arrival >= lo + w * 3 // 4)::INT AS part FROM a, b),
        m AS (SELECT k.part, date_trunc('milliseconds', max(p.ts)) - INTERVAL 10 SECOND AS watermark
              FROM (SELECT unnest([1, 2, 3]) AS part) k JOIN p ON p.part < k.part GROUP BY 1),
        x AS (SELECT p.*, watermark, coalesce({U} + INTERVAL 5 SECOND <= watermark, false) AS is_late FROM p LEFT JOIN m USING (part))"""

_LARGE_LEXICON_SQL = f"""
        WITH toks AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), {WORD_RE})) AS w FROM documents),
        lex AS (SELECT DISTINCT w, CASE WHEN md5(w)[1] <= '5' THEN 'positive' WHEN md5(w)[1] <= 'b' THEN 'negative' ELSE 'neutral' END AS cls FROM toks),
        hits AS (
            SELECT doc_id, count(*) AS nt, count(*) FILTER (WHERE cls = 'positive') AS p, count(*) FILTER (WHERE cls = 'negative') AS ng
            FROM toks JOIN lex USING (w) GROUP BY 1)
        SELECT d.doc_id, coalesce(nt, 0) AS n_tokens, coalesce(p, 0) AS pos_hits, coalesce(ng, 0) AS neg_hits,
               CASE WHEN coalesce(nt, 0) = 0 THEN 0.0 ELSE p / nt END AS positive,
               CASE WHEN coalesce(nt, 0) = 0 THEN 1.0 ELSE (nt - p - ng) / nt END AS neutral,
               CASE WHEN coalesce(nt, 0) = 0 THEN 0.0 ELSE ng / nt END AS negative
        FROM documents d LEFT JOIN hits USING (doc_id)"""

ORACLE: dict[str, str] = {
    "read_lines": _LINES,
    "drop_blank": f"SELECT doc_id, {_STRIP} AS line FROM ({_LINES}) WHERE regexp_matches(line, '\\S')",
    "word_count": f"""
        SELECT word, count(*) AS n
        FROM (SELECT unnest(regexp_extract_all(text, {WORD_RE})) AS word FROM documents) GROUP BY 1""",
    "word_count_stream": f"""
        SELECT word, count(*) AS n
        FROM (SELECT unnest(regexp_extract_all(text, {WORD_RE})) AS word FROM documents) GROUP BY 1""",
    "tag_count": f"""
        SELECT tag, count(*) AS n
        FROM (SELECT unnest(regexp_extract_all(text, {TAG_RE})) AS tag FROM documents) GROUP BY 1""",
    "keyword_filter": "SELECT doc_id FROM documents WHERE contains(lower(text), 'tion')",
    "keyword_filter_stream": f"""
        SELECT event_id, event_type AS text, {U} AS ws FROM events WHERE contains(lower(event_type), 'ic')""",
    "track_filter": """
        SELECT doc_id FROM documents
        WHERE lang IN ('en') AND (contains(lower(text), 'the') OR contains(lower(text), 'worthless'))""",
    "track_filter_many": _track_many(),
    "track_filter_2000": """
        WITH k AS (SELECT a || b || c AS k
            FROM (SELECT unnest(string_split('ba ce di fo gu la me ni po ru sa te vi wo ki ra li mo nu so', ' ')) AS a),
                 (SELECT unnest(string_split('n r s t l m c p d g', ' ')) AS b),
                 (SELECT unnest(string_split('al en ir os um ab ed il ot ur', ' ')) AS c))
        SELECT doc_id FROM documents WHERE lang IN ('en') AND EXISTS (SELECT 1 FROM k WHERE contains(lower(text), k.k))""",
    "decode_variant": """
        WITH x AS (SELECT event_id, event_id % 20 AS r, ['', '  ', 'null', '[1, 2]', NULL, '{"id": 1', '{"id": 1} {"id": 2}', '{"id": 1} tail', '7', '"text"'] AS bad,
            '{"id": ' || event_id || ', "user": {"id": ' || user_id || ', "tags": ["' || event_type || '", "t' || (event_id % 7) || '"]}, "props": ' || props || ', "extended_tweet": null}' AS j FROM events)
        SELECT event_id, CASE WHEN r >= 10 THEN (j::JSON ->> '$.user.id')::BIGINT END AS user_id,
            CASE WHEN r >= 10 THEN j::JSON ->> '$.user.tags[0]' END AS tag, CASE WHEN r >= 10 THEN j::JSON ->> '$.user.tags[1]' END AS second_tag,
            CASE WHEN r >= 10 THEN (j::JSON ->> '$.props.k')::BIGINT END AS k, CASE WHEN r >= 10 THEN j::JSON ->> '$.user.name' END AS name,
            CASE WHEN r < 10 THEN coalesce(bad[r + 1], '') END AS bad FROM x""",
    "model_sentiment": _MODEL_SQL,
    "model_sentiment_stream": _MODEL_SQL,
    "decode_json": "SELECT event_id, (props::JSON ->> 'k')::BIGINT AS k FROM events",
    "classify_by_key": "SELECT event_id, json_exists(props, '$.k') AS is_extended FROM events",
    "classify_counts": "SELECT json_exists(props, '$.k') AS is_extended, count(*) AS n FROM events GROUP BY 1",
    "format_tweet": """
        SELECT event_id, event_type AS text, strftime(ts, '%Y-%m-%d %H:%M:%S') AS created_at,
               epoch_us(ts) / 1000000.0 AS timestamp
        FROM events""",
    "publish_json": """
        SELECT event_id,
               json_object('event_time', (epoch_us(ts) // 1000000)::BIGINT, 'data', event_type)::VARCHAR AS value
        FROM events""",
    "format_line_event": """
        SELECT event_id, event_type AS data, (epoch_us(ts) // 1000000)::DOUBLE AS timestamp FROM events""",
    "write_lines_roundtrip": "SELECT unnest(string_split(text, chr(10))) AS line FROM documents",
    "assign_window": f"SELECT event_id, {U} AS ws FROM events",
    "tumbling_counts": f"SELECT {U} AS ws, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "tumbling_counts_stream": f"""
        SELECT {U} AS ws, event_type, count(*) AS n FROM events GROUP BY 1, 2
        HAVING {U} + INTERVAL 5 SECOND <= (SELECT max(ts) FROM events) - INTERVAL 10 SECOND""",
    "sliding_counts": f"SELECT ws, event_type, count(*) AS n FROM ({_SLIDING}) GROUP BY 1, 2",
    "sliding_counts_stream": f"""
        SELECT ws, event_type, count(*) AS n FROM ({_SLIDING}) GROUP BY 1, 2
        HAVING ws + INTERVAL 60 SECOND <= (SELECT max(ts) FROM events) - INTERVAL 10 SECOND""",
    "running_counts_batch": """
        SELECT event_id, event_type,
               count(*) OVER (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS n
        FROM events""",
    "running_counts_stream": "SELECT event_type, count(*) AS n FROM events GROUP BY 1",
    "ranked_list_window": f"""
        SELECT ws, string_agg(event_type || ':' || n, ',' ORDER BY n DESC, event_type) AS ranked
        FROM (SELECT {U} AS ws, event_type, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY ws""",
    "ranked_list_window_stream": f"""
        SELECT ws, string_agg(event_type || ':' || n, ',' ORDER BY n DESC, event_type) AS ranked
        FROM (SELECT {U} AS ws, event_type, count(*) AS n FROM events GROUP BY 1, 2)
        WHERE ws + INTERVAL 5 SECOND <= (SELECT max(ts) FROM events) - INTERVAL 10 SECOND
        GROUP BY ws""",
    "ranked_list_global": """
        SELECT string_agg(event_type || ':' || n, ',' ORDER BY n DESC, event_type) AS ranked
        FROM (SELECT event_type, count(*) AS n FROM events GROUP BY 1) HAVING count(*) > 0""",
    "first_seen_index": """
        SELECT user_id, (row_number() OVER (ORDER BY min(event_id), user_id) - 1)::BIGINT AS idx
        FROM events WHERE user_id IS NOT NULL GROUP BY user_id""",
    "first_seen_index_words": _first_seen(WORD_RE, "word"),
    "first_seen_index_tags": _first_seen(TAG_RE, "tag"),
    "indexed_counts": f"""
        WITH idx AS (
            SELECT event_type, row_number() OVER (ORDER BY min(event_id), event_type) - 1 AS idx
            FROM events WHERE event_type IS NOT NULL GROUP BY 1)
        SELECT {U} AS ws, e.event_type || '_' || idx.idx AS token_idx, count(*) AS n
        FROM events e JOIN idx ON e.event_type = idx.event_type GROUP BY 1, 2""",
    "first_seen_index_stream": _first_seen(WORD_RE, "word"),
    "indexed_counts_stream": f"""
        WITH idx AS (
            SELECT event_type, row_number() OVER (ORDER BY min(event_id), event_type) - 1 AS idx
            FROM events WHERE event_type IS NOT NULL GROUP BY 1)
        SELECT {U} AS ws, e.event_type || '_' || idx.idx AS token_idx, count(*) AS n
        FROM events e JOIN idx ON e.event_type = idx.event_type GROUP BY 1, 2
        HAVING {U} + INTERVAL 5 SECOND <= (SELECT max(ts) FROM events) - INTERVAL 10 SECOND""",
    "lexicon_sentiment": _LEXICON_SQL,
    "python_model_sentiment": f"SELECT doc_id, positive, neutral, negative FROM ({_LEXICON_SQL})",
    "replay_lines": f"""
        SELECT (row_number() OVER (ORDER BY doc_id, line_no) - 1)::BIGINT AS tick,
               (row_number() OVER (ORDER BY doc_id, line_no) - 1)::BIGINT AS event_time,
               {_STRIP} AS data
        FROM ({_LINES_POS}) WHERE regexp_matches(line, '\\S')""",
    "first_seen_index_event_time": """
        SELECT user_id, (row_number() OVER (ORDER BY min((ts, event_id)), user_id) - 1)::BIGINT AS idx
        FROM events WHERE user_id IS NOT NULL GROUP BY user_id""",
    "indexed_tag_counts": _tag_lists("true"),
    "indexed_tag_counts_stream": _tag_lists("ws + INTERVAL 5 SECOND <= (SELECT max(ts) FROM events) - INTERVAL 10 SECOND"),
    "lexicon_sentiment_stream": f"SELECT s.*, d.text FROM ({_LEXICON_SQL}) s JOIN documents d USING (doc_id)",
    "log_lines": "SELECT event_id, event_type, user_id FROM events",
    "messages_roundtrip": """
        SELECT nullif(event_type, 'view') AS data, (epoch_us(ts) // 1000000)::DOUBLE AS timestamp FROM events""",
    "publish_raw": "SELECT props AS value FROM events",
    "ranked_pages": _pages("true"),
    "ranked_pages_global": f"""
        WITH c AS (SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, {WORD_RE})) AS word FROM documents) GROUP BY 1),
        r AS (SELECT *, row_number() OVER (ORDER BY n DESC, word) - 1 AS r FROM c)
        SELECT (r // 1000)::BIGINT AS page, string_agg(word || ':' || n, ',' ORDER BY r) AS ranked FROM r GROUP BY 1""",
    "ranked_pages_stream": _pages("ws + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 10 SECOND"),
    "running_panes_stream": """
        SELECT event_id, event_type,
               count(*) OVER (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS n
        FROM events""",
    "messages_with_headers": _LOG_SQL,
    "messages_with_headers_stream": _LOG_SQL,
    "drop_blank_padded": f"""
        WITH l AS (SELECT doc_id, line_no::INT AS line_no, line, ['  ', chr(9), '', ' ' || chr(9) || ' '][(doc_id + line_no) % 4 + 1] AS pad FROM ({_LINES_POS})),
        x AS (SELECT doc_id, line_no, pad || line || pad AS line FROM l
              UNION ALL SELECT doc_id, line_no, unnest(['', ' ' || chr(9) || ' ']) FROM l WHERE (doc_id + line_no) % 4 = 1)
        SELECT doc_id, line_no, {_STRIP} AS line FROM x WHERE regexp_matches(line, '\\S')""",
    "track_filter_comma": """
        SELECT doc_id FROM documents
        WHERE lang IN ('en') AND (contains(lower(text), 'the') OR contains(lower(text), 'worthless'))""",
    "classify_by_key_mixed": f"SELECT event_id, json_exists(props, '$.k') AS is_extended FROM ({_MIXED_SQL})",
    "classify_counts_mixed": f"SELECT json_exists(props, '$.k') AS is_extended, count(*) AS n FROM ({_MIXED_SQL}) GROUP BY 1",
    "late_rows_stream": f"{_MARKED_SQL} SELECT event_id, ts, watermark FROM x WHERE is_late",
    "on_time_counts_stream": f"{_MARKED_SQL} SELECT {U} AS ws, event_type, count(*) AS n FROM x WHERE NOT is_late GROUP BY 1, 2",
    "large_lexicon_stream": _LARGE_LEXICON_SQL,
    "word_spans": f"""
        WITH d AS (SELECT doc_id, regexp_extract_all(text, {WORD_RE}) AS words, string_split_regex(text, {WORD_RE}) AS gaps FROM documents),
        u AS (SELECT doc_id, unnest(words) AS word, unnest(gaps[1:len(words)]) AS gap, unnest(generate_series(0, len(words) - 1)) AS pos
              FROM d WHERE len(words) > 0),
        s AS (SELECT *, sum(length(gap) + length(word)) OVER (PARTITION BY doc_id ORDER BY pos) AS stop FROM u)
        SELECT doc_id, pos::INT AS pos, word, (stop - length(word))::INT AS start, stop::INT AS stop FROM s""",
    "replay_lines_stream": f"""
        WITH l AS (SELECT row_number() OVER (ORDER BY doc_id, line_no) - 1 AS i, {_STRIP} AS data FROM ({_LINES_POS}) WHERE regexp_matches(line, '\\S')),
        c AS (SELECT count(*) AS n, (5 * count(*) + 15) // 16 AS per_batch FROM l),
        t AS (SELECT unnest(range(4 * per_batch)) AS tick, n, per_batch FROM c)
        SELECT tick::BIGINT AS tick, (tick // per_batch)::BIGINT AS event_time, data FROM t JOIN l ON l.i = t.tick % t.n""",
}
