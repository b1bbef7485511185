"""

Every builder reads whole fixture tables (``documents``, ``events``, ``labels``) and
composes the library operators; nothing is sampled, capped or filtered by id.
Column names match the SQL in :mod:`brook.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brook.functions.text import TAG, WORD
from brook.functions.time import epoch_micros, instant_to_local
from brook.operators.aggregate import count_by, rank_counts, ranked_list, ranked_pages, render_ranked
from brook.operators.filters import class_counts, classify_by_key, drop_blank, keyword_filter
from brook.operators.index import first_seen_index, indexed_counts, indexed_tag_counts
from brook.operators.records import decode_json, decode_variant, field, format_line_event, format_tweet, split_bad
from brook.operators.running import running_counts_batch
from brook.operators.sentiment import lexicon_sentiment, naive_bayes_sentiment, score_with_model, sentiment_labels, train_naive_bayes
from brook.operators.tablefn import WordSpans, apply_table_function
from brook.operators.tokens import explode_tokens
from brook.operators.windows import assign_window, sliding_counts, tumbling_counts
from brook.schemas import CORRUPT, FILE_EVENT, PROPS, TWEET
from brook.session import materialize, scratch_path, table
from brook.sinks.log import log_sink
from brook.sinks.messages import json_envelope, publish_json, publish_raw
from brook.sinks.text import write_lines
from brook.sources.feed import tracked_feed
from brook.sources.lines import lines_of, read_lines
from brook.sources.messages import attribute, read_messages
from brook.sources.replay import indexed_lines, replay_batch, replay_cycle, staged_ticks
from brook.streaming.firstseen import FirstSeenState
from brook.streaming.index import FirstSeenIndexer
from brook.streaming.late import mark_late
from brook.streaming.panes import running_panes, with_rocksdb
from brook.streaming.ranked import windowed_ranked_lists, windowed_ranked_pages
from brook.streaming.runner import batches_to_table, replay_batches_to_table, replay_splits, replay_to_table, run_to_table

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the registered queries.
KEYWORD = "tion"  # the reference's 'bit' has no hit in the fixture documents
STREAM_KEYWORD = "ic"  # F1 on the event stream (event types as post text)
TOPICS = ("the", "worthless")  # F4
LANGS = ("en",)  # F5
# F4 with a long keyword list
TOPICS_MANY = (
    "bitcoin", "worthless", "market", "price", "crypto", "blockchain", "wallet", "token",
    "exchange", "mining", "coin", "trade", "invest", "money", "bank", "finance",
    "stock", "bond", "fund", "profit", "loss", "risk", "growth", "value",
    "asset", "capital", "credit", "debt", "dollar", "euro", "yen", "gold",
    "silver", "oil", "energy", "tech", "startup", "venture", "equity", "tionou",
)
# F4 with 2,000 keywords: syllables put together by rule
TOPICS_2000 = tuple(
    f"{a}{b}{c}" for a in "ba ce di fo gu la me ni po ru sa te vi wo ki ra li mo nu so".split()
    for b in "n r s t l m c p d g".split() for c in "al en ir os um ab ed il ot ur".split()
)
JSON_KEY = "k"  # key whose presence classifies a payload
WINDOW = "5 seconds"  # W1/W3 fixed window (reference value)
SLIDE_SIZE, SLIDE_STEP = "60 seconds", "5 seconds"  # W2 (reference's alternate)
PAGE_WINDOW, PAGE_SIZE = "1 day", 100  # A2 in pages
DELAY = "10 seconds"  # W5 watermark delay of the streaming forms
LATE_MICROS = 12 * 86_400_000_000  # W5: how much later than its time a held-up event arrives
STREAM_SPLITS = 4  # micro-batches the staged tables are replayed in
# Sentiment lexicon (ours; the reference's model is absent).
LEXICON = [
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


def _documents(spark, sf):
    return table(spark, sf, "documents")


def _events(spark, sf):
    return table(spark, sf, "events")


def _doc_lines(spark, sf, pos=None):
    return lines_of(_documents(spark, sf), "text", keep=["doc_id"], out="line", pos=pos)


# -- S1 / F2 / K2 ---------------------------------------------------------------


def q_read_lines(spark, sf):
    return _doc_lines(spark, sf)


def q_drop_blank(spark, sf):
    from brook.functions.text import strip

    lines = drop_blank(_doc_lines(spark, sf), "line")
    return lines.select("doc_id", strip("line").alias("line"))


def q_write_lines_roundtrip(spark, sf):
    path = scratch_path(spark, "lines")
    write_lines(_doc_lines(spark, sf), path, col="line")
    return read_lines(spark, path).select(F.col("value").alias("line"))


def _padded_lines(spark, sf):
    """Document lines with white space around them, and some blank ones put between."""
    k = F.pmod(F.col("doc_id") + F.col("line_no"), F.lit(4))
    pad = F.element_at(F.array(*[F.lit(x) for x in ("  ", "\t", "", " \t ")]), (k + 1).cast("int"))
    blank = F.when(k == 1, F.array(F.lit(""), F.lit(" \t "))).otherwise(F.array().cast("array<string>"))
    lines = F.explode(F.concat(F.array(F.concat(pad, F.coalesce("line", F.lit("")), pad)), blank))
    return _doc_lines(spark, sf, pos="line_no").select("doc_id", "line_no", lines.alias("line"))


def q_drop_blank_padded(spark, sf):
    """Padded and blank lines: blank ones go, the rest is stripped."""
    from brook.functions.text import strip

    return drop_blank(_padded_lines(spark, sf), "line").select("doc_id", "line_no", strip("line").alias("line"))


# -- P5 / P6 / A1 / O1 ----------------------------------------------------------


def q_word_count(spark, sf):
    words = explode_tokens(_documents(spark, sf), "text", WORD, out="word")
    return rank_counts(count_by(words, ["word"]), token="word")


def q_tag_count(spark, sf):
    tags = explode_tokens(_documents(spark, sf), "text", TAG, out="tag")
    return rank_counts(count_by(tags, ["tag"]), token="tag")


# -- F1 / F4 / F5 ---------------------------------------------------------------


def q_keyword_filter(spark, sf):
    return keyword_filter(_documents(spark, sf), "text", KEYWORD).select("doc_id")


def q_track_filter(spark, sf):
    return tracked_feed(_documents(spark, sf), "text", "lang", TOPICS, LANGS).select("doc_id")


def q_track_filter_many(spark, sf):
    return tracked_feed(_documents(spark, sf), "text", "lang", TOPICS_MANY, LANGS).select("doc_id")


def q_track_filter_2000(spark, sf):
    return tracked_feed(_documents(spark, sf), "text", "lang", TOPICS_2000, LANGS).select("doc_id")


def q_track_filter_comma(spark, sf):
    """Topics as the comma-separated string of a command line."""
    return tracked_feed(_documents(spark, sf), "text", "lang", " the, worthless ,,", LANGS).select("doc_id")


# -- P1-P4 / F3 / A4 / K3 ---------------------------------------------------------


def _tweet_messages(spark, sf):
    """Events as topic messages: a JSON social post per event, published at ``ts``."""
    ev = _events(spark, sf)
    payload = F.to_json(
        F.struct(
            F.col("event_type").alias("text"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
        )
    )
    return ev.select("event_id", payload.cast("binary").alias("value"), F.col("ts").alias("timestamp"))


def _file_event_messages(spark, sf):
    """Events published as the replay's ``{"event_time", "data"}`` envelope (K3)."""
    ev = _events(spark, sf)
    fields = {
        "event_time": F.floor(epoch_micros(ev, "ts") / F.lit(1_000_000)).cast("long"),
        "data": F.col("event_type"),
    }
    return json_envelope(ev, fields, keep=["event_id"])


def q_decode_json(spark, sf):
    ev = _events(spark, sf)
    good, _bad = split_bad(decode_json(ev, "props", PROPS, out="j"))
    return good.select("event_id", F.col("j.k").alias("k"))


def _any_payloads(spark, sf):
    """Events as nested JSON payloads; some blank, null, cut, followed by text, or no object."""
    ev = _events(spark, sf)
    nested = F.format_string(
        '{"id": %d, "user": {"id": %d, "tags": ["%s", "t%d"]}, "props": %s, "extended_tweet": null}',
        "event_id", "user_id", "event_type", F.pmod("event_id", F.lit(7)), "props",
    )
    bad = ["", "  ", "null", "[1, 2]", None, '{"id": 1', '{"id": 1} {"id": 2}', '{"id": 1} tail', "7", '"text"']
    payload = nested
    for i, text in enumerate(bad):
        payload = F.when(F.pmod("event_id", F.lit(20)) == i, F.lit(text)).otherwise(payload)
    return ev.select("event_id", payload.cast("binary").alias("value"))


def q_decode_variant(spark, sf):
    """Payloads of any shape; bad ones set aside with their text."""
    msgs = decode_variant(_any_payloads(spark, sf), "value")
    return msgs.select(
        "event_id",
        field("msg", "$.user.id", "long").alias("user_id"),
        field("msg", "$.user.tags[0]").alias("tag"),
        field("msg", "$.user.tags[1]").alias("second_tag"),
        field("msg", "$.props.k", "long").alias("k"),
        field("msg", "$.user.name").alias("name"),
        F.col(CORRUPT).alias("bad"),
    )


def q_classify_by_key(spark, sf):
    return classify_by_key(_events(spark, sf), "props", JSON_KEY).select("event_id", "is_extended")


def q_classify_counts(spark, sf):
    return class_counts(classify_by_key(_events(spark, sf), "props", JSON_KEY))


def _keyed_or_not(spark, sf):
    """Events of which some payloads lack the key, nest it, or have it without a value."""
    k = F.pmod("event_id", F.lit(5))
    other = F.when(k == 0, F.lit('{"j": 1}')).when(k == 1, F.lit('{"j": {"k": 1}}')).when(k == 2, F.lit('{"k": null}')).when(k == 3, F.lit("{}"))
    return _events(spark, sf).select("event_id", F.coalesce(other, F.col("props")).alias("props"))


def q_classify_by_key_mixed(spark, sf):
    return classify_by_key(_keyed_or_not(spark, sf), "props", JSON_KEY).select("event_id", "is_extended")


def q_classify_counts_mixed(spark, sf):
    return class_counts(classify_by_key(_keyed_or_not(spark, sf), "props", JSON_KEY))


def q_format_tweet(spark, sf):
    good, _bad = split_bad(decode_json(_tweet_messages(spark, sf), "value", TWEET))
    return format_tweet(good, keep=["event_id"])


def q_publish_json(spark, sf):
    return _file_event_messages(spark, sf)


def q_format_line_event(spark, sf):
    good, _bad = split_bad(decode_json(_file_event_messages(spark, sf), "value", FILE_EVENT))
    return format_line_event(good, keep=["event_id"])


def q_keyword_filter_stream(spark, sf):
    """Posts stream: decode -> reshape -> 5 s window tag -> keyword filter (stateless)."""
    messages = _tweet_messages(spark, sf).withColumn("ts", F.col("timestamp"))

    def build(stream):
        good, _bad = split_bad(decode_json(stream, "value", TWEET))
        posts = format_tweet(good, keep=["event_id", "ts"])
        return keyword_filter(assign_window(posts, "ts", WINDOW), "text", STREAM_KEYWORD).select("event_id", "text", "ws")

    return replay_to_table(messages, "ts", STREAM_SPLITS, "keyword_stream", build)


def q_word_count_stream(spark, sf):
    """Streaming word count: running count per word (update mode) over replayed documents."""
    docs = _raw(spark, sf, "documents").select("doc_id", "text")

    def build(stream):
        return count_by(explode_tokens(stream, "text", WORD, out="word"), ["word"])

    return replay_to_table(docs, "doc_id", STREAM_SPLITS, "word_count", build, mode="update", keys=["word"])


# -- W1-W5 -------------------------------------------------------------------------


def q_assign_window(spark, sf):
    return assign_window(_events(spark, sf), "ts", WINDOW).select("event_id", "ws")


def q_tumbling_counts(spark, sf):
    return tumbling_counts(_events(spark, sf), "ts", ["event_type"], WINDOW)


def q_sliding_counts(spark, sf):
    return sliding_counts(_events(spark, sf), "ts", ["event_type"], SLIDE_SIZE, SLIDE_STEP)


def _raw(spark, sf, name):
    return table(spark, sf, name)


def _events_for_replay(spark, sf):
    return _raw(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")


def _replay_events(spark, sf, name, build, mode="append", keys=None):
    """Replay the events table as STREAM_SPLITS micro-batches in time order through ``build``."""
    return replay_to_table(_events_for_replay(spark, sf), "ts", STREAM_SPLITS, name, build, mode=mode, keys=keys)


def q_tumbling_counts_stream(spark, sf):
    return _replay_events(
        spark, sf, "tumbling_counts", lambda s: tumbling_counts(s, "ts", ["event_type"], WINDOW, delay=DELAY)
    )


def q_sliding_counts_stream(spark, sf):
    return _replay_events(
        spark,
        sf,
        "sliding_counts",
        lambda s: sliding_counts(s, "ts", ["event_type"], SLIDE_SIZE, SLIDE_STEP, delay=DELAY),
    )


def _marked_stream(spark, sf, name):
    """Events that arrive in ``STREAM_SPLITS`` parts, every tenth one twelve days after its time, marked when late."""
    ev = _events_for_replay(spark, sf)
    held = F.when(F.pmod("event_id", F.lit(10)) == 0, F.lit(LATE_MICROS)).otherwise(F.lit(0))
    arrivals = ev.withColumn("arrival", epoch_micros(ev, "ts") + held)
    return replay_to_table(arrivals, "arrival", STREAM_SPLITS, name, lambda s: mark_late(s, "ts", DELAY, WINDOW))


def q_late_rows_stream(spark, sf):
    """Rows behind the watermark, set aside with the watermark they missed."""
    return _marked_stream(spark, sf, "late_rows").where("is_late").select("event_id", "ts", "watermark")


def q_on_time_counts_stream(spark, sf):
    """Counts per window of the rows that came in time."""
    return tumbling_counts(_marked_stream(spark, sf, "on_time").where(~F.col("is_late")), "ts", ["event_type"], WINDOW)


def q_running_counts_batch(spark, sf):
    ev = _events(spark, sf).select("event_id", "event_type")
    return running_counts_batch(ev, "event_type", "event_id")


def q_running_counts_stream(spark, sf):
    return _replay_events(
        spark, sf, "running_counts", lambda s: count_by(s, ["event_type"]), mode="update", keys=["event_type"]
    )


# -- A2 ----------------------------------------------------------------------------


def q_ranked_list_window_stream(spark, sf):
    def build(stream):
        lists = windowed_ranked_lists(stream, "ts", "event_type", WINDOW, DELAY)
        return lists.select("ws", render_ranked("ranked").alias("ranked"))

    return _replay_events(spark, sf, "ranked_lists", build)


def q_ranked_list_window(spark, sf):
    counts = tumbling_counts(_events(spark, sf), "ts", ["event_type"], WINDOW)
    ranked = ranked_list(counts, token="event_type", by=["ws"])
    return ranked.select("ws", render_ranked("ranked").alias("ranked"))


def q_ranked_list_global(spark, sf):
    counts = count_by(_events(spark, sf), ["event_type"])
    return ranked_list(counts, token="event_type").select(render_ranked("ranked").alias("ranked"))


def _actions(df):
    """Events with the token ``type_user``: many distinct ones per window."""
    return df.select("event_id", "ts", F.concat_ws("_", "event_type", "user_id").alias("token"))


def q_ranked_pages(spark, sf):
    """Ranked lists per window in pages of 100 entries."""
    counts = tumbling_counts(_actions(_events(spark, sf)), "ts", ["token"], PAGE_WINDOW)
    return ranked_pages(counts, by=["ws"], page_size=PAGE_SIZE).select("ws", "page", render_ranked("ranked").alias("ranked"))


def q_ranked_pages_global(spark, sf):
    """One ranked list of all words, in pages."""
    words = count_by(explode_tokens(_documents(spark, sf), "text", WORD, out="word"), ["word"])
    return ranked_pages(words, token="word").select("page", render_ranked("ranked").alias("ranked"))


def q_ranked_pages_stream(spark, sf):
    events = _actions(_raw(spark, sf, "events"))
    ckpt, out = scratch_path(spark, "pages-ckpt"), scratch_path(spark, "pages-out")
    for source in replay_splits(events, "ts", STREAM_SPLITS, "pages"):
        stream = spark.readStream.schema(events.schema).parquet(source)
        result = windowed_ranked_pages(stream, "ts", "token", "pages", PAGE_WINDOW, DELAY, PAGE_SIZE, ckpt, out)
    return result.select("ws", "page", render_ranked("ranked").alias("ranked"))


def q_running_panes_stream(spark, sf):
    """The running count after every event, fired by each element."""
    events = _events_for_replay(spark, sf).select("event_id", "ts", "event_type")
    ckpt, out = scratch_path(spark, "panes-ckpt"), scratch_path(spark, "panes-out")
    for source in replay_splits(events, "event_id", STREAM_SPLITS, "panes"):
        panes = running_panes(spark.readStream.schema(events.schema).parquet(source), "event_type", ["event_id"])
        result = with_rocksdb(spark, lambda panes=panes: run_to_table(panes, "panes", checkpoint=ckpt, path=out))
    return result.select("event_id", "event_type", "n")


# -- T1 / T2 -----------------------------------------------------------------------


def q_first_seen_index(spark, sf):
    return first_seen_index(_events(spark, sf), "user_id", ["event_id"])


def _doc_tokens(spark, sf, pattern, out):
    return explode_tokens(_documents(spark, sf), "text", pattern, keep=["doc_id"], out=out, pos="pos")


def q_first_seen_index_words(spark, sf):
    return first_seen_index(_doc_tokens(spark, sf, WORD, "word"), "word", ["doc_id", "pos"])


def q_first_seen_index_tags(spark, sf):
    return first_seen_index(_doc_tokens(spark, sf, TAG, "tag"), "tag", ["doc_id", "pos"])


def q_indexed_counts(spark, sf):
    return indexed_counts(_events(spark, sf), "event_type", ["event_id"], "ts", WINDOW)


def q_first_seen_index_event_time(spark, sf):
    return first_seen_index(_events(spark, sf), "user_id", ["ts", "event_id"])


def _posts(df):
    """Events as posts with two tags each."""
    return df.select("event_id", "ts", F.concat(F.lit("#"), "event_type", F.lit(" by @user, #"), "event_type", F.lit("s")).alias("text"))


def q_indexed_tag_counts(spark, sf):
    """Lesson 4 in batch: tags -> first-seen index -> 5 s counts -> ranked list per window."""
    lists = indexed_tag_counts(_posts(_raw(spark, sf, "events")), "text", "ts", ["event_id"], WINDOW)
    return lists.select("ws", render_ranked("ranked").alias("ranked"))


def q_indexed_tag_counts_stream(spark, sf):
    """Lesson 4 on a stream: tags -> first-seen dictionary -> 5 s counts -> ranked list per window."""
    posts = _posts(_raw(spark, sf, "events"))
    occ = scratch_path(spark, "tag-occ")
    indexer = FirstSeenIndexer(
        scratch_path(spark, "tag-dict"), token="token", order=["event_id", "pos"], occurrences_path=occ, carry=["ts", "event_id", "pos"]
    )
    ckpt = scratch_path(spark, "tag-ckpt")
    for source in replay_splits(posts, "ts", STREAM_SPLITS, "tags"):
        stream = spark.readStream.schema(posts.schema).parquet(source)
        toks = explode_tokens(stream, "text", TAG, keep=["event_id", "ts"], out="token", pos="pos")
        _await(indexer.start(toks, ckpt))
    schema = "ts timestamp_ntz, event_id long, pos int, token_idx string, batch_id int"
    lists = windowed_ranked_lists(spark.readStream.schema(schema).parquet(occ), "ts", "token_idx", WINDOW, DELAY)
    return run_to_table(lists.select("ws", render_ranked("ranked").alias("ranked")), "tag_lists")


def q_first_seen_index_stream(spark, sf):
    docs = _raw(spark, sf, "documents").select("doc_id", "text")
    indexer = FirstSeenState(scratch_path(spark, "fsi-dict"), token="word", order=["doc_id", "pos"])
    ckpt = scratch_path(spark, "fsi-ckpt")
    for source in replay_splits(docs, "doc_id", STREAM_SPLITS, "fsi-docs"):
        stream = spark.readStream.schema(docs.schema).parquet(source)
        toks = explode_tokens(stream, "text", WORD, keep=["doc_id"], out="word", pos="pos")
        toks = toks.withColumn("pos", F.col("pos").cast("int"))  # a place in an array is one
        _await(indexer.start(toks, ckpt))
    return indexer.dictionary(spark)


def _await(query):
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def q_indexed_counts_stream(spark, sf):
    """Event stream -> first-seen index (foreachBatch) -> indexed occurrences ->
    5 s windowed counts with a watermark (second streaming query)."""
    ev = _events_for_replay(spark, sf)
    occ = scratch_path(spark, "idx-occ")
    indexer = FirstSeenIndexer(
        scratch_path(spark, "idx-dict"), token="event_type", order=["event_id"], occurrences_path=occ, carry=["ts"]
    )
    ckpt = scratch_path(spark, "idx-ckpt")
    for source in replay_splits(ev, "ts", STREAM_SPLITS, "indexed"):
        _await(indexer.start(spark.readStream.schema(ev.schema).parquet(source), ckpt))
    schema = "ts timestamp_ntz, token_idx string, batch_id int"
    occurrences = spark.readStream.schema(schema).parquet(occ)
    counts = tumbling_counts(occurrences, "ts", ["token_idx"], WINDOW, delay=DELAY)
    return run_to_table(counts, "indexed_counts")


# -- M1 / U5 -----------------------------------------------------------------------


def lexicon_df(spark):
    return spark.createDataFrame(LEXICON, "w string, cls string")


def q_lexicon_sentiment(spark, sf):
    return lexicon_sentiment(_documents(spark, sf), "doc_id", "text", lexicon_df(spark))


def q_model_sentiment(spark, sf):
    docs = _documents(spark, sf)
    return naive_bayes_sentiment(docs, train_naive_bayes(docs, sentiment_labels(table(spark, sf, "labels"))))


def q_model_sentiment_stream(spark, sf):
    """A fitted model applied to a stream of documents, micro-batch by micro-batch."""
    docs = _raw(spark, sf, "documents").select("doc_id", "text")
    model = train_naive_bayes(docs, sentiment_labels(table(spark, sf, "labels")))
    schema = "doc_id long, positive double, neutral double, negative double"
    return replay_batches_to_table(docs, "doc_id", STREAM_SPLITS, "model_sentiment", lambda b: naive_bayes_sentiment(b, model), schema)


def _lexicon_model():
    """U5 loader: the lexicon as a Python dict, built once per Python worker."""
    return dict(LEXICON)


def _lexicon_scores(model, texts):
    import re

    import pandas as pd

    # one row per token of the batch, then sums per text
    toks = texts.fillna("").str.lower().reset_index(drop=True).map(re.compile(WORD).findall).explode()
    cls = toks.map(model)
    per = pd.DataFrame({"n": toks.notna(), "p": cls == "positive", "q": cls == "negative"}).groupby(level=0).sum()
    n = per["n"].where(per["n"] > 0, 1)
    neutral = ((per["n"] - per["p"] - per["q"]) / n).where(per["n"] > 0, 1.0)
    return pd.DataFrame({"positive": per["p"] / n, "neutral": neutral, "negative": per["q"] / n})


def q_python_model_sentiment(spark, sf):
    return score_with_model(
        _documents(spark, sf), "text", _lexicon_model, _lexicon_scores, keep=["doc_id"], cache_key="brook.lexicon"
    )


def q_lexicon_sentiment_stream(spark, sf):
    """Sentiment of a stream: the record kept beside its scores."""
    docs = _raw(spark, sf, "documents").select("doc_id", "text")
    lexicon = lexicon_df(spark)
    return replay_to_table(
        docs, "doc_id", STREAM_SPLITS, "sentiment", lambda s: lexicon_sentiment(s, "doc_id", "text", lexicon, keep=["text"])
    )


def _word_lexicon(spark, sf):
    """A lexicon as large as the documents' vocabulary: a word's class follows from its hash."""
    words = explode_tokens(_documents(spark, sf).select(F.lower("text").alias("text")), "text", WORD, out="w").distinct()
    first = F.substring(F.md5("w"), 1, 1)
    return words.select("w", F.when(first <= "5", "positive").when(first <= "b", "negative").otherwise("neutral").alias("cls"))


def q_large_lexicon_stream(spark, sf):
    """Sentiment of a stream by a lexicon that is joined, micro-batch by micro-batch."""
    docs = _raw(spark, sf, "documents").select("doc_id", "text")
    lexicon = materialize(_word_lexicon(spark, sf), "lexicon")
    schema = "doc_id long, n_tokens long, pos_hits long, neg_hits long, positive double, neutral double, negative double"
    return replay_batches_to_table(
        docs, "doc_id", STREAM_SPLITS, "large_lexicon", lambda b: lexicon_sentiment(b, "doc_id", "text", lexicon, max_literal_words=0), schema
    )


def q_word_spans(spark, sf):
    """A table function of the user's own: words with their places in the text."""
    return apply_table_function(_documents(spark, sf), WordSpans, WordSpans.returns, ["text"], keep=["doc_id"])


# -- K1 / K3 / K4 / S2 -------------------------------------------------------------


def q_log_lines(spark, sf):
    """Every event logged as one line; the log read back."""
    path = scratch_path(spark, "log")
    log_sink(_events(spark, sf).select("event_id", "event_type", "user_id"), path)
    return spark.read.schema("event_id long, event_type string, user_id long").json(path)


def q_messages_roundtrip(spark, sf):
    """Events published as JSON messages, read as a topic and decoded."""
    ev = _events(spark, sf)
    path = scratch_path(spark, "messages")
    publish_json(ev, {"event_time": F.floor(epoch_micros(ev, "ts") / F.lit(1_000_000)).cast("long"), "data": F.nullif("event_type", F.lit("view"))}, path=path)
    good, _bad = split_bad(decode_json(read_messages(spark, "text", path, streaming=False), "value", FILE_EVENT))
    return format_line_event(good)


def q_publish_raw(spark, sf):
    """Raw payloads published and read back as they are."""
    path = scratch_path(spark, "raw")
    publish_raw(_events(spark, sf), "props", path=path)
    return read_messages(spark, "text", path, streaming=False).select(F.col("value").cast("string").alias("value"))


def _log_payload():
    """Payloads that a line can't hold: breaks of both kinds, nulls, empty ones."""
    k = F.pmod("event_id", F.lit(5))
    return (
        F.when(k == 0, F.concat("props", F.lit("\n"), "event_type")).when(k == 1, F.concat("props", F.lit("\r\n")))
        .when(k == 2, F.lit("")).when(k == 3, F.lit(None).cast("string")).otherwise(F.col("props"))
    )


def _published_log(spark, sf, name):
    path = scratch_path(spark, name)
    ev = _events(spark, sf).withColumn("payload", _log_payload())
    user = F.when(F.pmod("event_id", F.lit(3)) > 0, F.col("user_id").cast("string"))
    publish_raw(ev, "payload", fmt="parquet", path=path, headers={"kind": "event_type", "user": user}, timestamp="ts")
    return path


def _log_rows(messages):
    return messages.select(
        F.col("value").cast("string").alias("value"), instant_to_local("timestamp").alias("ts"),
        attribute("kind").alias("kind"), attribute("user").alias("user"), F.size("headers").alias("n_headers"),
    )


def q_messages_with_headers(spark, sf):
    """Payloads of any bytes with attributes and publish time through the message log."""
    return _log_rows(read_messages(spark, "parquet", _published_log(spark, sf, "log"), with_attributes=True, streaming=False))


def q_messages_with_headers_stream(spark, sf):
    path = _published_log(spark, sf, "log-stream")
    return run_to_table(_log_rows(read_messages(spark, "parquet", path, with_attributes=True)), "log_messages")


# -- S4 ----------------------------------------------------------------------------


def q_replay_lines(spark, sf):
    return replay_cycle(_doc_lines(spark, sf, pos="line_no"), "line", ["doc_id", "line_no"])


def q_replay_lines_stream(spark, sf):
    """The paced, endless replay: one and a quarter cycles over all lines in STREAM_SPLITS micro-batches of ticks."""
    idx = materialize(indexed_lines(_doc_lines(spark, sf, pos="line_no"), "line", ["doc_id", "line_no"]), "replay-lines")
    n = idx.count()
    if n == 0:
        return spark.createDataFrame([], "tick long, event_time long, data string")
    ckpt, out = scratch_path(spark, "replay-ckpt"), scratch_path(spark, "replay-out")
    per_batch = -(-5 * n // (4 * STREAM_SPLITS))
    for _ in range(STREAM_SPLITS):
        ticks = staged_ticks(spark, per_batch)
        result = batches_to_table(ticks, "replay", lambda b: replay_batch(b, idx, n), "tick long, event_time long, data string", ckpt, out)
    return result


QUERIES: dict[str, Query] = {
    "read_lines": q_read_lines,
    "drop_blank": q_drop_blank,
    "word_count": q_word_count,
    "word_count_stream": q_word_count_stream,
    "tag_count": q_tag_count,
    "keyword_filter": q_keyword_filter,
    "keyword_filter_stream": q_keyword_filter_stream,
    "track_filter": q_track_filter,
    "track_filter_many": q_track_filter_many,
    "track_filter_2000": q_track_filter_2000,
    "decode_json": q_decode_json,
    "decode_variant": q_decode_variant,
    "classify_by_key": q_classify_by_key,
    "classify_counts": q_classify_counts,
    "format_tweet": q_format_tweet,
    "publish_json": q_publish_json,
    "format_line_event": q_format_line_event,
    "write_lines_roundtrip": q_write_lines_roundtrip,
    "assign_window": q_assign_window,
    "tumbling_counts": q_tumbling_counts,
    "tumbling_counts_stream": q_tumbling_counts_stream,
    "sliding_counts": q_sliding_counts,
    "sliding_counts_stream": q_sliding_counts_stream,
    "running_counts_batch": q_running_counts_batch,
    "running_counts_stream": q_running_counts_stream,
    "ranked_list_window": q_ranked_list_window,
    "ranked_list_window_stream": q_ranked_list_window_stream,
    "ranked_list_global": q_ranked_list_global,
    "first_seen_index": q_first_seen_index,
    "first_seen_index_words": q_first_seen_index_words,
    "first_seen_index_tags": q_first_seen_index_tags,
    "indexed_counts": q_indexed_counts,
    "first_seen_index_stream": q_first_seen_index_stream,
    "indexed_counts_stream": q_indexed_counts_stream,
    "lexicon_sentiment": q_lexicon_sentiment,
    "model_sentiment": q_model_sentiment,
    "model_sentiment_stream": q_model_sentiment_stream,
    "python_model_sentiment": q_python_model_sentiment,
    "replay_lines": q_replay_lines,
    "first_seen_index_event_time": q_first_seen_index_event_time,
    "indexed_tag_counts": q_indexed_tag_counts,
    "indexed_tag_counts_stream": q_indexed_tag_counts_stream,
    "lexicon_sentiment_stream": q_lexicon_sentiment_stream,
    "log_lines": q_log_lines,
    "messages_roundtrip": q_messages_roundtrip,
    "publish_raw": q_publish_raw,
    "ranked_pages": q_ranked_pages,
    "ranked_pages_global": q_ranked_pages_global,
    "ranked_pages_stream": q_ranked_pages_stream,
    "running_panes_stream": q_running_panes_stream,
    "messages_with_headers": q_messages_with_headers,
    "messages_with_headers_stream": q_messages_with_headers_stream,
    "drop_blank_padded": q_drop_blank_padded,
    "track_filter_comma": q_track_filter_comma,
    "classify_by_key_mixed": q_classify_by_key_mixed,
    "classify_counts_mixed": q_classify_counts_mixed,
    "late_rows_stream": q_late_rows_stream,
    "on_time_counts_stream": q_on_time_counts_stream,
    "large_lexicon_stream": q_large_lexicon_stream,
    "word_spans": q_word_spans,
    "replay_lines_stream": q_replay_lines_stream,
}
