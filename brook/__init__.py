"""brook — text and event-stream analytics as Spark DataFrame operators.

Every operator takes and returns a ``DataFrame`` and, unless its docstring says
otherwise, runs unchanged on batch (``spark.read``) and streaming
(``spark.readStream``) inputs.  Work is declared with built-in column
expressions so Catalyst can prune, push down and fuse it; Python only runs
where a model has to be applied per Arrow batch.
"""

from brook.functions.text import TAG, WORD, tokens
from brook.operators.aggregate import count_by, rank_counts, ranked_list, ranked_pages, render_ranked
from brook.operators.filters import (
    class_counts,
    classify_by_key,
    drop_blank,
    keyword_filter,
    lang_filter,
    track_filter,
)
from brook.operators.index import first_seen_index, indexed_counts, indexed_tag_counts
from brook.operators.records import decode_json, decode_variant, field, format_line_event, format_tweet, split_bad
from brook.operators.running import global_index, running_counts_batch
from brook.operators.sentiment import (
    lexicon_sentiment,
    model_sentiment,
    naive_bayes_sentiment,
    score_with_model,
    train_naive_bayes,
    train_sentiment,
)
from brook.operators.tablefn import apply_table_function
from brook.operators.tokens import explode_tokens
from brook.operators.windows import assign_window, sliding_counts, tumbling_counts
from brook.sinks.log import log_sink, preview
from brook.sinks.messages import publish_json, publish_raw
from brook.sinks.text import write_lines
from brook.sources.feed import tracked_feed
from brook.sources.lines import lines_of, read_lines
from brook.sources.messages import attribute, read_messages
from brook.sources.replay import replay_cycle, replay_lines, replay_ticks, staged_ticks
from brook.streaming.firstseen import FirstSeenState
from brook.streaming.index import FirstSeenIndexer
from brook.streaming.late import mark_late
from brook.streaming.panes import running_panes, with_rocksdb
from brook.streaming.ranked import windowed_ranked_lists, windowed_ranked_pages
from brook.streaming.runner import batches_to_table, replay_batches_to_table, replay_splits, replay_to_table, run_to_table

__all__ = [
    "FirstSeenIndexer",
    "FirstSeenState",
    "TAG",
    "WORD",
    "apply_table_function",
    "assign_window",
    "attribute",
    "batches_to_table",
    "class_counts",
    "classify_by_key",
    "count_by",
    "decode_json",
    "decode_variant",
    "drop_blank",
    "explode_tokens",
    "field",
    "first_seen_index",
    "format_line_event",
    "format_tweet",
    "global_index",
    "indexed_counts",
    "indexed_tag_counts",
    "keyword_filter",
    "lang_filter",
    "lexicon_sentiment",
    "lines_of",
    "log_sink",
    "mark_late",
    "preview",
    "model_sentiment",
    "naive_bayes_sentiment",
    "publish_json",
    "publish_raw",
    "rank_counts",
    "ranked_list",
    "ranked_pages",
    "read_lines",
    "read_messages",
    "render_ranked",
    "replay_batches_to_table",
    "replay_cycle",
    "replay_lines",
    "replay_splits",
    "replay_ticks",
    "replay_to_table",
    "run_to_table",
    "running_counts_batch",
    "running_panes",
    "score_with_model",
    "sliding_counts",
    "split_bad",
    "staged_ticks",
    "tokens",
    "track_filter",
    "tracked_feed",
    "train_naive_bayes",
    "train_sentiment",
    "tumbling_counts",
    "windowed_ranked_lists",
    "windowed_ranked_pages",
    "with_rocksdb",
    "write_lines",
]
