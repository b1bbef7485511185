"""S5 tracked social feed: language allow-list and keyword tracking over any message source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from brook.operators.filters import lang_filter, track_filter

# The reference feed's defaults.
DEFAULT_TOPICS = ("bitcoin",)
DEFAULT_LANGS = ("en",)


def tracked_feed(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    topics: Sequence[str] | str = DEFAULT_TOPICS,
    langs: Sequence[str] = DEFAULT_LANGS,
) -> DataFrame:
    """Records in one of ``langs`` whose text mentions any of ``topics``.

    ``topics`` may be the comma-separated string the reference takes on its command line.
    """
    if isinstance(topics, str):
        topics = [t.strip() for t in topics.split(",") if t.strip()]
    return track_filter(lang_filter(df, langs, lang), text, topics)
