"""S1 text-line source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brook.schemas import LINE


def read_lines(spark: SparkSession, path: str, streaming: bool = False, **options) -> DataFrame:
    """One ``value: string`` row per line of the text file(s) at ``path`` (any Hadoop FS).

    ``streaming=True`` picks up new files as they land (``readStream.text``).
    """
    if streaming:
        return spark.readStream.schema(LINE).options(**options).text(path)
    return spark.read.options(**options).text(path)


def lines_of(
    df: DataFrame, text: str, keep: Sequence[str] = (), out: str = "line", pos: str | None = None
) -> DataFrame:
    """Split a text column into its lines (``\\n`` or ``\\r\\n``), keeping ``keep`` columns.

    A text ending in a newline gives a final empty line, as a file reader over the
    same bytes would not; drop blanks with :func:`brook.operators.filters.drop_blank`.
    """
    parts = F.split(F.col(text), r"\r?\n")
    cols = [F.col(c) for c in keep]
    if pos is None:
        return df.select(*cols, F.explode(parts).alias(out))
    return df.select(*cols, F.posexplode(parts).alias(pos, out)).withColumn(pos, F.col(pos).cast("long"))
