"""Silver: drop short texts, de-duplicate, clean, measure."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet import schemas as S
from broadsheet.functions import text as X
from broadsheet.functions.features import has_author

# The earliest record of an id; the rest only so that ties leave one row whatever the
# run, and that of two equally early ones a labelled one stays.
EARLIEST = (
    "ingestion_timestamp", "label IS NULL", "source", "url", "source_type", "title",
    "content", "published_date", "author", "label",
)

# Fixed value: texts up to this length are dropped, measured before cleaning.
MIN_CONTENT = 100


def usable(bronze: DataFrame) -> DataFrame:
    return bronze.filter(F.col("content").isNotNull() & (F.length("content") > MIN_CONTENT))


def clean(df: DataFrame) -> DataFrame:
    """Replace title and content by their text without tags."""
    return df.withColumns(
        {
            "title_cleaned": X.strip_tags(F.col("title")),
            "content_cleaned": X.strip_tags(F.col("content")),
        }
    ).drop("title", "content")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key under a total order.

    Spark prunes `row_number() == 1` inside every map task before the shuffle
    (WindowGroupLimit), so a key with a third of all rows sends on one row per
    task, not its whole group.
    """
    ordered = [F.expr(c) if isinstance(c, str) else c for c in order]
    w = Window.partitionBy(*keys).orderBy(*ordered)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def deduplicate(
    df: DataFrame, order: Sequence[Column | str] = ("ingestion_timestamp",), key: str = "id"
) -> DataFrame:
    """One row per id, the earliest by `order`. Give an order without ties where
    the survivor must not depend on the run."""
    return first_per_key(df, [key], order)


def measure(df: DataFrame) -> DataFrame:
    content = F.col("content_cleaned")
    return df.withColumns(
        {
            "word_count": X.space_words(content),
            "char_count": F.length(content),
            "has_author": has_author(F.col("author")),
        }
    )


def build_silver(
    bronze: DataFrame,
    order: Sequence[Column | str] = EARLIEST,
    as_of: str | None = None,
) -> DataFrame:
    """Bronze records to silver records.

    Copies go before the regexes run, so a text that arrived a million times is
    cleaned once.
    """
    kept = deduplicate(usable(bronze), order)
    now = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return measure(clean(kept)).withColumn("silver_timestamp", now).select(*S.SILVER_COLUMNS)


def new_ids(candidates: DataFrame, known: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose id is not in `known` yet; append these for an incremental run."""
    return candidates.join(known.select(key), key, "left_anti")
