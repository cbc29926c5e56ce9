"""The ten numeric article features, under three named definitions.

`lake` is what the tables hold and the default for training and scoring alike,
so that a model never sees one formula in training and another in scoring.
`documented` and `serving` give the other two published definitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.functions import text as X


def has_author(author: Column) -> Column:
    return F.when(X.or_empty(author) != "", 1).otherwise(0)


def _style(content: Column, title: Column, author: Column) -> dict[str, Column]:
    """Features on which all three definitions agree."""
    return {
        "char_count": F.length(content),
        "has_author": has_author(author),
        "title_length": F.length(title),
        "exclamation_count": X.occurrences(content, "!"),
        "question_count": X.occurrences(content, "?"),
    }


def lake(content: Column, title: Column, author: Column) -> dict[str, Column]:
    """ASCII capitals; words between single blanks; number and URL features are
    pieces of a split, hence matches plus one."""
    shared = _style(content, title, author)
    words = X.space_words(content)
    return shared | {
        "word_count": words,
        "caps_ratio": F.try_divide(X.kept_length(content, "A-Z"), shared["char_count"]),
        "avg_word_length": F.try_divide(shared["char_count"], words),
        "numeric_count": X.pieces(content, X.DIGIT_RUN),
        "url_count": X.pieces(content, X.URL),
    }


def documented(content: Column, title: Column, author: Column) -> dict[str, Column]:
    """Unicode capitals; words between any whitespace; true match counts."""
    shared = _style(content, title, author)
    words = X.whitespace_words(content)
    return shared | {
        "word_count": words,
        "caps_ratio": F.try_divide(X.kept_length(content, r"\p{Lu}"), shared["char_count"]),
        "avg_word_length": F.try_divide(shared["char_count"], words),
        "numeric_count": F.regexp_count(content, F.lit(X.DIGIT_RUN)),
        "url_count": F.regexp_count(content, F.lit(X.URL_PREFIX)),
    }


def serving(content: Column, title: Column, author: Column) -> dict[str, Column]:
    """Unicode capitals; words between any whitespace, their length without
    blanks; single digits; the letters 'http' in any case."""
    shared = _style(content, title, author)
    words = X.whitespace_words(content)
    lowered = F.lower(content)
    scheme = "http"
    return shared | {
        "word_count": words,
        "caps_ratio": F.try_divide(X.kept_length(content, r"\p{Lu}"), shared["char_count"]),
        "avg_word_length": F.try_divide(
            F.length(F.replace(content, F.lit(" "), F.lit(""))), F.greatest(words, F.lit(1))
        ),
        "numeric_count": X.kept_length(content, r"\p{Nd}"),
        "url_count": (
            (F.length(lowered) - F.length(F.replace(lowered, F.lit(scheme), F.lit("")))) / len(scheme)
        ).cast("int"),
    }


PROFILES = {"lake": lake, "documented": documented, "serving": serving}


def with_features(
    df: DataFrame,
    profile: str = "lake",
    content: str = "content_cleaned",
    title: str = "title_cleaned",
    author: str = "author",
) -> DataFrame:
    """Add the ten features in one projection."""
    return df.withColumns(PROFILES[profile](F.col(content), F.col(title), F.col(author)))
