"""Column expressions over text. All stay inside generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns that define the cleaned text and its features.
TAG = r"<[^>]+>"
DIGIT_RUN = r"[0-9]+"
URL = r"https?://\S+"
URL_PREFIX = r"https?://"
WHITESPACE = r"\s"
BLANKS = " \t\n\x0b\f\r"
PREVIEW_CHARS = 200
PREVIEW_SUFFIX = "..."

# Spark's default English stop words, as StopWordsRemover has them.
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his
himself she her hers herself it its itself they them their theirs themselves what which
who whom this that these those am is are was were be been being have has had having do
does did doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in out on
off over under again further then once here there when where why how all any both each
few more most other some such no nor not only own same so than too very s t can will
just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't
wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't
shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's
what's when's where's who's why's would
""".split()


def or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def content_hash(*parts: Column) -> Column:
    """md5 hex of the concatenated parts; a missing part counts as ''."""
    return F.md5(F.concat(*[or_empty(p) for p in parts]))


def strip_tags(c: Column) -> Column:
    """Drop markup. Nothing is put in its place, so neighbouring words may fuse."""
    return F.regexp_replace(c, TAG, "")


def occurrences(c: Column, char: str) -> Column:
    """How often a single character occurs."""
    return F.length(c) - F.length(F.replace(c, F.lit(char), F.lit("")))


def space_words(c: Column) -> Column:
    """Pieces between single blanks: one more than there are blanks. Unlike
    size(split(c, ' ')) this builds no array."""
    return occurrences(c, " ") + 1


def whitespace_words(c: Column) -> Column:
    """Words as runs of non-whitespace; '' has none."""
    return F.regexp_count(c, F.lit(r"\S+"))


def pieces(c: Column, pattern: str) -> Column:
    """Pieces left by splitting on a pattern: its matches plus one."""
    return F.size(F.split(c, pattern))


def kept_length(c: Column, char_class: str) -> Column:
    """Number of characters inside a class, e.g. 'A-Z'. Whole runs of other
    characters go in one match, which is much cheaper than one match each."""
    return F.length(F.regexp_replace(c, f"[^{char_class}]+", ""))


def preview(c: Column) -> Column:
    return F.concat(F.substring(c, 1, PREVIEW_CHARS), F.lit(PREVIEW_SUFFIX))


def tokens(c: Column) -> Column:
    """Lower-cased text split at every whitespace character. Trailing empty tokens go,
    others stay, and blanks alone give none, as MLlib's Tokenizer has it."""
    text = F.rtrim(F.lower(c), F.lit(BLANKS))
    only_blanks = (text == "") & (c != "")
    return F.when(only_blanks, F.array().cast("array<string>")).otherwise(F.split(text, WHITESPACE))


def drop_stop_words(words: Column) -> Column:
    return F.filter(words, lambda word: ~word.isin(STOP_WORDS))
