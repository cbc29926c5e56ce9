import math
import random
import re

import pytest
from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from broadsheet.functions import text as X
from broadsheet.functions.features import with_features

TEXT = "A1 22 3b http://a.b c https://d"
SCHEMA = "content_cleaned STRING, title_cleaned STRING, author STRING"


def features(spark, profile, content, title="t", author="a"):
    return with_features(spark.createDataFrame([(content, title, author)], SCHEMA), profile).first()


def test_lake_known_values(spark):
    r = features(spark, "lake", TEXT)
    assert (r.word_count, r.numeric_count, r.url_count) == (6, 4, 3)
    assert r.caps_ratio == 1 / len(TEXT) and r.avg_word_length == len(TEXT) / 6
    assert r.char_count == len(TEXT) and r.title_length == 1 and r.has_author == 1


def test_documented_known_values(spark):
    r = features(spark, "documented", TEXT)
    assert (r.word_count, r.numeric_count, r.url_count) == (6, 3, 2)


def test_serving_known_values(spark):
    r = features(spark, "serving", TEXT + " HTTP")
    assert (r.numeric_count, r.url_count) == (4, 3)
    assert r.avg_word_length == len((TEXT + "HTTP").replace(" ", "")) / 7


@pytest.mark.parametrize("profile", ["lake", "documented", "serving"])
def test_empty_text_gives_null_ratio_not_an_error(spark, profile):
    r = features(spark, profile, "", None, None)
    assert r.caps_ratio is None and r.char_count == 0 and r.has_author == 0 and r.title_length is None


def test_empty_text_counts(spark):
    r = features(spark, "lake", "")
    assert (r.word_count, r.numeric_count, r.url_count) == (1, 1, 1)
    assert features(spark, "documented", "").word_count == 0
    assert features(spark, "serving", "").avg_word_length == 0


def test_only_blanks_split_lake_words(spark):
    assert features(spark, "lake", "x\ty\nz").word_count == 1
    assert features(spark, "lake", "a  b ").word_count == 4
    assert features(spark, "documented", "x\ty\nz  w").word_count == 4


def test_marks_and_capitals(spark):
    text = "ÉCOLE? Why?? No! 'Éa'"
    r = features(spark, "lake", text)
    assert (r.question_count, r.exclamation_count) == (3, 1)
    assert math.isclose(r.caps_ratio, sum("A" <= c <= "Z" for c in text) / len(text))
    assert math.isclose(features(spark, "serving", text).caps_ratio, sum(c.isupper() for c in text) / len(text))


@pytest.mark.parametrize("author,flag", [(None, 0), ("", 0), ("x", 1)])
def test_author_flag(spark, author, flag):
    assert features(spark, "lake", "text", author=author).has_author == flag


def test_tags_leave_nothing_behind(spark):
    df = spark.createDataFrame([("<p>a</p><p>b</p>",), ("<br>",), (None,)], "c STRING")
    assert [r.c for r in df.select(X.strip_tags(F.col("c")).alias("c")).collect()] == ["ab", "", None]


def test_stop_words_are_sparks_own(spark):
    assert X.STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")


def test_relational_tokens_equal_the_transformers(spark):
    df = spark.createDataFrame([(t,) for t in ["The cat\tsat  on\n", " lead", "", " \n\t ", "a\x0b\f", "Ünï  CODE the"]], "c STRING")
    by_ml = StopWordsRemover(inputCol="w", outputCol="f").transform(
        Tokenizer(inputCol="c", outputCol="w").transform(df)
    )
    both = by_ml.withColumn("mine", X.tokens(F.col("c"))).withColumn("kept", X.drop_stop_words(F.col("mine")))
    for r in both.collect():
        assert r.w == r.mine and r.f == r.kept


def test_preview(spark):
    df = spark.createDataFrame([("x" * 300,), ("ab",)], "c STRING")
    assert [r.p for r in df.select(X.preview(F.col("c")).alias("p")).collect()] == ["x" * 200 + "...", "ab..."]


def expected(profile, c, title, author):
    """The features written out in Python."""
    ratio = lambda a, b: a / b if b else None
    words = len(c.split(" ")) if profile == "lake" else len(c.split())
    caps = len(re.findall("[A-Z]", c)) if profile == "lake" else sum(x.isupper() for x in c)
    numbers = {
        "lake": len(re.split("[0-9]+", c)),
        "documented": len(re.findall("[0-9]+", c)),
        "serving": sum(x.isdigit() for x in c),
    }
    urls = {
        "lake": len(re.split(r"https?://[^ \t\n\x0b\f\r]+", c)),
        "documented": len(re.findall("https?://", c)),
        "serving": c.lower().count("http"),
    }
    average = ratio(len(c), words)
    if profile == "serving":
        average = len(c.replace(" ", "")) / max(words, 1)
    return {
        "word_count": words, "char_count": len(c), "has_author": int(bool(author)), "title_length": len(title),
        "exclamation_count": c.count("!"), "question_count": c.count("?"), "caps_ratio": ratio(caps, len(c)),
        "avg_word_length": average, "numeric_count": numbers[profile], "url_count": urls[profile],
    }


@pytest.mark.parametrize("profile", ["lake", "documented", "serving"])
def test_random_texts(spark, profile):
    rnd = random.Random(7)
    parts = ["a", "Word", "É", "ß", "12", "7", "!", "?", " ", "  ", "\t", "\n", "http://", "https://x.y", "HTTP", "日本", "😀"]
    rows = [
        ("".join(rnd.choices(parts, k=rnd.randint(0, 25))), "t" * rnd.randint(0, 5), rnd.choice([None, "", "x"]))
        for _ in range(400)
    ]
    df = with_features(spark.createDataFrame(rows, SCHEMA), profile)
    for r in df.collect():
        want = expected(profile, r.content_cleaned, r.title_cleaned, r.author)
        assert {k: r[k] for k in want} == want, r.content_cleaned
