"""Phrases by association: neighbouring words that meet more often than chance has it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.functions import text as X

# Pairs found less often are not judged. Fixed value: the score that chance exceeds once in a thousand.
MIN_COUNT, MIN_SCORE = 5, 10.83
# Counters of each row of the sketch, and its rows. A join with those that are large enough
# is a broadcast of at most so many numbers.
WIDTH, DEPTH = 1 << 20, 2


def adjacent_words(silver: DataFrame) -> DataFrame:
    """(a, b) for all neighbouring tokens of all documents; empty tokens make no pair."""
    rows = silver.select(X.tokens(F.col("content_cleaned")).alias("words"))
    n = F.size("words")
    # By place: all of it is generated code, and no filter has the tokens made twice.
    places = F.when(n > 1, F.sequence(F.lit(0), n - 2))
    pairs = rows.select("words", F.explode(places).alias("i"))
    pairs = pairs.select(F.col("words")[F.col("i")].alias("a"), F.col("words")[F.col("i") + 1].alias("b"))
    return pairs.filter((F.col("a") != "") & (F.col("b") != ""))


def frequent_pairs(pairs: DataFrame, min_count: int = MIN_COUNT, width: int = WIDTH, depth: int = DEPTH) -> DataFrame:
    """(a, b, n) of pairs found at least `min_count` times, exact.

    Most distinct pairs occur once or twice, and each would be a row of the shuffle. A
    count-min sketch is taken first: pairs are counted by the hash of each row of it, which
    never counts too few. Only pairs whose counters all reach the limit are then counted
    one by one.
    """
    counters = F.array(*(F.pmod(F.xxhash64("a", "b", F.lit(seed)), F.lit(width)).cast("int") for seed in range(depth)))
    counted = pairs.select(F.posexplode(counters).alias("row", "counter")).groupBy("row", "counter")
    large = counted.agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)
    likely = pairs.withColumn("counters", counters)
    for row in range(depth):
        own = F.broadcast(large.filter(F.col("row") == row).select(F.col("counter").alias("own")))
        likely = likely.join(own, F.col("counters")[row] == F.col("own"), "left_semi")
    return likely.groupBy("a", "b").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


def _part(observed: Column, total: Column, row: Column, column: Column) -> Column:
    """A cell's part of the score; nothing where it is empty."""
    return F.when(observed > 0, observed * F.log(observed * total / (row * column))).otherwise(0.0)


def likelihood_ratio(ab: Column, first: Column, second: Column, total: Column) -> Column:
    """How much better two words that depend on each other explain the four counts of a
    pair than two that do not."""
    return 2 * (
        _part(ab, total, first, second)
        + _part(first - ab, total, first, total - second)
        + _part(second - ab, total, total - first, second)
        + _part(total - first - second + ab, total, total - first, total - second)
    )


def associated_phrases(silver: DataFrame, min_count: int = MIN_COUNT, min_score: float = MIN_SCORE) -> DataFrame:
    """(first, second, n, score) of pairs of neighbouring words that occur at least
    `min_count` times, more often than their words alone would make them, by a
    log-likelihood ratio of at least `min_score`."""
    # All pairs are counted once, and the words from the counts: in a large table most
    # pairs are frequent by any sketch of bounded width, and the texts are read once.
    counts = adjacent_words(silver).groupBy("a", "b").agg(F.count("*").alias("n"))
    # How often a word begins a pair and how often it ends one: one aggregation for both.
    sides = counts.select(F.inline(F.array(
        F.struct(F.col("a").alias("word"), F.col("n").alias("begins"), F.lit(0).cast("long").alias("ends")),
        F.struct(F.col("b").alias("word"), F.lit(0).cast("long").alias("begins"), F.col("n").alias("ends")),
    )))
    margins = sides.groupBy("word").agg(F.sum("begins").alias("begins"), F.sum("ends").alias("ends"))
    # Equal sums, and both sides in one column: so all that use the margins use one exchange.
    total = margins.agg(F.greatest(F.sum("begins"), F.sum("ends"))).scalar()
    margins = margins.select("word", F.array("begins", "ends").alias("sides"))
    found = counts.filter(F.col("n") >= min_count)
    found = found.join(margins.select(F.col("word").alias("a"), F.col("sides").alias("first_sides")), "a")
    found = found.join(margins.select(F.col("word").alias("b"), F.col("sides").alias("second_sides")), "b")
    found = found.withColumns({"f": F.col("first_sides")[0], "s": F.col("second_sides")[1]})
    number = lambda c: F.col(c).cast("double")
    found = found.withColumn("t", total.cast("double"))
    score = likelihood_ratio(number("n"), number("f"), number("s"), F.col("t"))
    more = number("n") * F.col("t") > number("f") * number("s")
    scored = found.filter(more).withColumn("score", score).filter(F.col("score") >= min_score)
    return scored.select(F.col("a").alias("first"), F.col("b").alias("second"), "n", "score")
