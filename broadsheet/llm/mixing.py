"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.llm.common import tasks_for, written
from broadsheet.operators.joins import skew_join

SEED = "mix-1"
# Default target: a source's share of the characters, to this power, over the sum.
TEMPERATURE = 0.5
BITS = 52
# Tables of so many numbers or fewer, 8 bytes each, go to every task.
BROADCAST_NUMBERS = 4_000_000


def _hash52(*parts):
    """52 bits of md5 of the parts, as a long: the same in any engine."""
    text = F.concat_ws("|", *parts)
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def _key():
    """Source as a join key that a null can match."""
    return F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), "source"))


def _size():
    """Characters of a document and one for its end, so that no source is without size."""
    return F.length(F.coalesce("text", F.lit(""))) + 1


# So far, in standard deviations and beyond, a table reaches to either side of its mean.
SPREAD, MARGIN = 12, 20


def _log_factorial(n):
    """ln(n!) of a large n, by Stirling's series."""
    x = n.cast("double")
    return x * F.log(x) - x + F.log(x * (2 * math.pi)) / 2 + 1 / (12 * x) - 1 / (360 * x * x * x)


def poisson_tables(rated: DataFrame) -> DataFrame:
    """`rated` (_key, rate) with `first` and `cdf`: the array of P(X <= k) for a mean of
    `rate`, for k from `first` on. Below `first`, and past the last k, lies less than a
    double can tell from nothing; so a table is as long as the root of its mean, and each
    value is the one before it and one more term."""
    first = F.greatest(F.floor(F.col("rate") - SPREAD * F.sqrt("rate") - MARGIN), F.lit(0))
    last = F.ceil(F.col("rate") + SPREAD * F.sqrt("rate") + MARGIN)
    rows = rated.select("_key", "rate", first.alias("first"), F.explode(F.sequence(first, last)).alias("k"))
    upto = Window.partitionBy("_key").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Of the first row ln(k!) as it is, of each later one the logarithm that it adds.
    start = F.when(F.col("first") == 0, 0.0).otherwise(_log_factorial(F.col("first")))
    added = F.when(F.col("k") == F.col("first"), start).otherwise(F.log(F.greatest("k", F.lit(1)).cast("double")))
    rows = rows.withColumn("log_factorial", F.sum(added).over(upto))
    # Without a rate there are no copies: all of the weight is on 0.
    term = F.exp(F.col("k") * F.log("rate") - F.col("rate") - F.col("log_factorial"))
    rows = rows.withColumn("cdf", F.sum(F.when(F.col("rate") > 0, term).otherwise((F.col("k") == 0).cast("double"))).over(upto))
    each = F.sort_array(F.collect_list(F.struct("k", "cdf")))
    return rows.groupBy("_key").agg(F.first("first").alias("first"), each.alias("each")).select("_key", "first", F.col("each.cdf").alias("cdf"))


def copies_at(u, first, cdf):
    """How many k have P(X <= k) <= u: the table is searched by halves."""
    middle = lambda x: F.floor((x["low"] + x["high"]) / 2)
    over = lambda x: F.element_at(cdf, (middle(x) + 1).cast("int")) <= u
    step = lambda x, _: F.when(
        x["low"] < x["high"],
        F.when(over(x), F.struct((middle(x) + 1).alias("low"), x["high"].alias("high")))
        .otherwise(F.struct(x["low"].alias("low"), middle(x).alias("high"))),
    ).otherwise(x)
    size = F.size(cdf).cast("long")
    halvings = F.sequence(F.lit(0), F.ceil(F.log2(size + 1)).cast("int"))
    found = F.aggregate(halvings, F.struct(F.lit(0).cast("long").alias("low"), size.alias("high")), step)
    return first + found["low"]


def source_rates(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    temperature: float = TEMPERATURE,
    budget: float = 1.0,
) -> DataFrame:
    """One row a source: source, size, rate (mean copies of each of its documents) and
    the Poisson distribution function of that mean, see `poisson_tables`.

    `weights` are target shares by source, in any scale; a source they leave out, null
    included, has weight 0. Without them a source's weight is its size to the power of
    `temperature`. `budget` is the size of the mix over the size of `docs`.
    """
    sizes = docs.groupBy(_key().alias("_key")).agg(
        F.first("source").alias("source"), F.sum(_size()).cast("double").alias("size"),
        F.count("*").alias("n"),
    )
    if weights is None:
        weighted = sizes.withColumn("weight", F.pow("size", F.lit(float(temperature))))
    else:
        given = docs.sparkSession.createDataFrame(
            [("n" if k is None else f"s{k}", float(v)) for k, v in weights.items()],
            "_key string, weight double",
        )
        weighted = sizes.join(given, "_key", "left").withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    weighted = written(weighted, "sources")
    totals = weighted.agg(F.sum("size").alias("all_size"), F.sum("weight").alias("all_weight"))
    rate = F.lit(float(budget)) * F.col("all_size") * F.col("weight") / F.col("all_weight") / F.col("size")
    rated = weighted.join(F.broadcast(totals)).withColumn("rate", F.coalesce(F.try_divide(rate, F.lit(1.0)), F.lit(0.0)))
    rated = written(rated.select("_key", "source", "size", "n", "rate"), "rates")
    return rated.join(poisson_tables(rated), "_key")


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    temperature: float = TEMPERATURE,
    budget: float = 1.0,
    seed: str = SEED,
) -> DataFrame:
    """`docs` with each document repeated so that sources reach their target weights in
    the mean, in a global random order.

    A document's number of copies is the inverse of its source's Poisson distribution
    function at a uniform number hashed from seed and doc_id (the text where doc_id is
    null), so it is the same in every run and any partitioning. Added columns: rate,
    n_copies, copy (from 0) and shuffle_key, by which the result is ordered across and
    inside partitions. All columns of `docs` are kept, whatever their names, but for ones
    with these four, which are replaced. Null and empty texts are documents of size 1; null is a source
    of its own; rows that repeat get the same count, each for itself. No rows give none.
    """
    spark = docs.sparkSession
    added = ("rate", "n_copies", "copy", "shuffle_key")
    docs = docs.drop(*added)
    # Once from storage: used for the count and for the join.
    rates = written(source_rates(docs, weights, temperature, budget), "tables")
    who = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit(""))))
    # A document is one column, so that no name of its own meets one from here.
    keyed = docs.select(_key().alias("_key"), who.alias("_who"), F.struct(*docs.columns).alias("_row"))
    short = rates.select("_key", "rate", "first", "cdf")
    if (rates.agg(F.sum(F.size("cdf") + 8)).first()[0] or 0) <= BROADCAST_NUMBERS:
        joined = keyed.join(F.broadcast(short), "_key")
    else:
        joined = skew_join(keyed, short, "_key", "_who", counts=rates.select("_key", "n"))
    u = _hash52(F.lit(seed), F.lit("count"), F.col("_who")) / F.lit(float(1 << BITS))
    counted = joined.withColumn("_u", u)
    counted = counted.withColumn("n_copies", copies_at(F.col("_u"), F.col("first"), F.col("cdf"))).filter("n_copies > 0")
    copies = counted.select("_row", "_who", "rate", "n_copies").withColumn(
        "copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_copies") - 1))
    )
    key = _hash52(F.lit(seed), F.lit("order"), F.col("_who"), F.col("copy").cast("string"))
    copies = copies.withColumn("shuffle_key", key)
    n = tasks_for(docs)
    # The key is uniform, so equal stretches of it are equal shares of the rows.
    place = F.floor(F.col("shuffle_key") / F.lit(float(1 << BITS)) * n).cast("int")
    spread = copies.repartitionById(n, place).sortWithinPartitions("shuffle_key", "_row.doc_id", "copy")
    return spread.select("_row.*", *added)
