"""Joins of a long table: with a short list of rows, and with keys that may be hot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot above both limits. Fewer than HOT_KEYS keys can each hold more than
# 1 / HOT_KEYS of the rows, whatever the data: the bound on what is broadcast here.
HOT_KEYS = 50_000
HOT_ROWS = 100_000

# At 50 bytes for an md5 id in a hash table, at most about 50 MB are broadcast.
BROADCAST_ROWS = 1_000_000


def broadcast_if_few(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Send a short list of ids to every task, so that the long table it is joined to
    stays where it is; leave a longer one to a join by shuffle. Counts the list, at
    most as far as the limit."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def skew_join(
    long: DataFrame,
    short: DataFrame,
    key: str,
    spread: str,
    how: str = "inner",
    counts: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join `long` to `short` on `key`, with the rows of each hot key dealt out over
    as many groups as it has multiples of the limit, by the hash of `spread`. The
    row of `short` is copied into those groups only, so that all copies together
    number at most HOT_KEYS beyond two for each hot key. Exact for inner, left,
    semi and anti joins.

    `counts` are the rows of `long` per key, as (key, n), where they are known.
    """
    if counts is None:
        counts = long.groupBy(key).agg(F.count("*").alias("n"))
    limit = F.greatest(counts.agg(F.sum("n")).scalar() / HOT_KEYS, F.lit(float(hot_rows)))
    # By the key's hash: 12 bytes a row however long the keys. Two keys of one hash
    # are both dealt out, on both sides alike, which changes no result.
    hashed = F.xxhash64(key)
    hot = F.broadcast(
        counts.filter(F.col("n") > limit)
        .groupBy(hashed.alias("_hash"))
        .agg(F.max(F.ceil(F.col("n") / limit)).cast("int").alias("_groups"))
    )
    # Free of nulls, or the optimiser adds a check that hashes each row once more.
    groups = F.coalesce("_groups", F.lit(1))
    with_groups = lambda df: df.withColumn("_hash", hashed).join(hot, "_hash", "left")
    dealt = with_groups(long).withColumn(
        "_salt", F.coalesce(F.pmod(F.hash(spread), groups), F.lit(0))
    )
    copies = with_groups(short).withColumn(
        "_salt", F.explode_outer(F.sequence(F.lit(0), groups - 1))
    )
    scratch = ("_hash", "_groups")
    joined = dealt.drop(*scratch).join(copies.drop(*scratch), [key, "_salt"], how)
    return joined.drop("_salt")
