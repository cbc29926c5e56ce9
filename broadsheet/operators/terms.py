"""Tokens, term weights and the terms that mark a label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.functions import text as X
from broadsheet.operators.joins import skew_join
from broadsheet.schemas import LABELS


def tokenised(silver: DataFrame, drop_stop_words: bool = False) -> DataFrame:
    words = X.tokens(F.col("content_cleaned"))
    return silver.withColumn("words", X.drop_stop_words(words) if drop_stop_words else words)


def phrased(silver: DataFrame) -> DataFrame:
    """Pairs of neighbouring tokens as terms, stop words among them: phrases such as
    "according to" are made of these."""
    words, n = F.col("words"), F.size("words")
    pairs = F.zip_with(
        F.slice(words, 1, n - 1), F.slice(words, 2, n - 1), lambda a, b: F.concat_ws(" ", a, b)
    )
    none = F.array().cast("array<string>")
    return tokenised(silver).withColumn("words", F.when(n > 1, pairs).otherwise(none))


def token_counts(tokens: DataFrame) -> DataFrame:
    return tokens.select(
        "id",
        F.size("words").alias("n_tokens"),
        F.size(F.array_distinct("words")).alias("n_distinct"),
    )


def _sorted_terms(tokens: DataFrame, *keys: str) -> DataFrame:
    """The keys, a document's tokens in order without empty ones, and their number."""
    words = F.sort_array(F.filter("words", lambda w: w != ""))
    rows = tokens.select(*keys, words.alias("_sorted"))
    return rows.withColumn("_n", F.size("_sorted"))


def _begins(words: Column, i: Column) -> Column:
    """Whether a run of equal tokens begins at place i of the sorted ones."""
    return (i == 0) | (words[i] != words[i - 1])


def term_frequencies(tokens: DataFrame) -> DataFrame:
    """(id, term, tf), counted inside each row: an id is one row of silver, so nothing
    needs to meet in another task."""
    rows = _sorted_terms(tokens, "id")
    words = F.col("_sorted")
    # No filter on what is made of the text, which would make it twice.
    places = F.when(F.col("_n") > 0, F.sequence(F.lit(0), F.col("_n") - 1))
    starts = F.filter(places, lambda i: _begins(words, i))
    rows = rows.withColumn("_starts", F.concat(starts, F.array("_n")))
    runs = F.transform(
        F.slice("_starts", 1, F.size("_starts") - 1),
        lambda start, k: F.struct(
            words[start].alias("term"), (F.col("_starts")[k + 1] - start).cast("long").alias("tf")
        ),
    )
    return rows.select("id", F.inline(runs))


def term_tfidf(tokens: DataFrame) -> DataFrame:
    """(id, term, tf, df, weight) with weight = tf * ln((N + 1) / (df + 1)).

    A frequent term occurs in most documents. Its document count is just the number
    of pairs that will meet on it, so the join knows which terms to deal out.
    """
    # Terms are never null. Said here, all that use the counts have one plan and share them.
    pairs = term_frequencies(tokens).filter("term IS NOT NULL")
    df = pairs.groupBy("term").agg(F.count("*").alias("df"))
    documents = tokens.agg(F.count("*")).scalar()
    joined = skew_join(pairs, df, "term", spread="id", counts=df.withColumnRenamed("df", "n"))
    return joined.select(
        "id",
        "term",
        "tf",
        "df",
        (F.col("tf") * F.log((documents + F.lit(1.0)) / (F.col("df") + 1))).alias("weight"),
    )


def label_terms(tokens: DataFrame, labels: Sequence[str] = LABELS) -> DataFrame:
    """(label, term, weight): a term's TF-IDF weight summed over a label's documents,
    where the label has the term.

    The inverse document frequency is the same for all documents of a term, so it
    suffices to add up frequencies, per label of the fixed set, and to weight the
    sums. Whether a token is its document's first of the term is known inside the row.
    So there is one aggregation, by term, combined in the map tasks. A label outside
    the set raises, as in splits and indexing.
    """
    known = F.col("label").isNull() | F.col("label").isin(*labels)
    label = F.when(known, F.col("label")).otherwise(
        F.raise_error(F.concat(F.lit("unknown label: "), F.col("label"))).cast("string")
    )
    rows = _sorted_terms(tokens.withColumn("label", label), "label")
    words = F.col("_sorted")
    each = F.transform(words, lambda w, i: F.struct(w.alias("term"), _begins(words, i).alias("first")))
    per_term = (
        rows.select("label", F.inline(each))
        .groupBy("term")
        .agg(
            F.count_if("first").alias("df"),
            *[F.nullif(F.count_if(F.col("label") == x), F.lit(0)).alias(f"tf_{x}") for x in labels],
        )
    )
    documents = tokens.agg(F.count("*")).scalar()
    idf = F.log((documents + F.lit(1.0)) / (F.col("df") + 1))
    rows = F.array(
        *[F.struct(F.lit(label).alias("label"), F.col(f"tf_{label}").alias("tf")) for label in labels]
    )
    return (
        per_term.select("term", idf.alias("idf"), F.inline(rows))
        .filter(F.col("tf").isNotNull())
        .select("label", "term", (F.col("tf") * F.col("idf")).alias("weight"))
    )


def top_terms_by_label(tokens: DataFrame, k: int = 20, digits: int = 6) -> DataFrame:
    """The k heaviest terms of each label, ties by term. The rank prunes to k rows
    per label in every task before the rows of a label meet."""
    totals = label_terms(tokens).withColumn("weight", F.round("weight", digits))
    w = Window.partitionBy("label").orderBy(F.col("weight").desc(), "term")
    return totals.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
