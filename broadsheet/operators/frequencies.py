"""Document frequencies of hashed terms as parts that merge, and what they are made of."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import ElementwiseProduct, HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.operators import terms as W

# How many terms name a bucket.
TERMS = 5


def frequency_part(counted: DataFrame, sign: int = 1, column: str = "term_counts") -> DataFrame:
    """One row: the documents and, for each bucket, those that have a term in it. With
    `sign` -1 the documents are withdrawn. No row without documents."""
    summary = Summarizer.metrics("numNonZeros").summary(F.col(column)).alias("s")
    # By a constant, as without documents there is no row.
    figures = counted.groupBy(F.lit(0).alias("all")).agg(summary, F.count("*").alias("n"))
    present = F.transform(vector_to_array("s.numNonZeros"), lambda v: v * sign)
    return figures.select((F.col("n") * sign).alias("documents"), present.alias("frequencies"))


def merged_frequencies(parts: DataFrame) -> DataFrame:
    """(bucket, df, documents) over all parts."""
    each = parts.select(F.posexplode("frequencies").alias("bucket", "df"))
    total = parts.agg(F.coalesce(F.sum("documents"), F.lit(0))).scalar()
    sums = each.groupBy("bucket").agg(F.sum("df").cast("long").alias("df"))
    return sums.withColumn("documents", total)


def text_model(counting: PipelineModel, frequencies: DataFrame, output: str = "tfidf_features") -> PipelineModel:
    """The text pipeline with weights from document frequencies, the same as those that a
    fit over all documents has: ln((documents + 1) / (df + 1))."""
    weight = F.log((F.col("documents") + 1.0) / (F.col("df") + 1.0))
    # One number for each dimension of the vectors.
    weights = {r.bucket: r.weight for r in frequencies.select("bucket", weight.alias("weight")).collect()}
    size = next(s for s in counting.stages if isinstance(s, HashingTF)).getNumFeatures()
    dense = Vectors.dense([weights.get(k, 0.0) for k in range(size)])
    product = ElementwiseProduct(scalingVec=dense, inputCol="term_counts", outputCol=output)
    return PipelineModel(stages=[*counting.stages, product])


def bucket_terms(silver: DataFrame, dimensions: int, k: int = TERMS) -> DataFrame:
    """(bucket, rank, term, df): the `k` terms of each bucket that most documents have, ties
    by term. Terms are counted inside their documents and hashed once each; every task
    keeps `k` for each bucket before those of a bucket meet."""
    pairs = W.term_frequencies(W.tokenised(silver, drop_stop_words=True))
    df = pairs.groupBy("term").agg(F.count("*").alias("df"))
    hashing = HashingTF(inputCol="words", outputCol="hashed", numFeatures=dimensions)
    hashed = hashing.transform(df.withColumn("words", F.array("term")))
    bucket = (F.array_position(vector_to_array("hashed"), F.lit(1.0)) - 1).cast("int")
    own = Window.partitionBy("bucket").orderBy(F.col("df").desc(), "term")
    ranked = hashed.select("term", "df", bucket.alias("bucket")).withColumn("rank", F.row_number().over(own))
    return ranked.filter(F.col("rank") <= k).select("bucket", "rank", "term", "df")
