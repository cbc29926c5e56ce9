"""The corpus pipeline: documents in, token shards out.

Each stage takes what the one before kept, with the columns of documents, and decides on
all of it; the last writes the token store and returns what can be read back from it.
Each result is written as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from broadsheet.llm import cotrain, decontam, hyperminhash, mixing, token_store
from broadsheet.llm.common import written

TOKENIZER = "byte_bpe_50k.json"
# Near-duplicates share so much of their shingles, in percent; op8's own 85 is its query's.
SIMILAR = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = cotrain.score_quality(docs, cotrain.train(docs, labels))
    return scored.filter("accepted").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest doc_id."""
    return hyperminhash.deduplicate(docs, percent=SIMILAR)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight asks for, shuffled."""
    return mixing.mix_sources(docs).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document's ids lie in the token store, and their checksum."""
    folder = token_store.write_store(docs, public_tokenizers.path(TOKENIZER))
    return token_store.fetch(spark, folder, token_store.stored_keys(spark, folder), digest=True)


STAGES = [
    ("quality classifier", quality),
    ("near-dedup", near_dedup),
    ("decontamination", decontamination),
    ("source mix", mix),
    ("token store", tokens),
]

# The classifier is learned, so SQL has no twin of the whole.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
