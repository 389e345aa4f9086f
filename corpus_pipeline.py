"""The corpus pipeline: language ID, near copies, personal data, mixing, packing.

Each stage gets the rows its predecessor kept and is written as Parquet in the folder the cluster shares, so a stage
never recomputes the one before it and lost executors cost one stage's tasks only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltgate.llm import langid, mixing, ngram_join, pack, private
from siltgate.llm.common import stored
from siltgate.llm.queries import table, word_bpe


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model, fitted on a bounded sample of the labelled ones, does not reject."""
    model = langid.fit(docs)
    return langid.predict(docs, model).where(~F.col("lang_rejected")).select(*docs.columns)


#: Near copies of this stage: n-grams of so many words, and the part of them in percent that both share.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near copies; rows without an id stay."""
    return ngram_join.keep_one(docs, words=NEAR_WORDS, percent=NEAR_PERCENT)


def without_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; n_chars follows the text."""
    masked = private.mask_private(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their weights: a document comes once for each epoch that uses it."""
    return mixing.mix(docs).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their place in the training sequences."""
    return pack.pack(docs, word_bpe())


STAGES = [
    ("language_id", known_languages),
    ("ngram_join", one_of_each),
    ("private_data", without_private_data),
    ("mixing", mixed),
    ("packing", packed),
]

#: Four of the five stages are beyond SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
