"""A corpus pipeline of five stages: from raw documents to packed token sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the
next stage's docs.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from curveloom.llm import minhash, mixing, packing, secrets, toxicity
from curveloom.llm.registry import QUERIES
from curveloom.llm.tables import stored, table

#: least likeness of the shingle sets of near copies
NEAR_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text scores below 0.5, as they are; NULL and empty texts are scored like others.

    The model is fitted on the labelled ones of ``docs``.
    """
    model = toxicity.fitted(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that with the smallest doc_id.  Rows without words all stay.

    Copies share 80 % of their five-word shingles; op1's 85 % are its own.
    """
    return minhash.without_near_duplicates(docs, NEAR_PERCENT)


def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows; each secret in a text becomes a mark, and n_chars follows the text."""
    clean = secrets.without_secrets(docs)
    return clean.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that are drawn by the mixture's probabilities."""
    return mixing.mixed(docs, mixing.dimensions_of()).where("sampled").select("doc.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash near-dedup", drop_near_duplicates),
    ("secret scan", remove_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: training and n-gram scores of the first stage, and the mixture's raking, are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


QUERIES["pipeline"] = run
