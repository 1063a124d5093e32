"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's documents.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netrollup.llm import language, minhash, mixing, packing, pii
from netrollup.llm.common import staged, table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def _sized(docs: DataFrame) -> DataFrame:
    """``n_chars`` after a change of the texts."""
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language, labelled with it; the others go."""
    return language.identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minhash.deduplicated(docs)


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and what discloses it replaced."""
    return _sized(pii.sanitise(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's share asks for."""
    return _sized(mixing.mixed_rows(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of tokenised documents and their places in sequences."""
    return packing.pack_documents(docs, TOKENIZER, ranks=RANKS)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", sanitise),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: SQL can express neither the trained language model nor the tokenizer; the tests compare every
#: stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
