"""Stages of the corpus pipeline: (spark, docs, sf_dir) -> DataFrame.

Each stage but the last returns the rows of ``docs`` that it keeps, with all their
columns. A row without an id or a text is handled as the operators define it; a
repeated id keeps or loses all its rows together where a decision is per id.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalwatch.llm import chosen_path, ecoc_lang, toxicity
from signalwatch.llm.common import read
from signalwatch.llm.packing import pack


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose language is determined: no letter, or two languages equally near, goes.

    Equally near is a gap of 0.02 per bit, a fifth of op3's flag for review, as rows that go do not come back.
    Learns from the documents' own ``lang`` where it is given.
    """
    return ecoc_lang.keep_determined(docs, ecoc_lang.fit(docs))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose toxicity score is below 0.7; learns from the table ``labels``."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of linked documents: the one with the least id."""
    return chosen_path.keep_first(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all kept documents, with their ids, in sequences of at most 2048 tokens."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
