"""The corpus pipeline: stages over documents, each written and read again."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from signalwatch.llm import stages
from signalwatch.llm.common import read
from signalwatch.session import ensure_checkpoint_dir

STAGES = [
    ("language", stages.language_stage),
    ("toxicity", stages.toxicity_stage),
    ("near_duplicates", stages.near_duplicate_stage),
    ("packing", stages.packing_stage),
]

#: Trained models and a tokenizer decide here, which SQL cannot express; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in order to ``documents``; each result is written to the shared folder and read again."""
    base = os.path.join(ensure_checkpoint_dir(spark), f"pipeline-{uuid.uuid4().hex}")
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
