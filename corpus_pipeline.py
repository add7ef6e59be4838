"""A corpus for training: languages recognised, repeated lines and near copies out, sources mixed, texts as tokens.

Each stage reads what its predecessor wrote as Parquet in the shared folder. The first four return the columns of documents.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stockwright.llm.bpe import bpe_stage
from stockwright.llm.jaccard import near_copies_stage
from stockwright.llm.language import identify_stage
from stockwright.llm.lines import line_stage
from stockwright.llm.mixing import mixing_stage
from stockwright.llm.tables import held, table

STAGES = [
    ("language_id", identify_stage),
    ("line_dedup", line_stage),
    ("near_copies", near_copies_stage),
    ("mixing", mixing_stage),
    ("bpe", bpe_stage),
]

#: Cosines of bundled vectors, Pfair schedules and merges by rank have no SQL form; tests/llm compares the mixed order
#: with plain Python, and the texts with the stages run one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = held(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
