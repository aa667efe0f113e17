"""A training corpus from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again as the
next stage's documents. All but the last return the columns of `documents`; any further columns
go through unchanged. An empty table goes through all stages as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from matchlake.llm.common import table
from matchlake.llm.decontamination import decontaminate
from matchlake.llm.line_dedup import without_boilerplate
from matchlake.llm.pieces import default_model, with_pieces
from matchlake.llm.near_dedup import one_of_each_group
from matchlake.llm.toxicity import remove_toxic, training_labels
from matchlake.session import materialise


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier does not take for toxic; labels of the held-out fold are not used."""
    return remove_toxic(docs, training_labels(table(spark, sf_dir, "labels")))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without lines that stand on many sites; one that has lost lines and has no text left goes."""
    return without_boilerplate(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    return one_of_each_group(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of which less than a twentieth of the words stand in the benchmark."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids, the number of them, and the text they decode to."""
    return with_pieces(docs, default_model())


STAGES = [
    ("toxicity", toxicity_stage),
    ("line dedup", line_dedup_stage),
    ("near dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("sentencepiece", sentencepiece_stage),
]
# A fitted classifier and a tokenizer's merges are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
