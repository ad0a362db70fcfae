"""From raw documents to packed training sequences, stage by stage.

Each stage reads the Parquet that the one before wrote, works on all of it, and all but the last
return the columns of ``documents``.

Every stage takes null ids and columns, empty and very long texts and repeated rows as its operator
does, keeps extra columns whatever their names, and gives no rows for an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.llm import language, mixing, neardup, packing, quality
from tallyhouse.llm.queries import read, vocabulary
from tallyhouse.llm.shared import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is told with some confidence; null texts and texts without a letter go. Repeated rows stay."""
    return language.keep_known(docs)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the base rules and the certified cutoffs of their language; null texts have no words and go. Repeated rows stay."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near-duplicates, the smallest id; rows without id stay, of repeated rows one."""
    return neardup.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the source mix takes them: not at all, once or twice. A null source is a source, rows without words go."""
    return mixing.resample(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens with their sequence and place."""
    return packing.pack(docs, vocabulary())


STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language),
    ("quality_rules", good_quality),
    ("minhash_near_dedup", one_of_each),
    ("mixing", mixed),
    ("best_fit_packing", packed),
]

#: SQL expresses neither the language model, the signatures nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every other stage's result is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
