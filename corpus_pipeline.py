"""From documents to packed training sequences, one operator a stage.

Every stage works on all rows the one before it kept, and every stage but the last returns the
columns of ``documents``. The result is one row for each piece of a document in a sequence, with
its token ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillmart.llm import line_rules, mixing, packing, repeats, simhash
from tillmart.llm.queries import END_ID, table, vocabulary
from tillmart.sources.shared import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the line and document rules, without their failing lines."""
    return line_rules.cleaned(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates, one with the smallest doc_id."""
    return simhash.kept_documents(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that stand elsewhere too; texts with nothing left go."""
    return repeats.without_repeats(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the weight of their source asks, in random order."""
    return mixing.mixed(docs).select(*docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents packed into sequences of 4096 tokens."""
    return packing.packed(docs, vocabulary("word_bpe_49k.json"), END_ID, with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("source_mix", source_mix),
    ("sequences", sequences),
]

#: SQL expresses neither XXH64 nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
