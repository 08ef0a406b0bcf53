"""The operators of this package as queries over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillmart.llm import (
    filter_audit,
    language_id,
    line_rules,
    mixing,
    packing,
    repeats,
    simhash,
    token_counts,
    token_files,
    vector_codes,
    vector_links,
    warc,
    word_windows,
)
from tillmart.sources.shared import new_folder

#: What ``word_bpe_49k.json`` has no id of its own for is marked by this id.
END_ID = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.packed(docs, vocabulary("word_bpe_49k.json"), END_ID)


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.report(table(spark, sf_dir, "documents"))


def op3_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.report(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identified(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), new_folder(spark, "archives"))


def op6_vector_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_links.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_counts.token_counts(docs, vocabulary("piece_bpe_32k.model"), spell=True)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "tokens")
    docs = table(spark, sf_dir, "documents")
    token_files.write(docs, path, vocabulary("word_bpe_49k.json"), END_ID)
    return token_files.digests(spark, path)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.report(table(spark, sf_dir, "embeddings"))


def op13_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_windows.report(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_packing,
            op2_repeats,
            op3_line_rules,
            op4_language_id,
            op5_warc,
            op6_vector_links,
            op7_token_counts,
            op8_token_files,
            op9_simhash,
            op10_mixing,
            op11_filter_audit,
            op12_vector_codes,
            op13_windows,
        )
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_line_rules": line_rules.SQL,
        "op10_mixing": mixing.sql(),
        "op11_filter_audit": filter_audit.SQL,
        "op12_vector_codes": vector_codes.SQL,
        "op13_windows": word_windows.SQL,
    }
