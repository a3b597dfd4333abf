"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessel.llm import (
    chat, collocations, decontaminate, fingerprints, licenses, packing, ppm, quality, search, simhash, substring, tokens,
    toxicity,
)
from tessel.llm.words import crc_remainder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, d: str) -> DataFrame:
    return substring.duplicate_passages(_table(spark, d, "documents"))


def op2_simhash_components(spark: SparkSession, d: str) -> DataFrame:
    return simhash.simhash_components(_table(spark, d, "documents")).select("doc_id", "fingerprint", "component_id")


def op3_document_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    return fingerprints.compare(_table(spark, d, "documents"))


def op4_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontaminate.matches(_table(spark, d, "documents"), _table(spark, d, "benchmark"))


def op5_ppm_score(spark: SparkSession, d: str) -> DataFrame:
    return ppm.score(_table(spark, d, "documents"), train=crc_remainder("doc_id", 7) != 2)


def op6_toxicity(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, d, "documents"), _table(spark, d, "labels"))


def op7_license_scan(spark: SparkSession, d: str) -> DataFrame:
    found = licenses.scan(_table(spark, d, "documents"))
    return found.drop("matches").withColumn("score", F.round("score", 6))


def op8_best_fit_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.packed_documents(_table(spark, d, "documents"), tokens.default_tokenizer())


def op9_chat_format(spark: SparkSession, d: str) -> DataFrame:
    turns = _table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    fixed = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    path = chat.default_tokenizer()
    return chat.read_back(chat.format_conversations(turns.unionByName(fixed), path), path)


def op10_sequence_files(spark: SparkSession, d: str) -> DataFrame:
    files, _ = tokens.write_sequences(_table(spark, d, "documents"), tokens.default_tokenizer(), end_id=1)
    return tokens.read_documents(spark, files)


def op11_lexical_search(spark: SparkSession, d: str) -> DataFrame:
    return search.search(_table(spark, d, "documents"), _table(spark, d, "benchmark"))


def op12_collocations(spark: SparkSession, d: str) -> DataFrame:
    return collocations.collocations(_table(spark, d, "documents"))


def op13_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    return quality.quality(_table(spark, d, "documents"), _table(spark, d, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_simhash_components,
        op3_document_fingerprints,
        op4_decontamination,
        op5_ppm_score,
        op6_toxicity,
        op7_license_scan,
        op8_best_fit_packing,
        op9_chat_format,
        op10_sequence_files,
        op11_lexical_search,
        op12_collocations,
        op13_quality_rules,
    )
}
ORACLE: dict[str, str] = {
    "op7_license_scan": licenses.oracle_sql(),
    "op11_lexical_search": search.oracle_sql(),
    "op12_collocations": collocations.oracle_sql(),
}
