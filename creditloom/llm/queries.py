"""The corpus operators as registered queries over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.llm import decontamination, line_dedup, toxicity
from creditloom.llm.hard_negatives import hard_negatives
from creditloom.llm.neighbours import nearest
from creditloom.llm.packing import pack
from creditloom.llm.personal_data import personal_data
from creditloom.llm.secrets import find_secrets
from creditloom.llm.simhash import hex_fingerprint, simhash_groups
from creditloom.llm.spelling import spelling_variants
from creditloom.llm.substring_dedup import remove_repeats
from creditloom.llm.suffix_dedup import remove_repeated_bytes
from creditloom.llm.token_output import read_tokens, write_tokens
from creditloom.plans.tables import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return groups.select("doc_id", hex_fingerprint().alias("fingerprint"), "component_id")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), keep=~toxicity.held_out())
    return toxicity.toxicity(docs, model).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), vocabulary(), capacity=2048, end_id=1)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), size=20, first=5, with_text=False)


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = decontamination.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.select("doc_id", "item_id", "n_shared", "n_item")


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, vocabulary(), end_id=2)
    return read_tokens(spark, path)


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.remove_repeated_lines(table(spark, sf_dir, "documents"), counts=True)
    return kept.select("doc_id", "n_lines", "n_removed", F.md5(F.coalesce("text", F.lit(""))).alias("kept_md5"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"), shortest=5, least=3, factor=2, spoil=97)


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(table(spark, sf_dir, "documents"), size=400, with_text=False)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(
        table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, moved, positives=5, negatives=10, window=(30, 90), scale=256
    )


def queries() -> dict[str, Query]:
    return {
        "op1_simhash": op1_simhash,
        "op2_toxicity": op2_toxicity,
        "op3_secrets": op3_secrets,
        "op4_packing": op4_packing,
        "op5_substring_dedup": op5_substring_dedup,
        "op6_personal_data": op6_personal_data,
        "op7_decontamination": op7_decontamination,
        "op8_token_output": op8_token_output,
        "op9_neighbours": op9_neighbours,
        "op10_line_dedup": op10_line_dedup,
        "op11_spelling": op11_spelling,
        "op12_suffix_dedup": op12_suffix_dedup,
        "op13_hard_negatives": op13_hard_negatives,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op7_decontamination": decontamination.ORACLE,
        "op10_line_dedup": line_dedup.ORACLE,
    }
