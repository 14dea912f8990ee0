"""Documents through the corpus operators, stage by stage; each stage's result is stored before the next begins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from creditloom.llm.common import stored
from creditloom.llm.decontamination import drop_contaminated
from creditloom.llm.line_dedup import remove_repeated_lines
from creditloom.llm.packing import pack
from creditloom.llm.queries import table, vocabulary
from creditloom.llm.simhash import drop_near_duplicates
from creditloom.llm.toxicity import drop_toxic, fit


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, fit(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs, shingle=4, radius=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, vocabulary(), capacity=2048, end_id=1)


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]

#: A trained classifier decides in the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
