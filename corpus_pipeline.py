"""The corpus pipeline: language ID, near duplicates, secrets, mixing, packing.

Each stage is one operator of callweave.llm applied to all that the stage before
kept. Stages exchange Parquet files in the shared folder, so a lost executor costs
no more than the stage that runs.

* language: documents without a letter, without a language that holds 30 % of their
  letters, or with less than 30 % of them in the scripts of learned languages, go.
* near_duplicates: of each group of near copies, over shingles of five words and a
  similarity of 0.8, the smallest doc_id stays.
* secrets: what the scan finds, encoded runs included, is masked in the text.
* mix: each document is repeated as its source's target asks.
* pack: the mixed documents are tokenised and packed into sequences of 2048.

Defined results: null and empty texts go in the first stage; of rows that repeat a
doc_id one stays after the second; rows without a doc_id are near duplicates of
nothing and stay; ties go to the smallest doc_id; null sources are one source; texts
of any length pass whole; other columns are kept up to the last stage, whatever their
names; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from callweave.llm import langid, mixing, neardup, packing, secrets
from callweave.llm._shared import materialise, prepare, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return langid.keep_known(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return neardup.deduplicate(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return secrets.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack(docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("secrets", secret_scan), ("mix", mix), ("pack", pack)]

#: Trained models, MinHash and byte-pair tokens have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents that pass the stages."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
