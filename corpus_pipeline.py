"""From raw documents to training tokens, in five stages.

Each stage takes the documents that its predecessor kept, as reread from
Parquet, and returns documents with all their columns (the last one: tokens).
A stage is one operator of ``tessera.llm`` with production parameters:

1. quality: lines above their cross-document limit are removed, documents
   that fail the word rules or are depleted go;
2. near_duplicates: of each SimHash component the document with the smallest
   id stays;
3. decontamination: documents that hold a benchmark item go;
4. secrets: secrets are replaced by a mark, the documents stay;
5. tokens: number and digest of each document's ids, and digest of the text
   that they decode to.

Nulls, empty texts and tables, ties and repeated rows have the results that
the operators' modules state.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm import bpe, decontamination, quality, secrets, simhash
from tessera.llm.common import materialise, table
from tessera.session import ship_package

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return quality.clean(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return simhash.keep_one(docs, shingle=4, radius=4)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return bpe.digests(docs, VOCABULARY)


STAGES = [("quality", quality_stage), ("near_duplicates", near_duplicate_stage),
          ("decontamination", decontamination_stage), ("secrets", secret_stage), ("tokens", token_stage)]

#: SQL engines have no seeded XXH64 and no BPE; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
