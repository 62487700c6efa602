"""The corpus pipeline: five stages over ``documents``, each written and read again.

1. quality classifier: documents that it rejects go;
2. MinHash near-dedup: of each class of near copies the first document stays;
3. suffix-array dedup: bytes of passages that start earlier go, and with them
   documents of which nothing is left;
4. benchmark decontamination: contaminated documents go;
5. SentencePiece encoding and decoding: the documents with their token ids, their
   number and whether decoding gave the text back.

Each stage works on all rows that its predecessor kept; rows repeating a doc_id
stay or go together; columns that the stages do not know pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from icuflow.llm import decontaminate, minhash_dedup, quality_model, sentencepiece_codec, suffix_dedup
from icuflow.llm.common import stage
from icuflow.sources.tables import table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_model.keep(docs, table(spark, sf_dir, "labels").where(~quality_model.held_out()))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_dedup.keep(docs)


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.keep(docs, length_col="n_chars" if "n_chars" in docs.columns else None)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep(docs, table(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.tokenize(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_stage),
    ("minhash near-dedup", near_dedup_stage),
    ("suffix-array dedup", suffix_stage),
    ("benchmark decontamination", decontamination_stage),
    ("sentencepiece", token_stage),
]

# The classifier is learnt, so SQL cannot give the rows; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, function) in enumerate(STAGES):
        docs = function(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{k + 1}")
    return docs
