"""From documents to tokens in five stages: language, repetition rules, near copies, benchmark passages, encoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sluice.llm import bpe, decontam, langid, rules, simhash_similar
from sluice.llm.common import cut, id_remainder
from sluice.llm.queries import VOCABULARY

#: A document whose likeliest language has a smaller share than this is rejected; texts without letters are as well.
LEAST_LANGUAGE_SHARE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep(docs, langid.fit(docs.where(id_remainder("doc_id", 3) != 1)), LEAST_LANGUAGE_SHARE)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rules.keep(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_similar.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.keep(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(docs, public_tokenizers.path(VOCABULARY), with_ids=True)


STAGES = [("language", language), ("quality", quality), ("near copies", near_copies), ("decontamination", decontaminate), ("encoding", encode)]
#: Language tables, near copies and merges are no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what each keeps is written to the shared folder, since the next reads it more than once."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
