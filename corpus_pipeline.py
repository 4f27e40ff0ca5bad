"""Documents to training tokens: five stages, each written and read again.

1. ``language_id``: documents whose language is not recognised go.
2. ``near_dedup``: of every near-duplicate group (five-word shingles, similarity
   0.8 or more) one document stays.
3. ``decontaminate``: benchmark passages are cut out of the texts; a document of
   which they are more than half goes.
4. ``secret_scan``: secrets in the texts are replaced by a mark.
5. ``bpe_encode``: the token ids of every text (columns ``ids``, ``n_tokens``).

All stages but the last return the columns of ``documents``; ``n_chars`` follows
the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import _text as T
from tidemark.llm import bpe, decontaminate, langid, near_dup, secret_scan

#: At the similarity 0.80 fewer than 37 of 64 equal coordinates have a probability of 1.4e-5.
NEAR = near_dup.Limits(similarity=80, matches=37)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.accepted(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.keep_one(docs, limits=NEAR)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets_redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, carry=True)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontamination),
    ("secret_scan", secrets_redacted),
    ("bpe_encode", bpe_encode),
]

#: A trained network and a tokenizer are beyond SQL; the tests hold the rows
#: against a plain version of every stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = T.kept(stage(spark, docs, sf_dir), name)
    return docs
