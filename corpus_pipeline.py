"""The corpus pipeline: five stages, each written as Parquet and read again as the next one's documents.

1. language ID: documents without a recognised language go;
2. SimHash near-duplicates: one document of each group stays;
3. PII: personal data in the texts is replaced by its kind;
4. mixing: every document as many times as its source's rate says;
5. packing: pieces of token sequences (the last stage's rows).

Stages read the columns doc_id, text, lang and source of ``documents`` and,
but for the last, return all columns of their input. Nulls, empty tables and
repeated rows behave as the operators' modules say.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from rankflow.llm import langid, mixing, packing, pii, simhash
from rankflow.session import checkpoint_dir


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_known(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs, simhash.SHINGLE, simhash.MAX_DISTANCE)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redacted(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs)


STAGES = [
    ("language ID", language),
    ("near-duplicates", near_duplicates),
    ("PII", personal_data),
    ("mixing", mix),
    ("packing", pack),
]

#: language models, components and packing have no SQL form; tests hold the stages against plain Python
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; what the others return is kept in the shared checkpoint folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        out = f"{folder}/{i}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
