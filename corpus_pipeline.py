"""The pipeline over `documents`: tell languages, drop copies and near copies, drop leaked passages, mix the sources.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the columns of `documents`; the
last returns every document as often as the mix takes it, numbered in `copy`. SQL cannot express the language model, so
there is no SQL for the whole. `run` writes what a stage keeps to the shared folder, and the next stage reads it there, so
that no stage is computed twice; these files stay, as the result is read from the last of them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from daytally.llm.common import shared_folder
from daytally.llm.decontaminate import without_leaks
from daytally.llm.exact_dedup import without_copies
from daytally.llm.language import without_rejected
from daytally.llm.mixing import mix
from daytally.llm.near_dedup import without_near_duplicates

ORACLE_SQL = None


def tell_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_rejected(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_near_duplicates(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


STAGES = [
    ("language", tell_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontaminate", drop_leaks),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
