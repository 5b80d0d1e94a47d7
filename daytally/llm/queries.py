"""The registered queries of this subpackage; each runs over its whole tables. Their SQL is in `oracles`."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from daytally.llm import (
    decontaminate,
    exact_dedup,
    html_extract,
    language,
    lexical_search,
    mixing,
    near_dedup,
    pii,
    quality,
    token_count,
    vector_search,
    warc,
    whitening,
)
from daytally.llm.common import shared_folder

Query = Callable[[SparkSession, str], DataFrame]

VOCABULARY = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


def _decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def _warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"), f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}")


def _language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predict_languages(_table(spark, sf_dir, "documents"))


def _pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text and n_entities; the other columns of documents are dropped."""
    return pii.with_surrogates(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def _token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_count.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def _near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def _html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_texts(_table(spark, sf_dir, "pages"))


def _mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(_table(spark, sf_dir, "documents"))


def _vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.top_vectors(_table(spark, sf_dir, "embeddings"))


def _lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def _whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(_table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    return {
        "op1_exact_dedup": _exact_dedup,
        "op2_warc": _warc,
        "op3_language": _language,
        "op4_pii": _pii,
        "op5_token_count": _token_count,
        "op6_quality": _quality,
        "op7_mixing": _mixing,
        "op8_decontaminate": _decontaminate,
        "op9_near_dedup": _near_dedup,
        "op10_html_extract": _html_extract,
        "op11_vector_search": _vector_search,
        "op12_lexical_search": _lexical_search,
        "op13_whitening": _whitening,
    }
