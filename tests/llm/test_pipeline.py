"""Each stage against a plain version of it, on its own input; nothing is left out on the way."""

import string
from collections import Counter

import corpus_pipeline as P
import pytest
from pyspark.sql import functions as F

from daytally.llm import decontaminate, language, mixing, near_dedup
from tests_llm_plain import components_by_hand, leaky_ids

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, medium, tmp_path_factory):
    """The input of every stage and the result of the last, each written and read again."""
    out = [spark.read.parquet(f"{medium}/documents.parquet")]
    for name, stage in P.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, out[-1], medium).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_stages_and_their_columns(steps):
    assert [name for name, _ in P.STAGES] == ["language", "exact_dedup", "near_dedup", "decontaminate", "mixing"]
    assert all(df.columns == COLUMNS for df in steps[:-1])
    assert steps[-1].columns == [*COLUMNS, "copy"]


def test_language_drops_what_is_rejected(steps):
    judged = language.predict_languages(steps[0]).where("not rejected")
    assert {r.doc_id for r in judged.collect()} == {r.doc_id for r in steps[1].collect()}


def test_exact_dedup_keeps_the_largest_id_of_each_text(steps):
    largest = {}
    for r in steps[1].collect():
        key = (r.text or "").translate(LOWER)
        largest[key] = max(largest.get(key, -1), r.doc_id)
    assert Counter(r.doc_id for r in steps[2].collect()) == Counter(largest.values())


def test_near_dedup_keeps_one_of_each_component(steps):
    rows = [(r.doc_id, r.text) for r in steps[2].collect()]
    assert {r.doc_id for r in steps[3].collect()} == set(components_by_hand(rows).values())


def test_decontamination_drops_leaks_only(spark, medium, steps):
    items = [r.text for r in spark.read.parquet(f"{medium}/benchmark.parquet").collect()]
    rows = [(r.doc_id, r.text) for r in steps[3].collect()]
    bad = leaky_ids(rows, items)
    assert bad and {r.doc_id for r in steps[4].collect()} == {i for i, _ in rows} - bad


def test_mix_takes_each_document_as_often_as_told(steps):
    told = {r.doc_id: r.taken // r.size for r in mixing.mixed(steps[4]).collect() if r.taken}
    got = steps[5].groupBy("doc_id").agg(F.count("*").alias("n"), F.max("copy").alias("last")).collect()
    assert {r.doc_id: r.n for r in got} == {r.doc_id: r["last"] for r in got} == told


def test_run_is_the_stages_in_a_row(spark, medium, steps):
    key = lambda df: Counter((r.doc_id, r.copy) for r in df.select("doc_id", "copy").collect())
    assert key(P.run(spark, medium)) == key(steps[-1])


def test_stages_on_an_empty_table(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet").where("false")
    for _, stage in P.STAGES:
        assert stage(spark, docs, medium).collect() == []


def test_operators_named_by_the_stages():
    assert P.without_leaks is decontaminate.without_leaks and P.without_near_duplicates is near_dedup.without_near_duplicates
