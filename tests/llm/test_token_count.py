import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from daytally.llm import token_count as C

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False))


def random_texts(n, size):
    rng = random.Random(1)
    parts = [*"ab é'sT1 2.,!\n\t\x1c​ 中😀 ", "<|endoftext|>", "  ", " the", "\n\n", "'re", " '", "�"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(size))) for _ in range(n)]


def test_random_texts_agree_with_the_library(library, monkeypatch):
    monkeypatch.setattr(C, "REMEMBERED", 200)
    monkeypatch.setattr(C, "SHORT", 3)
    counter = C.FragmentCounter(PATH)
    for batch in range(10):
        texts = random_texts(400, 5 + 12 * batch)
        assert counter.count(texts) == [library(t) for t in texts]


def test_whole_table_agrees_with_the_library(spark, medium, library):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = C.token_counts(docs, PATH).collect()
    assert {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got} == {
        (i, len(t.encode()), library(t), library(t) > 512) for i, t in texts.items()
    }


def test_nulls_long_texts_and_repeated_rows(spark, library):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "x" * 300_000), (4, "word " * 200_000), (5, "é <|endoftext|>"), (5, "é <|endoftext|>")]
    got = C.token_counts(spark.createDataFrame(rows, SCHEMA), PATH).collect()
    assert [(r.doc_id, r.n_tokens) for r in got] == [(i, library(t)) for i, t in rows]
    assert [r.n_bytes for r in got[:2]] == [0, 0]


def test_empty_table_and_other_columns(spark):
    assert C.token_counts(spark.createDataFrame([], SCHEMA), PATH).collect() == []
    more = spark.createDataFrame([(1, "a b c", 9, 9)], SCHEMA + ", n_tokens long, n_bytes long")
    assert [tuple(r) for r in C.token_counts(more, PATH, limit=2).collect()] == [(1, 5, 3, True)]
