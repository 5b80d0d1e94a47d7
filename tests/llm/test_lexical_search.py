import math
import re
import string
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from daytally.llm import lexical_search
from daytally.llm.lexical_search import count_terms, ranked

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, top=10):
    held = [(i, Counter(w)) for i, t in docs if (w := terms(t))]
    n_docs, n_terms = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = Counter()
    for item_id, text in items:
        scored = []
        for doc_id, c in held:
            m = 100 - 90 + (90 * c.total() * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
                for t in set(terms(text))
                if c[t]
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, unknown, doc_id) in enumerate(sorted(scored)[:top], 1):
            out[item_id, rank, None if unknown else doc_id, -score] += 1
    return out


def check(spark, docs, items, parts=3, **how):
    d, i = spark.createDataFrame(docs, DOCS).repartition(parts), spark.createDataFrame(items, ITEMS)
    assert Counter(map(tuple, ranked(d, i, **how).collect())) == brute(docs, items, how.get("top", 10))


ITEM_ROWS = [(1, "The cat, the DOG"), (2, "élan Élan 42"), (2, "cat"), (None, "dog"), (3, None), (4, ""), (5, "nowhere"), (6, "cat " * 3000 + "x1_y2")]


def test_odd_rows(spark):
    docs = [
        (1, "the cat"), (2, "the cat"), (2, "the cat"), (None, "the cat"), (3, None), (4, ""), (5, "--- ..."), (6, "CAT-dog_cat's"),
        (7, "élan 42"), (8, "Élan"), (9, "word " * 60_000 + "dog"), (10, "the " * 300), (None, "the cat"), (11, "x1 y2\0dog"), (0, "the cat"),
    ]
    check(spark, docs, ITEM_ROWS)
    check(spark, docs, ITEM_ROWS, top=2, block_bytes=5000)


WORDS = st.lists(st.sampled_from(["a", "B", "b", "c", "dd", "é", "-"]), max_size=12).map(" ".join)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 9) | st.none(), WORDS | st.none()), max_size=30), st.lists(st.tuples(st.integers(0, 3), WORDS), max_size=4))
def test_agrees_with_brute_force(spark, docs, items):
    check(spark, docs, items, top=3)


def test_hot_stratum_and_small_shards(spark, monkeypatch):
    docs = [(i, "same words here") for i in range(1500)] + [(i, f"own{i % 7} words " + "more " * (i % 40)) for i in range(1500, 3000)]
    check(spark, docs, [(1, "same words"), (2, "own3 more"), (3, "here own6")], parts=6)


def test_shards_are_bounded_and_hold_one_normaliser():
    import pyarrow as pa

    rows = [(m, i, [0, 1], [1 + i % 3, 2]) for m in (5, 6) for i in range(9000)]
    batch = pa.RecordBatch.from_pydict(
        {
            "m": [r[0] for r in rows],
            "doc_id": [r[1] for r in rows],
            "terms": pa.array([r[2] for r in rows], pa.list_(pa.int32())),
            "tfs": pa.array([r[3] for r in rows], pa.list_(pa.int64())),
        }
    )
    shards = [s for part in (batch.slice(0, 7000), batch.slice(7000)) for b in [part] for s in b.to_pylist()]
    assert len(shards) == len(rows)
    packed = [b.to_pylist()[0] for b in lexical_search._packed(iter([batch.slice(0, 7000), batch.slice(7000)]))]
    assert all(len(s["ids"]) <= lexical_search.SHARD_DOCS for s in packed)
    assert Counter((s["m"], i) for s in packed for i in s["ids"]) == Counter((r[0], r[1]) for r in rows)
    for s in packed:
        order = list(zip(s["terms"], [-x for x in s["tfs"]]))
        assert order == sorted(order)


def test_long_texts_are_counted_in_parts(monkeypatch):
    text = "one two, three " * 500 + "x" * 3000 + " end"
    whole = count_terms(text.encode())
    monkeypatch.setattr(lexical_search, "_SEGMENT", 64)
    assert count_terms(text.encode()) == whole == Counter(w.encode() for w in terms(text))


@pytest.mark.parametrize("docs, items", [([], ITEM_ROWS), ([(1, "cat")], []), ([(1, None)], ITEM_ROWS)])
def test_nothing_to_find(spark, docs, items):
    assert ranked(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect() == []


def test_other_columns_may_have_any_name(spark):
    docs = [(1, "cat dog"), (2, "dog")]
    d = spark.createDataFrame(docs, DOCS).selectExpr("*", "1 as n", "2 as terms", "3 as tfs", "4 as m", "5 as c", "6 as item_id")
    i = spark.createDataFrame([(1, "dog")], ITEMS).selectExpr("*", "7 as item", "8 as doc_id", "9 as score")
    assert Counter(map(tuple, ranked(d, i).collect())) == brute(docs, [(1, "dog")])
