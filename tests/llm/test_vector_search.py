import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from daytally.llm import vector_search
from daytally.llm.vector_search import top_vectors

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, every, top, scale):
    held = [
        (i, [math.floor(scale * c) for c in v])
        for i, v in rows
        if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]
    out = Counter()
    for at, (i, q) in enumerate(held):
        if i % every == 0:
            scored = [(-sum(a * b for a, b in zip(q, v)), j) for k, (j, v) in enumerate(held) if k != at]
            out.update((i, rank, j, -s) for rank, (s, j) in enumerate(sorted(scored)[:top], 1))
    return out


def ours(df, **how):
    return Counter(map(tuple, top_vectors(df, **how).collect()))


def check(spark, rows, every=3, top=4, scale=1024, parts=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    assert ours(df, every=every, top=top, scale=scale) == brute(rows, every, top, scale)


def test_odd_rows(spark):
    v = [0.5, -0.25, 1e-5]
    rows = [
        (0, v), (3, v), (3, v), (6, [0.1, 0.2, 0.3]), (6, [-0.1, 0.2, 0.3]), (1, None), (9, [None, 1.0, 1.0]), (2, [math.nan, 1.0, 1.0]),
        (4, [math.inf, 0.0, 0.0]), (None, v), (12, []), (5, [0.0, 0.0, 0.0]), (7, [1.0]), (15, [2.0, 1.0, 1.0, 9.0]), (8, [-1.0, -1.0, -1.0]),
    ]
    check(spark, rows)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 12) | st.none(), st.lists(st.integers(-3, 3).map(lambda x: x / 2), min_size=3, max_size=3)), max_size=30))
def test_ties_agree_with_brute_force(spark, rows):
    check(spark, rows, scale=2)


def test_many_shards_blocks_and_equal_vectors(spark, monkeypatch):
    monkeypatch.setattr(vector_search, "BLOCK_QUERIES", 20)
    monkeypatch.setattr(vector_search, "SHARD_BYTES", 4096)
    monkeypatch.setattr(vector_search, "SAMPLE_VECTORS", 40)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=12).tolist()) for i in range(1500)]
    rows += [(i, [0.1] * 12) for i in range(1500, 2300)]  # a third of all rows
    check(spark, rows, every=50, top=10, parts=5)


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.integers(-(2**28), 2**28, 6) * 1.0).tolist()) for i in range(200)]
    check(spark, rows, every=20, top=10, scale=1)


def test_hopeless_shards_and_components_are_passed_over():
    rng = np.random.default_rng(5)
    lists = np.ascontiguousarray((rng.normal(size=(8, 300)) * [[100]] * 4 + [[0]] * 8).astype(np.int64))
    lists[4:] //= 100
    shard = vector_search._Lists(np.arange(300).tobytes(), np.arange(300).tobytes(), lists.tobytes(), 300, 8)
    query = np.array([50, -50, 20, 3, 1, 1, 1, 1])
    scores = query @ lists
    at, found = shard.best(query, -1, -np.inf, 10)
    assert found.tolist() == sorted(scores, reverse=True)[:10] and (scores[at] == found).all()
    least = float(found[-1])
    again, same = shard.best(query, -1, least, 10)
    assert (again == at).all() and (same == found).all()
    assert len(shard.best(query, -1, 1e12, 10)[0]) == 0


@pytest.mark.parametrize("rows", [[], [(1, [1.0])], [(0, None)]])
def test_nothing_to_find(spark, rows):
    assert top_vectors(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_other_columns_may_have_any_name(spark):
    rows = [(i, [float(i), 1.0]) for i in range(8)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as place", "2 as score", "3 as query", "'a' as x", "5 as least", "6 as block")
    assert ours(df, every=4, top=3) == brute(rows, 4, 3, 1024)
