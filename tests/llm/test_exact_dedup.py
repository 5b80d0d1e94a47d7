import hashlib
import string
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from daytally.llm.exact_dedup import exact_groups, without_copies

SCHEMA = "doc_id long, text string"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").translate(LOWER)].append(doc_id)
    out = []
    for doc_id, text in rows:
        low = (text or "").translate(LOWER)
        keep = max((i for i in groups[low] if i is not None), default=None)
        out.append((doc_id, keep, len(groups[low]), doc_id == keep, hashlib.sha256(low.encode()).hexdigest()))
    return sorted(out, key=repr)


def ours(df, **how):
    return sorted(map(tuple, exact_groups(df, **how).collect()), key=repr)


LONG = "long text " * 30_000
ROWS = [
    (1, "Same"), (2, "sAME"), (3, "same "), (4, None), (5, ""), (6, LONG), (7, LONG + "x"), (8, LONG.upper()), (9, LONG[:64]),
    (10, LONG[:64]), (11, LONG[:63]), (None, "same"), (None, "alone"), (None, "alone"), (12, "É"), (13, "é"), (14, "twice"),
    (14, "twice"), (15, "one id"), (15, "two texts"), (16, "one id"), (17, "a\0"), (18, "a"), (19, "x" * 4096), (20, "x" * 4095 + "y"),
]


def test_agrees_with_brute_force(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    assert ours(df) == brute(ROWS)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 9) | st.none(), st.text("aAbé", max_size=6) | st.none()), max_size=25))
def test_small_blocks_agree_with_brute_force(spark, rows):
    assert ours(spark.createDataFrame(rows, SCHEMA), first_block=1, growth=2) == brute(rows)


def test_one_text_for_all_rows(spark):
    df = spark.range(3000).selectExpr("id as doc_id", "repeat('hot ', 100) as text")
    assert {(r.keep_id, r.group_size) for r in exact_groups(df).collect()} == {(2999, 3000)}


def test_empty_table(spark):
    assert ours(spark.createDataFrame([], SCHEMA)) == []


@pytest.mark.parametrize("first", ["tail", "group_id"])
def test_other_columns_may_have_any_name(spark, first):
    names = [first, "digest", "block", "kept", "keep_id", "name", "closed", "text_sha256", "times"]
    df = spark.createDataFrame([(1, "a", *["x"] * 9), (2, "A", *["y"] * 9), (3, None, *[None] * 9)], ["doc_id", "text", *names])
    assert [r[0] for r in ours(df)] == [1, 2, 3]
    kept = without_copies(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r[first]) for r in kept.collect()) == [(2, "y"), (3, None)]


def test_copies_go_and_repeated_rows_stay_once(spark):
    kept = without_copies(spark.createDataFrame(ROWS, SCHEMA)).collect()
    texts = [(r.text or "").translate(LOWER) for r in kept]
    assert len(texts) == len(set(texts)) == len({(t or "").translate(LOWER) for _, t in ROWS})
    # Of a text that some row has an id for, the largest id stays.
    assert {r.doc_id for r in kept if r.text and r.text.lower() == "same"} == {2}
