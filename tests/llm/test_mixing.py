import pytest

from daytally.llm.mixing import mix, mixed, source_targets

SCHEMA = "doc_id long, text string, source string"


def by_hand(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """The rule as it is told: share, hold what is above, share the rest again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, target = share * sum(sizes.values()), set(names), {}
    while free:
        part = left / sum(weight[s] for s in free)
        above = {s for s in free if part * weight[s] > most * sizes[s]}
        if not above:
            target |= {s: part * weight[s] for s in free}
            break
        target |= {s: most * sizes[s] for s in above}
        left -= sum(most * sizes[s] for s in above)
        free -= above
    return target


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100},
        {"a": 1, "b": 1000, "c": 50, "d": 7, None: 30},
        {"Z": 10, "a": 10, "é": 5, "zz": 0},
        {f"s{i:03}": i * i % 97 for i in range(200)},
    ],
)
def test_targets_agree_with_the_rule(spark, sizes):
    rows = [(s, n) for s, size in sizes.items() for n in (size - size // 3, size // 3)]
    got = source_targets(spark.createDataFrame(rows, "source string, size long"))
    got = {r.source: r.target for r in got.collect()}
    assert got == pytest.approx(by_hand(sizes))


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(1, "a b\tc", "s"), (1, "a b\tc", "s"), (None, "d e", "s"), (2, None, "s"), (3, "", None), (4, "\x1c é", None)]
    got = mixed(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r.size for r in got) == [0, 0, 2, 2, 3, 3]
    assert len({r.taken for r in got if r.doc_id == 1}) == 1
    assert all(r.taken <= 2 * r.size for r in got)


def test_empty_tables_and_texts(spark):
    assert mixed(spark.createDataFrame([], SCHEMA)).collect() == []
    assert [r.taken for r in mixed(spark.createDataFrame([(1, None, "s")], SCHEMA)).collect()] == [0]


def test_mix_holds_every_document_as_often_as_it_is_taken(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    judged = {r.doc_id: r for r in mixed(docs).collect()}
    copies = mix(docs).groupBy("doc_id").count().collect()
    assert {r.doc_id: r["count"] for r in copies} == {i: r.taken // r.size for i, r in judged.items() if r.taken}
    taken, target = sum(r.taken for r in judged.values()), 1.5 * sum(r.size for r in judged.values())
    assert taken == pytest.approx(target, rel=0.05)
    assert judged == {r.doc_id: r for r in mixed(docs.repartition(5)).collect()}


def test_other_columns_may_have_any_name(spark):
    df = spark.createDataFrame([(1, "a b", "s", 5, 6, 7)], SCHEMA + ", size long, target long, copy long")
    assert mixed(df).columns == ["doc_id", "size", "source_size", "target", "taken"]
    assert mix(df).columns == ["doc_id", "text", "source", "size", "target", "copy"]


def test_no_python_in_the_plan(spark, medium):
    plan = mix(spark.read.parquet(f"{medium}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
