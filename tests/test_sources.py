"""Reading day directories and writing partitioned tables."""

import gzip
import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from daytally.functions.periods import Period
from daytally.schema import LOG_SCHEMA
from daytally.sources.catalogue import catalogue, columns_of
from daytally.sources.logs import (
    MissingDays,
    absent_columns,
    column_names,
    line_quality,
    present_days,
    read_logs,
)
from daytally.sources.tables import read_table, write_partitioned

FIRST, SECOND, THIRD = date(2018, 10, 8), date(2018, 10, 9), date(2018, 10, 10)
ALL = Period(FIRST, THIRD)


def write_lines(root, day, name, lines):
    folder = root / f"logs_{day:%Y%m%d}"
    folder.mkdir(exist_ok=True)
    with gzip.open(folder / f"{day:%Y%m%d}-{name}.gz", "wt") as out:
        out.writelines((line if isinstance(line, str) else json.dumps(line)) + "\n" for line in lines)


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    write_lines(
        root,
        FIRST,
        "09_0_api_a",
        [
            {"ftime": "2018-10-08T09:00:00Z", "api": "a", "code": 200, "grade": 3, "extra": {"k": 1}},
            {"ftime": "2018-10-08T09:30:00Z", "api": "b", "code": "404"},
            '{"ftime": "2018-10-08T09:45:00Z", "api": ',
        ],
    )
    write_lines(root, FIRST, "10_0_api_a", [{"ftime": "2018-10-08T10:00:00Z", "api": "c", "grade": "n/a", "level": 7}])
    write_lines(root, THIRD, "10_0_api_a", [{"ftime": "2018-10-10T10:00:00Z", "api": "d", "grade": 3.5}])
    return str(root)


def test_numbers_and_text_are_read_as_text_and_malformed_lines_dropped(spark, root):
    df = read_logs(spark, root, ALL, allow_missing=True)
    assert sorted(df.columns) == sorted(LOG_SCHEMA.names)
    rows = [(r.api, r.code, r.grade, r.log_date) for r in df.orderBy("api").collect()]
    assert rows == [
        ("a", "200", "3", FIRST),
        ("b", "404", None, FIRST),
        ("c", None, "n/a", FIRST),
        ("d", None, "3.5", THIRD),
    ]


def test_pruned_reads_drop_the_same_lines(spark, root):
    df = read_logs(spark, root, ALL, allow_missing=True)
    assert [r.n for r in df.groupBy("log_date").agg(F.count("api").alias("n")).orderBy("log_date").collect()] == [3, 1]
    assert df.select("role").count() == 4


def test_only_days_of_the_period_are_read(spark, root):
    df = read_logs(spark, root, Period(SECOND, THIRD), allow_missing=True)
    assert [r.api for r in df.collect()] == ["d"]
    assert not any("logs_20181008" in f for f in df.inputFiles())


def test_missing_days_are_an_error_or_empty(spark, root):
    none = read_logs(spark, root, Period(SECOND, SECOND), allow_missing=True)
    assert none.count() == 0
    assert none.schema.names == read_logs(spark, root, ALL, allow_missing=True).schema.names
    assert present_days(spark, root, ALL) == {FIRST, THIRD}
    assert present_days(spark, root, Period(SECOND, SECOND)) == set()
    with pytest.raises(MissingDays, match="2018-10-09"):
        read_logs(spark, root, ALL)
    with pytest.raises(MissingDays):
        read_logs(spark, root + "/nowhere", Period(THIRD, THIRD))
    read_logs(spark, root, Period(THIRD, THIRD))


def test_hour_files(spark, root):
    df = read_logs(spark, root, ALL, file_glob="*-10_*.gz", allow_missing=True)
    assert sorted(r.api for r in df.collect()) == ["c", "d"]
    with pytest.raises(ValueError):
        read_logs(spark, root, ALL, fmt="parquet", file_glob="*")


def test_line_numbers_are_stable(spark, root):
    def numbers():
        return {(r.api, r.event_id) for r in read_logs(spark, root, ALL, allow_missing=True).collect()}

    assert numbers() == numbers()
    assert len(numbers()) == 4


def test_names_of_all_lines(spark, root, tmp_path):
    names = column_names(spark, root, ALL)
    assert names == ["api", "code", "extra", "ftime", "grade", "level"]
    rows = {r.api: r for r in read_logs(spark, root, ALL, extra=names, allow_missing=True).collect()}
    assert rows["a"].extra == '{"k": 1}' and rows["c"].level == "7" and rows["a"].code == "200"
    write_lines(tmp_path, FIRST, "09_0", [{"ftime": "a", "level": 7, "event_id": "x"}, {"level": "high"}, '{"only": '])
    period = Period(FIRST, FIRST)
    names = column_names(spark, str(tmp_path), period)
    assert names == ["ftime", "level", "raw_event_id"]
    rows = read_logs(spark, str(tmp_path), period, extra=names).collect()
    assert sorted((r.ftime or "", r.level, r.raw_event_id or "") for r in rows) == [("", "high", ""), ("a", "7", "x")]


def test_absent_columns(spark, root):
    assert absent_columns(spark, root, ALL, ["grade", "role", "code"]) == {"role"}
    assert absent_columns(spark, root, Period(THIRD, THIRD), ["grade", "code"]) == {"code"}
    assert absent_columns(spark, root, Period(SECOND, SECOND), ["grade"]) == set()


def test_line_quality(spark, root):
    rows = [tuple(r) for r in line_quality(spark, root, ALL).orderBy("log_date").collect()]
    assert rows == [(FIRST, 4, 1, 1), (THIRD, 1, 0, 0)]


def frame(spark, *rows):
    return spark.createDataFrame([(n, day) for n, day in rows], "n int, day date")


def contents(spark, path):
    return sorted((r.n, r.day) for r in read_table(spark, path, frame(spark).schema).collect())


def test_rerun_replaces_only_its_own_partitions(spark, tmp_path):
    path = str(tmp_path / "out")
    day = F.col("day")

    def write(rows, period):
        write_partitioned(frame(spark, *rows), path, ["day"], period.contains(day))

    write([(1, FIRST), (2, SECOND), (3, THIRD)], ALL)
    untouched = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "out" / f"day={FIRST}").iterdir()}
    for _ in range(2):
        write([(4, SECOND), (5, SECOND), (6, THIRD)], Period(SECOND, THIRD))
        assert contents(spark, path) == [(1, FIRST), (4, SECOND), (5, SECOND), (6, THIRD)]
    assert untouched == {f.name: f.stat().st_mtime_ns for f in (tmp_path / "out" / f"day={FIRST}").iterdir()}

    # The third day has no rows any more: its old ones must go.
    write([(7, SECOND)], Period(SECOND, THIRD))
    assert contents(spark, path) == [(1, FIRST), (7, SECOND)]
    write([], ALL)
    assert contents(spark, path) == []
    write([(8, THIRD)], ALL)
    assert contents(spark, path) == [(8, THIRD)]


def test_codec_and_file_size(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = [(n, FIRST) for n in range(100)]
    write_partitioned(frame(spark, *rows), path, ["day"], F.lit(True), compression="gzip", max_records_per_file=30)
    files = list((tmp_path / "out").rglob("*.parquet"))
    assert len(files) == 4 and all(f.name.endswith(".gz.parquet") for f in files)
    assert len(contents(spark, path)) == 100


def test_table_that_does_not_exist_is_empty(spark, tmp_path):
    assert contents(spark, str(tmp_path / "nowhere")) == []


def day_facts(facts):
    return {(r.log_date, r.name): tuple(r)[2:] for r in facts.collect()}


def test_catalogue_tells_names_and_counts_in_one_pass(spark, root):
    got = day_facts(catalogue(spark, root, ALL))
    assert {k: v[0] for k, v in got.items() if k[1]} == {
        (FIRST, "ftime"): 3, (FIRST, "api"): 3, (FIRST, "code"): 2, (FIRST, "grade"): 2, (FIRST, "extra"): 1,
        (FIRST, "level"): 1, (THIRD, "ftime"): 1, (THIRD, "api"): 1, (THIRD, "grade"): 1,
    }
    assert got[FIRST, None] == (4, 1, 1, 6) and got[THIRD, None] == (1, 0, 0, 3)
    assert day_facts(catalogue(spark, root, ALL, "*-10_*.gz"))[FIRST, None] == (1, 0, 1, 4)
    assert catalogue(spark, root, Period(SECOND, SECOND)).collect() == []
    assert columns_of(catalogue(spark, root, Period(SECOND, SECOND))) == ([], False)


def test_catalogue_of_odd_lines(spark, tmp_path):
    write_lines(tmp_path, FIRST, "09_0", ["", "  ", "7", '"x"', "{}", '{"a": 1, "a": 2}', '{"b": null}', '{"c": 1} trailing {'])
    write_lines(tmp_path, SECOND, "09_0", [])
    got = day_facts(catalogue(spark, str(tmp_path), Period(FIRST, SECOND)))
    assert got[FIRST, "a"][0] == got[FIRST, "b"][0] == 1
    lines, malformed, bad, names = got[FIRST, None]
    kept = read_logs(spark, str(tmp_path), Period(FIRST, SECOND)).count()
    assert lines == 6 and lines - malformed == kept and bad == 0
    assert not any(day == SECOND for day, _ in got)


def test_more_names_than_columns_go_into_a_map(spark, tmp_path):
    """Ids as keys flood neither the catalogue nor the schema, and no value is lost."""
    lines = [{"ftime": f"t{i}", "code": 200, "often": i, f"id{i}": {"k": i}, "more_columns": "own"} for i in range(60)]
    write_lines(tmp_path, FIRST, "09_0", [*lines, '{"broken": '])
    write_lines(tmp_path, SECOND, "09_0", [{"ftime": "s", "Often": "x", "often": "y"}])
    period = Period(FIRST, SECOND)
    facts = catalogue(spark, str(tmp_path), period, max_names=5).cache()
    assert facts.count() == 6 + 4
    assert day_facts(facts)[FIRST, None] == (61, 1, 0, 64)
    names, more = columns_of(facts, max_names=5)
    # `Often` is among the five names, but the same column as `often`.
    assert more and names == ["code", "ftime", "often", "raw_more_columns"]
    rows = {r.ftime: r for r in read_logs(spark, str(tmp_path), period, extra=names, rest=True).collect()}
    assert len(rows) == 61
    assert rows["t0"].raw_more_columns == "own"
    assert all(rows[f"t{i}"].more_columns == {f"id{i}": f'{{"k":{i}}}'} for i in range(60))
    assert rows["s"].often == "y" and rows["s"].more_columns == {"Often": "x"}
    assert len({r.event_id for r in rows.values()}) == 61
    all_names, more = columns_of(catalogue(spark, str(tmp_path), period))
    assert more and len(all_names) == 64 and "often" in all_names
