"""Cleaning rules and predicates on hand-made frames."""

from datetime import date

from pyspark.sql import functions as F

from daytally.functions import normalize, predicates
from daytally.operators.archive import local_archive
from daytally.functions.periods import Period
from daytally.schema import LOG_SCHEMA, Endpoints


def log(spark, *rows):
    """A log frame; columns not given are NULL, and `event_id` counts up."""
    names = LOG_SCHEMA.names
    full = [{"event_id": i, **row} for i, row in enumerate(rows)]
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in full], LOG_SCHEMA)


def column(df, expression):
    return [row[0] for row in df.select(expression).collect()]


def test_grade_cuts_decimals_and_rejects_text(spark):
    df = spark.createDataFrame([(g,) for g in (None, "3", "03", "3.5", "3.9999999", "-3.5", "n/a", " 7 ", "")], "g string")
    assert column(df, normalize.grade(F.col("g"))) == [-999, 3, 3, 3, 3, -3, None, 7, None]


def test_grade_too_large_for_bigint_is_null(spark):
    df = spark.createDataFrame([("9223372036854775807",), ("9223372036854775808",)], "g string")
    assert column(df, normalize.grade(F.col("g"))) == [9223372036854775807, None]


def test_code_and_language(spark):
    df = spark.createDataFrame([(None, None), ("200", "ko")], "code string, language string")
    assert column(df, normalize.code(F.col("code"))) == ["_null", "200"]
    assert column(df, normalize.language(F.col("language"), fill=True)) == ["_null", "ko"]
    assert column(df, normalize.language(F.col("language"), fill=False)) == [None, "ko"]


def test_device_rules_differ(spark):
    df = spark.createDataFrame(
        [("web.event", None), ("pageevent", "x"), (None, "ios.event"), (None, None), ("", "x"), ("event", None)],
        "device string, tag string",
    )
    regex = normalize.device_regex(F.col("device"), F.col("tag"))
    assert column(df, regex) == ["web", "pag", "ios", "_null", "", "event"]
    assert column(df, normalize.device_literal(F.col("device"))) == ["web", "pageevent", "null", "null", "", "event"]


def test_ensure_columns_keeps_what_is_there(spark):
    df = normalize.ensure_columns(spark.createDataFrame([("US", None)], "country string, grade string"))
    assert df.columns == ["country", "grade", "role", "device", "language"]
    assert tuple(df.first()) == ("US", None, "_null", "_null", "_null")
    assert dict(normalize.ensure_columns(spark.range(1)).dtypes)["grade"] == "bigint"


def test_missing_status_is_not_400(spark):
    df = spark.createDataFrame([(None,), ("400",), ("200",)], "code string")
    assert column(df, predicates.not_status("400")) == [True, False, True]


def test_user_activity_is_stricter_than_cohort_activity(spark):
    df = log(
        spark,
        {"api": "x", "id": "a"},
        {"api": "x", "id": ""},
        {"api": "x", "id": "a", "code": "400"},
        {"api": "x"},
        {"id": "a"},
        {"api": "page_move", "id": "a"},
        {"api": "_null", "id": "a"},
    )
    assert [r.event_id for r in df.where(predicates.user_activity()).collect()] == [0]
    assert [r.event_id for r in df.where(predicates.cohort_activity()).collect()] == [0, 1, 2]


def test_class_activity_keeps_missing_class(spark):
    writing = {"target_type": "class", "resource_type": "notice"}
    df = log(
        spark,
        writing,
        {**writing, "code": "400"},
        {**writing, "resource_type": "comment"},
        {**writing, "target_type": "user"},
        {**writing, "resource_type": None},
    )
    assert [r.event_id for r in df.where(predicates.class_activity()).collect()] == [0]


def test_deletion_needs_six_parts(spark):
    users, classes = "https://www.example.com/api/users", "https://www.example.com/api/classes"
    apis = [users, f"{users}/", f"{users}/1", f"{users}/1/", f"{users}/1//", f"{users}/1/x", f"{classes}_archived/9", None]
    df = log(spark, *[{"api": a, "method": "DELETE", "code": "200"} for a in apis])

    def hits(url):
        return [r.event_id for r in df.where(predicates.endpoint_deleted(url)).collect()]

    assert hits(Endpoints().users) == [2, 3, 4]
    assert hits(Endpoints().classes) == [6]
    failed = log(spark, {"api": f"{users}/1", "method": "DELETE", "code": "500"}, {"api": f"{users}/1", "method": "DELETE"})
    assert failed.where(predicates.endpoint_deleted(users)).count() == 0


def test_creation_needs_the_exact_url(spark):
    urls = Endpoints().signup_urls
    df = log(spark, *[{"api": a, "method": "POST", "code": "200"} for a in (*urls, urls[0] + "/")])
    assert [r.event_id for r in df.where(predicates.signup(Endpoints())).collect()] == [0, 1, 2]


def test_endpoints_follow_the_hosts():
    own = Endpoints("https://a.test", "https://b.test")
    assert own.signup_urls == ("https://a.test/api/users", "https://b.test/v1/oauth2/sign_up", "https://b.test/api/users")


def local_days(spark, first, last, late_days=0, *rows):
    df = log(spark, *[{"log_date": day, "ftime": ftime} for day, ftime in rows])
    found = local_archive(df, Period(first, last), late_days)
    return sorted((r.event_id, r.kr_date.day) for r in found.collect())


def test_local_day_boundaries(spark):
    day = date(2024, 1, 14)
    stamps = ["2024-01-14T15", "2024-01-14T15:00:00Z", "2024-01-14T14:59:59Z", None, "2024-01-14", "2024-01-14T15:"]
    rows = [(day, s) for s in stamps]
    everything = [(0, 14), (0, 15), (1, 15), (2, 14), (4, 14), (5, 15)]
    assert local_days(spark, date(2024, 1, 13), date(2024, 1, 16), 0, *rows) == everything
    assert local_days(spark, date(2024, 1, 15), date(2024, 1, 15), 0, *rows) == [(0, 15), (1, 15), (5, 15)]


def test_local_day_of_odd_stamps_follows_text_order(spark):
    """The same answer as one text comparison per target day."""
    stamps = ["2024-01-1", "2024-1-14T16", "2024-01-14 23:00", "2024-01-14U", "2024-01-32T01", "2024-02-30", "20", "x", ""]
    first, last = date(2024, 1, 8), date(2024, 2, 2)
    targets = Period(first, last)
    # Directories next to each target day, so that only the text decides.
    rows = [(d, s) for s in stamps for d in Period(first, last).widen(1).days()]

    def brute_force():
        for number, (directory, stamp) in enumerate(rows):
            for day in targets.days():
                start, end = f"{Period(day, day).widen(1).first}T15", f"{day}T15"
                if start <= stamp <= end and 0 <= (day - directory).days <= 1:
                    yield number, day.day

    assert local_days(spark, first, last, 0, *rows) == sorted(brute_force())


def test_late_lines_count_only_on_request(spark):
    rows = [(date(2024, 1, 14 + late), "2024-01-13T16:00:00Z") for late in range(4)]
    day = date(2024, 1, 14)
    assert local_days(spark, day, day, 0, *rows) == [(0, 14)]
    assert local_days(spark, day, day, 2, *rows) == [(0, 14), (1, 14), (2, 14)]


def test_local_date_ignores_session_zone(spark):
    df = log(spark, {"ftime": "2024-01-14T15:00:00Z"}, {"ftime": "2024-01-14T14:59:59Z"}, {"ftime": "x"}, {})
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert column(df, normalize.local_date(F.col("ftime"))) == [date(2024, 1, 15), date(2024, 1, 14), None, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
