from datetime import date

from daytally.functions.periods import Period, calendar, preceding, run_period, span, trailing


def test_run_period_counts_back_from_start():
    assert run_period("20240301", "3").days() == [date(2024, 2, 28), date(2024, 2, 29), date(2024, 3, 1)]
    assert run_period("20240301", "3.7") == run_period("20240301", 3)
    assert len(run_period("20240301", 0)) == 0
    assert len(run_period("20240301", "0.9")) == 0


def test_span_takes_both_directions():
    assert span("20240105", "20240103") == span("20240103", "20240105") == Period(date(2024, 1, 3), date(2024, 1, 5))


def test_look_back_windows():
    day = date(2024, 1, 30)
    assert trailing(day, 1) == Period(day, day)
    assert trailing("20240130", 7) == Period(date(2024, 1, 24), day)
    assert preceding(day, 30) == Period(date(2023, 12, 31), date(2024, 1, 29))
    assert preceding("20240101", 1) == Period(date(2023, 12, 31), date(2023, 12, 31))


def test_calendar_across_new_year(spark):
    rows = [tuple(r) for r in calendar(spark, run_period("20240101", 2)).orderBy("date").collect()]
    assert rows == [(date(2023, 12, 31), date(2023, 12, 30)), (date(2024, 1, 1), date(2023, 12, 31))]
    assert calendar(spark, run_period("20240101", 0)).count() == 0
