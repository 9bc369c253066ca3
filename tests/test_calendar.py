import datetime as dt

import pytest
from pyspark.sql import functions as F

from demandkit.functions.dates import with_easter
from demandkit.operators import calendar as cal


def dim(spark, first, last, states=("HE",), extra=None):
    return cal.date_dimension(cal.days_between(spark, first, last), states, extra)


def test_default_span(spark):
    days = cal.days_between(spark)
    found = days.agg(F.count("*"), F.min("date"), F.max("date")).first()
    assert tuple(found) == (10958, dt.date(2000, 1, 1), dt.date(2029, 12, 31))
    assert cal.date_dimension(days, ["HE"]).count() == 10958


def test_easter(spark):
    known = {
        2000: (4, 23), 2008: (3, 23), 2011: (4, 24), 2016: (3, 27), 2019: (4, 21),
        2021: (4, 4), 2024: (3, 31), 2025: (4, 20), 2038: (4, 25),
    }
    years = spark.createDataFrame([(y,) for y in known], "year int")
    found = {r["year"]: (r["easter"].month, r["easter"].day) for r in with_easter(years).collect()}
    assert found == known


def test_double_holiday_has_the_fixed_name(spark):
    row = dim(spark, dt.date(2008, 5, 1), dt.date(2008, 5, 1)).first()
    assert row["holiday_name"] == "Erster Mai" and row["is_holiday"]


def test_iso_week_and_weekday(spark):
    row = dim(spark, dt.date(2021, 1, 1), dt.date(2021, 1, 1)).first()
    assert (row["week"], row["weekday"], row["season"]) == (53, 5, "winter")
    assert row["is_shops_closed"] and row["is_free_day"] and not row["is_weekend"]


@pytest.mark.parametrize(
    "state, date, name",
    [
        ("SN", dt.date(2022, 11, 16), "Buß- und Bettag"),
        ("SN", dt.date(2023, 11, 22), "Buß- und Bettag"),
        ("HE", dt.date(2017, 10, 31), "Reformationstag"),
        ("HE", dt.date(2018, 10, 31), None),
        ("HH", dt.date(2018, 10, 31), "Reformationstag"),
        ("HE", dt.date(2024, 5, 30), "Fronleichnam"),
        ("HE", dt.date(2024, 11, 1), None),
        ("RP", dt.date(2024, 11, 1), "Allerheiligen"),
        ("HE", dt.date(2024, 3, 29), "Karfreitag"),
        ("BE", dt.date(2018, 3, 8), None),
    ],
)
def test_state_rules(spark, state, date, name):
    assert dim(spark, date, date, [state]).first()["holiday_name"] == name


def test_sunday_closes_shops_saturday_does_not(spark, rows):
    found = rows(dim(spark, dt.date(2024, 6, 1), dt.date(2024, 6, 2)), "weekday", "is_weekend", "is_shops_closed")
    assert found == [(6, True, False), (7, True, True)]


def test_extra_days_yield_to_rules(spark, rows):
    extra = spark.createDataFrame(
        [("HE", dt.date(2024, 1, 1), "Ferien"), ("HE", dt.date(2024, 1, 2), "Ferien")],
        "state string, date date, holiday_name string",
    )
    found = rows(dim(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 3), extra=extra), "day", "holiday_name")
    assert found == [(1, "Neujahr"), (2, "Ferien"), (3, None)]


def test_calendar_of_a_store_uses_its_state(spark, rows):
    day = dt.date(2024, 11, 1)
    stores = spark.createDataFrame([(1, "HE"), (2, "RP")], "store int, state string")
    facts = spark.createDataFrame([(1, day), (2, day), (3, day)], "store int, date date")
    joined = cal.with_calendar(facts, stores, dim(spark, day, day, ["HE", "RP"]))
    assert rows(joined, "store", "is_holiday") == [(1, False), (2, True), (3, None)]
