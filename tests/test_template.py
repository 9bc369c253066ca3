import datetime as dt

import pytest

from demandkit.operators.template import (
    IncompleteGridError,
    assert_full_grid,
    future_template,
    missing_pairs,
    recent_profile,
    with_template,
)

SCHEMA = "store int, product string, date date, sales double, price double, clerk string"


def day(n):
    return dt.date(2024, 1, n)


@pytest.fixture
def history(spark):
    return spark.createDataFrame(
        [
            (1, "x", day(1), 1.0, 100.0, "z"),
            (1, "x", day(3), 1.0, 1.0, "b"),
            (1, "x", day(7), 1.0, 2.0, "a"),
            (1, "x", day(20), 4.0, 6.0, None),
            (1, "y", day(2), 5.0, None, None),
            (2, "x", day(5), 2.0, 2.0, "c"),
            (2, "x", day(6), 3.0, 4.0, "d"),
        ],
        SCHEMA,
    )


def test_profile_uses_the_last_rows_not_days(history, rows):
    assert rows(recent_profile(history, measures_too=("sales",))) == [
        (1, "x", day(20), 2.0, 3.0, "a"),
        (1, "y", day(2), 5.0, None, None),
        (2, "x", day(6), 2.5, 3.0, "c"),
    ]


def test_template_is_pairs_by_seven_days_after_the_last_date(history, rows):
    template = future_template(recent_profile(history))
    assert template.count() == 3 * 7
    assert rows(template.select("date").distinct()) == [(day(20 + n),) for n in range(1, 8)]
    assert template.filter("sales is not null").isEmpty()
    assert rows(template.filter("store = 2").select("price", "clerk").distinct()) == [(3.0, "c")]


def test_assortment_gives_listings_without_history_null_attributes(spark, history, rows):
    listed = spark.createDataFrame([(2, "y"), (2, "x"), (2, "x")], "store int, product string")
    template = future_template(recent_profile(history), listed)
    assert template.count() == 14
    assert rows(template.filter("product = 'y'").select("price", "clerk").distinct()) == [(None, None)]


def test_grid_check(spark, history):
    assert missing_pairs(recent_profile(history)).first()["missing_pairs"] == 1
    with pytest.raises(IncompleteGridError):
        assert_full_grid(recent_profile(history))
    assert_full_grid(recent_profile(history.filter("product = 'x'")))


def test_null_sales_mark_only_the_template(history):
    curated = with_template(history, future_template(recent_profile(history)))
    assert curated.filter("sales is null").count() == 21
    assert curated.filter("sales is not null").count() == history.count()
    assert curated.groupBy("store", "product", "date").count().filter("count > 1").isEmpty()
