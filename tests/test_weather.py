import datetime as dt

import pytest

from demandkit.operators import weather

HISTORY = ["Date time", "Minimum Temperature", "Maximum Temperature", "Temperature", "Precipitation", "Dew Point", "Info",
           "Precipitation Cover", "Visibility", "Weather Type"]
FORECAST = ["Date time", "Temperature", "Precipitation", "Chance Precipitation (%)", "Snow"]


@pytest.fixture
def history(spark):
    data = [
        ("01/01/2024 00:00:00", 1.0, 5.0, 3.0, 0.5),
        ("01/01/2024 12:00:00", 2.0, 8.0, 5.0, 1.5),
        ("01/02/2024 00:00:00", 0.0, 4.0, 2.0, 0.0),
    ]
    return spark.createDataFrame([(*d, 0.0, "", 0.0, 0.0, "") for d in data], HISTORY)


@pytest.fixture
def forecast(spark):
    return spark.createDataFrame(
        [
            ("01/02/2024 00:00:00", 90.0, 9.0, 1.0, 0.0),
            ("01/02/2024 01:00:00", 10.0, 2.0, 0.5, 0.0),
            ("01/02/2024 02:00:00", 12.0, 2.0, 0.49, 0.0),
            ("01/03/2024 00:00:00", 7.0, 2.0, 0.9, 0.0),
        ],
        FORECAST,
    )


def test_rain_needs_the_threshold_chance(forecast, rows):
    found = rows(weather.prepare_forecast(forecast), "date_time", "precipitation", "minimum_temperature")
    assert [r[1] for r in found] == [9.0, 2.0, 0.0, 2.0]
    assert [r[2] for r in found] == [90.0, 10.0, 12.0, 7.0]


def test_history_wins_and_the_last_day_goes(history, forecast, rows):
    found = rows(weather.weather_by_day(history, forecast), "date", "minimum_temperature", "maximum_temperature",
                 "temperature", "precipitation")
    assert found == [
        (dt.date(2024, 1, 1), 1.0, 8.0, 4.0, 1.0),
        (dt.date(2024, 1, 2), 0.0, 12.0, 8.0, 2.0 / 3),
    ]


def test_columns_must_match(history, forecast):
    with pytest.raises(ValueError, match="columns differ"):
        weather.history_wins(weather.prepare_history(history), weather.prepare_forecast(forecast).drop("temperature"))


def test_unreadable_timestamps_become_null(spark):
    df = spark.createDataFrame([("13/45/2024 00:00:00",), ("01/31/2024 23:59:59",)], "date_time string")
    assert [r["date"] for r in weather.with_day(df).collect()] == [None, dt.date(2024, 1, 31)]


def test_drop_last_day(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, n),) for n in (1, 2, 5, 5)], "date date")
    assert weather.drop_last_day(df).count() == 2


def test_unreadable_timestamps_stop_the_job(spark):
    columns = "date_time string, temperature double, precipitation double"
    both = ", minimum_temperature double, maximum_temperature double"
    past = spark.createDataFrame([(at, 1.0, 0.0, 0.0, 2.0) for at in ("01/01/2024 00:00:00", "soon", "01/02/2024 00:00:00")], columns + both)
    assert [r["date_time"] for r in weather.unreadable_timestamps(past).collect()] == ["soon"]
    ahead = spark.createDataFrame([], columns + ", chance_precipitation double, snow double")
    with pytest.raises(ValueError, match="1 weather rows"):
        weather.weather_by_day(past, ahead)
    assert weather.weather_by_day(past, ahead, unreadable=1).count() == 1
