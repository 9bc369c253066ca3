"""Date dimension and public holidays."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from demandkit.functions.dates import iso_weekday, season, with_easter
from demandkit.runtime import small_side

#: Default span: 365 * 30 + 8 days from the first of January 2000.
FIRST_DAY = dt.date(2000, 1, 1)
DEFAULT_DAYS = 365 * 30 + 8

ALL_STATES = ("BB", "BE", "BW", "BY", "HB", "HE", "HH", "MV", "NI", "NW", "RP", "SH", "SL", "SN", "ST", "TH")

# German public holidays as (name, states, rule, a, b, first year, last year).
# rule 'fixed': a = month, b = day. rule 'easter': a = days after Easter Sunday.
# rule 'wednesday_before': the Wednesday before day b of month a.
HOLIDAY_RULES = (
    ("Neujahr", ALL_STATES, "fixed", 1, 1, None, None),
    ("Heilige Drei Könige", ("BW", "BY", "ST"), "fixed", 1, 6, None, None),
    ("Internationaler Frauentag", ("BE",), "fixed", 3, 8, 2019, None),
    ("Internationaler Frauentag", ("MV",), "fixed", 3, 8, 2023, None),
    ("Karfreitag", ALL_STATES, "easter", -2, None, None, None),
    ("Ostersonntag", ("BB",), "easter", 0, None, None, None),
    ("Ostermontag", ALL_STATES, "easter", 1, None, None, None),
    ("Erster Mai", ALL_STATES, "fixed", 5, 1, None, None),
    ("Tag der Befreiung", ("BE",), "fixed", 5, 8, 2020, 2020),
    ("Christi Himmelfahrt", ALL_STATES, "easter", 39, None, None, None),
    ("Pfingstsonntag", ("BB",), "easter", 49, None, None, None),
    ("Pfingstmontag", ALL_STATES, "easter", 50, None, None, None),
    ("Fronleichnam", ("BW", "BY", "HE", "NW", "RP", "SL"), "easter", 60, None, None, None),
    ("Mariä Himmelfahrt", ("SL",), "fixed", 8, 15, None, None),
    ("Weltkindertag", ("TH",), "fixed", 9, 20, 2019, None),
    ("Tag der Deutschen Einheit", ALL_STATES, "fixed", 10, 3, 1990, None),
    ("Reformationstag", ("BB", "MV", "SN", "ST", "TH"), "fixed", 10, 31, None, None),
    ("Reformationstag", ("HB", "HH", "NI", "SH"), "fixed", 10, 31, 2017, None),
    ("Reformationstag", ("BE", "BW", "BY", "HE", "NW", "RP", "SL"), "fixed", 10, 31, 2017, 2017),
    ("Allerheiligen", ("BW", "BY", "NW", "RP", "SL"), "fixed", 11, 1, None, None),
    ("Buß- und Bettag", ("SN",), "wednesday_before", 11, 23, None, None),
    ("Buß- und Bettag", tuple(s for s in ALL_STATES if s != "SN"), "wednesday_before", 11, 23, 1990, 1994),
    ("Erster Weihnachtstag", ALL_STATES, "fixed", 12, 25, None, None),
    ("Zweiter Weihnachtstag", ALL_STATES, "fixed", 12, 26, None, None),
)


def days_between(spark: SparkSession, first: dt.date = FIRST_DAY, last: dt.date | None = None) -> DataFrame:
    last = last or first + dt.timedelta(days=DEFAULT_DAYS - 1)
    span = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return spark.range(1).select(F.explode(span).alias("date"))


def date_span(facts: DataFrame, date: str = "date") -> tuple[dt.date, dt.date]:
    """First and last date of a fact table. They are fetched, so that no later
    step reads the facts again."""
    return tuple(facts.agg(F.min(date), F.max(date)).first())


def days_of(facts: DataFrame, date: str = "date") -> DataFrame:
    """Every day from the first to the last date of a fact table."""
    return days_between(facts.sparkSession, *date_span(facts, date))


def calendar_columns(date: Column) -> list[Column]:
    month = F.month(date)
    return [
        F.year(date).alias("year"),
        month.alias("month"),
        F.dayofmonth(date).alias("day"),
        F.weekofyear(date).alias("week"),
        iso_weekday(date).alias("weekday"),
        season(month).alias("season"),
    ]


def _rule_table(states: Sequence[str]) -> Column:
    """The rules of the given states as one constant array."""
    return F.array(
        *[
            F.struct(
                F.lit(name).alias("holiday_name"),
                F.array(*[F.lit(s) for s in in_states if s in states]).alias("states"),
                F.lit(rule).alias("rule"),
                F.lit(a).alias("a"),
                F.lit(b or 0).alias("b"),
                F.lit(since or 0).alias("since"),
                F.lit(until or 9999).alias("until"),
            )
            for name, in_states, rule, a, b, since, until in HOLIDAY_RULES
            if set(in_states) & set(states)
        ]
    )


def holidays(days: DataFrame, states: Sequence[str], extra: DataFrame | None = None) -> DataFrame:
    """One row per (state, date) that is a holiday in the years of ``days``.

    Where two rules meet, the fixed date wins over the one that follows Easter.
    ``extra`` (state, date, holiday_name) adds days of the user's own, such as
    school breaks; it yields to the rules.
    """
    years = with_easter(days.select(F.year("date").alias("year")).distinct())
    rule, moving = F.col("rule"), F.col("rule") == "easter"
    day = F.make_date("year", F.when(moving, 1).otherwise(F.col("a")), F.when(moving, 1).otherwise(F.col("b")))
    dated = years.select("year", "easter", F.inline(_rule_table(states))).filter("year between since and until")
    found = dated.select(
        F.explode("states").alias("state"),
        F.when(moving, F.date_add("easter", F.col("a")))
        .when(rule == "fixed", day)
        .otherwise(F.date_sub(day, (F.weekday(day) + 4) % 7 + 1))
        .alias("date"),
        "holiday_name",
        moving.cast("int").alias("priority"),
    )
    if extra is not None:
        found = found.unionByName(
            extra.select("state", "date", "holiday_name", F.lit(2).alias("priority"))
        )
    first = F.min_by("holiday_name", F.struct("priority", "holiday_name"))
    return found.groupBy("state", "date").agg(first.alias("holiday_name"))


def date_dimension(days: DataFrame, states: Sequence[str], extra: DataFrame | None = None) -> DataFrame:
    """Calendar rows per (state, date)."""
    listed = F.array(*[F.lit(s) for s in states])
    by_state = days.select("date", F.explode(listed).alias("state"))
    named = by_state.join(holidays(days, states, extra), ["state", "date"], "left")
    weekday = iso_weekday(F.col("date"))
    is_holiday = F.col("holiday_name").isNotNull()
    return named.select(
        "state",
        "date",
        *calendar_columns(F.col("date")),
        is_holiday.alias("is_holiday"),
        "holiday_name",
        (weekday >= 6).alias("is_weekend"),
        (is_holiday | (weekday >= 6)).alias("is_free_day"),
        (is_holiday | (weekday == 7)).alias("is_shops_closed"),
    )


def calendar_of(facts: DataFrame, states: Sequence[str], extra: DataFrame | None = None) -> DataFrame:
    """Calendar over the days of a fact table, ready to be joined to it. The span
    and the states bound its rows, which decides on the broadcast."""
    first, last = date_span(facts)
    calendar = date_dimension(days_between(facts.sparkSession, first, last), states, extra)
    return small_side(calendar, rows=((last - first).days + 1) * len(states))


def with_store_context(facts: DataFrame, stores: DataFrame) -> DataFrame:
    """State, city and name of the store of each row."""
    return facts.join(small_side(stores), "store", "left")


def with_calendar(facts: DataFrame, stores: DataFrame, calendar: DataFrame) -> DataFrame:
    """Calendar columns of each row's day in the state of its store."""
    placed = facts.join(small_side(stores.select("store", "state")), "store", "left")
    return placed.join(calendar, ["state", "date"], "left")
