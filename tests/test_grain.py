import datetime as dt
import random
from collections import Counter, defaultdict

import pytest

from demandkit.operators.grain import aggregate_map, to_grain

DAY = dt.date(2024, 1, 1)
SCHEMA = "index long, store int, product string, date date, sales double, price double, promo boolean, clerk string"


def lines(spark, *data):
    return spark.createDataFrame([(i, *row) for i, row in enumerate(data)], SCHEMA)


def test_functions_are_chosen_by_type(spark):
    assert aggregate_map(lines(spark)) == {
        "sales": "sum", "price": "mean", "promo": "mean", "clerk": "most_frequent",
    }


def test_null_keys_are_dropped_and_empty_sums_are_zero(spark, rows):
    df = lines(
        spark,
        (1, None, DAY, 5.0, 1.0, True, "a"),
        (None, "x", DAY, 5.0, 1.0, True, "a"),
        (1, "x", DAY, None, None, None, None),
    )
    assert rows(to_grain(df)) == [(1, "x", DAY, 0.0, None, None, None)]


def test_booleans_are_averaged(spark, rows):
    df = lines(spark, (1, "x", DAY, 1.0, 2.0, True, "a"), (1, "x", DAY, 2.0, 4.0, False, "a"))
    assert rows(to_grain(df)) == [(1, "x", DAY, 3.0, 3.0, 0.5, "a")]


@pytest.mark.parametrize(
    "clerks, expected",
    [
        (["b", "a", "b"], "b"),
        (["b", "a"], "a"),
        ([None, None, "a"], None),
        ([None, "a"], "a"),
        ([None], None),
        (["", None, None, ""], ""),
    ],
)
def test_most_frequent_counts_nulls_which_lose_ties(spark, clerks, expected):
    df = lines(spark, *[(1, "x", DAY, 1.0, 1.0, True, c) for c in clerks])
    assert to_grain(df).first()["clerk"] == expected


def test_types_of_voted_columns_stay(spark):
    df = spark.createDataFrame(
        [(1, "x", DAY, 1.0, DAY)], "store int, product string, date date, sales double, expires date"
    )
    assert dict(to_grain(df).dtypes)["expires"] == "date"


def test_without_voted_columns(spark, rows):
    df = lines(spark, (1, "x", DAY, None, 2.0, True, "a"), (1, "x", DAY, 2.0, None, False, "a")).drop("clerk")
    assert rows(to_grain(df)) == [(1, "x", DAY, 2.0, 2.0, 0.5)]


def test_overrides(spark):
    df = lines(spark, (1, "x", DAY, 1.0, 2.0, True, "a"), (1, "x", DAY, 1.0, 3.0, True, "a"))
    assert to_grain(df, overrides={"price": "sum"}).first()["price"] == 5.0


def test_against_brute_force_with_a_hot_key(spark):
    random.seed(1)
    data = []
    for _ in range(3000):
        hot = random.random() < 0.4
        data.append(
            (
                1 if hot else random.randint(1, 4),
                "hot" if hot else random.choice("pqr"),
                DAY if hot else DAY + dt.timedelta(days=random.randint(0, 5)),
                float(random.randint(0, 9)),
                float(random.randint(1, 99)),
                random.random() < 0.5,
                random.choice(["a", "b", "c", None]),
            )
        )
    groups = defaultdict(list)
    for row in data:
        groups[row[:3]].append(row[3:])
    expected = {}
    for key, members in groups.items():
        votes = Counter(m[3] for m in members)
        best = max(votes.values())
        tied = sorted((v for v, n in votes.items() if n == best), key=lambda v: (v is None, v or ""))
        expected[key] = (
            sum(m[0] for m in members),
            round(sum(m[1] for m in members) / len(members), 9),
            round(sum(m[2] for m in members) / len(members), 9),
            tied[0],
        )
    found = {tuple(r)[:3]: (r[3], round(r[4], 9), round(r[5], 9), r[6]) for r in to_grain(lines(spark, *data)).collect()}
    assert found == expected
