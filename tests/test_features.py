import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from demandkit.functions.geo import haversine
from demandkit.functions.text import num_characters, num_words
from demandkit.operators import checks, features as feat, lags, splits


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n - 1)


SCHEMA = "date date, amount double, flag boolean, kind string, note string"


@pytest.fixture
def entity(spark):
    return spark.createDataFrame(
        [
            (day(1), 1.0, True, "a", None),
            (day(1), 2.0, None, "b", None),
            (day(1), 6.0, False, "b", None),
            (day(2), 5.0, True, None, None),
            (day(2), 5.0, True, "z", None),
            (day(2), 5.0, True, "y", None),
            (day(3), 4.0, None, None, None),
            (None, 9.0, True, "q", "q"),
        ],
        SCHEMA,
    )


def test_definitions_follow_the_schema(entity):
    names = [d.name for d in feat.define_day_features(entity, "e", exclude=["note"])]
    assert names == [
        "days__count__e",
        *[f"days__{p}__e__amount" for p in ("sum", "std", "max", "skew", "min", "mean")],
        "days__percent_true__e__flag",
        "days__num_unique__e__kind",
        "days__mode__e__kind",
    ]


def test_day_aggregates(entity):
    where = {"large": F.col("amount") >= 5}
    definitions = feat.define_day_features(entity, "e", where=where)
    found = {r["date"]: r.asDict() for r in feat.day_aggregates(entity, definitions, where).collect()}
    assert set(found) == {day(1), day(2), day(3)}
    first, second, third = found[day(1)], found[day(2)], found[day(3)]
    values = [1.0, 2.0, 6.0]
    mean, n = statistics.mean(values), 3
    m2 = sum((v - mean) ** 2 for v in values) / n
    m3 = sum((v - mean) ** 3 for v in values) / n
    assert math.isclose(first["days__skew__e__amount"], m3 / m2**1.5 * math.sqrt(n * (n - 1)) / (n - 2))
    assert math.isclose(first["days__std__e__amount"], statistics.stdev(values))
    assert first["days__percent_true__e__flag"] == pytest.approx(1 / 3)
    assert (first["days__num_unique__e__kind"], first["days__mode__e__kind"]) == (2, "b")
    assert (second["days__num_unique__e__kind"], second["days__mode__e__kind"]) == (2, "y")
    assert (second["days__skew__e__amount"], second["days__std__e__amount"]) == (0.0, 0.0)
    assert third["days__skew__e__amount"] is None and third["days__std__e__amount"] is None
    assert (third["days__num_unique__e__kind"], third["days__mode__e__kind"]) == (0, None)
    assert (third["days__num_unique__e__note"], third["days__mode__e__note"]) == (0, None)
    assert [found[day(n)]["days__count__e__where_large"] for n in (1, 2, 3)] == [1, 3, 0]


def test_attached_counts_are_zero_on_days_without_rows(spark, entity, rows):
    facts = spark.createDataFrame([(day(1), 1), (day(9), 2)], "date date, id int")
    definitions = feat.define_day_features(entity, "e")
    joined = feat.attach_day_aggregates(facts, feat.day_aggregates(entity, definitions), definitions)
    assert rows(joined, "id", "days__count__e", "days__max__e__amount") == [(1, 3, 6.0), (2, 0, None)]


def test_target_stays_out_unless_asked_for(spark):
    curated = spark.createDataFrame(
        [(1, "x", day(1), 3.0, 2.0), (1, "x", day(2), None, 2.0)],
        "store int, product string, date date, sales double, price double",
    )
    stores = spark.createDataFrame([(1, "HE")], "store int, state string")
    from demandkit.operators.calendar import date_dimension, days_of

    calendar = date_dimension(days_of(curated), ["HE"])
    plain, definitions = feat.build_features(curated, stores, calendar)
    assert not [c for c in plain.columns if "sales__sales" in c]
    assert set(plain.columns) >= {d.name for d in definitions}
    leaky, _ = feat.build_features(curated, stores, calendar, include_target=True)
    assert "days__sum__sales__sales" in leaky.columns
    assert plain.count() == 2
    coverage = {r["name"]: r["non_null"] for r in feat.definition_coverage(plain, definitions).collect()}
    assert coverage["days__mean__sales__price"] == 2 and coverage["days__holiday_name"] == 1
    listed = feat.definition_table(spark, definitions)
    assert listed.columns == ["name", "entity", "column", "primitive"] and listed.count() == len(definitions)


def test_transforms(spark):
    df = spark.createDataFrame([(day(7), " two  words\n", 0.0, 0.0, 0.0, 90.0)], "date date, t string, a double, b double, c double, d double")
    row = feat.transform_features(df, texts=["t"], points=[(("a", "b"), ("c", "d"))], unit="kilometers").first()
    assert (row["day__date"], row["month__date"], row["week__date"], row["weekday__date"]) == (7, 1, 1, 6)
    assert (row["num_words__t"], row["num_characters__t"]) == (2, 12)
    assert row["haversine__a__c"] == pytest.approx(math.pi / 2 * 6371.0088)


def test_text_edges(spark):
    df = spark.createDataFrame([("",), ("   ",), ("a",), (None,)], "t string")
    found = [tuple(r) for r in df.select(num_words(F.col("t")), num_characters(F.col("t"))).collect()]
    assert found == [(0, 0), (0, 3), (1, 1), (None, None)]


def test_haversine_of_equal_points(spark):
    miles = haversine(F.lit(50.08), F.lit(8.24), F.lit(50.08), F.lit(8.24))
    assert spark.range(1).select(miles).first()[0] == 0.0


def test_lags_are_day_based(spark):
    sold = {1: 5.0, 8: 7.0, 10: 1.0, 365: 2.0, 366: None}
    df = spark.createDataFrame([(1, "x", day(n), v) for n, v in sold.items()], "store int, product string, date date, sales double")
    found = {r["date"]: r for r in lags.sales_lags(df).collect()}
    assert found[day(8)]["last_week"] == 5.0
    assert found[day(10)]["last_week"] is None
    assert found[day(365)]["last_year"] == 5.0
    assert (found[day(8)]["rolling7_sum"], found[day(8)]["rolling7_days"]) == (5.0, 1)
    assert (found[day(10)]["rolling7_mean"], found[day(10)]["rolling7_days"]) == (7.0, 1)
    assert (found[day(366)]["rolling7_sum"], found[day(1)]["rolling7_sum"]) == (2.0, None)


def test_trailing_days_against_brute_force(spark):
    random.seed(3)
    values = {(k, n): float(random.randint(0, 50)) for k in "ab" for n in random.sample(range(1, 60), 40)}
    df = spark.createDataFrame([(k, day(n), v) for (k, n), v in values.items()], "place string, date date, t double")
    for r in lags.trailing_days(df, ["t"], keys=["place"]).collect():
        n = (r["date"] - day(1)).days + 1
        past = [values[(r["place"], m)] for m in range(n - 7, n) if (r["place"], m) in values]
        assert r["past7_days"] == len(past)
        assert r["past7_t"] == (pytest.approx(sum(past) / len(past)) if past else None)


@pytest.fixture
def curated(spark):
    data = [(1, "x", day(n), float(n)) for n in range(1, 42)] + [(1, "x", day(n), None) for n in range(42, 49)]
    return spark.createDataFrame(data, "store int, product string, date date, sales double")


def test_split_bounds(curated):
    row = splits.split_bounds(curated).first()
    assert (row["timespan"], row["train_span"]) == (41, 30)
    bounds = splits.fetch_bounds(curated)
    assert bounds == splits.Bounds(day(1), day(48), day(42), day(31))


def test_splits_are_disjoint_and_complete(curated, rows):
    bounds = splits.fetch_bounds(curated)
    sizes = splits.split_sizes(splits.assign_split(curated, bounds))
    assert rows(sizes) == [
        ("predict", 7, day(42), day(48)), ("test", 10, day(32), day(41)), ("train", 31, day(1), day(31)),
    ]
    assert splits.split_violations(sizes, bounds).isEmpty()
    assert splits.history_rows(curated, bounds).count() == 41
    assert splits.to_predict(curated).count() == 7


def test_small_sets_are_violations(curated):
    bounds = splits.fetch_bounds(curated)
    sizes = splits.split_sizes(splits.assign_split(curated.filter(F.col("date") != F.lit(day(35))), bounds))
    assert [r["violation"] for r in splits.split_violations(sizes, bounds).collect()] == ["too few rows"]
    missing = splits.split_sizes(splits.assign_split(curated, bounds)).filter("split <> 'test'")
    assert [r["violation"] for r in splits.split_violations(missing, bounds).collect()] == ["no rows"]


def test_without_rows_to_predict(curated):
    bounds = splits.fetch_bounds(curated.filter("sales is not null"))
    assert bounds.pred_cutoff == day(42)


def test_trim_keeps_the_days_to_predict(spark, curated):
    entity = spark.createDataFrame([(day(n),) for n in range(-5, 60)], "date date")
    assert splits.trim(entity, splits.fetch_bounds(curated)).count() == 48


def test_checks(spark, curated):
    checks.assert_empty(checks.duplicate_keys(curated), "grain")
    with pytest.raises(checks.DataCheckError, match="grain"):
        checks.assert_empty(checks.duplicate_keys(curated.union(curated)), "grain")
    twice = spark.createDataFrame([("a",), ("a",), ("b",)], "date_time string")
    assert [tuple(r) for r in checks.duplicate_timestamps(twice).collect()] == [("a", 2)]
    assert checks.duplicate_ids(twice.withColumnRenamed("date_time", "index")).count() == 1
    assert checks.entity_problems("sales", curated, target=True) == []
    assert len(checks.entity_problems("sales", curated.select("store"), target=True)) == 2
    assert checks.schema_differences(curated, curated) == []
    assert checks.schema_differences(curated, curated.select("date", "store", "product", "sales"))
    assert checks.schema_differences(curated.select("store"), curated.select(F.col("store").cast("long"))) == ["store: int != bigint"]
    with pytest.raises(checks.DataCheckError):
        checks.assert_empty(["x"], "columns")
