import datetime as dt
import math
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from demandkit.config import ForecastConfig, Store
from demandkit.operators import model, splits
from demandkit.operators.serve import ORDER_COLUMNS
from demandkit.plans.stages import run_forecast, run_landed, train_and_score
from demandkit.runtime import settle, work_dir
from demandkit.sources import files


@pytest.fixture(scope="module")
def features(spark):
    """Sales follow the product and the weekday; one store sells a third more rows."""
    n = F.col("id")
    df = spark.range(1200).select(
        F.when(n % 3 == 0, 1).otherwise((n % 4).cast("int")).alias("store"),
        F.concat(F.lit("p"), (n % 12)).alias("product"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), (n / 12).cast("int")).alias("date"),
        (n % 12 + 2 * ((n / 12).cast("int") % 7)).cast("double").alias("value"),
        ((n / 12).cast("int") % 7).alias("weekday"),
        (n % 5 == 0).alias("promo"),
        F.when(n % 9 != 0, F.lit(1.0)).alias("gappy"),
    )
    day = F.datediff("date", F.lit(dt.date(2024, 1, 1)))
    split = F.when(day >= 93, "predict").when(day > 70, "test").otherwise("train")
    labelled = df.withColumn("split", split).withColumn("sales", F.when(split != "predict", F.col("value"))).drop("value")
    return settle(labelled, "test-features")


def test_columns_by_type(features):
    columns = model.model_columns(features)
    assert columns.categorical == ["product", "promo"]
    assert columns.numeric == ["store", "weekday", "gappy"]


def test_cleaning_fills_missing_values(spark):
    df = spark.createDataFrame([(None, None, 1)], "a string, b boolean, c int")
    cleaned = model.clean(df, model.Columns(["a", "b"], ["c"])).first()
    assert tuple(cleaned) == ("", "", 1.0)


def test_training_scoring_saving(spark, features, tmp_path):
    forecast = train_and_score(features, max_iter=15)
    metrics = model.regression_metrics(forecast.evaluation).first()
    assert metrics["r2"] > 0.8
    assert 1 <= model.trees_in(forecast.trained.production.pipeline) <= 15
    assert model.trees_in(forecast.trained.evaluation.pipeline) == model.trees_in(forecast.trained.production.pipeline)
    assert forecast.predictions.schema["store"].dataType == features.schema["store"].dataType
    forecast.trained.evaluation.save(str(tmp_path / "evaluation"))
    tested = model.score(model.Forecaster.load(spark, str(tmp_path / "evaluation")), features.filter("split = 'test'"))
    assert tested.orderBy("date", "product").collect() == forecast.evaluation.orderBy("date", "product").collect()
    assert forecast.predictions.count() == features.filter("split = 'predict'").count()
    assert forecast.predictions.filter("forecast is null").isEmpty()
    forecast.trained.production.save(str(tmp_path / "model"))
    again = model.Forecaster.load(spark, str(tmp_path / "model"))
    rows = features.filter("split = 'predict'")
    first = [r["forecast"] for r in model.score(again, rows).orderBy("date", "product").collect()]
    second = [r["forecast"] for r in forecast.predictions.orderBy("date", "product").collect()]
    assert first == second
    raw = rows.withColumns({"gappy": F.lit(None).cast("double"), "product": F.lit("never seen"), "promo": F.lit(None).cast("boolean")})
    assert model.score(again, raw).filter("forecast is null").isEmpty()


def by_hand(rows, counted, prior, weight=10.0):
    """Mean target of each row from the counted rows of earlier days, by plain loops."""
    out = {}
    for i, (category, date, _) in enumerate(rows):
        seen = [y for c, d, y in counted if c == category and d < date and y is not None]
        out[i] = (sum(seen) + weight * prior) / (len(seen) + weight)
    return out


def test_mean_targets_are_those_of_earlier_days(features):
    columns = model.model_columns(features)
    assert model.chosen_means(features, columns) == ["product"]
    assert model.chosen_means(features, columns, {"product": "index", "promo": "mean"}) == ["promo"]
    with pytest.raises(ValueError):
        model.chosen_means(features, columns, {"product": "hash"})
    found = model.encode_targets(features, F.col("split") == "train", columns, ["product"])
    assert found.inputs.numeric[-1] == "mean_target__product" and found.inputs.categorical == ["promo"]
    plain = [tuple(r) for r in features.filter("split <> 'predict'").select("product", "date", "sales", "split").collect()]
    counted = [r[:3] for r in plain if r[3] == "train"]
    prior = sum(r[2] for r in counted) / len(counted)
    assert found.prior == pytest.approx(prior)
    wanted = by_hand([r[:3] for r in plain], counted, prior)
    got = sorted((r["product"], r["date"], r["sales"], round(r["mean_target__product"], 9)) for r in found.rows.collect())
    assert got == sorted((p, d, y, round(wanted[i], 9)) for i, (p, d, y, _) in enumerate(plain))


@pytest.mark.parametrize("block_days", [1, 3, 64])
def test_running_sums_of_a_category_with_most_rows(spark, block_days):
    first = dt.date(2023, 12, 20)
    days = [("hot", first + dt.timedelta(days=n), float(n % 7), n % 3) for n in range(0, 200, 2)]
    days += [(None, first, 1.0, 1), ("cold", first + dt.timedelta(days=150), 5.0, 2), ("cold", dt.date(1950, 1, 1), 1.0, 1)]
    df = spark.createDataFrame(days, "k string, date date, `__sum` double, `__n` long")
    found = {(r.k, r.date): (r["__sum"], r["__n"]) for r in model.earlier_days(df, "k", block_days).collect() if r.k}
    for k, date, _, _ in days:
        if k:
            before = [(s, n) for c, d, s, n in days if c == k and d < date]
            assert found[k, date] == (sum(s for s, _ in before), sum(n for _, n in before))


def test_unseen_categories_and_late_days(features):
    columns = model.model_columns(features)
    cleaned = model.clean(features, columns)
    prior = 4.5
    days = settle(model.target_days(cleaned.filter("split = 'train' and product <> 'p3'"), "product"), "days")
    encoded = model.with_means(cleaned, {"product": days}, prior)
    assert encoded.count() == features.count()
    assert {r[0] for r in encoded.filter("product = 'p3'").select("mean_target__product").distinct().collect()} == {prior}
    total, n = days.filter("product = 'p4'").agg(F.sum("__sum"), F.sum("__n")).first()
    late = encoded.filter("split = 'predict' and product = 'p4'").select("mean_target__product").distinct().collect()
    assert [r[0] for r in late] == [pytest.approx((total + 10 * prior) / (n + 10))]


def test_a_noise_target_is_not_read_back(spark):
    """Sales drawn at random: nothing of a row's own target may be in its features."""
    n = F.col("id")
    noise = spark.range(4000).select(
        F.lit(1).alias("store"), F.concat(F.lit("p"), n % 200).alias("product"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), (n / 200).cast("int")).alias("date"),
        (F.abs(F.hash(n, F.lit(3))) % 1000 / 10.0).alias("sales"),
    )
    labelled = settle(noise.withColumn("split", F.when(F.dayofmonth("date") > 15, "test").otherwise("train")), "noise")
    columns = model.model_columns(labelled)
    seen = model.encode_targets(labelled, F.col("split") == "train", columns, ["product"])
    fitted = model.boosted_trees(seen.inputs, max_iter=10, max_depth=3).fit(seen.rows.filter("split = 'train'"))
    scored = fitted.transform(seen.rows.filter("split = 'train'"))
    assert model.regression_metrics(scored).first()["r2"] < 0.15
    assert abs(seen.rows.filter("split = 'train'").corr("sales", "mean_target__product")) < 0.1


@pytest.fixture(scope="module")
def encoded(features):
    seen = model.encode_targets(features, F.col("split") == "train", model.model_columns(features), ["product"])
    return settle(seen.rows, "encoded"), seen.inputs


def forecasts(frame):
    return [r["forecast"] for r in frame.orderBy("date", "product").select("forecast").collect()]


def test_best_round_equals_boosting_in_one_go(encoded):
    rows, inputs = encoded
    best = model.boost_with_patience(rows, inputs, "__held_out", max_iter=6, patience=6, block=4, max_depth=3)
    assert best.rounds == 1 + best.errors.index(min(best.errors)) and len(best.errors) == 6
    assert model.trees_in(best.pipeline) == best.rounds
    whole = model.boosted_trees(inputs, max_iter=best.rounds, max_depth=3).fit(rows.filter("not __held_out"))
    assert forecasts(best.pipeline.transform(rows)) == pytest.approx(forecasts(whole.transform(rows)), abs=1e-9)
    rmse = model.regression_metrics(whole.transform(rows.filter("__held_out"))).first()["rmse"]
    assert rmse == pytest.approx(min(best.errors))


def test_patience_and_blocks(encoded, monkeypatch):
    """Boosting ends ``patience`` rounds after the best one, wherever a block ends."""
    rows, inputs = encoded
    # With so large steps the error on the test set soon rises.
    found = [model.boost_with_patience(rows, inputs, "__held_out", max_iter=12, patience=3, block=b, max_depth=2, step=1.2) for b in (1, 5)]
    for one in found:
        assert len(one.errors) == min(12, one.rounds + 3)
        assert one.rounds < 9, "the error did not rise"
        assert min(one.errors) == one.errors[one.rounds - 1]
    assert found[0].rounds == found[1].rounds
    assert found[0].errors == pytest.approx(found[1].errors)


def test_without_held_out_rows_all_trees_stay(encoded):
    rows, inputs = encoded
    one = model.boost_with_patience(rows.filter("not __held_out"), inputs, "__held_out", max_iter=3, max_depth=2)
    assert (one.rounds, one.errors) == (3, [])


def test_a_tree_takes_few_jobs(spark, encoded):
    """Rows are binned once for all trees: a further tree costs a job a level, and no pass of its own."""
    rows, inputs = encoded
    context, jobs = spark.sparkContext, []
    for number in (4, 12):
        context.setJobGroup(f"boosting-{number}", "boosting")
        model.boost_with_patience(rows, inputs, "__held_out", max_iter=number, patience=12, max_depth=2)
        jobs.append(len(context.statusTracker().getJobIdsForGroup(f"boosting-{number}")))
    context._jsc.clearJobGroup()
    assert jobs[1] - jobs[0] <= 8 * 3


def test_later_goes_find_the_same_round(encoded, monkeypatch):
    """The first go does not end boosting; more trees do, with the trees and errors of one go."""
    rows, inputs = encoded
    begun, booster = [], model._booster
    monkeypatch.setattr(model, "_booster", lambda number, *args, **options: begun.append(number) or booster(number, *args, **options))
    best = model.boost_with_patience(rows, inputs, "__held_out", max_iter=8, patience=2, max_depth=3)
    assert begun == [4, 8] and len(best.errors) == 8
    monkeypatch.undo()
    whole = model.boosted_trees(inputs, max_iter=best.rounds, max_depth=3).fit(rows.filter("not __held_out"))
    assert forecasts(best.pipeline.transform(rows)) == pytest.approx(forecasts(whole.transform(rows)), abs=1e-9)


@pytest.mark.parametrize(
    "errors, found", [([], (0, 0)), ([3.0], (1, 0)), ([3.0, 2.0, 2.0, 2.5], (2, 4)), ([3.0, 2.0, 2.5, 1.0, 5.0], (4, 0)), ([1.0, 2.0, 2.0, 0.5], (1, 3))]
)
def test_best_round_within_patience(errors, found):
    assert model.best_round(errors, 2) == found


def test_the_number_of_categories_changes_nothing(spark, features):
    columns = model.model_columns(features)
    many = features.withColumn("product", F.concat("product", F.lit("-"), F.monotonically_increasing_id() % 257))
    assert model.chosen_means(many, columns) == model.chosen_means(features, columns)


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (8.0, 6.0), (None, 1.0), (1.0, None)], "sales double, forecast double")
    row = model.regression_metrics(df).first()
    assert row["n_rows"] == 3 and row["mae"] == 1.0
    assert row["rmse"] == pytest.approx(math.sqrt(5 / 3))
    assert row["r2"] == pytest.approx(1 - 5 / 26)


def test_whole_job(spark):
    n = F.col("id")
    lines = spark.range(4000).select(
        (n % 2).cast("int").alias("store"),
        F.concat(F.lit("p"), n % 3).alias("product"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), (n / 40).cast("int")).alias("date"),
        (n % 6 + 1).cast("double").alias("sales"),
        F.when(n % 2 == 0, "card").otherwise("cash").alias("payment"),
    )
    stores = spark.createDataFrame([(0, "HE"), (1, "RP")], "store int, state string")
    orders, _ = run_forecast(lines, stores, ["HE", "RP"], config=ForecastConfig(), max_iter=3)
    assert orders.columns == list(ORDER_COLUMNS)
    assert orders.count() == 6
    assert [r["id"] for r in orders.orderBy("store", "product").collect()] == [1, 2, 3, 1, 2, 3]


def test_job_over_landed_files(spark, tmp_path):
    first = dt.date(2024, 1, 1)
    sales = ["index,store,product,date,sales,payment"]
    weather = ["Date time,Minimum Temperature,Maximum Temperature,Temperature,Precipitation,Dew Point,Info,"
               "Precipitation Cover,Visibility,Weather Type"]
    for n in range(60):
        day = first + dt.timedelta(days=n)
        for store in (1, 2):
            for product in ("a", "b"):
                sales.append(f"{len(sales)},{store},{product},{day},{store * 2 + day.weekday()},card")
        weather.append(f"{day:%m/%d/%Y} 00:00:00,1,9,{n % 9},0.1,,,,,")
    forecast = ["Date time,Temperature,Precipitation,Chance Precipitation (%),Snow"]
    forecast += [f"{first + dt.timedelta(days=n):%m/%d/%Y} 00:00:00,{n % 9},1.0,0.7,0" for n in range(59, 70)]
    for folder, name, lines in (
        ("sales", "sales_1.csv", sales), ("weather", "weather_2024-01-01_21d.csv", weather),
        ("weather_forecast", "forecast.csv", forecast),
    ):
        (tmp_path / "landing" / folder).mkdir(parents=True)
        (tmp_path / "landing" / folder / name).write_text("\n".join(lines) + "\n")
    promotions = [(first + dt.timedelta(days=n // 2), n % 3 == 0, float(n)) for n in range(130)]
    spark.createDataFrame(promotions, "date date, tv boolean, spent double").write.parquet(str(tmp_path / "landing" / "entities" / "promotions.parquet"))
    config = ForecastConfig(register="csv", stores=(Store(1, "HE", "A", "One"), Store(2, "RP", "B", "Two")))
    orders = run_landed(spark, config, str(tmp_path / "landing"), str(tmp_path / "out"), with_lags=True, max_iter=3)
    assert orders.columns == list(ORDER_COLUMNS)
    assert sorted((r["store"], r["product"], r["id"]) for r in orders.collect()) == [
        (1, "a", 1), (1, "b", 2), (2, "a", 1), (2, "b", 2),
    ]
    assert orders.filter("next7_order_qty <= 0").isEmpty()
    stages = model.Forecaster.load(spark, f"{files.current_version(spark, str(tmp_path / 'out'))}/model_production")
    assert {"days__percent_true__promotions__tv", "days__sum__promotions__spent"} <= set(stages.columns.numeric)
    version = files.current_version(spark, str(tmp_path / "out"))
    assert spark.read.parquet(f"{version}/evaluation").first()["n_rows"] > 0
    assert model.Forecaster.load(spark, f"{version}/model_production").pipeline.stages
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["versions"]
    assert sorted(f.name for f in Path(work_dir(spark), "demandkit").glob("run-*")) == [], "stage tables stay"


def test_every_entity_needs_days_in_every_set(spark, features):
    sales = features.select("store", "product", "date", "sales")
    bounds = splits.fetch_bounds(sales)
    days = lambda first, n: spark.range(n).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("date"))
    entities = {"sales": sales, "whole": days(bounds.start, 90), "early": days(bounds.start, 30), "few": days(bounds.cutoff_date - dt.timedelta(days=20), 25)}
    found = sorted((r.entity, r.split, r.violation) for r in splits.entity_violations(entities, bounds).collect())
    assert found == [("early", "test", "no rows"), ("few", "test", "too few rows")]
