"""Forecast models: distributed boosted trees, a recent-mean baseline, metrics."""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from demandkit.operators.grain import PAIR, TARGET
from demandkit.operators.template import future_template
from demandkit.runtime import scratch, settle, small_side

#: Tree bins; an indexed category with more values is an error of the booster.
MAX_BINS = 64
#: Stands for a missing number: below every value, so trees can split it off.
MISSING = -1.0e12
#: Weight of the overall mean in the mean target of a category.
PRIOR_WEIGHT = 10.0
#: Days of a block of the running sums of a category.
BLOCK_DAYS = 64
#: Rounds without a lower error on the test set that end boosting; trees between two writes.
PATIENCE, BLOCK_TREES = 20, 10
NOT_FEATURES = (TARGET, "date", "index", "split")


@dataclass(frozen=True)
class Columns:
    categorical: list[str]
    numeric: list[str]


def model_columns(features: DataFrame, exclude: Sequence[str] = NOT_FEATURES) -> Columns:
    """Strings and flags are categories; numbers, the store included, stay numbers."""
    categorical, numeric = [], []
    for field in features.schema:
        if field.name in exclude:
            continue
        if isinstance(field.dataType, (T.StringType, T.BooleanType)):
            categorical.append(field.name)
        elif isinstance(field.dataType, T.NumericType):
            numeric.append(field.name)
    return Columns(categorical, numeric)


def clean(features: DataFrame, columns: Columns) -> DataFrame:
    """Categories as text with '' for missing, numbers as doubles."""
    return features.withColumns(
        {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns.categorical}
        | {c: F.coalesce(F.col(c).cast("double"), F.lit(MISSING)) for c in columns.numeric}
    )


def chosen_means(features: DataFrame, columns: Columns, encodings: Mapping[str, str] | None = None) -> list[str]:
    """The categories that become mean targets. The caller names ``"mean"`` or ``"index"``
    by column; strings are means and flags are indexed otherwise, however many values
    there are."""
    named = encodings or {}
    unknown = set(named.values()) - {"mean", "index"} or set(named) - set(columns.categorical)
    if unknown:
        raise ValueError(f"unknown encodings or columns: {sorted(unknown)}")
    flags = {f.name for f in features.schema if isinstance(f.dataType, T.BooleanType)}
    return [c for c in columns.categorical if named.get(c, "index" if c in flags else "mean") == "mean"]


def target_days(training: DataFrame, column: str) -> DataFrame:
    """Sum and number of known targets by category and day."""
    known = training.filter(F.col(TARGET).isNotNull())
    return known.groupBy(column, "date").agg(F.sum(TARGET).alias("__sum"), F.count(F.lit(1)).alias("__n"))


def earlier_days(days: DataFrame, column: str, block_days: int = BLOCK_DAYS) -> DataFrame:
    """Sum and number of targets on all earlier days, for each category and day of ``days``.

    A prefix in two levels: over the blocks of days of a category, and over the days of a
    block. So the days of one category are spread over tasks, and no window holds more than
    a block of them, or one row a block.
    """
    block = F.floor(F.datediff("date", F.lit("1970-01-01").cast("date")) / block_days)
    placed = days.withColumn("__block", block)
    before = Window.partitionBy(column).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = placed.groupBy(column, "__block").agg(*(F.sum(c).alias(c) for c in ("__sum", "__n")))
    blocks = blocks.select(column, "__block", *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_blocks") for c in ("__sum", "__n")))
    inside = Window.partitionBy(column, "__block").orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    within = placed.select(column, "__block", "date", *(F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(c) for c in ("__sum", "__n")))
    both = within.join(blocks, [column, "__block"])
    return both.select(column, "date", *((F.col(c) + F.col(f"{c}_blocks")).alias(c) for c in ("__sum", "__n")))


def with_means(rows: DataFrame, history: Mapping[str, DataFrame], prior: float, weight: float = PRIOR_WEIGHT) -> DataFrame:
    """Smoothed mean target of each row's category on earlier days, the overall mean being the prior.

    ``history`` holds the known targets by category and day (:func:`target_days`). A row sees
    neither its own target nor any of its day or later, so nothing of the answer is in the
    feature; days to predict see all of the history. No list of categories passes through
    the driver; categories without earlier days get the prior.
    """
    for column, table in history.items():
        own = rows.select(column, "date").distinct().withColumns({"__sum": F.lit(0.0), "__n": F.lit(0).cast("long")})
        days = own.unionByName(table.select(column, "date", "__sum", "__n"))
        days = days.groupBy(column, "date").agg(F.sum("__sum").alias("__sum"), F.sum("__n").alias("__n"))
        seen = small_side(settle(earlier_days(days, column), "earlier-days"))
        mean = (F.coalesce("__sum", F.lit(0.0)) + weight * prior) / (F.coalesce("__n", F.lit(0)) + weight)
        rows = rows.join(seen, [column, "date"], "left").withColumn(f"mean_target__{column}", mean).drop("__sum", "__n")
    return rows


def _preparation(columns: Columns) -> list:
    """Stages that index categories and assemble the features."""
    indexed = [f"__ix_{c}" for c in columns.categorical]
    stages = []
    if columns.categorical:
        stages.append(
            StringIndexer(inputCols=columns.categorical, outputCols=indexed, handleInvalid="keep")
        )
    return [*stages, VectorAssembler(inputCols=[*columns.numeric, *indexed], outputCol="__features")]


def _booster(max_iter: int, max_depth: int, step: float, max_bins: int, seed: int) -> GBTRegressor:
    return GBTRegressor(
        featuresCol="__features",
        labelCol=TARGET,
        predictionCol="forecast",
        lossType="squared",
        maxIter=max_iter,
        maxDepth=max_depth,
        stepSize=step,
        maxBins=max_bins,
        seed=seed,
    )


def boosted_trees(
    columns: Columns, max_iter: int = 100, max_depth: int = 5, step: float = 0.1, max_bins: int = MAX_BINS, seed: int = 42
) -> Pipeline:
    """Index categories, assemble, boost with squared loss: ``max_iter`` trees in one go."""
    return Pipeline(stages=[*_preparation(columns), _booster(max_iter, max_depth, step, max_bins, seed)])


@dataclass(frozen=True)
class Boosted:
    """Trees up to the best round, and the error on the held-out rows after each round."""

    pipeline: PipelineModel
    rounds: int
    errors: list[float]


def best_round(errors: Sequence[float], patience: int) -> tuple[int, int]:
    """The round with the lowest error, and the round that ends boosting, which is ``patience``
    rounds without a lower error after it; 0 if none ends it."""
    best = 0
    for number, error in enumerate(errors, 1):
        if number == 1 or error < errors[best - 1]:
            best = number
        if number - best >= patience:
            return best, number
    return best, 0


def _boost_in_goes(rows: DataFrame, testing: bool, max_iter: int, patience: int, block: int, **options) -> tuple[list, list[float]]:
    """Trees and errors from the booster itself: rows are binned once for all trees, and one pass
    over the held-out rows measures all rounds.

    The booster cannot go on from trees it was given. So it first makes twice ``patience``
    trees, and three times as many from the start while that did not end boosting.
    """
    training, held_out = (rows.filter(c).select("__features", F.col("__y").alias(TARGET)) for c in (~F.col("__out"), F.col("__out")))
    number = min(max_iter, max(1, 2 * patience)) if testing else max_iter
    while True:
        model = _booster(number, **options).setCheckpointInterval(block).fit(training)
        errors = [math.sqrt(e) for e in model.evaluateEachIteration(held_out, "squared")] if testing else []
        if number == max_iter or best_round(errors, patience)[1]:
            trees = [t.setFeaturesCol("__features").setPredictionCol(f"__t{n}") for n, t in enumerate(model.trees)]
            return trees, errors
        number = min(max_iter, 3 * number)


def _boost_by_tree(
    rows: DataFrame, testing: bool, max_iter: int, patience: int, block: int, max_depth: int, step: float, max_bins: int, seed: int
) -> tuple[list, list[float]]:
    """The same for steps that the booster does not take (above 1): a tree at a time."""
    trees: list = []
    errors: list[float] = []
    while len(trees) < max_iter and not best_round(errors, patience)[1]:
        now, added = rows, []
        for number in range(len(trees), min(max_iter, len(trees) + block)):
            # The first tree takes the target itself at full weight.
            label = F.col("__y") if number == 0 else 2 * (F.col("__y") - F.col("__f"))
            tree = DecisionTreeRegressor(
                featuresCol="__features", labelCol="__label", predictionCol=f"__t{number}", maxDepth=max_depth, maxBins=max_bins, seed=seed
            )
            model = tree.fit(now.filter(~F.col("__out")).withColumn("__label", label))
            trees.append(model)
            added.append(f"__f{number}")
            weight = 1.0 if number == 0 else step
            now = model.transform(now).withColumn("__f", F.col("__f") + weight * F.col(f"__t{number}")).withColumn(added[-1], F.col("__f"))
        off = [F.avg((F.col("__y") - F.col(c)) ** 2) for c in added]
        now = settle(now.select(*rows.columns, *added), "rounds")
        if testing:
            errors += [math.sqrt(error) for error in now.filter("__out").agg(*off).first()]
        rows = now.select(*rows.columns)
    return trees, errors


def boost_with_patience(
    encoded: DataFrame,
    columns: Columns,
    held_out: str,
    max_iter: int = 100,
    patience: int = PATIENCE,
    block: int = BLOCK_TREES,
    max_depth: int = 5,
    step: float = 0.1,
    max_bins: int = MAX_BINS,
    seed: int = 42,
) -> Boosted:
    """Boost until ``patience`` rounds have not lowered the error on the held-out rows.

    Each tree is fitted to the gradient of the squared error that the trees before it leave,
    and the trees are those that :func:`boosted_trees` gives. The forecasts so far are written after
    each block of trees, with steps up to 1 if the session has a ``spark.checkpoint.dir``: a lost
    executor costs at most that block. Which round is the best does not depend on the size
    of the blocks. Without held-out rows all ``max_iter`` trees stay.
    """
    spark = encoded.sparkSession
    known = encoded.filter(F.col(TARGET).isNotNull())
    prepared = Pipeline(stages=_preparation(columns)).fit(known.filter(~F.col(held_out)))
    boost = _boost_in_goes if step <= 1 else _boost_by_tree
    with scratch(spark, "boosting"):
        rows = prepared.transform(known).select("__features", F.col(TARGET).alias("__y"), F.col(held_out).alias("__out"), F.lit(0.0).alias("__f"))
        rows = settle(rows, "rounds")
        testing = not rows.filter("__out").isEmpty()
        trees, errors = boost(rows, testing, max_iter, patience, block, max_depth=max_depth, step=step, max_bins=max_bins, seed=seed)
    best, stopped = best_round(errors, patience)
    rounds = best if testing else len(trees)
    errors = errors[: stopped or len(errors)]
    terms = " + ".join(f"{1.0 if n == 0 else step!r} * `__t{n}`" for n in range(rounds))
    total = SQLTransformer(statement=f"SELECT *, {terms} AS forecast FROM __THIS__")
    return Boosted(PipelineModel([*prepared.stages, *trees[:rounds], total]), rounds, errors)


def trees_in(model: PipelineModel) -> int:
    last = model.stages[-1]
    return last.getNumTrees if hasattr(last, "getNumTrees") else sum(isinstance(s, DecisionTreeRegressionModel) for s in model.stages)


@dataclass(frozen=True)
class Forecaster:
    """Cleaning, mean targets and trees: raw feature rows in, forecasts out."""

    columns: Columns
    history: dict[str, DataFrame]
    prior: float
    pipeline: PipelineModel

    def encode(self, features: DataFrame) -> DataFrame:
        return with_means(clean(features, self.columns), self.history, self.prior)

    def transform(self, features: DataFrame) -> DataFrame:
        return self.pipeline.transform(self.encode(features))

    def save(self, path: str) -> None:
        """The trees, and beside them what turns raw rows into their input."""
        spark = SparkSession.getActiveSession()
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        for number, column in enumerate(self.history):
            self.history[column].write.mode("overwrite").parquet(f"{path}/target_days_{number}")
        settings = {
            "categorical": self.columns.categorical, "numeric": self.columns.numeric, "means": list(self.history), "prior": self.prior,
        }
        spark.createDataFrame([(json.dumps(settings),)], "settings string").write.mode("overwrite").parquet(f"{path}/settings")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Forecaster":
        settings = json.loads(spark.read.parquet(f"{path}/settings").first()[0])
        history = {c: spark.read.parquet(f"{path}/target_days_{n}") for n, c in enumerate(settings["means"])}
        columns = Columns(settings["categorical"], settings["numeric"])
        return cls(columns, history, settings["prior"], PipelineModel.load(f"{path}/pipeline"))


@dataclass(frozen=True)
class Trained:
    evaluation: Forecaster
    production: Forecaster
    features: DataFrame
    #: Error on the test set after each round of the evaluation.
    errors: list[float]


@dataclass(frozen=True)
class Encoded:
    """Known rows with mean targets from the counted ones, and what they were made of."""

    rows: DataFrame
    inputs: Columns
    history: dict[str, DataFrame]
    prior: float


def encode_targets(features: DataFrame, counted: Column, columns: Columns, means: Sequence[str]) -> Encoded:
    """Clean the rows that are not to be predicted; mean targets come from the ``counted`` ones."""
    training = clean(features, columns).filter(counted)
    prior = training.agg(F.avg(TARGET)).first()[0] or 0.0
    history = {c: settle(target_days(training, c), "target-days") for c in means}
    known = features.filter(F.col("split") != "predict").withColumn("__held_out", F.col("split") == "test")
    rows = with_means(clean(known, columns), history, prior)
    inputs = Columns([c for c in columns.categorical if c not in means], columns.numeric + [f"mean_target__{c}" for c in means])
    return Encoded(rows, inputs, history, prior)


def train(
    features: DataFrame, max_iter: int = 100, encodings: Mapping[str, str] | None = None, patience: int = PATIENCE, block: int = BLOCK_TREES,
    **options,
) -> Trained:
    """Train on the train set until the test set has not gained for ``patience`` rounds, then
    again on all history with the number of trees that was best.

    The production model's mean targets come from all history as well. ``features``
    carries the ``split`` label and should be a stored table, for boosting reads it
    many times.
    """
    columns = model_columns(features)
    means = chosen_means(features, columns, encodings)
    split = F.col("split")
    seen = encode_targets(features, split == "train", columns, means)
    best = boost_with_patience(seen.rows, seen.inputs, "__held_out", max_iter, patience, block, **options)
    evaluation = Forecaster(columns, seen.history, seen.prior, best.pipeline)
    whole = encode_targets(features, split != "predict", columns, means)
    with scratch(features.sparkSession, "production"):
        # Stored, as the booster reads its rows several times.
        rows = settle(whole.rows.select(*whole.inputs.categorical, *whole.inputs.numeric, TARGET), "whole")
        trees = boosted_trees(whole.inputs, max_iter=max(1, best.rounds), **options).fit(rows)
    return Trained(evaluation, Forecaster(columns, whole.history, whole.prior, trees), features, best.errors)


def score(model: Forecaster, rows: DataFrame) -> DataFrame:
    """Keys, date, split and target as they were, with the forecast."""
    kept = rows.withColumn("__row", F.struct(*PAIR, "date", "split", TARGET))
    return model.transform(kept).select("__row.*", "forecast")


def recent_mean_forecast(profile: DataFrame) -> DataFrame:
    """Baseline: every day to predict gets the mean of the pair's recent sales."""
    recent = f"recent_{TARGET}"
    return future_template(profile, keep=(recent,)).select(*PAIR, "date", F.col(recent).alias("forecast"))


def regression_metrics(scored: DataFrame, label: str = TARGET, prediction: str = "forecast") -> DataFrame:
    """R2, RMSE and MAE in one pass."""
    rows = scored.filter(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    y, error = F.col(label), F.col(label) - F.col(prediction)
    sums = rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(error * error).alias("sse"),
        F.var_pop(y).alias("variance"),
        F.avg(F.abs(error)).alias("mae"),
    )
    return sums.select(
        "n_rows",
        (1 - F.try_divide(F.col("sse"), F.col("variance") * F.col("n_rows"))).alias("r2"),
        F.sqrt(F.try_divide(F.col("sse"), F.col("n_rows"))).alias("rmse"),
        "mae",
    )
