"""Registered model queries (M1-M9) over the combined zone-hour table.

Label `pu_hourly`. The SQL-checkable ridge uses two features, one of small
and one of large variance; the trees use five. The fixture covers one month,
so the temporal split (M2) is by day of month: days before SPLIT_DAY train
(and validate, by hash bucket), all other days test. Values are rounded here,
in the queries, so that both engines print the same digits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.operators import models, qr, trees
from zonecast.plans import demand
from zonecast.plans.fixture_args import SPLIT_DAY
from zonecast.plans.registry import query
from zonecast.session import scratch_path

RIDGE_FEATURES = ("hour", "hourly_ridership")
FULL_FEATURES = ("locationid", "dayofmonth", "dayofweek", "hour", "hourly_ridership")
STEP_FEATURES = ("hour", "dayofweek")
TREE_FEATURES = ("locationid", "dayofmonth", "dayofweek", "hour", "hourly_ridership")


def model_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The combined table with split and fold columns, written once to the
    shared folder, partitioned by split: every model query runs several small
    jobs over it, each reading its split and columns only."""
    df = models.with_splits(demand.combined(spark, sf_dir),
                            train_period=F.col("dayofmonth") < SPLIT_DAY)
    path = scratch_path(spark, "model_input")
    df.write.partitionBy("split").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _ridge(spark: SparkSession, sf_dir: str):
    data = model_input(spark, sf_dir)
    train = data.where(F.col("split") == "train")
    grid, fit = models.ridge_search(train, RIDGE_FEATURES)
    return data, grid, fit


@query("train_val_split")
def q_train_val_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = models.with_splits(demand.combined(spark, sf_dir),
                            train_period=F.col("dayofmonth") < SPLIT_DAY)
    return df.select(*models.ROW_KEY, "bucket", "split", "fold")


@query("ridge_grid_search")
def q_ridge_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = model_input(spark, sf_dir)
    grid = models.ridge_grid(data.where(F.col("split") == "train"), RIDGE_FEATURES)
    return models.grid_frame(spark, grid).withColumn("mean_mse", F.round("mean_mse", 6))


@query("ridge_coefficients")
def q_ridge_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, fit = _ridge(spark, sf_dir)
    return models.coefficients_frame(spark, fit).withColumn("value", F.round("value", 6))


@query("ridge_predictions")
def q_ridge_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    data, _, fit = _ridge(spark, sf_dir)
    return (data.where(F.col("split") == "validation")
            .select(*models.ROW_KEY, "pu_hourly",
                    F.round(fit.predict(), 6).alias("prediction")))


@query("regression_metrics")
def q_regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    data, _, fit = _ridge(spark, sf_dir)
    m = models.regression_metrics(data, models.LABEL, fit.predict())
    return m.select("split", "n", F.round("mse", 6).alias("mse"),
                    F.round("r2", 6).alias("r2"))


@query("ridge_full")
def q_ridge_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3 over the full feature set, at the smallest alpha of the grid."""
    train = model_input(spark, sf_dir).where(F.col("split") == "train")
    fit = models.fit_ridge(train, FULL_FEATURES, alpha=models.RIDGE_ALPHAS[0])
    return models.coefficients_frame(spark, fit).withColumn("value", F.round("value", 6))


# The two features, one of them again, and one that never changes.
REPEATED_FEATURES = ("hour", "hourly_ridership", "hour_again", "always")


@query("ridge_qr")
def q_ridge_qr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3 by QR on features of which one repeats another and one is constant,
    without a penalty (coefficients of least size) and with two."""
    train = model_input(spark, sf_dir).where(F.col("split") == "train").withColumns(
        {"hour_again": F.col("hour"), "always": F.lit(7.0)})
    f = qr.factors(train, REPEATED_FEATURES)
    rows = []
    for alpha in (0.0, 1.0, 15.0):
        w, b = qr.solve(f.without(), alpha)
        rows += [(alpha, term, round(float(v), 6) + 0.0) for term, v in zip(("intercept", *REPEATED_FEATURES), (b, *w))]
    return spark.createDataFrame(rows, "alpha double, term string, value double")


@query("ridge_search_qr")
def q_ridge_search_qr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4 by QR: the grid of `ridge_grid_search`, from one pass."""
    train = model_input(spark, sf_dir).where(F.col("split") == "train")
    grid, _ = qr.ridge_search_qr(train, RIDGE_FEATURES)
    return models.grid_frame(spark, grid).withColumn("mean_mse", F.round("mean_mse", 6))


@query("tree_predictions")
def q_tree_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8: a tree of depth 1 over features of few values; all rows scored."""
    data = model_input(spark, sf_dir)
    tree = trees.fit(data.where(F.col("split") == "train"), STEP_FEATURES, max_depth=1)
    scored = trees.predict(data, tree)
    return scored.select(*models.ROW_KEY, "split", F.round("prediction", 6).alias("prediction"))


@query("tree_training_error")
def q_tree_training_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8 at depths 1 and 2 on the same features: the error on the training
    rows. A tree of depth 2 holds the one of depth 1 as its upper nodes."""
    train = model_input(spark, sf_dir).where(F.col("split") == "train")
    ways = trees.descend(train, trees.fit(train, STEP_FEATURES, max_depth=2))
    out = None
    for depth in (1, 2):
        at = F.least(F.lit(depth), F.size("path") - 1)
        row = models.regression_metrics(ways, models.LABEL, F.get("path", at)["prediction"]).select(
            F.lit(depth).alias("max_depth"), "n", F.round("mse", 6).alias("mse"))
        out = row if out is None else out.unionByName(row)
    return out


@query("tree_depth_search")
def q_tree_depth_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9: the grid search over depths 1 and 2 on the same features."""
    train = model_input(spark, sf_dir).where(F.col("split") == "train")
    grid = trees.grid_search(train, STEP_FEATURES, criteria=("squared_error",), depths=(1, 2), min_splits=(2,))
    return grid.select("max_depth", F.lit(1).alias("min_instances"), F.round("mean_mse", 6).alias("mean_mse"))


@query("tree_metrics")
def q_tree_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8 with the library's defaults: a tree over all features, grown until
    no node can be cut, scored on every split."""
    data = model_input(spark, sf_dir)
    scored = trees.predict(data, trees.fit(data.where(F.col("split") == "train"), TREE_FEATURES))
    m = models.regression_metrics(scored, models.LABEL, "prediction")
    return m.select("split", "n", F.round("mse", 6).alias("mse"), F.round("r2", 6).alias("r2"))


@query("tree_grid_search")
def q_tree_grid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9: 3 criteria x depths 1-4 x minimum split sizes 2-9, 5 folds."""
    train = model_input(spark, sf_dir).where(F.col("split") == "train")
    return trees.grid_search(train, TREE_FEATURES).withColumn("mean_mse", F.round("mean_mse", 6))
