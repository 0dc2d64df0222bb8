"""Fit and score the demand models on the combined table, and show the
results (the counterpart of a modelling script).

    python -m zonecast.plans.fit <sf_dir> [--with-passengers]

Prints the ridge grid (mean validation MSE per alpha), the refit ridge's
coefficients, R^2 / MSE per split for the ridge and for the regression tree.
Only these small result tables are shown; all fitting runs on Spark.
`--with-passengers` adds `hourly_passengers` to both feature lists: it is
summed over the same trips as the label, so it is a close proxy for it and
is off by default.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.operators import models, trees
from zonecast.plans.queries_models import RIDGE_FEATURES, TREE_FEATURES, model_input


def fit_all(spark: SparkSession, sf_dir: str,
            with_passengers: bool = False) -> dict[str, DataFrame]:
    """Ridge grid + refit + metrics, tree fit + metrics, over one
    materialised model input."""
    extra = ("hourly_passengers",) if with_passengers else ()
    ridge_features, tree_features = RIDGE_FEATURES + extra, TREE_FEATURES + extra
    data = model_input(spark, sf_dir)
    train = data.where(F.col("split") == "train")
    grid, ridge = models.ridge_search(train, ridge_features)
    tree = trees.fit(train, tree_features)
    return {
        "ridge_grid": models.grid_frame(spark, grid),
        "ridge_coefficients": models.coefficients_frame(spark, ridge),
        "ridge_metrics": models.regression_metrics(data, models.LABEL, ridge.predict()),
        "tree_metrics": models.regression_metrics(
            trees.predict(data, tree), models.LABEL, "prediction"),
    }


def main(argv: list[str]) -> None:
    from zonecast.session import local_session

    if not argv:
        raise SystemExit(__doc__)
    spark = local_session()
    for name, df in fit_all(spark, argv[0], "--with-passengers" in argv[1:]).items():
        print(name)
        df.show(truncate=False)


if __name__ == "__main__":
    main(sys.argv[1:])
