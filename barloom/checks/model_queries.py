"""Rows-only queries for the model stage (no SQL oracle: learners are
checked by determinism and sanity in ``tests/test_models.py``).

The random search (K7: 10 draws x 3 folds for each family, up to 500 rounds) is a
library function covered by the tests on small grids; it is not registered here
because a full search takes tens of minutes on one machine.  The selection rule
itself (D7) is registered with
SQL as ``best_model``."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..operators import features, models, segments
from . import spark_queries as Q


def _scaled(spark, sf):
    """The scaled features, written once as a run writes them."""
    return segments.written(features.scale_features(Q._features(spark, sf)))


def _train_one(name):
    def q(spark, sf):
        df = _scaled(spark, sf)
        table, _ = models.train_all(spark, df, names=[name])
        return table
    return q


def q_train_all(spark, sf):
    table, _ = models.train_all(spark, _scaled(spark, sf))
    return models.best(table)


def q_evaluate(spark, sf):
    df = _scaled(spark, sf)
    m = models.fit(df, "linear_regression")
    rows, _ = models.evaluate(m, df)
    return rows


def q_predict_latest(spark, sf):
    df = _scaled(spark, sf)
    m = models.fit(df, "linear_regression")
    return models.predict_latest(m, df, prediction_ts=datetime(2026, 1, 1))


QUERIES = {
    "train_linear": _train_one("linear_regression"),
    "train_forest": _train_one("random_forest"),
    "train_gbt": _train_one("gradient_boosting"),
    "train_gbt_sampled": _train_one("boosting_sampled"),
    "train_all": q_train_all,
    "evaluate": q_evaluate,
    "predict_latest": q_predict_latest,
}

__all__ = ["QUERIES", "F"]
