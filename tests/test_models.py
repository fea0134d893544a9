"""Model stage: determinism, selection, search, persistence, runs, stream."""

import uuid

from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from barloom.checks import spark_queries as Q
from barloom.operators import features, models
from barloom.plans import runs
from barloom.sources import bars, payload
from barloom.sources import layers as io
from barloom.streaming import ingest
from conftest import SF0001


def _scaled(spark):
    return features.scale_features(Q._features(spark, SF0001)).cache()


def test_linear_deterministic_and_sane(spark):
    df = _scaled(spark)
    a = models.score(models.fit(df, "linear_regression"), df.where("split = 'val'"))
    b = models.score(models.fit(df, "linear_regression"), df.where("split = 'val'"))
    assert a.exceptAll(b).count() == 0
    m = models.metrics_row(a)
    assert m["mae"] >= 0 and m["rmse"] >= m["mae"]


def test_select_best_and_persist(spark, tmp_path):
    df = _scaled(spark)
    table, fitted = models.train_all(spark, df, names=["linear_regression", "gradient_boosting"])
    rows = table.orderBy("mae", "ordinal").collect()
    best = models.best(table).first()
    assert best.model == rows[0].model
    path = str(tmp_path / "model")
    models.save_model(fitted[best.model], path, {"model_type": best.model})
    loaded, meta = models.load_model(path)
    assert meta["model_type"] == best.model
    x = models.score(loaded, df).exceptAll(models.score(fitted[best.model], df)).count()
    assert x == 0


def test_random_search_small_grid(spark):
    df = _scaled(spark)
    est = GBTRegressor(featuresCol="features", labelCol=models.LABEL, seed=42)
    space = {"gbt": (est, {"maxIter": [3, 5], "maxDepth": [2, 3]})}
    table, best = models.random_search(spark, df, n_iter=3, space=space)
    r = table.first()
    assert r.model == "gbt" and set(r.best_params) == {"maxIter", "maxDepth"}
    assert best is not None


def test_folds_contiguous(spark):
    f = features.folds(Q._features(spark, SF0001))
    per = f.groupBy("series_key", "fold").agg(F.min("date").alias("lo"), F.max("date").alias("hi")).collect()
    by = {}
    for r in per:
        by.setdefault(r.series_key, {})[r.fold] = r
    for folds in by.values():
        assert folds[0].hi < folds[1].lo and folds[1].hi < folds[2].lo


def _status(df):
    return {r.stage: r.status for r in df.collect()}


def _layer(spark, path):
    return io.read_layer(spark, path)


def _predictions(spark, root):
    return {(r.series_key, r.date): r.y_pred for r in _layer(spark, f"{root}/predictions").collect()}


def test_layer_schemas_are_what_is_written(spark):
    from barloom import schemas
    kinds = lambda t: {f.name: f.dataType for f in t.fields}
    assert kinds(Q._silver(spark, SF0001).schema) == kinds(schemas.silver_schema())
    assert kinds(Q._gold(spark, SF0001).schema) == kinds(schemas.gold_schema())
    assert kinds(Q._features(spark, SF0001).schema) == kinds(schemas.features_schema())


def test_runs_keep_model_and_scaler_together(spark, tmp_path):
    """historical -> daily -> monthly on other data -> daily: what the monthly
    run fits leaves the stored model's predictions as they were."""
    pages = payload.fixture_pages(bars.lineitem_bars(spark, SF0001).where("series_key IN ('A-F', 'R-F')"))
    older = pages.where("page_no >= 1")
    root = str(tmp_path / "lake")
    st = _status(runs.run(spark, "historical", older, root, model_names=["linear_regression"]))
    assert st["overall"] == "success", st
    assert _status(runs.run(spark, "daily", older, root))["overall"] == "success"
    before = _predictions(spark, root)
    grid = {"gbt": (GBTRegressor(featuresCol="features", labelCol=models.LABEL, seed=42), {"maxIter": [2]})}
    st = _status(runs.run(spark, "monthly", older, root, search={"space": grid, "n_iter": 1}))
    assert st["overall"] == "success", st
    st = _status(runs.run(spark, "daily", older, root))
    assert st["overall"] == "success", st
    assert _predictions(spark, root) == before
    # a failed training leaves the stored model in force, and is reported
    st = _status(runs.run(spark, "weekly", older, root, model_names=["no such learner"]))
    assert st["train"] == "failed" and st["evaluate"] == "success" and st["overall"] == "partial_success"
    # new pages add a series that the model has not seen: it is scored and marked
    more = payload.fixture_pages(bars.lineitem_bars(spark, SF0001).where("series_key IN ('A-F', 'N-O')"))
    assert _status(runs.run(spark, "daily", more, root))["overall"] == "success"
    last = {r.series_key: r.status for r in _layer(spark, f"{root}/predictions").where("series_key = 'N-O'").collect()}
    assert last == {"N-O": "untrained_series"}
    names = {r.run_name for r in spark.read.parquet(f"{root}/model_runs").collect()}
    assert {"baseline_linear_regression", "evaluation", "prediction", "tuning_gbt"} <= names
    meta = models.load_model(f"{root}/model")[1]
    assert len(meta["feature_names"]) == 35 and meta["training_date"]
    for doc in ["features_config", "evaluation_results", "tuning_metadata"]:
        assert io.read_json_record(spark, f"{root}/{doc}")
    for table in ["features_correlation", "residual_histogram", "axis_limits", "silver_summary", "gold_summary",
                  "tuning_results"]:
        assert spark.read.parquet(f"{root}/{table}").count() > 0
    assert spark.read.parquet(f"{root}/pipeline_runs").where("stage = 'overall'").count() == 6


def test_scoring_keeps_rows_without_features(spark):
    df = _scaled(spark)
    model = models.fit(df, "linear_regression", ["close", "rsi"])
    holes = df.withColumn("rsi", F.when(F.col("series_key") != "A-F", F.col("rsi")))
    out = models.score(model, holes)
    assert out.count() == df.count()
    by = {(r.status, r.none): r["count"] for r in
          out.groupBy("status", F.col("y_pred").isNull().alias("none")).count().collect()}
    assert set(by) == {("scored", False), ("missing_features", True)}
    rows, metrics = models.evaluate(model, holes)
    assert rows.count() == df.where("split = 'test'").count()
    assert metrics.first().n == rows.where("status = 'scored'").count()


def test_stream_replay_appends_nothing(spark, tmp_path):
    root = str(tmp_path / f"s{uuid.uuid4().hex}")
    docs = payload.fixture_pages(bars.lineitem_bars(spark, SF0001))
    ingest.land_pages(docs, f"{root}/landing")
    ingest.ingest_stream(spark, f"{root}/landing", f"{root}/bronze", f"{root}/ck1").awaitTermination()
    n1 = _layer(spark, f"{root}/bronze").count()
    # a fresh checkpoint re-reads every file: nothing new may be appended
    ingest.ingest_stream(spark, f"{root}/landing", f"{root}/bronze", f"{root}/ck2").awaitTermination()
    assert _layer(spark, f"{root}/bronze").count() == n1
    batch = payload.assemble_history(payload.normalize_ohlcv(docs, extra_cols=["page_no"]))
    assert batch.count() == n1
