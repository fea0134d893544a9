"""Composed runs (L3-L9): ingest, layers, features, models, status table.

``run(mode)`` executes the stages of a daily / weekly / monthly /
historical run in order and appends one status row per stage to the
``pipeline_runs`` table.  An ingest, layer or feature failure stops the run
(``error``); a model-stage failure gives ``partial_success``; evaluation
still runs after a failed training.  Every layer is written before the next
stage reads it, which also cuts the lineage of the long window plans.

Features are stored unscaled.  A training run fits a pooled scaler on them and
saves it inside the model's folder; evaluation and prediction scale with what
the model they load was saved with, whatever other runs have fitted since.
"""

from __future__ import annotations

import os
import traceback
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features, models, stats
from ..schemas import (BRONZE_SCHEMA, feature_columns, features_schema, gold_schema, silver_schema, target_columns)
from ..sources import layers as io
from ..sources import payload
from . import long_layers

RUN_SCHEMA = ("run_id string, mode string, stage string, status string, rows long, "
              "error string, finished_at timestamp")


@dataclass
class Paths:
    root: str

    def __getattr__(self, name: str) -> str:
        return os.path.join(self.root, name)


def ingest(spark: SparkSession, mode: str, pages: DataFrame, bronze_path: str) -> int:
    """L4: ``historical`` replaces Bronze with the assembled pages (A8 -> A6);
    otherwise the new rows are appended, stored rows win (A7).  Pages that
    could not be read go to the quarantine table."""
    if payload.CORRUPT in pages.columns:
        bad = payload.corrupt_pages(pages).withColumn("found_at", F.current_timestamp())
        if not bad.isEmpty():
            bad.write.mode("append").parquet(bronze_path + "_quarantine")
    rows = payload.normalize_ohlcv(pages, extra_cols=["page_no"])
    if mode == "historical":
        return io.write_layer(payload.assemble_history(rows), bronze_path)
    return io.append_bronze(spark, payload.assemble_history(rows), bronze_path)


def feature_stage(spark: SparkSession, gold_path: str, features_path: str) -> DataFrame:
    """L3: B5 -> E18(3) -> E19 -> E20; writes the features (A5), their config
    (A15) and correlations (D8) and returns the stored rows."""
    gold = io.read_layer(spark, gold_path, gold_schema(), missing_ok=False)
    io.write_layer(long_layers.build_features(gold), features_path)
    feats = io.read_layer(spark, features_path, features_schema(), missing_ok=False)
    names = feature_columns(feats.columns)
    io.write_json_record(spark, {"feature_columns": names, "target_columns": target_columns(feats.columns),
                                 "num_features": len(names), "created_at": _now()}, features_path + "_config")
    stats.correlation(feats, names + target_columns(feats.columns)).write.mode("overwrite").parquet(
        features_path + "_correlation")
    return feats


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def fitted_scaler(feats: DataFrame) -> DataFrame:
    """Pooled parameters (one row a feature): one model serves all series, so
    the features keep the price level that the target has."""
    return features.fit_scaler(feats, by_key=False).checkpoint()


def scaled(feats: DataFrame, params: DataFrame) -> DataFrame:
    return features.apply_scaler(feats, params, by_key=False)


def train_stage(spark: SparkSession, feats: DataFrame, p: Paths, names: list[str] | None = None) -> int:
    """Fit all learners, save the best with its scaler."""
    params = fitted_scaler(feats)
    ready = scaled(feats, params).persist()
    try:
        table, fitted = models.train_all(spark, ready, names=names)
        best = models.best(table).first()
        models.save_model(fitted[best.model], p.model, {"model_type": best.model, "metrics": best.asDict()}, params, feats)
        rows = table.collect()  # a row for each learner
        for r in rows:
            models.log_run(spark, p.model_runs, f"baseline_{r.model}", {"model": r.model},
                           {"mae": r.mae, "rmse": r.rmse, "r2": r.r2})
        return len(rows)
    finally:
        ready.unpersist()


def search_stage(spark: SparkSession, feats: DataFrame, p: Paths, families: list[str] | None = None,
                 **search) -> int:
    """Random search; saves the best model with its scaler, the
    tuning results and their metadata, and logs a run for each family."""
    params = fitted_scaler(feats)
    ready = scaled(feats, params).persist()
    try:
        table, best_model = models.random_search(spark, ready, families=families, **search)
        table = table.persist()
        table.write.mode("overwrite").parquet(p.tuning_results)
        rows = table.collect()  # a row for each family
        for r in rows:
            models.log_run(spark, p.model_runs, f"tuning_{r.model}", dict(r.best_params),
                           {"mae": r.mae, "rmse": r.rmse, "r2": r.r2})
        if best_model is not None:
            best = min(rows, key=lambda r: r.mae)
            record = {"model_type": best.model, "best_params": dict(best.best_params), "tuned_at": _now(),
                      "metrics": {"mae": best.mae, "rmse": best.rmse, "r2": best.r2}}
            models.save_model(best_model, p.tuned_model, record, params, feats)
            io.write_json_record(spark, record, p.tuning_metadata)
        return len(rows)
    finally:
        ready.unpersist()


def evaluate_stage(spark: SparkSession, feats: DataFrame, p: Paths) -> int:
    """Score the test rows with the saved model and its
    own scaler; rows, metrics document, histogram and axis limits."""
    model, meta = models.load_model(p.model)
    rows, metrics = models.evaluate(model, scaled(feats, models.load_scaler(p.model)))
    n = io.write_layer(models.mark_untrained(rows, models.load_series(p.model)), p.eval_predictions)
    m = metrics.first()
    found = {"mae": m.mae, "rmse": m.rmse, "r2": m.r2}
    models.log_run(spark, p.model_runs, "evaluation", {"model": meta.get("model_type")}, found)
    io.write_json_record(spark, {"evaluation_date": _now(), "model_type": meta.get("model_type"),
                                 "test_metrics": found, "test_samples": m.n}, p.evaluation_results)
    stored = io.read_layer(spark, p.eval_predictions, rows.schema)
    stats.residual_histogram(stored).write.mode("overwrite").parquet(p.residual_histogram)
    stats.axis_limits(stored).write.mode("overwrite").parquet(p.axis_limits)
    return n


def predict_stage(spark: SparkSession, feats: DataFrame, p: Paths) -> int:
    """Score the newest row of every series and merge it into
    the stored predictions."""
    model, meta = models.load_model(p.model)
    new = models.predict_latest(model, scaled(feats, models.load_scaler(p.model)))
    new = models.mark_untrained(new, models.load_series(p.model)).checkpoint()
    old = io.read_layer(spark, p.predictions, schema=new.schema)
    merged = io.upsert(old, new, keep="new", order_col="prediction_date").checkpoint()
    io.write_layer(merged, p.predictions)
    counts = {r.status: r["count"] for r in new.groupBy("status").count().collect()}  # a row for each status
    models.log_run(spark, p.model_runs, "prediction", {"model": meta.get("model_type")}, counts)
    return new.count()


def summary_stage(df: DataFrame, path: str) -> None:
    """The summary of a layer beside it."""
    stats.layer_summary(df).write.mode("overwrite").parquet(path + "_summary")


STAGES = {
    "daily": ["ingest", "silver", "gold", "features", "predict"],
    "weekly": ["ingest", "silver", "gold", "features", "train", "evaluate"],
    "monthly": ["ingest", "silver", "gold", "features", "search"],
    "historical": ["ingest", "silver", "gold", "features", "train", "evaluate"],
}
MODEL_STAGES = {"train", "evaluate", "predict", "search"}


def run(spark: SparkSession, mode: str, pages: DataFrame, root: str,
        model_names: list[str] | None = None, search_families: list[str] | None = None,
        search: dict | None = None) -> DataFrame:
    """Run every stage of ``mode``; returns this run's status rows."""
    p = Paths(root)
    run_id = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    status: list[tuple] = []
    state: dict = {}

    def stage(name: str) -> int:
        if name == "ingest":
            return ingest(spark, "historical" if mode == "historical" else "incremental", pages, p.bronze)
        if name == "silver":
            bronze = io.read_layer(spark, p.bronze, schema=BRONZE_SCHEMA)
            n = io.write_layer(long_layers.build_silver(bronze), p.silver)
            summary_stage(io.read_layer(spark, p.silver, silver_schema()), p.silver)
            return n
        if name == "gold":
            stored = io.read_layer(spark, p.silver, silver_schema(), missing_ok=False)
            n = io.write_layer(long_layers.build_gold(stored), p.gold)
            summary_stage(io.read_layer(spark, p.gold, gold_schema()), p.gold)
            return n
        if name == "features":
            state["features"] = feature_stage(spark, p.gold, p.features)
            return state["features"].count()
        if name == "train":
            return train_stage(spark, state["features"], p, model_names)
        if name == "search":
            return search_stage(spark, state["features"], p, search_families, **(search or {}))
        if name == "evaluate":
            return evaluate_stage(spark, state["features"], p)
        if name == "predict":
            return predict_stage(spark, state["features"], p)
        raise ValueError(name)

    failed = False
    for name in STAGES[mode]:
        if failed and name not in MODEL_STAGES:
            break
        try:
            n = stage(name)
            status.append((run_id, mode, name, "success", int(n), None))
        except Exception as e:  # noqa: BLE001 - recorded in the status table
            status.append((run_id, mode, name, "failed", None, "".join(traceback.format_exception_only(e))))
            if name not in MODEL_STAGES:
                failed = True
                break
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    rows = [(*s, now) for s in status]
    bad = [s for s in status if s[3] != "success"]
    overall = "success" if not bad else ("error" if failed else "partial_success")
    rows.append((run_id, mode, "overall", overall, None, None, now))
    out = spark.createDataFrame(rows, RUN_SCHEMA)
    out.write.mode("append").parquet(p.pipeline_runs)
    return out.orderBy(F.col("finished_at"))
