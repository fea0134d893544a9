"""Model stage on ``pyspark.ml``.

Learners are fitted on the scaled feature table (one row per bar, a
``split`` column, features assembled into one vector).  Training, scoring
and metrics are distributed ML / DataFrame jobs; the driver only holds
parameter maps and one metrics row per model.

Settings mapped from the reference learners (fixed values):
* linear regression: ordinary least squares;
* random forest: 100 trees, all features per split, unlimited depth (30 is
  Spark's cap), seed 42;
* gradient boosting: 100 rounds, depth 3, rate 0.1, seed 42;
* second boosting config: 200 rounds, depth 6, rate 0.1, row and column
  sampling 0.8, seed 42 (re-aimed onto Spark's GBT; a different learner).
Search grids (10 draws without replacement, 3 contiguous folds, MAE):
* forest: trees 100/200/300/500, depth none/5/10/20, min split 2/5/10;
* boosting: rounds 100/200/300, rate 0.01/0.05/0.1, depth 3/5/7;
* second boosting: rounds 100/200/500, rate 0.01/0.05/0.1, depth 3/6/10,
  row sample 0.6/0.8/1.0, column sample 0.6/0.8/1.0.
"""

from __future__ import annotations

import itertools
import random
import uuid
from datetime import datetime, timezone
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import KEY, MODEL_RUNS_SCHEMA, SCALER_SCHEMA, TS, feature_columns
from ..sources import layers as io
from . import features, stats

LABEL = "target_close"
SEED = 42
UNLIMITED_DEPTH = 30  # Spark's maximum tree depth stands in for "no limit"
# Deep trees: split more nodes per pass over the data and keep node ids
# cached (checkpointed every 10 rounds) instead of re-deriving them.
TASK_ROWS = 50_000  # training rows of one task
DEEP_TREE_CONF = {"maxMemoryInMB": 512, "cacheNodeIds": True, "checkpointInterval": 10}


def learners() -> dict:
    """K2-K5 in the reference's order (ties in MAE go to the earlier one)."""
    return {
        "linear_regression": LinearRegression(featuresCol="features", labelCol=LABEL),
        "random_forest": RandomForestRegressor(featuresCol="features", labelCol=LABEL, numTrees=100,
                                               featureSubsetStrategy="all", maxDepth=UNLIMITED_DEPTH,
                                               seed=SEED, **DEEP_TREE_CONF),
        "gradient_boosting": GBTRegressor(featuresCol="features", labelCol=LABEL, maxIter=100,
                                          maxDepth=3, stepSize=0.1, seed=SEED),
        "boosting_sampled": GBTRegressor(featuresCol="features", labelCol=LABEL, maxIter=200,
                                         maxDepth=6, stepSize=0.1, subsamplingRate=0.8,
                                         featureSubsetStrategy="0.8", seed=SEED),
    }


def assembler(cols: list[str]) -> VectorAssembler:
    # a training row with a missing feature is an error; scoring sets such
    # rows apart before it assembles them (see score)
    return VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="error")


def fit(df: DataFrame, name: str, cols: list[str] | None = None) -> PipelineModel:
    """Fit one learner on the train rows (K2-K5)."""
    cols = cols or feature_columns(df.columns)
    train = df.where(F.col("split") == "train")
    return Pipeline(stages=[assembler(cols), learners()[name]]).fit(train)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Batch scoring -> ``series_key, date, y_true, y_pred, status``.
    Every row comes back: one that lacks a feature has a null ``y_pred`` and
    the status ``missing_features``, the others ``scored``."""
    inputs = model.stages[0].getInputCols()
    missing = F.lit(False)
    for c in inputs:
        missing = missing | F.col(c).isNull() | F.isnan(F.col(c).cast("double"))
    rows = df.select(KEY, TS, F.col(LABEL).alias("y_true"), missing.alias("_missing"),
                     *[F.when(missing, F.lit(0.0)).otherwise(F.col(c)).alias(c) for c in inputs])
    return model.transform(rows).select(
        KEY, TS, "y_true", F.when(~F.col("_missing"), F.col("prediction")).alias("y_pred"),
        F.when(F.col("_missing"), F.lit("missing_features")).otherwise(F.lit("scored")).alias("status"))


def metrics_row(scored: DataFrame) -> dict:
    """D9 over the scored rows as a small dict (one aggregate row)."""
    r = stats.regression_metrics(scored.where("y_pred IS NOT NULL AND y_true IS NOT NULL")).first()
    return {"mae": r.mae, "rmse": r.rmse, "r2": r.r2}


def assembled(df: DataFrame, cols: list[str]) -> DataFrame:
    """The rows of ``df`` with one vector column, in (series, time) order and
    in as few partitions as their number needs: a tree learner runs several
    jobs for each level of a tree, so partitions of a few rows cost more than
    the work in them."""
    rows = assembler(cols).transform(df).select(KEY, TS, "features", LABEL)
    tasks = max(1, -(-df.count() // TASK_ROWS))
    return rows.repartitionByRange(tasks, KEY, TS).sortWithinPartitions(KEY, TS)


def train_all(spark: SparkSession, df: DataFrame, names: list[str] | None = None,
              cols: list[str] | None = None) -> tuple[DataFrame, dict]:
    """K6: fit every learner, score on val, return the metrics table
    (ordinal, model, mae, rmse, r2) and the fitted models.  The learners share
    one assembled copy of the train rows and are fitted at the same time, so
    the short jobs of one fill the gaps between those of another."""
    names = names or list(learners())
    cols = cols or feature_columns(df.columns)
    ready = assembled(df.where(F.col("split") == "train"), cols).persist()
    val = df.where(F.col("split") == "val")
    val = val.coalesce(max(1, -(-val.count() // TASK_ROWS))).persist()

    def one(name: str):
        model = PipelineModel([assembler(cols), learners()[name].fit(ready)])
        return model, metrics_row(score(model, val))

    try:
        with ThreadPool(len(names)) as pool:
            done = pool.map(inheritable_thread_target(spark)(one), names)
    finally:
        ready.unpersist()
        val.unpersist()
    rows = [(i, name, *metrics.values()) for i, (name, (_, metrics)) in enumerate(zip(names, done))]
    table = spark.createDataFrame(rows, "ordinal int, model string, mae double, rmse double, r2 double")
    return table, {name: model for name, (model, _) in zip(names, done)}


def best(table: DataFrame) -> DataFrame:
    """Lowest MAE, the earlier model wins ties."""
    return stats.argmin_row(table, "mae", "ordinal")


SCALER, PIPELINE, METADATA, SERIES = "scaler", "pipeline", "metadata", "series"


def save_model(model: PipelineModel, path: str, metadata: dict, scaler: DataFrame | None = None,
               series: DataFrame | None = None) -> None:
    """One folder holds all that scoring needs: the pipeline, the
    scaler parameters its features were scaled with, the series it was trained
    on and the metadata.  A new version of the folder takes over at once."""
    spark = SparkSession.getActiveSession()
    version = f"v-{uuid.uuid4().hex}"
    at = f"{path}/{version}"
    model.write().save(f"{at}/{PIPELINE}")
    if scaler is not None:
        scaler.select(*SCALER_SCHEMA.fieldNames()).coalesce(1).write.parquet(f"{at}/{SCALER}")
    if series is not None:
        series.select(KEY).distinct().write.parquet(f"{at}/{SERIES}")
    record = {"training_date": datetime.now(timezone.utc).isoformat(),
              "feature_names": list(model.stages[0].getInputCols()), **metadata}
    io.write_json_record(spark, record, f"{at}/{METADATA}")
    io.publish(spark, path, version)


def load_model(path: str) -> tuple[PipelineModel, dict]:
    """The pipeline and its metadata."""
    spark = SparkSession.getActiveSession()
    at = _version(spark, path)
    return PipelineModel.load(f"{at}/{PIPELINE}"), io.read_json_record(spark, f"{at}/{METADATA}")


def _version(spark: SparkSession, path: str) -> str:
    at = io.current_version(spark, path)
    if at is None:
        raise FileNotFoundError(f"no model at {path}")
    return at


def load_scaler(path: str) -> DataFrame:
    """The scaler parameters saved with the model at ``path``."""
    spark = SparkSession.getActiveSession()
    return spark.read.schema(SCALER_SCHEMA).parquet(f"{_version(spark, path)}/{SCALER}")


def load_series(path: str) -> DataFrame:
    """The series that the model at ``path`` was trained on."""
    spark = SparkSession.getActiveSession()
    return spark.read.schema(f"{KEY} string").parquet(f"{_version(spark, path)}/{SERIES}")


def mark_untrained(scored: DataFrame, series: DataFrame) -> DataFrame:
    """Status ``untrained_series`` for scored rows of a series that the model
    has not seen; their prediction stands, from the pooled scaling."""
    known = series.select(F.col(KEY).alias("_series"), F.lit(True).alias("_known"))
    return (scored.join(known, F.col(KEY).eqNullSafe(F.col("_series")), "left").drop("_series")
            .withColumn("status", F.when((F.col("status") == "scored") & F.col("_known").isNull(),
                                         F.lit("untrained_series")).otherwise(F.col("status")))
            .drop("_known"))


def log_run(spark: SparkSession, path: str, run_name: str, params: dict, metrics: dict) -> None:
    """Append one row to the ``model_runs`` table."""
    row = (run_name, {k: str(v) for k, v in params.items()},
           {k: float(v) for k, v in metrics.items() if v is not None},
           datetime.now(timezone.utc).replace(tzinfo=None))
    spark.createDataFrame([row], MODEL_RUNS_SCHEMA).write.mode("append").parquet(path)


# ------------------------------------------------------------------ search
def search_space() -> dict:
    return {
        "random_forest": (RandomForestRegressor(featuresCol="features", labelCol=LABEL, seed=SEED,
                                                featureSubsetStrategy="all", **DEEP_TREE_CONF),
                          {"numTrees": [100, 200, 300, 500], "maxDepth": [UNLIMITED_DEPTH, 5, 10, 20],
                           "minInstancesPerNode": [2, 5, 10]}),
        "gradient_boosting": (GBTRegressor(featuresCol="features", labelCol=LABEL, seed=SEED),
                              {"maxIter": [100, 200, 300], "stepSize": [0.01, 0.05, 0.1],
                               "maxDepth": [3, 5, 7]}),
        "boosting_sampled": (GBTRegressor(featuresCol="features", labelCol=LABEL, seed=SEED),
                             {"maxIter": [100, 200, 500], "stepSize": [0.01, 0.05, 0.1],
                              "maxDepth": [3, 6, 10], "subsamplingRate": [0.6, 0.8, 1.0],
                              "featureSubsetStrategy": ["0.6", "0.8", "1.0"]}),
    }


def sample_grid(est, grid: dict, n_iter: int, seed: int = SEED) -> list[dict]:
    """K7: ``n_iter`` distinct parameter maps drawn without replacement."""
    names = list(grid)
    combos = list(itertools.product(*[grid[n] for n in names]))
    picks = random.Random(seed).sample(combos, min(n_iter, len(combos)))
    maps = []
    for combo in picks:
        maps.append({est.getParam(n): v for n, v in zip(names, combo)})
    return maps


def random_search(spark: SparkSession, df: DataFrame, n_iter: int = 10, folds: int = 3,
                  families: list[str] | None = None, parallelism: int = 4,
                  cols: list[str] | None = None,
                  space: dict | None = None) -> tuple[DataFrame, PipelineModel | None]:
    """Per family, cross-validated random search on the train
    rows (contiguous folds, MAE), refit on all train rows, scored on val.
    Returns the summary table (model, best_params, mae, rmse, r2) and the
    overall best model (lowest val MAE, earlier family wins ties)."""
    cols = cols or feature_columns(df.columns)
    space = space or search_space()
    families = list(space) if families is None else families
    train = features.folds(df, folds)
    val = df.where(F.col("split") == "val")
    va = assembler(cols)
    train_v = va.transform(train)
    rows, best_model, best_mae = [], None, float("inf")
    for fam in families:
        est, grid = space[fam]
        maps = sample_grid(est, grid, n_iter)
        cv = CrossValidator(estimator=est, estimatorParamMaps=maps, numFolds=folds, foldCol="fold",
                            evaluator=RegressionEvaluator(labelCol=LABEL, metricName="mae"),
                            parallelism=parallelism, seed=SEED)
        cvm = cv.fit(train_v)
        model = PipelineModel(stages=[va, cvm.bestModel])
        m = metrics_row(score(model, val))
        best_idx = min(range(len(cvm.avgMetrics)), key=lambda i: (cvm.avgMetrics[i], i))
        params = {p.name: str(v) for p, v in maps[best_idx].items()}
        rows.append((fam, params, m["mae"], m["rmse"], m["r2"]))
        if m["mae"] < best_mae:
            best_model, best_mae = model, m["mae"]
    table = spark.createDataFrame(rows, "model string, best_params map<string,string>, "
                                        "mae double, rmse double, r2 double")
    return table, best_model


# ---------------------------------------------------------- evaluate/predict
def evaluate(model: PipelineModel, df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Test-split rows ``date, y_true, y_pred, residual`` (with the
    real date) and their metrics."""
    rows = residual_rows(score(model, df.where(F.col("split") == "test")))
    return rows, stats.regression_metrics(rows.where("residual IS NOT NULL"))


def residual_rows(scored: DataFrame) -> DataFrame:
    """Scored rows with their residual."""
    return scored.withColumn("residual", F.col("y_true") - F.col("y_pred"))


def predict_latest(model: PipelineModel, df: DataFrame, prediction_ts=None) -> DataFrame:
    """The newest test row of every series scored:
    ``series_key, date, y_true, y_pred, status, prediction_date``."""
    w = Window.partitionBy(KEY).orderBy(F.col(TS).desc())
    last = df.where(F.col("split") == "test").withColumn("_rk", F.row_number().over(w)).where("_rk = 1")
    ts = F.lit(prediction_ts) if prediction_ts is not None else F.current_timestamp()
    return score(model, last.drop("_rk")).withColumn("prediction_date", ts.cast("timestamp_ntz"))
