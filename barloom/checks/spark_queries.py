"""Spark side of the correctness gate: one query per operator.

Each query reads the supplied tables (through the bar adapters) and runs the
library operator on all rows.  Double columns are rounded to the
binary grid of ``duckdb_sql.GRID`` with the same arithmetic as the DuckDB
side (see there why the grid is binary).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import windows as W
from ..operators import clean, features, indicators, scan, stats
from ..plans import layers
from ..schemas import BRONZE_SCHEMA, GOLD_COLUMNS, KEY, MA_WINDOWS, PRICE_COLS, TS
from ..sources import bars, layers as io, payload

GRID = 16384.0

Query = Callable[[SparkSession, str], DataFrame]


def _half_away(y: Column) -> Column:
    """``y`` rounded to a whole number, halves away from zero as SQL's
    ``round`` does: ``rint`` takes them to the even one.  Spark's own ``round``
    goes through the decimal text of each value."""
    whole = F.rint(y)
    return F.when(F.abs(y - whole) == 0.5, y + F.signum(y) * 0.5).otherwise(whole)


def _on_grid(x: Column) -> Column:
    return _half_away(x * GRID) / GRID + 0.0


WIDE = 16  # doubles of a row whose rounding is still short enough in one method


def rnd(df: DataFrame) -> DataFrame:
    """Spark writes a projection of plain expressions as one method; for all
    columns of Gold that is longer than what the JVM compiles.  One that holds
    a function over an array is written in pieces: in a wide row the first
    double is rounded as the only element of one."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    grid = {c: _on_grid(F.col(c).cast("double")) for c in doubles}
    if len(doubles) > WIDE:
        grid[doubles[0]] = F.transform(F.array(F.col(doubles[0]).cast("double")), _on_grid)[0]
    return df.select(*[grid[c].alias(c) if c in grid else F.col(c) for c in df.columns])


# --------------------------------------------------------------- stages
def _text(spark, sf):
    return bars.text_bars(spark, sf)


def _coerced(spark, sf):
    return clean.coerce_types(_text(spark, sf))


def _filled(spark, sf):
    return clean.fill_missing(_coerced(spark, sf))


def _interp(spark, sf):
    return clean.interpolate_outliers(_filled(spark, sf))


def _repaired(spark, sf):
    return clean.repair_ohlc(_interp(spark, sf))


def _silver(spark, sf):
    return layers.silver(_text(spark, sf))


def _gold_ind(spark, sf):
    return layers.gold_indicators(_silver(spark, sf))


def _gold(spark, sf):
    return layers.gold(_silver(spark, sf))


def _features(spark, sf):
    return features.pipeline_features(_gold(spark, sf))


SILVER_OUT = ["open", "high", "low", "close", "volume", "daily_return", "price_range",
              "avg_price", "volume_millions", "day_of_week", "month", "year"]


def _pick(df: DataFrame, cols: list[str]) -> DataFrame:
    return rnd(df.select(KEY, TS, *cols))


# --------------------------------------------------------------- queries
def q_bars(spark, sf):
    return _pick(bars.lineitem_bars(spark, sf), ["open", "high", "low", "close", "volume"])


def q_event_bars(spark, sf):
    return _pick(bars.event_bars(spark, sf), ["open", "high", "low", "close", "volume"])


def q_coerce_types(spark, sf):
    return _pick(_coerced(spark, sf), ["open", "high", "low", "close", "volume"])


def q_ffill_bfill(spark, sf):
    return _pick(_filled(spark, sf), ["open", "high", "low", "close", "volume"])


def q_iqr_bounds(spark, sf):
    return rnd(clean.iqr_bounds(_filled(spark, sf)))


def q_outlier_counts(spark, sf):
    return clean.outlier_counts(_filled(spark, sf))


def q_outlier_interpolate(spark, sf):
    return _pick(_interp(spark, sf), ["open", "high", "low", "close", "volume"])


def q_ohlc_repair(spark, sf):
    return _pick(_repaired(spark, sf), ["open", "high", "low", "close", "volume"])


def q_log_return(spark, sf):
    return _pick(_silver(spark, sf), ["daily_return"])


def q_calendar_fields(spark, sf):
    return _pick(_silver(spark, sf), ["day_of_week", "month", "year"])


def q_silver(spark, sf):
    return _pick(_silver(spark, sf), SILVER_OUT)


def q_sma(spark, sf):
    w = W.series()
    df = _silver(spark, sf)
    return _pick(df.withColumns({f"sma_{n}": W.rolling_mean("close", w, n) for n in MA_WINDOWS}),
                 [f"sma_{n}" for n in MA_WINDOWS])


def q_price_sma_ratio(spark, sf):
    return _pick(indicators.moving_averages(_silver(spark, sf)),
                 [f"price_sma_ratio_{n}" for n in MA_WINDOWS])


def q_ema(spark, sf):
    df = scan.ema_columns(_silver(spark, sf), "close", {f"ema_{n}": n for n in MA_WINDOWS})
    return _pick(df, [f"ema_{n}" for n in MA_WINDOWS])


def q_rsi(spark, sf):
    return _pick(indicators.rsi(_silver(spark, sf)), ["rsi"])


def q_volatility(spark, sf):
    return _pick(indicators.volatility(_silver(spark, sf)), ["volatility_7", "volatility_14", "volatility_30"])


def q_true_range(spark, sf):
    return _pick(indicators.true_range(_silver(spark, sf)), ["true_range"])


def q_atr(spark, sf):
    return _pick(indicators.volatility(_silver(spark, sf)), ["atr_7", "atr_14", "atr_30"])


def q_roc(spark, sf):
    return _pick(indicators.momentum(_silver(spark, sf)), ["roc_7", "roc_14"])


def q_momentum(spark, sf):
    return _pick(indicators.momentum(_silver(spark, sf)), ["momentum_7", "momentum_14"])


def q_macd(spark, sf):
    return _pick(scan.macd(_silver(spark, sf)), ["macd", "macd_signal", "macd_histogram"])


def q_volume_indicators(spark, sf):
    return _pick(indicators.volume_indicators(_silver(spark, sf)),
                 ["volume_sma_7", "volume_sma_14", "volume_ratio_7", "volume_ratio_14"])


def q_obv(spark, sf):
    return _pick(indicators.volume_indicators(_silver(spark, sf)), ["obv"])


def q_targets(spark, sf):
    return _pick(indicators.targets(_silver(spark, sf)), ["target_close", "target_return", "target_direction"])


def q_gold_fill_drop(spark, sf):
    df = indicators.gold_fill_drop(_gold_ind(spark, sf))
    return _pick(df, indicators.technical_columns(GOLD_COLUMNS))


def q_gold(spark, sf):
    return rnd(_gold(spark, sf))


def q_feature_select(spark, sf):
    return rnd(features.select_features(_gold(spark, sf)))


def q_lags(spark, sf):
    return rnd(features.lags(features.select_features(_gold(spark, sf)), 3))


def q_rolling_features(spark, sf):
    df = features.lags(features.select_features(_gold(spark, sf)), 3)
    return rnd(features.rolling_features(df))


def q_split(spark, sf):
    return _features(spark, sf).select(KEY, TS, "split")


def q_folds(spark, sf):
    return features.folds(_features(spark, sf)).select(KEY, TS, "fold")


def q_scaler_robust(spark, sf):
    return rnd(features.fit_scaler(_features(spark, sf), kind="robust"))


def q_scaler_standard(spark, sf):
    return rnd(features.fit_scaler(_features(spark, sf), kind="standard"))


def q_scaled_features(spark, sf):
    return rnd(features.scale_features(_features(spark, sf)))


def q_correlation(spark, sf):
    df = _features(spark, sf)
    return rnd(stats.correlation(df, features.feature_columns(df.columns), key=KEY))


def q_describe(spark, sf):
    cols = ["open", "high", "low", "close", "volume", "daily_return"]
    return rnd(stats.describe(_silver(spark, sf), cols))


def q_null_counts(spark, sf):
    return stats.null_counts(_gold_ind(spark, sf), GOLD_COLUMNS)


def q_range_summary(spark, sf):
    return stats.range_summary(_silver(spark, sf))


def _naive_predictions(spark, sf):
    s = _silver(spark, sf)
    prev = F.lag("close", 1).over(W.series())
    return (s.select(KEY, TS, F.col("close").alias("y_true"), prev.alias("y_pred"))
             .where(F.col("y_pred").isNotNull())
             .withColumn("residual", F.col("y_true") - F.col("y_pred")))


def q_regression_metrics(spark, sf):
    return rnd(stats.regression_metrics(_naive_predictions(spark, sf), group=[KEY]))


def q_residual_histogram(spark, sf):
    return rnd(stats.residual_histogram(_naive_predictions(spark, sf), group=[KEY]))


def q_eval_rows(spark, sf):
    return rnd(_naive_predictions(spark, sf))


def q_best_model(spark, sf):
    g = _gold(spark, sf)
    cands = [("naive", "close"), ("sma_7", "sma_7"), ("ema_7", "ema_7"), ("ema_14", "ema_14")]
    preds = g.select(KEY, F.col("target_close").alias("y_true"),
                     F.inline(F.array(*[F.struct(F.lit(i).alias("ordinal"), F.lit(n).alias("model"),
                                                 F.col(c).alias("y_pred"))
                                        for i, (n, c) in enumerate(cands)])))
    m = stats.regression_metrics(preds, group=[KEY, "ordinal", "model"])
    return rnd(io.best_per_group(m, [KEY], "mae", "ordinal").drop("ordinal"))


def q_latest_bar(spark, sf):
    return rnd(io.latest(bars.lineitem_bars(spark, sf), 1))


def q_pool_argmax(spark, sf):
    docs = payload.fixture_pool_docs(bars.pools(spark, sf))
    return payload.best_pool(payload.normalize_pools(docs), group="network")


def q_bronze_upsert_keep_first(spark, sf):
    existing, new = io.fixture_deliveries(bars.lineitem_bars(spark, sf))
    return rnd(io.upsert(existing, new, keep="existing"))


def q_prediction_upsert_keep_last(spark, sf):
    old, new = io.fixture_predictions(_naive_predictions(spark, sf))
    return rnd(io.upsert(old, new, keep="new", order_col="prediction_date"))


def q_payload_normalize(spark, sf):
    docs = payload.fixture_pages(bars.lineitem_bars(spark, sf))
    return rnd(payload.normalize_ohlcv(docs, extra_cols=["page_no"]))


def q_pages_dedupe(spark, sf):
    docs = payload.fixture_pages(bars.lineitem_bars(spark, sf))
    return rnd(payload.assemble_history(payload.normalize_ohlcv(docs, extra_cols=["page_no"])))


QUERIES: dict[str, Query] = {
    "bars": q_bars,
    "event_bars": q_event_bars,
    "payload_normalize": q_payload_normalize,
    "pages_dedupe": q_pages_dedupe,
    "bronze_upsert_keep_first": q_bronze_upsert_keep_first,
    "latest_bar": q_latest_bar,
    "pool_argmax": q_pool_argmax,
    "coerce_types": q_coerce_types,
    "ffill_bfill": q_ffill_bfill,
    "iqr_bounds": q_iqr_bounds,
    "outlier_counts": q_outlier_counts,
    "outlier_interpolate": q_outlier_interpolate,
    "ohlc_repair": q_ohlc_repair,
    "log_return": q_log_return,
    "calendar_fields": q_calendar_fields,
    "silver": q_silver,
    "sma": q_sma,
    "price_sma_ratio": q_price_sma_ratio,
    "ema": q_ema,
    "rsi": q_rsi,
    "volatility": q_volatility,
    "true_range": q_true_range,
    "atr": q_atr,
    "roc": q_roc,
    "momentum": q_momentum,
    "macd": q_macd,
    "volume_indicators": q_volume_indicators,
    "obv": q_obv,
    "targets": q_targets,
    "gold_fill_drop": q_gold_fill_drop,
    "gold": q_gold,
    "feature_select": q_feature_select,
    "lags": q_lags,
    "rolling_features": q_rolling_features,
    "split": q_split,
    "folds": q_folds,
    "scaler_robust": q_scaler_robust,
    "scaler_standard": q_scaler_standard,
    "scaled_features": q_scaled_features,
    "correlation": q_correlation,
    "describe": q_describe,
    "null_counts": q_null_counts,
    "range_summary": q_range_summary,
    "regression_metrics": q_regression_metrics,
    "residual_histogram": q_residual_histogram,
    "eval_rows": q_eval_rows,
    "prediction_upsert_keep_last": q_prediction_upsert_keep_last,
    "best_model": q_best_model,
}

__all__ = ["QUERIES", "rnd", "PRICE_COLS"]


def q_stream_ingest(spark, sf):
    """Land the page documents, run the file-stream ingest to the end
    (availableNow) and read Bronze back; equals the batch assembly (A8)."""
    import uuid

    from ..session import scratch_path
    from ..streaming import ingest

    root = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    docs = payload.fixture_pages(bars.lineitem_bars(spark, sf))
    ingest.land_pages(docs, f"{root}/landing")
    q = ingest.ingest_stream(spark, f"{root}/landing", f"{root}/bronze", f"{root}/checkpoint")
    q.awaitTermination()
    out = io.read_layer(spark, f"{root}/bronze", BRONZE_SCHEMA)
    return rnd(out.select(KEY, TS, "open", "high", "low", "close", "volume"))


QUERIES["stream_ingest"] = q_stream_ingest


def q_gold_summary(spark, sf):
    return stats.layer_summary(_gold(spark, sf))


def q_preview(spark, sf):
    return rnd(io.preview(_silver(spark, sf), 5, ["open", "high", "low", "close", "volume"]))


def q_supplier_silver(spark, sf):
    """Many small series: one per supplier."""
    return _pick(layers.silver(bars.text_bars(spark, sf, bars.supplier_bars)), SILVER_OUT)


def q_supplier_gold(spark, sf):
    return rnd(layers.gold(layers.silver(bars.text_bars(spark, sf, bars.supplier_bars))))


def q_event_gold(spark, sf):
    """Hourly bars of the events table through Silver and Gold."""
    return rnd(layers.gold(layers.silver(bars.text_bars(spark, sf, bars.event_bars))))


QUERIES["event_gold"] = q_event_gold
QUERIES["supplier_silver"] = q_supplier_silver
QUERIES["supplier_gold"] = q_supplier_gold
def q_scaler_robust_pooled(spark, sf):
    return rnd(features.fit_scaler(_features(spark, sf), kind="robust", by_key=False))


QUERIES["scaler_robust_pooled"] = q_scaler_robust_pooled
def q_axis_limits(spark, sf):
    return rnd(stats.axis_limits(_naive_predictions(spark, sf), "y_true"))


def q_fetch_limit(spark, sf):
    return _pick(payload.fetch_limit(bars.lineitem_bars(spark, sf), 100),
                 ["open", "high", "low", "close", "volume"])


QUERIES["axis_limits"] = q_axis_limits
QUERIES["fetch_limit"] = q_fetch_limit
QUERIES["gold_summary"] = q_gold_summary
QUERIES["preview"] = q_preview


def q_stream_order(spark, sf):
    """I1 over three runs of one fetch, later pages landing first: equals the
    batch assembly as well."""
    import uuid

    from ..session import scratch_path
    from ..streaming import ingest

    root = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    docs = payload.fixture_pages(bars.lineitem_bars(spark, sf))
    for part in (2, 1, 0):
        ingest.land_pages(docs.where(F.col("page_no") % 3 == part), f"{root}/landing")
        ingest.ingest_stream(spark, f"{root}/landing", f"{root}/bronze", f"{root}/checkpoint",
                             fetch="one").awaitTermination()
    out = io.read_layer(spark, f"{root}/bronze", BRONZE_SCHEMA)
    return rnd(out.select(KEY, TS, "open", "high", "low", "close", "volume"))


QUERIES["stream_order"] = q_stream_order
