"""Model-feature operators.

Lags and rolling statistics are per-series windows.  The time split and the
fold assignment use the row number and the series length from windows
(no join, no driver round trip).  Scaler parameters are exact per-series
aggregates fitted on the train rows only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import windows as W
from . import quantiles
from ..schemas import (KEY, LAG_FEATURES, PIPELINE_MAX_LAG, PRIORITY_FEATURES, TARGET_COLUMNS,
                       TEST_SIZE, TS, VAL_SIZE, feature_columns)


def select_features(df: DataFrame, key: str = KEY, ts: str = TS) -> DataFrame:
    """Date + the priority features present + the targets present; rows
    with a missing feature are dropped (missing targets are kept)."""
    feats = [c for c in PRIORITY_FEATURES if c in df.columns]
    targets = [c for c in TARGET_COLUMNS if c in df.columns]
    return df.select(key, ts, *feats, *targets).dropna(subset=feats)


def lags(df: DataFrame, max_lag: int = 5, cols: list[str] | None = None,
         key: str = KEY, ts: str = TS) -> DataFrame:
    """``<c>_lag_<i>`` for i in 1..max_lag, then drop rows with any null."""
    w = W.series(key, ts)
    cols = [c for c in (cols or LAG_FEATURES) if c in df.columns]
    out = df.withColumns({f"{c}_lag_{i}": F.lag(c, i).over(w)
                          for c in cols for i in range(1, max_lag + 1)})
    return out.dropna(how="any")


def rolling_features(df: DataFrame, key: str = KEY, ts: str = TS) -> DataFrame:
    """Rolling close mean/std 7, mean 14 and volume mean 7 over the rows
    that arrive here (positions recounted after E18's drop), then drop rows
    with any null."""
    w = W.series(key, ts)
    cols = {}
    if "close" in df.columns:
        cols["rolling_mean_7"] = W.rolling_mean("close", w, 7)
        cols["rolling_std_7"] = W.rolling_std("close", w, 7)
        cols["rolling_mean_14"] = W.rolling_mean("close", w, 14)
    if "volume" in df.columns:
        cols["volume_rolling_mean_7"] = W.rolling_mean("volume", w, 7)
    return df.withColumns(cols).dropna(how="any")


def time_split(df: DataFrame, test_size: float = TEST_SIZE, val_size: float = VAL_SIZE,
               key: str = KEY, ts: str = TS) -> DataFrame:
    """Per series, the first ``int(n*(1-test-val))`` rows are train, up to
    ``int(n*(1-test))`` val, the rest test.  Fractions are Python doubles
    (``1-0.2-0.1`` is 0.7000000000000001)."""
    w = W.series(key, ts)
    n = F.count(F.lit(1)).over(W.whole(key))
    r = F.row_number().over(w) - 1
    val_at = F.floor(n * F.lit(1.0 - test_size - val_size))
    test_at = F.floor(n * F.lit(1.0 - test_size))
    split = (F.when(r < val_at, F.lit("train")).when(r < test_at, F.lit("val"))
              .otherwise(F.lit("test")))
    return df.withColumn("split", split)


def folds(df: DataFrame, k: int = 3, key: str = KEY, ts: str = TS,
          split_col: str = "split", on: str = "train") -> DataFrame:
    """Contiguous, unshuffled k-fold ids (0..k-1) over the train rows of
    each series; the first ``n % k`` folds are one row longer."""
    train = df.where(F.col(split_col) == on) if split_col in df.columns else df
    return train.withColumn("fold", F.ntile(k).over(W.series(key, ts)) - 1)


def pipeline_features(gold: DataFrame, max_lag: int = PIPELINE_MAX_LAG,
                      key: str = KEY, ts: str = TS) -> DataFrame:
    """L3 rows: B5 -> E18 -> E19 -> E20."""
    df = select_features(gold, key, ts)
    df = lags(df, max_lag, key=key, ts=ts)
    df = rolling_features(df, key, ts)
    return time_split(df, key=key, ts=ts)


# ------------------------------------------------------------------ scaling
def fit_scaler(df: DataFrame, cols: list[str] | None = None, kind: str = "robust",
               by_key: bool = True, key: str = KEY, split_col: str = "split",
               on: str = "train") -> DataFrame:
    """Scaler parameters fitted on the train rows.

    ``robust``: center = median, scale = Q3 - Q1 (exact, linear), by refining
    selection over one written copy of the columns: neither a series nor a
    pooled column is held in one task.  ``standard``: center = mean, scale =
    population std (partial aggregates).  A zero scale becomes 1.  Output:
    ``series_key, feature, center, scale`` (``series_key`` is ``'*'`` when
    pooled)."""
    cols = cols or feature_columns(df.columns)
    train = df.where(F.col(split_col) == on) if split_col in df.columns else df
    if kind not in ("robust", "standard"):
        raise ValueError(f"unknown scaler: {kind}")
    keycol = F.col(key) if by_key else F.lit("*")
    if kind == "robust":
        q = quantiles.exact_percentiles_of(train, cols, [0.25, 0.5, 0.75], key if by_key else None)
        long = q.select(keycol.alias(key), F.col("column").alias("feature"), F.col("p1").alias("center"),
                        (F.col("p2") - F.col("p0")).alias("spread"))
    else:
        parts = F.array(*[F.struct(F.lit(c).alias("feature"), F.avg(F.col(c).cast("double")).alias("center"),
                                   F.stddev_pop(F.col(c).cast("double")).alias("spread")) for c in cols])
        per = train.groupBy(key).agg(parts.alias("_p")) if by_key else train.agg(parts.alias("_p"))
        long = per.select(keycol.alias(key), F.inline("_p"))
    return long.select(key, "feature", "center",
                       F.when(F.col("spread") == 0, F.lit(1.0)).otherwise(F.col("spread")).alias("scale"))


def apply_scaler(df: DataFrame, params: DataFrame, cols: list[str] | None = None,
                 by_key: bool = True, key: str = KEY) -> DataFrame:
    """K1 / H19 / C2 with saved parameters (the table written by
    ``fit_scaler``): ``(x - center) / scale``.  Per-series parameters are
    pivoted to one row per series and joined on the key; pooled parameters
    are one row, broadcast (its size is fixed)."""
    cols = cols or feature_columns(df.columns)
    wide = params.groupBy(key).agg(
        *[F.max(F.when(F.col("feature") == c, F.struct("center", "scale"))).alias(f"_s_{c}")
          for c in cols])
    if by_key:
        joined = df.join(wide, key, "left")
    else:
        joined = df.crossJoin(F.broadcast(wide.drop(key)))
    scaled = {c: (F.col(c) - F.col(f"_s_{c}.center")) / F.col(f"_s_{c}.scale") for c in cols}
    return joined.withColumns(scaled).drop(*[f"_s_{c}" for c in cols])


def scale_features(df: DataFrame, cols: list[str] | None = None, kind: str = "robust",
                   key: str = KEY, split_col: str = "split", on: str = "train") -> DataFrame:
    """K1 fitted and applied in one pass, per series: the parameters are
    window aggregates over the train rows of the series, so no join and no
    extra exchange is needed."""
    cols = cols or feature_columns(df.columns)
    wk = W.whole(key)
    is_train = F.col(split_col) == on
    out = {}
    for c in cols:
        x = F.when(is_train, F.col(c).cast("double"))
        if kind == "robust":
            q = F.percentile(x, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).over(wk)
            center, spread = q[1], q[2] - q[0]
        elif kind == "standard":
            center, spread = F.avg(x).over(wk), F.stddev_pop(x).over(wk)
        else:
            raise ValueError(f"unknown scaler: {kind}")
        scale = F.when(spread == 0, F.lit(1.0)).otherwise(spread)
        out[c] = (F.col(c) - center) / scale
    return df.withColumns(out)
