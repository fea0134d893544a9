"""Gold technical indicators.

Rolling statistics need a full window: ``n`` non-null values, else null.
Ratios divide with ``try_divide`` (null instead of +-inf).  All windows are
partitioned by the series key and share one exchange.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..functions import windows as W
from ..schemas import (GOLD_COLUMNS, GOLD_TECHNICAL_MARKERS, KEY, MA_WINDOWS, ROC_PERIODS,
                       RSI_WINDOW, TRADING_DAYS, TS, VOLATILITY_WINDOWS, VOLUME_SMA_WINDOWS)
from . import scan


GAIN, LOSS, RANGE, STEP = CHANGES = ["_gain", "_loss", "_tr", "_obv_step"]


def _gain_loss(delta: Column) -> dict[str, Column]:
    """The missing first change counts as 0."""
    zero = F.lit(0.0)
    return {GAIN: F.coalesce(F.greatest(delta, zero), zero), LOSS: F.coalesce(F.greatest(-delta, zero), zero)}


def _range(prev: Column) -> Column:
    return F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - prev), F.abs(F.col("low") - prev))


def _step(delta: Column) -> Column:
    return F.coalesce(F.signum(delta) * F.col("volume"), F.lit(0.0))


def changes(df: DataFrame, key: str = KEY, ts: str | list[str] = TS) -> DataFrame:
    """What RSI, ATR and OBV take from a row and the close before it, by one
    look back (``CHANGES``).  Over these columns their windows need no other
    window first, so one operator computes them with the other indicators."""
    prev = F.lag("close", 1).over(W.series(key, ts))
    delta = F.col("close") - F.col("_prev")
    return df.withColumn("_prev", prev).withColumns(
        {**_gain_loss(delta), RANGE: _range(F.col("_prev")), STEP: _step(delta)}).drop("_prev")


def _replaced(df: DataFrame, out: DataFrame, cols: dict[str, Column]) -> DataFrame:
    """The columns of ``df`` and the new ones, from a frame with helpers."""
    return out.select(*[c for c in df.columns if c not in cols], *[c.alias(n) for n, c in cols.items()])


def moving_averages(df: DataFrame, windows: list[int] | None = None,
                    key: str = KEY, ts: str = TS) -> DataFrame:
    """``sma_n``, ``ema_n`` and ``price_sma_ratio_n`` of ``close``."""
    windows = windows or MA_WINDOWS
    missing = {f"ema_{n}": n for n in windows if f"ema_{n}" not in df.columns}
    if missing:  # EMAs computed upstream (one shared scan) are reused
        df = scan.ema_columns(df, "close", missing, key, ts)
    out, stats = W.rolled(df, [("mean", "close", n) for n in windows], W.series(key, ts))
    sma = {n: stats["mean", "close", n] for n in windows}
    return _replaced(df, out, {**{f"sma_{n}": c for n, c in sma.items()},
                               **{f"price_sma_ratio_{n}": S.safe_div("close", c) for n, c in sma.items()}})


def rsi(df: DataFrame, window: int = RSI_WINDOW, key: str = KEY, ts: str = TS) -> DataFrame:
    """Simple-mean RSI.  The missing first change counts as 0, so the
    first value is at row ``window - 1``.  Average loss 0 gives 100, or null
    when the average gain is 0 too.  Series shorter than ``window + 1`` rows
    get null."""
    w = W.series(key, ts)
    out = df
    if GAIN not in df.columns:  # changes computed upstream are reused
        out = df.withColumns(_gain_loss(F.col("close") - F.lag("close", 1).over(w)))
    out, stats = W.rolled(out, [("mean", GAIN, window), ("mean", LOSS, window)], w)
    out = out.withColumn("_n", F.count(F.lit(1)).over(W.whole(key, ts)))
    g, lo = stats["mean", GAIN, window], stats["mean", LOSS, window]
    value = (F.when(lo == 0, F.when(g == 0, F.lit(None).cast("double")).otherwise(F.lit(100.0)))
              .otherwise(100.0 - 100.0 / (1.0 + g / lo)))
    return _replaced(df, out, {"rsi": F.when(F.col("_n") >= window + 1, value)})


def true_range(df: DataFrame, key: str = KEY, ts: str = TS, name: str = "true_range") -> DataFrame:
    """max(high-low, |high-prev close|, |low-prev close|), nulls skipped."""
    return df.withColumn(name, _range(F.lag("close", 1).over(W.series(key, ts))))


def volatility(df: DataFrame, windows: list[int] | None = None,
               key: str = KEY, ts: str = TS) -> DataFrame:
    """E8 + E10: ``volatility_n`` = sample std of ``daily_return`` x sqrt(252);
    ``atr_n`` = mean true range."""
    windows = windows or VOLATILITY_WINDOWS
    w = W.series(key, ts)
    out = df if RANGE in df.columns else true_range(df, key, ts, RANGE)
    ann = math.sqrt(TRADING_DAYS)
    out, stats = W.rolled(out, [x for n in windows for x in (("std", "daily_return", n), ("mean", RANGE, n))], w)
    cols = {}
    for n in windows:
        cols[f"volatility_{n}"] = stats["std", "daily_return", n] * ann
        cols[f"atr_{n}"] = stats["mean", RANGE, n]
    return _replaced(df, out, cols)


def rates(df: DataFrame, periods: list[int] | None = None,
          key: str = KEY, ts: str = TS) -> DataFrame:
    """``roc_n = close/lag_n - 1``, ``momentum_n = close - lag_n``."""
    periods = periods or ROC_PERIODS
    w = W.series(key, ts)
    cols = {}
    for n in periods:
        cols[f"roc_{n}"] = S.safe_div("close", F.lag("close", n).over(w)) - 1
    for n in periods:
        cols[f"momentum_{n}"] = F.col("close") - F.lag("close", n).over(w)
    return df.withColumns(cols)


def momentum(df: DataFrame, periods: list[int] | None = None,
             key: str = KEY, ts: str = TS) -> DataFrame:
    """``rates``, then MACD."""
    return scan.macd(rates(df, periods, key, ts), "close", key, ts)


def volume_averages(df: DataFrame, key: str = KEY, ts: str = TS) -> DataFrame:
    """Volume SMA and the volume's ratio to it."""
    out, stats = W.rolled(df, [("mean", "volume", n) for n in VOLUME_SMA_WINDOWS], W.series(key, ts))
    sma = {n: stats["mean", "volume", n] for n in VOLUME_SMA_WINDOWS}
    return _replaced(df, out, {**{f"volume_sma_{n}": c for n, c in sma.items()},
                               **{f"volume_ratio_{n}": S.safe_div("volume", c) for n, c in sma.items()}})


def obv_step(key: str = KEY, ts: str = TS) -> Column:
    """What a row adds to the on-balance volume."""
    return _step(F.col("close") - F.lag("close", 1).over(W.series(key, ts)))


def volume_indicators(df: DataFrame, key: str = KEY, ts: str = TS) -> DataFrame:
    """Volume SMA / ratio and on-balance volume."""
    out = volume_averages(df, key, ts)
    step = F.col(STEP) if STEP in df.columns else obv_step(key, ts)
    return out.withColumn("obv", F.sum(step).over(W.running(W.series(key, ts))))


def targets(df: DataFrame, horizon: int = 1, key: str = KEY, ts: str = TS) -> DataFrame:
    """E16 + B7: ``target_close`` / ``target_return`` = value ``horizon`` rows
    ahead, ``target_direction`` = 1 if the target close is higher; then the
    last ``horizon`` rows of each series are dropped.  A series with at most
    ``horizon`` rows keeps its rows with null targets."""
    w = W.series(key, ts)
    n = F.count(F.lit(1)).over(W.whole(key, ts))
    out = df.withColumns({
        "target_close": F.lead("close", horizon).over(w),
        "target_return": F.lead("daily_return", horizon).over(w),
        "_has_next": F.lead(F.lit(1), horizon).over(w).isNotNull(),
        "_n": n,
    })
    out = out.withColumn("target_direction", S.flag(F.col("target_close") > F.col("close")))
    keep = F.col("_has_next") | (F.col("_n") < horizon + 1)
    return out.where(keep).drop("_has_next", "_n")


def technical_columns(cols: list[str]) -> list[str]:
    return [c for c in cols if any(m in c for m in GOLD_TECHNICAL_MARKERS)]


def gold_fill_drop(df: DataFrame, key: str = KEY, ts: str = TS) -> DataFrame:
    """Forward-fill the technical columns (names containing sma_, ema_,
    rsi, volatility_, atr_, macd) within each series, then drop rows with any
    null.  The whole numbers are tested as one array: a filter with a function
    over an array is compiled in pieces and hands on the rows it keeps, while
    one long method over all columns would write them again."""
    w = W.series(key, ts)
    filled = df.withColumns({c: W.ffill(c, w) for c in technical_columns(df.columns)})
    whole = [c for c, t in filled.dtypes if t == "int"]
    if not whole:
        return filled.dropna(how="any")
    return filled.dropna(how="any", subset=[c for c in filled.columns if c not in whole]).where(
        F.forall(F.array(*whole), lambda x: x.isNotNull()))


def ml_projection(df: DataFrame, key: str = KEY, ts: str = TS) -> DataFrame:
    """The Gold column order, existing columns only, date last."""
    cols = [c for c in GOLD_COLUMNS if c in df.columns]
    return df.select(key, *cols, ts)
