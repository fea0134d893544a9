"""Silver, Gold and feature rows over segments, for series of any length.

Same rows as ``plans.layers``, where a series is one window partition.  Here
rows are numbered and cut into segments, and a task sees one segment with its
halo.  Every phase that needs what lies before (or after) a segment ends in a
stored frame, so nothing is computed twice: the cut, the filled rows, the
interpolated rows; in Gold the cut and the rows with local indicators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import windows as W
from ..operators import clean, features, indicators, long_series, scan, segments
from ..schemas import (KEY, MA_WINDOWS, MACD_FAST, MACD_SIGNAL, MACD_SLOW, NUMERIC_COLS, PIPELINE_MAX_LAG, PRICE_COLS,
                       TS)
from . import layers

GOLD_HALO = 50        # fixed value: the longest window and the change before it
SERIES_ROWS = 200_000  # longest series that ``silver`` and ``gold`` of ``plans.layers`` are given


def silver(bronze: DataFrame, key: str = KEY, ts: str = TS, **sizes) -> DataFrame:
    """L1 over segments."""
    df = clean.coerce_types(bronze, ts).where(F.col(ts).isNotNull())
    cols = [c for c in NUMERIC_COLS if c in df.columns]
    parts = segments.cut(df, key=key, ts=ts, **sizes)
    parts = parts.keep(long_series.fill(parts, cols))
    parts = parts.keep(long_series.interpolate(parts, long_series.fences(parts, PRICE_COLS), PRICE_COLS))
    before, previous = long_series.previous(parts, "close")
    rows = parts.attach(before, rows=long_series.repair(parts))
    out = clean.add_derived(rows, key, ts, previous)
    return parts.uncut(out.drop(*[c for c in before.columns if c not in parts.by])).select(
        *bronze.columns, *[c for c in out.columns if c not in [*rows.columns, *bronze.columns]])


def gold_indicators(parts: segments.Segments) -> DataFrame:
    """L2 up to the targets over segments with ``GOLD_HALO`` rows before and
    one ahead, without what needs the rows before a segment as a whole:
    ``obv`` is still the step and the MACD signal is missing."""
    k, t = parts.by, segments.POS
    spans = {f"ema_{n}": n for n in MA_WINDOWS}
    spans.update({scan.FAST_COL: MACD_FAST, scan.SLOW_COL: MACD_SLOW})
    df = long_series.recurrences(parts, "close", spans)
    df = indicators.moving_averages(df, key=k, ts=t)
    df = indicators.rsi(df, key=k, ts=t)
    df = indicators.volatility(df, key=k, ts=t)
    df = indicators.rates(df, key=k, ts=t)
    df = df.withColumn("macd", F.col(scan.FAST_COL) - F.col(scan.SLOW_COL)).drop(scan.FAST_COL, scan.SLOW_COL)
    df = indicators.volume_averages(df, key=k, ts=t).withColumn("obv", indicators.obv_step(k, t))
    return indicators.targets(df, key=k, ts=t)


def gold(silver_df: DataFrame, key: str = KEY, ts: str = TS, **sizes) -> DataFrame:
    """L2 over segments."""
    parts = segments.cut(silver_df, GOLD_HALO, 1, key=key, ts=ts, **sizes)
    parts = parts.keep(gold_indicators(parts).where(long_series.own()))
    rows = long_series.recurrences(parts, "macd", {"macd_signal": MACD_SIGNAL})
    rows = rows.withColumn("macd_histogram", F.col("macd") - F.col("macd_signal")).withColumnRenamed("obv", "_step")
    rows = long_series.running_total(parts, F.col("_step"), "obv", rows).drop("_step")
    rows = parts.uncut(long_series.fill_forward(parts, indicators.technical_columns(rows.columns), rows))
    return indicators.ml_projection(rows.dropna(how="any"), key, ts)


def pipeline_features(gold_df: DataFrame, max_lag: int = PIPELINE_MAX_LAG, key: str = KEY, ts: str = TS,
                      **sizes) -> DataFrame:
    """L3 rows: B5 -> E18 -> E19 -> E20, numbered anew after each drop."""
    at = segments.POS
    df = features.select_features(gold_df, key, ts)
    df = segments.on_segments(df, lambda rows, by: features.lags(rows, max_lag, key=by, ts=at), max_lag, key=key, ts=ts,
                              **sizes)
    df = segments.on_segments(df, lambda rows, by: features.rolling_features(rows, by, at), 13, key=key, ts=ts, **sizes)
    return long_series.time_split(df, key=key, ts=ts, **{k: v for k, v in sizes.items() if k != "rows"})


# ------------------------------------------------------------- which of both
def series_rows(df: DataFrame, key: str = KEY) -> tuple[int, int]:
    """Rows of the longest series and of all (a scan of one column of a stored
    layer)."""
    n = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return tuple(x or 0 for x in n.agg(F.max("n"), F.sum("n")).first())


def build_silver(bronze: DataFrame, key: str = KEY, ts: str = TS) -> DataFrame:
    """L1: one window partition a series while all are short, dealt to as many
    tasks as the layer needs; else segments."""
    longest, rows = series_rows(bronze, key)
    return silver(bronze, key, ts) if longest > SERIES_ROWS else layers.silver(W.dealt(bronze, rows, key), key, ts)


def build_gold(silver_df: DataFrame, key: str = KEY, ts: str = TS) -> DataFrame:
    """L2: as ``build_silver``."""
    longest, rows = series_rows(silver_df, key)
    return gold(silver_df, key, ts) if longest > SERIES_ROWS else layers.gold(W.dealt(silver_df, rows, key), key, ts)


def build_features(gold_df: DataFrame, key: str = KEY, ts: str = TS) -> DataFrame:
    """L3 rows: as ``build_silver``."""
    longest, rows = series_rows(gold_df, key)
    if longest > SERIES_ROWS:
        return pipeline_features(gold_df, key=key, ts=ts)
    return features.pipeline_features(W.dealt(gold_df, rows, key), key=key, ts=ts)
