"""Composed layer transforms: L1 Bronze -> Silver and L2 Silver -> Gold.

Each is one lazy plan over many series.  Everything is a window partitioned
by ``series_key``, so Catalyst plans a single hash exchange on the key at
the start of Silver and every later window reuses it (checked by
``tests/test_plans.py``).  Rows of one series never cross a task boundary
after that exchange; a series holds bars (bounded by its time span over the
bar width), not raw records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import windows as W
from ..operators import clean, indicators, scan
from ..schemas import KEY, MA_WINDOWS, MACD_FAST, MACD_SIGNAL, MACD_SLOW, TS


def silver(bronze: DataFrame, key: str = KEY, ts: str = TS) -> DataFrame:
    """L1, in order: B1 coerce -> E1 fill (B2) -> E2 outliers -> B6 repair ->
    E3/H5/H6/H11 derived columns."""
    df = clean.coerce_types(bronze, ts)
    df = clean.fill_missing(df, key, ts)
    df = clean.interpolate_outliers(df, key=key, ts=ts)
    df = clean.repair_ohlc(df, key, ts)
    return clean.add_derived(df, key, ts)


def _indicators(silver_df: DataFrame, key: str, ts: str) -> tuple[DataFrame, list[str]]:
    """L2 up to targets: E4-6 -> E7 -> E8-10 -> E11-13 -> E14-15 -> E16, and the
    order of its rows.  The six EMAs (four averages, MACD fast and slow) share
    one block scan and MACD's signal its blocks; both run first, on few
    columns.  Every other window is over columns that are there by then and in
    the order of the blocks: one sort and one operator for all of them."""
    spans = {f"ema_{n}": n for n in MA_WINDOWS}
    spans.update({scan.FAST_COL: MACD_FAST, scan.SLOW_COL: MACD_SLOW})
    by = [scan.BLOCK, ts]
    df = indicators.changes(silver_df, key, ts)
    df = scan.in_blocks(df, scan.block_rows([*spans.values(), MACD_SIGNAL]), key, ts)
    counted = ["close", "daily_return", "volume", indicators.RANGE]
    df = W.count_unbroken(df, counted, scan.ROW, W.series(key, by))
    never_null = [indicators.GAIN, indicators.LOSS]
    df = df.withColumns({W.unbroken(c): F.col(scan.ROW) for c in never_null})
    df = scan.ema_columns(df, "close", spans, key, by)
    df = indicators.momentum(df, key=key, ts=by)
    df = indicators.moving_averages(df, key=key, ts=by)
    df = indicators.rsi(df, key=key, ts=by)
    df = indicators.volatility(df, key=key, ts=by)
    df = indicators.volume_indicators(df, key=key, ts=by)
    helpers = [*indicators.CHANGES, *scan.BLOCKS, *[W.unbroken(c) for c in counted + never_null]]
    return indicators.targets(df, key=key, ts=by).drop(*[c for c in helpers if c != scan.BLOCK]), by


def gold_indicators(silver_df: DataFrame, key: str = KEY, ts: str = TS) -> DataFrame:
    """L2 up to targets."""
    return _indicators(silver_df, key, ts)[0].drop(scan.BLOCK)


def gold(silver_df: DataFrame, key: str = KEY, ts: str = TS) -> DataFrame:
    """L2: indicators and targets, then E17 fill/drop and B4 projection."""
    df, by = _indicators(silver_df, key, ts)
    df = indicators.gold_fill_drop(df, key, by)
    return indicators.ml_projection(df, key, ts)
