"""Exponential moving averages as a windowed linear-recurrence scan.

``y0 = x0``, ``yt = b*y(t-1) + a*xt`` with ``a = 2/(span+1)``, ``b = 1-a``
(no bias adjustment), leading nulls stay null until the first value.

Spark has no recursive window, so the recurrence is unrolled in blocks of
``B`` rows per series:

* local part: ``loc_t = b^pos * SUM(u * b^-pos) OVER (PARTITION BY key, blk
  ORDER BY ts)`` with ``u = x`` on the first row and ``a*x`` after it.  ``B``
  is chosen from the smallest span so that ``b^-(B-1)`` stays below 1e100;
* carry: the value at the end of block k is ``loc_last(k) + w(k) * Y(k-1)``
  with the block's whole weight ``w(k)`` (``b^B`` without nulls);
  the previous block ends are collected in order and folded with
  ``aggregate`` (a handful of entries per series for daily bars);
* result: ``y_t = loc_t + b^(pos+1) * Y(blk-1)``.

All windows are partitioned by the series key (alone, or with the block), so
they reuse the series exchange: no extra shuffle, no Python, no join.  Those
along the series are ordered by (block, time), so they need the sort of the
block windows and no other.
A null row carries the last value; the first value after ``g - 1`` nulls
weighs the past by ``b^g / (b^g + a)`` and itself by ``a / (b^g + a)``, the rule
of an average whose weights go by position.  Such gaps enter the block sums as
an extra factor that is exactly 1 where there are none.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import windows as W
from ..schemas import KEY, MACD_FAST, MACD_SIGNAL, MACD_SLOW, TS

LEAST_SHARE = 1e-20  # below double precision: the past no longer counts
_LOG_RANGE = 100 * math.log(10.0)  # keep b^-(B-1) <= 1e100


def block_rows(spans: list[int]) -> int:
    """Rows per block for a set of spans (driven by the fastest decay)."""
    b = min(1.0 - 2.0 / (s + 1.0) for s in spans)
    if b <= 0.0:
        return 1
    return max(1, int(_LOG_RANGE / -math.log(b)) + 1)


ROW, BLOCK, AT, END, FIRST = BLOCKS = ["_scan_row", "_scan_block", "_scan_at", "_scan_end", "_scan_first"]


def in_blocks(df: DataFrame, size: int, key: str = KEY, ts: str = TS) -> DataFrame:
    """Numbers the rows of each series (``ROW``, from 1) and cuts them into
    blocks of ``size`` rows: the block, the place in it and whether it ends
    here.  Windows ordered by ``[BLOCK, ts]`` and those inside a block need one
    and the same sort."""
    at = F.col(ROW) - 1
    return df.withColumn(ROW, F.row_number().over(W.series(key, ts))).withColumns(
        {BLOCK: F.floor(at / size).cast("int"), AT: at % size, END: at % size == size - 1})


def ema_columns(df: DataFrame, col: str, spans: dict[str, int], key: str = KEY, ts: str | list[str] = TS,
                gaps: bool = True) -> DataFrame:
    """Add one EMA column per ``{name: span}`` of column ``col``.  Blocks that
    ``in_blocks`` has cut upstream are reused (their size must suit the spans)
    and kept, with ``FIRST``: no value of the column before this row.  Without
    ``gaps`` the column has nulls before its first value only, as an average
    has, and this is where ``FIRST`` says if it is there."""
    trivial = {n: F.col(col) for n, s in spans.items() if s <= 1}
    work = {n: 2.0 / (s + 1.0) for n, s in spans.items() if s > 1}
    out = df.withColumns(trivial) if trivial else df
    if not work:
        return out
    cut = BLOCK in df.columns
    if not cut:
        out = in_blocks(out, block_rows([s for s in spans.values() if s > 1]), key, ts)
    times = [c for c in ([ts] if isinstance(ts, str) else ts) if c != BLOCK]
    w = W.series(key, [BLOCK, *times])
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    wb = Window.partitionBy(key, BLOCK).orderBy(*times).rowsBetween(Window.unboundedPreceding, 0)
    seen, gap, pos = "_ema_seen", "_ema_gap", "_ema_pos"
    valid = F.col(col).isNotNull()
    if gaps or FIRST not in out.columns:  # the last row with a value before this one
        out = out.withColumn(seen, F.last(F.when(valid, F.col(ROW)), ignorenulls=True).over(before))
        out = out.withColumn(FIRST, F.col(seen).isNull())
    x = F.coalesce(F.col(col), F.lit(0.0))
    first = F.col(FIRST)
    rest = {}
    if gaps:
        # rows since the last value: 1 in a run without nulls, 0 on a null row
        out = out.withColumn(gap, F.when(valid, F.coalesce(F.col(ROW) - F.col(seen), F.lit(1))).otherwise(F.lit(0)))
        after_gap = F.col(gap) > 1
        for name, a in work.items():
            old = F.pow(F.lit(1.0 - a), F.col(gap))
            share = F.greatest(old / (old + a), F.lit(LEAST_SHARE))
            # what a gap weighs the past by beyond one ordinary step; exactly 1 where there is none
            rest[name] = F.exp(F.sum(F.when(after_gap, F.log(share / (1.0 - a))).otherwise(0.0)).over(wb))
        out = out.withColumns({pos: F.count(col).over(wb) - 1, **{f"_gap_{n}": c for n, c in rest.items()}})
    else:
        pos = AT
    decay, sums = {}, {}
    for name, a in work.items():
        b = F.lit(1.0 - a)
        u = F.when(first, x).otherwise(a * x)
        decay[f"_dec_{name}"], grown = F.pow(b, F.col(pos)), F.pow(b, -F.col(pos))
        if gaps:
            old, rest_of = F.pow(b, F.col(gap)), F.col(f"_gap_{name}")
            u = F.when(first, x).when(after_gap, x * (a / (old + a))).otherwise(a * x)
            decay[f"_dec_{name}"], grown = decay[f"_dec_{name}"] * rest_of, grown / rest_of
        sums[f"_loc_{name}"] = F.sum(u * grown).over(wb)
    out = out.withColumns({**decay, **sums})
    # all averages at the ends of the blocks before, with what a block weighs its past by
    past = {n: F.col(f"_dec_{n}") * (1.0 - a) for n, a in work.items()}
    local = {n: F.col(f"_dec_{n}") * F.col(f"_loc_{n}") for n in work}
    ends = F.collect_list(F.when(F.col(END), F.struct(
        *[past[n].alias(f"w_{n}") for n in work], *[local[n].alias(f"y_{n}") for n in work]))).over(before)
    out = out.withColumn("_ends", ends)
    results = {}
    for n in work:
        w_n, y_n = f"w_{n}", f"y_{n}"
        folded = F.aggregate("_ends", F.lit(0.0), lambda acc, e: acc * e[w_n] + e[y_n])  # noqa: B023 - called at once
        carry = F.when(F.size("_ends") > 0, folded).otherwise(0.0)
        results[n] = F.when(valid | ~first, local[n] + past[n] * carry)
    out = out.withColumns(results)
    return out.drop(seen, gap, "_ema_pos", "_ends", *([] if cut else BLOCKS), *decay, *sums, *[f"_gap_{n}" for n in rest])


def ema(df: DataFrame, col: str, span: int, name: str | None = None,
        key: str = KEY, ts: str = TS) -> DataFrame:
    """E5: one EMA column (default name ``ema_<span>``)."""
    return ema_columns(df, col, {name or f"ema_{span}": span}, key, ts)


FAST_COL, SLOW_COL = "_macd_fast", "_macd_slow"


def macd(df: DataFrame, col: str = "close", key: str = KEY, ts: str = TS) -> DataFrame:
    """``macd = EMA12 - EMA26``, ``macd_signal = EMA9(macd)``,
    ``macd_histogram = macd - macd_signal``.  The two EMAs are reused when an
    upstream scan already added ``_macd_fast`` / ``_macd_slow``."""
    fast, slow = FAST_COL, SLOW_COL
    out = df
    if fast not in df.columns or slow not in df.columns:
        if BLOCK not in df.columns:
            out = in_blocks(df, block_rows([MACD_FAST, MACD_SLOW, MACD_SIGNAL]), key, ts)
        out = ema_columns(out, col, {fast: MACD_FAST, slow: MACD_SLOW}, key, ts)
    out = out.withColumn("macd", F.col(fast) - F.col(slow)).drop(fast, slow)
    out = ema_columns(out, "macd", {"macd_signal": MACD_SIGNAL}, key, ts, gaps=False)
    out = out.withColumn("macd_histogram", F.col("macd") - F.col("macd_signal"))
    return out if BLOCK in df.columns else out.drop(*BLOCKS)


__all__ = ["ema", "ema_columns", "macd", "block_rows", "Column"]
