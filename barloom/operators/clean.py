"""Silver cleaning operators.

Every operator is ``DataFrame -> DataFrame`` over many series at once and
uses only windows partitioned by the series key, so the whole Silver chain
runs after a single hash exchange on ``series_key``.  Per-series scalars
(quantile bounds, "any row inconsistent" flags) are window aggregates over
the whole series, not joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import quantiles, segments
from ..functions import scalar as S
from ..functions import windows as W
from ..schemas import KEY, NUMERIC_COLS, PRICE_COLS, TS

IQR_K = 1.5  # fixed value: Tukey fence multiplier


def coerce_types(df: DataFrame, ts: str = TS) -> DataFrame:
    """B1: numeric columns -> double, date -> timestamp; bad values -> null.
    Only columns that are present are touched."""
    out = df
    for c in NUMERIC_COLS:
        if c in df.columns:
            out = out.withColumn(c, S.to_double(c))
    if ts in df.columns:
        dt = df.schema[ts].dataType
        if isinstance(dt, T.StringType):
            out = out.withColumn(ts, S.to_ts(ts))
        elif isinstance(dt, T.TimestampType):
            out = out.withColumn(ts, F.col(ts).cast("timestamp_ntz"))
    return out


def fill_missing(df: DataFrame, key: str = KEY, ts: str = TS) -> DataFrame:
    """Drop rows without a date; per series forward-fill then
    backward-fill each numeric column; drop rows still missing a numeric.
    What is left for the backward fill lies before the first value of the
    series and takes that one."""
    w, all_ = W.series(key, ts), W.whole(key, ts)
    cols = [c for c in NUMERIC_COLS if c in df.columns]
    filled = df.where(F.col(ts).isNotNull()).withColumns(
        {c: F.coalesce(W.ffill(c, w), F.first(F.col(c), ignorenulls=True).over(all_)) for c in cols})
    return filled.dropna(subset=cols)


def iqr_bounds(df: DataFrame, cols: list[str] = PRICE_COLS, key: str = KEY,
               budget: int = quantiles.BUDGET) -> DataFrame:
    """D1 as a table: per series and column, Q1, Q3 (exact, linear
    interpolation) and the fences ``Q1 - 1.5 IQR`` / ``Q3 + 1.5 IQR``, by
    refining selection: a series may be of any length."""
    q = quantiles.exact_percentiles_of(df, cols, [0.25, 0.75], key, budget=budget)
    spread = F.col("q3") - F.col("q1")
    return q.select(key, "column", F.col("p0").alias("q1"), F.col("p1").alias("q3")).select(
        "*", (F.col("q1") - IQR_K * spread).alias("lower"), (F.col("q3") + IQR_K * spread).alias("upper"))


def _quartiles(cols: list[str], key: str, ts: str | None = None) -> dict[str, Column]:
    """``_q_<c>``: Q1 and Q3, to be columns of their own before ``_fences``
    reads them, or each mention of one is a percentile to compute."""
    return {f"_q_{c}": F.percentile(F.col(c), F.array(F.lit(0.25), F.lit(0.75))).over(W.whole(key, ts)) for c in cols}


def _fences(c: str) -> tuple[Column, Column]:
    q = F.col(f"_q_{c}")
    return q[0] - IQR_K * (q[1] - q[0]), q[1] + IQR_K * (q[1] - q[0])


def outlier_flags(df: DataFrame, cols: list[str] = PRICE_COLS, key: str = KEY) -> DataFrame:
    """Adds ``_out_<c>``: value outside the per-series fences of column c."""
    flags = {}
    for c in cols:
        lo, hi = _fences(c)
        flags[f"_out_{c}"] = F.coalesce((F.col(c) < lo) | (F.col(c) > hi), F.lit(False))
    return df.withColumns(_quartiles(cols, key)).withColumns(flags).drop(*[f"_q_{c}" for c in cols])


def wide_fences(bounds: DataFrame, cols: list[str] = PRICE_COLS, key: str = KEY) -> DataFrame:
    """``iqr_bounds`` as one row a series, ``_lo_<c>`` and ``_hi_<c>``."""
    def pick(c, side):
        return F.max(F.when(F.col("column") == c, F.col(side)))

    return bounds.groupBy(key).agg(*[x for c in cols for x in (pick(c, "lower").alias(f"_lo_{c}"),
                                                               pick(c, "upper").alias(f"_hi_{c}"))])


def outlier_counts(df: DataFrame, cols: list[str] = PRICE_COLS, key: str = KEY) -> DataFrame:
    """Per series and column, the number of values outside the fences."""
    rows = segments.written(df.select(F.coalesce(F.col(key), F.lit(segments.NO_KEY)).alias(key), *cols))
    fences = segments.written(wide_fences(iqr_bounds(rows, cols, key), cols, key).withColumn(
        key, F.coalesce(F.col(key), F.lit(segments.NO_KEY))))
    joined = segments.per_series(rows, fences, key, F.struct(*cols))
    per = joined.groupBy(key).agg(
        *[F.count_if((F.col(c) < F.col(f"_lo_{c}")) | (F.col(c) > F.col(f"_hi_{c}"))).alias(c) for c in cols])
    return per.select(F.nullif(F.col(key), F.lit(segments.NO_KEY)).alias(key),
                      F.stack(F.lit(len(cols)), *[x for c in cols for x in (F.lit(c), F.col(c))])
                      .alias("column", "outliers"))


def interpolate_outliers(df: DataFrame, cols: list[str] = PRICE_COLS,
                         key: str = KEY, ts: str = TS) -> DataFrame:
    """Per series and price column, values outside the IQR fences become
    missing and are filled by linear interpolation over row position.
    Leading gaps stay missing; trailing gaps take the last value.  Fences
    are computed on the column as it arrives (before any replacement)."""
    w, wd = W.series(key, ts), W.series_desc(key, ts)
    pos = "_pos"
    out = df.withColumns({pos: F.row_number().over(w), **_quartiles(cols, key, ts)})
    masked = {}
    for c in cols:
        lo, hi = _fences(c)
        outside = F.coalesce((F.col(c) < lo) | (F.col(c) > hi), F.lit(False))
        masked[c] = F.when(~outside, F.col(c))
    out = out.withColumns(masked).drop(*[f"_q_{c}" for c in cols])
    prev, nxt = {}, {}
    for c in cols:
        known_pos = F.when(F.col(c).isNotNull(), F.col(pos))
        prev[f"_pv_{c}"] = W.ffill(c, w)
        prev[f"_pp_{c}"] = F.last(known_pos, ignorenulls=True).over(W.running(w))
        nxt[f"_nv_{c}"] = W.bfill(c, wd)
        nxt[f"_np_{c}"] = F.last(known_pos, ignorenulls=True).over(W.running(wd))
    out = out.withColumns(prev).withColumns(nxt)
    filled = {}
    for c in cols:
        pv, pp, nv, np_ = (F.col(f"_pv_{c}"), F.col(f"_pp_{c}"), F.col(f"_nv_{c}"), F.col(f"_np_{c}"))
        slope = (nv - pv) / (np_ - pp)
        filled[c] = (F.when(F.col(c).isNotNull(), F.col(c))
                      .when(pv.isNull(), F.lit(None).cast("double"))
                      .when(nv.isNull(), pv)
                      .otherwise(slope * (F.col(pos) - pp) + pv))
    helper = [pos] + [f"_{p}_{c}" for c in cols for p in ("pv", "pp", "nv", "np")]
    return out.withColumns(filled).drop(*helper)


def repair_ohlc(df: DataFrame, key: str = KEY, ts: str | None = None) -> DataFrame:
    """(1) swap high/low where high < low; (2) if any row of the series
    has high < open or high < close, high = max(open, high, close) on every
    row; (3) likewise low = min(open, low, close).  Row max/min skip nulls.
    ``ts``, if given, orders the rows for the windows that follow."""
    o, h, l, c = (F.col(x) for x in ("open", "high", "low", "close"))
    swap = F.coalesce(h < l, F.lit(False))
    step1 = df.withColumns({"high": F.when(swap, l).otherwise(h),
                            "low": F.when(swap, h).otherwise(l)})
    o, h, l, c = (F.col(x) for x in ("open", "high", "low", "close"))
    bad_high = F.bool_or(F.coalesce((h < o) | (h < c), F.lit(False))).over(W.whole(key, ts))
    bad_low = F.bool_or(F.coalesce((l > o) | (l > c), F.lit(False))).over(W.whole(key, ts))
    return step1.withColumns({
        "high": F.when(bad_high, F.greatest(o, h, c)).otherwise(h),
        "low": F.when(bad_low, F.least(o, l, c)).otherwise(l),
    })


def add_derived(df: DataFrame, key: str = KEY, ts: str = TS, previous: Column | None = None) -> DataFrame:
    """E3 + H5/H6/H11: log return, range, average price, volume in
    millions, calendar fields (Monday = 0).  ``previous`` is the close of the
    row before; a window over the series if not given."""
    if previous is None:
        previous = F.lag("close", 1).over(W.series(key, ts))
    return df.withColumns({
        "daily_return": S.log_return("close", previous),
        "price_range": F.col("high") - F.col("low"),
        "avg_price": (F.col("open") + F.col("high") + F.col("low") + F.col("close")) / 4,
        "volume_millions": F.col("volume") / 1_000_000,
        "day_of_week": S.weekday_monday0(ts),
        "month": F.month(ts),
        "year": F.year(ts),
    })
