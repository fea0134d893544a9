"""Queries of the segmented operators, with their DuckDB SQL.

All of ``lineitem`` is one series of half-hour bars here, with gaps longer
than a segment.  The SQL computes windows over the whole series; its moving
averages run the recurrence over the rows back that weigh anything."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean, long_series, segments
from ..plans import long_layers
from ..schemas import KEY, MA_WINDOWS, MACD_FAST, MACD_SIGNAL, MACD_SLOW, NUMERIC_COLS, PRICE_COLS, TS
from ..session import scratch_path
from ..sources import bars
from ..sources import bars as B
from . import duckdb_sql as S
from . import spark_queries as Q
from .duckdb_sql import D, K, W

FORGOTTEN = 1e-18  # weight of the rows that the SQL averages leave out
LARGE = 64
FEW_ROWS = 2000    # budget of a range in the percentile query: the ranges are divided several times


def rnd(df: DataFrame) -> DataFrame:
    """Doubles on the grid of the other queries up to ``LARGE``, beyond on one
    of 1/16: a moving average of prices differs in its last digits by the order
    of additions, and the more rows, the more often that meets a fine grid."""
    grid = [(F.when(F.abs(c) < LARGE, F.round(F.col(c) * S.GRID) / S.GRID).otherwise(F.round(F.col(c) * 16.0) / 16.0)
             + 0.0).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    return df.select(*grid)


def R(e: str) -> str:  # noqa: N802 - as in duckdb_sql
    x = f"({e})::DOUBLE"
    g = f"{S.GRID!r}::DOUBLE"
    return (f"(CASE WHEN abs({x}) < {LARGE} THEN round({x} * {g}) / {g} ELSE round({x} * 16.0::DOUBLE) / 16.0::DOUBLE END "
            f"+ 0.0::DOUBLE)")


def _picked(cols: list[str], src: str) -> str:
    return f"SELECT {K}, date, " + ", ".join(c if c in S.INT_COLS else f"{R(c)} AS {c}" for c in cols) + f" FROM {src}"


def _fresh(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """A stored layer, as a run would read it."""
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _bars(spark, sf):
    return _fresh(spark, bars.fine_text_bars(spark, sf), "fine")


def _silver(spark, sf):
    return _fresh(spark, long_layers.silver(_bars(spark, sf)), "fine-silver")


def _gold(spark, sf):
    return _fresh(spark, long_layers.gold(_silver(spark, sf)), "fine-gold")


def _filled(spark, sf) -> segments.Segments:
    parts = segments.cut(clean.coerce_types(_bars(spark, sf)).where(F.col(TS).isNotNull()))
    return parts.keep(long_series.fill(parts, NUMERIC_COLS))


def q_long_positions(spark, sf):
    """Numbers without a window over the series."""
    rows = segments.number_rows(_fresh(spark, bars.fine_bars(spark, sf), "fine"), block_rows=FEW_ROWS)
    return rows.select(KEY, TS, F.col(segments.POS).alias("position"), F.col(segments.LENGTH).alias("length"))


def q_long_fill(spark, sf):
    parts = _filled(spark, sf)
    return rnd(parts.uncut().select(KEY, TS, *NUMERIC_COLS))


def q_long_iqr_bounds(spark, sf):
    return rnd(clean.iqr_bounds(_filled(spark, sf).uncut(), budget=FEW_ROWS))


def q_long_interpolate(spark, sf):
    parts = _filled(spark, sf)
    rows = long_series.interpolate(parts, long_series.fences(parts, PRICE_COLS), PRICE_COLS)
    return rnd(parts.uncut(rows).select(KEY, TS, *NUMERIC_COLS))


def q_long_silver(spark, sf):
    return rnd(_silver(spark, sf).select(KEY, TS, *Q.SILVER_OUT))


def q_long_ema(spark, sf):
    out = long_series.ema(_silver(spark, sf), "close", {f"ema_{n}": n for n in MA_WINDOWS})
    return rnd(out.select(KEY, TS, *[f"ema_{n}" for n in MA_WINDOWS]))


def q_long_macd(spark, sf):
    return rnd(long_series.macd(_silver(spark, sf)).select(KEY, TS, *["macd", "macd_signal", "macd_histogram"]))


def q_long_targets(spark, sf):
    return rnd(long_series.targets(_silver(spark, sf)).select(KEY, TS, *["target_close", "target_return", "target_direction"]))


def q_long_gold(spark, sf):
    return rnd(_gold(spark, sf))


def _features(spark, sf):
    return _fresh(spark, long_layers.pipeline_features(_gold(spark, sf)), "fine-features")


def q_long_features(spark, sf):
    return rnd(_features(spark, sf))


def q_long_folds(spark, sf):
    return long_series.folds(_features(spark, sf)).select(KEY, TS, "fold")


QUERIES = {"long_positions": q_long_positions, "long_fill": q_long_fill, "long_iqr_bounds": q_long_iqr_bounds,
           "long_interpolate": q_long_interpolate, "long_silver": q_long_silver, "long_ema": q_long_ema,
           "long_macd": q_long_macd, "long_targets": q_long_targets, "long_gold": q_long_gold,
           "long_features": q_long_features, "long_folds": q_long_folds}


# --------------------------------------------------------------------- SQL
def _fine() -> list[tuple[str, str]]:
    tie = "(l_orderkey, l_linenumber, l_extendedprice)"
    q = f"""SELECT '{B.FINE_KEY}' AS {K},
  CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) + to_minutes(30 * (l_orderkey % {B.HALF_HOURS})) AS date,
  arg_min(l_extendedprice, {tie}) AS open, max(l_extendedprice) AS high,
  min(l_extendedprice) AS low, arg_max(l_extendedprice, {tie}) AS close,
  sum(l_quantity) AS volume
FROM lineitem GROUP BY 1, 2"""
    return [("bars", q)] + S.rn_bars()


def _fine_text() -> list[tuple[str, str]]:
    q = f"""SELECT {K},
  CAST(CASE WHEN rn BETWEEN {B.FINE_HIGH_FROM} AND {B.FINE_HIGH_TO} THEN open * 1000
       WHEN rn % {B.OPEN_X10_EVERY} = 0 OR rn = 1 OR rn = n THEN open * 10 ELSE open END AS VARCHAR) AS open,
  CAST(CASE WHEN rn % {B.SWAP_HIGH_LOW_EVERY} = 0 THEN low ELSE high END AS VARCHAR) AS high,
  CAST(CASE WHEN rn % {B.SWAP_HIGH_LOW_EVERY} = 0 THEN high ELSE low END AS VARCHAR) AS low,
  CASE WHEN rn % {B.TEXT_NA_EVERY} = 0 THEN 'n/a'
       WHEN rn % {B.NULL_CLOSE_EVERY} = 0 OR rn BETWEEN {B.FINE_GAP_FROM} AND {B.FINE_GAP_TO} THEN NULL
       ELSE CAST(close AS VARCHAR) END AS close,
  CAST(volume AS VARCHAR) AS volume, strftime(date, '%Y-%m-%d %H:%M:%S') AS date
FROM rbars"""
    return _fine() + [("textbars", q)]


def looked_back(src: str, col: str, spans: dict[str, int], name: str) -> list[tuple[str, str]]:
    """Moving averages of a column without nulls: the recurrence over as many
    rows back as weigh more than ``FORGOTTEN``, from the first of them."""
    cols = []
    for n, s in spans.items():
        a = 2 / (s + 1)
        back = math.ceil(math.log(FORGOTTEN) / math.log(1 - a))
        cols.append(f"list_reduce(list({col}) OVER {W('date', f'ROWS BETWEEN {back} PRECEDING AND CURRENT ROW')}, "
                    f"lambda y, x: {D(1 - a)} * y + {D(a)} * x) AS {n}")
    return [(name, f"SELECT {K}, date, row_number() OVER {W()} AS rn, {', '.join(cols)} FROM {src}")]


def _silver_sql() -> list[tuple[str, str]]:
    return _fine_text() + S.coerced() + S.filled() + S.interpolated() + S.repaired() + S.derived()


def _averages() -> list[tuple[str, str]]:
    """The CTE ``emas`` of ``duckdb_sql.gold_indicators`` without recursion over the rows."""
    spans = {f"ema_{n}": n for n in MA_WINDOWS} | {"ema_fast": MACD_FAST, "ema_slow": MACD_SLOW}
    return looked_back("silver", "close", spans, "avgs") + [
        ("diff", f"SELECT {K}, date, ema_fast - ema_slow AS macd FROM avgs")] + looked_back(
        "diff", "macd", {"macd_signal_raw": MACD_SIGNAL}, "sig") + [
        ("emas", f"SELECT a.*, s.macd_signal_raw FROM avgs a JOIN sig s ON s.{K} = a.{K} AND s.rn = a.rn")]


def _gold_sql() -> list[tuple[str, str]]:
    ctes = [c for c in S.gold_indicators() if c[0] not in ("emas", "emas_in")]
    return _silver_sql() + _averages() + ctes + S.gold_fill_drop()


def oracle() -> dict[str, str]:
    o = {}
    o["long_positions"] = S.sql(_fine(), f"SELECT {K}, date, rn - 1 AS position, n AS length FROM rbars")
    fill = _fine_text() + S.coerced() + S.filled()
    o["long_fill"] = S.sql(fill, _picked(S.OHLCV, "filled"))
    base = fill + [("pos", f"SELECT *, row_number() OVER {W()} AS pos FROM filled")] + S.fences("pos")
    o["long_iqr_bounds"] = S.sql(base, " UNION ALL ".join(
        f"SELECT {K}, '{c}' AS \"column\", {R(f'q1_{c}')} AS q1, {R(f'q3_{c}')} AS q3, {R(f'lo_{c}')} AS lower, "
        f"{R(f'hi_{c}')} AS upper FROM fences" for c in PRICE_COLS))
    o["long_interpolate"] = S.sql(fill + S.interpolated(), _picked(S.OHLCV, "interp"))
    silver = _silver_sql()
    o["long_silver"] = S.sql(silver, _picked(S.SILVER_COLS, "silver"))
    o["long_ema"] = S.sql(silver + looked_back("silver", "close", {f"ema_{n}": n for n in MA_WINDOWS}, "avgs"),
                          _picked([f"ema_{n}" for n in MA_WINDOWS], "avgs"))
    o["long_macd"] = S.sql(silver + _averages(), f"SELECT {K}, date, {R('ema_fast - ema_slow')} AS macd, "
                           f"{R('macd_signal_raw')} AS macd_signal, {R('ema_fast - ema_slow - macd_signal_raw')} "
                           f"AS macd_histogram FROM emas")
    o["long_targets"] = S.sql(silver + [
        ("t0", f"SELECT *, lead(close) OVER {W()} AS target_close, lead(daily_return) OVER {W()} AS target_return, "
               f"row_number() OVER {W('date DESC')} AS left_ FROM silver"),
        ("t1", "SELECT *, CAST(coalesce(target_close > close, false) AS INTEGER) AS target_direction FROM t0 WHERE left_ > 1")],
        _picked(["target_close", "target_return", "target_direction"], "t1"))
    gold = _gold_sql()
    o["long_gold"] = S.sql(gold, f"SELECT {K}, " + ", ".join(
        c if c in S.INT_COLS else f"{R(c)} AS {c}" for c in S.GOLD_COLUMNS) + ", date FROM gold")
    feats = gold + S.feature_select() + S.lags() + S.rolling() + S.split()
    cols = S.PRIORITY_FEATURES + S.TARGET_COLUMNS + S.LAG_COLS + S.ROLL_COLS
    o["long_features"] = S.sql(feats, f"SELECT {K}, date, " + ", ".join(
        c if c in S.INT_COLS else f"{R(c)} AS {c}" for c in cols) + ", split FROM splitted")
    o["long_folds"] = S.sql(feats, f"SELECT {K}, date, CAST(ntile(3) OVER {W()} - 1 AS INTEGER) AS fold "
                                   f"FROM splitted WHERE split = 'train'")
    return o
