"""Bar adapters over the supplied test tables (fixture input, not pipeline
operators).

* ``lineitem_bars``: one daily OHLCV bar per (return flag - line status, ship
  day).  Open / close are the first / last price by a total tie-break order.
* ``supplier_bars``: the same, one series per supplier (many small keys).
* ``event_bars``: hourly bars of ``events.value`` per event type.
* ``dirty_bars``: the lineitem bars with faults derived from the row number
  in the series, so the cleaning operators have something to repair.

All of these are one hash aggregate with map-side partial aggregation: a hot
series (say a third of all rows) is split across every input task before
the shuffle, and each bar group holds one (series, bar) pair only.  The lines
of ``supplier_bars`` hardly share bars: on a large table they are dealt by
(series, bar) first, and the bars by series, to as many tasks as the table
needs, so that neither aggregates nor windows hold more rows a task on a larger
one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..functions import windows as W
from ..operators import segments
from ..schemas import KEY, TS

# ---- fixed values of the fault fixture (row number in series, 1-based) ----
NULL_CLOSE_EVERY = 53
SWAP_HIGH_LOW_EVERY = 37
OPEN_X10_EVERY = 71
TEXT_NA_EVERY = 41
FLAT_CLOSE_FROM, FLAT_CLOSE_TO = 200, 220
PAGE_SIZE, PAGE_OVERLAP = 100, 5
FINE_KEY, HALF_HOURS = "all", 48
FINE_GAP_FROM, FINE_GAP_TO = 1500, 2200
FINE_HIGH_FROM, FINE_HIGH_TO = 3000, 3599
# ---------------------------------------------------------------------------


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ohlcv(df: DataFrame, key: F.Column, ts: F.Column, price: str, qty: str,
           tie: F.Column) -> DataFrame:
    tie_of = F.col("_tie")  # a column: both ends take it from there
    return (df.withColumn("_tie", tie).groupBy(key.alias(KEY), ts.alias(TS))
            .agg(F.min_by(F.col(price), tie_of).alias("open"),
                 F.max(price).alias("high"),
                 F.min(price).alias("low"),
                 F.max_by(F.col(price), tie_of).alias("close"),
                 F.sum(qty).alias("volume")))


def _order_line_tie() -> F.Column:
    """(order, line, cents) as one number of fixed width: the aggregate's
    buffer can be updated in place, so the bars are a hash aggregate."""
    return F.expr("cast(l_orderkey AS decimal(18,0)) * 1000000000000000BD + cast(l_linenumber AS decimal(4,0)) "
                  "* 100000000000BD + cast(round(l_extendedprice * 100) AS decimal(11,0))")


def lineitem_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    key = F.concat_ws("-", "l_returnflag", "l_linestatus")
    return _ohlcv(li, key, S.day_floor("l_shipdate"), "l_extendedprice", "l_quantity", _order_line_tie())


def supplier_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    rows = li.count()  # nearly every line is a bar of its own, so partial aggregates save nothing
    li = W.dealt(li.withColumn(TS, S.day_floor("l_shipdate")), rows, "l_suppkey", TS)
    b = _ohlcv(li, F.col("l_suppkey"), F.col(TS), "l_extendedprice", "l_quantity", _order_line_tie())
    return W.dealt(b.withColumn(KEY, F.concat(F.lit("supp-"), F.col(KEY).cast("string"))), rows, KEY)


def event_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    tie = F.expr("cast(timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) AS decimal(19,0)) * 1000000000000000BD + cast(event_id AS decimal(15,0))")
    return (ev.groupBy(F.col("event_type").alias(KEY), S.hour_floor("ts").alias(TS))
            .agg(F.min_by("value", tie).alias("open"),
                 F.max("value").alias("high"),
                 F.min("value").alias("low"),
                 F.max_by("value", tie).alias("close"),
                 F.count(F.lit(1)).cast("double").alias("volume")))


def fine_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ``lineitem`` table as one series of half-hour bars (the half
    hour of a line is its order's number modulo the half hours of a day)."""
    li = read_table(spark, sf_dir, "lineitem")
    at = F.expr(f"timestampadd(MINUTE, 30 * (l_orderkey % {HALF_HOURS}), cast(cast(l_shipdate AS date) AS timestamp_ntz))")
    return _ohlcv(li, F.lit(FINE_KEY), at, "l_extendedprice", "l_quantity", _order_line_tie())


def fine_text_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fine_bars`` with faults: every fault of ``dirty_bars`` and
    ``text_bars`` but the flat run, a run of missing closes and a run of far
    too high opens, both longer than a segment.  Rows are numbered without a
    window over the series."""
    b = segments.number_rows(segments.written(fine_bars(spark, sf_dir))).withColumn("rn", F.col(segments.POS) + 1)
    rn, last = F.col("rn"), F.col(segments.LENGTH)
    swap = rn % SWAP_HIGH_LOW_EVERY == 0
    gone = (rn % NULL_CLOSE_EVERY == 0) | rn.between(FINE_GAP_FROM, FINE_GAP_TO)
    open_ = (F.when(rn.between(FINE_HIGH_FROM, FINE_HIGH_TO), F.col("open") * 1000)
             .when((rn % OPEN_X10_EVERY == 0) | (rn == 1) | (rn == last), F.col("open") * 10).otherwise(F.col("open")))
    close = F.when(rn % TEXT_NA_EVERY == 0, F.lit("n/a")).when(~gone, F.col("close").cast("string"))
    return b.select(KEY, open_.cast("string").alias("open"),
                    F.when(swap, F.col("low")).otherwise(F.col("high")).cast("string").alias("high"),
                    F.when(swap, F.col("high")).otherwise(F.col("low")).cast("string").alias("low"),
                    close.alias("close"), F.col("volume").cast("string").alias("volume"),
                    F.date_format(TS, "yyyy-MM-dd HH:mm:ss").alias(TS))


def with_rn(bars: DataFrame) -> DataFrame:
    """1-based row number and length of each series (fixture helper)."""
    return bars.withColumns({"rn": F.row_number().over(W.series()), "n": F.count(F.lit(1)).over(W.whole(KEY, TS))})


def dirty_bars(spark: SparkSession, sf_dir: str, source=None) -> DataFrame:
    """Bars (lineitem by default) with deterministic faults: null close,
    swapped high/low, open x 10 (also on the first and last row) and a flat
    run of closes."""
    return _dirty(with_rn((source or lineitem_bars)(spark, sf_dir))).drop("rn")


def _dirty(b: DataFrame) -> DataFrame:
    rn = F.col("rn")
    b = b.withColumn("_flat", F.nth_value("close", FLAT_CLOSE_FROM).over(W.whole(KEY, TS)))
    swap = rn % SWAP_HIGH_LOW_EVERY == 0
    flat = rn.between(FLAT_CLOSE_FROM, FLAT_CLOSE_TO)
    flat_close = F.col("_flat")
    close = (F.when(rn % NULL_CLOSE_EVERY == 0, F.lit(None).cast("double"))
              .when(flat, flat_close).otherwise(F.col("close")))
    open_ = F.when((rn % OPEN_X10_EVERY == 0) | (rn == 1) | (rn == F.col("n")),
                   F.col("open") * 10).otherwise(F.col("open"))
    return b.select(
        KEY,
        open_.alias("open"),
        F.when(swap, F.col("low")).otherwise(F.col("high")).alias("high"),
        F.when(swap, F.col("high")).otherwise(F.col("low")).alias("low"),
        close.alias("close"),
        "volume",
        TS,
        "rn",
    )


def text_bars(spark: SparkSession, sf_dir: str, source=None) -> DataFrame:
    """String copy of the dirty bars, with ``'n/a'`` in ``close`` every
    41st row and the date as text (input of the type coercion)."""
    b = _dirty(with_rn((source or lineitem_bars)(spark, sf_dir)))
    close_txt = F.when(F.col("rn") % TEXT_NA_EVERY == 0, F.lit("n/a")).otherwise(
        F.col("close").cast("string"))
    return b.select(
        KEY,
        F.col("open").cast("string").alias("open"),
        F.col("high").cast("string").alias("high"),
        F.col("low").cast("string").alias("low"),
        close_txt.alias("close"),
        F.col("volume").cast("string").alias("volume"),
        F.date_format(TS, "yyyy-MM-dd HH:mm:ss").alias(TS),
    )


def pools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pool list rows: one list per nation (``network``), pools in supplier
    order, reserve as text."""
    s = read_table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_nationkey").alias("network"),
        F.col("s_suppkey").alias("ordinal"),
        F.concat(F.lit("eth_"), F.col("s_suppkey").cast("string")).alias("id"),
        F.col("s_acctbal").cast("string").alias("reserve_in_usd"),
    )
