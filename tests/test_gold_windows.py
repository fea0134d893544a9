"""Silver and Gold over many series: few sorts and windows, each window function
once, and the rules that the merged windows rest on."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from barloom.checks import spark_queries as Q
from barloom.functions import windows as W
from barloom.operators import clean, indicators, scan
from barloom.plans import layers
from barloom.sources import bars
from conftest import SF0001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_gold_sorts_and_windows(spark):
    plan = _plan(layers.gold(layers.silver(bars.supplier_bars(spark, SF0001))))
    assert len(re.findall(r"(?<!\w)Sort \[", plan)) <= 4
    assert len(re.findall(r"Window \[", plan)) <= 15


def test_each_percentile_once(spark):
    plan = _plan(clean.interpolate_outliers(clean.fill_missing(bars.supplier_bars(spark, SF0001))))
    assert plan.count("percentile(") == 4


def test_rounding_of_gold_is_compiled(spark):
    """A method of more than 8,000 bytes is interpreted by the JVM."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the plan with its compiled stages
    try:
        run = Q.q_supplier_gold(spark, SF0001)._jdf.queryExecution()
        text = getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package").codegenString(run.executedPlan())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert len(sizes) > 5 and max(sizes) < 8000


def test_rnd_is_half_away_from_zero(spark):
    g = Q.GRID
    xs = [0.5 / g, 1.5 / g, 2.5 / g, -0.5 / g, -1.5 / g, -2.5 / g, 0.49999999999999994 / g, -0.0, 1e300, -1e300, 2.0**52 + 1,
          float("inf"), float("nan"), None, 123.45678, -98765.43215]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double")
    want = df.select("i", (F.round(F.col("x") * F.lit(g)) / F.lit(g) + F.lit(0.0)).alias("x"))
    assert [str(r) for r in Q.rnd(df).orderBy("i").collect()] == [str(r) for r in want.orderBy("i").collect()]


def _rows(spark, n=400, seed=5):
    r = random.Random(seed)
    base = dt.datetime(2001, 1, 1)
    rows = []
    for k, m in (("a", n), ("b", 13), ("c", 1), ("d", 60)):
        for i in range(m):
            c = None if r.random() < 0.08 or (k == "d" and i < 20) else round(r.uniform(1, 900), 2)
            rows.append((k, base + dt.timedelta(days=i), c))
    return spark.createDataFrame(rows, "series_key string, date timestamp_ntz, close double")


def test_unbroken_runs_guard_as_counts_do(spark):
    df = scan.in_blocks(_rows(spark), 50)
    w = W.series()
    run = W.count_unbroken(df, ["close"], scan.ROW, w)
    wanted = [(kind, "close", n) for kind in ("mean", "std") for n in (3, 7, 14)]
    for rows in (df, run):
        out, stats = W.rolled(rows, wanted, w)
        out = out.withColumns({f"got_{k}_{n}": s for (k, _, n), s in stats.items()})
        out = out.withColumns({f"want_{k}_{n}": W.guarded(F.avg if k == "mean" else F.stddev_samp, "close", w, n)
                               for k, _, n in wanted})
        for k, _, n in wanted:
            assert out.where(~F.col(f"got_{k}_{n}").eqNullSafe(F.col(f"want_{k}_{n}"))).isEmpty(), (k, n)
        assert out.where("got_mean_14 is not null").count() > 0


@pytest.mark.parametrize("size", [7, 20, 1000])
def test_averages_do_not_depend_on_blocks(spark, size):
    """Gaps, leading nulls beyond a block and MACD over blocks cut upstream."""
    df = _rows(spark)
    spans = {"e7": 7, "e26": 26}
    whole = scan.macd(scan.ema_columns(df, "close", spans))
    cut = scan.macd(scan.ema_columns(scan.in_blocks(df, size), "close", spans)).drop(*scan.BLOCKS)
    cols = ["e7", "e26", "macd", "macd_signal", "macd_histogram"]
    pairs = whole.join(cut.select("series_key", "date", *[F.col(c).alias(f"_{c}") for c in cols]), ["series_key", "date"])
    for c in cols:
        near = F.abs(F.col(c) - F.col(f"_{c}")) <= 1e-9 * F.greatest(F.abs(c), F.lit(1.0))
        assert pairs.where(~F.coalesce(near, F.col(c).isNull() & F.col(f"_{c}").isNull())).count() == 0, c
    assert pairs.count() == df.count()


def test_changes_give_the_same_indicators(spark):
    s = layers.silver(bars.text_bars(spark, SF0001))
    plain = indicators.volume_indicators(indicators.volatility(indicators.rsi(s)))
    merged = indicators.volume_indicators(indicators.volatility(indicators.rsi(indicators.changes(s)))).select(*plain.columns)
    assert merged.exceptAll(plain).isEmpty() and plain.exceptAll(merged).isEmpty()


def test_fill_drop_drops_any_null(spark):
    rows = [("a", dt.datetime(2001, 1, 1 + i), *r) for i, r in enumerate(
        [(1.0, 1.0, 1, 1), (None, 1.0, 1, 1), (1.0, None, 1, 1), (1.0, 1.0, None, 1), (1.0, 1.0, 1, None),
         (1.0, float("nan"), 1, 1), (None, 2.0, 2, 2)])]
    df = spark.createDataFrame(rows, "series_key string, date timestamp_ntz, sma_7 double, close double, month int, year int")
    got = indicators.gold_fill_drop(df).orderBy("date").collect()
    assert [(r.date.day, r.sma_7) for r in got] == [(1, 1.0), (2, 1.0), (7, 1.0)]
