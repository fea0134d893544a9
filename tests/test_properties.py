"""Properties of the layers and the row accounting of the feature stage."""

from pyspark.sql import functions as F

from barloom.checks import spark_queries as Q
from barloom.operators import features
from barloom.plans import layers
from barloom.sources import bars
from conftest import SF0001


def test_ohlc_consistent_after_silver(spark):
    s = Q._silver(spark, SF0001)
    bad = s.where((F.col("low") > F.col("close")) | (F.col("high") < F.col("close")) |
                  (F.col("low") > F.col("open")) | (F.col("high") < F.col("open")))
    assert bad.count() == 0


def test_rsi_bounds(spark):
    g = Q._gold(spark, SF0001)
    assert g.where((F.col("rsi") < 0) | (F.col("rsi") > 100)).count() == 0


def test_splits_disjoint_ordered_covering(spark):
    f = Q._features(spark, SF0001)
    agg = f.groupBy("series_key", "split").agg(F.min("date").alias("lo"), F.max("date").alias("hi"),
                                               F.count(F.lit(1)).alias("n")).collect()
    per = {}
    for r in agg:
        per.setdefault(r.series_key, {})[r.split] = r
    total = f.groupBy("series_key").count().collect()
    for r in total:
        p = per[r.series_key]
        assert sum(x.n for x in p.values()) == r["count"]
        assert p["train"].hi < p["val"].lo and p["val"].hi < p["test"].lo


def test_shuffled_input_same_output(spark):
    b = bars.lineitem_bars(spark, SF0001)
    a = layers.gold(layers.silver(b))
    c = layers.gold(layers.silver(b.repartition(7).orderBy(F.rand(3))))
    assert a.exceptAll(c).count() == 0 and c.exceptAll(a).count() == 0


def test_row_accounting_180_bars(spark):
    """180 clean daily bars: Gold 130 -> lags 127 -> rolling 114 -> 79/12/23."""
    b = bars.with_rn(bars.lineitem_bars(spark, SF0001)).where("series_key = 'A-F' AND rn <= 180").drop("rn", "n")
    g = layers.gold(layers.silver(b))
    assert g.count() == 130
    sel = features.select_features(g)
    lagged = features.lags(sel, 3)
    assert lagged.count() == 127
    rolled = features.rolling_features(lagged)
    assert rolled.count() == 114
    split = {r.split: r["count"] for r in features.time_split(rolled).groupBy("split").count().collect()}
    assert split == {"train": 79, "val": 12, "test": 23}
