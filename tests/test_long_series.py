"""Segments, carries and the long-series operators against the window
operators and pandas, with segments and fans so small that a series has many
of both."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barloom.checks import spark_queries as Q
from barloom.operators import clean, features, indicators, long_series, quantiles, scan, segments
from barloom.plans import layers, long_layers
from barloom.sources import bars
from conftest import SF0001

SMALL = dict(rows=60, block_rows=40, fan=8)
SHORT = [0, 1, 13, 14, 49, 50, 51, 59, 60, 61, 120, 121]


def sorted_rows(df):
    pdf = Q.rnd(df).toPandas()
    return pdf.sort_values(["series_key", "date"], na_position="first").reset_index(drop=True)


def same(a, b):
    a, b = sorted_rows(a), sorted_rows(b)
    assert list(a.columns) == list(b.columns)
    assert len(a) == len(b)
    for c in a.columns:
        equal = (a[c] == b[c]) | (a[c].isna() & b[c].isna())
        assert equal.all(), f"{c}: {a[['series_key', 'date', c]][~equal].head(3)} {b[c][~equal].head(3).tolist()}"


def table(spark, lengths, seed=5, gaps=()):
    """One series for each length; ``gaps``: (from, to) rows without values."""
    rnd, rows = random.Random(seed), []
    for n in lengths:
        for i in range(n):
            o, c = rnd.uniform(50, 100), rnd.uniform(50, 100)
            none = any(a <= i < b for a, b in gaps)
            rows.append((f"s{n}", dt.datetime(2001, 1, 1) + dt.timedelta(hours=i * (1 + n % 3)), o, max(o, c) + 1,
                         min(o, c) - 1, None if none else c, float(rnd.randrange(1, 90))))
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, "series_key string, date timestamp_ntz, open double, high double, low double, "
                                       "close double, volume double")


# ------------------------------------------------------------- the carries
def _run(carry, parts):
    out = {k: np.array([carry.empty[k]]) for k in carry.columns}
    for p in parts:
        out = carry.then(out, p)
    return out


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.integers(0, 4), st.integers(0, 4), st.floats(-9, 9), st.floats(-9, 9),
                          st.floats(0.01, 1)), min_size=3, max_size=3))
def test_carries_compose_in_any_grouping(parts):
    carry = segments.Recurrence("e", [7])
    f, g, h = ({"has": np.array([has]), "lead": np.array([float(lead + (not has))]),
                "trail": np.array([float(trail) if has else 0.0]), "x": np.array([x if has else 0.0]),
                "loc0": np.array([loc if has else 0.0]), "w0": np.array([w if has else 1.0])}
               for has, lead, trail, x, loc, w in parts)
    one, two = carry.then(carry.then(f, g), h), carry.then(f, carry.then(g, h))
    for k in carry.columns:
        assert np.allclose(one[k].astype(float), two[k].astype(float))
    same_f = carry.then({k: np.array([v]) for k, v in carry.empty.items()}, f)
    assert all(np.allclose(same_f[k].astype(float), f[k].astype(float)) for k in carry.columns)


@pytest.mark.parametrize("reverse", [False, True])
def test_scan_over_several_levels(spark, reverse):
    n = 301
    rows = [("k", i, float(i * i % 17)) for i in range(n)] + [("one", 0, 5.0)]
    df = spark.createDataFrame(rows, "series_key string, _seg long, t_v double")
    got = {(r.series_key, r._seg): r.in_t_v for r in segments.carry_in(
        df, [segments.Total("t")], n - 1, fan=4, reverse=reverse).collect()}
    values = [r[2] for r in rows[:n]]
    for i in range(n):
        assert got["k", i] == sum(values[i + 1:] if reverse else values[:i])
    assert got["one", 0] == 0.0


# ---------------------------------------------------------------- numbering
def test_positions(spark):
    """Uneven density: one early row, then all in a few hours; null times."""
    at = [dt.datetime(1970, 1, 1)] + [dt.datetime(2020, 1, 1) + dt.timedelta(seconds=7 * i) for i in range(3000)]
    rows = [("a", t) for t in at] + [("b", at[5]), ("c", None), ("c", at[7])] + [("d", None)]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "series_key string, date timestamp_ntz")
    got = segments.number_rows(df, block_rows=20, fan=4).toPandas()
    for _, g in got.groupby("series_key"):
        g = g.sort_values("date", na_position="first")
        assert g._pos.tolist() == list(range(len(g))) and (g._length == len(g)).all()
    assert len(got) == len(rows)


def test_salted_join_of_series_facts(spark, monkeypatch):
    monkeypatch.setattr(segments, "BROADCAST_SERIES", 0)
    df = table(spark, [120, 61, 1])
    same(long_layers.silver(df, **SMALL), layers.silver(df))


def test_halo_rows_are_the_rows_before(spark):
    parts = segments.cut(table(spark, [200, 30]), halo=50, ahead=1, **SMALL)
    got = parts.rows.groupBy("series_key", "_seg", "_halo").agg(F.min("_pos").alias("lo"), F.max("_pos").alias("hi"),
                                                               F.count(F.lit(1)).alias("n")).collect()
    found = {(r.series_key, r._seg, r._halo): (r.lo, r.hi, r.n) for r in got}
    assert found["s200", 1, -1] == (10, 59, 50) and found["s200", 1, 1] == (120, 120, 1)
    assert found["s200", 3, 0] == (180, 199, 20) and ("s200", 3, 1) not in found
    assert {k[1] for k in found if k[0] == "s30"} == {0}


# ---------------------------------------------------------------- operators
def test_silver_and_gold_of_short_series(spark):
    df = table(spark, SHORT, gaps=[(0, 3), (100, 119)])
    same(long_layers.silver(df, **SMALL), layers.silver(df))
    s = segments.written(layers.silver(df))
    same(long_layers.gold(s, **SMALL), layers.gold(s))


def test_gaps_longer_than_a_segment(spark):
    df = table(spark, [900, 260], gaps=[(0, 70), (200, 390), (800, 900)])
    high = df.withColumn("open", F.when(F.hour("date") % 7 == 1, F.col("open") * 1000).otherwise(F.col("open")))
    far = high.withColumn("high", F.when((F.col("date") > "2001-01-12") & (F.col("date") < "2001-01-19"), 1e7)
                          .otherwise(F.col("high")))
    same(long_layers.silver(far, **SMALL), layers.silver(far))


def test_layers_of_the_fixture(spark):
    text = bars.text_bars(spark, SF0001)
    s = segments.written(layers.silver(text))
    g = segments.written(layers.gold(s))
    same(long_layers.gold(s, rows=200, block_rows=300), g)
    f = features.pipeline_features(g)
    same(long_layers.pipeline_features(g, rows=200, block_rows=300), f)
    same(long_series.folds(f, block_rows=100, fan=4), features.folds(f))


def test_null_series_key_is_a_series(spark):
    df = table(spark, [130, 61]).withColumn("series_key", F.when(F.col("series_key") == "s61", F.col("series_key")))
    same(long_layers.silver(df, **SMALL), layers.silver(df))


@pytest.mark.parametrize("span", [1, 2, 7, 26])
def test_averages_with_nulls_match_pandas(spark, span):
    rnd = random.Random(4)
    gone = [(3, 5), (40, 41), (110, 250), (300, 303)] + [(a, a + 1) for a in (rnd.randrange(5, 600) for _ in range(40))]
    df = table(spark, [700, 1, 5], gaps=[(0, 2), *gone])
    for r in [61, 60]:
        out = long_series.ema(df, "close", {"y": span}, rows=r, block_rows=40, fan=4).toPandas()
        for _, g in out.groupby("series_key"):
            g = g.sort_values("date")
            want = g.close.ewm(span=span, adjust=False).mean()
            assert (g.y.isna() == want.isna()).all()
            assert np.allclose(g.y.dropna(), want.dropna(), rtol=1e-9, atol=0)


def test_macd_and_targets(spark):
    df = table(spark, [400, 61, 2, 1])
    same(long_series.macd(df, **SMALL), scan.macd(df))
    df = df.withColumn("daily_return", F.col("close") / 3)
    for h in (1, 5):
        same(long_series.targets(df, h, **SMALL), indicators.targets(df, h))


def test_no_value_looks_ahead(spark):
    """Gold of a cut-off history equals the same rows of the whole history."""
    s = segments.written(layers.silver(table(spark, [300])))
    first = s.orderBy("date").limit(200)
    whole, part = long_layers.gold(s, **SMALL), long_layers.gold(segments.written(first), **SMALL)
    until = part.agg(F.max("date")).first()[0]
    same(part, whole.where(F.col("date") <= F.lit(until)))


def test_which_layers_are_built(spark, monkeypatch):
    df = table(spark, [130, 61])
    monkeypatch.setattr(long_layers, "SERIES_ROWS", 129)
    called = []
    monkeypatch.setattr(long_layers, "silver", lambda *a: called.append(1) or layers.silver(*a))
    long_layers.build_silver(df)
    long_layers.build_silver(df.where("series_key = 's61'"))
    assert called == [1]


# --------------------------------------------------------------- the plans
def top_lists(line):
    """The outermost [...] lists of a plan line."""
    depth, out = 0, []
    for ch in line[line.index("Window ["):]:
        depth += ch == "["
        if depth == 1 and ch == "[":
            out.append("")
        elif depth:
            out[-1] += ch
        depth -= ch == "]"
    return out


def test_no_window_holds_a_series(spark, monkeypatch):
    """Every plan that the segmented layers run, the stored ones included."""
    plans = []
    for name in ("stored", "written"):
        plain = getattr(segments, name)
        monkeypatch.setattr(segments, name, lambda df, plain=plain: plans.append(
            df._jdf.queryExecution().executedPlan().toString()) or plain(df))
    s = long_layers.silver(bars.lineitem_bars(spark, SF0001))
    g = long_layers.gold(s)
    plans += [x._jdf.queryExecution().executedPlan().toString() for x in (s, g)]
    windows = [line for p in plans for line in p.splitlines() if "Window [" in line]
    assert len(windows) > 20
    for line in windows:
        keys = top_lists(line)[1]
        assert "_seg" in keys or "_b1" in keys or "lo#" in keys, line
    assert all("SinglePartition" not in line for p in plans for line in p.splitlines() if "Exchange" in line
               and "series_key" in line)


# ------------------------------------------------------------- percentiles
@pytest.mark.parametrize("kind", ["even", "logs", "ties", "signs"])
def test_refining_selection(spark, kind):
    rnd = random.Random(8)
    make = {"even": lambda i: rnd.uniform(0, 1), "logs": lambda i: 10 ** rnd.uniform(-200, 200),
            "ties": lambda i: float(rnd.choice([1, 1, 1, 2, 3, 1e300])), "signs": lambda i: rnd.gauss(0, 1) ** 9}[kind]
    rows = [(rnd.choice(["a", "a", "b", None]), make(i), float(i % 7), None) for i in range(4000)]
    rows += [("empty", None, None, None), ("one", 4.0, float("nan"), None)]
    df = spark.createDataFrame(rows, "g string, x double, y double, z double")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = quantiles.exact_percentiles_of(df, ["x", "y", "z"], probs, "g", bins=8, budget=30).collect()
    assert len(got) == 5 * 3
    pdf = pd.DataFrame(rows, columns=["g", "x", "y", "z"])
    for r in got:
        x = pdf[pdf.g.isna() if r.g is None else pdf.g == r.g][r.column].astype(float).dropna()
        assert r.n == len(x)
        for i, p in enumerate(probs):
            if len(x):
                assert r[f"p{i}"] == pytest.approx(np.percentile(x, 100 * p), rel=1e-12)
            else:
                assert r[f"p{i}"] is None


def test_percentiles_read_their_input_once(spark):
    from pyspark.sql.functions import udf
    seen = spark.sparkContext.accumulator(0)

    def touch(x):
        seen.add(1)
        return x
    df = spark.range(1000).select(udf(touch, "double")(F.col("id").cast("double")).alias("v"))
    assert quantiles.exact_percentiles_of(df, ["v"], [0.5], bins=4, budget=10).first().p0 == 499.5
    assert seen.value == 1000
    assert clean.IQR_K == 1.5
