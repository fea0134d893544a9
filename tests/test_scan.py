"""EMA block scan against the plain sequential recurrence."""

import random

import pytest
from pyspark.sql import functions as F

from barloom.operators import scan


def recurrence(values, span):
    """pandas' rule: weights by position, nulls carry the last value."""
    import pandas as pd
    y = pd.Series(values, dtype="float64").ewm(span=span, adjust=False).mean()
    return [None if pd.isna(v) else v for v in y]


def _series(spark, rows):
    return spark.createDataFrame(rows, "series_key string, date timestamp_ntz, close double")


def _make(keys_lengths, seed=7, lead_nulls=0):
    import datetime as dt
    rnd = random.Random(seed)
    rows, ref = [], {}
    for k, n in keys_lengths.items():
        vals = [None] * min(lead_nulls, n) + [round(rnd.uniform(10, 1000), 2) for _ in range(max(0, n - lead_nulls))]
        ref[k] = vals
        base = dt.datetime(2000, 1, 1)
        rows += [(k, base + dt.timedelta(days=i), v) for i, v in enumerate(vals)]
    return rows, ref


@pytest.mark.parametrize("span", [2, 7, 12, 26, 50])
def test_ema_matches_recurrence(spark, span):
    lens = {"a": 0, "b": 1, "c": 13, "d": 14, "e": 49, "f": 50, "g": 51, "h": 1500}
    rows, ref = _make({k: v for k, v in lens.items() if v}, lead_nulls=3)
    out = scan.ema(_series(spark, rows), "close", span, "y").orderBy("series_key", "date").collect()
    got = {}
    for r in out:
        got.setdefault(r.series_key, []).append(r.y)
    for k, vals in ref.items():
        want = recurrence(vals, span)
        for g, w in zip(got[k], want):
            if w is None:
                assert g is None
            else:
                assert abs(g - w) <= 1e-9 * max(1.0, abs(w))


def test_block_rows_crosses_blocks():
    # a span-2 EMA uses small blocks, so the 1500-row series spans several
    assert scan.block_rows([2]) < 1500
    assert scan.block_rows([7, 50]) == scan.block_rows([7])


def test_ema_of_constant_is_constant(spark):
    rows, _ = _make({"z": 300})
    df = _series(spark, rows).withColumn("close", F.lit(42.5))
    ys = [r.y for r in scan.ema(df, "close", 9, "y").collect()]
    assert all(abs(y - 42.5) < 1e-9 for y in ys)


def test_macd_columns(spark):
    rows, ref = _make({"m": 400})
    out = scan.macd(_series(spark, rows)).orderBy("date").collect()
    fast = recurrence(ref["m"], 12)
    slow = recurrence(ref["m"], 26)
    macd = [f - s for f, s in zip(fast, slow)]
    sig = recurrence(macd, 9)
    for r, m, s in zip(out, macd, sig):
        assert abs(r.macd - m) < 1e-7 and abs(r.macd_signal - s) < 1e-7
        assert abs(r.macd_histogram - (m - s)) < 1e-7


@pytest.mark.parametrize("span", [2, 7, 26])
def test_interior_nulls_match_pandas(spark, span):
    import random
    rnd = random.Random(3)
    rows, ref = _make({"a": 900, "b": 5, "c": 2500})
    ref["b"] = [10.0, 12.0, None, 11.0, 15.0]
    for k in "ac":
        for at in [3, 4, 40, *range(300, 300 + 45 * span), *(rnd.randrange(5, 900) for _ in range(60))]:
            if at < len(ref[k]) - 1:
                ref[k][at] = None
    seen = {k: iter(v) for k, v in ref.items()}
    rows = [(k, d, next(seen[k])) for k, d, _ in rows]
    got = {}
    for r in scan.ema(_series(spark, rows), "close", span, "y").orderBy("series_key", "date").collect():
        got.setdefault(r.series_key, []).append(r.y)
    for k, vals in ref.items():
        for g, want in zip(got[k], recurrence(vals, span)):
            assert (g is None) == (want is None)
            assert want is None or abs(g - want) <= 1e-9 * abs(want)
