"""Staged exact percentiles against Spark's one-buffer ``percentile``."""

import random

from pyspark.sql import functions as F

from barloom.operators import quantiles


def test_matches_percentile_with_heavy_ties(spark):
    rnd = random.Random(5)
    rows = []
    for g in ["a", "b", "hot"]:
        n = 3000 if g == "hot" else 257
        for i in range(n):
            v = 7.0 if (g == "hot" and i % 3 == 0) else round(rnd.gauss(0, 10), 3)
            rows.append((g, v if i % 50 else None))
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {r.g: [r[f"p{i}"] for i in range(len(probs))]
           for r in quantiles.exact_percentiles(df, "v", probs, ["g"], bins=16).collect()}
    want = {r.g: r.q for r in df.groupBy("g").agg(
        F.percentile("v", F.array(*[F.lit(p) for p in probs])).alias("q")).collect()}
    for g in want:
        for a, b in zip(got[g], want[g]):
            assert abs(a - b) <= 1e-9 * max(1.0, abs(b))


def test_pooled_single_group(spark):
    df = spark.range(10001).select((F.col("id") % 97).cast("double").alias("v"))
    r = quantiles.exact_percentiles(df, "v", [0.5, 0.9]).first()
    w = df.agg(F.percentile("v", F.array(F.lit(0.5), F.lit(0.9))).alias("q")).first().q
    assert abs(r.p0 - w[0]) < 1e-9 and abs(r.p1 - w[1]) < 1e-9
