"""Aggregations (D3-D10, D12): summaries, correlation, regression metrics.

Everything is a grouped aggregate with map-side partial aggregation
(``count``, ``min``, ``max``, ``avg``, ``corr``, sums) so a hot group is
pre-aggregated in every input task.  Exact percentiles are used where the
result must equal the linear-interpolated quantile.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import quantiles, segments
from ..schemas import KEY, TS, numeric_columns

HIST_BINS = 20  # fixed value: residual histogram bins


def null_counts(df: DataFrame, cols: list[str], key: str | None = KEY) -> DataFrame:
    """D3: per group and column, the number of nulls (long format)."""
    group = [key] if key else []
    agg = (df.groupBy(*group) if group else df).agg(
        *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    pairs = [x for c in cols for x in (F.lit(c), F.col(c))]
    return agg.select(*group, F.stack(F.lit(len(cols)), *pairs).alias("column", "nulls"))


def range_summary(df: DataFrame, key: str = KEY, ts: str = TS) -> DataFrame:
    """Rows, first and last date per series."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"),
                               F.min(ts).alias("min_date"), F.max(ts).alias("max_date"))


def layer_summary(df: DataFrame, key: str = KEY, ts: str = TS) -> DataFrame:
    """Per series rows and date range, plus the layer's feature
    count (columns other than key and date) and numeric column count."""
    n_features = len([c for c in df.columns if c not in (key, ts)])
    n_numeric = len(numeric_columns(df))
    return range_summary(df, key, ts).select(
        "*", F.lit(n_features).alias("features"), F.lit(n_numeric).alias("numeric_columns"))


def describe(df: DataFrame, cols: list[str], key: str = KEY) -> DataFrame:
    """Count, mean, sample std, min, 25/50/75 % (exact, by refining
    selection) and max per series and column.  The columns are read from one
    written copy."""
    rows = segments.written(df.select(key, *cols))
    parts = []
    for c in cols:
        x = F.col(c)
        parts.append(F.struct(F.lit(c).alias("column"), F.count(x).alias("count"),
                              F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
                              F.min(x).cast("double").alias("min"),
                              F.max(x).cast("double").alias("max")).alias(f"_d_{c}"))
    plain = rows.groupBy(key).agg(*parts).select(key, F.inline(F.array(*[F.col(f"_d_{c}") for c in cols])))
    q = quantiles.exact_percentiles_of(rows, cols, [0.25, 0.5, 0.75], key).withColumnsRenamed(
        {key: "_key", "column": "_column"})
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("column") == F.col("_column"))
    return plain.join(q, same).select(key, "column", "count", "mean", "std", "min", F.col("p0").alias("p25"),
                                      F.col("p1").alias("p50"), F.col("p2").alias("p75"), "max")


def correlation(df: DataFrame, cols: list[str], key: str | None = None) -> DataFrame:
    """Pearson correlation of every ordered column pair over pairwise
    complete rows, long format ``(a, b, corr)`` (per ``key`` when given; rows
    with a null key form a group of their own).

    Each task turns its batches into co-moments, one row per group and column
    pair: the count, both means and the centred sums of squares and products
    over the rows that have both values (numpy matrix products, centred by the
    batch's own column means).  These rows merge exactly by the parallel rule
    for co-moments, folded per (group, pair) in the JVM, so a hot group is
    spread over all tasks and a fold holds one small row for each batch."""
    import numpy as np
    import pandas as pd

    p = len(cols)
    upper = [(i, j) for i in range(p) for j in range(i, p)]
    values = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)]
    rows = df.select((F.col(key) if key else F.lit("*")).alias("g"), *values)
    names = [f"x{i}" for i in range(p)]
    ia, ib = (np.array(v) for v in zip(*upper))

    def partial(batches):
        for pdf in batches:
            for g, part in pdf.groupby("g", sort=False, dropna=False):
                x = part[names].to_numpy(dtype="float64", na_value=np.nan)
                m = ~np.isnan(x)
                mid = np.where(m, x, 0.0).sum(axis=0) / np.maximum(m.sum(axis=0), 1)
                x0, mf = np.where(m, x - mid, 0.0), m.astype("float64")
                n = mf.T @ mf
                safe = np.maximum(n, 1.0)
                sx, sxx, sxy = x0.T @ mf, (x0 * x0).T @ mf, x0.T @ x0
                ma = sx / safe
                yield pd.DataFrame({"g": [None if pd.isna(g) else g] * len(upper), "ia": ia, "ib": ib, "n": n[ia, ib],
                                    "ma": (ma + mid[:, None])[ia, ib], "mb": (ma + mid[:, None])[ib, ia],
                                    "ca": (sxx - ma * sx)[ia, ib], "cb": (sxx - ma * sx)[ib, ia],
                                    "cab": (sxy - ma * ma.T * n)[ia, ib]})

    gtype = dict(rows.dtypes)["g"]
    moments = ["n", "ma", "mb", "ca", "cb", "cab"]
    partials = rows.mapInPandas(partial, f"g {gtype}, ia int, ib int, " + ", ".join(f"{c} double" for c in moments))

    def merge(acc, s):
        n = acc["n"] + s["n"]
        part = s["n"] / F.greatest(n, F.lit(1.0))  # pairs without a complete row keep n = 0
        da, db, w = s["ma"] - acc["ma"], s["mb"] - acc["mb"], acc["n"] * part
        return F.struct(n.alias("n"), (acc["ma"] + da * part).alias("ma"), (acc["mb"] + db * part).alias("mb"),
                        (acc["ca"] + s["ca"] + da * da * w).alias("ca"), (acc["cb"] + s["cb"] + db * db * w).alias("cb"),
                        (acc["cab"] + s["cab"] + da * db * w).alias("cab"))

    zero = F.struct(*[F.lit(0.0).alias(c) for c in moments])
    folded = partials.groupBy("g", "ia", "ib").agg(
        F.aggregate(F.sort_array(F.collect_list(F.struct(*moments))), zero, merge).alias("s"))
    corr = F.when((F.col("s.n") > 1) & (F.col("s.ca") > 0) & (F.col("s.cb") > 0),
                  F.col("s.cab") / F.sqrt(F.col("s.ca") * F.col("s.cb")))
    label = F.array(*[F.lit(c) for c in cols])
    one = F.struct(label[F.col("ia")].alias("a"), label[F.col("ib")].alias("b"), corr.alias("corr"))
    two = F.struct(label[F.col("ib")].alias("a"), label[F.col("ia")].alias("b"), corr.alias("corr"))
    sides = F.when(F.col("ia") == F.col("ib"), F.array(one)).otherwise(F.array(one, two))
    res = folded.select(F.col("g").alias(key or "g"), F.inline(sides))
    return res if key else res.drop("g")


def regression_metrics(df: DataFrame, y_true: str = "y_true", y_pred: str = "y_pred",
                       group: list[str] | None = None) -> DataFrame:
    """MAE, RMSE and R^2 = 1 - SSE / (n * var_pop(y))."""
    e = F.col(y_true) - F.col(y_pred)
    g = group or []
    agg = (df.groupBy(*g) if g else df).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.sum(e * e).alias("_sse"),
        F.var_pop(F.col(y_true)).alias("_var"))
    r2 = F.lit(1.0) - F.try_divide(F.col("_sse"), F.col("n") * F.col("_var"))
    return agg.select(*g, "n", "mae", "rmse", r2.alias("r2"))


def residual_histogram(df: DataFrame, residual: str = "residual", bins: int = HIST_BINS,
                       group: list[str] | None = None) -> DataFrame:
    """Equal-width histogram of residuals between their min and max;
    the right edge falls into the last bin.  Output ``bin`` (1..bins),
    ``lo``, ``hi``, ``count``."""
    g = group or []
    if g:  # per-group limits are pre-aggregated and joined back, so a hot group is never gathered
        lims = df.groupBy(*g).agg(F.min(residual).alias("_lo"), F.max(residual).alias("_hi"))
        lims = lims.withColumnsRenamed({c: f"_g_{c}" for c in g})
        same = [df[c].eqNullSafe(lims[f"_g_{c}"]) for c in g]
        joined = df.join(lims, same).drop(*[f"_g_{c}" for c in g])
    else:  # one row of limits: its size is fixed, so it is broadcast
        lims = df.agg(F.min(residual).alias("_lo"), F.max(residual).alias("_hi"))
        joined = df.crossJoin(F.broadcast(lims))
    width = (F.col("_hi") - F.col("_lo")) / bins
    raw = F.floor((F.col(residual) - F.col("_lo")) / width) + 1
    b = F.when(width == 0, F.lit(1)).otherwise(F.least(raw, F.lit(bins))).cast("int")
    counted = joined.where(F.col(residual).isNotNull()).groupBy(*g, b.alias("bin"), "_lo", "_hi").count()
    return counted.select(*g, "bin", (F.col("_lo") + (F.col("bin") - 1) * (F.col("_hi") - F.col("_lo")) / bins).alias("lo"),
                          (F.col("_lo") + F.col("bin") * (F.col("_hi") - F.col("_lo")) / bins).alias("hi"),
                          "count")


def axis_limits(df: DataFrame, col: str = "y_true") -> DataFrame:
    """Min and max of ``col``."""
    return df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))


def argmin_row(df: DataFrame, metric: str, order_col: str) -> DataFrame:
    """The row with the smallest ``metric``, first ``order_col`` wins
    ties (a global top-1: a single-row result)."""
    return df.orderBy(F.col(metric).asc_nulls_last(), F.col(order_col).asc()).limit(1)
