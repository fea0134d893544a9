"""Exact linear-interpolated percentiles by refining selection.

``percentile`` keeps a value -> count map of a whole group in one buffer.  Here
a group may be of any size:

1. the input's columns are written once; one pass gives count, least and
   largest value of every (group, column), and so the ranks that are needed,
   ``floor(h)`` and ``ceil(h)`` with ``h = (n-1)p``;
2. while a range that holds a needed rank has more than ``budget`` rows, all
   such ranges, of all groups and columns, are divided into ``bins`` parts in
   one pass (partial counts with the least and largest value of each part), and
   the part that holds the rank is the next range.  Even rounds divide on a
   signed logarithmic scale, odd ones evenly, between values that occur: the
   least and the largest value of a range never stay together, so ranges
   shrink whatever the distribution, and a value repeated any number of times
   ends as a range of its own;
3. the values in the ranges that are left are counted by value and the rank is
   looked up: at most ``budget`` rows a range;
4. ``v_lo + (h - floor(h)) (v_hi - v_lo)``: the definition of Spark's
   ``percentile`` and DuckDB's ``quantile_cont``.

Nulls and NaN are left out; null groups are one group; a (group, column)
without a value gives null percentiles and n = 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import segments

DEFAULT_BINS = 1024
BUDGET = 100_000  # rows of a range whose values are counted one by one
ABOVE_LEAST = 746.0  # the logarithm of every double above 0 is larger than minus this
GROUP, LIVE = "_g", ["_g", "c", "lo", "hi"]


def exact_percentiles_of(df: DataFrame, cols: list[str], probs: list[float], group: str | None = None,
                         bins: int = DEFAULT_BINS, budget: int = BUDGET) -> DataFrame:
    """One row for each group and column: ``group`` (if given), ``column``,
    ``n`` and ``p<i>`` for every probability."""
    name = F.coalesce(F.col(group).cast("string"), F.lit(segments.NO_KEY)) if group else F.lit("")
    doubles = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(f"x{i}")
               for i, c in enumerate(cols)]
    rows = segments.written(df.select(name.alias(GROUP), *doubles))
    items = F.array(*[F.struct(F.lit(i).alias("c"), F.col(f"x{i}").alias("x")) for i in range(len(cols))])
    # one wide partial aggregate, then one row a column
    first = rows.groupBy(GROUP).agg(*[
        F.struct(F.lit(i).alias("c"), F.count(f"x{i}").alias("n"), F.min(f"x{i}").alias("lo"),
                 F.max(f"x{i}").alias("hi")).alias(f"s{i}") for i in range(len(cols))])
    sizes = segments.written(first.select(GROUP, F.inline(F.array(*[F.col(f"s{i}") for i in range(len(cols))]))))
    p = F.explode(F.array(*[F.lit(float(p)) for p in probs]))
    ranks = sizes.where("n > 0").select("*", p.alias("p")).withColumn("h", (F.col("n") - 1) * F.col("p"))
    live = ranks.select(GROUP, "c", F.explode(F.array(F.floor("h"), F.ceil("h"))).alias("r"), "lo", "hi", "n",
                        F.lit(0).cast("long").alias("before")).distinct()
    live = segments.written(live)
    settled = []
    round_ = 0
    while True:
        crowded = (F.col("n") > budget) & (F.col("lo") < F.col("hi"))
        settled.append(live.where(~crowded))
        live = live.where(crowded)
        if live.isEmpty():
            break
        part = F.least(F.floor(_share(round_ % 2 == 0) * bins), F.lit(bins - 1)).cast("int")
        inside = _inside(rows, items, live)
        parts = inside.groupBy(*LIVE, part.alias("bin")).agg(
            F.count(F.lit(1)).alias("m"), F.min("x").alias("new_lo"), F.max("x").alias("new_hi"))
        upto = Window.partitionBy(*LIVE).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        parts = parts.withColumn("off", F.coalesce(F.sum("m").over(upto), F.lit(0)))
        at = F.col("before") + F.col("off")
        live = live.join(parts, LIVE).where((F.col("r") >= at) & (F.col("r") < at + F.col("m"))).select(
            GROUP, "c", "r", F.col("new_lo").alias("lo"), F.col("new_hi").alias("hi"), F.col("m").alias("n"),
            at.alias("before"))
        live = segments.written(live)
        round_ += 1
    found = settled[0]
    for more in settled[1:]:
        found = found.unionByName(more)
    found = segments.written(found)
    single = found.where("lo = hi").select(GROUP, "c", "r", F.col("lo").alias("v"))
    ranges = found.where("lo < hi")
    values = _inside(rows, items, ranges).groupBy(*LIVE, "x").agg(F.count(F.lit(1)).alias("m"))
    upto = Window.partitionBy(*LIVE).orderBy("x").rowsBetween(Window.unboundedPreceding, -1)
    values = values.withColumn("off", F.coalesce(F.sum("m").over(upto), F.lit(0)))
    at = F.col("before") + F.col("off")
    looked_up = ranges.join(values, LIVE).where((F.col("r") >= at) & (F.col("r") < at + F.col("m")))
    order = segments.written(single.unionByName(looked_up.select(GROUP, "c", "r", F.col("x").alias("v"))))
    # ranks back to percentiles: a row a (group, column) holds a value for each needed rank
    by_rank = order.groupBy(GROUP, "c").agg(F.map_from_entries(F.collect_list(F.struct("r", "v"))).alias("v"))
    out = sizes.join(by_rank, [GROUP, "c"], "left")
    results = []
    for i, q in enumerate(probs):
        h = (F.col("n") - 1) * F.lit(float(q))
        lo, hi = F.col("v")[F.floor(h)], F.col("v")[F.ceil(h)]
        results.append((lo + (h - F.floor(h)) * (hi - lo)).alias(f"p{i}"))
    label = F.array(*[F.lit(c) for c in cols])[F.col("c")].alias("column")
    key = [F.nullif(F.col(GROUP), F.lit(segments.NO_KEY)).cast(df.schema[group].dataType).alias(group)] if group else []
    return out.select(*key, label, "n", *results)


def _share(log: bool) -> Column:
    """Where x lies between lo and hi, from 0 to 1; grows with x."""
    even = (F.col("x") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)
    if not log:
        return even

    def scale(c: str) -> Column:
        size = F.when(F.col(c) == 0, 0.0).otherwise(F.log(F.abs(F.col(c))) + ABOVE_LEAST)
        return F.signum(c) * size

    return F.when(scale("lo") < scale("hi"), (scale("x") - scale("lo")) / (scale("hi") - scale("lo"))).otherwise(even)


def _inside(rows: DataFrame, items: Column, ranges: DataFrame) -> DataFrame:
    """The values that lie in a range, with it.  Ranges of a (group, column)
    do not overlap; a group has at most two for each column and percentile."""
    of_group = ranges.select(*LIVE).distinct().groupBy(GROUP).agg(F.collect_list(F.struct("c", "lo", "hi")).alias("_r"))
    wide = segments.per_series(rows, segments.written(of_group), GROUP, F.struct(*[c for c in rows.columns if c != GROUP]))
    near = F.transform("_r", lambda r: F.struct(r["c"].alias("c"), r["lo"].alias("lo"), r["hi"].alias("hi"),
                                                items[r["c"]]["x"].alias("x")))
    return wide.select(GROUP, F.inline(F.filter(near, lambda s: (s["x"] >= s["lo"]) & (s["x"] <= s["hi"]))))


def exact_percentiles(df: DataFrame, value: str, probs: list[float], group: list[str] | None = None,
                      bins: int = DEFAULT_BINS, budget: int = BUDGET) -> DataFrame:
    """One column: per group (no or one column), one row with ``p<i>``."""
    if len(group or []) > 1:
        raise ValueError("one grouping column at most")
    out = exact_percentiles_of(df, [value], probs, group[0] if group else None, bins, budget)
    return out.where("n > 0").drop("column", "n")
