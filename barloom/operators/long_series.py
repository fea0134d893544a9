"""The series operators over segments (see ``segments``): same results as the
window operators of ``clean``, ``scan``, ``indicators`` and ``features``, for
series of any length.

What looks back a bounded number of rows runs the window operator itself over
(series, segment) with a halo.  What runs along the series is computed inside
each segment and completed by a carry: fill values, nearest valid neighbours,
moving averages, on-balance volume.  What is known of a whole series only
(fences, flags, length) is aggregated by segment first and attached to the
segments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..functions import windows as W
from ..schemas import KEY, MACD_FAST, MACD_SIGNAL, MACD_SLOW, TEST_SIZE, TS, VAL_SIZE
from . import clean, scan, segments
from .segments import HALO, LENGTH, NO_KEY, POS, SEG, Latest, Recurrence, Segments, Total

def own() -> Column:
    return F.col(HALO) == 0


def _valid_at(c: str) -> Column:
    """A row's position where ``c`` has a value, for min_by and max_by."""
    return F.when(F.col(c).isNotNull(), F.col(POS))


def attach_per_series(parts: Segments, table: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """The rows with the columns of a table of one row a series: joined to the
    list of segments, and from there by segment."""
    named = table.withColumn(parts.key, F.coalesce(F.col(parts.key), F.lit(NO_KEY))) if parts.null_keys else table
    ids = parts.summary(F.lit(1).alias("_one")).drop("_one")
    return parts.attach(segments.per_series(ids, segments.written(named), parts.key, F.col(SEG), "left"), rows=rows)


# ------------------------------------------------------------------- E1
def fill(parts: Segments, cols: list[str]) -> DataFrame:
    """The last value before a gap, the first value of the series for the
    rows before it; rows of a series that has none of a column are dropped."""
    ends = []
    for c in cols:
        at = _valid_at(c)
        ends += [F.max(at.isNotNull()).alias(f"l_{c}_has"), F.coalesce(F.max_by(c, at), F.lit(0.0)).alias(f"l_{c}_v"),
                 F.coalesce(F.min_by(c, at), F.lit(0.0)).alias(f"f_{c}_v")]
    ends = segments.written(parts.summary(*ends).withColumns({f"f_{c}_has": F.col(f"l_{c}_has") for c in cols}))
    before = parts.carry(ends, [Latest(f"l_{c}") for c in cols])
    after = parts.carry(ends, [Latest(f"f_{c}") for c in cols], reverse=True)
    rows = parts.attach(ends, before, after)
    run = parts.running()
    filled = {c: F.coalesce(
        F.last(c, ignorenulls=True).over(run),
        F.when(F.col(f"in_l_{c}_has"), F.col(f"in_l_{c}_v")),
        F.when(F.col(f"f_{c}_has"), F.col(f"f_{c}_v")),
        F.when(F.col(f"in_f_{c}_has"), F.col(f"in_f_{c}_v"))) for c in cols}
    return rows.withColumns(filled).select(*parts.rows.columns).dropna(subset=cols)


# --------------------------------------------------------------- D1, E2
def interpolate(parts: Segments, fences: DataFrame, cols: list[str]) -> DataFrame:
    """Values outside the fences (one row a series, ``_lo_<c>`` and
    ``_hi_<c>``) are filled from the nearest valid rows, in whatever segment
    these lie."""
    rows = attach_per_series(parts, fences)
    masked = rows.withColumns({c: F.when(~F.coalesce((F.col(c) < F.col(f"_lo_{c}")) | (F.col(c) > F.col(f"_hi_{c}")),
                                                     F.lit(False)), F.col(c)) for c in cols})
    ends, at = [], {c: _valid_at(c) for c in cols}
    for c in cols:
        ends += [F.max(at[c].isNotNull()).alias(f"l_{c}_has"),
                 F.coalesce(F.max_by(c, at[c]), F.lit(0.0)).alias(f"l_{c}_v"),
                 F.coalesce(F.max(at[c]), F.lit(0)).cast("double").alias(f"l_{c}_p"),
                 F.coalesce(F.min_by(c, at[c]), F.lit(0.0)).alias(f"f_{c}_v"),
                 F.coalesce(F.min(at[c]), F.lit(0)).cast("double").alias(f"f_{c}_p")]
    ends = segments.written(parts.summary(*ends, rows=masked).withColumns(
        {f"f_{c}_has": F.col(f"l_{c}_has") for c in cols}))
    before = parts.carry(ends, [Latest(f"l_{c}", ("v", "p")) for c in cols])
    after = parts.carry(ends, [Latest(f"f_{c}", ("v", "p")) for c in cols], reverse=True)
    rows = parts.attach(before, after, rows=masked)
    run, back = parts.running(), parts.backwards()

    def seen(c: str, w) -> Column:
        return F.last(F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("v"), F.col(POS).cast("double").alias("p"))),
                      ignorenulls=True).over(w)

    def carried(c: str) -> Column:
        return F.when(F.col(f"{c}_has"), F.struct(F.col(f"{c}_v").alias("v"), F.col(f"{c}_p").alias("p")))

    rows = rows.withColumns({f"_prev_{c}": F.coalesce(seen(c, run), carried(f"in_l_{c}")) for c in cols})
    rows = rows.withColumns({f"_next_{c}": F.coalesce(seen(c, back), carried(f"in_f_{c}")) for c in cols})
    out = {}
    for c in cols:
        prev, nxt = F.col(f"_prev_{c}"), F.col(f"_next_{c}")
        slope = (nxt["v"] - prev["v"]) / (nxt["p"] - prev["p"])
        out[c] = (F.when(F.col(c).isNotNull(), F.col(c)).when(prev.isNull(), F.lit(None).cast("double"))
                  .when(nxt.isNull(), prev["v"]).otherwise(slope * (F.col(POS) - prev["p"]) + prev["v"]))
    return rows.withColumns(out).select(*parts.rows.columns)


def fences(parts: Segments, cols: list[str]) -> DataFrame:
    """D1 over the rows of ``parts``, one row a series."""
    bounds = clean.iqr_bounds(parts.rows.where(own()), cols, parts.key)
    return clean.wide_fences(bounds, cols, parts.key)


# ------------------------------------------------------------------- B6
def repair(parts: Segments) -> DataFrame:
    """The flags of a series are those of its segments taken together."""
    o, h, l, c = (F.col(x) for x in ("open", "high", "low", "close"))
    swap = F.coalesce(h < l, F.lit(False))
    rows = parts.rows.withColumns({"high": F.when(swap, l).otherwise(h), "low": F.when(swap, h).otherwise(l)})
    bad = parts.summary(F.bool_or(F.coalesce((h < o) | (h < c), F.lit(False))).alias("_bad_high"),
                        F.bool_or(F.coalesce((l > o) | (l > c), F.lit(False))).alias("_bad_low"), rows=rows)
    flags = bad.groupBy(parts.key).agg(F.bool_or("_bad_high").alias("_bad_high"), F.bool_or("_bad_low").alias("_bad_low"))
    rows = attach_per_series(parts, flags, rows)
    return rows.withColumns({
        "high": F.when(F.col("_bad_high"), F.greatest(o, h, c)).otherwise(h),
        "low": F.when(F.col("_bad_low"), F.least(o, l, c)).otherwise(l)}).drop("_bad_high", "_bad_low")


def previous(parts: Segments, c: str) -> tuple[DataFrame, Column]:
    """A table to attach, and the column with the row before's ``c``."""
    last = F.max_by(F.struct(F.col(c).alias("v")), POS)["v"]
    ends = parts.summary(last.alias("v")).select(
        *parts.by, F.lit(True).alias("r_has"), F.col("v").isNotNull().cast("double").alias("r_ok"),
        F.coalesce("v", F.lit(0.0)).alias("r_v"))
    before = parts.carry(ends, [Latest("r", ("ok", "v"))])
    w = parts.window()
    carried = F.when(F.col("in_r_has") & (F.col("in_r_ok") == 1), F.col("in_r_v"))
    return before, F.when(F.lag(F.lit(1)).over(w).isNull(), carried).otherwise(F.lag(c).over(w))


# ------------------------------------------------------------- E5, E13, E15
def recurrences(parts: Segments, col: str, spans: dict[str, int], rows: DataFrame | None = None) -> DataFrame:
    """E5: exponential averages of ``col`` for ``{name: span}``.  Inside a
    segment the average is ``loc + w * first`` of its first value; what that
    is comes from the carry.  On halo rows the columns mean nothing."""
    rows = parts.rows if rows is None else rows
    for s in spans.values():
        if s > 1 and scan.block_rows([s]) < parts.size:
            raise ValueError(f"segments of {parts.size} rows are too long for span {s}")
    w = parts.window()
    run, before = W.running(w), w.rowsBetween(Window.unboundedPreceding, -1)
    valid = own() & F.col(col).isNotNull()
    at = F.when(valid, F.col(POS))
    out = rows.withColumns({"_p": F.count(at).over(run) - 1, "_gap": F.col(POS) - F.last(at, ignorenulls=True).over(before)})
    later = valid & (F.col("_p") >= 1)
    decay = {n: 1.0 - 2.0 / (s + 1.0) for n, s in spans.items()}

    def past(b: float, gap: Column) -> Column:
        old = F.pow(F.lit(b), gap)
        return F.when(gap > 1, old / (old + (1.0 - b))).otherwise(F.lit(b))

    out = out.withColumns({f"_w_{n}": F.pow(F.lit(b), F.greatest(F.col("_p"), F.lit(0))) * F.exp(F.sum(
        F.when(later & (F.col("_gap") > 1), F.log(past(b, F.col("_gap")) / b)).otherwise(0.0)).over(run))
        if b > 0 else F.when(F.col("_p") >= 1, 0.0).otherwise(1.0) for n, b in decay.items()})
    out = out.withColumns({f"_loc_{n}": F.col(f"_w_{n}") * F.sum(
        F.when(later, (1.0 - past(b, F.col("_gap"))) * F.col(col) / F.col(f"_w_{n}")).otherwise(0.0)).over(run)
        if b > 0 else F.when(F.col("_p") >= 1, F.last(F.when(valid, F.col(col)), ignorenulls=True).over(run)).otherwise(0.0)
        for n, b in decay.items()})
    seen = F.when(F.col(col).isNotNull(), F.col(POS))
    n_rows = F.max(POS) - F.min(POS) + 1
    ends = [F.max(seen.isNotNull()).alias("e_has"),
            F.coalesce(F.min(seen) - F.min(POS), n_rows).cast("double").alias("e_lead"),
            F.coalesce(F.max(POS) - F.max(seen), F.lit(0)).cast("double").alias("e_trail"),
            F.coalesce(F.min_by(col, seen), F.lit(0.0)).alias("e_x")]
    for i, n in enumerate(spans):
        ends += [F.coalesce(F.max_by(f"_loc_{n}", seen), F.lit(0.0)).alias(f"e_loc{i}"),
                 F.coalesce(F.max_by(f"_w_{n}", seen), F.lit(1.0)).alias(f"e_w{i}")]
    ends = segments.written(parts.summary(*ends, rows=out))
    carried = parts.carry(ends, [Recurrence("e", list(spans.values()))])
    out = parts.attach(ends.select(*parts.by, "e_lead", "e_x"), carried, rows=out)
    gap = F.col("in_e_trail") + F.col("e_lead") + 1
    result = {}
    for i, (n, b) in enumerate(decay.items()):
        y = F.col(f"in_e_loc{i}") + F.col(f"in_e_w{i}") * F.col("in_e_x")
        first = F.when(F.col("in_e_has"), past(b, gap) * y + (1.0 - past(b, gap)) * F.col("e_x")).otherwise(F.col("e_x"))
        result[n] = F.when(F.col("_p") >= 0, F.col(f"_loc_{n}") + F.col(f"_w_{n}") * first).when(F.col("in_e_has"), y)
    return out.withColumns(result).select(*rows.columns, *spans)


def running_total(parts: Segments, step: Column, name: str, rows: DataFrame) -> DataFrame:
    """The sum of ``step`` over a row and all rows before it.  ``step`` must
    be 0 outside the own rows."""
    out = rows.withColumn("_sum", F.sum(step).over(parts.running()))
    ends = parts.summary(F.max_by("_sum", POS).alias("t_v"), rows=out)
    carried = parts.carry(ends, [Total("t")])
    return parts.attach(carried, rows=out).withColumn(name, F.col("_sum") + F.col("in_t_v")).select(*rows.columns, name)


def fill_forward(parts: Segments, cols: list[str], rows: DataFrame) -> DataFrame:
    """The last value of every column, in own rows, up to and including a row."""
    ends = []
    for c in cols:
        ends += [F.max(_valid_at(c).isNotNull()).alias(f"l_{c}_has"),
                 F.coalesce(F.max_by(c, _valid_at(c)).cast("double"), F.lit(0.0)).alias(f"l_{c}_v")]
    carried = parts.carry(parts.summary(*ends, rows=rows), [Latest(f"l_{c}") for c in cols])
    out = parts.attach(carried, rows=rows)
    return out.withColumns({c: F.coalesce(
        F.last(F.when(own(), F.col(c)), ignorenulls=True).over(parts.running()),
        F.when(F.col(f"in_l_{c}_has"), F.col(f"in_l_{c}_v"))) for c in cols}).select(*rows.columns)


# ----------------------------------------------------------- plain frames
def ema(df: DataFrame, col: str, spans: dict[str, int], key: str = KEY, ts: str = TS, **sizes) -> DataFrame:
    """E5 on a plain frame, in segments as short as the fastest average needs."""
    rows = min([segments.SEGMENT_ROWS, *(scan.block_rows([s]) for s in spans.values() if s > 1)])
    parts = segments.cut(df, key=key, ts=ts, **({"rows": rows} | sizes))
    return parts.uncut(recurrences(parts, col, spans))


def macd(df: DataFrame, col: str = "close", key: str = KEY, ts: str = TS, **sizes) -> DataFrame:
    """E13 on a plain frame."""
    parts = segments.cut(df, key=key, ts=ts, **sizes)
    rows = recurrences(parts, col, {scan.FAST_COL: MACD_FAST, scan.SLOW_COL: MACD_SLOW})
    parts = parts.keep(rows.withColumn("macd", F.col(scan.FAST_COL) - F.col(scan.SLOW_COL))
                       .drop(scan.FAST_COL, scan.SLOW_COL))
    out = recurrences(parts, "macd", {"macd_signal": MACD_SIGNAL})
    return parts.uncut(out.withColumn("macd_histogram", F.col("macd") - F.col("macd_signal")))


def targets(df: DataFrame, horizon: int = 1, key: str = KEY, ts: str = TS, **sizes) -> DataFrame:
    """E16 + B7: values ``horizon`` rows ahead from the halo, the cut at the
    end of a series from its length."""
    parts = segments.cut(df, ahead=horizon, key=key, ts=ts, **sizes)
    w = parts.window()
    rows = parts.rows.withColumns({"target_close": F.lead("close", horizon).over(w),
                                   "target_return": F.lead("daily_return", horizon).over(w)})
    rows = rows.withColumn("target_direction", S.flag(F.col("target_close") > F.col("close")))
    keep = (F.col(POS) < F.col(LENGTH) - horizon) | (F.col(LENGTH) < horizon + 1)
    return parts.uncut(rows.where(keep))


def _numbered(df: DataFrame, key: str, ts: str, **sizes) -> DataFrame:
    named = segments.written(df.withColumn(key, F.coalesce(key, F.lit(NO_KEY))))
    return segments.number_rows(named, key, ts, **sizes)


def _plain(df: DataFrame, key: str) -> DataFrame:
    return df.drop(POS, LENGTH).withColumn(key, F.nullif(F.col(key), F.lit(NO_KEY)))


def time_split(df: DataFrame, test_size: float = TEST_SIZE, val_size: float = VAL_SIZE, key: str = KEY, ts: str = TS,
               **sizes) -> DataFrame:
    """E20 from positions and lengths."""
    rows = _numbered(df, key, ts, **sizes)
    split = (F.when(F.col(POS) < F.floor(F.col(LENGTH) * F.lit(1.0 - test_size - val_size)), F.lit("train"))
             .when(F.col(POS) < F.floor(F.col(LENGTH) * F.lit(1.0 - test_size)), F.lit("val")).otherwise(F.lit("test")))
    return _plain(rows.withColumn("split", split), key)


def folds(df: DataFrame, k: int = 3, key: str = KEY, ts: str = TS, split_col: str = "split", on: str = "train",
          **sizes) -> DataFrame:
    """E21 from positions and lengths: the first ``n % k`` folds are one row
    longer."""
    train = df.where(F.col(split_col) == on) if split_col in df.columns else df
    rows = _numbered(train, key, ts, **sizes)
    size, longer = F.floor(F.col(LENGTH) / k), F.col(LENGTH) % k
    head = longer * (size + 1)
    fold = F.when(F.col(POS) < head, F.floor(F.col(POS) / (size + 1))).otherwise(
        longer + F.floor(F.try_divide(F.col(POS) - head, size)))
    return _plain(rows.withColumn("fold", fold.cast("int")), key)

