"""Window helpers shared by the per-series operators.

All series windows are ``partitionBy(key)`` (plus, for block scans, a block
column).  A ``HashPartitioning(key)`` satisfies the clustering of every such
spec, so a whole Silver -> Gold chain plans with one Exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..schemas import KEY, TS

TASK_ROWS = 250_000  # aimed-at rows of one task; every sort of a chain of windows holds its task's rows


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df``, of at most ``rows`` rows, dealt by a hash of ``keys`` to so many
    tasks that one has about ``TASK_ROWS`` rows, whatever the size of the
    input.  Aggregates and windows on the keys move no rows again.  Small
    frames stay as they are."""
    if rows <= TASK_ROWS:
        return df
    tasks = max(-(-rows // TASK_ROWS), df.sparkSession.sparkContext.defaultParallelism)
    return df.repartition(tasks, *keys)


def series(key: str = KEY, ts: str | list[str] = TS) -> WindowSpec:
    """Rows of one series in time order.  ``ts`` may be columns that order as
    the time does (block, time), so that windows share a sort with block scans."""
    return Window.partitionBy(key).orderBy(*([ts] if isinstance(ts, str) else ts))


def series_desc(key: str = KEY, ts: str = TS) -> WindowSpec:
    """Rows of one series, newest first (running frames instead of O(n^2)
    ``unboundedFollowing`` frames)."""
    return Window.partitionBy(key).orderBy(F.col(ts).desc())


def whole(key: str = KEY, ts: str | list[str] | None = None) -> WindowSpec:
    """The whole series as one frame (per-series scalars without a join).
    With ``ts``, in time order: one window operator computes it beside what
    runs along ``series``."""
    if ts is None:
        return Window.partitionBy(key)
    return series(key, ts).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def trailing(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(-(n - 1), Window.currentRow)


def running(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def guarded(fn, col: Column | str, w: WindowSpec, n: int) -> Column:
    """``fn(col)`` over the last ``n`` rows, null until ``n`` non-null values
    are in the frame (a rolling window whose minimum count equals its size)."""
    c = F.col(col) if isinstance(col, str) else col
    frame = trailing(w, n)
    return F.when(F.count(c).over(frame) >= n, fn(c).over(frame))


def rolling_mean(col, w: WindowSpec, n: int) -> Column:
    return guarded(F.avg, col, w, n)


def rolling_std(col, w: WindowSpec, n: int) -> Column:
    return guarded(F.stddev_samp, col, w, n)


ROLLED = {"mean": F.sum, "std": F.stddev_samp}


def unbroken(col: str) -> str:
    """Name of the column that ``count_unbroken`` adds for ``col``."""
    return f"_run_{col}"


def count_unbroken(df: DataFrame, cols: list[str], row: str, w: WindowSpec) -> DataFrame:
    """For each column, the values without a null up to this row: ``row`` (the
    row's number from 1) less that of the last null.  One look at a row; a count
    over each frame looks at every row of it."""
    null_at = {c: F.last(F.when(F.col(c).isNull(), F.col(row)), ignorenulls=True).over(running(w)) for c in cols}
    return df.withColumns({unbroken(c): at for c, at in null_at.items()}).withColumns(
        {unbroken(c): F.col(row) - F.coalesce(F.col(unbroken(c)), F.lit(0)) for c in cols})


def rolled(df: DataFrame, wanted: list[tuple[str, str, int]], w: WindowSpec) -> tuple[DataFrame, dict]:
    """``df`` with the windows behind the rolling statistics ``(kind, column,
    n)`` as plain columns (to be dropped), and the statistics over these, null
    until ``n`` non-null values are in the frame.  What is computed from them
    in one step lets Spark join the windows of several operators."""
    raw, stats = {}, {}
    for kind, c, n in wanted:
        frame = trailing(w, n)
        raw[f"_{kind}_{c}_{n}"] = ROLLED[kind](c).over(frame)
        count = unbroken(c)
        if count not in df.columns:
            count = f"_count_{c}_{n}"
            raw[count] = F.count(c).over(frame)
        value = F.col(f"_{kind}_{c}_{n}")
        stats[kind, c, n] = F.when(F.col(count) >= n, value / n if kind == "mean" else value)
    return df.withColumns(raw), stats


def ffill(col: str, w: WindowSpec) -> Column:
    """Last non-null value up to and including this row."""
    return F.last(F.col(col), ignorenulls=True).over(running(w))


def bfill(col: str, w_desc: WindowSpec) -> Column:
    """First non-null value at or after this row (running frame over the
    newest-first order)."""
    return F.last(F.col(col), ignorenulls=True).over(running(w_desc))
