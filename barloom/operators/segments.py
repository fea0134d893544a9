"""Long series in parts: row numbers, segments with halos, prefix scans.

One task never holds a series here.  Three steps replace the window over a
whole series:

* ``number_rows``: rows are counted in time blocks (a block that is too full is
  divided again), the counts are summed up over the blocks, and a row's
  position is its block's base plus its place inside the block.
* ``cut``: position / ``rows`` is the segment.  A segment also gets copies of
  the ``halo`` rows before it and the ``ahead`` rows after it, marked in
  ``_halo``; rolling windows over (series, segment) then see what a window over
  the series would see, and ``uncut`` drops the copies.
* ``carry_in``: what runs along the whole series (last value, sum, moving
  average) is reduced in every segment to a small function, a ``Carry``.
  Functions are composed over groups of ``FAN`` segments, then over groups of
  groups, until one is left, and every segment gets the composition of all
  segments before it (or after it).

Frames in segments are partitioned by (series, segment) and stored, so the
windows, summaries and joins on that pair move no rows again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import EPOCH_NTZ
from ..schemas import KEY, TS
from ..session import ensure_checkpoint_dir, scratch_path

SEG, POS, LENGTH, HALO = "_seg", "_pos", "_length", "_halo"
SEGMENT_ROWS = 512     # rows of one segment; at most what an EMA block can hold, see scan.block_rows
BLOCK_ROWS = 65_536    # aimed-at rows of one time block when rows are numbered
FULL_BLOCK = 8         # a block with so many times that is divided again
FAN = 2048             # segments composed by one task
BROADCAST_SERIES = 100_000  # per-series rows broadcast; above it they are joined by salted keys
SALTS = 64
NO_KEY = "\x00no key"  # stands for a null series key inside this module
TASK_ROWS = 1_000_000  # aimed-at rows of one task


# ----------------------------------------------------------------- storing
def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: the work before it runs
    once, and later passes read the columns they need."""
    path = scratch_path(df.sparkSession, f"long-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a checkpoint, which keeps its partitioning and order."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def per_series(rows: DataFrame, table: DataFrame, key: str, spread: Column, how: str = "inner") -> DataFrame:
    """``rows`` joined to a stored table with one row a series.  The table is
    broadcast when it is small; else the rows of a series are dealt over
    ``SALTS`` copies of its row by a hash of ``spread``."""
    if table.limit(BROADCAST_SERIES + 1).count() <= BROADCAST_SERIES:
        return rows.join(F.broadcast(table), key, how)
    copies = table.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    return salted.join(copies, [key, "_salt"], how).drop("_salt")


def instant(df: DataFrame, ts: str = TS) -> Column:
    """The time column as a whole number."""
    kind = df.schema[ts].dataType
    if isinstance(kind, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, {EPOCH_NTZ}, `{ts}`)")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(F.col(ts))
    if isinstance(kind, T.DateType):
        return F.unix_date(F.col(ts)).cast("long")
    return F.col(ts).cast("long")


# ------------------------------------------------------------------ carries
class Carry:
    """Functions that are composed along a series.  ``columns`` are the
    columns of one function; ``empty`` the function that changes nothing;
    ``then(f, g)`` the function that is first f, then g, for arrays."""

    def __init__(self, name: str):
        self.name = name

    columns: dict[str, str] = {}
    empty: dict[str, float] = {}

    def then(self, f: dict, g: dict) -> dict:
        raise NotImplementedError

    def full(self, column: str) -> str:
        return f"{self.name}_{column}"

    def ddl(self, prefix: str = "") -> list[str]:
        return [f"`{prefix}{self.full(c)}` {t}" for c, t in self.columns.items()]


class Total(Carry):
    """A sum."""

    columns, empty = {"v": "double"}, {"v": 0.0}

    def then(self, f, g):
        return {"v": f["v"] + g["v"]}


class Latest(Carry):
    """The values of the last row that had any: ``has`` and one or more
    doubles."""

    def __init__(self, name: str, values: tuple[str, ...] = ("v",)):
        super().__init__(name)
        self.columns = {"has": "boolean"} | dict.fromkeys(values, "double")
        self.empty = {"has": False} | dict.fromkeys(values, 0.0)

    def then(self, f, g):
        return {"has": f["has"] | g["has"]} | {
            c: np.where(g["has"], g[c], f[c]) for c in self.columns if c != "has"}


class Recurrence(Carry):
    """``y -> loc + w * y`` between the first and the last value of a run of
    rows, for several spans at once, with the nulls before (``lead``) and
    after (``trail``) them: how much the first value weighs depends on the
    rows since the value before it, which only the composition knows.
    ``x`` is the first value; without a value (``has`` false) ``lead`` counts
    the rows."""

    def __init__(self, name: str, spans: list[int]):
        super().__init__(name)
        self.decays = [1.0 - 2.0 / (s + 1.0) for s in spans]
        self.columns = {"has": "boolean", "lead": "double", "trail": "double", "x": "double"}
        self.columns |= {f"{c}{i}": "double" for i in range(len(spans)) for c in ("loc", "w")}
        self.empty = {"has": False, "lead": 0.0, "trail": 0.0, "x": 0.0}
        self.empty |= {f"{c}{i}": v for i in range(len(spans)) for c, v in (("loc", 0.0), ("w", 1.0))}

    def then(self, f, g):
        both, gap = f["has"] & g["has"], f["trail"] + g["lead"] + 1.0
        out = {
            "has": f["has"] | g["has"],
            "lead": np.where(f["has"], f["lead"], f["lead"] + g["lead"]),
            "trail": np.where(g["has"], g["trail"], np.where(f["has"], f["trail"] + g["lead"], 0.0)),
            "x": np.where(f["has"], f["x"], g["x"])}
        for i, b in enumerate(self.decays):
            past = old_share(b, gap)
            loc, w = g[f"w{i}"] * (past * f[f"loc{i}"] + (1.0 - past) * g["x"]), g[f"w{i}"] * past * f[f"w{i}"]
            out[f"loc{i}"] = np.where(both, g[f"loc{i}"] + loc, np.where(g["has"], g[f"loc{i}"], f[f"loc{i}"]))
            out[f"w{i}"] = np.where(both, w, np.where(g["has"], g[f"w{i}"], f[f"w{i}"]))
        return out


def old_share(b: float, gap: np.ndarray) -> np.ndarray:
    """What the past weighs when a value follows after ``gap`` rows."""
    old = np.power(b, gap)
    return np.where(gap > 1, old / (old + (1.0 - b)), b)


# ---------------------------------------------------------------- the scan
def _local(carries: list[Carry], order: list[str], group: list[str], reverse: bool):
    """One group: every row's composition of the rows before it, and, on the
    last row, that of the whole group."""
    def scan(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, ascending=not reverse, kind="stable")
        out = pdf[[*group, *order]].copy()
        m = len(pdf)
        out["_last"] = np.arange(m) == m - 1
        for c in carries:
            x = {k: pdf[c.full(k)].to_numpy(dtype=bool if t == "boolean" else float)
                 for k, t in c.columns.items()}
            d = 1
            while d < m:  # after the step of d, a row holds the rows of the last 2 d places
                new = c.then({k: v[:-d] for k, v in x.items()}, {k: v[d:] for k, v in x.items()})
                x = {k: np.concatenate((v[:d], new[k])) for k, v in x.items()}
                d *= 2
            for k in c.columns:
                out[f"in_{c.full(k)}"] = np.concatenate((np.array([c.empty[k]], x[k].dtype), x[k][:-1]))
                out[f"all_{c.full(k)}"] = x[k]
        return out
    return scan


def _joined(carries: list[Carry], keep: list[str]):
    """Rows with an outer and an inner part: their composition."""
    def compose(batches):
        for pdf in batches:
            out = pdf[keep].copy()
            for c in carries:
                def part(prefix, c=c):
                    return {k: pdf[f"{prefix}{c.full(k)}"].to_numpy(dtype=bool if t == "boolean" else float)
                            for k, t in c.columns.items()}
                for k, v in c.then(part("out_"), part("in_")).items():
                    out[f"in_{c.full(k)}"] = v
            yield out
    return compose


def carry_in(table: DataFrame, carries: list[Carry], largest: int, key: str = KEY, index: str = SEG,
             order: list[str] | None = None, reverse: bool = False, fan: int = FAN) -> DataFrame:
    """For every row of ``table`` (one a segment, with the columns of the
    carries) the composition of all rows of its series before it, in order of
    ``order`` (after it, if ``reverse``), as ``in_<column>``.  ``index``
    (at most ``largest``) decides which rows are composed together."""
    order = order or [index]
    group = f"_g_{index}"
    kinds = {c: table.schema[c].dataType.simpleString() for c in [key, *order]}
    values = [c.full(k) for c in carries for k in c.columns]
    rows = table.select(key, *dict.fromkeys([*order, *([index] if index not in order else [])]), *values) \
                .withColumn(group, F.floor(F.col(index) / fan).cast("long"))
    head = [f"`{key}` {kinds[key]}", f"`{group}` long", *[f"`{o}` {kinds[o]}" for o in order], "`_last` boolean"]
    ins = [d for c in carries for d in c.ddl("in_")]
    schema = ", ".join(head + [d for c in carries for d in (x for pair in zip(c.ddl("in_"), c.ddl("all_")) for x in pair)])
    local = rows.groupBy(key, group).applyInPandas(_local(carries, order, [key, group], reverse), schema)
    if largest < fan:
        return local.drop(group, "_last", *[f"all_{v}" for v in values])
    local = written(local)
    totals = local.where("_last").select(key, group, *[F.col(f"all_{v}").alias(v) for v in values])
    outer = carry_in(totals, carries, largest // fan, key, group, None, reverse, fan)
    outer = outer.withColumnsRenamed({f"in_{v}": f"out_{v}" for v in values})
    both = local.drop("_last", *[f"all_{v}" for v in values]).join(outer, [key, group])
    keep = [key, *order]
    return both.mapInPandas(_joined(carries, keep), ", ".join([head[0], *head[2:-1], *ins]))


# ---------------------------------------------------------------- numbering
def _blocks(df: DataFrame, key: str, ts: str, rows: int) -> tuple[DataFrame, int]:
    """``df`` with the time block (``_b1``, ``_b2``) of every row and the
    series' length, and the largest ``_b1``.  Rows without a time come first."""
    t = instant(df, ts)
    width = F.greatest(F.lit(1), F.ceil((F.col("hi") - F.col("lo") + 1) / F.ceil(F.col(LENGTH) / rows))).cast("long")
    spans = written(df.groupBy(key).agg(F.count(F.lit(1)).alias(LENGTH), F.min(t).alias("lo"), F.max(t).alias("hi"))
                    .select(key, LENGTH, F.col("lo").alias("_lo"), width.alias("_width")))
    first = F.coalesce(F.floor((instant(df, ts) - F.col("_lo")) / F.col("_width")), F.lit(-1)).cast("long")
    placed = per_series(df, spans, key, F.col(ts)).withColumn("_b1", first).drop("_lo", "_width")
    full = written(placed.groupBy(key, "_b1").agg(F.count(F.lit(1)).alias("n"), F.min(t).alias("lo"), F.max(t).alias("hi"))
                   .select(key, "_b1", "n", F.col("lo").alias("_lo"),
                           F.greatest(F.lit(1), F.ceil((F.col("hi") - F.col("lo") + 1) / F.ceil(F.col("n") / rows)))
                           .cast("long").alias("_width")))
    largest = full.agg(F.max("_b1")).first()[0]
    crowded = full.where((F.col("n") > FULL_BLOCK * rows) & (F.col("_b1") >= 0)).drop("n")
    if crowded.isEmpty():
        return placed.withColumn("_b2", F.lit(0).cast("long")), largest or 0
    salt = F.pmod(F.xxhash64(ts), F.lit(SALTS)).cast("int")
    copies = crowded.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    again = placed.withColumn("_salt", salt).join(copies, [key, "_b1", "_salt"], "left")
    second = F.coalesce(F.floor((instant(df, ts) - F.col("_lo")) / F.col("_width")), F.lit(0)).cast("long")
    return again.withColumn("_b2", second).drop("_lo", "_width", "_salt"), largest


def number_rows(df: DataFrame, key: str = KEY, ts: str = TS, block_rows: int = BLOCK_ROWS, fan: int = FAN) -> DataFrame:
    """Adds ``_pos``, the place of a row in its series from 0, and
    ``_length``, the rows of the series.  ``df`` is read four times: pass a
    written frame.  Rows of one time are numbered in any order."""
    placed, largest = _blocks(df, key, ts, block_rows)
    counts = placed.groupBy(key, "_b1", "_b2").agg(F.count(F.lit(1)).cast("double").alias("n_v"))
    base = carry_in(counts.withColumn("_i", F.greatest("_b1", F.lit(0))), [Total("n")], largest,
                    key, "_i", ["_b1", "_b2"], fan=fan)
    w = Window.partitionBy(key, "_b1", "_b2").orderBy(ts)
    place = placed.withColumn("_place", F.row_number().over(w))
    return (place.join(base, [key, "_b1", "_b2"])
            .withColumn(POS, (F.col("in_n_v") + F.col("_place") - 1).cast("long"))
            .drop("_b1", "_b2", "_place", "in_n_v"))


class Segments:
    """A frame in segments: ``rows`` is stored, partitioned by (series,
    segment) and ordered by time in them; ``largest`` is the last segment."""

    def __init__(self, rows: DataFrame, largest: int, key: str, ts: str, null_keys: bool, size: int, fan: int = FAN):
        self.rows, self.largest, self.key, self.ts, self.null_keys = rows, largest, key, ts, null_keys
        self.size, self.fan, self.by = size, fan, [key, SEG]

    def window(self):
        return Window.partitionBy(*self.by).orderBy(POS)

    def running(self):
        return self.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def backwards(self):
        return Window.partitionBy(*self.by).orderBy(F.col(POS).desc()).rowsBetween(
            Window.unboundedPreceding, Window.currentRow)

    def keep(self, rows: DataFrame) -> Segments:
        """The same segments with other columns, stored."""
        return Segments(stored(rows), self.largest, self.key, self.ts, self.null_keys, self.size, self.fan)

    def summary(self, *aggregates: Column, rows: DataFrame | None = None) -> DataFrame:
        """One row a segment, over its own rows."""
        return (rows if rows is not None else self.rows).where(F.col(HALO) == 0).groupBy(*self.by).agg(*aggregates)

    def carry(self, summary: DataFrame, carries: list[Carry], reverse: bool = False) -> DataFrame:
        """``carry_in`` over the summary of the segments."""
        return carry_in(summary, carries, self.largest, self.key, SEG, reverse=reverse, fan=self.fan)

    def attach(self, *tables: DataFrame, rows: DataFrame | None = None) -> DataFrame:
        """The rows with the columns of tables that have one row a segment."""
        out = self.rows if rows is None else rows
        for t in tables:
            out = out.join(t, self.by, "left")
        return out

    def uncut(self, rows: DataFrame | None = None, extra: tuple[str, ...] = ()) -> DataFrame:
        """A plain frame: own rows only, without the helper columns."""
        rows = (self.rows if rows is None else rows).where(F.col(HALO) == 0)
        rows = rows.drop(*[c for c in (SEG, POS, LENGTH, HALO) if c not in extra])
        return rows.withColumn(self.key, F.nullif(F.col(self.key), F.lit(NO_KEY))) if self.null_keys else rows


def cut(df: DataFrame, halo: int = 0, ahead: int = 0, rows: int = SEGMENT_ROWS, key: str = KEY, ts: str = TS,
        block_rows: int = BLOCK_ROWS, fan: int = FAN) -> Segments:
    """Number the rows of ``df`` and cut every series into segments of
    ``rows`` rows, with copies of the ``halo`` rows before and the ``ahead``
    rows after each."""
    if halo > rows or ahead > rows:
        raise ValueError("a segment must be as long as its halo")
    null_keys = isinstance(df.schema[key].dataType, T.StringType)
    if null_keys:
        df = df.withColumn(key, F.coalesce(key, F.lit(NO_KEY)))
    numbered = number_rows(written(df), key, ts, block_rows, fan)
    seg, place = F.floor(F.col(POS) / rows).cast("long"), F.col(POS) % rows
    here = [F.struct(seg.alias(SEG), F.lit(0).alias(HALO))]
    if halo:  # not past the end of the series
        here.append(F.when((place >= rows - halo) & ((seg + 1) * rows < F.col(LENGTH)),
                           F.struct((seg + 1).alias(SEG), F.lit(-1).alias(HALO))))
    if ahead:
        here.append(F.when((place < ahead) & (seg > 0), F.struct((seg - 1).alias(SEG), F.lit(1).alias(HALO))))
    copies = numbered.select("*", F.inline(F.filter(F.array(*here), lambda s: s.isNotNull())))
    spark = df.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = stored(copies.repartition(tasks, key, SEG).sortWithinPartitions(key, SEG, POS))
    largest = out.agg(F.max(SEG)).first()[0] or 0
    return Segments(out, largest, key, ts, null_keys, rows, fan)


def on_segments(df: DataFrame, work: Callable[[DataFrame, list[str]], DataFrame], halo: int = 0, ahead: int = 0,
                rows: int = SEGMENT_ROWS, key: str = KEY, ts: str = TS, **sizes) -> DataFrame:
    """``work(frame, [series, segment])`` for an operator whose windows reach
    at most ``halo`` rows back and ``ahead`` rows forward."""
    parts = cut(df, halo, ahead, rows, key, ts, **sizes)
    return parts.uncut(work(parts.rows, parts.by))


__all__ = ["Carry", "Latest", "Recurrence", "Segments", "Total", "carry_in", "cut", "number_rows", "on_segments",
           "per_series", "stored", "written"]
