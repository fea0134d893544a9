"""DuckDB SQL for the correctness gate.

Each function returns CTE text; ``sql()`` joins them into one statement.
The tables ``lineitem``, ``supplier``, ``events`` ... are views registered by
the checking tool.  Doubles are rounded on both sides to a binary grid of
2^-14 (~6e-5), ``round(x * 16384) / 16384 + 0.0``: scaling by a power of two
is exact, both engines round half away from zero, and ``+ 0.0`` folds -0.0
into 0.0.  A decimal grid puts exact ties on values built from 2-decimal
prices (EMA, averages), where last-bit noise between two correct summation
orders flips the rounding; dyadic midpoints never coincide with such values.
Literal doubles carry an explicit ``::DOUBLE`` (DuckDB reads ``0.75`` as
DECIMAL).
"""

from __future__ import annotations

import math

from ..schemas import (GOLD_COLUMNS, LAG_FEATURES, MA_WINDOWS, MACD_FAST, MACD_SIGNAL,
                       MACD_SLOW, PIPELINE_MAX_LAG, PRICE_COLS, PRIORITY_FEATURES,
                       RSI_WINDOW, TARGET_COLUMNS, TEST_SIZE, TRADING_DAYS, VAL_SIZE,
                       VOLATILITY_WINDOWS)
from ..sources import bars as B

K = "series_key"


def D(x: float) -> str:
    return f"{float(x)!r}::DOUBLE"


GRID = 16384.0  # 2^14: doubles are compared on a binary grid of ~6e-5


def R(e: str) -> str:
    return f"(round(({e})::DOUBLE * {GRID!r}::DOUBLE) / {GRID!r}::DOUBLE + 0.0)"


def sql(ctes: list[tuple[str, str]], final: str) -> str:
    body = ",\n".join(f"{n} AS (\n{q}\n)" for n, q in ctes)
    return f"WITH RECURSIVE {body}\n{final}"


def W(order: str = "date", frame: str | None = None) -> str:
    f = f" {frame}" if frame else ""
    return f"(PARTITION BY {K} ORDER BY {order}{f})"


def ROWS(n: int) -> str:
    return W("date", f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW")


RUN = W("date", "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW")
FOLLOW = W("date", "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING")
WHOLE = f"(PARTITION BY {K})"


# ---------------------------------------------------------------- fixtures
SERIES_KEYS = {"flag": "l_returnflag || '-' || l_linestatus",
               "supplier": "'supp-' || CAST(l_suppkey AS VARCHAR)"}


def lineitem_bars(by: str = "flag") -> list[tuple[str, str]]:
    tie = "(l_orderkey, l_linenumber, l_extendedprice)"
    q = f"""SELECT {SERIES_KEYS[by]} AS {K},
  CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS date,
  arg_min(l_extendedprice, {tie}) AS open, max(l_extendedprice) AS high,
  min(l_extendedprice) AS low, arg_max(l_extendedprice, {tie}) AS close,
  sum(l_quantity) AS volume
FROM lineitem GROUP BY 1, 2"""
    return [("bars", q)]


def event_bars() -> list[tuple[str, str]]:
    tie = "(ts, event_id)"
    q = f"""SELECT event_type AS {K}, date_trunc('hour', ts) AS date,
  arg_min(value, {tie}) AS open, max(value) AS high, min(value) AS low,
  arg_max(value, {tie}) AS close, CAST(count(*) AS DOUBLE) AS volume
FROM events GROUP BY 1, 2"""
    return [("ebars", q)]


def rn_bars(src: str = "bars", name: str = "rbars") -> list[tuple[str, str]]:
    return [(name, f"SELECT *, row_number() OVER {W()} AS rn, count(*) OVER {WHOLE} AS n FROM {src}")]


def dirty_bars(by: str = "flag") -> list[tuple[str, str]]:
    q = f"""SELECT {K},
  CASE WHEN rn % {B.OPEN_X10_EVERY} = 0 OR rn = 1 OR rn = n THEN open * 10 ELSE open END AS open,
  CASE WHEN rn % {B.SWAP_HIGH_LOW_EVERY} = 0 THEN low ELSE high END AS high,
  CASE WHEN rn % {B.SWAP_HIGH_LOW_EVERY} = 0 THEN high ELSE low END AS low,
  CASE WHEN rn % {B.NULL_CLOSE_EVERY} = 0 THEN NULL
       WHEN rn BETWEEN {B.FLAT_CLOSE_FROM} AND {B.FLAT_CLOSE_TO}
         THEN max(CASE WHEN rn = {B.FLAT_CLOSE_FROM} THEN close END) OVER {WHOLE}
       ELSE close END AS close,
  volume, date
FROM rbars"""
    src = ([(n, q0) for n, q0 in event_bars()] + [("bars", "SELECT * FROM ebars")]
           if by == "events" else lineitem_bars(by))
    return src + rn_bars() + [("dirty", q)]


def text_bars(by: str = "flag") -> list[tuple[str, str]]:
    q = f"""SELECT {K}, CAST(open AS VARCHAR) AS open, CAST(high AS VARCHAR) AS high,
  CAST(low AS VARCHAR) AS low,
  CASE WHEN row_number() OVER {W()} % {B.TEXT_NA_EVERY} = 0 THEN 'n/a' ELSE CAST(close AS VARCHAR) END AS close,
  CAST(volume AS VARCHAR) AS volume, strftime(date, '%Y-%m-%d %H:%M:%S') AS date
FROM dirty"""
    return dirty_bars(by) + [("textbars", q)]


# ------------------------------------------------------------------ silver
def coerced(src: str = "textbars") -> list[tuple[str, str]]:
    cols = ", ".join(f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in ["open", "high", "low", "close", "volume"])
    return [("coerced", f"SELECT {K}, {cols}, TRY_CAST(date AS TIMESTAMP) AS date FROM {src}")]


def filled(src: str = "coerced") -> list[tuple[str, str]]:
    cols = ", ".join(
        f"coalesce(last_value({c} IGNORE NULLS) OVER {RUN}, first_value({c} IGNORE NULLS) OVER {FOLLOW}) AS {c}"
        for c in ["open", "high", "low", "close", "volume"])
    q1 = f"SELECT {K}, date, {cols} FROM {src} WHERE date IS NOT NULL"
    q2 = ("SELECT * FROM filled0 WHERE " +
          " AND ".join(f"{c} IS NOT NULL" for c in ["open", "high", "low", "close", "volume"]))
    return [("filled0", q1), ("filled", q2)]


def fences(src: str, cols=PRICE_COLS, name: str = "fences") -> list[tuple[str, str]]:
    parts = []
    for c in cols:
        parts.append(f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}")
    q = f"SELECT {K}, {', '.join(parts)} FROM {src} GROUP BY {K}"
    lim = []
    for c in cols:
        lim.append(f"q1_{c} - {D(1.5)} * (q3_{c} - q1_{c}) AS lo_{c}, q3_{c} + {D(1.5)} * (q3_{c} - q1_{c}) AS hi_{c}")
    q2 = f"SELECT *, {', '.join(lim)} FROM {name}0"
    return [(f"{name}0", q), (name, q2)]


def interpolated(src: str = "filled") -> list[tuple[str, str]]:
    ctes = [("pos", f"SELECT *, row_number() OVER {W()} AS pos FROM {src}")]
    ctes += fences("pos")
    masked = ", ".join(
        f"CASE WHEN coalesce(p.{c} < f.lo_{c} OR p.{c} > f.hi_{c}, false) THEN NULL ELSE p.{c} END AS {c}"
        for c in PRICE_COLS)
    ctes.append(("masked", f"SELECT p.{K}, p.date, p.pos, p.volume, {masked} FROM pos p JOIN fences f USING ({K})"))
    nb = []
    for c in PRICE_COLS:
        kp = f"CASE WHEN {c} IS NOT NULL THEN pos END"
        nb.append(f"last_value({c} IGNORE NULLS) OVER {RUN} AS pv_{c}, last_value({kp} IGNORE NULLS) OVER {RUN} AS pp_{c}, "
                  f"first_value({c} IGNORE NULLS) OVER {FOLLOW} AS nv_{c}, first_value({kp} IGNORE NULLS) OVER {FOLLOW} AS np_{c}")
    ctes.append(("nbrs", f"SELECT *, {', '.join(nb)} FROM masked"))
    vals = ", ".join(
        f"CASE WHEN {c} IS NOT NULL THEN {c} WHEN pv_{c} IS NULL THEN NULL WHEN nv_{c} IS NULL THEN pv_{c} "
        f"ELSE (nv_{c} - pv_{c}) / (np_{c} - pp_{c}) * (pos - pp_{c}) + pv_{c} END AS {c}" for c in PRICE_COLS)
    ctes.append(("interp", f"SELECT {K}, {vals}, volume, date FROM nbrs"))
    return ctes


def repaired(src: str = "interp") -> list[tuple[str, str]]:
    q1 = f"""SELECT {K}, open, CASE WHEN high < low THEN low ELSE high END AS high,
  CASE WHEN high < low THEN high ELSE low END AS low, close, volume, date FROM {src}"""
    q2 = f"""SELECT *, coalesce(bool_or(coalesce(high < open OR high < close, false)) OVER {WHOLE}, false) AS bad_high,
  coalesce(bool_or(coalesce(low > open OR low > close, false)) OVER {WHOLE}, false) AS bad_low FROM swapped"""
    q3 = f"""SELECT {K}, open, CASE WHEN bad_high THEN greatest(open, high, close) ELSE high END AS high,
  CASE WHEN bad_low THEN least(open, low, close) ELSE low END AS low, close, volume, date FROM flagged"""
    return [("swapped", q1), ("flagged", q2), ("repaired", q3)]


def derived(src: str = "repaired", name: str = "silver") -> list[tuple[str, str]]:
    q = f"""SELECT {K}, open, high, low, close, volume, date,
  ln(close / nullif(lag(close) OVER {W()}, 0)) AS daily_return,
  high - low AS price_range, (open + high + low + close) / 4 AS avg_price,
  volume / {D(1_000_000)} AS volume_millions,
  CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, CAST(month(date) AS INTEGER) AS month,
  CAST(year(date) AS INTEGER) AS year
FROM {src}"""
    return [(name, q)]


def silver(by: str = "flag") -> list[tuple[str, str]]:
    return text_bars(by) + coerced() + filled() + interpolated() + repaired() + derived()


SILVER_COLS = ["open", "high", "low", "close", "volume", "daily_return", "price_range",
               "avg_price", "volume_millions", "day_of_week", "month", "year"]


# -------------------------------------------------------------------- gold
def guarded(fn: str, c: str, n: int) -> str:
    return f"CASE WHEN count({c}) OVER {ROWS(n)} >= {n} THEN {fn}({c}) OVER {ROWS(n)} END"


def ema_rec(src: str, col: str, spans: dict[str, int], name: str,
            signal: tuple[str, str, int] | None = None) -> list[tuple[str, str]]:
    """Recursive CTE: the sequential EMA recurrence per series.  ``signal`` =
    (fast_name, slow_name, span) adds ``macd`` and its EMA."""
    inp = f"{name}_in"
    ctes = [(inp, f"SELECT {K}, date, {col} AS x, row_number() OVER {W()} AS rn FROM {src}")]
    init = [f"x AS {n}" for n in spans]
    step = []
    for n, s in spans.items():
        a = 2.0 / (s + 1.0)
        step.append(f"CASE WHEN r.{n} IS NULL THEN i.x ELSE {D(1 - a)} * r.{n} + {D(a)} * i.x END AS {n}")
    if signal:
        f, sl, s = signal
        a = 2.0 / (s + 1.0)
        init.append(f"x - x AS macd_signal_raw")
        m = f"(({step_expr(spans, f)}) - ({step_expr(spans, sl)}))"
        step.append(f"CASE WHEN r.macd_signal_raw IS NULL THEN {m} ELSE {D(1 - a)} * r.macd_signal_raw + {D(a)} * {m} END AS macd_signal_raw")
    q = f"""SELECT {K}, rn, date, {', '.join(init)} FROM {inp} WHERE rn = 1
UNION ALL
SELECT i.{K}, i.rn, i.date, {', '.join(step)}
FROM {name} r JOIN {inp} i ON i.{K} = r.{K} AND i.rn = r.rn + 1"""
    ctes.append((name, q))
    return ctes


def step_expr(spans: dict[str, int], n: str) -> str:
    a = 2.0 / (spans[n] + 1.0)
    return f"CASE WHEN r.{n} IS NULL THEN i.x ELSE {D(1 - a)} * r.{n} + {D(a)} * i.x END"


def gold_indicators(src: str = "silver") -> list[tuple[str, str]]:
    ctes = []
    spans = {f"ema_{n}": n for n in MA_WINDOWS}
    spans.update({"ema_fast": MACD_FAST, "ema_slow": MACD_SLOW})
    rec = ema_rec(src, "close", spans, "emas", ("ema_fast", "ema_slow", MACD_SIGNAL))
    # the signal's first value is the first macd: fix the seed row
    ctes += rec
    cols = []
    for n in MA_WINDOWS:
        cols.append(f"{guarded('avg', 'close', n)} AS sma_{n}")
    ctes.append(("g1", f"SELECT s.*, {', '.join(cols)}, close - lag(close) OVER {W()} AS delta, "
                       f"greatest(high - low, abs(high - lag(close) OVER {W()}), abs(low - lag(close) OVER {W()})) AS tr, coalesce(sign(close - lag(close) OVER {W()}) * volume, {D(0)}) AS obv_step FROM {src} s"))
    ema_cols = ", ".join(f"e.ema_{n}" for n in MA_WINDOWS)
    ctes.append(("g2", f"""SELECT g.*, {ema_cols}, e.ema_fast - e.ema_slow AS macd,
  CASE WHEN e.rn = 1 THEN e.ema_fast - e.ema_slow ELSE e.macd_signal_raw END AS macd_signal,
  coalesce(greatest(delta, {D(0)}), {D(0)}) AS gain, coalesce(greatest(-delta, {D(0)}), {D(0)}) AS loss
FROM g1 g JOIN emas e ON e.{K} = g.{K} AND e.date = g.date"""))
    c3 = [f"close / nullif(sma_{n}, 0) AS price_sma_ratio_{n}" for n in MA_WINDOWS]
    c3.append(f"{guarded('avg', 'gain', RSI_WINDOW)} AS avg_gain")
    c3.append(f"{guarded('avg', 'loss', RSI_WINDOW)} AS avg_loss")
    c3.append(f"count(*) OVER {WHOLE} AS n_rows")
    for n in VOLATILITY_WINDOWS:
        c3.append(f"{guarded('stddev_samp', 'daily_return', n)} * {D(math.sqrt(TRADING_DAYS))} AS volatility_{n}")
        c3.append(f"{guarded('avg', 'tr', n)} AS atr_{n}")
    for n in (7, 14):
        c3.append(f"close / nullif(lag(close, {n}) OVER {W()}, 0) - 1 AS roc_{n}")
    for n in (7, 14):
        c3.append(f"close - lag(close, {n}) OVER {W()} AS momentum_{n}")
    c3.append("macd - macd_signal AS macd_histogram")
    for n in (7, 14):
        c3.append(f"{guarded('avg', 'volume', n)} AS volume_sma_{n}")
    c3.append(f"sum(obv_step) OVER {RUN} AS obv")
    c3.append(f"lead(close) OVER {W()} AS target_close")
    c3.append(f"lead(daily_return) OVER {W()} AS target_return")
    c3.append(f"lead(1) OVER {W()} IS NOT NULL AS has_next")
    ctes.append(("g3", f"SELECT *, {', '.join(c3)} FROM g2"))
    c4 = [f"""CASE WHEN n_rows >= {RSI_WINDOW + 1} THEN CASE WHEN avg_loss = 0 THEN CASE WHEN avg_gain = 0 THEN NULL ELSE {D(100)} END
  ELSE {D(100)} - {D(100)} / ({D(1)} + avg_gain / avg_loss) END END AS rsi"""]
    for n in (7, 14):
        c4.append(f"volume / nullif(volume_sma_{n}, 0) AS volume_ratio_{n}")
    c4.append("CAST(coalesce(target_close > close, false) AS INTEGER) AS target_direction")
    ctes.append(("g4", f"SELECT *, {', '.join(c4)} FROM g3"))
    ctes.append(("gind", "SELECT * FROM g4 WHERE has_next OR n_rows < 2"))
    return ctes


TECH_MARKERS = ["sma_", "ema_", "rsi", "volatility_", "atr_", "macd"]


def gold_fill_drop(src: str = "gind", name: str = "gold") -> list[tuple[str, str]]:
    cols = [c for c in GOLD_COLUMNS]
    sel = []
    for c in cols:
        if any(m in c for m in TECH_MARKERS):
            sel.append(f"last_value({c} IGNORE NULLS) OVER {RUN} AS {c}")
        else:
            sel.append(c)
    q1 = f"SELECT {K}, {', '.join(sel)}, date FROM {src}"
    q2 = f"SELECT * FROM {name}0 WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in cols)
    return [(f"{name}0", q1), (name, q2)]


def gold(by: str = "flag") -> list[tuple[str, str]]:
    return silver(by) + gold_indicators() + gold_fill_drop()


# ---------------------------------------------------------------- features
def feature_select(src: str = "gold") -> list[tuple[str, str]]:
    cols = ", ".join(PRIORITY_FEATURES + TARGET_COLUMNS)
    cond = " AND ".join(f"{c} IS NOT NULL" for c in PRIORITY_FEATURES)
    return [("fsel", f"SELECT {K}, date, {cols} FROM {src} WHERE {cond}")]


LAG_COLS = [f"{c}_lag_{i}" for c in LAG_FEATURES for i in range(1, PIPELINE_MAX_LAG + 1)]


def lags(src: str = "fsel") -> list[tuple[str, str]]:
    sel = ", ".join(f"lag({c}, {i}) OVER {W()} AS {c}_lag_{i}"
                    for c in LAG_FEATURES for i in range(1, PIPELINE_MAX_LAG + 1))
    cond = " AND ".join(f"{c} IS NOT NULL" for c in PRIORITY_FEATURES + TARGET_COLUMNS + LAG_COLS)
    return [("lagged0", f"SELECT *, {sel} FROM {src}"), ("lagged", f"SELECT * FROM lagged0 WHERE {cond}")]


ROLL_COLS = ["rolling_mean_7", "rolling_std_7", "rolling_mean_14", "volume_rolling_mean_7"]


def rolling(src: str = "lagged") -> list[tuple[str, str]]:
    sel = (f"{guarded('avg', 'close', 7)} AS rolling_mean_7, {guarded('stddev_samp', 'close', 7)} AS rolling_std_7, "
           f"{guarded('avg', 'close', 14)} AS rolling_mean_14, {guarded('avg', 'volume', 7)} AS volume_rolling_mean_7")
    cond = " AND ".join(f"{c} IS NOT NULL" for c in ROLL_COLS)
    return [("rolled0", f"SELECT *, {sel} FROM {src}"), ("features", f"SELECT * FROM rolled0 WHERE {cond}")]


def split(src: str = "features") -> list[tuple[str, str]]:
    q = f"""SELECT *, CASE WHEN rn0 < floor(cnt * {D(1 - TEST_SIZE - VAL_SIZE)}) THEN 'train'
  WHEN rn0 < floor(cnt * {D(1 - TEST_SIZE)}) THEN 'val' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER {W()} - 1 AS rn0, count(*) OVER {WHOLE} AS cnt FROM {src})"""
    return [("splitted", q)]


def features_all() -> list[tuple[str, str]]:
    return gold() + feature_select() + lags() + rolling() + split()


FEATURE_COLS = PRIORITY_FEATURES + LAG_COLS + ROLL_COLS


# ------------------------------------------------------------------ finals
def pick(cols: list[str], src: str, doubles: list[str] | None = None, where: str = "") -> str:
    dbl = set(cols if doubles is None else doubles)
    sel = ", ".join(f"{R(c)} AS {c}" if c in dbl else c for c in cols)
    return f"SELECT {K}, date, {sel} FROM {src}{(' WHERE ' + where) if where else ''}"


OHLCV = ["open", "high", "low", "close", "volume"]
INT_COLS = {"day_of_week", "month", "year", "target_direction"}


def unpivot(src: str, group: list[str], items: list[tuple[str, str]], label: str, value: str) -> str:
    """Long format via UNNEST over a list of structs."""
    structs = ", ".join(f"{{'l': '{name}', 'v': {expr}}}" for name, expr in items)
    g = ", ".join(group)
    return (f"SELECT {g}, u.l AS \"{label}\", u.v AS {value} FROM "
            f"(SELECT {g}, UNNEST([{structs}]) AS u FROM {src})")


def naive_preds() -> list[tuple[str, str]]:
    q = f"""SELECT {K}, date, close AS y_true, lag(close) OVER {W()} AS y_pred FROM silver"""
    return silver() + [("np0", q), ("preds", "SELECT *, y_true - y_pred AS residual FROM np0 WHERE y_pred IS NOT NULL")]


def pages() -> list[tuple[str, str]]:
    step = B.PAGE_SIZE - B.PAGE_OVERLAP
    q1 = f"SELECT *, n - rn AS rd, CAST(floor((n - rn) / {step}) AS INTEGER) AS q FROM rbars"
    q2 = f"""SELECT {K}, q AS page_no, date, open, high, low,
  CASE WHEN q >= 1 AND rd - q * {step} < {B.PAGE_OVERLAP} THEN close + {D(0.5)} ELSE close END AS close, volume, rn FROM pg
UNION ALL
SELECT {K}, q - 1 AS page_no, date, open, high, low, close, volume, rn FROM pg
WHERE q >= 1 AND rd - q * {step} < {B.PAGE_OVERLAP}"""
    q3 = f"SELECT * FROM members WHERE rn % {B.TEXT_NA_EVERY} <> 0"
    return lineitem_bars() + rn_bars() + [("pg", q1), ("members", q2), ("pagerows", q3)]


def oracle_upsert() -> str:
    """Bronze after the second delivery: stored rows win."""
    deliveries = lineitem_bars() + rn_bars() + [
        ("existing", f"SELECT {K}, open, high, low, close, volume, date, 0 AS src FROM rbars WHERE rn <= floor(n * {D(0.9)})"),
        ("newrows", f"SELECT {K}, open, high, low, close + {D(1.0)} AS close, volume, date, 1 AS src FROM rbars WHERE rn > floor(n * {D(0.9)}) - 10"),
        ("ups", f"SELECT *, row_number() OVER (PARTITION BY {K}, date ORDER BY src) AS rk FROM (SELECT * FROM existing UNION ALL SELECT * FROM newrows)")]
    return sql(deliveries, pick(OHLCV, "ups", where="rk = 1"))


def oracle() -> dict[str, str]:
    o: dict[str, str] = {}
    o["bars"] = sql(lineitem_bars(), pick(OHLCV, "bars"))
    o["event_bars"] = sql(event_bars(), pick(OHLCV, "ebars"))
    o["payload_normalize"] = sql(pages(), f"SELECT {K}, page_no, date, " +
                                 ", ".join(f"{R(c)} AS {c}" for c in OHLCV) + " FROM pagerows")
    o["pages_dedupe"] = sql(pages() + [("dd", f"SELECT *, row_number() OVER (PARTITION BY {K}, date ORDER BY page_no) AS rk FROM pagerows")],
                            pick(OHLCV, "dd", where="rk = 1"))
    o["bronze_upsert_keep_first"] = oracle_upsert()
    o["latest_bar"] = sql(lineitem_bars() + [("lt", f"SELECT *, row_number() OVER (PARTITION BY {K} ORDER BY date DESC) AS rk FROM bars")],
                          f"SELECT {K}, " + ", ".join(f"{R(c)} AS {c}" for c in OHLCV) + ", date FROM lt WHERE rk = 1")
    o["pool_argmax"] = ("SELECT network, replace(id, 'eth_', '') AS pool_id, reserve FROM ("
                        "SELECT s_nationkey AS network, 'eth_' || CAST(s_suppkey AS VARCHAR) AS id, s_acctbal AS reserve, "
                        "row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS rk "
                        "FROM supplier WHERE s_acctbal > 0) WHERE rk = 1")
    o["coerce_types"] = sql(text_bars() + coerced(), pick(OHLCV, "coerced"))
    o["ffill_bfill"] = sql(text_bars() + coerced() + filled(), pick(OHLCV, "filled"))
    base = text_bars() + coerced() + filled() + [("pos", f"SELECT *, row_number() OVER {W()} AS pos FROM filled")] + fences("pos")
    o["iqr_bounds"] = sql(base, " UNION ALL ".join(
        f"SELECT {K}, '{c}' AS \"column\", {R(f'q1_{c}')} AS q1, {R(f'q3_{c}')} AS q3, {R(f'lo_{c}')} AS lower, {R(f'hi_{c}')} AS upper FROM fences"
        for c in PRICE_COLS))
    o["outlier_counts"] = sql(base, " UNION ALL ".join(
        f"SELECT p.{K}, '{c}' AS \"column\", count_if(coalesce(p.{c} < f.lo_{c} OR p.{c} > f.hi_{c}, false)) AS outliers "
        f"FROM pos p JOIN fences f USING ({K}) GROUP BY p.{K}" for c in PRICE_COLS))
    si = text_bars() + coerced() + filled() + interpolated()
    o["outlier_interpolate"] = sql(si, pick(OHLCV, "interp"))
    o["ohlc_repair"] = sql(si + repaired(), pick(OHLCV, "repaired"))
    o["log_return"] = sql(silver(), pick(["daily_return"], "silver"))
    o["calendar_fields"] = sql(silver(), pick(["day_of_week", "month", "year"], "silver", doubles=[]))
    o["silver"] = sql(silver(), pick(SILVER_COLS, "silver", doubles=[c for c in SILVER_COLS if c not in INT_COLS]))
    gi = silver() + gold_indicators()
    o["sma"] = sql(gi, pick([f"sma_{n}" for n in MA_WINDOWS], "g1"))
    o["price_sma_ratio"] = sql(gi, pick([f"price_sma_ratio_{n}" for n in MA_WINDOWS], "g3"))
    o["ema"] = sql(gi, pick([f"ema_{n}" for n in MA_WINDOWS], "g2"))
    o["rsi"] = sql(gi, pick(["rsi"], "g4"))
    o["volatility"] = sql(gi, pick([f"volatility_{n}" for n in VOLATILITY_WINDOWS], "g3"))
    o["true_range"] = sql(gi, f"SELECT {K}, date, {R('tr')} AS true_range FROM g2")
    o["atr"] = sql(gi, pick([f"atr_{n}" for n in VOLATILITY_WINDOWS], "g3"))
    o["roc"] = sql(gi, pick(["roc_7", "roc_14"], "g3"))
    o["momentum"] = sql(gi, pick(["momentum_7", "momentum_14"], "g3"))
    o["macd"] = sql(gi, pick(["macd", "macd_signal", "macd_histogram"], "g3"))
    o["volume_indicators"] = sql(gi, pick(["volume_sma_7", "volume_sma_14", "volume_ratio_7", "volume_ratio_14"], "g4"))
    o["obv"] = sql(gi, pick(["obv"], "g3"))
    o["targets"] = sql(gi, pick(["target_close", "target_return", "target_direction"], "gind", doubles=["target_close", "target_return"]))
    tech = [c for c in GOLD_COLUMNS if any(m in c for m in TECH_MARKERS)]
    o["gold_fill_drop"] = sql(gold(), pick(tech, "gold"))
    o["gold"] = sql(gold(), f"SELECT {K}, " + ", ".join(c if c in INT_COLS else f"{R(c)} AS {c}" for c in GOLD_COLUMNS) + ", date FROM gold")

    def fsel_cols(extra: list[str]) -> list[str]:
        return PRIORITY_FEATURES + TARGET_COLUMNS + extra

    def dbl(cols):
        return [c for c in cols if c not in INT_COLS]

    fs = gold() + feature_select()
    o["feature_select"] = sql(fs, pick(fsel_cols([]), "fsel", doubles=dbl(fsel_cols([]))))
    o["lags"] = sql(fs + lags(), pick(fsel_cols(LAG_COLS), "lagged", doubles=dbl(fsel_cols(LAG_COLS))))
    allf = fsel_cols(LAG_COLS + ROLL_COLS)
    o["rolling_features"] = sql(fs + lags() + rolling(), pick(allf, "features", doubles=dbl(allf)))
    fa = features_all()
    o["split"] = sql(fa, f"SELECT {K}, date, split FROM splitted")
    o["folds"] = sql(fa, f"SELECT {K}, date, CAST(ntile(3) OVER {W()} - 1 AS INTEGER) AS fold FROM splitted WHERE split = 'train'")
    rob = ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), [0.25, 0.5, 0.75]) AS q_{c}" for c in FEATURE_COLS)
    items = [(c, f"{{'c': q_{c}[2], 's': q_{c}[3] - q_{c}[1]}}") for c in FEATURE_COLS]
    o["scaler_robust"] = sql(fa + [("qs", f"SELECT {K}, {rob} FROM splitted WHERE split = 'train' GROUP BY {K}"),
                                   ("ql", unpivot("qs", [K], items, "feature", "p"))],
                             f"SELECT {K}, feature, {R('p.c')} AS center, {R('CASE WHEN p.s = 0 THEN 1.0::DOUBLE ELSE p.s END')} AS scale FROM ql")
    o["scaler_robust_pooled"] = sql(fa + [("qp", f"SELECT '*' AS {K}, {rob} FROM splitted WHERE split = 'train'"),
                                          ("qpl", unpivot("qp", [K], items, "feature", "p"))],
                                    f"SELECT {K}, feature, {R('p.c')} AS center, {R('CASE WHEN p.s = 0 THEN 1.0::DOUBLE ELSE p.s END')} AS scale FROM qpl")
    std = ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m_{c}, stddev_pop(CAST({c} AS DOUBLE)) AS s_{c}" for c in FEATURE_COLS)
    items = [(c, f"{{'c': m_{c}, 's': s_{c}}}") for c in FEATURE_COLS]
    o["scaler_standard"] = sql(fa + [("ms", f"SELECT {K}, {std} FROM splitted WHERE split = 'train' GROUP BY {K}"),
                                     ("sl", unpivot("ms", [K], items, "feature", "p"))],
                               f"SELECT {K}, feature, {R('p.c')} AS center, {R('CASE WHEN p.s = 0 THEN 1.0::DOUBLE ELSE p.s END')} AS scale FROM sl")
    scaled = ", ".join(
        f"{R(f'(CAST(f.{c} AS DOUBLE) - q.q_{c}[2]) / CASE WHEN q.q_{c}[3] - q.q_{c}[1] = 0 THEN 1.0::DOUBLE ELSE q.q_{c}[3] - q.q_{c}[1] END')} AS {c}"
        for c in FEATURE_COLS)
    o["scaled_features"] = sql(fa + [("qs", f"SELECT {K}, {rob} FROM splitted WHERE split = 'train' GROUP BY {K}")],
                               f"SELECT f.{K}, f.date, {scaled}, {R('f.target_close')} AS target_close, "
                               f"{R('f.target_return')} AS target_return, f.target_direction, f.split FROM splitted f JOIN qs q USING ({K})")
    pairs = [(a, b) for a in FEATURE_COLS for b in FEATURE_COLS]
    cor = ", ".join(f"corr(CAST({b} AS DOUBLE), CAST({a} AS DOUBLE)) AS c{i}" if FEATURE_COLS.index(a) > FEATURE_COLS.index(b)
                    else f"corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS c{i}" for i, (a, b) in enumerate(pairs))
    structs = ", ".join(f"{{'a': '{a}', 'b': '{b}', 'v': c{i}}}" for i, (a, b) in enumerate(pairs))
    o["correlation"] = sql(fa + [("cr", f"SELECT {K}, {cor} FROM splitted GROUP BY {K}"),
                                 ("cl", f"SELECT {K}, UNNEST([{structs}]) AS u FROM cr")],
                           f"SELECT {K}, u.a AS a, u.b AS b, {R('u.v')} AS corr FROM cl")
    dcols = ["open", "high", "low", "close", "volume", "daily_return"]
    o["describe"] = sql(silver(), " UNION ALL ".join(
        f"SELECT {K}, '{c}' AS \"column\", count({c}) AS count, {R(f'avg({c})')} AS mean, {R(f'stddev_samp({c})')} AS std, "
        f"{R(f'min({c})')} AS min, {R(f'quantile_cont({c}, 0.25)')} AS p25, {R(f'quantile_cont({c}, 0.5)')} AS p50, "
        f"{R(f'quantile_cont({c}, 0.75)')} AS p75, {R(f'max({c})')} AS max FROM silver GROUP BY {K}" for c in dcols))
    o["null_counts"] = sql(gi, " UNION ALL ".join(
        f"SELECT {K}, '{c}' AS \"column\", count_if({c} IS NULL) AS nulls FROM gind GROUP BY {K}" for c in GOLD_COLUMNS))
    o["range_summary"] = sql(silver(), f"SELECT {K}, count(*) AS rows, min(date) AS min_date, max(date) AS max_date FROM silver GROUP BY {K}")
    e = "(y_true - y_pred)"
    o["regression_metrics"] = sql(naive_preds(),
                                  f"SELECT {K}, count(*) AS n, {R(f'avg(abs({e}))')} AS mae, {R(f'sqrt(avg({e} * {e}))')} AS rmse, "
                                  f"{R(f'1.0::DOUBLE - sum({e} * {e}) / nullif(count(*) * var_pop(y_true), 0)')} AS r2 FROM preds GROUP BY {K}")
    width = f"((hi - lo) / {B_HIST})"
    o["residual_histogram"] = sql(naive_preds() + [
        ("lim", f"SELECT *, min(residual) OVER {WHOLE} AS lo, max(residual) OVER {WHOLE} AS hi FROM preds"),
        ("hb", f"SELECT {K}, lo, hi, CAST(CASE WHEN {width} = 0 THEN 1 ELSE least(floor((residual - lo) / {width}) + 1, {B_HIST}) END AS INTEGER) AS bin FROM lim WHERE residual IS NOT NULL"),
        ("hc", f"SELECT {K}, bin, lo, hi, count(*) AS count FROM hb GROUP BY {K}, bin, lo, hi")],
        f"SELECT {K}, bin, {R(f'lo + (bin - 1) * (hi - lo) / {B_HIST}')} AS lo, {R(f'lo + bin * (hi - lo) / {B_HIST}')} AS hi, count FROM hc")
    o["eval_rows"] = sql(naive_preds(), pick(["y_true", "y_pred", "residual"], "preds"))
    pu = naive_preds() + [
        ("pr", f"SELECT *, row_number() OVER {W()} AS rn, count(*) OVER {WHOLE} AS n FROM preds"),
        ("pold", f"SELECT {K}, date, y_true, y_pred, date AS prediction_date, 0 AS src FROM pr"),
        ("pnew", f"SELECT {K}, date, y_true, y_pred + {D(1.0)} AS y_pred, date + INTERVAL 1 DAY AS prediction_date, 1 AS src FROM pr WHERE rn > floor(n * {D(0.8)})"),
        ("pu", f"SELECT *, row_number() OVER (PARTITION BY {K}, date ORDER BY src DESC, prediction_date DESC) AS rk FROM (SELECT * FROM pold UNION ALL SELECT * FROM pnew)")]
    o["prediction_upsert_keep_last"] = sql(pu, f"SELECT {K}, date, {R('y_true')} AS y_true, {R('y_pred')} AS y_pred, prediction_date FROM pu WHERE rk = 1")
    cands = [("naive", "close"), ("sma_7", "sma_7"), ("ema_7", "ema_7"), ("ema_14", "ema_14")]
    unions = " UNION ALL ".join(f"SELECT {K}, {i} AS ordinal, '{n}' AS model, target_close AS y_true, {c} AS y_pred FROM gold"
                                for i, (n, c) in enumerate(cands))
    o["best_model"] = sql(gold() + [
        ("cand", unions),
        ("cm", f"SELECT {K}, ordinal, model, count(*) AS n, avg(abs(y_true - y_pred)) AS mae, sqrt(avg((y_true - y_pred) * (y_true - y_pred))) AS rmse, "
               f"1.0::DOUBLE - sum((y_true - y_pred) * (y_true - y_pred)) / nullif(count(*) * var_pop(y_true), 0) AS r2 FROM cand GROUP BY {K}, ordinal, model"),
        ("bm", f"SELECT *, row_number() OVER (PARTITION BY {K} ORDER BY mae, ordinal) AS rk FROM cm")],
        f"SELECT {K}, model, n, {R('mae')} AS mae, {R('rmse')} AS rmse, {R('r2')} AS r2 FROM bm WHERE rk = 1")
    o["gold_summary"] = sql(gold(), f"SELECT {K}, count(*) AS rows, min(date) AS min_date, max(date) AS max_date, "
                                    f"CAST({len(GOLD_COLUMNS)} AS INTEGER) AS features, CAST({len(GOLD_COLUMNS)} AS INTEGER) AS numeric_columns "
                                    f"FROM gold GROUP BY {K}")
    o["preview"] = sql(silver() + [("pv", f"SELECT *, row_number() OVER {W()} AS rk FROM silver")],
                       pick(OHLCV, "pv", where="rk <= 5"))
    o["supplier_silver"] = sql(silver("supplier"), pick(SILVER_COLS, "silver", doubles=[c for c in SILVER_COLS if c not in INT_COLS]))
    o["event_gold"] = sql(gold("events"), f"SELECT {K}, " + ", ".join(c if c in INT_COLS else f"{R(c)} AS {c}" for c in GOLD_COLUMNS) + ", date FROM gold")
    o["supplier_gold"] = sql(gold("supplier"), f"SELECT {K}, " + ", ".join(c if c in INT_COLS else f"{R(c)} AS {c}" for c in GOLD_COLUMNS) + ", date FROM gold")
    o["axis_limits"] = sql(naive_preds(), f"SELECT {R('min(y_true)')} AS lo, {R('max(y_true)')} AS hi FROM preds")
    o["fetch_limit"] = sql(lineitem_bars() + [("fl", f"SELECT *, row_number() OVER (PARTITION BY {K} ORDER BY date DESC) AS rk FROM bars")],
                           pick(OHLCV, "fl", where="rk <= 100"))
    # the streamed Bronze must equal the batch history assembly
    o["stream_ingest"] = o["pages_dedupe"]
    o["stream_order"] = o["pages_dedupe"]
    return o


B_HIST = 20
