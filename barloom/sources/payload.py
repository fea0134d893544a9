"""Raw payload scans.

Payload documents are JSON lines landed by the fetcher, one document per
page: ``{"series_key": .., "page_no": .., "data": {"attributes":
{"ohlcv_list": [[ts, o, h, l, c, v], ...]}}}``.  They are read with a fixed
schema (no inference pass) and flattened with ``explode``; every document is
one row, so the work spreads over the files like any scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalar as S
from ..schemas import KEY, NUMERIC_COLS, OHLCV_PAYLOAD_SCHEMA, TS
from .bars import PAGE_OVERLAP, PAGE_SIZE, TEXT_NA_EVERY

PAGE_DOC_SCHEMA = T.StructType([
    T.StructField(KEY, T.StringType()),
    T.StructField("page_no", T.IntegerType()),
    *OHLCV_PAYLOAD_SCHEMA.fields,
])

CORRUPT = "corrupt_record"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed OHLCV page documents (JSON lines) with the fixed schema; a line
    that is no such document keeps its text in ``corrupt_record``."""
    return parse_pages(spark.read.text(path))


def parse_pages(lines: DataFrame, column: str = "value") -> DataFrame:
    """Page documents of JSON text, one a row (also of a stream)."""
    schema = T.StructType([*PAGE_DOC_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
    doc = F.from_json(column, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return lines.where(F.length(F.trim(column)) > 0).select(doc.alias("d")).select("d.*")


def sound_pages(pages: DataFrame) -> DataFrame:
    return pages.where(F.col(CORRUPT).isNull()) if CORRUPT in pages.columns else pages


def corrupt_pages(pages: DataFrame) -> DataFrame:
    """The quarantine: what could not be read, with what could be told of it."""
    return pages.where(F.col(CORRUPT).isNotNull()).select(KEY, "page_no", CORRUPT)


def normalize_ohlcv(docs: DataFrame, extra_cols: list[str] | None = None) -> DataFrame:
    """A1: one row per bar of ``data.attributes.ohlcv_list``: epoch seconds
    -> ``date``; numerics -> double (bad text -> null); rows with a missing
    numeric are dropped.  A missing path or an empty list yields no rows."""
    extra = [c for c in (extra_cols or []) if c in docs.columns]
    keep = [c for c in [KEY] if c in docs.columns] + extra
    docs = sound_pages(docs)
    lists = F.col("data.attributes.ohlcv_list")
    rows = docs.select(*keep, F.explode_outer(lists).alias("_e")).where(F.col("_e").isNotNull())
    vals = {name: S.to_double(F.col("_e")[i + 1]) for i, name in enumerate(NUMERIC_COLS)}
    out = rows.select(*keep, S.epoch_to_ts(F.col("_e")[0]).alias(TS),
                      *[v.alias(k) for k, v in vals.items()])
    return out.select(*keep, *NUMERIC_COLS, TS).dropna(subset=NUMERIC_COLS)


def assemble_history(pages: DataFrame, key: str = KEY, ts: str = TS) -> DataFrame:
    """Union of normalized pages, one row per (series, date),
    the page fetched first (lowest ``page_no``) wins.  Each group holds the
    copies of one bar only."""
    w = Window.partitionBy(key, ts).orderBy(F.col("page_no").asc())
    out = pages.withColumn("_rk", F.row_number().over(w)).where("_rk = 1")
    return out.drop("_rk", "page_no")


def fetch_limit(bars: DataFrame, n: int, key: str = KEY, ts: str = TS) -> DataFrame:
    """the newest ``n`` bars of each series (the fetch limit)."""
    w = Window.partitionBy(key).orderBy(F.col(ts).desc())
    return bars.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= n).drop("_rk")


# ------------------------------------------------------------------- pools
def normalize_pools(docs: DataFrame) -> DataFrame:
    """Pool list documents -> (network, ordinal, id, reserve_in_usd text)."""
    return docs.select("network", F.posexplode("data").alias("ordinal", "p")).select(
        "network", "ordinal", F.col("p.id").alias("id"),
        F.col("p.attributes.reserve_in_usd").alias("reserve_in_usd"))


def best_pool(pools: DataFrame, group: str = "network", prefix: str = "eth_") -> DataFrame:
    """Per network, the pool with the largest reserve
    (missing reserve counts as 0); only reserves above 0 qualify; the first
    pool in list order wins ties; ``prefix`` is removed from the id."""
    reserve = F.coalesce(S.to_double("reserve_in_usd"), F.lit(0.0))
    cand = pools.withColumn("reserve", reserve).where(F.col("reserve") > 0)
    w = Window.partitionBy(group).orderBy(F.col("reserve").desc(), F.col("ordinal").asc())
    best = cand.withColumn("_rk", F.row_number().over(w)).where("_rk = 1")
    return best.select(group, S.strip_prefix("id", prefix).alias("pool_id"), "reserve")


def fixture_pool_docs(pools: DataFrame) -> DataFrame:
    """Pool list documents, one a network, pools in order."""
    entry = F.struct("id", F.struct("reserve_in_usd").alias("attributes"))
    listed = pools.groupBy("network").agg(F.sort_array(F.collect_list(F.struct("ordinal", entry.alias("e")))).alias("l"))
    return listed.select("network", F.transform("l", lambda s: s["e"]).alias("data"))


# ---------------------------------------------------------- page fixture
def fixture_pages(bars: DataFrame) -> DataFrame:
    """Payload documents built from bars: pages of 100 bars, newest first,
    consecutive pages overlapping by 5 bars.  The copy of an overlapping bar
    in the later-fetched page carries close + 0.5, and every 41st bar has
    volume ``'n/a'``.  Each page is one group of at most 100 bars."""
    step = PAGE_SIZE - PAGE_OVERLAP
    w = Window.partitionBy(KEY).orderBy(TS)
    b = bars.withColumns({"_rn": F.row_number().over(w),
                          "_n": F.count(F.lit(1)).over(Window.partitionBy(KEY))})
    rd = F.col("_n") - F.col("_rn")
    q = F.floor(rd / step).cast("int")
    overlap = (q >= 1) & (rd - q * step < PAGE_OVERLAP)
    member = F.when(overlap, F.array(F.struct((q - 1).alias("page_no"), F.lit(False).alias("dup")),
                                     F.struct(q.alias("page_no"), F.lit(True).alias("dup")))
                    ).otherwise(F.array(F.struct(q.alias("page_no"), F.lit(False).alias("dup"))))
    m = b.select("*", F.inline(member))
    close = F.when(F.col("dup"), F.col("close") + 0.5).otherwise(F.col("close"))
    vol = F.when(F.col("_rn") % TEXT_NA_EVERY == 0, F.lit("n/a")).otherwise(F.col("volume").cast("string"))
    entry = F.array(S.ts_to_epoch(TS).cast("string"), F.col("open").cast("string"),
                    F.col("high").cast("string"), F.col("low").cast("string"),
                    close.cast("string"), vol)
    docs = m.groupBy(KEY, "page_no").agg(
        F.sort_array(F.collect_list(F.struct(F.col(TS).alias("t"), entry.alias("e")))).alias("_l"))
    lists = F.transform("_l", lambda s: s["e"])
    return docs.select(KEY, "page_no", F.struct(F.struct(lists.alias("ohlcv_list")).alias("attributes")).alias("data"))
