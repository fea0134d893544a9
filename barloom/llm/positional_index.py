"""Benchmark decontamination over a positional inverted index.

Test windows are runs of ``WINDOW`` consecutive item words.  The corpus terms
that occur in windows are counted over all documents, and every window is
looked up through its two rarest terms.  The postings of these terms are
stored: (document, position) and the words around.  Each list is shifted by its term's place in the window, the shifted lists are
intersected on (window, document, start), and what is left is an exact phrase
match when the words around agree with the whole window.  A place where either
of the two rarest terms has at least ``NEAR_SHARE`` of the window's distinct
words around it, without being an exact match, is a proximity match: it is
counted and its items are listed, and it does not make a document contaminated.

Built from DataFrame functions alone.  The window tables are broadcast only
after a count shows that they are small; larger ones are joined by shuffles.
Documents are told apart by a 128-bit hash of id and text, so repeated rows,
repeated ids and null ids need no other key.

Defined cases: a null or empty text has no words and no hits; an item without
words has no window; a null item id is listed as ``null``; repeated items
count once for each id; an empty table on either side gives rows without
hits or no rows; other columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fits, saved

WINDOW = 10  # fixed value of the contract
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # fixed value of the contract: what lies between words
NEAR_SHARE = 0.8
BROADCAST_ROWS = 100_000


def words_of(text: str = "text") -> Column:
    """The words of a text; only A-Z are lowered."""
    raw = F.coalesce(F.col(text), F.lit(""))
    plain = F.when(raw.rlike(r"[^\x00-\x7F]"),
                   F.translate(raw, string.ascii_uppercase, string.ascii_lowercase)).otherwise(F.lower(raw))
    return F.array_remove(F.split(plain, BETWEEN), "")  # splitting costs a fifth of extracting


def _key() -> list[Column]:
    return [F.xxhash64("doc_id", "text").alias("_k1"), F.xxhash64(F.lit("2"), "text", "doc_id").alias("_k2")]


def _sized(df: DataFrame) -> DataFrame:
    """Broadcast a table that a count has shown to be small."""
    return F.broadcast(df) if fits(df, BROADCAST_ROWS) else df


def test_windows(items: DataFrame, width: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(gid, words) for each distinct window and (gid, item) for its items."""
    w = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
                     words_of().alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (width - 1)))
    each = w.select("item", F.explode(F.transform(starts, lambda s: F.slice("w", s, width))).alias("words"))
    each = saved(each.distinct())
    windows = saved(each.select("words").distinct().withColumn("gid", F.monotonically_increasing_id()))
    return windows, each.join(windows, "words").select("gid", "item")


def rarest_terms(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(gid, words, rank, term, off) for the two rarest terms of each window,
    rarest first; ``off`` is the term's place.  Counts cover all documents."""
    places = windows.select("gid", "words", F.posexplode("words").alias("off", "term"))
    vocabulary = _sized(places.select("term").distinct())
    counts = (docs.select(F.explode(words_of()).alias("term")).join(vocabulary, "term")
              .groupBy("term").agg(F.count(F.lit(1)).alias("n")))
    ranked = (places.join(counts, "term", "left")
              .groupBy("gid", "words")
              .agg(F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "off", "term")))
                   .alias("t")))
    return saved(ranked.select("gid", "words", F.posexplode(F.slice("t", 1, 2)).alias("rank", "t"))
                 .select("gid", "words", "rank", "t.term", "t.off"))


def postings(docs: DataFrame, terms: DataFrame, width: int = WINDOW) -> DataFrame:
    """The stored index: (_k1, _k2, term, pos, near).  ``near`` holds the words
    from ``width - 1`` places before to as many after, for terms of windows of
    several words (a window of one word needs none)."""
    wanted = _sized(terms.groupBy("term").agg((F.max(F.size("words")) > 1).alias("around")))
    tokens = (docs.select(*_key(), words_of().alias("w"))
              .select("_k1", "_k2", "w", F.posexplode("w").alias("pos", "term")))
    around = F.slice("w", F.greatest(F.lit(1), F.col("pos") - (width - 2)), F.least(F.col("pos"), F.lit(width - 1)) + width)
    return saved(tokens.join(wanted, "term")
                 .select("_k1", "_k2", "term", "pos", F.when(F.col("around"), around).alias("near")))


def matches(docs: DataFrame, items: DataFrame, width: int = WINDOW) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Exact matches (_k1, _k2, gid, start, len), proximity matches of the
    same columns, and (gid, item)."""
    windows, items_of = test_windows(items, width)
    terms = rarest_terms(docs, windows)
    index = postings(docs, terms, width)
    place = ["_k1", "_k2", "gid", "start"]
    looked_up = _sized(terms.select("gid", "words", "rank", "term", "off"))
    heads = index.join(looked_up, "term").select(
        "_k1", "_k2", "gid", "rank", (F.col("pos") - F.col("off")).alias("start"), "words", "near",
        # the window's start inside ``near``, 1-based
        (F.least(F.col("pos"), F.lit(width - 1)) - F.col("off") + 1).alias("at"))
    second = _sized(terms.where("rank = 1").select("gid", "term", "off"))
    seconds = index.join(second, "term").select("_k1", "_k2", "gid", (F.col("pos") - F.col("off")).alias("start"))
    long = F.size("words") > 1
    same = (F.col("at") >= 1) & (F.slice("near", F.greatest("at", F.lit(1)), F.size("words")) == F.col("words"))
    firsts = heads.where("rank = 0")
    exact = (firsts.where(long).join(seconds, place, "left_semi").where(same).unionByName(firsts.where(~long))
             .select(*place, F.size("words").alias("len")).distinct())
    shared = F.size(F.array_intersect("near", "words"))
    close = (heads.where(long & (shared >= NEAR_SHARE * F.size(F.array_distinct("words"))) & ~same)
             .select(*place, F.size("words").alias("len")).distinct())
    return exact, close, items_of


def covered(spans: Column) -> Column:
    """Number of places in the union of (start, len) structs."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def step(acc, s):
        stop = s["start"] + s["len"]
        new = F.greatest(F.lit(0), stop - F.greatest(s["start"], acc["end"]))
        return F.struct(F.greatest(stop, acc["end"]).alias("end"), (acc["n"] + new).alias("n"))

    return F.aggregate(F.sort_array(spans), start, step, lambda acc: acc["n"])


def _named(found: DataFrame, items_of: DataFrame, name: str) -> DataFrame:
    """The sorted items of the windows found in each document."""
    return (found.select("_k1", "_k2", "gid").distinct().join(items_of, "gid")
            .groupBy("_k1", "_k2").agg(F.sort_array(F.collect_set("item")).alias(name)))


def op2_positional_index(docs: DataFrame, items: DataFrame, width: int = WINDOW) -> DataFrame:
    """One row a document: words, hit words and items hit exactly; then the
    proximity matches and the items they belong to."""
    exact, close, items_of = matches(docs, items, width)
    exact, close = saved(exact), saved(close)
    key = ["_k1", "_k2"]
    hits = exact.groupBy(*key).agg(covered(F.collect_set(F.struct("start", "len"))).alias("n_hit"))
    near = close.groupBy(*key).agg(F.count(F.lit(1)).alias("n_near"))
    rows = docs.select("doc_id", *_key(), F.size(words_of()).cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    out = rows.join(hits, key, "left").join(near, key, "left")
    out = out.join(_named(exact, items_of, "items"), key, "left").join(_named(close, items_of, "near_items"), key, "left")

    def digest(items: str) -> Column:
        return F.sha2(F.array_join(F.coalesce(items, none), ",").cast("binary"), 256)

    return out.select(
        "doc_id", "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        digest("items").alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        digest("near_items").alias("near_items_sha256"))


def keep_clean(docs: DataFrame, items: DataFrame, width: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without any exact match; all columns."""
    exact, _, _ = matches(docs, items, width)
    found = exact.select("_k1", "_k2").distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"), *_key())
    return rows.join(found, ["_k1", "_k2"], "left_anti").select(*[F.col("row")[c].alias(c) for c in docs.columns])
