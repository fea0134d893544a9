"""How five document filters interact, in all orders.

1. One pass over the texts gives every document its failures of the filters
   A to D as bits, and a 64-bit hash of its text.
2. E by an existential self-join: documents left-semi joined on hash, exact
   text and a smaller doc_id.  Only texts whose hash comes twice are moved.
   The right side is one row for each distinct text, its smallest doc_id (a
   smaller one exists exactly if the smallest is); it is made with partial
   aggregation, and repeated for the pieces that a frequent hash's rows are
   dealt into.
3. The ids marked by E are united with those that fail another filter and the
   bits are added up by document; documents are counted by part and
   combination of bits (32 at most).
4. What a filter does depends on the set of filters before it alone, so the
   combinations are summed for the 80 pairs (set before, filter), and each pair
   is written out for the orders and the step it belongs to.

Defined cases: a null text is the empty text (it fails A, and E if a smaller
id is empty or null too); a null id is not smaller than any and has no smaller
one; rows with equal id and text share E; a null source is the part ''.  A
document is good or toxic if any label row of its id says so; a null id has no
label.  An empty table gives no rows; other columns are ignored.  Texts are
read whole by one task.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fits, map_batches, slices, written

# fixed values of the contract
FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_UPPER = 50, 65, 5
UPPER, SYMBOLS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"

BROADCAST_HASHES = 200_000  # 16 bytes each; above it the hashes are joined by a shuffle
PIECE_ROWS = 500            # rows of one hash in one piece of the self-join
SALTS = 32                  # groups for rows of one hash while its count is not known yet


def failures(raw: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    words = raw.split()  # bytes are split at 0x20 and 0x09 to 0x0D
    n = len(words)
    upper = len(raw) - len(raw.translate(None, UPPER))
    points = len(raw) if raw.isascii() else len(raw.decode())
    return ((n < LEAST_WORDS) | (100 * len(set(words)) < LEAST_DISTINCT * n) << 1
            | (100 * upper > MOST_UPPER * points) << 2
            | (len(raw.translate(None, SYMBOLS)) < len(raw)) << 3)


def _texts(docs: DataFrame, key: str, part: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col(key).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
                       F.xxhash64(text).alias("h"), text.alias("text"))


def _facts(texts: DataFrame) -> DataFrame:
    """Per row: id, part, hash, bits of A to D."""
    def work(batches):
        for ids, parts, hashes, some in slices(batches):
            yield {"id": ids, "part": parts, "h": hashes, "mask": [failures(t.encode()) for t in some]}

    return map_batches(texts, work, f"id {texts.schema['id'].dataType.simpleString()}, part string, h long, mask int")


def repeated(texts: DataFrame, facts: DataFrame) -> DataFrame:
    """The rows (id, part, h) whose text comes with a smaller id too."""
    counts = facts.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi"))
    twice = written(counts.where(F.col("lo") < F.col("hi"))
                    .select("h", F.ceil(F.col("n") / PIECE_ROWS).cast("int").alias("pieces")))
    if fits(twice, BROADCAST_HASHES):
        some = texts.join(F.broadcast(twice), "h")
    else:
        salt = F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("salt")
        dealt = twice.select("*", F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")).alias("salt"))
        some = texts.select("*", salt).join(dealt, ["h", "salt"]).drop("salt")
    left = some.select("id", "part", "h", "text", F.pmod(F.xxhash64("id"), F.col("pieces")).cast("int").alias("piece"))
    first = some.groupBy("h", "text").agg(F.min("id").alias("first_id"), F.max("pieces").alias("pieces"))
    right = first.select(F.col("h").alias("rh"), F.col("text").alias("rtext"), "first_id",
                         F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("rpiece"))
    return left.join(right, (F.col("h") == F.col("rh")) & (F.col("piece") == F.col("rpiece"))
                     & (F.col("text") == F.col("rtext")) & (F.col("first_id") < F.col("id")),
                     "left_semi").select("id", "part", "h")


def combinations(docs: DataFrame, labels: DataFrame, key: str = "doc_id", part: str = "source") -> DataFrame:
    """Documents by part and combination of failures: ``part``, ``mask``
    (bit i for filter i), ``n``, ``good``, ``toxic``."""
    texts = _texts(docs, key, part)
    facts = written(_facts(texts))
    marked = repeated(texts, facts).select("id", "part", "h", F.lit(1 << FILTERS.index("E")).alias("mask"),
                                           F.lit(0).alias("n"))
    by_row = (facts.select("id", "part", "h", "mask", F.lit(1).alias("n")).unionByName(marked)
              .groupBy("id", "part", "h").agg(F.bit_or("mask").alias("mask"), F.sum("n").alias("n")))
    known = (labels.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("string").alias("label_id"))
             .agg(F.max((F.col("quality") == 1).cast("int")).alias("g"),
                  F.max((F.col("toxic") == 1).cast("int")).alias("t")))
    # rows without an id meet no label; their own keys keep them apart
    label_id = F.coalesce(F.col("id").cast("string"), F.concat(F.lit("none "), F.col("h")))
    joined = by_row.join(known, label_id == F.col("label_id"), "left")
    return joined.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("g", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("t", F.lit(0))).alias("toxic"))


def _states() -> Column:
    """Every (filters before, filter) with the orders that reach it."""
    reached: dict[tuple[int, int], list[str]] = {}
    for order in permutations(range(len(FILTERS))):
        before = 0
        for f in order:
            reached.setdefault((f, before), []).append("".join(FILTERS[i] for i in order))
            before |= 1 << f
    return F.array(*[
        F.struct(F.lit(1 << f).alias("bit"), F.lit(before).alias("before"),
                 F.lit(before.bit_count() + 1).alias("step"), F.lit(",".join(orders)).alias("orders"),
                 F.lit(len(orders)).alias("n_orders")) for (f, before), orders in reached.items()])


def interactions(combos: DataFrame) -> DataFrame:
    """The report, from the rows of ``combinations``."""
    rows = combos.select("*", F.explode(_states()).alias("s")).select("part", "mask", "n", "good", "toxic", "s.*")
    fails = (F.col("mask").bitwiseAND(F.col("bit")) != 0)
    early = (F.col("mask").bitwiseAND(F.col("before")) != 0)

    def total(condition: Column, of: str = "n") -> Column:
        return F.sum(F.when(condition, F.col(of)).otherwise(0)).cast("long")

    per = rows.groupBy("part", "bit", "before", "step", "orders", "n_orders").agg(
        total(~fails & ~early).alias("kept"), total(fails & ~early).alias("removed"),
        total(fails & early).alias("redundant"), total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(fails & ~early, "good").alias("good_lost"), total(fails & ~early, "toxic").alias("toxic_lost"))
    shares = per.groupBy("part", "bit").agg(F.sum(F.col("removed") * F.col("n_orders")).alias("shapley"))
    out = per.join(shares, ["part", "bit"])
    return out.select("part", F.explode(F.split("orders", ",")).alias("filter_order"), "step", "kept", "removed",
                      "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def op11_filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return interactions(combinations(docs, labels))
