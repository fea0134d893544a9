"""Removal of multi-line chunks that repeat across the corpus.

The lines of a text are hashed, and a rolling hash over ``WINDOW_LINES`` line
hashes ends a chunk wherever it falls into one of ``SPREAD`` classes; a chunk
has ``LEAST_LINES`` visible (non-blank) lines or more.  Boundaries depend on
nearby lines alone, so texts that share a passage at different places share
its chunks.  All chunks are compared over the whole corpus, but for texts that
have fewer than ``LEAST_LINES`` visible lines in all: they are grouped by hash
and by their bytes, and every occurrence but the first (the smallest id, then
place) is removed.  Two chunks whose 128-bit hashes agree
but whose bytes differ are never removed.

Groups are pre-aggregated in every task, so a chunk that is everywhere moves
once from each; texts move once by chunk and once by document.

Defined cases: rows with the same id and text are one occurrence, and each of
them is returned; null ids come last; a null text stays null; a text without
repeated chunks stays as it is to the byte; an empty table gives an empty
result; other columns are untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, saved, slices

LEAST_LINES = 2
WINDOW_LINES = 2
SPREAD = 3
MASK = (1 << 64) - 1
ROLL = 0x9E3779B97F4A7C15


def visible(line: str) -> bool:
    return bool(line.strip())


def cut(lines: list[str]) -> list[tuple[int, int]]:
    """(first line, lines) of each chunk; a last part with too few visible
    lines joins the chunk before it."""
    import xxhash

    chunks, start, roll, seen = [], 0, 0, 0
    hashes = [xxhash.xxh64_intdigest(line.encode()) for line in lines]
    drop = pow(ROLL, WINDOW_LINES, 1 << 64)
    for i, h in enumerate(hashes):
        roll = (roll * ROLL + h) & MASK
        if i >= WINDOW_LINES:
            roll = (roll - hashes[i - WINDOW_LINES] * drop) & MASK
        seen += visible(lines[i])
        if seen >= LEAST_LINES and (roll >> 33) % SPREAD == 0:
            chunks.append((start, i + 1 - start))
            start, seen = i + 1, 0
    if start < len(lines):
        if chunks and seen < LEAST_LINES:
            last, n = chunks.pop()
            chunks.append((last, n + len(lines) - start))
        else:
            chunks.append((start, len(lines) - start))
    return chunks


def keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_h", F.xxhash64("text"))


def chunks(docs: DataFrame, with_text: bool) -> DataFrame:
    """(a, b, _h, doc_id, first, n) for each chunk that may be removed; ``a``
    and ``b`` are its hash.  ``text`` is added when asked for."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches):
        import xxhash

        for keys, hashes, texts in slices(batches):
            rows = []
            for key, own, text in zip(keys, hashes, texts):
                lines = (text or "").split("\n")
                for first, n in cut(lines) if len(lines) > 1 else []:
                    part = lines[first:first + n]
                    if sum(map(visible, part)) >= LEAST_LINES:
                        whole = "\n".join(part)
                        d = xxhash.xxh3_128_intdigest(whole.encode())
                        rows.append((_signed(d >> 64), _signed(d & MASK), own, key, first, n, whole))
            cols = list(zip(*rows)) if rows else [()] * 7
            names = ["a", "b", "_h", "doc_id", "first", "n"] + ["text"] * with_text
            yield dict(zip(names, cols))

    return map_batches(keyed(docs.select("doc_id", "text")).select("doc_id", "_h", "text"), work,
                       f"a long, b long, _h long, doc_id {kind}, first int, n int" + ", text string" * with_text)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _place() -> Column:
    """Order of occurrences: ids ascending, null ids last."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_h", "first")


def repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, _h, gone): the removed line ranges of each changed document."""
    same = (chunks(docs, True).groupBy("a", "b", "text")
            .agg(F.min(_place()).alias("keep"), F.max(_place()).alias("last")))
    groups = (same.groupBy("a", "b").agg(F.count(F.lit(1)).alias("kinds"), F.first("keep").alias("keep"),
                                         F.first("last").alias("last"))
              .where((F.col("kinds") == 1) & (F.col("keep") != F.col("last"))).select("a", "b", "keep"))
    groups = saved(groups)
    members = chunks(docs, False).join(groups, ["a", "b"]).where(_place() != F.col("keep"))
    return (members.groupBy("doc_id", "_h")
            .agg(F.sort_array(F.collect_set(F.struct("first", "n"))).alias("gone")))


def with_ranges(docs: DataFrame) -> DataFrame:
    """(row, gone, left): each row as a struct, its removed ranges (null where
    nothing goes) and the lines that stay of a changed text."""
    gone = repeats(docs).select(F.col("doc_id").alias("id"), F.col("_h").alias("gh"), "gone")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64("text").alias("h"))
    joined = rows.join(gone, F.col("row.doc_id").eqNullSafe(F.col("id")) & (F.col("h") == F.col("gh")), "left")
    left = F.filter(F.split("row.text", "\n"), lambda line, i: ~F.exists(
        "gone", lambda g: (i >= g["first"]) & (i < g["first"] + g["n"])))
    return joined.select("row", "gone", F.when(F.col("gone").isNotNull(), left).alias("left"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` without the repeated chunks.  ``n_chars`` follows the text; a
    document that loses all its lines goes."""
    changed = F.col("gone").isNotNull()
    rows = with_ranges(docs).where(~changed | (F.size("left") > 0))
    text = F.array_join("left", "\n")
    new = {"text": text}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return rows.select(*[F.when(changed, new[c]).otherwise(F.col("row")[c]).alias(c) if c in new
                         else F.col("row")[c].alias(c) for c in docs.columns])


def op3_line_chunks(docs: DataFrame) -> DataFrame:
    """Per document: lines, removed lines and chunks, digest of what stays."""
    rows = with_ranges(docs.select("doc_id", "text"))
    whole = F.coalesce("row.text", F.lit(""))
    none = F.array().cast("array<struct<first:int,n:int>>")
    gone = F.coalesce("gone", none)
    return rows.select(
        "row.doc_id",
        F.size(F.split(whole, "\n")).cast("long").alias("n_lines"),
        F.aggregate(gone, F.lit(0).cast("long"), lambda a, g: a + g["n"]).alias("n_removed_lines"),
        F.size(gone).cast("long").alias("n_removed_chunks"),
        F.sha2(F.when(F.col("gone").isNotNull(), F.array_join("left", "\n")).otherwise(whole).cast("binary"), 256)
        .alias("kept_sha256"))
