"""Removal of repeated byte strings by sorted suffixes.

A byte goes when it lies in a string of ``LENGTH`` bytes that also starts
earlier in the corpus (smaller id, or same document and earlier place).  A
suffix therefore matters through its first ``LENGTH`` bytes, and the suffixes
of one document are handled in runs:

1. Every string of ``LENGTH`` bytes has an anchor, the place of its least
   ``GRAM``-byte hash (the first of equals), which depends on the string
   alone.  Neighbouring strings share anchors, so a document falls into runs
   of some thirty starts.  Each run is described by the hash of its anchor's
   gram and by the hash of all bytes of its strings.
2. Runs are dealt out by gram hash; a task sends one run of each gram it has,
   packed, and passes on the other runs of a repeated gram as known, so a gram
   that is everywhere is asked for once by each task.  Runs whose gram is
   unique in the corpus hold no repeated string and end here.
3. Runs with equal bytes form a class.  All but the first of a class are
   repeats; a task settles its own, so a class has one row from each task at
   most.  The first of a class is settled too if its gram has no other class.
4. The suffixes that are left start in first runs of grams with several
   classes, mostly at the edges of shared passages.  They are range-partitioned
   by leading bytes with sampled splitters; every bucket sorts them by multikey
   quicksort on 8-byte words and compares neighbours.  They travel as runs
   under the anchor's gram.  Where a gram has more than ``HOT_CLASSES``
   classes its suffixes travel one by one under all their bytes, after equal
   ones of a task have been merged, so no bucket holds more than one row of a
   suffix for each task.  Equal keys are never split by the range partitioner,
   so no equal suffixes lie on two sides of a boundary.

Equality of classes rests on 128 bits of hash; step 4 compares bytes.

Defined cases: a null text is empty; a text shorter than ``LENGTH`` bytes
loses nothing; rows with the same id and text are one document and each is
returned; rows with the same id and other texts are documents of their own in
the order of their text's hash; null ids come last; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType

from .common import map_batches, saved, slices, written

LENGTH = 100  # fixed value of the contract
GRAM = 24
HOT_CLASSES = 4096
RUNS_AT_ONCE = 500_000
SUFFIXES_AT_ONCE = 200_000
SMALL = 1024  # suffixes of a segment that are sorted as whole rows
PIECE = 1 << 15  # starts whose anchors are found at a time


# ------------------------------------------------------------ anchors, runs
def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def gram_hashes(data: np.ndarray, width: int = GRAM) -> np.ndarray:
    """A 64-bit hash of every ``width`` bytes, put together from the 8-byte
    words in it (the last two may overlap; a shorter one is masked)."""
    n, odd = len(data) - width + 1, np.uint64(0xD6E8FEB86659FD93)
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    word = np.ndarray((len(data),), "<u8", padded, strides=(1,)).astype(np.uint64)
    if width < 8:
        word &= np.uint64((1 << 8 * width) - 1)
    word += np.uint64(0x9E3779B97F4A7C15)
    word *= odd
    word ^= word >> np.uint64(32)
    places = sorted({*range(0, max(1, width - 7), 8), max(0, width - 8)})
    out = word[:n].copy()
    for at in places[1:]:
        out *= odd
        out += word[at:at + n]
    out ^= out >> np.uint64(32)
    out *= odd
    return out


def anchors(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(gram hash, place) of the anchor of every string of ``length`` bytes.
    The least hash is looked for by its upper bits with the place below them,
    so one minimum settles both; pieces of ``PIECE`` starts stay in cache and
    the result does not depend on where they are cut."""
    n = len(data) - length + 1
    wide = length - gram + 1
    bits = np.uint64((PIECE + wide).bit_length())
    hashes, places = np.empty(n, np.uint64), np.empty(n, np.int64)
    for at in range(0, n, PIECE):
        size = min(PIECE, n - at)
        own = gram_hashes(data[at:at + size + length - 1], gram)
        least, done = (own >> bits << bits) | np.arange(len(own), dtype=np.uint64), 1
        while done < wide:
            step = min(done, wide - done)
            least = np.minimum(least[:-step], least[step:])
            done += step
        place = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        hashes[at:at + size], places[at:at + size] = own[place], place + at
    return hashes, places


def runs_of(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text number, gram hash, first start, starts, anchor - first start) of
    each run of all ``texts``, which are worked on as one buffer."""
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    hashes, places = anchors(np.frombuffer(b"".join(texts), np.uint8), length, gram)
    inside = np.ones(len(places), bool)  # strings across two texts are none
    for end in ends[:-1].tolist():
        inside[max(0, end - length + 1):end] = False
    start = np.flatnonzero(inside)
    place = places[start]
    # anchors of different texts lie at different places, so no run spans two texts
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    count = np.diff(np.concatenate((first, [len(place)])))
    start, place = start[first], place[first]
    which = np.searchsorted(ends, start, side="right")
    return which, hashes[start], start - (ends - sizes)[which], count, place - start


# ------------------------------------------------------------ packed runs
#: Columns of a packed block: gram hash, bytes' hash, row id, first start, starts, anchor's place, state.
#: States: a run that asks whether its gram is repeated; one of a gram that the task has more of; the run that
#: asks for such a gram; and a run whose bytes the task has from an earlier place, which is settled.
ASKS, KNOWN, ASKS_REPEATED, SETTLED = range(4)
PACKED = ["<u8", "<u8", "<i8", "<i4", "u1", "u1", "u1"]


def _pack(cols: list[np.ndarray]) -> bytes:
    import zstandard

    order = np.lexsort((cols[3], cols[2]))
    cols = [c[order].astype(kind) for c, kind in zip(cols, PACKED)]
    cols[2] = np.diff(cols[2], prepend=0)
    raw = b"".join(c.view(np.uint8).reshape(len(c), -1).T.tobytes() for c in cols)  # byte planes
    return len(order).to_bytes(4, "little") + zstandard.compress(raw, 1)


def _unpack(block: bytes) -> list[np.ndarray]:
    import zstandard

    n, raw, at, cols = int.from_bytes(block[:4], "little"), zstandard.decompress(block[4:]), 0, []
    for kind in PACKED:
        size = np.dtype(kind).itemsize
        plane = np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n)
        cols.append(np.ascontiguousarray(plane.T).view(kind).reshape(n))
        at += n * size
    cols[2] = np.cumsum(cols[2])
    return cols


def packed_runs(rows: DataFrame, buckets: int, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(bucket, block): the runs of all rows, dealt out by gram hash."""
    def flush(parts):
        cols = [np.concatenate(c) for c in zip(*parts)]
        order = np.lexsort((cols[3], cols[2], cols[1], cols[0]))
        cols = [c[order] for c in cols]
        first = np.concatenate(([True], cols[0][1:] != cols[0][:-1]))
        again = np.concatenate((~first[1:], [False])) & first
        later = ~first & np.concatenate(([False], cols[1][1:] == cols[1][:-1]))
        # rows of one document may come twice; none of them is later than the other
        same = np.concatenate(([False], (cols[2][1:] == cols[2][:-1]) & (cols[3][1:] == cols[3][:-1])))
        head = np.maximum.accumulate(np.where(~later, np.arange(len(later)), 0))
        own = same & (cols[2] == cols[2][head]) & (cols[3] == cols[3][head])
        known = np.where(first, np.where(again, ASKS_REPEATED, ASKS), np.where(later & ~own, SETTLED, KNOWN))
        by_gram = (cols[0] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
        by_row = _mix(cols[2].view(np.uint64) + cols[3].astype(np.uint64)) % np.uint64(buckets)
        bucket = np.where(first, by_gram, by_row)
        order = np.argsort(bucket, kind="stable")
        cols, bucket = [c[order] for c in (*cols, known)], bucket[order]
        edges = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
        return {"bucket": bucket[edges[:-1]].astype(np.int32),
                "block": [_pack([c[a:b] for c in cols]) for a, b in zip(edges, edges[1:])]}

    def work(batches):
        import xxhash

        parts, held = [], 0
        for rids, texts in slices(batches):
            own = [(rid, text) for rid, text in zip(rids, texts) if len(text or b"") >= length]
            if not own:
                continue
            ids, own = np.array([rid for rid, _ in own], np.int64), [text for _, text in own]
            which, g, first, n, off = runs_of(own, length, gram)
            views = [memoryview(text) for text in own]
            body = np.array([xxhash.xxh64_intdigest(views[w][a:a + m + length - 1], o) for w, a, m, o in
                             zip(which.tolist(), first.tolist(), n.tolist(), off.tolist())], np.uint64)
            parts.append((g, body, ids[which], first, n, off))
            held += len(g)
            if held >= RUNS_AT_ONCE:
                yield flush(parts)
                parts, held = [], 0
        if parts:
            yield flush(parts)

    return map_batches(rows.select("rid", "text"), work, "bucket int, block binary")


def repeated_runs(blocks: DataFrame, partitions: int) -> DataFrame:
    """The runs whose gram is found more than once in the corpus."""
    def settle(held):
        cols = [np.concatenate(c) for c in zip(*map(_unpack, held))]
        asks = (cols[6] == ASKS) | (cols[6] == ASKS_REPEATED)
        grams, where, count = np.unique(cols[0], return_inverse=True, return_counts=True)
        ask_count = np.bincount(where[asks], minlength=len(grams))
        more = np.zeros(len(grams), bool)
        more[where[cols[6] == ASKS_REPEATED]] = True
        keep = ~asks | (ask_count > 1)[where] | more[where]
        g, body, rid, first, n, off, state = (c[keep] for c in cols)
        gone = state == SETTLED
        # settled runs are members of no class any more; a gram of their own spreads them
        g = np.where(gone, _mix(rid.view(np.uint64) * np.uint64(31) + first.astype(np.uint64)), g)
        return {"g": g.view(np.int64), "c": body.view(np.int64), "rid": rid, "start": first,
                "n": n.astype(np.int32), "off": off.astype(np.int32), "gone": gone}

    def work(batches):
        held, now = [], None
        for batch in batches:
            for bucket, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if bucket != now and held:
                    yield settle(held)
                    held = []
                now = bucket
                held.append(block)
        if held:
            yield settle(held)

    dealt = blocks.repartition(partitions, "bucket").sortWithinPartitions("bucket")
    return map_batches(dealt, work, "g long, c long, rid long, start int, n int, off int, gone boolean")


# ------------------------------------------------------------ suffix sort
def suffix_words(view: np.ndarray) -> np.ndarray:
    """Rows of ``LENGTH`` bytes as big-endian words, zero-filled at the end."""
    out = np.zeros((len(view), 8 * (-(-view.shape[1] // 8))), np.uint8)
    out[:, :view.shape[1]] = view
    return out.view(">u8").astype(np.uint64)


def multikey_quicksort(words: np.ndarray) -> np.ndarray:
    """The order of the rows of ``words``.  A segment is split three ways by a
    pivot in its current word; the equal part goes on to the next word.  Small
    segments are finished by comparing whole rows."""
    n, depth_max = words.shape
    order = np.empty(n, np.int64)
    stack = [(0, np.arange(n), 0)]
    rng = np.random.default_rng(n)
    whole = np.ascontiguousarray(words.astype(">u8")).view(f"S{8 * depth_max}").reshape(n)
    while stack:
        at, rows, depth = stack.pop()
        size = len(rows)
        if size <= SMALL or depth == depth_max:
            if depth < depth_max and size > 1:
                rows = rows[np.argsort(whole[rows], kind="stable")]
            order[at:at + size] = rows
            continue
        word = words[rows, depth]
        pivot = np.sort(word[rng.integers(0, size, 9)])[4]
        low, high = word < pivot, word > pivot
        below, above, same = rows[low], rows[high], rows[~(low | high)]
        if len(below):
            stack.append((at, below, depth))
        stack.append((at + len(below), same, depth + 1))
        if len(above):
            stack.append((at + len(below) + len(same), above, depth))
    return order


def later_equals(words: np.ndarray, rid: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Whether each suffix equals one that starts earlier in the corpus."""
    if not len(words):
        return np.zeros(0, bool)
    order = multikey_quicksort(words)
    s = words[order]
    new = np.concatenate(([True], (s[1:] != s[:-1]).any(axis=1), [True]))
    out = np.zeros(len(words), bool)
    shared = ~(new[:-1] & new[1:])  # in a group of two or more
    if not shared.any():
        return out
    rows, group = order[shared], np.cumsum(new[:-1])[shared]
    by = np.lexsort((start[rows], rid[rows], group))
    rows, group = rows[by], group[by]
    first = np.concatenate(([True], group[1:] != group[:-1]))
    # the first of a group, and its own repeated rows, are originals
    head = rows[np.maximum.accumulate(np.where(first, np.arange(len(rows)), 0))]
    out[rows] = (rid[rows] != rid[head]) | (start[rows] != start[head])
    return out


def edge_suffixes(texts: DataFrame, open_runs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(key, body, rid, start, n) for the open runs: ordinary runs as ``body``
    under their anchor's gram; suffixes of hot grams one by one under all
    their bytes.  Rows with ``n`` set are repeats already (seen in this task)."""
    wanted = open_runs.groupBy("rid").agg(F.collect_list(F.struct("start", "n", "off", "hot")).alias("runs"))
    # all columns of ``texts``, so that its exchange is the one the last join uses too
    joined = texts.join(wanted, "rid").select("rid", "doc_id", "text", "runs")

    def work(batches):
        import xxhash

        seen: dict[bytes, tuple] = {}
        names = ["key", "body", "rid", "start", "n"]
        for rids, _, texts, runs in slices(batches):
            rows = []
            for rid, text, own in zip(rids, texts, runs):
                for r in own:
                    a, n = r["start"], r["n"]
                    if not r["hot"]:
                        rows.append((text[a + r["off"]:a + r["off"] + gram], text[a:a + n + length - 1], rid, a, None))
                        continue
                    for p in range(a, a + n):
                        s = text[p:p + length]
                        # rows come in no order: the earlier of two equals stays, the later one is a repeat
                        here, there = (rid, p), seen.setdefault(s, (rid, p))
                        if there != here:
                            seen[s] = min(here, there)
                            late = max(here, there)
                            # any key will do for a settled row: one that spreads them over the buckets
                            rows.append((xxhash.xxh64_digest(b"%d:%d" % late), None, *late, 1))
                if len(seen) > SUFFIXES_AT_ONCE:
                    rows += [(s, None, *place, None) for s, place in seen.items()]
                    seen = {}
            yield dict(zip(names, zip(*rows))) if rows else dict.fromkeys(names, ())
        if seen:
            yield dict(zip(names, zip(*[(s, None, *place, None) for s, place in seen.items()])))

    return map_batches(joined, work, "key binary, body binary, rid long, start int, n int")


def sorted_repeats(suffixes: DataFrame, partitions: int, length: int = LENGTH) -> DataFrame:
    """(rid, start, n): runs of repeated starts among the open suffixes."""
    def bucket(keys, bodies, rids, starts):
        whole = [(k, r, p) for k, b, r, p in zip(keys, bodies, rids, starts) if b is None]
        runs = [(b, r, p) for b, r, p in zip(bodies, rids, starts) if b is not None]
        for rows in (whole, runs):
            if not rows:
                continue
            views, rid, start = [], [], []
            for b, r, p in rows:
                v = np.lib.stride_tricks.sliding_window_view(np.frombuffer(b, np.uint8), length)
                views.append(v)
                rid.append(np.full(len(v), r, np.int64))
                start.append(np.arange(p, p + len(v)))
            rid, start = np.concatenate(rid), np.concatenate(start)
            again = later_equals(suffix_words(np.concatenate(views)), rid, start)
            rid, start = rid[again], start[again]
            order = np.lexsort((start, rid))
            rid, start = rid[order], start[order]
            if len(rid):
                cut = np.flatnonzero(np.concatenate(([True], (rid[1:] != rid[:-1]) | (np.diff(start) != 1), [True])))
                yield {"rid": rid[cut[:-1]], "start": start[cut[:-1]].astype(np.int32),
                       "n": np.diff(cut).astype(np.int32)}

    def work(batches):
        held, size = [], 0
        for cols in slices(batches):
            rows = list(zip(*cols))
            done = [r for r in rows if r[4] is not None]
            if done:
                yield {"rid": [r[2] for r in done], "start": [r[3] for r in done], "n": [r[4] for r in done]}
            for r in rows:
                if r[4] is not None:
                    continue
                # a bucket is worked off in parts that end where the key changes
                if size > SUFFIXES_AT_ONCE and r[0] != held[-1][0]:
                    yield from bucket(*zip(*[h[:4] for h in held]))
                    held, size = [], 0
                held.append(r)
                size += 1 if r[1] is None else len(r[1]) - length + 1
        if held:
            yield from bucket(*zip(*[h[:4] for h in held]))

    dealt = suffixes.repartitionByRange(partitions, "key", "n").sortWithinPartitions("key")
    return map_batches(dealt, work, "rid long, start int, n int")


# ------------------------------------------------------------ the operator
def numbered(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, text): ``rid`` orders the documents.  Unique integer ids
    are their own numbers; else distinct (id, text hash) pairs are numbered in
    order, from counts of range partitions."""
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    integral = isinstance(docs.schema["doc_id"].dataType, (IntegerType, LongType))
    total, known, distinct = docs.agg(F.count(F.lit(1)), F.count("doc_id"), F.count_distinct("doc_id")).first()
    if integral and total == known == distinct:
        return rows.select(F.col("doc_id").cast("long").alias("rid"), "doc_id", "text")
    rows = rows.withColumn("_h", F.xxhash64("text"))
    pairs = rows.select(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_h").distinct()
    pairs = saved(pairs.repartitionByRange("no_id", "doc_id", "_h").withColumn("part", F.spark_partition_id()))
    sizes = pairs.groupBy("part").agg(F.count(F.lit(1)).alias("size"))  # one row a partition
    base = sizes.withColumn("base", F.coalesce(F.sum("size").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("part", "base")
    place = F.row_number().over(Window.partitionBy("part").orderBy("no_id", "doc_id", "_h")) - 1
    ids = pairs.withColumn("place", place).join(base, "part").select(
        F.col("doc_id").alias("_id"), F.col("_h").alias("_ih"), (F.col("base") + F.col("place")).alias("rid"))
    same = rows.doc_id.eqNullSafe(F.col("_id")) & (rows._h == F.col("_ih"))
    return rows.join(ids, same).select("rid", "doc_id", "text")


def repeats(rows: DataFrame, texts: DataFrame, partitions: int, length: int = LENGTH, gram: int = GRAM,
            hot: int = HOT_CLASSES) -> DataFrame:
    """(rid, start, n): runs of starts whose strings also start earlier."""
    members = repeated_runs(packed_runs(rows, 8 * partitions, length, gram), partitions)
    # a class has one row from each task at most (and equal rows), so it fits a window
    first = F.min(F.struct("rid", "start")).over(Window.partitionBy("g", "c", "gone"))
    placed = written(members.withColumn("own", ~F.col("gone") & (F.struct("rid", "start") == first)))
    settled = placed.where(~F.col("own")).select("rid", "start", "n")
    heads = placed.where("own").select("g", "c", "rid", "start", "n", "off").distinct()
    per_gram = heads.groupBy("g").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    left = heads.join(per_gram, "g").select("rid", "start", "n", "off", (F.col("kinds") > hot).alias("hot"))
    # rows of one document may stand for several equal ones
    edges = sorted_repeats(edge_suffixes(texts, left, length, gram), partitions, length)
    return settled.union(edges)


def marked(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT_CLASSES) -> DataFrame:
    """(rid, doc_id, text as bytes, marks) for every row of ``docs``."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = numbered(docs)
    # texts move once, for both joins: they need the same columns and the same filter
    texts = rows.where(F.col("rid").isNotNull()).repartition(partitions, "rid")
    gone = repeats(rows, texts, partitions, length, gram, hot)
    gone = gone.groupBy("rid").agg(F.collect_list(F.struct("start", "n")).alias("marks"))
    return texts.join(gone, "rid", "left").select("rid", "doc_id", "text", "marks")


def spans_of(marks: list, length: int = LENGTH) -> list[tuple[int, int]]:
    """Maximal removed byte ranges of the marked starts."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((m["start"], m["start"] + m["n"] - 1 + length) for m in marks):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def op1_suffix_dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT_CLASSES) -> DataFrame:
    """Per row: bytes, removed bytes and runs, digest of what stays."""
    rows = marked(docs, length, gram, hot)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def work(batches):
        for _, keys, texts, marks in slices(batches):
            n, gone, runs, digest = [], [], [], []
            for text, own in zip(texts, marks):
                spans = spans_of(own or [], length)
                kept, at = hashlib.sha256(), 0
                for a, b in spans:
                    kept.update(text[at:a])
                    at = b
                kept.update(text[at:])
                n.append(len(text))
                gone.append(sum(b - a for a, b in spans))
                runs.append(len(spans))
                digest.append(kept.hexdigest())
            yield {"doc_id": keys, "n_bytes": n, "n_removed": gone, "n_spans": runs, "kept_sha256": digest}

    return map_batches(rows, work, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, text): the remaining bytes of every row as text; bytes cut out
    of a character are replaced by U+FFFD."""
    rows = marked(docs, length)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def work(batches):
        for _, keys, texts, marks in slices(batches):
            out = []
            for text, own in zip(texts, marks):
                at, parts = 0, []
                for a, b in spans_of(own or [], length):
                    parts.append(text[at:a])
                    at = b
                out.append(b"".join((*parts, text[at:])).decode("utf-8", "replace"))
            yield {"doc_id": keys, "text": out}

    return map_batches(rows, work, f"doc_id {kind}, text string")
