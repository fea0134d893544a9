"""SimHash fingerprints and near-duplicate groups by a binary trie self-join.

Two fingerprints within ``bits`` differing bits agree on at least one of
``bits + 1`` blocks of equal width.  Every distinct fingerprint is therefore
put, once for each block, under that block's value, and the other bits form a
binary trie.  Pairs of trie nodes are walked together from the root: the
differing bits add up on the way down and a pair over the budget is dropped
with everything below it.  A pair of nodes whose fingerprints are known to be
in one component already is dropped too, so a large group of near copies
costs no quadratic walk, and each task returns a spanning forest of its links
instead of all pairs.

Defined cases: null and empty texts have no words and fingerprint zero, which
links like any other; rows are never merged, a repeated row is returned as
often as it comes; a null ``doc_id`` is a document but never a component id
unless no member has an id; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hex64, map_batches, saved, slices
from .graph import components

SHINGLE_WORDS = 3  # fixed value of the contract
MAX_BITS = 3  # fixed value of the contract
SEED = 42  # fixed value of the contract
HASHES_AT_ONCE = 1 << 16
PAIRS_AT_ONCE = 1 << 17


def fingerprint(text: str | None, width: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of one text, as an unsigned number."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    words = (text or "").encode().lower().split()  # of bytes: only A-Z change, ASCII white space splits
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = max(1, len(words) - width + 1)
    lo, hi = starts[:k].tolist(), ends[-k:].tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, k, HASHES_AT_ONCE):
        part = [digest(line[a:b], SEED) for a, b in zip(lo[at:at + HASHES_AT_ONCE], hi[at:at + HASHES_AT_ONCE])]
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > k, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """(key, fp) for every row; ``fp`` is the fingerprint as a signed long."""
    kind = docs.schema[key].dataType.simpleString()

    def work(batches):
        for keys, texts in slices(batches):
            fp = np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64)
            yield {key: keys, "fp": fp}

    return map_batches(docs.select(key, text), work, f"`{key}` {kind}, fp long")


# ------------------------------------------------------------------ trie walk
def _settle(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the components of a[i] and b[i]; ``label`` maps to the least member."""
    while a.size:
        x, y = label[a], label[b]
        open_ = x != y
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        low = np.minimum(x, y)
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def trie_components(group: np.ndarray, bits: np.ndarray, width: int, budget: int) -> np.ndarray:
    """For rows sorted by (group, bits), all distinct: the least row of each
    row's component under links of at most ``budget`` differing bits inside a
    group.  ``bits`` are unsigned with ``width`` used low bits."""
    n = len(bits)
    label = np.arange(n)
    if n < 2:
        return label
    first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    last = np.concatenate((first[1:], [n]))
    wide = last - first > 1
    first, last = first[wide], last[wide]
    # a node is a range [lo, hi) of rows at a depth; a stack entry holds pairs of one depth
    stack = [(0, first[i:i + PAIRS_AT_ONCE], last[i:i + PAIRS_AT_ONCE], first[i:i + PAIRS_AT_ONCE],
              last[i:i + PAIRS_AT_ONCE], np.zeros(len(first[i:i + PAIRS_AT_ONCE]), np.int8))
             for i in range(0, len(first), PAIRS_AT_ONCE)]
    # ones[d][i]: rows before i whose bit at depth d is set; in a node the zeros come first
    ones: dict[int, np.ndarray] = {}

    def middle(depth: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        if depth not in ones:
            bit = (bits >> np.uint64(width - 1 - depth)) & np.uint64(1)
            ones[depth] = np.concatenate(([0], np.cumsum(bit.astype(np.int32), dtype=np.int32)))
        return hi - (ones[depth][hi] - ones[depth][lo])

    changes = np.concatenate(([0], np.cumsum(np.ones(n, np.int32))))  # prefix count of label changes
    while stack:
        depth, al, ah, bl, bh, diff = stack.pop()
        one_label = (changes[ah] - changes[al + 1] == 0) & (changes[bh] - changes[bl + 1] == 0)
        keep = ~(one_label & (label[al] == label[bl]))
        al, ah, bl, bh, diff = (x[keep] for x in (al, ah, bl, bh, diff))
        leaf = (ah - al == 1) & (bh - bl == 1)
        x, y = al[leaf], bl[leaf]
        near = np.bitwise_count(bits[x] ^ bits[y]) <= budget
        if depth == width:  # equal rows only; nothing is below
            leaf[:] = True
        if near.any():
            _settle(label, x[near], y[near])
            changes = np.concatenate(([0], np.cumsum(np.concatenate(([1], label[1:] != label[:-1])).astype(np.int32))))
        al, ah, bl, bh, diff = (v[~leaf] for v in (al, ah, bl, bh, diff))
        if not al.size:
            continue
        am, bm = middle(depth, al, ah), middle(depth, bl, bh)
        own = al == bl
        pairs = [(al, am, bl, bm, diff, None), (am, ah, bm, bh, diff, None),
                 (al, am, bm, bh, diff + 1, None), (am, ah, bl, bm, diff + 1, ~own)]
        cols = [[], [], [], [], []]
        for pl, ph, ql, qh, d, also in pairs:
            ok = (ph > pl) & (qh > ql) & (d <= budget)
            if also is not None:
                ok &= also
            # a node paired with itself needs two rows
            ok &= ~((pl == ql) & (ph - pl < 2))
            for c, v in zip(cols, (pl, ph, ql, qh, d)):
                c.append(v[ok])
        nxt = [np.concatenate(c) for c in cols]
        for i in range(0, len(nxt[0]), PAIRS_AT_ONCE):
            stack.append((depth + 1, *(v[i:i + PAIRS_AT_ONCE] for v in nxt)))
    return label


def links(distinct: DataFrame, budget: int = MAX_BITS) -> DataFrame:
    """``distinct(fp)`` -> links ``(a, b)`` that span the components of all
    pairs within ``budget`` bits; at most one per fingerprint and block."""
    blocks = budget + 1
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    fp = F.col("fp")
    cells = []
    for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        block = F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1))
        cells.append(F.struct(F.lit(i).alias("r"), block.alias("v")))
    keyed = distinct.select("fp", F.explode(F.array(*cells)).alias("c")).select("c.r", "c.v", "fp")

    def work(batches):
        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        r, v, x = (np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in rows]) for i in range(3))
        x = x.view(np.uint64)
        for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
            at = r == i
            if not at.any():
                continue
            # the bits outside the block, moved together
            low = x[at] & np.uint64((1 << lo) - 1)
            high = np.zeros_like(low) if hi == 64 else (x[at] >> np.uint64(hi)) << np.uint64(lo)
            rest, group, full = low | high, v[at], x[at].view(np.int64)
            order = np.lexsort((rest, group))
            label = trie_components(group[order], rest[order], 64 - (hi - lo), budget)
            far = np.flatnonzero(label != np.arange(len(label)))
            full = full[order]
            yield {"a": full[far], "b": full[label[far]]}

    return map_batches(keyed.repartition("r", "v"), work, "a long, b long")


def near_groups(docs: DataFrame, width: int = SHINGLE_WORDS, budget: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, root, component_id) for every row of ``docs``; ``root`` is
    the least fingerprint of the component."""
    fps = saved(fingerprints(docs, width))
    distinct = saved(fps.groupBy("fp").agg(F.min("doc_id").alias("least_id")))
    roots = components(links(distinct, budget))
    named = (distinct.join(roots, distinct.fp == roots.node, "left")
             .select("fp", "least_id", F.coalesce("root", "fp").alias("root")))
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = named.join(least, "root").select("fp", "root", "component_id")
    return fps.join(named, "fp").select("doc_id", "fp", "root", "component_id")


def op7_simhash_trie(docs: DataFrame) -> DataFrame:
    out = near_groups(docs)
    return out.select("doc_id", hex64(F.col("fp")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, width: int = SHINGLE_WORDS, budget: int = MAX_BITS) -> DataFrame:
    """One row of each near-duplicate group: the smallest ``doc_id`` (null ids
    last), then the smallest text hash; repeated rows leave one row."""
    own = F.xxhash64("text")
    keyed = docs.select(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", own.alias("h")).alias("doc_id"), "text")
    groups = near_groups(keyed, width, budget).select("root", "doc_id")
    chosen = (groups.groupBy("root").agg(F.min("doc_id").alias("k"))
              .select(F.col("k.doc_id").alias("kept_id"), F.col("k.h").alias("kept_h")))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("id"), own.alias("h"))
    kept = rows.join(chosen, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("h") == F.col("kept_h")), "left_semi")
    return kept.dropDuplicates(["id", "h"]).select(*[F.col("row")[c].alias(c) for c in docs.columns])
