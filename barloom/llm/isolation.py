"""Quality rules: an isolation forest over rule statistics.

Every document gets a vector of rule statistics, unrounded: words, mean word
length, shares of duplicate lines and repeated words, shares of symbols and
other marks.  Random trees cut the vectors of all rows at random places; anomalous documents
are cut off after few cuts or are left with few others, so their mean path is
short.  The score is ``2 ** (-path / c)``.  One forest cuts all statistics, and
each statistic has a forest of its own, so that a document that is unusual in
one of them alone does not pass for being ordinary in the others.  The cut-offs
are calibrated on labelled rows: each forest may reject an equal part of
``FALSE_SHARE`` of the rows labelled good.

Nothing is sampled.  Trees grow ``HEIGHT`` levels, each by one pass over the
rows that pass the base rule: tasks count the rows of every node and find their
ranges, and the driver gets these figures only, of at most ``2 ** level`` nodes
a tree.  The cut-offs are order statistics of all rows labelled good that labels
may be learnt from, by refining selection.  Only scored rows are written to the
shared folder; what is read several times before that is kept on the executors'
disks for as long, and made again from the texts where one is lost.  Tasks and
files after the texts follow the number of rows, not the partitions of the input.

Defined cases: a null or empty text has no words and fails the base rule;
without good labels only the forest of all statistics counts, with ``DEFAULT_CUT``; repeated rows are scored
each on their own; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, saved, slices, training_row

# Fixed values of the contract.
WINDOW_WORDS, LEAST_WORDS, REPEAT_PERCENT = 5, 10, 20
SYMBOLS = re.compile(r"[#*$%&|<>]")

MARKS = re.compile(r"[!?@=+~^_\\/{}\[\]]")

TREES, OWN_TREES, HEIGHT = 100, 20, 8
FALSE_SHARE, DEFAULT_CUT = 0.005, 0.75
PARTS = 1024  # of a range of scores, counted in one pass
TASK_ROWS = 10_000  # a task of the passes over statistics; each gives figures of its own for every node
split_words = re.compile(r"[^\x20\x09-\x0D]+").findall
has_word = re.compile(r"[^\x20\x09-\x0D]").search
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
STATS = ["log_words", "word_length", "dup_lines", "repeat_words", "symbols", "with_symbol", "bare_symbol", "upper",
         "marks", "adjacent"]
#: Shares are taken over this many more words than there are, so that a short
#: text is not unusual for being short.
EXTRA_WORDS = 30


def repeated_words(words: list[str], width: int = WINDOW_WORDS) -> int:
    """Words inside a run of ``width`` words that the text has twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    runs = list(zip(*(words[i:] for i in range(width))))
    counts = Counter(runs)
    if len(counts) == n:
        return 0
    hit = np.zeros(len(words) + 1, np.int64)
    for i, run in enumerate(runs):
        if counts[run] > 1:
            hit[i] += 1
            hit[i + width] -= 1
    return int((np.cumsum(hit) > 0).sum())


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The base counts and the rule statistics of one text."""
    text = text or ""
    words = split_words(text)
    n, chars = len(words), sum(map(len, words))
    lines = [line for line in text.split("\n") if has_word(line)]
    dup = len(lines) - len(set(lines))
    symbols = len(SYMBOLS.findall(text))
    repeat = repeated_words(words)
    base = [n, chars, symbols, dup, repeat]
    if not n:
        return base, [0.0] * len(STATS)
    with_symbol = [w for w in words if SYMBOLS.search(w)]
    shares = [symbols, len(with_symbol), sum(not any(map(str.isalnum, w)) for w in with_symbol),
              sum(map(str.isupper, words)), len(MARKS.findall(text)), sum(map(str.__eq__, words, words[1:]))]
    # square roots, so that random cuts fall among small shares too
    return base, [float(np.log1p(n)), chars / n, np.sqrt(dup / len(lines)), np.sqrt(repeat / n),
                  *(np.sqrt(c / (n + EXTRA_WORDS)) for c in shares)]


def vectors(docs: DataFrame) -> DataFrame:
    """(doc_id, base counts, stats) for every row; texts stay behind."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches):
        for keys, texts in slices(batches):
            both = [statistics(t) for t in texts]
            yield {"doc_id": keys, "stats": [s for _, s in both]} | {
                name: [b[i] for b, _ in both] for i, name in enumerate(BASE)}

    counts = ", ".join(f"{b} long" for b in BASE)
    return map_batches(docs.select("doc_id", "text"), work, f"doc_id {kind}, {counts}, stats array<double>")


def mean_path(n: np.ndarray) -> np.ndarray:
    """The mean path that cuts one by one would still take in ``n`` rows."""
    more = np.maximum(n, 3).astype(float)
    far = 2 * (np.log(more - 1) + 0.5772156649) - 2 * (more - 1) / more
    return np.where(n < 2, 0.0, np.where(n == 2, 1.0, far))


class Forest:
    """Random trees as tables (tree, node): feature (-1: leaf), cut, and at
    leaves the path length with the usual allowance for rows left uncut.  The
    children of node i are 2i + 1 and 2i + 2.

    Trees grow a level at a time: ``measure`` counts rows in the nodes of the
    level and finds their least and largest statistics, which may be done in
    parts; ``grow`` cuts the nodes between them.  ``rows``: grow on these at once.
    """

    def __init__(self, rows: np.ndarray | None = None, trees: int = TREES, seed: int = 11,
                 columns: list[int] | None = None):
        self.columns = list(range(rows.shape[1])) if columns is None else columns
        self.trees, self.seed, self.norm = trees, seed, 0.0
        nodes = 2 ** (HEIGHT + 1) - 1
        self.feature, self.cut = np.full((trees, nodes), -1, np.int8), np.zeros((trees, nodes))
        self.path = np.tile(np.floor(np.log2(np.arange(nodes) + 1)), (trees, 1))
        if rows is not None and len(rows):
            for level in range(HEIGHT + 1):
                self.grow(level, *self.measure(rows, level))

    def nodes(self, x: np.ndarray, tree: int, levels: int = HEIGHT) -> np.ndarray:
        """The node of every row after ``levels`` cuts, or the leaf above."""
        node, every = np.zeros(len(x), np.int32), np.arange(len(x))
        feature, cut = self.feature[tree], self.cut[tree]
        for _ in range(levels):
            f = feature[node]
            inner = f >= 0
            if not inner.any():
                break
            right = x[every, np.maximum(f, 0)] > cut[node]
            node = np.where(inner, 2 * node + 1 + right, node)
        return node

    def measure(self, x: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(tree, node of the level): rows, least and largest statistics."""
        x = x[:, self.columns] if len(self.columns) < x.shape[1] else x
        n = np.zeros((self.trees, 2 ** level), np.int64)
        low = np.full((*n.shape, x.shape[1]), np.inf)
        high = -low
        for tree in range(self.trees):
            at = self.nodes(x, tree, level) - (2 ** level - 1)
            order = np.argsort(at, kind="stable")
            order = order[np.searchsorted(at[order], 0):]  # without rows in leaves above
            if not len(order):
                continue
            found, first = np.unique(at[order], return_index=True)
            n[tree, found] = np.diff(np.append(first, len(order)))
            low[tree, found] = np.minimum.reduceat(x[order], first, axis=0)
            high[tree, found] = np.maximum.reduceat(x[order], first, axis=0)
        return n, low, high

    def grow(self, level: int, n: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        """Cut the nodes of a level, given the figures of all rows."""
        if not level:
            self.norm = float(mean_path(n[0, 0]))
        at = slice(2 ** level - 1, 2 ** (level + 1) - 1)
        varied = high > low
        wide = varied.sum(axis=2)
        self.path[:, at] = level + mean_path(n)
        if level == HEIGHT:
            return
        which, where = np.random.default_rng([self.seed, level]).random((2, *n.shape))
        # the feature whose place among the varied ones was drawn
        f = (varied.cumsum(axis=2) > (which * wide).astype(int)[..., None]).argmax(axis=2)
        split = wide > 0
        least, most = (np.where(split, np.take_along_axis(v, f[..., None], axis=2)[..., 0], 0.0) for v in (low, high))
        self.feature[:, at] = np.where(split, f, -1)
        self.cut[:, at] = least + where * (most - least)

    def score(self, x: np.ndarray) -> np.ndarray:
        x = x[:, self.columns] if len(self.columns) < x.shape[1] else x
        total = np.zeros(len(x))
        for tree in range(self.trees):
            total += self.path[tree][self.nodes(x, tree)]
        return 2 ** (-total / self.trees / max(self.norm, 1e-9))


class Forests:
    """A forest over all statistics, then one for each statistic."""

    def __init__(self, rows: np.ndarray | None = None):
        self.all = Forest(rows, columns=list(range(len(STATS))))
        self.own = [Forest(rows, OWN_TREES, seed=12 + i, columns=[i]) for i in range(len(STATS))]

    def each(self) -> list[Forest]:
        return [self.all, *self.own]

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.stack([f.score(x) for f in self.each()], axis=1)


def grown(rows: DataFrame) -> Forests:
    """Forests over the ``stats`` of all rows; the same as ``Forests(array)``."""
    forests = Forests()
    for level in range(HEIGHT + 1):
        found = measured(rows, forests, level).toArrow()
        if not found.num_rows:
            break
        cols = {c: found.column(c).to_numpy() for c in found.column_names}
        for i, forest in enumerate(forests.each()):
            mine = cols["forest"] == i
            at = cols["tree"][mine], cols["node"][mine]
            n = np.zeros((forest.trees, 2 ** level), np.int64)
            low = np.full((*n.shape, len(forest.columns)), np.inf)
            high = -low
            n[at] = cols["n"][mine]
            for k in range(len(forest.columns)):
                low[*at, k], high[*at, k] = cols[f"low{k}"][mine], cols[f"high{k}"][mine]
            forest.grow(level, n, low, high)
    return forests


def measured(rows: DataFrame, forests: Forests, level: int) -> DataFrame:
    """The figures of ``Forest.measure`` over all rows, a row a node: each task
    gives those of its rows, which are added up by node."""
    lows, highs = ([f"{side}{k}" for k in range(len(STATS))] for side in ("low", "high"))

    def work(batches):
        total = None
        for (stats,) in slices(batches):
            x = np.array(stats)
            new = [f.measure(x, level) for f in forests.each()]
            total = new if total is None else [
                (n + m, np.minimum(low, least), np.maximum(high, most))
                for (n, low, high), (m, least, most) in zip(total, new)]
        for i, (n, low, high) in enumerate(total or []):
            tree, node = np.nonzero(n)
            out = {"forest": [i] * len(tree), "tree": tree, "node": node, "n": n[tree, node]}
            for names, v in ((lows, low), (highs, high)):
                out |= {c: v[tree, node, k] if k < v.shape[2] else [None] * len(tree) for k, c in enumerate(names)}
            yield out

    doubles = ", ".join(f"{c} double" for c in lows + highs)
    parts = map_batches(rows.select("stats"), work, f"forest int, tree int, node int, n long, {doubles}")
    return parts.groupBy("forest", "tree", "node").agg(
        F.sum("n").alias("n"), *[F.min(c).alias(c) for c in lows], *[F.max(c).alias(c) for c in highs])


def cut_place(n: int, k: int) -> int:
    """The place of the cut-off of one of ``k`` forests among ``n`` good rows."""
    return min(n - 1, int(n * (1 - FALSE_SHARE / k)))


def cuts(good: np.ndarray) -> np.ndarray:
    """The cut-off of each forest, from the scores of rows labelled good."""
    n, k = good.shape
    if not n:
        return np.array([DEFAULT_CUT] + [1.0] * (k - 1))  # no score is above 1
    return np.sort(good, axis=0)[cut_place(n, k)]


def exact_cuts(good: DataFrame) -> np.ndarray:
    """``cuts`` of stored ``scores`` of any number of rows, by refining
    selection: a pass counts the rows in ``PARTS`` parts of each forest's range,
    and the part that holds the cut-off is the next range.  The least and the
    largest score of a range never stay together, so ranges shrink to one value;
    the driver gets the figures of the parts only."""
    k = 1 + len(STATS)
    score = [F.col("scores")[i] for i in range(k)]
    n, *ends = good.agg(F.count(F.lit(1)), *map(F.min, score), *map(F.max, score)).first()
    if not n:
        return cuts(np.zeros((0, k)))
    low, high = np.array(ends).reshape(2, k)
    place = [cut_place(n, k)] * k  # of the cut-off in its range
    while (low < high).any():
        items = F.array(*[F.struct(F.lit(i).alias("c"), score[i].alias("x"), F.lit(float(low[i])).alias("lo"),
                                   F.lit(float(high[i])).alias("hi")) for i in range(k) if low[i] < high[i]])
        part = F.least(F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * PARTS), F.lit(PARTS - 1))
        found = good.select(F.inline(items)).where("x >= lo AND x <= hi").groupBy("c", part.alias("part")).agg(
            F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).collect()
        passed = set()
        for r in sorted(found, key=lambda r: (r.c, r.part)):
            if r.c in passed:
                continue
            if place[r.c] < r.n:
                low[r.c], high[r.c] = r.low, r.high
                passed.add(r.c)
            else:
                place[r.c] -= r.n
    return low


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def scored(rows: DataFrame, forest: Forests) -> DataFrame:
    """Adds the anomaly ``scores``, one of each forest."""
    names = [c for c in rows.columns if c != "stats"]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "stats")

    def work(batches):
        for *cols, stats in slices(batches):
            yield dict(zip(names, cols)) | {"scores": forest.score(np.array(stats)).tolist()}

    return map_batches(rows.select(*names, "stats"), work, f"{ddl}, scores array<double>")


def op8_isolation_forest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Base counts and verdict of every row."""
    plain = vectors(docs).persist(StorageLevel.DISK_ONLY)
    try:
        few = plain.coalesce(max(1, -(-plain.count() // TASK_ROWS)))
        rows = saved(scored(few, grown(few.where(~base_failed()))))
    finally:
        plain.unpersist()
    good = (labels.where("quality = 1").select("doc_id").where(training_row()).distinct()
            .join(rows.where(~base_failed()), "doc_id").select("scores").persist(StorageLevel.DISK_ONLY))
    try:
        limits = F.array(*[F.lit(float(c)) for c in exact_cuts(good)])
    finally:
        good.unpersist()
    over = F.array_max(F.zip_with("scores", limits, lambda s, c: s - c))
    return rows.select("doc_id", *BASE, base_failed().alias("base_failed"),
                       (~base_failed() & (over <= 0)).alias("kept"), over.alias("anomaly"))
