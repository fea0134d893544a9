"""Product codes by Lloyd rounds over cover trees.

Vectors become integers and are cut into 16 parts; every part position has a
codebook.  Each task packs its rows into chunks and builds, for every chunk
and part position, one cover tree that is stored and used by all rounds:

* a node has a centre, a radius (the largest distance from the centre to a
  point below it) and a run of the points, which are kept in tree order, so the
  running sums of the ordered points give the count and sum of any subtree;
* the children of a node of scale s have scale s / 2: their centres are more
  than s / 2 apart, the first is the node's own centre, and every point lies
  within s / 2 of the centre of its child.  Equal points are one place.

A round walks the trees from the roots.  With d1 and d2 the distances from a
centre to its nearest and second nearest entry, every point within radius r has
the same nearest entry if d2 - d1 > 2 r: the whole subtree is added to that
entry by its sums.  Otherwise the children follow, and the points of ambiguous
leaves are compared exactly, in integers, ties to the lower index.  What a
round sends on is one count and sum for each task, part and entry; the driver
holds the codebooks (64 entries) only.

Defined cases: rows whose vector is null or has a null or non-finite component
are dropped, and so are vectors that cannot be cut like the others: an empty
one, one whose length is no multiple of 16, or another length than that of the
smallest id.  Null ids come last in the order of ids; equal ids are ordered by
their components.  With fewer than 64 vectors the codebooks have as many
entries.  Components beyond 2^26 in size (after the factor 256) are set to
2^26, which keeps every distance in 64 bits.  Repeated rows are coded each; null
labels are one label; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import io

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, salted_lookup, with_salt, written

PARTS, ENTRIES, ROUNDS, FACTOR = 16, 64, 2, 256  # fixed values of the contract
LARGEST = 1 << 26
EXACT = 1 << 20       # sums of up to 2^11 products of numbers below this are exact in doubles
CHUNK_ROWS = 16_384   # rows of one set of trees
LEAF_POINTS = 24      # a node with no more places is a leaf
TREE_SCHEMA = "ids {id}, labels {label}, points binary, trees binary"


# ------------------------------------------------------------------- trees
class CoverTree:
    """One tree over the rows of an integer matrix."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF_POINTS):
        places, which = np.unique(points, axis=0, return_inverse=True)
        x = places.astype(np.float64)
        centre, lo, hi, first, n_children, radius = [], [], [], [], [], []
        order = np.empty(len(x), np.int64)

        def distances(c, among):
            d = x[among] - x[c]
            return np.sqrt(np.einsum("ij,ij->i", d, d))

        root = np.arange(len(x))
        level = [(0, root, distances(0, root), None)]
        starts = [0]
        while level:
            following = []
            base = len(centre) + len(level)
            for (c, members, d, scale), start in zip(level, starts):
                r = float(d.max())
                scale = r if scale is None else scale
                centre.append(c), lo.append(start), hi.append(start + len(members)), radius.append(r)
                first.append(base + len(following))
                if len(members) <= leaf or r == 0.0:
                    order[start:start + len(members)] = members
                    n_children.append(0)
                    continue
                half = scale / 2
                while half >= r:  # an empty scale: the only child would be the node itself
                    half /= 2
                child, rest, near = c, members, d
                before = len(following)
                while True:
                    inside = near <= half
                    following.append((child, rest[inside], near[inside], half))
                    rest = rest[~inside]
                    if not len(rest):
                        break
                    child = rest[0]
                    near = distances(child, rest)
                n_children.append(len(following) - before)
            # a child's run lies inside its parent's
            starts = []
            for k in range(base - len(level), base):
                at = lo[k]
                for j in range(first[k] - base, first[k] - base + n_children[k]):
                    starts.append(at)
                    at += len(following[j][1])
            level = following
        # places to rows: rows of one place follow one another
        rank = np.empty(len(x), np.int64)
        rank[order] = np.arange(len(x))
        row_rank = rank[which.reshape(-1)]
        self.order = np.argsort(row_rank, kind="stable").astype(np.int32)
        at = np.concatenate(([0], np.cumsum(np.bincount(row_rank, minlength=len(x)))))
        self.centre = places[centre]
        self.lo, self.hi = at[lo].astype(np.int32), at[hi].astype(np.int32)
        self.first, self.n_children = np.array(first, np.int32), np.array(n_children, np.int32)
        self.radius = np.array(radius)

    FIELDS = ("order", "centre", "lo", "hi", "first", "n_children", "radius")

    def fields(self) -> list[np.ndarray]:
        return [getattr(self, f) for f in self.FIELDS]

    @classmethod
    def of(cls, fields) -> CoverTree:
        tree = cls.__new__(cls)
        for name, value in zip(cls.FIELDS, fields):
            setattr(tree, name, value)
        return tree

    def assign(self, points: np.ndarray, book: np.ndarray, codes: np.ndarray | None = None):
        """Counts and sums of the points of every entry; ``codes`` (by row) is
        filled when given."""
        n = np.zeros(len(book), np.int64)
        sums = np.zeros(book.shape, np.int64)
        ordered = points[self.order]
        below = np.zeros((len(points) + 1, points.shape[1]), np.int64)
        np.cumsum(ordered, axis=0, out=below[1:])
        entries = book.astype(np.float64)
        open_nodes = np.zeros(1, np.int64)
        exact = []
        while len(open_nodes):
            d = np.sqrt(((self.centre[open_nodes].astype(np.float64)[:, None] - entries) ** 2).sum(axis=2))
            best = d.argmin(axis=1)
            rows = np.arange(len(best))
            d1 = d[rows, best]
            d[rows, best] = np.inf
            slack = 1e-9 * (1.0 + d1 + self.radius[open_nodes])
            sure = d.min(axis=1) - d1 > 2 * self.radius[open_nodes] + slack
            k, e = open_nodes[sure], best[sure]
            np.add.at(n, e, self.hi[k] - self.lo[k])
            np.add.at(sums, e, below[self.hi[k]] - below[self.lo[k]])
            if codes is not None:
                codes[self.order[_runs(self.lo[k], self.hi[k])]] = np.repeat(e, self.hi[k] - self.lo[k])
            k = open_nodes[~sure]
            leaf = self.n_children[k] == 0
            exact.append(_runs(self.lo[k[leaf]], self.hi[k[leaf]]))
            k = k[~leaf]
            open_nodes = _runs(self.first[k], self.first[k] + self.n_children[k])
        at = np.concatenate(exact)
        e = nearest(ordered[at], book)
        np.add.at(n, e, 1)
        np.add.at(sums, e, ordered[at])
        if codes is not None:
            codes[self.order[at]] = e
        return n, sums


def _runs(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The numbers of all runs [lo, hi), one after another."""
    size = (hi - lo).astype(np.int64)
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(lo - (ends - size), size)


def nearest(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    """The nearest entry of every point in integers, ties to the lower index."""
    small = max(np.abs(points).max(initial=0), np.abs(book).max(initial=0)) < EXACT
    kind = np.float64 if small else np.int64
    p, b = points.astype(kind), book.astype(kind)
    return ((b * b).sum(axis=1) - 2 * (p @ b.T)).argmin(axis=1)


def _packed(arrays: list[np.ndarray]) -> bytes:
    out = io.BytesIO()
    for a in arrays:
        np.save(out, a, allow_pickle=False)
    return out.getvalue()


def _unpacked(raw: bytes):
    source = io.BytesIO(raw)
    while source.tell() < len(raw):
        yield np.load(source, allow_pickle=False)


# ------------------------------------------------------------------- Spark
def integer_vectors(rows: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """The kept rows as ``id``, ``label`` and integers ``v``."""
    x = F.col(vector)
    whole = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                                     & (F.abs(c.cast("double")) < float("inf")))

    def integer(c: Column) -> Column:
        return F.floor(F.greatest(F.least(c.cast("double") * FACTOR, F.lit(float(LARGEST))), F.lit(float(-LARGEST))))

    ok = rows.where(whole & (F.size(x) > 0) & (F.size(x) % PARTS == 0))
    return ok.select(F.col(key).alias("id"), F.col(label).alias("label"), F.transform(x, integer).alias("v"))


def build_trees(vectors: DataFrame, width: int) -> DataFrame:
    """One row for each chunk: ids, labels, integer points and trees."""
    w = width // PARTS

    def work(batches):
        def packed(chunk):
            points = np.array([v for _, _, v in chunk], np.int32).reshape(len(chunk), width)
            trees = [CoverTree(points[:, p * w:(p + 1) * w]).fields() for p in range(PARTS)]
            return {"ids": [[i for i, _, _ in chunk]], "labels": [[x for _, x, _ in chunk]],
                    "points": [points.tobytes()], "trees": [_packed([a for t in trees for a in t])]}

        chunk = []
        for batch in batches:
            chunk += zip(*(batch.column(i).to_pylist() for i in range(3)))
            while len(chunk) >= CHUNK_ROWS:
                yield packed(chunk[:CHUNK_ROWS])
                chunk = chunk[CHUNK_ROWS:]
        if chunk:
            yield packed(chunk)

    kinds = {c: f"array<{vectors.schema[c].dataType.simpleString()}>" for c in ("id", "label")}
    return map_batches(vectors.where(F.size("v") == width), work, TREE_SCHEMA.format(**kinds))


def _chunks(batches, width: int):
    """Stored chunks: ids, labels, points, trees by part."""
    for batch in batches:
        for i in range(batch.num_rows):
            points = np.frombuffer(batch.column("points")[i].as_py(), np.int32).reshape(-1, width)
            arrays = list(_unpacked(batch.column("trees")[i].as_py()))
            step = len(CoverTree.FIELDS)
            trees = [CoverTree.of(arrays[p * step:(p + 1) * step]) for p in range(PARTS)]
            yield batch, i, points, trees


def lloyd_round(trees: DataFrame, books: np.ndarray) -> np.ndarray:
    """New codebooks (parts x entries x components) from one pass."""
    parts, entries, w = books.shape

    def work(batches):
        n, sums = np.zeros((parts, entries), np.int64), np.zeros(books.shape, np.int64)
        for _, _, points, some in _chunks(batches, parts * w):
            for p, tree in enumerate(some):
                more, total = tree.assign(points[:, p * w:(p + 1) * w], books[p])
                n[p] += more
                sums[p] += total
        p, e = np.nonzero(n)
        yield {"part": p.tolist(), "entry": e.tolist(), "n": n[p, e].tolist(), "sums": sums[p, e].tolist()}

    partial = map_batches(trees.select("points", "trees"), work, "part int, entry int, n long, sums array<long>")
    total = partial.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[j]) for j in range(w)]).alias("sums"))
    new = books.copy()
    for row in total.collect():  # at most parts x entries rows
        new[row["part"], row["entry"]] = [s // row["n"] for s in row["sums"]]
    return new


def code_rows(trees: DataFrame, books: np.ndarray) -> DataFrame:
    """Per vector: id, label, code and error."""
    parts, _, w = books.shape
    fields = {f.name: f.dataType.elementType.simpleString() for f in trees.schema.fields if f.name in ("ids", "labels")}

    def work(batches):
        for batch, i, points, some in _chunks(batches, parts * w):
            codes = np.zeros((len(points), parts), np.uint8)
            error = np.zeros(len(points), np.int64)
            for p, tree in enumerate(some):
                part = points[:, p * w:(p + 1) * w].astype(np.int64)
                tree.assign(part, books[p], codes[:, p])
                error += ((part - books[p][codes[:, p]]) ** 2).sum(axis=1)
            yield {"id": batch.column("ids")[i].values, "label": batch.column("labels")[i].values,
                   "code": [c.tobytes().hex() for c in codes], "error": error.tolist()}

    return map_batches(trees, work, f"id {fields['ids']}, label {fields['labels']}, code string, error long")


def vector_codes(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                 rounds: int = ROUNDS) -> DataFrame:
    """Per kept vector: key, ``code``, ``error``, ``label_error`` and the
    digest of the final codebooks."""
    vectors = integer_vectors(rows, key, vector, label)
    by_id = vectors.orderBy(F.col("id").asc_nulls_last(), "v")
    lead = by_id.limit(1).collect()
    width = len(lead[0]["v"]) if lead else PARTS
    seeds = [r["v"] for r in by_id.where(F.size("v") == width).limit(ENTRIES).select("v").collect()]
    books = np.array(seeds, np.int64).reshape(len(seeds), PARTS, width // PARTS).swapaxes(0, 1)
    trees = written(build_trees(vectors, width))
    if seeds:
        for _ in range(rounds):
            books = lloyd_round(trees, books)
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    coded = written(with_salt(code_rows(trees, books)))
    totals = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    return salted_lookup(coded, totals, ["label"]).select(
        F.col("id").alias(key), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op12_cover_codes(embeddings: DataFrame) -> DataFrame:
    return vector_codes(embeddings)
