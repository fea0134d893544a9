"""Filter audit, vector codes and token counts against plain Python versions
on rows with nulls, empty and long texts, ties, repeated rows and clashing
columns."""

import hashlib
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barloom.llm import cover_codes, filter_audit, token_counts
from barloom.llm.common import tokenizer_path

from .conftest import SCHEMA, edge_rows


# ------------------------------------------------------------------- op11
def brute_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    docs = []
    for i, text, _, source, _ in rows:
        text = text or ""
        words = re.findall("[^\x20\x09-\x0d]+", text)
        bad = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
               "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), "D": bool(re.search("[#$%&*|]", text)),
               "E": i is not None and any(j is not None and j < i and (t or "") == text for j, t, *_ in rows)}
        docs.append((source or "", {f for f in bad if bad[f]}, i in good, i in toxic))
    out = Counter()
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        lines, share = [], Counter()
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                before = set(order[:step - 1])
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                share[f] += len(gone)
                lines.append((part, "".join(order), step, len(left), len(gone),
                              sum(f in d[1] and bool(d[1] & before) for d in mine), sum(d[1] == {f} for d in mine),
                              sum(d[2] for d in gone), sum(d[3] for d in gone)))
        out.update((*x, share[x[1][x[2] - 1]]) for x in lines)
    return out


REPORT = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


@pytest.mark.parametrize("broadcast, piece", [(filter_audit.BROADCAST_HASHES, filter_audit.PIECE_ROWS), (0, 2)])
def test_audit(edge, labels, monkeypatch, broadcast, piece):
    monkeypatch.setattr(filter_audit, "BROADCAST_HASHES", broadcast)
    monkeypatch.setattr(filter_audit, "PIECE_ROWS", piece)
    got = Counter(tuple(r[c] for c in REPORT) for r in filter_audit.op11_filter_audit(edge, labels).collect())
    want = brute_audit(edge_rows(), [(r[0], r[1], r[2]) for r in labels.collect()])
    assert got == want


def test_audit_of_a_hot_text(spark, labels):
    """A third of the rows share one text; only the smallest id is no copy."""
    rows = [(i, "the one text" if i % 3 == 0 else f"text number {i}", "en", "a", 1) for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = filter_audit.combinations(df, labels).where(F.col("mask").bitwiseAND(16) != 0).agg(F.sum("n")).first()[0]
    assert got == 999


def test_audit_empty(empty, labels):
    assert filter_audit.op11_filter_audit(empty, labels).count() == 0


# ------------------------------------------------------------------- op12
def brute_codes(rows, rounds=2):
    kept = [(i, [int(np.floor(256 * float(x))) for x in v], lab) for i, v, lab in rows
            if v and all(x is not None and np.isfinite(x) for x in v) and len(v) % 16 == 0]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    if not kept:
        return Counter()
    w = len(kept[0][1]) // 16
    books = [[r[1][p * w:(p + 1) * w] for r in kept[:64]] for p in range(16)]

    def distance(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    def assign(v, p):
        part = v[p * w:(p + 1) * w]
        return min((distance(part, c), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(16):
            groups = {}
            for _, v, _ in kept:
                groups.setdefault(assign(v, p)[1], []).append(v[p * w:(p + 1) * w])
            new.append([[sum(x) // len(groups[e]) for x in zip(*groups[e])] if e in groups else c
                        for e, c in enumerate(books[p])])
        books = new
    found = [(i, lab, [assign(v, p) for p in range(16)]) for i, v, lab in kept]
    by_label = Counter()
    for _, lab, a in found:
        by_label[lab] += sum(d for d, _ in a)
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return Counter((i, "".join(f"{e:02x}" for _, e in a), sum(d for d, _ in a), by_label[lab], digest)
                   for i, lab, a in found)


VECTORS = "vec_id long, embedding array<float>, label int, code string, n long"


def vector_rows(n=150, seed=3):
    rng = np.random.default_rng(seed)
    grid = rng.integers(-2, 3, (n, 32)) / 8  # many ties and equal parts
    rows = [(int(i), [float(x) for x in v], int(i) % 4 or None, "x", 1) for i, v in enumerate(grid)]
    rows += rows[:5] + [(3, rows[9][1], 1, "x", 1), (None, rows[2][1], None, None, None)]
    bad = [[], None, [1.0] * 31, [1.0] * 16, [float("nan")] * 32, [float("inf")] + [0.0] * 31, [None] + [0.0] * 31]
    return rows + [(1000 + i, v, 1, "x", 1) for i, v in enumerate(bad)]


@pytest.mark.parametrize("chunk, leaf", [(cover_codes.CHUNK_ROWS, cover_codes.LEAF_POINTS), (40, 2)])
def test_codes(spark, monkeypatch, chunk, leaf):
    monkeypatch.setattr(cover_codes, "CHUNK_ROWS", chunk)
    monkeypatch.setattr(cover_codes.CoverTree.__init__, "__defaults__", (leaf,))
    rows = vector_rows()
    got = cover_codes.op12_cover_codes(spark.createDataFrame(rows, VECTORS))
    names = ("vec_id", "code", "error", "label_error", "codebooks_sha256")
    assert Counter(tuple(r[c] for c in names) for r in got.collect()) == brute_codes([r[:3] for r in rows])


def test_few_and_no_vectors(spark):
    rows = vector_rows(20)[:20]
    got = cover_codes.op12_cover_codes(spark.createDataFrame(rows, VECTORS)).collect()
    assert Counter(tuple(r) for r in got) == brute_codes([r[:3] for r in rows])
    assert cover_codes.op12_cover_codes(spark.createDataFrame([], VECTORS)).count() == 0
    assert cover_codes.op12_cover_codes(spark.createDataFrame(vector_rows()[-7:-5], VECTORS)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 400), st.integers(1, 5), st.sampled_from([1, 3, 40, 3000, 1 << 26]),
       st.sampled_from([1, 4, 24]))
def test_cover_tree(seed, n, w, size, leaf):
    """The invariants of the tree, and subtree assignment against plain search."""
    rng = np.random.default_rng(seed)
    points = rng.integers(-size, size + 1, (n, w))
    book = rng.integers(-size, size + 1, (rng.integers(1, 65), w))
    tree = cover_codes.CoverTree(points, leaf)
    assert sorted(tree.order.tolist()) == list(range(n))
    for k, kids in enumerate(tree.n_children):
        run = points[tree.order[tree.lo[k]:tree.hi[k]]]
        assert np.sqrt(((run - tree.centre[k]) ** 2).sum(axis=1)).max() <= tree.radius[k] * (1 + 1e-12)
        if kids:
            c = np.arange(tree.first[k], tree.first[k] + kids)
            assert (tree.centre[c[0]] == tree.centre[k]).all()
            assert tree.lo[c[0]] == tree.lo[k] and tree.hi[c[-1]] == tree.hi[k]
            assert (tree.lo[c[1:]] == tree.hi[c[:-1]]).all()
            apart = np.sqrt(((tree.centre[c][:, None] - tree.centre[c]) ** 2).sum(axis=2)) + np.eye(kids) * 1e300
            assert apart.min() > tree.radius[c].max()
    codes = np.zeros(n, np.int64)
    counts, sums = tree.assign(points, book, codes)
    d = ((points.astype(object)[:, None] - book.astype(object)) ** 2).sum(axis=2)
    want = np.array([min(range(len(book)), key=lambda e: (row[e], e)) for row in d])
    assert (codes == want).all()
    assert (counts == np.bincount(want, minlength=len(book))).all()
    for e in range(len(book)):
        assert (sums[e] == points[want == e].sum(axis=0)).all()


def test_subtrees_are_assigned_whole():
    """Clustered points: most are added by subtree, few are compared."""
    rng = np.random.default_rng(1)
    homes = rng.integers(-5000, 5000, (20, 4))
    points = homes[rng.integers(0, 20, 4000)] + rng.integers(-20, 21, (4000, 4))
    tree = cover_codes.CoverTree(points)
    compared = []
    plain = cover_codes.nearest
    try:
        cover_codes.nearest = lambda p, b: compared.append(len(p)) or plain(p, b)
        tree.assign(points, homes)
    finally:
        cover_codes.nearest = plain
    assert sum(compared) < 400


# ------------------------------------------------------------------- op13
def brute_counts(rows):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(tokenizer_path(token_counts.MODEL))
    out = Counter()
    for i, text, *_ in rows:
        n = len(lib.encode(text or "", add_special_tokens=False))
        out[i, len((text or "").encode()), n, n > 2048] += 1
    return out


TRICKY = ["<|endoftext|> a", "<|ENDOFTEXT|> a", "a<|startoftext|>", "a<|startoftext|> b", "A  b\n", "a b", " a b ", "é é",
          "é é", "İSTANBUL ΑΣ", "t0:", "<|endoftext|", "x" * 5000]


def test_counts(edge, spark):
    rows = edge_rows() + [(100 + i, t, None, None, None) for i, t in enumerate(TRICKY * 2)]
    names = ("doc_id", "n_bytes", "n_tokens", "over_limit")
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"content": F.lit(1), "n_tokens": F.lit(2), "_salt": F.lit(0)})
    got = Counter(tuple(r[c] for c in names) for r in token_counts.op13_token_counts(df).collect())
    assert got == brute_counts(rows)


@pytest.mark.parametrize("bound", [token_counts.BROADCAST_MISSES, 0])
def test_cache_holds_each_content_once(spark, tmp_path, monkeypatch, bound):
    monkeypatch.setattr(token_counts, "BROADCAST_MISSES", bound)
    cache = f"{tmp_path}/counts"
    first = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(["One  text", "one text", "two", None])], SCHEMA)
    more = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(["ONE TEXT", "three", "two", "two"])], SCHEMA)
    token_counts.token_counts(first, cache).collect()
    assert spark.read.parquet(cache).count() == 3  # spaces and case do not reach the tokenizer
    got = Counter(tuple(r) for r in token_counts.token_counts(more, cache).collect())
    assert got == brute_counts(more.collect())
    assert spark.read.parquet(cache).count() == 4
    token_counts.token_counts(more, cache).collect()
    assert spark.read.parquet(cache).count() == 4


def test_cache_of_another_tokenizer_is_not_used(spark, tmp_path):
    cache = f"{tmp_path}/counts"
    df = spark.createDataFrame([(1, "words and words", None, None, None)], SCHEMA)
    a = token_counts.token_counts(df, cache).first()["n_tokens"]
    spark.read.parquet(cache).selectExpr("content", "cast('old' as binary) as tokenizer", "n_tokens + 7 as n_tokens") \
        .write.mode("append").parquet(cache)
    assert token_counts.token_counts(df, cache).first()["n_tokens"] == a


def test_counts_empty(empty):
    assert token_counts.op13_token_counts(empty).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(
    st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "'s", "'LL", "don't", "''s", "\x1c", "\x85", "\xa0",
                     "\u2028", "İ", "ß", "Σ", "e\u0301", "½²", "ǅ", "’s", "…", "日本", "🙂", "\x00", "  \n"]),
    st.text(st.characters(max_codepoint=0x24f), max_size=8), st.text(max_size=5)), max_size=10))
def test_words_count_as_the_library_counts(pieces):
    text = "".join(pieces)
    counter = _counter()
    assert counter.count([text]) == [len(counter.lib.encode(text, add_special_tokens=False))]
    for other in (text.lower(), text.upper(), " " + text + "\n", text.replace(" ", "\t ")):
        if counter.digest(other) == counter.digest(text):
            assert counter.count([other]) == counter.count([text])


def _counter(made=[]):
    if not made:
        made.append(token_counts.Counter(tokenizer_path(token_counts.MODEL), entries=50))
    return made[0]
