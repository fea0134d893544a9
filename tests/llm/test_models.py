"""Trained operators: held-out accuracy, properties, defined cases."""

import itertools
import os
import zlib

import numpy as np
import pytest

from barloom.llm import crf_langid, isolation, pu_quality
from barloom.llm.common import read_table

from .conftest import edge_rows

SF = "/root/testdata/sf0.01"


def held_out(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 0


def test_language_accuracy(spark):
    docs = read_table(spark, SF, "documents")
    got = {r.doc_id: r for r in crf_langid.op10_language_crf(docs).collect()}
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert all(got[i].held_out == held_out(i) for i in got)
    rest = [i for i in got if got[i].held_out]
    assert np.mean([got[i].lang_pred == truth[i] for i in rest]) >= 0.97
    assert all(0 <= r.score <= 1 for r in got.values())
    assert crf_langid.keep_identified(docs).schema == docs.schema


def test_language_of_code_switched_words(spark):
    docs = read_table(spark, SF, "documents")
    model = crf_langid.fit(docs)
    lines = {}
    for lang, line in sorted(crf_langid.training_lines(docs)):
        words = crf_langid.words_of(line)
        if len(words) >= 12:
            lines.setdefault(lang, words[:12])
    right = total = 0
    for a, b in itertools.permutations(sorted(lines), 2):
        text = " ".join(lines[a] + lines[b])
        labels = [lang for _, lang, _ in crf_langid.label_words(text, model)]
        right += sum(x == y for x, y in zip(labels, [a] * 12 + [b] * 12))
        total += 24
    assert right / total >= 0.9
    assert (np.diag(model.moves) > model.moves.mean(axis=1)).all()  # staying in a language is likelier


def test_forward_backward_is_exact():
    rng = np.random.default_rng(5)
    emit, moves = rng.random((5, 3)).astype(np.float32) + 0.1, rng.random((3, 3)) + 0.1
    lengths = np.array([2, 3])
    post, pairs = crf_langid.forward_backward(emit, lengths, moves, pairs=True)
    at, total = 0, np.zeros((3, 3))
    for n in lengths:
        mass, want, z = 0, np.zeros((n, 3)), np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            w = np.prod([emit[at + t, s] for t, s in enumerate(path)]) * np.prod([moves[a, b] for a, b in zip(path, path[1:])])
            mass += w
            for t, s in enumerate(path):
                want[t, s] += w
            for a, b in zip(path, path[1:]):
                z[a, b] += w
        np.testing.assert_allclose(post[at:at + n], want / mass, rtol=1e-4)
        total += z / mass
        at += n
    np.testing.assert_allclose(pairs, total, rtol=1e-4)


def test_language_edges(spark, edge, empty):
    got = crf_langid.op10_language_crf(edge).collect()
    assert len(got) == len(edge_rows())
    none = {2, 3, 9, 11}
    assert {r.doc_id for r in got if r.lang_pred == "und"} == none
    assert all(r.score == 0 for r in got if r.lang_pred == "und")
    kept = crf_langid.keep_identified(edge)
    assert kept.columns == edge.columns and not none & {r.doc_id for r in kept.collect()}
    assert crf_langid.op10_language_crf(empty).count() == 0
    from pyspark.sql import functions as F
    blind = edge.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in crf_langid.op10_language_crf(blind).collect()} == {"und"}


@pytest.fixture(scope="module")
def quality(spark):
    return pu_quality.op9_pu_quality(read_table(spark, SF, "documents"), read_table(spark, SF, "labels")).collect()


def test_quality_held_out(spark, quality):
    truth = {r.doc_id: r.quality for r in read_table(spark, SF, "labels").collect()}
    rest = [r for r in quality if r.held_out and r.doc_id in truth]
    assert all(r.held_out == held_out(r.doc_id) for r in quality)
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in quality)
    assert np.mean([r.predicted == truth[r.doc_id] for r in rest]) >= 0.9


def test_quality_ignores_held_out_labels(spark, quality):
    from pyspark.sql import functions as F
    labels = read_table(spark, SF, "labels").withColumn(
        "quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality"))
        .otherwise(F.col("quality")))
    again = pu_quality.op9_pu_quality(read_table(spark, SF, "documents"), labels).collect()
    assert {r.doc_id: r.score for r in again} == {r.doc_id: r.score for r in quality}


def test_quality_edges(edge, labels, empty):
    got = pu_quality.op9_pu_quality(edge, labels).collect()
    assert len(got) == len(edge_rows())
    assert len({r.score for r in got if r.doc_id in (2, 3)}) == 1
    assert {r.score for r in pu_quality.op9_pu_quality(edge, labels.limit(0)).collect()} == {0.5}
    assert pu_quality.op9_pu_quality(empty, labels).count() == 0


def test_prior_estimate():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(1.5, 1, (4000, 6)), rng.normal(-1.5, 1, (4000, 6))
    mixed = np.concatenate((good[2000:3400], bad[:600]))
    prior = pu_quality.estimate_prior(good[:2000].astype(np.float32), rng.permutation(mixed).astype(np.float32))
    assert abs(prior - 0.7) < 0.08


def test_isolation_on_labelled_rows(spark):
    rows = isolation.op8_isolation_forest(read_table(spark, SF, "documents"), read_table(spark, SF, "labels"))
    kept = {r.doc_id: r.kept for r in rows.where("NOT base_failed").collect()}
    truth = {r.doc_id: r.quality for r in read_table(spark, SF, "labels").collect()}
    good = [kept[i] for i in kept if truth.get(i) == 1]
    bad = [kept[i] for i in kept if truth.get(i) == 0]
    assert np.mean(good) >= 0.98 and np.mean(bad) <= 0.2


def test_forest_isolates_far_points():
    rng = np.random.default_rng(2)
    x = np.concatenate((rng.normal(0, 1, (500, 3)), [[9, 9, 9]]))
    s = isolation.Forest(x).score(x)
    assert s.argmax() == 500 and s[500] > 0.6
    assert np.isfinite(isolation.Forest(np.zeros((0, 3))).score(x)).all()


def test_package_is_shipped_by_value():
    from pyspark import cloudpickle
    assert b"barloom.llm" not in cloudpickle.dumps(lambda: pu_quality.sigmoid(np.zeros(1)))[:60]
    assert "barloom.llm" in cloudpickle.list_registry_pickle_by_value()
    assert os.path.isdir(SF)
