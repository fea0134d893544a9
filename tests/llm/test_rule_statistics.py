"""The forest sees every rule statistic, also in small shares."""

import os
import zlib

import numpy as np
import pytest

from barloom.llm import isolation
from barloom.llm.common import read_table, shared_folder

SF = "/root/testdata/sf0.01"


def unusual(base):
    """Kinds of junk that the test tables do not have, made from ordinary prose."""
    words = base.split()
    marked = [w + "#" if i % 20 == 0 else w for i, w in enumerate(words)]
    lines = [" ".join(words[i:i + 8]) for i in range(0, len(words) - 8, 8)]
    return {"tokens": " ".join("".join(words[i:i + 40])[:200] for i in range(0, len(words) - 40, 8)),
            "symbols": " ".join(marked), "two in twelve": " ".join(words[:10] + ["and##", "of##"]),
            "lines": "\n".join(x for line in lines for x in (line, "Read more"))}


@pytest.fixture(scope="module")
def verdicts(spark):
    from pyspark.sql import functions as F
    docs, labels = (read_table(spark, SF, t).select(*c) for t, c in
                    (("documents", ["doc_id", "text"]), ("labels", ["doc_id", "quality"])))
    base = (docs.join(labels.where("quality = 1"), "doc_id").where(F.size(F.split("text", " ")).between(400, 900))
            .orderBy("doc_id").first().text)
    kinds = unusual(base)
    more = spark.createDataFrame([(10**9 + i, t) for i, t in enumerate(kinds.values())], docs.schema)
    rows = isolation.op8_isolation_forest(docs.unionByName(more), labels).where(f"doc_id >= {10**9}").collect()
    got = {r.doc_id - 10**9: r for r in rows}
    return {k: got[i] for i, k in enumerate(kinds)}


@pytest.mark.parametrize("kind", ["tokens", "symbols", "two in twelve", "lines"])
def test_unusual_text_goes(verdicts, kind):
    assert not verdicts[kind].base_failed and not verdicts[kind].kept


def test_shares_are_not_rounded():
    one, two = (isolation.statistics(" ".join(["word"] * 497 + ["odd#"] * n + ["end"] * (3 - n)))[1] for n in (1, 2))
    assert one != two and len(one) == len(isolation.STATS)


def test_cuts_bound_rejected_good_rows():
    scores = np.random.default_rng(1).random((5000, 11))
    assert (scores > isolation.cuts(scores)).any(axis=1).mean() <= isolation.FALSE_SHARE


def test_nothing_is_sampled(spark):
    """Forests and cut-offs come from all rows, also of more than were once read."""
    rng = np.random.default_rng(4)
    texts = [" ".join("ab#!c"[:k] * m for k, m in zip(rng.integers(1, 6, n), rng.integers(1, 4, n)))
             for n in rng.integers(8, 25, 26_000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    labels = docs.selectExpr("doc_id", "cast(doc_id % 10 > 0 AS int) AS quality")
    got = isolation.op8_isolation_forest(docs, labels).collect()
    assert len(got) == len(texts)
    fed = {r.doc_id for r in got if not r.base_failed}
    x = {i: isolation.statistics(texts[i])[1] for i in sorted(fed)}
    score = dict(zip(x, isolation.Forests(np.array(list(x.values()))).score(np.array(list(x.values())))))
    cut = isolation.cuts(np.array([s for i, s in score.items() if i % 10 and zlib.crc32(str(i).encode()) % 5]))
    assert {r.doc_id: r.kept for r in got} == {i: i in fed and bool((score[i] <= cut).all()) for i in range(len(texts))}
    assert all(r.anomaly == (score[r.doc_id] - cut).max() for r in got if r.doc_id in fed)


def test_cuts_of_stored_scores(spark):
    rng = np.random.default_rng(6)
    for n in (0, 1, 2, 9, 3000):
        scores = np.round(rng.random((n, 1 + len(isolation.STATS))), 2)  # many equal ones
        rows = spark.createDataFrame([(s.tolist(),) for s in scores], "scores array<double>")
        assert isolation.exact_cuts(rows).tolist() == isolation.cuts(scores).tolist()


def test_only_scored_rows_are_stored(spark):
    """One file for ``TASK_ROWS`` rows in the shared folder, and nothing kept on the executors."""
    def found():
        return {os.path.join(at, f) for at, _, files in os.walk(shared_folder(spark)) for f in files if f.startswith("part-")}

    docs = read_table(spark, SF, "documents").repartition(6)
    assert docs.count() <= isolation.TASK_ROWS
    stored, kept = found(), spark.sparkContext._jsc.sc().getPersistentRDDs().size()
    rows = isolation.op8_isolation_forest(docs, read_table(spark, SF, "labels"))
    assert len(found() - stored) == 1
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() <= kept
    assert rows.count() == docs.count()


def test_cuts_of_close_scores(spark):
    """Scores that differ in the last digits only, next to far ones."""
    x = np.concatenate([0.5 + np.arange(2500) * 2.0 ** -53, [0.1, 0.9]])
    scores = np.stack([np.roll(x, i) for i in range(1 + len(isolation.STATS))], axis=1)
    rows = spark.createDataFrame([(s.tolist(),) for s in scores], "scores array<double>")
    assert isolation.exact_cuts(rows).tolist() == isolation.cuts(scores).tolist()
