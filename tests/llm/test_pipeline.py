"""The whole pipeline against a brute-force version of its stages."""

import corpus_pipeline
from barloom.llm import crf_langid, line_chunks, pieces
from barloom.llm.common import read_table

from .test_exact import brute_chunks, brute_components, brute_decontaminate, brute_fingerprint, sha

SF = "/root/testdata/sf0.001"


def brute(spark, sf):
    """Ids and id digests that should be left; the language model is the only part shared."""
    import sentencepiece

    docs = [r.asDict() for r in read_table(spark, sf, "documents").collect()]
    model = crf_langid.fit(read_table(spark, sf, "documents"))
    pred, score = crf_langid.judge([d["text"] for d in docs], model)
    docs = [d for d, p, s in zip(docs, pred, score) if p != "und" and s >= crf_langid.LEAST_SHARE]
    chunks = brute_chunks([(d["doc_id"], d["text"]) for d in docs])
    docs = [dict(d, text="\n".join(chunks[d["doc_id"], d["text"]][0])) for d in docs
            if chunks[d["doc_id"], d["text"]][0] or not chunks[d["doc_id"], d["text"]][1]]
    root = brute_components([brute_fingerprint(d["text"]) for d in docs])
    first = {}
    for d in sorted(docs, key=lambda d: d["doc_id"]):
        first.setdefault(root[brute_fingerprint(d["text"])], d)
    docs = list(first.values())
    items = [(r.item_id, r.text) for r in read_table(spark, sf, "benchmark").collect()]
    hit = {r[0] for r in brute_decontaminate([(d["doc_id"], d["text"]) for d in docs], items) if r[-1]}
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.tokenizer_path(pieces.MODEL))
    return {d["doc_id"]: sha(" ".join(map(str, sp.encode(d["text"]) + [2]))) for d in docs if d["doc_id"] not in hit}


def test_pipeline(spark):
    got = {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == brute(spark, SF)


def test_stages_keep_columns(spark, edge, tmp_path):
    docs = edge
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == edge.columns, name
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert 0 < docs.count() < edge.count()
    assert len(corpus_pipeline.STAGES) == 5


def test_stages_on_empty_table(spark, empty, tmp_path):
    docs = empty
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name)) if name != "sentencepiece" else docs
        assert docs.count() == 0


def test_line_stage_updates_length(spark):
    text = "a first line here\nand a second\nthen a third\nand a fourth"
    docs = spark.createDataFrame([(1, text, "en", "s", len(text)), (2, text + "\nmore\nlines", "en", "s", 99)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    for r in line_chunks.remove_repeats(docs).collect():
        assert r.n_chars == len(r.text) or r.doc_id == 1
