"""Texts without newlines: their language is learnt from pieces of the line."""

import re

import numpy as np

from barloom.llm import crf_langid

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {"aa": ["tharin", "olemp", "dwisk", "hatho", "wrenth"], "bb": ["zuliga", "peqora", "mivato", "sanoli", "korepa"]}


def corpus(spark, long_langs):
    rng, rows = np.random.default_rng(4), []
    for lang, words in sorted(WORDS.items()):
        for _ in range(20):
            text = " ".join(rng.choice(words, 600))
            assert len(text) > crf_langid.LINE_CHARS
            if lang not in long_langs:
                text = "\n".join(re.findall(".{1,60}(?: |$)", text))
            rows.append((len(rows), text, lang, "s", len(text)))
    return spark.createDataFrame(rows, SCHEMA)


def test_language_of_single_long_lines_is_learnt(spark):
    docs = corpus(spark, {"bb"})
    truth = {r.doc_id: r.lang for r in docs.collect()}
    assert {r.doc_id: r.lang_pred for r in crf_langid.op10_language_crf(docs).collect()} == truth


def test_corpus_of_single_long_lines_is_kept(spark):
    docs = corpus(spark, set(WORDS))
    assert crf_langid.keep_identified(docs).count() == docs.count()


def test_pieces_end_between_words(spark):
    text = "é" + " ".join("ñandú,wort" for _ in range(900)) + " " + "x" * 4500
    docs = spark.createDataFrame([(i, text + "\nshort line", "es", "s", 1) for i in (1, 2, 3)], SCHEMA)
    got = {line for _, line in crf_langid.training_lines(docs)}
    assert max(map(len, got)) <= crf_langid.LINE_CHARS and "short line" in got
    words = {w for line in got for w in crf_langid.words_of(line)}
    runs = {w for w in words if set(w) == {"x"}}  # longer than a piece, so cut inside
    assert sum(map(len, runs)) == 4500 and words - runs == {"éñandú", "ñandú", "wort", "short", "line"}
