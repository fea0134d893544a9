"""Language identification with a linear-chain conditional random field.

Every word of a text gets a posterior over the languages by forward-backward:
emissions come from prefixes, suffixes, character trigrams (hashed) and from
per-language lexicons, transitions between neighbouring words are learnt.  A
line of the text is one chain, so code-switched text is labelled word by
word; the document's language is the one with the most posterior mass, each
word weighted by its letters.

Training reads a bounded sample of labelled rows (``LINES`` lines for each
language, from ``DOCS`` hash-chosen documents of each).  A line of more than
``LINE_CHARS`` characters is cut between words into pieces of at most as many,
so a language whose texts have no newlines is learnt like any other.  Lines of different documents are joined into
code-switched chains so that the transitions can be learnt.  The model has a
fixed size.  Scoring reads whole texts.

Defined cases: a text that is null or has no letter is ``und`` with score 0;
ties go to the language that sorts first; with no labelled row every text is
``und``; repeated rows are returned as often as they come; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, slices, training_row

DOCS, LINES, LINE_CHARS = 500, 2500, 2000
BUCKETS = 1 << 15
LEXICON_WORDS = 400
CHAIN, BATCH, STEPS, RATE = 40, 192, 160, 0.08
TABLE_ENTRIES = 300_000
SLICE = 2_000_000
LEAST_SHARE = 0.35  # four even languages would share a quarter each
UNKNOWN = "und"  # fixed value of the contract
#: Pieces of a line: as long as they may be, ending where no letter follows;
#: only a longer run of letters is cut inside.
PIECE = rf"(?s).{{1,{LINE_CHARS}}}(?!\p{{L}})|.{{1,{LINE_CHARS}}}"

find_words = re.compile(r"[^\W\d_]+").findall


def words_of(line: str) -> list[str]:
    return [w for w in find_words(line.lower()) if w.isalpha() or any(map(str.isalpha, w))]


def word_features(word: str, lexicon: dict[str, list[int]]) -> np.ndarray:
    """Hashed affixes and trigrams, then the word's lexicon features."""
    w = f"^{word}$".encode()
    seen = {zlib.crc32(b"p" + w[:i]) for i in (2, 3, 4)} | {zlib.crc32(b"s" + w[-i:]) for i in (2, 3, 4)}
    seen.update(zlib.crc32(w[i:i + 3]) for i in range(max(1, len(w) - 2)))
    return np.array([h % BUCKETS for h in seen] + [BUCKETS + i for i in lexicon.get(word, ())], np.int32)


class Chain:
    """A trained model: emission weights, transitions, lexicon."""

    def __init__(self, langs: list[str], weights: np.ndarray, moves: np.ndarray, lexicon: dict):
        self.langs, self.weights, self.moves, self.lexicon = langs, weights, moves, lexicon
        self.table: dict[str, int] = {}
        self.rows = np.zeros((0, len(langs)), np.float32)

    def emissions(self, words: list[str]) -> np.ndarray:
        """exp of the emission scores, one row a word; each distinct word of
        the task is scored once."""
        new = list(set(words).difference(self.table))
        if new:
            if len(self.table) + len(new) > TABLE_ENTRIES:
                self.table, self.rows, new = {}, self.rows[:0], list(set(words))
            feats = [word_features(w, self.lexicon) for w in new]
            sizes = np.array([len(f) for f in feats])
            at = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            score = np.add.reduceat(self.weights[np.concatenate(feats)], at) / np.sqrt(sizes)[:, None]
            score = np.exp(score - score.max(axis=1, keepdims=True)) + 1e-12
            self.table.update(zip(new, range(len(self.rows), len(self.rows) + len(new))))
            self.rows = np.concatenate((self.rows, score.astype(np.float32)))
        get = self.table.__getitem__
        return self.rows[np.fromiter(map(get, words), np.int64, len(words))]

    def posteriors(self, emit: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Per word, the posterior of every language; ``lengths`` are the
        words of the chains, which lie one after another in ``emit``."""
        return forward_backward(emit, lengths, np.exp(self.moves))[0]


def forward_backward(emit: np.ndarray, lengths: np.ndarray, moves: np.ndarray,
                     pairs: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors of all words and, if asked, the summed expected moves.  All
    chains take each step together; the longest come first, so the chains
    still running are a prefix."""
    n, k = emit.shape
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    longest = int(lengths[0]) if len(lengths) else 0
    running = np.searchsorted(-lengths, -np.arange(1, longest + 1), side="right")
    fore, expected = np.empty((n, k), np.float32), np.zeros((k, k))
    for t in range(longest):
        at = starts[:running[t]] + t
        a = emit[at] if t == 0 else (last[:running[t]] @ moves) * emit[at]
        last = a / a.sum(axis=1, keepdims=True)
        fore[at] = last
    back = np.ones((len(lengths), k), np.float32)
    post = np.empty((n, k), np.float32)
    for t in range(longest - 1, -1, -1):
        m = running[t]
        at = starts[:m] + t
        g = fore[at] * back[:m]
        post[at] = g / g.sum(axis=1, keepdims=True)
        ahead = back[:m] * emit[at]
        ahead /= ahead.sum(axis=1, keepdims=True)
        if pairs and t:
            x = fore[at - 1][:, :, None] * moves * ahead[:, None, :]
            expected += (x / x.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        back[:m] = ahead @ moves.T
    return post, expected


def train(lines: list[tuple[str, str]], seed: int = 7) -> Chain | None:
    """Fit on (language, line) pairs by maximum likelihood."""
    rows = [(lang, words_of(line)) for lang, line in sorted(lines)]
    rows = [(lang, w) for lang, w in rows if w]
    langs = sorted({lang for lang, _ in rows})
    if not langs:
        return None
    k = len(langs)
    counts = {lang: Counter() for lang in langs}
    for lang, words in rows:
        counts[lang].update(words)
    lexicon: dict[str, list[int]] = {}
    for i, lang in enumerate(langs):
        for w, _ in sorted(counts[lang].items(), key=lambda x: (-x[1], x[0]))[:LEXICON_WORDS]:
            lexicon.setdefault(w, []).append(i)
    vocabulary = sorted({w for _, words in rows for w in words})
    number = {w: i for i, w in enumerate(vocabulary)}
    feats = [word_features(w, lexicon) for w in vocabulary]
    sizes = np.array([len(f) for f in feats])
    at, flat = np.concatenate(([0], np.cumsum(sizes)[:-1])), np.concatenate(feats)
    scale = 1 / np.sqrt(sizes)
    rng = np.random.default_rng(seed)
    by_lang = {lang: [np.array([number[w] for w in words]) for l, words in rows if l == lang] for lang in langs}
    weights, moves = np.zeros((BUCKETS + k, k)), np.zeros((k, k))
    mean = [np.zeros_like(weights), np.zeros_like(moves)]
    square = [np.zeros_like(weights), np.zeros_like(moves)]
    for step in range(1, STEPS + 1):
        ids, gold, lengths = [], [], []
        for _ in range(BATCH):
            size = 0
            while size < CHAIN:  # a run of words of one language, then perhaps of another
                i = int(rng.integers(k))
                own = by_lang[langs[i]]
                line = own[int(rng.integers(len(own)))]
                run = int(rng.integers(3, CHAIN))
                cut = int(rng.integers(len(line)))
                part = line[cut:cut + run]
                ids.append(part)
                gold.append(np.full(len(part), i))
                size += len(part)
            lengths.append(size)
        ids, gold, lengths = np.concatenate(ids), np.concatenate(gold), np.array(lengths)
        used, where = np.unique(ids, return_inverse=True)
        spread = np.concatenate([np.arange(at[u], at[u] + sizes[u]) for u in used])
        starts = np.concatenate(([0], np.cumsum(sizes[used])[:-1]))
        score = np.add.reduceat(weights[flat[spread]], starts) * scale[used][:, None]
        emit = np.exp(score - score.max(axis=1, keepdims=True))[where] + 1e-12
        post, expected = forward_backward(emit.astype(np.float32), lengths, np.exp(moves), pairs=True)
        slope = -post
        slope[np.arange(len(gold)), gold] += 1
        by_word = np.zeros((len(used), k))
        np.add.at(by_word, where, slope)
        by_word *= scale[used][:, None] / len(gold)
        grad_w = np.zeros_like(weights)
        np.add.at(grad_w, flat[spread], np.repeat(by_word, sizes[used], axis=0))
        inside = np.ones(len(gold), bool)
        inside[np.cumsum(lengths) - 1] = False
        observed = np.zeros((k, k))
        np.add.at(observed, (gold[:-1][inside[:-1]], gold[1:][inside[:-1]]), 1)
        grad_m = (observed - expected) / len(gold)
        for x, g, m, v in ((weights, grad_w, mean[0], square[0]), (moves, grad_m, mean[1], square[1])):
            m *= 0.9
            m += 0.1 * g
            v *= 0.99
            v += 0.01 * g * g
            x += RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return Chain(langs, weights.astype(np.float32), moves.astype(np.float32), lexicon)


def training_lines(docs: DataFrame, doc_id: str = "doc_id") -> list[tuple[str, str]]:
    """The bounded sample: for each language, lines of hash-chosen documents
    of the training rows."""
    rows = docs.where(training_row(doc_id) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = rows.groupBy("lang").count().collect()  # a row for each language
    if not sizes:
        return []
    whole = 1 << 30
    share = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(whole, whole * DOCS // r["count"]))])
    draw = F.pmod(F.xxhash64(F.col(doc_id), F.lit("crf")), F.lit(whole))
    lines = (rows.where(draw < F.element_at(share, F.col("lang")))
             .select("lang", F.explode(F.split("text", "\n")).alias("whole"))
             .select("lang", F.explode(F.regexp_extract_all("whole", F.lit(PIECE), F.lit(0))).alias("line")))
    total = {r["lang"]: r["count"] for r in lines.groupBy("lang").count().collect()}
    if not total:
        return []
    keep = F.create_map(*[F.lit(x) for l, n in total.items() for x in (l, min(whole, whole * LINES // n))])
    pick = F.pmod(F.xxhash64(F.col("line"), F.lit("crf")), F.lit(whole)) < F.element_at(keep, F.col("lang"))
    return [(r.lang, r.line) for r in lines.where(pick).distinct().limit(2 * LINES * len(total)).collect()]


def judge(texts: list[str | None], model: Chain | None) -> tuple[list[str], list[float]]:
    """Language and score of each text."""
    pred, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
    words, lengths, owner = [], [], []
    for i, text in enumerate(texts):
        for line in (text or "").split("\n"):
            if own := words_of(line):
                words += own
                lengths.append(len(own))
                owner.append(i)
    if model is not None and words:
        post = model.posteriors(model.emissions(words), np.array(lengths))
        weight = np.fromiter(map(len, words), np.float64, len(words))
        at = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        mass = np.zeros((len(texts), post.shape[1]))
        np.add.at(mass, owner, np.add.reduceat(post * weight[:, None], at))
        total, best = mass.sum(axis=1), mass.argmax(axis=1)
        for i in np.flatnonzero(total):
            pred[i] = model.langs[best[i]]
            score[i] = float(min(1.0, mass[i, best[i]] / total[i]))
    return pred, score


def predict(docs: DataFrame, model: Chain | None, key: str = "doc_id") -> DataFrame:
    """(key, lang_pred, score) for every row."""
    kind = docs.schema[key].dataType.simpleString()

    def work(batches):
        for keys, texts in slices(batches, SLICE):
            pred, score = judge(texts, model)
            yield {key: keys, "lang_pred": pred, "score": score}

    return map_batches(docs.select(key, "text"), work, f"`{key}` {kind}, lang_pred string, score double")


def label_words(text: str, model: Chain) -> list[tuple[str, str, float]]:
    """(word, language, posterior) for every word of one text."""
    out = []
    for line in (text or "").split("\n"):
        if words := words_of(line):
            post = model.posteriors(model.emissions(words), np.array([len(words)]))
            out += [(w, model.langs[i], float(p[i])) for w, p, i in zip(words, post, post.argmax(axis=1))]
    return out


def fit(docs: DataFrame) -> Chain | None:
    return train(training_lines(docs))


def op10_language_crf(docs: DataFrame) -> DataFrame:
    out = predict(docs, fit(docs))
    return out.select("doc_id", (~training_row()).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float = LEAST_SHARE) -> DataFrame:
    """The rows of ``docs`` whose language is identified with at least the
    share ``least`` of the posterior mass.  Batches are filtered as they are,
    so there is no join, and rows with null or repeated ids are each judged on
    their own."""
    model, at = fit(docs), docs.columns.index("text")

    def run(batches):
        for batch in batches:
            mask = []
            for texts, in slices(iter([batch.select([at])]), SLICE):
                mask += [p != UNKNOWN and s >= least for p, s in zip(*judge(texts, model))]
            if batch.num_rows:
                yield batch.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
