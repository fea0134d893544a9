"""Quality classifier learnt from trusted positives and unlabelled text.

Only rows labelled good are trusted; all other text is unlabelled.  A linear
scorer over character-class pairs and a few shape figures is fitted by the
non-negative unbiased risk: with class prior ``pi``, the loss on positives
weighs ``pi`` and the loss of the negatives is what the unlabelled rows show
beyond ``pi`` times the positives, kept at zero or above.  The prior is
estimated from the data: a first scorer separates positives from unlabelled
rows, and ``pi`` is the least ratio, over its thresholds, of the unlabelled
share to the positive share (corrected for sampling error).

Fitting reads at most ``2 * POSITIVES`` positives and ``2 * UNLABELLED``
unlabelled rows, hash-chosen from the rows that labels may be learnt from;
scoring reads whole texts of all rows.  Language, source, ids and labels are
no inputs of a score.

Defined cases: a null text scores like an empty one; without positives every
row scores 0.5; repeated rows are scored each on their own; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_sample, map_batches, slices, training_row

THRESHOLD = 0.3  # fixed value of the contract
POSITIVES, UNLABELLED = 2000, 4000
STEPS, RATE, DECAY = 400, 0.03, 1e-2
CLASSES = 32
SHAPES = 5
LEAST_SHARE = 0.7  # of the positives above a threshold that may tell the prior


def _classes() -> np.ndarray:
    """A class for each byte: letters by case and vowel, digits, white space,
    single marks, and bytes beyond ASCII."""
    out = np.full(256, 0, np.uint16)
    groups = [b" ", b"\n", b"\t\r\x0b\x0c", b"0123456789", b"AEIOUY", b"BCDFGHJKLMNPQRSTVWXZ", b"aeiouy",
              b"bcdfghjklmnpqrstvwxz", b".", b",", b"'\"`", b"#", b"*", b"$", b"%", b"&", b"|", b"<>", b"!", b"?",
              b":;", b"-_", b"()[]{}", b"/\\", b"@", b"=+~^"]
    for i, group in enumerate(groups, 1):
        out[list(group)] = i
    out[128:192], out[192:] = len(groups) + 1, len(groups) + 2
    return out


CLASS_OF = _classes()


def features(texts: list[bytes | None]) -> np.ndarray:
    """Square roots of the shares of character-class pairs, then figures of
    length and repetition."""
    out = np.zeros((len(texts), CLASSES * CLASSES + SHAPES), np.float32)
    for row, text in zip(out, texts):
        c = CLASS_OF[np.frombuffer(text or b"", np.uint8)]
        if len(c) > 1:
            pairs = np.bincount(c[:-1] * CLASSES + c[1:], minlength=CLASSES * CLASSES)
            row[:-SHAPES] = np.sqrt(pairs / (len(c) - 1))
        words = (text or b"").split()
        n = len(words)
        same = sum(map(bytes.__eq__, words, words[1:]))
        row[-SHAPES:] = (min(1.0, np.log1p(n) / 10), n < 10, same / (n + 10), len(set(words)) / (n ** 0.8 + 1) / 2,
                         min(2.0, sum(map(len, words)) / (n + 1) / 10))
    return out


def _vectors(df: DataFrame, *keys: str) -> DataFrame:
    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)

    def work(batches):
        for *cols, texts in slices(batches):
            yield dict(zip(keys, cols)) | {"x": [v.tobytes() for v in features(texts)]}

    return map_batches(df.select(*keys, F.col("text").cast("binary")), work, f"{kinds}, x binary")


class Scorer:
    def __init__(self, weights: np.ndarray, bias: float, mean: np.ndarray, scale: np.ndarray):
        self.weights, self.bias, self.mean, self.scale = weights, bias, mean, scale

    def margin(self, x: np.ndarray) -> np.ndarray:
        # summed row by row, so that a score does not depend on the rows beside it
        return ((x - self.mean) / self.scale * self.weights).astype(np.float64).sum(axis=1) + self.bias


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _fit(p: np.ndarray, u: np.ndarray, slope) -> Scorer:
    """Adam on a linear scorer.  ``slope`` gives the risk's derivatives by the
    margins of positives and unlabelled rows."""
    both = np.concatenate((p, u))
    mean, scale = both.mean(axis=0), both.std(axis=0) + 0.02
    p, u = (p - mean) / scale, (u - mean) / scale
    w = np.zeros(p.shape[1] + 1, np.float32)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        dp, du = (d.astype(np.float32) for d in slope(p @ w[:-1] + w[-1], u @ w[:-1] + w[-1]))
        g = np.concatenate((p.T @ dp + u.T @ du + DECAY * w[:-1], [dp.sum() + du.sum()]))
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return Scorer(w[:-1], float(w[-1]), mean, scale)


def estimate_prior(p: np.ndarray, u: np.ndarray) -> float:
    """The share of positives among unlabelled rows.  Half of the rows fit the
    first scorer and the other half are counted, so fitting does not flatter."""
    def apart(zp, zu):
        return (sigmoid(zp) - 1) / len(zp), sigmoid(zu) / len(zu)

    first = _fit(p[::2], u[::2], apart)
    sp, su = np.sort(first.margin(p[1::2])), np.sort(first.margin(u[1::2]))
    cuts = sp[: max(1, int(len(sp) * (1 - LEAST_SHARE)))]
    above_p = 1 - np.searchsorted(sp, cuts, side="left") / len(sp)
    above_u = 1 - np.searchsorted(su, cuts, side="left") / len(su)
    ratio = above_u / np.maximum(above_p, 1e-9)
    return float(np.clip(ratio.min(), 0.01, 0.99))


def non_negative_fit(p: np.ndarray, u: np.ndarray, prior: float) -> Scorer:
    """Minimise the non-negative unbiased risk with the logistic loss."""
    def slope(zp, zu):
        loss_p_as_n = np.logaddexp(0, zp).mean()
        loss_u_as_n = np.logaddexp(0, zu).mean()
        dp, du = prior * (sigmoid(zp) - 1) / len(zp), np.zeros(len(zu))
        part = loss_u_as_n - prior * loss_p_as_n
        if part >= 0:
            return dp - prior * sigmoid(zp) / len(zp), sigmoid(zu) / len(zu)
        return prior * sigmoid(zp) / len(zp), -sigmoid(zu) / len(zu)  # undo the overfitted part

    return _fit(p, u, slope)


def calibrate(model: Scorer, p: np.ndarray, u: np.ndarray) -> None:
    """Shift the margins so that ``THRESHOLD`` lies at the cut that positives
    and unlabelled rows call best: the most of ``recall ** 2 / share``, with
    the recall of the positives and the share of the unlabelled rows above.
    Without labelled negatives this stands in for the F score."""
    zp, zu = np.sort(model.margin(p)), np.sort(model.margin(u))
    recall = 1 - np.arange(len(zp)) / len(zp)
    share = 1 - np.searchsorted(zu, zp, side="left") / len(zu)
    best = int(np.argmax(recall ** 2 / np.maximum(share, 1 / len(zu))))
    model.bias += float(np.log(THRESHOLD / (1 - THRESHOLD)) - zp[best])


def fit(docs: DataFrame, labels: DataFrame) -> Scorer | None:
    """Fit on bounded, repeatable samples of the rows that labels may be
    learnt from."""
    rows = docs.select("doc_id", "text").where(training_row())
    good = labels.where("quality = 1").select("doc_id").where(training_row()).distinct()
    trusted = hash_sample(rows.join(good, "doc_id", "left_semi").select("doc_id"), POSITIVES)
    p = rows.join(trusted.distinct(), "doc_id", "left_semi").limit(2 * POSITIVES)
    u = hash_sample(rows, UNLABELLED)
    size = CLASSES * CLASSES + SHAPES

    def matrix(df):
        found = sorted((r.doc_id is not None, r.doc_id or 0, bytes(r.x)) for r in _vectors(df, "doc_id").collect())
        return np.frombuffer(b"".join(x for *_, x in found), np.float32).reshape(-1, size)

    p, u = matrix(p), matrix(u)
    if len(p) < 2 or len(u) < 2:
        return None
    # rows in the order of a fixed shuffle, so that halves are alike
    rng = np.random.default_rng(3)
    p, u = p[rng.permutation(len(p))], u[rng.permutation(len(u))]
    model = non_negative_fit(p, u, estimate_prior(p, u))
    calibrate(model, p, u)
    return model


def score(docs: DataFrame, model: Scorer | None) -> DataFrame:
    """(doc_id, score) for every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches):
        for keys, texts in slices(batches):
            value = np.full(len(keys), 0.5) if model is None else sigmoid(model.margin(features(texts)))
            yield {"doc_id": keys, "score": value}

    return map_batches(docs.select("doc_id", F.col("text").cast("binary").alias("text")), work,
                       f"doc_id {kind}, score double")


def op9_pu_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    out = score(docs, fit(docs, labels))
    return out.select("doc_id", (~training_row()).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
