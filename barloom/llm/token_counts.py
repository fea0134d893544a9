"""Token counts through a digest cache.

The cache is a Parquet table of (content digest, tokenizer digest, count).  A
text's content digest is taken over what the tokenizer's own normaliser makes
of it: texts that differ in nothing the tokenizer sees share one entry.
Special strings are found in the raw text first, as the library does, and
enter the digest as their ids, so that no normalised text can look like one.
The tokenizer digest covers its file and the library's version, so a new file
or library never meets old counts.

1. every row gets its digest (one pass, no text is moved);
2. the distinct digests without a stored count are the misses;
3. one text of each miss is encoded, where copies have been merged in the task
   that read them and again after the shuffle, and its count is appended;
4. the counts are joined back to the rows, the rows of a frequent digest dealt
   over salted groups.

A job that dies before its append has changed nothing; one that dies after it
finds its counts stored.  Two jobs that append the same digest at once store
equal counts twice, and readers take one of them.

Defined cases: a null text is the empty text, 0 bytes and 0 tokens; texts are
never cut; rows that repeat, in id or text, come back as often as they came;
a null id stays null; an empty table gives an empty result and appends
nothing; other columns are ignored.  Texts of any length are encoded whole by
one task.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import fits, joined_path, map_batches, salted_lookup, slices, tokenizer_path, with_salt, written

MODEL = "word_bpe_49k.json"
LIMIT = 2048
TABLE_ENTRIES, LONGEST_KEPT = 300_000, 100  # words kept by a task, characters of a kept word
BROADCAST_MISSES = 200_000  # 32 bytes each; above it misses are found after the shuffle
CACHE_SCHEMA = "content binary, tokenizer binary, n_tokens long"


# fixed values of the tokenizer files that are cut into words here
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
WORDS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"

# Characters whose classes, lower case and normal form are the same in all
# Unicode versions: Latin without the dotted capital I, which lower-cases to two
# characters, common punctuation and currency.  U+001C to U+001F are white space
# for Python only.
PLAIN = re.compile("[\x00-\x1b\x20-\u012f\u0131-\u024f\u2010-\u2027\u2030-\u205e\u20a0-\u20bf]*")
LETTER, DIGIT = "A-Za-zªµºÀ-ÖØ-öø-\u024f", "0-9²³¹¼-¾"
PLAIN_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[{DIGIT}]|[^\\s{LETTER}{DIGIT}]+")


class Counter:
    """The library's tokenizer in one task.  Words of plain texts are counted
    once while they are in a bounded table; a token never crosses a word.
    Other texts, and other tokenizers, go through the library whole."""

    def __init__(self, model_file: str, entries: int = TABLE_ENTRIES):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(model_file)
        self.lib.no_padding()
        self.lib.no_truncation()
        added = self.lib.get_added_tokens_decoder().values()
        alone = all(not (t.lstrip or t.rstrip or t.single_word or t.normalized) for t in added)
        self.normal = self.lib.normalizer if alone else None
        names = sorted((t.content for t in added), key=len, reverse=True)
        self.specials = re.compile(f"({'|'.join(map(re.escape, names))})") if names else None
        with open(model_file, encoding="utf-8") as f:
            parts = json.load(f)
        cut = (parts.get("pre_tokenizer") or {}).get("pretokenizers", [])
        model = parts["model"]
        self.by_word = (
            alone and parts["normalizer"] == NORMALIZER and len(cut) == 2 and cut[1]["type"] == "ByteLevel"
            and not cut[1]["add_prefix_space"] and not cut[1]["use_regex"]
            and cut[0] == {"type": "Split", "pattern": {"Regex": WORDS}, "behavior": "Removed", "invert": True}
            and model["type"] == "BPE" and not model["dropout"])
        self.entries = entries
        self.table: dict[str, int] = {}

    def parts(self, text: str) -> list[str]:
        """Text and special strings in turn."""
        return self.specials.split(text) if self.specials else [text]

    def digest(self, text: str) -> bytes:
        """Digest of the normalised content: parts between special strings,
        each with its kind and length before it."""
        if self.normal is None:  # no normaliser, or added tokens that reach over their neighbours
            return hashlib.sha256(b"r" + text.encode()).digest()
        out = hashlib.sha256()
        for i, part in enumerate(self.parts(text)):
            kind, raw = b"s", part
            if not i % 2:
                plain = self.by_word and PLAIN.fullmatch(part)
                kind = b"p" if plain else b"t"
                raw = " ".join(part.lower().split()) if plain else self.normal.normalize_str(part)
            raw = raw.encode()
            out.update(kind + b"%d:" % len(raw) + raw)
        return out.digest()

    def count(self, texts: list[str]) -> list[int]:
        plain = [self.by_word and PLAIN.fullmatch(t) is not None for t in texts]
        rest = iter([len(e) for e in self.lib.encode_batch(
            [t for t, p in zip(texts, plain) if not p], add_special_tokens=False)])
        return [self._by_words(t) if p else next(rest) for t, p in zip(texts, plain)]

    def _by_words(self, text: str) -> int:
        parts = self.parts(text)
        words = [w for part in parts[::2] for w in PLAIN_WORDS.findall(part.lower())]
        new = list(set(words).difference(self.table))
        if len(self.table) + len(new) > self.entries:
            self.table = {}
            new = list(set(words))
        if new:
            self.table.update(zip(new, map(len, self.lib.encode_batch(new, add_special_tokens=False))))
        n = sum(map(self.table.__getitem__, words)) + len(parts) // 2
        for w in new:
            if len(w) > LONGEST_KEPT:
                del self.table[w]
        return n


def tokenizer_digest(model_file: str) -> bytes:
    import tokenizers

    with open(model_file, "rb") as f:
        return hashlib.sha256(f.read() + tokenizers.__version__.encode()).digest()


def _digested(docs: DataFrame, model: str, key: str, with_text: bool) -> DataFrame:
    id_type = docs.schema[key].dataType.simpleString()

    def work(batches):
        lib = Counter(model)
        for keys, texts in slices(batches, 2_000_000):
            texts = [t or "" for t in texts]
            row = {"content": [lib.digest(t) for t in texts]}
            yield row | ({"text": texts} if with_text else {key: keys, "n_bytes": [len(t.encode()) for t in texts]})

    columns = "text string" if with_text else f"`{key}` {id_type}, n_bytes long"
    return map_batches(docs.select(key, "text"), work, f"content binary, {columns}")


def stored_counts(docs: DataFrame, cache: str, version: bytes) -> DataFrame:
    """What the cache holds for this tokenizer, one row for each content."""
    spark = docs.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(cache)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], "content binary, n_tokens long")
    rows = spark.read.schema(CACHE_SCHEMA).parquet(cache).where(F.col("tokenizer") == F.lit(version))
    return rows.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, cache: str | None = None, model: str | None = None, limit: int = LIMIT,
                 key: str = "doc_id") -> DataFrame:
    """Per row: key, ``n_bytes``, ``n_tokens`` and ``over_limit``.  ``cache``
    is a folder that later calls may name again; without one a new folder in
    the shared checkpoint folder is used."""
    model = model or tokenizer_path(MODEL)
    version = tokenizer_digest(model)
    cache = cache or joined_path(ensure_checkpoint_dir(docs.sparkSession), f"token-counts-{uuid.uuid4().hex}")
    rows = written(with_salt(_digested(docs, model, key, with_text=False)))
    before = stored_counts(docs, cache, version)
    misses = written(rows.select("content").distinct().join(before, "content", "left_anti"))
    if not misses.isEmpty():
        texts = _digested(docs, model, key, with_text=True)
        few = fits(misses, BROADCAST_MISSES)
        if few:
            texts = texts.join(F.broadcast(misses), "content", "left_semi")
        texts = texts.groupBy("content").agg(F.first("text").alias("text"))
        if not few:
            texts = texts.join(misses, "content", "left_semi")

        def encode(batches):
            lib = Counter(model)
            for contents, some in slices(batches, 2_000_000):
                yield {"content": contents, "tokenizer": [version] * len(some), "n_tokens": lib.count(some)}

        map_batches(texts, encode, CACHE_SCHEMA).write.mode("append").parquet(cache)
    counts = stored_counts(docs, cache, version)
    out = salted_lookup(rows, counts, ["content"])
    return out.select(key, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op13_token_counts(docs: DataFrame, cache: str | None = None) -> DataFrame:
    return token_counts(docs, cache)
