"""Token ids as flat binary files that training code memory-maps.

Documents are range-partitioned by id and every partition writes three files
into one folder: ``NNNNNN.bin``, the ids of its documents one after another as
unsigned little-endian integers (16 bits when the vocabulary allows, else 32);
``NNNNNN.local``, 64-bit token offsets inside that file; and, once the token
counts of all partitions are known, ``NNNNNN.off`` with 64-bit offsets in the
whole corpus.  The partition bases are prefix sums over one number for each
partition.  Files get their names only when complete, so a repeated task
replaces a file by an equal one.

Pre-tokens never merge with each other, so each distinct pre-token of a task
is encoded once by the library's model and the ids are joined by position; a
second table holds the ids of whole space-separated chunks.  The cut here is
used only on texts of Latin letters, digits and punctuation, where its classes
are spelt out; other texts, and texts that contain a special token, go through
the library whole.

Defined cases: a null or empty text has the end id only; documents with a null
id come first; documents of the same id follow each other in the order of
their text's hash; an empty table writes no token; other columns are ignored.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import uuid
import zlib
from collections.abc import Callable

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_batches, saved, shared_folder, slices, tokenizer_path

MODEL = "byte_bpe_50k.json"
END_ID = 2  # fixed value of the contract
TABLE_ENTRIES = 300_000
LONGEST_KEPT = 100
#: Pre-tokens of Latin text: the vocabulary's own rule with its letters and digits spelt out.
LETTER, DIGIT = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9"
PRE_TOKEN = (rf"'(?:s|t|re|ve|m|ll|d)| ?[{LETTER}]+| ?[{DIGIT}]+| ?[^\s{LETTER}{DIGIT}]+"
             r"|\s+(?!\S)|\s+")
#: Texts that hold anything else go through the library whole.
LATIN = rf"[\t\n\r\x20-\x7e¡-±´-¸»¿-ɏ‐-‧‰-⁞]*"


def id_type(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


class ChunkIds:
    """Distinct space-separated chunks and pre-tokens with their ids as bytes,
    for one task."""

    def __init__(self, model_file: str, entries: int = TABLE_ENTRIES):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(model_file)
        spec = json.loads(self.lib.to_str())
        pre = spec.get("pre_tokenizer") or {}
        self.quick = (spec.get("normalizer") is None and pre.get("type") == "ByteLevel"
                      and not pre.get("add_prefix_space") and pre.get("use_regex", True)
                      and spec["model"].get("type") == "BPE" and not spec["model"].get("dropout"))
        self.kind = id_type(self.lib.get_vocab_size())
        special = [re.escape(t["content"]) for t in spec.get("added_tokens") or []]
        self.special = re.compile("|".join(special) or "(?!)").search
        self.cut, self.plain = re.compile(PRE_TOKEN).findall, re.compile(LATIN).fullmatch
        self.space_run = re.compile(r"\s ").search
        # byte-level vocabularies write a byte as itself where it is printable, else as the next free code
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        self.shown = {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}
        self.entries, self.words, self.chunks = entries, {}, {}

    def by_library(self, text: str) -> bytes:
        return np.array(self.lib.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def word(self, word: str) -> bytes:
        """One pre-token, by the library's model."""
        ids = self.words.get(word)
        if ids is None:
            marked = word.encode().decode("latin-1").translate(self.shown)
            ids = np.array([t.id for t in self.lib.model.tokenize(marked)], self.kind).tobytes()
            if len(word) <= LONGEST_KEPT:
                if len(self.words) >= self.entries:
                    self.words.clear()
                self.words[word] = ids
        return ids

    def chunk(self, chunk: str) -> bytes:
        ids = b"".join([self.word(w) for w in self.cut(chunk)])
        if len(chunk) <= LONGEST_KEPT:
            if len(self.chunks) >= self.entries:
                self.chunks.clear()
            self.chunks[chunk] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if not self.quick or self.special(text) or not self.plain(text):
            return self.by_library(text)
        if self.space_run(text):
            return b"".join([self.word(w) for w in self.cut(text)])
        # every space follows a visible character, so it begins a pre-token
        get, first, *rest = self.chunks.get, *text.split(" ")
        parts = [self.chunk(first)] if first else []
        for part in rest:
            part = " " + part
            parts.append(get(part) or self.chunk(part))
        return b"".join(parts)


def _put(path: str, write: Callable) -> None:
    """Write a file under another name and rename it when it is complete."""
    part = f"{path}.{uuid.uuid4().hex}.part"
    with open(part, "wb") as out:
        write(out)
    os.replace(part, path)


def write_files(docs: DataFrame, folder: str, partitions: int, model: str | None = None,
                end_id: int = END_ID) -> DataFrame:
    """Tokenise ``docs`` into ``folder`` and return the index ``(part, row,
    doc_id)`` of what each file holds, in order."""
    path = model or tokenizer_path(MODEL)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches):
        table = ChunkIds(path)
        end = np.array([end_id], table.kind).tobytes()
        unit, part = len(end), TaskContext.get().partitionId()
        name = os.path.join(folder, f"{part:06d}")
        counts, rows = [], []

        def stream(out):
            for keys, texts in slices(batches):
                for t in texts:
                    ids = table.encode(t or "")
                    out.write(ids)
                    out.write(end)
                    counts.append(len(ids) // unit + 1)
                rows.append(keys)

        _put(name + ".bin", stream)
        local = np.concatenate(([0], np.cumsum(np.array(counts, "<i8")))).astype("<i8")
        _put(name + ".local", lambda out: out.write(local.tobytes()))
        at = 0
        for keys in rows:
            yield {"part": [part] * len(keys), "row": range(at, at + len(keys)), "doc_id": keys}
            at += len(keys)

    ordered = (docs.select("doc_id", "text").withColumn("_h", F.xxhash64("text"))
               .repartitionByRange(partitions, "doc_id", "_h").sortWithinPartitions("doc_id", "_h")
               .select("doc_id", "text"))
    return saved(map_batches(ordered, work, f"part int, row long, doc_id {kind}"))


def write_bases(spark: SparkSession, index: DataFrame, folder: str) -> None:
    """Prefix sums over the partitions' token counts, then each partition's
    offsets in the whole corpus.  The driver sees one number a partition."""
    def count(batches):
        for parts, in slices(batches):
            size = [int(np.fromfile(os.path.join(folder, f"{p:06d}.local"), "<i8")[-1]) for p in parts]
            yield {"part": parts, "tokens": size}

    parts = index.groupBy("part").agg(F.lit(1)).select("part")
    totals = sorted(map_batches(parts, count, "part int, tokens long").collect())
    bases = list(itertools.accumulate((t.tokens for t in totals), initial=0))
    table = spark.createDataFrame([(t.part, b) for t, b in zip(totals, bases)], "part int, base long")

    def shift(batches):
        for parts, base in slices(batches):
            for p, b in zip(parts, base):
                name = os.path.join(folder, f"{p:06d}")
                off = np.fromfile(name + ".local", "<i8") + b
                _put(name + ".off", lambda out, off=off: out.write(off.tobytes()))
            yield {"part": parts}

    map_batches(table.repartition(max(1, len(bases) // 8)), shift, "part int").count()


def read_files(index: DataFrame, folder: str, kind: str) -> DataFrame:
    """Per document, from the memory-mapped files: its start in the corpus,
    its number of ids and the crc32 of its ids as 32-bit numbers."""
    key = index.schema["doc_id"].dataType.simpleString()

    def work(batches):
        open_part, ids, off = None, None, None
        for parts, rows, keys in slices(batches, 400_000):
            start, n, crc = [], [], []
            for p, r in zip(parts, rows):
                if p != open_part:
                    name = os.path.join(folder, f"{p:06d}")
                    ids = np.memmap(name + ".bin", kind, "r")
                    off = np.memmap(name + ".off", "<i8", "r")
                    open_part = p
                lo, hi = int(off[r]), int(off[r + 1])
                own = ids[lo - int(off[0]):hi - int(off[0])]
                start.append(lo)
                n.append(hi - lo)
                crc.append(zlib.crc32(own.astype("<u4").tobytes()))
            yield {"doc_id": keys, "start": start, "n_tokens": n, "ids_crc32": crc}

    return map_batches(index, work, f"doc_id {key}, start long, n_tokens long, ids_crc32 long")


def op6_binary_ids(docs: DataFrame, model: str | None = None, folder: str | None = None) -> DataFrame:
    """Write the corpus files and read them back; ``folder`` must be mounted on
    every executor (default: a new one in the checkpoint folder)."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    folder = folder or os.path.join(shared_folder(spark), f"ids-{uuid.uuid4().hex}")
    os.makedirs(folder, exist_ok=True)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    index = write_files(docs, folder, partitions, model)
    write_bases(spark, index, folder)
    kind = id_type(Tokenizer.from_file(model or tokenizer_path(MODEL)).get_vocab_size())
    return read_files(index, folder, kind)
