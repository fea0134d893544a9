"""SentencePiece encoding and decoding over a table of distinct chunks.

No piece of the vocabulary has a white-space marker after another character
(checked when the model is loaded), so merges never cross the start of a run
of markers.  A text is cut there, every distinct chunk of a task is segmented
once by the library, and the ids are joined back by position.  The table is
kept from batch to batch and emptied when it reaches its bound, so memory is
bounded whatever the vocabulary of the corpus.  Decoding gives the library
all ids of the document.

Defined cases: a null text is encoded as the empty text, whose only id is the
end id; texts are never cut short; repeated rows are returned as often as
they come; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame

from .common import map_batches, slices, tokenizer_path

MARK = "▁"
MODEL = "piece_bpe_32k.model"
TABLE_ENTRIES = 300_000
LONGEST_KEPT = 200


class ChunkTable:
    """Distinct chunks and their ids, for one model in one task."""

    def __init__(self, model_file: str, entries: int = TABLE_ENTRIES):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.entries = entries
        self.table: dict[str, bytes] = {}
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        self.apart = not any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces)
        self.cut = re.compile(f"{MARK}+[^{MARK}]*").findall
        self.mark_id = self.sp.piece_to_id(MARK)

    def ids_of(self, chunks: list[str]) -> list[bytes]:
        """Each chunk's ids as 32-bit numbers."""
        raw = [c[1:].replace(MARK, " ") for c in chunks]  # the library adds the first marker itself
        return [np.array(ids if r else [self.mark_id], "<u4").tobytes()
                for r, ids in zip(raw, self.sp.encode(raw, num_threads=1))]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text, without end id."""
        if not self.apart:
            return [np.array(x, "<u4") for x in self.sp.encode(texts, num_threads=1)]
        cut = [self.cut(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        new = list({c for chunks in cut for c in chunks}.difference(self.table))
        if len(self.table) + len(new) > self.entries:
            self.table = {}
            new = list({c for chunks in cut for c in chunks})
        self.table.update(zip(new, self.ids_of(new)))
        get = self.table.__getitem__
        out = [np.frombuffer(b"".join(map(get, chunks)), "<u4") for chunks in cut]
        for c in new:
            if len(c) > LONGEST_KEPT:
                del self.table[c]
        return out


def encode_documents(docs: DataFrame, model: str | None = None, key: str = "doc_id",
                     outputs: tuple[str, ...] = ("ids", "decoded")) -> DataFrame:
    """Per row: key, the ``outputs`` asked for (``ids``, end id last, and the
    ``decoded`` text), the number of ids and the digests of both."""
    path = model or tokenizer_path(MODEL)
    kinds = {"ids": "array<int>", "decoded": "string"}
    first = f"`{key}` {docs.schema[key].dataType.simpleString()}, " + "".join(f"{o} {kinds[o]}, " for o in outputs)

    def work(batches):
        table = ChunkTable(path)
        end = np.array([table.sp.eos_id()], "<u4")
        names = [str(i) for i in range(table.sp.get_piece_size())]
        for keys, texts in slices(batches, 2_000_000):
            arrays = [np.concatenate((x, end)).astype(np.int32) for x in table.encode([t or "" for t in texts])]
            lists = [x.tolist() for x in arrays]
            back = [table.sp.decode(x) for x in lists]
            yield {
                key: keys, "ids": arrays, "decoded": back,
                "n_tokens": [len(x) for x in lists],
                "ids_sha256": [hashlib.sha256(" ".join([names[i] for i in x]).encode()).hexdigest() for x in lists],
                "decoded_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in back],
            }

    return map_batches(docs.select(key, "text"), work,
                       first + "n_tokens long, ids_sha256 string, decoded_sha256 string")


def op5_sentencepiece(docs: DataFrame, model: str | None = None) -> DataFrame:
    return encode_documents(docs, model, outputs=())
