"""SentencePiece encoding and decoding over a table of distinct chunks.

No piece holds a whitespace marker behind another character, so merges never cross
into a marked word: a text's ids are the ids of its marked words, one after another.
Each distinct marked word is segmented once, and ids are joined back by position.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import map_batches, texts_of, worker_cache

MARK = "▁"
CHUNK = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
# A worker's table is begun anew beyond so many characters; its size is bounded, results are not.
TABLE_CHARS = 16 << 20


class ChunkTable:
    """Distinct chunks of one worker: chunk -> (ids as bytes, decoded text)."""

    def __init__(self, model: str) -> None:
        self.whole = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = (self.whole.id_to_piece(i) for i in range(self.whole.get_piece_size()))
        if any(re.search(f"[^{MARK}]{MARK}", piece) for piece in pieces):
            raise ValueError("the model has pieces that cross a whitespace marker")
        if self.whole.normalize("x") != f"{MARK}x":
            raise ValueError("the model does not put a whitespace marker before a text")
        self.mark = [self.whole.piece_to_id(MARK)]
        self.begin = np.array([self.whole.bos_id()], "<u4").tobytes()
        self.end = np.array([self.whole.eos_id()], "<u4").tobytes()
        self.anchor = self.whole.encode("x")
        self.anchor_text = self.whole.decode(self.anchor)
        self.clear()

    def clear(self) -> None:
        # a chunk is kept without its first marker, which the encoder puts there again
        self.ids: dict[str, bytes] = {}
        self.texts: dict[str, str] = {}
        self.size = 0

    def learn(self, words: Iterable[str]) -> None:
        new = [word for word in words if word not in self.ids]
        for word, found in zip(new, self.whole.encode(new, num_threads=1)) if new else ():
            found = found or self.mark
            self.ids[word] = np.array(found, "<u4").tobytes()
            # behind an anchor, or the decoder takes the first marker for its own
            self.texts[word] = self.whole.decode(self.anchor + found)[len(self.anchor_text) :]
            self.size += 2 * len(word) + 8

    def encode(self, text: str) -> tuple[bytes, str]:
        """(all ids with begin and end as little-endian unsigned 32-bit, decoded text)."""
        if not text:
            return self.begin + self.end, ""
        if self.size > TABLE_CHARS:
            self.clear()
        normal = self.whole.normalize(text)
        if MARK * 2 in normal:
            words = [chunk[1:] for chunk in CHUNK.findall(normal)]
        else:
            words = normal[1:].split(MARK)
        self.learn(dict.fromkeys(words))
        decoded = "".join(map(self.texts.__getitem__, words))
        return self.begin + b"".join(map(self.ids.__getitem__, words)) + self.end, decoded[1:]


def with_pieces(
    df: DataFrame, model: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, ids, decoded) for every row.

    ``ids`` is binary: all ids, begin and end included, as little-endian unsigned 32-bit
    integers, equal to those the library gives for the whole text; ``decoded`` is the
    library's decoding of them. NULL and empty texts give begin and end alone and an empty
    decoding. Keys are passed on as they are (NULL, repeated); other columns are not read.
    """
    rows = df.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        table = worker_cache(f"pieces {model}", lambda: ChunkTable(model))
        made = [table.encode(t) for t in texts_of(batch, "text")]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([m[0] for m in made], pa.binary()),
                pa.array([m[1] for m in made], pa.string()),
            ],
            names=["doc_id", "ids", "decoded"],
        )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(rows, run, f"doc_id {kind}, ids binary, decoded string", "text")


def report(df: DataFrame, model: str) -> DataFrame:
    """One row per document: number of ids, digests of the ids and of the decoded text."""
    return with_pieces(df, model).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
