"""Packing of documents into token windows, lexical neighbours side by side.

A document's tokens fill whole windows of their own as far as they go. What is left of
each document is a unit of retrieval: a BM25 index, in shards, returns for a seed unit the
unused units nearest to it, and these fill the seed's window one after another. The last
one is cut where the window ends, and its rest stays in the index. What is left in a shard
at the end is cut into windows of powers of two, so no window has padding.
"""

from __future__ import annotations

import os
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tablesync.llm.common import map_batches, texts_of, worker_cache
from tablesync.session import Scratch

WINDOW = 1024
END_ID = 0
# Units of one index shard, and of one task's range of them.
SHARD = 1024
UNITS_PER_TASK = 8192
K1, B = 1.2, 0.75
TABLE_CHARS = 8 << 20

# Beyond these blocks, letter classes can differ between Unicode versions.
LAST = 0x24F


def _class(*categories: str) -> str:
    found = (chr(c) for c in range(LAST + 1) if unicodedata.category(chr(c))[0] in categories)
    return "".join(map(re.escape, found))


def splitting_rule() -> re.Pattern:
    """The rule by which byte-level vocabularies of this kind split texts, up to LAST."""
    letter, number = _class("L"), _class("N")
    space = re.escape("\t\n\v\f\r \x85\xa0")
    return re.compile(
        rf" ?[{letter}]+| ?[{number}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^{space}{letter}{number}]+"
        rf"|[{space}]+(?![^{space}])|[{space}]+"
    )


WORD = splitting_rule()
# The same rule for texts of ASCII alone, whose classes are cheaper to match.
ASCII_WORD = re.compile(
    r" ?[A-Za-z]+| ?[0-9]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^\t\n\v\f\r A-Za-z0-9]+"
    r"|[\t\n\v\f\r ]+(?![^\t\n\v\f\r ])|[\t\n\v\f\r ]+"
)
BEYOND = re.compile(f"[^\0-{chr(LAST)}]")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class WordTable(dict):
    """Distinct words of one worker and their ids, filled as words turn up.

    A single word is merged by rank, which in these vocabularies is the order of the
    merges; texts whose words are in doubt go to the tokenizer whole.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        letters = byte_letters()
        ranks = {
            bytes(letters[c] for c in piece): i
            for piece, i in self.tokenizer.get_vocab(with_added_tokens=False).items()
            if piece not in self.special
        }
        if max(ranks.values()) >= 1 << 16:
            raise ValueError("ids are kept in 16 bits")
        whole = tiktoken.Encoding("words", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
        self.merged = whole.encode_ordinary
        self.end = np.array([END_ID], "<u2").tobytes()
        self.size = 0

    def __missing__(self, word: str) -> bytes:
        ids = self.merged(word)
        made = struct.pack(f"<{len(ids)}H", *ids)
        if self.size < TABLE_CHARS:
            self[word] = made
            self.size += len(word) + 8
        return made

    def encode(self, text: str) -> np.ndarray:
        """The ids of a whole text, as the tokenizer gives them without special ids, and END_ID."""
        ascii_only = text.isascii()
        if not ascii_only and BEYOND.search(text) or any(s in text for s in self.special):
            whole = self.tokenizer.encode(text, add_special_tokens=False).ids
            return np.array([*whole, END_ID], "<u2")
        words = (ASCII_WORD if ascii_only else WORD).findall(text)
        return np.frombuffer(b"".join(map(self.__getitem__, words)) + self.end, "<u2")


def crc_of(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def tokenized(df: DataFrame, vocabulary: str, key: str, text: str, keep_ids: bool) -> DataFrame:
    """(doc_id, n, crcs, body, tail): crc of each whole window, ids of what is left (16 bits each).

    ``body`` holds the ids of the whole windows if they are wanted.
    """
    rows = df.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        table = worker_cache(f"words {vocabulary}", lambda: WordTable(vocabulary))
        found = [table.encode(t) for t in texts_of(batch, "text")]
        whole = [len(ids) // WINDOW * WINDOW for ids in found]
        crcs = [[crc_of(i[at : at + WINDOW]) for at in range(0, w, WINDOW)] for i, w in zip(found, whole)]
        body = [i[:w].tobytes() if keep_ids else None for i, w in zip(found, whole)]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([len(ids) for ids in found], pa.int64()),
                pa.array(crcs, pa.list_(pa.int64())),
                pa.array(body, pa.binary()),
                pa.array([i[w:].tobytes() for i, w in zip(found, whole)], pa.binary()),
            ],
            names=["doc_id", "n", "crcs", "body", "tail"],
        )

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n bigint, crcs array<bigint>, body binary, tail binary"
    return map_batches(rows, run, schema, "text")


def counted(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids in order and how often each is there."""
    ids = np.sort(ids)
    edge = np.ones(len(ids) + 1, bool)
    np.not_equal(ids[1:], ids[:-1], out=edge[1:-1])
    at = np.flatnonzero(edge)
    return ids[at[:-1]], np.diff(at)


class Corpus:
    """Document frequencies and mean length of all units; bounded by the vocabulary."""

    def __init__(self, tails: DataFrame) -> None:
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen, units, tokens = np.zeros(1 << 16, np.int64), 0, 0
            for batch in batches:
                for tail in batch.column("tail").to_pylist():
                    ids = np.frombuffer(tail, "<u2")
                    seen[counted(ids)[0]] += 1
                    units, tokens = units + 1, tokens + len(ids)
            at = np.flatnonzero(seen)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([[-2, -1], at])),
                    pa.array(np.concatenate([[tokens, units], seen[at]])),
                ],
                names=["term", "n"],
            )

        parts = tails.select("tail").mapInArrow(count, "term bigint, n bigint")
        table = parts.groupBy("term").agg(F.sum("n").alias("n")).toPandas()
        known = dict(zip(table["term"], table["n"]))
        self.units = int(known.pop(-1, 0))
        self.mean = max(1.0, known.pop(-2, 0) / max(1, self.units))
        frequency = np.zeros(1 << 16)
        frequency[list(known)] = list(known.values())
        self.idf = np.log1p((self.units - frequency + 0.5) / (frequency + 0.5)).astype(np.float32)

    def theme(self, tail: bytes) -> tuple[int, int]:
        """The two most telling terms: units that share them become neighbours in the range."""
        terms, times = counted(np.frombuffer(tail, "<u2"))
        weight = self.idf[terms] * times / (times + K1)
        first = second = int(np.argmax(weight))
        if len(weight) > 1:
            weight[first] = -np.inf
            second = int(np.argmax(weight))
        return int(terms[first]), int(terms[second])


class Shard:
    """Inverted index over some units: for each term, the units that have it and their weights."""

    def __init__(self, units: list[np.ndarray], corpus: Corpus) -> None:
        found = [counted(ids) for ids in units]
        self.terms = [terms for terms, _ in found]
        unit = np.repeat(np.arange(len(units)), [len(t) for t in self.terms])
        term = np.concatenate(self.terms)
        times = np.concatenate([n for _, n in found]).astype(np.float32)
        length = np.array([len(ids) for ids in units], np.float32)[unit]
        weight = corpus.idf[term] * times * (K1 + 1) / (times + K1 * (1 - B + B * length / corpus.mean))
        order = np.argsort(term, kind="stable")
        self._index(term[order], unit[order], weight[order])
        self.held = len(units)

    def _index(self, term: np.ndarray, unit: np.ndarray, weight: np.ndarray) -> None:
        self.term, self.unit, self.weight = term, unit, weight
        self.first = np.searchsorted(term, np.arange((1 << 16) + 1))

    def unused(self, left: np.ndarray) -> np.ndarray:
        """Units with tokens left; entries of the others go when a quarter of them is used."""
        units = np.flatnonzero(left)
        if len(units) < 0.75 * self.held:
            kept = left[self.unit] > 0
            self._index(self.term[kept], self.unit[kept], self.weight[kept])
            self.held = len(units)
        return units

    def scores(self, seed: int) -> np.ndarray:
        terms = self.terms[seed].astype(np.int64)
        begin, size = self.first[terms], self.first[terms + 1] - self.first[terms]
        jump = np.repeat(begin - np.concatenate([[0], np.cumsum(size)[:-1]]), size)
        at = jump + np.arange(len(jump))
        return np.bincount(self.unit[at], self.weight[at], minlength=len(self.terms))


def pack_units(units: list[np.ndarray], corpus: Corpus) -> list[list[tuple[int, int, int]]]:
    """Windows of (unit, start, length) over all tokens of all units, without padding."""
    shard = Shard(units, corpus)
    left = np.array([len(ids) for ids in units])
    windows, last = [], []
    for seed in range(len(units)):
        while left[seed]:
            window, space = [], WINDOW
            ranked = None
            at = seed
            while space:
                take = int(min(space, left[at]))
                window.append((at, len(units[at]) - int(left[at]), take))
                left[at] -= take
                space -= take
                if space:
                    if ranked is None:
                        unused = shard.unused(left)
                        best = np.argsort(-shard.scores(seed)[unused], kind="stable")
                        ranked = iter(unused[best].tolist())
                    at = next((u for u in ranked if left[u]), None)
                    if at is None:
                        break
            if space:
                last = window
            else:
                windows.append(window)
    # only the very last window can be short: cut it at powers of two
    rest = sum(take for _, _, take in last)
    while rest:
        size = 1 << (rest.bit_length() - 1)
        rest -= size
        window, space = [], size
        while space:
            unit, start, length = last[0]
            take = min(space, length)
            window.append((unit, start, take))
            space -= take
            last = [(unit, start + take, length - take), *last[1:]] if take < length else last[1:]
        windows.append(window)
    return windows


def packed(
    df: DataFrame,
    scratch: Scratch,
    vocabulary: str,
    key: str = "doc_id",
    text: str = "text",
    keep_ids: bool = True,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids].

    Every token of every row lies in exactly one piece; sequences have WINDOW tokens or a
    power of two of them, with offsets from 0 without gaps. NULL and empty texts are the
    end id alone. Rows with equal or NULL keys are packed as rows of their own; an empty
    table gives an empty result; other columns are not read. ``ids`` is binary, 16 bits
    each, little-endian.

    Shards are cut from ranges of the units' most telling terms, then of their content and
    key, so copies and units on one theme meet, and a theme of any size is split among
    tasks. No unit is compared outside its shard, and no shard is larger than SHARD.
    """
    tokens = scratch.write(tokenized(df, vocabulary, key, text, keep_ids), "tokens")
    kind = tokens.schema["doc_id"].dataType.simpleString()
    windows = tokens.select("doc_id", "n", "body", F.posexplode("crcs").alias("at", "ids_crc32"))
    windows = windows.select(
        "doc_id",
        (F.col("at") * WINDOW).cast("long").alias("start"),
        F.lit(WINDOW).cast("long").alias("length"),
        "ids_crc32",
        F.col("n").alias("doc_tokens"),
        (F.monotonically_increasing_id() * 2).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        F.substring("body", F.col("at") * (2 * WINDOW) + 1, F.lit(2 * WINDOW)).alias("ids"),
    )
    tails = tokens.where(F.octet_length("tail") > 0).select("doc_id", "n", "tail")
    corpus = Corpus(tails)

    def themes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [corpus.theme(tail) for tail in batch.column("tail").to_pylist()]
            columns = [pa.array([f[i] for f in found], pa.int32()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *columns], names=[*batch.schema.names, "theme", "second"]
            )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 33
        waiting: list[dict] = []
        for batch in batches:
            waiting += batch.select(["doc_id", "n", "tail"]).to_pylist()
            while len(waiting) >= SHARD:
                made, sequence = rows_of(waiting[:SHARD], sequence)
                del waiting[:SHARD]
                yield made
        if waiting:
            yield rows_of(waiting, sequence)[0]

    def rows_of(shard: list[dict], sequence: int) -> tuple[pa.RecordBatch, int]:
        units = [np.frombuffer(row["tail"], "<u2") for row in shard]
        out = {name: [] for name in names}
        for window in pack_units(units, corpus):
            offset = 0
            for unit, start, length in window:
                ids = units[unit][start : start + length]
                row = shard[unit]
                values = (
                    row["doc_id"],
                    row["n"] - len(units[unit]) + start,
                    length,
                    crc_of(ids),
                    row["n"],
                    2 * sequence + 1,
                    offset,
                    ids.tobytes() if keep_ids else None,
                )
                for name, value in zip(names, values):
                    out[name].append(value)
                offset += length
            sequence += 1
        return pa.RecordBatch.from_pydict(out, schema=arrow), sequence

    names = windows.columns
    number = pa.int64()
    key_kind = to_arrow_schema(tokens.select("doc_id").schema).field(0).type
    arrow = pa.schema(
        [("doc_id", key_kind), *((n, number) for n in names[1:-1]), ("ids", pa.binary())]
    )
    schema = f"doc_id {kind}, " + ", ".join(f"{n} bigint" for n in names[1:-1]) + ", ids binary"
    order = ["theme", "second", F.xxhash64("tail"), F.xxhash64("doc_id"), "n"]
    tasks = max(1, -(-corpus.units // UNITS_PER_TASK))
    ranged = tails.mapInArrow(themes, f"doc_id {kind}, n bigint, tail binary, theme int, second int")
    ranged = scratch.write(ranged, "units")  # ranges are found from a sample, a pass of its own
    ranged = ranged.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    both = windows.unionByName(ranged.mapInArrow(pack, schema))
    return both if keep_ids else both.drop("ids")
