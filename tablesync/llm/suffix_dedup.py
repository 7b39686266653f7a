"""Passages that an earlier document has already, found by prefix doubling.

Equal byte strings get equal names, and names of growing length are made from pairs of
names at growing offsets: 8 bytes, 16, 32, up to the threshold. Spark sorts the named
positions of all documents twice, first by the names of short strings, then by the names
of whole passages of the positions that are not decided yet; a position whose name is
unique, or whose whole surroundings an earlier document has, is ranked no further.

Ranking every byte would move some twenty bytes for each byte of text and round. So the
first round ranks a sample that content alone chooses: of every window of ``LENGTH`` bytes
the short string with the smallest name. Equal passages choose the same place, so none is
missed. A run is all windows in a row that choose one place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.session import Scratch

# Bytes of a repeated passage, and of the strings ranked first.
LENGTH = 50
SHORT = 20
REACH = LENGTH - SHORT + 1
# Texts are kept in blocks of about so many bytes; a longer text is a block of its own.
BLOCK_BYTES = 2 << 20
# Text bytes whose names meet in one group, on average.
BUCKET_BYTES = 4 << 20
# Windows worked on at once, and those of them that fit a processor's cache.
CHUNK = 1 << 19
SLICE = 1 << 15
ODD = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))
SHORT_BITS, RUN_BITS = np.uint64(28), np.uint64(36)
SAMPLE, WINDOWS = 1, 2


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Names of concatenations from the names of their parts."""
    x = a * ODD[0]
    x ^= x >> np.uint64(32)
    x += b
    x *= ODD[1]
    x ^= x >> np.uint64(29)
    return x


def names(data: np.ndarray, lengths: tuple[int, ...]) -> list[np.ndarray]:
    """Names of all strings of these ascending lengths (8 or more) in some bytes.

    Eight bytes are their own name. From there lengths double, and a length between two
    powers joins two overlapping strings.
    """
    name = data.astype(np.uint64)
    size = 1
    while size < 8:
        name = name[:-size] | name[size:] << np.uint64(8 * size)
        size *= 2
    found = []
    for length in lengths:
        while 2 * size <= length:
            name = pair(name[:-size], name[size:])
            size *= 2
        more = length - size
        found.append(pair(name[:-more], name[more:]) if more else name)
    return found


def smallest_in_reach(values: np.ndarray, reach: int) -> np.ndarray:
    """Minimum of every ``reach`` neighbours, by doubling."""
    size = 1
    while 2 * size <= reach:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    more = reach - size
    return np.minimum(values[:-more], values[more:]) if more else values


@dataclass
class Block:
    """Texts one after another; a document without an id has no windows."""

    ids: np.ndarray
    has_id: np.ndarray
    ends: np.ndarray
    data: np.ndarray

    @classmethod
    def of(cls, row: dict) -> Block:
        ids = np.frombuffer(row["ids"], np.int64)
        ends = np.cumsum(np.frombuffer(row["sizes"], np.int64))
        size = int(ends[-1]) if len(ends) else 0
        data = np.frombuffer(pa.decompress(row["body"], size, codec="zstd"), np.uint8)
        return cls(ids, np.frombuffer(row["has_id"], bool), ends, data)

    def runs(self) -> Iterator[Runs]:
        """Runs of the whole block, chunk by chunk; where chunks end does not change results."""
        for at in range(0, max(0, len(self.data) - LENGTH + 1), CHUNK):
            found = self._chunk(at, min(at + CHUNK, len(self.data) - LENGTH + 1))
            if found is not None:
                yield found

    def _chunk(self, start: int, stop: int) -> Runs | None:
        place = np.empty(stop - start, np.int64)
        whole = np.empty(stop - start, np.uint64)
        short = np.empty(stop - start + REACH - 1, np.uint64)
        for a in range(start, stop, SLICE):
            b = min(a + SLICE, stop)
            brief, full = names(self.data[a : b + LENGTH - 1], (SHORT, LENGTH))
            low = np.uint64(0xFFFF)
            marked = brief & ~low | np.arange(len(brief), dtype=np.uint64)
            place[a - start : b - start] = (smallest_in_reach(marked, REACH) & low).astype(np.int64) + a
            whole[a - start : b - start] = full
            short[a - start : a - start + len(brief)] = brief
        doc = np.searchsorted(self.ends, np.arange(start, stop), side="right")
        inside = np.arange(start + LENGTH, stop + LENGTH) <= self.ends[doc]
        inside &= self.has_id[doc]
        at = np.flatnonzero(inside)
        if not len(at):
            return None
        new = np.ones(len(at), bool)
        new[1:] = (place[at[1:]] != place[at[:-1]]) | (doc[at[1:]] != doc[at[:-1]])
        begin = np.flatnonzero(new)
        first = at[begin]
        last = at[np.append(begin[1:], len(at)) - 1]
        around = pair(pair(whole[first], whole[last]), (last - first).astype(np.uint64))
        return Runs(doc[first], first + start, last + start, short[place[first] - start], around, whole, start)


@dataclass
class Runs:
    """Runs of windows: document, first and last start, names; names of all windows."""

    doc: np.ndarray
    first: np.ndarray
    last: np.ndarray
    short: np.ndarray
    around: np.ndarray
    whole: np.ndarray
    start: int

    def sample(self, buckets: int) -> Named:
        name = self.short << RUN_BITS | self.around >> SHORT_BITS
        return Named(bucket_of(self.short, buckets), name, self.doc)

    def windows(self, open_runs: np.ndarray, buckets: int) -> tuple[Named, np.ndarray]:
        """Names of the windows of some runs, and where they start."""
        size = (self.last - self.first + 1)[open_runs]
        run = np.repeat(open_runs, size)
        at = np.arange(len(run)) - np.repeat(np.cumsum(size) - size, size) + self.first[run]
        whole = self.whole[at - self.start]
        return Named(bucket_of(whole, buckets), pair(whole, self.short[run]), self.doc[run]), at


def bucket_of(name: np.ndarray, buckets: int) -> np.ndarray:
    """Sampled names are the smallest of many, so a product spreads them first."""
    spread = name * ODD[1] >> np.uint64(32)
    return (spread * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


@dataclass
class Named:
    """Names of one block. In a bucket a name is sent once, for its smallest document."""

    bucket: np.ndarray
    name: np.ndarray
    doc: np.ndarray

    @classmethod
    def joined(cls, parts: list[Named]) -> Named:
        columns = ([getattr(p, c) for p in parts] for c in ("bucket", "name", "doc"))
        return cls(*(np.concatenate(c) if c else np.zeros(0, np.int64) for c in columns))

    def distinct(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows that stand for their (bucket, name), in that order, and which one each row has."""
        order = np.lexsort((ids[self.doc], self.name, self.bucket))
        name, bucket = self.name[order], self.bucket[order]
        new = np.ones(len(order), bool)
        new[1:] = (name[1:] != name[:-1]) | (bucket[1:] != bucket[:-1])
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(new) - 1
        return order[new], group

    def rows(self, block: int, ids: np.ndarray) -> Iterator[tuple]:
        """(bucket, block, names, ids, which): the distinct names bucket by bucket."""
        stands, _ = self.distinct(ids)
        bucket = self.bucket[stands]
        edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1)) if len(bucket) else []
        for a, b in zip(edges[:-1], edges[1:]):
            own, which = np.unique(ids[self.doc[stands[a:b]]], return_inverse=True)
            small = np.min_scalar_type(len(own) - 1)
            name = self.name[stands[a:b]].tobytes()
            yield int(bucket[a]), block, name, own.tobytes(), which.astype(small).tobytes()


ROW = "bucket bigint, block bigint, names binary, ids binary, which binary"


def _batch(rows: list[tuple], columns: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    values = zip(*rows) if rows else [()] * len(columns)
    return pa.RecordBatch.from_arrays([pa.array(list(v), k) for v, k in zip(values, kinds)], names=columns)


def blocks_of(df: DataFrame, key: str, text: str) -> DataFrame:
    """(ids, has_id, sizes, body, bytes): texts in compressed blocks, NULL as empty."""
    columns = ["ids", "has_id", "sizes", "body", "bytes"]
    kinds = [pa.binary()] * 4 + [pa.int64()]

    def packed(ids: list, texts: list[bytes]) -> tuple:
        sizes = np.array([len(t) for t in texts], np.int64)
        known = np.array([i is not None for i in ids])
        body = b"".join(texts)
        numbers = np.array([0 if i is None else i for i in ids], np.int64)
        return numbers.tobytes(), known.tobytes(), sizes.tobytes(), pa.compress(
            body, codec="zstd", asbytes=True
        ), len(body)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        for batch in batches:
            bodies = batch.column("text").cast(pa.large_binary())
            for i, body in zip(batch.column("id"), bodies):
                one = body.as_py() or b""
                if ids and size + len(one) > BLOCK_BYTES:
                    yield _batch([packed(ids, texts)], columns, kinds)
                    ids, texts, size = [], [], 0
                ids.append(i.as_py())
                texts.append(one)
                size += len(one)
        if ids:
            yield _batch([packed(ids, texts)], columns, kinds)

    rows = df.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    schema = "ids binary, has_id binary, sizes binary, body binary, bytes bigint"
    return rows.mapInArrow(run, schema).withColumn("block", F.monotonically_increasing_id())


def each_block(blocks: DataFrame, work, columns: list[str], kinds: list[pa.DataType], schema: str) -> DataFrame:
    """Rows that ``work`` yields for every block, one block at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield _batch(list(work(batch.slice(i, 1).to_pylist()[0])), columns, kinds)

    return blocks.mapInArrow(run, schema)


def ranked(rows: DataFrame, sample: bool) -> DataFrame:
    """(block, bucket, earlier, open): bits of the names that each block sent to a bucket.

    ``earlier``: another block has the name in a smaller document. ``open``, in the
    sample: strings around the same short string differ between documents, so windows of
    them may still be equal. A bucket holds every distinct name of a block once, so copies
    and common passages do not add to it.
    """
    columns = ["block", "bucket", "earlier", "open"]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]

    def settle(rows: list[dict]) -> pa.RecordBatch:
        name = np.concatenate([np.frombuffer(r["names"], np.uint64) for r in rows])
        size = [len(r["names"]) // 8 for r in rows]
        doc = np.concatenate([_documents(r, n) for r, n in zip(rows, size)])
        order = np.lexsort((doc, name))
        sorted_name, sorted_doc = name[order], doc[order]
        new = np.ones(len(order), bool)
        new[1:] = sorted_name[1:] != sorted_name[:-1]
        first = sorted_doc[np.flatnonzero(new)]
        earlier = np.empty(len(order), bool)
        earlier[order] = sorted_doc > first[np.cumsum(new) - 1]
        undecided = np.zeros(len(order), bool)
        if sample:
            short = sorted_name >> RUN_BITS
            begins = np.ones(len(order), bool)
            begins[1:] = short[1:] != short[:-1]
            group, starts = np.cumsum(begins) - 1, np.flatnonzero(begins)
            firsts = first[np.cumsum(new) - 1]
            several = np.maximum.reduceat(firsts, starts) > np.minimum.reduceat(firsts, starts)
            undecided[order] = several[group]
            undecided &= ~earlier
        ends = np.cumsum(size)
        found = [
            (r["block"], r["bucket"], np.packbits(earlier[b - n : b]).tobytes(), np.packbits(undecided[b - n : b]).tobytes())
            for r, n, b in zip(rows, size, ends)
        ]
        return _batch(found, columns, kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[dict] = []
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if waiting and waiting[-1]["bucket"] != row["bucket"]:
                    yield settle(waiting)
                    waiting = []
                waiting.append(row)
        if waiting:
            yield settle(waiting)

    dealt = rows.repartition("bucket").sortWithinPartitions("bucket", "block")
    return dealt.mapInArrow(run, "block bigint, bucket bigint, earlier binary, open binary")


def _documents(row: dict, size: int) -> np.ndarray:
    ids = np.frombuffer(row["ids"], np.int64)
    kind = np.min_scalar_type(len(ids) - 1)
    return ids[np.frombuffer(row["which"], kind, count=size)]


def bits(marks: list[dict], field: str, sizes: np.ndarray) -> np.ndarray:
    """The bits of all buckets of a block, in the order of the names it sent."""
    parts = [np.unpackbits(np.frombuffer(m[field], np.uint8), count=n) for m, n in zip(marks, sizes)]
    return np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)


def told(named: Named, ids: np.ndarray, marks: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """For every row: an earlier document has its name; it is open and the first to have it."""
    stands, group = named.distinct(ids)
    _, sizes = np.unique(named.bucket[stands], return_counts=True)
    marks = sorted(marks, key=lambda m: m["bucket"])
    later = ids[named.doc] > ids[named.doc[stands]][group]
    return bits(marks, "earlier", sizes)[group] | later, bits(marks, "open", sizes)[group] & ~later


def undecided(block: Block, marks: list[dict], buckets: int) -> tuple[list, list, Named, np.ndarray]:
    """Runs of a block and which of them are repeated; windows of the open ones."""
    chunks = list(block.runs())
    sample = Named.joined([c.sample(buckets) for c in chunks])
    whole, still = told(sample, block.ids, [m for m in marks if m["round"] == SAMPLE])
    spans, parts, places = [], [], []
    at = 0
    for chunk in chunks:
        mine = slice(at, at + len(chunk.doc))
        at += len(chunk.doc)
        spans.append((chunk.first[whole[mine]], chunk.last[whole[mine]]))
        named, place = chunk.windows(np.flatnonzero(still[mine]), buckets)
        parts.append(named)
        places.append(place)
    where = np.concatenate(places) if places else np.zeros(0, np.int64)
    return spans, chunks, Named.joined(parts), where


def covered(block: Block, spans: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Bytes inside windows that start within these spans, first and last start included."""
    change = np.zeros(len(block.data) + 1, np.int32)
    for first, last in spans:
        np.add.at(change, first, 1)
        np.add.at(change, last + LENGTH, -1)
    return np.cumsum(change[:-1]) > 0


def without_repeats(df: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of every row.

    Each byte covered by a string of LENGTH bytes that also starts in a row with a smaller
    key goes; what is left is ``kept`` (binary, as a cut may fall inside a character). All
    rows are judged on the input. Texts are UTF-8 bytes, NULL is empty, and no string
    crosses texts. Of rows with equal keys none is earlier. A row without a key keeps its
    text and removes nothing elsewhere. An empty table gives an empty result; other
    columns are not read.

    Names are 64 bits long, and a bucket adds the logarithm of their number: with buckets
    of 4 MB of text, under one false match is expected in 100 TB.
    """
    blocks = scratch.write(blocks_of(df, key, text), "blocks")
    total = blocks.agg(F.sum("bytes")).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_BYTES))
    columns = ["bucket", "block", "names", "ids", "which"]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]

    def sampled(row: dict) -> Iterator[tuple]:
        block = Block.of(row)
        found = Named.joined([c.sample(buckets) for c in block.runs()])
        yield from found.rows(row["block"], block.ids)

    def windows(row: dict) -> Iterator[tuple]:
        block = Block.of(row)
        _, _, named, _ = undecided(block, row["marks"] or [], buckets)
        yield from named.rows(row["block"], block.ids)

    def results(row: dict) -> Iterator[tuple]:
        block, marks = Block.of(row), row["marks"] or []
        spans, _, named, at = undecided(block, marks, buckets)
        again, _ = told(named, block.ids, [m for m in marks if m["round"] == WINDOWS])
        gone = covered(block, [*spans, (at[again], at[again])])
        start = 0
        for i, end in enumerate(block.ends):
            out, data = gone[start:end], block.data[start:end]
            kept = data[~out].tobytes()
            n_spans = int(np.count_nonzero(np.diff(out.astype(np.int8), prepend=0) == 1))
            doc = int(block.ids[i]) if block.has_id[i] else None
            yield doc, len(data), len(data) - len(kept), n_spans, hashlib.sha256(kept).hexdigest(), kept
            start = int(end)

    def marked(*rounds: tuple[int, DataFrame]) -> DataFrame:
        """Blocks with what the rounds told of their names; at most one row a bucket each."""
        told_rows = None
        for number, rows in rounds:
            rows = rows.withColumn("round", F.lit(number))
            told_rows = rows if told_rows is None else told_rows.unionByName(rows)
        marks = told_rows.groupBy("block").agg(
            F.collect_list(F.struct("round", "bucket", "earlier", "open")).alias("marks")
        )
        return blocks.join(marks, "block", "left")

    first = scratch.write(ranked(each_block(blocks, sampled, columns, kinds, ROW), True), "sample")
    rows = each_block(marked((SAMPLE, first)), windows, columns, kinds, ROW)
    second = scratch.write(ranked(rows, False), "windows")
    out = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    out_kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    return each_block(marked((SAMPLE, first), (WINDOWS, second)), results, out, out_kinds, schema)
