"""Ranked lexical search by norm buckets: the documents that score highest for each query.

A document is a vector of impacts over the queries' terms, a score an inner product. The
square root of a term's weight goes to either side, so that rare terms make vectors long.
Documents are ordered by length and cut into buckets of similar length. With the score a
query already has at the last rank as threshold:

* a bucket whose longest vector cannot reach it (Cauchy-Schwarz) is skipped, and so are
  all shorter ones of the task;
* inside a bucket the query's heaviest coordinates are taken from an inverted index of the
  bucket, and Cauchy-Schwarz over the rest bounds every document;
* what survives is scored again over all terms, in 64-bit integers.

The longest documents are searched first; what they give starts the thresholds of the rest.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.llm.common import map_batches
from tablesync.session import Scratch

TOP = 20
# Fixed values of the score: scale of weights, saturation and length normalisation.
WEIGHT_SCALE, IMPACT_SCALE, TIMES, LENGTH_TIMES = 1000, 1_000_000_000, 1000, 12
FLAT, BY_LENGTH = 75, 25
# Queries whose terms are held at once, in bytes of their texts.
QUERY_BYTES = 1 << 20
# Documents of a bucket inside a task, and coordinates that bound a document.
BUCKET = 1024
FOCUS = 4
# Share of the documents, the longest ones, that is searched first.
FIRST_SHARE = 1 / 64
# Documents searched by one task.
DOCUMENTS_PER_TASK = 1 << 14
# Room for rounding in the bounds, which are floats.
SLACK = 1 + 1e-9
PIECE = 1 << 20

SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
# separators become spaces; the capital letters of ASCII are not among them
FOLDED = bytes.maketrans(
    bytes(b for b in SEPARATORS if b not in UPPER) + UPPER,
    b" " * sum(b not in UPPER for b in SEPARATORS) + LOWER,
)


def pieces_of_terms(text: bytes) -> Iterator[list[bytes]]:
    """All terms of a text, some at a time."""
    folded = text.translate(FOLDED)
    start = 0
    while start < len(folded):
        stop = folded.find(b" ", start + PIECE)
        stop = len(folded) if stop < 0 else stop
        yield folded[start:stop].split()
        start = stop


@dataclass
class Queries:
    """The queries of one block: their terms as numbers of a vocabulary, with repeats."""

    ids: list
    vocabulary: dict[bytes, int]
    terms: list[np.ndarray]
    times: list[np.ndarray]

    @classmethod
    def of(cls, rows: list) -> Queries:
        vocabulary: dict[bytes, int] = {}
        terms, times = [], []
        for row in rows:
            counts: Counter = Counter()
            for piece in pieces_of_terms((row["text"] or "").encode("utf-8", "replace")):
                counts.update(piece)
            terms.append(np.array([vocabulary.setdefault(t, len(vocabulary)) for t in counts], np.int64))
            times.append(np.array(list(counts.values()), np.int64))
        return cls([row["item_id"] for row in rows], vocabulary, terms, times)


def counted(docs: DataFrame, vocabulary: dict[bytes, int], key: str, text: str) -> DataFrame:
    """(doc_id, n, terms, tf): all documents with a term, and how often they have query terms."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = []
        for one in batch.column("text").cast(pa.large_binary()):
            n, counts = 0, Counter()
            for piece in pieces_of_terms(one.as_py() or b""):
                n += len(piece)
                counts.update(map(vocabulary.get, piece))
            counts.pop(None, None)
            terms = sorted(counts)
            found.append((n, np.array(terms, "<u4").tobytes(), np.array([counts[t] for t in terms], "<u4").tobytes()))
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([f[0] for f in found], pa.int64()),
                pa.array([f[1] for f in found], pa.binary()),
                pa.array([f[2] for f in found], pa.binary()),
            ],
            names=["doc_id", "n", "terms", "tf"],
        )

    return map_batches(rows, run, "doc_id bigint, n bigint, terms binary, tf binary", "text").where("n > 0")


def document_frequencies(counts: DataFrame, size: int) -> np.ndarray:
    """In how many documents each query term occurs; bounded by the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(size, np.int64)
        for batch in batches:
            for terms in batch.column("terms").to_pylist():
                seen[np.frombuffer(terms, "<u4")] += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], names=["term", "n"])

    parts = counts.select("terms").mapInArrow(run, "term bigint, n bigint")
    frequency = np.zeros(size, np.int64)
    for row in parts.groupBy("term").agg(F.sum("n").alias("n")).collect():
        frequency[row["term"]] = row["n"]
    return frequency


def weights_of(frequency: np.ndarray, documents: int) -> np.ndarray:
    ratios = [(2 * documents + 2) / (2 * int(df) + 1) for df in frequency]
    return np.array([math.floor(WEIGHT_SCALE * math.log(r)) for r in ratios], np.int64)


def impacts(counts: DataFrame, weights: np.ndarray, documents: int, total: int) -> DataFrame:
    """(doc_id, length, terms, impact): vectors of the documents that have query terms."""
    root = np.sqrt(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, lengths = [], []
            columns = (batch.column(c).to_pylist() for c in ("n", "terms", "tf"))
            for n, terms, tf in zip(*columns):
                times = np.frombuffer(tf, "<u4").astype(np.int64)
                norm = FLAT + BY_LENGTH * n * documents // total
                impact = IMPACT_SCALE * times // (TIMES * times + LENGTH_TIMES * norm)
                vector = root[np.frombuffer(terms, "<u4")] * impact
                made.append(impact.astype("<u4").tobytes())
                lengths.append(float(np.sqrt(vector @ vector)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lengths, pa.float64()), batch.column("terms"), pa.array(made, pa.binary())],
                names=["doc_id", "length", "terms", "impact"],
            )

    rows = counts.where(F.octet_length("terms") > 0)
    return rows.mapInArrow(run, "doc_id bigint, length double, terms binary, impact binary").where("length > 0")


class Bucket:
    """Documents of similar length as an inverted index: for each term, documents and impacts."""

    def __init__(self, rows: list[dict], root: np.ndarray) -> None:
        term = np.concatenate([np.frombuffer(r["terms"], "<u4") for r in rows]).astype(np.int64)
        impact = np.concatenate([np.frombuffer(r["impact"], "<u4") for r in rows]).astype(np.int64)
        doc = np.repeat(np.arange(len(rows)), [len(r["terms"]) // 4 for r in rows])
        order = np.argsort(term, kind="stable")
        self.term, self.impact, self.doc = term[order], impact[order], doc[order]
        self.part = root[self.term] * self.impact
        self.length = np.array([r["length"] for r in rows])
        self.no_id = np.array([r["doc_id"] is None for r in rows])
        self.ids = np.array([r["doc_id"] or 0 for r in rows], np.int64)

    def column(self, term: int) -> slice:
        return slice(*np.searchsorted(self.term, (term, term + 1)))

    def survivors(self, query: Query, least: float) -> np.ndarray:
        """Documents whose bound over the query's heaviest coordinates reaches a score."""
        known = np.zeros(len(self.ids))
        taken = np.zeros(len(self.ids))
        for term, size in zip(query.terms[:FOCUS], query.parts[:FOCUS]):
            at = self.column(term)
            known[self.doc[at]] += size * self.part[at]
            taken[self.doc[at]] += self.part[at] ** 2
        rest = np.sqrt(np.maximum(self.length**2 * SLACK - taken, 0))
        bound = (known + query.rest * rest) * SLACK
        return np.flatnonzero((bound >= least) & (bound > 0))

    def scores(self, query: Query, docs: np.ndarray) -> np.ndarray:
        """Exact scores of some documents, in integers."""
        place = np.full(len(self.ids), -1)
        place[docs] = np.arange(len(docs))
        found = np.zeros(len(docs), np.int64)
        for term, weight in zip(query.terms, query.weights):
            at = self.column(term)
            where = place[self.doc[at]]
            here = where >= 0
            found[where[here]] += weight * self.impact[at][here]
        return found


@dataclass
class Query:
    """Terms by falling weight, their integer weights and parts of the norm."""

    terms: np.ndarray
    weights: np.ndarray
    parts: np.ndarray

    def __post_init__(self) -> None:
        order = np.argsort(-self.parts, kind="stable")
        self.terms, self.weights, self.parts = (x[order] for x in (self.terms, self.weights, self.parts))
        self.norm = float(np.sqrt(self.parts @ self.parts))
        self.rest = float(np.sqrt(self.parts[FOCUS:] @ self.parts[FOCUS:]))


class Best:
    """The best documents found for one query: scores, ids, whether an id is missing."""

    def __init__(self, least: int) -> None:
        self.rows = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))
        self.least = least

    def add(self, *more: np.ndarray) -> None:
        rows = [np.concatenate(x) for x in zip(self.rows, more)]
        order = np.lexsort((rows[1], rows[2], -rows[0]))[:TOP]
        self.rows = tuple(x[order] for x in rows)
        if len(order) == TOP:
            self.least = max(self.least, int(self.rows[0][-1]))


def searched(vectors: DataFrame, queries: list[Query], root: np.ndarray, least: list[int]) -> DataFrame:
    """(query, doc_id, score): per task, which has documents by falling length, the best ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(x) for x in least]
        going = list(range(len(queries)))
        waiting: list[dict] = []
        for batch in batches:
            waiting += batch.to_pylist()
            while len(waiting) >= BUCKET:
                going = look(waiting[:BUCKET], best, going)
                del waiting[:BUCKET]
        if waiting:
            look(waiting, best, going)
        for q, found in enumerate(best):
            scores, ids, no_id = found.rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), q)), pa.array(ids, mask=no_id), pa.array(scores)],
                names=["query", "doc_id", "score"],
            )

    def look(rows: list[dict], best: list[Best], going: list[int]) -> list[int]:
        longest = rows[0]["length"]
        going = [q for q in going if queries[q].norm * longest * SLACK >= max(best[q].least, 1)]
        bucket = Bucket(rows, root) if going else None
        for q in going:
            docs = bucket.survivors(queries[q], best[q].least)
            if len(docs):
                scores = bucket.scores(queries[q], docs)
                good = scores >= max(best[q].least, 1)
                best[q].add(scores[good], bucket.ids[docs[good]], bucket.no_id[docs[good]])
        return going

    return vectors.mapInArrow(run, "query bigint, doc_id bigint, score bigint")


def by_length(vectors: DataFrame) -> DataFrame:
    """Ranges of falling length; equal lengths are cut by document."""
    tasks = max(1, -(-vectors.count() // DOCUMENTS_PER_TASK))
    order = [F.desc("length"), F.xxhash64("doc_id", "impact")]
    return vectors.repartitionByRange(tasks, *order).sortWithinPartitions(*order)


def ranked(found: DataFrame) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)


def search(
    docs: DataFrame,
    items: DataFrame,
    scratch: Scratch,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): the TOP highest scores above 0 of each item.

    Equal scores go by ascending key, rows without a key last. NULL and empty texts have no
    terms: such items return nothing, such documents count for nothing. Repeated documents
    rank each; each repeated item has a ranking of its own. Empty tables give an empty
    result; other columns are not read. Statistics cover all documents. Items are searched
    in blocks of about QUERY_BYTES of text, whose terms go to every task.
    """
    spark = docs.sparkSession
    wanted = items.select(F.col(item).alias("item_id"), F.col(item_text).cast("string").alias("text"))
    kind = T.StructType([T.StructField("query", T.LongType()), T.StructField("item_id", wanted.schema["item_id"].dataType)])
    size = wanted.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // QUERY_BYTES))
    result = None
    for block in range(blocks):
        mine = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block
        queries = Queries.of(wanted.where(mine).collect())
        numbers = spark.createDataFrame(list(enumerate(queries.ids)), kind)
        best = best_documents(docs, queries, scratch, key, text).join(numbers, "query")
        best = best.select("item_id", "rank", "doc_id", "score")
        result = best if result is None else result.unionByName(best)
    return result


def best_documents(docs: DataFrame, queries: Queries, scratch: Scratch, key: str, text: str) -> DataFrame:
    """(query, rank, doc_id, score) of one block of queries."""
    counts = scratch.write(counted(docs, queries.vocabulary, key, text), "counts")
    documents, total = counts.agg(F.count("*"), F.sum("n")).first()
    weights = weights_of(document_frequencies(counts, len(queries.vocabulary)), documents)
    root = np.sqrt(weights)
    prepared = [Query(t, weights[t] * n, root[t] * n) for t, n in zip(queries.terms, queries.times)]
    vectors = scratch.write(impacts(counts, weights, documents, total), "impacts")
    edge = vectors.agg(F.percentile_approx("length", F.lit(1 - FIRST_SHARE), F.lit(1000))).first()[0]
    edge = 0.0 if edge is None else edge
    first = searched(by_length(vectors.where(F.col("length") >= edge)), prepared, root, [0] * len(prepared))
    first = scratch.write(ranked(first).drop("rank"), "first")
    full = first.groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    least = [0] * len(prepared)
    for row in full.where(F.col("n") == TOP).collect():  # a row a query at most
        least[row["query"]] = row["least"]
    rest = searched(by_length(vectors.where(F.col("length") < edge)), prepared, root, least)
    return ranked(first.unionByName(rest))
