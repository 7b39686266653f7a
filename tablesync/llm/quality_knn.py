"""Document quality by votes of the nearest labelled documents.

Texts become vectors of hashed byte trigrams and of words that repeat the word before
them (log counts, weighted by inverse document frequency over all documents), which a truncated singular value decomposition of a
labelled sample maps to a small latent space. Labelled vectors, a bounded number of
them, go to every task; each document is compared with all of them in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm import labelled
from tablesync.llm.common import cut_batch, texts_of

TRIGRAMS = 4096
# the last bucket counts repeats of a word, in the scale of REPEAT trigrams each
BUCKETS = TRIGRAMS + 1
REPEAT = 4.0
LATENT = 64
# Bound of the fit: labelled rows of each label whose vectors are broadcast (48 floats each).
PER_LABEL = 1500
NEIGHBOURS = 25
POWER = 8
# The prior votes like as many neighbours at this cosine: texts near no one stay close to it.
PRIOR_COSINE = 0.6
BLOCK = 256
SLICE = 1 << 20
ACCEPTED = 0.7
MODULUS, HELD_OUT = 4, 2


def term_counts(text: str) -> np.ndarray:
    """Counts of hashed byte trigrams and of immediate repeats, over a whole text."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    total = np.zeros(BUCKETS, np.float32)
    for at in range(0, max(len(raw) - 2, 0), SLICE):
        b = raw[at : at + SLICE + 2].astype(np.uint32)
        code = (b[:-2] | b[1:-1] << 8 | b[2:] << 16) * np.uint32(2654435761)
        total[:TRIGRAMS] += np.bincount(code >> np.uint32(20), minlength=TRIGRAMS)
    words = text.split()
    total[TRIGRAMS] = sum(map(eq, words, islice(words, 1, None)))
    return total


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    rows = np.log1p(counts) * idf
    rows[:, TRIGRAMS] *= REPEAT
    return _unit(rows)


def features(texts: list[str], idf: np.ndarray) -> np.ndarray:
    return weighted(np.stack([term_counts(t) for t in texts]), idf)


def _unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norm > 0, norm, 1)


@dataclass
class Voters:
    """What scoring needs; its size depends on the parameters alone."""

    idf: np.ndarray
    to_latent: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    # a labelled vector stands for so many labelled rows of its label
    stands_for: np.ndarray
    prior: float

    def latent(self, texts: list[str]) -> np.ndarray:
        return _unit(features(texts, self.idf) @ self.to_latent)

    def score(self, texts: list[str]) -> np.ndarray:
        """Share of the neighbours' weight that has label 1; the prior where none is near."""
        scores = np.full(len(texts), self.prior)
        if not len(self.labels):
            return scores
        k = min(NEIGHBOURS, len(self.labels))
        for at in range(0, len(texts), BLOCK):
            cosine = self.latent(texts[at : at + BLOCK]) @ self.vectors.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(np.float64) ** POWER
            weight *= self.stands_for[near]
            own = k * PRIOR_COSINE**POWER * self.stands_for.mean()
            vote = (weight * self.labels[near]).sum(axis=1) + own * self.prior
            scores[at : at + BLOCK] = np.clip(vote / (weight.sum(axis=1) + own), 0, 1)
        return scores


def fit_latent(rows: np.ndarray, size: int = LATENT) -> np.ndarray:
    """Right singular vectors of the sample, by a randomised range finder."""
    size = min(size, *rows.shape)
    start = np.random.default_rng(7).standard_normal((rows.shape[1], min(size + 10, rows.shape[1])))
    basis = rows @ start.astype(rows.dtype)
    for _ in range(3):
        basis, _ = np.linalg.qr(rows @ (rows.T @ basis))
    _, _, right = np.linalg.svd(basis.T @ rows, full_matrices=False)
    return np.ascontiguousarray(right[:size].T)


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, int]:
    """In how many of all documents each bucket occurs, and how many documents there are."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for part in cut_batch(batch, "text"):
                for whole in texts_of(part, "text"):
                    seen += term_counts(whole) > 0
                    rows += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, BUCKETS)), pa.array(np.concatenate([[rows], seen]))],
            names=["bucket", "n"],
        )

    parts = docs.select(F.col(text).alias("text")).mapInArrow(count, "bucket bigint, n bigint")
    table = parts.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas().set_index("bucket")["n"]
    counts = table.reindex(np.arange(-1, BUCKETS), fill_value=0).to_numpy()
    return counts[1:], int(counts[0])


def _sample_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Term counts and labels of the bounded sample, ordered by key."""

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [term_counts(t) for t in texts_of(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("label"),
                    pa.array([np.flatnonzero(c).astype("<u2").tobytes() for c in counts], pa.binary()),
                    pa.array([c[c > 0].astype("<f4").tobytes() for c in counts], pa.binary()),
                ],
                names=["doc_id", "label", "at", "n"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.select("doc_id", "label", "text").mapInArrow(
        sparse, f"doc_id {kind}, label int, at binary, n binary"
    )
    table = found.toPandas().sort_values(["doc_id", "label", "n"], kind="stable")
    dense = np.zeros((len(table), BUCKETS), np.float32)
    for row, at, n in zip(dense, table["at"], table["n"]):
        row[np.frombuffer(at, "<u2")] = np.frombuffer(n, "<f4")
    return dense, table["label"].to_numpy()


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Voters:
    """Learn from labelled rows that are not held out.

    The sample is bounded by PER_LABEL; document frequencies and the prior come from all
    rows. Without labelled rows every score is the prior 0.5.
    """
    teaching = labelled.teaching_rows(docs, labels, "quality", MODULUS, HELD_OUT, key)
    by_label = dict(teaching.groupBy("label").count().collect())
    total = sum(by_label.values())
    prior = by_label.get(1, 0) / total if total else 0.5
    seen, rows = document_frequencies(docs, text)
    idf = (np.log((1 + rows) / (1 + seen)) + 0.1).astype(np.float32)
    chosen = F.broadcast(labelled.sample(teaching, PER_LABEL))
    counts, known = _sample_counts(labelled.with_texts(chosen, docs, key, text))
    if not len(known):
        none = np.zeros((0, 1), np.float32)
        return Voters(idf, np.zeros((BUCKETS, 1), np.float32), none, known, known, prior)
    sample = weighted(counts, idf)
    to_latent = fit_latent(sample)
    share = {c: by_label.get(c, 0) / max(1, np.sum(known == c)) for c in (0, 1)}
    stands_for = np.array([share[c] for c in known])
    vectors = _unit(sample @ to_latent)
    return Voters(idf, to_latent, vectors, known.astype(np.float64), stands_for, prior)


def score_column(voters: Voters, text: Column) -> Column:
    """Score of a whole text, 0 to 1, higher where label 1 is likelier.

    NULL reads as empty; texts shorter than three bytes are near no one and get the prior.
    """
    shared = voters

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.score(["" if t is None else t for t in texts]))

    return score(text)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row; NULL keys are not held out.

    Repeated rows get equal scores, an empty table no rows; other columns are not read.
    """
    scored = docs.select("doc_id", score_column(fit(docs, labels), F.col("text")).alias("score"))
    return scored.select(
        "doc_id",
        labelled.held_out_column(MODULUS, HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPTED).cast("int").alias("predicted"),
    )


def keep_accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    return docs.where(score_column(fit(docs, labels), F.col("text")) >= ACCEPTED)
