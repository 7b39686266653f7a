"""Toxicity by a linear classifier over character n-grams scaled by log-count ratios.

A text is the set of its hashed byte 4- to 7-grams, in lower case. The naive Bayes
log-count ratio of every n-gram and a logistic regression over the scaled features are
fitted to bounded samples of the labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm import labelled
from tablesync.llm.common import cut_batch, texts_of

BITS = 20
SIZES = (4, 5, 6, 7)
BUCKETS = 1 << BITS
SMOOTHING = 1.0
# A ratio counts if it is so many standard errors from zero.
LEAST_ERRORS = 3.0
# Bounds of the fit: labelled rows of each label that are counted, and those of them that
# the regression sees. Their keys are broadcast, so that no texts are shuffled.
COUNTED_PER_LABEL = 20_000
PER_LABEL = 2000
PENALTY = 1e-3
STEPS = 100
RATE = 0.05
SLICE = 1 << 20
ACCEPTED = 0.7
MODULUS, HELD_OUT = 3, 1


def ngrams(text: str, wanted: np.ndarray | None = None) -> np.ndarray:
    """Distinct hashed n-grams of a whole text, ascending; only ``wanted`` buckets, if given."""
    raw = np.frombuffer(text.encode("utf-8", "replace").lower(), np.uint8)
    shift, by = np.uint32(32 - BITS), np.uint32(2654435761)
    parts = [np.zeros(0, np.uint32)]
    for at in range(0, max(len(raw) - SIZES[0] + 1, 0), SLICE):
        b = raw[at : at + SLICE + SIZES[-1] - 1].astype(np.uint32)
        code = b[:-3] | b[1:-2] << 8 | b[2:-1] << 16 | b[3:] << 24
        hashed = [code * by]
        for size in SIZES[1:]:
            code = (code[:-1] ^ (code[:-1] >> 15)) * np.uint32(0x2C1B3C6D) + b[size - 1 :] * np.uint32(0x297A2D39)
            hashed.append((code ^ (code >> 12)) * by)
        found = np.concatenate(hashed) >> shift
        parts.append(np.unique(found if wanted is None else found[wanted[found]]))
    return np.unique(np.concatenate(parts)).astype(np.int32) if len(parts) > 2 else parts[-1].astype(np.int32)


@dataclass
class Linear:
    """A weight per bucket and an intercept."""

    weights: np.ndarray
    intercept: float

    def score(self, texts: list[str]) -> np.ndarray:
        wanted = self.weights != 0
        margins = [self.weights[ngrams(t, wanted)].sum(dtype=np.float64) for t in texts]
        return 1 / (1 + np.exp(-np.clip(np.array(margins) + self.intercept, -500, 500)))


def log_count_ratio(positive: np.ndarray, negative: np.ndarray) -> np.ndarray:
    p, q = positive + SMOOTHING, negative + SMOOTHING
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    ratio[np.abs(ratio) < LEAST_ERRORS * np.sqrt(1 / p + 1 / q)] = 0
    return ratio.astype(np.float32)


def fit_linear(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, prior: float) -> Linear:
    """Logistic regression over ratio-scaled indicators, by adaptive gradient steps.

    ``rows`` hold n-grams whose ratio is not zero.
    Rows are weighted so that the classes' odds lie halfway between those among all
    labelled rows and even ones: rare positives are not given up for certainty.
    """
    odds = np.sqrt(prior / (1 - prior))
    prior = odds / (1 + odds)
    counts = np.array([len(row) for row in rows])
    used, at = np.unique(np.concatenate(rows), return_inverse=True)
    scale = ratio[used].astype(np.float64)
    row_of = np.repeat(np.arange(len(rows)), counts)
    share = labels.mean()
    importance = np.where(labels == 1, prior / share, (1 - prior) / (1 - share)) / len(labels)

    def margins(weights: np.ndarray) -> np.ndarray:
        return np.bincount(row_of, (weights * scale)[at], minlength=len(rows))

    weights = np.zeros(len(used) + 1)
    weights[-1] = np.log(prior / (1 - prior))
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for i in range(1, STEPS + 1):
        margin = np.clip(margins(weights[:-1]) + weights[-1], -500, 500)
        error = (1 / (1 + np.exp(-margin)) - labels) * importance
        gradient = np.append(np.bincount(at, error[row_of], minlength=len(used)) * scale, error.sum())
        gradient[:-1] += PENALTY * weights[:-1]
        # steps of each weight's own size: common and rare n-grams are learned alike
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        size = RATE * (1 - (i - 1) / STEPS)
        weights = weights - size * (mean / (1 - 0.9**i)) / (np.sqrt(square / (1 - 0.99**i)) + 1e-9)
    full = np.zeros(BUCKETS, np.float32)
    full[used] = weights[:-1] * scale
    return Linear(full, float(weights[-1]))


def gram_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """In how many labelled documents of label 1 and of label 0 each bucket occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BUCKETS), np.int32)
        for batch in batches:
            for part in cut_batch(batch, "text"):
                for text, label in zip(texts_of(part, "text"), part.column("label").to_pylist()):
                    total[label][ngrams(text)] += 1
        at = np.flatnonzero(total.any(axis=0))
        for low in range(0, len(at), 1 << 16):
            some = at[low : low + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some.astype(np.int32)), *(pa.array(total[c][some]) for c in (0, 1))],
                names=["bucket", "n0", "n1"],
            )

    parts = rows.select("label", "text").mapInArrow(count, "bucket int, n0 int, n1 int")
    table = parts.groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow()
    made = np.zeros((2, BUCKETS), np.int64)
    for c, name in enumerate(("n0", "n1")):
        made[c][table["bucket"].to_numpy()] = table[name].to_numpy()
    return made[1], made[0]


def _sample_ngrams(rows: DataFrame, wanted: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The n-grams with a say, of each text of the bounded sample, and its label; ordered by key."""

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in cut_batch(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("label"),
                        pa.array([ngrams(t, wanted).tobytes() for t in texts_of(part, "text")], pa.binary()),
                    ],
                    names=["doc_id", "label", "grams"],
                )

    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.select("doc_id", "label", "text").mapInArrow(
        grams, f"doc_id {kind}, label int, grams binary"
    )
    table = found.toArrow().sort_by([(name, "ascending") for name in ("doc_id", "label", "grams")])
    return [np.frombuffer(g, np.int32) for g in table["grams"].to_pylist()], table["label"].to_numpy()


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Linear:
    """Learn from labelled rows that are not held out.

    Counts are bounded by COUNTED_PER_LABEL, the regression by PER_LABEL; the share of
    label 1 comes from all rows. With one label only, or none, every score is that share,
    smoothed.
    """
    teaching = labelled.teaching_rows(docs, labels, "toxic", MODULUS, HELD_OUT, key)
    by_label = dict(teaching.groupBy("label").count().collect())
    prior = (by_label.get(1, 0) + 1) / (sum(by_label.values()) + 2)
    if len(by_label) < 2:
        return Linear(np.zeros(BUCKETS, np.float32), float(np.log(prior / (1 - prior))))
    counted = F.broadcast(labelled.sample(teaching, COUNTED_PER_LABEL))
    ratio = log_count_ratio(*gram_counts(labelled.with_texts(counted, docs, key, text)))
    chosen = F.broadcast(labelled.sample(teaching, PER_LABEL))
    rows, known = _sample_ngrams(labelled.with_texts(chosen, docs, key, text), ratio != 0)
    return fit_linear(rows, known, ratio, prior)


def score_column(model: Linear, text: Column) -> Column:
    """Score of a whole text, 0 to 1, higher where label 1 is likelier.

    NULL reads as empty; texts of fewer than four bytes get the intercept's score.
    """
    shared = model

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
