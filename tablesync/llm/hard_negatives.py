"""Hard negatives by lists that anchors of one direction share, walked to a certified end.

Anchors are clustered by direction. For a cluster and a block of candidates, every
candidate has one bound on its inner product with any member: its length times the cosine
of its angle to the cluster's centre, less the cluster's widest angle. Candidates are sorted
by it once; the members walk that list together, and each leaves when the bound of what
follows cannot reach the score it still needs. Scores are integers.

Positives are found first; they say which scores of other labels count as hard.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablesync.session import Scratch

SCALE = 256
# Larger components count as this, so that scores of up to 2,048 components fit 64 bits.
LARGEST = 1 << 26
POSITIVES = NEGATIVES = 5
# A negative is hard from this share of the positive's score on, in hundredths.
LEAST_SHARE = 80
# Candidates of a block, and those scored at a time while walking a list.
BLOCK = 4096
STEP = 256
# Anchors whose directions fit the centres, and the number of centres.
FITTED = 1024
CENTRES = 32
# Members of a cluster that walk together.
TOGETHER = 64


def usable(vector: Column) -> Column:
    """Not NULL, and every component a finite number."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return F.coalesce(finite, F.lit(False))


def quantised(vector: Column, scale: int = SCALE) -> Column:
    limit = F.lit(LARGEST)
    return F.transform(
        vector, lambda x: F.least(F.greatest(F.floor(x.cast("double") * scale), -limit), limit).cast("int")
    )


def unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norm > 0, norm, 1)


def inner(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact integer inner products; floats serve where no sum can lose a unit."""
    if left.size and right.size and left.shape[1] * int(np.abs(left).max()) * int(np.abs(right).max()) >= 1 << 53:
        return left.astype(np.int64) @ right.astype(np.int64).T
    return (left.astype(np.float64) @ right.astype(np.float64).T).astype(np.int64)


def fit_centres(anchors: DataFrame) -> dict[int, np.ndarray]:
    """Directions of a bounded sample of anchors, per number of components."""
    sample = anchors.orderBy(F.xxhash64("node")).limit(FITTED).select("vector").collect()
    centres = {}
    for dim in {len(r["vector"]) for r in sample} - {0}:
        points = unit(np.array([r["vector"] for r in sample if len(r["vector"]) == dim], float))
        found = points[: max(1, min(CENTRES, len(points) // 8))].copy()
        for _ in range(5):
            nearest = np.argmax(points @ found.T, axis=1)
            for c in range(len(found)):
                if (nearest == c).any():
                    found[c] = points[nearest == c].sum(axis=0)
            found = unit(found)
        centres[dim] = found
    return centres


def centre_of(centres: dict[int, np.ndarray], dim: int) -> np.ndarray:
    return centres[dim] if dim in centres else np.eye(1, max(dim, 1))[:, :dim]


def angles(vectors: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit(vectors.astype(float)) @ centre, -1, 1))


def clustered(anchors: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """Anchors with their cluster and their angle to its centre."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, angle = [], []
            for vector in batch.column("vector").to_pylist():
                v = np.array([vector], float)
                near = centre_of(centres, len(vector))
                best = int(np.argmax(unit(v) @ near.T))
                cluster.append(best)
                angle.append(float(angles(v, near[best])[0]) if v.any() else 0.0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cluster, pa.int32()), pa.array(angle, pa.float64())],
                names=[*batch.schema.names, "cluster", "angle"],
            )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in anchors.schema.fields)
    return anchors.mapInArrow(run, f"{kinds}, cluster int, angle double")


@dataclass
class Candidates:
    """A block of rows with vectors of one length, and its lists, one per cluster."""

    node: np.ndarray
    ids: np.ndarray
    label: np.ndarray
    vector: np.ndarray

    @classmethod
    def of(cls, table: pa.Table) -> Candidates:
        label = np.array(table.column("label").to_pylist(), object)
        return cls(*(table.column(c).to_numpy() for c in ("node", "vec_id")), label, matrix(table.column("vector")))

    def listed(self, centre: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
        """Rows by falling bound on their inner product with a unit vector of the cluster."""
        norm = np.linalg.norm(self.vector.astype(float), axis=1)
        away = np.maximum(0, angles(self.vector, centre) - radius)
        # room for rounding, so that no bound lies below a product
        bound = norm * np.cos(away) + 1e-6 * norm
        order = np.argsort(-bound, kind="stable")
        return order, bound[order]


def matrix(column) -> np.ndarray:
    """Vectors of one length as rows."""
    chunk = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = len(chunk.slice(0, 1).flatten()) if len(chunk) else 0
    return chunk.flatten().to_numpy().reshape(len(chunk), size).astype(np.int64)


class Top:
    """The best rows of a range of scores: highest first, ties by the smaller id."""

    def __init__(self, size: int, low: int | None = None, high: int | None = None) -> None:
        self.size, self.low, self.high = size, low, high
        self.scores = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int64)

    @property
    def needed(self) -> float:
        """The least score that still counts."""
        if len(self.scores) == self.size:
            return int(self.scores[-1])
        return -np.inf if self.low is None else self.low

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.needed
        if self.high is not None:
            good &= scores <= self.high
        if good.any():
            scores = np.concatenate([self.scores, scores[good]])
            ids = np.concatenate([self.ids, ids[good]])
            best = np.lexsort((ids, -scores))[: self.size]
            self.scores, self.ids = scores[best], ids[best]


def wanted(anchor: dict) -> list[Top]:
    """What an anchor looks for: its positives, or hard negatives for each of them."""
    if anchor["positives"] is None:
        return [Top(POSITIVES)]
    # 100 * score must reach LEAST_SHARE * positive
    return [Top(NEGATIVES, -(-LEAST_SHARE * p["score"] // 100), p["score"]) for p in anchor["positives"]]


def walk(members: list[dict], block: Candidates, order: np.ndarray, bound: np.ndarray) -> list[list[Top]]:
    """What the members find in a block, along the list of their cluster."""
    vectors = np.array([m["vector"] for m in members], np.int64).reshape(len(members), block.vector.shape[1])
    norm = np.linalg.norm(vectors.astype(float), axis=1)
    found = [wanted(m) for m in members]
    going = [i for i in range(len(members)) if found[i]]
    for at in range(0, len(order), STEP):
        going = [i for i in going if norm[i] * bound[at] >= min(t.needed for t in found[i])]
        if not going:
            break
        rows = order[at : at + STEP]
        scores = inner(vectors[going], block.vector[rows])
        for i, line in zip(going, scores):
            same = block.label[rows] == members[i]["label"]
            fits = same & (block.node[rows] != members[i]["node"]) if members[i]["positives"] is None else ~same
            fits &= line >= min(t.needed for t in found[i])
            if fits.any():
                for top in found[i]:
                    top.add(line[fits], block.ids[rows][fits])
    return found


def against_blocks(
    anchors: DataFrame, rows: DataFrame, blocks: int, centres: dict[int, np.ndarray], radius: dict[tuple, float]
) -> DataFrame:
    """(node, positive, score, vec_id): the best rows of every block for each anchor.

    Anchors go to every block, sorted behind its rows, so a task holds one block and as
    many anchors as walk together.
    """
    columns = ["block", "dim", "node", "vec_id", "label", "vector", "cluster", "positives"]
    kind = anchors.schema["positives"].dataType.simpleString()
    block = F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int")
    rows = rows.withColumns({"block": block, "cluster": F.lit(-1), "positives": F.lit(None).cast(kind)})
    anchors = anchors.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    both = rows.select(*columns).unionByName(anchors.select(*columns))
    dealt = both.repartition(blocks, "block", "dim").sortWithinPartitions("block", "dim", "cluster", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held, candidates = None, [], None
        listed: tuple = (None, None, None)
        for batch in batches:
            key = [batch.column(c).to_numpy() for c in ("block", "dim", "cluster")]
            edges = np.flatnonzero(np.any([np.diff(k, prepend=k[0] - 1) != 0 for k in key], axis=0))
            for a, b in zip(edges, [*edges[1:], batch.num_rows]):
                here, cluster = (int(key[0][a]), int(key[1][a])), int(key[2][a])
                part = pa.Table.from_batches([batch.slice(a, b - a)])
                if here != place:
                    place, held, candidates, listed = here, [], None, (None, None, None)
                if cluster < 0:
                    held.append(part)
                    continue
                if not held:
                    continue  # nothing in this block has vectors of this length
                candidates = candidates or Candidates.of(pa.concat_tables(held))
                if listed[0] != cluster:
                    centre = centre_of(centres, here[1])[cluster]
                    listed = (cluster, *candidates.listed(centre, radius[here[1], cluster]))
                members = part.to_pylist()
                for i in range(0, len(members), TOGETHER):
                    some = members[i : i + TOGETHER]
                    yield told(some, walk(some, candidates, *listed[1:]))

    return dealt.mapInArrow(run, "node bigint, positive int, score bigint, vec_id bigint")


def told(members: list[dict], found: list[list[Top]]) -> pa.RecordBatch:
    tops = [(m["node"], n, top) for m, own in zip(members, found) for n, top in enumerate(own)]
    size = [len(top.ids) for _, _, top in tops]
    none = np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.repeat(np.array([t[0] for t in tops], np.int64), size)),
            pa.array(np.repeat(np.array([t[1] for t in tops], np.int32), size)),
            pa.array(np.concatenate([none, *(t[2].scores for t in tops)])),
            pa.array(np.concatenate([none, *(t[2].ids for t in tops)])),
        ],
        names=["node", "positive", "score", "vec_id"],
    )


def first_rows(found: DataFrame, group: list[str], size: int) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


def hard_negatives(
    df: DataFrame,
    is_anchor: Column,
    scratch: Scratch,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components count as floor(SCALE * x). An anchor's positives are its POSITIVES
    highest-scoring other rows of its label, its negatives for one of them the NEGATIVES
    highest-scoring rows of other labels from LEAST_SHARE hundredths of the positive's score
    to that score itself; ties go by the smaller key. Fewer are returned where there are no
    more.

    Rows with a NULL key, label or vector, or a component that is NULL or not finite, take
    no part, nor does ``is_anchor`` hold where it is NULL. Vectors of other lengths are
    never compared; empty ones score 0 with each other. Repeated rows are rows of their own,
    so a copy of an anchor is its positive. An empty table gives an empty result; other
    columns are not read.
    """
    rows = df.where(F.col(key).isNotNull() & F.col(label).isNotNull() & usable(F.col(vector))).select(
        F.col(key).cast("long").alias("vec_id"),
        F.col(label).cast("string").alias("label"),
        quantised(F.col(vector)).alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    )
    rows = scratch.write(rows.withColumn("node", F.monotonically_increasing_id()), "vectors")
    rows = rows.withColumn("dim", F.size("vector"))
    blocks = max(1, -(-rows.count() // BLOCK))
    anchors = rows.where("anchor").drop("anchor")
    centres = fit_centres(anchors)
    anchors = scratch.write(clustered(anchors, centres), "anchors")
    widest = anchors.groupBy("dim", "cluster").agg(F.max("angle").alias("angle"))  # a row a centre
    radius = {(r["dim"], r["cluster"]): r["angle"] for r in widest.collect()}
    rows = rows.drop("anchor")

    kind = "array<struct<positive:int,score:bigint,vec_id:bigint>>"
    search = anchors.withColumn("positives", F.lit(None).cast(kind))
    found = first_rows(against_blocks(search, rows, blocks, centres, radius), ["node"], POSITIVES)
    found = found.withColumn("positive", (F.col("rank") - 1).cast("int"))
    positives = found.groupBy("node").agg(
        F.array_sort(F.collect_list(F.struct("positive", "score", "vec_id"))).alias("positives")
    )
    search = scratch.write(anchors.join(positives, "node"), "positives")  # POSITIVES an anchor
    found = against_blocks(search, rows, blocks, centres, radius)
    found = first_rows(found, ["node", "positive"], NEGATIVES)
    named = search.select("node", F.col("vec_id").alias("anchor_id"), F.explode("positives").alias("p"))
    named = named.select(
        "node",
        "anchor_id",
        F.col("p.positive").alias("positive"),
        F.col("p.vec_id").alias("positive_id"),
        F.col("p.score").alias("positive_score"),
    )
    return named.join(found, ["node", "positive"]).select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
