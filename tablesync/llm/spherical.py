"""Near-duplicate vectors by spherical-cap filters of random product codes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import worker_cache
from tablesync.llm.components import components
from tablesync.session import Scratch

COSINE = 0.93
# Each code's filters are all sums of one code word from each half of a rotated vector, so
# there are as many as the square of the words. Several codes even out how many filters a
# vector has.
CODES = 8
# Words and filters of a vector for labels of up to so many vectors. For larger ones words
# grow as the rows to the power GROWTH, so that the vectors a filter brings together do not
# become more, and filters as the words to the power MORE, so that recall stays.
BASE_ROWS, CODE_SIZE, FILTERS = 1_000, 256, 32
GROWTH, MORE = 0.75, 0.35
# Words are bounded by what a worker holds; beyond some 40,000 vectors of a label candidates
# grow with the rows again.
MOST_WORDS = 4096
SEED = 11
# Members of one filter that are compared at once; larger groups are cut into blocks.
BLOCK = 1024
ROWS = 512


@dataclass(frozen=True)
class Size:
    """Words of a code's halves, and filters that a random vector has on average."""

    words: int = CODE_SIZE
    filters: int = FILTERS

    @classmethod
    def of(cls, rows: int) -> Size:
        """For the largest number of vectors that share a label."""
        words = min(MOST_WORDS, CODE_SIZE * max(1.0, rows / BASE_ROWS) ** GROWTH)
        return cls(round(words), round(FILTERS * (words / CODE_SIZE) ** MORE))


class Code:
    """Product code of one dimension: a rotation, and unit code words for both halves."""

    def __init__(self, dim: int, number: int, size: Size) -> None:
        random = np.random.default_rng((SEED, dim, number, size.words))
        self.rotation, _ = np.linalg.qr(random.standard_normal((dim, dim)))
        self.half = (dim + 1) // 2
        self.words = []
        for part in (self.half, dim - self.half):
            words = random.standard_normal((size.words, max(part, 1)))
            self.words.append(words / np.linalg.norm(words, axis=1, keepdims=True) / np.sqrt(2))
        self.size = size.words
        self.first_id = number * size.words**2
        some = random.standard_normal((64, dim))
        self.cap = self.cap_for(some / np.linalg.norm(some, axis=1, keepdims=True), size.filters / CODES)

    def cap_for(self, units: np.ndarray, filters: float) -> float:
        """The height that these vectors exceed with so many filters on average."""
        left, right = self.cosines(units)
        right = np.sort(right, axis=1)
        low, high = -2.0, 2.0
        for _ in range(40):
            cap = (low + high) / 2
            above = sum(self.size * self.size - np.searchsorted(r, cap - a).sum() for a, r in zip(left, right))
            low, high = (cap, high) if above > filters * len(units) else (low, cap)
        return high

    def cosines(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        turned = units @ self.rotation
        left = turned[:, : self.half] @ self.words[0].T
        right = turned[:, self.half :] @ self.words[1].T if units.shape[1] > 1 else np.zeros_like(left)
        return left, right

    def decode(self, units: np.ndarray) -> list[np.ndarray]:
        """Every filter whose direction a vector exceeds the cap with, per vector.

        Words of the first half that cannot reach the cap with the best second word are
        left out; the others need a prefix of the second words in falling order.
        """
        left, right = self.cosines(units)
        order = np.argsort(-right, axis=1, kind="stable")
        right = np.take_along_axis(right, order, axis=1)
        found = []
        for a, b, by in zip(left, right, order):
            first = np.flatnonzero(a + b[0] >= self.cap)
            count = np.searchsorted(-b, a[first] - self.cap, side="right")
            start = np.repeat(np.cumsum(count) - count, count)
            second = by[np.arange(len(start)) - start]
            found.append(np.repeat(first, count) * self.size + second + self.first_id)
        return found


def decode(units: np.ndarray, size: Size = Size()) -> list[np.ndarray]:
    """The filters of each vector over all codes, ascending."""
    dim = units.shape[1]
    codes = worker_cache(
        f"codes {SEED} {CODES} {size} {dim}", lambda: [Code(dim, n, size) for n in range(CODES)]
    )
    found = []
    for at in range(0, len(units), ROWS):
        lists = zip(*(code.decode(units[at : at + ROWS]) for code in codes))
        found += [np.sort(np.concatenate(one)) for one in lists]
    return found


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def usable(vector: Column) -> Column:
    """Not NULL, not empty, every component finite, one of them not zero."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.ListArray) -> list[np.ndarray]:
    values, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(ends[:-1], ends[1:])]


def with_filters(nodes: DataFrame, size: Size) -> DataFrame:
    """Nodes with the length of their vector and all filters that it exceeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                vectors = _matrix(batch.column("vector"))
                dims = np.array([len(v) for v in vectors])
                lists = [None] * len(vectors)
                for dim in np.unique(dims):
                    at_dim = np.flatnonzero(dims == dim)
                    found = decode(unit(np.stack([vectors[i] for i in at_dim])), size)
                    for i, one in zip(at_dim, found):
                        lists[i] = one
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(dims, pa.int32()), pa.array(lists, pa.list_(pa.int32()))],
                    names=[*batch.schema.names, "dim", "filters"],
                )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema.fields)
    return nodes.mapInArrow(run, f"{kinds}, dim int, filters array<int>")


def compare(
    filter_id: int,
    left: np.ndarray,
    right: np.ndarray,
    units: np.ndarray,
    nodes: np.ndarray,
    copies: np.ndarray,
    filters: list[np.ndarray],
) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Verified links among the members of one filter, or between two blocks of them.

    Returns (node, smallest node linked to it in here, links) of linked members. A pair
    that shares several filters counts in the smallest one alone.
    """
    linked = units[left] @ units[right].T >= COSINE
    linked &= nodes[left][:, None] != nodes[right][None, :]
    if not linked.any():
        return None
    used = np.unique(np.concatenate([left[linked.any(axis=1)], right[linked.any(axis=0)]]))
    earlier = [filters[i][filters[i] < filter_id] for i in used]
    known, column = np.unique(np.concatenate(earlier), return_inverse=True)
    shared = np.bincount(column, minlength=len(known)) > 1
    where = np.cumsum(shared) - 1
    has = np.zeros((len(units), max(1, int(shared.sum()))), np.float32)
    row = np.repeat(used, [len(f) for f in earlier])
    has[row[shared[column]], where[column[shared[column]]]] = 1
    counted = linked & ~(has[left] @ has[right].T > 0)
    links = np.zeros(len(units), np.int64)
    np.add.at(links, left, counted @ copies[right])
    if left is not right:
        np.add.at(links, right, counted.T @ copies[left])
    root = nodes.copy()
    while True:
        before = root.copy()
        far = np.iinfo(np.int64).max
        from_right = np.where(linked, root[right][None, :], far).min(axis=1)
        np.minimum.at(root, left, from_right)
        from_left = np.where(linked, root[left][:, None], far).min(axis=0)
        np.minimum.at(root, right, from_left)
        if (root == before).all():
            return nodes[used], root[used], links[used]


def verified(members: DataFrame) -> DataFrame:
    """(node, root, links) from members dealt and sorted by filter and pair of blocks."""
    key = ["label", "dim", "filter", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if rest is None else [*rest.to_batches(), batch])
            edges = _edges(table, key)
            yield from groups(table, edges)
            rest = table.slice(edges[-1])
        if rest is not None:
            yield from groups(rest, [0, rest.num_rows])

    def groups(table: pa.Table, edges: list[int]) -> Iterator[pa.RecordBatch]:
        found = []
        if len(edges) > 1:
            table = table.slice(0, edges[-1]).combine_chunks()
            vectors, filters = (_matrix(table.column(c).chunk(0)) for c in ("vector", "filters"))
            nodes, copies, block = (table.column(n).to_numpy() for n in ("node", "copies", "block"))
            ids, i, j = (table.column(n).to_numpy() for n in ("filter", "i", "j"))
            for a, b in zip(edges[:-1], edges[1:]):
                if b - a > 1:
                    side = np.arange(b - a)
                    left, right = (side, side) if i[a] == j[a] else (
                        np.flatnonzero(block[a:b] == i[a]), np.flatnonzero(block[a:b] == j[a])
                    )
                    one = compare(int(ids[a]), left, right, unit(np.stack(vectors[a:b])), nodes[a:b], copies[a:b], filters[a:b])
                    found += [one] if one else []
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([f[k] for f in found])) for k in range(3)],
                names=["node", "root", "links"],
            )

    return members.mapInArrow(run, "node bigint, root bigint, links bigint")


def _edges(table: pa.Table, key: list[str]) -> list[int]:
    """Where groups of the sorted rows begin; the last one may go on in the next batch."""
    changed = np.zeros(table.num_rows, bool)
    changed[0] = True
    for name in key:
        values = table.column(name).to_numpy()
        changed[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(changed).tolist()


def similar_vectors(
    df: DataFrame,
    scratch: Scratch,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row.

    Vectors link when their labels and lengths are equal and their cosine is at least
    COSINE; every link is verified in double precision. Pairs without a filter in common
    are missed (see the README for the measured share). Equal vectors of a label are one
    node and count as linked. Vectors that are NULL, empty, zero or hold NULL or values
    that are not finite, and rows without a label, link with nothing. Rows with a NULL key count
    as others' links; alone, their component is NULL and they are kept. Repeated rows each
    come back; an empty table gives an empty result; other columns are not read.

    A filter's members are compared in blocks of about BLOCK, each pair of blocks a group
    of its own, and leave counts and one link per member, never their pairs.
    """
    rows = df.select(F.col(key).alias("vec_id"), F.col(vector).alias("vector"), F.col(label).alias("label"))
    good = rows.where(F.col("label").isNotNull() & usable(F.col("vector")))
    nodes = good.groupBy("label", "vector").agg(
        F.min("vec_id").alias("class_id"), F.count("*").alias("copies")
    )
    nodes = scratch.write(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    largest = nodes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    nodes = scratch.write(with_filters(nodes, Size.of(largest)), "filters")
    filters = nodes.select("label", "dim", "node", F.explode("filters").alias("filter"))
    same = ["label", "dim", "filter"]
    sizes = filters.groupBy(*same).count().where("count > 1")
    blocks = F.ceil(F.col("count") / BLOCK).cast("int")
    dealt = filters.join(sizes, same).withColumn("blocks", blocks)
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(
        *same, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node"
    )
    # the planner does not see how often a row is dealt, so it must not be broadcast
    members = dealt.hint("merge").join(nodes.select("node", "copies", "vector", "filters"), "node")
    group = [*same, "i", "j"]
    members = members.select(*group, "block", "node", "copies", "vector", "filters")
    members = members.repartition(*group).sortWithinPartitions(*group, "node")
    found = scratch.write(verified(members), "links")
    linked = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), scratch)
    named = linked.join(nodes.select("node", "class_id"), "node")
    smallest = named.groupBy("component").agg(F.min("class_id").alias("component_id"))
    labels = named.join(smallest, "component").select("node", "component_id")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    moved = nodes.join(labels, "node", "left").join(links, "node", "left")
    moved = moved.where("copies > 1 OR component_id IS NOT NULL").select(
        "label",
        "vector",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component_id", "class_id").alias("component_id"),
    )
    moved = scratch.write(moved, "labels")
    component = F.coalesce("component_id", "vec_id")
    return rows.join(moved, ["label", "vector"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
