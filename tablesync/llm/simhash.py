"""Near duplicates by SimHash fingerprints and multi-index hashing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import fresh, map_batches
from tablesync.llm.components import components
from tablesync.session import Scratch

WORDS = 3
DISTANCE = 2
SEED = 42
SLICE = 1 << 15
# A table entry with more fingerprints is matched through ball points instead of pairs.
DENSE = 32
HALF = (1 << 32) - 1


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """64-bit fingerprint of a whole text; 0 without words."""
    # lower() and split() on bytes know A-Z and ASCII white space alone
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    count = max(1, len(parts) - words + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, count, SLICE):
        some = parts[at : at + min(SLICE, count - at) + words - 1]
        joined = b" ".join(some)
        ends = np.cumsum([len(p) + 1 for p in some])
        starts = [0, *ends[:-1].tolist()]
        ends = (ends - 1).tolist()[words - 1 :] or [len(joined)]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts, ends)]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """(doc_id, digest, fingerprint) of every row, the fingerprint as a signed 64-bit number."""
    rows = df.select(F.col(key).alias("doc_id"), digest(F.col(text)).alias("digest"), F.col(text).alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = np.array([fingerprint(t, words) for t in batch.column("text").to_pylist()], np.uint64)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("digest"), pa.array(made.view(np.int64))],
            names=["doc_id", "digest", "fingerprint"],
        )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_batches(rows, run, f"doc_id {kind}, digest binary, fingerprint bigint", "text")


def digest(text: Column) -> Column:
    """Tells the texts of one key apart; NULL reads as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _halves(fp: Column) -> tuple[Column, Column]:
    return F.shiftrightunsigned(fp, 32), fp.bitwiseAND(F.lit(HALF))


def _flips(value: Column) -> Column:
    """The points at distance one of a 32-bit half."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(31)), lambda i: value.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))
    )


def probes(points: DataFrame) -> DataFrame:
    """(fp, segment, at, own): table entries that a fingerprint asks for.

    Two fingerprints at distance two or less differ by at most one bit in the first half,
    or not at all in the second. So a fingerprint asks the table of first halves for its
    own half and the 32 at distance one, and the table of second halves for its own.
    """
    first, second = _halves(F.col("fp"))
    zero = F.lit(0)

    def ask(segment: Column, at: Column, own: Column) -> Column:
        return F.struct(segment.alias("segment"), at.alias("at"), own.alias("own"))

    asked = F.concat(
        F.array(ask(zero, first, F.lit(True)), ask(F.lit(1), second, F.lit(True))),
        F.transform(_flips(first), lambda at: ask(zero, at, F.lit(False))),
    )
    return points.select("fp", F.explode(asked).alias("ask")).select("fp", "ask.*")


def links(points: DataFrame, scratch: Scratch) -> DataFrame:
    """(a, b): links that connect exactly the fingerprints which pairs within DISTANCE do.

    ``points`` has distinct fingerprints ``fp``. Entries of the two tables hold the
    fingerprints with that half; matches are fetched by an equi-join and kept if their
    complete distance fits. An entry with more than DENSE members (variants of one text)
    would give the square of its size, so whoever asks for it is linked through ball
    points instead: fingerprints at distance two or less have a point at distance one or
    less of both, and all that share a point are within two of each other. The first of
    them stands for the others. That is exact and grows with the number of members.
    """
    asked = probes(points)
    sizes = asked.where("own").groupBy("segment", "at").count()
    sizes = scratch.write(sizes.where("count > 1 OR segment = 0"), "entries")
    # nobody but its owner asks for an entry of the second table that has one member;
    # the planner does not see how many probes a fingerprint has, so they must not be broadcast
    asked = scratch.write(asked.hint("merge").join(sizes, ["segment", "at"]), "probes")
    table = asked.where(f"own AND count <= {DENSE}").select(F.col("fp").alias("b"), "segment", "at")
    fetched = asked.where(f"count <= {DENSE}").join(table, ["segment", "at"])
    pairs = fetched.where((F.col("fp") < F.col("b")) & (distance(F.col("fp"), F.col("b")) <= DISTANCE))
    crowd = asked.where(f"count > {DENSE}").select("fp").distinct()
    first, second = _halves(F.col("fp"))
    points_near = F.concat(
        F.array(F.col("fp")),
        F.transform(_flips(first), lambda at: F.call_function("shiftleft", at, F.lit(32)).bitwiseOR(second)),
        F.transform(_flips(second), lambda at: F.call_function("shiftleft", first, F.lit(32)).bitwiseOR(at)),
    )
    ball = crowd.select("fp", F.explode(points_near).alias("point"))
    first_of = ball.groupBy("point").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1")
    star = ball.hint("merge").join(first_of, "point").where("a <> fp")
    star = star.where(distance(F.col("a"), F.col("fp")) <= DISTANCE)
    return (
        pairs.select(F.col("fp").alias("a"), "b")
        .unionByName(star.select("a", F.col("fp").alias("b")))
        .distinct()
    )


def near_duplicates(
    df: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text", words: int = WORDS
) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row.

    Equal fingerprints are one point of the search, whose class id is their smallest
    doc_id; ``component_id`` is the smallest doc_id reachable over links. NULL and empty
    texts have fingerprint zero and are linked like any other. Rows with a NULL key get
    the component of their fingerprint, if it has another row. Repeated rows each come
    back; an empty table gives an empty result; other columns are not read.
    """
    return _grouped(df, scratch, key, text, words).select("doc_id", "fingerprint", "component_id")


def _grouped(df: DataFrame, scratch: Scratch, key: str, text: str, words: int = WORDS) -> DataFrame:
    """near_duplicates with the text's digest and ``group``, a fingerprint that names the component.

    Two components can have the same smallest doc_id, if it stands for several texts;
    ``group`` tells them apart.
    """
    prints = scratch.write(fingerprints(df, key, text, words), "prints")
    classes = prints.groupBy(F.col("fingerprint").alias("fp")).agg(
        F.min("doc_id").alias("class_id"), F.count("*").alias("rows")
    )
    classes = scratch.write(classes, "classes")
    linked = components(links(classes.select("fp"), scratch), scratch)
    # label: the smallest class id of a component of fingerprints
    named = linked.join(classes, linked["node"] == classes["fp"])
    smallest = named.groupBy("component").agg(F.min("class_id").alias("component_id"))
    labels = named.join(smallest, "component").select("fp", "component", "component_id")
    # documents whose class is alone need no lookup
    moved = classes.join(labels, "fp", "left").where("rows > 1 OR component_id IS NOT NULL")
    moved = moved.select(
        F.col("fp").alias("fingerprint"),
        F.coalesce("component", "fp").alias("group"),
        F.coalesce("component_id", "class_id").alias("component_id"),
    )
    moved = scratch.write(moved, "labels")
    return prints.join(moved, "fingerprint", "left").select(
        "doc_id",
        "digest",
        "fingerprint",
        F.coalesce("group", "fingerprint").alias("group"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def report(df: DataFrame, scratch: Scratch) -> DataFrame:
    hexed = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return near_duplicates(df, scratch).withColumn("fingerprint", hexed)


def keep_one(df: DataFrame, scratch: Scratch, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group, with all its columns; rows with NULL keys stay.

    The row whose key names the component stays. A row is looked up by its key and its
    text, so a key that stands for several texts loses only the rows that lose. If a group
    has that key more than once, the text of the smallest digest stays, and of rows that
    repeat key and text any one.
    """
    found = scratch.write(_grouped(df, scratch, key, text), "groups")
    named = found.where("doc_id = component_id").groupBy("doc_id", "group", "digest").count()
    # groups that have their key more than once are few
    first = named.groupBy("doc_id", "group").agg(F.min("digest").alias("first"), F.sum("count").alias("rows"))
    first = scratch.write(first.where("rows > 1"), "repeated")
    repeated = named.join(first, ["doc_id", "group"])
    lost = found.where("doc_id <> component_id").select("doc_id", "digest")
    lost = lost.unionByName(repeated.where("digest <> first").select("doc_id", "digest")).distinct()
    names = fresh(df, "_key"), fresh(df, "_text")
    lost = lost.select(F.col("doc_id").alias(names[0]), F.col("digest").alias(names[1]))

    def same(rows: DataFrame) -> Column:
        return (rows[key] == F.col(names[0])) & (digest(rows[text]) == F.col(names[1]))

    stay = df.join(lost, same(df), "left_anti")
    twice = repeated.where("digest = first AND count > 1")
    twice = twice.select(F.col("doc_id").alias(names[0]), F.col("digest").alias(names[1]))
    if twice.isEmpty():
        return stay
    one = stay.join(twice, same(stay)).dropDuplicates(list(names)).select(*df.columns)
    return stay.join(twice, same(stay), "left_anti").unionByName(one)
