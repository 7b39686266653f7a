"""Connected components of a table of links, as rounds of joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.session import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for every node of links(a, b); component is its smallest node.

    Alternates two steps until the links no longer change: every node links its larger
    neighbours to its smallest one, then its smaller neighbours. Each node ends with one
    link to the root of its component, after a logarithmic number of rounds in practice.
    Every round is written to the shared folder, so lineage stays short and a lost
    executor costs one round. A node with many neighbours is reduced by partial
    aggregates; its neighbours are joined, never gathered into one row.
    Self links and repeats are ignored; an empty table gives an empty result.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = scratch.write(links.where("a > b").distinct(), "links")
    written = [scratch.paths[-1]]
    before = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low"))
        low = low.select("a", F.least("a", "low").alias("low"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = scratch.write(large.where("a > b").distinct(), "links")
        written.append(scratch.paths[-1])
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a")
        small = small.where("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        links = scratch.write(
            small.unionByName(low.select("a", F.col("low").alias("b"))).distinct(), "links"
        )
        for path in written:  # the new links were made from these, nothing reads them now
            scratch.drop(path)
        written = [scratch.paths[-1]]
        now = links.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if now == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = now
