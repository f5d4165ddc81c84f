"""Connected components of a link table, by alternating large and small stars until nothing changes.

Labels never leave Spark. Each round costs a few shuffles of the links that are left; the number of rounds grows with the
logarithm of the longest path. Rounds are cut off from their lineage by reliable checkpoints. At most FEW_LINKS different
links, or as few left after some rounds, are united in one task instead, which gives the same components.

Defined cases: loops and repeated links change nothing; null ends are dropped; no links give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, checkpointed_small

#: Links that one task unites: about 100 bytes each there.
FEW_LINKS = 200_000


def large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked with the node's smallest neighbour (or itself)."""
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are all linked with the smallest of them; links go from larger to smaller."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    others = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
    return others.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def united(links: DataFrame) -> DataFrame:
    """(node, component) of a bounded number of links (a, b), in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := root.setdefault(x, x)) != x:
                root[x] = root[up]
                x = root[x]
            return x

        for batch in batches:
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                x, y = find(x), find(y)
                if x != y:
                    root[max(x, y)] = min(x, y)
        nodes = list(root)
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(list(map(find, nodes)), pa.int64())], names=["node", "component"])

    return checkpointed(links.select("a", "b").coalesce(1).mapInArrow(run, "node long, component long"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node of a link; component is the smallest node that links reach."""
    ends = links.select(F.col(a).cast("long").alias("x"), F.col(b).cast("long").alias("y")).filter("x IS NOT NULL AND y IS NOT NULL AND x <> y")
    found = ends.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()
    found, before = checkpointed_small(found), None
    while True:
        now = found.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now[0] <= FEW_LINKS:
            return united(found)
        if now == before:
            break
        found, before = checkpointed_small(small_star(large_star(found))), now
    return found.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(found.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
