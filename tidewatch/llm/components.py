"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm._shared import written


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's least neighbour (or itself)."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return (both.where("b > a").join(least, "a").where("b <> m")
            .select(F.col("m").alias("a"), F.col("b")))


def _small(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours all move to the least of them."""
    down = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))  # u > v
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u")
    return (moved.where("v <> m").select(F.col("m").alias("a"), F.col("v").alias("b"))
            .unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b"))))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the least node reachable, for every node that has a link.

    Links with a null or equal end are ignored.  Each round writes the remaining
    links to the shared folder; only their count and checksum reach the driver.
    The number of rounds grows with the logarithm of the longest path.
    """
    cur = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a < b").distinct()
    cur = written(cur, "links")
    mark = None
    while True:
        n, check = cur.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if n == 0 or (n, check) == mark:
            break
        mark = (n, check)
        cur = written(_small(_large(cur).distinct()).distinct(), "links")
    return cur.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        cur.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
