"""Connected components by alternating large-star and small-star rounds (DataFrame operations only)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import stored


def connected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that an edge joins to a smaller one; root is the smallest node of its component.

    A round hangs the larger neighbours of every node under its smallest neighbour (large star), then the smaller
    ones (small star); it ends when a round changes nothing. Each round is written to the shared folder, and says by the
    way whether it changed anything. What hot centres are joined with is written first: then both sides of the join are
    plain exchanges, of which Spark splits the hot one.
    """
    e, mark = told(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("node"), F.least(a, b).alias("root")).distinct())
    while mark[0]:
        least = stored(e.groupBy(F.col("node").alias("_n")).agg(F.min("root").alias("_m")), "least")
        large = e.join(least, F.col("root") == F.col("_n"), "left").select("node", F.coalesce("_m", "root").alias("root")).distinct()
        low = large.groupBy("node").agg(F.min("root").alias("_m"))
        small = large.join(low, "node").where(F.col("root") != F.col("_m")).select(F.col("root").alias("node"), F.col("_m").alias("root"))
        was = mark
        e, mark = told(small.union(low.select("node", F.col("_m").alias("root"))).distinct())
        if was == mark:
            break
    return e


def told(e: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges as they are stored, and their number with two sums of hashes, which change with any edge."""
    seen = Observation()
    sums = [F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(node, root)) AS x"), F.expr("sum(cast(xxhash64(root, node) % 1000003 AS long)) AS s")]
    out = stored(e.observe(seen, *sums), "edges")
    return out, tuple(seen.get[c] for c in "nxs")
