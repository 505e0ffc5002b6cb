"""Connected components of an edge table, in linear-size rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.sources.session import materialise


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """edges (hi, lo): no hi has two lo, and no lo is itself a hi."""
    tally = edges.select(F.col("hi").alias("x"), F.lit(1).alias("h"), F.lit(0).alias("l")).unionAll(
        edges.select(F.col("lo").alias("x"), F.lit(0).alias("h"), F.lit(1).alias("l"))
    )
    bad = tally.groupBy("x").agg(F.sum("h").alias("h"), F.sum("l").alias("l")).filter("h > 1 or (h > 0 and l > 0)")
    return bad.isEmpty()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every end of an edge; component is the smallest node reachable.

    Alternating large-star and small-star rounds: every round keeps at most one row per
    edge, the neighbour minimum is a partial aggregate, and no group is ever collected.
    Each round is written to the shared folder, so lost executors cost one round at most.
    Null ends and self loops are ignored; an empty table gives an empty result.
    """
    pairs = (
        edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .filter(f"{a} is not null and {b} is not null")
        .filter("hi > lo")
        .distinct()
    )
    pairs = materialise(pairs, "edges")
    while not _is_forest_of_stars(pairs):
        both = pairs.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
            pairs.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Written first, so that both sides of the join are plain shuffles, which Spark can split at a hub.
        least = materialise(least, "least")
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        large = materialise(large, "large")
        down = materialise(large.groupBy("hi").agg(F.min("lo").alias("m")), "down")
        small = (
            large.join(down, "hi")
            .select(F.explode(F.array(F.struct(F.col("hi"), F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e"))
            .select("e.hi", "e.lo")
            .filter("hi > lo")
            .distinct()
        )
        pairs = materialise(small, "edges")
    roots = pairs.select(F.col("lo").alias("node")).distinct()
    return pairs.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionAll(
        roots.select("node", F.col("node").alias("component"))
    )
