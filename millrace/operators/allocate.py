"""Frequencies, budgets and diversity of a taxonomy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _all() -> Window:
    """The whole table: one row a bucket of a taxonomy, whatever the corpus' size."""
    return Window.partitionBy()


def reweight(df: DataFrame, frequency: str, t: float, within: Sequence[str] = (), name: str = "weight") -> DataFrame:
    """F ** (1/t) over its sum; zeros stay, all zero is uniform. One row a bucket: the table is small by nature."""
    if t <= 0:
        raise ValueError("temperature must be positive")
    w = Window.partitionBy(*within)
    p = F.when(F.col(frequency) > 0, F.pow(F.col(frequency).cast("double"), 1.0 / t)).otherwise(F.lit(0.0))
    total = F.sum(p).over(w)
    return df.withColumn(name, F.when(total > 0, p / total).otherwise(1.0 / F.count(F.lit(1)).over(w)))


def largest_remainder(df: DataFrame, weight: str, total: int, order: Sequence[str], at_least: int = 0, name: str = "budget") -> DataFrame:
    """Whole numbers that sum to total: at_least each, the rest by weight, the leftover to the largest fractions, ties in order."""
    n = F.count(F.lit(1)).over(_all())
    floor_ = F.when(n * at_least > total, F.lit(0)).otherwise(F.lit(at_least))
    rest = F.lit(total) - floor_ * n
    out = df.withColumn("_exact", F.col(weight) * rest).withColumn("_whole", F.floor("_exact").cast("long")).withColumn("_floor", floor_)
    left = rest - F.sum("_whole").over(_all())
    place = F.row_number().over(Window.partitionBy().orderBy(F.desc(F.round(F.col("_exact") - F.col("_whole"), 9)), *order))
    return out.withColumn(name, (F.col("_floor") + F.col("_whole") + F.when(place <= left, 1).otherwise(0)).cast("long")).drop("_exact", "_whole", "_floor")


def floor_allocation(df: DataFrame, weight: str, total: int, least: int, name: str = "budget") -> DataFrame:
    """Least each and int(rest * w / sum); the sum may differ from total."""
    rest = F.greatest(F.lit(0), F.lit(total) - F.count(F.lit(1)).over(_all()) * least)
    return df.withColumn(name, (F.lit(least) + F.floor(rest * F.col(weight) / F.sum(weight).over(_all()))).cast("long"))


def split_budget(total: int, parts: int) -> list[int]:
    """A10: nearly equal whole parts, the larger first."""
    return [total // parts + (i < total % parts) for i in range(parts)]


def temperature_budget(df: DataFrame, frequency: str, total: int, temperatures: Sequence[float], order: Sequence[str], name: str = "budget") -> DataFrame:
    """The budget split over temperatures, A8 for each, summed a bucket."""
    out = None
    for t, part in zip(temperatures, split_budget(total, len(temperatures)), strict=True):
        one = largest_remainder(reweight(df, frequency, t), "weight", part, order, name="_b").select(*order, "_b")
        out = one if out is None else out.unionAll(one)
    return df.join(out.groupBy(*order).agg(F.sum("_b").alias(name)), list(order))


def normalised_entropy(counts: DataFrame, n: str) -> DataFrame:
    """Shannon entropy of the counts over ln of how many there are, zeros among them; 0 for fewer than two."""
    p = F.col(n) / F.col("_total")
    total = counts.agg(F.sum(n).alias("_total"), F.count(F.lit(1)).alias("_k"))
    h = -F.sum(F.when(F.col(n) > 0, p * F.log(p)).otherwise(0.0))
    out = counts.crossJoin(F.broadcast(total)).agg(h.alias("h"), F.max("_k").alias("k"), F.max("_total").alias("t"))
    return out.select(F.when((F.col("k") > 1) & (F.col("t") > 0), F.col("h") / F.log("k")).otherwise(F.lit(0.0)).alias("diversity"))


def coverage(nodes: DataFrame, features: DataFrame, node: str | Sequence[str]) -> DataFrame:
    """A5: features a node, zeros kept."""
    keys = [node] if isinstance(node, str) else list(node)
    counts = features.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_features"))
    return nodes.join(counts, keys, "left").withColumn("n_features", F.coalesce("n_features", F.lit(0)))


def sparse(nodes: DataFrame, features: DataFrame, node: str | Sequence[str], threshold: int = 3, least_depth: Column | None = None) -> DataFrame:
    """nodes with fewer than threshold features, none among them."""
    out = coverage(nodes, features, node).filter(F.col("n_features") < threshold)
    return out if least_depth is None else out.filter(least_depth)


def rollup_counts(df: DataFrame, levels: Sequence[str], value: Column | None = None) -> DataFrame:
    """Counts of each root and node, and of all, in one pass."""
    return df.rollup(*levels).agg(F.count(F.lit(1) if value is None else value).alias("n"))


def feature_frequency(trees: DataFrame, features: str = "features", kind: str = "feature_type") -> DataFrame:
    """A4: how many features of each type all trees hold; a missing type is "unknown"."""
    rows = trees.select(F.explode(features).alias("_f")).select(F.coalesce(F.col(f"_f.{kind}"), F.lit("unknown")).alias(kind))
    return rows.groupBy(kind).agg(F.count(F.lit(1)).alias("n"))
