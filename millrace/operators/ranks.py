"""Ranks and running sums over a whole table without one task that sees it all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def hash_order(key: Column | str, seed: int | str) -> Column:
    """The one random order: md5 of seed and key, the same on every engine and partitioning."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))


def global_rank(df: DataFrame, order: Sequence[Column | str], name: str = "rank", amount: Column | None = None, total: str | None = None) -> DataFrame:
    """df with `name`: the row's place in (ascending) order, from 0; with amount, `total`: the sum of amount over rows before it.

    Rows are range-partitioned by order, ranked inside their partition, and shifted by the partitions'
    sums, of which there is one row a partition. The range partitions are fixed by a write to the shared
    folder, so both reads see the same ones.
    """
    from millrace.sources.session import materialise

    cols = df.columns
    keyed = df.withColumns({f"_o{i}": o if isinstance(o, Column) else F.col(o) for i, o in enumerate(order)})
    keys = [f"_o{i}" for i in range(len(order))]
    if amount is not None:
        keyed = keyed.withColumn("_amount", amount)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = materialise(keyed.repartitionByRange(parts, *keys).withColumn("_p", F.spark_partition_id()), "ranked")
    sums = spread.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"), (F.sum("_amount") if amount is not None else F.lit(0)).alias("_s"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    shift = sums.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"), F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_s0"))
    own = Window.partitionBy("_p").orderBy(*keys)
    out = spread.join(F.broadcast(shift), "_p").withColumn(name, (F.row_number().over(own) - 1 + F.col("_n0")).cast("long"))
    keep = [*cols, name]
    if amount is not None and total:
        out = out.withColumn(total, F.coalesce(F.sum("_amount").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("_s0"))
        keep.append(total)
    return out.select(*keep)


def rank_within(df: DataFrame, within: Sequence[str], order: Sequence[Column | str], name: str = "rank") -> DataFrame:
    """The row's place within its group, from 0, as a window: groups of bounded size, or ones Spark may spill."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*within).orderBy(*order)) - 1)
