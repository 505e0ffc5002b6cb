"""Sessions, runs, bands and arcs of ordered rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.operators.ranks import global_rank


def parse_timestamp(x: Column) -> Column:
    """Four formats, then ISO; null if none fits."""
    formats = ["yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd HH:mm:ss XX", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss"]
    return F.coalesce(*[F.try_to_timestamp(F.trim(x), F.lit(f)) for f in formats], F.try_to_timestamp(F.trim(x)))


def gap_sessions(df: DataFrame, within: Sequence[str], ts: str, order: Sequence[str], hours: float = 4) -> DataFrame:
    """With `session`, from 0: a new one after a gap of more than `hours`. A null time never splits, nor does the row after it."""
    w = Window.partitionBy(*within).orderBy(*order)
    gap = F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.lag(F.col(ts).cast("timestamp")).over(w))
    new = F.coalesce((gap > int(hours * 3_600_000_000)).cast("int"), F.lit(0))
    return df.withColumn("_new", new).withColumn("session", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def boundary_sessions(df: DataFrame, within: Sequence[str], boundary: Column, order: Sequence[str]) -> DataFrame:
    """Sessions between boundary rows, which go; empty ones aren't counted."""
    w = Window.partitionBy(*within).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = df.withColumn("_edge", F.coalesce(boundary, F.lit(False)).cast("int")).withColumn("_s", F.sum("_edge").over(w)).filter("_edge = 0")
    return out.withColumn("session", F.dense_rank().over(Window.partitionBy(*within).orderBy("_s")) - 1).drop("_edge", "_s")


def is_merge(message: Column) -> Column:
    m = F.ltrim(message)
    return m.startswith("Merge pull request") | m.startswith("Merge branch")


def prefix_runs(df: DataFrame, within: Sequence[str], prefix: Column, order: Sequence[str]) -> DataFrame:
    """Runs of consecutive rows with one prefix; rows without one end a run and go."""
    w = Window.partitionBy(*within).orderBy(*order)
    out = df.withColumn("_p", prefix)
    out = out.withColumn("_new", (~F.col("_p").eqNullSafe(F.lag("_p").over(w)) | (F.row_number().over(w) == 1)).cast("int"))
    out = out.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).filter("_p is not null")
    return out.withColumn("session", F.dense_rank().over(Window.partitionBy(*within).orderBy("_run")) - 1).drop("_p", "_new", "_run")


def lifecycle_band(df: DataFrame, order: Sequence[str], low: float = 0.4, high: float = 0.8, most: int | None = None) -> DataFrame:
    """Rows [int(low * n), int(high * n)) in order, at most `most`."""
    n = df.count()
    lo, hi = int(low * n), int(high * n)
    hi = hi if most is None else min(hi, lo + most)
    return global_rank(df, order, "_rank").filter((F.col("_rank") >= lo) & (F.col("_rank") < hi)).drop("_rank")


def arcs(df: DataFrame, order: Sequence[str], k: int, within: Sequence[str] = ()) -> DataFrame:
    """With `arc`: rows k by k in order, the last arc may be short."""
    if not within:
        return global_rank(df, order, "_rank").withColumn("arc", F.floor(F.col("_rank") / k)).drop("_rank")
    rn = F.row_number().over(Window.partitionBy(*within).orderBy(*order))
    return df.withColumn("arc", F.floor((rn - 1) / k))


def asof(left: DataFrame, right: DataFrame, within: Sequence[str], at: str, value: str) -> DataFrame:
    """Left with the right value at the same or nearest earlier place; of right rows at one place the largest value."""
    cols = left.columns
    both = left.withColumns({"_side": F.lit(1), "_v": F.lit(None).cast(right.schema[value].dataType)}).unionByName(
        right.groupBy(*within, at).agg(F.max(value).alias("_v")).withColumn("_side", F.lit(0)), allowMissingColumns=True
    )
    w = Window.partitionBy(*within).orderBy(at, "_side").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn(value + "_asof", F.last("_v", ignorenulls=True).over(w)).filter("_side = 1").select(*cols, value + "_asof")


def alternate(df: DataFrame, index: str, even: bool = True) -> DataFrame:
    """W15."""
    return df.filter(F.col(index) % 2 == (0 if even else 1))
