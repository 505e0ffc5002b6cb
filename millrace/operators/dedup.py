"""Exact and keyed deduplication, keeping the first in a stated order, and unions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions.text import _c, changelog_stripped, first_line, non_blank, strip, word_count


def exact_key(instruction: Column | str = "instruction", output: Column | str = "output") -> Column:
    """sha256 of both fields, stripped."""
    return F.sha2(F.concat(strip(F.coalesce(_c(instruction), F.lit(""))), F.lit("\n"), strip(F.coalesce(_c(output), F.lit("")))), 256)


def field_key(field: Column | str) -> Column:
    """D3: sha256 of the field, stripped and in lower case; a missing field counts as empty."""
    return F.sha2(F.lower(strip(F.coalesce(_c(field).cast("string"), F.lit("")))), 256)


def keep_first(df: DataFrame, key: Column, order: Sequence[Column | str]) -> DataFrame:
    """One row of each key, the first in order.

    The minimum by order is a partial aggregate on both sides of the one shuffle, so a key that holds
    a third of all rows costs one row a task.
    """
    cols = df.columns
    packed = df.select(key.alias("_key"), F.struct(*[_c(o).alias(f"_o{i}") for i, o in enumerate(order)]).alias("_order"), F.struct(*cols).alias("_row"))
    return packed.groupBy("_key").agg(F.min_by("_row", "_order").alias("_row")).select("_row.*")


def merge(sources: Sequence[DataFrame], key: Column | None, order: Sequence[str]) -> DataFrame:
    """Rows of all sources in argument order, then D4 by the key."""
    out = None
    for rank, df in enumerate(sources):
        df = df.withColumn("_source_rank", F.lit(rank))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if key is not None:
        out = keep_first(out, key, ["_source_rank", *order])
    return out.drop("_source_rank")


def keep_longest_prefix(df: DataFrame, text: str, within: Sequence[str], position: str, letters: int = 50) -> DataFrame:
    """Of texts with the same first letters, in lower case, the longest, at the first one's position."""
    key = [*within, F.lower(F.substring(text, 1, letters)).alias("_k")]
    cols = [c for c in df.columns if c not in within]
    best = F.max_by(F.struct(*cols), F.struct(F.length(text).alias("n"), (-F.col(position)).alias("p")))
    out = df.groupBy(*key).agg(best.alias("_row"), F.min(position).alias("_at"))
    return out.select(*within, *[F.col(f"_row.{c}") if c != position else F.col("_at").alias(position) for c in cols])


def distinct_parts(parts: Column) -> Column:
    """D8, second half: later repeats of a part (in lower case) dropped, in order."""
    start = F.struct(F.array().cast("array<string>").alias("seen"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, p: Column) -> Column:
        low, new = F.lower(p), ~F.array_contains(acc["seen"], F.lower(p))
        return F.struct(
            F.when(new, F.concat(acc["seen"], F.array(low))).otherwise(acc["seen"]).alias("seen"), F.when(new, F.concat(acc["out"], F.array(p))).otherwise(acc["out"]).alias("out")
        )

    return F.aggregate(parts, start, step, lambda acc: acc["out"])


def joint_instruction(messages: Column | str) -> Column:
    """The messages' first lines without merges, prefixes and trivial ones, each once, joined."""
    lines = F.transform(F.filter(_c(messages), lambda m: m.isNotNull()), first_line)
    lines = F.filter(lines, lambda s: (s != "") & ~s.startswith("Merge pull request") & ~s.startswith("Merge branch"))
    lines = F.filter(non_blank(F.transform(lines, changelog_stripped)), lambda s: (word_count(s) >= 3) & (F.length(s) >= 10))
    return F.array_join(F.array_distinct(lines), "; ")


def merge_trees(trees: DataFrame) -> DataFrame:
    """(tree, node, name, ...) -> one row of each node and name, of the first tree."""
    return keep_first(trees, F.concat_ws("\x00", "node", "name"), ["tree"])


def mine_distinct(df: DataFrame, instruction: str, order: Sequence[str], most: int) -> DataFrame:
    """Distinct instructions in order, the first `most`."""
    return keep_first(df, F.col(instruction), order).orderBy(*order).limit(most)


def row_numbered(df: DataFrame, within: Sequence[str], order: Sequence[Column | str], name: str = "rn") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*within).orderBy(*order)))


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """U4: all rows of all parts by column name, a missing column null."""
    out, *rest = parts
    for df in rest:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def union_shuffled(parts: Sequence[DataFrame], key: str, seed: int = 42) -> DataFrame:
    """U4 with `place`, the row's place in hash order (O2)."""
    from millrace.operators.ranks import global_rank, hash_order

    return global_rank(union_all(parts), [hash_order(key, seed), key], "place")


def union_existing(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """U4 of the Parquet tables among the paths that exist; an error if none does."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    found = [p for p in paths if (at := jvm.org.apache.hadoop.fs.Path(p)).getFileSystem(conf).exists(at)]
    if not found:
        raise FileNotFoundError(", ".join(paths))
    return union_all([spark.read.parquet(p) for p in found])


def process_side(df: DataFrame, side: Column, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows of the side changed, the others (null counts as other) as they are."""
    on = F.coalesce(side, F.lit(False))
    return change(df.filter(on)).unionByName(df.filter(~on))


def remaining(df: DataFrame, selected: DataFrame, key: str) -> DataFrame:
    """U8: the rows that aren't selected."""
    return df.join(selected.select(key).distinct(), key, "left_anti")
