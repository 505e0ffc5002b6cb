"""Balancing, splits and seeded samples. Random choices go by hash order."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.operators.ranks import global_rank, hash_order


def _within(df: DataFrame, within: Sequence[str], key: str, seed: int) -> DataFrame:
    w = Window.partitionBy(*within)
    return df.withColumn("_rn", F.row_number().over(w.orderBy(hash_order(key, seed), key))).withColumn("_n", F.count(F.lit(1)).over(w))


def first_by_hash(df: DataFrame, within: Sequence[str], key: str, most: Callable[[Column], Column], seed: int = 42) -> DataFrame:
    """df with `_first`: whether a row is among its group's first most(rows of the group) in hash order; rows of one key stay together.

    No group is ranked whole: its hashes are counted by their first three digits, and only the interval where the cut
    falls is ranked, which gives one cut a group; groups are strata, so few that the cuts are broadcast.
    """
    order = hash_order(key, seed)
    small = df.select(*within, order.alias("_h"), F.col(key).alias("_k")).withColumn("_b", F.substring("_h", 1, 3))
    own = Window.partitionBy(*within)
    counts = small.groupBy(*within, "_b").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(own.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    counts = counts.withColumn("_all", F.sum("_n").over(own)).withColumn("_m", F.least(most(F.col("_all")), F.col("_all")).cast("long"))
    edge = counts.filter("_before < _m and _before + _n >= _m").select(*[F.col(c).alias(f"_w_{c}") for c in within], F.col("_b").alias("_w_b"), "_before", "_m")
    same = [F.col(c).eqNullSafe(F.col(f"_w_{c}")) for c in within]
    inside = small.join(F.broadcast(edge), [*same, F.col("_b") == F.col("_w_b")])
    inside = inside.withColumn("_rn", F.row_number().over(Window.partitionBy(*within, "_b").orderBy("_h", "_k")))
    cuts = inside.filter("_rn = _m - _before").select(*[F.col(c).alias(f"_w_{c}") for c in within], F.col("_h").alias("_cut_h"), F.col("_k").alias("_cut_k"))
    out = df.join(F.broadcast(cuts), same, "left")
    first = (order < F.col("_cut_h")) | ((order == F.col("_cut_h")) & (F.col(key) <= F.col("_cut_k")))
    return out.select(*df.columns, F.coalesce(first, F.lit(False)).alias("_first"))


def balance(df: DataFrame, kind: str, key: str, cap: int | None = None, seed: int = 42) -> DataFrame:
    """B1: at most cap rows of each kind, the smallest kind's count by default.

    A given cap is a rank limit, so each task keeps cap rows of a kind at most before the shuffle.
    """
    if cap is None:
        least = df.groupBy(kind).count().agg(F.min("count")).first()[0] or 0
        return first_by_hash(df, [kind], key, lambda n: F.lit(least), seed).filter("_first").drop("_first")
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(kind).orderBy(hash_order(key, seed), key)))
    return ranked.filter(F.col("_rn") <= cap).drop("_rn")


def stratified_split(df: DataFrame, strata: Sequence[str], key: str, share: float = 0.05, seed: int = 42) -> DataFrame:
    """B2: with `split`: the first round(n * share) rows of each stratum, half to even, are val."""
    out = first_by_hash(df, strata, key, lambda n: F.bround(n * share, 0), seed)
    return out.withColumn("split", F.when(F.col("_first"), "val").otherwise("train")).drop("_first")


def cut_split(df: DataFrame, key: str, shares: Sequence[tuple[str, float]], seed: int = 42, rest: str = "test", at_least: int = 0) -> DataFrame:
    """In hash order, floor(n * share) rows for each name in turn, what is left to `rest`; the first name gets `at_least` rows."""
    n = df.count()
    ranked = global_rank(df, [hash_order(key, seed), key], "_rank")
    out, at = None, 0
    for i, (name, share) in enumerate(shares):
        at += max(int(n * share), at_least if i == 0 else 0)
        cond = F.col("_rank") < at
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return ranked.withColumn("split", out.otherwise(rest)).drop("_rank")


def shuffled(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """O2: in hash order."""
    return df.orderBy(hash_order(key, seed), key)


def sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """N rows, all if there are no more; a top-k by hash."""
    return df.orderBy(hash_order(key, seed), key).limit(n)


def weighted_sample(df: DataFrame, key: str, weight: Column, n: int, seed: int = 42) -> DataFrame:
    """Without replacement, by u ** (1 / weight); rows of no weight never."""
    u = (F.conv(F.substring(hash_order(key, seed), 1, 13), 16, 10).cast("double") + 1) / float(16**13 + 1)
    return df.filter(weight > 0).orderBy(F.desc(F.pow(u, 1 / weight)), key).limit(n)


def per_group_sample(df: DataFrame, group: str, key: str, n: int, groups: int, seed: int = 42) -> DataFrame:
    """max(1, n // groups) of each group, cut to n in hash order."""
    quota = max(1, n // max(1, groups))
    out = _within(df, [group], key, seed).filter(F.col("_rn") <= quota)
    return out.orderBy("_rn", hash_order(key, seed), key).limit(n).drop("_rn", "_n")


def share_sample(df: DataFrame, node: str, key: str, n: int, seed: int = 42) -> DataFrame:
    """Of each node max(1, int(n * its share)), shuffled, cut to n."""
    total = df.count()
    out = _within(df, [node], key, seed).filter(F.col("_rn") <= F.greatest(F.lit(1), F.floor(F.col("_n") * n / max(1, total))))
    return out.orderBy(hash_order(key, seed), key).limit(n).drop("_rn", "_n")


def by_feature(df: DataFrame, features: str, key: str, n: int, seed: int = 42) -> DataFrame:
    """One example a feature, by hash, features in hash order; may give fewer than n."""
    pairs = df.select(F.explode(features).alias("_f"), key)
    one = pairs.groupBy("_f").agg(F.min_by(key, hash_order(F.concat_ws(":", "_f", key), seed)).alias(key))
    first = one.groupBy(key).agg(F.min(hash_order("_f", seed)).alias("_o")).orderBy("_o", key).limit(n)
    return df.join(F.broadcast(first.select(key)), key, "left_semi")


def variants(df: DataFrame, text: str, kinds: Sequence[str] = ("standard", "info_dropout", "abstract"), least_words: int = 10) -> DataFrame:
    """A row for each kind; all but the first only for texts of least_words words or more."""
    from millrace.functions.text import word_count

    own = F.when(word_count(text) >= least_words, F.array(*[F.lit(k) for k in kinds])).otherwise(F.array(F.lit(kinds[0])))
    return df.withColumn("variation_type", F.explode(own))


def every_step(df: DataFrame, order: Sequence[str], words: Column, ratio: float, budget: int) -> DataFrame:
    """Every step-th row, step = max(1, int(1 / ratio)), until the words reach the budget."""
    step = max(1, int(1 / ratio)) if ratio > 0 else 1
    picked = global_rank(df, order, "_rank").filter(F.col("_rank") % step == 0).drop("_rank")
    return global_rank(picked, order, "_rank", words, "_before").filter(F.col("_before") < budget).drop("_rank", "_before")


def diverse_first(df: DataFrame, cluster: str, quality: str, key: str, per_cluster: int = 2) -> DataFrame:
    """O6, first phase: the best of each cluster."""
    w = Window.partitionBy(cluster).orderBy(F.desc(quality), key)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= per_cluster).drop("_rn")


def diverse_select(df: DataFrame, cluster: str, quality: str, tokens: str, key: str, target: int, per_cluster: int = 2, cap: int = 20, slack: float = 1.05) -> DataFrame:
    """The first phase, then the best of the rest up to a cap a cluster, as a prefix of the token budget.

    The fill is a running-sum prefix: a greedy that skips what doesn't fit depends on every row before it.
    """
    w = Window.partitionBy(cluster).orderBy(F.desc(quality), key)
    ranked = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= cap).withColumn("_late", (F.col("_rn") > per_cluster).cast("int"))
    out = global_rank(ranked, ["_late", -F.col(quality), key], "_rank", F.col(tokens), "_before")
    return out.filter(F.col("_before") + F.col(tokens) <= target * slack).drop("_rn", "_late", "_rank", "_before")


def drawn(df: DataFrame, key: str, weight: str, n: int, seed: int = 42) -> DataFrame:
    """The distinct rows of n draws with replacement by whole-number weights, so fewer than n where one is drawn twice.

    The i-th draw is a point below the sum of weights; a row is drawn if one lies in its stretch of the running sum by key.
    """
    total = df.agg(F.coalesce(F.sum(F.greatest(F.col(weight), F.lit(0))), F.lit(0))).first()[0]
    if not total:
        return df.limit(0)
    points = F.array(*[F.lit(int(hashlib.md5(f"{seed}:{i}".encode()).hexdigest()[:8], 16) % total) for i in range(n)])
    at = global_rank(df, [key], "_rank", F.greatest(F.col(weight), F.lit(0)), "_before")
    hit = F.exists(points, lambda p: (p >= F.col("_before")) & (p < F.col("_before") + F.greatest(F.col(weight), F.lit(0))))
    return at.filter(hit).drop("_rank", "_before")


def top_similar(df: DataFrame, score: str, key: str, n: int) -> DataFrame:
    """O3: the n rows of the highest score, by key on ties."""
    return df.orderBy(F.desc(score), key).limit(n)


def robustness(df: DataFrame, kind: str, key: str, original: str = "original", made: str = "robustness", seed: int = 42) -> DataFrame:
    """All rows, and a third of the originals (rounded down), in hash order, once more as `made`."""
    own = df.filter(F.col(kind) == original)
    return df.unionByName(sample(own, key, own.count() // 3, seed).withColumn(kind, F.lit(made)))
