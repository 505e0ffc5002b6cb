"""Diversity selection, semantic near-duplicates and centroid blending."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions import lexicons as L
from millrace.functions.text import run_counts, word_tokens
from millrace.functions.vectors import cosine, cosine_distance_unit, euclidean
from millrace.operators import blocks
from millrace.operators.joins import centroid
from millrace.operators.components import connected_components
from millrace.operators.ranks import global_rank
from millrace.sources.session import materialise


def farthest_first(x: np.ndarray, first: int, k: int, metric: str) -> list[int]:
    """Indices of k centres: each the point farthest from those before it, the lowest index on ties."""
    dist = (lambda c: 1 - x @ c) if metric == "cosine" else (lambda c: np.linalg.norm(x - c, axis=1))
    out = [first]
    near = dist(x[first])
    near[first] = -np.inf
    while len(out) < min(k, len(x)):
        i = int(np.argmax(near))
        out.append(i)
        near = np.minimum(near, dist(x[i]))
        near[out] = -np.inf
    return out


def k_center(df: DataFrame, key: str, vec: str, k: int, metric: str = "cosine", seed: int = 42, one_task: int = 50_000) -> DataFrame:
    """The keys of k centres, the first by hash, sorted; all if there are no more.

    Up to `one_task` rows it runs in one task. Above, every part of the table is thinned to k centres of its own, and
    the centres of these are taken: at most twice as far off as one round, and the second round sees parts * k rows.
    """

    def pick(it):
        rows = [(k_, v) for t in it for k_, v in zip(t.column("k").to_pylist(), t.column("v").to_pylist(), strict=True)]
        if not rows:
            yield pa.RecordBatch.from_arrays([pa.array([], pa.int64()), pa.array([], pa.list_(pa.float64())), pa.array([], pa.int64())], names=["k", "v", "ord"])
            return
        rows.sort(key=lambda r: r[0])
        import hashlib

        first = min(range(len(rows)), key=lambda i: hashlib.md5(f"{seed}:{rows[i][0]}".encode()).hexdigest())
        at = farthest_first(np.array([r[1] for r in rows], np.float64), first, k, metric)
        yield pa.RecordBatch.from_arrays(
            [pa.array([rows[i][0] for i in at], pa.int64()), pa.array([rows[i][1] for i in at], pa.list_(pa.float64())), pa.array(list(range(len(at))), pa.int64())], names=["k", "v", "ord"]
        )

    x = df.select(F.col(key).cast("long").alias("k"), F.col(vec).cast("array<double>").alias("v"))
    schema = "k long, v array<double>, ord long"
    n = df.count()
    if n > one_task:
        parts = -(-n // one_task)
        x = x.repartition(parts, "k").mapInArrow(pick, schema).select("k", "v")
    return x.coalesce(1).mapInArrow(pick, schema).select(F.col("k").alias(key), F.col("ord").alias("pick")).orderBy(key)


def content_signature(x: Column | str) -> Column:
    """Of the words of five letters or more that aren't stop words, the five most frequent, ties by word, sorted."""
    w = F.filter(word_tokens(x), lambda s: s.rlike("^[a-z]{5,}$") & ~s.isin(*L.CLUSTER_STOP_WORDS))
    return F.array_join(F.array_sort(F.transform(F.slice(F.sort_array(run_counts(F.sort_array(w))), 1, 5), lambda c: c["w"])), " ")


def content_cluster(x: Column | str, clusters: int = 50) -> Column:
    """The first eight hex digits of the signature's md5, modulo clusters."""
    return (F.conv(F.substring(F.md5(content_signature(x).cast("binary")), 1, 8), 16, 10).cast("long") % clusters).cast("long")


def kmeans_budget(df: DataFrame, key: str, vec: str, words: str, target: int, slack: float = 1.1, seed: int = 42) -> DataFrame:
    """K-means, then the longest of each cluster up to its share of the target, then, below 90 %, the longest of the rest."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    n = df.count()
    k = max(1, min(max(10, target // 10000), n // 5, 100))
    data = df.withColumn("_features", array_to_vector(F.col(vec).cast("array<double>")))
    model = KMeans(k=k, seed=seed, featuresCol="_features", predictionCol="cluster").fit(data)
    data = materialise(model.transform(data).drop("_features"), "clusters")
    return cluster_budget(data, key, words, target, slack)


def cluster_budget(df: DataFrame, key: str, words: str, target: int, slack: float = 1.1) -> DataFrame:
    """B15, U8 on rows with a `cluster`: the longest of each up to its share of the target, then, below 90 %, the longest of the rest.

    Rows are ranked over the whole table by cluster, length and key, so a cluster with most rows is no task of its own;
    a cluster's own sum is the table's less what the clusters before it hold. Null lengths count 0.
    """
    amount = F.coalesce(F.col(words).cast("long"), F.lit(0).cast("long"))
    ranked = global_rank(df, ["cluster", -amount, key], "_rank", amount, "_before")
    before = Window.orderBy("cluster").rowsBetween(Window.unboundedPreceding, -1)  # one row a cluster
    shares = df.groupBy("cluster").agg(F.count(F.lit(1)).alias("_n"), F.sum(amount).alias("_words"))
    shares = shares.withColumns({"_share": F.col("_n") / F.sum("_n").over(Window.partitionBy()) * target * slack, "_start": F.coalesce(F.sum("_words").over(before), F.lit(0))})
    chosen = ranked.join(F.broadcast(shares.select("cluster", "_share", "_start")), "cluster").filter(F.col("_before") - F.col("_start") + amount <= F.col("_share")).select(*df.columns)
    have = chosen.agg(F.coalesce(F.sum(amount), F.lit(0))).first()[0]
    if have >= 0.9 * target:
        return chosen
    rest = global_rank(df.join(chosen.select(key), key, "left_anti"), [-amount, key], "_rank", amount, "_before")
    return chosen.unionByName(rest.filter(F.col("_before") + amount <= target - have).select(*df.columns))


#: So many links at most are followed one by one; of more, rows are decided in rounds first.
LINKS = 2_000_000
_NONE = np.iinfo(np.int64).max


def _linked(a, b, same: bool, threshold: float):
    """Of the links of two blocks the rows i of a and j of b, their keys, and whether the earlier row is no shorter (then the later goes)."""
    i, j = blocks.alike(a, b, threshold, strict=True)
    (ka, na), (kb, nb) = ((x.columns["i"].to_numpy(), x.columns["n"]) for x in (a, b))
    apart = ka[i] < kb[j] if same else ka[i] != kb[j]
    i, j = i[apart], j[apart]
    known = na.is_valid().to_numpy(zero_copy_only=False)[i] & nb.is_valid().to_numpy(zero_copy_only=False)[j]
    na, nb = (x.fill_null(0).to_numpy()[at] for x, at in ((na, i), (nb, j)))
    return i, j, ka[i], kb[j], known & np.where(ka[i] < kb[j], na >= nb, nb >= na)


def _tallies(threshold: float):
    """Of each row with links in two blocks: how many, the first earlier row, the first earlier one that is shorter, and whether a later one is longer."""

    def tally(keys, at, own, other, later_goes):
        low, first = np.full(len(keys), _NONE), np.full(len(keys), _NONE)
        longer = np.zeros(len(keys), bool)
        back = own > other
        np.minimum.at(first, at[back], other[back])
        np.minimum.at(low, at[back & ~later_goes], other[back & ~later_goes])
        longer[at[~back & ~later_goes]] = True
        n = np.bincount(at, minlength=len(keys))
        k = np.flatnonzero(n)
        return pa.RecordBatch.from_arrays([pa.array(keys[k]), pa.array(n[k]), pa.array(first[k]), pa.array(low[k]), pa.array(longer[k])], names=["i", "links", "first", "low", "longer"])

    def found(pairs):
        for a, b, m, n in pairs:
            i, j, ka, kb, later_goes = _linked(a, b, m == n, threshold)
            if len(i):
                yield tally(a.columns["i"].to_numpy(), i, ka, kb, later_goes)
                yield tally(b.columns["i"].to_numpy(), j, kb, ka, later_goes)

    return found


def _links(threshold: float):
    def found(pairs):
        for a, b, m, n in pairs:
            i, j, ka, kb, later_goes = _linked(a, b, m == n, threshold)
            if len(i):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(ka, kb)), pa.array(np.maximum(ka, kb)), pa.array(later_goes)], names=["a", "b", "later_goes"])

    return found


def _heads_of(threshold: float):
    """Heads' blocks against others': of each other row the first head it is linked with."""

    def found(pairs):
        for a, b, *_ in pairs:
            i, j, ka, _, _ = _linked(a, b, False, threshold)
            if len(i):
                keys, head = b.columns["i"].to_numpy(), np.full(len(b.x), _NONE)
                np.minimum.at(head, j, ka)
                k = np.flatnonzero(head < _NONE)
                yield pa.RecordBatch.from_arrays([pa.array(keys[k]), pa.array(head[k])], names=["i", "head"])

    return found


def semantic_near(df: DataFrame, key: str, vec: str, length: str, threshold: float = 0.9) -> DataFrame:
    """Df without near-duplicates by cosine: in order of key, of two rows alike the shorter goes, the later on ties.

    All pairs are compared, block by block (`blocks`), and first only counted by row. Up to LINKS links, the greedy pass runs over
    the links of one connected group at a time, in key order. Of more, as in a large group of rows alike, rows are decided
    in rounds, and no link is written: a row with no earlier row and no later longer one beside it stays (a head), and all
    beside it go when its turn comes; one that could not have driven out a shorter row before that turn is left out of
    the next round. A round without such rows falls back to the links. Rows without links never move.
    """
    rows = df.select(F.col(key).cast("long").alias("i"), F.col(vec).alias("v"), F.col(length).cast("long").alias("n")).filter("i is not null")
    rows = materialise(rows, "vectors")
    gone = []
    while True:
        own = blocks.packed(rows, "i", "v", ["n"])
        tally = blocks.meeting(own, own, _tallies(threshold), "i long, links long, first long, low long, longer boolean", once=True)
        tally = materialise(tally.groupBy("i").agg(F.sum("links").alias("links"), F.min("first").alias("first"), F.min("low").alias("low"), F.max("longer").alias("longer")), "tally")
        total = tally.agg(F.coalesce(F.sum("links"), F.lit(0))).first()[0] // 2
        # Only rows with links are compared again.
        rows = rows.join(tally.select("i"), "i", "left_semi")
        if total <= LINKS:
            break
        head = (F.col("first") == _NONE) & ~F.col("longer")
        heads, rest = (blocks.packed(rows.join(tally.filter(which).select("i"), "i", "left_semi"), "i", "v", ["n"]) for which in (head, ~head))
        beside = blocks.meeting(heads, rest, _heads_of(threshold), "i long, head long").groupBy("i").agg(F.min("head").alias("head"))
        out = materialise(beside.join(tally, "i").filter("low > head").select("i"), "gone")
        if out.isEmpty():
            break
        gone.append(out)
        rows = materialise(rows.join(out, "i", "left_anti"), "vectors")
    if total:
        own = blocks.packed(rows, "i", "v", ["n"])
        links = materialise(blocks.meeting(own, own, _links(threshold), "a long, b long, later_goes boolean", once=True).distinct(), "near")
        group = connected_components(links).select(F.col("node").alias("x"), F.col("component").alias("g"))
        grouped = links.join(group, F.col("a") == F.col("x")).select("g", "a", "b", "later_goes")

        def resolve(pdf: pd.DataFrame) -> pd.DataFrame:
            out: set = set()
            for r in pdf.sort_values(["a", "b"]).itertuples():
                if r.a not in out and r.b not in out:
                    out.add(r.b if r.later_goes else r.a)
            return pd.DataFrame({"i": sorted(out)}, dtype="int64")

        gone.append(grouped.groupBy("g").applyInPandas(resolve, "i long"))
    for out in gone:
        df = df.join(out.select(F.col("i").alias(key)), key, "left_anti")
    return df


def blend(df: DataFrame, author: str, key: str, vec: str, primary: str, others: Sequence[str], threshold: float | None = None, top_percent: float | None = None, primary_weight: float = 2.0, least: int = 10) -> DataFrame:
    """(key, author, similarity) of the rows accepted, author by author against the centroid of what is accepted so far.

    One distributed round an author; only the centroid (one vector) is carried from round to round.
    """
    base = df.filter(F.col(author) == primary).select(key, F.col(author).alias("author"), vec, F.lit(primary_weight).alias("_w"))
    accepted = base.withColumn("similarity", F.lit(1.0))
    for name in others:
        center = materialise(centroid(accepted, vec, weight=F.col("_w")), "centroid")
        own = df.filter(F.col(author) == name).crossJoin(F.broadcast(center)).withColumn("similarity", cosine(vec, "centroid"))
        own = own.select(key, F.col(author).alias("author"), vec, F.lit(1.0).alias("_w"), "similarity")
        if threshold is not None:
            own = own.filter(F.col("similarity") >= threshold)
        elif top_percent is not None:
            own = own.filter("similarity > 0")
            most = max(least, int(own.count() * top_percent))
            own = own.orderBy(F.desc("similarity"), key).limit(most)
        accepted = materialise(accepted.unionByName(own), "accepted")
    return accepted.select(key, "author", "similarity")


def nearest_center(df: DataFrame, key: str, vec: str, centers: DataFrame, metric: str = "cosine") -> DataFrame:
    """Each row's nearest centre and distance: the radius check of a coreset. centers (center, cvec) is small by construction."""
    d = cosine_distance_unit(vec, "cvec") if metric == "cosine" else euclidean(vec, "cvec")
    pairs = df.crossJoin(F.broadcast(centers)).withColumn("_d", d)
    return pairs.groupBy(key).agg(F.min(F.struct("_d", "center")).alias("m")).select(key, F.col("m.center").alias("center"), F.col("m._d").alias("distance"))
