"""Mixing sources to target weights by hierarchical budgeting.

Weights go down a tree of domain, language and source. A node that has fewer tokens than its share
(`epochs` times over) takes what it has, and its siblings share the rest by weight; only what all of
them cannot take goes to the level above. Each leaf then reads whole epochs of its documents and,
of one more, seeded, epoch, the shortest prefix that reaches its quota.

Prefixes are found without sorting a leaf: its documents' order hashes are counted in 1024
intervals or more (INTERVAL_ROWS), the interval where the quota falls is ranked by itself, and the result is one cutoff
hash a leaf. The texts themselves are only filtered, never shuffled.

Defined cases: tokens are runs of non-space characters; null text has none; null language
or source is a branch of its own (""); a source in no domain goes to "other", and a name
without a weight weighs `default`; leaves without tokens keep all their documents once if they
have a share; documents of one id share their place; an empty table gives no rows; the input's
columns are kept as they are, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import materialise, own_prefix

#: Intervals of the order hash, as bits: at least so many, and more where a leaf would have above INTERVAL_ROWS rows in one.
BITS, INTERVAL_ROWS = 10, 50_000


@dataclass(frozen=True)
class Mixture:
    domains: Mapping[str, tuple[str, ...]]
    domain_weights: Mapping[str, float]
    lang_weights: Mapping[str, float]
    source_weights: Mapping[str, float] = field(default_factory=dict)
    default: float = 1.0
    share: float = 0.7  # of all tokens, the budget
    epochs: int = 1
    seed: int = 42


#: The production mixture.
PRODUCTION = Mixture(
    domains={"web": tuple(f"src{i}" for i in range(10)), "books": tuple(f"src{i}" for i in range(10, 15)), "code": tuple(f"src{i}" for i in range(15, 20))},
    domain_weights={"web": 0.5, "books": 0.3, "code": 0.2, "other": 0.1},
    lang_weights={"en": 0.6, "fr": 0.15, "de": 0.15, "es": 0.1, "": 0.05},
)


def spread(budget: float, weights: list[float], most: list[float]) -> list[float]:
    """budget by weight, no one above its most; what one cannot take goes to the others by weight."""
    out, open_, left = [0.0] * len(weights), {i for i, w in enumerate(weights) if w > 0}, budget
    while open_:
        total = sum(weights[i] for i in open_)
        full = {i for i in open_ if left * weights[i] / total >= most[i]}
        if not full:
            for i in open_:
                out[i] = left * weights[i] / total
            break
        for i in full:
            out[i] = most[i]
            left -= most[i]
        open_ -= full
    return out


def quotas(leaves: Mapping[tuple[str, str, str], int], mix: Mixture) -> dict[tuple[str, str, str], int]:
    """Tokens of each (domain, lang, source), from the tokens that each has."""
    weights = (mix.domain_weights, mix.lang_weights, mix.source_weights)
    out: dict = {}

    def go(prefix: tuple, names: list[tuple], budget: float) -> None:
        depth = len(prefix)
        if depth == 3:
            out[prefix] = int(budget)
            return
        kids: dict = {}
        for n in names:
            kids.setdefault(n[depth], []).append(n)
        order = sorted(kids)
        most = [float(mix.epochs * sum(leaves[n] for n in kids[k])) for k in order]
        for k, b in zip(order, spread(budget, [weights[depth].get(k, mix.default) for k in order], most), strict=True):
            go((*prefix, k), kids[k], b)

    go((), list(leaves), mix.share * sum(leaves.values()))
    return out


def _leaf(mix: Mixture) -> tuple[Column, Column, Column]:
    source = F.coalesce(F.col("source").cast("string"), F.lit(""))
    domain = F.lit("other")
    for name, members in mix.domains.items():
        domain = F.when(source.isin(*members), F.lit(name)).otherwise(domain)
    return domain, F.coalesce(F.col("lang").cast("string"), F.lit("")), source


def _placed(docs: DataFrame, mix: Mixture) -> DataFrame:
    """(doc_id, tokens, domain, language, origin), without the texts."""
    d, lang, source = _leaf(mix)
    tokens = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(r"\S+")), F.lit(0)).cast("long")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), tokens.alias("tokens"), d.alias("domain"), lang.alias("language"), source.alias("origin"))


def _order(doc_id: Column, epoch: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), epoch, F.coalesce(doc_id, F.lit(-1)))


LEAF = ["domain", "language", "origin"]


def cutoffs(placed: DataFrame, mix: Mixture) -> DataFrame:
    """(domain, language, origin, whole, cutoff): the epochs that a leaf reads whole, and the last order hash of the next (null: none)."""
    spark = placed.sparkSession
    # One row a leaf: as many as there are sources, however many documents.
    found = placed.groupBy(*LEAF).agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("n")).collect()
    supply = {(r.domain, r.language, r.origin): r.tokens for r in found}
    bits = max(BITS, (max((r.n for r in found), default=0) // INTERVAL_ROWS).bit_length())
    rows = []
    for leaf, quota in quotas(supply, mix).items():
        have = supply[leaf]
        whole = min(mix.epochs, quota // have) if have else 1
        rows.append((*leaf, int(whole), int(quota - whole * have) if whole < mix.epochs and have else 0))
    leaves = spark.createDataFrame(rows, "domain string, language string, origin string, whole long, rest long")
    cut = placed.join(F.broadcast(leaves.filter("rest > 0")), LEAF)
    cut = cut.withColumn("u", _order(F.col("doc_id"), F.col("whole") + 1, mix.seed)).withColumn("part", F.shiftright("u", 64 - bits))
    parts = cut.groupBy(*LEAF, "rest", "part").agg(F.sum("tokens").alias("n"))
    up = Window.partitionBy(*LEAF).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    edge = parts.withColumn("before", F.coalesce(F.sum("n").over(up), F.lit(0))).filter("before < rest")
    last = edge.groupBy(*LEAF).agg(F.max_by(F.struct("part", "before"), "part").alias("e")).select(*LEAF, F.col("e.part").alias("part"), F.col("e.before").alias("before"))
    inside = cut.join(F.broadcast(last), [*LEAF, "part"]).groupBy(*LEAF, "rest", "before", "u").agg(F.sum("tokens").alias("n"))
    below = Window.partitionBy(*LEAF).orderBy("u").rowsBetween(Window.unboundedPreceding, -1)
    ends = inside.withColumn("at", F.col("before") + F.coalesce(F.sum("n").over(below), F.lit(0))).filter("at < rest").groupBy(*LEAF).agg(F.max("u").alias("cutoff"))
    return leaves.select(*LEAF, "whole").join(ends, LEAF, "left")


def _with_reads(docs: DataFrame, mix: Mixture) -> tuple[DataFrame, str]:
    """docs, and one more column that none of docs' clashes with: how often a document is read, 1 or more."""
    placed = materialise(_placed(docs, mix), "placed")
    ends = materialise(cutoffs(placed, mix), "cutoffs")
    x = own_prefix(docs.columns)
    named = ends.select(*[F.col(c).alias(f"{x}of_{c}") for c in ends.columns])
    own = docs.withColumns({f"{x}{c}": v for c, v in zip(LEAF, _leaf(mix), strict=True)})
    own = own.join(F.broadcast(named), [F.col(f"{x}{c}") == F.col(f"{x}of_{c}") for c in LEAF])
    u = _order(F.col("doc_id").cast("long"), F.col(f"{x}of_whole") + 1, mix.seed)
    times = F.col(f"{x}of_whole") + F.when(u <= F.col(f"{x}of_cutoff"), 1).otherwise(0)
    own = own.withColumn(f"{x}reads", times.cast("long")).filter(F.col(f"{x}reads") > 0)
    return own.select(*[F.col(f"`{c}`") for c in docs.columns], f"{x}reads"), f"{x}reads"


def mixed(docs: DataFrame, mix: Mixture = PRODUCTION) -> DataFrame:
    """docs with `epochs_read` (in place of a column of that name), how often a document is read, without those never read."""
    own, reads = _with_reads(docs.drop("epochs_read"), mix)
    return own.withColumnRenamed(reads, "epochs_read")


def mix_report(docs: DataFrame, mix: Mixture) -> DataFrame:
    """Per document read: doc_id, domain, lang, source, tokens, epochs_read."""
    d, lang, source = _leaf(mix)
    tokens = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(r"\S+")), F.lit(0)).cast("long")
    return mixed(docs, mix).select("doc_id", d.alias("domain"), lang.alias("lang"), source.alias("source"), tokens.alias("tokens"), "epochs_read")


def take(docs: DataFrame, mix: Mixture = PRODUCTION) -> DataFrame:
    """docs as the mixture reads them, in docs' own columns: a document read n times stands n times."""
    chosen, reads = _with_reads(docs, mix)
    if mix.epochs > 1:
        chosen = chosen.withColumn(reads, F.explode(F.sequence(F.lit(1), F.col(reads).cast("int"))))
    return chosen.drop(reads)
