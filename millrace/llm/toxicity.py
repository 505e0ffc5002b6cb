"""Toxicity: a factorization machine over hashed terms.

Terms are a text's distinct lower-cased words and the first three to six letters of longer words, hashed to `BITS` bits. From a bounded labelled sample (`max_train` rows) the `terms` terms (1000) in at
least `min_docs` (3) of its texts that tell the classes apart best, by chi-squared, are the model's features, and a factorization machine learns a
weight and a short vector for each: the products of vectors are the pairwise interactions that a
linear model lacks. These bounds fit the model; every text is scored whole.

Defined cases: as in `quality`: null text is empty; without labels of both classes every text
gets the smoothed share of label 1 (0.5 without labels); null ids or labels are not learned
from; repeated rows score alike; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.scoring import in_order, scored, training_rows

BITS = 22
PREFIXES = (3, 4, 5, 6)
_WORD = re.compile(r"\w+").findall


def terms_of(word: str) -> list[int]:
    out = [word, *(f"{k}:{word[:k]}" for k in PREFIXES if len(word) > k)]
    return [zlib.crc32(t.encode()) >> (32 - BITS) for t in out]


class Terms(dict):
    """word -> its terms; emptied when it grows past `most`."""

    most = 300_000

    def __init__(self, kept=None):
        self.kept = kept

    def __missing__(self, word: str) -> tuple:
        if len(self) >= self.most:
            self.clear()
        t = terms_of(word)
        out = self[word] = tuple(t if self.kept is None else (self.kept[x] for x in t if x in self.kept))
        return out


_ALL = Terms()


def features(text: str) -> np.ndarray:
    """The distinct terms of the whole text."""
    out: set = set()
    for w in set(_WORD(text.lower())):
        out.update(_ALL[w])
    return np.fromiter(sorted(out), np.int32, len(out))


@dataclass
class Model:
    base: float
    kept: dict
    w: np.ndarray
    v: np.ndarray
    cache: Terms = field(default=None, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"cache": None}

    def score(self, texts: list[str]) -> np.ndarray:
        if self.cache is None:
            self.cache = Terms(self.kept)
        out = np.full(len(texts), self.base)
        for i, t in enumerate(texts):
            own: set = set()
            for w in set(_WORD(t.lower())):
                if x := self.cache[w]:
                    own.update(x)
            if own:
                at = np.fromiter(sorted(own), np.int64, len(own))
                v = self.v[at]
                out[i] += self.w[at].sum() + 0.5 * float((v.sum(0) ** 2 - (v * v).sum(0)).sum())
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def fit(rows: list[np.ndarray], y: np.ndarray, terms: int = 1000, min_docs: int = 3, factors: int = 4, updates: int = 1500, batch: int = 64, rate: float = 0.1, ridge: float = 1e-4, seed: int = 7) -> Model:
    n = len(y)
    prior = float(np.log((y.sum() + 0.5) / (n - y.sum() + 0.5))) if n else 0.0
    if not n or y.min() == y.max():
        return Model(prior, {}, np.zeros(0), np.zeros((0, factors)))
    flat = np.concatenate(rows)
    doc = np.repeat(np.arange(n), [len(r) for r in rows])
    both = np.bincount(flat, minlength=1 << BITS)
    pos = np.bincount(flat, y[doc], minlength=1 << BITS)
    names = np.flatnonzero(both >= min_docs)
    a, m, p = pos[names], both[names], y.sum()
    chi = n * (a * n - m * p) ** 2 / np.maximum(1.0, m * p * (n - m).clip(1) * (n - p))
    names = np.sort(names[np.argsort(-chi, kind="stable")[: min(terms, n)]])
    kept = {int(h): i for i, h in enumerate(names)}
    known = np.full(1 << BITS, -1, np.int32)
    known[names] = np.arange(len(names))
    at = known[flat]
    doc, at = doc[at >= 0], at[at >= 0]
    start = np.searchsorted(doc, np.arange(n + 1))
    rng = np.random.default_rng(seed)
    w, v = np.zeros(len(names)), rng.normal(0, 0.01, (len(names), factors))
    base, gw, gv = prior, np.full(len(names), 1e-6), np.full((len(names), factors), 1e-6)
    parts = max(1, n // batch)
    for _ in range(-(-updates // parts)):
        for part in np.array_split(rng.permutation(n), parts):
            size = start[part + 1] - start[part]
            own = np.repeat(np.arange(len(part)), size)
            pick = np.repeat(start[part], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            j = at[pick]
            total = np.zeros((len(part), factors))
            for f in range(factors):
                total[:, f] = np.bincount(own, v[j, f], len(part))
            square = np.bincount(own, (v[j] ** 2).sum(1), len(part))
            z = base + np.bincount(own, w[j], len(part)) + 0.5 * ((total**2).sum(1) - square)
            miss = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[part]
            base -= 0.01 * miss.mean()
            live = np.unique(j)
            step = np.bincount(j, miss[own], len(w))[live] / len(part) + ridge * w[live]
            gw[live] += step**2
            w[live] -= rate * step / np.sqrt(gw[live])
            for f in range(factors):
                step = np.bincount(j, miss[own] * (total[own, f] - v[j, f]), len(w))[live] / len(part) + ridge * v[live, f]
                gv[live, f] += step**2
                v[live, f] -= 0.2 * rate * step / np.sqrt(gv[live, f])
    return Model(base, kept, w, v)


def train(docs: DataFrame, labels: DataFrame, max_train: int = 8_000, modulus: int = 4, held_out: int = 2, terms: int = 1000, min_docs: int = 3) -> Model:
    """The terms are chosen where the rows are; only their numbers in each row (`terms` at most) come to the driver."""
    rows = training_rows(docs, labels, "toxic", modulus, held_out, max_train, features, "int")
    n, p = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not 0 < p < n:
        return fit([np.zeros(0, np.int64)] * n, np.full(n, float(p > 0)), terms, min_docs)
    m, a = F.col("m").cast("double"), F.col("a").cast("double")
    chi = n * (a * n - m * p) ** 2 / F.greatest(F.lit(1.0), m * p * F.greatest(n - m, F.lit(1.0)) * (n - p))
    counted = rows.select("y", F.explode("f").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("m"), F.sum("y").alias("a")).filter(F.col("m") >= min_docs)
    best = counted.orderBy(chi.desc(), "term").limit(min(terms, n)).select("term").collect()
    kept = np.array(sorted(r.term for r in best), np.int32)

    def pick(it):
        for rb in it:
            f = [np.intersect1d(np.array(x, np.int32), kept, assume_unique=True) for x in rb.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([rb.column(0), rb.column(1), pa.array(f, pa.list_(pa.int32()))], names=["doc_id", "y", "f"])

    known = in_order(rows.mapInArrow(pick, "doc_id long, y int, f array<int>"))
    return fit([np.array(r.f, np.int64) for r in known], np.array([r.y for r in known], float), terms, min_docs)


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_train: int = 8_000) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    held = docs.sparkSession.sparkContext.broadcast(train(docs, labels, max_train))
    return scored(docs, lambda texts: held.value.score(texts), 4, 2, threshold)
