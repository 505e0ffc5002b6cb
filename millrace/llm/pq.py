"""Embedding near-dedup with an inverted file and product quantisation.

1. Equal vectors form a class of one representative and a multiplicity.
2. Coarse centroids and residual codebooks are fitted on a bounded sample (`train` vectors).
3. Every representative is put in the list of its nearest centroid, as residual subspace codes with
   the norm of what the codes leave out. Lists are packed into blocks of at most about `block` members,
   a row each; a larger list takes several.
4. Two blocks meet if any of their lists can hold a linked pair: by the triangle inequality only where
   the centroids are no further apart than both radii and the threshold's distance. In a meeting, a vector
   asks every list that its own distance from the centroid lets it reach. The asymmetric distance is
   the product with the decoded codes; a pair goes on only if that plus the member's left-out norm
   reaches the threshold. All three are bounds, so nothing is lost; the exact cosine decides.
5. A task returns sums per vector and a spanning forest of its links, never the pairs.

Every pair at the threshold is found, whatever the table's size. Where no bound tells lists apart (vectors
spread evenly), that is every pair of blocks: the work is then quadratic, with no shuffle of it.

Defined cases: vectors that are null, empty, zero, of another length than the first in id order, or
hold null or non-finite components link with nothing; equal vectors link with each other; a
null vec_id is kept alone, with a null component; repeated ids share a component, and each row's links
count all other rows linked with it; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import materialise
from millrace.llm.graph import connected_components


def _kmeans(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        at = _nearest(x, c)
        n = np.bincount(at, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, at, x)
        c[n > 0] = sums[n > 0] / n[n > 0, None]
        if (n == 0).any():
            c[n == 0] = x[rng.choice(len(x), int((n == 0).sum()))]
    return c


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    half = (c * c).sum(1) / 2
    return np.concatenate([np.argmax(x[i : i + 4096] @ c.T - half, axis=1) for i in range(0, len(x), 4096)]) if len(x) else np.zeros(0, int)


@dataclass
class Index:
    coarse: np.ndarray  # (lists, dim)
    books: np.ndarray  # (subspaces, codes, dim / subspaces)
    order: np.ndarray  # dimensions, padded to whole subspaces

    def decoded(self, at: np.ndarray, codes: np.ndarray) -> np.ndarray:
        parts = np.concatenate([self.books[m][codes[:, m]] for m in range(len(self.books))], axis=1)
        return self.coarse[at] + parts[:, : self.coarse.shape[1]]

    def coded(self, x: np.ndarray, probes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The nearest lists, the codes in the nearest one, and the norm that these leave out."""
        half = (self.coarse**2).sum(1) / 2
        k = min(probes, len(self.coarse))
        lists = np.concatenate([np.argsort(-(x[i : i + 2048] @ self.coarse.T - half), axis=1, kind="stable")[:, :k] for i in range(0, len(x), 2048)])
        rest = _padded(x - self.coarse[lists[:, 0]], len(self.order))
        w = self.books.shape[2]
        codes = np.stack([_nearest(rest[:, m * w : (m + 1) * w], self.books[m]) for m in range(len(self.books))], axis=1).astype(np.uint8)
        left = np.linalg.norm(x - self.decoded(lists[:, 0], codes), axis=1)
        return lists, codes, left


def _padded(x: np.ndarray, width: int) -> np.ndarray:
    return x if x.shape[1] == width else np.pad(x, ((0, 0), (0, width - x.shape[1])))


def fit(x: np.ndarray, lists: int, subspaces: int = 16, codes: int = 64, rounds: int = 8, seed: int = 11) -> Index:
    rng = np.random.default_rng(seed)
    coarse = _kmeans(x, lists, rounds, rng)
    width = -(-x.shape[1] // subspaces) * subspaces
    rest = _padded(x - coarse[_nearest(x, coarse)], width)
    w = width // subspaces
    part = rest[rng.choice(len(rest), min(len(rest), 6000), replace=False)]
    books = [_kmeans(part[:, m * w : (m + 1) * w], codes, rounds, rng) for m in range(subspaces)]
    k = max(len(b) for b in books)
    return Index(coarse, np.stack([np.concatenate([b, np.repeat(b[:1], k - len(b), 0)]) for b in books]), np.arange(width))


def _unit_rows(raw: list) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(vec_id, key) of every row, key null where it links with nothing; and (key, id, mult, vec) of each class."""
    v = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding"))
    first = v.filter("vec_id is not null and embedding is not null and size(embedding) > 0").orderBy("vec_id").select(F.size("embedding").alias("n")).first()
    dim = first.n if first else 0

    def keyed(it):
        import xxhash

        for rb in it:
            keys, vecs = [], []
            for i, e in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist(), strict=True):
                ok = i is not None and e is not None and len(e) == dim and None not in e
                x = np.array(e if ok else [], np.float64) + 0.0
                ok = ok and dim and np.isfinite(x).all() and x.any() and np.isfinite(np.linalg.norm(x)) and np.linalg.norm(x) > 0
                keys.append(xxhash.xxh3_128_digest(x.tobytes()) if ok else None)
                vecs.append(x.tobytes() if ok else None)
            yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(keys, pa.binary()), pa.array(vecs, pa.binary())], names=["vec_id", "key", "vec"])

    rows = materialise(v.mapInArrow(keyed, "vec_id long, key binary, vec binary"), "vectors")
    classes = rows.filter("key is not null").groupBy("key").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("mult"), F.first("vec").alias("vec"))
    return rows.select("vec_id", "key"), materialise(classes, "classes")


COUNTED = "id long, n long, a long, b long"
PACKED = "block int, meets array<int>, ids binary, mults binary, vecs binary, lists binary, codes binary, left_out binary"
#: A task's sums and links are reduced when so many are held.
HELD = 1_000_000


def _labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least node of each node's component, for links a-b."""
    up = np.arange(n)
    while True:
        x, y = up[a], up[b]
        if (x == y).all():
            return up
        np.minimum.at(up, np.maximum(x, y), np.minimum(x, y))
        while (up[up] != up).any():
            up = up[up]


def _forest(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (row, column) that connect what all of the matrix's links connect: a first one of each row and column, until none joins two parts."""
    rows, cols = np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = hit
    while new.any():
        i, j = np.flatnonzero(new.any(1)), np.flatnonzero(new.any(0))
        rows, cols = np.concatenate([rows, i, new[:, j].argmax(0)]), np.concatenate([cols, new[i].argmax(1), j])
        label = _labels(sum(hit.shape), rows, len(hit) + cols)
        new = hit & (label[: len(hit), None] != label[None, len(hit) :])
    return rows, cols


def _links(q: np.ndarray, d: np.ndarray, approx: np.ndarray, left: np.ndarray, threshold: float) -> np.ndarray:
    """Whether each q and d reach the threshold; approx and left: the d decoded, and what that leaves out."""
    # Twice the rounding error of a product of unit vectors in single precision.
    slack = 2.4e-7 * (q.shape[1] + 4)
    q32 = q.astype(np.float32)
    maybe = q32 @ approx.T + left[None, :] >= threshold - slack
    if np.count_nonzero(maybe) > maybe.size // 50:
        cos = q32 @ d.T.astype(np.float32)
        sure = cos >= threshold + slack
        maybe = (cos >= threshold - slack) & ~sure
    else:
        sure = np.zeros(maybe.shape, bool)
    i, j = np.nonzero(maybe)
    for s in range(0, len(i), 65536):
        part = slice(s, s + 65536)
        sure[i[part], j[part]] = np.einsum("ij,ij->i", q[i[part]], d[j[part]]) >= threshold
    return sure


def _reach(c: np.ndarray, x: np.ndarray, low: np.ndarray, high: np.ndarray, far: float) -> np.ndarray:
    """(rows of x, lists): whether a vector can have a partner in a list whose members are between low and high from its centroid."""
    apart = np.sqrt(np.maximum((x * x).sum(1)[:, None] + (c * c).sum(1) - 2 * (x @ c.T), 0))
    return (apart <= high + far) & (apart >= low - far)


def _found(threshold: float, far: float, index, radii):
    """Pairs of blocks -> counts by vector and a forest of links, summed over the task."""

    def block(row):
        ids, mults, lists, left = (np.frombuffer(row[k], t) for k, t in (("ids", np.int64), ("mults", np.int64), ("lists", np.int32), ("left_out", np.float64)))
        x = np.frombuffer(row["vecs"], np.float64).reshape(len(ids), -1)
        codes = np.frombuffer(row["codes"], np.uint8).reshape(len(ids), -1)
        return ids, mults, x / np.linalg.norm(x, axis=1, keepdims=True), lists, codes, left

    def meeting(one, other, same):
        low, high = radii.value
        ix = index.value
        q_id, q_mult, q, *_ = one
        d_id, d_mult, d, lists, codes, left = other
        hit = np.zeros((len(q), len(d)), bool)
        held = np.unique(lists)
        can = _reach(ix.coarse[held], q, low[held], high[held], far)
        approx = ix.decoded(lists, codes).astype(np.float32)
        # Lists that the same vectors reach are asked in one product.
        kinds, kind = np.unique(can, axis=1, return_inverse=True)
        kind = kind.reshape(-1)[np.searchsorted(held, lists)]
        for k in range(kinds.shape[1]):
            i, j = np.flatnonzero(kinds[:, k]), np.flatnonzero(kind == k)
            if len(i):
                hit[np.ix_(i, j)] = _links(q[i], d[j], approx[j], left[j], threshold)
        both = np.intersect1d(q_id, d_id)
        for x in both:
            hit[np.ix_(q_id == x, d_id == x)] = False
        if same:
            hit |= hit.T
        # Sums as float are exact below 2**53.
        counts = [(q_id, (hit @ d_mult.astype(float)).astype(np.int64))]
        if not same:
            counts.append((d_id, (q_mult.astype(float) @ hit).astype(np.int64)))
        a, b = _forest(hit)
        return counts, q_id[a], d_id[b]

    def summed(held):
        ids, at = np.unique(np.concatenate([i for i, _ in held]), return_inverse=True)
        n = np.zeros(len(ids), np.int64)
        np.add.at(n, at, np.concatenate([n for _, n in held]))
        return [(ids[n > 0], n[n > 0])]

    def joined(held):
        ids, at = np.unique(np.concatenate([x for ab in held for x in ab]), return_inverse=True)
        half = np.cumsum([0] + [len(x) for ab in held for x in ab])
        a = np.concatenate([at[half[k] : half[k + 1]] for k in range(0, len(half) - 1, 2)])
        b = np.concatenate([at[half[k] : half[k + 1]] for k in range(1, len(half) - 1, 2)])
        top = ids[_labels(len(ids), a, b)]
        return [(top[top != ids], ids[top != ids])]

    def run(it):
        counts, links = [], []
        for rb in it:
            for at in range(rb.num_rows):
                row = {k: rb.column(i)[at].as_py() for i, k in enumerate(rb.schema.names)}
                same = row["block"] == row["d_block"]
                one = block(row)
                other = one if same else block({k[2:]: v for k, v in row.items() if k.startswith("d_")})
                more, a, b = meeting(one, other, same)
                counts += [(i[n > 0], n[n > 0]) for i, n in more]
                links.append((a, b))
                if sum(len(i) for i, _ in counts) > HELD:
                    counts = summed(counts)
                if sum(len(a) for a, _ in links) > HELD:
                    links = joined(links)
        if not counts:
            return
        (ids, n), (a, b) = summed(counts)[0], joined(links)[0]
        no = pa.nulls(len(a), pa.int64()), pa.nulls(len(ids), pa.int64())
        columns = [pa.concat_arrays(x) for x in ([pa.array(ids), no[0]], [pa.array(n), no[0]], [no[1], pa.array(a)], [no[1], pa.array(b)])]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "a", "b"])

    return run


def _blocks(coarse: np.ndarray, sizes: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """First block, and number of blocks, of each list; each is followed by the nearest one left, so that blocks hold neighbours."""
    order, left = [0], np.ones(len(coarse), bool)
    left[0] = False
    half = (coarse**2).sum(1) / 2
    while left.any():
        order.append(int(np.argmax(np.where(left, coarse @ coarse[order[-1]] - half, -np.inf))))
        left[order[-1]] = False
    first, chunks = np.zeros(len(coarse), np.int64), np.ones(len(coarse), np.int64)
    at, held = 0, 0
    for x in order:
        if held and held + sizes[x] > block:
            at, held = at + 1, 0
        first[x], chunks[x] = at, max(1, -(-sizes[x] // block))
        held += sizes[x]
        if chunks[x] > 1:
            at, held = at + chunks[x], 0
    return first, chunks


def near_vectors(vectors: DataFrame, threshold: float = 0.9, per_list: int = 400, probes: int = 12, train: int = 12_000, most_lists: int = 4096, block: int = 2000) -> DataFrame:
    """Per row: vec_id, n_links, component_id, kept. `probes` bounds nothing: every list within reach is asked."""
    rows, classes = _classes(vectors)
    spark = vectors.sparkSession
    sample = classes.orderBy(F.xxhash64("key"), "key").limit(train).select("vec").collect()
    if not sample:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    lists = int(np.clip(classes.count() // per_list, 1, most_lists))
    fitted = fit(_unit_rows([bytes(r.vec) for r in sample]), lists)
    index = spark.sparkContext.broadcast(fitted)

    def code(it):
        for rb in it:
            if not rb.num_rows:
                continue
            x = _unit_rows(rb.column("vec").to_pylist())
            found, codes, left = index.value.coded(x, 1)
            apart = np.linalg.norm(x - index.value.coarse[found[:, 0]], axis=1)
            yield pa.RecordBatch.from_arrays(
                [rb.column("id"), rb.column("mult"), rb.column("vec"), pa.array(found[:, 0].astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(left), pa.array(apart)],
                names=["id", "mult", "vec", "list", "codes", "left_out", "apart"],
            )

    coded = materialise(classes.select("id", "mult", "vec").mapInArrow(code, "id long, mult long, vec binary, list int, codes binary, left_out double, apart double"), "coded")
    # One row a list.
    sizes, low, high = np.zeros(len(fitted.coarse), np.int64), np.zeros(len(fitted.coarse)), np.zeros(len(fitted.coarse))
    for r in coded.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.min("apart").alias("low"), F.max("apart").alias("high")).collect():
        sizes[r["list"]], low[r["list"]], high[r["list"]] = r.n, r.low, r.high
    far = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-6
    first, chunks = _blocks(fitted.coarse, sizes, block)
    radii = spark.sparkContext.broadcast((low, high))
    full = np.flatnonzero(sizes)
    c = fitted.coarse[full]
    meet = _reach(c, c, low[full] - high[full][:, None], high[full] + high[full][:, None], far)
    of_list = dict(zip(full.tolist(), [full[m] for m in meet], strict=True))
    place = spark.sparkContext.broadcast((first, chunks, of_list))

    def pack(t):
        start, n, reach = place.value
        at = t.column("block")[0].as_py()
        lists = t.column("list").to_numpy().astype(np.int32)
        met = np.unique(np.concatenate([reach[x] for x in np.unique(lists).tolist()]))
        blocks = np.unique(np.concatenate([start[x] + np.arange(n[x]) for x in met]))
        flat = [t.column(k).to_numpy() for k in ("id", "mult", "left_out")]
        one = {
            "block": [at], "meets": [blocks[blocks >= at].astype(np.int32)], "ids": [flat[0].tobytes()], "mults": [flat[1].tobytes()], "vecs": [b"".join(t.column("vec").to_pylist())],
            "lists": [lists.tobytes()], "codes": [b"".join(t.column("codes").to_pylist())], "left_out": [flat[2].tobytes()],
        }
        types = {"block": pa.int32(), "meets": pa.list_(pa.int32())}
        return pa.table({k: pa.array(v, types.get(k, pa.binary())) for k, v in one.items()})

    places = spark.createDataFrame([(int(x), int(first[x]), int(chunks[x])) for x in full], "list int, first int, chunks int")
    members = coded.join(F.broadcast(places), "list").withColumn("block", (F.col("first") + F.pmod(F.xxhash64("id"), F.col("chunks"))).cast("int"))
    packed = materialise(members.groupBy("block").applyInArrow(pack, PACKED), "blocks")
    others = packed.drop("meets").select([F.col(k).alias(f"d_{k}") for k in packed.columns if k != "meets"])
    # Blocks are read again where they meet; nothing is shuffled.
    pairs = packed.join(others.hint("shuffle_replicate_nl"), F.expr("block <= d_block and array_contains(meets, d_block)")).drop("meets")
    found = materialise(pairs.mapInArrow(_found(threshold, far, index, radii), COUNTED), "links")
    counts = found.filter("id is not null").groupBy("id").agg(F.sum("n").alias("n"))
    linked = connected_components(found.filter("a is not null").select("a", "b"))
    by_key = classes.select("key", "id", "mult").join(counts, "id", "left").join(linked, F.col("id") == F.col("node"), "left")
    by_key = by_key.select("key", (F.col("mult") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    out = rows.join(by_key, "key", "left").withColumn("component_id", F.coalesce("component_id", "vec_id"))
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept")
    )
