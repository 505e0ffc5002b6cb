"""MinHash near-dedup with tensored banding.

Two small collections of half-keys (each a hash of `half` minhashes) are computed; every
pair of one half-key from either collection is a table key, so side*side tables cost only
2*side*half minhashes. With 10 and 3, a pair of likeness 0.85 shares a table with probability 0.9998, one of 0.8 with 0.998. Candidates sharing a table are thinned on their signatures and
confirmed on full shingle sets.

1. Documents with equal shingle sets form a class; only the smallest id of each class goes on.
2. Tables that hold two classes or more give candidate edges. Inside a table a class is
   compared with leaders only: a class becomes a leader unless its estimated likeness to one
   is at least the threshold. Any class as like as the threshold to a covered class has, by
   the triangle inequality of the Jaccard distance, a likeness of at least 2*threshold-1 to
   that leader, less the estimate's error; edges are kept down to `loose`, below that bound.
   A table of more than `table_rows` classes is cut into parts by hash, each with leaders of its own, whose
   leaders are then compared with each other in blocks: theirs is at least 3*threshold-2, and edges go down to `looser`.
3. Connected candidates form a cluster. First those edges that are likely links are confirmed on full sets, which
   joins copies of one text without comparing them with each other.
4. In clusters that this leaves in several parts, members of different parts are compared on full sets. A cluster above
   `block` documents is cut into blocks; the blocks of its largest part meet only the blocks of the others.

Defined cases: no words or null text give an empty set, linked with nothing; fewer words
than a shingle give the whole sequence as the one shingle; equal texts link; a null doc_id is
left alone as its own component (null); extra columns are ignored. Repeated ids share a row's
fate: their sets are linked under one id, and each keeps its own n_shingles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import materialise
from millrace.llm.graph import connected_components

#: Candidate tables of at most so many rows (24 bytes each) are broadcast to the texts; larger ones are joined by shuffle.
BROADCAST_ROWS = 500_000
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


class WordHashes(dict):
    """word -> 64-bit hash; emptied when it grows past `most`."""

    most = 300_000

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.most:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_WORDS = WordHashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * MIX[0]
    x = x ^ (x >> np.uint64(29))
    x = x * MIX[1]
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, k: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the k-word shingles of text."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - k + 1)
    out = np.full(n, min(k, len(h)), np.uint64)
    for i in range(min(k, len(h))):
        out = _mixed(out * MIX[2] + h[i : i + n])
    return np.unique(out)


def _seeds(count: int) -> tuple[np.ndarray, np.ndarray]:
    x = _mixed(np.arange(1, 2 * count + 1, dtype=np.uint64) * MIX[2])
    return x[:count] | np.uint64(1), x[count:]


def signatures(sets: list[np.ndarray], count: int) -> np.ndarray:
    """Row i: count 32-bit minhashes of the non-empty set i."""
    a, b = _seeds(count)
    out = np.empty((len(sets), count), np.uint32)
    lo = 0
    while lo < len(sets):
        hi, total = lo, 0
        while hi < len(sets) and (hi == lo or total + len(sets[hi]) <= 50_000):
            total += len(sets[hi])
            hi += 1
        flat = np.concatenate(sets[lo:hi])
        start = np.cumsum([0, *(len(x) for x in sets[lo : hi - 1])])
        for i in range(count):
            out[lo:hi, i] = np.minimum.reduceat((flat * a[i] + b[i]) >> np.uint64(32), start)
        lo = hi
    return out


def table_keys(sig: np.ndarray, side: int, half: int) -> np.ndarray:
    """side*side keys: every half-key of the first collection with every one of the second."""
    parts = sig.astype(np.uint64).reshape(2 * side, half)
    own = np.arange(2 * side, dtype=np.uint64)
    for i in range(half):
        own = _mixed(own * MIX[2] + parts[:, i])
    return _mixed(own[:side, None] * MIX[1] + own[None, side:]).ravel().view(np.int64)


def sketched(docs: DataFrame, k: int, side: int, half: int) -> DataFrame:
    """(doc_id, n_shingles, set_key, keys, sig): keys and sig are null for empty sets."""
    schema = "doc_id long, n_shingles long, set_key binary, keys array<long>, sig binary"
    count = 2 * side * half

    def sketch(it):
        import xxhash

        for rb in it:
            for lo in range(0, rb.num_rows, 1000):
                part = rb.slice(lo, 1000)
                sets = [shingles(t, k) for t in part.column(1).to_pylist()]
                n = [len(x) for x in sets]
                sig = iter(signatures([x for x in sets if len(x)], count))
                own = [next(sig) if m else None for m in n]
                key = [xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None for x in sets]
                keys = [None if x is None else table_keys(x, side, half) for x in own]
                sigs = [None if x is None else x.tobytes() for x in own]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(sigs, pa.binary())],
                    names=["doc_id", "n_shingles", "set_key", "keys", "sig"],
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(sketch, schema)


class _Leaders:
    """The leaders of one part of a table, and the forest of edges that connects them."""

    def __init__(self, width: int):
        self.n, self.ids, self.up, self.sigs = 0, [], [], np.zeros((0, width), np.uint32)

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def add(self, id_: int, sig: np.ndarray) -> None:
        if self.n == len(self.sigs):
            grown = np.zeros((max(8, 2 * self.n), len(sig)), np.uint32)
            grown[: self.n] = self.sigs[: self.n]
            self.sigs = grown
        self.sigs[self.n] = sig
        self.ids.append(id_)
        self.up.append(self.n)
        self.n += 1

    def meet(self, id_: int, sig: np.ndarray, threshold: float, loose: float) -> list[tuple]:
        """Edges (a, b, likely a link) that connect a class with every leader like it: a spanning forest of them."""
        like = (self.sigs[: self.n] == sig).mean(axis=1)
        near = np.flatnonzero(like >= loose)
        covered = len(near) and like.max() >= threshold
        if not covered:
            self.add(id_, sig)
        if not len(near):
            return []
        # A covered class has its closest leader's edge, the likeliest to be a link.
        best = int(near[np.argmax(like[near])])
        out = [(id_, self.ids[best], bool(like[best] >= threshold - LIKELY))]
        first = self.root(best)
        for j in near:
            other = self.root(int(j))
            if other != first:
                self.up[other] = first
                out.append((self.ids[best], self.ids[int(j)], False))
        if not covered:
            self.up[self.n - 1] = first
        return out


#: Edges whose estimate is at most so far below the threshold are confirmed by themselves; the others only hold clusters together.
LIKELY = 0.1
FOUND = "a long, b long, likely boolean, key long, id long, sig binary"


def _found(edges: set, leaders: list) -> pa.RecordBatch:
    """Edges, and leaders (key, id, sig) of cut tables."""
    pairs = sorted({(int(max(a, b)), int(min(a, b)), likely) for a, b, likely in edges if a != b})
    no = [None] * len(leaders), [None] * len(pairs)
    columns = [*([e[k] for e in pairs] + no[0] for k in range(3)), *(no[1] + [x[k] for x in leaders] for k in range(3))]
    types = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["a", "b", "likely", "key", "id", "sig"])


def _table_edges(threshold: float, loose: float):
    """Over rows (key, part, parts, id, sig) sorted by key and part: the candidate edges of each part, at most about leaders x rows compared."""

    def run(it):
        at, state, cut = None, None, False
        for rb in it:
            if not rb.num_rows:
                continue
            keys, part, parts, ids = (rb.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            sigs = np.frombuffer(b"".join(rb.column(4).to_pylist()), np.uint32).reshape(rb.num_rows, -1)
            edges: set = set()
            leaders: list = []
            for i in range(rb.num_rows):
                if at != (keys[i], part[i]):
                    if cut:
                        leaders += [(int(at[0]), int(x), y.tobytes()) for x, y in zip(state.ids, state.sigs, strict=False)]
                    at, state, cut = (keys[i], part[i]), _Leaders(sigs.shape[1]), parts[i] > 1
                edges.update(state.meet(ids[i], sigs[i], threshold, loose))
            yield _found(edges, leaders)
        if cut:
            yield _found(set(), [(int(at[0]), int(x), y.tobytes()) for x, y in zip(state.ids, state.sigs, strict=False)])

    return run


def _leader_edges(looser: float):
    """A task's leaders (mine, id, sig) of blocks i and j -> a forest of the pairs across (or within, if i is j) that are like."""

    def run(key, table):
        _, i, j = (x.as_py() for x in key)
        mine = table.column("mine").to_numpy()
        ids = table.column("id").to_numpy()
        sigs = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint32).reshape(len(ids), -1)
        one, other = np.flatnonzero(mine == i), np.flatnonzero(mine == j)
        up = np.arange(len(ids))

        def root(x: int) -> int:
            while up[x] != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        a, b = [], []
        for x in one:
            for y in other[(sigs[other] == sigs[x]).mean(axis=1) >= looser]:
                p, q = root(int(x)), root(int(y))
                if p != q:
                    up[p] = q
                    a.append(int(max(ids[x], ids[y]))), b.append(int(min(ids[x], ids[y])))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _in_blocks(rows: DataFrame, key: str, by: str, size: int, columns: list[str]) -> DataFrame:
    """Each row (with n, the rows of its key) once for every other block of its key: i and j, the task's blocks, and mine."""
    blocks = F.ceil(F.col("n") / size).cast("int")
    cut = rows.withColumn("mine", F.pmod(F.xxhash64(by), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return cut.select(key, F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", *columns)


def candidate_edges(reps: DataFrame, threshold: float, loose: float, looser: float, table_rows: int) -> DataFrame:
    """reps (id, keys, sig) -> (a, b, likely)."""
    rows = reps.select("id", F.explode("keys").alias("key"))
    # One shuffle of (key, id): the window's sort also tells which tables hold two classes or more.
    hits = rows.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("key"))).filter("n > 1").select("key", "id", "n")
    hits = materialise(hits, "tables")
    parts = F.ceil(F.col("n") / table_rows).cast("int")
    full = hits.join(reps.select("id", "sig"), "id").select("key", F.pmod(F.xxhash64("id"), parts).cast("int").alias("part"), parts.alias("parts"), "id", "sig")
    found = full.repartition("key", "part").sortWithinPartitions("key", "part", "id").mapInArrow(_table_edges(threshold, loose), FOUND)
    found = materialise(found, "found")
    edges = found.filter("a is not null").select("a", "b", "likely")
    leaders = found.filter("id is not null").select("key", "id", "sig")
    if not leaders.isEmpty():
        counted = leaders.join(leaders.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "key")
        met = _in_blocks(counted, "key", "id", table_rows, ["id", "sig"]).groupBy("key", "i", "j").applyInArrow(_leader_edges(looser), "a long, b long")
        edges = edges.unionAll(met.withColumn("likely", F.lit(False)))
    return edges.groupBy("a", "b").agg(F.max("likely").alias("likely"))


def _linked(ids: list, sets: list, parts: list, num: int, den: int, split: int | None = None) -> list[tuple]:
    """A spanning forest of the links (den*|A&B| >= num*|A|B|) among sets of different parts, as (id, root id).

    Each set in turn is compared at once with all sets that it isn't linked with yet; split: only
    pairs across that position count.
    """
    n = len(ids)
    size = np.array([len(s) for s in sets])
    order = np.argsort(size, kind="stable")
    size = size[order]
    flat = np.concatenate([sets[i] for i in order])
    _, flat = np.unique(flat, return_inverse=True)
    start = np.concatenate([[0], np.cumsum(size)])
    left = np.array([split is None or i < split for i in order])
    parent = np.arange(n)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    flag = np.zeros(int(flat.max()) + 1 if len(flat) else 1, np.int32)
    label = np.unique(np.array(parts)[order], return_inverse=True)[1].reshape(-1)
    for i in range(n):
        end = int(np.searchsorted(size, size[i] * den / num, "right"))
        if end <= i + 1:
            continue
        other = np.arange(i + 1, end)
        other = other[label[other] != label[i]]
        if split is not None:
            other = other[left[other] != left[i]]
        if not len(other):
            continue
        own = flat[start[i] : start[i + 1]]
        flag[own] = 1
        if len(other) > (end - i) // 4:
            both = np.add.reduceat(flag[flat[start[i + 1] : start[end]]], start[i + 1 : end] - start[i + 1])[other - i - 1]
        else:
            both = np.array([flag[flat[start[j] : start[j + 1]]].sum() for j in other])
        flag[own] = 0
        for j in other[den * both >= num * (size[i] + size[other] - both)]:
            a, b = root(i), root(int(j))
            if a != b:
                parent[max(a, b)] = min(a, b)
                label[label == label[j]] = label[i]
    groups: dict = {}
    for i in range(n):
        groups.setdefault(root(i), []).append(ids[order[i]])
    return [(x, min(g)) for g in groups.values() if len(g) > 1 for x in g if x != min(g)]


#: A leader's edges are confirmed in lots of about so many.
LOT = 500


def _confirmed(edges: DataFrame, full: DataFrame, num: int, den: int) -> DataFrame:
    """The edges (a, b) that are links by the full sets (node, s)."""
    # Leaders of many edges are copied once a lot, so that no task holds them all; these are fewer than edges / LOT.
    hot = edges.groupBy("b").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > LOT).select("b", F.ceil(F.col("n") / LOT).cast("int").alias("lots"))
    hot = materialise(hot, "hot")
    lots = F.coalesce("lots", F.lit(1))
    dealt = edges.join(F.broadcast(hot), "b", "left").select("a", "b", F.pmod(F.xxhash64("a"), lots).cast("int").alias("lot"))
    one = full.select(F.col("node").alias("a"), F.col("s").alias("sa"))
    led = edges.select("b").distinct().join(full.select(F.col("node").alias("b"), F.col("s").alias("sb")), "b").join(F.broadcast(hot), "b", "left")
    led = led.select("b", F.explode(F.sequence(F.lit(0), lots - 1)).alias("lot"), "sb")
    both = dealt.join(one, "a").join(led, ["b", "lot"]).select("a", "b", "sa", "sb")

    def check(it):
        for rb in it:
            keep = []
            for x, y in zip(rb.column(2), rb.column(3), strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                # Both are sorted and distinct.
                n = len(np.intersect1d(x, y, assume_unique=True)) if den * min(len(x), len(y)) >= num * max(len(x), len(y)) else 0
                keep.append(n > 0 and den * n >= num * (len(x) + len(y) - n))
            out = pa.RecordBatch.from_arrays([rb.column(0), rb.column(1)], names=["a", "b"])
            yield out.filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(check, "a long, b long")


def confirmed_links(docs: DataFrame, edges: DataFrame, clusters: DataFrame, k: int, num: int, den: int, block: int) -> DataFrame:
    """Candidate edges (a, b, likely) and their clusters (node, component) -> (a, b) links confirmed on full sets, enough to connect what all links connect."""
    members = clusters
    if clusters.count() <= BROADCAST_ROWS:
        members = F.broadcast(members)
    text = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("string")).join(members, "node")

    def sets(it):
        for rb in it:
            s = [shingles(x, k).tobytes() for x in rb.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(s, pa.binary())], names=["node", "s"])

    full = text.select("node", "text").mapInArrow(sets, "node long, s binary")
    # Repeated ids have their sets linked under one id; equal ones are one.
    full = materialise(full, "sets")
    sure = materialise(_confirmed(edges.filter("likely").select("a", "b"), full, num, den), "sure")
    of = clusters.join(connected_components(sure).withColumnRenamed("component", "part"), "node", "left").withColumn("part", F.coalesce("part", "node"))
    of = materialise(of, "parts")
    sizes = of.groupBy("component", "part").agg(F.count(F.lit(1)).alias("m"))
    whole = sizes.groupBy("component").agg(F.sum("m").alias("n"), F.max("m").alias("most"), F.max_by("part", F.struct("m", "part")).alias("major"), F.count(F.lit(1)).alias("parts"))
    # Only clusters in several parts have pairs left to compare.
    left = of.join(whole.filter("parts > 1"), "component").select("node", "component", "part", "n", "most", F.col("part").eqNullSafe(F.col("major")).alias("in_major"))
    left = materialise(left, "left")
    if left.count() <= BROADCAST_ROWS:
        left = F.broadcast(left)
    rows = full.join(left, "node")
    small = rows.filter(F.col("n") <= block).select("component", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("mine"), "node", "part", "s")
    # Above `block`: by hash into blocks. Blocks grow with the root of the cluster, to seven
    # times `block`, which keeps tasks even in middling clusters and copies few in large ones.
    wide = F.greatest(F.lit(block), F.least(F.lit(7 * block), F.sqrt("n") * (6 * block / 300)))
    first, others = F.ceil(F.col("most") / wide).cast("int"), F.ceil((F.col("n") - F.col("most")) / wide).cast("int")
    own = F.when(F.col("in_major"), F.pmod(F.xxhash64("node"), first)).otherwise(first + F.pmod(F.xxhash64("node"), others)).cast("int")
    # The major part's blocks, 0 to first-1, meet the other blocks only.
    meets = F.sequence(F.when(F.col("in_major"), first).otherwise(0), first + others - 1)
    large = rows.filter(F.col("n") > block).withColumn("mine", own).withColumn("other", F.explode(meets))
    large = large.select("component", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "node", "part", "s")

    def links(key, table):
        component, i, j = (x.as_py() for x in key)
        mine = np.array(table.column("mine").to_pylist())
        order = np.argsort(mine, kind="stable")
        ids = table.column("node").to_numpy()[order].tolist()
        parts = table.column("part").to_numpy()[order].tolist()
        raw = table.column("s").to_pylist()
        rows = [np.frombuffer(raw[o], np.uint64) for o in order]
        found = _linked(ids, rows, parts, num, den, None if i == j else int((mine == i).sum()))
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([x for _, x in found], pa.int64())})

    return sure.unionAll(small.unionAll(large).groupBy("component", "i", "j").applyInArrow(links, "a long, b long"))


def near_duplicates(
    docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, side: int = 10, half: int = 3, loose: float | None = None, block: int = 300, table_rows: int = 2000
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row; links are den*|A&B| >= num*|A|B|."""
    threshold = num / den
    loose = loose if loose is not None else max(0.3, 2 * threshold - 1 - 0.14)
    sketches = materialise(sketched(docs, k, side, half), "sketch")
    filled = sketches.filter("set_key is not null and doc_id is not null")
    classes = filled.groupBy("set_key").agg(F.min("doc_id").alias("id"), F.min_by(F.struct("keys", "sig"), "doc_id").alias("x"))
    classes = materialise(classes.select("set_key", "id", "x.keys", "x.sig"), "classes")
    looser = min(loose, max(0.25, 3 * threshold - 2 - 0.14))
    near = materialise(candidate_edges(classes.select("id", "keys", "sig"), threshold, loose, looser, table_rows), "near")
    clusters = materialise(connected_components(near), "clusters")
    links = confirmed_links(docs.select("doc_id", "text"), near, clusters, k, num, den, block)
    linked = connected_components(links)
    of_class = classes.select("set_key", "id").join(linked, F.col("id") == F.col("node"), "left")
    of_class = of_class.select("set_key", F.coalesce("component", "id").alias("component_id"))
    out = sketches.select("doc_id", "n_shingles", "set_key").join(of_class, "set_key", "left")
    # A null id stays alone, whatever its text.
    out = out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """docs with one document of each group of near-duplicates, the one of the smallest id; of rows that share that id all stay."""
    gone = near_duplicates(docs.select("doc_id", "text"), **options).filter("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")
