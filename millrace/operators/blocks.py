"""Vectors compared block by block: products in numpy find what may pass, sums in order of position decide.

Rows are packed into blocks of one dimension. Two blocks meet in one step of a task, so that a pair costs a few
multiplications in single precision and only what comes near the threshold is compared in double precision, by the
same sums in the same order as `functions.vectors.cosine`: equal vectors have equal cosines, and nothing is lost.
Blocks are read again where they meet; nothing is collected, and only a stated query set is broadcast.

Vectors that are null, empty or hold nulls, and vectors of different dimensions, have no cosine. One that isn't finite is
compared in double precision with all; a cosine that is NaN passes, as in SQL.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import _c
from millrace.sources.session import materialise

#: Rows of a block, and of a partition of blocks.
ROWS, PART = 2048, 16_384
#: Pairs compared in double precision at a time.
PAIRS = 1 << 18
#: Bytes of blocks that a task keeps for the next pair.
HELD = 64 << 20


def packed(df: DataFrame, key: str, vec: str, more: Sequence[str] = ()) -> DataFrame:
    """Rows (block, dim, vecs, and arrays of key and of `more`), each block in order of key, nulls last."""
    v = _c(vec)
    rows = df.select(F.col(key), *more, v.alias("_v")).filter(v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull()))
    kind = dict(rows.dtypes)
    if kind["_v"] != "array<float>":
        rows = rows.withColumn("_v", F.col("_v").cast("array<double>"))
    width = np.float32 if kind["_v"] == "array<float>" else np.float64
    most = ROWS
    names = [key, *more]

    def cut(held, dim, block):
        t = pa.Table.from_batches(held).combine_chunks()
        t = t.take(pc.sort_indices(t.column(0), null_placement="at_end"))
        lists = [pa.ListArray.from_arrays([0, t.num_rows], t.column(i).combine_chunks()) for i in range(len(names))]
        v = t.column(len(names)).combine_chunks()
        flat = np.ascontiguousarray(v.flatten().to_numpy(zero_copy_only=False), width)
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([dim], pa.int32()), pa.array([width(0).itemsize], pa.int32()), pa.array([flat.tobytes()], pa.binary()), *lists], names=["block", "dim", "width", "vecs", *names])

    def pack(it):
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 20
        held: dict[int, list] = {}
        for rb in it:
            sizes = pc.list_value_length(rb.column(len(names)))
            for dim in pc.unique(sizes).to_pylist():
                rest = rb.filter(pc.equal(sizes, dim))
                while rest.num_rows:
                    own = held.setdefault(dim, [])
                    room = most - sum(x.num_rows for x in own)
                    own.append(rest.slice(0, room))
                    rest = rest.slice(room)
                    if sum(x.num_rows for x in own) == most:
                        yield cut(held.pop(dim), dim, block)
                        block += 1
        for dim, own in held.items():
            yield cut(own, dim, block)
            block += 1

    schema = "block long, dim int, width int, vecs binary, " + ", ".join(f"`{c}` array<{kind[c]}>" for c in names)
    n = rows.count()
    own = max(1, -(-n // PART), min(rows.sparkSession.sparkContext.defaultParallelism, -(-n // 1024)))
    return materialise(rows.repartition(own).mapInArrow(pack, schema), "blocks").repartition(own)


class Block:
    """A block's vectors, as they are and at unit length, and its columns as Arrow arrays."""

    def __init__(self, row: dict, columns: dict):
        self.columns = columns
        self.x = np.frombuffer(row["vecs"], np.float32 if row["width"] == 4 else np.float64).astype(np.float64).reshape(-1, row["dim"])
        square = np.zeros(len(self.x))
        with np.errstate(all="ignore"):
            for d in range(row["dim"]):
                square += self.x[:, d] * self.x[:, d]
            self.norm = np.sqrt(square)
            finite = np.isfinite(self.norm)
            unit = self.x / np.where(self.norm > 0, self.norm, 1.0)[:, None]
        # What isn't finite, or too short for its square, is never ruled out by the product.
        unit[~finite | ((self.norm < 1e-100) & self.x.any(axis=1))] = np.nan
        self.unit = unit.astype(np.float32)


def likeness(a: Block, b: Block) -> tuple[np.ndarray, float]:
    """Cosines in single precision, NaN where they can't be told, and how far off they may be."""
    with np.errstate(all="ignore"):
        out = a.unit @ b.unit.T
        slack = 2.4e-7 * (a.x.shape[1] + 4)
        least = [x.norm[x.norm > 0].min(initial=1.0) for x in (a, b)]
        if 1e-8 > 1e-6 * least[0] * least[1]:
            p = np.outer(a.norm, b.norm)
            out *= (p / (p + 1e-8)).astype(np.float32)
        else:
            slack += 1e-6
    return out, slack


def exact(a: Block, b: Block, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The cosines of a's rows i with b's rows j, summed in order of position."""
    out = np.empty(len(i))
    with np.errstate(all="ignore"):
        for lo in range(0, len(i), PAIRS):
            p, q = i[lo : lo + PAIRS], j[lo : lo + PAIRS]
            dot = np.zeros(len(p))
            for d in range(a.x.shape[1]):
                dot += a.x[p, d] * b.x[q, d]
            out[lo : lo + PAIRS] = dot / (a.norm[p] * b.norm[q] + 1e-8)
    return out


def _not_below(rough: np.ndarray, cut: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of what isn't below cut; rows whose greatest is below it aren't looked at again."""
    rows = np.flatnonzero(~(rough.max(axis=1) < cut))
    at = np.flatnonzero(~(rough[rows].ravel() < cut))
    return rows[at // rough.shape[1]], at % rough.shape[1]


def alike(a: Block, b: Block, threshold: float, strict: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a and of b whose cosine reaches the threshold, or passes it if strict."""
    rough, slack = likeness(a, b)
    i, j = _not_below(rough, threshold - slack)
    near = rough[i, j]
    sure = near > threshold + slack
    at = np.flatnonzero(~sure)
    c = exact(a, b, i[at], j[at])
    sure[at] = ~(c <= threshold) if strict else ~(c < threshold)
    return i[sure], j[sure]


def meeting(left: DataFrame, right: DataFrame, found: Callable, schema: str, once: bool = False, few: bool = False) -> DataFrame:
    """What `found` (an iterator of pairs of Block, with the right one's number, -> record batches) makes of all pairs of blocks.

    `once`: left and right are the same blocks, and two of them meet once; a block also meets itself. `few`: the right ones are broadcast.
    """
    names = [c for c in left.columns if c not in ("block", "dim", "width", "vecs")]
    others = [c for c in right.columns if c not in ("block", "dim", "width", "vecs")]
    l = left.select([F.col(c).alias(f"l_{c}") for c in left.columns])  # noqa: E741
    r = right.select([F.col(c).alias(f"r_{c}") for c in right.columns])
    meet = F.col("l_dim") == F.col("r_dim")
    if once:
        # Either of the two may stand left, so that tasks have equal shares.
        even = (F.col("l_block") + F.shiftright("l_block", 20) + F.col("r_block") + F.shiftright("r_block", 20)) % 2 == 0
        meet = meet & F.when(even, F.col("l_block") <= F.col("r_block")).otherwise(F.col("l_block") > F.col("r_block"))
    # Without the hint equal dimensions would be dealt by the one dimension there is.
    pairs = l.join(F.broadcast(r), (F.col("l_dim") <= F.col("r_dim")) & (F.col("l_dim") >= F.col("r_dim"))) if few else l.join(r.hint("shuffle_replicate_nl"), meet)

    def run(it):
        def each():
            held: dict[tuple, Block] = {}

            def block(side, rb, at, columns):
                number = rb.column(f"{side}_block")[at].as_py()
                found = held.get((side, number))
                if found is None:
                    row = {c: rb.column(f"{side}_{c}")[at].as_py() for c in ("dim", "width", "vecs")}
                    found = Block(row, {c: rb.column(f"{side}_{c}")[at].values for c in columns})
                    while held and (len(held) + 1) * found.x.nbytes * 2 > HELD:
                        held.pop(next(iter(held)))
                    held[side, number] = found
                return number, found

            for rb in it:
                for at in range(rb.num_rows):
                    (m, a), (n, b) = block("l", rb, at, names), block("r", rb, at, others)
                    yield a, b, m, n

        yield from found(each())

    return pairs.mapInArrow(run, schema)


def near(left: DataFrame, right: DataFrame, l_id: str, r_id: str, threshold: float) -> DataFrame:
    """(left_id, right_id) of all pairs of packed rows whose cosine reaches the threshold."""

    def found(pairs: Iterator) -> Iterator[pa.RecordBatch]:
        for a, b, *_ in pairs:
            i, j = alike(a, b, threshold)
            for lo in range(0, len(i), PAIRS):
                part = slice(lo, lo + PAIRS)
                yield pa.RecordBatch.from_arrays([a.columns[l_id].take(pa.array(i[part])), b.columns[r_id].take(pa.array(j[part]))], names=["left_id", "right_id"])

    kind = [dict(d.dtypes)[c][6:-1] for d, c in ((left, l_id), (right, r_id))]
    return meeting(left, right, found, f"left_id {kind[0]}, right_id {kind[1]}")


def _best(a: Block, b: Block, k: int, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of b, row of a, cosine): for each row of b the k rows of a of highest cosine, none below `low` of that row; ties to the first."""
    rough, slack = likeness(b, a)
    cut = low - slack
    if k < rough.shape[1]:
        # What can't be told from the product raises no bar.
        told = np.where(np.isnan(rough), -np.inf, rough) if np.isnan(rough).any() else rough
        cut = np.maximum(cut, np.partition(told, rough.shape[1] - k, axis=1)[:, -k] - 2 * slack)
    i, j = np.nonzero(~(rough < cut[:, None]))
    c = exact(b, a, i, j)
    ok = ~(c < low[i])
    i, j, c = i[ok], j[ok], c[ok]
    order = np.lexsort((j, np.where(np.isnan(c), -np.inf, -c), i))
    i, j, c = i[order], j[order], c[order]
    first = np.searchsorted(i, np.arange(len(b.x)))
    keep = np.arange(len(i)) - first[i] < k
    return i[keep], j[keep], c[keep]


def top(items: DataFrame, queries: DataFrame, i_id: str, q_id: str, k: int, least: float, few: bool = False) -> DataFrame:
    """(query, item, similarity): of each packed query what may be among the k items of highest cosine, from `least` on.

    A task ranks the items of a block and passes on what isn't worse than the k best it has met; ties of one block go to the smaller id.
    """

    def found(pairs: Iterator) -> Iterator[pa.RecordBatch]:
        met: dict[int, np.ndarray] = {}
        for a, b, _, number in pairs:
            best = met.get(number)
            if best is None:
                best = np.full((len(b.x), k), least)
            i, j, c = _best(a, b, k, best[:, 0])
            own = np.full((len(b.x), k), -np.inf)
            own[i, np.arange(len(i)) - np.searchsorted(i, np.arange(len(b.x)))[i]] = np.where(np.isnan(c), np.inf, c)
            met[number] = np.sort(np.concatenate([best, own], axis=1), axis=1)[:, -k:]
            if len(i):
                yield pa.RecordBatch.from_arrays([b.columns[q_id].take(pa.array(i)), a.columns[i_id].take(pa.array(j)), pa.array(c)], names=["query", "item", "similarity"])

    kind = [dict(d.dtypes)[c][6:-1] for d, c in ((queries, q_id), (items, i_id))]
    return meeting(items, queries, found, f"query {kind[0]}, item {kind[1]}, similarity double", few=few)
