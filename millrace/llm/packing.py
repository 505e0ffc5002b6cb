"""Sequence packing by non-negative least squares over shallow length combinations.

1. Every document is tokenised once. Its full windows of `window` ids are sequences of their
   own; what remains is a length of 0 to window-1.
2. The histogram of the remainders (at most `window` counts) goes to the driver, which
   enumerates pairs and triples of lengths that fill a window exactly, solves the repeat
   counts by non-negative least squares against the histogram, and rounds them.
3. The residuals are packed greedily: the longest length left, then again and again the longest that
   fits, for as long as that fills windows exactly. What is left then goes next-fit in order of length:
   a document that doesn't fit the window is cut there and goes on in the next, which pads one sequence in all.
4. A document's rank among those of its length says which combination or residual place takes it: all is
   arithmetic on ranks, so no document list is ever gathered.
5. Only residuals that a window boundary cuts are tokenised again, for their pieces' checksums.

Ranks go by rest, hash slice and id, so they are the same in every run. Equal rows (of one id and one text) are counted, not listed, until
they are placed, and slices grow in number with the table: no length and no repeated row meets in one task.

A text that contains an added token's content, such as `<|endoftext|>`, takes its id there, as the library does by default.

Defined cases: null text is empty, and so the end id alone; repeated rows are packed each
on its own; an empty table gives no pieces; a null doc_id is packed like any other; extra
columns are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import materialise

#: Rows of one length are ranked in slices, one for so many rows of the table, and never fewer than SLICES.
SLICE_ROWS, SLICES = 500_000, 64
#: Equal rows are placed in parts of so many.
COPIES = 10_000
#: Cut pieces of at most so many rows (32 bytes each) are broadcast to the texts; more are joined by shuffle.
BROADCAST_ROWS = 200_000
_CODERS: dict[str, Coder] = {}


class Coder:
    """Texts to the ids of the byte-level BPE in a tokenizers file, as little-endian unsigned 32-bit bytes.

    The file's vocabulary is read as merge ranks for tiktoken, which gives the same ids some four
    times as fast; a text that it refuses, or that holds an added token, goes to the tokenizers library itself.
    """

    def __init__(self, path: str, end: int):
        import json

        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        self.added = [t["content"] for t in spec["added_tokens"]]
        byte = _byte_of()
        ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in self.added}
        self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.end = np.array([end], "<u4").tobytes()

    def encoded(self, text: str | None) -> bytes:
        text = text or ""
        ids = None
        if not any(t in text for t in self.added):
            try:
                ids = self.fast.encode_to_numpy(text, disallowed_special=())
            except Exception:  # its regular expressions have a limit of depth
                ids = None
        if ids is None:
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return ids.astype("<u4").tobytes() + self.end


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 stands for itself, the others follow from U+0100."""
    plain = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace()]
    rest = (b for b in range(256) if b not in set(plain))
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def coder(path: str, end: int) -> Coder:
    if path not in _CODERS:
        _CODERS[path] = Coder(path, end)
    return _CODERS[path]


@dataclass
class Plan:
    """Slots of the combinations: ranks [lo, hi) of `length` go to sequences from `first`, `per` a sequence, at the given offsets."""

    length: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    first: np.ndarray
    offset: np.ndarray
    taken: np.ndarray  # by length
    sequences: int
    residual_start: np.ndarray  # by length, in ids of the residual stream


def combinations(hist: np.ndarray, window: int, each: int = 24) -> tuple[np.ndarray, np.ndarray]:
    """Pairs and triples of lengths that fill the window exactly.

    All pairs; for every length, triples with up to `each` others, spread evenly over the documents'
    lengths (so frequent lengths come more often). Triples are sorted, each given once.
    """
    low = np.flatnonzero(hist[: window // 2 + 1])
    low = low[(low > 0) & (hist[window - np.maximum(low, 1)] > 0)]
    pairs = np.stack([low, window - low], 1)
    lengths = np.flatnonzero(hist)
    lengths = lengths[lengths > 0]
    if not len(lengths):
        return pairs, np.zeros((0, 3), np.int64)
    mass = np.cumsum(hist[lengths])
    spread = lengths[np.searchsorted(mass, (np.arange(each) + 0.5) / each * mass[-1])]
    # Another spread for each length, else all triples would share the same few partners.
    a = np.repeat(lengths, each)
    b = np.tile(spread, len(lengths)) + np.repeat(np.arange(len(lengths)) * 7 % 53 - 26, each)
    c = window - a - b
    ok = (b > 0) & (c > 0) & (hist[np.clip(b, 0, window - 1)] > 0) & (hist[np.clip(c, 0, window - 1)] > 0)
    triples = np.unique(np.sort(np.stack([a, b, c], 1)[ok], 1), axis=0)
    return pairs, triples.reshape(-1, 3)


def solve(hist: np.ndarray, pairs: np.ndarray, triples: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Repeat counts of the combinations: non-negative least squares |A x - hist| by multiplicative updates, then rounded.

    Rounding: the whole parts first, the largest first, then one more of each by falling fraction,
    and last as many more as the histogram still holds; never more than it holds.
    """
    window, sizes = len(hist), [len(pairs), len(triples)]
    x = np.ones(sum(sizes))
    parts = [(pairs, slice(0, sizes[0])), (triples, slice(sizes[0], sum(sizes)))]

    def times(x: np.ndarray) -> np.ndarray:
        out = np.zeros(window)
        for c, s in parts:
            for k in range(c.shape[1]):
                out += np.bincount(c[:, k], x[s], window)
        return out

    def back(v: np.ndarray) -> np.ndarray:
        return np.concatenate([v[c].sum(1) if len(c) else np.zeros(0) for c, _ in parts])

    want = back(hist.astype(float))
    for _ in range(rounds):
        x *= want / np.maximum(back(times(x)), 1e-9)
    out = np.zeros(len(x), np.int64)
    left = hist.astype(np.int64).tolist()
    combos = [*map(tuple, pairs.tolist()), *map(tuple, triples.tolist())]
    fraction = x - np.floor(x)
    for wish, order in ((np.floor(x), -x), (np.ceil(x), -fraction), (np.full(len(x), np.inf), -x)):
        for i in np.argsort(order, kind="stable"):
            c = combos[i]
            more = min(left[v] // c.count(v) for v in c)
            more = int(min(more, wish[i] - out[i]))
            if more > 0:
                out[i] += more
                for v in c:
                    left[v] -= more
    return out


def greedy(left: np.ndarray, window: int) -> list[tuple[list[int], int]]:
    """(lengths, repeats) that fill windows exactly: the longest length, then always the longest that fits.

    A start that leaves a gap is given up; each round uses up a length or gives up one, so there are few rounds.
    """
    left, out = left.copy(), []
    left[0] = 0
    starts = left > 0
    while starts.any():
        longest = int(np.flatnonzero(starts)[-1])
        own, gap = [longest], window - longest
        left[longest] -= 1
        while gap:
            fits = np.flatnonzero(left[: gap + 1])
            if not len(fits):
                break
            own.append(int(fits[-1]))
            left[own[-1]] -= 1
            gap -= own[-1]
        np.add.at(left, own, 1)
        if gap:
            starts[longest] = False
            continue
        lengths, each = np.unique(own, return_counts=True)
        n = int((left[lengths] // each).min())
        left[lengths] -= n * each
        out.append((own, n))
        starts &= left > 0
    return out


def plan(hist: np.ndarray, window: int) -> Plan:
    pairs, triples = combinations(hist, window)
    counts = solve(hist, pairs, triples)
    used = np.zeros(window, np.int64)
    for part, n in ((pairs, counts[: len(pairs)]), (triples, counts[len(pairs) :])):
        for k in range(part.shape[1]):
            np.add.at(used, part[:, k], n)
    rest = greedy(hist - used, window)
    rows, taken, first = [], np.zeros(window, np.int64), 0
    for c, n in [*zip([*pairs.tolist(), *triples.tolist()], counts, strict=True), *rest]:
        if not n:
            continue
        at = 0
        for length in c:
            rows.append((length, taken[length], taken[length] + n, first, at))
            taken[length] += n
            at += length
        first += int(n)
    rows.sort()
    cols = np.array(rows, np.int64).reshape(-1, 5).T
    left = (hist - taken) * np.arange(window)
    return Plan(*cols, taken, first, np.concatenate([[0], np.cumsum(left)[:-1]]))


def measured(docs: DataFrame, path: str, end: int, window: int) -> DataFrame:
    """(doc_id, text_key, tokens, crcs, rest_crc): the checksums of the full windows and of the remainder."""

    def measure(it):
        import xxhash

        code = coder(path, end)
        for rb in it:
            keys, tokens, crcs, rest = [], [], [], []
            for text in rb.column(1).to_pylist():
                ids = code.encoded(text)
                full = len(ids) // (4 * window)
                keys.append(xxhash.xxh3_64_intdigest((text or "").encode()) - 2**63)
                tokens.append(len(ids) // 4)
                crcs.append([zlib.crc32(ids[4 * window * i : 4 * window * (i + 1)]) for i in range(full)])
                rest.append(zlib.crc32(ids[4 * window * full :]))
            yield pa.RecordBatch.from_arrays(
                [rb.column(0), pa.array(keys, pa.int64()), pa.array(tokens, pa.int64()), pa.array(crcs, pa.list_(pa.int64())), pa.array(rest, pa.int64())],
                names=["doc_id", "text_key", "tokens", "crcs", "rest_crc"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        measure, "doc_id long, text_key long, tokens long, crcs array<long>, rest_crc long"
    )


def ranked(lens: DataFrame, window: int, rows: int) -> DataFrame:
    """A row for up to COPIES equal rows of lens, with copies, rest, rank (of the first copy, among rows of this rest, from 0) and before (full windows of all rows ordered before)."""
    names = ["tokens", "crcs", "rest_crc"]
    same = lens.groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in names])
    same = same.withColumn("rest", F.pmod("tokens", F.lit(window))).withColumn("full", F.size("crcs").cast("long"))
    same = same.withColumn("slice", F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(max(SLICES, rows // SLICE_ROWS))))
    parts = same.groupBy("rest", "slice").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("full")).alias("f"))
    rests = parts.groupBy("rest").agg(F.sum("f").alias("rf"))
    by_rest = Window.partitionBy("rest").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.orderBy("rest").rowsBetween(Window.unboundedPreceding, -1)
    # At most `window` rows meet in one task here, and below one a slice, however many documents there are.
    rests = rests.select("rest", F.coalesce(F.sum("rf").over(over), F.lit(0)).alias("f_rest"))
    parts = parts.select("rest", "slice", F.coalesce(F.sum("n").over(by_rest), F.lit(0)).alias("n_before"), F.coalesce(F.sum("f").over(by_rest), F.lit(0)).alias("f_before"))
    offsets = parts.join(F.broadcast(rests), "rest")
    own = Window.partitionBy("rest", "slice").orderBy("doc_id", "text_key").rowsBetween(Window.unboundedPreceding, 0)
    out = same.withColumn("_r", F.sum("n").over(own) - F.col("n")).withColumn("_f", F.sum(F.col("n") * F.col("full")).over(own) - F.col("n") * F.col("full"))
    out = out.join(offsets, ["rest", "slice"])
    out = out.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(COPIES).cast("long"))))
    return out.select(
        "doc_id", "text_key", *names, "rest", (F.col("n_before") + F.col("_r") + F.col("at")).alias("rank"),
        (F.col("f_rest") + F.col("f_before") + F.col("_f") + F.col("at") * F.col("full")).alias("before"), F.least(F.col("n") - F.col("at"), F.lit(COPIES)).alias("copies"),
    )


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, text_key long"


def pack(docs: DataFrame, path: str, window: int = 2048, end: int = 1) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    lens = materialise(measured(docs, path, end, window), "lengths")
    hist = np.zeros(window, np.int64)
    for r in lens.groupBy(F.pmod("tokens", F.lit(window)).alias("rest")).count().collect():  # at most `window` rows
        hist[r["rest"]] = r["count"]
    total = int(hist.sum())
    full = lens.agg(F.coalesce(F.sum(F.size("crcs")), F.lit(0)).cast("long")).first()[0]
    # Its slots are bounded by the window: at most 24 triples a length, the pairs, and the greedy ones (a length each).
    held = lens.sparkSession.sparkContext.broadcast(plan(hist, window))

    def placed(p: Plan, starts: np.ndarray, doc, key, tokens, crcs, rest_crc, rest: int, rank: int, before: int) -> list[tuple]:
        rows = [(doc, window * i, window, c, tokens, before + i, 0, key) for i, c in enumerate(crcs)]
        at = window * len(crcs)
        if not rest:
            return rows
        if rank < p.taken[rest]:
            i = starts[rest] + int(np.searchsorted(p.hi[starts[rest] : starts[rest + 1]], rank, "right"))
            rows.append((doc, at, rest, rest_crc, tokens, full + int(p.first[i]) + rank - int(p.lo[i]), int(p.offset[i]), key))
            return rows
        pos, left = int(p.residual_start[rest]) + (rank - int(p.taken[rest])) * rest, rest
        whole = pos // window == (pos + rest - 1) // window
        while left:
            n = min(left, window - pos % window)
            rows.append((doc, at, n, rest_crc if whole else None, tokens, full + p.sequences + pos // window, pos % window, key))
            at, pos, left = at + n, pos + n, left - n
        return rows

    def told(rows: list) -> pa.RecordBatch:
        cols = list(zip(*rows, strict=True)) or [[]] * 8
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=[x.split()[0] for x in PIECES.split(", ")])

    def place(it):
        p = held.value
        starts = np.searchsorted(p.length, np.arange(window + 1))
        for rb in it:
            rows: list = []
            for *own, crcs, rest_crc, rest, rank, before, copies in zip(*(rb.column(i).to_pylist() for i in range(9)), strict=True):
                for i in range(copies):
                    rows += placed(p, starts, *own, crcs, rest_crc, rest, rank + i, before + i * len(crcs))
                    if len(rows) > COPIES:
                        yield told(rows)
                        rows = []
            yield told(rows)

    # Parts of equal rows go apart.
    wanted = ranked(lens, window, total).repartition("rest", F.expr("rank div 100"))
    pieces = materialise(wanted.mapInArrow(place, PIECES), "pieces")
    cut = pieces.filter("ids_crc32 is null").select("doc_id", "text_key", "start", "length").distinct()

    def again(it):
        import xxhash

        code = coder(path, end)
        for rb in it:
            out = []
            for doc, key, start, length, text in zip(*(rb.column(i).to_pylist() for i in range(5)), strict=True):
                if xxhash.xxh3_64_intdigest((text or "").encode()) - 2**63 == key:
                    out.append((doc, key, start, length, zlib.crc32(code.encoded(text)[4 * start : 4 * (start + length)])))
            cols = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["d", "k", "s", "l", "crc"])

    texts = docs.select(F.col("doc_id").cast("long").alias("t"), F.col("text").cast("string").alias("text"))
    if cut.count() <= BROADCAST_ROWS:
        cut = F.broadcast(cut)
    crcs = cut.join(texts, F.col("doc_id").eqNullSafe(F.col("t"))).select("doc_id", "text_key", "start", "length", "text")
    crcs = crcs.mapInArrow(again, "d long, k long, s long, l long, crc long").dropDuplicates(["d", "k", "s", "l"])
    known = pieces.filter("ids_crc32 is not null")
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")) & (F.col("start") == F.col("s")) & (F.col("length") == F.col("l"))
    mended = pieces.filter("ids_crc32 is null").drop("ids_crc32").join(crcs, same).withColumnRenamed("crc", "ids_crc32")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return known.select(*names).unionAll(mended.select(*names))
