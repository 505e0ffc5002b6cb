"""SpotSigs document fingerprints.

A signature is a common-word anchor with the `chain` content words that follow it (fewer at the text's end). Where no anchor
stands among the last `reach` words, or none has come yet, every content word is its own anchor; so texts of any language
tell apart, by one rule for every place of every text. A text's
fingerprint is the sorted set of its signatures' 64-bit hashes, in base64 after the set's size;
fingerprints are partitioned by size and compared through a Jaccard that gives up where sizes or
the remaining signatures cannot reach the wanted likeness any more.

Defined cases: null text is empty; a text without words has the fingerprint "0:" and likeness 1
to another such text, 0 to others; equal texts have equal fingerprints; the next document of
the last is the first, and of the only one itself; repeated ids follow each other in order of
their texts' hashes, and are cut into buckets by these; a null doc_id comes after all others; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Common words of the corpus languages, the anchors (fixed values).
ANCHORS = frozenset(
    (
        "a an and are as at be by can do for from had has have he her his if in is it its of on or she that the their there they this to was were which who will with you "
        "au aux avec ce ces dans des du elle en est et il la le les leur mais ne nous ou par pas pour qui que se ses son sur un une "
        "auf aus bei das dem den der des die ein eine einen er es für im ist mit nicht sein sich sie sind und von war wie zu "
        "al como con de del el ella ello era es ha hay los las lo más no o para pero por se si sin su sus y"
    ).split()
)
_WORD = re.compile(r"\w+").findall


def signatures(text: str, chain: int = 2, reach: int = 8, anchors: frozenset = ANCHORS) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the text's spot signatures."""
    content, spots, since = [], [], reach
    for w in _WORD(text.lower()):
        if w in anchors:
            spots.append((w, len(content)))
            since = 0
        else:
            if since >= reach:
                spots.append((w, len(content) + 1))
            content.append(w)
            since += 1
    if not spots:
        return np.empty(0, np.uint64)
    import xxhash

    found = {" ".join((w, *content[i : i + chain])) for w, i in spots}
    return np.unique(np.fromiter((xxhash.xxh3_64_intdigest(s) for s in found), np.uint64, len(found)))


def fingerprint(s: np.ndarray) -> str:
    return f"{len(s)}:" + base64.b64encode(s.astype("<u8").tobytes()).decode()


def parsed(fp: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fp.partition(":")[2]), "<u8")


def size_class(size: int, wanted: float) -> int:
    """The partition of a set size: sets whose likeness is `wanted` or more are in the same or neighbouring partitions."""
    return int(np.floor(np.log(max(1, size)) / -np.log(wanted))) if 0 < wanted < 1 else 0


def likeness(a: np.ndarray, b: np.ndarray, wanted: float = 0.0) -> float:
    """The Jaccard of two sorted sets; 0 as soon as it is known to be below `wanted`."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if min(len(a), len(b)) < wanted * max(len(a), len(b)) or a[0] > b[-1] or b[0] > a[-1]:
        return 0.0
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    out = both / (len(a) + len(b) - both)
    return out if out >= wanted else 0.0


def _edited(text: str, nxt: str) -> str:
    k = len(text) // 3
    return text[: len(text) - k] + nxt[:k]


FINGERPRINTED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _in_order(docs: DataFrame) -> DataFrame:
    """(doc_id, text, bucket, halo) in buckets of consecutive ids, sorted downwards inside each partition.

    The bounds of the buckets are quantiles of all ids (eight a shuffle partition at most); an id that fills whole
    buckets is cut by its texts' hashes. The first row of a bucket is sent along to the bucket before it as its last, a halo; so each
    row's next row is beside it, and the texts are shuffled once.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Null ids come last, below every other id.
    d = d.withColumn("at", F.coalesce(F.col("doc_id").cast("double"), F.lit(-1.7e308)))
    bounds = d.agg(F.percentile_approx("at", F.lit([i / (8 * parts) for i in range(1, 8 * parts)]), 100_000)).first()[0] or []
    splits = [-float("inf"), *sorted(set(bounds)), float("inf")]
    if len(splits) < 3:
        splits = [-float("inf"), 0.0, float("inf")]
    # Such an id is the lower bound of its bucket: its own cuts come first there, then the ids above it.
    times = {b: bounds.count(b) for b in set(bounds)}
    hot = spark.createDataFrame([(float(b), n) for b, n in times.items() if n > 1], "_hot double, _cuts int")  # fewer rows than bounds
    bucketed = Bucketizer(splits=splits, inputCol="at", outputCol="range").transform(d.withColumn("hash", F.xxhash64("text")))
    bucketed = bucketed.join(F.broadcast(hot), F.col("at") == F.col("_hot"), "left")
    cut = F.least(F.floor((F.col("hash") / F.lit(2.0**64) + 0.5) * F.col("_cuts")), F.col("_cuts") - 1)
    bucketed = bucketed.withColumn("cut", F.coalesce(cut.cast("int"), F.lit(1_000_000))).drop("_hot", "_cuts")
    head = F.max(F.struct("at", "hash")).alias("top")
    tops = bucketed.groupBy("range", "cut").agg(head).orderBy("range", "cut").collect()  # one row a bucket
    if not tops:
        return bucketed.select("doc_id", "text", F.lit(0).alias("bucket"), F.lit(False).alias("halo"))
    # The head of each bucket goes to the bucket above it, the head of all to the lowest.
    rows = [(t["range"], t["cut"], i, t.top.at, t.top.hash, (i + 1) % len(tops)) for i, t in enumerate(tops)]
    heads = spark.createDataFrame(rows, "range double, cut int, bucket int, _at double, _hash long, _above int")
    rows = bucketed.join(F.broadcast(heads), ["range", "cut"])
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("halo"))
    also = F.struct(F.col("_above").alias("bucket"), F.lit(True).alias("halo"))
    is_head = (F.col("at") == F.col("_at")) & (F.col("hash") == F.col("_hash"))
    rows = rows.withColumn("_to", F.explode(F.when(is_head, F.array(own, also)).otherwise(F.array(own))))
    rows = rows.select("doc_id", "text", "hash", "_to.bucket", "_to.halo")
    # A halo is the next bucket's first row, so the last one here.
    return rows.repartition(parts, "bucket").sortWithinPartitions("bucket", "halo", F.desc_nulls_last("doc_id"), F.desc("hash"), "text")


def fingerprints(docs: DataFrame, chain: int = 2, reach: int = 8) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""

    def rows(doc, text, nxt, own, after) -> tuple:
        changed = _edited(text, nxt)
        e = signatures(changed, chain, reach) if changed != text else own
        return doc, len(text), hashlib.sha256(changed.encode()).hexdigest(), fingerprint(own), fingerprint(e), likeness(own, e), likeness(own, after)

    def run(it):
        held = None  # the row before, of the same bucket
        done = None  # the bucket whose halo has been used
        for rb in it:
            out = []
            for doc, text, bucket, halo in zip(*(rb.column(i).to_pylist() for i in range(4)), strict=True):
                if bucket == done:
                    continue
                text = text or ""
                own = signatures(text, chain, reach)
                if held is not None and held[3] == bucket:
                    out.append(rows(held[0], held[1], text, held[2], own))
                if halo:
                    held, done = None, bucket
                else:
                    held = (doc, text, own, bucket)
            cols = list(zip(*out, strict=True)) or [[]] * 7
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=[x.split()[0] for x in FINGERPRINTED.split(", ")])

    return _in_order(docs).select("doc_id", "text", "bucket", "halo").mapInArrow(run, FINGERPRINTED)


def near_pairs(docs: DataFrame, wanted: float = 0.8, chain: int = 2, reach: int = 8) -> DataFrame:
    """(a, b, likeness) of the pairs of distinct fingerprints at least `wanted` alike, by the smallest id of each.

    Candidates share one of the first signatures of their sets (as many as a pair of this likeness must
    share one of, by the prefix bound) in the same or a neighbouring size class; others are never compared.
    """

    def prefixes(it):
        for rb in it:
            ids, classes, sigs, fps = [], [], [], []
            for doc, text in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist(), strict=True):
                s = signatures(text or "", chain, reach)
                keep = s[: len(s) - int(np.ceil(wanted * len(s))) + 1] if len(s) else s
                ids.append(doc), classes.append(size_class(len(s), wanted)), sigs.append(keep.astype(np.int64)), fps.append(fingerprint(s))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(classes, pa.int32()), pa.array(sigs, pa.list_(pa.int64())), pa.array(fps, pa.string())], names=["id", "size", "sigs", "fp"]
            )

    d = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(prefixes, "id long, size int, sigs array<long>, fp string")
    d = d.filter("id is not null").groupBy("fp").agg(F.min("id").alias("id"), F.first("size").alias("size"), F.first("sigs").alias("sigs"))
    keys = d.select("id", "size", F.explode("sigs").alias("sig"))
    left = keys.select(F.col("id").alias("a"), F.col("size").alias("sa"), "sig")
    right = keys.select(F.col("id").alias("b"), F.col("size").alias("sb"), "sig")
    pairs = left.join(right, "sig").filter("a < b and abs(sa - sb) <= 1").select("a", "b").distinct()
    full = pairs.join(d.select(F.col("id").alias("a"), F.col("fp").alias("fa")), "a").join(d.select(F.col("id").alias("b"), F.col("fp").alias("fb")), "b")

    def compare(it):
        for rb in it:
            like = [likeness(parsed(x), parsed(y), wanted) for x, y in zip(rb.column(2).to_pylist(), rb.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([rb.column(0), rb.column(1), pa.array(like, pa.float64())], names=["a", "b", "likeness"])

    return full.select("a", "b", "fa", "fb").mapInArrow(compare, "a long, b long, likeness double").filter(F.col("likeness") >= wanted)
