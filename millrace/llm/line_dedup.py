"""Line dedup over levelled sorted runs of line hashes.

Lines are keyed by a 128-bit hash of their normalised bytes. The corpus comes in batches;
each batch is merge-anti-joined against the keys that the runs already
know to be common, and the rest is added as a sorted run of level 0. When a
level holds `fan_in` runs they are merged into one run of the next level. Runs are tables of sorted
buckets, all by the same key and count, so line keys are exchanged once, when they are counted: joining and
merging runs reads bucket beside bucket.

Defined cases: a document is a row: repeated rows, of one id or none, count one by one;
null or empty text is one empty line, whose key is too short to count; an empty table gives no rows;
extra columns, whatever they are called, are kept as they are by `drop_common_lines` and ignored elsewhere.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import bucketed, materialise, own_prefix

#: The white space that is stripped from both ends of a line: x20, x09 to x0D.
BLANK = b" \t\n\x0b\x0c\r"


def keys_of(text: str | None) -> list[bytes]:
    """Of each line: 16 bytes, or b'' for a key of no characters."""
    import xxhash

    out = []
    for line in (text or "").encode().lower().split(b"\n"):
        line = line.strip(BLANK)
        out.append(xxhash.xxh3_128_digest(line) if line else b"")
    return out


#: So many keys are summed in Python before they are passed on.
HELD = 300_000


def line_counts(docs: DataFrame, batches: int, buckets: int) -> DataFrame:
    """(batch, key, docs): in how many documents of the batch a line occurs, summed in each task first."""
    schema = "batch int, key binary, docs long"

    def told(found: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([b for b, _ in found], pa.int32()), pa.array([k for _, k in found], pa.binary()), pa.array(list(found.values()), pa.int64())], names=["batch", "key", "docs"]
        )

    def count(it):
        from collections import Counter

        found: Counter = Counter()
        for rb in it:
            for b, text in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist(), strict=True):
                found.update((b, k) for k in set(keys_of(text)) if k)
                if len(found) >= HELD:
                    yield told(found)
                    found.clear()
        yield told(found)

    batch = F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int")
    counted = docs.select(batch.alias("batch"), F.col("text").cast("string")).mapInArrow(count, schema)
    return counted.repartition(buckets, "key").groupBy("batch", "key").agg(F.sum("docs").alias("docs"))


@dataclass
class LineRuns:
    """The levels of sorted runs; each run holds (key, docs), one row a key."""

    threshold: int
    fan_in: int = 3
    buckets: int = 8
    levels: list[list[DataFrame]] = field(default_factory=list)
    tables: list[str] = field(default_factory=list)

    def _stored(self, df: DataFrame, aligned: bool) -> DataFrame:
        table, name = bucketed(df, "key", self.buckets, aligned=aligned)
        self.tables.append(name)
        return table

    def _merged(self, runs: list[DataFrame]) -> DataFrame:
        # True of every row: Spark 4.1 sets buckets beside each other only in a union of rows, not of columnar scans, which it would merge wrongly.
        out, *others = (run.filter("docs > 0") for run in runs)
        for run in others:
            out = out.unionAll(run)
        return out.groupBy("key").agg(F.sum("docs").alias("docs"))

    def common(self) -> DataFrame:
        """The keys in at least `threshold` documents."""
        return self._merged([run for level in self.levels for run in level]).filter(F.col("docs") >= self.threshold).select("key")

    def add(self, batch: DataFrame, in_buckets: bool = False) -> None:
        """batch: (key, docs); in_buckets: it is a table of the runs' buckets."""
        if self.levels:
            batch = batch.join(self._stored(self.common(), True).hint("merge"), "key", "left_anti")
        self._put(batch if in_buckets and not self.levels else self._stored(batch, in_buckets), 0)

    def _put(self, run: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fan_in:
            runs, self.levels[level] = self.levels[level], []
            self._put(self._stored(self._merged(runs), True), level + 1)

    def close(self, spark: SparkSession) -> None:
        """Forget the runs' tables; their files go when the application ends."""
        for name in self.tables:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.tables.clear()


def common_keys(docs: DataFrame, threshold: int, batches: int = 4, fan_in: int = 3) -> DataFrame:
    """(key): the lines that stand in at least `threshold` documents, written."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts, name = bucketed(line_counts(docs, batches, buckets), "key", buckets, partition_by="batch", aligned=True)
    runs = LineRuns(threshold, fan_in, buckets, tables=[name])
    try:
        for b in range(batches):
            runs.add(counts.filter(F.col("batch") == b).select("key", "docs"), in_buckets=True)
        return materialise(runs.common(), "common")
    finally:
        runs.close(spark)


REPORT = ("n_lines", "n_dropped", "kept_sha256")


def _stripper(keep_text: bool, report: bool, bad_set):
    """mapInArrow function over (..., text), or (..., text, bad keys of the row) where bad_set is None."""

    def strip(it):
        for rb in it:
            n = rb.num_columns - (2 if bad_set is None else 1)
            n_lines, n_dropped, sha, kept = [], [], [], []
            for i, text in enumerate(rb.column(n).to_pylist()):
                text = text or ""
                bad = bad_set.value if bad_set is not None else set(rb.column(n + 1)[i].as_py() or ())
                lines = text.split("\n")
                good = [line for line, k in zip(lines, keys_of(text), strict=True) if k not in bad]
                new = "\n".join(good)
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(good))
                if report:
                    sha.append(hashlib.sha256(new.encode()).hexdigest())
                kept.append(new)
            arrays, names = [rb.column(i) for i in range(n)], list(rb.schema.names[:n])
            if keep_text:
                arrays.append(pa.array(kept, pa.string()))
                names.append(rb.schema.names[n])
            if report:
                arrays += [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(sha, pa.string())]
                names += REPORT
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return strip


def drop_common_lines(
    docs: DataFrame, threshold: int = 10, batches: int = 4, fan_in: int = 3, keep_text: bool = True, broadcast_keys: int = 200_000, report: bool = True
) -> DataFrame:
    """docs without the lines that stand in at least `threshold` documents.

    Returns docs' columns (text edited and last, or left out); with `report` also n_lines, n_dropped and
    kept_sha256, which replace columns of docs by these names. Common keys
    are broadcast up to `broadcast_keys` (16 bytes each); beyond that the occurrences of
    common keys are joined by shuffle and sent back to their documents by id.
    """
    docs = docs.drop(*REPORT) if report else docs
    spark = docs.sparkSession
    bad = common_keys(docs.select("doc_id", "text"), threshold, batches, fan_in)
    fields = [f for f in docs.schema.fields if f.name.lower() != "text"]
    own = own_prefix(docs.columns)
    schema = [f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + (["text string"] if keep_text else []) + ["n_lines long", "n_dropped long", "kept_sha256 string"] * report
    kept = [F.col(f"`{f.name}`") for f in fields]
    text = F.col("text").cast("string").alias("text")
    if bad.count() <= broadcast_keys:
        keys = spark.sparkContext.broadcast({bytes(r.key) for r in bad.toLocalIterator()})
        return docs.select(*kept, text).mapInArrow(_stripper(keep_text, report, keys), ", ".join(schema))

    def occurrences(it):
        for rb in it:
            ids, ks = [], []
            for d, t in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist(), strict=True):
                found = {k for k in keys_of(t) if k}
                ids += [d] * len(found)
                ks += found
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ks, pa.binary())], names=[f"{own}id", "key"])

    hits = (
        docs.select(F.col("doc_id").cast("long"), text)
        .mapInArrow(occurrences, f"{own}id long, key binary")
        .join(bad, "key", "left_semi")
        .groupBy(f"{own}id")
        .agg(F.collect_set("key").alias(f"{own}bad"))
    )
    joined = docs.join(hits, F.col("doc_id").cast("long").eqNullSafe(F.col(f"{own}id")), "left").select(*kept, text, f"{own}bad")
    return joined.mapInArrow(_stripper(keep_text, report, None), ", ".join(schema))


def line_dedup(docs: DataFrame, threshold: int = 10) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped, kept_sha256."""
    return drop_common_lines(docs.select("doc_id", "text"), threshold, keep_text=False)
