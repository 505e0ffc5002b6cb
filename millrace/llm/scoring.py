"""Learning from labelled rows and scoring every text, for the classifiers."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import labelled_sample, materialise

SCORED = "doc_id long, held_out boolean, score double, predicted int"


def training_rows(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int, most: int, features: Callable, kind: str) -> DataFrame:
    """(doc_id, y, f), written: y (0 or 1) and features, an array of `kind`, of at most `most` labelled documents outside the held-out fold.

    The sample's ids (12 bytes each, `most` rows) are broadcast. Of several texts of one id one is learned from.
    """
    sample = F.broadcast(labelled_sample(labels, label, modulus, held_out, most))
    found = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(sample, "doc_id").select("doc_id", "y", "text")
    item = {"int": pa.int32(), "double": pa.float64()}[kind]

    def extract(it):
        for rb in it:
            f = [features(t or "") for t in rb.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([rb.column(0), rb.column(1), pa.array(f, pa.list_(item))], names=["doc_id", "y", "f"])

    rows = found.mapInArrow(extract, f"doc_id long, y int, f array<{kind}>")
    one = rows.groupBy("doc_id").agg((F.max("y") > 0).cast("int").alias("y"), F.min_by("f", F.xxhash64("f")).alias("f"))
    return materialise(one, "training")


def in_order(rows: DataFrame) -> list:
    """The rows, on the driver, in the same order every time."""
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").collect()


def scored(docs: DataFrame, score: Callable, modulus: int, held_out: int, threshold: float) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; score: list of texts -> array of probabilities."""

    def run(it):
        for rb in it:
            ids = rb.column(0).to_pylist()
            s = score([t or "" for t in rb.column(1).to_pylist()])
            fold = [zlib.crc32(("" if i is None else str(i)).encode()) % modulus == held_out for i in ids]
            yield pa.RecordBatch.from_arrays(
                [rb.column(0), pa.array(fold), pa.array(s, pa.float64()), pa.array((np.asarray(s) >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCORED)


def accepted(docs: DataFrame, score: Callable, threshold: float) -> DataFrame:
    """The rows of docs whose text scores at least the threshold, with all their columns."""

    def run(it):
        for rb in it:
            texts = rb.column(rb.schema.get_field_index("text")).to_pylist()
            yield rb.filter(pa.array(np.asarray(score([t or "" for t in texts])) >= threshold))

    return docs.mapInArrow(run, docs.schema)
