"""Structured Streaming forms: sessions, dedup, runs, resumable generation and sinks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def sessions(events: DataFrame, user: str, ts: str, gap: str = "4 hours", late: str = "1 hour") -> DataFrame:
    """W1 over a stream; a gap of exactly `gap` merges; rows later than `late` are dropped."""
    own = events.withWatermark(ts, late).groupBy(user, F.session_window(ts, gap).alias("w"))
    return own.agg(F.count(F.lit(1)).alias("n")).select(user, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def deduplicated(events: DataFrame, key: str, ts: str, late: str = "1 hour") -> DataFrame:
    """D5 over a stream: the first row of a key within the watermark; state is dropped after it."""
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def runs(events: DataFrame, user: str, ts: str, kind: str) -> DataFrame:
    """W3 over a stream: (user, kind, start, end, n) of each ended run of one kind; rows of a batch are taken in order of time."""
    out, state = "user string, kind string, start timestamp, end timestamp, n long", "kind string, start timestamp, end timestamp, n long"

    def step(key: Any, parts: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        run = list(held.get) if held.exists else None
        done = []
        rows = pd.concat(list(parts)).sort_values(ts)
        for k, at in zip(rows[kind], rows[ts], strict=True):
            if run and k == run[0]:
                run = [run[0], run[1], at, run[3] + 1]
                continue
            if run:
                done.append((str(key[0]), *run))
            run = None if k is None or pd.isna(k) else [k, at, at, 1]
        if run:
            held.update(tuple(run))
        elif held.exists:
            held.remove()
        yield pd.DataFrame(done, columns=["user", "kind", "start", "end", "n"])

    return events.groupBy(user).applyInPandasWithState(step, out, state, "append", GroupStateTimeout.NoTimeout)


def generate_to(stream: DataFrame, generate: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, key: str, on_batch: Callable[[int, int], None] | None = None):
    """Every micro-batch through a generator and appended; keys already written are skipped, so a rerun resumes.

    Rows whose answer is null are left out and asked again on the next run.
    """
    spark = stream.sparkSession

    def batch(df: DataFrame, number: int) -> None:
        from millrace.sources.files import _exists

        if _exists(spark, path + "/*.parquet"):
            df = df.join(spark.read.parquet(path).select(key), key, "left_anti")
        generate(df).write.mode("append").parquet(path)
        if on_batch:
            on_batch(number, spark.read.parquet(path).count())

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def partial_results(spark, path: str) -> DataFrame:
    """T5: what has been written so far."""
    return spark.read.parquet(path)


def rates(stream: DataFrame, key: str, ts: str, window: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Counts by tumbling window and key, with a watermark."""
    return stream.withWatermark(ts, late).groupBy(F.window(ts, window).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), key, "n")
