"""What the training-data operators share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.session import materialise, shared_dir, ship

__all__ = ["bucketed", "fold", "labelled_sample", "materialise", "own_prefix", "read", "shared_dir", "ship"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fold(doc_id: str, modulus: int):
    """crc32 of the id as text, modulo modulus; null ids count as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def labelled_sample(labels: DataFrame, label: str, modulus: int, held_out: int, most: int) -> DataFrame:
    """(doc_id, y): at most `most` labelled rows outside the held-out fold, the same ones every time.

    Rows with a null id or label are left out; an id with several labels keeps the largest.
    """
    return (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .filter(fold("doc_id", modulus) != held_out)
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )


def own_prefix(columns: list[str]) -> str:
    """A prefix that none of these columns has, for an operator's own columns beside them."""
    prefix = "_own_"
    while any(c.lower().startswith(prefix) for c in columns):
        prefix = "_" + prefix
    return prefix


def bucketed(df: DataFrame, key: str, buckets: int, partition_by: str | None = None, aligned: bool = False) -> tuple[DataFrame, str]:
    """df written as a table of `buckets` sorted buckets in the shared folder and read back; and the table's name, to be dropped in the end.

    Tables of equal buckets are merged and joined by the key without an exchange; aligned: df is partitioned so already.
    """
    spark = df.sparkSession
    name = f"millrace_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/{name}"
    writer = (df if aligned else df.repartition(buckets, key)).write
    writer = writer.partitionBy(partition_by) if partition_by else writer
    writer.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.table(name), name
