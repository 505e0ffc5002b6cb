"""File sources and sinks: JSON lines, corpora, stage tables, chunk stores."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import head_and_tail, strip

RECORD = T.StructType([T.StructField(n, T.StringType()) for n in ("instruction", "input", "output", "system", "source")])


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.globStatus(where))


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType = RECORD) -> DataFrame:
    """A file or a folder of *.jsonl; blank and malformed lines go; a missing path has no rows.

    `_file` and `_offset` (the row's order inside its file) define load order; columns are read by the schema, others stay out.
    """
    if not _exists(spark, path):
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("_file", T.StringType()), T.StructField("_offset", T.LongType())]))
    bad = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    rows = spark.read.option("pathGlobFilter", "*.jsonl").option("recursiveFileLookup", "false").text(path)
    rows = rows.select(F.col("_metadata.file_path").alias("_file"), (F.col("_metadata.file_block_start") * (1 << 20) + F.monotonically_increasing_id() % (1 << 33)).alias("_offset"), strip("value").alias("value"))
    parsed = rows.filter("value != ''").withColumn("r", F.from_json("value", bad, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    return parsed.filter("r is not null and r._bad is null").select(*[F.col(f"r.{f.name}") for f in schema.fields], "_file", "_offset")


def read_variant_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """S2 for records of any keys: each line as a VARIANT, malformed ones out."""
    rows = spark.read.text(path).filter(strip("value") != "")
    return rows.select(F.try_parse_json("value").alias("record")).filter("record is not null")


def write_jsonl(df: DataFrame, path: str, fields: Sequence[str] | None = None) -> None:
    """S3: an object a line, keys in the order of fields, null keys left out, non-ASCII as it is."""
    df.select(F.to_json(F.struct(*(fields or df.columns))).alias("value")).write.mode("overwrite").text(path)


def count_records(spark: SparkSession, path: str) -> int:
    """Non-blank lines; JSON isn't parsed."""
    return spark.read.text(path).filter(strip("value") != "").count()


def replace_in_place(df: DataFrame, path: str) -> None:
    """Write where df was read from: to a staging folder, then renamed; the old one goes last."""
    spark = df.sparkSession
    stage, old = f"{path.rstrip('/')}.{uuid.uuid4().hex}", f"{path.rstrip('/')}.old"
    write_jsonl(df, stage)
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path
    fs = p(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(p(old), True)
    fs.rename(p(path), p(old))
    fs.rename(p(stage), p(path))
    fs.delete(p(old), True)


def split_output(df: DataFrame, split: str, path: str) -> None:
    """B4-B6 sinks: one folder a split in one pass."""
    df.write.mode("overwrite").partitionBy(split).json(path)


def source_files(spark: SparkSession, root: str, extensions: Sequence[str], exclude: Sequence[str] = (), most_lines: int = 300, largest: int | None = None) -> DataFrame:
    """(path, size, content) of the files under root by extension, without excluded paths, long ones cut in the middle."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    ok = F.lit(False)
    for e in extensions:
        ok = ok | F.col("path").endswith(e)
    for x in exclude:
        ok = ok & ~F.contains("path", F.lit(x))
    files = files.filter(ok).select("path", F.col("length").alias("size"), head_and_tail(F.decode("content", "UTF-8"), most_lines).alias("content"))
    return files.orderBy("path") if largest is None else files.orderBy(F.desc("size"), "path").limit(largest)


def corpus_text(spark: SparkSession, path: str) -> DataFrame:
    """The sorted *.txt files of a folder (or one file), joined by blank lines, as one row."""
    t = spark.read.option("wholetext", "true").text(path).select(F.col("_metadata.file_path").alias("f"), "value")
    return t.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("f", "value"))), lambda s: s["value"]), "\n\n").alias("text"))


def save_stage(df: DataFrame, path: str) -> None:
    """S16."""
    df.select("text", "variation_type").write.mode("overwrite").parquet(path)


def stage_type(df: DataFrame) -> DataFrame:
    """variation_type, from is_varied in old stages."""
    old = F.when(F.col("is_varied"), "varied").otherwise("original") if "is_varied" in df.columns else F.lit("original")
    own = F.coalesce(F.col("variation_type"), old) if "variation_type" in df.columns else old
    return df.select("text", own.alias("variation_type"))


class ChunkStore:
    """Chunks by author in Parquet, one partition an author; rows are replaced by id."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self) -> DataFrame | None:
        return self.spark.read.parquet(self.path) if _exists(self.spark, self.path + "/*") else None

    def upsert(self, chunks: DataFrame) -> None:
        """Rows of the authors touched are rewritten: old rows without a new one of their id, and the new ones."""
        old = self.read()
        new = chunks
        if old is not None:
            touched = old.join(F.broadcast(chunks.select("author").distinct()), "author", "left_semi")
            new = touched.join(chunks.select("id"), "id", "left_anti").unionByName(chunks, allowMissingColumns=True)
            from millrace.sources.session import materialise

            new = materialise(new, "chunks")
        new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("author").parquet(self.path)

    def delete(self, author: str) -> None:
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(f"{self.path}/author={author}")
        where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def trainer_log(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Train and eval rows, told by eval_loss."""
    return log.filter("eval_loss is null").select("step", "epoch", "loss"), log.filter("eval_loss is not null").select("step", "epoch", "eval_loss")


def checkpoint_files(listing: DataFrame) -> DataFrame:
    """(path, size) -> checkpoint, its step, and a map of file to size, in order of step."""
    head = F.split_part("path", F.lit("/"), F.lit(1))
    out = listing.select(head.alias("checkpoint"), F.substring_index("path", "/", -1).alias("file"), "size").groupBy("checkpoint").agg(F.map_from_entries(F.collect_list(F.struct("file", "size"))).alias("files"))
    return out.withColumn("step", F.regexp_extract("checkpoint", r"(\d+)$", 1).try_cast("int")).orderBy("step")


def json_rows(x: Column, schema: str, wrapper: str | None = None) -> Column:
    """Rows of an object, an array, a wrapped array or a fenced block of JSON."""
    inner = F.regexp_extract(x, r"(?s)```(?:json)?\s*(.*?)```", 1)
    body = strip(F.when(inner != "", inner).otherwise(x))
    rows = F.from_json(body, f"array<{schema}>")
    wrapped = F.from_json(body, f"struct<{wrapper}:array<{schema}>>")[wrapper] if wrapper else F.lit(None).cast(f"array<{schema}>")
    one = F.filter(F.array(F.from_json(body, schema)), lambda r: r.isNotNull())
    return F.when(body.startswith("["), rows).otherwise(F.coalesce(wrapped, one))
