"""The corpus pipeline: quality, line dedup, near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents. run() writes each stage's result into the shared folder before the next
reads it, as stages read their input more than once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import line_dedup, minhash, mixing, packing, quality
from millrace.llm.common import materialise, read, ship
from millrace.llm.queries import tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    ship(spark)
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand in ten documents or more go; n_chars follows the text."""
    kept = line_dedup.drop_common_lines(docs, threshold=10, report=False)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: five-word shingles, a similarity of 0.8 or more."""
    return minhash.drop_near_duplicates(docs, k=5, num=80, den=100)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture's documents, each once."""
    return mixing.take(docs, mixing.PRODUCTION)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer_path(), window=2048, end=1)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("minhash near-dedup", near_stage),
    ("source mixing", mix_stage),
    ("packing", pack_stage),
]

#: SQL can express neither the classifier nor the packing; tests/llm/ holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
