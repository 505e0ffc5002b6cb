"""The life cycles L1-L4 as compositions of operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.scores import change_type, load_reason, rhythm, style_metrics
from millrace.functions.text import clean_instruction, corpus_paragraphs
from millrace.operators import code, coreset, dedup, joins, models, profile, records, sampling, sessions
from millrace.sources.session import materialise


@dataclass(frozen=True)
class Assembly:
    max_per_type: int | None = None
    max_chars: int | None = None
    min_changed_lines: int = 4
    val_share: float = 0.05
    seed: int = 42


def assembled(git: Sequence[DataFrame], synthetic: Sequence[DataFrame], pools: dict[str, Sequence[str]], how: Assembly = Assembly(), order: Sequence[str] = ("_file", "_offset")) -> DataFrame:
    """L1: merge, repair, dedup, filter, balance the mined side, assign prompts, in hash order.

    Shuffles are at dedup (key), balance (type) and the final order only.
    """
    rows = [records.tag_source(d, "git") for d in git] + [records.tag_source(d, "synthetic") for d in synthetic]
    ranked = [d.withColumn("_rank", F.lit(i)) for i, d in enumerate(rows)]
    out = ranked[0]
    for d in ranked[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    out = out.withColumn("instruction", clean_instruction(F.coalesce("instruction", F.lit(""))))
    out = dedup.keep_first(out, dedup.exact_key(), ["_rank", *order])
    out = records.without_trivial_diffs(records.within_length(out, how.max_chars), how.min_changed_lines)
    text = F.lower(F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in ("instruction", "output", "input") if c in out.columns]))
    out = materialise(out.withColumn("change_type", change_type(text)).withColumn("_key", dedup.exact_key()), "assembled")
    mined = sampling.balance(out.filter("source != 'synthetic'"), "change_type", "_key", how.max_per_type, how.seed)
    both = mined.unionByName(out.filter("source = 'synthetic'"))
    return sampling.shuffled(records.assign_prompts(both, "_key", pools, seed=how.seed), "_key", how.seed).drop("_rank")


def split_checked(rows: DataFrame, how: Assembly = Assembly()) -> tuple[DataFrame, DataFrame]:
    """L1, last part: formatted train and val rows by objective and type; their keys don't meet."""
    split = materialise(sampling.stratified_split(rows, ["source", "change_type"], "_key", how.val_share, how.seed), "split")
    train, val = split.filter("split = 'train'"), split.filter("split = 'val'")
    joins.assert_no_leakage(train, val, "_key")
    return records.format_records(train), records.format_records(val)


def mined(commits: DataFrame, arc: int = 3, band: tuple[float, float] = (0.4, 0.8), patterns: Sequence[str] = (), diffs: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """L2: commits (of one repository) -> arcs with instruction, base, head and, given a diff reader, the diff and its patterns."""
    kept = records.code_commits(sessions.lifecycle_band(commits, ["timestamp", "hash"], *band))
    runs = sessions.arcs(kept, ["timestamp", "hash"], arc)
    at = F.struct("timestamp", "hash")
    own = runs.groupBy("repo", "arc").agg(
        F.min_by("parent", at).alias("base"), F.max_by("hash", at).alias("head"), F.array_distinct(F.flatten(F.collect_list("files"))).alias("files"),
        F.transform(F.array_sort(F.collect_list(F.struct("timestamp", "hash", "message"))), lambda c: c["message"]).alias("messages"),
    )
    own = own.withColumn("instruction", dedup.joint_instruction("messages")).filter("instruction != ''")
    if diffs is None:
        return own
    own = diffs(own).withColumn("patterns", code.pattern_flags("diff", "files"))
    return code.with_patterns(own, list(patterns)) if patterns else own


def indexed(corpus: DataFrame, author: str, text: str, embed: Callable | None = None, least_words: int = 30, threshold: float = 0.9) -> tuple[DataFrame, DataFrame]:
    """(chunks, reasons): split, quality, near-dup by the embedding if there is one, metrics, ids."""
    parts = corpus.select(F.col(author).alias("author"), F.posexplode(corpus_paragraphs(text)).alias("chunk_index", "text")).withColumn("reason", load_reason("text", least_words))
    parts = materialise(parts, "paragraphs")
    reasons = parts.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"))
    good = parts.filter("reason = 'ok'").drop("reason")
    good = good.withColumn("id", records.chunk_id("author", F.md5(F.col("text").cast("binary")), "chunk_index"))
    if embed is not None:
        good = materialise(models.embedded(good, F.col("text"), embed).withColumn("k", F.xxhash64("id")).withColumn("n", F.length("text")), "embedded")
        good = coreset.semantic_near(good, "k", "embedding", "n", threshold).drop("k", "n")
    return good.withColumn("metrics", style_metrics("text")), reasons


def guidance(chunks: DataFrame, text: str = "text") -> DataFrame:
    """One row of length, fragment and dash hints with an example rhythm."""
    hints = profile.length_guidance(chunks, text)
    example = sampling.sample(chunks.select(text, rhythm(text).alias("r")).filter("r.sentence_count >= 2"), text, 1).select(F.col("r.length_sequence").alias("rhythm"))
    return hints.crossJoin(F.broadcast(example))


def transformed(paragraphs: DataFrame, text: str, generate: Callable[[], Callable], least: float = 0.7) -> DataFrame:
    """References out, generate, verify, references back; paragraphs are independent of each other."""
    out = paragraphs.withColumn("refs", models.references(F.col(text)))
    out = models.generated(out, F.col(text), generate, "answer").filter("answer is not null")
    out = out.withColumn("check", joins.verification(text, "answer", least))
    return out.withColumn("restored", models.reinjected(F.col("answer"), F.col("refs")))


def registered_functions(spark: SparkSession) -> list[str]:
    """SQL names for column functions, as views of expressions: usable as `select millrace_...` through temporary functions."""
    made = []
    for name, args, body in (
        ("millrace_word_count", "x STRING", "regexp_count(coalesce(x, ''), '\\\\S+')"),
        ("millrace_strip", "x STRING", "btrim(x, ' \\t\\n\\r\\f\\u000b')"),
        ("millrace_dedup_key", "i STRING, o STRING", "sha2(concat(btrim(coalesce(i, ''), ' \\t\\n\\r\\f\\u000b'), '\\n', btrim(coalesce(o, ''), ' \\t\\n\\r\\f\\u000b')), 256)"),
        ("millrace_token_estimate", "x STRING", "cast(floor(regexp_count(coalesce(x, ''), '\\\\S+') * 1.3D) as int)"),
    ):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURN {body}")
        made.append(name)
    return made
