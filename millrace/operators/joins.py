"""Lookup, interval, vector and grounding joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions.scores import mean
from millrace.functions.text import _c, let, same_stem, sentences, word_count
from millrace.functions.vectors import cosine
from millrace.operators import blocks
from millrace.operators.records import content_words
from millrace.sources.session import materialise


#: Query vectors of at most so many rows are broadcast to the items.
QUERY_ROWS = 20_000


def leaked(train: DataFrame, val: DataFrame, key: str) -> DataFrame:
    """The keys that stand in both."""
    return train.select(key).intersect(val.select(key))


def assert_no_leakage(train: DataFrame, val: DataFrame, key: str) -> None:
    """J1."""
    if not leaked(train, val, key).isEmpty():
        raise ValueError("train and val share keys")


def file_states(before: DataFrame, after: DataFrame, changes: DataFrame) -> DataFrame:
    """(path, change_type) with both contents; added has no before, deleted no after."""
    out = changes.join(before.withColumnRenamed("content", "before"), "path", "left").join(after.withColumnRenamed("content", "after"), "path", "left")
    return out.withColumn("before", F.when(F.col("change_type") != "added", F.col("before"))).withColumn("after", F.when(F.col("change_type") != "deleted", F.col("after")))


def interval_overlap(left: DataFrame, right: DataFrame, keys: Sequence[str], l_start: str, l_end: str, r_start: str, r_end: str, width: int = 64) -> DataFrame:
    """Pairs whose closed intervals overlap (l_start <= r_end and r_start <= l_end).

    Both sides are cut into bins of `width`, joined on key and bin, and each pair is kept in the first bin it shares.
    """
    bins = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / width), F.floor(F.greatest(F.col(a), F.col(b)) / width)))
    a, b = left.withColumn("_bin", bins(l_start, l_end)), right.withColumn("_bin", bins(r_start, r_end))
    out = a.join(b, [*keys, "_bin"]).filter((F.col(l_start) <= F.col(r_end)) & (F.col(r_start) <= F.col(l_end)))
    return out.filter(F.col("_bin") == F.floor(F.greatest(l_start, r_start) / width)).drop("_bin")


def vector_top(queries: DataFrame, items: DataFrame, q_vec: str, i_vec: str, q_id: str, i_id: str, k: int, least: float = 0.15) -> DataFrame:
    """Of each query the k items of highest cosine, ties to the smaller id.

    The query set is stated, and meets the items block by block in numpy (`blocks`). Up to QUERY_ROWS queries their blocks
    are broadcast; more are read by each item partition. A task passes on what isn't worse than the k best it has met, by the
    sums that `cosine` makes; what the tasks pass on is written once and ranked.
    """
    few = queries.count() <= QUERY_ROWS
    found = blocks.top(blocks.packed(items, i_id, i_vec), blocks.packed(queries, q_id, q_vec), i_id, q_id, k, least, few)
    rows = materialise(found.toDF(q_id, i_id + "_match", "similarity"), "top")
    w = Window.partitionBy(q_id).orderBy(F.desc("similarity"), F.asc_nulls_last(i_id + "_match"))
    return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def centroid(df: DataFrame, vec: str, within: Sequence[str] = (), weight: Column | None = None) -> DataFrame:
    """The weighted mean vector, summed by position with partial aggregates."""
    w = weight if weight is not None else F.lit(1.0)
    flat = df.select(*within, w.alias("_w"), F.posexplode(vec).alias("_pos", "_x"))
    sums = flat.groupBy(*within, "_pos").agg((F.sum(F.col("_x").cast("double") * F.col("_w")) / F.sum("_w")).alias("_m"))
    return sums.groupBy(*within).agg(F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_m"))), lambda s: s["_m"]).alias("centroid"))


def centroid_similarity(df: DataFrame, vec: str, center: DataFrame) -> DataFrame:
    """Each vector against a one-row centroid."""
    return df.crossJoin(F.broadcast(center)).withColumn("similarity", cosine(vec, "centroid")).drop("centroid")


def f1(a: Column, b: Column) -> Column:
    """Of two word sets: 2pr / (p + r)."""
    both = F.size(F.array_intersect(a, b))
    return F.when(both > 0, 2.0 * both / (F.size(a) + F.size(b))).otherwise(F.lit(0.0))


def grounding(source: Column | str, output: Column | str, threshold: float = 0.4) -> Column:
    """Per output sentence of four words or more: best source sentence (the first on ties), its score, grounded, hallucinated.

    Sentences of both sides are local to the row, so they meet in the row.
    """

    def check(s: Column, own: Column, src: Column, every: Column) -> Column:
        def of(scores: Column) -> Column:
            best = F.coalesce(F.array_max(scores), F.lit(0.0))
            free = (word_count(s) < 4) | (F.size(own) == 0)
            novel = F.when(F.size(own) > 0, F.size(F.array_except(own, every)) / F.size(own)).otherwise(F.lit(0.0))
            return F.struct(
                s.alias("sentence"),
                F.when(~free & (best > 0), F.array_position(scores, best).cast("int") - 1).alias("match"),
                F.when(free, F.lit(1.0)).otherwise(best).alias("score"),
                (free | (best >= threshold) | (novel < 0.3)).alias("grounded"),
                (~free & (best < 0.15) & (novel > 0.5) & (word_count(s) > 8)).alias("hallucinated"),
            )

        return let(F.transform(src, lambda w: f1(own, w)), of)

    def against(k: Column) -> Column:
        return F.transform(sentences(output), lambda s: let(F.array_distinct(content_words(s)), lambda own: check(s, own, k["src"], k["every"])))

    src = F.transform(sentences(source), lambda s: F.array_distinct(content_words(s)))
    return let(let(src, lambda x: F.struct(x.alias("src"), F.array_distinct(F.flatten(x)).alias("every"))), against)


def content_coverage(source: Column | str, output: Column | str) -> Column:
    """Share of the source's content words that the output has; 1 if there are none."""
    b = content_words(output)
    return let(F.array_distinct(content_words(source)), lambda a: F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(a)).otherwise(F.lit(1.0)))


def missing_content(source: Column | str, output: Column | str) -> Column:
    """The content words that the output lacks, sorted."""
    return F.array_sort(F.array_except(F.array_distinct(content_words(source)), F.array_distinct(content_words(output))))


def _entities(x: Column | str) -> Column:
    """Stand-in for a tagger: runs of capitalised words inside a sentence."""
    found = F.regexp_extract_all(_c(x), F.lit(r"(?<=[a-z,;] )\p{Lu}\p{L}+(?: \p{Lu}\p{L}+)*"), F.lit(0))
    return F.array_distinct(F.transform(found, F.lower))


def entity_coverage(source: Column | str, output: Column | str) -> Column:
    """(coverage, missing, fabricated): entities by stem, years from 1800 to 2099 and citations exactly."""
    a, b = _entities(source), _entities(output)
    lost = F.filter(a, lambda e: ~F.exists(b, lambda o: same_stem(e, o)))
    made = F.filter(b, lambda o: ~F.exists(a, lambda e: same_stem(e, o)))
    years = lambda x: F.array_distinct(F.regexp_extract_all(_c(x), F.lit(r"\b(1[89]\d{2}|20\d{2})\b"), F.lit(1)))
    cites = lambda x: F.array_distinct(F.regexp_extract_all(_c(x), F.lit(r"\([^)]*(?:19|20)\d{2}[^)]*\)"), F.lit(0)))
    new_years = F.transform(F.array_except(years(output), years(source)), lambda y: F.concat(F.lit("year:"), y))
    new_cites = F.transform(F.array_except(cites(output), cites(source)), lambda c: F.concat(F.lit("citation:"), F.substring(c, 1, 30)))
    return F.struct(
        F.when(F.size(a) > 0, 1 - F.size(lost) / F.size(a)).otherwise(F.lit(1.0)).alias("coverage"), F.array_sort(lost).alias("missing"),
        F.concat(F.array_sort(made), new_years, new_cites).alias("fabricated"),
    )


def verification(source: Column | str, output: Column | str, threshold: float = 0.7) -> Column:
    """0.4 grounded + 0.3 content + 0.3 entities, less penalties, at least 0."""
    g = grounding(source, output)
    grounded = F.when(F.size(g) > 0, mean(F.transform(g, lambda s: s["grounded"].cast("double")))).otherwise(F.lit(0.0))
    e = entity_coverage(source, output)
    halluc, made = F.size(F.filter(g, lambda s: s["hallucinated"])), F.size(e["fabricated"])
    score = grounded * 0.4 + content_coverage(source, output) * 0.3 + e["coverage"] * 0.3 - F.least(F.lit(0.5), halluc * 0.15) - F.least(F.lit(0.3), made * 0.1)
    score = F.greatest(F.lit(0.0), score)
    return F.struct(score.alias("score"), (score >= threshold).alias("valid"), grounded.alias("grounded"), halluc.alias("hallucinations"), made.alias("fabricated"))


def issues(v: Column) -> Column:
    """What a verification finds wrong."""
    return F.array_compact(
        F.array(F.when(v["grounded"] < 0.7, "low grounding"), F.when(v["score"] < 0.5, "low score"), F.when(v["hallucinations"] > 0, "hallucinated sentences"), F.when(v["fabricated"] > 0, "fabricated entities"))
    )


def pending(chunks: DataFrame, processed: DataFrame, key: str, anchors: DataFrame | None = None, parity: int | None = None) -> DataFrame:
    """Chunks (of one parity) with a successful anchor, without those processed."""
    out = chunks if parity is None else chunks.filter(F.col(key) % 2 == parity)
    if anchors is not None:
        out = out.join(anchors.select(key).distinct(), key, "left_semi")
    return out.join(processed.select(key).distinct(), key, "left_anti")


def chat_to_record(turns: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """The last user and last assistant text of each conversation, and the first system text."""
    last = lambda role: F.max_by(F.when(F.col("role") == role, F.col("text")), F.when(F.col("role") == role, F.col(turn)))
    out = turns.groupBy(conv).agg(last("user").alias("instruction"), last("assistant").alias("output"), F.min_by(F.when(F.col("role") == "system", F.col("text")), F.when(F.col("role") == "system", F.col(turn))).alias("system"))
    return out.filter("instruction is not null and output is not null").withColumn("system", F.coalesce("system", F.lit("")))


def best_step(log: DataFrame, step: str = "step", loss: str = "eval_loss") -> DataFrame:
    """The step of the least loss, the first on ties."""
    return log.filter(F.col(loss).isNotNull()).agg(F.min_by(step, F.struct(loss, step)).alias(step), F.min(loss).alias(loss))


def routed(features: DataFrame, table: DataFrame, kind: str, default: str) -> DataFrame:
    """Category by exact kind, else the first in table order where either name contains the other, else the default.

    table: (kind_name, category, ord), a taxonomy.
    """
    t = F.broadcast(table)
    pairs = features.select(kind).distinct().join(t, F.contains(F.col(kind), F.col("kind_name")) | F.contains(F.col("kind_name"), F.col(kind)), "left")
    best = pairs.groupBy(kind).agg(F.min_by("category", F.struct((F.col("kind_name") != F.col(kind)).cast("int"), "ord")).alias("category"))
    return features.join(F.broadcast(best), kind, "left").withColumn("category", F.coalesce("category", F.lit(default)))


def best_child(features: DataFrame, children: DataFrame, parent: str, text: str) -> DataFrame:
    """The child of the feature's parent with the highest score (3 for its name in the text, 1 a shared word), the first on ties."""
    c = F.broadcast(children.select(F.col("parent").alias(parent), "child", "ord"))
    spaced = F.replace(F.lower("child"), F.lit("-"), F.lit(" "))
    score = F.when(F.contains(F.lower(text), spaced), 3).otherwise(0) + F.size(F.array_intersect(F.split(spaced, " "), F.split(F.lower(text), r"\W+")))
    out = features.join(c, parent).groupBy(*features.columns).agg(F.min_by("child", F.struct(-score, "ord")).alias("child"))
    return out


def sentence_index(df: DataFrame, key: str, text: str, least: int = 8, most: int = 60) -> DataFrame:
    """Sentences of 8 to 60 words with paragraph and place."""
    from millrace.functions.text import paragraphs

    p = df.select(key, F.posexplode(paragraphs(text)).alias("paragraph", "_p"))
    s = p.select(key, "paragraph", F.posexplode(sentences("_p")).alias("position", "sentence"))
    return s.filter(word_count("sentence").between(least, most))


#: So many item keys at most are compared as one array; more are joined by shuffle.
ITEM_KEYS = 20_000


def containing(docs: DataFrame, text: str, items: DataFrame, item: str, item_text: str) -> DataFrame:
    """docs' columns and `item` for each item whose text stands in the document's, as it is.

    An item's second to fourth words stand whole in every text that holds it, so a document meets only the items
    whose three words it has; then the texts decide. Items of fewer than five words are few enough words to be looked for one by one.
    """
    from millrace.functions.text import let, words

    triple = lambda w, i: F.xxhash64(w[i], w[i + 1], w[i + 2])
    own = items.filter(F.col(item_text).isNotNull()).select(F.col(item).alias("_item"), F.col(item_text).alias("_t"), words(item_text).alias("_w"))
    long_ = own.filter(F.size("_w") >= 5).select("_item", "_t", triple(F.col("_w"), 1).alias("_key"))
    short = own.filter(F.size("_w") < 5).select("_item", "_t")
    found = let(words(text), lambda w: F.when(F.size(w) >= 3, F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: triple(w, i)))).otherwise(F.array().cast("array<long>")))
    keys = long_.select("_key").distinct()
    n = keys.count()
    if n <= ITEM_KEYS:
        one = keys.agg(F.collect_list("_key").alias("_keys"))
        met = docs.crossJoin(F.broadcast(one)).withColumn("_key", F.explode(F.array_intersect(found, "_keys"))).join(F.broadcast(long_), "_key")
    else:
        met = docs.withColumn("_key", F.explode(found)).join(long_, "_key")
    out = met.filter(F.contains(text, "_t")).select(*docs.columns, F.col("_item").alias(item))
    if short.isEmpty():
        return out
    return out.unionAll(docs.join(short.hint("shuffle_replicate_nl"), F.contains(F.col(text), F.col("_t"))).select(*docs.columns, F.col("_item").alias(item)))
