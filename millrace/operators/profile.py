"""Corpus profiles: vocabulary, transitions, stance, openings, distinctive words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.functions import lexicons as L
from millrace.functions.scores import length_band, rhythm
from millrace.functions.text import sentences, word_count, words

PUNCTUATION = ".,!?;:'\"()-—“”"


def bare(s: Column) -> Column:
    return F.btrim(F.lower(s), F.lit(PUNCTUATION))


def tokens(df: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """(keys, word): lower-case words without outer punctuation."""
    return df.select(*keys, F.explode(F.transform(words(text), bare)).alias("word")).filter("word != ''")


def _top(counts: DataFrame, within: Sequence[str], k: int) -> DataFrame:
    w = Window.partitionBy(*within).orderBy(F.desc("n"), "word")
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def vocabulary_clusters(df: DataFrame, text: str, k: int = 10) -> DataFrame:
    """(cluster, word, n, rank) of seven word classes; those a tagger would give fall back to their lists."""
    lists = {"certainty": L.CERTAINTY, "hedge": L.HEDGES, "archaic": L.ARCHAIC, "emotional": L.EMOTIONS, "sensory": L.SENSORY, "temporal": L.TEMPORAL_WORDS, "conceptual": L.CONCEPT_WORDS}
    t = tokens(df, [], text)
    cluster = F.when(F.lit(False), F.lit(""))
    for name, ws in lists.items():
        cluster = cluster.when(F.col("word").isin(*ws), name)
    counts = t.withColumn("cluster", cluster).filter("cluster is not null").groupBy("cluster", "word").agg(F.count(F.lit(1)).alias("n"))
    return _top(counts, ["cluster"], k)


def first_words(df: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """(keys, word): the first word of each sentence."""
    s = df.select(*keys, F.explode(sentences(text)).alias("s"))
    return s.select(*keys, bare(words("s")[0]).alias("word")).filter("word != ''")


def transitions(df: DataFrame, text: str, k: int = 5) -> DataFrame:
    """(class, word, n, rank): the commonest sentence-initial connectives of each class."""
    kind = F.when(F.lit(False), F.lit(""))
    for name, ws in L.TRANSITIONS.items():
        kind = kind.when(F.col("word").isin(*ws), name)
    counts = first_words(df, [], text).withColumn("class", kind).filter("class is not null").groupBy("class", "word").agg(F.count(F.lit(1)).alias("n"))
    return _top(counts, ["class"], k)


def unused_transitions(df: DataFrame, text: str) -> DataFrame:
    """The machine transitions that open no sentence of the corpus."""
    spark = df.sparkSession
    own = df.select(F.explode(sentences(text)).alias("s")).select(F.explode(F.filter(F.array(*[F.lit(t) for t in L.MACHINE_TRANSITIONS]), lambda t: F.startswith(F.lower(F.col("s")), t))).alias("word")).distinct()
    return spark.createDataFrame([(t,) for t in L.MACHINE_TRANSITIONS], "word string").join(own, "word", "left_anti")


def stance(df: DataFrame, text: str, within: Sequence[str] = ()) -> DataFrame:
    """Question rate a text; exclamations, address and parentheses a sentence; certainty and hedge counts."""
    s = sentences(text)
    low = F.transform(words(text), bare)
    count = lambda keys: F.size(F.filter(low, lambda w: w.isin(*keys)))
    per = df.select(
        *within, F.size(s).alias("s"), F.size(F.filter(s, lambda x: x.endswith("?"))).alias("q"), F.size(F.filter(s, lambda x: F.contains(x, F.lit("!")))).alias("e"),
        F.size(F.filter(s, lambda x: F.contains(x, F.lit("—")) | F.contains(x, F.lit("(")))).alias("p"), count(L.ADDRESS).alias("a"), count(L.CERTAINTY).alias("c"), count(L.HEDGES).alias("h"),
    )
    n, t = F.greatest(F.sum("s"), F.lit(1)), F.greatest(F.count(F.lit(1)), F.lit(1))
    return per.groupBy(*within).agg(
        (F.sum("q") / t).alias("question_freq"), (F.sum("e") / n).alias("exclamation_freq"), (F.sum("a") / n).alias("address_freq"), (F.sum("p") / n).alias("parenthetical_freq"),
        F.sum("c").alias("certainty"), F.sum("h").alias("hedges"),
    )


def openings(df: DataFrame, text: str, n: int = 3, k: int = 15) -> DataFrame:
    """The commonest n-word openings with their share; words stand in for tags."""
    s = df.select(F.explode(sentences(text)).alias("s")).filter(word_count("s") >= n)
    counts = s.select(F.array_join(F.slice(F.transform(words("s"), bare), 1, n), " ").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("_t"))
    return counts.orderBy(F.desc("n"), "word").limit(k).crossJoin(F.broadcast(total)).select(F.col("word").alias("opening"), "n", (F.col("n") / F.col("_t")).alias("share"))


def tag_templates(df: DataFrame, tags: str, example: str, order: str, n: int = 10, k: int = 10) -> DataFrame:
    """The commonest n-tag patterns of tagged sentences (an array column), with the first example."""
    p = df.filter(F.size(tags) >= n).select(F.array_join(F.slice(tags, 1, n), " ").alias("pattern"), example, order)
    out = p.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"), F.min_by(example, order).alias("exemplar"))
    return out.orderBy(F.desc("n"), "pattern").limit(k)


def complexity(df: DataFrame, text: str) -> DataFrame:
    """Shares of sentences that open inverted (by list), end long clauses late, and hold a dash."""
    s = df.select(F.explode(sentences(text)).alias("s"))
    inverted = F.lower("s").rlike(r"^(never|seldom|rarely|nor|neither|here|there|so|such|not only|in|on|from|beneath|beyond|above)(?![\p{L}\p{N}_])")
    late = F.coalesce(F.regexp_instr("s", F.lit(",[^,]*$")), F.lit(0)) > F.length("s") * 0.4
    return s.agg(F.avg(inverted.cast("int")).alias("inverted"), F.avg(late.cast("int")).alias("periodic"), F.avg(F.contains("s", F.lit("—")).cast("int")).alias("dashes"))


def starters(df: DataFrame, key: str, text: str, least: int = 2) -> DataFrame:
    """Two-word sentence starters used `least` times or more in a text."""
    s = df.select(key, F.explode(sentences(text)).alias("s")).filter(word_count("s") >= 2)
    st = s.select(key, F.array_join(F.slice(F.transform(words("s"), F.lower), 1, 2), " ").alias("starter"))
    return st.groupBy(key, "starter").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)


def overused(df: DataFrame, text: str, k: int = 10, threshold: int = 3) -> DataFrame:
    """The top k words, and of these those at the threshold."""
    counts = tokens(df, [], text).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "word").limit(k).filter(F.col("n") >= threshold)


def distinctive(source: DataFrame, reference: DataFrame, text: str, least: int = 3, above: float = 0.5) -> DataFrame:
    """log2((c_s + 1) / (c_r + 1)) of words of the source, above 0.5."""
    count = lambda d, n: tokens(d, [], text).groupBy("word").agg(F.count(F.lit(1)).alias(n))
    both = count(source, "n_source").filter(F.col("n_source") >= least).join(count(reference, "n_reference"), "word", "left")
    both = both.withColumn("n_reference", F.coalesce("n_reference", F.lit(0)))
    return both.withColumn("score", F.log2((F.col("n_source") + 1) / (F.col("n_reference") + 1))).filter(F.col("score") > above)


def noun_category(x: Column, lists: dict[str, Sequence[str]], default: str = "physical") -> Column:
    """The category of most shared words, the first on ties."""
    own = F.array_distinct(F.transform(words(x), bare))
    scores = {k: F.size(F.array_intersect(own, F.array(*[F.lit(w) for w in ws]))) for k, ws in lists.items()}
    best = F.greatest(*scores.values())
    out = F.when(best == 0, default)
    for k, s in scores.items():
        out = out.when(s == best, k)
    return out


def length_guidance(df: DataFrame, text: str) -> DataFrame:
    """Mean length and variance of rhythms of two sentences or more, with levels of fragments and dashes."""
    r = df.select(rhythm(text).alias("r")).filter("r.sentence_count >= 2")
    out = r.agg(F.avg("r.avg_length").alias("avg"), F.avg("r.length_variance").alias("variance"), F.avg("r.fragment_ratio").alias("fragments"), F.avg((F.col("r.punctuation_density") > 0.3).cast("int")).alias("dense"))
    return out.select(
        "avg", "variance", F.greatest(F.lit(3), F.floor(F.col("avg") - F.sqrt("variance"))).alias("min_words"), F.ceil(F.col("avg") + F.sqrt("variance")).alias("max_words"),
        F.when(F.col("fragments") > 0.2, "frequent").when(F.col("fragments") > 0.1, "occasional").otherwise("rare").alias("fragment_hint"), (F.col("dense") > 0.3).alias("dash_hint"),
    )


def corpus_counts(df: DataFrame, author: str, filled: str) -> DataFrame:
    """Chunks of each author and the share with a value."""
    return df.groupBy(author).agg(F.count(F.lit(1)).alias("chunks"), (F.count_if(F.col(filled).isNotNull()) / F.count(F.lit(1))).alias("filled"))


def shares(df: DataFrame, kind: str) -> DataFrame:
    """Counts and whole percent of each kind."""
    counts = df.groupBy(kind).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("_t"))
    return counts.crossJoin(F.broadcast(total)).select(kind, "n", F.floor(F.col("n") * 100 / F.col("_t")).cast("long").alias("percent"))


def band_counts(df: DataFrame, text: str) -> DataFrame:
    """X62 over all sentences."""
    return df.select(F.explode(sentences(text)).alias("s")).groupBy(length_band(word_count("s")).alias("band")).agg(F.count(F.lit(1)).alias("n"))
