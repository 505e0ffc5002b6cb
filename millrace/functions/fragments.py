"""Incomplete sentences, model output and structure hints, in columns; lists stand in for a tagger."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.scores import any_of
from millrace.functions.text import _c, complete_sentences, let, sentences, strip, tidy_punctuation, word_count, words

#: Words that a sentence doesn't end on (fixed values).
OPEN_ENDS = (
    "a an the this that these those my your his her its our their in on at by for with about against between into through during before after above below to from up down of off over "
    "under and or but nor so yet because although though while since unless until if when where whereas is are was were be been being am have has had do does did will would shall should can could may might must not"
).split()
SUBORDINATORS = "although because since unless until while whereas though when where if that which who whom whose".split()
#: What a model's training format leaves behind (fixed values).
MARKERS = ["[NEUTRAL INPUT]:", "[NEUTRAL INPUT]", "_OUTPUT]:", "\n\nRewrite the following", "\n\n---", "_NOTE:", ".DebugLine", ".debugLine", "DebugLine:"]
FOREIGN = r"[Ѐ-ӿ֐-׿؀-ۿ฀-๿가-힯぀-ヿ一-鿿\u0080-\u009F　-〿＀-￯]"


def incomplete(x: Column | str) -> Column:
    """Why a sentence is incomplete, or null: a dash at its end, a word that something follows, or no end mark after three words."""
    t = strip(x)
    last = F.btrim(F.lower(F.element_at(words(t), -1)), F.lit(".,;:!?\"'()"))
    return F.when(F.coalesce(t, F.lit("")) == "", None).when(t.rlike("[—-]$"), "ends with dash").when(last.isin(*OPEN_ENDS), "ends with function word").when(~t.rlike("[.!?;:\"'”’]$") & (word_count(t) > 3), "no ending punctuation")


def incomplete_sentences(x: Column | str) -> Column:
    """X67."""
    return F.filter(sentences(x), lambda s: incomplete(s).isNotNull())


def whole_sentences(x: Column | str) -> Column:
    """X68."""
    return F.filter(sentences(x), lambda s: incomplete(s).isNull())


def clause_structure(x: Column | str) -> Column:
    """By how many subordinators a sentence has; four words or fewer are a fragment."""
    w = F.transform(words(F.lower(_c(x))), lambda s: F.btrim(s, F.lit(".,;:!?\"'()")))
    n = F.size(F.filter(w, lambda s: s.isin(*SUBORDINATORS)))
    return F.when(word_count(x) <= 4, "fragment").when(n == 0, "main").when(n == 1, "main + subordinate").otherwise("complex")


def cleaned_answer(x: Column | str, stop_markers: Sequence[str] = ()) -> Column:
    """Cut at training marks and foreign script, thoughts and runs of symbols out, marked sentences and an unfinished tail dropped."""
    t = F.split_part(_c(x), F.lit("###"), F.lit(1))
    for m in MARKERS:
        t = F.split_part(t, F.lit(m), F.lit(1))
    t = F.regexp_replace(t, r"[\d!@#$%^&*()_+{}|:\"<>?,./;'\[\]\\=\-]{10,}", "")
    t = F.split_part(F.regexp_replace(t, r"(?s)<think>.*?</think>", ""), F.lit("<think>"), F.lit(1))
    t = F.regexp_replace(F.regexp_extract(t, rf"(?s)^(.*?)(?:{FOREIGN}|\z)", 1), r"\s{2,}", " ")
    if stop_markers:
        t = F.array_join(F.filter(sentences(t), lambda s: ~any_of(F.lower(s), [m.lower() for m in stop_markers])), " ")
    return complete_sentences(strip(t))


def without_modifiers(x: Column | str, modifiers: Sequence[str]) -> Column:
    """Listed adjectives and adverbs dropped."""
    return F.array_join(F.filter(words(x), lambda w: ~F.btrim(F.lower(w), F.lit(".,;:!?")).isin(*modifiers)), " ")


def nouns_as_things(x: Column | str, nouns: Sequence[str]) -> Column:
    """Listed nouns as [THING], with the punctuation that follows."""
    core = lambda w: F.btrim(F.lower(w), F.lit(".,;:!?\"'"))
    return F.array_join(F.transform(words(x), lambda w: F.when(core(w).isin(*nouns), F.concat(F.lit("[THING]"), F.regexp_extract(w, r"([.,;:!?\"']*)$", 1))).otherwise(w)), " ")


def sentence_patterns(x: Column | str) -> Column:
    """Leading expletives out."""
    return tidy_punctuation(F.regexp_replace(_c(x), r"(?i)\b(?:it is|it's) (?:important|worth noting|interesting) (?:to note )?that ", ""))


def profile_text(sections: Column) -> Column:
    """A map of section to array of words, as lines, empty ones left out."""
    rows = F.filter(F.array_sort(F.map_entries(sections)), lambda e: F.size(e["value"]) > 0)
    return F.array_join(F.transform(rows, lambda e: F.concat(e["key"], F.lit(": "), F.array_join(e["value"], ", "))), "\n")


def default_rhythm(n: Column, key: Column, patterns: Sequence[Sequence[str]] = (("SHORT", "LONG", "MEDIUM"), ("LONG", "SHORT", "SHORT"), ("MEDIUM", "MEDIUM", "LONG"), ("FRAGMENT", "LONG", "SHORT"), ("LONG", "LONG", "FRAGMENT"))) -> Column:
    """The first n bands of a pattern picked by hash, repeated as needed."""
    pick = F.element_at(F.array(*[F.array(*[F.lit(b) for b in p]) for p in patterns]), (F.pmod(F.xxhash64(key), F.lit(len(patterns))) + 1).cast("int"))
    return let(pick, lambda p: F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda i: F.element_at(p, (i % F.size(p) + 1).cast("int"))))


def findings(matches: Column, denied: Sequence[str]) -> Column:
    """Tool findings with would_skip."""
    return F.transform(matches, lambda m: F.struct(m.alias("match"), m["rule_id"].isin(*denied).alias("would_skip")))


def hash_int(key: Column, low: int, high: int, salt: str = "") -> Column:
    """A number from low to high by hash."""
    return (F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(high - low + 1)) + low).cast("int")
