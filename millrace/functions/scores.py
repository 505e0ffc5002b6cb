"""Quality, style and class of a text, as column expressions inside one projection."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions import lexicons as L
from millrace.functions.text import _c, let, run_counts, sentence_lengths, sentences, strip, word_count, word_tokens, words


def hits(x: Column, keywords: list[str]) -> Column:
    """A1: how many of the keywords the text contains; one listed twice counts twice."""
    return sum((F.contains(x, F.lit(k)).cast("int") for k in keywords), F.lit(0))


def any_of(x: Column, keywords: list[str]) -> Column:
    # Bound first: in the inner lambda x would be computed for each keyword.
    return let(x, lambda v: F.exists(F.array(*[F.lit(k) for k in keywords]), lambda k: F.contains(v, k)))


def change_type(x: Column) -> Column:
    """A2: the class of most keywords of lower-case text x, the earlier on ties; none, or docs, is refactor."""
    scores = {name: hits(x, keys) for name, keys in L.CHANGE_TYPES}
    best = F.greatest(*scores.values())
    out = F.when(best == 0, F.lit("refactor"))
    for name, s in scores.items():
        out = out.when(s == best, F.lit("refactor" if name == "docs" else name))
    return out


def relevance(instruction: Column | str) -> Column:
    """X20."""
    t = strip(F.lower(_c(instruction)))
    n, terms = F.length(t), hits(t, L.CODE_TERMS)
    band = F.when(n < 10, 0.1).when(n < 30, 0.3).when(n <= 200, 0.5).when(n <= 500, 0.4).otherwise(0.3)
    dense = F.when(terms >= 4, 0.3).when(terms >= 2, 0.2).when(terms >= 1, 0.1).otherwise(0.0)
    task = F.when(any_of(t, L.TASK_WORDS), 0.2).otherwise(0.0)
    return F.when(F.coalesce(t, F.lit("")) == "", F.lit(0.0)).otherwise(F.least(band + dense + task, F.lit(1.0)))


def special_ratio(x: Column | str, allowed: str) -> Column:
    """Share of characters outside the class `allowed`; 0 for an empty text."""
    return F.regexp_count(_c(x), F.lit(f"[^{allowed}]")) / F.greatest(F.length(_c(x)), F.lit(1))


def special_chars(x: Column | str) -> Column:
    """share of characters that are neither letters, digits nor white space."""
    return F.when(F.length(_c(x)) > 0, F.regexp_count(_c(x), F.lit(r"[^\p{L}\p{N}\s]")) / F.length(_c(x))).otherwise(F.lit(0.0))


def word_repetition(x: Column | str) -> Column:
    """one less the share of distinct words; 0 under ten words."""
    return let(words(F.lower(_c(x))), lambda w: F.when(F.size(w) < 10, F.lit(0.0)).otherwise(1 - F.size(F.array_distinct(w)) / F.size(w)))


def _top(w: Column) -> Column:
    """How often the most frequent of lower-case words stands among them, of those with more than three letters: the longest run of the sorted words."""
    long_ = lambda s: F.length(s) > 3
    ordered = F.sort_array(F.filter(F.transform(F.filter(w, long_), lambda s: F.btrim(s, F.lit(".,!?;:'\""))), long_))
    return F.coalesce(-F.array_min(F.transform(run_counts(ordered), lambda c: c["n"])), F.lit(0))


def top_frequency(x: Column | str) -> Column:
    """How often the most frequent word of more than three letters stands in the text."""
    return _top(words(F.lower(_c(x))))


def _parts(x: Column) -> Column:
    return F.split(strip(x), "[.!?]+")


def _artifacts(x: Column) -> Column:
    return F.regexp_replace(x, "[—–‘’“”…]", "").rlike(r"[^\x00-\x7F]{3,}")


def _facts(x: Column, least: int, of) -> Column:
    """of(facts), where facts holds what F9 and F10 ask of a text, each computed once: its number of words and, from `least` words on,
    whether it has artifacts, the words of its parts, and its top frequency."""
    facts = lambda w: F.struct(
        F.size(w).alias("n"), F.when(F.size(w) >= least, _artifacts(x)).alias("artifacts"),
        F.when(F.size(w) >= least, F.transform(_parts(x), word_count)).alias("sizes"), F.when(F.size(w) >= least, _top(w)).alias("top"),
    )
    return let(let(words(F.lower(x)), facts), of)


def _repeated(f: Column) -> Column:
    return (f["top"] > f["n"] * 0.15) & (f["top"] > 5)


def _curation(x: Column, f: Column, min_words: int) -> Column:
    few = F.size(F.filter(f["sizes"], lambda k: k >= 3)) < 2
    broken = F.size(F.filter(f["sizes"], lambda k: (k > 0) & (k < 3))) > F.size(f["sizes"]) * 0.5
    return (
        F.when(f["n"] < min_words, "too short").when(f["artifacts"], "encoding artifacts").when(special_ratio(x, r"a-zA-Z0-9\s.,!?;:'\"()-") > 0.1, "too many special chars")
        .when(few, "too few complete sentences").when(broken, "too many fragments")
        .when(_repeated(f), "excessive repetition").otherwise("ok")
    )


def _load(x: Column, f: Column, min_words: int) -> Column:
    complete = F.size(F.filter(f["sizes"], lambda k: k >= 3))
    return (
        F.when(f["n"] < min_words, "too_short").when(f["artifacts"], "encoding_artifacts").when(special_ratio(x, "a-zA-Z0-9\\s.,!?;:'\"()\\-—–") > 0.1, "special_chars")
        .when(complete < 1, "incomplete").when(_repeated(f), "repetitive").otherwise("ok")
    )


def curation_reason(x: Column | str, min_words: int = 40) -> Column:
    """the first rule that the paragraph breaks, or ok."""
    x = _c(x)
    return _facts(x, min_words, lambda f: _curation(x, f, min_words))


def load_reason(x: Column | str, min_words: int = 30) -> Column:
    """as F9, with stable codes and without the fragment rule."""
    x = _c(x)
    return _facts(x, min_words, lambda f: _load(x, f, min_words))


def reasons(x: Column | str, curation_words: int = 40, load_words: int = 30) -> Column:
    """F9 and F10 as a struct (curation, load)."""
    x = _c(x)
    return _facts(x, min(curation_words, load_words), lambda f: F.struct(_curation(x, f, curation_words).alias("curation"), _load(x, f, load_words).alias("load")))


def config_reason(x: Column | str, min_words: int = 40, max_words: int = 500, min_sentences: int = 2, most_special: float = 0.15, most_repeated: float = 0.6) -> Column:
    """the configurable rules."""
    n = word_count(x)
    return (
        F.when(n < min_words, "too_short").when(n > max_words, "too_long").when(F.size(sentences(x)) < min_sentences, "few_sentences")
        .when(special_chars(x) > most_special, "special_chars").when(word_repetition(x) > most_repeated, "repetition").otherwise("ok")
    )


def overlap(a: Column | str, b: Column | str) -> Column:
    """Shared distinct lower-case words over a's."""
    wb = words(F.lower(_c(b)))
    return let(F.array_distinct(words(F.lower(_c(a)))), lambda wa: F.when(F.size(wa) > 0, F.size(F.array_intersect(wa, wb)) / F.size(wa)).otherwise(F.lit(0.0)))


def good_variation(original: Column | str, varied: Column | str) -> Column:
    """F15."""
    a, b = word_count(original), word_count(varied)
    return (F.abs(a - b) <= a * 0.2) & (F.abs(F.size(sentences(original)) - F.size(sentences(varied))) <= 1) & (overlap(original, varied) <= 0.85)


def good_perspective(original: Column | str, varied: Column | str) -> Column:
    """F16."""
    a, b = word_count(original), word_count(varied)
    return (F.abs(a - b) <= a * 0.15) & (F.size(sentences(original)) == F.size(sentences(varied)))


def lexical_bleed(neutral: Column | str, styled: Column | str) -> Column:
    """share of styled's distinctive words that neutral has; 0 if it has none."""
    common = F.array(*[F.lit(w) for w in L.COMMON_WORDS])
    given = words(F.lower(_c(neutral)))
    return let(F.array_except(words(F.lower(_c(styled))), common), lambda own: F.when(F.size(own) > 0, F.size(F.array_intersect(own, given)) / F.size(own)).otherwise(F.lit(0.0)))


def mean(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0.0), lambda a, x: a + x) / F.size(xs)


def deviation(xs: Column) -> Column:
    """Population standard deviation of a non-empty array."""
    return let(mean(xs), lambda m: F.sqrt(F.aggregate(xs, F.lit(0.0), lambda a, x: a + (x - m) * (x - m)) / F.size(xs)))


def burstiness(x: Column | str) -> Column:
    """Standard deviation over mean of sentence lengths; 0 under two sentences."""
    return let(sentence_lengths(x), lambda n: F.when(F.size(n) >= 2, deviation(n) / mean(n)).otherwise(F.lit(0.0)))


def _style(x: Column, with_connectives: bool) -> Column:
    hard = any_of(x, L.COMPLEX_MARKS)
    syntax = F.when(hard, "Complex Syntax").otherwise("Simple Syntax")
    if with_connectives:
        syntax = F.when(hard & any_of(F.lower(x), L.CONNECTIVES), "Baroque Syntax").otherwise(syntax)

    def tag(n: Column) -> Column:
        length = let(mean(n), lambda m: F.when(m < 12, "Short & Punchy").when(m > 25, "Long & Flowing").when(deviation(n) > 8, "Varied Lengths").otherwise("Medium Length"))
        return F.when(F.size(n) == 0, "[STYLE: Medium Length | Simple Syntax]").otherwise(F.concat(F.lit("[STYLE: "), length, F.lit(" | "), syntax, F.lit("]")))

    return let(sentence_lengths(x), tag)


def style_tag(x: Column | str) -> Column:
    """X36."""
    return _style(_c(x), True)


def simple_style_tag(x: Column | str) -> Column:
    """X102."""
    return _style(_c(x), False)


def vocabulary_richness(x: Column | str) -> Column:
    """A34."""

    def score(w: Column) -> Column:
        rare = lambda own: F.size(F.filter(own, lambda s: (F.length(s) > 8) & ~s.isin(*L.RICHNESS_STOP_WORDS)))
        own = let(F.array_distinct(w), lambda o: F.size(o) / F.size(w) * 0.6 + rare(o) / F.greatest(F.size(o), F.lit(1)) * 0.4 + 0.2)
        return F.when(F.size(w) < 10, F.lit(0.0)).otherwise(F.least(F.lit(1.0), own))

    return let(F.filter(word_tokens(x), lambda s: s.rlike("^[a-z]+$")), score)


def syntax_complexity(x: Column | str) -> Column:
    """A35."""
    x = _c(x)
    lengths = F.transform(F.filter(F.split(x, "[.!?]+"), lambda s: strip(s) != ""), word_count)
    marks = F.least(F.lit(1.0), F.regexp_count(x, F.lit("[;:—–()]")) / 10)
    clauses = F.least(F.lit(1.0), F.size(F.filter(word_tokens(x), lambda w: w.isin(*L.CLAUSE_MARKERS))) / 5)

    def score(n: Column) -> Column:
        spread = F.when(F.size(n) < 2, F.lit(0.3)).otherwise(F.least(F.lit(1.0), deviation(n) / 20))
        return F.when(F.size(n) == 0, F.lit(0.0)).otherwise(spread * 0.3 + marks * 0.3 + clauses * 0.4)

    return let(lengths, score)


def style_markers(x: Column | str) -> Column:
    """A36."""
    x = _c(x)
    low = F.lower(x)
    found = F.least(F.lit(1.0), hits(low, L.DARK_WORDS) / 5)
    phrases = F.least(F.lit(1.0), sum((low.rlike(p).cast("int") for p in L.DARK_PATTERNS), F.lit(0)) / 3)
    own = F.size(F.filter(F.regexp_extract_all(x, F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)), lambda w: w.isin("I", "my", "me", "myself")))
    first = F.when(own > 0, F.least(F.lit(1.0), own / 10)).otherwise(F.lit(0.3))
    loud = F.least(F.lit(1.0), F.regexp_count(x, F.lit(r"!|—|\.{3}")) / 5)
    return found * 0.4 + phrases * 0.3 + first * 0.15 + loud * 0.15


def paragraph_quality(x: Column | str) -> Column:
    """A37."""
    return vocabulary_richness(x) * 0.3 + syntax_complexity(x) * 0.35 + style_markers(x) * 0.35


def length_band(n: Column) -> Column:
    """X62; none of the bands, so 0 too, is VERY_LONG."""
    return F.when(n.between(1, 4), "FRAGMENT").when(n.between(5, 10), "SHORT").when(n.between(11, 20), "MEDIUM").when(n.between(21, 35), "LONG").otherwise("VERY_LONG")


def rhythm(x: Column | str) -> Column:
    """A struct of sentence count, bands, variance, mean length, punctuation a word and fragment share."""
    dense = F.regexp_count(_c(x), F.lit("[,;:—–-]")) / F.greatest(word_count(x), F.lit(1))

    def of(n: Column) -> Column:
        some = F.size(n) > 0
        return F.struct(
            F.size(n).alias("sentence_count"),
            F.transform(n, length_band).alias("length_sequence"),
            F.when(some, let(deviation(n), lambda d: d * d)).otherwise(F.lit(0.0)).alias("length_variance"),
            F.when(some, mean(n)).otherwise(F.lit(0.0)).alias("avg_length"),
            dense.alias("punctuation_density"),
            F.when(some, F.size(F.filter(n, lambda k: k.between(1, 4))) / F.size(n)).otherwise(F.lit(0.0)).alias("fragment_ratio"),
        )

    return let(sentence_lengths(x), of)


def rhythm_string(bands: Column) -> Column:
    """The first six bands."""
    return F.array_join(F.slice(bands, 1, 6), " → ")


def rhythm_instruction(r: Column) -> Column:
    """A rhythm in words."""
    return F.concat_ws(
        ". ",
        F.concat(F.lit("Rhythm: "), rhythm_string(r["length_sequence"])),
        F.when(r["length_variance"] > 64, "Vary sentence lengths dramatically").when(r["length_variance"] > 25, "Vary sentence lengths"),
        F.when(r["fragment_ratio"] > 0.1, "Use occasional fragments"),
        F.when(r["punctuation_density"] > 0.3, "Use rich punctuation"),
    )


def move(x: Column) -> Column:
    """The first of six rules that a sentence meets, or Observation."""
    low = F.lower(x)
    out = None
    for name, kind, keys in L.MOVES:
        if kind == "contains":
            ok = any_of(low, keys)
        elif kind == "starts":
            ok = F.exists(F.array(*[F.lit(k) for k in keys]), lambda k: low.startswith(k))
        else:
            ok = F.arrays_overlap(F.slice(words(low), 1, 3), F.array(*[F.lit(k) for k in keys]))
        out = F.when(ok, name) if out is None else out.when(ok, name)
    return out.otherwise("Observation")


def skeleton(x: Column | str) -> Column:
    """X35."""
    parts = F.transform(sentences(x), lambda s: F.concat(F.lit("["), move(s), F.lit("]")))
    return F.when(F.size(parts) > 0, F.array_join(parts, " -> ")).otherwise("[Observation]")


def perspective(x: Column | str) -> Column:
    """The most frequent of three kinds of pronouns; ties are third person."""
    count = lambda w, words_: F.size(F.filter(w, lambda s: s.isin(*words_)))

    def pick(k: Column) -> Column:
        return F.when((k["a"] > k["b"]) & (k["a"] > k["c"]), "first_person_singular").when((k["b"] > k["a"]) & (k["b"] > k["c"]), "first_person_plural").otherwise("third_person")

    counts = let(word_tokens(x), lambda w: F.struct(count(w, L.FIRST_SINGULAR).alias("a"), count(w, L.FIRST_PLURAL).alias("b"), count(w, L.THIRD).alias("c")))
    return let(counts, pick)


def content_type(x: Column | str, narrative_default: bool = True, entities: Column | None = None, past: Column | None = None, present: Column | None = None) -> Column:
    """NARRATIVE or CONCEPTUAL by score, with a margin; counts of a tagger may be given."""
    low = F.lower(_c(x))
    own = F.array_distinct(F.transform(words(low), lambda w: F.btrim(w, F.lit(".,!?;:\"'-"))))
    count = lambda keys: F.size(F.array_intersect(own, F.array(*[F.lit(k) for k in keys])))
    zero = F.lit(0)
    e, p, q = entities if entities is not None else zero, past if past is not None else zero, present if present is not None else zero
    narrative = F.when(e >= 2, 3).when(e >= 1, 1).otherwise(0) + F.least(count(L.TEMPORAL_WORDS), F.lit(3)) + F.when(p >= 5, 2).when(p >= 2, 1).otherwise(0) + F.least(count(L.SEQUENCE_WORDS), F.lit(2))
    concept = F.least(count(L.CONCEPT_WORDS) * 2, F.lit(4)) + F.when(any_of(low, L.DEFINITION_PHRASES), 3).otherwise(0)
    concept += F.exists(F.array(*[F.lit(k) for k in L.IMPERSONAL_OPENINGS]), lambda k: low.startswith(k)).cast("int") + F.least(q, F.lit(2))
    tie = "NARRATIVE" if narrative_default else "CONCEPTUAL"
    return F.when(narrative > concept + 1, "NARRATIVE").when(concept > narrative + 1, "CONCEPTUAL").otherwise(tie)


def heading(x: Column | str) -> Column:
    """X26."""
    line = strip(x)
    letters = F.regexp_replace(line, r"[^\p{L}]", "")
    upper = F.length(F.regexp_replace(letters, r"[^\p{Lu}]", ""))
    edge = ".,;:!?\"'()-—?"
    small = lambda s: F.lower(s).isin(*L.TITLE_SMALL_WORDS) | (s.rlike(r"^[^\p{Ll}]*\p{Lu}[^\p{Ll}]*$") & (F.length(s) <= 4))

    def title(w: Column) -> Column:
        rest = F.filter(F.transform(F.slice(w, F.lit(2), F.greatest(F.size(w), F.lit(1))), lambda s: F.btrim(s, F.lit(edge))), lambda s: (s != "") & ~small(s))
        caps = lambda r: F.size(F.filter(r, lambda s: s.rlike(r"^\p{Lu}")))
        many = let(F.struct(F.size(rest).alias("n"), caps(rest).alias("c")), lambda k: ((k["n"] >= 2) & (k["c"] >= k["n"] * 0.5)) | ((F.size(w) <= 6) & (k["c"] >= 1) & ((k["n"] <= 1) | (k["c"] == k["n"]))))
        return F.when((F.size(w) == 1) & F.btrim(w[0], F.lit(edge)).rlike(r"^\p{Lu}"), True).otherwise((F.size(w) >= 2) & many)

    return (
        F.when(line == "", False).when(line.startswith("#"), True).when((F.length(letters) > 0) & (upper > F.length(letters) * 0.8), True).when(line.rlike(r"[.!]$"), False)
        .otherwise(let(words(line), title))
    )


def output_statistics(x: Column | str) -> Column:
    """Words, sentences, mean, deviation, least and most sentence length, machine transitions, dashes, semicolons."""
    low = F.lower(_c(x))
    return let(sentence_lengths(x), lambda n: _statistics(_c(x), low, n, F.size(n) > 0))


def _statistics(x: Column, low: Column, n: Column, some: Column) -> Column:
    return F.struct(
        word_count(x).alias("words"), F.size(n).alias("sentences"), F.when(some, mean(n)).otherwise(F.lit(0.0)).alias("avg"), F.when(some, deviation(n)).otherwise(F.lit(0.0)).alias("std"),
        F.coalesce(F.array_min(n), F.lit(0)).alias("shortest"), F.coalesce(F.array_max(n), F.lit(0)).alias("longest"), hits(low, L.MACHINE_TRANSITIONS).alias("transitions"),
        F.regexp_count(_c(x), F.lit("—|--")).alias("dashes"), F.regexp_count(_c(x), F.lit(";")).alias("semicolons"),
    )


def style_metrics(x: Column | str) -> Column:
    """The lexical five of seven metrics; depth and adjective ratio need a tagger and are 0 without one."""
    return let(F.struct(sentence_lengths(x).alias("n"), words(x).alias("w")), lambda s: _metrics(_c(x), s["n"], s["w"]))


def _metrics(x: Column, n: Column, w: Column) -> Column:
    some, zero = (F.size(n) > 0) & (F.size(w) > 0), F.lit(0.0)
    return F.struct(
        F.when(some, mean(n)).otherwise(zero).alias("avg_sentence_length"), F.when(some, deviation(n)).otherwise(zero).alias("sentence_length_std"), zero.alias("avg_dependency_depth"),
        zero.alias("adj_verb_ratio"), F.when(some, F.regexp_count(_c(x), F.lit("[^\\w\\s]")) * 100 / F.size(w)).otherwise(zero).alias("punctuation_density"),
        F.when(some, mean(F.transform(w, F.length))).otherwise(zero).alias("avg_word_length"), F.when(some, F.size(F.array_distinct(words(F.lower(_c(x))))) / F.size(w)).otherwise(zero).alias("variety"),
    )


def structural_distance(a: Column, b: Column, weights: dict[str, float]) -> Column:
    """Weighted sum of |a - b| / max(|a|, |b|, 1)."""
    return sum((F.abs(a[k] - b[k]) / F.greatest(F.abs(a[k]), F.abs(b[k]), F.lit(1.0)) * w for k, w in weights.items()), F.lit(0.0))


def narrative(x: Column | str) -> Column:
    """X103."""
    return content_type(x) == "NARRATIVE"
