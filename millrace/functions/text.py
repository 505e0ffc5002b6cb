"""Text functions on columns. White space means space, tab, newline, return, form feed and vertical tab (ASCII)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = " \t\n\r\f\u000b"
SENTENCE_BREAK = r"(?<=[.!?])\s+"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(x: Column, f) -> Column:
    """f(x) with x computed once a row, however often f names it: a lambda's variable holds its value."""
    return F.transform(F.array(x), f)[0]


def strip(x: Column | str) -> Column:
    """Without white space at both ends."""
    return F.btrim(_c(x), F.lit(BLANKS))


def words(x: Column | str) -> Column:
    """Runs of non-space characters; none for null or empty text."""
    return F.regexp_extract_all(F.coalesce(_c(x), F.lit("")), F.lit(r"\S+"), F.lit(0))


def word_count(x: Column | str) -> Column:
    """X2, X104."""
    return F.regexp_count(F.coalesce(_c(x), F.lit("")), F.lit(r"\S+"))


def word_tokens(x: Column | str) -> Column:
    """Runs of letters, digits and underscores of any script, in lower case: what stands between word boundaries."""
    return F.regexp_extract_all(F.lower(_c(x)), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))


def lower_words(x: Column | str) -> Column:
    return words(F.lower(_c(x)))


def non_blank(parts: Column) -> Column:
    return F.filter(F.transform(parts, strip), lambda s: s != "")


def paragraphs(x: Column | str) -> Column:
    """Split at blank lines; a text that has none but has newlines is split at these."""
    parts = non_blank(F.split(_c(x), "\n\n"))
    return F.when((F.size(parts) == 1) & F.contains(_c(x), F.lit("\n")), non_blank(F.split(_c(x), "\n"))).otherwise(parts)


def corpus_paragraphs(x: Column | str) -> Column:
    """Normalised line ends, split at blank lines, inner white space squeezed."""
    unix = F.regexp_replace(_c(x), "\r\n?", "\n")
    return F.filter(F.transform(F.split(unix, r"\n\s*\n"), squeeze), lambda s: s != "")


def squeeze(x: Column | str) -> Column:
    """White space runs to one space, trimmed."""
    return F.trim(F.regexp_replace(_c(x), r"\s+", " "))


def sentences(x: Column | str) -> Column:
    """X5, X6 and the default of X8 and X105: split at white space after . ! or ?"""
    return non_blank(F.split(_c(x), SENTENCE_BREAK))


def sentence_lengths(x: Column | str) -> Column:
    return F.transform(sentences(x), word_count)


def clean_text(x: Column | str) -> Column:
    """Line ends, blank runs, tabs, curly quotes and dashes."""
    t = F.regexp_replace(_c(x), "\r\n", "\n")
    t = F.regexp_replace(F.regexp_replace(t, r"\n{3,}", "\n\n"), r"[ \t]+", " ")
    return strip(F.translate(t, "‘’“”—–", "''\"\"--"))


def clean_book_text(x: Column | str) -> Column:
    """X9 without chapter, page and number lines, and with ellipses as dots."""
    t = _c(x)
    for line in (r"Chapter \d+.*", r"\d+", r"Page \d+.*"):
        t = F.regexp_replace(t, f"(?m)^{line}$", "")
    return F.replace(clean_text(t), F.lit("…"), F.lit("..."))


def clean_neutral(x: Column | str) -> Column:
    """Without leading punctuation and double spaces."""
    return strip(F.regexp_replace(F.regexp_replace(_c(x), r"^[\s.,;:!?\-–—]+", ""), "  +", " "))


def run_counts(ordered: Column) -> Column:
    """array<struct<n, w>> of a sorted array: each distinct element with how often it stands, negative, so that sorting puts the most frequent first.

    A run's length is the distance between the places where elements change, so nothing grows element by element.
    """
    starts = lambda w: F.filter(F.sequence(F.lit(1), F.size(w)), lambda i: (i == 1) | (w[i - 1] != w[i - 2]))

    def of(w: Column) -> Column:
        ends = lambda at: F.concat(F.slice(at, F.lit(2), F.size(at)), F.array(F.size(w) + 1))
        return let(starts(w), lambda at: F.zip_with(at, ends(at), lambda a, b: F.struct((a - b).alias("n"), w[a - 1].alias("w"))))

    return let(ordered, lambda w: F.when(F.size(w) > 0, of(w)).otherwise(F.expr("cast(array() as array<struct<n:int,w:string>>)")))


def token_estimate(x: Column | str) -> Column:
    """int(words * 1.3)."""
    return F.floor(word_count(x) * F.lit(1.3)).cast("int")


def words_of_tokens(tokens: Column | str) -> Column:
    """int(tokens / 1.3)."""
    return F.floor(_c(tokens) / F.lit(1.3)).cast("int")


def citations(x: Column | str) -> Column:
    """The [^n] markers."""
    return F.regexp_extract_all(_c(x), F.lit(r"\[\^\d+\]"), F.lit(0))


def without_citations(x: Column | str) -> Column:
    """X29."""
    return F.regexp_replace(_c(x), r"\[\^\d+\]", "")


def without_references(x: Column | str) -> Column:
    """Without [^n] and [n,m-k] markers, spaces squeezed."""
    return F.trim(F.regexp_replace(F.regexp_replace(_c(x), r"\[\^\d+\]|\[\d+(?:[,\-–]\s*\d+)*\]", ""), " {2,}", " "))


def bracket_moves(x: Column | str) -> Column:
    """What stands in square brackets."""
    return F.regexp_extract_all(_c(x), F.lit(r"\[([^\]]+)\]"), F.lit(1))


def truncated(x: Column | str, limit: int, mark: str = "...") -> Column:
    """X55."""
    return F.when(F.length(_c(x)) > limit, F.concat(F.substring(_c(x), 1, limit), F.lit(mark))).otherwise(_c(x))


def head_and_tail(x: Column | str, most: int = 300, head: int = 50) -> Column:
    """Over `most` lines, the first `head` and the last most-head, with a mark between."""
    lines = F.split(_c(x), "\n")
    n = F.size(lines)
    parts = F.concat(F.slice(lines, 1, head), F.array(F.concat(F.lit("... ("), (n - most).cast("string"), F.lit(" lines omitted) ..."))), F.slice(lines, n - (most - head) + 1, F.lit(most - head)))
    return F.when(n > most, F.array_join(parts, "\n")).otherwise(_c(x))


def first_line(x: Column | str) -> Column:
    return strip(F.split_part(strip(x), F.lit("\n"), F.lit(1)))


def changelog_stripped(x: Column | str) -> Column:
    """`* path: text` to text, if the head looks like a path."""
    entry = r"^\*?\s*([\w./\-]+)\s*:\s*(.*)$"
    head, rest = F.regexp_extract(_c(x), entry, 1), strip(F.regexp_extract(_c(x), entry, 2))
    return F.when((head != "") & head.rlike(r"/|\.(clj|cljs|cljc|cljx|edn)$"), rest).otherwise(_c(x))


def clean_instruction(x: Column | str) -> Column:
    """X13 on each ;-segment, empty ones dropped."""
    return F.array_join(non_blank(F.transform(non_blank(F.split(_c(x), ";")), changelog_stripped)), "; ")


def commit_prefix(x: Column | str) -> Column:
    """`[tag]`, or a known `tag:`; lower case, null where there is none."""
    from millrace.functions.lexicons import COMMIT_PREFIXES

    m = strip(x)
    bracket = F.lower(F.regexp_extract(m, r"^(\[[^\]]+\])", 1))
    tag = F.lower(F.regexp_extract(m, r"^([^:]{1,10}):", 1))
    return F.when(bracket != "", bracket).when(tag.isin(*COMMIT_PREFIXES) | tag.startswith("squash"), tag)


def slug_title(x: Column | str) -> Column:
    """X60."""
    return F.initcap(F.replace(_c(x), F.lit("-"), F.lit(" ")))


def slug(*names: Column | str) -> Column:
    """The first non-blank of the columns, lower case with dashes."""
    first = F.coalesce(*[F.when(strip(n) != "", strip(n)) for n in names])
    return F.regexp_replace(F.lower(first), r"[\s_]+", "-")


def file_tree(files: Column | str) -> Column:
    """A map of path to content as markdown sections, in order of path."""
    entry = lambda e: F.concat(F.lit("### "), e["key"], F.lit("\n```clojure\n"), e["value"], F.lit("\n```"))
    return F.array_join(F.transform(F.array_sort(F.map_entries(_c(files))), entry), "\n\n")


def template(text: Column | str, values: dict[str, Column]) -> Column:
    """{name} replaced by its column."""
    out = _c(text)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), value.cast("string"))
    return out


def matched_case(replacement: Column | str, original: Column | str) -> Column:
    """Upper, capitalised or lower like the original."""
    r, o = _c(replacement), _c(original)
    cap = F.concat(F.upper(F.substring(r, 1, 1)), F.substring(r, 2, 1 << 30))
    return F.when((F.upper(o) == o) & (F.length(o) > 1), F.upper(r)).when(F.substring(o, 1, 1).rlike("[A-Z]"), cap).otherwise(r)


def capitalised(x: Column | str) -> Column:
    """The first letter in upper case."""
    at = F.regexp_instr(_c(x), F.lit("[A-Za-z]"))
    return F.when(at > 0, F.overlay(_c(x), F.upper(F.substring(_c(x), at, F.lit(1))), at, F.lit(1))).otherwise(_c(x))


def complete_sentences(x: Column | str) -> Column:
    """Only the sentences that end in . ! or ? (with closing quotes); the text itself if there is none."""
    done = F.filter(sentences(x), lambda s: s.rlike(r"[.!?][\"'”’)]*$"))
    return F.when(F.size(done) > 0, F.array_join(done, " ")).otherwise(_c(x))


def tidy_punctuation(x: Column | str) -> Column:
    """Repeated and misplaced punctuation."""
    t = _c(x)
    for pattern, new in ((r"\s+([.,;:!?])", "$1"), (r",{2,}", ","), (r";{2,}", ";"), (r"\.{4,}", "..."), (r"([!?])\1+", "$1"), (r",\s*\.", "."), (r"\(\s*\)", ""), (r"[ \t]{2,}", " ")):
        t = F.regexp_replace(t, pattern, new)
    return strip(t)


def simplified_punctuation(x: Column | str, dashes: int = 1) -> Column:
    """Semicolons to full stops, and dashes beyond the first `dashes` to commas."""
    parts = F.split(_c(x), r"\s*—\s*")
    joined = F.when(
        F.size(parts) > dashes + 1,
        F.concat(F.array_join(F.slice(parts, 1, dashes + 1), "—"), F.lit(", "), F.array_join(F.slice(parts, F.lit(dashes + 2), F.size(parts) - dashes - 1), ", ")),
    ).otherwise(_c(x))
    return F.regexp_replace(joined, r";\s+([a-z])", ". $1")


def restored(text: Column | str, entities: Column | str) -> Column:
    """Placeholders of a map back to what they stand for."""
    return F.aggregate(F.map_entries(_c(entities)), _c(text), lambda t, e: F.replace(t, e["key"], e["value"]))


def stem(x: Column | str) -> Column:
    """The longest listed suffix off, if four letters or more stay."""
    from millrace.functions.lexicons import ENTITY_SUFFIXES

    return F.regexp_replace(_c(x), "(?<=.{4})(" + "|".join(ENTITY_SUFFIXES) + ")$", "")


def same_stem(a: Column, b: Column) -> Column:
    """Equal, or one starts with the other's five letters or more and is at most two longer."""
    short, long_ = F.when(F.length(a) <= F.length(b), a).otherwise(b), F.when(F.length(a) <= F.length(b), b).otherwise(a)
    return (a == b) | ((F.length(short) >= 5) & long_.startswith(short) & (F.length(long_) - F.length(short) <= 2))


def strip_html_topics(x: Column | str) -> Column:
    """Poem wrappers, footnotes, markdown headers and rules out."""
    t = F.regexp_replace(_c(x), r"(?s)<div class=\"poem\">|</div>", "")
    for pattern in (r"\[\^\d+\]:?", r"(?m)^#+\s.*$", r"(?m)^-{3,}$"):
        t = F.regexp_replace(t, pattern, "")
    return t


#: Ends of words that end no sentence (fixed values).
ABBREVIATIONS = "Mr. Mrs. Ms. Dr. Prof. Sr. Jr. St. vs. etc. viz. al. eg. ie. cf. No. Vol. Ch. Fig. Eq. approx. dept. est.".split()


def guarded_sentences(x: Column | str, least: int = 3) -> Column:
    """Split before a capital or quote, joined again after abbreviations; sentences of fewer than `least` words go."""
    known = "|".join(a[:-1] + r"\." for a in ABBREVIATIONS)
    cut = F.regexp_replace(squeeze(x), r"(?<=[.!?]) (?=[A-Z\"])", "\x01")
    whole = F.regexp_replace(cut, rf"(?<=^|[ \x01])({known})\x01", "$1 ")
    return F.filter(F.split(whole, "\x01"), lambda s: word_count(s) >= least)


def distribution(tags: Column | str) -> Column:
    """A map of each tag of an array to its count."""
    return let(_c(tags), lambda t: F.map_from_entries(F.transform(run_counts(F.sort_array(t)), lambda c: F.struct(c["w"], -c["n"]))))
