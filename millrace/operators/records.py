"""Training records: shaping, formatting and filtering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import lexicons as L
from millrace.functions.scores import any_of, style_tag
from millrace.functions.text import _c, first_line, strip, word_count, words
from millrace.operators.ranks import hash_order


def as_string(x: Column) -> Column:
    """Null to empty."""
    return F.coalesce(x.cast("string"), F.lit(""))


def format_records(df: DataFrame, default_prompt: str = "") -> DataFrame:
    """The five fields, a blank system to the default prompt; other columns go."""
    get = lambda c: as_string(F.col(c)) if c in df.columns else F.lit("")
    history = F.coalesce(F.col("history"), F.array().cast("array<array<string>>")) if "history" in df.columns else F.array().cast("array<array<string>>")
    system = F.when(strip(get("system")) == "", F.lit(default_prompt)).otherwise(get("system"))
    return df.select(get("instruction").alias("instruction"), get("input").alias("input"), get("output").alias("output"), system.alias("system"), history.alias("history"))


def tag_source(df: DataFrame, source: str) -> DataFrame:
    """P3."""
    own = F.coalesce(F.col("source"), F.lit(source)) if "source" in df.columns else F.lit(source)
    return df.withColumn("source", own)


def to_record(df: DataFrame, instruction: Column, output: Column, input_: Column | None = None, source: str | None = None) -> DataFrame:
    """A mined or generated row as a record."""
    return df.select(instruction.alias("instruction"), (input_ if input_ is not None else F.lit("")).alias("input"), output.alias("output"), F.lit(source).alias("source"))


def phased_record(df: DataFrame, neutral: str, styled: str, author: str, templates: Sequence[str], seed: int = 42) -> DataFrame:
    """{text, prompt, word_count, variation_type}; the template is picked by hash."""
    pick = F.element_at(F.array(*[F.lit(t) for t in templates]), (F.pmod(F.conv(F.substring(hash_order(styled, seed), 1, 8), 16, 10).cast("long"), F.lit(len(templates))) + 1).cast("int"))
    prompt = F.concat_ws("\n", F.replace(pick, F.lit("{author}"), F.lit(author)), style_tag(styled), F.col(neutral))
    return df.withColumn("prompt", prompt).withColumn("text", F.concat_ws("\n\n", "prompt", F.col(styled))).withColumn("word_count", word_count(styled))


def normalised_layouts(df: DataFrame) -> DataFrame:
    """`messages` (array of role, content; the last of each role), prompt and completion, or ### text, as one text; unusable rows go."""
    cols = set(df.columns)
    forms = []
    if "messages" in cols:
        last = lambda role: F.try_element_at(F.filter("messages", lambda m: m["role"] == role), F.lit(-1))["content"]
        forms.append(F.when(last("user").isNotNull() & last("assistant").isNotNull(), F.concat_ws("\n\n", last("user"), last("assistant"))))
    if {"prompt", "completion"} <= cols:
        forms.append(F.when(F.col("prompt").isNotNull() & F.col("completion").isNotNull(), F.concat_ws("\n\n", "prompt", "completion")))
    if "text" in cols:
        user, answer = F.regexp_extract("text", r"(?s)###\s*(?:Instruction|Human|User):?\s*(.*?)\s*###", 1), F.regexp_extract("text", r"(?s)###\s*(?:Response|Assistant):?\s*(.*)$", 1)
        tagged = F.regexp_extract("text", r"(?s)<\|?assistant\|?>\s*(.*?)(?:<\||$)", 1), F.regexp_extract("text", r"(?s)<\|?user\|?>\s*(.*?)<\|", 1)
        forms += [F.when((user != "") & (answer != ""), F.concat_ws("\n\n", user, answer)), F.when((tagged[0] != "") & (tagged[1] != ""), F.concat_ws("\n\n", tagged[1], tagged[0]))]
    return df.withColumn("normalised", F.coalesce(*forms)).filter("normalised is not null")


def assign_prompts(df: DataFrame, key: str, pools: dict[str, Sequence[str]], source: str = "source", default: str = "git", seed: int = 42) -> DataFrame:
    """A system prompt of the source's pool, by hash of the key."""
    place = lambda n: (F.pmod(F.conv(F.substring(hash_order(key, seed), 1, 8), 16, 10).cast("long"), F.lit(n)) + 1).cast("int")
    pick = lambda pool: F.element_at(F.array(*[F.lit(p) for p in pool]), place(len(pool)))
    out = None
    for name, pool in pools.items():
        if name != default:
            out = F.when(F.col(source) == name, pick(pool)) if out is None else out.when(F.col(source) == name, pick(pool))
    return df.withColumn("system", out.otherwise(pick(pools[default])) if out is not None else pick(pools[default]))


def task_text(task: Column | str, files: Column | str, plan: Column | str | None = None) -> Column:
    """Markdown sections, each only when it has something."""
    listed = F.when(F.size(_c(files)) > 0, F.concat(F.lit("## Relevant files\n"), F.array_join(F.transform(_c(files), lambda f: F.concat(F.lit("- "), f)), "\n")))
    steps = None if plan is None else F.when(F.size(_c(plan)) > 0, F.concat(F.lit("## Plan\n"), F.array_join(_c(plan), "\n")))
    return F.concat_ws("\n\n", F.concat(F.lit("## Task\n"), _c(task)), listed, *([steps] if steps is not None else []))


def batch_text(files: Column | str) -> Column:
    """An array of (path, content) as markdown."""
    return F.array_join(F.transform(_c(files), lambda f: F.concat(F.lit("### "), f["path"], F.lit("\n"), f["content"])), "\n\n")


def chunk_id(author: Column | str, source: Column | str, index: Column | str) -> Column:
    """P17."""
    return F.substring(F.md5(F.concat_ws(":", _c(author), _c(source), _c(index)).cast("binary")), 1, 16)


def constraints(key: Column, always: Sequence[str], often: Sequence[str], rare: Sequence[str], seed: int = 42) -> Column:
    """All of the first tier, each of the second with 70 %, one of the third with 40 %, by hash."""
    u = lambda salt: F.conv(F.substring(hash_order(F.concat_ws(":", key.cast("string"), F.lit(salt)), seed), 1, 8), 16, 10).cast("double") / float(16**8)
    second = [F.when(u(f"often{i}") < 0.7, F.lit(t)) for i, t in enumerate(often)]
    third = F.when(u("rare") < 0.4, F.element_at(F.array(*[F.lit(t) for t in rare]), (F.floor(u("which") * len(rare)) + 1).cast("int"))) if rare else F.lit(None).cast("string")
    return F.array_join(F.array_compact(F.array(*[F.lit(t) for t in always], *second, third)), "\n")


def record_chars(df: DataFrame) -> Column:
    """length of the three fields, a missing one 0."""
    return sum((F.length(as_string(F.col(c))) for c in ("instruction", "input", "output") if c in df.columns), F.lit(0))


def within_length(df: DataFrame, most: int | None = None) -> DataFrame:
    """F1."""
    return df if most is None else df.filter(record_chars(df) <= most)


def changed_lines(diff: Column | str) -> Column:
    """Added and removed lines, headers left out."""
    lines = F.split(F.coalesce(_c(diff), F.lit("")), "\n")
    return F.size(F.filter(lines, lambda s: (s.startswith("+") & ~s.startswith("+++")) | (s.startswith("-") & ~s.startswith("---"))))


def without_trivial_diffs(df: DataFrame, least: int = 4, output: str = "output") -> DataFrame:
    """synthetic rows and rows that hold no diff are exempt; 0 or less keeps all."""
    if least <= 0:
        return df
    exempt = F.col("source").eqNullSafe(F.lit("synthetic")) | ~F.contains(as_string(F.col(output)), F.lit("diff --git"))
    return df.filter(exempt | (changed_lines(output) >= least))


def is_code_file(path: Column) -> Column:
    """F5."""
    named = F.lit(False)
    for n in L.NON_CODE_FILES:
        named = named | path.endswith(n) | path.startswith(n)
    for p in L.NON_CODE_PREFIXES:
        named = named | path.startswith(p)
    return ~named & _ends(path, L.CODE_EXTENSIONS)


def _ends(path: Column, extensions: Sequence[str]) -> Column:
    out = F.lit(False)
    for e in extensions:
        out = out | path.endswith(e)
    return out


def is_test_file(path: Column) -> Column:
    """F25."""
    return F.contains(path, F.lit("test/")) | path.rlike(r"_test\.clj[cs]?$")


def is_source_file(path: Column) -> Column:
    """F34."""
    return _ends(path, L.SOURCE_EXTENSIONS) & ~is_test_file(path)


def meaningful(message: Column | str) -> Column:
    """F6."""
    m = strip(message)
    return (word_count(m) >= 3) & (F.length(m) >= 10)


def code_commits(df: DataFrame) -> DataFrame:
    """no merges, some code file, a message that says something."""
    return df.filter(~F.col("is_merge") & F.exists("files", is_code_file) & meaningful("message"))


def substantive(instruction: Column | str) -> Column:
    """F8."""
    line = first_line(F.coalesce(_c(instruction), F.lit("")))
    return (word_count(line) >= 3) & (F.length(line) >= 12) & ~line.rlike(L.TRIVIAL_MESSAGE)


def ratio_filter(df: DataFrame, input_: str, output: str, most: float = 2.0, least_words: int = 15) -> tuple[DataFrame, DataFrame]:
    """The kept rows, and the removed ones, the worst ratio first."""
    own = df.withColumn("ratio", word_count(output) / F.greatest(word_count(input_), F.lit(1)))
    ok = (F.col("ratio") <= most) & (word_count(input_) >= least_words)
    return own.filter(ok), own.filter(~ok).orderBy(F.desc("ratio"))


def balanced_lengths(neutral: Column | str, styled: Column | str) -> Column:
    """styled words from half to three times neutral's."""
    return word_count(styled).between(word_count(neutral) * 0.5, word_count(neutral) * 3)


def valid_trace(solution: Column | str) -> Column:
    """F18."""
    s = _c(solution)
    return any_of(s, [";; eval:", ";; repl", ";; session"]) & F.contains(s, F.lit(";; eval:")) & any_of(s, [";; apply:", "diff --git"]) & any_of(s, ["diff --git", "@@"])


def prose_paragraph(x: Column | str, least: int = 40) -> Column:
    """enough words, no heading, few quotes."""
    from millrace.functions.scores import heading

    return (word_count(x) >= least) & ~heading(x) & (F.regexp_count(_c(x), F.lit("[\"“”]")) <= F.length(_c(x)) * 0.05)


def diverse_paragraph(x: Column | str, least: int = 80, most: int = 600) -> Column:
    """F24."""
    from millrace.functions.scores import special_ratio

    head = _c(x).rlike(r"^(Chapter|Part|Section|[IVXLC]+\.?\s*$|[A-Z][A-Z\s]+$)")
    return word_count(x).between(least, most) & ~head & (special_ratio(x, "a-zA-Z0-9\\s.,;:!?'\"()\\-—") <= 0.05)


def exemplar_score(x: Column | str) -> Column:
    """of 10 to 40 words: dashes, semicolons, feeling words and a spread of lengths."""
    from millrace.functions.scores import hits

    n = word_count(x)
    score = F.contains(_c(x), F.lit("—")).cast("int") + F.contains(_c(x), F.lit(";")).cast("int") + hits(F.lower(_c(x)), L.EMOTIONS) * 2 + (F.abs(n - 20) > 8).cast("int")
    return F.when(n.between(10, 40), score).otherwise(0)


def is_page_number(line: Column | str) -> Column:
    """F27."""
    return strip(line).rlike(r"^\d{1,4}$")


def is_roman(line: Column | str) -> Column:
    """I to L, in either case."""
    return F.upper(strip(line)).rlike(r"^(X{0,3}(IX|IV|V?I{0,3})|XL(IX|IV|V?I{0,3})|L)\.?$") & (strip(line) != "")


def clean_lines(df: DataFrame, doc: str, text: str, headers: Sequence[str] = ()) -> DataFrame:
    """Page and roman numbers go, and second and later known header lines; blanks squeezed; a narrow projection."""
    known = F.array(*[F.lit(h) for h in headers]).cast("array<string>")
    start = F.struct(F.array().cast("array<string>").alias("seen"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, line: Column) -> Column:
        s = F.ltrim(line)
        head = F.array_contains(known, F.trim(s))
        drop = is_page_number(s) | is_roman(s) | (head & F.array_contains(acc["seen"], F.trim(s)))
        return F.struct(
            F.when(head, F.array_append(acc["seen"], F.trim(s))).otherwise(acc["seen"]).alias("seen"), F.when(drop, acc["out"]).otherwise(F.array_append(acc["out"], s)).alias("out")
        )

    joined = F.regexp_replace(F.col(text), r"([a-z])-\n([a-z])", "$1$2")  # W14
    lines = F.aggregate(F.split(joined, "\n"), start, step, lambda acc: acc["out"])
    return df.select(doc, strip(F.regexp_replace(F.array_join(lines, "\n"), r"\n{3,}", "\n\n")).alias(text))


def allowed_findings(df: DataFrame, rules: DataFrame, rule: str = "rule_id") -> DataFrame:
    """F32: findings whose rule isn't on the deny list."""
    return df.join(rules, rule, "left_anti")


def safe_replacement(new: Column, length: Column) -> Column:
    """F33."""
    return (F.length(new) > 0) & (F.length(new) <= F.greatest(length * 3, F.lit(30)))


def corrected(text: Column, edits: Column) -> Column:
    """Edits (start, length, new) applied from the right."""
    return F.aggregate(F.reverse(F.array_sort(edits)), text, lambda t, e: F.overlay(t, e["new"], e["start"] + 1, e["length"]))


def content_words(x: Column | str) -> Column:
    """F36, and the stand-in for a tagger: lower-case words of four letters or more that aren't stop words."""
    w = F.transform(words(F.lower(_c(x))), lambda s: F.btrim(s, F.lit(".,!?;:'\"()-—")))
    return F.filter(w, lambda s: s.rlike(r"^\p{L}{4,}$") & ~s.isin(*L.STOP_WORDS))


def keywords(x: Column | str, n: int = 10) -> Column:
    """The first n distinct content words in order."""
    return F.slice(F.array_distinct(content_words(x)), 1, n)


def of_difficulty(df: DataFrame, wanted: Sequence[str], difficulty: str = "difficulty") -> DataFrame:
    """F19."""
    return df.filter(F.col(difficulty).isin(*wanted))


def text_stems(x: Column | str) -> Column:
    """The distinct stems of content words, which stand in for nouns and adjectives."""
    from millrace.functions.text import stem

    return F.array_sort(F.array_distinct(F.transform(content_words(x), stem)))
