"""Queries on texts and sentences: cleaning, splitting, fragments, stems, profiles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions import fragments, lexicons as L, scores, text
from millrace.operators import joins, profile, records, sessions
from millrace.plans import sql as S
from millrace.plans.records import _LINES, _PARA, as_records, query

#: Punctuation that is stripped from words in profiles, as a SQL string.
_BARE = S.q(profile.PUNCTUATION)


def _md5(c: Column) -> Column:
    return F.md5(c.cast("binary"))


def _bare_words(x: str) -> str:
    return f"list_transform({S.words(x)}, lambda w: trim(lower(w), {_BARE}))"


_BOOK = rf"""regexp_replace(regexp_replace(regexp_replace(text, '(?m)^Chapter \d+.*$', '', 'g'), '(?m)^\d+$', '', 'g'), '(?m)^Page \d+.*$', '', 'g')"""
_CLEANED = r"""replace(trim(translate(regexp_replace(regexp_replace(replace({x}, chr(13) || chr(10), chr(10)), '\n{{3,}}', chr(10) || chr(10), 'g'), '[ \t]+', ' ', 'g'), '‘’“”—–', '''''""--'), {ws}), '…', '...')"""


@query(f"SELECT doc_id, md5({_CLEANED.format(x=_BOOK, ws=S.WS)}) AS cleaned FROM documents")
def clean_book(t):
    """X10."""
    return t("documents").select("doc_id", _md5(text.clean_book_text("text")).alias("cleaned"))


@query(
    r"""SELECT doc_id, md5(trim(regexp_replace(regexp_replace(text, '\[\^\d+\]|\[\d+(?:[,\-–]\s*\d+)*\]', '', 'g'), ' {2,}', ' ', 'g'), ' ')) AS stripped,
array_to_string(regexp_extract_all(text, '\[([^\]]+)\]', 1), '|') AS moves FROM documents"""
)
def brackets(t):
    """X32, X33."""
    return t("documents").select("doc_id", _md5(text.without_references("text")).alias("stripped"), F.array_join(text.bracket_moves("text"), "|").alias("moves"))


@query(
    r"""SELECT doc_id, CASE WHEN length(text) > 120 THEN substr(text, 1, 120) || '...' ELSE text END AS cut,
CASE WHEN len(l) > 8 THEN array_to_string(list_concat(list_concat(l[1:3], ['... (' || (len(l) - 8) || ' lines omitted) ...']), l[len(l) - 4:]), chr(10)) ELSE text END AS ends
FROM (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents)"""
)
def shortened(t):
    """X55, S14."""
    return t("documents").select("doc_id", text.truncated("text", 120).alias("cut"), text.head_and_tail("text", 8, 3).alias("ends"))


_TIDY = "text"
for _a, _b in ((r"\s+([.,;:!?])", r"\1"), (",{2,}", ","), (";{2,}", ";"), (r"\.{4,}", "..."), ("!{2,}", "!"), (r"\?{2,}", "?"), (r",\s*\.", "."), (r"\(\s*\)", ""), (r"[ \t]{2,}", " ")):
    _TIDY = f"regexp_replace({_TIDY}, {S.q(_a)}, {S.q(_b)}, 'g')"


@query(f"SELECT doc_id, md5({S.strip(_TIDY)}) AS tidy FROM documents")
def tidy_punctuation(t):
    """X39."""
    return t("documents").select("doc_id", _md5(text.tidy_punctuation("text")).alias("tidy"))


_DONE = rf"list_filter({S.sents('text')}, lambda s: regexp_matches(s, '[.!?][\"''”’)]*$'))"


@query(f"SELECT doc_id, md5(CASE WHEN len({_DONE}) > 0 THEN array_to_string({_DONE}, ' ') ELSE text END) AS whole FROM documents")
def complete_sentences(t):
    """X38, X40."""
    return t("documents").select("doc_id", _md5(text.complete_sentences("text")).alias("whole"))


@query(
    """SELECT doc_id, CASE WHEN regexp_matches(text, '[A-Za-z]') THEN regexp_extract(text, '(?s)^([^A-Za-z]*)', 1) || upper(regexp_extract(text, '([A-Za-z])', 1)) || substr(text, length(regexp_extract(text, '(?s)^([^A-Za-z]*)', 1)) + 2) ELSE text END AS out
FROM documents"""
)
def capitalised(t):
    """X96."""
    return t("documents").select("doc_id", text.capitalised("text").alias("out"))


_KNOWN = "|".join(a[:-1] + r"\." for a in text.ABBREVIATIONS)
_CUT = r"""regexp_replace(trim(regexp_replace(text, '\s+', ' ', 'g'), ' '), '([.!?]) ([A-Z"])', '\1' || chr(1) || '\2', 'g')"""
for _ in range(3):  # abbreviations may follow each other
    _CUT = rf"""regexp_replace({_CUT}, '(^|[ \x01])({_KNOWN})\x01', '\1\2 ', 'g')"""


@query(f"""WITH s AS (SELECT doc_id, list_filter(string_split({_CUT}, chr(1)), lambda s: {S.wc('s')} >= 3) AS s FROM documents) SELECT doc_id, unnest(s) AS sentence, generate_subscripts(s, 1) - 1 AS position FROM s""")
def guarded_sentences(t):
    """X7."""
    d = t("documents")
    # An abbreviation in each text, before a capital.
    return d.select("doc_id", F.posexplode(text.guarded_sentences("text")).alias("position", "sentence"))


@query("SELECT conv_id, turn, len(s) AS sentences, md5(array_to_string(s, '|')) AS parts FROM (SELECT conv_id, turn, " + S.sents("'He met Dr. Bell. ' || text") + " AS s FROM conversations)")
def plain_sentences(t):
    """X6, X8, X105: the default of a model's sentences."""
    s = text.sentences(F.concat(F.lit("He met Dr. Bell. "), "text"))
    return t("conversations").select("conv_id", "turn", F.size(s).alias("sentences"), _md5(F.array_join(s, "|")).alias("parts"))


_LAST = rf"trim(lower({S.words('s')}[-1]), '.,;:!?\"''()')"
_WHY = rf"""CASE WHEN s = '' THEN NULL WHEN regexp_matches(s, '[—-]$') THEN 'ends with dash' WHEN {S.in_list(_LAST, fragments.OPEN_ENDS)} THEN 'ends with function word'
 WHEN NOT regexp_matches(s, '[.!?;:"''”’]$') AND {S.wc('s')} > 3 THEN 'no ending punctuation' END"""
_SENTS = f"s AS (SELECT doc_id, unnest({S.sents('text')}) AS s FROM documents)"


@query(f"WITH {_SENTS} SELECT doc_id, {_WHY} AS why, count(*) AS n, md5(string_agg(s, '|' ORDER BY s)) AS sentences FROM s GROUP BY 1, 2")
def incomplete_sentences(t):
    """X66, X67, X68."""
    s = t("documents").select("doc_id", F.explode(text.sentences("text")).alias("s"))
    out = s.groupBy("doc_id", fragments.incomplete("s").alias("why")).agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("s")).alias("s"))
    return out.select("doc_id", "why", "n", _md5(F.array_join("s", "|")).alias("sentences"))


_CLAUSES = f"len(list_filter(list_transform({S.words('lower(s)')}, lambda w: trim(w, '.,;:!?\"''()')), lambda w: {S.in_list('w', fragments.SUBORDINATORS)}))"


@query(f"WITH {_SENTS} SELECT CASE WHEN {S.wc('s')} <= 4 THEN 'fragment' WHEN {_CLAUSES} = 0 THEN 'main' WHEN {_CLAUSES} = 1 THEN 'main + subordinate' ELSE 'complex' END AS structure, count(*) AS n FROM s GROUP BY 1")
def clause_structures(t):
    """X63, X85."""
    s = t("documents").select(F.explode(text.sentences("text")).alias("s"))
    return s.groupBy(fragments.clause_structure("s").alias("structure")).agg(F.count(F.lit(1)).alias("n"))


_MODIFIERS = ("the", "of", "and", "des", "der")


@query(
    f"""SELECT doc_id, md5(array_to_string(list_filter({S.words('text')}, lambda w: NOT {S.in_list("trim(lower(w), '.,;:!?')", _MODIFIERS)}), ' ')) AS bare,
md5(array_to_string(list_transform({S.words('text')}, lambda w: CASE WHEN {S.in_list("trim(lower(w), '.,;:!?\"''')", _MODIFIERS)} THEN '[THING]' || regexp_extract(w, '([.,;:!?"'']*)$', 1) ELSE w END), ' ')) AS things FROM documents"""
)
def listed_words(t):
    """X53, F37, X54."""
    return t("documents").select("doc_id", _md5(fragments.without_modifiers("text", _MODIFIERS)).alias("bare"), _md5(fragments.nouns_as_things("text", _MODIFIERS)).alias("things"))


_STEM = rf"regexp_replace(w, '^(.{{4,}}?)({'|'.join(L.ENTITY_SUFFIXES)})$', '\1')"
_CONTENT = rf"list_filter(list_transform({S.words('lower(text)')}, lambda w: trim(w, '.,!?;:''\"()-—')), lambda w: regexp_full_match(w, '\p{{L}}{{4,}}') AND NOT {S.in_list('w', L.STOP_WORDS)})"
#: The first of each, in order.
_FIRSTS = f"(SELECT list(w ORDER BY i) FROM (SELECT w, min(i) AS i FROM (SELECT unnest({_CONTENT}) AS w, generate_subscripts({_CONTENT}, 1) AS i) GROUP BY w))"


@query(f"SELECT doc_id, array_to_string(list_sort(list_distinct(list_transform({_CONTENT}, lambda w: {_STEM}))), ' ') AS stems, coalesce(array_to_string(({_FIRSTS})[1:10], ' '), '') AS keywords FROM documents")
def stems_and_keywords(t):
    """X64, X98, F36, O8."""
    return t("documents").select("doc_id", F.array_join(records.text_stems("text"), " ").alias("stems"), F.array_join(records.keywords("text"), " ").alias("keywords"))


@query(
    f"""WITH w AS (SELECT doc_id, unnest({_CONTENT}) AS w, generate_subscripts({_CONTENT}, 1) AS i FROM documents), p AS (SELECT doc_id, w AS a, lead(w) OVER (PARTITION BY doc_id ORDER BY i) AS b FROM w)
SELECT doc_id, count(*) FILTER (WHERE a = b OR (least(length(a), length(b)) >= 5 AND abs(length(a) - length(b)) <= 2 AND (starts_with(a, b) OR starts_with(b, a)))) AS n FROM p WHERE b IS NOT NULL GROUP BY 1"""
)
def same_stems(t):
    """Neighbouring content words of one stem."""
    w = records.content_words("text")
    pairs = t("documents").select("doc_id", text.let(w, lambda x: F.arrays_zip(F.slice(x, F.lit(1), F.greatest(F.size(x) - 1, F.lit(0))).alias("a"), F.slice(x, 2, F.size(x)).alias("b"))).alias("p"))
    return pairs.filter(F.size("p") > 0).select("doc_id", F.size(F.filter("p", lambda x: text.same_stem(x["a"], x["b"]))).alias("n"))


@query(
    """SELECT p_partkey, list_aggregate(list_transform(string_split(replace(lower(p_type), ' ', '-'), '-'), lambda w: upper(w[1]) || w[2:]), 'string_agg', ' ') AS title,
replace(replace(lower(trim(p_type)), ' ', '-'), '_', '-') AS slug, CASE WHEN upper(p_brand) = p_brand AND length(p_brand) > 1 THEN 'ALPHA' WHEN regexp_matches(p_brand[1], '[A-Z]') THEN 'Alpha' ELSE 'alpha' END AS cased FROM part"""
)
def names(t):
    """X45, X60, X61."""
    slug = text.slug(F.lit(" "), "p_type", "p_name")
    return t("part").select("p_partkey", text.slug_title(F.lower(text.slug("p_type"))).alias("title"), slug.alias("slug"), text.matched_case(F.lit("alpha"), "p_brand").alias("cased"))


@query(
    rf"""WITH {S.RECORDS}, p AS (SELECT doc_id, list_filter(list_transform(string_split('* src/a.clj: ' || instruction || ' ; plain: kept;; lib/x: y', ';'), lambda s: {S.strip('s')}), lambda s: s <> '') AS p FROM records)
SELECT doc_id, array_to_string(list_filter(list_transform(p, lambda s: CASE WHEN regexp_matches(regexp_extract(s, '^\*?\s*([\w./\-]+)\s*:\s*(.*)$', 1), '/|\.(clj|cljs|cljc|cljx|edn)$')
 THEN {S.strip(r"regexp_extract(s, '^\*?\s*([\w./\-]+)\s*:\s*(.*)$', 2)")} ELSE s END), lambda s: {S.strip('s')} <> ''), '; ') AS cleaned FROM p"""
)
def clean_instructions(t):
    """X13, X14."""
    r = as_records(t("documents"))
    return r.select("doc_id", text.clean_instruction(F.concat(F.lit("* src/a.clj: "), "instruction", F.lit(" ; plain: kept;; lib/x: y"))).alias("cleaned"))


@query(
    """SELECT doc_id, 'The task of src: ' || source || ' in ' || lang || ', ' || doc_id || ' {other}' AS filled, '/data/' || lang || '/x//' || source AS path,
'### a.clj' || chr(10) || '```clojure' || chr(10) || lang || chr(10) || '```' || chr(10) || chr(10) || '### b.clj' || chr(10) || '```clojure' || chr(10) || source || chr(10) || '```' AS tree FROM documents"""
)
def templates(t):
    """X56, X74, Y17."""
    from millrace.operators.taxonomy import environment

    filled = text.template(F.lit("The task of src: {source} in {lang}, {id} {other}"), {"source": F.col("source"), "lang": F.col("lang"), "id": F.col("doc_id")})
    path = environment(F.concat(F.lit("${ROOT}/"), "lang", F.lit("/${NAME}/${NONE}/"), "source"), {"ROOT": "/data", "NAME": "x"})
    tree = text.file_tree(F.create_map(F.lit("b.clj"), "source", F.lit("a.clj"), "lang"))
    return t("documents").select("doc_id", filled.alias("filled"), path.alias("path"), tree.alias("tree"))


_HYPHEN = r"regexp_replace(text, '([a-z])-\n([a-z])', '\1\2', 'g')"
_ROMAN = r"(regexp_matches(upper({s}), '^(X{{0,3}}(IX|IV|V?I{{0,3}})|XL(IX|IV|V?I{{0,3}})|L)\.?$') AND {s} <> '')"


@query(
    rf"""WITH l AS (SELECT doc_id, list_transform(string_split({_HYPHEN}, chr(10)), lambda s: ltrim(s, ' ')) AS l FROM documents)
SELECT doc_id, md5({S.strip(rf"regexp_replace(array_to_string(list_filter(l, lambda s: NOT regexp_matches({S.strip('s')}, '^[0-9]{{1,4}}$') AND NOT {_ROMAN.format(s=S.strip('s'))}), chr(10)), '\n{{3,}}', chr(10) || chr(10), 'g')")}) AS cleaned FROM l"""
)
def clean_lines(t):
    """X11, W14, F27, F28."""
    return records.clean_lines(t("documents"), "doc_id", "text").select("doc_id", _md5(F.col("text")).alias("cleaned"))


@query(
    f"""WITH p AS (SELECT doc_id, CASE WHEN len({_PARA}) = 1 AND contains(text, chr(10)) THEN {_LINES} ELSE {_PARA} END AS p FROM documents),
q AS (SELECT doc_id, unnest(p) AS p, generate_subscripts(p, 1) - 1 AS paragraph FROM p), s AS (SELECT doc_id, paragraph, unnest({S.sents('p')}) AS sentence, generate_subscripts({S.sents('p')}, 1) - 1 AS position FROM q)
SELECT * FROM s WHERE {S.wc('sentence')} BETWEEN 8 AND 60"""
)
def sentence_index(t):
    """J23."""
    return joins.sentence_index(t("documents"), "doc_id", "text")


_N = f"list_transform({S.sents('text')}, lambda s: {S.wc('s')})"


@query(
    rf"""SELECT doc_id, {S.wc('text')} AS words, len({_N}) AS sentences, round(coalesce({S.mean(_N)}, 0), 6) AS avg, round(coalesce({S.deviation(_N)}, 0), 6) AS std, coalesce(list_min({_N}), 0) AS shortest, coalesce(list_max({_N}), 0) AS longest,
{S.hits('lower(text)', L.MACHINE_TRANSITIONS)} AS transitions, len(regexp_extract_all(text, '—|--')) AS dashes, len(regexp_extract_all(text, ';')) AS semicolons FROM documents"""
)
def output_statistics(t):
    """A38."""
    d = t("documents").select("doc_id", scores.output_statistics("text").alias("s")).select("doc_id", "s.*")
    return d.withColumns({c: F.round(c, 6) for c in ("avg", "std")})


@query(
    rf"""SELECT conv_id, turn, round({S.mean(_N)}, 9) AS avg_sentence_length, round({S.deviation(_N)}, 9) AS sentence_length_std, round(len(regexp_extract_all(text, '[^\w\s]')) * 100 / {S.wc('text')}, 9) AS punctuation_density,
round({S.mean(f"list_transform({S.words('text')}, lambda w: length(w))")}, 9) AS avg_word_length, round(len(list_distinct({S.words('lower(text)')})) / {S.wc('text')}, 9) AS variety FROM conversations WHERE {S.wc('text')} > 0"""
)
def style_batch(t):
    """A18 of every turn."""
    d = t("conversations").filter(text.word_count("text") > 0).select("conv_id", "turn", scores.style_metrics("text").alias("m")).select("conv_id", "turn", "m.*").drop("avg_dependency_depth", "adj_verb_ratio")
    return d.select("conv_id", "turn", *[F.round(c, 9).alias(c) for c in d.columns[2:]])


@query(
    rf"""WITH {_SENTS} SELECT round(avg((regexp_matches(lower(s), '^(never|seldom|rarely|nor|neither|here|there|so|such|not only|in|on|from|beneath|beyond|above)([^\p{{L}}\p{{N}}_]|$)'))::INT), 9) AS inverted,
round(avg((contains(s, ',') AND length(s) - length(regexp_extract(s, '([^,]*)$', 1)) > length(s) * 0.4::DOUBLE)::INT), 9) AS periodic, round(avg(contains(s, '—')::INT), 9) AS dashes FROM s"""
)
def sentence_complexity(t):
    """A26, by list."""
    return profile.complexity(t("documents"), "text").select(*[F.round(c, 9).alias(c) for c in ("inverted", "periodic", "dashes")])


_CATEGORIES = {"physical": ["the", "stone", "water"], "mental": ["of", "mind", "thought"], "social": ["and", "people", "law"]}


@query(
    "SELECT doc_id, CASE WHEN greatest(a, b, c) = 0 THEN 'physical' WHEN a = greatest(a, b, c) THEN 'physical' WHEN b = greatest(a, b, c) THEN 'mental' ELSE 'social' END AS category FROM (SELECT doc_id, "
    + ", ".join(f"len(list_intersect(list_distinct({_bare_words('text')}), {S.array(ws)})) AS {k}" for k, ws in zip("abc", _CATEGORIES.values(), strict=True))
    + " FROM documents)"
)
def noun_categories(t):
    """A33, X99, by list."""
    return t("documents").select("doc_id", profile.noun_category(F.col("text"), _CATEGORIES).alias("category"))


_BAND = "CASE WHEN n BETWEEN 1 AND 4 THEN 'FRAGMENT' WHEN n BETWEEN 5 AND 10 THEN 'SHORT' WHEN n BETWEEN 11 AND 20 THEN 'MEDIUM' WHEN n BETWEEN 21 AND 35 THEN 'LONG' ELSE 'VERY_LONG' END"


@query(f"WITH b AS (SELECT doc_id, {_BAND} AS band, count(*) AS c FROM (SELECT doc_id, unnest({_N}) AS n FROM documents) GROUP BY 1, 2) SELECT doc_id, string_agg(band || ':' || c, ',' ORDER BY band) AS tags FROM b GROUP BY 1")
def tag_distribution(t):
    """Of sentence bands, as tags."""
    d = t("documents").select("doc_id", text.distribution(F.transform(text.sentence_lengths("text"), scores.length_band)).alias("m")).filter(F.size("m") > 0)
    return d.select("doc_id", F.array_join(F.transform(F.array_sort(F.map_entries("m")), lambda e: F.concat(e["key"], F.lit(":"), e["value"])), ",").alias("tags"))


@query(
    rf"""WITH r AS (SELECT {_N} AS n, len(regexp_extract_all(text, '[,;:—–-]')) / greatest({S.wc('text')}, 1) AS dense FROM documents WHERE len({_N}) >= 2),
a AS (SELECT avg({S.mean('n')}) AS avg, avg({S.deviation('n')} ** 2) AS variance, avg(len(list_filter(n, lambda k: k BETWEEN 1 AND 4)) / len(n)) AS fragments, avg((dense > 0.3)::INT) AS dense FROM r)
SELECT round(avg, 6) AS avg, round(variance, 6) AS variance, greatest(3, floor(avg - sqrt(variance)))::BIGINT AS min_words, ceil(avg + sqrt(variance))::BIGINT AS max_words,
CASE WHEN fragments > 0.2 THEN 'frequent' WHEN fragments > 0.1 THEN 'occasional' ELSE 'rare' END AS fragment_hint, dense > 0.3 AS dash_hint FROM a"""
)
def length_and_fragment_hints(t):
    """A49, A50, A51."""
    g = profile.length_guidance(t("documents"), "text")
    return g.select(F.round("avg", 6).alias("avg"), F.round("variance", 6).alias("variance"), F.col("min_words").cast("long").alias("min_words"), F.col("max_words").cast("long").alias("max_words"), "fragment_hint", "dash_hint")


@query("SELECT source AS author, count(*) AS chunks, count(*) FILTER (WHERE lang <> 'en') / count(*) AS filled, row_number() OVER (ORDER BY source) - 1 AS place FROM documents GROUP BY 1")
def author_listing(t):
    """Authors in order with their counts, and the share with a value."""
    from millrace.operators.ranks import global_rank

    d = t("documents").select(F.col("source").alias("author"), F.when(F.col("lang") != "en", F.col("lang")).alias("value"))
    return global_rank(profile.corpus_counts(d, "author", "value"), ["author"], "place")


@query("SELECT doc_id, text FROM documents WHERE doc_id % 2 = 1")
def alternate_rows(t):
    """W15."""
    return sessions.alternate(t("documents").select("doc_id", "text"), "doc_id", even=False)


@query("SELECT event_id, epoch(date_trunc('second', ts))::BIGINT AS at FROM events")
def parsed_timestamps(t):
    """Four formats and ISO."""
    e = t("events").withColumn("s", F.date_trunc("second", "ts"))
    shapes = ["yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd HH:mm:ss XX", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"]
    written = F.element_at(F.array(*[F.date_format("s", f) for f in shapes]), (F.col("event_id") % 5 + 1).cast("int"))
    return e.select("event_id", F.unix_seconds(sessions.parse_timestamp(written)).alias("at"))
