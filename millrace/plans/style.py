"""Queries on the style of documents and on conversations and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import lexicons as L
from millrace.functions import scores, text
from millrace.operators import chunking, joins, models, profile, records, sampling
from millrace.plans import sql as S
from millrace.plans.records import query

_N = f"list_transform({S.sents('text')}, lambda s: {S.wc('s')})"
_WITH_N = f"WITH d AS (SELECT doc_id, lang, text, lower(text) AS low, {_N} AS n FROM documents)"
_TOKENS = r"regexp_extract_all(low, '[\p{L}\p{N}_]+')"


def _in(x: str, keys) -> str:
    return f"len(list_filter({x}, lambda w: {S.in_list('w', keys)}))"


@query(
    _WITH_N
    + f""" SELECT doc_id, CASE WHEN len(n) = 0 THEN '[STYLE: Medium Length | Simple Syntax]' ELSE '[STYLE: ' || CASE WHEN {S.mean('n')} < 12 THEN 'Short & Punchy' WHEN {S.mean('n')} > 25 THEN 'Long & Flowing'
 WHEN {S.deviation('n')} > 8 THEN 'Varied Lengths' ELSE 'Medium Length' END || ' | ' || CASE WHEN {S.any_of('text', L.COMPLEX_MARKS)} AND {S.any_of('low', L.CONNECTIVES)} THEN 'Baroque Syntax'
 WHEN {S.any_of('text', L.COMPLEX_MARKS)} THEN 'Complex Syntax' ELSE 'Simple Syntax' END || ']' END AS tag FROM d"""
)
def style_tag(t):
    """X36."""
    return t("documents").select("doc_id", scores.style_tag("text").alias("tag"))


@query(_WITH_N + f" SELECT doc_id, CASE WHEN len(n) >= 2 THEN {S.deviation('n')} / {S.mean('n')} ELSE 0 END AS burstiness FROM d")
def burstiness(t):
    """A15."""
    return t("documents").select("doc_id", scores.burstiness("text").alias("burstiness"))


@query(
    rf"""WITH d AS (SELECT doc_id, list_filter(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+'), lambda w: regexp_full_match(w, '[a-z]+')) AS w FROM documents)
SELECT doc_id, CASE WHEN len(w) < 10 THEN 0 ELSE least(1.0, len(list_distinct(w)) / len(w) * 0.6::DOUBLE + len(list_filter(list_distinct(w), lambda s: length(s) > 8 AND NOT {S.in_list('s', L.RICHNESS_STOP_WORDS)})) / greatest(len(list_distinct(w)), 1) * 0.4::DOUBLE + 0.2::DOUBLE) END AS richness FROM d"""
)
def vocab_richness(t):
    """A34."""
    return t("documents").select("doc_id", scores.vocabulary_richness("text").alias("richness"))


@query(
    rf"""WITH d AS (SELECT doc_id, text, lower(text) AS low, list_transform(list_filter(string_split_regex(text, '[.!?]+'), lambda s: {S.strip('s')} <> ''), lambda s: {S.wc('s')}) AS n FROM documents)
SELECT doc_id, CASE WHEN len(n) = 0 THEN 0 ELSE (CASE WHEN len(n) < 2 THEN 0.3::DOUBLE ELSE least(1.0, {S.deviation('n')} / 20) END) * 0.3::DOUBLE + least(1.0, len(regexp_extract_all(text, '[;:—–()]')) / 10) * 0.3::DOUBLE
 + least(1.0, {_in(_TOKENS, L.CLAUSE_MARKERS)} / 5) * 0.4::DOUBLE END AS complexity FROM d"""
)
def syntax_complexity(t):
    """A35."""
    return t("documents").select("doc_id", scores.syntax_complexity("text").alias("complexity"))


_OWN = r"len(list_filter(regexp_extract_all(text, '[\p{L}\p{N}_]+'), lambda w: w IN ('I', 'my', 'me', 'myself')))"


@query(
    rf"""WITH d AS (SELECT doc_id, text, lower(text) AS low FROM documents) SELECT doc_id, least(1.0, {S.hits('low', L.DARK_WORDS)} / 5) * 0.4::DOUBLE
 + least(1.0, ({' + '.join(f"regexp_matches(low, {S.q(p)})::INT" for p in L.DARK_PATTERNS)}) / 3) * 0.3::DOUBLE + (CASE WHEN {_OWN} > 0 THEN least(1.0, {_OWN} / 10) ELSE 0.3::DOUBLE END) * 0.15::DOUBLE
 + least(1.0, len(regexp_extract_all(text, '!|—|\.{{3}}')) / 5) * 0.15::DOUBLE AS markers FROM d"""
)
def style_markers(t):
    """A36."""
    return t("documents").select("doc_id", scores.style_markers("text").alias("markers"))


_BAND = "CASE WHEN x BETWEEN 1 AND 4 THEN 'FRAGMENT' WHEN x BETWEEN 5 AND 10 THEN 'SHORT' WHEN x BETWEEN 11 AND 20 THEN 'MEDIUM' WHEN x BETWEEN 21 AND 35 THEN 'LONG' ELSE 'VERY_LONG' END"


@query(_WITH_N + f", b AS (SELECT unnest(n) AS x FROM d) SELECT {_BAND} AS band, count(*) AS n FROM b GROUP BY 1")
def length_bands(t):
    """X62."""
    return profile.band_counts(t("documents"), "text")


@query(
    _WITH_N
    + f""" SELECT doc_id, len(n) AS sentence_count, array_to_string(list_transform(n[1:6], lambda x: {_BAND}), ' → ') AS rhythm, CASE WHEN len(n) > 0 THEN round({S.deviation('n')} * {S.deviation('n')}, 6) ELSE 0 END AS variance,
 CASE WHEN len(n) > 0 THEN {S.mean('n')} ELSE 0 END AS avg_length, len(regexp_extract_all(text, '[,;:—–-]')) / greatest({S.wc('text')}, 1) AS punctuation, CASE WHEN len(n) > 0 THEN len(list_filter(n, lambda x: x BETWEEN 1 AND 4)) / len(n) ELSE 0 END AS fragments FROM d"""
)
def rhythm_sequence(t):
    """A20, X87."""
    d = t("documents").select("doc_id", scores.rhythm("text").alias("r"))
    return d.select(
        "doc_id", F.col("r.sentence_count"), scores.rhythm_string(F.col("r.length_sequence")).alias("rhythm"), F.round("r.length_variance", 6).alias("variance"), "r.avg_length",
        F.col("r.punctuation_density").alias("punctuation"), F.col("r.fragment_ratio").alias("fragments"),
    )


@query(
    rf"""WITH d AS (SELECT doc_id, {_in(r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')", L.FIRST_SINGULAR)} AS a, {_in(r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')", L.FIRST_PLURAL)} AS b,
 {_in(r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')", L.THIRD)} AS c FROM documents)
SELECT doc_id, CASE WHEN a > b AND a > c THEN 'first_person_singular' WHEN b > a AND b > c THEN 'first_person_plural' ELSE 'third_person' END AS perspective FROM d"""
)
def perspective(t):
    """X27."""
    return t("documents").select("doc_id", scores.perspective("text").alias("perspective"))


def _move_sql(s: str) -> str:
    low = f"lower({s})"
    whens = []
    for name, kind, keys in L.MOVES:
        if kind == "contains":
            cond = S.any_of(low, keys)
        elif kind == "starts":
            cond = "(" + " OR ".join(f"starts_with({low}, {S.q(k)})" for k in keys) + ")"
        else:
            cond = f"list_has_any({S.words(low)}[1:3], {S.array(keys)})"
        whens.append(f"WHEN {cond} THEN '{name}'")
    return f"CASE {' '.join(whens)} ELSE 'Observation' END"


@query(f"WITH s AS (SELECT doc_id, unnest({S.sents('text')}) AS s FROM documents) SELECT {_move_sql('s')} AS move, count(*) AS n FROM s GROUP BY 1")
def rhetorical_moves(t):
    """X34."""
    s = t("documents").select(F.explode(text.sentences("text")).alias("s"))
    return s.groupBy(scores.move(F.col("s")).alias("move")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH d AS (SELECT doc_id, {S.sents('text')} AS s FROM documents) SELECT doc_id, md5(CASE WHEN len(s) = 0 THEN '[Observation]' ELSE array_to_string(list_transform(s, lambda x: '[' || {_move_sql('x')} || ']'), ' -> ') END) AS skeleton FROM d")
def skeletons(t):
    """X35."""
    return t("documents").select("doc_id", F.md5(scores.skeleton("text").cast("binary")).alias("skeleton"))


_EDGE = "'.,;:!?\"''()-—?'"
_BARE = f"list_filter(list_transform({S.words('l')}[2:], lambda s: trim(s, {_EDGE})), lambda s: s <> '' AND NOT {S.in_list('lower(s)', L.TITLE_SMALL_WORDS)} AND NOT (regexp_full_match(s, '[^\\p{{Ll}}]*\\p{{Lu}}[^\\p{{Ll}}]*') AND length(s) <= 4))".replace("{{", "{").replace("}}", "}")


@query(
    rf"""WITH l AS (SELECT doc_id, i, {S.strip('l')} AS l FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents)),
k AS (SELECT *, {_BARE} AS bare, regexp_replace(l, '[^\p{{L}}]', '', 'g') AS letters, {S.wc('l')} AS n FROM l),
c AS (SELECT *, len(list_filter(bare, lambda s: regexp_matches(s, '^\p{{Lu}}'))) AS caps FROM k)
SELECT doc_id, i AS line FROM c WHERE CASE WHEN l = '' THEN false WHEN starts_with(l, '#') THEN true
 WHEN length(letters) > 0 AND length(regexp_replace(letters, '[^\p{{Lu}}]', '', 'g')) > length(letters) * 0.8 THEN true WHEN regexp_matches(l, '[.!]$') THEN false
 WHEN n = 1 AND regexp_matches(trim({S.words('l')}[1], {_EDGE}), '^\p{{Lu}}') THEN true
 ELSE n >= 2 AND ((len(bare) >= 2 AND caps >= len(bare) * 0.5) OR (n <= 6 AND caps >= 1 AND (len(bare) <= 1 OR caps = len(bare)))) END"""
)
def heading_lines(t):
    """X26."""
    lines = t("documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "l"))
    return lines.filter(scores.heading("l")).select("doc_id", "line")


_METRICS = rf"""m AS (SELECT doc_id, lang, CASE WHEN len(n) > 0 THEN {S.mean('n')} ELSE 0 END AS a, CASE WHEN len(n) > 0 THEN {S.deviation('n')} ELSE 0 END AS b,
 CASE WHEN len(n) > 0 THEN len(regexp_extract_all(text, '[^a-zA-Z0-9_\s]')) * 100 / {S.wc('text')} ELSE 0 END AS p, CASE WHEN len(n) > 0 THEN {S.mean(f"list_transform({S.words('text')}, lambda w: length(w))")} ELSE 0 END AS w FROM d)"""


@query(
    _WITH_N
    + ", "
    + _METRICS
    + """, c AS (SELECT lang, avg(a) AS ca, avg(b) AS cb, avg(p) AS cp, avg(w) AS cw FROM m GROUP BY 1)
SELECT doc_id, 0.4::DOUBLE * abs(a - ca) / greatest(abs(a), abs(ca), 1) + 0.2::DOUBLE * abs(b - cb) / greatest(abs(b), abs(cb), 1) + 0.2::DOUBLE * abs(p - cp) / greatest(abs(p), abs(cp), 1) + 0.2::DOUBLE * abs(w - cw) / greatest(abs(w), abs(cw), 1) AS distance
FROM m JOIN c USING (lang)"""
)
def style_distance_to_lang_mean(t):
    """The lexical metrics against their means by language."""
    m = t("documents").select("doc_id", "lang", scores.style_metrics("text").alias("m"))
    keys = {"avg_sentence_length": 0.4, "sentence_length_std": 0.2, "punctuation_density": 0.2, "avg_word_length": 0.2}
    center = m.groupBy("lang").agg(F.struct(*[F.avg(f"m.{k}").alias(k) for k in keys]).alias("c"))
    return m.join(F.broadcast(center), "lang").select("doc_id", scores.structural_distance(F.col("m"), F.col("c"), keys).alias("distance"))


_TRIM = "'.,!?;:''\"()-—“”'"
_FIRST = f"f AS (SELECT doc_id, trim(lower({S.words('s')}[1]), {_TRIM}) AS word, s FROM (SELECT doc_id, unnest({S.sents('text')}) AS s FROM documents))"
_KIND = "CASE " + " ".join(f"WHEN {S.in_list('word', ws)} THEN '{k}'" for k, ws in L.TRANSITIONS.items()) + " END"


@query(f"WITH {_FIRST}, c AS (SELECT {_KIND} AS class, word, count(*) AS n FROM f GROUP BY 1, 2) SELECT class, word, n, row_number() OVER (PARTITION BY class ORDER BY n DESC, word) AS rank FROM c WHERE class IS NOT NULL QUALIFY rank <= 5")
def transition_inventory(t):
    """A23."""
    return profile.transitions(t("documents"), "text")


@query(f"WITH {_FIRST} SELECT m AS word FROM (SELECT unnest({S.array(L.MACHINE_TRANSITIONS)}) AS m) WHERE NOT EXISTS (SELECT 1 FROM f WHERE starts_with(lower(s), m))")
def unused_transitions(t):
    """A23, second half."""
    return profile.unused_transitions(t("documents"), "text")


_LOWW = f"list_transform({S.words('text')}, lambda w: trim(lower(w), {_TRIM}))"


@query(
    f"""WITH d AS (SELECT lang, {S.sents('text')} AS s, {_LOWW} AS w FROM documents)
SELECT lang, sum(len(list_filter(s, lambda x: ends_with(x, '?')))) / count(*) AS question_freq, sum(len(list_filter(s, lambda x: contains(x, '!')))) / sum(len(s)) AS exclamation_freq,
 sum({_in('w', L.ADDRESS)}) / sum(len(s)) AS address_freq, sum(len(list_filter(s, lambda x: contains(x, '—') OR contains(x, '(')))) / sum(len(s)) AS parenthetical_freq,
 sum({_in('w', L.CERTAINTY)})::BIGINT AS certainty, sum({_in('w', L.HEDGES)})::BIGINT AS hedges FROM d GROUP BY 1"""
)
def stance_profile(t):
    """A24."""
    return profile.stance(t("documents"), "text", ["lang"])


@query(
    f"""WITH s AS (SELECT doc_id, {S.words('lower(s)')} AS w FROM (SELECT doc_id, unnest({S.sents('text')}) AS s FROM documents))
SELECT doc_id, array_to_string(w[1:2], ' ') AS starter, count(*) AS n FROM s WHERE len(w) >= 2 GROUP BY 1, 2 HAVING count(*) >= 2"""
)
def sentence_starters(t):
    """A29."""
    return profile.starters(t("documents"), "doc_id", "text")


_T = f"(SELECT lang, trim(lower(unnest({S.words('text')})), {_TRIM}) AS word FROM documents)"


@query(
    f"""WITH c AS (SELECT word, count(*) FILTER (WHERE lang = 'en') AS n_source, count(*) FILTER (WHERE lang = 'fr') AS n_reference FROM {_T} WHERE word <> '' GROUP BY 1)
SELECT word, n_source, n_reference, log2((n_source + 1) / (n_reference + 1)) AS score FROM c WHERE n_source >= 3 AND log2((n_source + 1) / (n_reference + 1)) > 0.5"""
)
def distinctive_words(t):
    """English against French."""
    d = t("documents")
    return profile.distinctive(d.filter("lang = 'en'"), d.filter("lang = 'fr'"), "text")


@query(f"WITH c AS (SELECT word, count(*) AS n FROM {_T} WHERE word <> '' GROUP BY 1 ORDER BY n DESC, word LIMIT 20) SELECT * FROM c WHERE n >= 3")
def overused_words(t):
    """A top-k report."""
    return profile.overused(t("documents"), "text", 20)


@query(
    f"""WITH s AS (SELECT list_transform({S.words('s')}, lambda w: trim(lower(w), {_TRIM})) AS w FROM (SELECT unnest({S.sents('text')}) AS s FROM documents)),
c AS (SELECT array_to_string(w[1:3], ' ') AS opening, count(*) AS n FROM s WHERE len(w) >= 3 GROUP BY 1) SELECT opening, n, n / (SELECT sum(n) FROM c) AS share FROM c ORDER BY n DESC, opening LIMIT 15"""
)
def opening_patterns(t):
    """A top-k report."""
    return profile.openings(t("documents"), "text")


_LISTS = {"certainty": L.CERTAINTY, "hedge": L.HEDGES, "archaic": L.ARCHAIC, "emotional": L.EMOTIONS, "sensory": L.SENSORY, "temporal": L.TEMPORAL_WORDS, "conceptual": L.CONCEPT_WORDS}


@query(
    f"""WITH w AS (SELECT unnest(list_transform({S.words('text')}, lambda w: trim(lower(w), {_TRIM}))) AS word FROM documents), c AS (SELECT CASE {' '.join(f"WHEN {S.in_list('word', ws)} THEN '{n}'" for n, ws in _LISTS.items())} END AS cluster, word FROM w WHERE word <> ''),
n AS (SELECT cluster, word, count(*) AS n FROM c WHERE cluster IS NOT NULL GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, word) AS rank FROM n) SELECT * FROM r WHERE rank <= 10"""
)
def vocabulary_clusters(t):
    """A22, A31, by list: a top-k report."""
    return profile.vocabulary_clusters(t("documents"), "text")


@query(
    f"""WITH l AS (SELECT avg(CASE WHEN len(n) > 0 THEN {S.mean('n')} END) AS a, avg(CASE WHEN len(n) > 0 THEN {S.deviation('n')} * {S.deviation('n')} END) AS v FROM (SELECT {_N} AS n FROM documents) WHERE len(n) >= 2)
SELECT a AS avg, v AS variance, greatest(3, floor(a - sqrt(v)))::BIGINT AS min_words, ceil(a + sqrt(v))::BIGINT AS max_words FROM l"""
)
def length_guidance(t):
    """A49."""
    g = profile.length_guidance(t("documents"), "text")
    return g.select("avg", "variance", F.col("min_words").cast("long"), F.col("max_words").cast("long"))


def _bleed() -> str:
    return f"list_filter(list_distinct({S.words('lower(b.text)')}), lambda w: NOT {S.in_list('w', L.COMMON_WORDS)})"


@query(
    f"""WITH b AS (SELECT item_id, {_bleed()} AS w FROM benchmark b), d AS (SELECT doc_id, list_distinct({S.words('lower(text)')}) AS w FROM documents),
x AS (SELECT item_id, unnest(w) AS t FROM b), y AS (SELECT doc_id, unnest(w) AS t FROM d), c AS (SELECT item_id, doc_id, count(*) AS k FROM x JOIN y USING (t) GROUP BY 1, 2)
SELECT item_id, doc_id, k / len(w) AS overlap FROM c JOIN b USING (item_id) WHERE k / len(w) >= 0.5"""
)
def lexical_bleed(t):
    """benchmark items whose distinctive words a document has half of: an equi-join on words, counted."""
    common = F.array(*[F.lit(w) for w in L.COMMON_WORDS])
    b = t("benchmark").select("item_id", F.array_except(text.lower_words("text"), common).alias("w")).withColumn("n", F.size("w"))
    x = b.select("item_id", "n", F.explode("w").alias("t"))
    y = t("documents").select("doc_id", F.explode(F.array_distinct(text.lower_words("text"))).alias("t"))
    k = y.join(x, "t").groupBy("item_id", "n", "doc_id").agg(F.count(F.lit(1)).alias("k"))
    return k.select("item_id", "doc_id", (F.col("k") / F.col("n")).alias("overlap")).filter("overlap >= 0.5")


@query("SELECT item_id, count(*) AS n FROM benchmark b JOIN documents d ON contains(d.text, b.text) GROUP BY 1")
def contains_benchmark(t):
    """J4-like containment: documents by three words inside each passage, then by the passage itself."""
    return joins.containing(t("documents").select("text"), "text", t("benchmark"), "item_id", "text").groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT conv_id, arg_max(text, turn) FILTER (WHERE role = 'user') AS instruction, arg_max(text, turn) FILTER (WHERE role = 'assistant') AS output, coalesce(arg_min(text, turn) FILTER (WHERE role = 'system'), '') AS system
FROM conversations GROUP BY 1 HAVING count(*) FILTER (WHERE role = 'user') > 0 AND count(*) FILTER (WHERE role = 'assistant') > 0"""
)
def chat_to_record(t):
    """P9, J18."""
    return joins.chat_to_record(t("conversations"))


_CHAT = """chat AS (SELECT conv_id, arg_max(text, turn) FILTER (WHERE role = 'user') AS i, arg_max(text, turn) FILTER (WHERE role = 'assistant') AS o FROM conversations GROUP BY 1),
paired AS (SELECT * FROM chat WHERE i IS NOT NULL AND o IS NOT NULL)"""


@query(f"WITH {_CHAT} SELECT conv_id, {S.wc('o')} / greatest({S.wc('i')}, 1) AS ratio FROM paired WHERE {S.wc('o')} / greatest({S.wc('i')}, 1) <= 2.0 AND {S.wc('i')} >= 15")
def word_ratio_filter(t):
    """F14, S25."""
    return records.ratio_filter(joins.chat_to_record(t("conversations")), "instruction", "output")[0].select("conv_id", "ratio")


def _content(x: str) -> str:
    return rf"list_filter(list_transform({S.words(f'lower({x})')}, lambda s: trim(s, '.,!?;:''\"()-—')), lambda s: regexp_full_match(s, '\p{{L}}{{4,}}') AND NOT {S.in_list('s', L.STOP_WORDS)})"


@query(
    f"""WITH {_CHAT}, w AS (SELECT conv_id, list_distinct({_content('i')}) AS a, list_distinct({_content('o')}) AS b FROM paired)
SELECT conv_id, CASE WHEN len(a) > 0 THEN len(list_intersect(a, b)) / len(a) ELSE 1 END AS coverage, array_to_string(list_sort(list_filter(a, lambda x: NOT list_contains(b, x))), ' ') AS missing FROM w"""
)
def content_coverage(t):
    """J8, A47, U7."""
    c = joins.chat_to_record(t("conversations"))
    return c.select("conv_id", joins.content_coverage("instruction", "output").alias("coverage"), F.array_join(joins.missing_content("instruction", "output"), " ").alias("missing"))


@query(
    f"""WITH {_CHAT}, s AS (SELECT conv_id, si, {S.strip('sx')} AS src, list_distinct({_content('sx')}) AS a FROM (SELECT conv_id, unnest({S.sents('i')}) AS sx, generate_subscripts({S.sents('i')}, 1) - 1 AS si FROM paired)),
o AS (SELECT conv_id, oi, ox, list_distinct({_content('ox')}) AS b FROM (SELECT conv_id, unnest({S.sents('o')}) AS ox, generate_subscripts({S.sents('o')}, 1) - 1 AS oi FROM paired)),
p AS (SELECT o.conv_id, oi, ox, b, si, CASE WHEN len(list_intersect(a, b)) > 0 THEN 2.0::DOUBLE * len(list_intersect(a, b)) / (len(a) + len(b)) ELSE 0 END AS f FROM o LEFT JOIN s USING (conv_id))
SELECT conv_id, oi AS position, CASE WHEN {S.wc('any_value(ox)')} < 4 OR len(any_value(b)) = 0 THEN 1 ELSE coalesce(max(f), 0) END AS score,
 CASE WHEN {S.wc('any_value(ox)')} >= 4 AND len(any_value(b)) > 0 AND max(f) > 0 THEN arg_max(si, struct_pack(f := f, i := -si)) END AS match FROM p GROUP BY 1, 2"""
)
def best_sentence_match(t):
    """J7."""
    c = joins.chat_to_record(t("conversations")).select("conv_id", F.posexplode(joins.grounding("instruction", "output")).alias("position", "g"))
    return c.select("conv_id", "position", F.col("g.score"), F.col("g.match"))


@query()
def verification_scores(t):
    """J9, A46, A55, E51."""
    v = joins.chat_to_record(t("conversations")).select("conv_id", joins.verification("instruction", "output").alias("v"))
    return v.select("conv_id", "v.*", F.array_join(joins.issues(F.col("v")), "; ").alias("issues"))


@query(
    r"""SELECT page_id, md5(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<div class="poem">|</div>', '', 'g'), '\[\^\d+\]:?', '', 'g'), '(?m)^#+\s.*$', '', 'g'), '(?m)^-{3,}$', '', 'g')) AS stripped,
 len(regexp_extract_all(html, '\[\^\d+\]')) AS citations FROM pages"""
)
def strip_html_topics(t):
    """P12, X28."""
    return t("pages").select("page_id", F.md5(text.strip_html_topics("html").cast("binary")).alias("stripped"), F.size(text.citations("html")).alias("citations"))


@query()
def overlap_chunks(t):
    """W6."""
    return chunking.corpus_chunks(t("documents"), "doc_id", "text")


@query()
def greedy_pack(t):
    """W10."""
    return t("documents").select("doc_id", F.posexplode(chunking.index_chunks("text")).alias("chunk_index", "text"))


@query()
def short_variants(t):
    """W11, W12."""
    return chunking.with_short_variants(t("documents"), "doc_id", "text")


@query()
def perturbed_texts(t):
    """X50, X100: the noisy twin of each text."""
    return t("documents").select("doc_id", models.perturbed(F.col("text")).alias("noisy"))


_OWN = f"list_distinct(list_transform({S.words('lower(text)')}, lambda w: trim(w, '.,!?;:\"''-')))"


def _shared(keys) -> str:
    return f"len(list_intersect({_OWN}, {S.array(list(dict.fromkeys(keys)))}))"


@query(
    f"""WITH k AS (SELECT doc_id, least({_shared(L.TEMPORAL_WORDS)}, 3) + least({_shared(L.SEQUENCE_WORDS)}, 2) AS n, least(2 * {_shared(L.CONCEPT_WORDS)}, 4) + 3 * {S.any_of('lower(text)', L.DEFINITION_PHRASES)}::INT
 + ({' OR '.join(f"starts_with(lower(text), {S.q(k)})" for k in L.IMPERSONAL_OPENINGS)})::INT AS c FROM documents)
SELECT doc_id, CASE WHEN n > c + 1 THEN 'NARRATIVE' WHEN c > n + 1 THEN 'CONCEPTUAL' ELSE 'NARRATIVE' END AS content_type, NOT c > n + 1 AS narrative FROM k"""
)
def content_types(t):
    """X69, X103, with the lexical signals."""
    return t("documents").select("doc_id", scores.content_type("text").alias("content_type"), scores.narrative("text").alias("narrative"))


@query(
    f"""WITH k AS (SELECT doc_id, {S.wc('text')} AS w, least({_shared(L.TEMPORAL_WORDS)}, 3) + least({_shared(L.SEQUENCE_WORDS)}, 2) AS n, least(2 * {_shared(L.CONCEPT_WORDS)}, 4) + 3 * {S.any_of('lower(text)', L.DEFINITION_PHRASES)}::INT
 + ({' OR '.join(f"starts_with(lower(text), {S.q(k)})" for k in L.IMPERSONAL_OPENINGS)})::INT AS c FROM documents) SELECT doc_id FROM k WHERE w BETWEEN 100 AND 500 AND c > n + 1 ORDER BY md5('42:' || doc_id), doc_id LIMIT 30"""
)
def conceptual_passages(t):
    """a sample of 30 conceptual passages of 100 to 500 words."""
    d = t("documents").filter(text.word_count("text").between(100, 500) & (scores.content_type("text") == "CONCEPTUAL")).select("doc_id")
    return sampling.sample(d, "doc_id", 30)
