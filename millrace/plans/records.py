"""Queries on documents as training records: assembly, dedup, filters, splits, samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import lexicons as L
from millrace.functions import scores, text
from millrace.operators import allocate, code, dedup, joins, profile, records, sampling
from millrace.operators.coreset import content_cluster
from millrace.operators.ranks import global_rank
from millrace.plans import sql as S
from millrace.sources.session import materialise, ship

QUERIES: dict = {}
ORACLES: dict = {}


def query(oracle: str | None = None):
    """Register a query under its function's name, with whole numbers as long."""

    def add(f):
        if f.__name__ in QUERIES:
            raise ValueError(f"two queries named {f.__name__}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            df = f(lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet"))
            return df.select(*[F.col(c).cast("long").alias(c) if k in ("int", "smallint", "tinyint") else F.col(c) for c, k in df.dtypes])

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        QUERIES[f.__name__] = run
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def as_records(docs: DataFrame) -> DataFrame:
    at = F.instr("text", "\n")
    return docs.select("doc_id", F.split_part("text", F.lit("\n"), F.lit(1)).alias("instruction"), F.when(at > 0, F.substring("text", at + 1, F.length("text"))).otherwise("").alias("output"), "source")


def joined(df: DataFrame):
    return F.lower(F.concat_ws(" ", "instruction", "output", F.lit("")))


_JOINED = "lower(instruction || ' ' || output || ' ')"
_KEY = f"sha256({S.strip('instruction')} || chr(10) || {S.strip('output')})"


def _type_sql(t: str) -> str:
    s = {n: S.hits(t, k) for n, k in L.CHANGE_TYPES}
    best = f"greatest({', '.join(s.values())})"
    whens = " ".join(f"WHEN {v} = {best} THEN '{'refactor' if n == 'docs' else n}'" for n, v in s.items())
    return f"CASE WHEN {best} = 0 THEN 'refactor' {whens} END"


_TYPED = f"""WITH {S.RECORDS},
first AS (SELECT * FROM records QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY doc_id) = 1),
typed AS (SELECT *, {_type_sql(_JOINED)} AS change_type FROM first WHERE length(instruction) + length(output) <= 4000)"""


def _typed(t) -> DataFrame:
    r = dedup.keep_first(as_records(t("documents")), dedup.exact_key(), ["doc_id"])
    return records.within_length(r, 4000).withColumn("change_type", scores.change_type(joined(r)))


@query(
    _TYPED
    + """, n AS (SELECT min(c) AS cap FROM (SELECT count(*) AS c FROM typed GROUP BY change_type))
SELECT doc_id, change_type, source FROM typed QUALIFY row_number() OVER (PARTITION BY change_type ORDER BY md5('42:' || doc_id), doc_id) <= (SELECT cap FROM n)"""
)
def assemble_by_type(t):
    """L1: D1, D2, F1, A2, B1."""
    typed = materialise(_typed(t).select("doc_id", "change_type", "source"), "typed")
    return sampling.balance(typed, "change_type", "doc_id")


@query(_TYPED + " SELECT change_type, count(*) AS n FROM typed GROUP BY change_type")
def type_counts(t):
    """A2, A3."""
    return _typed(t).groupBy("change_type").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {S.RECORDS} SELECT doc_id, {_type_sql(_JOINED)} AS change_type FROM records")
def classify_type(t):
    """A1, A2."""
    r = as_records(t("documents"))
    return r.select("doc_id", scores.change_type(joined(r)).alias("change_type"))


@query(f"WITH {S.RECORDS} SELECT min(doc_id) AS doc_id, {_KEY} AS dedup_key FROM records GROUP BY {_KEY}")
def dedup_exact(t):
    """D1, D2."""
    r = as_records(t("documents")).withColumn("dedup_key", dedup.exact_key())
    return dedup.keep_first(r, F.col("dedup_key"), ["doc_id"]).select("doc_id", "dedup_key")


@query(f"SELECT min(doc_id) AS doc_id, sha256(lower({S.strip('text')})) AS signature FROM documents GROUP BY 2")
def dedup_norm(t):
    """D3, D4."""
    d = t("documents").withColumn("signature", dedup.field_key("text"))
    return dedup.keep_first(d, F.col("signature"), ["doc_id"]).select("doc_id", "signature")


@query(f"WITH {S.RECORDS} SELECT {_KEY} AS dedup_key, count(*) AS n, min(doc_id) AS first_id FROM records GROUP BY 1 HAVING count(*) > 1")
def dup_groups(t):
    """D1."""
    r = as_records(t("documents")).groupBy(dedup.exact_key().alias("dedup_key"))
    return r.agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id")).filter("n > 1")


@query(
    """SELECT source, lower(substr(text, 1, 50)) AS prefix, min(doc_id) AS position, arg_max(doc_id, struct_pack(a := length(text), b := -doc_id)) AS kept, max(length(text)) AS n_chars
FROM documents GROUP BY 1, 2"""
)
def prefix50_keep_longest(t):
    """D8."""
    d = t("documents").select("source", "text", "doc_id", F.col("doc_id").alias("kept"))
    out = dedup.keep_longest_prefix(d, "text", ["source"], "doc_id")
    return out.select("source", F.lower(F.substring("text", 1, 50)).alias("prefix"), F.col("doc_id").alias("position"), "kept", F.length("text").alias("n_chars"))


@query(
    """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
k AS (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY doc_id, lower(line) ORDER BY i) = 1)
SELECT doc_id, count(*) AS n_kept, md5(string_agg(line, chr(10) ORDER BY i)) AS kept_md5 FROM k GROUP BY doc_id"""
)
def line_dedup_in_doc(t):
    """D8, second half."""
    kept = dedup.distinct_parts(F.split("text", "\n"))
    return t("documents").select("doc_id", kept.alias("k")).select("doc_id", F.size("k").alias("n_kept"), F.md5(F.array_join("k", "\n").cast("binary")).alias("kept_md5"))


@query(f"SELECT doc_id, {S.wc('text')} AS words, floor({S.wc('text')} * 1.3::DOUBLE)::BIGINT AS tokens, floor(floor({S.wc('text')} * 1.3::DOUBLE) / 1.3::DOUBLE)::BIGINT AS back FROM documents")
def word_counts(t):
    """X2, X57, X58."""
    return t("documents").select("doc_id", text.word_count("text").alias("words"), text.token_estimate("text").alias("tokens"), text.words_of_tokens(text.token_estimate("text")).alias("back"))


_PARA = f"""list_filter(list_transform(string_split(text, chr(10) || chr(10)), lambda s: {S.strip('s')}), lambda s: s <> '')"""
_LINES = f"""list_filter(list_transform(string_split(text, chr(10)), lambda s: {S.strip('s')}), lambda s: s <> '')"""


@query(
    f"""WITH p AS (SELECT doc_id, CASE WHEN len({_PARA}) = 1 AND contains(text, chr(10)) THEN {_LINES} ELSE {_PARA} END AS p FROM documents)
SELECT doc_id, unnest(p) AS paragraph, generate_subscripts(p, 1) - 1 AS position FROM p"""
)
def paragraph_split(t):
    """X3."""
    return t("documents").select("doc_id", F.posexplode(text.paragraphs("text")).alias("position", "paragraph"))


@query(f"WITH s AS (SELECT doc_id, {S.sents('text')} AS s FROM documents) SELECT doc_id, unnest(s) AS sentence, generate_subscripts(s, 1) - 1 AS position FROM s")
def sentence_split(t):
    """X5."""
    return t("documents").select("doc_id", F.posexplode(text.sentences("text")).alias("position", "sentence"))


_CLEAN = r"""trim(translate(regexp_replace(regexp_replace(replace(text, chr(13) || chr(10), chr(10)), '\n{3,}', chr(10) || chr(10), 'g'), '[ \t]+', ' ', 'g'), '‘’“”—–', '''''""--'), """ + S.WS + ")"


@query(rf"SELECT doc_id, md5({_CLEAN}) AS cleaned, md5(trim(regexp_replace(regexp_replace(text, '^[\s.,;:!?\-–—]+', ''), '  +', ' ', 'g'), {S.WS})) AS neutral FROM documents")
def clean_text(t):
    """X9, X12."""
    h = lambda c: F.md5(c.cast("binary"))
    return t("documents").select("doc_id", h(text.clean_text("text")).alias("cleaned"), h(text.clean_neutral("text")).alias("neutral"))


def _top_sql(x: str) -> str:
    return f"coalesce((SELECT max(c) FROM (SELECT count(*) AS c FROM (SELECT unnest(list_filter(list_transform({S.words(x)}, lambda w: trim(lower(w), '.,!?;:''\"')), lambda w: length(w) > 3)) AS w) GROUP BY w)), 0)"


_PARTS = rf"string_split_regex({S.strip('text')}, '[.!?]+')"
_ART = r"regexp_matches(regexp_replace(text, '[—–‘’“”…]', '', 'g'), '[^\x00-\x7F]{3,}')"
_CURATE = rf"""CASE WHEN n < 40 THEN 'too short' WHEN {_ART} THEN 'encoding artifacts'
 WHEN len(regexp_extract_all(text, '[^a-zA-Z0-9\s.,!?;:''"()-]')) / greatest(length(text), 1) > 0.1 THEN 'too many special chars'
 WHEN len(list_filter(parts, lambda s: {S.wc('s')} >= 3)) < 2 THEN 'too few complete sentences'
 WHEN len(list_filter(parts, lambda s: {S.wc('s')} BETWEEN 1 AND 2)) > len(parts) * 0.5 THEN 'too many fragments'
 WHEN top > n * 0.15 AND top > 5 THEN 'excessive repetition' ELSE 'ok' END"""
_LOAD = rf"""CASE WHEN n < 30 THEN 'too_short' WHEN {_ART} THEN 'encoding_artifacts'
 WHEN len(regexp_extract_all(text, '[^a-zA-Z0-9\s.,!?;:''"()\-—–]')) / greatest(length(text), 1) > 0.1 THEN 'special_chars'
 WHEN len(list_filter(parts, lambda s: {S.wc('s')} >= 3)) < 1 THEN 'incomplete' WHEN top > n * 0.15 AND top > 5 THEN 'repetitive' ELSE 'ok' END"""
_TOPS = r"""tops AS (SELECT doc_id, max(c) AS top FROM (SELECT doc_id, w, count(*) AS c FROM
 (SELECT doc_id, trim(lower(unnest(regexp_extract_all(text, '\S+'))), '.,!?;:''"') AS w FROM documents) WHERE length(w) > 3 GROUP BY 1, 2) GROUP BY 1)"""
_REASONS = f"""WITH {_TOPS}, d AS (SELECT d.*, {S.wc('text')} AS n, {_PARTS} AS parts, coalesce(top, 0) AS top FROM documents d LEFT JOIN tops USING (doc_id)),
reasons AS (SELECT doc_id, lang, source, {_CURATE} AS curation, {_LOAD} AS load FROM d)"""


@query(_REASONS + " SELECT doc_id, curation, load FROM reasons")
def quality_reasons(t):
    """F9, F10."""
    return t("documents").select("doc_id", scores.reasons("text").alias("r")).select("doc_id", "r.curation", "r.load")


@query(_REASONS + " SELECT load AS reason, count(*) AS n FROM reasons GROUP BY 1")
def reason_counts(t):
    """A42."""
    return t("documents").groupBy(scores.load_reason("text").alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query(_REASONS + " SELECT lang, count(*) AS n, count(*) FILTER (WHERE load = 'ok') AS passed, (count(*) FILTER (WHERE load = 'ok')) / count(*) AS share FROM reasons GROUP BY 1")
def pass_by_lang(t):
    """A42, A39."""
    d = t("documents").withColumn("ok", (scores.load_reason("text") == "ok").cast("int"))
    return d.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum("ok").alias("passed"), F.avg("ok").alias("share"))


@query(_REASONS + " SELECT quality, load = 'ok' AS passed, count(*) AS n FROM reasons JOIN labels USING (doc_id) GROUP BY 1, 2")
def quality_vs_label(t):
    """F10 against gold."""
    d = t("documents").join(t("labels"), "doc_id")
    return d.groupBy("quality", (scores.load_reason("text") == "ok").alias("passed")).agg(F.count(F.lit(1)).alias("n"))


@query(
    rf"""SELECT doc_id, CASE WHEN length(text) > 0 THEN len(regexp_extract_all(text, '[^\p{{L}}\p{{N}}\s]')) / length(text) ELSE 0 END AS special,
 CASE WHEN {S.wc('text')} < 10 THEN 0 ELSE 1 - len(list_distinct({S.words('lower(text)')})) / {S.wc('text')} END AS repetition FROM documents"""
)
def text_ratios(t):
    """F12, F13."""
    return t("documents").select("doc_id", scores.special_chars("text").alias("special"), scores.word_repetition("text").alias("repetition"))


def _relevance_sql(x: str) -> str:
    return f"""CASE WHEN {x} = '' THEN 0 ELSE least(1.0, CASE WHEN length({x}) < 10 THEN 0.1 WHEN length({x}) < 30 THEN 0.3 WHEN length({x}) <= 200 THEN 0.5 WHEN length({x}) <= 500 THEN 0.4 ELSE 0.3 END
 + CASE WHEN {S.hits(x, L.CODE_TERMS)} >= 4 THEN 0.3 WHEN {S.hits(x, L.CODE_TERMS)} >= 2 THEN 0.2 WHEN {S.hits(x, L.CODE_TERMS)} >= 1 THEN 0.1 ELSE 0 END
 + CASE WHEN {S.any_of(x, L.TASK_WORDS)} THEN 0.2 ELSE 0 END)::DOUBLE END"""


@query(f"WITH {S.RECORDS}, r AS (SELECT doc_id, lower({S.strip('instruction')}) AS x FROM records) SELECT doc_id, round(({_relevance_sql('x')})::DOUBLE, 6) AS relevance FROM r")
def relevance_score(t):
    """X20."""
    return as_records(t("documents")).select("doc_id", F.round(scores.relevance("instruction"), 6).alias("relevance"))


@query(
    rf"""WITH {S.RECORDS}, r AS (SELECT doc_id, split_part({S.strip('instruction')}, chr(10), 1) AS l FROM records)
SELECT doc_id, ({S.wc('l')} >= 3 AND length({S.strip('l')}) >= 12 AND NOT regexp_matches(l, '{L.TRIVIAL_MESSAGE}')) AS substantive, ({S.wc('l')} >= 3 AND length(l) >= 10) AS meaningful FROM r"""
)
def message_filters(t):
    """F6, F8."""
    r = as_records(t("documents"))
    return r.select("doc_id", records.substantive("instruction").alias("substantive"), records.meaningful("instruction").alias("meaningful"))


@query(
    f"""WITH {S.RECORDS}, typed AS (SELECT *, {_type_sql(_JOINED)} AS change_type FROM records),
r AS (SELECT *, row_number() OVER (PARTITION BY source, change_type ORDER BY md5('42:' || doc_id), doc_id) AS rn, count(*) OVER (PARTITION BY source, change_type) AS n FROM typed)
SELECT doc_id, source, change_type, CASE WHEN rn <= round_even(n * 0.05, 0) THEN 'val' ELSE 'train' END AS split FROM r"""
)
def stratified_split(t):
    """B2, B3."""
    r = as_records(t("documents"))
    # The class is computed once, for the passes that count, cut and mark.
    r = materialise(r.select("doc_id", "source", scores.change_type(joined(r)).alias("change_type")), "typed")
    return sampling.stratified_split(r, ["source", "change_type"], "doc_id").select("doc_id", "source", "change_type", "split")


@query(
    f"""WITH {S.RECORDS}, k AS (SELECT doc_id, {_KEY} AS key, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS rn, count(*) OVER () AS n FROM records)
SELECT DISTINCT a.key FROM k a JOIN k b ON a.key = b.key WHERE a.rn <= floor(a.n * 0.9) AND b.rn > floor(b.n * 0.9)"""
)
def leakage(t):
    """Keys on both sides of a split before dedup."""
    r = as_records(t("documents")).withColumn("key", dedup.exact_key())
    s = sampling.cut_split(r, "doc_id", [("train", 0.9)])
    return joins.leaked(s.filter("split = 'train'"), s.filter("split = 'test'"), "key")


@query("SELECT doc_id, CASE WHEN rn <= floor(n * 0.8) THEN 'train' WHEN rn <= floor(n * 0.8) + floor(n * 0.1) THEN 'val' ELSE 'test' END AS split FROM (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS rn, count(*) OVER () AS n FROM documents)")
def split_80_10_10(t):
    """B4, B5, B6."""
    return sampling.cut_split(t("documents").select("doc_id"), "doc_id", [("train", 0.8), ("val", 0.1)])


@query("WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5('42:' || doc_id), doc_id) AS rn FROM documents) SELECT doc_id, source FROM r WHERE rn <= 10 ORDER BY rn, md5('42:' || doc_id), doc_id LIMIT 200")
def balanced_sample(t):
    """A sampling operator: 200 rows over 20 sources."""
    return sampling.per_group_sample(t("documents").select("doc_id", "source"), "source", "doc_id", 200, 20)


@query("SELECT doc_id FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 100")
def hash_sample(t):
    """B11, B17."""
    return sampling.sample(t("documents").select("doc_id"), "doc_id", 100)


_LANGS = "l AS (SELECT lang, count(*) AS f FROM documents GROUP BY 1)"


@query(
    f"""WITH {_LANGS}, w AS (SELECT lang, f, pow(f, 0.5) / sum(pow(f, 0.5)) OVER () AS weight FROM l),
e AS (SELECT *, weight * (1000 - 10 * count(*) OVER ()) AS exact FROM w),
k AS (SELECT *, floor(exact) AS whole, row_number() OVER (ORDER BY round(exact - floor(exact), 9) DESC, lang) AS place, (1000 - 10 * count(*) OVER ()) - sum(floor(exact)) OVER () AS left_over FROM e)
SELECT lang, f AS frequency, weight, (10 + whole + CASE WHEN place <= left_over THEN 1 ELSE 0 END)::BIGINT AS budget FROM k"""
)
def temperature_alloc(t):
    """A7, A8."""
    f = t("documents").groupBy("lang").agg(F.count(F.lit(1)).alias("frequency"))
    return allocate.largest_remainder(allocate.reweight(f, "frequency", 2.0), "weight", 1000, ["lang"], 10)


def _slice(i: int, t: float, part: int) -> str:
    return f"""w{i} AS (SELECT lang, pow(f, {1 / t}) / sum(pow(f, {1 / t})) OVER () * {part} AS e FROM l),
s{i} AS (SELECT lang, floor(e) + CASE WHEN row_number() OVER (ORDER BY round(e - floor(e), 9) DESC, lang) <= {part} - sum(floor(e)) OVER () THEN 1 ELSE 0 END AS b FROM w{i})"""


@query(f"WITH {_LANGS}, {_slice(0, 1.0, 34)}, {_slice(1, 2.0, 33)}, {_slice(2, 4.0, 33)} SELECT lang, (s0.b + s1.b + s2.b)::BIGINT AS budget FROM s0 JOIN s1 USING (lang) JOIN s2 USING (lang)")
def temperature_budget(t):
    """A10, B18."""
    f = t("documents").groupBy("lang").agg(F.count(F.lit(1)).alias("frequency"))
    return allocate.temperature_budget(f, "frequency", 100, [1.0, 2.0, 4.0], ["lang"]).select("lang", "budget")


@query("WITH l AS (SELECT source, count(*) AS f FROM documents GROUP BY 1) SELECT source, (2 + floor((500 - 2 * count(*) OVER ()) * f / sum(f) OVER ()))::BIGINT AS budget FROM l")
def min_floor_alloc(t):
    """A9."""
    f = t("documents").groupBy("source").agg(F.count(F.lit(1)).alias("f"))
    return allocate.floor_allocation(f, "f", 500, 2).select("source", "budget")


@query("WITH l AS (SELECT source, count(*) AS f FROM documents GROUP BY 1), p AS (SELECT f / sum(f) OVER () AS p, count(*) OVER () AS k FROM l) SELECT -sum(p * ln(p)) / ln(max(k)) AS diversity FROM p")
def entropy_diversity(t):
    """A6."""
    return allocate.normalised_entropy(t("documents").groupBy("source").agg(F.count(F.lit(1)).alias("f")), "f")


@query(
    """WITH g AS (SELECT lang, source FROM (SELECT DISTINCT lang FROM documents), (SELECT DISTINCT source FROM documents)), c AS (SELECT lang, source, count(*) AS n FROM documents GROUP BY 1, 2)
SELECT lang, source, coalesce(n, 0) AS n_features FROM g LEFT JOIN c USING (lang, source) WHERE coalesce(n, 0) < 6"""
)
def sparse_nodes(t):
    """A5, F26. The grid of languages and sources is a taxonomy, some 80 rows however many documents there are."""
    d = t("documents").select("lang", "source")
    grid = d.select("lang").distinct().crossJoin(d.select("source").distinct())
    return allocate.sparse(grid, d, ["lang", "source"], 6)


@query("SELECT r_name, n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)")
def node_rollup(t):
    """A11."""
    d = t("customer").join(F.broadcast(t("nation")), F.col("c_nationkey") == F.col("n_nationkey")).join(F.broadcast(t("region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return allocate.rollup_counts(d, ["r_name", "n_name"])


def _stop() -> str:
    return S.array(sorted(set(L.CLUSTER_STOP_WORDS)))


_SIG = rf"""w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+')) AS w FROM documents),
c AS (SELECT doc_id, w, count(*) AS n FROM w WHERE regexp_full_match(w, '[a-z]{{5,}}') AND NOT list_contains({_stop()}, w) GROUP BY 1, 2),
top AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, w) <= 5),
sig AS (SELECT d.doc_id, coalesce(string_agg(w, ' ' ORDER BY w), '') AS signature FROM documents d LEFT JOIN top USING (doc_id) GROUP BY 1)"""


@query(f"WITH {_SIG} SELECT doc_id, {S.md5_int('signature')} % 50 AS cluster FROM sig")
def content_clusters(t):
    """B16."""
    return t("documents").select("doc_id", content_cluster("text").alias("cluster"))


@query(
    f"WITH {_SIG}, k AS (SELECT doc_id, {S.md5_int('signature')} % 50 AS cluster, n_chars FROM sig JOIN documents USING (doc_id)) SELECT doc_id, cluster FROM k QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY n_chars DESC, doc_id) <= 2"
)
def diverse_select_phase1(t):
    """O6, first phase."""
    d = t("documents").select("doc_id", "n_chars", content_cluster("text").alias("cluster"))
    return sampling.diverse_first(d, "cluster", "n_chars", "doc_id").select("doc_id", "cluster")


@query(
    f"""WITH r AS (SELECT doc_id, {S.wc('text')} AS w, row_number() OVER (ORDER BY doc_id) - 1 AS rn FROM documents), p AS (SELECT *, coalesce(sum(w) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM r WHERE rn % 4 = 0)
SELECT doc_id, w AS words FROM p WHERE b < 20000"""
)
def budget_prefix(t):
    """O7."""
    d = t("documents").select("doc_id", text.word_count("text").alias("words"))
    return sampling.every_step(d, ["doc_id"], F.col("words"), 0.25, 20000)


@query("SELECT doc_id, row_number() OVER (ORDER BY n_chars DESC, doc_id) - 1 AS rank, (coalesce(sum(n_chars) OVER (ORDER BY n_chars DESC, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS chars_before FROM documents")
def running_totals(t):
    """Ranks and running sums of a whole table without a one-task window."""
    return global_rank(t("documents").select("doc_id", "n_chars"), [-F.col("n_chars"), "doc_id"], "rank", F.col("n_chars"), "chars_before").select("doc_id", "rank", "chars_before")


@query(
    """SELECT doc_id, len(regexp_extract_all(text, '\\[\\^\\d+\\]')) AS n, md5(regexp_replace(text, '\\[\\^\\d+\\]', '', 'g')) AS stripped FROM documents""".replace("\\\\", "\\")
)
def citation_counts(t):
    """X28, X29."""
    return t("documents").select("doc_id", F.size(text.citations("text")).alias("n"), F.md5(text.without_citations("text").cast("binary")).alias("stripped"))


@query("SELECT source, count(*) AS n, floor(count(*) * 100 / (SELECT count(*) FROM documents))::BIGINT AS percent FROM documents GROUP BY 1")
def kind_shares(t):
    """A3, A43-A45."""
    return profile.shares(t("documents"), "source")


@query(
    rf"""WITH {S.RECORDS} SELECT doc_id, CASE WHEN regexp_matches(l, '^\[[^\]]+\]') THEN lower(regexp_extract(l, '^(\[[^\]]+\])', 1))
 WHEN {S.in_list("lower(regexp_extract(l, '^([^:]{1,10}):', 1))", L.COMMIT_PREFIXES)} OR lower(regexp_extract(l, '^([^:]{{1,10}}):', 1)) LIKE 'squash%' THEN lower(regexp_extract(l, '^([^:]{{1,10}}):', 1)) END AS prefix
FROM (SELECT doc_id, {S.strip('instruction')} AS l FROM records)"""
)
def message_prefixes(t):
    """X15."""
    return as_records(t("documents")).select("doc_id", text.commit_prefix("instruction").alias("prefix"))


@query(f"WITH {S.RECORDS} SELECT doc_id, list_filter([{', '.join(f'CASE WHEN {S.any_of(chr(39) + chr(39) + chr(124) * 2 + chr(100), k)} THEN {S.q(n)} END' for n, k in (('macro', L.MACRO_FORMS), ('protocol', L.PROTOCOL_FORMS), ('spec', L.SPEC_FORMS), ('async', L.ASYNC_FORMS), ('multimethod', L.MULTIMETHOD_FORMS)))}], lambda x: x IS NOT NULL) AS patterns, {S.hits('d', L.CONCURRENCY_FORMS)} >= 2 OR (contains(d, 'atom') AND contains(d, 'swap!')) AS state_machine FROM (SELECT doc_id, lower(output) AS d FROM records)")
def pattern_flags(t):
    """X70-X73, X79-X83 on the outputs, with a file name that matches."""
    r = as_records(t("documents")).withColumn("p", code.pattern_flags("output", F.array(F.lit("src/a.clj"))))
    own = F.array(*[F.lit(x) for x in ("macro", "protocol", "spec", "async", "multimethod")])
    return r.select("doc_id", F.filter("p", lambda x: F.array_contains(own, x)).alias("patterns"), F.array_contains("p", "state-machine").alias("state_machine"))


@query(f"WITH {S.RECORDS} SELECT doc_id, len(list_filter(string_split(output, chr(10)), lambda s: (starts_with(s, '+') AND NOT starts_with(s, '+++')) OR (starts_with(s, '-') AND NOT starts_with(s, '---')))) AS changed, length(instruction) + length(output) AS chars FROM records")
def changed_lines(t):
    """X16, F2."""
    r = as_records(t("documents"))
    return r.select("doc_id", records.changed_lines("output").alias("changed"), records.record_chars(r).alias("chars"))


@query()
def validation(t):
    """The summary of all records."""
    return code.validation_summary(code.validated(as_records(t("documents"))))
