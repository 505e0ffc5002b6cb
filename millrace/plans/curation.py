"""Queries on filters, records, unions, samples, splits and routes."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from millrace.functions import fragments, lexicons as L, scores, text
from millrace.operators import allocate, code, dedup, joins, records, sampling, taxonomy
from millrace.operators.ranks import global_rank
from millrace.plans import sql as S
from millrace.plans.records import ORACLES, QUERIES, as_records, query
from millrace.sources.session import ship

_N = f"list_transform({S.sents('text')}, lambda s: {S.wc('s')})"


def _md5(c: Column) -> Column:
    return F.md5(c.cast("binary"))


# Filters.


@query(
    rf"""SELECT doc_id, CASE WHEN {S.wc('text')} < 40 THEN 'too_short' WHEN {S.wc('text')} > 500 THEN 'too_long' WHEN len({_N}) < 2 THEN 'few_sentences'
 WHEN len(regexp_extract_all(text, '[^\p{{L}}\p{{N}}\s]')) / length(text) > 0.15 THEN 'special_chars' WHEN 1 - len(list_distinct({S.words('lower(text)')})) / {S.wc('text')} > 0.6 THEN 'repetition' ELSE 'ok' END AS reason FROM documents"""
)
def config_reasons(t):
    """F11."""
    return t("documents").select("doc_id", scores.config_reason("text").alias("reason"))


_PARAGRAPHS = f"p AS (SELECT doc_id, unnest(list_filter(list_transform(string_split(replace(text, chr(10), chr(10) || chr(10)), chr(10) || chr(10)), lambda s: {S.strip('s')}), lambda s: s <> '')) AS text FROM documents)"


@query(
    rf"""WITH {_PARAGRAPHS} SELECT doc_id, count(*) AS n, md5(string_agg(text, '|' ORDER BY text)) AS kept FROM p WHERE {S.wc('text')} BETWEEN 20 AND 120 AND len({_N}) >= 2
 AND len(regexp_extract_all(text, '[^\p{{L}}\p{{N}}\s]')) / length(text) <= 0.15 AND 1 - len(list_distinct({S.words('lower(text)')})) / {S.wc('text')} <= 0.6 GROUP BY 1"""
)
def quality_paragraphs(t):
    """split, then F11."""
    lines = F.split(F.replace("text", F.lit("\n"), F.lit("\n\n")), "\n\n")
    p = t("documents").select("doc_id", F.explode(text.non_blank(lines)).alias("text")).filter(scores.config_reason("text", 20, 120) == "ok")
    return p.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("text")).alias("k")).select("doc_id", "n", _md5(F.array_join("k", "|")).alias("kept"))


_PAIRS = """pairs AS (SELECT conv_id, turn, text AS a, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS b FROM conversations)"""


def _pairs(t):
    nxt = t("conversations").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("b"))
    return t("conversations").select("conv_id", "turn", F.col("text").alias("a")).join(nxt, ["conv_id", "turn"])


def _sentences(x: str) -> str:
    return f"len({S.sents(x)})"


@query(
    f"""WITH {_PAIRS}, n AS (SELECT *, {S.wc('a')} AS wa, {S.wc('b')} AS wb, {_sentences('a')} AS sa, {_sentences('b')} AS sb, list_distinct({S.words('lower(a)')}) AS da, list_distinct({S.words('lower(b)')}) AS db FROM pairs WHERE b IS NOT NULL)
SELECT conv_id, turn, abs(wa - wb) <= wa * 0.2 AND abs(sa - sb) <= 1 AND CASE WHEN len(da) > 0 THEN len(list_intersect(da, db)) / len(da) ELSE 0 END <= 0.85 AS variation, abs(wa - wb) <= wa * 0.15 AND sa = sb AS perspective,
wb >= wa * 0.5 AND wb <= wa * 3 AS balanced FROM n"""
)
def pair_filters(t):
    """Each turn against the next."""
    return _pairs(t).select("conv_id", "turn", scores.good_variation("a", "b").alias("variation"), scores.good_perspective("a", "b").alias("perspective"), records.balanced_lengths("a", "b").alias("balanced"))


@query(
    rf"""WITH {_PARAGRAPHS} SELECT doc_id, count(*) FILTER (WHERE {S.wc('text')} BETWEEN 80 AND 600 AND NOT regexp_matches(text, '^(Chapter|Part|Section|[IVXLC]+\.?\s*$|[A-Z][A-Z\s]+$)')
 AND len(regexp_extract_all(text, '[^a-zA-Z0-9\s.,;:!?''"()\-—]')) / greatest(length(text), 1) <= 0.05) AS diverse, sum(CASE WHEN {S.wc('text')} BETWEEN 10 AND 40 THEN contains(text, '—')::INT + contains(text, ';')::INT + 2 * {S.hits('lower(text)', L.EMOTIONS)} + (abs({S.wc('text')} - 20) > 8)::INT ELSE 0 END)::BIGINT AS score FROM p GROUP BY 1"""
)
def paragraph_scores(t):
    """F21, F24."""
    lines = F.split(F.replace("text", F.lit("\n"), F.lit("\n\n")), "\n\n")
    p = t("documents").select("doc_id", F.explode(text.non_blank(lines)).alias("text"))
    return p.groupBy("doc_id").agg(F.count_if(records.diverse_paragraph("text")).alias("diverse"), F.sum(records.exemplar_score("text")).alias("score"))


@query(
    """WITH d AS (SELECT doc_id, (CASE WHEN doc_id % 2 = 0 THEN ';; eval: ' ELSE ';; repl ' END) || source || (CASE WHEN doc_id % 3 = 0 THEN chr(10) || 'diff --git a b' ELSE '' END) || (CASE WHEN doc_id % 5 = 0 THEN chr(10) || ';; apply: @@' ELSE '' END) AS s FROM documents)
SELECT doc_id, contains(s, ';; eval:') AND (contains(s, ';; apply:') OR contains(s, 'diff --git')) AND (contains(s, 'diff --git') OR contains(s, '@@')) AS valid FROM d"""
)
def trace_filter(t):
    """F18."""
    s = F.concat(
        F.when(F.col("doc_id") % 2 == 0, ";; eval: ").otherwise(";; repl "), "source", F.when(F.col("doc_id") % 3 == 0, "\ndiff --git a b").otherwise(""), F.when(F.col("doc_id") % 5 == 0, "\n;; apply: @@").otherwise("")
    )
    return t("documents").select("doc_id", records.valid_trace(s).alias("valid"))


#: Paths made of part names; the ends go round.
_ENDS = [".clj", "_test.clj", ".edn", ".md", "_test.cljs", ".cljc"]
_HEADS = ["src/", "test/", "docs/", "resources/"]
_PATH_SQL = f"({S.array(_HEADS)})[p_partkey % 4 + 1] || replace(p_name, ' ', '_') || ({S.array(_ENDS)})[p_partkey % 6 + 1]"


def _path() -> Column:
    at = lambda xs, n: F.element_at(F.array(*[F.lit(x) for x in xs]), (F.col("p_partkey") % n + 1).cast("int"))
    return F.concat(at(_HEADS, 4), F.replace("p_name", F.lit(" "), F.lit("_")), at(_ENDS, 6))


def _ends(x: str, keys) -> str:
    return "(" + " OR ".join(f"ends_with({x}, {S.q(k)})" for k in keys) + ")"


def _starts(x: str, keys) -> str:
    return "(" + " OR ".join(f"starts_with({x}, {S.q(k)})" for k in keys) + ")"


_CODE_FILE = f"(NOT ({_ends('p', L.NON_CODE_FILES)} OR {_starts('p', [*L.NON_CODE_FILES, *L.NON_CODE_PREFIXES])}) AND {_ends('p', L.CODE_EXTENSIONS)})"
_TEST_FILE = r"(contains(p, 'test/') OR regexp_matches(p, '_test\.clj[cs]?$'))"


@query(f"SELECT p_partkey, {_CODE_FILE} AS code, {_TEST_FILE} AS test, {_ends('p', L.SOURCE_EXTENSIONS)} AND NOT {_TEST_FILE} AS source FROM (SELECT p_partkey, {_PATH_SQL} AS p FROM part)")
def file_kinds(t):
    """F5, F25, F34."""
    d = t("part").select("p_partkey", _path().alias("p"))
    return d.select("p_partkey", records.is_code_file(F.col("p")).alias("code"), records.is_test_file(F.col("p")).alias("test"), records.is_source_file(F.col("p")).alias("source"))


@query(
    f"""WITH f AS (SELECT p_partkey, {_PATH_SQL} AS p, p_size % 7 = 0 AS is_merge, p_partkey // 3 AS c, p_type || ' ' || p_name AS note FROM part), g AS (SELECT c, bool_or({_CODE_FILE}) AS has_code, arg_min(is_merge, p_partkey) AS is_merge, arg_min(note, p_partkey) AS message FROM f GROUP BY 1)
SELECT c AS commit_id FROM g WHERE has_code AND NOT is_merge AND {S.wc('message')} >= 3 AND length({S.strip('message')}) >= 10"""
)
def code_commits(t):
    """three paths a commit."""
    d = t("part").select(F.floor(F.col("p_partkey") / 3).alias("commit_id"), "p_partkey", (F.col("p_size") % 7 == 0).alias("m"), F.concat("p_type", F.lit(" "), "p_name").alias("note"), _path().alias("p"))
    d = d.groupBy("commit_id").agg(F.collect_list("p").alias("files"), F.min_by("m", "p_partkey").alias("is_merge"), F.min_by("note", "p_partkey").alias("message"))
    return records.code_commits(d).select("commit_id")


_DIFF = "CASE WHEN doc_id % 3 > 0 THEN 'diff --git a/x b/x' || chr(10) || '+++ b/x' || chr(10) || repeat('+a' || chr(10), doc_id % 7) || '-b' ELSE 'plain' END"


@query(f"""SELECT doc_id FROM (SELECT doc_id, source, {_DIFF} AS o FROM documents) WHERE source = 'src1' OR NOT contains(o, 'diff --git') OR doc_id % 7 + 1 >= 4""")
def without_trivial_diffs(t):
    """src1 stands for the synthetic side."""
    body = F.concat(F.lit("diff --git a/x b/x\n+++ b/x\n"), F.repeat(F.lit("+a\n"), (F.col("doc_id") % 7).cast("int")), F.lit("-b"))
    d = t("documents").select("doc_id", F.when(F.col("source") == "src1", "synthetic").otherwise(F.col("source")).alias("source"), F.when(F.col("doc_id") % 3 > 0, body).otherwise("plain").alias("output"))
    return records.without_trivial_diffs(d).select("doc_id")


@query("SELECT event_id, event_type = 'view' AS would_skip, length(props) > 0 AND length(props) <= greatest(user_id % 5 * 3, 30) AS safe FROM events WHERE event_type <> 'click'")
def finding_filters(t):
    """Findings are events, rules their types."""
    denied = t("events").filter("event_type = 'click'").select(F.col("event_type").alias("rule_id")).distinct()
    e = records.allowed_findings(t("events").withColumnRenamed("event_type", "rule_id"), denied)
    found = fragments.findings(F.array(F.struct("rule_id")), ["view"])
    return e.select("event_id", found[0]["would_skip"].alias("would_skip"), records.safe_replacement(F.col("props"), F.col("user_id") % 5).alias("safe"))


@query("SELECT event_id FROM events WHERE event_type IN ('view', 'purchase')")
def of_difficulty(t):
    """event types stand for difficulties."""
    return records.of_difficulty(t("events"), ["view", "purchase"], "event_type").select("event_id")


@query("SELECT doc_id, CASE WHEN length(text) >= 10 THEN 'X' || substr(text, 2, 4) || 'yz' || substr(text, 8) ELSE text END AS edited FROM documents")
def offset_edits(t):
    """Two edits, applied from the right."""
    edits = F.array(F.struct(F.lit(5).alias("start"), F.lit(2).alias("length"), F.lit("yz").alias("new")), F.struct(F.lit(0).alias("start"), F.lit(1).alias("length"), F.lit("X").alias("new")))
    return t("documents").select("doc_id", F.when(F.length("text") >= 10, records.corrected(F.col("text"), edits)).otherwise(F.col("text")).alias("edited"))


# Records.


@query(
    f"""WITH {S.RECORDS} SELECT instruction, '' AS input, output, CASE WHEN {S.strip('source')} = 'src2' THEN 'default' ELSE source END AS system, 0 AS turns FROM records"""
)
def formatted_records(t):
    """P1, P2, P18."""
    r = as_records(t("documents")).withColumn("system", F.when(F.col("source") != "src2", F.col("source")))
    return records.format_records(r, "default").withColumn("turns", F.size("history")).drop("history")


@query("SELECT doc_id, coalesce(CASE WHEN source <> 'src3' THEN source END, 'git') AS source, md5(text) || ':' || lang AS output FROM documents")
def tagged_records(t):
    """P3, P4, P5, P6."""
    d = t("documents").select("doc_id", "text", "lang", F.when(F.col("source") != "src3", F.col("source")).alias("source"))
    tagged = records.tag_source(d, "git")
    made = records.to_record(tagged.withColumn("text", F.md5(F.col("text").cast("binary"))), F.col("doc_id").cast("string"), F.concat_ws(":", "text", "lang"), source=None)
    return made.select(F.col("instruction").cast("long").alias("doc_id"), "output").join(tagged.select("doc_id", "source"), "doc_id")


@query(
    """SELECT doc_id, '## Task' || chr(10) || source || CASE WHEN doc_id % 3 > 0 THEN chr(10) || chr(10) || '## Relevant files' || chr(10) || array_to_string(list_transform(range(doc_id % 3), lambda i: '- f' || i), chr(10)) ELSE '' END
 || CASE WHEN doc_id % 2 > 0 THEN chr(10) || chr(10) || '## Plan' || chr(10) || lang || chr(10) || 'end' ELSE '' END AS task, '### ' || source || chr(10) || lang || chr(10) || chr(10) || '### b' || chr(10) || 'c' AS batch FROM documents"""
)
def task_texts(t):
    """P13, P14, P21."""
    files = F.filter(F.array(F.lit("f0"), F.lit("f1")), lambda f: F.substring(f, 2, 1).cast("int") < F.col("doc_id") % 3)
    plan = F.when(F.col("doc_id") % 2 > 0, F.array("lang", F.lit("end"))).otherwise(F.array().cast("array<string>"))
    batch = F.array(F.struct(F.col("source").alias("path"), F.col("lang").alias("content")), F.struct(F.lit("b").alias("path"), F.lit("c").alias("content")))
    return t("documents").select("doc_id", records.task_text("source", files, plan).alias("task"), records.batch_text(batch).alias("batch"))


@query("SELECT doc_id, substr(md5(source || ':' || lang || ':' || doc_id), 1, 16) AS id FROM documents")
def chunk_ids(t):
    """P17."""
    return t("documents").select("doc_id", records.chunk_id("source", "lang", F.col("doc_id")).alias("id"))


def _u(salt: str) -> str:
    return f"('0x' || substr(md5('42:' || doc_id || ':{salt}'), 1, 8))::BIGINT / {16**8}.0::DOUBLE"


@query(
    f"""SELECT doc_id, 'keep meaning' || CASE WHEN {_u('often0')} < 0.7 THEN chr(10) || 'vary length' ELSE '' END || CASE WHEN {_u('often1')} < 0.7 THEN chr(10) || 'no lists' ELSE '' END
 || CASE WHEN {_u('rare')} < 0.4 THEN chr(10) || (['a dash', 'a question', 'an aside'])[floor({_u('which')} * 3)::INT + 1] ELSE '' END AS constraints FROM documents"""
)
def seeded_constraints(t):
    """P19, P20, E29."""
    return t("documents").select("doc_id", records.constraints(F.col("doc_id"), ["keep meaning"], ["vary length", "no lists"], ["a dash", "a question", "an aside"]).alias("constraints"))


@query("SELECT p.p_partkey AS step, l.loss FROM part p LEFT JOIN (SELECT s_suppkey AS step, s_acctbal AS loss FROM supplier) l ON p.p_partkey = l.step")
def loss_lookup(t):
    """P16."""
    return taxonomy.lookup(t("supplier").select(F.col("s_suppkey").alias("step"), F.col("s_acctbal").alias("loss")), t("part").select(F.col("p_partkey").alias("step")))


@query("SELECT coalesce(CASE WHEN lang <> 'fr' THEN lang END, 'xx') AS lang, source, 'none' AS extra FROM documents")
def fields_with_defaults(t):
    """Y15, Y16."""
    d = t("documents").select(F.when(F.col("lang") != "fr", F.col("lang")).alias("lang"), "source")
    return taxonomy.with_defaults(d, {"lang": "xx", "source": "s", "extra": "none"})


# Unions, dedup.


@query(f"""WITH m AS (SELECT 0 AS r, text, doc_id AS id FROM documents UNION ALL SELECT 1, text, conv_id * 1000 + turn FROM conversations)
SELECT id, sha256(lower({S.strip('text')})) AS signature FROM m QUALIFY row_number() OVER (PARTITION BY sha256(lower({S.strip('text')})) ORDER BY r, id) = 1""")
def merged_sources(t):
    """Documents before conversations, by D3."""
    a = t("documents").select("text", F.col("doc_id").alias("id"))
    b = t("conversations").select("text", (F.col("conv_id") * 1000 + F.col("turn")).alias("id"))
    return dedup.merge([a, b], dedup.field_key("text"), ["id"]).select("id", dedup.field_key("text").alias("signature"))


@query(
    """WITH o AS (SELECT doc_id, lang, source FROM documents WHERE source <> 'src1'), k AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id), doc_id) <= 20)
SELECT * FROM k UNION ALL SELECT doc_id, lang, source FROM documents WHERE source = 'src1'"""
)
def one_side_balanced(t):
    """All sources but one, at most 20 a language (a sample's cap); the one is kept whole."""
    d = t("documents").select("doc_id", "lang", "source")
    return dedup.process_side(d, F.col("source") != "src1", lambda side: sampling.balance(side, "lang", "doc_id", 20))


@query(
    """WITH u AS (SELECT 'd' || doc_id AS id, text, lang FROM documents UNION ALL SELECT 'c' || conv_id || '-' || turn, text, NULL FROM conversations)
SELECT id, md5(text) AS text, lang, row_number() OVER (ORDER BY md5('42:' || id), id) - 1 AS place FROM u"""
)
def union_in_hash_order(t):
    """U3, U4, O2."""
    a = t("documents").select(F.concat(F.lit("d"), "doc_id").alias("id"), _md5(F.col("text")).alias("text"), "lang")
    b = t("conversations").select(F.concat(F.lit("c"), "conv_id", F.lit("-"), "turn").alias("id"), _md5(F.col("text")).alias("text"))
    return dedup.union_shuffled([a, b], "id")


def phase_union(spark: SparkSession, sf_dir: str):
    """Three phases, of which one is missing."""
    ship(spark)
    rows = dedup.union_existing(spark, [f"{sf_dir}/benchmark.parquet", f"{sf_dir}/no_such_phase.parquet", f"{sf_dir}/labels.parquet"])
    return rows.select("item_id", "doc_id", F.md5(F.col("text").cast("binary")).alias("text"))


QUERIES["phase_union"] = phase_union
ORACLES["phase_union"] = "SELECT item_id, NULL::BIGINT AS doc_id, md5(text) AS text FROM benchmark UNION ALL SELECT NULL, doc_id, NULL FROM labels"


@query(
    """WITH s AS (SELECT doc_id FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 50)
SELECT doc_id, row_number() OVER (ORDER BY n_chars DESC, doc_id) - 1 AS place FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM s)"""
)
def remaining_longest_first(t):
    """U8: what a sample of 50 leaves, the longest first."""
    d = t("documents").select("doc_id", "n_chars")
    return global_rank(dedup.remaining(d, sampling.sample(d, "doc_id", 50), "doc_id"), [-F.col("n_chars"), "doc_id"], "place").select("doc_id", "place")


@query(
    f"""WITH {S.RECORDS} SELECT min(doc_id) AS doc_id FROM records GROUP BY instruction ORDER BY 1 LIMIT 60"""
)
def mined_distinct(t):
    """The first 60 distinct instructions, a limit that is the feature."""
    return dedup.mine_distinct(as_records(t("documents")), "instruction", ["doc_id"], 60).select("doc_id")


_LINE = f"{S.strip(f'''split_part({S.strip('text')}, chr(10), 1)''')}"


@query(
    f"""WITH l AS (SELECT source, doc_id, {_LINE} AS s FROM documents), k AS (SELECT source, s, min(doc_id) AS d FROM l WHERE s <> '' AND NOT starts_with(s, 'Merge ') AND NOT regexp_matches(s, '^\\*?\\s*[\\w./\\-]+\\s*:') AND {S.wc('s')} >= 3 AND length(s) >= 10 GROUP BY 1, 2)
SELECT x.source, coalesce(md5(string_agg(s, '; ' ORDER BY d)), md5('')) AS joint FROM (SELECT DISTINCT source FROM documents) x LEFT JOIN k USING (source) GROUP BY 1"""
)
def joint_instructions(t):
    """The first lines of a source's documents, each once, in order (lines with a colon after their first word left out beforehand)."""
    d = t("documents").filter(~F.regexp_like(text.first_line("text"), F.lit(r"^\*?\s*[\w./\-]+\s*:")))
    m = d.groupBy("source").agg(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "text"))), lambda x: x["text"]).alias("m"))
    return m.select("source", _md5(dedup.joint_instruction("m")).alias("joint"))


@query("SELECT p_brand AS node, p_type AS name, min(p_size) AS tree FROM part GROUP BY 1, 2")
def merged_trees(t):
    """Sizes stand for trees."""
    return dedup.merge_trees(t("part").select(F.col("p_size").alias("tree"), F.col("p_brand").alias("node"), F.col("p_type").alias("name"))).select("node", "name", "tree")


@query(
    f"""WITH r AS (SELECT doc_id, n_chars AS w, coalesce(sum(n_chars) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b, sum(n_chars) OVER () AS total FROM documents),
p AS (SELECT {S.md5_int("'42:' || i")} AS h FROM range(80) x(i)) SELECT DISTINCT doc_id FROM r, p WHERE h % total >= b AND h % total < b + w"""
)
def drawn_distinct(t):
    """80 draws by length, with replacement, each row once."""
    return sampling.drawn(t("documents").select("doc_id", "n_chars"), "doc_id", "n_chars", 80).select("doc_id")


# Samples, splits, routes.


@query("SELECT r_regionkey, CASE WHEN row_number() OVER (ORDER BY md5('42:' || r_regionkey), r_regionkey) <= greatest(1, floor(0.1 * 5)) THEN 'train' ELSE 'test' END AS split FROM region")
def split_with_one_train(t):
    """A tenth, but one row at least."""
    return sampling.cut_split(t("region").select("r_regionkey"), "r_regionkey", [("train", 0.1)], at_least=1)


@query(
    """WITH u AS (SELECT doc_id, pow((('0x' || substr(md5('42:' || doc_id), 1, 13))::BIGINT + 1) / 4503599627370497.0::DOUBLE, 1.0 / n_chars) AS k FROM documents WHERE n_chars > 0) SELECT doc_id FROM u ORDER BY k DESC, doc_id LIMIT 60"""
)
def weighted_sample(t):
    """60 rows by length, without replacement."""
    return sampling.weighted_sample(t("documents").select("doc_id", "n_chars"), "doc_id", F.col("n_chars"), 60).select("doc_id")


@query(
    """WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5('42:' || doc_id), doc_id) AS rn, count(*) OVER (PARTITION BY source) AS n, count(*) OVER () AS total FROM documents)
SELECT doc_id, source FROM r WHERE rn <= greatest(1, floor(n * 50 / total)) ORDER BY md5('42:' || doc_id), doc_id LIMIT 50"""
)
def share_sample(t):
    """50 rows by each source's share."""
    return sampling.share_sample(t("documents").select("doc_id", "source"), "source", "doc_id", 50)


@query(
    """WITH f AS (SELECT DISTINCT p_partkey, unnest(string_split(p_type, ' ')) AS f FROM part), o AS (SELECT f, arg_min(p_partkey, md5('42:' || f || ':' || p_partkey)) AS k FROM f GROUP BY 1),
g AS (SELECT k, min(md5('42:' || f)) AS o FROM o GROUP BY 1) SELECT k AS p_partkey FROM g ORDER BY o, k LIMIT 12"""
)
def one_per_feature(t):
    """Words of the type as features."""
    d = t("part").select("p_partkey", F.array_distinct(F.split("p_type", " ")).alias("features"))
    return sampling.by_feature(d, "features", "p_partkey", 12).select("p_partkey")


@query(f"SELECT conv_id, turn, unnest(CASE WHEN {S.wc('text')} >= 10 THEN ['standard', 'info_dropout', 'abstract'] ELSE ['standard'] END) AS variation_type FROM conversations")
def fan_out(t):
    """B20, B21."""
    return sampling.variants(t("conversations"), "text").select("conv_id", "turn", "variation_type")


@query("SELECT doc_id, 'original' AS kind FROM documents UNION ALL (SELECT doc_id, 'robustness' FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT (SELECT count(*) // 3 FROM documents))")
def robustness_rows(t):
    """A third of the originals once more."""
    return sampling.robustness(t("documents").select("doc_id", F.lit("original").alias("kind")), "kind", "doc_id")


@query("SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 25")
def top_by_score(t):
    """O3: a top-k report."""
    return sampling.top_similar(t("customer").select("c_custkey", "c_acctbal"), "c_acctbal", "c_custkey", 25)


@query("SELECT word AS feature_type, count(*) AS n FROM (SELECT p_partkey, unnest(string_split(p_type, ' ')) AS word FROM part) GROUP BY 1")
def feature_frequency(t):
    """A4: types' words as features of trees."""
    d = t("part").select(F.transform(F.split("p_type", " "), lambda w: F.struct(w.alias("feature_type"))).alias("features"))
    return allocate.feature_frequency(d)


_KINDS = [("STANDARD", "common"), ("ECONOMY", "cheap"), ("BRUSHED", "surface"), ("STEEL", "metal"), ("PROMO", "sale")]


@query(
    f"""WITH k AS (SELECT DISTINCT p_partkey, p_type AS kind FROM part), m AS (SELECT * FROM (VALUES {', '.join(f"('{a}', '{b}', {i})" for i, (a, b) in enumerate(_KINDS))}) v(name, category, ord)),
j AS (SELECT p_partkey, arg_min(category, (CASE WHEN name = kind THEN 0 ELSE 100 END) + ord) AS category FROM k JOIN m ON contains(kind, name) OR contains(name, kind) GROUP BY 1) SELECT p_partkey, coalesce(category, 'other') AS category FROM part LEFT JOIN j USING (p_partkey)"""
)
def routed_kinds(t):
    """J10."""
    d = t("part").select("p_partkey", F.upper("p_type").alias("kind"))
    table = d.sparkSession.createDataFrame([(a, b, i) for i, (a, b) in enumerate(_KINDS)], "kind_name string, category string, ord int")
    return joins.routed(d, table, "kind", "other").select("p_partkey", "category")


@query("SELECT DISTINCT d.doc_id FROM documents d WHERE doc_id % 2 = 0 AND EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND quality = 1) AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND toxic = 1)")
def pending_chunks(t):
    """Even documents with a good anchor that aren't done."""
    done = t("labels").filter("toxic = 1")
    return joins.pending(t("documents").select("doc_id"), done, "doc_id", t("labels").filter("quality = 1"), 0)


@query(
    """WITH r AS (SELECT user_id, event_type, value > 50 AS ok, event_type = 'click' AS def, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events)
SELECT user_id, count(*) FILTER (WHERE ok) / count(*) AS pass_rate, bool_and(ok) AS all_ok, coalesce(arg_max(ok, i) FILTER (WHERE NOT def), false) AS end_state FROM r GROUP BY 1"""
)
def result_metrics(t):
    """A user's events as evaluated forms, clicks as definitions."""
    form = F.when(F.col("event_type") == "click", "(def x 1)").otherwise("(f x)")
    e = t("events").groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_id", form.alias("form"), (F.col("value") > 50).alias("ok")))).alias("r"))
    return e.select("user_id", code.pass_rate(F.col("r")).alias("pass_rate"), code.all_ok(F.col("r")).alias("all_ok"), code.right_end_state(F.col("r")).alias("end_state"))


@query("SELECT doc_id, (2 + i * i)::BIGINT AS seen FROM (SELECT doc_id, doc_id % 5 AS i FROM documents)")
def forms_framed(t):
    """X106, Y14: forms framed for an evaluator, and its output read back."""
    forms = F.array(F.lit("(+ 1 1)"), F.lit("(* x x)"))
    script = code.evaluator_script(forms)
    out = F.concat(F.lit("@@form 0\n2\n@@form 1\n"), (F.col("doc_id") % 5 * (F.col("doc_id") % 5)).cast("string"), F.lit("\n"))
    read = code.evaluator_results(F.when(F.contains(script, F.lit("@@form 1")), out), forms)
    return t("documents").select("doc_id", F.aggregate(F.transform(read, lambda r: r["value"].cast("long")), F.lit(0).cast("long"), lambda a, x: a + x).alias("seen"))
