"""Queries on the model-backed steps with a scripted model, whose answers SQL can tell too."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import tasks
from millrace.plans import sql as S
from millrace.plans.records import query


def scripted(say):
    """A factory of a model that answers by `say`; texts that hold "fail" raise."""

    def factory():
        def call(texts):
            if any("fail" in t for t in texts):
                raise ValueError("scripted")
            return [say(t) for t in texts]

        return call

    return factory


_FAILING = "CASE WHEN doc_id % 5 = 0 THEN 'fail ' ELSE '' END || source"


def _prompt():
    return F.concat(F.when(F.col("doc_id") % 5 == 0, "fail ").otherwise(""), "source")


@query("SELECT doc_id, CASE WHEN doc_id % 5 > 0 THEN upper(source) END AS answer FROM documents")
def model_answers(t):
    """One call a row; failed ones are null and cost no other."""
    d = t("documents").select("doc_id", _prompt().alias("p"))
    return tasks.single_turn(d, F.col("p"), scripted(lambda x: x.upper()), wait=0).select("doc_id", "answer")


@query(
    """SELECT conv_id, length(string_agg(role || ': ' || text, chr(10) ORDER BY turn)) AS n FROM conversations WHERE NOT contains(text, 'fail') GROUP BY 1"""
)
def model_conversations(t):
    """E50."""
    c = t("conversations").filter(~F.contains("text", F.lit("fail"))).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("m"))
    return tasks.multi_turn(c, F.col("m"), scripted(lambda x: str(len(x)))).select("conv_id", F.col("answer").cast("long").alias("n"))


@query(
    """SELECT doc_id, CASE WHEN doc_id % 5 > 0 THEN 'do ' || source END AS prompt, CASE WHEN doc_id % 5 > 0 THEN '' END AS context, CASE WHEN doc_id % 5 > 0 THEN source || '|' || source ELSE 'Implement fail ' || source || '.|Test fail ' || source || '.' END AS tasks,
CASE WHEN doc_id % 5 > 0 THEN source ELSE 'read|change|verify' END AS steps, CASE WHEN doc_id % 5 > 0 THEN source ELSE 'neutral' END AS tone, 'none' AS mood FROM documents"""
)
def model_json(t):
    """JSON answers, in a fence or not, with fallbacks."""
    d = t("documents").select("doc_id", _prompt().alias("p"))
    d = tasks.prompt_of_message(d, "p", scripted(lambda x: '```json\n{"prompt": "do %s"}\n```' % x))
    d = tasks.tasks_of_nodes(d, "p", scripted(lambda x: 'Sure: ["%s", "%s"]' % (x, x)))
    d = tasks.plans(d, "p", scripted(lambda x: '{"steps": ["%s"]}' % x))
    d = tasks.analysis(d, "p", scripted(lambda x: '{"tone": "%s"}' % x), {"tone": "neutral", "mood": "none"})
    return d.select("doc_id", "prompt", "context", F.array_join("tasks", "|").alias("tasks"), F.array_join("steps", "|").alias("steps"), "tone", "mood")


def _checked(solution):
    return F.when(solution.isNotNull(), F.array(F.struct(F.lit("(f)").alias("form"), (F.length(solution) % 2 == 0).alias("ok")), F.struct(F.lit("(g)").alias("form"), F.lit(True).alias("ok"))))


@query("SELECT doc_id, length(source) % 2 = 0 AS whole FROM documents WHERE doc_id % 5 > 0")
def model_solutions(t):
    """Solutions at a pass rate of one half, and whether all passed."""
    d = tasks.verified_solutions(t("documents").select("doc_id", _prompt().alias("p")), "p", scripted(lambda x: x), _checked, 0.5)
    return d.select("doc_id", tasks.all_ok(F.col("results")).alias("whole"))


@query("SELECT doc_id, source || chr(10) || 'read' || chr(10) || 'change' || chr(10) || 'verify' || CASE WHEN length(source) % 2 = 0 THEN '' ELSE '!' END AS trace FROM (SELECT * FROM documents ORDER BY doc_id LIMIT 50) WHERE doc_id % 5 > 0")
def model_workflows(t):
    """Plan, trace and check of the first 50 tasks, a limit that is the feature."""
    d = t("documents").select("doc_id", _prompt().alias("p"))
    even = lambda x: x + "!" * ((len(x.split("\n")[0])) % 2)
    ok = lambda s: F.when(s.isNotNull(), F.array(F.struct(F.lit("(f)").alias("form"), F.lit(True).alias("ok"))))
    return tasks.first_workflows(d, "p", ["doc_id"], 50, scripted(lambda x: "no plan"), scripted(even), ok).select("doc_id", "trace")


@query(
    """SELECT doc_id, CASE WHEN doc_id % 5 > 0 AND length(source) = 4 THEN 'metal' WHEN contains(CASE WHEN doc_id % 5 = 0 THEN 'fail ' ELSE '' END || source, 'src1') THEN 'surface' ELSE 'other' END AS category FROM documents"""
)
def model_routes(t):
    """The model's category, or J10's."""
    d = t("documents").select("doc_id", _prompt().alias("kind"))
    table = d.sparkSession.createDataFrame([("src1", "surface", 0), ("steel", "metal", 1)], "kind_name string, category string, ord int")
    return tasks.routed_by_model(d, table, "kind", "other", scripted(lambda x: "metal" if len(x) == 4 else "unknown")).select("doc_id", "category")


@query(
    f"""SELECT doc_id, CASE WHEN doc_id % 5 > 0 THEN reverse(upper(source)) END AS neutral, CASE WHEN doc_id % 5 > 0 THEN 'In the first person' || chr(10) || chr(10) || source ELSE {_FAILING} END AS rewritten,
CASE WHEN doc_id % 5 > 0 THEN 1 END AS moves, CASE WHEN doc_id % 5 > 0 THEN [source] ELSE [] END AS features FROM documents"""
)
def model_rewrites(t):
    """E8, E18, E22, E24, E25, E33, E41, E46, E47, E48."""
    d = t("documents").select("doc_id", _prompt().alias("p"))
    d = tasks.neutralised(d, "p", scripted(lambda x: x.upper()), scripted(lambda x: x[::-1]))
    d = tasks.rewritten(d, "p", "In the first person", scripted(lambda x: x))
    d = tasks.skeletons(d, "p", scripted(lambda x: "[Claim] then"))
    d = tasks.features_of_files(d, "p", scripted(lambda x: [x]))
    return d.select("doc_id", "neutral", "rewritten", F.size("moves").alias("moves"), "features").withColumn("moves", F.when(F.col("doc_id") % 5 > 0, F.col("moves")))


@query(
    f"""WITH v AS (SELECT conv_id, turn, text, unnest(['first person', 'third person']) AS view FROM conversations WHERE NOT contains(text, 'fail')) SELECT conv_id, turn, view, md5(text) AS varied FROM v WHERE view = 'first person' AND {S.wc('text')} > 0"""
)
def model_perspectives(t):
    """Views by paragraph; the scripted third person loses its text, so F16 drops it."""
    c = t("conversations").filter(~F.contains("text", F.lit("fail")))
    out = tasks.perspectives(c, "text", ["first person", "third person"], scripted(lambda x: x.split("\n\n", 1)[1] if "first person:" in x[:30] else "lost " * 5000))
    return out.select("conv_id", "turn", "view", F.md5(F.col("varied").cast("binary")).alias("varied"))


@query(
    f"""SELECT conv_id, turn, unnest(CASE WHEN {S.wc('text')} >= 10 THEN ['standard', 'info_dropout', 'abstract'] ELSE ['standard'] END) AS variation_type, {S.wc('text')} AS word_count FROM conversations WHERE NOT contains(text, 'fail')"""
)
def model_pairs(t):
    """Neutral versions of each variation, as records."""
    c = t("conversations").filter(~F.contains("text", F.lit("fail"))).select(F.concat_ws("\x00", F.col("conv_id").cast("string"), F.col("turn").cast("string"), "text").alias("text"))
    out = tasks.paired(c, "text", scripted(lambda x: x[:20]))
    at = F.split("output", "\x00")
    return out.select(at[0].cast("long").alias("conv_id"), at[1].cast("long").alias("turn"), "variation_type", "word_count")


@query("SELECT conv_id, md5(string_agg(CASE WHEN contains(text, 'fail') THEN text ELSE 'Restyle' || chr(10) || chr(10) || text END, chr(10) || chr(10) ORDER BY turn)) AS text FROM conversations GROUP BY 1")
def model_in_turn(t):
    """Paragraph by paragraph, in order."""
    return tasks.in_turn(t("conversations"), "text", ["turn"], "conv_id", scripted(lambda x: x)).select("conv_id", F.md5(F.col("text").cast("binary")).alias("text"))
