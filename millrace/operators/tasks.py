"""What the model-backed steps do around their calls: prompts, parsing, validation, fallbacks.

Every step takes a factory of a callable(list of texts) -> list of answers, as in `models`; a call that fails is a null
answer, and each step says what becomes of that row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.scores import good_perspective, good_variation
from millrace.functions.text import bracket_moves, strip, word_count
from millrace.operators.code import all_ok, pass_rate
from millrace.operators.joins import routed
from millrace.operators.models import generated
from millrace.operators.sampling import variants

Factory = Callable[[], Callable[[list[str]], list]]
#: Characters of a text that a topic is told by.
SUMMARY = 200


def json_body(answer: Column | str) -> Column:
    """An answer without the fences of a code block, from its first brace or bracket to its last."""
    a = F.col(answer) if isinstance(answer, str) else answer
    return F.nullif(F.regexp_extract(a, r"(?s)([{\[].*[}\]])", 1), F.lit(""))


def single_turn(df: DataFrame, prompt: Column, factory: Factory, name: str = "answer", tries: int = 3, wait: float = 1.0) -> DataFrame:
    """One call a row, with retries; a blank answer is null."""
    out = generated(df, prompt, factory, name, tries=tries, wait=wait)
    return out.withColumn(name, F.when(strip(name) != "", strip(name)))


def multi_turn(df: DataFrame, turns: Column, factory: Factory, name: str = "answer", **retry) -> DataFrame:
    """Turns is an array of (role, text), told in order; an empty one isn't asked about and has a null answer."""
    told = F.array_join(F.transform(turns, lambda m: F.concat(m["role"], F.lit(": "), m["text"])), "\n")
    asked = single_turn(df.withColumn("_size", F.size(turns)), told, factory, name, **retry)
    return asked.withColumn(name, F.when(F.col("_size") > 0, F.col(name))).drop("_size")


def features_of_files(df: DataFrame, text: str, factory: Factory, files: int = 3) -> DataFrame:
    """A call for each `files` files; a file without an answer has no features."""
    out = generated(df, F.col(text), factory, "features", batch=files, kind="array<string>")
    return out.withColumn("features", F.coalesce("features", F.array().cast("array<string>")))


def prompt_of_message(df: DataFrame, message: str, factory: Factory) -> DataFrame:
    """`prompt` and `context` from a JSON answer, both null unless it has a prompt."""
    out = single_turn(df, F.col(message), factory, "_a")
    return out.withColumn("_j", F.from_json(json_body("_a"), "prompt string, context string")).withColumns(
        {"prompt": F.when(strip("_j.prompt") != "", F.col("_j.prompt")), "context": F.when(strip("_j.prompt") != "", F.coalesce("_j.context", F.lit("")))}
    ).drop("_a", "_j")


def tasks_of_nodes(df: DataFrame, node: str, factory: Factory, fallback: Sequence[str] = ("Implement {node}.", "Test {node}.")) -> DataFrame:
    """An array of tasks from a JSON answer; without one the fallback's templates."""
    own = F.array(*[F.replace(F.lit(t), F.lit("{node}"), F.col(node)) for t in fallback])
    out = single_turn(df, F.col(node), factory, "_a").withColumn("tasks", F.from_json(json_body("_a"), "array<string>"))
    return out.withColumn("tasks", F.when(F.size("tasks") > 0, F.col("tasks")).otherwise(own)).drop("_a")


def verified_solutions(df: DataFrame, task: str, factory: Factory, check: Callable[[Column], Column], least: float = 1.0) -> DataFrame:
    """Solutions whose results (check: solution -> array of form, ok) pass at the least rate; a missing solution fails."""
    out = single_turn(df, F.col(task), factory, "solution").withColumn("results", check(F.col("solution")))
    return out.filter(F.col("solution").isNotNull() & (F.size("results") > 0) & (pass_rate(F.col("results")) >= least))


def plans(df: DataFrame, task: str, factory: Factory, fallback: Sequence[str] = ("read", "change", "verify")) -> DataFrame:
    """`steps` from a JSON answer, the fallback's without one."""
    out = single_turn(df, F.col(task), factory, "_a").withColumn("steps", F.from_json(json_body("_a"), "steps array<string>")["steps"])
    return out.withColumn("steps", F.when(F.size("steps") > 0, F.col("steps")).otherwise(F.array(*[F.lit(s) for s in fallback]))).drop("_a")


def workflows(df: DataFrame, task: str, plan: Factory, trace: Factory, check: Callable[[Column], Column]) -> DataFrame:
    """Plan, then a trace of the plan, then its results; the trace is null unless every result is right."""
    planned = plans(df, task, plan)
    out = single_turn(planned, F.concat_ws("\n", F.col(task), F.array_join("steps", "\n")), trace, "trace")
    return out.withColumn("trace", F.when(all_ok(check(F.col("trace"))), F.col("trace")))


def first_workflows(df: DataFrame, task: str, order: Sequence[str], n: int, plan: Factory, trace: Factory, check: Callable[[Column], Column]) -> DataFrame:
    """E12 for the first n tasks, those that fail left out."""
    return workflows(df.orderBy(*order).limit(n), task, plan, trace, check).filter("trace is not null")


def routed_by_model(df: DataFrame, table: DataFrame, kind: str, default: str, factory: Factory) -> DataFrame:
    """The model's category if the table knows it, else J10's."""
    known = F.broadcast(table.select(F.col("category").alias("_k")).distinct())
    asked = single_turn(df, F.col(kind), factory, "_a").join(known, F.col("_a") == F.col("_k"), "left")
    return routed(asked, table, kind, default).withColumn("category", F.coalesce("_k", "category")).drop("_a", "_k")


def analysis(df: DataFrame, text: str, factory: Factory, fallback: dict[str, str]) -> DataFrame:
    """The fallback's fields from a JSON answer, each with its default."""
    out = single_turn(df, F.col(text), factory, "_a").withColumn("_j", F.from_json(json_body("_a"), ", ".join(f"`{k}` string" for k in fallback)))
    return out.withColumns({k: F.coalesce(F.col(f"_j.{k}"), F.lit(v)) for k, v in fallback.items()}).drop("_a", "_j")


def skeletons(df: DataFrame, text: str, factory: Factory, letters: int = 1500) -> DataFrame:
    """E18 for each chunk; `moves` is null where the call failed."""
    out = single_turn(df, F.substring(text, 1, letters), factory, "_a")
    return out.withColumn("moves", F.when(F.col("_a").isNotNull(), bracket_moves("_a"))).drop("_a")


def neutralised(df: DataFrame, text: str, away: Factory, back: Factory) -> DataFrame:
    """There and back through another form; null if either call fails. Rows keep their place."""
    there = single_turn(df, F.col(text), away, "_there")
    out = single_turn(there, F.coalesce("_there", F.lit("")), back, "neutral")
    return out.withColumn("neutral", F.when(F.col("_there").isNotNull(), F.col("neutral"))).drop("_there")


def rewritten(df: DataFrame, text: str, instruction: str, factory: Factory, name: str = "rewritten", keep: bool = True) -> DataFrame:
    """A rewrite by an instruction (expansion, abstraction, subject alignment, first person, styling); the text itself where it failed, unless keep is false."""
    out = single_turn(df, F.concat(F.lit(instruction + "\n\n"), F.col(text)), factory, name)
    return out.withColumn(name, F.coalesce(name, F.col(text))) if keep else out


def perspectives(df: DataFrame, text: str, views: Sequence[str], factory: Factory, validated: bool = True) -> DataFrame:
    """A row for each paragraph and view; with `validated` those that F16 passes."""
    fan = df.withColumn("view", F.explode(F.array(*[F.lit(v) for v in views])))
    out = single_turn(fan, F.concat(F.lit("Rewrite as "), F.col("view"), F.lit(":\n\n"), F.col(text)), factory, "varied")
    return out.filter(F.col("varied").isNotNull() & (good_perspective(text, "varied") if validated else F.lit(True)))


def topic_swapped(df: DataFrame, text: str, topic: str, factory: Factory, validated: bool = True) -> DataFrame:
    """A rewrite on the topic of another text, told by its first 200 characters; null if F15 fails."""
    prompt = F.concat(F.lit("Topic: "), F.substring(topic, 1, SUMMARY), F.lit("\n\n"), F.col(text))
    out = single_turn(df, prompt, factory, "varied")
    return out.withColumn("varied", F.when(good_variation(text, "varied"), F.col("varied"))) if validated else out


def paired(df: DataFrame, text: str, factory: Factory, kinds: Sequence[str] = ("standard", "info_dropout", "abstract"), least_words: int = 10) -> DataFrame:
    """For each variation of a passage its neutral version, as a record; failures go."""
    fan = variants(df, text, kinds, least_words)
    out = single_turn(fan, F.concat(F.col("variation_type"), F.lit("\n"), F.col(text)), factory, "neutral").filter("neutral is not null")
    return out.select("variation_type", F.col("neutral").alias("instruction"), F.col(text).alias("output"), word_count(text).alias("word_count"))


def in_turn(df: DataFrame, text: str, order: Sequence[str], within: str, factory: Factory) -> DataFrame:
    """Each paragraph by itself (what came before isn't read), joined in order by document; failed ones stay as they were."""
    out = rewritten(df, text, "Restyle", factory, "_new")
    parts = out.groupBy(within).agg(F.array_sort(F.collect_list(F.struct(*order, "_new"))).alias("_p"))
    return parts.select(within, F.array_join(F.transform("_p", lambda p: p["_new"]), "\n\n").alias("text"))
