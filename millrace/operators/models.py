"""Model plug-ins: any callable over a batch of texts, run in Arrow batches with retries; failures are null rows.

No model is bundled. What the reference models do elsewhere is a callable given here; each worker makes it
once. Rows keep their keys, so order and resume need nothing else.
"""

from __future__ import annotations

import hashlib
import re
import subprocess
import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import lexicons as L
from millrace.functions.scores import good_perspective, good_variation, lexical_bleed
from millrace.functions.text import bracket_moves, sentences
from millrace.operators.code import _blocks, right_end_state

#: Characters of answers that go on in one piece.
LETTERS = 1 << 20

#: name -> factory of a callable(list of texts) -> list of answers.
REGISTRY: dict[str, Callable[[], Callable[[list[str]], list]]] = {}


def register(name: str):
    """Decorator of a factory."""

    def add(factory):
        REGISTRY[name] = factory
        return factory

    return add


class Retryable(Exception):
    """What a callable raises for a rate limit or a timeout."""


def with_retry(call: Callable, texts: list[str], tries: int = 3, wait: float = 1.0) -> list:
    """Exponential waits on Retryable; other errors rise."""
    for i in range(tries):
        try:
            return call(texts)
        except Retryable:
            if i == tries - 1:
                raise
            time.sleep(wait * 2**i)
    return []


def generated(df: DataFrame, prompt: Column, factory: Callable[[], Callable[[list[str]], list]], name: str = "answer", batch: int = 16, tries: int = 3, wait: float = 1.0, kind: str = "string") -> DataFrame:
    """Df with the model's answer to the prompt, null where it failed; `tasks` has the steps built on it.

    A batch that fails is asked again row by row, so that one bad row costs itself only. Answers go on in pieces of
    about LETTERS characters, so what a worker holds of them doesn't grow with Spark's batches.
    """
    most = LETTERS

    @F.pandas_udf(kind)
    def ask(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        call = factory()
        for part in parts:
            out: list = []
            size = 0
            for lo in range(0, len(part), batch):
                start = len(out)
                texts = part.iloc[lo : lo + batch].tolist()
                try:
                    out += with_retry(call, texts, tries, wait)
                except Exception:
                    for t in texts:
                        try:
                            out += with_retry(call, [t], tries, wait)
                        except Exception:
                            out.append(None)
                size += sum(len(x) for x in out[start:] if isinstance(x, str)) + len(out) - start
                if size > most:
                    yield pd.Series(out, dtype=object)
                    out, size = [], 0
            if out or not len(part):
                yield pd.Series(out, dtype=object)

    return df.withColumn(name, ask(prompt))


def embedded(df: DataFrame, text: Column, factory: Callable, name: str = "embedding", letters: int = 512, batch: int = 64) -> DataFrame:
    """Vectors of the first letters of each text."""
    return generated(df, F.substring(text, 1, letters), factory, name, batch, kind="array<float>")


def extracted(df: DataFrame, text: Column, factory: Callable, name: str = "features") -> DataFrame:
    """Lists from a hook."""
    return generated(df, text, factory, name, kind="array<string>")


def checked_variation(df: DataFrame, text: str, factory: Callable, attempts: int = 2, same_view: bool = False) -> DataFrame:
    """A rewrite that passes F15 (or F16); up to `attempts` tries, else null."""
    ok = good_perspective if same_view else good_variation
    out = df.withColumn("varied", F.lit(None).cast("string"))
    for i in range(attempts):
        out = generated(out, F.concat_ws("\n", F.lit(f"attempt {i + 1}"), F.col(text)), factory, "_new")
        out = out.withColumn("varied", F.coalesce("varied", F.when(ok(text, "_new"), F.col("_new")))).drop("_new")
    return out


def neutral_pairs(df: DataFrame, styled: str, factory: Callable, most: float = 0.5) -> DataFrame:
    """Neutral versions, those that keep too many distinctive words dropped."""
    return generated(df, F.col(styled), factory, "neutral").filter(F.col("neutral").isNotNull() & (lexical_bleed("neutral", styled) < most))


def moves_or_default(df: DataFrame, text: str, factory: Callable) -> DataFrame:
    """The model's bracketed moves."""
    return generated(df, F.substring(text, 1, 1500), factory, "_m").withColumn("moves", bracket_moves(F.coalesce("_m", F.lit("")))).drop("_m")


def corrected_or_same(df: DataFrame, text: str, factory: Callable) -> DataFrame:
    """The model's correction, the text itself where there is none."""
    return generated(df, F.col(text), factory, "_c").withColumn("corrected", F.coalesce(F.nullif(F.trim("_c"), F.lit("")), F.col(text))).drop("_c")


def entailment(df: DataFrame, a: Column, b: Column, factory: Callable | None) -> DataFrame:
    """(forward, backward); (0.5, 0.5) without a model."""
    if factory is None:
        return df.withColumn("entailment", F.struct(F.lit(0.5).alias("forward"), F.lit(0.5).alias("backward")))
    pair = F.concat_ws("\x1f", F.substring(a, 1, 1500), F.substring(b, 1, 1500))
    return generated(df, pair, factory, "entailment", kind="struct<forward:double,backward:double>")


def evolve(tree: DataFrame, factory: Callable, rounds: int = 2, most: int = 8) -> DataFrame:
    """Nodes (name, parent) and what the model adds to each of the `most` first parents; names that exist are skipped."""
    for _ in range(rounds):
        parents = tree.orderBy("name").limit(most)
        new = generated(parents, F.col("name"), factory, "kids", kind="array<string>").select(F.explode("kids").alias("name"), F.col("name").alias("parent"))
        new = new.toDF("name", "parent").dropDuplicates(["name"]).join(tree.select("name"), "name", "left_anti")
        tree = tree.unionByName(new, allowMissingColumns=True)
    return tree


def evaluated(df: DataFrame, solution: str, command: Sequence[str] | None = None, timeout: float = 30.0) -> DataFrame:
    """Forms of a trace and their results from an interpreter; without a command nothing is run and results are null."""

    @F.pandas_udf("array<struct<form:string,value:string,ok:boolean,error:string>>")
    def run(col: pd.Series) -> pd.Series:
        def one(text):
            if command is None:
                return None
            out = []
            for b in _blocks(text):
                try:
                    p = subprocess.run([*command, b["form"]], capture_output=True, text=True, timeout=timeout, check=False)
                    out.append({"form": b["form"], "value": p.stdout.strip(), "ok": p.returncode == 0, "error": p.stderr.strip() or None})
                except subprocess.TimeoutExpired:
                    out.append({"form": b["form"], "value": "", "ok": False, "error": "timeout"})
            return out

        return col.map(one)

    out = df.withColumn("results", run(F.col(solution)))
    return out.withColumn("reaches_end", F.when(F.col("results").isNotNull(), right_end_state(F.col("results"))))


def usage(df: DataFrame, prompt: Column, answer: Column) -> DataFrame:
    """Calls and tokens, four characters each."""
    i, o = F.sum(F.ceil(F.length(prompt) / 4)), F.sum(F.ceil(F.length(answer) / 4))
    return df.agg(F.count(F.lit(1)).alias("calls"), i.alias("input_tokens"), o.alias("output_tokens"), (i + o).alias("total_tokens"))


def _u(seed: int, key: str, i: int) -> float:
    return int(hashlib.md5(f"{seed}:{key}:{i}".encode()).hexdigest()[:8], 16) / 16**8


#: Words and what stands for them (fixed values).
SYNONYMS = {
    "big": ["large", "huge", "great"], "small": ["little", "tiny", "minor"], "old": ["ancient", "aged", "elderly"], "new": ["fresh", "recent", "modern"], "good": ["fine", "nice", "great"],
    "bad": ["poor", "awful", "terrible"], "house": ["building", "home", "dwelling"], "said": ["stated", "spoke", "remarked"], "walked": ["went", "moved", "traveled"],
    "looked": ["appeared", "seemed", "gazed"], "very": ["quite", "rather", "extremely"], "really": ["truly", "actually", "indeed"],
}


def perturbed(text: Column, rate: float = 0.08, bands: Sequence[tuple[str, float]] = (("synonym", 0.4), ("drop", 0.3), ("swap", 0.3)), seed: int = 42) -> Column:
    """X50-X52, X100, X101: words changed at `rate` by hash of text and place; trailing punctuation stays with its place."""

    @F.pandas_udf("string")
    def run(col: pd.Series) -> pd.Series:
        def one(t):
            if t is None:
                return None
            ws, out, i = t.split(), [], 0
            key = hashlib.md5(t.encode()).hexdigest()
            while i < len(ws):
                w = ws[i]
                if _u(seed, key, 2 * i) < rate:
                    x, kind = _u(seed, key, 2 * i + 1), ""
                    for kind, share in bands:
                        if x < share:
                            break
                        x -= share
                    core = w.rstrip(".,!?;:")
                    if kind == "synonym" and core.lower() in SYNONYMS:
                        options = SYNONYMS[core.lower()]
                        w = options[int(_u(seed, core, i) * len(options))] + w[len(core) :]
                    elif kind == "drop" and core.lower() in L.STOP_WORDS:
                        i += 1
                        continue
                    elif kind == "swap" and i + 1 < len(ws):
                        out.append(ws[i + 1])
                        i += 1
                    elif kind == "double":
                        out.append(w)
                    elif kind == "case":
                        w = w.swapcase()
                out.append(w)
                i += 1
            return " ".join(out)

        return col.map(one)

    return run(text)


HEAVY = (("synonym", 0.30), ("drop", 0.20), ("swap", 0.25), ("double", 0.15), ("case", 0.10))


def masked(text: Column) -> Column:
    """(text, entities): capitalised words inside sentences as __ENTn__ and a map back."""

    @F.pandas_udf("struct<text:string,entities:map<string,string>>")
    def run(col: pd.Series) -> pd.DataFrame:
        rows = []
        for t in col:
            found: dict = {}

            def name(m, found=found):
                return found.setdefault(m[0], f"__ENT{len(found)}__")

            rows.append((re.sub(r"(?<=[a-z,;] )[A-Z][\w]+(?: [A-Z][\w]+)*", name, t or ""), {v: k for k, v in found.items()}))
        return pd.DataFrame(rows, columns=["text", "entities"])

    return run(text)


def split_long(text: Column, most: int = 25, least: int = 15) -> Column:
    """Sentences over `most` words cut at a comma and conjunction with `least` words before it."""

    @F.pandas_udf("string")
    def run(col: pd.Series) -> pd.Series:
        def one(xs):
            out = []
            for s in () if xs is None else xs:
                while len(s.split()) > most:
                    cut = next((m for m in re.finditer(r", (?:and|but|or|so|yet|while|which) ", s) if len(s[: m.start()].split()) >= least), None)
                    if not cut:
                        break
                    out.append(s[: cut.start()] + ".")
                    s = s[cut.end() :]
                    s = s[:1].upper() + s[1:]
                out.append(s)
            return " ".join(out)

        return col.map(one)

    return run(sentences(text))


REFERENCES = "array<struct<marker:string,ref_id:string,attached_to:string,context:string,position:int>>"
_REF = re.compile(r"\[\^(\d+)\]|\[(\d+(?:[,\-–]\s*\d+)*)\]")


def references(text: Column) -> Column:
    """Markers with the phrase they hang on, their context of 50 characters either way and their place."""

    @F.pandas_udf(REFERENCES)
    def run(col: pd.Series) -> pd.Series:
        def one(t):
            out = []
            for m in _REF.finditer(t or ""):
                before = t[: m.start()].rstrip()
                phrase = re.search(r"[\"“]([^\"“”]+)[\"”]$|\(([^()]+)\)$|([A-Z]\w+ [A-Z]\w+)$|([\w'-]+)[.,;:!?]*$", before)
                word = next((g for g in phrase.groups() if g), "") if phrase else ""
                out.append({"marker": m[0], "ref_id": m[1] or m[2], "attached_to": word, "context": t[max(0, m.start() - 50) : m.end() + 50], "position": m.start()})
            return out

        return col.map(one)

    return run(text)


def reinjected(output: Column, refs: Column) -> Column:
    """(text, dropped): markers put back after their phrase, else its last word, else a word of its stem; others dropped."""

    @F.pandas_udf("struct<text:string,dropped:array<string>>")
    def run(col: pd.Series, refs: pd.Series) -> pd.DataFrame:
        rows = []
        for t, rs in zip(col, refs, strict=True):
            t, lost = t or "", []
            for r in () if rs is None else rs:
                phrase, near = r["attached_to"], set(re.findall(r"\w{4,}", r["context"].lower()))
                tries = [re.escape(phrase), re.escape(phrase.split()[-1]) if phrase.split() else None, re.escape(phrase[:5]) + r"\w{0,4}" if len(phrase) >= 5 else None]
                spot = None
                for p in filter(None, tries):
                    found = [m for m in re.finditer(rf"(?i)\b{p}\b", t)]
                    if found:
                        score = lambda m: len(near & set(re.findall(r"\w{4,}", t[max(0, m.start() - 50) : m.end() + 50].lower())))  # noqa: B023, E731
                        spot = max(found, key=lambda m: (score(m), -m.start())).end()
                        break
                if spot is None or not phrase:
                    lost.append(r["marker"])
                else:
                    t = t[:spot] + r["marker"] + t[spot:]
            rows.append((t, lost))
        return pd.DataFrame(rows, columns=["text", "dropped"])

    return run(output, refs)


def phrases_replaced(text: Column, table: dict[str, str]) -> Column:
    """Phrases by their replacements, the longest first, in the case of what they replace."""
    order = sorted(table, key=lambda p: (-len(p), p))

    @F.pandas_udf("string")
    def run(col: pd.Series) -> pd.Series:
        if not order:
            return col
        pattern = re.compile("|".join(rf"\b{re.escape(p)}\b" for p in order), re.I)

        def fit(m):
            new = table[m[0].lower()]
            return new.upper() if m[0].isupper() and len(m[0]) > 1 else new[:1].upper() + new[1:] if m[0][:1].isupper() else new

        return col.map(lambda t: None if t is None else pattern.sub(fit, t))

    return run(text)


