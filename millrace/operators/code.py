"""Code changes: diffs, syntax, forms, evaluation traces and pattern flags.

What needs a state machine over characters or lines runs in Arrow-batched functions; the rest are columns.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import lexicons as L
from millrace.functions.scores import any_of, hits, relevance
from millrace.functions.text import _c, let, strip
from millrace.operators.joins import interval_overlap
from millrace.operators.records import _ends, changed_lines

HUNK = r"^@@\s+-(\d+)(?:,(\d+))?\s+\+(\d+)(?:,(\d+))?\s+@@"
FILES = "array<struct<path:string,change_type:string,old_path:string,hunks:array<struct<old_start:int,old_count:int,new_start:int,new_count:int,lines:array<string>>>>>"


def _diff_files(diff: str | None) -> list:
    """One part for each header; inside, names, kind and hunks are found by pattern."""
    out = []
    for part in re.split(r"(?m)^(?=diff --git )", diff or "")[1:]:
        head, *rest = re.split(r"(?m)^(?=@@ )", part)
        names = re.match(r"diff --git a/(.*?) b/(.*)", head)
        if not names:
            continue
        kind = "added" if re.search(r"(?m)^new file|^--- /dev/null", head) else "deleted" if re.search(r"(?m)^deleted file|^\+\+\+ /dev/null", head) else "modified"
        old = re.search(r"(?m)^rename from (.*)$", head)
        hunks = []
        for h in rest:
            first, *lines = h.split("\n")
            m = re.match(HUNK, first)
            if m:
                a, b, c, d = (1 if x is None else int(x) for x in m.groups())
                hunks.append({"old_start": a, "old_count": b, "new_start": c, "new_count": d, "lines": [x for x in lines if x[:1] in ("+", "-", " ")]})
        out.append({"path": names[2].strip(), "change_type": "renamed" if old else kind, "old_path": old[1] if old else None, "hunks": hunks})
    return out


def parse_diff(diff: Column | str) -> Column:
    """Files of a unified diff with kind, old name and hunks; a missing count is 1, malformed hunks go."""

    @F.pandas_udf(FILES)
    def parse(col: pd.Series) -> pd.Series:
        return col.map(_diff_files)

    return parse(_c(diff))


_LEX = re.compile(r'"(?:[^"\\]|\\.)*(?:"|\Z)|;[^\n]*|\\(?:.|\Z)|[()\[\]{}]', re.S)


def _forms(content: str | None) -> list:
    """Outermost bracketed forms by lines: tokens that hide brackets are skipped by one pattern."""
    text = content or ""
    ends = [m.start() for m in re.finditer("\n", text)]
    from bisect import bisect_left

    depth, start, spans = 0, None, []
    for m in _LEX.finditer(text):
        if m[0] in "([{":
            if not depth:
                start = m.start()
            depth += 1
        elif m[0] in ")]}":
            depth = max(0, depth - 1)
            if not depth and start is not None:
                spans.append((bisect_left(ends, start) + 1, bisect_left(ends, m.start()) + 1))
                start = None
    if start is not None:
        spans.append((bisect_left(ends, start) + 1, len(ends) + 1))
    lines = text.split("\n")
    return [{"start": a, "end": b, "text": "\n".join(lines[a - 1 : b])} for a, b in spans]


def top_level_forms(content: Column | str) -> Column:
    """Lines (from 1, both inclusive) and text of the outermost forms."""

    @F.pandas_udf("array<struct<start:int,end:int,text:string>>")
    def find(col: pd.Series) -> pd.Series:
        return col.map(_forms)

    return find(_c(content))


def changed_regions(before: DataFrame, hunks: DataFrame) -> DataFrame:
    """Before (id, path, content), hunks (id, path, old_start, old_end) -> (id, path, body).

    The forms that meet a changed range, and the namespace form, with a mark where they aren't next to
    each other; the whole content where none does.
    """
    forms = before.select("id", "path", F.explode(top_level_forms("content")).alias("f")).select("id", "path", F.col("f.start").alias("s"), F.col("f.end").alias("e"), F.col("f.text").alias("t"))
    hit = interval_overlap(forms, hunks, ["id", "path"], "s", "e", "old_start", "old_end").select("id", "path", "s", "e", "t")
    spaces = forms.filter(F.ltrim("t").startswith("(ns ")).join(hunks.select("id", "path").distinct(), ["id", "path"], "left_semi").select("id", "path", "s", "e", "t")
    kept = hit.unionAll(spaces).distinct().groupBy("id", "path").agg(F.array_sort(F.collect_list(F.struct("s", "e", "t"))).alias("k"))
    parts = F.transform("k", lambda f, i: F.when((i > 0) & (f["s"] > F.try_element_at("k", i)["e"] + 1), F.concat(F.lit(";; ...\n"), f["t"])).otherwise(f["t"]))
    return before.join(kept, ["id", "path"], "left").select("id", "path", F.coalesce(F.array_join(parts, "\n"), "content").alias("body"))


def syntax_errors(code: Column | str) -> Column:
    """Unbalanced round brackets, with lines. Quotes open and close strings inside comments too."""

    def check(text: str | None) -> list:
        # Strings end at the next unescaped quote wherever it stands, so they are cut out first; then comments.
        bare = re.sub(r'"(?:[^"\\]|\\.)*(?:"|\Z)', lambda m: "\n" * m[0].count("\n"), text or "", flags=re.S)
        bare = re.sub(r";[^\n]*", "", bare)
        depth, out = 0, []
        for i, line in enumerate(bare.split("\n"), 1):
            for ch in re.findall(r"[()]", line):
                depth += 1 if ch == "(" else -1
                if depth < 0:
                    out.append(f"Unmatched closing parenthesis at line {i}")
                    depth = 0
        return out + ([f"Unmatched opening parenthesis: {depth} unclosed"] if depth else [])

    @F.pandas_udf("array<string>")
    def run(col: pd.Series) -> pd.Series:
        return col.map(check)

    return run(_c(code))


def diff_errors(diff: Column | str) -> Column:
    """X19."""
    d = F.coalesce(_c(diff), F.lit(""))
    lines = F.split(d, "\n")
    bad = F.filter(F.transform(lines, lambda s, i: F.when(s.startswith("@@") & ~s.rlike(HUNK), F.concat(F.lit("Malformed hunk header at line "), (i + 1).cast("string"), F.lit(": "), F.substring(s, 1, 60)))), lambda s: s.isNotNull())
    found = F.array_compact(
        F.array(
            F.when(~F.contains(d, F.lit("diff --git")), "Missing diff --git header"),
            F.when(~F.contains(d, F.lit("@@")), "Missing hunk header (@@ -line,count +line,count @@)"),
            F.when(~(F.contains(d, F.lit("-")) | F.contains(d, F.lit("+"))), "No changed lines found (+/- lines)"),
        )
    )
    last = F.array_compact(F.array(F.when(changed_lines(d) == 0, "Diff contains no changed lines (only context)")))
    return F.when(strip(d) == "", F.array(F.lit("Empty diff"))).otherwise(F.concat(found, bad, last))


def code_blocks(text: Column | str) -> Column:
    """The forms of eval comments, then fenced blocks."""
    evals = F.filter(F.transform(F.regexp_extract_all(_c(text), F.lit(r"(?m)^\s*;; eval:(.*)$"), F.lit(1)), strip), lambda s: s != "")
    fences = F.regexp_extract_all(_c(text), F.lit(r"(?ms)^\s*```clojure[^\n]*\n(.*?)^\s*```\s*$"), F.lit(1))
    return F.concat(evals, F.transform(fences, lambda s: F.regexp_replace(s, r"\n\z", "")))


def validated(df: DataFrame, instruction: str = "instruction", output: str = "output", least: float = 0.4) -> DataFrame:
    """0.3 instruction + 0.3 syntax + 0.4 diff, rounded half to even, valid from `least`."""
    out = df.withColumn("instruction_score", relevance(instruction))
    out = out.withColumn("syntax_errors", syntax_errors(F.array_join(code_blocks(F.coalesce(F.col(output), F.lit(""))), "\n"))).withColumn("diff_errors", diff_errors(output))
    out = out.withColumn("syntax_score", F.when(F.size("syntax_errors") == 0, 0.5).otherwise(0.0)).withColumn("diff_score", F.when(F.size("diff_errors") == 0, 0.5).otherwise(0.0))
    total = F.bround(F.col("instruction_score") * 0.3 + F.col("syntax_score") * 0.3 + F.col("diff_score") * 0.4, 2)
    return out.withColumn("total_score", total).withColumn("is_valid", total >= least)


def validation_summary(scored: DataFrame) -> DataFrame:
    """A12, S6."""
    return scored.agg(
        F.count(F.lit(1)).alias("total"), F.count_if("is_valid").alias("valid"), F.count_if(~F.col("is_valid")).alias("invalid"), F.bround(F.avg("total_score"), 2).alias("avg_score")
    )


def pattern_flags(diff: Column | str, files: Column | str) -> Column:
    """The names of the patterns of a diff, none without a source file."""
    own = F.filter(_c(files), lambda f: _ends(f, L.CODE_EXTENSIONS))
    named = lambda keys: F.exists(own, lambda f: any_of(F.lower(f), keys))
    data = F.exists(own, lambda f: _ends(f, L.DATA_EXTENSIONS))
    found = lambda d, effects: F.array_compact(
        F.array(
            F.when(~effects & ~data & any_of(d, L.STRUCTURE_FORMS), "pure-refactor"),
            F.when((hits(d, L.CONCURRENCY_FORMS) >= 2) | (F.contains(d, F.lit("atom")) & F.contains(d, F.lit("swap!"))), "state-machine"),
            F.when(effects & named(L.EFFECT_FILES) & ~named(L.CORE_FILES), "side-effect-isolation"),
            F.when(any_of(d, L.MACRO_FORMS), "macro"), F.when(any_of(d, L.PROTOCOL_FORMS), "protocol"), F.when(any_of(d, L.SPEC_FORMS), "spec"),
            F.when(any_of(d, L.ASYNC_FORMS), "async"), F.when(any_of(d, L.MULTIMETHOD_FORMS), "multimethod"),
        )
    )
    # The lower-case diff, and whether it has effects, are computed once a row.
    flags = let(F.lower(F.coalesce(_c(diff), F.lit(""))), lambda d: let(any_of(d, L.SIDE_EFFECT_FORMS), lambda effects: found(d, effects)))
    return F.when(F.size(own) > 0, flags).otherwise(F.array().cast("array<string>"))


def with_patterns(df: DataFrame, wanted: list[str], patterns: str = "patterns") -> DataFrame:
    """rows of any wanted pattern."""
    return df.filter(F.arrays_overlap(patterns, F.array(*[F.lit(w) for w in wanted])))


def is_definition(form: Column | str) -> Column:
    """X25."""
    inner = F.ltrim(F.regexp_replace(F.regexp_replace(_c(form), r"^\s+", ""), r"^\(+\s*", ""))
    out = F.lit(False)
    for p in L.DEFINITION_FORMS:
        out = out | inner.startswith(p)
    return out


_MARK = re.compile(r"^\s*;;+\s*(eval|result|apply):\s?(.*)$")
_COMMENT = re.compile(r"^\s*;;+\s?(.*)$")


def _blocks(text: str | None) -> list:
    """Runs of comment lines, each cut at its marks; a form is an eval mark with what follows it up to the next."""
    out: list = []
    held = None
    for i, line in enumerate((text or "").split("\n")):
        mark, note = _MARK.match(line), _COMMENT.match(line)
        if mark and mark[1] == "eval":
            held = {"form": [mark[2]] if mark[2].strip() else [], "eval_start": i, "result_start": None, "result_end": None}
            out.append(held)
        elif mark and mark[1] == "result" and held and held["result_start"] is None:
            held["result_start"] = held["result_end"] = i
        elif note and not mark and held:
            if held["result_start"] is None:
                held["form"].append(note[1])
            else:
                held["result_end"] = i
        else:
            held = None
    return [b | {"form": "\n".join(b["form"]).strip()} for b in out]


BLOCKS = "array<struct<form:string,eval_start:int,result_start:int,result_end:int>>"


def eval_blocks(solution: Column | str) -> Column:
    """X23."""

    @F.pandas_udf(BLOCKS)
    def run(col: pd.Series) -> pd.Series:
        return col.map(_blocks)

    return run(_c(solution))


def grounded_trace(solution: Column | str, results: Column | str) -> Column:
    """Result lines rewritten from the results, in order of their forms."""

    @F.pandas_udf("string")
    def run(col: pd.Series, res: pd.Series) -> pd.Series:
        def one(text, rs):
            lines = (text or "").split("\n")
            for b, r in reversed(list(zip(_blocks(text), () if rs is None else rs, strict=False))):
                new = [";; result: " + str(r)]
                if b["result_start"] is None:
                    at = b["eval_start"] + max(1, b["form"].count("\n") + 1)
                    lines[at:at] = new
                else:
                    lines[b["result_start"] : b["result_end"] + 1] = new
            return "\n".join(lines)

        return pd.Series([one(t, r) for t, r in zip(col, res, strict=True)])

    return run(_c(solution), _c(results))


def pass_rate(results: Column) -> Column:
    """Of results with `ok`; 0 for none."""
    return F.coalesce(F.try_divide(F.size(F.filter(results, lambda r: r["ok"])), F.size(results)), F.lit(0.0))


def all_ok(results: Column) -> Column:
    """A53."""
    return (F.size(results) > 0) & F.forall(results, lambda r: r["ok"])


def right_end_state(results: Column) -> Column:
    """The last result that is no definition is ok."""
    demos = F.filter(results, lambda r: ~is_definition(r["form"]))
    return F.coalesce(F.try_element_at(demos, F.lit(-1))["ok"], F.lit(False))


def evaluator_script(forms: Column | str) -> Column:
    """X106: each form framed, so that results can be told apart."""
    return F.array_join(F.transform(_c(forms), lambda f, i: F.concat(F.lit('(println "@@form '), i.cast("string"), F.lit('")\n'), f)), "\n")


def evaluator_results(stdout: Column | str, forms: Column | str) -> Column:
    """Per form the output after its frame; none: "no output"."""
    parts = F.map_from_entries(
        F.transform(F.filter(F.split(_c(stdout), r"@@form "), lambda s: s.rlike(r"^\d+\n")), lambda s: F.struct(F.split_part(s, F.lit("\n"), F.lit(1)), strip(F.regexp_replace(s, r"^\d+\n", ""))))
    )
    return F.transform(_c(forms), lambda f, i: F.struct(f.alias("form"), F.coalesce(F.nullif(F.try_element_at(parts, i.cast("string")), F.lit("")), F.lit("no output")).alias("value")))


def unescaped(payload: Column | str) -> Column:
    """A JSON string's text, or the payload without quotes."""
    p = _c(payload)
    return F.coalesce(F.from_json(F.concat(F.lit('{"v":'), p, F.lit("}")), "v string")["v"], F.btrim(p, F.lit('"')))
