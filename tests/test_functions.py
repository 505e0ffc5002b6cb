"""Edge cases of the column functions (FIXTURES.md, part C)."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import scores, text
from millrace.functions import vectors as V
from millrace.operators import code, joins, records


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column.alias("v")).first().v


@pytest.mark.parametrize("x,n", [("", 0), ("   ", 0), ("one", 1), (" a  b\n c ", 3), (None, 0)])
def test_word_count(spark, x, n):
    df = spark.createDataFrame([(x,)], "x string")
    assert df.select(text.word_count("x")).first()[0] == n


@pytest.mark.parametrize(
    "x,want", [("a\n\nb", ["a", "b"]), ("a\nb", ["a", "b"]), ("one line", ["one line"]), ("a\n\nb\nc", ["a", "b\nc"]), ("", [])]
)
def test_paragraphs(spark, x, want):
    assert one(spark, text.paragraphs("x"), x=x) == want


@pytest.mark.parametrize("x,want", [("A b. C d! E?", ["A b.", "C d!", "E?"]), ("no end", ["no end"]), ("", []), ("Dr. Who", ["Dr.", "Who"])])
def test_sentences(spark, x, want):
    assert one(spark, text.sentences("x"), x=x) == want


@pytest.mark.parametrize(
    "x,want",
    [("* src/foo/bar.clj: add retry", "add retry"), ("Title: detail", "Title: detail"), ("a.clj: x", "x"), ("plain", "plain")],
)
def test_changelog(spark, x, want):
    assert one(spark, text.changelog_stripped("x"), x=x) == want
    assert one(spark, text.clean_instruction("x"), x=x + "; ;b") == want + "; b"


@pytest.mark.parametrize("x,want", [("WIP: x", "wip"), ("[Feature] y", "[feature]"), ("hello: x", None), ("squash! a: b", "squash! a"), ("", None), ("[] x", None)])
def test_prefix(spark, x, want):
    assert one(spark, text.commit_prefix("x"), x=x) == want


@pytest.mark.parametrize(
    "x,want",
    [("", "refactor"), ("fix the bug", "bug-fix"), ("readme documentation docstring", "refactor"), ("rename", "refactor"), ("zzz", "refactor"), ("add new feature", "add-feature")],
)
def test_change_type(spark, x, want):
    assert one(spark, scores.change_type(F.col("x")), x=x) == want


def test_duplicate_keywords_count_twice(spark):
    assert one(spark, scores.hits(F.col("x"), ["rename", "move", "rename"]), x="rename it") == 2


@pytest.mark.parametrize("n,band", [(0, "VERY_LONG"), (1, "FRAGMENT"), (4, "FRAGMENT"), (5, "SHORT"), (20, "MEDIUM"), (35, "LONG"), (36, "VERY_LONG")])
def test_bands(spark, n, band):
    assert one(spark, scores.length_band(F.col("n")), n=n) == band


@pytest.mark.parametrize(
    "x,want",
    [("# Title", True), ("ALL CAPS LINE", True), ("A sentence ends here.", False), ("Chapter", True), ("", False), ("Tell me about Paris", False), ("The Great War Begins", True)],
)
def test_heading(spark, x, want):
    assert one(spark, scores.heading("x"), x=x) is want


@pytest.mark.parametrize(
    "x,want",
    [("short", "too_short"), ("word " * 40, "repetitive"), (" ".join(f"w{i}" for i in range(40)) + ".", "ok"), (" ".join(f"ééé{i}" for i in range(40)), "encoding_artifacts")],
)
def test_load_reasons(spark, x, want):
    assert one(spark, scores.load_reason("x"), x=x) == want


def test_relevance_limits(spark):
    assert one(spark, scores.relevance("x"), x="") == 0.0
    assert one(spark, scores.relevance("x"), x="   ") == 0.0
    assert one(spark, scores.relevance("x"), x="refactor the defn atom swap! ref code") == pytest.approx(1.0)


def test_vectors(spark):
    a, b, z = [1.0, 0.0], [-1.0, 0.0], [0.0, 0.0]
    arr = lambda v: F.array(*[F.lit(x) for x in v])
    get = lambda c: spark.range(1).select(c).first()[0]
    assert get(V.cosine(arr(a), arr(a))) == pytest.approx(1.0)
    assert get(V.cosine(arr(a), arr(b))) == pytest.approx(-1.0)
    assert get(V.cosine(arr(a), arr(z))) == 0.0
    assert get(V.euclidean(arr(a), arr(b))) == 2.0


def test_hash_embedding(spark):
    import hashlib

    import numpy as np

    bits = np.unpackbits(np.frombuffer(hashlib.sha256(b"abc").digest(), np.uint8), bitorder="little").astype(float)
    want = np.concatenate([bits / np.linalg.norm(bits), np.zeros(44)])
    assert np.allclose(one(spark, V.hash_embedding("x", 300), x="abc"), want)


DIFF = "diff --git a/x.clj b/x.clj\n--- a/x.clj\n+++ b/x.clj\n@@ -1,2 +1,3 @@\n a\n-b\n+c\n+d\n@@ -9 +10 @@\n-e\n+f\ndiff --git a/n.clj b/m.clj\nrename from n.clj\nrename to m.clj\n"


def test_diffs(spark):
    files = one(spark, code.parse_diff("x"), x=DIFF)
    assert [(f.path, f.change_type, f.old_path, len(f.hunks)) for f in files] == [("x.clj", "modified", None, 2), ("m.clj", "renamed", "n.clj", 0)]
    assert (files[0].hunks[1].old_start, files[0].hunks[1].old_count) == (9, 1)
    assert one(spark, records.changed_lines("x"), x=DIFF) == 5
    assert one(spark, code.diff_errors("x"), x=DIFF) == []
    assert one(spark, code.diff_errors("x"), x="  ") == ["Empty diff"]
    assert "Malformed hunk header at line 1: @@ bad" in one(spark, code.diff_errors("x"), x="@@ bad")


@pytest.mark.parametrize("x,n", [("(a (b))", 0), ("(a", 1), ("a)", 1), ('(str ")")', 0), ("; ) comment", 0), ("", 0)])
def test_syntax(spark, x, n):
    assert len(one(spark, code.syntax_errors("x"), x=x)) == n


def test_forms(spark):
    src = '(ns a)\n\n(defn f [x]\n  ; (not\n  "(" x)\n(def c \\()\n(open'
    assert [(f.start, f.end) for f in one(spark, code.top_level_forms("x"), x=src)] == [(1, 1), (3, 5), (6, 6), (7, 7)]


def test_changed_regions(spark):
    before = spark.createDataFrame([(1, "a.clj", "(ns a)\n(one)\n(two)\n(three)"), (1, "b.clj", "(x)")], "id int, path string, content string")
    hunks = spark.createDataFrame([(1, "a.clj", 4, 4)], "id int, path string, old_start int, old_end int")
    got = {r.path: r.body for r in code.changed_regions(before, hunks).collect()}
    assert got == {"a.clj": "(ns a)\n;; ...\n(three)", "b.clj": "(x)"}


def test_eval_trace(spark):
    trace = ";; eval: (+ 1\n;;   2)\n;; result: 3\n;; more\ntext\n;; eval: (def x 1)"
    b = one(spark, code.eval_blocks("x"), x=trace)
    assert [(x.form, x.result_start, x.result_end) for x in b] == [("(+ 1\n  2)", 2, 3), ("(def x 1)", None, None)]
    res = F.array(F.struct(F.lit("(+ 1 2)").alias("form"), F.lit(True).alias("ok")), F.struct(F.lit("(def x 1)").alias("form"), F.lit(False).alias("ok")))
    assert one(spark, code.right_end_state(res)) is True
    assert one(spark, code.pass_rate(res)) == 0.5
    assert one(spark, code.all_ok(res)) is False
    none = F.filter(res, lambda r: F.lit(False))
    assert one(spark, code.right_end_state(none)) is False and one(spark, code.pass_rate(none)) == 0.0


def test_patterns(spark):
    flags = lambda d, f: one(spark, code.pattern_flags("d", F.array(F.lit(f))), d=d)
    assert flags("(swap! (atom 1))", "a.clj") == ["state-machine"] or "state-machine" in flags("(swap! (atom 1))", "a.clj")
    assert flags("(swap! (atom 1))", "a.txt") == []
    assert "side-effect-isolation" in flags("(println 1)", "src/io.clj") and "side-effect-isolation" not in flags("(println 1)", "src/io_core.clj")


def test_commit_filters(spark):
    rows = [("h1", "Add a retry loop", ["src/a.clj"], False), ("h2", "fix", ["src/a.clj"], False), ("h3", "Add a retry loop", ["doc/a.clj"], False), ("h4", "Merge branch x y", ["src/a.clj"], True), ("h5", "Add a retry loop", ["project.clj"], False)]
    df = spark.createDataFrame(rows, "hash string, message string, files array<string>, is_merge boolean")
    assert [r.hash for r in records.code_commits(df).collect()] == ["h1"]


def test_trivial_diffs(spark):
    rows = [("synthetic", "diff --git\n+a"), ("git", "no diff"), (None, "diff --git\n+a"), ("git", "diff --git\n+a\n+b\n-c\n-d")]
    df = spark.createDataFrame(rows, "source string, output string")
    assert records.without_trivial_diffs(df, 4).count() == 3
    assert records.without_trivial_diffs(df, 0).count() == 4


def test_format_records(spark):
    df = spark.createDataFrame([(1, None, " ", "git")], "instruction int, output string, system string, source string")
    r = records.format_records(df, "be brief").first()
    assert (r.instruction, r.input, r.output, r.system, r.history) == ("1", "", "", "be brief", [])


def test_layouts(spark):
    m = "messages array<struct<role:string,content:string>>, prompt string, completion string, text string"
    rows = [([("user", "a"), ("user", "b"), ("assistant", "c")], None, None, None), (None, "p", "q", None), (None, None, None, "### Instruction: x\n### Response: y"), (None, None, None, "nothing")]
    assert [r.normalised for r in records.normalised_layouts(spark.createDataFrame(rows, m)).collect()] == ["b\n\nc", "p\n\nq", "x\n\ny"]


def test_grounding(spark):
    g = one(spark, joins.grounding("a", "b"), a="The quick brown foxes jumped. Lazy dogs slept.", b="Quick brown foxes jumped over. Completely unrelated martian volcanoes erupted violently beneath seventeen crimson moons. Yes.")
    assert g[0].grounded and g[0].match == 0 and g[1].hallucinated and g[2].grounded


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab .!?\n", max_size=40), min_size=20, max_size=30))
def test_sentence_words_add_up(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    for r in df.select(text.word_count("x").alias("n"), F.aggregate(text.sentence_lengths("x"), F.lit(0), lambda a, b: a + b).alias("m")).collect():
        assert r.n == r.m
