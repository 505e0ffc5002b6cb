from pyspark.sql import functions as F

from millrace.functions import fragments
from millrace.operators import taxonomy
from millrace.plans import pipelines

REC = "instruction string, input string, output string, _file string, _offset long"


def test_assembly(spark):
    diff = "diff --git a/x b/x\n@@ -1 +1 @@\n" + "".join(f"+l{i}\n" for i in range(6))
    git = spark.createDataFrame([(f"fix bug {i % 6}", "", diff + str(i % 6), "a", i) for i in range(12)] + [("add feature", "", diff, "a", 99), ("add tiny", "", "diff --git\n+a", "a", 100)], REC)
    syn = spark.createDataFrame([("fix bug 1", "", diff + "1", "b", 0), ("build new", "", "trace", "b", 1)], REC)
    pools = {"git": ["g1", "g2"], "synthetic": ["s1"]}
    got = pipelines.assembled([git], [syn], pools).collect()
    by = {}
    for r in got:
        by.setdefault((r.source, r.change_type), []).append(r)
    assert {k: len(v) for k, v in by.items()} == {("git", "bug-fix"): 1, ("git", "add-feature"): 1, ("synthetic", "add-feature"): 1}
    assert all(r.system in pools[r.source] for r in got)
    train, val = pipelines.split_checked(pipelines.assembled([git], [syn], pools))
    assert train.columns == ["instruction", "input", "output", "system", "history"] and train.count() + val.count() == 3


def test_mining(spark):
    rows = [("r", f"h{i}", f"h{i - 1}", f"2024-01-{i + 1:02d}", f"Add nice thing {i}", [f"src/{i}.clj"], False) for i in range(20)]
    df = spark.createDataFrame(rows, "repo string, hash string, parent string, timestamp string, message string, files array<string>, is_merge boolean")
    got = pipelines.mined(df).orderBy("arc").collect()
    assert [(r.base, r.head) for r in got] == [("h7", "h10"), ("h10", "h13"), ("h13", "h15")]
    assert got[0].instruction == "Add nice thing 8; Add nice thing 9; Add nice thing 10"
    flagged = pipelines.mined(df, patterns=["macro"], diffs=lambda d: d.withColumn("diff", F.when(F.col("arc") == 1, "defmacro").otherwise("x")))
    assert [r.arc for r in flagged.collect()] == [1]


def test_indexing_and_guidance(spark):
    good = "This is a fine sentence with many different words inside it. " + " ".join(f"token{i}" for i in range(30)) + ". And it ends well here."
    df = spark.createDataFrame([("a", good + "\n\nshort\n\n" + good.replace("fine", "good"))], "author string, text string")
    chunks, reasons = pipelines.indexed(df, "author", "text", lambda: lambda ts: [[1.0, float("fine" in t) * 0.01] for t in ts])
    assert {r.reason: r.n for r in reasons.collect()} == {"ok": 2, "too_short": 1}
    assert chunks.count() == 1 and len(chunks.first().id) == 16
    assert pipelines.guidance(chunks).first().rhythm[0] == "MEDIUM"


def test_transform(spark):
    df = spark.createDataFrame([("The bridge[^1] was long.",), ("fail",)], "t string")

    def factory():
        def call(ts):
            if "fail" in ts[0] or len(ts) > 1:
                raise ValueError
            return ["A long bridge stood there."]

        return call

    (r,) = pipelines.transformed(df, "t", factory).collect()
    assert r.restored.text == "A long bridge[^1] stood there."


def test_taxonomy(spark):
    nodes = taxonomy.baseline(spark)
    assert nodes.filter("depth = 0").count() == 12 and nodes.filter("name = 'atoms-refs'").first().label == "Atoms Refs"
    back = taxonomy.from_json(taxonomy.to_json(nodes))
    assert sorted(map(tuple, back.select(*nodes.columns).collect()), key=str) == sorted(map(tuple, nodes.collect()), key=str)
    assert taxonomy.descendants(spark, nodes, "testing").count() == 6
    feats = spark.createDataFrame([("macro", "my macros", ""), ("zzz", "unit tests here", ""), ("atom thing", "x", "core async")], "feature_type string, name string, description string")
    table = spark.createDataFrame([("macro", "metaprogramming", 1), ("atom", "concurrency", 2)], "kind_name string, category string, ord int")
    got = {r.feature_type: (r.category, r.node) for r in taxonomy.assigned(nodes, feats, table, "testing").collect()}
    assert got == {"macro": ("metaprogramming", "macros"), "zzz": ("testing", "unit-tests"), "atom thing": ("concurrency", "core-async")}
    placed = spark.createDataFrame([("macros",), ("macros",), ("testing",)], "node string")
    stats = {r.root: (r.nodes, r.features) for r in taxonomy.statistics(nodes, placed).collect()}
    assert stats["metaprogramming"] == (5, 2) and stats["testing"] == (6, 1) and stats[None][1] == 3
    assert taxonomy.diversity(nodes, placed).first().diversity == 0.0


def test_fragments(spark):
    get = lambda c: spark.range(1).select(c).first()[0]
    assert get(fragments.incomplete(F.lit("It was the"))) == "ends with function word"
    assert get(fragments.incomplete(F.lit("It ended—"))) == "ends with dash"
    assert get(fragments.incomplete(F.lit("It ended well."))) is None
    assert get(fragments.cleaned_answer(F.lit("Good text here. <think>x</think>More. ### junk"))) == "Good text here. More."
    assert get(fragments.cleaned_answer(F.lit("Fine. Привет. End."))) == "Fine."
    assert get(fragments.nouns_as_things(F.lit("a house, a car."), ["house", "car"])) == "a [THING], a [THING]."
    assert get(fragments.clause_structure(F.lit("He left because it rained and the road, which was old, broke."))) == "complex"
    assert len(get(fragments.default_rhythm(F.lit(5), F.lit("k")))) == 5
    spark.sql("select 1")
    names = pipelines.registered_functions(spark)
    assert spark.sql(f"select {names[0]}(' a  b ')").first()[0] == 2
