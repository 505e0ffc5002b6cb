"""Files, git and streams."""

import json
import subprocess
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from millrace.sources import files, git
from millrace.streaming import incremental


def test_jsonl(spark, tmp_path):
    a, b = tmp_path / "in" / "b.jsonl", tmp_path / "in" / "a.jsonl"
    a.parent.mkdir()
    a.write_text('{"instruction": "x", "output": "é"}\n\nnot json\n{"instruction": "y", "extra": 1}\n')
    b.write_text('{"instruction": "z"}\n')
    (tmp_path / "in" / "c.txt").write_text('{"instruction": "no"}\n')
    df = files.read_jsonl(spark, str(a.parent))
    assert [r.instruction for r in df.orderBy("_file", "_offset").collect()] == ["z", "x", "y"]
    assert files.read_jsonl(spark, str(tmp_path / "none")).count() == 0
    assert files.count_records(spark, str(a)) == 3
    out = str(tmp_path / "out")
    files.write_jsonl(df, out, ["output", "instruction"])
    lines = [x for p in (tmp_path / "out").glob("part*") for x in p.read_text().split("\n") if x]
    assert '{"output":"é","instruction":"x"}' in lines
    assert files.read_variant_jsonl(spark, str(a)).count() == 2


def test_replace_in_place(spark, tmp_path):
    path = str(tmp_path / "t")
    files.write_jsonl(spark.range(5), path)
    files.replace_in_place(spark.read.json(path).filter("id > 2"), path)
    assert spark.read.json(path).count() == 2


def test_chunk_store(spark, tmp_path):
    store = files.ChunkStore(spark, str(tmp_path / "s"))
    store.upsert(spark.createDataFrame([("1", "a", "x"), ("2", "a", "y"), ("3", "b", "z")], "id string, author string, text string"))
    store.upsert(spark.createDataFrame([("2", "a", "new"), ("4", "a", "w")], "id string, author string, text string"))
    assert sorted((r.id, r.text) for r in store.read().collect()) == [("1", "x"), ("2", "new"), ("3", "z"), ("4", "w")]
    store.delete("a")
    assert [r.id for r in store.read().collect()] == ["3"]


def test_files_and_stages(spark, tmp_path):
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "a.clj").write_text("\n".join(str(i) for i in range(400)))
    (tmp_path / "src" / "b.md").write_text("x")
    (tmp_path / "1.txt").write_text("one")
    (tmp_path / "2.txt").write_text("two")
    (f,) = files.source_files(spark, str(tmp_path / "src"), [".clj"]).collect()
    lines = f.content.split("\n")
    assert len(lines) == 301 and lines[49] == "49" and lines[51] == "150"
    assert files.corpus_text(spark, str(tmp_path / "*.txt")).first().text == "one\n\ntwo"
    old = spark.createDataFrame([("t", True), ("u", False)], "text string, is_varied boolean")
    assert [r.variation_type for r in files.stage_type(old).collect()] == ["varied", "original"]
    listing = spark.createDataFrame([("checkpoint-20/a", 1), ("checkpoint-3/a", 2), ("checkpoint-20/b", 3)], "path string, size int")
    assert [(r.step, r.files) for r in files.checkpoint_files(listing).collect()] == [(3, {"a": 2}), (20, {"a": 1, "b": 3})]


def test_json_rows(spark):
    rows = ['[{"a": 1}, {"a": 2}]', '{"a": 3}', '```json\n{"rows": [{"a": 4}]}\n```', "oops"]
    df = spark.createDataFrame([(r,) for r in rows], "x string").select(files.json_rows(F.col("x"), "struct<a:int>", "rows").alias("r"))
    got = [[y.a for y in r.r or []] for r in df.collect()]
    assert got[:3] == [[1, 2], [3], [4]] and got[3] in ([], [None])


def test_git(spark, tmp_path):
    run = lambda *a: subprocess.run(["git", "-C", str(tmp_path), "-c", "user.name=t", "-c", "user.email=t@t", *a], check=True, capture_output=True)
    run("init", "-q")
    for i in range(3):
        (tmp_path / "a.clj").write_text(f"(v {i})\n")
        run("add", ".")
        run("commit", "-qm", f"change number {i}")
    spark.dataSource.register(git.GitCommits)
    df = spark.read.format("git_commits").option("paths", str(tmp_path)).load()
    rows = df.collect()
    assert [r.message for r in rows] == ["change number 2", "change number 1", "change number 0"]
    assert rows[-1].parent == git.EMPTY_TREE and rows[0].files == ["a.clj"]
    arc = df.filter("message like '%2'").select("repo", F.col("parent").alias("base"), F.col("hash").alias("head"))
    assert "+(v 2)" in git.range_diffs(arc).first()["diff"]
    assert git.file_contents(df.withColumn("path", F.lit("a.clj"))).filter("message like '%1'").first().content == "(v 1)\n"


def feed(spark, tmp_path, batches):
    src = tmp_path / "src"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, "u string, ts timestamp, kind string, id long").coalesce(1).write.parquet(str(src / f"b{i}"))
    return spark.readStream.schema("u string, ts timestamp, kind string, id long").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(src))


T0 = datetime(2024, 1, 1)


def drain(df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.sql(f"select * from {name}").collect()


def test_stream_sessions_and_dedup(spark, tmp_path):
    rows = [("a", T0 + timedelta(hours=h), "k", i) for i, h in enumerate((0, 4, 8.5, 30))]
    s = feed(spark, tmp_path, [rows[:2], rows[2:], [("z", T0 + timedelta(days=9), "k", 9)], [("z", T0 + timedelta(days=10), "k", 10)]])
    got = sorted((r.start, r.n) for r in drain(incremental.sessions(s, "u", "ts"), "sess") if r.u == "a")
    assert [n for _, n in got] == [2, 1, 1]
    d = feed(spark, tmp_path / "d", [rows, [(u, t, k, i) for u, t, k, i in rows]])
    assert len(drain(incremental.deduplicated(d, "id", "ts", "10 days"), "dd")) == 4


def test_stream_runs(spark, tmp_path):
    kinds = ["x", "x", "y", None, "y", "x"]
    rows = [("a", T0 + timedelta(minutes=i), k, i) for i, k in enumerate(kinds)]
    got = drain(incremental.runs(feed(spark, tmp_path, [rows[:3], rows[3:]]), "u", "ts", "kind"), "runs")
    assert sorted((r.kind, r.n) for r in got) == [("x", 2), ("y", 1), ("y", 1)]


def test_generation_resumes(spark, tmp_path):
    s = feed(spark, tmp_path, [[("a", T0, "k", 1), ("a", T0, "k", 2)], [("a", T0, "k", 2), ("a", T0, "k", 3)]])
    out = str(tmp_path / "out")
    incremental.generate_to(s, lambda df: df.dropDuplicates(["id"]).withColumn("answer", F.upper("u")), out, str(tmp_path / "cp"), "id").awaitTermination()
    assert sorted(r.id for r in incremental.partial_results(spark, out).collect()) == [1, 2, 3]
    assert json.dumps([r.answer for r in spark.read.parquet(out).collect()]) == '["A", "A", "A"]'
