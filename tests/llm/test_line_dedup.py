import hashlib
import re
from collections import Counter

import pytest

from millrace.llm import line_dedup
from tests.llm.helpers import AWKWARD, docs

WS = " \t\n\x0b\x0c\r"


def brute(rows, threshold):
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(WS))
    n = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")})
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not key(x) or n[key(x)] < threshold]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return Counter(out)


ROWS = AWKWARD + [(100 + i, f"Common LINE \n own {i}\n\n  common line\t\nÀ {i % 2}") for i in range(12)]


@pytest.mark.parametrize("most", [200_000, 0])
def test_matches_brute_force_on_either_path(spark, most):
    df = docs(spark, ROWS)
    got = line_dedup.drop_common_lines(df.select("doc_id", "text"), 10, batches=3, fan_in=2, keep_text=False, broadcast_keys=most)
    assert Counter(tuple(r) for r in got.collect()) == brute(ROWS, 10)


def test_keeps_other_columns(spark):
    df = docs(spark, ROWS)
    got = line_dedup.drop_common_lines(df, 10)
    assert set(df.columns) < set(got.columns)
    assert got.count() == len(ROWS)


def test_empty_table(spark):
    assert line_dedup.line_dedup(docs(spark, [])).count() == 0


def test_levels_compact(spark):
    runs = line_dedup.LineRuns(threshold=3, fan_in=2)
    for b in range(4):
        runs.add(spark.createDataFrame([(b"a", 1), (bytes([b]), 1)], "key binary, docs long"))
    assert [len(x) for x in runs.levels] == [0, 0, 1]
    assert [bytes(r.key) for r in runs.common().collect()] == [b"a"]


def test_rows_count_one_by_one_as_in_the_sql(spark, tmp_path):
    import duckdb

    from millrace.llm.queries import ORACLES, QUERIES

    rows = [(5, "one line\nown")] * 9 + [(5, "one line"), (None, "no id"), (None, "no id")] + [(i, None if i % 2 else "NO ID \n\nx") for i in range(10, 30)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter(tuple(r[c] for c in ("doc_id", "n_lines", "n_dropped", "kept_sha256")) for r in QUERIES["op6_line_dedup"](spark, str(tmp_path)).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.execute(f"SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM ({ORACLES['op6_line_dedup']})").fetchall()
    assert got == Counter(want) == brute(rows, 10)


def test_line_keys_are_exchanged_once(spark):
    runs = line_dedup.LineRuns(threshold=3, fan_in=3, buckets=4)
    for b in range(2):
        runs.add(spark.createDataFrame([(b"a", 2), (bytes([b]), 1)], "key binary, docs long"))
    plan = runs.common()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Bucketed: true") == 2
    assert [bytes(r.key) for r in runs.common().collect()] == [b"a"]
    names = set(runs.tables)
    runs.close(spark)
    assert len(names) == 3 and not names & {t.name for t in spark.catalog.listTables()}


def test_only_the_text_changes_without_a_report(spark):
    df = docs(spark, ROWS).withColumns({c: line_dedup.F.lit("x") for c in ("n_lines", "N_DROPPED", "_bad", "_id", "_own_id", "kept_sha256")})
    for most in (200_000, 0):
        got = line_dedup.drop_common_lines(df, 10, report=False, broadcast_keys=most)
        assert sorted(got.columns) == sorted(df.columns)
        assert {(r.n_lines, r.N_DROPPED, r._bad, r._id, r._own_id) for r in got.collect()} == {("x",) * 5}
