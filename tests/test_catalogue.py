"""Every registered query against its SQL on DuckDB, and the registry's own rules."""

import glob
import math
import os

import duckdb
import pytest

from millrace.plans.catalogue import ORACLES, QUERIES


def norm(v):
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    return v


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    cols = sorted(df.columns)
    rows = sorted(repr(tuple(norm(r[c]) for c in cols)) for r in df.collect())
    if name not in ORACLES:
        assert rows
        return
    out = duck.execute(ORACLES[name])
    names = [c[0] for c in out.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    assert rows == sorted(repr(tuple(norm(r[i]) for i in at)) for r in out.fetchall())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_library_stands_without_the_llm_folder():
    import re
    from pathlib import Path

    root = Path(__file__).resolve().parents[1] / "millrace"
    for p in root.rglob("*.py"):
        if p.parent.name != "llm":
            assert not re.search(r"millrace\.llm", p.read_text()), p


@pytest.mark.parametrize("name", ["quality_reasons", "style_tag", "rhythm_sequence", "classify_type", "rhetorical_moves", "cosine_topk", "time_gap_sessions"])
def test_no_python_in_column_plans(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan
