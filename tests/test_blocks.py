"""Vectors compared block by block against plain loops, and that no query evaluates a column expression a pair."""

import math

import numpy as np
import pytest

from millrace.operators import blocks, coreset, joins
from millrace.plans.catalogue import QUERIES


def fold(a, b):
    """The cosine by sums in order of position; None where there is none."""
    if a is None or b is None or len(a) != len(b) or not a or None in a or None in b:
        return None
    dot = na = nb = 0.0
    for x, y in zip(a, b, strict=True):
        dot, na, nb = dot + x * y, na + x * x, nb + y * y
    return dot / (math.sqrt(na) * math.sqrt(nb) + 1e-8)


def odd_rows():
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 6))
    rows = [(i, (base[i % 40] * (1 + i % 3) + (i % 7) * 0.03 * rng.normal(size=6)).tolist()) for i in range(130)]
    rows += [(200 + i, base[0].tolist()) for i in range(9)]
    rows += [(300, None), (301, []), (302, [0.0] * 6), (303, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (304, [math.nan] * 6), (305, [1e-9, 0.0, 0.0, 0.0, 0.0, 0.0]), (306, [1e-5, 1e-5, 0.0, 0.0, 0.0, 0.0]), (307, [1e200] * 6), (308, [1.0, 2.0]), (309, [2.0, 4.0]), (310, [1e-200] * 6)]
    return rows


def passes(c, t):
    return c is not None and (c >= t or math.isnan(c))


@pytest.mark.parametrize("rows", [2048, 16])
@pytest.mark.parametrize("threshold", [0.3, 0.9, -0.2])
def test_near_equals_a_loop(spark, rows, threshold, monkeypatch):
    monkeypatch.setattr(blocks, "ROWS", rows)
    monkeypatch.setattr(blocks, "PART", 50)
    data = odd_rows()
    df = spark.createDataFrame(data, "k long, v array<double>").repartition(3)
    a, b = blocks.packed(df.filter("k % 3 = 0"), "k", "v"), blocks.packed(df, "k", "v")
    got = sorted((r.left_id, r.right_id) for r in blocks.near(a, b, "k", "k", threshold).collect())
    assert got == sorted((i, j) for i, x in data if i % 3 == 0 for j, y in data if passes(fold(x, y), threshold))


@pytest.mark.parametrize("rows", [2048, 16])
@pytest.mark.parametrize("most", [20_000, 0])
def test_top_equals_a_loop(spark, rows, most, monkeypatch):
    monkeypatch.setattr(blocks, "ROWS", rows)
    monkeypatch.setattr(blocks, "PART", 50)
    monkeypatch.setattr(joins, "QUERY_ROWS", most)
    data = odd_rows()
    df = spark.createDataFrame(data, "k long, v array<double>").repartition(3)
    got = {(r.k, r["rank"]): (r.k_match, r.similarity) for r in joins.vector_top(df.filter("k % 3 = 0"), df, "v", "v", "k", "k", 4).collect()}
    want = {}
    for i, x in data:
        if i % 3 == 0:
            own = sorted(((-math.inf if math.isnan(c) else -c, j, c) for j, y in data if passes(c := fold(x, y), 0.15)))[:4]
            want |= {(i, n + 1): (j, c) for n, (_, j, c) in enumerate(own)}
    assert repr(sorted(got.items())) == repr(sorted(want.items()))


@pytest.mark.parametrize("name", ["near_search"])
def test_no_column_expression_a_pair(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "zip_with" not in plan and "aggregate(" not in plan


def test_top_ranks_what_tasks_pass_on(spark, sf_dir):
    plan = QUERIES["cosine_topk"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "zip_with" not in plan and "xplode" not in plan


def greedy(rows, threshold):
    gone = set()
    for a, x, na in rows:
        for b, y, nb in rows:
            c = fold(x, y)
            if a < b and a not in gone and b not in gone and c is not None and (c > threshold or math.isnan(c)):
                gone.add(b if na >= nb else a)
    return [a for a, *_ in rows if a not in gone]


@pytest.mark.parametrize("rows,most", [(2048, 2_000_000), (16, 0)])
@pytest.mark.parametrize("lengths", [1, 4])
def test_semantic_near_equals_the_greedy_pass(spark, rows, most, lengths, monkeypatch):
    """Chains, copies, a group with a third of all rows, and pairs just above the threshold, which hyperplane codes lose."""
    monkeypatch.setattr(blocks, "ROWS", rows)
    monkeypatch.setattr(blocks, "PART", 50)
    monkeypatch.setattr(coreset, "LINKS", most)
    rng = np.random.default_rng(11)
    base = rng.normal(size=(12, 8))
    x = [base[0] + 0.1 * rng.normal(size=8) if i % 3 == 0 else base[i % 12] + 0.35 * rng.normal(size=8) for i in range(150)]
    x += [np.array([math.cos(0.4 * i), math.sin(0.4 * i), *[0.0] * 6]) for i in range(30)]
    at = rng.permutation(len(x))
    data = [(i, x[at[i]].tolist(), int(rng.integers(0, lengths))) for i in range(len(x))]
    got = coreset.semantic_near(spark.createDataFrame(data, "k long, v array<double>, n long").repartition(3), "k", "v", "n").collect()
    assert sorted(r.k for r in got) == greedy(data, 0.9)
