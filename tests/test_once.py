"""What a row asks for more than once is computed once; what Python holds doesn't grow with a batch."""

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from millrace.operators import chunking, code, models
from millrace.plans.catalogue import QUERIES


def test_pattern_flags_lower_the_diff_once(spark):
    df = spark.createDataFrame([("(DEFMACRO a) swap! ATOM",), (None,)], "d string").select(code.pattern_flags("d", F.array(F.lit("src/a.clj"))).alias("p"))
    assert df._jdf.queryExecution().analyzed().toString().count("lower(coalesce(d") == 1
    got = [r.p for r in df.collect()]
    assert "state-machine" in got[0] and "macro" in got[0] and got[1] == []


def test_answers_go_on_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(models, "LETTERS", 1000)
    pieces = []

    def factory():
        return lambda texts: [t * 100 for t in texts]

    real = F.pandas_udf

    def watched(kind):
        def wrap(f):
            pieces.extend(len(x) for x in f(iter([pd.Series(["abc"] * 100)])))
            return real(kind)(f)

        return wrap

    monkeypatch.setattr(F, "pandas_udf", watched)
    df = models.generated(spark.range(100).select(F.lit("abc").alias("t")).coalesce(1), F.col("t"), factory)
    assert len(pieces) > 5 and sum(pieces) == 100
    assert [r.answer for r in df.collect()] == ["abc" * 100] * 100


def test_texts_are_cut_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(chunking, "TEXTS", 7)
    pieces = []
    real = F.arrow_udf

    def watched(kind):
        def wrap(f):
            pieces.extend(len(x) for x in f(iter([pa.array([["a " * 120, "b " * 60]] * 20 + [None])])))
            return real(kind)(f)

        return wrap

    monkeypatch.setattr(F, "arrow_udf", watched)
    df = spark.createDataFrame([(i, "One two three. " * 60) for i in range(20)], "k long, t string").coalesce(1)
    got = chunking.corpus_chunks(df, "k", "t").collect()
    assert pieces == [7, 7, 7]
    assert len({r.k for r in got}) == 20 and all(r.words >= 100 for r in got)


def test_quality_reasons_find_words_once(spark, sf_dir):
    plan = QUERIES["quality_reasons"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(coalesce(") == 1 and plan.count("array_min") == 1
