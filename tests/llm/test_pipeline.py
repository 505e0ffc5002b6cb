import collections
import zlib

import numpy as np
import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from millrace.llm import mixing, quality  # noqa: E402
from millrace.llm.queries import tokenizer_path  # noqa: E402
from tests.llm.helpers import AWKWARD  # noqa: E402
from tests.llm.helpers import docs as awkward_docs  # noqa: E402
from tests.llm.test_line_dedup import WS  # noqa: E402
from tests.llm.test_minhash import brute as near_brute  # noqa: E402
from tests.llm.test_mixing import brute as mix_brute  # noqa: E402


def test_stages_and_run_match_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    at = docs
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in at.collect()} if name != "packing" else None
        out = stage(spark, at, sf_dir).cache()
        rows = out.collect()
        if name != "packing":
            assert out.columns == columns
            assert out.schema.simpleString() == docs.schema.simpleString()
            got = {r.doc_id: r.text for r in rows}
        if name == "quality classifier":
            model = quality.train(at, spark.read.parquet(f"{sf_dir}/labels.parquet"))
            want = {i for i, r in before.items() if model.score(quality.features(r.text)[None])[0] >= 0.3}
            assert set(got) == want and 0 < len(want) < len(before)
        elif name == "line dedup":
            key = lambda x: x.strip(WS).lower()
            n = collections.Counter(k for r in before.values() for k in {key(x) for x in r.text.split("\n")})
            assert set(got) == set(before)
            for i, r in before.items():
                assert got[i] == "\n".join(x for x in r.text.split("\n") if not key(x) or n[key(x)] < 10)
            assert all(r.n_chars == len(r.text) for r in rows)
        elif name == "minhash near-dedup":
            comp = near_brute([(i, r.text) for i, r in before.items()], 5, 80, 100)
            assert set(got) == {i for i in comp if comp[i] == i}
        elif name == "source mixing":
            assert set(got) == set(mix_brute(at, mixing.PRODUCTION))
            assert 0 < len(got) < len(before)
        else:
            texts = {r.doc_id: r.text for r in at.collect()}
            assert {r.doc_id for r in rows} == set(texts)
            from tokenizers import Tokenizer

            tk = Tokenizer.from_file(tokenizer_path())
            for r in rows:
                ids = np.array(tk.encode(texts[r.doc_id], add_special_tokens=False).ids + [1], "<u4")
                assert zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32
        at = out
    whole = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, at.collect()))
    assert [k for k, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "minhash near-dedup", "source mixing", "packing"]


CLASH = ("_bad", "n_lines", "N_DROPPED", "kept_sha256", "_id", "key", "_own_id", "_own_reads", "_mix_whole", "_at_domain", "epochs_read", "set_key", "component_id", "kept", "score", "predicted", "node", "f", "y")
HELD = [(70 + i, f"A line that many share\nown words of row {i} here\n") for i in range(12)]


def awkward(spark, rows):
    from pyspark.sql import functions as F

    return awkward_docs(spark, rows).withColumns({c: F.lit(f"own {c}") for c in CLASH})


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_on_awkward_rows(spark, sf_dir, name, stage):
    rows = AWKWARD + HELD + HELD[:3]
    df = awkward(spark, rows)
    out = stage(spark, df, sf_dir)
    got = out.collect()
    if name == "packing":
        assert {r.doc_id for r in got} == {i for i, _ in rows}
    else:
        assert out.columns == df.columns and [f.dataType for f in out.schema] == [f.dataType for f in df.schema]
        assert all(r[c] == f"own {c}" for r in got for c in CLASH)
        texts = collections.Counter((i, t or "") for i, t in rows)
        if name == "line dedup":
            want = collections.Counter((i, "\n".join(x for x in (t or "").split("\n") if x != "A line that many share")) for i, t in rows)
            assert collections.Counter((r.doc_id, r.text or "") for r in got) == want
        else:
            assert not collections.Counter((r.doc_id, r.text or "") for r in got) - texts
        if name == "minhash near-dedup":
            kept = {r.doc_id for r in got}
            assert {1, 2, 3, 7, None} <= kept and 8 not in kept  # 7 and 8 are equal
    # Without rows, and without labels that any row has.
    empty = stage(spark, awkward(spark, []), sf_dir)
    assert empty.count() == 0 and (name == "packing" or empty.columns == df.columns)
