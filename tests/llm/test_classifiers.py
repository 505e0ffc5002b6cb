import bisect
import math
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from millrace.llm import quality, toxicity
from tests.llm.helpers import AWKWARD, docs

DATA = "/root/testdata/sf0.1"


def table(name):
    return pq.read_table(f"{DATA}/{name}.parquet").to_pandas()


@pytest.fixture(scope="module")
def gold():
    return table("labels").merge(table("documents"), on="doc_id")


def fold(ids, m):
    return np.array([zlib.crc32(str(i).encode()) % m for i in ids])


def test_quality_held_out(gold):
    held = fold(gold.doc_id, 5) == 0
    x = np.array([quality.features(t) for t in gold.text])
    model = quality.fit(x[~held], gold.quality.to_numpy(float)[~held])
    p = model.score(x[held]) >= 0.3
    y = gold.quality.to_numpy()[held] == 1
    assert p[y].mean() > 0.99 and (~p[~y]).mean() > 0.95
    assert model.pairs and len(model.tables) == len(quality.FEATURES)


def test_toxicity_held_out(gold):
    held = fold(gold.doc_id, 4) == 2
    model = toxicity.fit([toxicity.features(t) for t in gold.text[~held]], gold.toxic.to_numpy(float)[~held])
    p = model.score(gold.text[held].tolist()) >= 0.3
    y = gold.toxic.to_numpy()[held] == 1
    assert p[y].mean() > 0.9 and p[~y].mean() < 0.02


def test_interactions_are_learned():
    """Each word alone is clean, both together are not: no additive model can tell."""
    rng = np.random.default_rng(0)
    texts, y = [], []
    for _ in range(1600):
        a, b = (int(v < 0.5) for v in rng.random(2))
        texts.append(" ".join(["alpha"] * a + ["omega"] * b + [f"w{rng.integers(40)}"]))
        y.append(float(a and b) if rng.random() > 0.02 else 0.0)
    # Either word alone in surplus, so that neither says anything by itself.
    texts += ["alpha"] * 400 + ["omega"] * 400
    y += [0.0] * 800
    model = toxicity.fit([toxicity.features(t) for t in texts], np.array(y), updates=3000)
    one, both = model.score(["alpha w1", "omega w2"]), model.score(["alpha omega w1"])
    assert both[0] > 0.5 > max(one)


@pytest.mark.parametrize("scores,label", [(quality.quality_scores, "quality"), (toxicity.toxicity_scores, "toxic")])
def test_awkward_rows(spark, scores, label):
    df = docs(spark, AWKWARD)
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 1), (7, 1, 0), (7, 1, None), (None, 1, 1), (6, None, None)], "doc_id long, quality int, toxic int")
    for lab in (labels, labels.limit(0), labels.filter("doc_id = 4")):
        got = scores(df, lab).collect()
        assert len(got) == len(AWKWARD)
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    if label == "quality":
        assert quality.keep_good(df, labels.limit(0)).columns == df.columns
    assert scores(docs(spark, []), labels).count() == 0


def test_registered_queries(spark):
    from millrace.llm.queries import QUERIES

    for name, modulus, held in (("op5_quality", 5, 0), ("op3_toxicity", 4, 2)):
        got = QUERIES[name](spark, "/root/testdata/sf0.001").toPandas()
        assert (got.held_out == (fold(got.doc_id, modulus) == held)).all()
        assert len(got) == 200


@pytest.mark.parametrize("scores,modulus,held", [(quality.quality_scores, 5, 0), (toxicity.toxicity_scores, 4, 2)])
def test_a_labelled_null_text_is_empty(spark, scores, modulus, held):
    ids = [i for i in range(1, 60) if zlib.crc32(str(i).encode()) % modulus != held][:4]
    df = docs(spark, list(zip(ids, [None, "", "some words", "other words"], strict=True)))
    got = {r.doc_id: r.score for r in scores(df, spark.createDataFrame([(i, k % 2, k % 2) for k, i in enumerate(ids)], "doc_id long, quality int, toxic int")).collect()}
    assert len(got) == 4 and got[ids[0]] == got[ids[1]]


def plain_quality_features(t):
    """quality.FEATURES by plain counting over the whole text."""
    raw, words = t.encode(), t.split()
    n, size = max(1, len(words)), max(1, len(raw))
    classes = ["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n", ".,;:?", "!", "#$%&*@^~", "|", "<>[]{}()", "/\\_=", "\"'`", "+-"]
    out = [math.log1p(len(t)), *(sum(b in c.encode() for b in raw) / size for c in classes), sum(b > 127 for b in raw) / size, sum(b < 9 for b in raw) / size]
    lines = [x for x in t.split("\n") if x.strip()]
    m = max(1, len(lines))
    most = lambda xs: max((xs.count(x) for x in set(xs)), default=0)
    out += [sum(map(len, words)) / n, sum(len(w) > 14 for w in words) / n, sum(len(w) < 4 for w in words) / n if words else 1.0, len(set(words)) / n, most(words) / n]
    out += [len(words) / m, len(set(lines)) / m, most(lines) / m, sum(x.strip()[-1] in ".!?:;\"')" for x in lines) / m, sum(w[0].isupper() for w in words) / n]
    return [*out, len({(a, b) for a, b in zip(words, words[1:])}) / max(1, len(words) - 1)]  # noqa: B905


def test_quality_query_matches_brute_force(spark, sf_dir):
    from millrace.llm.queries import QUERIES

    df, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(df, labels)
    texts = {r.doc_id: r.text for r in df.collect()}
    got = QUERIES["op5_quality"](spark, sf_dir).collect()
    assert len(got) == len(texts) and model.pairs
    for r in got:
        x = plain_quality_features(texts[r.doc_id])
        z = model.base + sum(t[bisect.bisect_right(e.tolist(), v)] for v, e, t in zip(x, model.edges, model.tables, strict=True))
        for (a, b), t in zip(model.pairs, model.pair_tables, strict=True):
            z += t[bisect.bisect_right(model.coarse[a].tolist(), x[a])][bisect.bisect_right(model.coarse[b].tolist(), x[b])]
        assert abs(r.score - 1 / (1 + math.exp(-z))) < 1e-6, r.doc_id
        assert r.predicted == int(r.score >= 0.3)


def test_toxicity_query_matches_brute_force(spark, sf_dir):
    from millrace.llm.queries import QUERIES

    df, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(df, labels)
    assert len(model.kept) > 10
    texts = {r.doc_id: r.text for r in df.collect()}
    got = QUERIES["op3_toxicity"](spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        terms = set()
        for w in re.findall(r"\w+", texts[r.doc_id].lower()):
            terms |= {w, *(f"{k}:{w[:k]}" for k in (3, 4, 5, 6) if len(w) > k)}
        at = sorted({model.kept[h] for h in (zlib.crc32(t.encode()) >> 10 for t in terms) if h in model.kept})
        z = model.base + sum(model.w[i] for i in at) + sum(float(model.v[i] @ model.v[j]) for i in at for j in at if i < j)
        assert abs(r.score - 1 / (1 + math.exp(-max(-30, min(30, z))))) < 1e-9, r.doc_id


def test_terms_are_chosen_as_in_memory(spark, gold):
    """The distributed choice of terms leaves the model that fitting on all terms gives."""
    df, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = sorted(toxicity.training_rows(df, labels, "toxic", 4, 2, 8000, toxicity.features, "int").collect(), key=lambda r: r.doc_id)
    model = toxicity.train(df, labels)
    whole = toxicity.fit([np.array(r.f) for r in rows], np.array([r.y for r in rows], float))
    assert set(model.kept) == set(whole.kept)


def test_line_ends_count_whatever_blanks_follow():
    at = quality.FEATURES.index("marked_ends")
    assert quality.features("A line." + " " * 20 + "\nno")[at] == 0.5
