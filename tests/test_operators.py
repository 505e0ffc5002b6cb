"""Operators on small tables: order, caps, sums, boundaries, determinism."""

import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import lexicons
from millrace.operators import allocate, chunking, coreset, dedup, joins, models, ranks, sampling, sessions
from millrace.operators.chunking import Windows


def test_dedup_keeps_first(spark):
    df = spark.createDataFrame([(3, " a ", "b"), (1, "a", "b\n"), (2, "A", "b"), (4, None, None)], "i int, instruction string, output string").repartition(3)
    assert sorted(r.i for r in dedup.keep_first(df, dedup.exact_key(), ["i"]).collect()) == [1, 2, 4]
    assert sorted(r.i for r in dedup.keep_first(df, dedup.field_key("instruction"), ["i"]).collect()) == [1, 4]


def test_merge_prefers_earlier_sources(spark):
    a, b = spark.createDataFrame([("x", 1)], "k string, v int"), spark.createDataFrame([("x", 2, "e"), ("y", 3, "e")], "k string, v int, extra string")
    got = dedup.merge([a, b], dedup.field_key("k"), ["v"]).collect()
    assert sorted((r.k, r.v) for r in got) == [("x", 1), ("y", 3)]


def test_joint_instruction(spark):
    df = spark.createDataFrame([(["Merge branch x", "* src/a.clj: add retry logic here", "wip", "add retry logic here", None],)], "m array<string>")
    assert df.select(dedup.joint_instruction("m")).first()[0] == "add retry logic here"


def test_balance_and_split(spark):
    df = spark.range(100).withColumn("kind", F.when(F.col("id") < 90, "a").otherwise("b"))
    got = Counter(r.kind for r in sampling.balance(df, "kind", "id").collect())
    assert got == {"a": 10, "b": 10}
    s = sampling.stratified_split(df, ["kind"], "id", 0.05)
    assert Counter((r.kind, r.split) for r in s.collect()) == {("a", "val"): 4, ("a", "train"): 86, ("b", "train"): 10}
    assert s.count() == 100
    again = sampling.stratified_split(df.repartition(7), ["kind"], "id", 0.05)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, s.collect()))


def test_cut_split_keeps_one(spark):
    s = sampling.cut_split(spark.range(1), "id", [("train", 0.9)], at_least=1)
    assert s.first().split == "train"


def test_weighted_sample_skips_zeros(spark):
    df = spark.range(50).withColumn("w", (F.col("id") % 2).cast("double"))
    got = sampling.weighted_sample(df, "id", F.col("w"), 40).collect()
    assert len(got) == 25 and all(r.id % 2 for r in got)


def test_global_rank(spark):
    df = spark.range(1000).withColumn("x", F.pmod(F.col("id") * 7919, F.lit(101))).repartition(7)
    got = ranks.global_rank(df, ["x", "id"], "r", F.col("id"), "b").orderBy("r").collect()
    want = sorted(((r.x, r.id) for r in got))
    total = 0
    for i, (r, (x, k)) in enumerate(zip(got, want, strict=True)):
        assert (r.r, r.x, r.id, r.b) == (i, x, k, total)
        total += k


@pytest.mark.parametrize("t", [0.5, 1.0, 3.0, 100.0])
def test_allocation_sums(spark, t):
    df = spark.createDataFrame([("a", 0), ("b", 3), ("c", 9), ("d", 1)], "k string, f int")
    w = allocate.reweight(df, "f", t)
    got = {r.k: (r.weight, r.budget) for r in allocate.largest_remainder(w, "weight", 17, ["k"]).collect()}
    assert sum(b for _, b in got.values()) == 17 and got["a"] == (0.0, 0)
    if t == 1.0:
        assert got["c"][0] == pytest.approx(9 / 13)
    if t == 100.0:
        assert got["b"][0] == pytest.approx(1 / 3, abs=0.01)


def test_allocation_edges(spark):
    zero = spark.createDataFrame([("a", 0), ("b", 0)], "k string, f int")
    assert [r.weight for r in allocate.reweight(zero, "f", 1.0).collect()] == [0.5, 0.5]
    with pytest.raises(ValueError):
        allocate.reweight(zero, "f", 0)
    floor = allocate.largest_remainder(allocate.reweight(zero, "f", 1.0), "weight", 5, ["k"], at_least=2)
    assert sorted(r.budget for r in floor.collect()) == [2, 3]
    over = allocate.largest_remainder(allocate.reweight(zero, "f", 1.0), "weight", 3, ["k"], at_least=2)
    assert sum(r.budget for r in over.collect()) == 3
    assert allocate.split_budget(10, 3) == [4, 3, 3]


EVENTS = "u int, ts timestamp, i int, m string"


def stamp(spark, rows):
    return spark.createDataFrame(rows, "u int, t string, i int, m string").select("u", F.to_timestamp("t").alias("ts"), "i", "m")


def test_sessions(spark):
    rows = [(1, "2024-01-01 00:00:00", 0, "fix: a"), (1, "2024-01-01 04:00:00", 1, "fix: b"), (1, "2024-01-01 08:00:01", 2, "plain"), (1, None, 3, "fix: c"), (1, "2024-01-03 00:00:00", 4, "feat: d"), (1, "2024-01-03 00:00:01", 5, "Merge branch x")]
    df = stamp(spark, rows)
    assert [r.session for r in sessions.gap_sessions(df, ["u"], "ts", ["i"]).orderBy("i").collect()] == [0, 0, 1, 1, 1, 1]
    from millrace.functions.text import commit_prefix

    runs = sessions.prefix_runs(df, ["u"], commit_prefix("m"), ["i"]).orderBy("i").collect()
    assert [(r.i, r.session) for r in runs] == [(0, 0), (1, 0), (3, 1), (4, 2)]
    edge = sessions.boundary_sessions(df.withColumn("m", F.when(F.col("i").isin(0, 2, 3), "Merge branch y").otherwise(F.col("m"))), ["u"], sessions.is_merge(F.col("m")), ["i"])
    assert [(r.i, r.session) for r in edge.orderBy("i").collect()] == [(1, 0), (4, 1)]


@pytest.mark.parametrize("n,want", [(1, []), (2, [0]), (5, [2, 3])])
def test_band(spark, n, want):
    got = sessions.lifecycle_band(spark.range(n), ["id"]).collect()
    assert sorted(r.id for r in got) == want


def test_arcs_and_asof(spark):
    got = sessions.arcs(spark.range(7), ["id"], 3).orderBy("id").collect()
    assert [r.arc for r in got] == [0, 0, 0, 1, 1, 1, 2]
    left, right = spark.createDataFrame([(1, 5), (1, 1), (2, 9)], "k int, at int"), spark.createDataFrame([(1, 3, 10), (1, 5, 11), (1, 6, 12)], "k int, at int, v int")
    got = sessions.asof(left, right, ["k"], "at", "v").collect()
    assert sorted((r.k, r.at, r.v_asof) for r in got if r.v_asof is not None) == [(1, 5, 11)] and len(got) == 3


def test_timestamps(spark):
    rows = ["2024-01-01T10:00:00+02:00", "2024-01-01 10:00:00 +0000", "2024-01-01T10:00:00", "2024-01-01 10:00:00", "2024-01-01", "nope"]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in rows], "x string").select(sessions.parse_timestamp(F.col("x"))).collect()]
    assert [g is not None for g in got] == [True] * 5 + [False] and (got[1] - got[0]).seconds == 7200


def test_interval_overlap(spark):
    rng = np.random.default_rng(0)
    mk = lambda n, a, b: [(int(i), int(s), int(s + w)) for i, s, w in zip(rng.integers(0, 3, n), rng.integers(0, 300, n), rng.integers(0, 150, n), strict=True)]
    x, y = mk(60, 0, 0), mk(60, 0, 0)
    left, right = spark.createDataFrame(x, "k int, a int, b int"), spark.createDataFrame(y, "k int, c int, d int")
    got = Counter(tuple(r) for r in joins.interval_overlap(left, right, ["k"], "a", "b", "c", "d").collect())
    assert got == Counter((k, a, b, c, d) for k, a, b in x for q, c, d in y if k == q and a <= d and c <= b)


def walk(lengths, target, overlap, slack, least, tail, enough, enough_sentences):
    """The windows in words: sentence by sentence."""
    i, out = 0, []
    while i < len(lengths):
        size = used = 0
        for n in lengths[i:]:
            if size + n > target * slack and (size >= enough if enough else used >= enough_sentences) and used:
                break
            size, used = size + n, used + 1
            if size >= target:
                break
        if size >= least:
            out.append((i, i + used))
        i += max(1, used - overlap)
        if i < len(lengths) and sum(lengths[i:]) < tail:
            break
    return out


@given(st.lists(st.integers(1, 60), max_size=40))
def test_windows(lengths):
    for w in (Windows(40, 1, 1.3, 20, 16, enough_sentences=2), Windows(40, 2, 1.4, 30, 20, enough=30), Windows(30, 1, 1.1, 20, 10, enough=20)):
        assert w.spans(lengths) == walk(lengths, w.target, w.overlap, w.slack, w.least, w.tail, w.enough, w.enough_sentences)


def test_packs(spark):
    text = "\n\n".join(["w " * 12, "x " * 150, "tiny", "y. " * 250, "z " * 35])
    df = spark.createDataFrame([(text,)], "t string")
    sizes = [len(c.split()) for c in df.select(chunking.index_chunks("t")).first()[0]]
    assert sizes == [162, 200, 50, 35]
    para = F.array(*[F.lit(p) for p in ("a " * 40, "b " * 70, "c " * 400, "d " * 30)])
    assert [len(p.split()) for p in spark.range(1).select(chunking.style_paragraphs(para)).first()[0]] == [110, 400]


def test_splices(spark):
    base = F.array(*[F.lit(x) for x in ("s0", "s1", "s2", "s3")])
    cand = F.array(*[F.struct(F.lit(p).alias("position"), F.lit(s).alias("sentence"), F.lit(v).alias("similarity")) for p, s, v in ((1, "c", 0.9), (1, "d", 0.8), (2, "c", 0.7), (3, "e", 0.2))])
    get = lambda **k: spark.range(1).select(chunking.spliced(base, cand, **k)).first()[0]
    assert get(ratio=0.5) == ["s0", "s1", "c", "s2", "s3", "e"]
    assert get(mode="replace", ratio=0.5) == ["s0", "c", "s2", "s3"]
    assert get(mode="append", ratio=0.5) == ["s0", "s1", "s2", "s3", "c", "d"]


def unit(n, d=8, seed=0):
    x = np.random.default_rng(seed).normal(size=(n, d))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@pytest.mark.parametrize("one_task", [1000, 30])
def test_k_center(spark, one_task):
    x = unit(80)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "k long, v array<double>").repartition(3)
    got = coreset.k_center(df, "k", "v", 12, one_task=one_task).collect()
    assert len({r.k for r in got}) == 12
    assert [r.k for r in got] == sorted(r.k for r in got)
    assert coreset.k_center(df, "k", "v", 500).count() == 80
    if one_task == 1000:
        order = [r.k for r in sorted(got, key=lambda r: r.pick)]
        radius = [min((1 - x @ x[c])[order[i + 1]] for c in order[: i + 1]) for i in range(11)]
        assert all(a >= b - 1e-12 for a, b in zip(radius, radius[1:], strict=False))


def test_semantic_near_keeps_the_longer(spark):
    x = unit(3)
    rows = [(1, x[0].tolist(), 5), (2, (x[0] * 1.01).tolist(), 9), (3, x[1].tolist(), 1), (4, x[2].tolist(), 7), (5, x[2].tolist(), 7)]
    got = coreset.semantic_near(spark.createDataFrame(rows, "k long, v array<double>, n long"), "k", "v", "n")
    assert sorted(r.k for r in got.collect()) == [2, 3, 4]


def test_blend_and_kmeans(spark):
    x = unit(60)
    df = spark.createDataFrame([(i, "abc"[i % 3], v.tolist(), 10) for i, v in enumerate(x)], "k long, author string, v array<double>, words long")
    got = coreset.blend(df, "author", "k", "v", "a", ["b", "c"], top_percent=0.5, least=2).collect()
    assert Counter(r.author for r in got)["a"] == 20 and all(r.similarity > 0 for r in got)
    assert coreset.kmeans_budget(df, "k", "v", "words", 200).count() >= 15


def budgeted(rows, target, slack=1.1):
    """Keys of (key, cluster, words) chosen by running sums, row by row."""
    got, have = set(), 0
    for c in {r[1] for r in rows}:
        own, total = sorted((r for r in rows if r[1] == c), key=lambda r: (-r[2], r[0])), 0
        for k, _, n in own:
            total += n
            if total <= len(own) / len(rows) * target * slack:
                got.add(k)
                have += n
    if have < 0.9 * target:
        total = 0
        for k, _, n in sorted((r for r in rows if r[0] not in got), key=lambda r: (-r[2], r[0])):
            total += n
            if total <= target - have:
                got.add(k)
    return got


@pytest.mark.parametrize("target", [0, 300, 1500, 100_000])
def test_cluster_budget_matches_running_sums(spark, target):
    rng = np.random.default_rng(target)
    # One cluster holds two thirds of the rows; lengths tie.
    rows = [(i, int(c) if c < 4 else 1, int(n)) for i, (c, n) in enumerate(zip(rng.integers(0, 9, 150), rng.integers(0, 30, 150), strict=True))]
    df = spark.createDataFrame(rows, "k long, cluster int, words long").repartition(5)
    assert {r.k for r in coreset.cluster_budget(df, "k", "words", target).collect()} == budgeted(rows, target)
    assert coreset.cluster_budget(df.filter("k < 0"), "k", "words", target).count() == 0


@pytest.mark.parametrize("threshold,share", [(0.1, None), (None, 0.3)])
def test_blend_matches_plain_rounds(spark, threshold, share):
    x = unit(90, seed=8)
    who = ["abcd"[i % 4] for i in range(90)]
    df = spark.createDataFrame([(i, w, v.tolist()) for i, (w, v) in enumerate(zip(who, x, strict=True))], "k long, author string, v array<double>")
    got = {r.k: r.similarity for r in coreset.blend(df, "author", "k", "v", "a", ["b", "c"], threshold, share, least=3).collect()}
    taken = {i: (1.0, 2.0) for i in range(90) if who[i] == "a"}
    for name in "bc":
        center = sum(x[i] * w for i, (_, w) in taken.items()) / sum(w for _, w in taken.values())
        like = {i: float(x[i] @ center / (np.linalg.norm(x[i]) * np.linalg.norm(center) + 1e-8)) for i in range(90) if who[i] == name}
        order = sorted((i for i in like if (like[i] >= threshold if threshold is not None else like[i] > 0)), key=lambda i: (-like[i], i))
        taken |= {i: (like[i], 1.0) for i in (order if threshold is not None else order[: max(3, int(len(order) * share))])}
    assert set(got) == set(taken) and len(got) < 69
    assert all(abs(got[i] - taken[i][0]) < 1e-6 for i in got)


@pytest.mark.parametrize("most", [20_000, 0])
def test_vector_top_ties(spark, most, monkeypatch):
    monkeypatch.setattr(joins, "QUERY_ROWS", most)
    q = spark.createDataFrame([(1, [1.0, 0.0])], "id int, v array<double>")
    items = spark.createDataFrame([(5, [1.0, 0.0]), (3, [2.0, 0.0]), (4, [0.0, 1.0])], "id int, v array<double>")
    got = joins.vector_top(q, items, "v", "v", "id", "id", 2).collect()
    assert {r.id_match for r in got} == {3, 5}


def test_models_retry_and_fail_by_row(spark):
    def factory():
        state = {"n": 0}

        def call(texts):
            state["n"] += 1
            if state["n"] == 1:
                raise models.Retryable
            if any("bad" in t for t in texts):
                raise ValueError
            return [t.upper() for t in texts]

        return call

    df = spark.createDataFrame([("a",), ("bad",), ("c",)], "t string").coalesce(1)
    got = models.generated(df, F.col("t"), factory, wait=0.0).collect()
    assert [r.answer for r in got] == ["A", None, "C"]


def test_references_round_trip(spark):
    df = spark.createDataFrame([("The old Roman road[^1] ran north [2,3-4] to York.",)], "t string")
    r = df.select(models.references(F.col("t")).alias("r"), F.lit("It ran north; the road to Rome was long.").alias("o"))
    out = r.select("r", models.reinjected(F.col("o"), F.col("r")).alias("x")).first()
    assert [x.ref_id for x in out.r] == ["1", "2,3-4"]
    assert "road[^1]" in out.x.text and "north[2,3-4]" in out.x.text and out.x.dropped == []


def test_text_changes(spark):
    df = spark.createDataFrame([("the very big house was said to be old. " * 5,)], "t string")
    a, b = (df.select(models.perturbed(F.col("t"), 0.3)).first()[0] for _ in range(2))
    assert a == b != df.first().t
    m = spark.createDataFrame([("we met John Smith in Paris, then John Smith left",)], "t string").select(models.masked(F.col("t")).alias("m"))
    from millrace.functions.text import restored

    assert "John" not in m.first().m.text
    assert m.select(restored("m.text", "m.entities")).first()[0] == "we met John Smith in Paris, then John Smith left"
    long_ = "word " * 20 + "here, and " + "more " * 10 + "end."
    assert spark.createDataFrame([(long_,)], "t string").select(models.split_long(F.col("t"))).first()[0].count(".") == 2
    assert spark.createDataFrame([("Delve into it",)], "t string").select(models.phrases_replaced(F.col("t"), {"delve into": "explore"})).first()[0] == "Explore it"


def test_containing(spark, monkeypatch):
    texts = ["xa b c d e fx", "a b  c d e f", "one two", "a b c d e f and one two", None, ""]
    items = [(1, "a b c d e f"), (2, "one two"), (3, "two"), (4, None), (5, "b c d e fx")]
    want = sorted((i, k) for i, t in enumerate(texts) for k, x in items if t is not None and x is not None and x in t)
    docs = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    for most in (20_000, 0):
        monkeypatch.setattr(joins, "ITEM_KEYS", most)
        got = joins.containing(docs, "text", spark.createDataFrame(items, "item long, t string"), "item", "t")
        assert sorted((r.i, r.item) for r in got.collect()) == want


def test_first_by_hash_is_a_rank_limit(spark):
    import hashlib

    rows = [(i, "a" if i % 3 else None, i % 2) for i in range(400)]
    df = spark.createDataFrame(rows, "k long, g string, h long")
    got = {r.k for r in sampling.first_by_hash(df, ["g", "h"], "k", lambda n: F.floor(n * 0.3)).filter("_first").collect()}
    want = set()
    for g, h in {(g, h) for _, g, h in rows}:
        own = sorted((hashlib.md5(f"42:{k}".encode()).hexdigest(), k) for k, a, b in rows if (a, b) == (g, h))
        want |= {k for _, k in own[: int(len(own) * 0.3)]}
    assert got == want
    assert sampling.first_by_hash(df, ["g"], "k", lambda n: n + 5).filter("_first").count() == 400
    assert sampling.first_by_hash(df, ["g"], "k", lambda n: F.lit(0)).filter("_first").count() == 0


def verified(source, output):
    """(score, grounded, hallucinations, fabricated) by plain loops."""
    stop = set(lexicons.STOP_WORDS)

    def content(t):
        w = [v.strip(".,!?;:'\"()-—") for v in t.lower().split()]
        return {v for v in w if len(v) >= 4 and v.isalpha() and v not in stop}

    def names(t):
        return {v.lower() for v in re.findall(r"(?<=[a-z,;] )[A-Z][a-zé]+(?: [A-Z][a-zé]+)*", t)}

    def stem(a, b):
        a, b = sorted((a, b), key=len)
        return a == b or (len(a) >= 5 and b.startswith(a) and len(b) - len(a) <= 2)

    split = lambda t: [v.strip() for v in re.split(r"(?<=[.!?])\s+", t) if v.strip()]
    years = lambda t: set(re.findall(r"\b(1[89]\d{2}|20\d{2})\b", t))
    cites = lambda t: set(re.findall(r"\([^)]*(?:19|20)\d{2}[^)]*\)", t))
    src, every, good, bad = [content(v) for v in split(source)], content(source), [], 0
    for v in split(output):
        own, n = content(v), len(v.split())
        best = max((2 * len(own & w) / (len(own) + len(w)) for w in src if own & w), default=0.0)
        novel = len(own - every) / len(own) if own else 0.0
        free = n < 4 or not own
        good.append(free or best >= 0.4 or novel < 0.3)
        bad += not free and best < 0.15 and novel > 0.5 and n > 8
    grounded = sum(good) / len(good) if good else 0.0
    covered = len(every & content(output)) / len(every) if every else 1.0
    a, b = names(source), names(output)
    known = sum(any(stem(x, y) for y in b) for x in a) / len(a) if a else 1.0
    made = sum(not any(stem(x, y) for x in a) for y in b) + len(years(output) - years(source)) + len(cites(output) - cites(source))
    return max(0.0, 0.4 * grounded + 0.3 * covered + 0.3 * known - min(0.5, 0.15 * bad) - min(0.3, 0.1 * made)), grounded, bad, made


def test_verification_matches_plain_loops(spark):
    parts = [
        "The river crossed the old valley near Lyon in 1923.", "A merchant named Hegel walked, with Anna Karen, across the market.", "Nothing grows there!", "Why not?",
        "Engines burn fuel (Smith 2001) while pilots watch several silver gauges every morning.", "The valley near Lyons was crossed by the old river.", "Go on then.",
        "Completely unrelated planets orbit distant stars beyond imagination, however quickly astronomers calculate trajectories.", "In 1850 the Prussian army left, Marx wrote.", "it was so.",
    ]
    rng = np.random.default_rng(12)
    rows = [(i, " ".join(rng.choice(parts, rng.integers(0, 6))), " ".join(rng.choice(parts, rng.integers(0, 6)))) for i in range(120)]
    df = spark.createDataFrame(rows, "k int, a string, b string").select("k", joins.verification("a", "b").alias("v"))
    got = {r.k: r.v for r in df.collect()}
    wants = [verified(a, b) for _, a, b in rows]
    assert len({w[2] for w in wants}) > 1 and len({w[3] for w in wants}) > 2
    for (i, a, b), want in zip(rows, wants, strict=True):
        v = got[i]
        assert (v.hallucinations, v.fabricated) == want[2:], (a, b)
        assert abs(v.score - want[0]) < 1e-9 and abs(v.grounded - want[1]) < 1e-9, (a, b)
        assert v.valid == (v.score >= 0.7)
