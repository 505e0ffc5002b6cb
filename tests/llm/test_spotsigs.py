import base64
import hashlib
import random
import re

import xxhash

from millrace.llm import spotsigs as S
from tests.llm.helpers import AWKWARD, docs


def test_rows_match_brute_force(spark):
    rows = [r for r in AWKWARD if r[0] not in (8, None)] + [(50 + i, f"the cat {i} sat of mat {i} and the dog ran to house {i * 3}") for i in range(40)]
    got = {r.doc_id: r for r in S.fingerprints(docs(spark, rows)).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    assert len(got) == len(rows)
    for i, (d, t) in enumerate(order):
        t, n = t or "", order[(i + 1) % len(order)][1] or ""
        k = len(t) // 3
        x = t[: len(t) - k] + n[:k]
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(x.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (S.fingerprint(S.signatures(t)), S.fingerprint(S.signatures(x)))
        a, b, c = (set(S.signatures(y).tolist()) for y in (t, x, n))
        j = lambda p, q: len(p & q) / len(p | q) if p | q else 1.0
        assert abs(r.near_edited - j(a, b)) < 1e-12 and abs(r.near_next - j(a, c)) < 1e-12


def test_repeated_rows_null_ids_and_one_row(spark):
    assert S.fingerprints(docs(spark, AWKWARD)).count() == len(AWKWARD)
    (r,) = S.fingerprints(docs(spark, [(5, "the cat sat of mat")])).collect()
    assert r.near_next == 1.0
    assert S.fingerprints(docs(spark, [])).count() == 0


def test_equal_texts_have_equal_fingerprints(spark):
    got = S.fingerprints(docs(spark, [(1, "the cat sat on the mat"), (2, "the cat sat on the mat")])).collect()
    assert len({r.fingerprint for r in got}) == 1


def test_pruned_likeness():
    a, b = S.signatures("the cat sat of mat and the dog ran to house again"), S.signatures("the cat sat of mat and the dog ran to barn again")
    full = S.likeness(a, b)
    assert 0 < full < 1
    assert S.likeness(a, b, full) == full and S.likeness(a, b, full + 0.01) == 0.0
    assert S.parsed(S.fingerprint(a)).tolist() == a.tolist()


def test_pairs(spark):
    text = " ".join(f"the word{i} item{i} of thing{i}" for i in range(40))
    rows = [(1, text), (2, text + " the last one here"), (3, text), (4, "the other text of nothing alike and more to say")]
    got = S.near_pairs(docs(spark, rows), 0.8).collect()
    assert [(r.a, r.b) for r in got] == [(1, 2)]


def plain_signatures(t, chain=2, reach=8):
    """The signatures' hashes, word by word from the definition."""
    words = re.findall(r"\w+", t.lower())
    content_at = [i for i, w in enumerate(words) if w not in S.ANCHORS]
    out = set()
    for i, w in enumerate(words):
        lonely = not any(x in S.ANCHORS for x in words[max(0, i - reach) : i]) and (i >= reach or not any(x in S.ANCHORS for x in words[:i]))
        if w in S.ANCHORS or lonely:
            out.add(xxhash.xxh3_64_intdigest(" ".join([w, *[words[j] for j in content_at if j > i][:chain]])))
    return sorted(out)


def test_signatures_match_their_definition():
    rng = random.Random(4)
    for n in (0, 1, 2, 5, 40, 200):
        for share in (0, 0.05, 0.5, 1):
            t = " ".join(rng.choice(["the", "of", "der", "la"]) if rng.random() < share else f"w{rng.randrange(50)}" for _ in range(n))
            assert S.signatures(t).tolist() == plain_signatures(t)
            assert bool(n) == bool(len(S.signatures(t)))


def test_rows_match_a_version_without_the_modules_own_functions(spark):
    rows = [(1000 - 7 * i, f"the cat {i} sat of mat {i % 5} and dog{i} " * (i % 9) + "ÄÖ ß"[: i % 5]) for i in range(60)] + [(5, None), (3, "")]
    got = {r.doc_id: r for r in S.fingerprints(docs(spark, rows)).collect()}
    order = sorted(rows, reverse=True, key=lambda r: r[0])
    for i, (d, t) in enumerate(order):
        t, n = t or "", order[(i + 1) % len(order)][1] or ""
        k = len(t) // 3
        x = t[: len(t) - k] + (n[:k])
        a, b, c = (set(plain_signatures(y)) for y in (t, x, n))
        for own, fp in ((a, got[d].fingerprint), (b, got[d].edited_fingerprint)):
            assert fp == f"{len(own)}:" + base64.b64encode(b"".join(v.to_bytes(8, "little") for v in sorted(own))).decode()
        like = [len(a & y) / len(a | y) if a | y else 1.0 for y in (b, c)]
        assert abs(got[d].near_edited - like[0]) < 1e-12 and abs(got[d].near_next - like[1]) < 1e-12


def test_an_id_of_many_rows_is_cut(spark):
    rows = [(7, f"the text {i} of row {i % 150}") for i in range(300)] + [(None, f"no id {i}") for i in range(150)] + [(i, f"the own {i}") for i in range(20, 60)] + [(7, "the text 3 of row 3")] * 5
    df = docs(spark, rows)
    buckets = S._in_order(df).filter("not halo").groupBy("bucket").count().collect()
    assert sum(r["count"] for r in buckets) == len(rows) and max(r["count"] for r in buckets) < 100
    got = S.fingerprints(df).collect()
    assert sorted((str(r.doc_id), r.n_chars) for r in got) == sorted((str(i), len(t)) for i, t in rows)
    # In one round through all rows each is the next of another.
    hashes = {r.t: r.h for r in spark.createDataFrame([(t,) for _, t in set(rows)], "t string").selectExpr("t", "xxhash64(t) h").collect()}
    order = sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else -1e308), -hashes[r[1]], r[1]))
    want = sorted(hashlib.sha256((t[: len(t) - len(t) // 3] + order[(i + 1) % len(order)][1][: len(t) // 3]).encode()).hexdigest() for i, (_, t) in enumerate(order))
    assert sorted(r.edited_sha256 for r in got) == want
